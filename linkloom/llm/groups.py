"""Whole groups out of sorted Arrow batches, without holding a partition in memory."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold only complete groups of the integer column ``key`` (rows sorted by it, no nulls)."""
    pending: list[pa.Table] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        keys = table.column(key).to_numpy()
        if keys[0] == keys[-1] and last is not None and keys[0] == last:
            pending.append(table)
            continue
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut or (last is not None and keys[0] != last):
            pending.append(table.slice(0, cut))
            yield pa.concat_tables(pending).combine_chunks()
            pending = [table.slice(cut)]
        else:
            pending.append(table)
        last = keys[-1]
    if pending:
        yield pa.concat_tables(pending).combine_chunks()


def bounds(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the length at the end."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])).astype(np.int64)
