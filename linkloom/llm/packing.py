"""Best-fit packing with certified bin counts.

Each round deals the open pieces over groups of about ``GROUP`` rows and packs every group by
best-fit decreasing. Dual feasible functions bound the group's bin count from below. A group
whose count equals its bound is certified and keeps all its sequences. A group with a gap
keeps the sequences that are nearly full and releases the documents of the others, with those
of some sequences of many small documents; what the groups release is dealt anew over fewer
groups and packed again. A round that needs no fewer sequences than were released changes
nothing and ends the exchange. Rows are dealt by their number in the written table, so equal
rows are spread as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.storage import materialize
from linkloom.llm.tokens import CACHE, encoder

CAPACITY = 2048
GROUP = 16_384
ROUNDS = 4
#: A sequence with less room than this share of the capacity is never released.
SLACK = 0.005
#: As many sequences of the most documents are released for each of those with room.
MIXED = 1


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian uint32 bytes): each document's ids, then id 0, cut at ``capacity``.

    A null or empty text is the single id 0. Repeated rows are packed as often as they occur.
    Other columns are ignored. ``cache`` words at most are held twice in each worker.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, cache).encode
        step, schema = 4 * capacity, pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(low, 1000), ([], [], [], [], [])
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encode(text or "") + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(ids), step)):
                        own = ids[at : at + step]
                        for column, value in zip(rows, (doc, piece, at // 4, len(own) // 4, own), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema, strict=True)], schema=schema)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item (given in decreasing order), and the room left in each bin."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, offsets, open_rooms = [], [], [], 0
    for n in lengths.tolist():
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, own = capacity, len(rooms)
            rooms.append(capacity)
        bins.append(own)
        offsets.append(capacity - room)
        rooms[own] = room - n
        if room > n:
            by_room[room - n].append(own)
            open_rooms |= 1 << (room - n)
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(rooms, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best of three families of dual feasible functions: size, size with a threshold, and rounding."""
    if not len(lengths):
        return 0
    x = np.asarray(lengths, np.int64)
    best = -(-int(x.sum()) // capacity)
    count = np.bincount(x, minlength=capacity + 1)
    items, weight = np.concatenate(([0], np.cumsum(count))), np.concatenate(([0], np.cumsum(count * np.arange(capacity + 1))))
    cut = np.arange(0, capacity // 2 + 1)
    # items over capacity - cut count as a whole bin, those under cut as nothing
    large = items[capacity + 1] - items[capacity - cut + 1]
    middle = weight[capacity - cut + 1] - weight[cut]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, 33):
        scaled = (k + 1) * x
        # in units of 1 / (k * capacity)
        value = np.where(scaled % capacity == 0, k * x, (scaled // capacity) * capacity)
        best = max(best, -(-int(value.sum()) // (k * capacity)))
    return best


def _packer(round_no: int, last: bool, capacity: int, names: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending")] + [(n, "ascending") for n in names])
        lengths = table.column("length").to_numpy()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        group, bound = table.column("g")[0].as_py(), lower_bound(lengths, capacity)
        if len(rooms) > 1 << 21:
            raise ValueError("a group has more sequences than its numbers allow; deal smaller groups")
        loose = np.zeros(len(rooms), bool)
        if len(rooms) > bound and not last:
            loose = rooms > SLACK * capacity
            # without small documents the others can't be arranged anew
            many = np.argsort(-np.bincount(bins), kind="stable")
            loose[many[: MIXED * max(int(loose.sum()), len(rooms) - bound)]] = True
        new = {
            "sequence_id": pa.array((round_no << 58) + (group << 21) + bins),
            "offset": pa.array(offsets),
            "open": pa.array(loose[bins]),
            "group_bins": pa.array(np.full(len(bins), len(rooms), np.int64)),
            "group_bound": pa.array(np.full(len(bins), bound, np.int64)),
        }
        for name, column in new.items():
            at = table.schema.get_field_index(name)
            table = table.set_column(at, name, column) if at >= 0 else table.append_column(name, column)
        return table

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """All rows of ``pieces`` with sequence_id, offset, group_bins and group_bound added.

    ``pieces`` has a column length (1 to ``capacity``); every other column is carried along,
    but for the names that this operator adds, which it overwrites. group_bins against
    group_bound is the certificate of the last group a row was packed in. An empty table
    gives an empty one.
    """
    added = ["sequence_id", "offset", "open", "group_bins", "group_bound", "g"]
    pieces = pieces.select("length", *[c for c in pieces.columns if c not in ("length", *added)])
    names = [f.name for f in pieces.schema if f.name != "length" and isinstance(f.dataType, (T.IntegralType, T.StringType))]
    table = materialize(pieces, "pieces")
    salt = F.monotonically_increasing_id()
    schema = T.StructType([*pieces.schema.fields, *[T.StructField(n, T.BooleanType() if n == "open" else T.LongType()) for n in added]])
    done: list[DataFrame] = []
    whole = table.where(F.col("length") == capacity)
    own = (F.lit(ROUNDS + 1).cast("long") * F.lit(1 << 58)) + F.monotonically_increasing_id()
    done.append(whole.select(*pieces.columns, own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("group_bins"), F.lit(1).cast("long").alias("group_bound")))
    left, before = table.where(F.col("length") < capacity), None
    final = [*pieces.columns, "sequence_id", "offset", "group_bins", "group_bound"]
    for round_no in range(ROUNDS):
        n = left.count()
        groups = max(1, -(-n // group))
        last = groups == 1 or round_no == ROUNDS - 1
        dealt = left.withColumn("g", F.pmod(F.xxhash64(salt, F.lit(round_no)), F.lit(groups)))
        packed = dealt.groupBy("g").applyInArrow(_packer(round_no, last, capacity, names), T.StructType([f for f in _order(dealt, schema)]))
        packed = materialize(packed, "packed")
        if before is not None and packed.select("sequence_id").distinct().count() >= before:
            done.append(left.select(*final))
            break
        done.append(packed.where(~F.col("open")).select(*final))
        left = packed.where(F.col("open")).drop("g", "open")
        before = left.select("sequence_id").distinct().count()
        if not before:
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _order(dealt: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """The columns as the packer returns them: those it gets, then those it adds."""
    return [*dealt.schema.fields, *[f for f in schema if f.name not in dealt.columns]]


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, group_bins, group_bound; and ids with ``keep_ids``.

    Offsets in a sequence leave no gaps. See ``token_pieces`` for nulls, empty texts and
    repeated rows.
    """
    pieces = token_pieces(docs, tokenizer, capacity, cache=cache).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if keep_ids else pieces.drop("ids"), capacity)

