"""Minimum-cost role repair of conversations, then rendering.

A conversation is legal if it is (system)? (user assistant)+. A dynamic programme over the
automaton of the last turn's role chooses for every turn its label and whether it is appended,
merged into the turn before, or preceded by empty turns. Turns are cut into segments by turn
number, and segments of many turns with equal or no numbers into pieces of a sort by range;
each piece becomes a 4 x 4 cost matrix, a conversation chains its pieces' matrices (min-plus
products; 150 bytes for each 256 turns or so), and pieces are then decoded and rendered apart:
a conversation of any length never meets in one task as text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.storage import materialize

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
RELABEL, MERGE, INSERT = 3, 1, 2
SEGMENT = 256
#: Turns of one segment that are collected as they are.
LIMIT = 4096
INF = 1 << 40
#: Empty turns to put between a state and a label, None where no legal way exists.
_BETWEEN = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (ASSISTANT, USER): (),
    (USER, USER): (ASSISTANT,), (ASSISTANT, ASSISTANT): (USER,),
}
#: Empty turns that close a conversation that ends in a state.
_CLOSE = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _step_costs(role: str | None) -> np.ndarray:
    """Cost [state, label] of a turn of ``role``."""
    out = np.full((4, 4), INF, np.int64)
    for state in range(4):
        for label in (SYSTEM, USER, ASSISTANT):
            ways = [MERGE] if state == label else []
            if (state, label) in _BETWEEN:
                ways.append(INSERT * len(_BETWEEN[state, label]))
            if ways:
                out[state, label] = min(ways) + RELABEL * (role != ROLES[label - 1])
    return out


_COSTS = {r: _step_costs(r) for r in (*ROLES, None)}


def _costs(role: str | None) -> np.ndarray:
    return _COSTS[role if role in ROLES else None]


def segment_matrix(roles: list[str | None]) -> np.ndarray:
    """Least cost [entry state, exit state] over a segment's turns."""
    out = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(out, 0)
    for role in roles:
        out = np.minimum(INF, (out[:, :, None] + _costs(role)[None]).min(axis=1))
    return out


def plan(matrices: list[np.ndarray]) -> tuple[list[tuple[int, int]], int]:
    """(entry, exit) state of each segment on the cheapest way, and its cost with the closing turns."""
    after = [np.array([INSERT * len(_CLOSE[s]) for s in range(4)], np.int64)]
    for m in reversed(matrices):
        after.append((m + after[-1][None, :]).min(axis=1))
    after.reverse()
    state, out = START, []
    for i, m in enumerate(matrices):
        to = int((m[state] + after[i + 1]).argmin())
        out.append((state, to))
        state = to
    return out, int(after[0][START])


def decode(roles: list[str | None], entry: int, end: int) -> list[int]:
    """The labels of a segment's turns on the cheapest way from one state to another; ties go to the smaller label."""
    after = [np.where(np.arange(4) == end, 0, INF)]
    for role in reversed(roles):
        after.append(np.minimum(INF, (_costs(role) + after[-1][None, :]).min(axis=1)))
    after.reverse()
    state, out = entry, []
    for i, role in enumerate(roles):
        state = int((_costs(role)[state] + after[i + 1]).argmin())
        out.append(state)
    return out


def escaped(text: str | None) -> str:
    """A turn's text, null as empty, that can't be taken for the marks around turns: ``<|im_`` gets a backslash before the bar."""
    return (text or "").replace("<|im_", "<\\|im_")


def render(roles: list[str | None], texts: list[str | None], labels: list[int], entry: int, last: bool) -> tuple[str, int, int, int]:
    """The segment's part of the rendered conversation, and the numbers of merges, relabels and inserts."""
    out, state, merges, relabels, inserts = [], entry, 0, 0, 0

    def turn(label: int, text: str) -> None:
        nonlocal state
        out.append(("" if state == START else "<|im_end|>\n") + f"<|im_start|>{ROLES[label - 1]}\n{text}")
        state = label

    for role, text, label in zip(roles, texts, labels, strict=True):
        relabels += role != ROLES[label - 1]
        if label == state:
            merges += 1
            out.append("\n" + escaped(text))
            continue
        for empty in _BETWEEN[state, label]:
            inserts += 1
            turn(empty, "")
        turn(label, escaped(text))
    if last:
        for empty in _CLOSE[state]:
            inserts += 1
            turn(empty, "")
        out.append("<|im_end|>\n")
    return "".join(out), merges, relabels, inserts


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of large segments in pieces of at most ``SEGMENT``; sub numbers a segment's pieces in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("sub", pa.int64()), ("turns", pa.list_(_TURN))])
    task, number = TaskContext.get().partitionId() + 1, 0
    key, held = None, []
    done: list[dict] = []
    for batch in batches:
        for conv, part, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and ((conv, part) != key or len(held) == SEGMENT):
                done.append({"conv_id": key[0], "part": key[1], "sub": (task << 32) + number, "turns": held})
                number, held = number + 1, []
            key = (conv, part)
            held.append(dict(zip(("turn", "role", "hash", "text"), turn, strict=True)))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if held:
        yield pa.RecordBatch.from_pylist([{"conv_id": key[0], "part": key[1], "sub": (task << 32) + number, "turns": held}], schema)


_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("hash", pa.int64()), ("text", pa.string())])


def _packed(turns: DataFrame, segment: int, limit: int) -> DataFrame:
    """conv_id, part, sub, turns: the sorted turns of each segment, large segments in several rows."""
    picked = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.lower(F.trim(F.col("role").cast("string"))).alias("role"), F.col("text").cast("string").alias("text"))
    part = F.coalesce(F.floor(F.col("turn") / segment), F.lit(-(1 << 62)))
    picked = picked.select("conv_id", part.alias("part"), "turn", "role", F.xxhash64("text").alias("hash"), "text", F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("conv"))
    keys, order = ["none", "conv", "part"], ["turn", "role", "hash", "text"]
    # at most one of ``limit`` turns names such a segment
    large = materialize(picked.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(*keys), "large")
    whole = picked.join(large, keys, "left_anti").groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("turns"))
    whole = whole.select("conv_id", "part", F.lit(0).cast("long").alias("sub"), "turns")
    if large.isEmpty():
        return whole
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the row's number parts equal turns, too
    rest = picked.join(large, keys, "left_semi").withColumn("no", F.monotonically_increasing_id())
    rest = rest.repartitionByRange(parts, *keys, "turn", "role", "hash", "no").sortWithinPartitions(*keys, *order)
    pieces = rest.select("conv_id", "part", *order).mapInArrow(_pieces, "conv_id long, part long, sub long, turns array<struct<turn: bigint, role: string, hash: bigint, text: string>>")
    return whole.unionByName(pieces)


def format_chats(turns: DataFrame, segment: int = SEGMENT, limit: int = LIMIT) -> DataFrame:
    """conv_id, part, sub, rendered, n_turns, n_merges, n_relabels, n_inserts: a row per conversation and segment.

    ``turns`` has conv_id, turn, role and text. Turns are ordered by turn number (nulls
    first), ties by role, a hash of the text and the text; a part holds the turn numbers of one
    ``segment`` range, and one of more than ``limit`` turns gives several rows, numbered by sub.
    The rendered texts of a conversation, joined by part and sub, are its text. Unknown or null
    roles can take any label at the price of a relabel; null texts are empty, and a text that
    holds a mark of turns has it escaped. Rows without conv_id form one conversation. Repeated
    rows are turns each. Other columns are ignored; an empty table gives an empty one.
    """
    packed = materialize(_packed(turns, segment, limit), "turns")

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [segment_matrix(roles).ravel().tolist() for roles in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.list_(pa.int64()))], ["conv_id", "part", "sub", "m"])

    costs = packed.select("conv_id", "part", "sub", F.col("turns.role").alias("roles")).mapInArrow(matrices, "conv_id long, part long, sub long, m array<bigint>")
    chained = costs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "sub", "m"))).alias("parts"))

    def plans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for conv, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ways, _ = plan([np.array(p["m"], np.int64).reshape(4, 4) for p in parts])
                for i, (p, (entry, end)) in enumerate(zip(parts, ways, strict=True)):
                    for column, value in zip(rows, (conv, p["part"], p["sub"], entry, end, i == len(parts) - 1), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], ["c", "p", "s", "entry", "end", "last"])

    ways = chained.mapInArrow(plans, "c long, p long, s long, entry int, end int, last boolean")
    joined = packed.join(ways, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("sub") == F.col("s")))

    def rendered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for turns, entry, end, last in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6)), strict=True):
                roles, texts = [t["role"] for t in turns], [t["text"] for t in turns]
                text, *counts = render(roles, texts, decode(roles, entry, end), entry, last)
                for column, value in zip(out, (text, len(turns), *counts), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out[0], pa.string()), *[pa.array(x, pa.int64()) for x in out[1:]]], ["conv_id", "part", "sub", "rendered", "n_turns", "n_merges", "n_relabels", "n_inserts"])

    return joined.select("conv_id", "part", "sub", "turns", "entry", "end", "last").mapInArrow(rendered, "conv_id long, part long, sub long, rendered string, n_turns long, n_merges long, n_relabels long, n_inserts long")
