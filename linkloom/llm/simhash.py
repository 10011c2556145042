"""SimHash near duplicates by meet-in-the-middle ball hashing.

Radius 3 is odd: half of it is one bit flip and a half. The half bit is paid by masking.
The 64 bits are cut into four blocks of 16. If two fingerprints differ in 1 to 3 bits, at
least one differing bit lies in some block, so with that block masked they differ in at most
2 bits, and the balls of one flip around both meet. Every distinct fingerprint therefore
emits, for each masked block, itself and its 48 one-flip variants: 4 * 49 = 196 keys.
(Rounding half the radius up to 2 over all 64 bits takes 2,081 keys.) Equal keys meet in one
bucket; a bucket holds at most 2**16 * 49 fingerprints whatever the input, and yields a
forest of its verified links, at most one row a member, never all pairs, in large buckets
without comparing all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.components import connected
from linkloom.llm.groups import bounds, whole_groups
from linkloom.llm.storage import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
_STEP = 1 << 16
#: Prints of a bucket that are compared each with each.
DENSE = 4096


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit SimHash of the 3-word shingles of UTF-8 ``text``; no words or null: 0."""
    words = (text or b"").lower().split()
    n = len(words)
    if n == 0:
        return 0
    flat = b" ".join(words)
    if n < SHINGLE:
        return xxhash.xxh64_intdigest(flat, SEED)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: n - SHINGLE + 1]
    ends = ends[SHINGLE - 1 :]
    digest, total, votes = xxhash.xxh64_intdigest, n - SHINGLE + 1, np.zeros(64, np.int64)
    for low in range(0, total, _STEP):
        spans = zip(starts[low : low + _STEP].tolist(), ends[low : low + _STEP].tolist(), strict=True)
        hashes = np.array([digest(flat[s:e], SEED) for s, e in spans], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(x) for x in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), one row per input row."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(_fingerprints, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball_masks() -> list[tuple[int, int]]:
    """(keep, flip) of the 196 keys: key = (fingerprint & keep) ^ flip; the masked block holds its number."""
    out = []
    for block in range(4):
        low = 16 * block
        keep = ((1 << 64) - 1) ^ (0xFFFF << low)
        flips = [0] + [1 << i for i in range(64) if not low <= i < low + 16]
        out += [(_signed(keep), _signed((block + 1) << low ^ f)) for f in flips]
    return out


def _ball(fp: str) -> Column:
    return F.array(*[F.struct(F.lit(k).cast("long").alias("keep"), F.lit(x).cast("long").alias("flip")) for k, x in ball_masks()])


def forest(prints: np.ndarray, radius: int = RADIUS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Roots and members of the trees that the links among sorted distinct ``prints`` span."""
    roots, members, left = [], [], prints
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                roots.append(np.full(len(found), root))
                members.append(found)
                queue.extend(found)
    return roots, members


def dense_forest(prints: np.ndarray, key: np.uint64) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The same for the many distinct prints of one bucket, without comparing each with each.

    Outside the masked block a print has the key's bits, or one flip. Prints of one value of
    the block are linked, whatever their flips; values at distance 1 are, too; at distance 2 if
    they share a flip or one has a print without, at distance 3 if they share one. So labels
    spread over the 65,536 values along 696 masks, and over labels of labels, until none changes.
    """
    for block in range(4):
        low = np.uint64(16 * block)
        outside = (prints ^ key) & np.uint64(((1 << 64) - 1) ^ (0xFFFF << 16 * block))
        if (np.bitwise_count(outside) <= 1).all():
            break
    else:
        return forest(prints)
    value = ((prints >> low) & np.uint64(0xFFFF)).astype(np.int64)
    # bit 0 of flips: a print without a flip; the masked block's own bits never flip
    at = np.where(outside == 0, 0, 1 + np.bitwise_count(outside - np.uint64(1)).astype(np.int64))
    at -= 16 * (at > 16 * block + 16)
    flips = np.zeros(1 << 16, np.uint64)
    np.bitwise_or.at(flips, value, np.uint64(1) << at.astype(np.uint64))
    every, label = np.arange(1 << 16), np.where(flips > 0, np.arange(1 << 16), 1 << 16)
    masks = [m for m in range(1, 1 << 16) if m.bit_count() <= RADIUS]
    while True:
        before = label.copy()
        for m in masks:
            other, shared = flips[every ^ m], flips & flips[every ^ m]
            near = (flips > 0) & (other > 0)
            if m.bit_count() == 2:
                near &= (shared > 0) | ((flips | other) & np.uint64(1) > 0)
            elif m.bit_count() == 3:
                near &= shared > 0
            label = np.where(near, np.minimum(label, label[every ^ m]), label)
        label = np.minimum(label, np.append(label, 1 << 16)[label])
        if (label == before).all():
            break
    first = np.full((1 << 16) + 1, len(prints))
    np.minimum.at(first, label[value], np.arange(len(prints)))
    root = first[label[value]]
    member = root != np.arange(len(prints))
    return [prints[root[member]]], [prints[member]]


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a", "b"]
    for table in whole_groups(batches, "key"):
        keys, prints = table.column("key").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
        at = bounds(keys)
        size = np.diff(at)
        two = at[:-1][size == 2]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= RADIUS
        roots, members = [prints[two][near]], [prints[two + 1][near]]
        for i in np.flatnonzero(size > 2):
            own = np.unique(prints[at[i] : at[i + 1]])
            r, m = forest(own) if len(own) <= DENSE else dense_forest(own, keys[at[i] : at[i] + 1].view(np.uint64)[0])
            roots += r
            members += m
        found = np.stack([np.concatenate(roots), np.concatenate(members)], axis=1)
        found.sort(axis=1)
        found = np.unique(found, axis=0).view(np.int64)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names)


def links(prints: DataFrame) -> DataFrame:
    """Rows (a, b) whose transitive closure is that of all links among the distinct values of ``fp``."""
    distinct = prints.select("fp").where("fp is not null").distinct()
    # small rows that each give 196: spread them over as many tasks as there are, whatever their bytes
    spread = distinct.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    keyed = spread.select("fp", F.inline(_ball("fp")))
    keyed = keyed.select(F.col("fp").bitwiseAND(F.col("keep")).bitwiseXOR(F.col("flip")).alias("key"), "fp")
    met = keyed.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(_bucket_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per input row.

    Texts with equal fingerprints, or 3 or fewer differing bits, are linked; component_id is
    the smallest doc_id reachable. Null or wordless texts have fingerprint zero and link like
    others. A null doc_id keeps its row and never becomes a component_id unless no other id is
    there. Repeated rows give repeated rows. Other columns of ``docs`` are ignored.
    """
    table = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = table.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected(links(table), "a", "b")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return table.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: that with the smallest doc_id, nulls last.

    Rows are chosen by row, not by id: a group whose rows have no id keeps one, and different
    texts that share an id stay if their groups differ. Among rows of one id, that with the
    least hash of all columns is taken; of equal rows one.
    """
    row = F.xxhash64(*docs.columns)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), row.alias("row"))
    table = materialize(picked.mapInArrow(_fingerprints, "doc_id long, fp long, row long"), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    classes = table.groupBy("fp").agg(F.min(least).alias("least"))
    roots = connected(links(table), "a", "b")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("least", F.coalesce("root", "fp").alias("root"))
    kept = named.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias("_id"), F.col("least.row").alias("_kept"))
    own = docs.withColumn("_row", row)
    same = (own["_row"] == kept["_kept"]) & own["doc_id"].cast("long").eqNullSafe(kept["_id"])
    return own.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_row"]).select(*docs.columns)
