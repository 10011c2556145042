"""Quality rules: fixed document counts, and a line CRF whose content share decides retention.

The CRF's sequence is a document's lines (\\n-split lines that hold a word). It is fitted on the
executors' line features of a bounded sample of labelled documents: per label the
``SAMPLE`` documents first in the order of a hash of their id, of at most ``SAMPLE_CHARS``
characters. Lines of a good document are content unless they repeat an earlier line of it;
lines of a bad one are boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.crf import LinearChainCRF

SAMPLE = 800
SAMPLE_CHARS = 20_000
CONTENT_SHARE = 0.5
WINDOW = 8
CONTENT, BOILERPLATE = 0, 1

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
#: The bytes of a code point behind its first.
_INNER = bytes(range(128, 192))
#: Upper edges of the buckets of each line feature.
_EDGES = [
    [1, 2, 4, 8, 16, 32, 64],  # words
    [0.0, 0.05, 0.2, 0.5, 1.0, 2.0],  # symbols a word
    [0.0, 0.02, 0.05, 0.1, 0.3, 0.6],  # capitals among ASCII letters
    [0.2, 0.4, 0.6, 0.8, 0.99],  # distinct words
    [0.0, 0.05, 0.2, 0.5, 1.0],  # exclamation and question marks a word
    [2.0, 3.5, 5.0, 7.0, 10.0],  # bytes a word
    [0.0, 0.05, 0.2, 0.5],  # digits among bytes
    [0.5],  # repeats an earlier line
]
_BASE = np.cumsum([1] + [len(e) + 1 for e in _EDGES])
N_FEATURES = int(_BASE[-1])


def _lines(text: bytes) -> tuple[list[list[bytes]], np.ndarray, int]:
    """Words by line (lines with a word), measures [lines, features], number of repeated lines."""
    words, rows, seen, repeated = [], [], set(), 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        again = line in seen
        seen.add(line)
        repeated += again
        n, size = len(own), sum(map(len, own))
        upper, lower = len(line) - len(line.translate(None, _UPPER)), len(line) - len(line.translate(None, _LOWER))
        rows.append((
            n,
            (len(line) - len(line.translate(None, _SYMBOLS))) / n,
            upper / max(1, upper + lower),
            len(set(own)) / n,
            (len(line) - len(line.translate(None, _MARKS))) / n,
            size / n,
            (len(line) - len(line.translate(None, _DIGITS))) / size,
            again,
        ))
        words.append(own)
    return words, np.array(rows, float).reshape(-1, len(_EDGES)), repeated


def _features(measures: np.ndarray) -> np.ndarray:
    return np.stack([base + np.searchsorted(edges, measures[:, i], side="left") for i, (base, edges) in enumerate(zip(_BASE, _EDGES, strict=False))], axis=1)


def repeated_words(ids: np.ndarray, docs: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Words of each document that lie in a ``window``-word sequence found twice or more in it.

    ids: the words of all documents end to end as non-negative numbers; docs: the document of
    each. Ranks of windows of 1, 2, 4, 8 words are paired by sorting, so no hash can collide.
    """
    n = len(ids)
    if n < window:
        return np.zeros(n_docs, np.int64)
    rank = np.unique(docs * (int(ids.max()) + 1) + ids, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < window:
        rank = np.unique(rank[:-width] * (n + 1) + rank[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2
    inside = docs[: len(rank)] == docs[window - 1 :]
    again = (np.bincount(rank[inside], minlength=len(rank))[rank] > 1) & inside
    steps = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return np.bincount(docs[np.cumsum(steps[:-1]) > 0], minlength=n_docs)


def measure(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts by name, line features of all documents, lines by document, words by line."""
    ids, sizes, feats, per_doc, per_line = [], [], [], [], []
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    for i, text in enumerate(texts):
        words, measures, out["n_dup_lines"][i] = _lines(text)
        flat = [w for line in words for w in line]
        known: dict[bytes, int] = {}
        ids.append(np.fromiter((known.setdefault(w, len(known)) for w in flat), np.int64, len(flat)))
        sizes.append(len(flat))
        out["word_chars"][i] = len(b"".join(flat).translate(None, _INNER))
        out["n_symbols"][i] = len(text) - len(text.translate(None, _SYMBOLS))
        feats.append(measures)
        per_doc.append(len(words))
        per_line += [len(line) for line in words]
    out["n_words"] = np.array(sizes, np.int64)
    if n:
        docs = np.repeat(np.arange(n), out["n_words"])
        out["n_repeat_words"] = repeated_words(np.concatenate(ids), docs, n)
    every = np.concatenate(feats) if feats else np.zeros((0, len(_EDGES)))
    return out, _features(every), np.array(per_doc, np.int64), np.array(per_line, np.int64)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for quality, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            measures = _lines(text or b"")[1]
            yield pa.RecordBatch.from_arrays([pa.array([quality], pa.int32()), pa.array([_features(measures).astype(np.int16).ravel().tolist()], pa.list_(pa.int16()))], ["quality", "feats"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LinearChainCRF:
    """The line CRF; without labelled documents of both kinds its weights are zero and all lines are content."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.char_length("text").between(1, SAMPLE_CHARS))
    texts = texts.select("doc_id", F.col("text").cast("binary").alias("text"))
    known = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    picked = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample) for q in (0, 1)]
    few = picked[0].unionByName(picked[1])
    found = texts.join(F.broadcast(few), "doc_id").select("quality", "text").mapInArrow(_sampled, "quality int, feats array<smallint>")
    rows = sorted(((r["quality"], tuple(r["feats"])) for r in found.collect()), key=lambda r: hash(r[1]))
    model = LinearChainCRF(N_FEATURES, 2)
    train = []
    for quality in (0, 1):
        for _, flat in [r for r in rows if r[0] == quality][:sample]:
            x = np.array(flat, np.int64).reshape(-1, len(_EDGES))
            y = np.full(len(x), BOILERPLATE) if quality == 0 else np.where(x[:, -1] > _BASE[len(_EDGES) - 1], BOILERPLATE, CONTENT)
            train.append((x, y))
    return model.fit(train) if {r[0] for r in rows} == {0, 1} else model


def _verdicts(texts: list[bytes | None], model: LinearChainCRF) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts by name, base_failed, kept and content_share of each text."""
    counts, feats, per_doc, per_line = measure([x or b"" for x in texts])
    marked = model.viterbi(feats, per_doc)
    content = np.bincount(np.repeat(np.arange(len(texts)), per_doc), per_line * (marked == CONTENT), len(texts))
    share = content / np.maximum(1, counts["n_words"])
    failed = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
    return counts, failed, ~failed & (share >= CONTENT_SHARE), share


def judge(docs: DataFrame, model: LinearChainCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share.

    content_share: words in lines marked content among all words (0.0 without words). kept:
    not base_failed, and a share of at least ``CONTENT_SHARE``. A null text counts as empty:
    base_failed, not kept. Repeated rows give repeated rows; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = f"doc_id long, {', '.join(f'{n} long' for n in names)}, base_failed boolean, kept boolean, content_share double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                counts, failed, kept, share = _verdicts(batch.column(1).to_pylist(), model)
                columns = [batch.column(0), *[pa.array(counts[n]) for n in names], pa.array(failed), pa.array(kept), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "kept", "content_share"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, schema)


def keep(docs: DataFrame, model: LinearChainCRF) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is kept (see ``judge``): one pass, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index("text")
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                texts = [x if x is None else x.encode() for x in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(_verdicts(texts, model)[2]))

    return docs.mapInArrow(run, docs.schema)
