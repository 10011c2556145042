import itertools
import re
from collections import Counter

import numpy as np
import pytest

from linkloom.llm import quality
from linkloom.llm.crf import LinearChainCRF


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), n < 20 or 100 * len(inside) > 30 * n


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.01"
    return quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def test_base_counts(frame, documents, model):
    rows = quality.judge(frame, model).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == sorted((str(d), *base_counts(t)) for d, t in documents)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_repeated_words_across_documents():
    ids = np.array([*range(10), *range(10), *range(5), *range(10)])
    docs = np.array([0] * 10 + [1] * 15 + [2] * 10)
    assert quality.repeated_words(ids, docs, 3).tolist() == [0, 0, 0]
    twice = np.array([*range(10), *range(10)])
    assert quality.repeated_words(twice, np.zeros(20, np.int64), 1).tolist() == [20]


def test_held_out_accuracy(spark, model):
    """The model of one table on the labelled documents of another."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.judge(docs, model).join(labels, "doc_id").where("not base_failed").select("kept", "quality").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_without_labels_everything_is_content(spark, frame):
    model = quality.fit(frame, spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int"))
    rows = quality.judge(frame, model).collect()
    assert all(r["kept"] != r["base_failed"] for r in rows)


def test_empty(spark, model):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def best_path(crf, feats):
    k = len(crf.start)

    def score(path):
        e = sum(crf.w[f, y] for row, y in zip(feats, path, strict=True) for f in row)
        return crf.start[path[0]] + e + sum(crf.trans[a, b] for a, b in itertools.pairwise(path)) + crf.stop[path[-1]]

    return max(itertools.product(range(k), repeat=len(feats)), key=score)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    crf = LinearChainCRF(6, 3)
    crf.w, crf.trans, crf.start, crf.stop = rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), rng.normal(size=3)
    sizes = [3, 0, 1, 6, 2, 6]
    feats = rng.integers(0, 6, (sum(sizes), 2))
    got, at = crf.viterbi(feats, np.array(sizes)), 0
    for n in sizes:
        if n:
            assert tuple(got[at : at + n]) == best_path(crf, feats[at : at + n])
        at += n


def test_fit_learns_transitions():
    rng = np.random.default_rng(1)
    sequences = []
    for _ in range(60):
        y = np.cumsum(rng.random(12) < 0.2) % 2
        x = np.where(rng.random(12) < 0.8, y + 1, rng.integers(1, 3, 12))[:, None]
        sequences.append((x, y))
    crf = LinearChainCRF(3, 2).fit(sequences[:40])
    held = sequences[40:]
    got = crf.viterbi(np.concatenate([x for x, _ in held]), np.array([12] * 20))
    assert (got == np.concatenate([y for _, y in held])).mean() > 0.85
