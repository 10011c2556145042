import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkloom.llm import packing, token_counts
from linkloom.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
CACHED, PLAIN = WordEncoder(PATH, 50), Tokenizer.from_file(PATH)


def pieces_of(documents):
    own = Tokenizer.from_file(PATH)
    out = []
    for doc, text in documents:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            out.append((str(doc), piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out)


def check_layout(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_pieces_and_layout(frame, documents):
    rows = packing.pack_documents(frame, PATH).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces_of(documents)
    n = check_layout(rows)
    assert n <= packing.lower_bound(np.array([r["length"] for r in rows])) + 1


def test_exchange_closes_gaps(spark):
    rng = np.random.default_rng(2)
    lengths = np.minimum(2048, rng.lognormal(6.3, 0.8, 6000).astype(int) + 1)
    table = spark.createDataFrame([(int(i), int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(table, group=300).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(6000))
    n, bound = check_layout(rows), packing.lower_bound(lengths)
    assert n <= bound * 1.01 + 2
    apart = sum(len(packing.best_fit_decreasing(np.sort(part)[::-1])[2]) for part in np.array_split(lengths, 20))
    assert n < apart


def test_equal_rows_are_dealt_over_groups(spark):
    table = spark.createDataFrame([(1, 100)] * 4000 + [(2, 30)] * 500, "doc_id long, length long").repartition(3)
    rows = packing.pack(table, group=400).collect()
    assert sorted(r["doc_id"] for r in rows) == [1] * 4000 + [2] * 500
    assert check_layout(rows) <= 4000 * 100 // 2000 + 15 and max(r["group_bins"] for r in rows) < 60


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="word BPE"):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_kept_on_request(frame):
    row = packing.pack_documents(frame, PATH, keep_ids=True).where("doc_id = 100003").first()
    assert np.frombuffer(row["ids"], "<u4").tolist() == [*Tokenizer.from_file(PATH).encode("one", add_special_tokens=False).ids, 0]


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def smallest(lengths, capacity):
    """The least number of bins, by trying."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i]:
                go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=7))
@settings(max_examples=150, deadline=None)
def test_bound_never_exceeds_the_optimum(lengths):
    lengths = sorted(lengths, reverse=True)
    assert packing.lower_bound(np.array(lengths), 20) <= smallest(lengths, 20)
    bins, offsets, rooms = packing.best_fit_decreasing(np.array(lengths), 20)
    assert len(rooms) >= smallest(lengths, 20) and (rooms >= 0).all()


@given(st.text(alphabet=st.sampled_from("aAbé'sßÉ.,!?#0 9\n\t\r ́İſ<|endofx>"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_cached_encoder_equals_the_tokenizer(text):
    assert np.frombuffer(CACHED.encode(text), "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_token_counts(frame, documents):
    own = Tokenizer.from_file(PATH)
    lengths = [len(own.encode(t or "", add_special_tokens=False).ids) for _, t in documents]
    table = token_counts.length_histogram(token_counts.encoded_lengths(frame, PATH)).cache()
    rows = {r["n_tokens"]: r for r in table.collect()}
    assert rows.keys() == set(lengths)
    for n, r in rows.items():
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_over"] == sum(x > n for x in lengths)
        assert r["tokens_over"] == sum(x for x in lengths if x > n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert r["total_docs"] == len(lengths) and r["total_tokens"] == sum(lengths)
    one = token_counts.truncated_total(table, 77).first()
    assert (one["docs"], one["docs_cut"], one["tokens"]) == (len(lengths), sum(x > 77 for x in lengths), sum(min(x, 77) for x in lengths))
    ordered = sorted(lengths)
    assert token_counts.quantile(table, 0.5).first()["n_tokens"] == ordered[-(-len(ordered) // 2) - 1]


def test_token_counts_of_nothing(spark):
    empty = spark.createDataFrame([], "n_tokens long")
    assert token_counts.length_histogram(empty).collect() == []
    assert token_counts.truncated_total(token_counts.length_histogram(empty), 5).first()["tokens"] == 0


def test_ids_do_not_depend_on_the_cache(spark):
    rows = [(i, " ".join(f"word{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}, W{'x' * (j % 7)}." for j in range(60))) for i in range(40)] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen = [sorted(map(tuple, packing.token_pieces(table, PATH, cache=size).select("doc_id", "piece", "ids").collect())) for size in (5, 600_000)]
    want = sorted((i, 0, bytearray(np.array([*PLAIN.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, text in rows)
    assert [[(d, p, bytearray(x)) for d, p, x in own] for own in seen] == [want, want]
