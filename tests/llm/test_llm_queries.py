"""The registered queries: their columns and digests, made again in plain Python from the tables."""

import base64
import glob
import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece as library
import xxhash
from tokenizers import Tokenizer

from linkloom.llm import pii, queries, quality, substring

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def test_op1(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    got = rows_of(spark, "op1_projected_neighbours")
    asked = sorted(i for i in rows if i % 100 == 0)
    assert sorted({r["query_id"] for r in got}) == asked
    hits = 0
    for q in asked:
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [n for n, _, _ in own] == list(range(1, 11)) and [s for _, _, s in own] == sorted(s for _, _, s in own)
        assert all(s == pytest.approx(math.dist(rows[q], rows[i]), rel=1e-12) for _, i, s in own)
        near = sorted((math.dist(rows[q], v), i) for i, v in rows.items() if i != q)[:10]
        hits += len({i for _, i in near} & {i for _, i, _ in own})
    assert hits >= 0.95 * 10 * len(asked)


def test_op2(spark):
    turns = Counter(r["conv_id"] for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect())
    got = rows_of(spark, "op2_role_repair")
    told = Counter()
    for r in got:
        told[r["conv_id"]] += r["n_turns"]
    assert told == turns and all(r["rendered"].startswith("<|im_start|>") for r in got if (r["part"], r["sub"]) == (0, 0))


def test_op3(spark, texts):
    found = dict(zip(texts, pii.find(list(texts.values())), strict=True))
    joined = lambda spans: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in spans)
    got = rows_of(spark, "op3_crf_personal_data")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base, spans = found[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest() and r["spans"] == joined(spans)
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for _, _, k in base) for i in range(4)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda x: (x[0], x[2]))


def test_op4(spark, texts):
    own, sequences = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    got = rows_of(spark, "op4_best_fit_packing")
    want = []
    for doc, text in texts.items():
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want += [(doc, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        spans.sort()
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 2048
    assert len(sequences) <= 1.01 * sum(w[3] for w in want) / 2048 + 2


def test_op5(spark, texts):
    own = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: (r["n_ids"], r["ids_crc32"], r["text_sha256"]) for r in rows_of(spark, "op5_sentencepiece")}
    ids = {d: np.array(own.encode(t), "<u4") for d, t in texts.items()}
    assert got == {d: (len(ids[d]), zlib.crc32(ids[d].tobytes()), hashlib.sha256(t.encode()).hexdigest()) for d, t in texts.items()}


def test_op6(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    top = {}
    for page, raw in sorted(pages.items()):
        top[raw] = page
    want = {p: (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if top[raw] == p else "revisit", None if top[raw] == p else top[raw]) for p, raw in pages.items()}
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows_of(spark, "op6_warc")} == want
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    sql = connection.sql(queries.ORACLES["op6_warc"] + " order by page_id").project("page_id, payload_bytes, payload_digest, record_type, refers_to").fetchall()
    assert {r[0]: tuple(r[1:]) for r in sql} == want


def test_op7(spark, texts):
    space = regex.compile("[^\\x20\\x09-\\x0D]+")
    got = rows_of(spark, "op7_quality_rules")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        text = texts[r["doc_id"]]
        words = space.findall(text)
        lines = [x for x in text.split("\n") if space.search(x)]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (not r["base_failed"] and r["content_share"] >= quality.CONTENT_SHARE)


def test_op8(spark, texts):
    for r in rows_of(spark, "op8_substring_dedup"):
        own, other = texts[r["doc_id"]], texts[r["match_doc_id"]].lower().split()
        words = own[r["start"] : r["end"]].lower().split()
        assert r["match_doc_id"] < r["doc_id"] and len(words) == r["end_word"] - r["start_word"] >= substring.MIN_WORDS
        assert r["similarity"] >= 0.8 and len(set(words) & set(other)) >= 0.5 * len(set(words))


def test_op9(spark, texts):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter(len(own.encode(t, add_special_tokens=False).ids) for t in texts.values())
    assert {r["n_tokens"]: r["n_docs"] for r in rows_of(spark, "op9_token_counts")} == lengths


def test_op10(spark, texts):
    space = regex.compile(rb"[^\x20\x09-\x0D]+")

    def fingerprint(text):
        words = space.findall(text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {d: fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op10_simhash")} == {d: (f"{p:016x}", find(d)) for d, p in prints.items()}
