import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from sentencepiece import sentencepiece_model_pb2 as proto

from linkloom.llm import queries, sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")


def changed(tmp_path, change):
    spec = proto.ModelProto()
    spec.ParseFromString(open(PATH, "rb").read())
    change(spec)
    path = str(tmp_path / "changed.model")
    open(path, "wb").write(spec.SerializeToString())
    return path


def test_ids_equal_the_library(frame, documents):
    own = library.SentencePieceProcessor(model_file=PATH)
    got = sentencepiece.decode(sentencepiece.encode(frame, PATH), PATH).collect()
    want = sorted((str(d), None if t is None else own.encode(t), t) for d, t in documents if t is not None)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in got if r["ids"] is not None) == want
    assert sum(r["ids"] is None for r in got) == sum(t is None for _, t in documents)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, ids int")
    assert sentencepiece.decode(sentencepiece.encode(none, PATH), PATH).collect() == []


def best_score(model, text):
    """The greatest sum of scores, over all pieces at each border."""
    best = [0.0] + [-1e18] * len(text)
    for i in range(1, len(text) + 1):
        for n in range(1, min(i, model.max_piece) + 1):
            score = model.scores.get(text[i - n : i], model.unknown_score if n == 1 else None)
            if score is not None:
                best[i] = max(best[i], best[i - n] + score)
    return best[-1]


def test_unigram_paths_are_best(tmp_path, documents):
    def change(spec):
        spec.trainer_spec.model_type = 1
        rng = random.Random(3)
        for p in spec.pieces:
            p.score = -rng.uniform(1, 12) if p.type == 1 else p.score

    path = changed(tmp_path, change)
    model = sentencepiece.Model(path)
    for _, text in documents[:60]:
        text = text[:3000]
        got = model.encode(text)
        assert model.decode(got) == text
        score = sum(model.scores.get(model.texts[c], model.unknown_score) for part in model.cut.findall("▁" + text.replace(" ", "▁")) for c in model.segment(part))
        assert score == pytest.approx(best_score(model, "▁" + text.replace(" ", "▁")), abs=1e-6)
        assert got == b"".join(model.raw[c] for c in model.segment("▁" + text.replace(" ", "▁")))


def test_pairs_against_whole_merging():
    model = sentencepiece.Model(PATH)
    rng = random.Random(8)
    some = [i for i in model.ids.values() if model.pieces[i].isascii() or i % 7 == 0]
    for _ in range(20_000):
        left, right = rng.choice([-1, *rng.choices(some, k=9)]), rng.choice(some)
        a, b = (model.texts[left] if left >= 0 else ""), model.texts[right]
        assert model.stays(left, right) == (model.merge(a + b) == ([a, b] if a else [b])), (a, b)


def test_window_is_bounded_and_commits():
    model = sentencepiece.Model(PATH)
    text = "abracadabra" * 400
    own = library.SentencePieceProcessor(model_file=PATH)
    out = model.segment("▁" + text)
    first = next(out)
    assert model.texts[first] and "".join(model.texts[c] for c in [first, *out]) == "▁" + text
    assert np.frombuffer(model.encode(text), "<u4").tolist() == own.encode(text)


def test_long_runs_without_borders():
    model, own = sentencepiece.Model(PATH), library.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(6)
    for letters in ("ab", "the quick", "éèa日本語 😀x", "0123456789abcdef", "=-_#"):
        for n in (15, 16, 17, 40, 65, 3000):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert np.frombuffer(model.encode(text), "<u4").tolist() == own.encode(text)


def test_small_cache_gives_the_same(documents):
    small, large = sentencepiece.Model(PATH, cache_size=10), sentencepiece.Model(PATH)
    for _, text in documents[:40]:
        if text:
            assert small.encode(text) == large.encode(text)


def test_models_with_other_rules_are_refused(tmp_path):
    def user(spec):
        spec.pieces[400].type = 4

    with pytest.raises(ValueError):
        sentencepiece.Model(changed(tmp_path, user))


def test_round_trip_in_one_worker(spark, frame):
    def rows(df):
        return sorted(((r["doc_id"], r["ids"], r["text"]) for r in df.collect()), key=str)

    def workers(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")

    got = sentencepiece.round_trip(frame, PATH)
    assert workers(got) == 1
    assert rows(got) == rows(sentencepiece.decode(sentencepiece.encode(frame, PATH), PATH))
    assert workers(queries.op5_sentencepiece(spark, "/root/testdata/sf0.001")) == 1
