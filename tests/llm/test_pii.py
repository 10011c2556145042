import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) for d in digits[::-1]]
    return sum(sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(values)) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), list(PLAIN).index(kind)))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_against_the_patterns(documents):
    for _, text in documents:
        assert pii.base_spans(text or "") == plain_spans(text or "")


@given(st.text(alphabet=st.sampled_from("a@.-+ 12()0459\n_%é"), max_size=50))
@settings(max_examples=1500, deadline=None)
def test_base_on_random_texts(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_luhn_runs():
    assert pii.base_spans("4111 1111 1111 1111 and 4111-1111-1111-1112") == [(0, 19, 2)]


def test_detect(frame, documents):
    got = {(r["doc_id"], tuple(tuple(x) for x in r["base"])) for r in pii.detect(frame).collect()}
    assert got == {(d, tuple((pii.KINDS[k], s, e) for s, e, k in plain_spans(t or ""))) for d, t in documents}


def test_crf_adds_what_patterns_miss():
    lines = {
        "you can write to sam dot lee": 0,
        "reach ann at mail dot com now": 1,
        "then call (416) 555-0192 at noon": 1,
        "room 17 4111 1111 1111 1111 was paid": None,
        "the 9913866557355101 is a number": 0,
        "version 2.0 of 12 items in 2024": 0,
        "ping 10 dot 44 dot 3 dot 41 now": 1,
        "the server 8[.]8[.]114[.]4 is up": 1,
        "host 300 dot 1 dot 1 dot 1 is down": 0,
    }
    for line, n in lines.items():
        base, spans = pii.find([line])[0]
        assert set(base) <= set(spans)
        if n is not None:
            assert len(spans) - len(base) == n, line


def test_held_out_accuracy():
    table = pii.training_table()
    tagger = pii.ShapeTagger().fit([x for i, x in enumerate(table) if i % 4])
    held = table[::4]
    good = sum(tagger.spans([line])[0] == [s for s in spans if pii.plausible(line[s[0] : s[1]], s[2])] for line, spans in held)
    assert good >= 0.9 * len(held)


def test_long_lines_and_runs():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "." * 50_000
    assert pii.find([text])[0] == ([], [])


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail bo@x.org or +1 (325) 555-8094.", 5), (2, None, 7), (3, "", 0)], "doc_id long, text string, n_chars long")
    rows = {r["doc_id"]: r for r in pii.mask_documents(docs).collect()}
    assert rows[1]["text"] == "mail [EMAIL] or [PHONE]." and rows[1]["n_chars"] == 24
    assert rows[2]["text"] is None and rows[2]["n_chars"] == 7 and rows[3]["text"] == ""
    assert pii.detect(docs, mask=True).where(F.col("doc_id") == 1).first()["masked"] == rows[1]["text"]


def test_empty(spark):
    assert pii.detect(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_spans_dont_depend_on_their_place_in_a_line():
    for span in ("(416) 555-0192", "ann at mail dot com"):
        line = f"call {span} today"
        found = [(line[s:e], k) for s, e, k in pii.find([line])[0][1]]
        assert len(found) == 1
        for n in (*range(248, 262), 509, 510, 511, 512, 1021):
            text = "the " * n + line + " the" * 300
            assert [(text[s:e], k) for s, e, k in pii.find([text])[0][1]] == found, n
