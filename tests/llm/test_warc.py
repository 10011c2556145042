import base64
import gzip
import hashlib
import io
import random
from collections import defaultdict

import pytest

from linkloom.llm import warc

ROWS = [
    (1, "http://a/", "<p>one</p>", "x"), (2, "http://b/?q=1 2\r\n", "<p>one</p>", "x"), (3, None, None, "x"), (4, "", "", "x"), (5, "http://c/", "é€😀", "x"),
    (9, "u", "<p>one</p>", "x"), (7, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "x"), (None, "u", "<p>one</p>", "x"), (None, "u", "only here", "x"), (9, "u", "<p>one</p>", "x"),
]
SCHEMA = "page_id long, url string, html string, digest string"


def expected(rows, least=0):
    by = defaultdict(list)
    for page, _, html, _ in rows:
        by[html or ""].append(page)
    out = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        top = max((p for p in by[html or ""] if p is not None), default=None)
        revisit = len(raw) >= least and top is not None and page != top
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert got(warc.round_trip(spark, pages, least)) == expected(ROWS, least)


def test_payloads_of_many_copies(spark, monkeypatch):
    """A third of all pages are empty: their digest goes to all tasks, and no row of them through the join by digest."""
    monkeypatch.setattr(warc, "COPIES", 3)
    rows = ROWS + [(100 + i, f"http://x/{i}", None if i % 3 == 0 else f"page {i % 50}", "") for i in range(400)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(warc.round_trip(spark, pages)) == expected(rows)
    assert got(warc.round_trip(spark, pages, 5)) == expected(rows, 5)


def test_payloads_and_splits(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", "".join(rng.choice("abc <>é\n") for _ in range(rng.choice([0, 10, 4000, 90_000]))), "") for i in range(120)]
    manifest = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(2), f"file://{tmp_path}/w")
    for split in (1 << 10, 7_001, 1 << 24):
        read = warc.read(manifest, split)
        responses = {r["page_id"]: bytes(r["payload"]).decode() for r in read.collect() if r["record_type"] == "response"}
        assert all(responses[i] == html for i, _, html, _ in rows if i in responses)
        assert got(read) == expected(rows)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)


def test_members_are_owned_once():
    rng = random.Random(2)
    records = [warc.record(i, "u", bytes(rng.choices(b"\x1f\x8b\x08abc", k=rng.randrange(3000)))) for i in range(60)]
    blob = b"".join(gzip.compress(r, rng.choice([0, 6])) for r in records)
    for size in (50, 1000, 5000, len(blob)):
        found = [raw for low in range(0, len(blob), size) for _, raw in warc.members(io.BytesIO(blob), low, min(low + size, len(blob)))]
        assert found == records


def test_false_magic_and_damage():
    good = gzip.compress(warc.record(1, "u", b"x"))
    blob = b"\x1f\x8b\x08junk" + gzip.compress(b"not a record") + good + good[:20]
    assert len(list(warc.members(io.BytesIO(blob), 0, len(blob)))) == 1


def test_wrong_payload_is_refused():
    raw = warc.record(1, "u", b"payload").replace(b"payload\r\n", b"pay1oad\r\n")
    with pytest.raises(ValueError, match="doesn't match"):
        warc.parse(raw)


def test_empty(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).collect() == []
