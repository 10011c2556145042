import pytest
from pyspark.sql import functions as F

from linkloom import config
from linkloom.functions import keys, text

SEP = config.SEPARATOR


def one(spark, value, make, column="text", dtype="string"):
    return spark.createDataFrame([(value,)], f"{column} {dtype}").select(make(F.col(column)).alias("x")).first()["x"]


def folded(spark, name=None, address=None):
    return text.with_folded(spark.createDataFrame([(name, address)], "business_name string, business_address string"))


@pytest.mark.parametrize(("given", "want"), [(None, ""), ("  --  Holloway   Peak, Inc.", "holloway peak inc"), ("Foo™ & Co.", "fooTM co"), ("A\x1cB c", "a b c"), ("राम‍क", "राम क")])
def test_clean(spark, given, want):
    assert folded(spark, given).select(text.clean(F.col("folded.name"))).first()[0] == want


@pytest.mark.parametrize(("given", "want"), [("Foo™ & Co.", "fooTM company"), ("A & B", "a b"), ("A and B", "a and b"), ("X LLP", "x limited liability partnership"), ("", "")])
def test_normalized_name(spark, given, want):
    assert folded(spark, given).select(text.normalized_name(F.col("folded.name"))).first()[0] == want


def test_normalized_address(spark):
    assert folded(spark, "", "12 Main St, Apt. No 4").select(text.normalized_address(F.col("folded.address"))).first()[0] == "12 main street apartment number 4"


def test_significant_tokens(spark):
    assert one(spark, "the abc of company xy", text.significant_tokens) == ["abc"]
    assert one(spark, "", text.significant_tokens) == []


@pytest.mark.parametrize(("given", "want"), [("Déntal", "Dental"), ("राम", "राम"), ("Å", "A"), ("plain", "plain"), ("é̂x", "ex"), ("й", "й"), (None, "")])
def test_strip_accents(spark, given, want):
    assert one(spark, given, text.strip_accents) == want


def test_fix_lookalike(spark):
    pairs = {"harb0r": "harbor", "at1antic": "atlantic", "c0mpany": "company", "l1c": "llc", "101a": "lola", "7eleven": "7eleven", "b2b": "b2b", "123": "123"}
    rows = spark.createDataFrame([(k,) for k in pairs], "t string").select("t", text.fix_lookalike(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == pairs


@pytest.mark.parametrize(("given", "want"), [("C0mpany L1C Foo", ["company", "foo"]), ("राम मार्केटिंग प्राइवेट लिमिटेड", ["राम", "मार्केटिंग"]), ("Foo Foo Bar", ["foo", "bar"]), (None, [])])
def test_name_block_tokens(spark, given, want):
    assert folded(spark, given).select(text.name_block_tokens(F.col("folded.name_plain"))).first()[0] == want


def test_address_token(spark):
    pairs = {"03807": "3807", "12b": "12", "000": "0", "1st": "1st", "12ab": "12ab"}
    rows = spark.createDataFrame([(k,) for k in pairs], "t string").select("t", text.address_token(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == pairs


@pytest.mark.parametrize(("given", "want"), [("TN, MEMPHIS, 03807 LAMAR AVE", [["tn"], ["memphis"], ["3807", "lamar", "avenue"]]), (", ,X", []), (None, [])])
def test_address_parts(spark, given, want):
    assert folded(spark, "", given).select(text.address_block_parts(F.col("folded.address_parts"))).first()[0] == want


def test_trigrams_and_jaccard(spark):
    assert one(spark, "ab", text.trigrams) == []
    assert sorted(one(spark, "ab cab", text.trigrams)) == ["abc", "bca", "cab"]
    frame = spark.createDataFrame([("abcd", "abce", "")], "a string, b string, c string")
    row = frame.select(*[text.jaccard(text.trigrams(F.col("a")), text.trigrams(F.col(c))).alias("j" + c) for c in "abc"]).first()
    assert (row["ja"], round(row["jb"], 6), row["jc"]) == (1.0, round(1 / 3, 6), 0.0)


def key_set(spark, name, address, country="US", **settings):
    frame = spark.createDataFrame([("r", name, address, country)], "id string, business_name string, business_address string, country string")
    rows = keys.record_keys(frame, "id", settings=config.BlockingConfig(**settings)).collect()
    assert len(rows) == len({r["key"] for r in rows})
    return {(r["key_type"], r["key"].removeprefix(f"{country or ''}{SEP}{r['key_type']}{SEP}")) for r in rows}


def test_all_keys(spark):
    assert key_set(spark, "Memorial Society LLC", "TN, MEMPHIS, 03807 LAMAR AVE") == {
        (1, "memorial"), (1, "society"), (2, "memorial|society"), (3, "memorialsociety"),
        (4, "3807|lamar"), (4, "3807|avenue"), (4, "avenue|lamar"), (4, "3807|tn"), (4, "3807|memphis"),
    }


def test_generic_pairs(spark):
    assert key_set(spark, "", "Rd 5, 5 St Rd") == {(4, "5|road"), (4, "5|street")}


def test_address_budget(spark):
    words = ["ka", "kb", "kc", "kd", "ke", "kf", "kg", "kh1", "ki", "kj", "kk", "kl"]
    found = {k for _, k in key_set(spark, "", " ".join(["7", *words, "99"]))}
    assert "7|kl" in found and "kk|kl" not in found and not any(k.startswith("99|") for k in found)


def test_concat_guard(spark):
    assert key_set(spark, "Ab Cde", "") == {(1, "cde")}
    assert key_set(spark, None, None, None) == set()


def test_disabled_types(spark):
    every = key_set(spark, "Memorial Society LLC", "12 Elm Rd")
    assert key_set(spark, "Memorial Society LLC", "12 Elm Rd", key_types=(2, 4)) == {k for k in every if k[0] in (2, 4)}


def test_part_order_does_not_matter(spark):
    assert key_set(spark, "", "12 Elm Road, Austin, TX") == key_set(spark, "", "TX, Austin, 12 Elm Road")
