import math
import random

import pytest
from pyspark.sql import functions as F

from linkloom.config import BlockingConfig
from linkloom.operators import candidates, diagnose, index, matching, metrics, validate
from linkloom.plans import blocking
from linkloom.sources import storage, tsv
from linkloom.sources.storage import materialize
from linkloom.streaming import lookup


def test_end_to_end(spark, source_files, tmp_path):
    pairs = blocking.generate_candidate_pairs(spark, source_files, str(tmp_path / "out"))
    got = {(r["s1"], r["cand"]) for r in pairs.collect()}
    assert got == {("S1-00001", "S2-00001"), ("S1-00001", "S3-00002"), ("S1-00002", "S2-00002"), ("S1-00003", "S2-00003"), ("S1-00004", "S3-00001")}


def test_candidate_file(spark, source_files, tmp_path):
    out = tmp_path / "c"
    blocking.generate_candidate_pairs(spark, source_files, str(out))
    parts = [p.read_text().splitlines() for p in out.glob("part-*")]
    assert all(p[0] == "source1_entity_id\tcandidate_entity_ids" for p in parts if p)
    lines = [x for p in parts for x in p[1:]]
    assert "S1-00005\t" in lines and "S1-00001\tS2-00001,S3-00002" in lines and len(lines) == 5


def test_reader_edges(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\na\t"Foo ""Bar"" Inc"\tx\tUS\nb\tJoe 12" Pizza\ty\tUS\nc\tshort\n\nd\tnull\tback\\slash\tUS\ne\tone two\tz\tUS\n', encoding="utf-8")
    rows = {r["entity_id"]: r for r in tsv.read_records(spark, str(path), 1).collect()}
    assert set(rows) == {"a", "b", "c", "d", "e"}
    assert rows["a"]["business_name"] == 'Foo "Bar" Inc' and rows["b"]["business_name"] == 'Joe 12" Pizza'
    assert rows["c"]["country"] == "" and rows["d"]["business_name"] == "null" and rows["e"]["business_name"] == "one two"


def test_empty_lists_and_last_row_wins(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nA\tx,y\nB\t\nA\tz\n")
    assert {tuple(r) for r in tsv.read_pairs(spark, str(path)).collect()} == {("A", "z")}


def hit_rows(spark):
    rows = [("a", "y", 10), ("a", "z", 290), ("a", "w", 301), ("a", "x", 500), ("b", "q", 1500), ("b", "r", 1600)]
    return spark.createDataFrame([(s, k, 1, c, 1.0) for s, k, c in rows], "s1 string, key string, key_type int, cnt long, weight double")


def test_fanout_budget(spark):
    kept = candidates.within_budget(hit_rows(spark), 300)
    assert {(r["s1"], r["key"]) for r in kept.collect()} == {("a", "y"), ("a", "z"), ("b", "q")}
    assert candidates.within_budget(hit_rows(spark), None).count() == 6


def test_cap_and_weights(spark):
    postings = spark.range(2000).select(F.lit("k").alias("key"), F.lit(1).alias("key_type"))
    more = spark.range(2001).select(F.lit("m").alias("key"), F.lit(1).alias("key_type"))
    few = spark.range(3).select(F.lit("n").alias("key"), F.lit(1).alias("key_type"))
    got = {r["key"]: r["weight"] for r in index.key_stats(postings.union(more).union(few)).collect()}
    assert got.keys() == {"k", "n"}
    assert math.isclose(got["k"], 0.693147, abs_tol=1e-6) and math.isclose(got["n"], 6.503789, abs_tol=1e-6)


def test_ties_are_ranked_by_source_and_id(spark):
    rows = spark.createDataFrame([("a", "S3-1", 3, 1.0), ("a", "S2-2", 2, 1.0), ("a", "S2-1", 2, 1.0 + 1e-9), ("a", "S3-0", 3, 2.0)], "s1 string, cand string, cand_src long, score double")
    assert [r["cand"] for r in candidates.ranked(rows, 3).orderBy("rank").collect()] == ["S3-0", "S2-1", "S2-2"]


@pytest.fixture(scope="module")
def random_records(spark):
    rng = random.Random(3)
    words = [f"w{chr(97 + i)}{chr(97 + j)}x" for i in range(6) for j in range(5)]
    rows = [(f"S{s}-{i}", s, " ".join(rng.choices(words, k=3)), f"{rng.randrange(20)} {rng.choice(words)} St", "US") for s in (1, 2, 3) for i in range(25)]
    return spark.createDataFrame(rows, "entity_id string, src long, business_name string, business_address string, country string").repartition(3).cache()


def pairs_of(records, **settings):
    found = candidates.candidates(records.where("src = 1"), records.where("src > 1"), BlockingConfig(**settings))
    return {(r["s1"], r["cand"]) for r in found.collect()}


def test_properties(random_records):
    small, large = pairs_of(random_records, top_n=3), pairs_of(random_records, top_n=9)
    assert small <= large <= pairs_of(random_records, top_n=None)
    free = {"top_n": None, "fanout_budget": None}
    assert pairs_of(random_records, bucket_cap=3, **free) <= pairs_of(random_records, bucket_cap=9, **free)
    assert pairs_of(random_records.orderBy(F.rand(1)), top_n=3) == small


def test_every_record_is_listed_once(random_records):
    listed = blocking.candidate_pairs(random_records, BlockingConfig(top_n=2))
    assert listed.count() == 25 and listed.select("s1").distinct().count() == 25


def test_plan(random_records):
    plan = blocking.candidate_pairs(random_records)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "WindowGroupLimit" in physical
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_lookup_ignores_the_budget(random_records):
    settings = BlockingConfig(fanout_budget=1, top_n=None)
    one = random_records.where("entity_id = 'S1-0'")
    others = random_records.where("src > 1")
    assert candidates.lookup(one, others, settings).count() >= candidates.candidates(one, others, settings).count()


def test_empty_sources(spark, random_records):
    nothing = random_records.limit(0)
    assert blocking.candidate_pairs(nothing).collect() == []
    only = blocking.candidate_pairs(random_records.where("src = 1")).collect()
    assert len(only) == 25 and all(r["candidate_ids"] == "" for r in only)
    stats = blocking.run_stats(nothing).first()
    assert stats["n_reference"] == 0 and stats["pairs_per_record"] == 0.0


def test_streaming_lookup(spark, random_records, tmp_path):
    reference, others = random_records.where("src = 1"), random_records.where("src > 1")
    lookup.write_index(others, str(tmp_path / "index"))
    want = {tuple(r) for r in candidates.candidates(reference, others).select("s1", "cand", "rank").collect()}
    reference.select("entity_id", "business_name", "business_address", "country").write.parquet(str(tmp_path / "new"))
    stream = spark.readStream.schema("entity_id string, business_name string, business_address string, country string").parquet(str(tmp_path / "new"))
    run = lookup.lookup_stream(stream, str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("s1", "cand", "rank").collect()} == want


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1 string, cand string")


def test_recall(spark):
    truth = pairs(spark, [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-1")])
    assert metrics.recall(truth, pairs(spark, [("S1-1", "S2-2")])).first()["recall"] == pytest.approx(1 / 3)
    assert metrics.recall(truth.limit(0), truth).first()["recall"] == 0.0


def test_f05(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    truth, said = pairs(spark, [("a", "x"), ("a", "y")]), pairs(spark, [("a", "x"), ("a", "y"), ("a", "z")])
    assert metrics.f05(ids("a"), truth, said).first()["f05_macro"] == pytest.approx(0.714, abs=1e-3)
    assert metrics.f05(ids("a", "b", "c"), truth, pairs(spark, [("c", "q")])).first()["f05_macro"] == pytest.approx(1 / 3)


def test_features(spark, random_records):
    both = spark.createDataFrame([("S1-0", "S1-0")], "s1 string, cand string")
    row = matching.features(both, random_records).first()
    assert row["name_jaccard"] == row["trigram_jaccard"] == row["name_edit"] == 1.0 and row["same_sound"]
    assert matching.tfidf_cosine(both, random_records).first()["cosine"] == pytest.approx(1.0)


def report(spark, tmp_path, matching_text, candidate_text=None, ids=None):
    paths = {}
    for name, content in (("matching", matching_text), ("candidate", candidate_text), ("required", "entity_id\tx\nS1-1\ta\nS1-2\tb\n"), ("known", ids)):
        if content is not None:
            paths[name] = str(tmp_path / f"{name}.tsv")
            (tmp_path / f"{name}.tsv").write_text(content)
    known = [paths["known"]] if ids else None
    rows = blocking.validation_report(spark, paths["matching"], paths["required"], paths.get("candidate"), known).collect()
    return {(r["severity"], r["rule"]): r["examples"] for r in rows}


HEAD = "source1_entity_id\tmatched_entity_ids\n"
QUIET = {("W", "candidate_file_absent"), ("W", "ids_not_checked")}


@pytest.mark.parametrize(
    ("content", "rules"),
    [
        (HEAD + "S1-1\tS2-1,S3-1\nS1-2\t\n", set()),
        (" Source1_Entity_ID \tMATCHED_ENTITY_IDS\nS1-1\t\n\nS1-2\t\n", set()),
        ("source1_entity_id,matched_entity_ids\nS1-1,\n", {("E", "matching_comma")}),
        ("a\tb\nS1-1\t\n", {("E", "matching_header")}),
        ("", {("E", "matching_empty")}),
        (HEAD + "S1-1\nS1-1\t\nS1-2\t\n", {("E", "matching_row_without_tab")}),
        (HEAD + "S1-1\t\nS1-1\t\nS1-2\t\n", {("E", "matching_duplicate_row")}),
        (HEAD + "S1-1\tS2-1,S2-1\nS1-2\t\n", {("E", "matching_repeated_id")}),
        (HEAD + "S1-1\tS1-2\nS1-2\t\n", {("E", "matching_self_match")}),
        (HEAD + "S1-1\tS2-1,\nS1-2\t\n", {("E", "matching_bad_prefix")}),
        (HEAD + "S1-1\tS2-1, S3-1\nS1-2\t\n", {("E", "matching_bad_prefix")}),
        (HEAD + "S1-1\t\n", {("E", "matching_missing_row")}),
        (HEAD + "S1-1\t\nS1-2\t\nS1-9\t\n", {("E", "matching_extra_row")}),
    ],
)
def test_validation_rules(spark, tmp_path, content, rules):
    assert set(report(spark, tmp_path, content)) - QUIET == rules


def test_validation_of_ids_and_subsets(spark, tmp_path):
    content = HEAD + "S1-1\tS2-1,S2-99999\nS1-2\t\n"
    found = report(spark, tmp_path, content, "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n", "entity_id\tx\nS2-1\ta\n")
    assert found == {("E", "matching_unknown_id"): "S2-99999", ("W", "match_not_candidate"): "S1-1"}


def test_line_numbers(spark, tmp_path):
    (tmp_path / "x.txt").write_text("".join(f"line {i}\n" for i in range(1, 2001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        rows = tsv.read_lines(spark, str(tmp_path / "x.txt")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2000 and all(r["value"] == f"line {r['line_no']}" for r in rows)


def test_ids_count_once_and_the_last_row_counts(spark):
    lines = [("S1-1\tX-1,S1-5", 2), ("S1-2\tX-1,S1-5,S2-9", 3), ("S1-2\tS2-1", 4), ("S1-3\tS2-1", 5), ("S1-3\t", 6)]
    rows = validate.split_rows(spark.createDataFrame(lines, "value string, line_no long"))
    assert [tuple(r) for r in validate.bad_prefixes(rows).collect()] == [("X-1",)]
    assert [tuple(r) for r in validate.self_matches(rows).collect()] == [("S1-5",)]
    known = validate.split_rows(spark.createDataFrame([("S1-1\tX-1,S1-5", 2), ("S1-2\tS2-1", 3)], "value string, line_no long"))
    assert validate.not_candidates(rows, known).collect() == []
    assert sorted(r["s1"] for r in validate.not_candidates(known, rows).collect()) == []


def test_hot_keys_go_before_any_shuffle(spark, random_records):
    counts = spark.createDataFrame([("a", 1, 5), ("b", 1, 2000), ("c", 1, 2001), ("d", 1, 90_000)], "key string, key_type int, cnt long")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), ("d", 5)], "key string, cand int")
    for most in (10, 1):
        kept = index.without_hot(rows, counts, most=most)
        assert sorted(r["cand"] for r in kept.collect()) == [1, 2]
    assert "SortMergeJoin" not in kept_plan(index.without_hot(rows, counts))
    tight = BlockingConfig(bucket_cap=4, top_n=None)
    found = candidates.Blocking(random_records.where("src = 1"), random_records.where("src > 1"), tight)
    whole = candidates.ranked(candidates.scored(candidates.expand(found.kept, found.postings)), None)
    assert found.usable_postings.count() < found.postings.count()
    assert sorted(map(tuple, found.ranked.collect())) == sorted(map(tuple, whole.collect()))


def kept_plan(frame):
    plan = frame._jdf.queryExecution().toString()
    return plan[plan.index("== Physical Plan ==") :]


def test_scans(spark, random_records):
    """Keys are extracted once a side, whatever is asked of a run."""
    run = candidates.Blocking(random_records.where("src = 1"), random_records.where("src > 1"))
    truth = random_records.where("src = 1").selectExpr("entity_id as s1", "replace(entity_id, 'S1', 'S2') as cand")
    known = diagnose.missed_pairs(truth, run.pairs, materialize(diagnose.described(random_records), "info"))
    assert kept_plan(known).count("FileScan") <= 4 and "Arrow" not in kept_plan(known)
    stats = blocking.run_stats(random_records)
    assert kept_plan(stats).count("FileScan") <= 4 and "ArrowEvalPython" not in kept_plan(stats)
    assert kept_plan(run.ranked).count("FileScan") <= 5 and "ArrowEvalPython" not in kept_plan(run.ranked)


def test_own_files_alone_are_released(spark):
    table = materialize(spark.range(3), "t")
    other = storage.shared_dir(spark) + "/linkloom/other"
    spark.range(2).write.mode("overwrite").parquet(other)
    assert table.count() == 3
    path = storage.run_dir(spark)
    storage.release(spark)
    assert storage.run_dir(spark) != path and spark.read.parquet(other).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)


def test_bad_prefix_rule(spark):
    rows = validate.split_rows(spark.createDataFrame([("S1-1\tX-1,S2-1", 2)], "value string, line_no long"))
    assert [r["cand"] for r in validate.bad_prefixes(rows).collect()] == ["X-1"]


def test_missing_files_and_encoding(spark, tmp_path):
    good = tmp_path / "good.tsv"
    good.write_text("entity_id\tx\nS1-1\ta\n")
    bad = tmp_path / "bad.tsv"
    bad.write_bytes(HEAD.encode() + b"S1-1\tS2-\xff\n")
    rules = lambda *a: {(r["severity"], r["rule"]) for r in blocking.validation_report(spark, *a).collect()}
    assert rules(str(good), str(tmp_path / "none")) == {("E", "required_file_missing")}
    assert rules(str(tmp_path / "none"), str(good), str(tmp_path / "none"), [str(good), str(tmp_path / "gone")]) == {("W", "candidate_file_absent"), ("E", "matching_file_missing"), ("W", "id_file_absent")}
    assert rules(str(bad), str(good)) == QUIET | {("E", "matching_not_utf8")}


def test_classifier(spark, random_records):
    ids = [f"S1-{i}" for i in range(12)]
    both = spark.createDataFrame([(a, b) for a in ids for b in ids], "s1 string, cand string")
    truth = spark.createDataFrame([(a, a) for a in ids], "s1 string, cand string")
    featured = matching.features(both, random_records).cache()
    scored = matching.classify(featured, matching.fit_classifier(featured, truth)).cache()
    sweep = matching.threshold_sweep(scored, truth).orderBy("threshold").collect()
    assert len(sweep) == 20 and sweep[0]["n_said"] == 144 and sweep[0]["recall"] == 1.0
    assert max(r["f05"] for r in sweep) > 0.9
