"""Rules for result files: lists of ids, one row per reference record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.sources.storage import materialize

EXAMPLES = 5
ERROR, WARNING = "E", "W"


def split_rows(lines: DataFrame) -> DataFrame:
    """s1, ids, has_tab, line_no of the non-blank lines (value, line_no) behind the header."""
    parts = F.split("value", "\t", 2)
    has_tab = F.contains("value", F.lit("\t"))
    rest = F.when(has_tab, parts[1]).otherwise("")
    ids = F.when(~rest.rlike(r"\S"), F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return lines.where(has_tab | F.col("value").rlike(r"\S")).select(parts[0].alias("s1"), ids.alias("ids"), has_tab.alias("has_tab"), "line_no")


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where("has_tab")


def report(items: DataFrame, severity: str) -> DataFrame:
    """severity, rule, n, examples (the first five) of (rule, item) rows: no row for a rule that nothing breaks.

    Only five items of a task and rule are shuffled for the examples.
    """
    counts = items.groupBy("rule").agg(F.count("*").alias("n"))
    first = items.withColumn("no", F.row_number().over(Window.partitionBy("rule").orderBy("item"))).where(F.col("no") <= EXAMPLES)
    listed = first.groupBy("rule").agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("examples"))
    return counts.join(listed, "rule").select(F.lit(severity).alias("severity"), "rule", "n", "examples")


def _items(bad: DataFrame, item: Column, rule: str) -> DataFrame:
    return bad.select(F.lit(rule).alias("rule"), item.cast("string").alias("item"))


def _line(number: str) -> Column:
    return F.concat(F.lit("line "), F.lpad(F.col(number).cast("string"), 12, " "))


def malformed(rows: DataFrame) -> DataFrame:
    """Lines without a tab."""
    return rows.where("not has_tab").select("line_no")


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """s1, n of records with more than one row."""
    return good_rows(rows).groupBy("s1").agg(F.count("*").alias("n")).where("n > 1")


def repeated_ids(rows: DataFrame) -> DataFrame:
    """s1 with a list that holds an id twice."""
    return good_rows(rows).where(_repeats()).select("s1").distinct()


def _repeats() -> Column:
    return F.size("ids") != F.size(F.array_distinct("ids"))


def listed_ids(rows: DataFrame) -> DataFrame:
    return good_rows(rows).select("s1", F.explode("ids").alias("cand"))


def self_matches(rows: DataFrame) -> DataFrame:
    """The distinct listed ids of source 1."""
    return listed_ids(rows).where(F.startswith("cand", F.lit("S1-"))).select("cand").distinct()


def bad_prefixes(rows: DataFrame) -> DataFrame:
    """The distinct listed ids of no source."""
    right = reduce(lambda a, b: a | b, [F.startswith("cand", F.lit(p)) for p in ("S1-", "S2-", "S3-")])
    return listed_ids(rows).where(~right).select("cand").distinct()


def unknown_ids(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Well-prefixed ids that no source has."""
    well = F.startswith("cand", F.lit("S2-")) | F.startswith("cand", F.lit("S3-"))
    return listed_ids(rows).where(well).select("cand").distinct().join(known.select(F.col("entity_id").alias("cand")), "cand", "left_anti")


def missing(rows: DataFrame, required: DataFrame) -> DataFrame:
    """Reference records without a row."""
    return required.select(F.trim("entity_id").alias("s1")).distinct().join(good_rows(rows).select("s1"), "s1", "left_anti")


def extra(rows: DataFrame, required: DataFrame) -> DataFrame:
    """Rows of records that aren't asked for."""
    return good_rows(rows).select("s1").distinct().join(required.select(F.trim("entity_id").alias("s1")), "s1", "left_anti")


def last_rows(rows: DataFrame) -> DataFrame:
    """s1, ids: of rows with the same s1 the last counts."""
    return good_rows(rows).groupBy("s1").agg(F.max_by("ids", "line_no").alias("ids"))


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """s1 with a matched id that isn't among its candidates, by the last row of either file."""
    said, known = (last_rows(x).select("s1", F.explode("ids").alias("cand")) for x in (matches, candidates))
    return said.join(known, ["s1", "cand"], "left_anti").select("s1").distinct()


def header_problem(header: str | None, expected: tuple[str, str]) -> str | None:
    """What is wrong with a header line, if anything: empty, comma or header."""
    if header is None:
        return "empty"
    if "\t" not in header and "," in header:
        return "comma"
    return None if tuple(x.strip().lower() for x in header.split("\t")) == expected else "header"


def list_items(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """rule and item of all that is wrong with one file, in three passes: by row, by id and by record. Ids are checked if ``known`` is given."""
    fault = lambda rule, bad, item: F.when(bad, F.struct(F.lit(rule).alias("rule"), item.alias("item")))
    faults = F.array(fault("row_without_tab", ~F.col("has_tab"), _line("line_no")), fault("repeated_id", F.col("has_tab") & _repeats(), F.col("s1")))
    by_row = rows.select(F.inline(F.filter(faults, lambda x: x.isNotNull()))).distinct()
    starts = lambda p: F.startswith("cand", F.lit(p))
    ids = good_rows(rows).select(F.explode("ids").alias("cand")).distinct()
    kind = F.when(starts("S1-"), "self_match").when(~(starts("S2-") | starts("S3-")), "bad_prefix").otherwise("unknown_id")
    by_id = ids.select(kind.alias("rule"), F.col("cand").alias("item"))
    by_id = by_id.where("rule <> 'unknown_id'") if known is None else by_id.join(known.select(F.lit("unknown_id").alias("rule"), F.col("entity_id").alias("item")), ["rule", "item"], "left_anti")
    seen = good_rows(rows).groupBy("s1").agg(F.count("*").alias("n"))
    wanted = required.select(F.trim("entity_id").alias("s1")).distinct().withColumn("wanted", F.lit(True))
    faults = F.array(fault("duplicate_row", F.col("n") > 1, F.col("s1")), fault("missing_row", F.col("n").isNull(), F.col("s1")), fault("extra_row", F.col("wanted").isNull(), F.col("s1")))
    by_record = seen.join(wanted, "s1", "full").select(F.inline(F.filter(faults, lambda x: x.isNotNull())))
    return by_row.unionByName(by_id).unionByName(by_record)


def list_report(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The rules for one file, as severity, rule, n, examples."""
    return report(materialize(list_items(rows, required, known), "faults"), ERROR)


def encoding_report(lines: DataFrame) -> DataFrame:
    """Lines that aren't UTF-8."""
    return report(_items(lines.where(~F.is_valid_utf8("value")), _line("line_no"), "not_utf8"), ERROR)


def subset_report(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    return report(_items(not_candidates(matches, candidates), F.col("s1"), "match_not_candidate"), WARNING)
