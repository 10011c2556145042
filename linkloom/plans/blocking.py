"""Whole runs: sources to candidate file, and validation of result files."""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import config
from linkloom.config import BlockingConfig
from linkloom.operators import candidates, index, metrics, validate
from linkloom.sources import tsv
from linkloom.sources.storage import materialize


def blocking(records: DataFrame, settings: BlockingConfig = config.DEFAULT) -> candidates.Blocking:
    """The run over ``records`` (with src): source 1 is the reference."""
    return candidates.Blocking(records.where("src = 1"), records.where("src > 1"), settings)


def candidate_pairs(records: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """s1, candidate_ids, n_candidates for every record of source 1 in ``records`` (with src)."""
    run = blocking(records, settings)
    return candidates.listed(run.reference, run.ranked)


def run_stats(records: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    run = blocking(records, settings)
    return metrics.run_stats(records, index.index_stats(run.counts, run.asked, settings), run.pairs)


def generate_candidate_pairs(spark: SparkSession, paths: dict[int, str], out: str, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """Read the source files, write the candidate file and return its rows as written."""
    tsv.write_pairs(candidate_pairs(tsv.read_sources(spark, paths), settings), out)
    return tsv.read_pairs(spark, out, "candidate_entity_ids")


def validation_report(spark: SparkSession, matching: str, required: str, candidate: str | None = None, known: list[str] | None = None) -> DataFrame:
    """severity, rule, n, examples for the result files: no row of severity E means they pass.

    A missing list of required records ends the check. Ids are held against the files of
    ``known``, and not at all if one of them is absent. An absent candidate file is a warning.
    """
    if not _exists(spark, required):
        return _note(spark, validate.ERROR, "required_file_missing")
    wanted, ids = tsv.read_ids(spark, required), None
    parts = []
    if not known:
        parts.append(_note(spark, validate.WARNING, "ids_not_checked"))
    elif not all(_exists(spark, path) for path in known):
        parts.append(_note(spark, validate.WARNING, "id_file_absent"))
    else:
        ids = reduce(DataFrame.unionByName, [tsv.read_ids(spark, path) for path in known])
    tables = {}
    for name, path, column in (("matching", matching, "matched_entity_ids"), ("candidate", candidate, "candidate_entity_ids")):
        if path is None or not _exists(spark, path):
            optional = name == "candidate"
            parts.append(_note(spark, validate.WARNING if optional else validate.ERROR, f"{name}_file_{'absent' if optional else 'missing'}"))
            continue
        lines = materialize(tsv.read_lines(spark, path), "lines")
        parts.append(validate.encoding_report(lines).withColumn("rule", F.concat(F.lit(f"{name}_"), "rule")))
        header = lines.where("line_no = 1").first()
        problem = validate.header_problem(header["value"] if header else None, ("source1_entity_id", column))
        if problem:
            parts.append(_note(spark, validate.ERROR, f"{name}_{problem}"))
            continue
        tables[name] = materialize(validate.split_rows(lines.where("line_no > 1")), "rows")
        parts.append(validate.list_report(tables[name], wanted, ids).withColumn("rule", F.concat(F.lit(f"{name}_"), "rule")))
    if len(tables) == 2:
        parts.append(validate.subset_report(tables["matching"], tables["candidate"]))
    parts.append(_note(spark, validate.ERROR, "none").limit(0))
    return reduce(DataFrame.unionByName, parts)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _note(spark: SparkSession, severity: str, rule: str) -> DataFrame:
    return spark.range(1).select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.col("id").alias("n"), F.lit("").alias("examples"))


def main(args: list[str] | None = None) -> int:
    """Command line: ``block`` writes candidates (and prints recall if truth is given), ``validate`` checks files."""
    parser = argparse.ArgumentParser(prog="linkloom")
    kinds = parser.add_subparsers(dest="kind", required=True)
    block = kinds.add_parser("block")
    block.add_argument("sources", nargs=3)
    block.add_argument("--out", default="output/candidate_pairs")
    block.add_argument("--truth")
    check = kinds.add_parser("validate")
    check.add_argument("--matching", "-m", required=True)
    check.add_argument("--candidate", "-c")
    check.add_argument("--source1", required=True)
    check.add_argument("--check-ids", nargs="*")
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if given.kind == "block":
        pairs = generate_candidate_pairs(spark, dict(enumerate(given.sources, 1)), given.out)
        if given.truth:
            metrics.recall(tsv.read_pairs(spark, given.truth), pairs).show()
        return 0
    report = validation_report(spark, given.matching, given.source1, given.candidate, given.check_ids).orderBy(F.desc("severity"), "rule")
    report.show(100, False)
    failed = not report.where("severity = 'E'").isEmpty()
    print("FAIL" if failed else "PASS")
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
