"""Quality of candidates and of matches against known pairs (s1, cand)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: n_truth, n_found and recall (0.0 without truth). Repeated pairs count once."""
    found = pairs.select("s1", "cand").distinct().withColumn("hit", F.lit(1))
    joined = truth.select("s1", "cand").distinct().join(found, ["s1", "cand"], "left")
    total = joined.agg(F.count("*").alias("n_truth"), F.count("hit").alias("n_found"))
    return total.withColumn("recall", F.when(F.col("n_truth") == 0, 0.0).otherwise(F.col("n_found") / F.col("n_truth")))


def run_stats(records: DataFrame, stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: records (with src) on either side, ``index.index_stats``, pairs, pairs a record, reference records without any."""
    sides = records.agg(F.count_if(F.col("src") == 1).alias("n_reference"), F.count_if(F.col("src") > 1).alias("n_others"))
    found = pairs.agg(F.count("*").alias("n_pairs"), F.countDistinct("s1").alias("n_some"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sides, stats, found])
    rows = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    rows = rows.withColumn("n_empty", F.col("n_reference") - F.col("n_some")).drop("n_some")
    return rows.withColumn("pairs_per_record", F.when(F.col("n_reference") == 0, 0.0).otherwise(F.col("n_pairs") / F.col("n_reference")))


def reduction_ratio(reference: DataFrame, others: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: the share of all possible pairs that blocking spares."""
    parts = [reference.agg(F.count("*").alias("n1")), others.agg(F.count("*").alias("n23")), pairs.agg(F.count("*").alias("n_pairs"))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    every = F.col("n1") * F.col("n23")
    return rows.withColumn("reduction_ratio", F.when(every == 0, 0.0).otherwise(1 - F.col("n_pairs") / every))


def f05(reference: DataFrame, truth: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: n_s1 and f05_macro, the mean F0.5 over all reference records.

    A record without matches scores 1.0 if none is predicted, else 0.0; one with matches and
    no prediction 0.0.
    """
    true, said = truth.select("s1", "cand").distinct(), matches.select("s1", "cand").distinct()
    both = true.withColumn("t", F.lit(1)).join(said.withColumn("p", F.lit(1)), ["s1", "cand"], "full")
    counts = both.groupBy("s1").agg(F.count("t").alias("n_true"), F.count("p").alias("n_said"), F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("n_hit"))
    per = reference.select(F.col("entity_id").alias("s1")).join(counts, "s1", "left").na.fill(0)
    # F0.5 = 1.25 hits / (said + 0.25 true)
    score = F.when(F.col("n_true") == 0, F.when(F.col("n_said") == 0, 1.0).otherwise(0.0)).otherwise(1.25 * F.col("n_hit") / (F.col("n_said") + 0.25 * F.col("n_true")))
    return per.agg(F.count("*").alias("n_s1"), F.avg(score).alias("f05_macro"))
