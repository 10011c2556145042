"""The inverted index as two tables: key statistics and postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import config
from linkloom.config import BlockingConfig

#: Keys over the cap that are broadcast at most: 8 MB of hashes.
HOT_KEYS = 1_000_000


def bucket_counts(postings: DataFrame) -> DataFrame:
    """key, key_type, cnt: the records of each key. Partial counts absorb hot keys before the shuffle."""
    return postings.groupBy("key", "key_type").agg(F.count("*").alias("cnt"))


def weight(settings: BlockingConfig = config.DEFAULT) -> Column:
    """The rarity weight of a key, times that of its type; the cap is the numerator."""
    kind = F.lit(1.0)
    for key_type, value in settings.weights.items():
        if value != 1.0:
            kind = F.when(F.col("key_type") == key_type, value).otherwise(kind)
    return F.log1p(F.lit(float(settings.bucket_cap)) / F.col("cnt")) * kind


def usable(counts: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """key, key_type, cnt, weight of the keys that the cap leaves (cnt at most the cap)."""
    return counts.where(F.col("cnt") <= settings.bucket_cap).withColumn("weight", weight(settings))


def key_stats(postings: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    return usable(bucket_counts(postings), settings)


def without_hot(rows: DataFrame, counts: DataFrame, settings: BlockingConfig = config.DEFAULT, most: int = HOT_KEYS) -> DataFrame:
    """``rows`` without those of keys over the cap, before any shuffle by key.

    Keys over the cap are few: each takes more than ``bucket_cap`` postings. Up to ``most`` of
    them are sent to every executor as 8-byte hashes; a hash shared with a usable key would
    drop that one, so such keys are taken out of the set. If there are more, the anti join
    shuffles, and adaptive execution splits the hot partitions.
    """
    over = F.col("cnt") > settings.bucket_cap
    hot = counts.where(over)
    n = hot.limit(most + 1).count()
    if not n:
        return rows
    if n > most:
        return rows.join(hot.select("key"), "key", "left_anti")
    hashes = F.broadcast(hot.select(F.xxhash64("key").alias("_hash")).distinct())
    shared = counts.where(~over).withColumn("_hash", F.xxhash64("key")).join(hashes, "_hash", "left_semi").select("_hash").distinct()
    hashes = F.broadcast(hashes.join(F.broadcast(shared), "_hash", "left_anti"))
    return rows.withColumn("_hash", F.xxhash64("key")).join(hashes, "_hash", "left_anti").drop("_hash")


def prune(stats: DataFrame, query_postings: DataFrame) -> DataFrame:
    """The statistics of keys that some query record has."""
    return stats.join(query_postings.select("key").distinct(), "key", "left_semi")


def index_stats(counts: DataFrame, query_postings: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """One row from ``bucket_counts``: n_postings, n_keys, n_dropped (over the cap) and n_usable (under it, and asked for)."""
    asked = query_postings.select("key", F.lit(True).alias("asked")).distinct()
    small = F.col("cnt") <= settings.bucket_cap
    joined = counts.join(asked, "key", "left")
    return joined.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n_postings"), F.count("*").alias("n_keys"), F.count_if(~small).alias("n_dropped"), F.count_if(small & F.coalesce("asked", F.lit(False))).alias("n_usable"))
