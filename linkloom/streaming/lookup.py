"""Candidates for new reference records as they arrive, against a stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from linkloom import config
from linkloom.config import BlockingConfig
from linkloom.operators import candidates, index


def write_index(others: DataFrame, path: str, settings: BlockingConfig = config.DEFAULT) -> None:
    """Store the postings of the usable keys with their weights."""
    postings = candidates.index_postings(others, settings)
    stats = index.key_stats(postings, settings)
    postings.join(stats.select("key", "cnt", "weight"), "key").write.mode("overwrite").parquet(path)


def lookup_batch(spark: SparkSession, records: DataFrame, path: str, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """s1, cand, cand_src, score, n_keys, rank for a batch of records."""
    stored = spark.read.parquet(path)
    stats = stored.select("key", "key_type", "cnt", "weight").distinct()
    found = candidates.within_budget(candidates.hits(candidates.query_postings(records, settings), stats), settings.fanout_budget)
    return candidates.ranked(candidates.scored(candidates.expand(found, stored)), settings.top_n)


def lookup_stream(records: DataFrame, index_path: str, out: str, checkpoint: str, settings: BlockingConfig = config.DEFAULT) -> DataStreamWriter:
    """A writer that, for each micro-batch of a stream of records, writes its candidates.

    A batch that is run again overwrites its own folder, so results are written once.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        pairs = lookup_batch(batch.sparkSession, batch, index_path, settings)
        pairs.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return records.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
