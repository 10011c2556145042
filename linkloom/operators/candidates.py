"""From keys to ranked candidates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom import config
from linkloom.config import BlockingConfig
from linkloom.functions.keys import record_keys
from linkloom.operators import index
from linkloom.sources.storage import materialize


def hits(query_postings: DataFrame, stats: DataFrame) -> DataFrame:
    """s1, key, key_type, cnt, weight: the query records' keys that the index holds."""
    return query_postings.select("s1", "key").join(stats, "key").select("s1", "key", "key_type", "cnt", "weight")


def fanout(found: DataFrame) -> DataFrame:
    """s1, fanout: the postings that a query record's keys lead to."""
    return found.groupBy("s1").agg(F.sum("cnt").alias("fanout"))


def within_budget(found: DataFrame, budget: int | None) -> DataFrame:
    """Each query record's rarest keys, as far as their postings fit the budget; the first one always."""
    if budget is None:
        return found
    rarest = Window.partitionBy("s1").orderBy("cnt", "key_type", "key")
    running = F.sum("cnt").over(rarest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = found.withColumn("_sum", running).withColumn("_no", F.row_number().over(rarest))
    return kept.where((F.col("_sum") <= budget) | (F.col("_no") == 1)).drop("_sum", "_no")


def expand(found: DataFrame, postings: DataFrame) -> DataFrame:
    """s1, cand, cand_src, weight: a row per hit and record of its key; at most the cap for each hit.

    Give it the postings of usable keys only (see ``index.without_hot``).
    """
    return found.select("s1", "key", "weight").join(postings.select("key", "cand", "cand_src"), "key").select("s1", "cand", "cand_src", "weight")


def scored(pairs: DataFrame) -> DataFrame:
    """s1, cand, cand_src, score, n_keys: the sum of the shared keys' weights."""
    return pairs.groupBy("s1", "cand", "cand_src").agg(F.sum("weight").alias("score"), F.count("*").alias("n_keys"))


def ranked(pairs: DataFrame, top_n: int | None) -> DataFrame:
    """The best ``top_n`` candidates of each query record with their rank; ties by source and id."""
    order = Window.partitionBy("s1").orderBy(F.round("score", 6).desc(), "cand_src", "cand")
    out = pairs.withColumn("rank", F.row_number().over(order))
    return out if top_n is None else out.where(F.col("rank") <= top_n)


def query_postings(records: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    return record_keys(records, "entity_id", settings=settings).withColumnRenamed("entity_id", "s1")


def index_postings(records: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    keyed = record_keys(records, "entity_id", "src", settings=settings)
    return keyed.withColumnsRenamed({"entity_id": "cand", "src": "cand_src"})


class Blocking:
    """The tables of one run, each computed once.

    Keys are extracted once for either side and written to the shared folder, counts and the
    ranked pairs as well; what follows reads those.
    """

    def __init__(self, reference: DataFrame, others: DataFrame, settings: BlockingConfig = config.DEFAULT):
        self.reference, self.others, self.settings = reference, others, settings

    @cached_property
    def asked(self) -> DataFrame:
        return materialize(query_postings(self.reference, self.settings), "asked")

    @cached_property
    def postings(self) -> DataFrame:
        return materialize(index_postings(self.others, self.settings), "postings")

    @cached_property
    def counts(self) -> DataFrame:
        return materialize(index.bucket_counts(self.postings), "counts")

    @property
    def stats(self) -> DataFrame:
        return index.usable(self.counts, self.settings)

    @cached_property
    def usable_postings(self) -> DataFrame:
        return index.without_hot(self.postings, self.counts, self.settings)

    @cached_property
    def hits(self) -> DataFrame:
        return hits(index.without_hot(self.asked, self.counts, self.settings), self.stats)

    @property
    def kept(self) -> DataFrame:
        return within_budget(self.hits, self.settings.fanout_budget)

    @property
    def scored(self) -> DataFrame:
        return scored(expand(self.kept, self.usable_postings))

    @property
    def ranked(self) -> DataFrame:
        return ranked(self.scored, self.settings.top_n)

    @cached_property
    def pairs(self) -> DataFrame:
        """s1, cand, cand_src, score, n_keys, rank, written once."""
        return materialize(self.ranked, "pairs")


def candidates(reference: DataFrame, others: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """s1, cand, cand_src, score, n_keys, rank of the records of ``others`` for those of ``reference``."""
    return Blocking(reference, others, settings).ranked


def listed(reference: DataFrame, pairs: DataFrame) -> DataFrame:
    """s1, candidate_ids (comma-joined, best first), n_candidates: one row per reference record, empty lists too."""
    lists = pairs.groupBy("s1").agg(F.sort_array(F.collect_list(F.struct("rank", "cand"))).alias("c"))
    joined = reference.select(F.col("entity_id").alias("s1")).join(lists, "s1", "left")
    ids = F.coalesce(F.array_join(F.transform("c", lambda x: x["cand"]), ","), F.lit(""))
    return joined.select("s1", ids.alias("candidate_ids"), F.coalesce(F.size("c"), F.lit(0)).cast("long").alias("n_candidates"))


def lookup(record: DataFrame, others: DataFrame, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """Candidates of single records, without the fan-out budget."""
    free = BlockingConfig(**{**settings.__dict__, "fanout_budget": None})
    return candidates(record, others, free)
