"""Exact histogram of encoded lengths; suffix sums answer every context limit."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.tokens import encoder


def encoded_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens, one row per input row; a null text has no tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            counts = np.fromiter((len(encode(x or "")) // 4 for x in batch.column(1).to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], ["doc_id", "n_tokens"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with suffix sums over the lengths.

    Columns: n_tokens; n_docs of that length; docs_over and tokens_over (documents strictly
    longer, and their tokens); total_docs, total_tokens; truncated_tokens (what is left of all
    documents cut at this length); share_whole (documents not cut by this limit). Null lengths
    are left out. The table has at most as many rows as the longest document has tokens, so
    its one ordered pass doesn't grow with the number of documents. Empty input: no rows.
    """
    n = F.col(length_col)
    counted = lengths.where(n.isNotNull()).groupBy(n.cast("long").alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    after = Window.orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("n_tokens") * F.col("n_docs")
    over = counted.select(
        "n_tokens",
        "n_docs",
        F.coalesce(F.sum("n_docs").over(after), F.lit(0)).alias("docs_over"),
        F.coalesce(F.sum(tokens).over(after), F.lit(0)).alias("tokens_over"),
        F.sum("n_docs").over(everything).alias("total_docs"),
        F.sum(tokens).over(everything).alias("total_tokens"),
    )
    return over.select(
        "*",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("truncated_tokens"),
        (1 - F.col("docs_over") / F.col("total_docs")).alias("share_whole"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> Column | DataFrame:
    """One row: docs, docs_cut and tokens kept at any context limit, a length of the table or not."""
    n = F.col("n_tokens")
    return histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.when(n > limit, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.least(n, F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"),
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share ``q`` of all documents doesn't exceed."""
    return histogram.where(F.col("total_docs") - F.col("docs_over") >= q * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens"))
