"""The registered queries of the ten operators: thin calls over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import ann, chat, packing, pii, quality, sentencepiece, simhash, substring, token_counts, tokens, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _table(spark, sf_dir, "embeddings")
    return ann.search(data, data.where("vec_id % 100 = 0"), k=10)


def op2_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a query by itself has the memory for more words than a stage of the pipeline
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache=2 * tokens.CACHE)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = sentencepiece.round_trip(_table(spark, sf_dir, "documents"), path)
    return docs.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("text_sha256"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, _table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_counts.length_histogram(lengths)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_projected_neighbours, op2_role_repair, op3_crf_personal_data, op4_best_fit_packing, op5_sentencepiece, op6_warc, op7_quality_rules, op8_substring_dedup, op9_token_counts, op10_simhash)}

_BITS = " + ".join(f"{16 >> k} * cast(substr(bits, 5 * i + {k + 1}, 1) as int)" for k in range(5))

#: The other operators hold a model, a tokenizer's ids, a hash or a search that SQL can't express; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op6_warc": f"""with p as (select page_id, coalesce(html, '') as html from pages),
        d as (select *, max(page_id) over (partition by html) as top, cast(cast(unhex(sha1(html)) as bit) as varchar) as bits from p)
        select page_id, strlen(html) as payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_BITS}, 1)), '') as payload_digest,
        case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to from d""",
}
