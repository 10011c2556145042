"""Business records made from the test documents, and the pairs known to match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.sources import storage


def scratch(spark: SparkSession) -> str:
    """A new folder for files of one query, where all executors reach it."""
    return storage.new_path(spark, "files")


def write_file(lines: DataFrame, header: str, path: str) -> None:
    """Write ``value`` as a text file in one part, the header (if any) first."""
    rows = lines.select("value", F.lit(1).alias("no"))
    if header:
        rows = rows.unionByName(lines.sparkSession.range(1).select(F.lit(header).alias("value"), F.lit(0).alias("no")))
    rows.coalesce(1).sortWithinPartitions("no", "value").select("value").write.text(path)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, src, business_name, business_address, country, grp: one source-1 record for each start of a text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = F.split(F.trim("text"), r"\s+", 19)  # no further than needed, however long the text
    src = (1 + F.substring("source", 4, 10).cast("int") % 3).cast("long")
    rows = docs.select(src.alias("src"), "doc_id", F.slice(words, 1, 18).alias("w"), F.col("lang").alias("country"), F.substring("text", 1, 60).alias("grp"))
    # partial minima absorb starts that many texts share
    first = rows.where("src = 1").groupBy("src", "country", "grp").agg(F.min(F.struct("doc_id", "w")).alias("m"))
    rows = first.select("src", "m.doc_id", "m.w", "country", "grp").unionByName(rows.where("src > 1"))
    return rows.select(F.concat(F.lit("S"), "src", F.lit("-"), "doc_id").alias("entity_id"), "src", F.concat_ws(" ", F.slice("w", 1, 6)).alias("business_name"), F.concat_ws(" ", F.slice("w", 7, 12)).alias("business_address"), "country", "grp")


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with house numbers and digits written for letters."""
    base = records(spark, sf_dir)
    number = F.length("grp") * 37 + F.ascii("grp") * 11 + F.length(F.replace("grp", F.lit("e"), F.lit("")))
    name = F.when(F.col("src") == 3, F.translate("business_name", "o", "0")).otherwise(F.col("business_name"))
    address = F.concat(F.when(F.col("src") == 2, "0").otherwise(""), number.cast("string"), F.when(F.col("src") == 3, "b").otherwise(""), F.lit(" St, "), "business_address")
    return base.select("entity_id", "src", name.alias("business_name"), address.alias("business_address"), "country", "grp")


def posted(base: DataFrame) -> DataFrame:
    """``noisy`` records with a five-digit code, the same for equal starts, at the end of the address."""
    code = 10_000 + F.length("grp") * 37 + F.ascii("grp") * 11
    return base.withColumn("business_address", F.concat("business_address", F.lit(", "), code.cast("string")))


def truth(base: DataFrame) -> DataFrame:
    """s1, cand: records of the other sources with the same country and start."""
    left = base.where("src = 1").select(F.col("entity_id").alias("s1"), "country", "grp")
    return left.join(base.where("src > 1").select(F.col("entity_id").alias("cand"), "country", "grp"), ["country", "grp"]).select("s1", "cand")


def odd_truth(base: DataFrame) -> DataFrame:
    """The known pairs, and some that no blocking can find: with an unknown record, and with the least record of the next country."""
    left = base.where("src = 1").select(F.col("entity_id").alias("s1"), "country", F.substring("entity_id", 4, 20).cast("long").alias("n"))
    gone = left.where("n % 5 = 0").select("s1", F.concat(F.lit("S2-x"), "n").alias("cand"))
    least = base.where("src > 1").groupBy("country").agg(F.min("entity_id").alias("least"))
    following = least.select("country", F.lead("least").over(Window.orderBy("country")).alias("cand"))  # a row per country
    abroad = left.where("n % 3 = 0").join(following.where("cand is not null"), "country").select("s1", "cand")
    return truth(base).unionByName(gone).unionByName(abroad)
