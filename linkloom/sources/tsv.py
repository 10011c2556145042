"""Tab-separated sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])


def _id_list(second: str) -> T.StructType:
    return T.StructType([T.StructField("source1_entity_id", T.StringType()), T.StructField(second, T.StringType())])


def read_records(spark: SparkSession, path: str, src: int) -> DataFrame:
    """entity_id, business_name, business_address, country, src of one source file; missing fields are empty.

    Fields may be quoted, with doubled quotes inside. Splits of any size are read in parallel.
    """
    rows = spark.read.schema(RECORD).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return rows.na.fill("").withColumn("src", F.lit(src).cast("long"))


def read_sources(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """The union of source files, by source number."""
    first, *rest = [read_records(spark, path, src) for src, path in paths.items()]
    for part in rest:
        first = first.unionByName(part)
    return first


def split_ids(ids: F.Column | str) -> F.Column:
    """A comma-joined list as an array; null or empty: no elements."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.when(ids.isNull() | (ids == ""), F.array().cast("array<string>")).otherwise(F.split(ids, ","))


def read_pairs(spark: SparkSession, path: str, column: str = "matched_entity_ids") -> DataFrame:
    """s1, cand of an id-list file; of rows with the same s1 the last counts."""
    rows = spark.read.schema(_id_list(column)).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    numbered = rows.select(F.col("source1_entity_id").alias("s1"), split_ids(column).alias("ids"), F.monotonically_increasing_id().alias("no"))
    last = numbered.groupBy("s1").agg(F.max_by("ids", "no").alias("ids"))
    return last.select("s1", F.explode("ids").alias("cand")).distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: the distinct trimmed first fields behind the header."""
    lines = read_lines(spark, path).where("line_no > 1")
    return lines.where(F.col("value").rlike(r"\S")).select(F.trim(F.split("value", "\t", 2)[0]).alias("entity_id")).distinct()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value and line_no (from 1) of a text file, unquoted.

    Numbers follow file order: lines are counted within splits and offset by the sizes of
    those before, so no split waits for another. The offsets are a row of 16 bytes for each
    split, which every executor gets.
    """
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", 33)
    lines = lines.select("value", part.alias("part"), (F.col("at") - F.shiftleft(part, 33)).alias("i"))
    sizes = lines.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row per split
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return lines.join(F.broadcast(starts), "part").select("value", (F.col("first") + F.col("i") + 1).alias("line_no"))


def write_pairs(listed: DataFrame, path: str, column: str = "candidate_entity_ids", single_file: bool = False) -> None:
    """Write s1 and candidate_ids as an id-list file: header, tabs, no quotes, empty lists kept."""
    out = listed.select(F.col("s1").alias("source1_entity_id"), F.col("candidate_ids").alias(column))
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
