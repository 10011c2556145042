"""Similarity features of candidate pairs, and a threshold matcher."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text


def features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` (s1, cand, ...) with name_jaccard, trigram_jaccard, name_edit (1 - edit distance over
    the longer length), same_sound (of the first tokens) and same_postcode."""
    f = text.with_folded(records).select("entity_id", text.normalized_name(F.col("folded.name_plain")).alias("name"), F.array_join("folded.address_parts", ",").alias("address"))
    f = f.select("entity_id", "name", text.significant_tokens(F.col("name")).alias("tokens"), text.trigrams(F.col("name")).alias("grams"), F.regexp_extract("address", r"(?<!\d)(\d{5,6})(?!\d)", 1).alias("code"))
    side = lambda p: f.select(*[F.col(c).alias(p + c) for c in f.columns])
    both = pairs.join(side("a_"), F.col("s1") == F.col("a_entity_id")).join(side("b_"), F.col("cand") == F.col("b_entity_id"))
    longest = F.greatest(F.length("a_name"), F.length("b_name"))
    return both.select(
        *pairs.columns,
        text.jaccard(F.array_distinct("a_tokens"), F.array_distinct("b_tokens")).alias("name_jaccard"),
        text.jaccard(F.col("a_grams"), F.col("b_grams")).alias("trigram_jaccard"),
        F.when(longest == 0, 0.0).otherwise(1 - F.levenshtein("a_name", "b_name") / longest).alias("name_edit"),
        F.coalesce(F.soundex(F.get("a_tokens", 0)) == F.soundex(F.get("b_tokens", 0)), F.lit(False)).alias("same_sound"),
        ((F.col("a_code") != "") & (F.col("a_code") == F.col("b_code"))).alias("same_postcode"),
    )


def tfidf_cosine(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """s1, cand, cosine of the names' TF-IDF vectors (idf = ln(1 + records / records with the token)); pairs that share no token have no row."""
    f = text.with_folded(records).select("entity_id", F.explode(text.significant_tokens(text.normalized_name(F.col("folded.name_plain")))).alias("token"))
    tf = f.groupBy("entity_id", "token").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("token").agg(F.count("*").alias("df")).select("token", F.log1p(records.agg(F.count("*")).scalar() / F.col("df")).alias("idf"))
    weights = tf.join(idf, "token").select("entity_id", "token", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    a = weights.select(F.col("entity_id").alias("s1"), "token", F.col("w").alias("wa"))
    b = weights.select(F.col("entity_id").alias("cand"), "token", F.col("w").alias("wb"))
    dot = pairs.select("s1", "cand").join(a, "s1").join(b, ["cand", "token"]).groupBy("s1", "cand").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    na, nb = norms.select(F.col("entity_id").alias("s1"), F.col("norm").alias("na")), norms.select(F.col("entity_id").alias("cand"), F.col("norm").alias("nb"))
    return dot.join(na, "s1").join(nb, "cand").select("s1", "cand", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("cosine"))


def matches(featured: DataFrame, threshold: float = 0.5) -> DataFrame:
    """s1, cand, confidence of the candidates whose mean name similarity reaches the threshold."""
    mean = (F.col("name_jaccard") + F.col("trigram_jaccard") + F.col("name_edit")) / 3
    return featured.select("s1", "cand", mean.alias("confidence")).where(F.col("confidence") >= threshold)


_INPUTS = ["name_jaccard", "trigram_jaccard", "name_edit", "sound", "code"]


def _numbers(featured: DataFrame) -> DataFrame:
    return featured.withColumn("sound", F.col("same_sound").cast("double")).withColumn("code", F.col("same_postcode").cast("double"))


def fit_classifier(featured: DataFrame, truth: DataFrame) -> PipelineModel:
    """A logistic regression on the features; pairs of ``truth`` are the positives."""
    known = truth.select("s1", "cand").distinct().withColumn("label", F.lit(1.0))
    rows = _numbers(featured).join(known, ["s1", "cand"], "left").na.fill(0.0, ["label"])
    return Pipeline(stages=[VectorAssembler(inputCols=_INPUTS, outputCol="features"), LogisticRegression(regParam=0.01)]).fit(rows)


def classify(featured: DataFrame, model: PipelineModel) -> DataFrame:
    """s1, cand, confidence: the model's probability of a match."""
    return model.transform(_numbers(featured)).select("s1", "cand", vector_to_array("probability")[1].alias("confidence"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, steps: int = 20) -> DataFrame:
    """threshold, n_said, n_hit, precision, recall and f05 over all pairs, for each of ``steps`` thresholds.

    One pass: pairs are counted by the step that their confidence reaches, and summed upwards.
    """
    known = truth.select("s1", "cand").distinct().withColumn("hit", F.lit(1))
    step = F.least(F.floor(F.col("confidence") * steps), F.lit(steps - 1))
    counts = scored.join(known, ["s1", "cand"], "left").groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    every = scored.sparkSession.range(steps).withColumnRenamed("id", "step")
    upward = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over ``steps`` rows
    total = every.join(counts, "step", "left").na.fill(0).select("step", F.sum("n").over(upward).alias("n_said"), F.sum("h").over(upward).alias("n_hit"))
    n_true = truth.select("s1", "cand").distinct().agg(F.count("*")).scalar()
    precision, found = F.try_divide("n_hit", "n_said"), F.try_divide(F.col("n_hit"), n_true)
    f05 = F.coalesce(F.try_divide(1.25 * F.col("n_hit"), F.col("n_said") + 0.25 * n_true), F.lit(0.0))
    return total.select((F.col("step") / steps).alias("threshold"), "n_said", "n_hit", precision.alias("precision"), found.alias("recall"), f05.alias("f05"))
