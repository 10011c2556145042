"""Why known pairs were missed: shared tokens, their frequencies, addresses, name similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import config
from linkloom.functions import text
from linkloom.sources.storage import materialize

FIELDS = ("names", "addresses")
SAMPLE, EXAMPLES, TOP_COUNTRIES, TOP_SIZES = 20_000, 12, 25, 8


def described(records: DataFrame) -> DataFrame:
    """entity_id, src, country, business_name, names, addresses (distinct tokens) and grams (trigrams of the name)."""
    f = text.with_folded(records).select("entity_id", "src", "country", "business_name", text.normalized_name(F.col("folded.name")).alias("name"), text.normalized_address(F.col("folded.address")).alias("address"))
    names, addresses = F.array_distinct(text.significant_tokens(F.col("name"))), F.array_distinct(text.significant_tokens(F.col("address"), 2))
    return f.select("entity_id", "src", F.coalesce("country", F.lit("")).alias("country"), "business_name", names.alias("names"), addresses.alias("addresses"), text.trigrams(F.col("name")).alias("grams"))


def _tagged() -> Column:
    """The tokens of both fields as an array of field and token."""

    def one(field: str) -> Column:
        return F.transform(field, lambda t: F.struct(F.lit(field).alias("field"), t.alias("token")))

    return F.concat(*map(one, FIELDS))


def all_frequencies(info: DataFrame) -> DataFrame:
    """country, field (names or addresses), token, df: how many described records of the other sources hold a token."""
    listed = info.where("src > 1").select("country", F.inline(_tagged()))
    return listed.groupBy("country", "field", "token").agg(F.count("*").alias("df"))


def token_frequencies(info: DataFrame, column: str) -> DataFrame:
    """country, token, df of one field."""
    return info.where("src > 1").select("country", F.explode(column).alias("token")).groupBy("country", "token").agg(F.count("*").alias("df"))


def truth_sample(truth: DataFrame, n: int | None = SAMPLE, seed: int = 42) -> DataFrame:
    """s1 of at most ``n`` reference records with known pairs, the same for each run; of all without ``n``."""
    ids = truth.select("s1").distinct()
    if n is None:
        return ids
    return ids.orderBy(F.xxhash64("s1", F.lit(seed)), "s1").limit(n)


def missed_pairs(truth: DataFrame, pairs: DataFrame, info: DataFrame, cap: int = config.DEFAULT.bucket_cap) -> DataFrame:
    """One row per known pair whose reference record exists: s1, cand, found, s1_has_candidates,
    category, signal, jaccard and decile. The last four are null for pairs that were found;
    for a missing record all but the category.

    The known pairs meet their records and candidates once and are written; the tokens that
    missed ones share are then counted against all frequencies in one join.
    """
    found = pairs.groupBy("s1").agg(F.collect_set("cand").alias("cands"))
    left = info.where("src = 1").select(F.col("entity_id").alias("s1"), "country", F.col("names").alias("a_names"), F.col("addresses").alias("a_addresses"), F.col("grams").alias("a_grams"))
    right = info.select(F.col("entity_id").alias("cand"), F.col("country").alias("b_country"), F.col("names").alias("b_names"), F.col("addresses").alias("b_addresses"), F.col("grams").alias("b_grams"))
    met = truth.select("s1", "cand").distinct().join(left, "s1").join(found, "s1", "left").join(right, "cand", "left")
    hit = F.coalesce(F.array_contains("cands", F.col("cand")), F.lit(False))
    compared = ~hit & F.col("b_country").isNotNull()
    shared = [F.when(compared, F.array_intersect(f"a_{c}", f"b_{c}")).alias(c) for c in FIELDS]
    empty = (F.size("a_addresses") == 0) | (F.size("b_addresses") == 0)
    similar = F.when(compared, text.jaccard(F.col("a_grams"), F.col("b_grams")))
    known = met.select("s1", "cand", "country", "b_country", hit.alias("found"), F.col("cands").isNotNull().alias("s1_has_candidates"), compared.alias("compared"), *shared, empty.alias("no_address"), similar.alias("jaccard"))
    known = materialize(known, "known")
    listed = known.where("compared").select("s1", "cand", "country", F.inline(_tagged()))
    counted = listed.join(all_frequencies(info), ["country", "field", "token"], "left")
    rare = F.coalesce("df", F.lit(0)) <= cap
    counted = counted.groupBy("s1", "cand").agg(F.count_if(rare & (F.col("field") == "names")).alias("n_kept"), F.count_if(rare & (F.col("field") == "addresses")).alias("n_rare"))
    known = known.join(counted, ["s1", "cand"], "left")
    category = (
        F.when(F.col("found"), None)
        .when(F.col("b_country").isNull(), "missing_record")
        .when(F.col("country") != F.col("b_country"), "country_mismatch")
        .when(F.size("names") == 0, "no_shared_name_token")
        .when(F.coalesce("n_kept", F.lit(0)) == 0, "shared_only_dropped")
        .otherwise("shared_kept_truncated")
    )
    signal = (
        F.when(F.col("no_address"), "addr_empty")
        .when(F.coalesce("n_rare", F.lit(0)) > 0, "addr_rare_shared")
        .when(F.size("addresses") > 0, "addr_only_generic_shared")
        .otherwise("addr_nothing_shared")
    )
    return known.select(
        "s1", "cand", "country", "found", "s1_has_candidates", category.alias("category"), F.when(F.col("compared"), signal).alias("signal"), "jaccard",
        F.when(F.col("compared"), F.least(F.floor(F.col("jaccard") * 10), F.lit(9))).cast("long").alias("decile"), F.col("names").alias("shared"),
    )


def _shares(df: DataFrame, *by: str) -> DataFrame:
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def _missed(known: DataFrame) -> DataFrame:
    return known.where("not found and category <> 'missing_record'")


def failure_buckets(known: DataFrame) -> DataFrame:
    """category, n, share among missed pairs."""
    return _shares(known.where("not found"), "category")


def miss_by_source(known: DataFrame) -> DataFrame:
    return _missed(known).groupBy(F.substring("cand", 1, 2).alias("source")).agg(F.count("*").alias("n"))


def miss_by_country(known: DataFrame) -> DataFrame:
    return _missed(known).groupBy("country").agg(F.count("*").alias("n"))


def miss_zero_candidates(known: DataFrame) -> DataFrame:
    """One row: n_total and n_found pairs, n_s1 records, n_s1_zero of them without candidates, and missed pairs of records without and with candidates."""
    missed = ~F.col("found") & (F.col("category") != "missing_record")
    return known.agg(
        F.count("*").alias("n_total"),
        F.count_if("found").alias("n_found"),
        F.countDistinct("s1").alias("n_s1"),
        F.countDistinct(F.when(~F.col("s1_has_candidates"), F.col("s1"))).alias("n_s1_zero"),
        F.count_if(missed & ~F.col("s1_has_candidates")).alias("n_missed_zero"),
        F.count_if(missed & F.col("s1_has_candidates")).alias("n_missed_some"),
    )


def address_rescue(known: DataFrame) -> DataFrame:
    return _missed(known).groupBy("category", "signal").agg(F.count("*").alias("n"))


def trigram_deciles(known: DataFrame) -> DataFrame:
    return _missed(known).groupBy("category", "decile").agg(F.count("*").alias("n"))


def examples(known: DataFrame, frequencies: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """category, no, s1, cand, jaccard, shared (tokens with their frequencies): at most ``n`` missed pairs of each category."""
    order = Window.partitionBy("category").orderBy("s1", "cand")
    few = _missed(known).withColumn("no", F.row_number().over(order)).where(F.col("no") <= n)
    listed = few.select("s1", "cand", "country", F.explode("shared").alias("token")).join(frequencies, ["country", "token"], "left")
    words = listed.groupBy("s1", "cand").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "token", F.coalesce("df", F.lit(0)).cast("string")))), " ").alias("shared"))
    return few.drop("shared").join(words, ["s1", "cand"], "left").select("category", "no", "s1", "cand", "jaccard", F.coalesce("shared", F.lit("")).alias("shared"))


def matches_histogram(truth: DataFrame, n: int = TOP_SIZES) -> DataFrame:
    """n_matches, n_entities: the ``n`` most frequent numbers of known matches."""
    sizes = truth.groupBy("s1").agg(F.count("*").alias("n_matches")).groupBy("n_matches").agg(F.count("*").alias("n_entities"))
    return sizes.orderBy(F.desc("n_entities"), "n_matches").limit(n)


def country_counts(records: DataFrame) -> DataFrame:
    """country, s1, s2, s3, total."""
    per = [F.count_if(F.col("src") == i).alias(f"s{i}") for i in (1, 2, 3)]
    return records.groupBy(F.coalesce("country", F.lit("")).alias("country")).agg(*per, F.count("*").alias("total"))


def top_countries(records: DataFrame, n: int = TOP_COUNTRIES) -> DataFrame:
    return country_counts(records).orderBy(F.desc("total"), "country").limit(n)


def ratio(part: Column, whole: Column) -> Column:
    """Null-safe share: null where there is nothing."""
    return F.when(whole != 0, part / whole)
