"""Typed blocking keys of a record, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import config
from linkloom.config import BlockingConfig
from linkloom.functions import text


def _pair(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def name_pairs(names: Column, limit: int) -> Column:
    """Unordered pairs of the first ``limit`` tokens."""
    first = F.slice(names, 1, limit)
    return F.flatten(F.transform(first, lambda a, i: F.transform(F.slice(first, i + 2, F.lit(limit)), lambda b: _pair(a, b))))


def name_concat(names: Column, least: int) -> Column:
    joined = F.array_join(names, "")
    return F.when(F.length(joined) >= least, F.array(joined)).otherwise(F.array().cast("array<string>"))


def address_pairs(parts: Column, limit: int) -> Column:
    """Pairs of tokens within a part, among the first ``limit`` tokens of the address, and pairs
    of each of its first two numbers there with every word of the whole address. Generic words
    make no pair with each other, nor with numbers of other parts."""
    generic = lambda t: t.isin(config.ADDRESS_GENERIC)
    placed = F.flatten(F.transform(parts, lambda p, i: F.transform(p, lambda t: F.struct(i.alias("part"), t.alias("token")))))
    near = F.slice(placed, 1, limit)

    def after(x: Column, i: Column) -> Column:
        partners = F.filter(F.slice(near, i + 2, F.lit(limit)), lambda y: (y["part"] == x["part"]) & (y["token"] != x["token"]) & ~(generic(x["token"]) & generic(y["token"])))
        return F.transform(partners, lambda y: _pair(x["token"], y["token"]))

    within = F.flatten(F.transform(near, after))
    numbers = F.slice(F.filter(F.transform(near, lambda x: x["token"]), text.is_number), 1, 2)
    words = F.array_distinct(F.filter(F.flatten(parts), lambda t: ~text.is_number(t) & ~generic(t)))
    across = F.flatten(F.transform(numbers, lambda n: F.transform(words, lambda w: _pair(n, w))))
    return F.array_distinct(F.concat(within, across))


def block_tokens(records: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, names (block tokens of the name) and parts (those of the address)."""
    folded = text.with_folded(records)
    return folded.select(*keep, text.name_block_tokens(F.col("folded.name_plain")).alias("names"), text.address_block_parts(F.col("folded.address_parts")).alias("parts"))


def record_keys(records: DataFrame, *keep: str, settings: BlockingConfig = config.DEFAULT) -> DataFrame:
    """``keep``, key_type and key: one row per distinct key of a record and enabled type.

    A key's text holds the country and the type, so equal keys are candidates by themselves.
    A null country counts as empty.
    """
    tokens = block_tokens(records, *keep, "country")
    makers = {
        config.NAME_TOKEN: F.col("names"),
        config.NAME_PAIR: name_pairs(F.col("names"), settings.name_pair_tokens),
        config.NAME_CONCAT: name_concat(F.col("names"), settings.concat_length),
        config.ADDRESS_PAIR: address_pairs(F.col("parts"), settings.address_tokens),
    }
    typed = [_typed(t, makers[t]) for t in settings.key_types]
    listed = tokens.select(*keep, "country", F.explode(F.concat(*typed)).alias("k"))
    key = F.concat_ws(config.SEPARATOR, F.coalesce("country", F.lit("")), F.col("k.key_type").cast("string"), F.col("k.text"))
    return listed.select(*keep, F.col("k.key_type").alias("key_type"), key.alias("key"))


def _typed(key_type: int, texts: Column) -> Column:
    return F.transform(F.array_distinct(texts), lambda k: F.struct(F.lit(key_type).alias("key_type"), k.alias("text")))
