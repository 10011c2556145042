"""Text normalisation as Column functions; one vectorised UDF does the Unicode forms."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom import config

_LATIN_MARKS = regex.compile(r"(?<=[A-Za-z])\p{Mn}+")
FOLDED = T.StructType([*(T.StructField(c, T.StringType()) for c in ("name", "name_plain", "address")), T.StructField("address_parts", T.ArrayType(T.StringType()))])


def strip_latin_accents(text: str) -> str:
    """``text`` without the non-spacing marks on a to z; marks of other scripts stay."""
    return text if text.isascii() else unicodedata.normalize("NFC", _LATIN_MARKS.sub("", unicodedata.normalize("NFD", text)))


def _fold(text: str) -> str:
    return unicodedata.normalize("NFKC", text.strip().lower())


@F.pandas_udf(FOLDED)
def fold(name: pd.Series, address: pd.Series) -> pd.DataFrame:
    """Lower case and compatibility forms of a record's texts, null as empty, in one crossing to Python.

    name and address as they are; name_plain and the comma-parted address_parts with Latin
    accents stripped first.
    """
    name, address = name.fillna(""), address.fillna("")
    plain = address.map(strip_latin_accents)
    return pd.DataFrame({
        "name": name.map(_fold),
        "name_plain": name.map(lambda x: _fold(strip_latin_accents(x))),
        "address": address.map(_fold),
        "address_parts": plain.map(lambda x: [_fold(p) for p in x.split(",")]),
    })


@F.pandas_udf(T.StringType())
def strip_accents(text: pd.Series) -> pd.Series:
    """Latin accents stripped; null as empty."""
    return text.fillna("").map(strip_latin_accents)


def with_folded(records: DataFrame, name: str = "business_name", address: str = "business_address") -> DataFrame:
    """``records`` with the struct column folded (see ``fold``)."""
    return records.withColumn("folded", fold(F.col(name), F.col(address)))


def clean(folded: Column) -> Column:
    """A folded text without punctuation, white space collapsed: letters, marks and numbers of any script stay."""
    spaced = F.regexp_replace(folded, r"(?U)[^\p{L}\p{M}\p{N}\s\x1c-\x1f]", " ")
    return F.trim(F.regexp_replace(spaced, r"(?U)[\s\x1c-\x1f]+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def expand(words: Column, abbreviations: dict[str, str]) -> Column:
    """The words, joined, each replaced by what it abbreviates."""

    def one(t: Column) -> Column:
        out = None
        for short, full in abbreviations.items():
            out = F.when(t == short, full) if out is None else out.when(t == short, full)
        return out.otherwise(t)

    return F.array_join(F.transform(words, one), " ")


def normalized_name(folded: Column) -> Column:
    return expand(tokens(clean(folded)), config.NAME_ABBREVIATIONS)


def normalized_address(folded: Column) -> Column:
    return expand(tokens(clean(folded)), config.ADDRESS_ABBREVIATIONS)


def _in(t: Column, words: list[str]) -> Column:
    return t.isin(words)


def significant_tokens(normalized: Column, min_length: int = 3) -> Column:
    """Tokens of at least ``min_length`` code points that aren't legal forms or fillers."""
    return F.filter(tokens(normalized), lambda t: (F.length(t) >= min_length) & ~_in(t, config.STOP_WORDS))


def fix_lookalike(token: Column) -> Column:
    """Digits written for letters turned back, if only letters come of it."""
    fixed = F.translate(token, config.LOOKALIKE_DIGITS, config.LOOKALIKE_LETTERS)
    mixed = token.rlike("[a-z]") & token.rlike(r"\p{Nd}") & fixed.rlike(r"^\p{L}+$")
    return F.when(mixed, fixed).otherwise(token)


def name_block_tokens(name_plain: Column) -> Column:
    """The distinct tokens of a name that make keys, in order."""
    fixed = F.transform(significant_tokens(normalized_name(name_plain)), fix_lookalike)
    return F.array_distinct(F.filter(fixed, lambda t: ~_in(t, config.NAME_BLOCK_STOP)))


def is_number(token: Column) -> Column:
    return token.rlike(r"^\p{Nd}+$")


def address_token(token: Column) -> Column:
    """A house number without leading zeros and without its letter; other tokens as they are."""
    digits = F.regexp_replace(F.regexp_extract(token, r"^(\p{Nd}+)[a-z]?$", 1), "^0+", "")
    return F.when(token.rlike(r"^\p{Nd}+[a-z]?$"), F.when(digits == "", "0").otherwise(digits)).otherwise(token)


def address_block_parts(parts: Column) -> Column:
    """Token lists of the comma parts that have any: words of two letters or more, and numbers."""

    def one(part: Column) -> Column:
        words = F.transform(tokens(normalized_address(part)), address_token)
        return F.filter(words, lambda t: (F.length(t) >= 2) | is_number(t))

    return F.filter(F.transform(parts, one), lambda p: F.size(p) > 0)


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text without its spaces."""
    solid = F.replace(text, F.lit(" "), F.lit(""))
    n = F.length(solid)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(solid, i, F.lit(3)))
    return F.when(n >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 0.0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))
