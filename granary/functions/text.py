"""The four text normalisers, trigrams and polarity."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

SPACE = r"[\s\x1c-\x1f]+"
#: Prefixes that negate a predicate, first match wins.
NEGATIVE = ["does_not_", "did_not_", "do_not_", "is_not_", "was_not_", "were_not_", "has_not_", "have_not_", "had_not_", "cannot_", "can_not_", "not_", "never_"]


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse(x: Column) -> Column:
    return strip(F.regexp_replace(x, "(?U)" + SPACE, " "))


@F.pandas_udf(StringType())
def _casefold(x: pd.Series) -> pd.Series:
    return x.map(lambda v: v.casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def _compatible(x: pd.Series) -> pd.Series:
    return x.map(lambda v: unicodedata.normalize("NFKC", v).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def _entity(x: pd.Series) -> pd.Series:
    keep = {**dict.fromkeys("-_/:&+", " "), **dict.fromkeys(".'’`", "")}

    def one(v):
        v = unicodedata.normalize("NFKC", v).casefold()
        return " ".join("".join(keep.get(c, c if c.isalnum() else " ") for c in v).split())

    return x.map(one, na_action="ignore")


def casefold(x: Column, ascii_only: bool = False) -> Column:
    return F.lower(x) if ascii_only else _casefold(x)


def mention_text(x: Column, ascii_only: bool = False) -> Column:
    """Case-folded, spaces collapsed."""
    return collapse(casefold(x, ascii_only))


def semantic_text(x: Column, ascii_only: bool = False) -> Column:
    """Compatibility-normalised, case-folded, spaces collapsed."""
    return collapse(F.lower(x) if ascii_only else _compatible(x))


def entity_name(x: Column, ascii_only: bool = False) -> Column:
    """As semantic_text, with joining marks as spaces and other punctuation dropped or as spaces."""
    if not ascii_only:
        return _entity(x)
    return collapse(F.regexp_replace(F.regexp_replace(F.lower(x), r"[.'`]", ""), "[^a-z0-9]+", " "))


def predicate_token(x: Column, ascii_only: bool = False) -> Column:
    """Runs of other than word characters as one underscore."""
    folded = F.regexp_replace(strip(F.lower(x) if ascii_only else _compatible(x)), r"(?U)[^\w]+", "_")
    return F.regexp_replace(folded, "^_+|_+$", "")


def polarity(token: Column) -> Column:
    """struct<predicate, polarity> of a predicate token."""
    pattern = "^(" + "|".join(NEGATIVE) + ")(.+)$"
    rest = F.regexp_extract(token, pattern, 2)
    return F.struct(F.when(rest != "", rest).otherwise(token).alias("predicate"), F.when(rest != "", "negative").otherwise("positive").alias("polarity"))


def trigrams(name: Column) -> Column:
    """Distinct trigrams of a normalised name, padded by two spaces; none for an empty name."""
    padded = F.concat(F.lit("  "), name, F.lit("  "))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
    return F.when(F.length(name) > 0, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def compatible_types(a: Column, b: Column) -> Column:
    """Null fits all; a and b are folded by casefold()."""
    return a.isNull() | b.isNull() | (a == b)


def label_order(x: Column) -> Column:
    """Distinct strings, sorted by their lower case, then by themselves."""
    return F.transform(F.array_sort(F.transform(F.array_distinct(x), lambda v: F.struct(F.lower(v).alias("l"), v.alias("r")))), lambda s: s["r"])


def tags(x: Column) -> Column:
    """Stripped, lower-cased, distinct, sorted, no blanks."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(x, lambda t: F.lower(strip(t))), lambda t: t != "")))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks; Arrow, for pairs that blocking has left."""
    from difflib import SequenceMatcher

    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")
