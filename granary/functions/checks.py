"""Record constraints as check columns, and set-based guards."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

MOST_TAGS = 32


class ContractError(ValueError):
    """A table breaks its contract."""


def shares(policy) -> None:
    """Every number of a policy that is a weight or a threshold lies in [0, 1]."""
    for f in dataclasses.fields(policy):
        value = getattr(policy, f.name)
        if isinstance(value, float) and not 0.0 <= value <= 1.0:
            raise ValueError(f"{type(policy).__name__}.{f.name} is {value}, not a share")


def filled(x: Column) -> Column:
    return x.isNotNull() & (strip(x) != "")


def score(x: Column, low: float = 0.0) -> Column:
    return x.isNotNull() & x.between(low, 1.0)


def digest(x: Column) -> Column:
    return x.isNull() | (F.length(x) == 64)


def offsets(a: Column, b: Column) -> Column:
    return (a.isNull() & b.isNull()) | (a.isNotNull() & b.isNotNull() & (a >= 0) & (b > a))


def anchor(a: Column) -> Column:
    """A proxy names its reason; no end before a start of equal form."""
    ordered = a["start"].isNull() | a["end"].isNull() | (a["start"] <= a["end"])
    return (~a["is_proxy"] | filled(a["proxy_reason"])) & ordered


def few_tags(x: Column) -> Column:
    return x.isNull() | (F.size(x) <= MOST_TAGS)


def _record(kind: str) -> dict[str, Column]:
    c = F.col
    return {
        "mention": lambda: {"mention_text": filled(c("mention_text")), "confidence": score(c("confidence"))},
        "evidence": lambda: {"exact_text": filled(c("exact_text")), "offsets": offsets(c("start_offset"), c("end_offset")), "source_sha256": digest(c("source_sha256"))},
        "candidate": lambda: {"statement": filled(c("statement")), "importance": score(c("importance")), "durability": score(c("durability")), "tags": few_tags(c("tags"))},
        "relation": lambda: {"ends": c("source_group_id") != c("target_group_id"), "score": score(c("score"))},
        "conflict": lambda: {"order": c("left_group_id") < c("right_group_id"), "score": score(c("score"))},
        "response": lambda: {"reviewer": filled(c("reviewer")), "reason": filled(c("reason")), "authority": c("authority").between(1, 3), "decision": c("decision").isin("accept", "reject", "defer", "escalate")},
    }[kind]()


def violations(df: DataFrame, key: str, **rules: Column) -> DataFrame:
    """key, rule for each broken rule."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.col(key).alias("key"), F.explode(broken).alias("rule"))


def record_violations(df: DataFrame, key: str, kind: str) -> DataFrame:
    """key, rule for each broken rule of a kind of record: mention, evidence, candidate, relation, conflict or response."""
    return violations(df, key, **_record(kind))


def require_empty(df: DataFrame, message: str) -> None:
    """Raises with a few examples if the table has rows."""
    if bad := df.take(3):
        raise ContractError(f"{message}: {[tuple(r) for r in bad]}")


def duplicates(df: DataFrame, *keys: str, what: str) -> DataFrame:
    """what, key, n of keys that repeat."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(what).alias("what"), F.concat_ws("/", *keys).alias("key"), "n")


def unique(df: DataFrame, *keys: str, what: str) -> None:
    require_empty(duplicates(df, *keys, what=what).select("key"), f"duplicate {what}")


def unknown(df: DataFrame, column: str, of: DataFrame, key: str, code: str) -> DataFrame:
    """code, ref of references that lead nowhere; null refers to nothing."""
    refs = df.select(F.col(column).cast("string").alias("ref")).where("ref is not null").distinct()
    return refs.join(of.select(F.col(key).cast("string").alias("ref")), "ref", "left_anti").select(F.lit(code).alias("code"), "ref")


def known(df: DataFrame, column: str, of: DataFrame, key: str, what: str) -> None:
    require_empty(unknown(df, column, of, key, what).select("ref"), f"unknown {what}")
