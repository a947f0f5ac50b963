"""Folding of evidence scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fuse(evidence: Column, clamped: bool = True) -> Column:
    """evidence: array<struct<evidence_id, score>>. Noisy-or of the support, damped by that of the objections; folded in the
    order of the ids, so that the last bit does not depend on partitioning."""
    ordered = F.transform(F.array_sort(F.transform(evidence, lambda e: F.struct(e["evidence_id"].alias("i"), e["score"].cast("double").alias("s")))), lambda e: e["s"])
    miss = F.aggregate(ordered, F.lit(1.0), lambda a, s: F.when(s >= 0, a * (1 - s)).otherwise(a))
    deny = F.aggregate(ordered, F.lit(1.0), lambda a, s: F.when(s < 0, a * (1 - F.abs(s))).otherwise(a))
    score = (1 - miss) * (1 - (1 - deny))
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)) if clamped else score


def clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
