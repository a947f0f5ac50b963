"""Typed relations from polarity and proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, identity
from ..functions.scores import fuse

SYMMETRIC = ["contradicts", "unrelated", "polarity_opposes", "repeats"]
REVIEW = 0.80


def opposition(groups: DataFrame) -> DataFrame:
    """left, right: groups that agree in all but polarity; positive groups joined to negative ones."""
    base = ["subject", "predicate", "object", "epistemic_type", "memory_class"]
    pos = groups.where("polarity = 'positive'").select(*base, F.col("signature_id").alias("p"))
    neg = groups.where("polarity = 'negative'").select(*base, F.col("signature_id").alias("n"))
    return pos.join(neg, base).select(F.least("p", "n").alias("source_group_id"), F.greatest("p", "n").alias("target_group_id"))


def canonical(proposals: DataFrame) -> DataFrame:
    """Symmetric types with sorted ends."""
    sym = F.col("relation_type").isin(SYMMETRIC)
    s, t = F.col("source_group_id"), F.col("target_group_id")
    return proposals.withColumns({"source_group_id": F.when(sym, F.least(s, t)).otherwise(s), "target_group_id": F.when(sym, F.greatest(s, t)).otherwise(t)})


def compile(proposals: DataFrame, structural: DataFrame | None = None, groups: DataFrame | None = None, review: float = REVIEW) -> DataFrame:
    """relation_id, source_group_id, target_group_id, relation_type, score, proposers, disposition. proposals: source_group_id, target_group_id,
    relation_type, proposer, evidence_id, score (a row per piece of evidence). With groups, both ends must exist."""
    checks.require_empty(proposals.where("source_group_id = target_group_id"), "relation of a group with itself")
    if groups is not None:
        for end in ("source_group_id", "target_group_id"):
            checks.known(proposals, end, groups, "signature_id", "relation group")
    x = canonical(proposals).withColumn("structural", F.lit(False))
    if structural is not None:
        made = structural.select("source_group_id", "target_group_id", F.lit("polarity_opposes").alias("relation_type"), F.lit("K06.rule").alias("proposer"), identity.key_id(F.lit("structural"), "source_group_id", "target_group_id").alias("evidence_id"), F.lit(1.0).alias("score"), F.lit(True).alias("structural"))
        x = x.unionByName(made)
    key = ["source_group_id", "target_group_id", "relation_type"]
    who = x.groupBy(*key).agg(F.sort_array(F.collect_set("proposer")).alias("proposers"))
    once = x.dropDuplicates([*key, "evidence_id"]).groupBy(*key).agg(fuse(F.collect_list(F.struct("evidence_id", "score"))).alias("score"), F.bool_or("structural").alias("structural"))
    shown = F.when(F.col("structural"), "structural").when(F.col("score") >= review, "review_required").otherwise("suggested")
    return once.join(who, key).select(identity.key_id(F.lit("relation"), *key).alias("relation_id"), *key, "score", "proposers", shown.alias("disposition"))
