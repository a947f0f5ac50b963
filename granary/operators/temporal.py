"""Dual clocks, state slots and supersessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks, identity, times
from ..functions.scores import fuse

SLOT = ["subject", "predicate", "epistemic_type", "memory_class"]


def occurrences(assertions: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """Assertions with their slot, distinct source times, clock and diagnostics. evidence: assertion_id, chunk_id; chunks: chunk_id, occurred_at."""
    e = evidence.join(chunks.select("chunk_id", "occurred_at", F.lit(True).alias("known")), "chunk_id", "left")
    t = e.groupBy("assertion_id").agg(F.sort_array(F.collect_set("occurred_at")).alias("source_times"), F.bool_or(F.col("known").isNull() & F.col("chunk_id").isNotNull()).alias("unknown_chunk"))
    x = assertions.join(t, "assertion_id", "left").withColumn("source_times", F.coalesce("source_times", F.array().cast("array<string>")))
    notes = F.array_compact(F.array(F.when(F.col("unknown_chunk"), "unknown_evidence_chunk"), F.when(F.size("source_times") == 0, "missing_source_occurrence_time"), F.when(F.col("is_proxy"), "effective_time_is_proxy") if "is_proxy" in assertions.columns else F.lit(None).cast("string")))
    return x.withColumns({"slot_id": identity.key_id(*SLOT), "clock": times.clock(F.col("source_times")), "diagnostics": notes}).drop("unknown_chunk")


def group_problems(occ: DataFrame, groups: DataFrame) -> DataFrame:
    """code, ref of assertions whose signature has no group."""
    lost = occ.join(groups.select("signature_id"), "signature_id", "left_anti")
    return lost.select(F.lit("assertion_without_group").alias("code"), F.col("assertion_id").alias("ref"))


def grouped(occ: DataFrame, groups: DataFrame, strict: bool = True) -> DataFrame:
    """occ with the group_id of its signature; strict: every assertion has one, and no id repeats."""
    if strict:
        checks.unique(occ, "assertion_id", what="assertions")
        checks.unique(groups, "signature_id", what="group signatures")
        checks.require_empty(group_problems(occ, groups), "occurrences")
    return occ.join(groups.select("signature_id", F.col("signature_id").alias("group_id")), "signature_id")


def slot_order(occ: DataFrame) -> DataFrame:
    """slot_id, assertion_id, position from 1: parsed times of one kind first, by least time; others by their strings."""
    good = F.col("clock.kind").isin("aware", "naive")
    by = Window.partitionBy("slot_id").orderBy(F.when(good, 0).otherwise(1), F.when(good, F.col("clock.lo")), F.when(~good, F.array_join("source_times", ",")), "assertion_id")
    return occ.select("slot_id", "assertion_id", F.row_number().over(by).alias("position"))


def supersessions(proposals: DataFrame, occ: DataFrame, review: float = 0.80, strict: bool = True) -> DataFrame:
    """supersession_id, predecessor_id, successor_id, chronology, score, disposition. proposals: predecessor_id, successor_id, proposer,
    evidence_id, score."""
    for end in ("predecessor_id", "successor_id"):
        checks.known(proposals, end, occ, "assertion_id", "supersession assertion")
    key = ["predecessor_id", "successor_id"]
    s = proposals.dropDuplicates([*key, "evidence_id"]).groupBy(*key).agg(fuse(F.collect_list(F.struct("evidence_id", "score"))).alias("score"))
    side = lambda p, k: occ.select(F.col("assertion_id").alias(k), F.col("signature_id").alias(f"{p}_sig"), F.col("slot_id").alias(f"{p}_slot"), F.col("clock").alias(f"{p}_clock"))
    x = s.join(side("p", "predecessor_id"), "predecessor_id").join(side("s", "successor_id"), "successor_id")
    x = x.withColumn("chronology", times.chronology(F.col("p_clock"), F.col("s_clock")))
    ready = (F.col("score") >= review) & ((F.col("chronology") == "before") | F.lit(not strict))
    shown = F.when(F.col("p_sig") == F.col("s_sig"), "blocked_same_proposition").when(F.col("p_slot") != F.col("s_slot"), "blocked_slot_mismatch").when(F.col("chronology").isin("after", "same"), "blocked_chronology").when(ready, "review_required").otherwise("suggested")
    return x.select(identity.key_id(F.lit("supersession"), *key).alias("supersession_id"), *key, "chronology", "score", shown.alias("disposition"))
