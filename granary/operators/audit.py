"""Audit metrics and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rates: metric -> (numerator, denominator).
RATES = {
    "quarantine_rate": ("candidates_quarantined", "candidates_total"),
    "unresolved_entity_hypotheses_per_entity": ("unresolved_entity_hypotheses", "active_entities"),
    "missing_source_time_rate": ("missing_source_time_occurrences", "temporal_occurrences"),
    "third_tier_review_rate": ("third_tier_review_items", "review_items"),
    "staging_block_rate": ("staging_candidates_blocked", "staging_candidates_total"),
}


def rate(a: Column, b: Column) -> Column:
    """0 of 0 is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def count(df: DataFrame, **conditions: Column) -> DataFrame:
    """metric, value rows from one pass over a table."""
    x = df.agg(*(F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("double").alias(k) for k, c in conditions.items()))
    return x.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in conditions))).alias("m")).select("m.*")


def metrics(*counts: DataFrame) -> DataFrame:
    """All counts, and the rates that they allow."""
    x = counts[0]
    for c in counts[1:]:
        x = x.unionByName(c)
    wide = x.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))  # a row per metric: bounded
    names = F.array(*(F.struct(F.lit(k).alias("metric"), rate(F.col("m")[a], F.col("m")[b]).alias("value"), F.col("m")[a].isNotNull().alias("there")) for k, (a, b) in RATES.items()))
    return x.unionByName(wide.select(F.explode(names).alias("r")).select("r.*").where("there").drop("there"))


def report(stages: dict[str, DataFrame]) -> DataFrame:
    """All 25 metrics of a run: 20 counts, each stage's in one pass, and 5 rates. stages: dispositions, entities, hypotheses, groups,
    assertions, relations, occurrences, conflicts, cards, queue, eligibility, staged (relations)."""
    yes, at = F.lit(True), F.col
    return metrics(
        count(stages["dispositions"], candidates_total=yes, candidates_accepted=at("accepted"), candidates_quarantined=~at("accepted")),
        count(stages["entities"], active_entities=at("status") == "active"),
        count(stages["hypotheses"], unresolved_entity_hypotheses=at("disposition") != "blocked"),
        count(stages["groups"], semantic_groups=yes),
        count(stages["assertions"], normalized_assertions=yes),
        count(stages["relations"], compiled_relations=yes),
        count(stages["occurrences"], temporal_occurrences=yes, missing_source_time_occurrences=F.size("source_times") == 0),
        count(stages["conflicts"], conflicts=yes),
        count(stages["cards"], synthesis_cards=yes),
        count(stages["queue"], review_items=yes, first_tier_review_items=at("route") == 1, second_tier_review_items=at("route") == 2, third_tier_review_items=at("route") == 3),
        count(stages["eligibility"], staging_candidates_total=yes, staging_candidates_eligible=at("eligibility") == "eligible", staging_candidates_blocked=at("eligibility") != "eligible"),
        count(stages["staged"], staging_relations_eligible=yes),
    )


def findings(found: DataFrame, limits: dict[str, float | None]) -> DataFrame:
    """metric, observed, max_allowed where a limit is exceeded; equal passes."""
    spec = F.create_map(*(F.lit(v) for k, x in limits.items() if x is not None for v in (k, float(x)))) if any(x is not None for x in limits.values()) else F.create_map().cast("map<string,double>")
    return found.withColumn("max_allowed", spec[F.col("metric")]).where("value > max_allowed").select("metric", F.col("value").alias("observed"), "max_allowed")


def status(found: DataFrame) -> str:
    return "pass" if found.isEmpty() else "fail"
