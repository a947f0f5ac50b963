"""Routing by consequence, and adjudication by authority."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks, identity
from ..functions.scores import clamp

#: Severity of a kind.
SEVERITY = {"entity_resolution": 0.58, "relation": 0.46, "supersession": 0.76, "conflict": 0.86, "projection_diagnostic": 0.34}


@dataclass(frozen=True)
class Policy:
    second_tier_priority: float = 0.58
    third_tier_priority: float = 0.84
    third_tier_impact: float = 0.82
    high_centrality: int = 8

    def __post_init__(self):
        checks.shares(self)
        if self.high_centrality < 1:
            raise ValueError("high_centrality counts propositions")


def entity_impact(max_impact: Column, n_props: Column, policy: Policy = Policy()) -> Column:
    return clamp(0.55 * F.coalesce(max_impact, F.lit(0.0)) + 0.45 * F.least(F.lit(1.0), n_props / policy.high_centrality))


def group_entities(groups: DataFrame) -> DataFrame:
    """group_id, entity_id of entity arguments. groups: group_id, subject, subject_kind, object, object_kind."""
    side = lambda r: groups.where(F.col(f"{r}_kind") == "entity").select("group_id", F.col(r).alias("entity_id"))
    return side("subject").unionByName(side("object")).distinct()


def _sized_groups(groups: DataFrame) -> DataFrame:
    """k (the packed group_id), impact, entity_ids. groups: group_id, impact, arguments."""
    own = F.array_compact(F.array(*(F.when(F.col(f"{r}_kind") == "entity", F.col(r)) for r in ("subject", "object"))))
    return groups.groupBy(identity.packed_key("group_id").alias("k")).agg(F.max("impact").alias("impact"), F.flatten(F.collect_set(own)).alias("entity_ids"))


def _sized_pairs(links: DataFrame, sized: DataFrame) -> DataFrame:
    """source_ref, impact, group_ids, entity_ids of a link's two groups; what nobody reads is not gathered. sized: k, impact, entity_ids."""
    ends = links.select("source_ref", F.explode(F.array_distinct(F.array(*(identity.packed(F.col(c)) for c in ("left_group_id", "right_group_id"))))).alias("k"))
    x = ends.join(sized, "k", "left").groupBy("source_ref")
    ids = F.sort_array(F.transform(F.collect_set("k"), identity.unpacked))
    return x.agg(F.coalesce(F.max("impact"), F.lit(0.0)).alias("impact"), ids.alias("group_ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("entity_ids")))).alias("entity_ids"))


def pair_impact(links: DataFrame, groups: DataFrame) -> DataFrame:
    """source_ref, impact (the greater of its two groups'; 0 for unknown ones), group_ids. links: source_ref, left_group_id,
    right_group_id; groups: group_id, impact."""
    sized = groups.select(identity.packed_key("group_id").alias("k"), "impact", F.array().cast("array<string>").alias("entity_ids"))
    return _sized_pairs(links, sized).drop("entity_ids")


def items(hypotheses: DataFrame, relations: DataFrame, supersessions: DataFrame, conflicts: DataFrame, notes: DataFrame, cards: DataFrame, groups: DataFrame, members: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Signals of all six sources for queue(): kind, source_ref, score, impact, disposition, unknown, code, entity_ids, group_ids.
    hypotheses: hypothesis_id, entity_id, score, disposition; relations, supersessions, conflicts: of K06 to K08 with ids; notes:
    (code, ref, entity_id) of K09; cards: entity_id, max_impact, n_props, diagnostics; groups: group_id, impact, arguments;
    members: assertion_id, group_id."""
    no, none = F.lit(False), F.array().cast("array<string>")
    by_entity = cards.select("entity_id", entity_impact(F.col("max_impact"), F.col("n_props"), policy).alias("impact"))
    sized = _sized_groups(groups)

    def of_entities(x: DataFrame) -> DataFrame:  # source_ref, entity_id, score, disposition, code
        y = x.join(by_entity, "entity_id", "left").withColumns({"impact": F.coalesce("impact", F.lit(0.0)), "entity_ids": F.array_compact(F.array("entity_id"))})
        return y.withColumns({"unknown": no, "group_ids": none})

    def of_groups(x: DataFrame) -> DataFrame:  # source_ref, left_group_id, right_group_id, score, disposition, unknown
        return x.join(_sized_pairs(x, sized), "source_ref").withColumn("code", F.lit(None).cast("string"))

    # an assertion is sized once; its supersessions then carry numbers instead of ids of groups
    of = members.select("assertion_id", identity.packed(F.col("group_id")).alias("k")).join(sized, "k", "left")
    at = lambda end, name: of.select(F.col("assertion_id").alias(end), *(F.col(c).alias(f"{name}_{c}") for c in ("k", "impact", "entity_ids")))
    s = supersessions.join(at("predecessor_id", "left"), "predecessor_id", "left").join(at("successor_id", "right"), "successor_id", "left")
    both = lambda c: F.array_compact(F.array(f"left_{c}", f"right_{c}"))
    s = s.select(
        F.col("supersession_id").alias("source_ref"), "score", "disposition", (F.col("chronology") == "unknown").alias("unknown"), F.lit(None).cast("string").alias("code"), F.coalesce(F.greatest("left_impact", "right_impact"), F.lit(0.0)).alias("impact"),
        F.sort_array(F.transform(F.array_distinct(both("k")), identity.unpacked)).alias("group_ids"), F.array_sort(F.array_distinct(F.flatten(both("entity_ids")))).alias("entity_ids"),
    )
    parts = {
        "entity_resolution": of_entities(hypotheses.select(F.col("hypothesis_id").alias("source_ref"), "entity_id", "score", "disposition", F.lit(None).cast("string").alias("code"))),
        "relation": of_groups(relations.select(F.col("relation_id").alias("source_ref"), F.col("source_group_id").alias("left_group_id"), F.col("target_group_id").alias("right_group_id"), "score", "disposition", no.alias("unknown"))),
        "supersession": s,
        "conflict": of_groups(conflicts.select(F.col("conflict_id").alias("source_ref"), "left_group_id", "right_group_id", "score", "disposition", (F.col("effective_relation") == "unknown").alias("unknown"))),
    }
    seen = notes.select(F.concat_ws(":", "code", "ref").alias("source_ref"), "entity_id", F.lit(0.5).alias("score"), F.lit("diagnostic").alias("disposition"), F.lit(None).cast("string").alias("code"))
    card = cards.select("entity_id", F.explode("diagnostics").alias("code")).select(F.concat_ws(":", "entity_id", "code").alias("source_ref"), "entity_id", F.lit(0.5).alias("score"), F.lit("diagnostic").alias("disposition"), "code")
    columns = ["kind", "source_ref", "score", "impact", "disposition", "unknown", "code", "entity_ids", "group_ids"]
    out = None
    for kind, x in [*parts.items(), ("projection_diagnostic", of_entities(seen)), ("projection_diagnostic", of_entities(card))]:
        x = x.withColumn("kind", F.lit(kind)).select(*columns)
        out = x if out is None else out.unionByName(x)
    return out


def ambiguity(kind: Column, score: Column, unknown: Column, code: Column) -> Column:
    open_ = clamp(1 - score)
    wider = clamp(open_ + F.when(F.coalesce(unknown, F.lit(False)) & kind.isin("supersession", "conflict"), 0.25).otherwise(0.0))
    # diagnostics of cards have a code of their own; those of projections none
    return F.when(kind != "projection_diagnostic", wider).when(code.isNull(), 0.70).when(code == "latest_observed_not_unique", 0.65).otherwise(0.50)


def queue(signals: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """review_item_id, kind, source_ref, ambiguity, impact, priority, route, reason. signals: kind, source_ref, score, impact,
    disposition, unknown (time), code. Signals that need no review drop out; equal items are one."""
    drop = ((F.col("kind") == "entity_resolution") & (F.col("disposition") == "blocked")) | ((F.col("kind") == "relation") & (F.col("disposition") == "structural")) | ((F.col("kind") == "supersession") & ~F.col("disposition").isin("suggested", "review_required")) | ((F.col("kind") == "conflict") & (F.col("disposition") == "temporally_disjoint"))
    x = signals.where(~F.coalesce(drop, F.lit(False)))
    x = x.withColumn("score", F.when(F.col("kind") == "projection_diagnostic", 0.5).otherwise(F.col("score"))).withColumn("ambiguity", ambiguity(F.col("kind"), F.col("score"), F.col("unknown"), F.col("code")))
    severity = F.create_map(*(F.lit(v) for kv in SEVERITY.items() for v in kv))[F.col("kind")]
    x = x.withColumn("priority", clamp(0.45 * F.col("impact") + 0.25 * F.col("ambiguity") + 0.30 * severity))
    high = F.col("kind").isin("entity_resolution", "supersession", "conflict") & (F.col("impact") >= policy.third_tier_impact)
    third, second = F.col("priority") >= policy.third_tier_priority, F.col("kind").isin("supersession", "conflict") | (F.col("priority") >= policy.second_tier_priority)
    route = F.when(high | third, 3).when(second, 2).otherwise(1)
    reason = F.when(high, "high_consequence_high_impact").when(third, "priority_exceeds_third_tier_threshold").when(second, "semantic_adjudication_required")
    return x.select(identity.key_id("kind", "source_ref").alias("review_item_id"), "kind", "source_ref", "score", "ambiguity", "impact", "priority", route.alias("route"), reason.alias("reason")).dropDuplicates(["review_item_id"])


def adjudicate(items: DataFrame, responses: DataFrame, strict: bool = True) -> DataFrame:
    """review_item_id, disposition, controlling (response). Final answers of the highest sufficient authority decide; a tie of
    both kinds stays open; without final answers escalation beats deferral."""
    if strict:
        checks.known(responses, "review_item_id", items, "review_item_id", "review item")
    r = responses.join(items.select("review_item_id", "route"), "review_item_id").where("authority >= route")
    final = F.col("decision").isin("accept", "reject")
    r = r.withColumn("rank", F.dense_rank().over(Window.partitionBy("review_item_id").orderBy(F.when(final, 0).otherwise(1), F.desc("authority")))).where("rank = 1")
    least = lambda d: F.min(F.when(F.col("decision") == d, F.col("response_id")))
    x = r.groupBy("review_item_id").agg(*(least(d).alias(d) for d in ("accept", "reject", "escalate", "defer")))
    y = items.select("review_item_id").join(x, "review_item_id", "left")
    has = lambda d: F.col(d).isNotNull()
    shown = F.when(has("accept") & has("reject"), "pending").when(has("accept"), "accepted").when(has("reject"), "rejected").when(has("escalate"), "escalated").when(has("defer"), "deferred").otherwise("pending")
    ruling = F.when(has("accept") & has("reject"), None).otherwise(F.coalesce("accept", "reject", "escalate", "defer"))
    why = F.when(has("accept") & has("reject"), "conflicting_same_authority_final_responses").when(ruling.isNull(), "no_response_with_required_authority")
    return y.select("review_item_id", shown.alias("disposition"), ruling.alias("controlling"), why.alias("reason"))
