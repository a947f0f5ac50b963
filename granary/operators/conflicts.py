"""Effective intervals and conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times


def intervals(anchors: DataFrame) -> DataFrame:
    """Adds lo and hi (days since 1970) from start, end, precision and is_proxy. In steps whose columns are used more than once,
    so that the planner keeps them apart and each compiles."""
    x = anchors.withColumn("_lo", times.bound(F.col("start"), False)).withColumn("_till", times.until(F.col("start"), F.col("end"), F.col("precision")))
    x = x.withColumn("_hi", times.bound(F.col("_till"), True))
    usable = ~F.coalesce("is_proxy", F.lit(False)) & ~F.col("precision").isin("relative", "unknown") & F.col("_lo").isNotNull() & F.col("_hi").isNotNull() & (F.col("_hi") >= F.col("_lo"))
    x = x.withColumn("_ok", usable)
    return x.withColumns({"lo": F.when(F.col("_ok"), F.unix_date("_lo")), "hi": F.when(F.col("_ok"), F.unix_date("_hi"))}).drop("_lo", "_till", "_hi", "_ok")


def merged(anchors: DataFrame) -> DataFrame:
    """A group's overlapping intervals as one, so that pairs of groups are compared on few. anchors: group_id, lo, hi."""
    by = Window.partitionBy("group_id").orderBy("lo", "hi")
    x = anchors.where("lo is not null").withColumn("reach", F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("run", F.sum(F.when(F.col("lo") <= F.col("reach"), 0).otherwise(1)).over(by))
    return x.groupBy("group_id", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def compare(pairs: DataFrame, anchors: DataFrame) -> DataFrame:
    """left_group_id, right_group_id, relation: overlap if any anchors do, else unknown if any is open or a side has none, else
    disjoint. anchors: group_id, lo, hi."""
    anchors = anchors.select("group_id", "lo", "hi").distinct()
    facts = anchors.groupBy("group_id").agg(F.bool_or(F.col("lo").isNull()).alias("open"))
    key = ["left_group_id", "right_group_id"]
    m = merged(anchors)
    side = lambda s: m.select(F.col("group_id").alias(f"{s}_group_id"), F.col("lo").alias(f"{s}_lo"), F.col("hi").alias(f"{s}_hi"))
    hit = pairs.join(side("left"), "left_group_id").join(side("right"), "right_group_id").where("left_lo <= right_hi and right_lo <= left_hi").select(*key).distinct().withColumn("hit", F.lit(True))
    f = lambda s: facts.select(F.col("group_id").alias(f"{s}_group_id"), F.col("open").alias(f"{s}_open"))
    x = pairs.join(hit, key, "left").join(f("left"), "left_group_id", "left").join(f("right"), "right_group_id", "left")
    relation = F.when(F.col("hit"), "overlap").when(F.col("left_open").isNull() | F.col("right_open").isNull() | F.col("left_open") | F.col("right_open"), "unknown").otherwise("disjoint")
    return x.select(*key, relation.alias("relation"), (F.col("left_open").isNull() | F.col("right_open").isNull()).alias("missing"))


def superseded_pairs(supersessions: DataFrame, occ: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(left_group_id, right_group_id, supersession_ids) of reviewable supersessions between two groups, and (code, ref) of those whose
    assertion has no group. supersessions: supersession_id, predecessor_id, successor_id, disposition; occ: assertion_id, group_id."""
    side = lambda p, k: occ.select(F.col("assertion_id").alias(k), F.col("group_id").alias(p)).distinct()
    x = supersessions.where("disposition = 'review_required'").join(side("p", "predecessor_id"), "predecessor_id", "left").join(side("s", "successor_id"), "successor_id", "left")
    lost = x.where("p is null or s is null").select(F.lit("supersession_missing_group").alias("code"), F.col("supersession_id").alias("ref"))
    pairs = x.where("p <> s").groupBy(F.least("p", "s").alias("left_group_id"), F.greatest("p", "s").alias("right_group_id"))
    return pairs.agg(F.sort_array(F.collect_set("supersession_id")).alias("supersession_ids")), lost


def conflicts(relations: DataFrame, anchors: DataFrame, superseded: DataFrame, review: float = 0.80) -> DataFrame:
    """left_group_id, right_group_id, kind, effective_relation, score, relation_ids, supersession_ids, disposition, diagnostic. relations:
    source_group_id, target_group_id, relation_type, score and, if there, relation_id; superseded: pairs, and their
    supersession_ids if there."""
    key = ["left_group_id", "right_group_id"]
    r = relations.where(F.col("relation_type").isin("polarity_opposes", "contradicts")).withColumns({"left_group_id": F.least("source_group_id", "target_group_id"), "right_group_id": F.greatest("source_group_id", "target_group_id")})
    r = r if "relation_id" in r.columns else r.withColumn("relation_id", F.lit(None).cast("string"))
    s = r.groupBy(*key).agg(F.bool_or(F.col("relation_type") == "polarity_opposes").alias("polar"), F.max("score").alias("score"), F.sort_array(F.collect_set("relation_id")).alias("relation_ids"))
    ids = F.col("supersession_ids") if "supersession_ids" in superseded.columns else F.array().cast("array<string>")
    changed = superseded.select(*key, ids.alias("supersession_ids"), F.lit(True).alias("changed")).dropDuplicates(key)
    x = s.join(compare(s.select(*key), anchors), key).join(changed, key, "left")
    shown = F.when(F.col("changed"), "change_over_time_candidate").when(F.col("relation") == "disjoint", "temporally_disjoint").when(F.col("relation") == "unknown", "unknown_temporal").when(F.col("score") >= review, "review_required").otherwise("suggested")
    return x.select(*key, F.when(F.col("polar"), "polarity_opposition").otherwise("semantic_contradiction").alias("kind"), F.col("relation").alias("effective_relation"), "score", "relation_ids", F.coalesce("supersession_ids", F.array().cast("array<string>")).alias("supersession_ids"), shown.alias("disposition"), F.when(F.col("missing"), "missing_temporal_occurrence").alias("diagnostic"))
