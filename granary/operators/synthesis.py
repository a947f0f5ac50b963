"""Views per entity. A card names no current truth; the latest are a set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks, text


def latest(occ: DataFrame) -> DataFrame:
    """Occurrences of an entity that are not strictly before another of the same clock kind. occ: entity_id, assertion_id,
    kind (aware, naive or other), lo, hi. A window's maximum instead of pairs."""
    comparable = F.col("kind").isin("aware", "naive")
    x = occ.withColumn("last", F.max(F.when(comparable, F.col("lo"))).over(Window.partitionBy("entity_id", "kind")))
    return x.where(~comparable | (F.col("hi") >= F.col("last"))).drop("last")


def roles(assertions: DataFrame) -> DataFrame:
    """entity_id, signature_id, role of entity arguments. assertions: signature_id, subject, subject_kind, object, object_kind."""
    side = lambda s: assertions.where(F.col(f"{s}_kind") == "entity").select(F.col(s).alias("entity_id"), "signature_id", F.lit(s).alias("role"))
    x = side("subject").unionByName(side("object")).groupBy("entity_id", "signature_id").agg(F.min("role").alias("a"), F.max("role").alias("b"))
    return x.select("entity_id", "signature_id", F.when(F.col("a") != F.col("b"), "both").otherwise(F.col("a")).alias("role"))


def group_map(groups: DataFrame, strict: bool = True) -> DataFrame:
    """assertion_id, group_id; an assertion in two groups is an error. groups: group_id, assertion_ids."""
    x = groups.select("group_id", F.explode("assertion_ids").alias("assertion_id")).distinct()
    if strict:
        checks.unique(x, "assertion_id", what="groups of an assertion")
    return x.select("assertion_id", "group_id")


def reference_problems(groups: DataFrame, members: DataFrame, occ: DataFrame, relations: DataFrame, conflicts: DataFrame, supersessions: DataFrame) -> DataFrame:
    """code, ref (of the row that refers) for references out of the inputs. groups: group_id; members: assertion_id; occ:
    assertion_id, group_id; relations: relation_id, source_group_id, target_group_id; conflicts: conflict_id, left_group_id,
    right_group_id; supersessions: supersession_id, predecessor_id, successor_id."""

    def lost(df: DataFrame, ref: str, ends: list[str], known: DataFrame, key: str, code: str) -> DataFrame:
        x = df.select(F.col(ref).cast("string").alias("ref"), F.explode(F.array(*ends)).alias("end")).where("end is not null")
        return x.join(known.select(F.col(key).alias("end")).distinct(), "end", "left_anti").select(F.lit(code).alias("code"), "ref").distinct()

    out = lost(occ, "assertion_id", ["group_id"], groups, "group_id", "occurrence_unknown_group")
    out = out.unionByName(lost(relations, "relation_id", ["source_group_id", "target_group_id"], groups, "group_id", "relation_unknown_group"))
    out = out.unionByName(lost(conflicts, "conflict_id", ["left_group_id", "right_group_id"], groups, "group_id", "conflict_unknown_group"))
    return out.unionByName(lost(supersessions, "supersession_id", ["predecessor_id", "successor_id"], members, "assertion_id", "supersession_unknown_assertion"))


def edges(links: DataFrame, name: str) -> DataFrame:
    """group_id and the sorted ids of links at either end. links: id, left_group_id, right_group_id."""
    ends = links.select("id", F.explode(F.array("left_group_id", "right_group_id")).alias("group_id")).where("group_id is not null")
    return ends.groupBy("group_id").agg(F.sort_array(F.collect_set("id")).alias(name))


def propositions(role: DataFrame, groups: DataFrame, statements: DataFrame, occ: DataFrame) -> DataFrame:
    """entity_id, group_id, role, representative, statement (a placeholder where it is missing), missing, assertion_ids,
    occurrence_ids, impact. role: entity_id, group_id, role; groups: group_id, representative, assertion_ids, impact; statements:
    candidate_id, statement; occ: group_id, occurrence_id."""
    seen = occ.groupBy("group_id").agg(F.sort_array(F.collect_set("occurrence_id")).alias("occurrence_ids"))
    s = statements.select(F.col("candidate_id").alias("representative"), "statement").dropDuplicates(["representative"])
    x = role.join(groups, "group_id").join(s, "representative", "left").join(seen, "group_id", "left")
    shown = F.coalesce("statement", F.concat(F.lit("(no statement of "), "representative", F.lit(")")))
    return x.select("entity_id", "group_id", "role", "representative", shown.alias("statement"), F.col("statement").isNull().alias("missing"), "assertion_ids", F.coalesce("occurrence_ids", F.array().cast("array<string>")).alias("occurrence_ids"), "impact")


def views(props: DataFrame) -> DataFrame:
    """entity_id and its propositions as one sorted array of records."""
    record = F.struct("group_id", "role", "representative", "statement", "assertion_ids", "occurrence_ids")
    return props.groupBy("entity_id").agg(F.array_sort(F.collect_list(record)).alias("propositions"))


def alias_list(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """entity_id, aliases: normalised and display forms without the canonical name, in order of their lower case. aliases:
    entity_id, normalized, display_forms."""
    a = aliases.groupBy("entity_id").agg(F.flatten(F.collect_list(F.concat(F.array("normalized"), "display_forms"))).alias("all"))
    x = entities.select("entity_id", "canonical_name").join(a, "entity_id", "left")
    return x.select("entity_id", text.label_order(F.array_except(F.coalesce("all", F.array().cast("array<string>")), F.array("canonical_name"))).alias("aliases"))


def cards(entities: DataFrame, role: DataFrame, group: DataFrame, occ: DataFrame, hypotheses: DataFrame | None = None) -> DataFrame:
    """A card per active entity, with or without propositions. entities: entity_id, canonical_name, status; role: of roles();
    group: signature_id, n, representative, impact; occ: of latest()'s input; hypotheses: entity_id, disposition."""
    props = role.join(group, "signature_id").groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_props"), F.sum("n").alias("n_occ"), F.max("impact").alias("max_impact"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))
    last = latest(occ).groupBy("entity_id").agg(F.count(F.lit(1)).alias("latest_count"))
    x = entities.where("status = 'active'").join(props, "entity_id", "left").join(last, "entity_id", "left")
    open_ = hypotheses.where("disposition <> 'blocked'").groupBy("entity_id").agg(F.count(F.lit(1)).alias("unresolved")) if hypotheses is not None else None
    x = x.join(open_, "entity_id", "left") if open_ is not None else x.withColumn("unresolved", F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return x.select("entity_id", "canonical_name", zero("n_props"), zero("n_occ"), F.coalesce("roles", F.lit("")).alias("roles"), zero("latest_count"), zero("unresolved"), F.coalesce("max_impact", F.lit(0.0)).alias("max_impact"), F.when(F.col("latest_count") > 1, "latest_observed_not_unique").alias("diagnostic"))


def whole_cards(card: DataFrame, props: DataFrame, aliases: DataFrame, occ: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """Cards with their records: aliases, propositions, latest occurrences, and the ids of relations, conflicts and supersessions of
    their groups. links: column -> group_id and ids, as edges() gives them."""
    none = F.array().cast("array<string>")
    x = card.join(alias_list(card, aliases), "entity_id", "left").join(views(props), "entity_id", "left")
    x = x.join(latest(occ).groupBy("entity_id").agg(F.sort_array(F.collect_set("assertion_id")).alias("latest_ids")), "entity_id", "left")
    for name, ids in links.items():
        mine = props.select("entity_id", "group_id").distinct().join(ids, "group_id").groupBy("entity_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name))
        x = x.join(mine, "entity_id", "left").withColumn(name, F.coalesce(name, none))
    gaps = props.groupBy("entity_id").agg(F.bool_or("missing").alias("gap"))
    codes = F.array_compact(F.array("diagnostic", F.when(F.col("gap"), "missing_representative_statement")))
    return x.join(gaps, "entity_id", "left").withColumn("diagnostics", F.array_sort(codes)).drop("gap")
