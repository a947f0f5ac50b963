"""Arguments, signatures and semantic groups. Grouping never removes an occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, identity, text

SIGNATURE = ["subject", "predicate", "object", "polarity", "epistemic_type", "memory_class"]


def predicates(x: DataFrame, ontology: DataFrame | None = None, ascii_only: bool = False) -> DataFrame:
    """Adds predicate and polarity from `raw`; ontology: alias -> canonical, one hop after the negation is split off."""
    token = text.predicate_token(F.col("raw"), ascii_only)
    y = x.withColumn("_p", text.polarity(token)).withColumns({"predicate": F.col("_p.predicate"), "polarity": F.col("_p.polarity")}).drop("_p")
    if ontology is None:
        return y
    checks.unique(ontology, "alias", what="ontology aliases")
    return y.join(F.broadcast(ontology), F.col("predicate") == F.col("alias"), "left").withColumn("predicate", F.coalesce("canonical", "predicate")).drop("alias", "canonical")  # a curated list


def arguments(x: DataFrame, decisions: DataFrame, bound: DataFrame, aliases: DataFrame) -> DataFrame:
    """candidate_id, role, kind, value, basis, diagnostic: by decision, else a unique entity of the candidate's mentions of that
    text, else a unique alias, else the literal. x: candidate_id, role, text; decisions: candidate_id, role, entity_id; bound:
    candidate_id, text, entity_id; aliases: text, entity_id."""
    checks.unique(decisions, "candidate_id", "role", what="argument decisions")
    count = lambda c: (F.min(c).alias("low"), F.max(c).alias("high"))
    b = bound.groupBy("candidate_id", "text").agg(*count("entity_id")).select("candidate_id", "text", F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    a = aliases.groupBy("text").agg(*count("entity_id")).select("text", F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    y = x.join(decisions.select("candidate_id", "role", F.col("entity_id").alias("decided")), ["candidate_id", "role"], "left").join(b, ["candidate_id", "text"], "left").join(a, "text", "left")
    one = lambda s: F.when(F.col(f"{s}_low") == F.col(f"{s}_high"), F.col(f"{s}_low"))
    many = lambda s: F.col(f"{s}_low") < F.col(f"{s}_high")
    basis = F.when(F.col("decided").isNotNull(), "explicit").when(F.coalesce(many("b"), F.lit(False)), "literal").when(one("b").isNotNull(), "mention").when(F.coalesce(many("a"), F.lit(False)), "literal").when(one("a").isNotNull(), "alias").otherwise("literal")
    y = y.withColumn("basis", basis)
    value = F.when(F.col("basis") == "explicit", F.col("decided")).when(F.col("basis") == "mention", one("b")).when(F.col("basis") == "alias", one("a")).otherwise(F.col("text"))
    note = F.when(F.col("basis") != "literal", None).when(many("b"), "ambiguous_candidate_argument").when(many("a"), "ambiguous_registry_alias").otherwise("unresolved_literal_argument")
    return y.select("candidate_id", "role", F.when(F.col("basis") == "literal", "literal").otherwise("entity").alias("kind"), value.alias("value"), "basis", note.alias("diagnostic"))


def registry_aliases(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """text, entity_id: canonical names, aliases and display forms of active entities, normalised. aliases: entity_id, normalized,
    display_forms."""
    live = entities.where("status = 'active'").select("entity_id", F.col("canonical_name").alias("t"))
    forms = aliases.select("entity_id", F.explode(F.concat(F.array("normalized"), "display_forms")).alias("t")).join(live.select("entity_id"), "entity_id", "left_semi")
    return live.unionByName(forms).select(text.semantic_text(F.col("t")).alias("text"), "entity_id").where("text <> ''").distinct()


def decision_problems(decisions: DataFrame, entities: DataFrame, roots: DataFrame) -> DataFrame:
    """code, ref: two decisions for one argument, and decisions for entities that are not active. decisions: candidate_id, role, entity_id."""
    twice = checks.duplicates(decisions, "candidate_id", "role", what="argument_decided_twice").select(F.col("what").alias("code"), F.col("key").alias("ref"))
    r = roots.select(F.col("source").alias("entity_id"), "root")
    at = decisions.join(r, "entity_id", "left").select(F.coalesce("root", "entity_id").alias("entity_id"))
    return twice.unionByName(checks.unknown(at, "entity_id", entities.where("status = 'active'"), "entity_id", "argument_inactive_entity"))


def project(candidates: DataFrame, resolved: DataFrame, evidence: DataFrame) -> DataFrame:
    """A signed assertion per candidate with its scores, effective anchor and sorted evidence ids; a repeated candidate is an error.
    candidates: candidate_id, predicate, polarity, statement, epistemic_type, memory_class, the four scores, temporal (struct);
    resolved: of arguments(); evidence: candidate_id, evidence_id."""
    checks.unique(candidates, "candidate_id", what="candidates")
    side = lambda role: resolved.where(F.col("role") == role).select("candidate_id", F.col("value").alias(role), F.col("kind").alias(f"{role}_kind"), F.col("basis").alias(f"{role}_basis"))
    ids = evidence.groupBy("candidate_id").agg(F.sort_array(F.collect_set("evidence_id")).alias("evidence_ids"))
    x = candidates.join(side("subject"), "candidate_id").join(side("object"), "candidate_id").join(ids, "candidate_id", "left")
    x = x.withColumns({"assertion_id": F.col("candidate_id"), "evidence_ids": F.coalesce("evidence_ids", F.array().cast("array<string>"))})
    return signed(x)


def signed(assertions: DataFrame) -> DataFrame:
    return assertions.withColumn("signature_id", identity.key_id(*SIGNATURE))


def groups(assertions: DataFrame, members: bool = True, strict: bool = False) -> DataFrame:
    """A row per signature (its group_id) with the representative: highest origin, confidence, importance and durability, then least id.
    Members stay in the assertions; members=True lists them as well, strict=True refuses repeated ids."""
    best = F.min_by("assertion_id", F.struct(*(-F.col(c) for c in ("source_origin_probability", "extractor_confidence", "importance", "durability")), F.col("assertion_id")))
    listed = [F.sort_array(F.collect_list("assertion_id")).alias("assertion_ids")] if members else []
    checks.unique(assertions, "assertion_id", what="assertions") if strict else None
    return assertions.groupBy("signature_id", *SIGNATURE).agg(F.count(F.lit(1)).alias("n"), best.alias("representative"), F.max(0.6 * F.col("importance") + 0.4 * F.col("durability")).alias("impact"), *listed)
