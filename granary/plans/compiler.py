"""The stages K01 to K13 wired over conversations: a function of tables, each result written before the next stage reads it."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text
from ..operators import audit, conflicts, extraction, mentions, normalization, relations, resolution, review, staging, synthesis, temporal, validation

STAGES = ["candidates", "diagnostics", "dispositions", "mention_index", "bindings", "entities", "aliases", "hypotheses", "assertions", "groups", "relations", "occurrences", "slots", "supersessions", "conflicts", "cards", "queue", "adjudications", "eligibility", "staged", "records", "metrics", "builds"]

EMPTY = {
    "links": "mention_key_id string, entity_id string",
    "proposals": "mention_key_id string, entity_id string, evidence_id string, score double",
    "relation_proposals": "source_group_id string, target_group_id string, relation_type string, proposer string, evidence_id string, score double",
    "supersession_proposals": "predecessor_id string, successor_id string, proposer string, evidence_id string, score double",
    "responses": "review_item_id string, response_id string, authority int, decision string",
    "bindings": "mention_key_id string, entity_id string",
    "entities": "entity_id string, entity_type string, canonical_name string, anchor_mention_key_id string, status string",
    "aliases": "entity_id string, normalized string, display_forms array<string>, mention_key_ids array<string>",
}


def run(
    spark: SparkSession, chunks: DataFrame, root: str, backend: extraction.Backend | None = None, prior: dict[str, DataFrame] | None = None, decisions: list[dict] | None = None,
    inputs: dict[str, DataFrame] | None = None, capability: staging.Capability | None = None, strict: bool = True,
) -> dict[str, DataFrame]:
    """K01 to K13 over chunks; every table is a folder under root. prior: bindings, entities and aliases of an earlier run; decisions:
    the log that fold() applies; inputs: proposals, relation_proposals, supersession_proposals and responses, each empty if absent.
    A candidate's temporal columns (start, end, precision, is_proxy) come from the backend, if it gives them.
    strict: broken references raise; otherwise they show as diagnostics."""
    out: dict[str, DataFrame] = {}

    def given(name: str) -> DataFrame:
        found = (inputs or {}).get(name)
        return found if found is not None else (prior or {}).get(name, spark.createDataFrame([], EMPTY[name]))

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
        return out[name]

    # K01, K02
    c = keep("candidates", extraction.compile(chunks, backend or extraction.SentenceRules(), strict))
    defaults = {"source_origin_probability": F.lit(1.0), "extractor_confidence": F.lit(1.0), "importance": F.lit(0.5), "durability": F.lit(0.5), "is_proxy": F.lit(False), "start": F.lit(None).cast("string"), "end": F.lit(None).cast("string"), "precision": F.lit("unknown"), "statement": F.col("exact_text"), "source_type": F.lit("chat")}
    rated = c.withColumns({k: v for k, v in defaults.items() if k not in c.columns})
    numbered = rated.withColumn("position", F.xxhash64("chunk_id", "exact_text"))  # repeats of an id are ordered by content
    found = keep("diagnostics", validation.diagnostics(chunks, numbered, rated))
    shown = keep("dispositions", validation.dispositions(numbered, found))
    ok = shown.where("accepted").select("candidate_id").distinct()
    good = rated.join(ok, "candidate_id", "left_semi").dropDuplicates(["candidate_id"])
    # K03, K04
    m = good.select(F.col("candidate_id").alias("mention_id"), F.col("subject").alias("mention_text"), F.lit(None).cast("string").alias("entity_type_hint"), F.lit(None).cast("string").alias("canonical_hint"))
    index = keep("mention_index", mentions.index(m))
    keys = index.withColumn("mention_key_id", identity.key_id("normalized_text", F.coalesce("entity_type_hint", F.lit(""))))
    old = given("entities")
    registry = resolution.fold(decisions or [], {r["entity_id"]: r["entity_type"] for r in old.select("entity_id", "entity_type").collect()} if decisions else {})
    roots = registry.roots(spark)
    links = spark.createDataFrame(sorted(registry.links.items()), EMPTY["links"])
    known = resolution.alias_index(given("aliases").select(F.col("normalized").alias("alias"), "entity_id"), old.where("status = 'active'"), roots)
    first = resolution.bindings(keys.withColumn("normalized_text", text.entity_name(F.col("normalized_text"))), given("bindings"), links, known, roots=roots, entities=old)
    bound = keep("bindings", resolution.rebind(first, registry).join(keys.select("mention_key_id", "normalized_text"), "mention_key_id"))
    new = resolution.seeds(first, keys.select("mention_key_id", "entity_type_hint", "display_forms"))
    entities = keep("entities", resolution.entity_table(old.select(new.columns).unionByName(new).dropDuplicates(["entity_id"]), roots, registry.names))
    forms = bound.join(keys.select("mention_key_id", F.explode("display_forms").alias("display_form")), "mention_key_id").select("entity_id", text.entity_name(F.col("normalized_text")).alias("normalized"), "display_form", "mention_key_id")
    before = given("aliases").select("entity_id", "normalized", F.explode_outer("display_forms").alias("display_form"), "mention_key_ids").select("entity_id", "normalized", "display_form", F.explode_outer("mention_key_ids").alias("mention_key_id"))
    aliases = keep("aliases", resolution.alias_table(before, forms, roots))
    guesses = resolution.resolve(keys, bound, entities, aliases.select("entity_id", "normalized"), given("proposals"), registry)
    hyp = keep("hypotheses", guesses.withColumn("hypothesis_id", identity.key_id(F.lit("hypothesis"), "mention_key_id", "entity_id")))
    # K05
    p = normalization.predicates(good.withColumn("raw", F.col("predicate")).drop("predicate"))
    sides = p.select("candidate_id", F.explode(F.array(*(F.struct(F.lit(r).alias("role"), F.col(r).alias("text")) for r in ("subject", "object")))).alias("a")).select("candidate_id", "a.role", text.semantic_text(F.col("a.text")).alias("text"))
    own = p.select("candidate_id", text.mention_text(F.col("subject")).alias("normalized_text"), text.semantic_text(F.col("subject")).alias("text")).join(bound.select("normalized_text", "entity_id"), "normalized_text").select("candidate_id", "text", "entity_id")
    none = spark.createDataFrame([], "candidate_id string, role string, entity_id string")
    args = normalization.arguments(sides, none, own, normalization.registry_aliases(entities, aliases))
    p = p.drop("subject", "object").withColumns({"epistemic_type": F.lit("user_statement"), "memory_class": F.lit("other"), "temporal": F.struct("start", "end", "precision", "is_proxy")})
    evidence = good.select("candidate_id", identity.key_id("chunk_id", "exact_text").alias("evidence_id"))
    a = keep("assertions", normalization.project(p, args, evidence))
    g = keep("groups", normalization.groups(a, strict=strict).withColumn("group_id", F.col("signature_id")))
    members = synthesis.group_map(g, strict)
    # K06 to K08
    r = keep("relations", relations.compile(given("relation_proposals"), relations.opposition(g), g))
    occ = temporal.occurrences(a, good.select(F.col("candidate_id").alias("assertion_id"), "chunk_id"), chunks)
    occ = keep("occurrences", temporal.grouped(occ, g, strict))
    keep("slots", temporal.slot_order(occ))
    sup = keep("supersessions", temporal.supersessions(given("supersession_proposals"), occ))
    anchors = conflicts.intervals(occ.select("group_id", "start", "end", "precision", "is_proxy")).select("group_id", "lo", "hi")
    pairs, lost = conflicts.superseded_pairs(sup, occ)
    k = keep("conflicts", conflicts.conflicts(r, anchors, pairs).withColumn("conflict_id", identity.key_id(F.lit("conflict"), "left_group_id", "right_group_id")))
    # K09
    kinds = a.select("signature_id", "subject_kind", "object_kind").dropDuplicates(["signature_id"])
    g2 = g.join(kinds, "signature_id")
    role = synthesis.roles(a)
    views = role.join(occ.select("signature_id", "assertion_id", F.col("clock.kind").alias("kind"), F.col("clock.lo").alias("lo"), F.col("clock.hi").alias("hi")), "signature_id").select("entity_id", "assertion_id", "kind", "lo", "hi")
    props = synthesis.propositions(role.withColumnRenamed("signature_id", "group_id"), g, a.select("candidate_id", "statement"), occ.select("group_id", F.col("assertion_id").alias("occurrence_id")))
    ends = lambda df, i, l, s: df.select(F.col(i).alias("id"), F.col(l).alias("left_group_id"), F.col(s).alias("right_group_id"))
    at = lambda end, name: members.select(F.col("assertion_id").alias(end), F.col("group_id").alias(name))
    sup_ends = sup.join(at("predecessor_id", "p"), "predecessor_id", "left").join(at("successor_id", "s"), "successor_id", "left")
    tied = {
        "relation_ids": synthesis.edges(ends(r, "relation_id", "source_group_id", "target_group_id"), "relation_ids"),
        "conflict_ids": synthesis.edges(ends(k, "conflict_id", "left_group_id", "right_group_id"), "conflict_ids"),
        "supersession_ids": synthesis.edges(ends(sup_ends, "supersession_id", "p", "s"), "supersession_ids"),
    }
    card = synthesis.cards(entities, role, g, views, hyp)
    cards = keep("cards", synthesis.whole_cards(card, props, aliases, views, tied))
    notes = synthesis.reference_problems(g, a, occ, r, k, sup).unionByName(lost).withColumn("entity_id", F.lit(None).cast("string"))
    # K10
    queue = keep("queue", review.queue(review.items(hyp, r, sup, k, notes, cards, g2, members)))
    verdicts = keep("adjudications", review.adjudicate(queue, given("responses"), strict))
    # K11
    backend_can = capability or staging.Capability("parquet-staging")
    cand = rated.join(shown.where("copy = 1").select("candidate_id", "accepted"), "candidate_id").join(a.select("candidate_id", F.lit(True).alias("has")), "candidate_id", "left").dropDuplicates(["candidate_id"])
    cand = cand.select("candidate_id", "accepted", F.col("has").isNotNull().alias("has_assertion"), (F.col("start").isNotNull() | F.col("end").isNotNull()).alias("has_effective_time"))
    proof = rated.select("candidate_id", "chunk_id", "source_type", "exact_text", F.lit(None).cast("string").alias("source_sha256"))
    fit = keep("eligibility", staging.eligibility(cand, proof, chunks, backend_can))
    accepted = staging.accepted_refs(verdicts, queue, strict)
    emitted = staging.emissions(r, sup, k, members, accepted)
    staged, _ = staging.relations(emitted, members.select("group_id", F.col("assertion_id").alias("candidate_id")), fit, accepted, backend_can)
    staged = keep("staged", staged)
    keep("records", staging.records(a, fit, staged))
    # K13, and what each table was
    keep("metrics", audit.report({"dispositions": shown, "entities": entities, "hypotheses": hyp, "groups": g, "assertions": a, "relations": r, "occurrences": occ, "conflicts": k, "cards": cards, "queue": queue, "eligibility": fit, "staged": staged}))
    source = identity.table_hash(chunks).first()[0] or hashlib.sha256(b"").hexdigest()
    rows = [(name, identity.build_id(name, "0.1.0", f"{name}.v0", {"strict": strict}, source)["build_id"], identity.table_hash(df).first()[0]) for name, df in out.items()]
    keep("builds", spark.createDataFrame(rows, "stage string, build_id string, output_hash string"))
    return out
