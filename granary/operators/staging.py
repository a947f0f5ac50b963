"""Staging records and relations; pending only, never promotion."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, identity

#: Relation types that a staging backend may know.
RELATIONS = ["supports", "repeats", "elaborates", "refines", "qualifies", "contradicts", "supersedes", "unrelated"]


@dataclass(frozen=True)
class Capability:
    backend_id: str
    record_contract: str = "record.v0"
    staging_contract: str = "staging.v0"
    source_types: tuple[str, ...] = ("chat",)
    relation_types: tuple[str, ...] = tuple(RELATIONS)
    temporal_bases: tuple[str, ...] = ("source_exact_timestamp", "source_bounded_interval")
    can_build: bool = True
    can_validate: bool = True
    preserves_effective_anchor: bool = False
    exposes_promotion: bool = False

    def gate(self) -> Capability:
        if self.exposes_promotion or not (self.can_build and self.can_validate):
            raise checks.ContractError("the backend must build and validate pending bundles and must not promote")
        return self


class Backend(Protocol):
    def capability(self) -> Capability: ...

    def build(self, records: DataFrame, relations: DataFrame, bundle_id: str, created_at: str) -> dict: ...

    def validate(self, artifact: dict) -> dict: ...


def eligibility(candidates: DataFrame, evidence: DataFrame, chunks: DataFrame, capability: Capability) -> DataFrame:
    """candidate_id, eligibility, reasons, temporal_basis. candidates: candidate_id, accepted, has_assertion, has_effective_time;
    evidence: candidate_id, chunk_id, source_type, exact_text, source_sha256; chunks: chunk_id, text, occurred_at, source_sha256.
    The first failing gate decides."""
    capability.gate()
    c = chunks.select(F.col("chunk_id").alias("k"), F.col("text").alias("k_text"), "occurred_at", F.col("source_sha256").alias("k_sha"))
    e = evidence.join(c, F.col("chunk_id") == F.col("k"), "left")
    digest = F.coalesce("source_sha256", "k_sha")
    why = F.when(F.col("chunk_id").isNull(), "evidence_without_chunk").when(F.col("k").isNull(), "evidence_chunk_missing").when(F.coalesce(F.length(digest), F.lit(0)) != 64, "source_sha256_missing").when(~F.contains("k_text", "exact_text"), "evidence_text_not_in_chunk")
    x = e.withColumn("why", why).groupBy("candidate_id").agg(F.array_sort(F.collect_set("why")).alias("inexact"), F.collect_set(F.when(F.col("why").isNull(), F.col("source_type"))).alias("types"), F.collect_set(F.when(F.col("why").isNull(), F.col("occurred_at"))).alias("times"))
    y = candidates.join(x, "candidate_id", "left")
    wrong = F.array_sort(F.array_except("types", F.array(*map(F.lit, capability.source_types))))
    basis = F.when(F.coalesce(F.size("times"), F.lit(0)) <= 0, "unknown").when(F.size("times") == 1, "source_exact_timestamp").otherwise("source_bounded_interval")
    y = y.withColumns({"wrong": wrong, "temporal_basis": basis})
    gates = [
        (~F.col("accepted"), "blocked_validation", F.array(F.lit("k02_not_accepted"))),
        (~F.col("has_assertion"), "blocked_validation", F.array(F.lit("missing_k05_normalized_assertion"))),
        (F.col("inexact").isNull() | (F.size("inexact") > 0), "blocked_source_exactness", F.coalesce("inexact", F.array().cast("array<string>"))),
        (F.size("wrong") > 0, "blocked_source_mode", F.transform("wrong", lambda t: F.concat(F.lit("unsupported_source_type:"), t))),
        (~F.col("temporal_basis").isin(list(capability.temporal_bases)), "blocked_temporal_contract", F.array(F.concat(F.lit("unsupported_temporal_basis:"), "temporal_basis"))),
        (F.col("has_effective_time") & F.lit(not capability.preserves_effective_anchor), "blocked_temporal_contract", F.array(F.lit("backend_drops_effective_time"))),
    ]
    shown, reasons = F.lit("eligible"), F.array().cast("array<string>")
    for failed, name, text in reversed(gates):
        shown, reasons = F.when(failed, name).otherwise(shown), F.when(failed, text).otherwise(reasons)
    return y.select("candidate_id", shown.alias("eligibility"), reasons.alias("reasons"), "temporal_basis")


def relations(links: DataFrame, members: DataFrame, eligible: DataFrame, accepted: DataFrame, capability: Capability) -> tuple[DataFrame, DataFrame]:
    """(source_candidate_id, target_candidate_id, relation_type, source_ref) and (code, source_ref). links: source_ref,
    left_group_id, right_group_id, relation_type, structural and, of emissions(), accepted (null: look it up); members: group_id,
    candidate_id; accepted: source_ref. A group stands for a record only if exactly one member is eligible. Links that have a code
    without their groups are not joined with these."""
    x = links.where(F.col("relation_type").isin(RELATIONS))
    ok = accepted.select("source_ref").distinct().withColumn("ok", F.lit(True))
    ends = [identity.packed_key(c, 3).alias(c) for c in ("left_group_id", "right_group_id")]
    if "accepted" in x.columns:
        known = x.where("accepted is not null").select("source_ref", *ends, "relation_type", "structural", F.when(F.col("accepted"), True).alias("ok"))
        x = x.where("accepted is null")
    else:
        known = None
    x = x.select("source_ref", *ends, "relation_type", "structural").join(ok, "source_ref", "left")
    x = x if known is None else x.unionByName(known)
    structural, supported = F.coalesce("structural", F.lit(False)), F.col("relation_type").isin(list(capability.relation_types))
    code = F.when(structural, "structural_relation_not_promoted").when(F.col("ok").isNull(), "relation_not_adjudicated_accepted").when(~supported, "unsupported_relation")
    one = members.join(eligible.where("eligibility = 'eligible'").select("candidate_id"), "candidate_id", "left_semi").groupBy(identity.packed_key("group_id").alias("k")).agg(F.min("candidate_id").alias("c"), F.count(F.lit(1)).alias("n")).where("n = 1")
    side = lambda s: one.select(F.col("k").alias(f"{s}_group_id"), F.col("c").alias(f"{s}_c"))
    open_ = x.where(~structural & F.col("ok").isNotNull() & supported).join(side("left"), "left_group_id", "left").join(side("right"), "right_group_id", "left")
    out = open_.where("left_c <> right_c").select(F.col("left_c").alias("source_candidate_id"), F.col("right_c").alias("target_candidate_id"), "relation_type", "source_ref").dropDuplicates()
    shut = x.select(code.alias("code"), "source_ref").where("code is not null")
    unclear = open_.where("left_c is null or right_c is null").select(F.lit("ambiguous_group_to_record_relation").alias("code"), "source_ref")
    return out, shut.unionByName(unclear).distinct()


def accepted_refs(adjudications: DataFrame, items: DataFrame, strict: bool = True) -> DataFrame:
    """source_ref, adjudication_id of accepted review items; of several the last by id. adjudications: review_item_id, disposition;
    items: review_item_id, source_ref. strict: an adjudication of an unknown item is an error."""
    if strict:
        checks.known(adjudications, "review_item_id", items, "review_item_id", "adjudicated item")
    x = adjudications.where("disposition = 'accepted'").join(items.select("review_item_id", "source_ref"), "review_item_id")
    return x.groupBy("source_ref").agg(F.max(identity.key_id(F.lit("adjudication"), "review_item_id")).alias("adjudication_id"))


def emissions(relations: DataFrame, supersessions: DataFrame, conflicts: DataFrame, members: DataFrame, accepted: DataFrame) -> DataFrame:
    """Links for relations(): source_ref, left_group_id, right_group_id, relation_type, structural, accepted (null for relations: not
    looked up). Relations all; supersessions that were reviewable and accepted, as predecessor `supersedes` successor; accepted conflicts
    that overlap in time, as `contradicts`. members: assertion_id, group_id; accepted: source_ref."""
    ok = accepted.select("source_ref").distinct()
    no, yes = F.lit(False).alias("structural"), F.lit(True).alias("accepted")
    r = relations.select(F.col("relation_id").alias("source_ref"), F.col("source_group_id").alias("left_group_id"), F.col("target_group_id").alias("right_group_id"), "relation_type", (F.col("disposition") == "structural").alias("structural"), F.lit(None).cast("boolean").alias("accepted"))
    of = members.select("assertion_id", identity.packed(F.col("group_id")).alias("k"))
    at = lambda end, name: of.select(F.col("assertion_id").alias(end), F.col("k").alias(name))
    s = supersessions.where(F.col("disposition").isin("suggested", "review_required")).select(F.col("supersession_id").alias("source_ref"), "predecessor_id", "successor_id").join(ok, "source_ref", "left_semi")
    s = s.join(at("predecessor_id", "l"), "predecessor_id").join(at("successor_id", "r"), "successor_id")
    back = lambda l, r: (identity.unpacked(F.col(l)).alias("left_group_id"), identity.unpacked(F.col(r)).alias("right_group_id"))
    s = s.select("source_ref", *back("l", "r"), F.lit("supersedes").alias("relation_type"), no, yes)
    c = conflicts.where(~F.col("disposition").isin("temporally_disjoint", "change_over_time_candidate"))
    c = c.select(F.col("conflict_id").alias("source_ref"), identity.packed(F.col("left_group_id")).alias("l"), identity.packed(F.col("right_group_id")).alias("r")).join(ok, "source_ref", "left_semi")
    c = c.select("source_ref", *back("l", "r"), F.lit("contradicts").alias("relation_type"), no, yes)
    return r.unionByName(s).unionByName(c)


def records(candidates: DataFrame, eligible: DataFrame, links: DataFrame) -> DataFrame:
    """Eligible candidates, all columns, with temporal_basis and `relations`: the distinct links that start at them, sorted. links: of
    relations()."""
    own = links.groupBy(F.col("source_candidate_id").alias("candidate_id")).agg(F.array_sort(F.collect_set(F.struct("target_candidate_id", "relation_type", "source_ref"))).alias("relations"))
    x = candidates.join(eligible.where("eligibility = 'eligible'").select("candidate_id", "temporal_basis"), "candidate_id").join(own, "candidate_id", "left")
    none = F.array().cast("array<struct<target_candidate_id:string,relation_type:string,source_ref:string>>")
    return x.withColumn("relations", F.coalesce("relations", none))


class ParquetStaging:
    """A backend that writes a pending bundle as Parquet with a manifest."""

    def __init__(self, root: str, capability: Capability | None = None):
        self.root, self._capability = root, capability or Capability("parquet-staging")

    def capability(self) -> Capability:
        return self._capability

    def build(self, records: DataFrame, links: DataFrame, bundle_id: str, created_at: str) -> dict:
        at = f"{self.root}/{bundle_id}"
        records.write.mode("overwrite").parquet(f"{at}/records")
        links.write.mode("overwrite").parquet(f"{at}/relations")
        spark = records.sparkSession
        manifest = {"bundle_id": bundle_id, "backend_id": self._capability.backend_id, "created_at": created_at, "status": "pending_review", "path": at, "records": identity.table_hash(spark.read.parquet(f"{at}/records")).first()[0]}
        spark.createDataFrame([(identity.canonical_json(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/manifest")
        return manifest

    def validate(self, artifact: dict) -> dict:
        return {"bundle_id": artifact["bundle_id"], "backend_id": self._capability.backend_id, "valid": artifact["status"] == "pending_review"}


def stage(backend: Backend, records: DataFrame, links: DataFrame, bundle_id: str, created_at: str) -> dict:
    """Builds and validates a pending bundle; the identities must agree."""
    capability = backend.capability().gate()
    artifact = backend.build(records, links, bundle_id, created_at)
    report = backend.validate(artifact)
    if artifact["backend_id"] != capability.backend_id or report["backend_id"] != capability.backend_id or not artifact["bundle_id"] == report["bundle_id"] == bundle_id or not report["valid"]:
        raise checks.ContractError("the bundle's identity does not hold")
    return artifact
