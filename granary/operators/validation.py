"""Validation and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAST_CONFIDENCE = 0.5


def diagnostics(chunks: DataFrame, candidates: DataFrame, evidence: DataFrame, least_origin: float = 0.5) -> DataFrame:
    """candidate_id, copy, code, severity. candidates: candidate_id, position (of the input), source_origin_probability,
    extractor_confidence, is_proxy; evidence: candidate_id, chunk_id, source_id, conversation_id, speaker, exact_text."""
    c = candidates.withColumn("copy", F.row_number().over(Window.partitionBy("candidate_id").orderBy("position")))
    at = chunks.select(F.col("chunk_id").alias("k"), F.col("text").alias("k_text"), F.col("conversation_id").alias("k_conversation"), F.col("source_id").alias("k_source"), F.col("speaker").alias("k_speaker"))
    e = evidence.where("chunk_id is not null").join(at, F.col("chunk_id") == F.col("k"), "left")
    found = F.col("k").isNotNull()
    other = lambda a, b: found & F.col(a).isNotNull() & (F.col(a) != F.col(b))
    rules = {"unknown_chunk": ~found, "evidence_text_mismatch": found & ~F.contains("k_text", "exact_text"), "conversation_mismatch": other("conversation_id", "k_conversation"), "source_mismatch": found & (F.col("source_id") != F.col("k_source")), "speaker_mismatch": other("speaker", "k_speaker")}
    codes = F.array_compact(F.array(*(F.when(ok, F.lit(code)) for code, ok in rules.items())))
    by_evidence = e.select("candidate_id", F.explode(codes).alias("code")).distinct()
    bound = evidence.groupBy("candidate_id").agg(F.count("chunk_id").alias("bound"))
    x = c.join(bound, "candidate_id", "left")
    own = {"duplicate_candidate": ("error", F.col("copy") > 1), "low_source_origin_probability": ("error", F.col("source_origin_probability") < least_origin), "missing_chunk_provenance": ("error", F.coalesce("bound", F.lit(0)) == 0), "proxy_time": ("warning", F.coalesce("is_proxy", F.lit(False))), "low_extractor_confidence": ("warning", F.col("extractor_confidence") < LEAST_CONFIDENCE)}
    made = F.array_compact(F.array(*(F.when(ok, F.struct(F.lit(code).alias("code"), F.lit(s).alias("severity"))) for code, (s, ok) in own.items())))
    direct = x.select("candidate_id", "copy", F.explode(made).alias("d")).select("candidate_id", "copy", "d.code", "d.severity")
    return direct.unionByName(c.select("candidate_id", "copy").join(by_evidence, "candidate_id").select("candidate_id", "copy", "code", F.lit("error").alias("severity")))


def dispositions(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """candidate_id, copy, accepted: no error."""
    c = candidates.withColumn("copy", F.row_number().over(Window.partitionBy("candidate_id").orderBy("position"))).select("candidate_id", "copy")
    bad = found.where("severity = 'error'").select("candidate_id", "copy").distinct().withColumn("bad", F.lit(True))
    return c.join(bad, ["candidate_id", "copy"], "left").select("candidate_id", "copy", F.col("bad").isNull().alias("accepted"))
