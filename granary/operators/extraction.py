"""Candidates from chunks, through a backend that only returns rows."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks, identity
from ..functions.text import strip

CONTRACT = "candidates.v0"


class Backend(Protocol):
    """chunks -> candidate rows (candidate_id, chunk_id, exact_text and the scores); no authority to write."""

    name: str

    def extract(self, chunks: DataFrame) -> DataFrame: ...


class SentenceRules:
    """First word, second word and last word of each sentence of three words or more; DataFrame functions only."""

    name = "sentence-rules"

    def extract(self, chunks: DataFrame) -> DataFrame:
        x = chunks.select("chunk_id", "source_id", "conversation_id", "speaker", F.posexplode(F.split("text", r"[.!?\n]+")).alias("seq", "s"))
        x = x.withColumn("exact_text", F.trim("s")).withColumn("w", F.split("exact_text", " +")).where("size(w) >= 3")
        return x.select(identity.key_id("chunk_id", F.col("seq").cast("string")).alias("candidate_id"), "chunk_id", "source_id", "conversation_id", "speaker", "seq", "exact_text", F.element_at("w", 1).alias("subject"), F.element_at("w", 2).alias("predicate"), F.element_at("w", -1).alias("object"))


def problems(chunks: DataFrame, out: DataFrame) -> DataFrame:
    """code, ref: candidate ids that repeat, and evidence from outside the input."""
    twice = checks.duplicates(out, "candidate_id", what="duplicate_candidate_id").select(F.col("what").alias("code"), F.col("key").alias("ref"))
    return twice.unionByName(checks.unknown(out, "chunk_id", chunks, "chunk_id", "evidence_outside_input"))


def compile(chunks: DataFrame, backend: Backend, strict: bool = True) -> DataFrame:
    """The backend's candidates; strict: some input and no problems."""
    out = backend.extract(chunks)
    if strict:
        if chunks.isEmpty():
            raise checks.ContractError("no chunks")
        checks.require_empty(problems(chunks, out), "extraction")
    return out


def ordered(chunks: DataFrame) -> DataFrame:
    """chunk_id, conversation_id and the place in its conversation, by time, then id."""
    by = Window.partitionBy("conversation_id").orderBy(F.coalesce("occurred_at", F.lit("")), "chunk_id")
    return chunks.select("conversation_id", "chunk_id", F.row_number().over(by).alias("place"))


def build(chunks: DataFrame, backend: Backend, version: str = "0.1.0") -> dict[str, str]:
    """Build identity; the backend's name is part of the configuration."""
    return identity.build_id("K01.extract", version, CONTRACT, {"backend": backend.name}, identity.table_hash(chunks).first()[0])


def chunk_violations(chunks: DataFrame) -> DataFrame:
    return checks.violations(chunks, "chunk_id", chunk_id=checks.filled(F.col("chunk_id")), source_id=checks.filled(F.col("source_id")), conversation_id=checks.filled(F.col("conversation_id")), speaker=checks.filled(F.col("speaker")), text=strip(F.col("text")) != "", source_sha256=checks.digest(F.col("source_sha256")))
