"""Mention index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def index(mentions: DataFrame, ascii_only: bool = False) -> DataFrame:
    """A row per (normalised text, type hint); a null type is a key of its own. mentions: mention_id, mention_text,
    entity_type_hint, canonical_hint."""
    x = mentions.withColumn("normalized_text", text.mention_text(F.col("mention_text"), ascii_only))
    hint = F.when(text.strip(F.col("canonical_hint")) != "", text.strip(F.col("canonical_hint")))
    by = lambda c: F.transform(F.array_sort(F.collect_set(F.struct(F.lower(c).alias("l"), c.alias("r")))), lambda s: s["r"])
    return x.groupBy("normalized_text", "entity_type_hint").agg(F.count(F.lit(1)).alias("occurrences"), by(F.col("mention_text")).alias("display_forms"), F.filter(by(hint), lambda h: h.isNotNull()).alias("canonical_hints"), F.min("mention_id").alias("first_mention_id"))
