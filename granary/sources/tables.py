"""Reading tables and snapshots, and the compiler's inputs derived by rule from tables that hold no real assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identity
from ..operators.extraction import SentenceRules, compile


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save_snapshot(tables: dict[str, DataFrame], root: str) -> None:
    """A folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def load_snapshot(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk per turn; every ninth has no time."""
    t = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("conv_id") % 28).cast("string"), 2, "0"), F.lit("T"), F.lpad((F.col("turn") % 24).cast("string"), 2, "0"), F.lit(":00:00"))
    return read(spark, sf_dir, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.concat(F.lit("s"), (F.col("conv_id") % 7).cast("string")).alias("source_id"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("conversation_id"), F.col("role").alias("speaker"), F.when((F.col("conv_id") + F.col("turn")) % 9 != 0, t).alias("occurred_at"), "text", F.sha2("text", 256).alias("source_sha256"))


def candidates(chunk: DataFrame) -> DataFrame:
    """Sentence candidates with scores and, by a residue r, one planted defect each."""
    x = compile(chunk, SentenceRules(), strict=False)
    n = F.length("exact_text")
    return x.withColumns({"r": (n + F.col("seq")) % 11, "source_origin_probability": ((n * 5 + F.col("seq")) % 10) / 10.0, "extractor_confidence": ((n * 7 + F.col("seq") * 3) % 10) / 10.0, "is_proxy": (n + F.col("seq")) % 11 == 7})


def flawed(x: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, evidence) with the defects applied."""
    r = F.col("r")
    evidence = x.select("candidate_id", F.when(r == 4, F.concat(F.lit("missing:"), "chunk_id")).when(r != 5, F.col("chunk_id")).alias("chunk_id"), F.when(r == 2, "elsewhere").otherwise(F.col("source_id")).alias("source_id"), F.when(r == 1, "elsewhere").when(r == 8, None).otherwise(F.col("conversation_id")).alias("conversation_id"), F.when(r == 3, "nobody").when(r == 9, None).otherwise(F.col("speaker")).alias("speaker"), F.when(r == 0, F.concat("exact_text", F.lit("~"))).otherwise(F.col("exact_text")).alias("exact_text"))
    c = x.select("candidate_id", F.explode(F.when(r == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("position"), "source_origin_probability", "extractor_confidence", "is_proxy")
    return c, evidence


def signed(i: Column, user: Column, kind: Column) -> dict[str, Column]:
    """What an event's assertion is signed by."""
    return {
        "subject": F.concat(F.lit("u"), user.cast("string")), "predicate": kind, "object": F.concat(F.lit("o"), (i % 3).cast("string")), "polarity": F.when(i % 4 == 0, "negative").otherwise("positive"),
        "epistemic_type": F.when(i % 2 == 0, "event").otherwise("fact"), "memory_class": F.lit("event"),
    }


def neighbours(spark: SparkSession, sf_dir: str, span: int = 1 << 14) -> DataFrame:
    """i, left_group_id, right_group_id: each event with the one before it of its type, by their signatures. A type has a large share of all
    events, so windows hold `span` ids of a type, and the last event before them; signatures are made after."""
    e = read(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("i"), "user_id", "event_type")
    e = e.withColumns({"block": F.floor(F.col("i") / span), "carried": F.lit(False)})
    last = e.groupBy("event_type", "block").agg(F.max(F.struct("i", "user_id")).alias("last"))
    last = last.withColumn("last", F.lag("last").over(Window.partitionBy("event_type").orderBy("block"))).where("last is not null")
    x = e.unionByName(last.select("last.i", "last.user_id", "event_type", "block", F.lit(True).alias("carried")))
    x = x.withColumn("before", F.lag(F.struct("i", "user_id")).over(Window.partitionBy("event_type", "block").orderBy("i"))).where("not carried and before is not null")
    at = lambda i, user: identity.key_id(*signed(F.col(i), F.col(user), F.col("event_type")).values())
    return x.select("i", at("before.i", "before.user_id").alias("left_group_id"), at("i", "user_id").alias("right_group_id"))


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed assertions from events: user, event type, a value's bucket."""
    e = read(spark, sf_dir, "events")
    i = F.col("event_id")
    t = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    x = e.select(
        i.cast("string").alias("assertion_id"), *(x.alias(name) for name, x in signed(i, F.col("user_id"), F.col("event_type")).items()),
        ((i % 9) / 10.0).alias("source_origin_probability"), ((i % 8) / 10.0).alias("extractor_confidence"), ((i % 10) / 10.0).alias("importance"), ((i % 7) / 10.0).alias("durability"),
        F.when(i % 11 == 0, None).when(i % 13 == 0, F.concat(t, F.lit("Z"))).when(i % 17 == 0, "long ago").otherwise(t).alias("occurred_at"), (i % 19 == 0).alias("is_proxy"),
    )
    return x.withColumn("signature_id", identity.key_id("subject", "predicate", "object", "polarity", "epistemic_type", "memory_class"))
