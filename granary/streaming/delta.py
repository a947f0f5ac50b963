"""Delta compilation: a micro-batch of chunks is a set of changed conversations. The compiler's stages are batch functions, so a
stream runs them in foreachBatch with the plan of K12; there is no watermark, since nothing expires."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import scheduling


def conversation_hashes(chunks: DataFrame) -> DataFrame:
    row = F.sha2(F.concat_ws("|", "chunk_id", "speaker", "text", F.coalesce("occurred_at", F.lit(""))), 256)
    return chunks.groupBy(F.col("conversation_id").alias("partition")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), ""), 256).alias("input_hash"))


def changed(chunks: DataFrame, cached: DataFrame) -> DataFrame:
    """The plan's rows to run."""
    return scheduling.corpus_plan(conversation_hashes(chunks), cached).where("disposition = 'run'")


def start(chunks: DataFrame, compile_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """chunks: a streaming table. compile_batch gets each batch of whole conversations and its number."""
    return chunks.writeStream.foreachBatch(compile_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
