"""Shared helpers: scratch tables in the shared folder, byte-word splitting, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5  # words in a shingle
SIMILAR = (80, 100)  # a link: 100 * intersection >= 80 * union


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see; one of our own only in local mode where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.gettempdir()}/granary-shared"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors. drop() frees those not needed again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/granary/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t.scratch_path)

    def clear(self) -> None:
        """Frees all tables put here."""
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def free_shuffles(self) -> None:
        """Lets Spark's cleaner remove the shuffle files of finished steps."""
        import gc

        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def own(df: DataFrame) -> list:
    """The columns of df, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_whole(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow over all columns of df; they travel under plain names, as Spark resolves a dot in a name as a field."""
    names = df.columns

    def renamed(batches):
        yield from run(b.rename_columns(names) for b in batches)

    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(renamed, schema)


def slices(batches, columns: list[str], most: int = 4 << 20):
    """Splits Arrow batches so that a slice holds about `most` bytes of text, or one document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.zeros(batch.num_rows, np.int64)
        for c in columns:
            k = pc.binary_length(batch.column(c)).fill_null(0)
            sizes += k.to_numpy(zero_copy_only=False).astype(np.int64)
        at, total = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def raw(column) -> list[bytes]:
    """UTF-8 bytes of each row; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    """A hash per five-word shingle in text order; one for the whole of a shorter text; none for no words."""
    n = len(w) - WORDS + 1
    if len(w) == 0:
        return w
    if n < 1:
        total = np.full(1, 0x5851F42D4C957F2D + len(w), np.uint64)
        for i in range(len(w)):
            total = total + w[i : i + 1] * _MIX[i]
        return mix(total)
    out = w[:n] * _MIX[0]
    for j in range(1, WORDS):
        out = out + w[j : j + n] * _MIX[j]
    return mix(out)


def components(edges: DataFrame, scratch: Scratch, rounds: int = 40) -> DataFrame:
    """(a, b) links to (node, root): root is the smallest node reached. Large-star and small-star by turns
    (Kiveris et al.), with minima by groupBy and a join, so that no neighbourhood is gathered in one task."""
    state = scratch.put(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b")))
        new = scratch.put(small.where("a <> b").distinct())
        mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(state)
        state = new
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
