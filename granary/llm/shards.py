"""Sharding by a k-d tree: split at weighted medians along the widest metadata dimension until the leaves reach the target bytes.

The points are distinct texts, so equal texts always share a shard. A point's metadata are its source and language (the least of its
copies', as order-preserving codes of their first characters after the common prefix) and its size in bytes; each coordinate has
the text's CRC-32 behind it, so that many points of one value can still be divided. Per level, every node takes the dimension
with the widest range, relative to that of all points, and is cut at the exact weighted median: four histograms of at most
65,536 rows a node, one per 16 bits of the coordinate, whatever the number of documents. Nodes, cuts and heavy texts are
tables of a few rows a shard, joined to the points level by level; the plan does not grow with the number of shards.
A text whose copies weigh more than a `heavy_at`-th of a shard is placed as a whole, the largest first, on the emptier side of each cut.
Law `bytes`: the shards' sizes are near equal.

Null text: no bytes, size 1, CRC-32 of the empty text (0). Null doc_id: kept, ordered first. Null or absent source and language:
as empty. Empty table: no rows. Repeated rows: each gets a slot. Other columns are ignored, or carried along (whole=True).
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, own

DIMS = ("source", "lang", "size")
DIGITS = 4  # of 16 bits: a coordinate holds 32 bits of metadata and 31 of the CRC


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, source and lang of each row."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in DIMS[:2]]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), *names)


def _code(name: Column, prefix: int) -> Column:
    """The four bytes after the common prefix as a number, in byte order."""
    four = F.rpad(F.hex(F.substring(name.cast("binary"), prefix + 1, 4)), 8, "0")
    return F.conv(four, 16, 10).cast("long")


def atoms_of(x: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per distinct text: text_crc32, size, bytes and rows of its copies, a coordinate per dimension."""
    a = scratch.put(x.groupBy("text_crc32", "size").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("source").alias("source"), F.min("lang").alias("lang")))
    low = a.agg(*(f(c).alias(f"{n}_{c}") for c in DIMS[:2] for n, f in (("lo", F.min), ("hi", F.max)))).first()
    codes = {}
    for c in DIMS[:2]:
        p, q = (low[f"lo_{c}"] or "").encode(), (low[f"hi_{c}"] or "").encode()
        same = next((i for i, (s, t) in enumerate(zip(p, q)) if s != t), min(len(p), len(q)))
        codes[c] = _code(F.col(c), same)
    codes["size"] = F.least("size", F.lit((1 << 32) - 1))
    tail = F.shiftright("text_crc32", 1)
    return a.select("text_crc32", "size", "bytes", "rows", *((F.shiftleft(v, 31) + tail).alias(f"at_{c}") for c, v in codes.items()))


def _cuts(light: DataFrame, plan: DataFrame) -> DataFrame:
    """node, cut: per node of `plan` (node, dim, need: bytes wanted on the left) the least coordinate up to which at least that much lies."""
    at = F.coalesce(*(F.when(F.col("dim") == c, F.col(f"at_{c}")) for c in DIMS))
    x = light.join(F.broadcast(plan), "node").select("node", at.alias("v"), "bytes")  # a row per open node
    found = plan.select("node", F.lit(0).cast("long").alias("cut"), F.col("need").alias("left"))
    for k in range(DIGITS - 1, -1, -1):
        part = F.shiftright("v", 16 * k).bitwiseAND(65535)
        rest = x.join(F.broadcast(found), "node").where(F.shiftright("v", 16 * (k + 1)) == F.col("cut")) if k < DIGITS - 1 else x.join(F.broadcast(found), "node")
        h = rest.groupBy("node", "cut", "left", part.alias("part")).agg(F.sum("bytes").alias("b"))
        upto = F.sum("b").over(Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        h = h.withColumn("upto", upto)
        first = F.min(F.when(F.col("upto") >= F.col("left"), F.struct("part", (F.col("upto") - F.col("b")).alias("under"))))
        found = h.groupBy("node", "cut", "left").agg(first.alias("s"), F.max(F.struct("part", (F.col("upto") - F.col("b")).alias("under"))).alias("last"))
        s = F.coalesce("s", "last")
        found = found.select("node", (F.shiftleft("cut", 16) + s["part"]).alias("cut"), (F.col("left") - s["under"]).alias("left"))
        found = light.sparkSession.createDataFrame(found.collect(), "node long, cut long, left double")  # a row per open node
    return found.select("node", "cut")


def tree(atoms: DataFrame, shards: int, scratch: Scratch, heavy_at: int = 32) -> DataFrame:
    """text_crc32, size, shard for each atom. On the driver: the open nodes (at most one a shard) and the heavy texts (at most
    shards * heavy_at, by their definition)."""
    total = atoms.agg(F.sum("bytes")).first()[0] or 0
    is_heavy = F.col("bytes") * shards * heavy_at > total
    heavy = {(r["text_crc32"], r["size"]): r["bytes"] for r in atoms.where(is_heavy).select("text_crc32", "size", "bytes").collect()}
    light = scratch.put(atoms.where(~is_heavy).withColumn("node", F.lit(1).cast("long")))
    ranges = [f(F.shiftright(f"at_{d}", 31)).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))]
    span = light.agg(*ranges).first()
    spark = atoms.sparkSession
    leaves, place = {1: (0, shards)}, dict.fromkeys(heavy, 1)  # node -> first shard and number of shards
    while any(n > 1 for _, n in leaves.values()):
        split = {k: v for k, v in leaves.items() if v[1] > 1}
        stats = {r["node"]: r for r in light.groupBy("node").agg(F.sum("bytes").alias("b"), *ranges).collect()}
        inside: dict = {}
        for x, k in place.items():
            inside.setdefault(k, []).append(x)
        plan = []
        for k, (_, n) in split.items():
            r, mine = stats.get(k), sorted(inside.get(k, ()), key=lambda x: (-heavy[x], x))
            light_b = r["b"] if r else 0
            # heavy texts go, the largest first, to the shard that is emptiest; the light ones fill up to the even share
            load = [(0, j) for j in range(n)]
            for x in mine:
                b, j = heapq.heappop(load)
                heapq.heappush(load, (b + heavy[x], j))
                place[x] = 2 * k if j < n // 2 else 2 * k + 1
            even = (light_b + sum(heavy[x] for x in mine)) / n
            spare = [max(0.0, even - b) for b, _ in sorted(load, key=lambda y: y[1])]
            need = light_b * sum(spare[: n // 2]) / sum(spare) if sum(spare) else light_b * (n // 2) / n
            if r:
                width = {d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / max(1, span[f"hi_{d}"] - span[f"lo_{d}"]) for d in DIMS}
                plan.append((k, max(DIMS, key=width.get), float(need)))
        if plan:
            plan = spark.createDataFrame(plan, "node long, dim string, need double")
            cuts = plan.drop("need").join(_cuts(light, plan), "node")
            at = F.coalesce(*(F.when(F.col("dim") == c, F.col(f"at_{c}")) for c in DIMS))
            side = F.when(F.col("cut").isNull(), F.col("node")).when(at <= F.col("cut"), F.col("node") * 2).otherwise(F.col("node") * 2 + 1)
            old, light = light, scratch.put(light.join(F.broadcast(cuts), "node", "left").withColumn("node", side).select(light.columns))  # a row per open node
            scratch.drop(old)
        for k, (at, n) in split.items():
            del leaves[k]
            leaves[2 * k], leaves[2 * k + 1] = (at, n // 2), (at + n // 2, n - n // 2)
    ends = spark.createDataFrame([(k, at) for k, (at, _) in leaves.items()], "node long, shard int")
    out = light.join(F.broadcast(ends), "node").select("text_crc32", "size", "shard")
    if heavy:
        out = out.unionByName(spark.createDataFrame([(c, s, leaves[place[c, s]][0]) for c, s in heavy], "text_crc32 long, size long, shard int"))
    return out


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, slot_rows: int = 100_000, whole: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; with whole=True behind all columns of docs (under names of our own where
    docs has such a column). Give the number of shards, or the bytes a leaf may have."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either the number of shards or their target bytes")
    scratch = scratch or Scratch(docs.sparkSession, "shards")
    x = scratch.put(points(docs))
    atoms = scratch.put(atoms_of(x, scratch))
    rows, total = atoms.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = shards or max(1, math.ceil(total / target_bytes))
    where = scratch.put(tree(atoms, shards, scratch))
    made = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    if whole:
        body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
        mine = F.struct(*own(docs)).alias("_granary_row")
        x = docs.select(mine, F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        place = where.withColumnsRenamed({"text_crc32": "_c", "size": "_s"})
        y = x.join(place.hint("merge"), (F.col("text_crc32") == F.col("_c")) & (F.col("size") == F.col("_s"))).drop("_c", "_s")
    else:
        y = x.drop("source", "lang").join(where, ["text_crc32", "size"])
    # slots: numbered within small buckets of a shard, after the counts of the buckets before
    buckets = max(1, min(8192, rows // (slot_rows * shards) + 1))
    bucket = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int")
    y = y.withColumn("b", bucket)
    counts = (x if not whole else x.select("doc_id", "size", "text_crc32")).join(where, ["text_crc32", "size"]).groupBy("shard", bucket.alias("b")).agg(F.count(F.lit(1)).alias("k"))
    by = Window.partitionBy("shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("shard", "b", F.coalesce(F.sum("k").over(by), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "b").orderBy("doc_id", "text_crc32", "size"))
    y = y.withColumn("i", number).join(start, ["shard", "b"])
    y = y.withColumns({"law": F.lit("bytes"), "slot": (F.col("start") + F.col("i") - 1).cast("long"), "grown_shard": F.lit(None).cast("int")})
    if not whole:
        return y.select(*made)
    kept = [F.col("_granary_row").getField(c).alias(c) for c in docs.columns]
    return y.select(*kept, *(F.col(c).alias(c if c not in docs.columns else f"_granary_{c}") for c in made if c != "doc_id" or "doc_id" not in docs.columns))
