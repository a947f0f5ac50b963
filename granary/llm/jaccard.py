"""N-gram Jaccard join by parity sketches.

A document is the set of its five-word shingles (64-bit hashes). Its parity sketch cuts the hash space into segments and
XORs the hashes of each: two sketches differ in at most as many segments as the sets differ in shingles. Within a size
band (all sets that could be linked share one, with one number of segments) documents meet on equal segments. Sets of up to
64 shingles use a segment per shingle, where the pigeonhole is certain; larger bands have as many segments as leave 24
equal ones expected at the very threshold, of which at least three must occur (a link is missed with a probability below
2e-8 at the threshold and far below above it). Equal sets are one class and meet once.

The classes of one segment meet on single-bit parity sketches, whose Hamming distance is never above the symmetric difference; of
the pairs that the sketches leave a spanning forest is sent on. A segment of many classes is cut into blocks and each pair of
blocks is one task. The components of these forests are families, so a line in common makes none. No pair is listed
for a family: it is cut into blocks too, and for each pair of blocks one task makes the exact test on whole sets, where
sketches again leave few pairs. A task sends on a spanning forest of its links and each class's number of links.

Null or wordless text: an empty set, linked with nothing. Null doc_id: never linked, component null. Fewer than five words:
one shingle. Repeated rows and equal sets: one class; n_links counts the other rows. Empty table: no rows. Other columns
are ignored.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, mix, own, raw, shingle_hashes, slices, word_hashes

SMALL = 64  # shingles of a set that has a segment for each
EQUAL, NEED = 24, 3
BLOCK = 384  # classes of a block
BLOCK_SHINGLES = 1 << 20  # and their shingles, about seven megabytes of text; one longer text is a block of its own size
SIFT, SIFT_SHINGLES = 4096, 1 << 23  # classes of a segment's block, and their shingles: at most four megabytes of sketches
SETS = "doc_id long, n_shingles int, d1 long, d2 long, keys array<long>, sketch binary"


def band_of(n: int) -> int:
    return 0 if n <= SMALL else math.ceil(math.log2(n / SMALL) - 1e-12)


@functools.cache
def segments(band: int) -> int:
    """Least number with EQUAL equal segments expected at the threshold for every size of the band."""
    low, high, m = int(0.8 * SMALL * 2 ** (band - 1)), SMALL * 2**band, 16
    while any(m * math.exp(-n / 4.5 / m) * (1 - math.exp(-n / 1.125 / m)) < EQUAL for n in (low, high)):
        m += 1 + m // 64
    return m


def shingle_set(text: bytes):
    import numpy as np

    return np.unique(shingle_hashes(word_hashes(text.lower().split())))


def sketched(h) -> bytes:
    """Parity of the hashes of each residue, of two bits or more per shingle up to 32768."""
    import numpy as np

    bits = 256
    while bits < 2 * len(h) and bits < 1 << 15:
        bits *= 2
    return np.packbits(np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _sets(batches):
    import numpy as np
    import pyarrow as pa

    seen: set = set()  # classes whose keys this task has sent; bounded
    none = np.zeros(0, np.int64)
    for part in slices(batches, ["text"]):
        out, keys, ends, sketches = [], [], [0], []
        for i, text in zip(part.column("doc_id").to_pylist(), raw(part.column("text"))):
            h = shingle_set(text)
            n = len(h)
            if n == 0 or i is None:
                own = mix(np.array([(i or 0) & 0xFFFFFFFFFFFFFFFF, 1], np.uint64)).view(np.int64)
                out.append((i, n, int(own[0]), int(own[1])))
                ends.append(ends[-1])
                sketches.append(None)
                continue
            with np.errstate(over="ignore"):
                d = mix(np.array([h.sum() + np.uint64(n), np.bitwise_xor.reduce(mix(h)) ^ np.uint64(n)], np.uint64)).view(np.int64)
            d = (int(d[0]), int(d[1]))
            out.append((i, n, *d))
            if d in seen:
                ends.append(ends[-1])
                sketches.append(None)
                continue
            if len(seen) > 200_000:
                seen.clear()
            seen.add(d)
            mine = [none]
            for band in {band_of(n), band_of(int(n / 0.8))}:
                salt = np.uint64(0x9E3779B97F4A7C15 * (band + 1) & 0xFFFFFFFFFFFFFFFF)
                if band == 0:
                    mine.append(mix(h + salt).view(np.int64))
                else:
                    seg = ((h >> np.uint64(32)) * np.uint64(segments(band))) >> np.uint64(32)
                    start = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])  # h is sorted, and so seg
                    x = np.bitwise_xor.reduceat(mix(h + salt), start)
                    mine.append(mix(x + seg[start] * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
            mine = np.concatenate(mine)
            keys.append(mine)
            ends.append(ends[-1] + len(mine))
            sketches.append(sketched(h))
        cols = [list(c) for c in zip(*out)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([none, *keys]), pa.int64())), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "d1", "d2", "keys", "sketch"],
        )


def _sift(table):
    """Segments, or one pair of blocks of one: a spanning forest of the pairs whose sizes and sketches leave a link possible."""
    import numpy as np
    import pyarrow as pa

    key, d1, size = (table.column(c).to_numpy() for c in ("key", "d1", "n"))
    sketches = table.column("sketch").to_pylist()
    order = np.lexsort((d1, key))
    a, b = [], []
    for rows in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        width = min(len(sketches[i]) for i in rows)
        folded = []
        for i in rows:
            x = np.frombuffer(sketches[i], np.uint64)
            while 8 * len(x) > width:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            folded.append(x)
        folded, n, node = np.array(folded), size[rows], d1[rows]
        rest = np.arange(len(rows))
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                i = reached.pop()
                near = 9 * np.abs(n[rest] - n[i]) <= n[rest] + n[i]
                some = rest[near]
                near[near] = 9 * np.bitwise_count(folded[some] ^ folded[i]).sum(1, dtype=np.int64) <= n[some] + n[i]
                new, rest = rest[near], rest[~near]
                reached += new.tolist()
                a += [node[i]] * len(new)
                b += node[new].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _linked(table):
    """One pair of blocks: the links of classes in different blocks, or within one."""
    import numpy as np
    import pyarrow as pa

    rows = {}
    for r, b, size, text, bi, bj in zip(*(table.column(c).to_pylist() for c in ("rep", "blk", "size", "text", "bi", "bj"))):
        rows[r] = (b, size, text, bi, bj)
    reps = sorted(rows)
    sets = [shingle_set((rows[r][2] or "").encode()) for r in reps]
    n = np.array([len(s) for s in sets])
    blk, size = np.array([rows[r][0] for r in reps]), np.array([rows[r][1] for r in reps])
    bits = 64
    while bits < n.max() and bits < 1 << 15:
        bits *= 2
    sketch = np.zeros((len(reps), bits // 8), np.uint8)
    for i, s in enumerate(sets):
        sketch[i] = np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1)
    sketch = sketch.view(np.uint64)
    root, degree, forest = list(range(len(reps))), np.zeros(len(reps), np.int64), []

    def find(a):
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    own = next(iter(rows.values()))[3] == next(iter(rows.values()))[4]
    for i in range(len(reps) - 1):
        j = np.arange(i + 1, len(reps))
        j = j[(blk[j] == blk[i]) == own]
        total = n[i] + n[j]
        j = j[(9 * np.abs(n[i] - n[j]) <= total)]
        if len(j):
            j = j[9 * np.bitwise_count(sketch[j] ^ sketch[i]).sum(1, dtype=np.int64) <= n[i] + n[j]]
        for k in j.tolist():
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= 80 * (n[i] + n[k] - both):
                degree[i] += size[k]
                degree[k] += size[i]
                a, b = find(i), find(k)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    forest.append((reps[i], reps[k]))
    some = np.flatnonzero(degree)
    a = [x for x, _ in forest] + [reps[i] for i in some]
    b = [x for _, x in forest] + [None] * len(some)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "degree": pa.array([0] * len(forest) + degree[some].tolist(), pa.int64())})


def families(x: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): classes (by d1) that share segments and have similar sketches; only classes with a possible partner."""
    sent = x.where(F.size("keys") > 0)
    by = Window.partitionBy("key")
    met = sent.select("d1", F.explode("keys").alias("key")).select("key", "d1", F.min("d1").over(by).alias("lo"), F.max("d1").over(by).alias("hi"), F.count(F.lit(1)).over(by).alias("df")).where("lo < hi").select("key", "d1", "df")
    met = scratch.put(met.groupBy("key", "d1").agg(F.max("df").alias("df")))
    scratch.free_shuffles()
    size = sent.groupBy("d1").agg(F.max("n_shingles").cast("long").alias("n"))
    need = F.when(F.col("n") <= int(0.8 * SMALL), F.ceil(F.col("n") * 4 / 5)).otherwise(NEED)
    own = Window.partitionBy("d1")
    ranked = met.join(size, "d1").select("key", "d1", "n", need.alias("need"), F.count(F.lit(1)).over(own).alias("cnt"), F.row_number().over(own.orderBy("df", "key")).alias("rank"))
    # a partner shares `need` of the segments, and so one of those left when the need - 1 most frequent go
    left = scratch.put(ranked.where("cnt >= need and rank <= cnt - need + 1").select("key", "d1", "n"))
    # segments of the same classes count once: near copies share most of theirs
    same = [F.bit_xor(F.xxhash64("d1", F.lit(k))).alias(f"same{k}") for k in (1, 2)]
    groups = left.groupBy("key").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("all"), *same).where("df > 1")
    groups = scratch.put(groups.groupBy("df", "same1", "same2").agg(F.min("key").alias("key"), F.max("all").alias("all")))
    scratch.free_shuffles()
    classes, shingles = groups.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("all"), F.lit(0))).first()
    tasks = max(1, -(-classes // SIFT), -(-shingles // SIFT_SHINGLES))  # for the segments of a single block
    nb = F.greatest(F.ceil(F.col("df") / SIFT), F.ceil(F.col("all") / SIFT_SHINGLES)).cast("int")
    rows = left.join(groups.select("key", nb.alias("nb")), "key").select("key", "d1", "n", "nb", F.pmod(F.xxhash64("d1", "key"), "nb").cast("int").alias("blk"))
    rows = rows.join(sent.select("d1", "sketch").dropDuplicates(["d1"]), "d1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).where("nb = 1 or blk <> other")
    task = F.when(F.col("nb") == 1, F.pmod(F.xxhash64("key", F.lit(5)), F.lit(tasks))).otherwise(F.col("key"))
    rows = rows.select("key", "d1", "n", "sketch", task.alias("task"), F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"))
    edges = scratch.put(rows.groupBy("task", "bi", "bj").applyInArrow(_sift, "a long, b long").distinct())
    scratch.drop(met, left, groups)
    scratch.free_shuffles()
    found = components(edges, scratch)
    return scratch.put(found.unionByName(found.select(F.col("root").alias("node"), "root")).distinct())


def link(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other documents linked directly) for each row of docs."""
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    x = scratch.put(docs.mapInArrow(_sets, SETS))
    family = families(x, scratch)
    wide, x = x, scratch.put(x.select("doc_id", "n_shingles", "d1", "d2"))
    scratch.drop(wide)
    classes = scratch.put(x.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.max("n_shingles").cast("long").alias("n")))
    members = classes.join(family, classes["d1"] == family["node"]).select("rep", "size", "n", F.col("root").alias("gid"))
    groups = members.groupBy("gid").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("all")).where("g > 1")
    blocks = F.greatest(F.ceil(F.col("g") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int")
    members = scratch.put(members.join(groups, "gid").select("rep", "size", "gid", blocks.alias("nb"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("blk")))
    texts = docs.join(members.hint("merge"), docs["doc_id"] == members["rep"]).select("rep", "size", "gid", "blk", "text", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    pairs = texts.select("rep", "size", "gid", "blk", "text", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"))
    links = scratch.put(pairs.groupBy("gid", "bi", "bj").applyInArrow(_linked, "a long, b long, degree long"))
    scratch.free_shuffles()
    found = components(links.where("b is not null").select("a", "b"), scratch)
    degrees = links.where("b is null").groupBy("a").agg(F.sum("degree").alias("degree"))
    classes = classes.join(found, classes["rep"] == found["node"], "left").join(degrees, classes["rep"] == degrees["a"], "left")
    classes = classes.select("d1", "d2", F.coalesce("root", "rep").alias("root"), (F.col("size") - 1 + F.coalesce("degree", F.lit(0))).alias("n"))
    out = x.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """docs with one document of each component, the smallest doc_id, and one of its repeated rows. A null doc_id stays."""
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    steps = Scratch(docs.sparkSession, "jaccard")
    found = scratch.put(link(docs, steps).select("doc_id", "component_id"))
    steps.clear()
    scratch.free_shuffles()
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"), F.max(F.col("doc_id") > F.col("component_id")).alias("drop")).where("doc_id is not null")
    kept = docs.join(again.where("drop").select("doc_id").hint("merge"), "doc_id", "left_anti").select(*own(docs))
    if again.where("k > 1").isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
