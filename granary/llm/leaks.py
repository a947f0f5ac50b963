"""Benchmark decontamination: CGK random walks and bit-sampling over item-sized windows, then exact edit distances.

A benchmark item of n words leaks into a document where a run of its words is within floor(0.2 n) word edits of the item. Each
item-sized window and each item walk through their words as in the embedding of Chakraborty, Goldenberg and Koucky (step j
repeats or passes the current word by a random bit of j and the word; length 3 n); each of `repeats` walks samples `bits`
positions, and the sampled code is a bucket of that length and repeat. Windows are looked up in the buckets of all items; window
and item meet in a bucket, and the pairs that meet are checked by the exact edit distance.
A run within the edits keeps at least n - 2 - 3 * edits of an item's word triples, so a window of n words is embedded only if it
holds that many triples of items of n words, whichever items: nothing is lost by it.

The item index is sent to the tasks in blocks of at most `block_bytes` of item text; a larger benchmark takes several passes. The
documents are only mapped: no shuffle, so hot sources and copies cost nothing extra.

Null text: no match. Null or wordless items, and items of under three words (no triple): none. Null doc_id: kept as null. Empty tables: no rows. Items that repeat: each
reported. Other columns are ignored (find) or kept (clean).
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _MIX, map_whole, mix, raw, slices, word_hashes

FOUND = "doc_id long, item_id long, start_word int, end_word int, distance int"
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes):
    return word_hashes(text.translate(_PLAIN).split())


def allowed(n: int) -> int:
    """Edits of an item of n words."""
    return max(0, min(n // 5, (n - 3) // 3))


def _triples(w):
    return mix(w[:-2] * _MIX[0] + w[1:-1] * _MIX[1] + w[2:] * _MIX[2])


def edits(item, run) -> tuple[int, int, int]:
    """Least word edits that turn the item into a part of run, and that part's bounds."""
    m = len(run)
    pos = np.arange(m + 1)
    row, start = np.zeros(m + 1, np.int64), pos.copy()
    best, src = np.empty(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i, x in enumerate(item, 1):
        sub, up = row[:-1] + (run != x), row[1:] + 1
        diagonal = sub <= up
        best[0] = i
        best[1:] = np.where(diagonal, sub, up)
        src[1:] = np.where(diagonal, start[:-1], start[1:])
        key = best - pos  # words of the run may be passed over: the least best[k] + j - k for k <= j
        at = np.maximum.accumulate(np.where(key == np.minimum.accumulate(key), pos, 0))
        row, start = key[at] + pos, src[at]
    end = int(np.argmin(row))
    return int(row[end]), int(start[end]), end


class Index:
    """The buckets of the items' sampled walks, and the triples of the items of each length."""

    def __init__(self, items: list[tuple[int, bytes]], repeats: int, bits: int, seed: int = 11):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        use = [k for k, w in enumerate(self.words) if len(w) >= 3]
        self.repeats, self.bits, self.seed = repeats, bits, seed
        self.samples: dict = {}
        n = np.array([len(self.words[k]) for k in use], np.int64)
        # triples by the length of the item, not by item
        h = np.concatenate([np.zeros(0, np.uint64), *(_triples(self.words[k]) for k in use)])
        of = np.repeat(n, n - 2)
        order = np.lexsort((of, h))
        h, of = h[order], of[order]
        first = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])][: len(h)]
        self.h, self.of = h[first], of[first]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.h >> np.uint64(42)).astype(np.int64)] = True
        # buckets: key of (length, repeat, sampled code) -> items
        keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for m in np.unique(n).tolist():
            same = [k for k, x in zip(use, n.tolist()) if x == m]
            keys.append(self.keys(np.stack([self.words[k] for k in same])).ravel())
            owner.append(np.repeat(same, repeats))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        self.bucket, self.owner = keys[order], owner[order]

    def keys(self, x):
        """(windows, repeats) bucket keys of equally long windows."""
        n = x.shape[1]
        return mix(self.walk(x) + mix(np.arange(self.repeats, dtype=np.uint64) + np.uint64(n << 16)))

    def walk(self, x):
        """(windows, repeats) sampled codes of equally long windows."""
        c, n = x.shape
        if n not in self.samples:
            g = np.random.default_rng([self.seed, n])
            hit = np.zeros((3 * n, self.repeats), bool)
            for r in range(self.repeats):
                hit[g.choice(3 * n, self.bits, replace=False), r] = True
            self.samples[n] = (hit, hit.any(1), g.integers(1, 1 << 63, (3 * n, self.repeats), dtype=np.uint64) | np.uint64(1))
        hit, some, odd = self.samples[n]
        flat = np.concatenate([x, np.zeros((c, 1), np.uint64)], 1).ravel()
        first = (np.arange(c) * (n + 1))[:, None]
        at, last = np.repeat(first, self.repeats, 1), first + n
        out = np.zeros((c, self.repeats), np.uint64)
        for j in range(int(np.flatnonzero(some)[-1]) + 1):
            word = flat[at]
            if some[j]:
                out = np.where(hit[j], mix(out * np.uint64(31) + word + np.uint64(j)), out)
            at = np.minimum(at + ((word * odd[j]) >> np.uint64(63)).astype(np.int64), last)
        return out

    def met(self, w, hit, lengths) -> dict[int, list]:
        """item -> starts of the windows that share a bucket with it. hit: positions of item triples, lengths: of their items."""
        found: dict[int, list] = {}
        most = np.bincount(lengths)
        for n in np.flatnonzero(most).tolist():
            slack = allowed(n)
            least = max(1, n - 2 - 3 * slack)
            if most[n] < least:
                continue
            at = np.zeros(len(w) + 1, np.int64)
            at[hit[lengths == n] + 1] = 1
            upto = np.cumsum(at)
            start = np.arange(max(1, len(w) - n + slack + 1))
            start = start[upto[np.minimum(start + n - 2, len(w))] - upto[start] >= least]
            for part in np.array_split(start, -(-len(start) // 4096)) if len(start) else []:
                place = part[:, None] + np.arange(n)
                body = np.where(place < len(w), w[np.minimum(place, len(w) - 1)], np.uint64(0))
                key = self.keys(body).ravel()
                lo, hi = np.searchsorted(self.bucket, key, "left"), np.searchsorted(self.bucket, key, "right")
                k = hi - lo
                row = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())
                pairs = np.unique(np.stack([self.owner[row], np.repeat(np.repeat(part, self.repeats), k)], 1), axis=0)
                for item, s in pairs.tolist():
                    found.setdefault(item, []).append(s)
        return found

    def find(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item, start, end, distance): the best run of each item within its allowed edits."""
        w = words_of(text)
        if len(w) < 3 or not len(self.h):
            return []
        t = _triples(w)
        hit = np.flatnonzero(self.filter[(t >> np.uint64(42)).astype(np.int64)])
        if not len(hit):
            return []
        lo, hi = np.searchsorted(self.h, t[hit], "left"), np.searchsorted(self.h, t[hit], "right")
        k = hi - lo
        if not k.any():
            return []
        row = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())
        found = []
        for i, starts in sorted(self.met(w, np.repeat(hit, k), self.of[row]).items()):
            n, best = len(self.words[i]), None
            slack, starts = allowed(n), np.array(starts)
            for same in np.split(starts, np.flatnonzero(np.diff(starts) > slack) + 1):  # neighbours are checked as one run
                a = max(0, int(same[0]) - slack)
                dist, x, y = edits(self.words[i], w[a : int(same[-1]) + n + slack])
                if dist <= slack and (best is None or dist < best[3]):
                    best = (self.ids[i], a + x, a + y, dist)
            if best:
                found.append(best)
        return found


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The items in blocks that fit a task, read from the driver one block at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").toLocalIterator():
        text = r[1].encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r[0], text))
        size += len(text)
    yield block


_indexes: dict = {}  # of this Python worker; the last one


def _finder(spark, items, repeats, bits):
    """The index is built once in each Python worker from the sent items."""
    sent, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def get() -> Index:
        if key not in _indexes:
            _indexes.clear()
            _indexes[key] = Index(sent.value, repeats, bits)
        return _indexes[key]

    return get


def find(docs: DataFrame, benchmark: DataFrame, repeats: int = 24, bits: int = 2, block_bytes: int = 8 << 20) -> DataFrame:
    """A row per document and item that it holds: the best run, in words of letters and digits."""
    docs, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), None
    for items in _blocks(benchmark, block_bytes):
        get = _finder(docs.sparkSession, items, repeats, bits)

        def run(batches, get=get):
            import pyarrow as pa

            index = get()
            for part in slices(batches, ["text"]):
                rows = [(i, *m) for i, t in zip(part.column("doc_id").to_pylist(), raw(part.column("text"))) for m in index.find(t)]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=[x.split()[0] for x in FOUND.split(", ")])

        one = docs.mapInArrow(run, FOUND)
        out = one if out is None else out.unionByName(one)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, repeats: int = 24, bits: int = 2, block_bytes: int = 8 << 20) -> DataFrame:
    """docs without the documents that hold a benchmark item; all columns are kept."""
    for items in _blocks(benchmark, block_bytes):
        get = _finder(docs.sparkSession, items, repeats, bits)

        def run(batches, get=get):
            import pyarrow as pa

            index = get()
            for part in slices(batches, ["text"]):
                yield part.filter(pa.array([not index.find(t) for t in raw(part.column("text"))], pa.bool_()))

        docs = map_whole(docs, run, docs.schema)
    return docs
