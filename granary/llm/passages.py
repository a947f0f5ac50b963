"""Near-duplicate passages by compact windows.

Tokens are five-word shingles. Under each of `hashes` min-hash functions, a text's subsequences of at least `words` words fall into
compact windows (l, c, r): all [i, j] with l <= i <= c <= j <= r have their minimum at c. The windows are the nodes of
the Cartesian tree over the hashes, cut where a node is shorter than a passage; nodes that are long enough are the minima of
sliding windows, so the tree is built over those alone. Windows of different documents that share a minimum meet; in a
group of any size each document is paired with the first one only, if they meet under at least `need` functions with overlapping
windows. That first one may hold a mere variant. So the groups with a window that does not lie within a passage found meet
again by finer keys, if as many functions' windows lie around, and each document is paired with the first one under each of them: the minima of two and of three functions over
one run of `words` words, and the exact content of every such run.
Pairs are verified on the texts: runs of common shingles, bridged over a few edits, of at least `words` words with a
Jaccard similarity of 0.8 or more.

The result has a row per passage of a document that repeats in another: its words [start_word, end_word), the first document that
holds it and where, and their similarity; the first document's own passage is a row too. Exact repeats of `words` words or more
are always compared with the first document that holds them; a near repeat of one passage's length at similarity 0.8 with
probability 0.97. Earlier documents that hold variants of it, too far from both, can stand before it under all keys that the two
share; the README has the recall measured with one, two and four such variants.

Null or short texts: no rows. Null doc_id: left out. Repeated rows of one doc_id: as one. Empty table: no rows. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORDS, Scratch, mix, raw, shingle_hashes, slices, word_hashes

LEAST = 50  # words of a passage
GROUP = 64  # documents verified against one text at a time
FOUND = "doc_id long, start_word int, end_word int, first_doc_id long, first_start int, first_end int, similarity double"


def shingles(text: bytes):
    return shingle_hashes(word_hashes(text.lower().split()))


PLACE = (1 << 28) - 1  # bits of a position


def minima(v, least: int):
    """Positions of the sliding windows' minima, the first of equal ones, each once: minima of value and position packed in one number,
    over spans that double."""
    import numpy as np

    x = (v & np.uint64(~PLACE & 0xFFFFFFFFFFFFFFFF)) | np.arange(len(v), dtype=np.uint64)
    span = 1
    while 2 * span <= least:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < least:
        x = np.minimum(x[: len(x) - (least - span)], x[least - span :])
    at = (x & np.uint64(PLACE)).astype(np.int64)
    return at[np.r_[True, at[1:] != at[:-1]]]


def windows(v, least: int):
    """Compact windows (l, c, r) of at least `least` positions of the values v: nodes of the Cartesian tree."""
    if len(v) < least:
        return []
    at = minima(v, least)
    at, value = at.tolist(), v[at].tolist()
    out, stack = [], []  # positions and values of the path from the root; l of each
    for c, x in zip(at, value):
        while stack and stack[-1][1] > x:
            p, _, l = stack.pop()
            out.append((l, p, c - 1))
        stack.append((c, x, stack[-1][0] + 1 if stack else 0))
    return out + [(l, p, len(v) - 1) for p, _, l in stack]


def _salts(hashes: int):
    import numpy as np

    return [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 3) & 0xFFFFFFFFFFFFFFFF) for k in range(hashes)]


def _windows(least: int, hashes: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        salts = _salts(hashes)
        for part in slices(batches, ["text"]):
            sig, ids, pos = [], [], []
            for i, text in zip(part.column("doc_id").to_pylist(), raw(part.column("text"))):
                h = shingles(text)
                if i is None or len(h) < least:
                    continue
                for k, salt in enumerate(salts):
                    v = mix(h + salt)
                    w = np.array(windows(v, least), np.int64)
                    l, c, r = w[:, 0], w[:, 1], w[:, 2]
                    sig.append(v[c] ^ np.uint64(k))
                    ids.append(np.full(len(w), i, np.int64))
                    pos.append((k << 60) | (c << 32) | (np.minimum(c - l, 65535) << 16) | np.minimum(r - c, 65535))
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *(x.view(np.int64) for x in sig)])), pa.array(np.concatenate([none, *ids])), pa.array(np.concatenate([none, *pos]))], names=["sig", "doc_id", "pos"])

    return run


OPEN = 1 << 62  # of a window's position: it is not within a passage found


def _backed(least: int, need: int):
    """The windows that at least `need` functions' windows back: only such can hold a passage. Documents without an open one still
    stand as first ones for others."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, kept = [], []
            for i, at in zip(b.column("doc_id").to_pylist(), b.column("at")):
                pos = np.unique(at.values.to_numpy() if len(at) else np.zeros(0, np.int64))
                kind, c = (pos >> 60) & 3, (pos >> 32) & ((1 << 28) - 1)
                near = np.zeros(len(pos), np.int64)
                for k in range(4):
                    own = np.sort(c[kind == k])
                    near += np.searchsorted(own, c + least, "left") > np.searchsorted(own, c - least, "right")
                pos = pos[near >= need]
                if len(pos):
                    ids.append(i)
                    kept.append(pos)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.list_(pa.int64()))], names=["doc_id", "at"])

    return run


def _keys(least: int, hashes: int):
    """Keys by which documents meet that share the windows `at`: the content of each run of `least` shingles in those of the first
    hash function (by prefix sums of a polynomial hash), and for every window the minima of two and of three functions over one
    run in it, for the runs that end, centre and begin at its minimum. A key is open if a window that gives it is."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        none = np.zeros(0, np.int64)
        base = 0x9E3779B97F4A7C15
        salts = _salts(hashes)

        def spans(low, high, n):
            edge = np.bincount(np.minimum(low, n), minlength=n + 1) - np.bincount(np.minimum(high + 1, n), minlength=n + 1)
            return np.cumsum(edge[:n]) > 0

        for part in slices(batches, ["text"]):
            keys, opens, ids = [none], [np.zeros(0, bool)], [none]
            for i, text, at in zip(part.column("doc_id").to_pylist(), raw(part.column("text")), part.column("at")):
                h = shingles(text)
                n = len(h) - least + 1
                if n < 1:
                    continue
                pos = at.values.to_numpy()
                is_open, pos = (pos & OPEN) > 0, pos & ~np.int64(OPEN)
                kind, c = pos >> 60, (pos >> 32) & ((1 << 28) - 1)
                low = np.maximum(c - np.minimum((pos >> 16) & 65535, least - 1), 0)
                high = np.minimum(c, c + (pos & 65535) - least + 1)
                own = kind == 0
                mine, flags = [], []
                start = np.flatnonzero(spans(low[own], high[own], n))
                if len(start):
                    up = np.cumprod(np.full(len(h), base, np.uint64))
                    down = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up)])
                    mine.append((total[start + least] - total[start]) * down[start])
                    flags.append(spans(low[own & is_open], high[own & is_open], n)[start])
                fit = high >= low
                kind, c, low, high, is_open = kind[fit], c[fit], low[fit], high[fit], is_open[fit]
                rows = np.concatenate([low, (low + high) // 2, high])
                who, first, flag = np.tile(kind, 3), np.tile(c, 3), np.tile(is_open, 3)
                runs = h[rows[:, None] + np.arange(least)]
                for k in range(hashes):
                    sel = who == k
                    if hashes > 1 and sel.any():
                        key = mix(h[first[sel]] + salts[k]) + np.uint64(k)
                        for j in range(1, min(3, hashes)):
                            key = mix(key * np.uint64(31) + mix(runs[sel] + salts[(k + j) % hashes]).min(1))
                            mine.append(key)
                            flags.append(flag[sel])
                if not mine:
                    continue
                key, at = np.unique(np.concatenate(mine), return_inverse=True)
                keys.append(key.view(np.int64))
                opens.append(np.bincount(at, np.concatenate(flags), len(key)) > 0)
                ids.append(np.full(len(key), i, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(opens))], names=["content", "doc_id", "open"])

    return run


def _runs(own, other, order, ranked, bridge: int = 12):
    """Passages of `own` that repeat in `other`: (start, end, other_start, other_end, similarity) in shingles, ends inclusive. order,
    ranked: other's positions and values by value."""
    import numpy as np

    found = np.searchsorted(ranked, own)
    found[found == len(other)] = 0
    hit = np.flatnonzero(ranked[found] == own)
    if 100 * len(hit) < 80 * (LEAST - WORDS + 1):  # a passage has as many shingles in common
        return []
    # of several places in the other text take the one on the last hit's diagonal, if any
    place = order[found[hit]]
    many = np.searchsorted(ranked, own[hit], "right") - found[hit]
    for n in np.flatnonzero(many > 1).tolist():
        if n:
            p, f = int(hit[n]), int(found[hit[n]])
            spots = order[f : f + int(many[n])]
            place[n] = spots[int(np.argmin(np.abs(spots - p - (place[n - 1] - hit[n - 1]))))]
    diag = place - hit

    def passages(most: int):
        cut = np.flatnonzero((np.diff(hit) > most) | (np.abs(np.diff(diag)) > most)) + 1
        low, high = np.r_[0, cut], np.r_[cut, len(hit)]
        for i in np.flatnonzero(hit[high - 1] - hit[low] + WORDS >= LEAST).tolist():  # shorter ones hold no passage
            seg = place[low[i] : high[i]]
            yield int(hit[low[i]]), int(hit[high[i] - 1]), int(seg.min()), int(seg.max())

    out = []
    for a, b, x, y in passages(bridge):
        pieces = [(a, b, x, y)]
        mine, theirs = np.unique(own[a : b + 1]), np.unique(other[x : y + 1])
        both = len(np.intersect1d(mine, theirs, assume_unique=True))
        if 100 * both < 80 * (len(mine) + len(theirs) - both):
            pieces = [p for p in passages(1) if p[0] >= a and p[1] <= b]
        for s, e, u, v in pieces:
            if e - s + WORDS >= LEAST and v - u + WORDS >= LEAST:
                mine, theirs = np.unique(own[s : e + 1]), np.unique(other[u : v + 1])
                both = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * both >= 80 * (len(mine) + len(theirs) - both):
                    out.append((s, e, u, v, both / (len(mine) + len(theirs) - both)))
    return out


def _verify(table):
    """One first document and some of those that meet it."""
    import pyarrow as pa

    rows, texts, first = [], {}, None
    for i, text, is_first in zip(*(table.column(c).to_pylist() for c in ("doc_id", "text", "is_first"))):
        if is_first:
            first = (i, text)
        else:
            texts[i] = text
    other = shingles(first[1].encode())
    order = other.argsort(kind="stable")
    ranked = other[order]
    own = set()
    for i, text in sorted(texts.items()):
        for s, e, u, v, sim in _runs(shingles(text.encode()), other, order, ranked):
            rows.append((i, s, e + WORDS, first[0], u, v + WORDS, sim))
            own.add((first[0], u, v + WORDS, first[0], u, v + WORDS, 1.0))
    cols = list(zip(*rows, *sorted(own))) or [[]] * 7
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
    return pa.table({x.split()[0]: pa.array(c, k) for x, c, k in zip(FOUND.split(", "), cols, kinds)})


def _verified(docs: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """FOUND of the pairs (doc_id, first_id): the later documents of a first one in groups of GROUP."""
    parts = pairs.groupBy("first_id").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    ends = pairs.join(parts, "first_id").select("doc_id", "first_id", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"))
    firsts = ends.select(F.col("first_id").alias("doc_id"), "first_id", "part").distinct().withColumn("is_first", F.lit(True))
    wanted = scratch.put(ends.withColumn("is_first", F.lit(False)).unionByName(firsts))
    found = scratch.put(docs.join(wanted.hint("merge"), "doc_id").where("text is not null").groupBy("first_id", "part").applyInArrow(_verify, FOUND))
    scratch.drop(wanted)
    scratch.free_shuffles()
    return found


def repeats(docs: DataFrame, words: int = LEAST, hashes: int = 4, need: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """FOUND: the passages of docs that repeat in other documents."""
    scratch = scratch or Scratch(docs.sparkSession, "passages")
    least = words - WORDS + 1
    if hashes > 4:
        raise ValueError("a window's position has two bits for its hash function")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    w = docs.mapInArrow(_windows(least, hashes), "sig long, doc_id long, pos long")
    by = Window.partitionBy("sig")
    w = w.select("doc_id", "pos", F.min(F.struct("doc_id", "pos")).over(by).alias("first"), F.max("doc_id").over(by).alias("last")).where("last > first.doc_id")
    shared = scratch.put(w.select("doc_id", "pos", F.col("first.doc_id").alias("first_id"), F.col("first.pos").alias("first_pos")))
    scratch.free_shuffles()
    met = shared.where("doc_id > first_id")
    # interval join: the windows, laid on one another by their minima, overlap for a passage's length
    reach = lambda bits: F.least(F.shiftright("pos", bits).bitwiseAND(65535), F.shiftright("first_pos", bits).bitwiseAND(65535))
    kind = F.expr("shiftleft(1, cast(shiftright(pos, 60) as int))")
    pairs = scratch.put(met.where(reach(16) + reach(0) + 1 >= least).groupBy("doc_id", "first_id").agg(F.bit_or(kind).alias("kinds")).where(F.bit_count("kinds") >= need).select("doc_id", "first_id"))
    found = _verified(docs, pairs, scratch)
    # a group stays open if a window of a member is not wholly within a passage found: its first document may hold a mere variant.
    # All its members meet again, by finer keys
    c = F.shiftright("pos", 32).bitwiseAND((1 << 28) - 1)
    low, high = c - F.least(F.shiftright("pos", 16).bitwiseAND(65535), F.lit(least - 1)), c + F.least(F.col("pos").bitwiseAND(65535), F.lit(least - 1))
    rows = met.select("doc_id", "pos", "first_id", "first_pos", low.alias("low"), high.alias("high"))
    within = found.where("first_doc_id < doc_id").select(F.col("doc_id").alias("d"), F.col("start_word").alias("s"), (F.col("end_word") - WORDS).alias("e")).distinct()
    open_ = scratch.put(rows.join(within.hint("merge"), (F.col("doc_id") == F.col("d")) & (F.col("low") >= F.col("s")) & (F.col("high") <= F.col("e")), "left_anti").select("doc_id", "pos", "first_id", "first_pos"))
    members = shared.join(open_.select("first_id", "first_pos").distinct().hint("merge"), ["first_id", "first_pos"], "left_semi").select("doc_id", "pos")
    at = members.unionByName(open_.select("doc_id", F.col("pos").bitwiseOR(F.lit(OPEN)).alias("pos"))).groupBy("doc_id").agg(F.collect_list("pos").alias("at"))
    at = scratch.put(at.mapInArrow(_backed(least, need), "doc_id long, at array<long>"))
    scratch.drop(shared)
    scratch.free_shuffles()
    keys = docs.join(at.hint("merge"), "doc_id").where("text is not null").mapInArrow(_keys(least, hashes), "content long, doc_id long, open boolean")
    again = keys.select("doc_id", "open", F.min("doc_id").over(Window.partitionBy("content")).alias("first_id")).where("open and doc_id > first_id").select("doc_id", "first_id").distinct()
    more = scratch.put(again.join(pairs.hint("merge"), ["doc_id", "first_id"], "left_anti"))
    scratch.drop(at, open_)
    scratch.free_shuffles()
    both = found.unionByName(_verified(docs, more, scratch))
    return both.groupBy(*[x.split()[0] for x in FOUND.split(", ")[:6]]).agg(F.max("similarity").alias("similarity"))
