"""Language-model scores: a causal self-attention model over subword ids, trained in numpy, beside a word unigram base.

Words (lower-cased A-Z) are cut into subword ids by a public vocabulary. The model factors an id as class and id within class:
masked attention over the 8 to 15 ids before gives P(class), and counts over the whole training corpus give P(id | class)
(classes: ids clustered by their neighbours, and one for the end). Given its first id's class, a word is drawn from the corpus
counts of the words of that class or, if never seen, spelt id by id, so every text has a proper probability. A text is cut in
blocks of eight ids; each overlapping window holds a block and the one before it, and scores the block's ids once, many
windows a batch. Blocks lie in a run, a text's after an empty one, so that what a window needs of the block before it is computed once.

Each text is cut into ids once: the ids, beside the text, and the counts of words go to a scratch table, from which neighbours,
training and scores are taken.

All is gathered from the whole training corpus: word counts (the base), and through them the counts of ids by words and tokens and the
chance of new words; the neighbours of ids; and the attention weights, by rounds in which groups of documents train from the
same weights and are averaged, so that each window is trained on, once in a large corpus. The base needs each word's count: the `hot` most frequent words (a
fixed bound) go to the tasks; the others, a small share of the words, are joined by word and summed per document.

Null or wordless text: only the end. Null doc_id: in training, not held out. Repeated rows: counted and scored alike. Very long
texts: whole, in blocks. Empty table: no rows. No training row: N = 0, V = 0, uniform ids. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, raw, slices
from .langid import crc
from .tokens import locate

BLOCK = 8
SLOTS = 4096  # ids with an embedding of their own
READ = "doc_id long, held_out boolean, text string, ids binary, word binary, c long"  # a text and its ids, or a word's count
PIECES = "id long, tokens long, types long, firsts long, singles long"
ROWS = "doc_id long, held_out boolean, h long, n_tokens long, n_known long, hot double, score double, cold array<struct<word:binary,a:float,b:float>>"


class Vocabulary:
    """Subword ids of a word, by a .tiktoken file."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        with open(locate(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(ranks.values()) + 2
        self.end = self.size - 1
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(self.size, np.int64)
        self.spaced[[v for k, v in ranks.items() if k[:1] == b" "]] = 1
        self.begins = self.spaced == 1  # a word holds no space but the one put before it, so these ids begin a word; or the end
        self.begins[self.end] = True
        self.kind = np.dtype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.wide = np.zeros(self.size, np.int64)
        self.wide[[v for k, v in ranks.items() if not k.isascii()]] = 1

    def ids(self, word: bytes) -> list[int]:
        return self.encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))

    def many(self, words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of an Arrow array in one run, and their numbers by word. Cut together, unless an id spans two words."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py()
        found = self.encoding.encode_to_numpy(" " + joined.decode("utf-8", "replace"), disallowed_special=()).astype(np.int64)
        at = np.flatnonzero(self.spaced[found])
        if len(at) == len(words):
            return found, np.diff(np.r_[at, len(found)])
        each = [self.ids(w) for w in words.to_pylist()]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)


@functools.cache
def vocabulary_of(name: str) -> Vocabulary:
    """One a process, whatever groups and rounds it serves."""
    return Vocabulary(name)


def below(x: np.ndarray, most: float = 60) -> np.ndarray:
    """x, cut in place where it exceeds what exp takes; mostly it does not, and reading is cheaper than writing."""
    return np.minimum(x, most, out=x) if x.size and x.max() > most else x


@functools.cache
def keep_memory() -> None:
    """Freed arrays stay with the worker, up to 64 MB: pages given back and taken anew cost more than the arithmetic on them. glibc only."""
    import ctypes

    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass


class Attention:
    """One head of width d over embeddings of slots; the last position's embedding is added to what it attends to."""

    def __init__(self, slots: int, classes: int, d: int = 16, seed: int = 3):
        g = np.random.default_rng(seed)
        r = lambda *s: (g.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": (g.standard_normal((slots, d)) * 0.3).astype(np.float32), "q": r(d, d), "k": r(d, d), "v": r(d, d), "rel": np.zeros(2 * BLOCK, np.float32), "out": r(2 * d, classes) * np.float32(0.3), "b": np.zeros(classes, np.float32)}
        at = np.arange(BLOCK)[:, None] + BLOCK - 1 - np.arange(2 * BLOCK - 1)[None]
        self.back, self.mask = np.clip(at, 0, 2 * BLOCK - 1), at >= 0

    def forward(self, s: np.ndarray):
        """s: (m + 1, 8) slots of a run of blocks, the first only read. Logits, without the bias, of the classes of the 8 m ids after the
        first block, and what backward needs. Keys are kept by dimension as well: products with a transposed right side are slow."""
        p, d = self.p, self.p["q"].shape[0]
        e = p["emb"].take(s.ravel(), 0)
        w = np.concatenate([p["q"] * np.float32(d**-0.5), p["k"], p["v"]], 1)
        x, t = e @ w, w[:, d:].T @ e.T
        m, row, cell = len(s) - 1, x.strides[0], x.itemsize
        q = np.ndarray((m, BLOCK, d), x.dtype, x, (BLOCK - 1) * row, (BLOCK * row, row, cell))
        k, v = (np.ndarray((m, 2 * BLOCK - 1, d), x.dtype, x, i * d * cell, (BLOCK * row, row, cell)) for i in (1, 2))
        kt, vt = (np.ndarray((m, d, 2 * BLOCK - 1), t.dtype, t, i * d * t.strides[0], (BLOCK * cell, t.strides[0], cell)) for i in (0, 1))
        a = q @ kt
        a += np.where(self.mask, p["rel"][self.back], np.float32(-1e9))
        np.exp(below(a), out=a)
        a /= (a.reshape(-1, a.shape[2]) @ np.ones(a.shape[2], np.float32)).reshape(m, BLOCK, 1)
        z = np.empty((m * BLOCK, 2 * d), np.float32)
        np.matmul(a, v, out=z.reshape(m, BLOCK, 2 * d)[..., :d])
        z[:, d:] = e[BLOCK - 1 : -1]
        return z @ p["out"], (e, w, q, k, vt, a, z)

    def slopes(self, s, y, share) -> dict[str, np.ndarray]:
        """Gradients of the cross-entropy of the classes y of the ids after the first block, weighted by share."""
        p, d, m = self.p, self.p["q"].shape[0], len(s) - 1
        x, (e, w, q, k, vt, a, z) = self.forward(s)
        bias = np.exp(p["b"])
        np.exp(below(x), out=x)
        total = x @ bias
        at = np.arange(len(y)) * x.shape[1] + y
        x.reshape(-1)[at] -= total / bias.take(y)  # x * bias * share / total is the slope of the logits
        r = (share / total)[:, None]
        g = {"out": (z * r).T @ x * bias, "b": (r[:, 0] @ x) * bias}
        dz = x @ np.ascontiguousarray((p["out"] * bias).T)
        dz *= r
        dh = dz.reshape(m, BLOCK, 2 * d)[..., :d]
        da = dh @ vt
        da *= a
        da -= a * (da.reshape(-1, da.shape[2]) @ np.ones(da.shape[2], np.float32)).reshape(m, BLOCK, 1)
        g["rel"] = np.bincount(self.back.ravel(), np.ones(m, np.float32) @ da.reshape(m, -1) * self.mask.ravel(), 2 * BLOCK).astype(np.float32)
        dx = np.empty((m + 1, BLOCK, 3 * d), np.float32)
        dx[-1] = 0
        dx[0, : BLOCK - 1, :d] = 0
        for right, left, at in ((q, da, slice(d, 2 * d)), (dh, a, slice(2 * d, 3 * d))):
            left = left.transpose(0, 2, 1)
            np.matmul(left[:, :BLOCK], right, out=dx[:-1, :, at])
            dx[1:, :-1, at] += left[:, BLOCK:] @ right
        dx = dx.reshape(-1, 3 * d)
        dx[-1, :d] = 0
        dx[BLOCK - 1 : -1, :d] = (da @ k).reshape(-1, d)
        dw = e.T @ dx
        g["q"], g["k"], g["v"] = dw[:, :d] * np.float32(d**-0.5), dw[:, d : 2 * d], dw[:, 2 * d :]
        de = dx @ np.ascontiguousarray(w.T)
        de[BLOCK - 1 : -1] += dz[:, d:]
        at = s.ravel()
        g["emb"] = np.array([np.bincount(at, x, len(p["emb"])) for x in de.T], np.float32).T
        return g

    def step(self, runs, state, t, rate=0.01):
        """One step of Adam on the cross-entropy of the classes y of each run (s, y, valid) where valid."""
        p = self.p
        n = np.float32(sum(valid.sum() for _, _, valid in runs))
        parts = [self.slopes(s, y, valid / n) for s, y, valid in runs]
        for name in parts[0]:
            x = sum(g[name] for g in parts)
            m, w = state.setdefault(name, (np.zeros_like(p[name]), np.zeros_like(p[name])))
            m += 0.1 * (x - m)
            w += 0.01 * (x * x - w)
            p[name] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(w / (1 - 0.99**t)) + 1e-8)).astype(np.float32)


class Model:
    """Classes, within-class probabilities and attention."""

    def __init__(self, vocabulary: str, classes: int = 57):
        self.name, self.classes = vocabulary, classes

    def prepare(self, freq: np.ndarray, voc: Vocabulary) -> Model:
        """freq: counts of ids in the training corpus. Slots for the frequent ones; the others' classes go by their form."""
        top = np.argsort(-freq, kind="stable")[:SLOTS]
        self.top = top[freq[top] >= 20]
        self.rank = np.full(voc.size, 255, np.int64)
        self.rank[self.top[:255]] = np.arange(min(255, len(self.top)))
        self.row = np.full(voc.size, len(self.top))
        self.row[self.top] = np.arange(len(self.top))
        return self

    def group(self, near: np.ndarray, voc: Vocabulary) -> Model:
        """near: counts of the neighbours of the ids with a slot. Classes are k-means on them, of ids within words and of those that
        begin one apart; from self.begin on, classes begin a word or are the end."""
        k = (self.classes - 5) // 2
        self.begin = k + 2
        self.cls = np.where(voc.spaced == 1, self.begin + voc.wide, k + voc.wide)
        top = self.top
        for own, at in ((top[voc.spaced[top] == 0], 0), (top[(voc.spaced[top] == 1)], self.begin + 2)):
            own = own[own != voc.end]
            x = np.sqrt(near[self.row[own]])
            x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
            if len(own) <= k:
                continue
            centre = x[np.linspace(0, len(own) - 1, k).astype(int)]
            for _ in range(12):
                mine = (x @ centre.T).argmax(1)
                for c in range(k):
                    if (mine == c).any():
                        centre[c] = x[mine == c].mean(0)
                centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-9
            self.cls[own] = (x @ centre.T).argmax(1) + at
        self.cls[voc.end] = self.classes - 1
        self.slot = self.cls + 1  # slot 0: before the text
        self.slot[top] = np.arange(len(top)) + self.classes + 1
        self.net = Attention(int(self.slot.max()) + 1, self.classes)
        return self

    def learn(self, ids: np.ndarray, size: np.ndarray, most: int, rate: float, seed: list[int], run: int = 16, batch: int = 32) -> int:
        """Steps of Adam over `most` windows, in order of runs drawn at random; the number taken. A step holds `batch` runs, each of `run` blocks
        after the one before them, and goes over them in two halves, which fit the processor's cache."""
        s, y, valid = self.blocks(ids, size)
        spare = -(len(s) - 1) % run
        s, y, valid = (np.concatenate([x, np.zeros((spare, BLOCK), x.dtype)]) for x in (s, y, valid))
        own = valid[1:].any(1).reshape(-1, run).sum(1)
        g, state, done, t = np.random.default_rng(seed), {}, 0, 0

        def part(pick):
            at = (pick[:, None] * run + np.arange(run + 1)).ravel()
            real = valid[at]
            real[:: run + 1] = False
            return s[at], y[at[1:]].ravel(), real[1:].ravel()

        while done < most:
            order = g.permutation(len(own))
            order = order[: 1 + int(np.searchsorted(np.cumsum(own[order]), most - done))]
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                t += 1
                self.net.step([part(x) for x in (pick[: batch // 2], pick[batch // 2 :]) if len(x)], state, t, rate)
            done += int(own[order].sum())
        return done

    def finish(self, tokens: np.ndarray, types: np.ndarray, firsts: np.ndarray, singles: np.ndarray) -> Model:
        """Of each id in the whole training corpus: its tokens, the distinct words it is in, and as the first of a word its tokens and
        the words seen once. Words that are spelt are rare ones, so ids weigh there by words; the chance of a word never seen is that of
        one seen once (Good and Turing), per class."""
        c = types + 0.1 + 1e-6 * tokens
        sums = lambda x: np.bincount(self.cls, x, self.classes)
        self.inside = np.log(c / sums(c)[self.cls])
        n, once = sums(firsts), sums(singles)
        self.words = np.log(np.maximum(n, 1))
        new = (once + 0.5) / (n + 1)
        self.new, self.known = np.log(new), np.log1p(-new)
        return self

    def blocks(self, ids: np.ndarray, size: np.ndarray):
        """The sequences that follow each other in ids as (blocks, 8) slots, their classes and which are real; each begins a block after an
        empty one."""
        n = -(-size // BLOCK) + 1
        at = np.arange(len(ids)) + np.repeat((np.cumsum(n) - n + 1) * BLOCK - (np.cumsum(size) - size), size)
        total = int(n.sum()) * BLOCK
        slots, y, valid = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, bool)
        slots[at], y[at], valid[at] = self.slot.take(ids), self.cls.take(ids), True
        return slots.reshape(-1, BLOCK), y.reshape(-1, BLOCK), valid.reshape(-1, BLOCK)

    def score(self, ids: np.ndarray, size: np.ndarray, most: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """log P(class | ids before) and log P(a word begins or the text ends) at each id of the sequences that follow each other in ids."""
        s, y, valid = self.blocks(ids, size)
        b = self.net.p["b"]
        pick = np.exp(b)[:, None] * np.ones((1, 2), np.float32)
        pick[: self.begin, 1] = 0
        got, both = np.zeros(y.shape, np.float32), np.zeros((*y.shape, 2), np.float32)
        for i in range(0, len(s) - 1, most):
            part = y[i + 1 : i + 1 + most]
            x, _ = self.net.forward(s[i : i + 1 + most])
            below(x)
            got[i + 1 : i + 1 + most] = x.reshape(-1)[np.arange(len(x)) * x.shape[1] + part.ravel()].reshape(part.shape)
            both[i + 1 : i + 1 + most] = (np.exp(x, out=x) @ pick).reshape(*part.shape, 2)
        both = np.log(both[valid] + 1e-30).astype(np.float64)
        return got[valid] + b.take(y[valid]).astype(np.float64) - both[:, 0], both[:, 1] - both[:, 0]


def _words(text):
    """The lower-cased words of each text in one Arrow array, and their numbers by text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    found = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words, cuts = found.flatten().cast(pa.binary()), found.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    done = np.cumsum(np.r_[0, full])[cuts - cuts[0]]
    return words.filter(pa.array(full)), np.diff(done)


def _cut(voc: Vocabulary, text):
    """The different words of the texts, each word's place among them, the numbers of words by text, the ids of each text's words and then its
    end, as one flat run, and where the ends are."""
    words, n = _words(text)
    found = words.dictionary_encode()
    at = found.indices.to_numpy()
    pool, each = voc.many(found.dictionary)
    size, start = each[at], (np.cumsum(each) - each)[at]
    done = np.cumsum(np.r_[0, size])  # ids of the words before
    ends = done[np.cumsum(n)] + np.arange(len(n))
    ids = np.full(int(done[-1]) + len(n), voc.end, voc.kind)
    inner = np.ones(len(ids), bool)
    inner[ends] = False
    ids[inner] = pool.astype(voc.kind).take(np.arange(done[-1]) + np.repeat(start - done[:-1], size)) if len(at) else []
    return found.dictionary, at, n, ids, ends


def _read(name: str, most: int = 400_000):
    """Rows of READ: each text with the ids of its words and then the end, and the counts of the training texts' words."""

    def run(batches):
        import pyarrow as pa

        keep_memory()
        voc = vocabulary_of(name)
        names = [c.split()[0] for c in READ.split(", ")]
        none = lambda n, *kinds: [pa.nulls(n, k) for k in kinds]
        counts = pa.table({"word": pa.array([], pa.binary()), "c": pa.array([], pa.int64())})

        def rows(counts):
            for b in counts.to_batches():
                yield pa.RecordBatch.from_arrays([*none(len(b), pa.int64(), pa.bool_(), pa.string(), pa.binary()), b.column("word"), b.column("c")], names=names)

        for part in slices(batches, ["text"], 8 << 20):
            words, at, n, ids, ends = _cut(voc, part.column("text"))
            offsets = (np.r_[0, ends + 1] * voc.kind.itemsize).astype(np.int32)
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), part.column("text"), ids, *none(len(n), pa.binary(), pa.int64())], names=names)
            seen = np.bincount(at[~np.repeat(part.column("held_out").to_numpy(zero_copy_only=False), n)], minlength=len(words))
            some = np.flatnonzero(seen)
            more = pa.table({"word": words.take(pa.array(some)), "c": pa.array(seen[some])})
            counts = pa.concat_tables([counts, more]).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])
            if len(counts) > most:
                yield from rows(counts)
                counts = counts.slice(0, 0)
        yield from rows(counts)

    return run


def _pieces(name: str):
    """Of each id: tokens, distinct words, and as a word's first: tokens and words seen once."""

    def run(batches):
        import pyarrow as pa

        keep_memory()
        voc = vocabulary_of(name)
        total = np.zeros((4, voc.size), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column("c").to_numpy()
            ids, size = voc.many(b.column("word"))
            first = ids[np.cumsum(size) - size]
            for x, at, weight in zip(total, (ids, ids, first, first), (np.repeat(c, size), None, c, c == 1)):
                x += np.bincount(at, weight, voc.size).astype(np.int64)
        some = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(x[some]) for x in total)], names=PIECES.replace(" long", "").split(", "))

    return run


def _stored(column, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column of READ in one run, and their numbers by row."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), voc.kind).astype(np.int64), np.array([len(x) for x in parts], np.int64) // voc.kind.itemsize


def _near(sent):
    """Counts of neighbours: cell (row of an id with a slot, place of its neighbour), n."""

    def run(batches):
        import pyarrow as pa

        keep_memory()
        model = sent.value
        voc = vocabulary_of(model.name)
        near = np.zeros((len(model.top) + 1) * 512, np.int64)
        for part in slices(batches, ["ids"]):
            q, _ = _stored(part.column("ids"), voc)
            before = q[:-1] != voc.end  # an end has no neighbour after it
            row, rank = model.row.take(q) * 512, model.rank.take(q)
            near += np.bincount((row[:-1] + rank[1:])[before], minlength=len(near))
            near += np.bincount((row[1:] + rank[:-1])[before] + 256, minlength=len(near))
        some = np.flatnonzero(near)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(near[some])], names=["cell", "n"])

    return run


def _learner(sent, turn: int, part: float, rate: float):
    """One group of training documents, given by ids or by text: the weights after `part` of its windows, times their number."""

    def run(table):
        import copy

        import pyarrow as pa

        keep_memory()
        model = copy.deepcopy(sent.value)
        voc = vocabulary_of(model.name)
        if "ids" in table.column_names:
            rows = table.column("ids").to_pylist()
        else:
            *_, ids, ends = _cut(voc, table.column("text").combine_chunks())
            rows = [x.tobytes() for x in np.split(ids, ends[:-1] + 1)]
        ids, size = _stored(pa.array(sorted(rows), pa.binary()), voc)
        windows = int((-(-size // BLOCK)).sum())
        n = model.learn(ids, size, max(1, round(windows * part)), rate, [turn, len(size), windows])
        flat = np.concatenate([p.ravel() for p in model.net.p.values()]).astype(np.float64)
        return pa.table({"at": pa.array(np.arange(len(flat))), "x": pa.array(flat * n), "n": pa.array(np.full(len(flat), n, np.int64))})

    return run


def fit(train: DataFrame, counts: DataFrame, voc: Vocabulary, vocabulary: str, ends: int, rounds: int = 6, least_windows: int = 230_000, group: int = 1 << 15) -> Model:
    """Classes from the neighbours of ids in the training texts, then attention weights by rounds of averaging: groups of texts (of
    `group` windows a round, or eight times the square root of a round's) each take steps from the same weights, whose means, by windows,
    start the next round. Each text has its round, so all windows are used once; where there are few, each text is in
    every round and its windows are used once or more. The driver holds tables of the model's size."""
    spark = train.sparkSession
    found = counts.mapInArrow(_pieces(vocabulary), PIECES).groupBy("id").agg(*(F.sum(c).alias(c) for c in ("tokens", "types", "firsts", "singles"))).toPandas()  # a row per id
    of = np.zeros((4, voc.size))
    of[:, found["id"]] = found[["tokens", "types", "firsts", "singles"]].to_numpy().T
    of[0, voc.end] = ends
    model = Model(vocabulary).prepare(of[0], voc)
    near = np.zeros((len(model.top) + 1) * 512, np.float32)
    cells = train.select("ids").mapInArrow(_near(spark.sparkContext.broadcast(model)), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most 512 a slot
    near[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    model.group(near.reshape(-1, 512), voc)
    blocks = float(of[0].sum()) / BLOCK
    if blocks:
        few = blocks < least_windows
        part = max(1.0, least_windows / blocks) / rounds if few else 1.0
        each = max(blocks, least_windows) / rounds
        groups = max(1, round(each / max(group, 8 * each**0.5)))
        dealt = train.select("ids", F.pmod(F.xxhash64("ids", F.lit(3)), F.lit(groups)).alias("g"), F.pmod(F.xxhash64("ids", F.lit(4)), F.lit(rounds)).alias("turn"))
        for turn in range(rounds):
            sent = spark.sparkContext.broadcast(model)
            now = dealt if few else dealt.where(F.col("turn") == turn)
            got = now.select("ids", "g").groupBy("g").applyInArrow(_learner(sent, turn, part, 0.02 if turn < rounds - 2 else 0.005), "at long, x double, n long")
            mean = got.groupBy("at").agg((F.sum("x") / F.sum("n")).alias("x")).toArrow()  # a row per weight
            if not mean.num_rows:  # no text has this round
                continue
            flat = np.zeros(mean.num_rows, np.float32)
            flat[mean["at"].to_numpy()] = mean["x"].to_numpy()
            done = 0
            for name, p in model.net.p.items():
                model.net.p[name] = flat[done : done + p.size].reshape(p.shape)
                done += p.size
    return model.finish(*of)


def _rows(sent):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from xxhash import xxh3_64_intdigest

        keep_memory()
        model, hot, ends, total = sent.value
        voc = vocabulary_of(model.name)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        words = pa.array(list(hot), pa.binary())
        counts = np.append(np.fromiter(hot.values(), np.int64, len(hot)), -1)
        for part in slices(batches, ["text"], 4 << 20):
            texts = [t.lower() for t in raw(part.column("text"))]
            flat, _ = _words(part.column("text"))
            count = counts[pc.index_in(flat, words).fill_null(len(hot)).to_numpy()]
            ids, size = _stored(part.column("ids"), voc)
            begin = np.flatnonzero(voc.begins.take(ids))  # of units, which are words or ends
            own = ids[begin] != voc.end
            last = np.flatnonzero(~own)
            n = np.diff(last, prepend=-1) - 1
            cl, starts = model.score(ids, size)
            cl[begin] -= starts[begin]  # a word begins here for certain; that the last one was over counts where it is spelt
            spelt = np.add.reduceat(cl + model.inside[ids], begin)
            spelt[own] += starts[begin[np.flatnonzero(own) + 1]]
            kind = model.cls[ids[begin]]
            a = cl[begin] + model.known[kind] - model.words[kind]
            b = spelt + model.new[kind]
            c = np.full(len(own), -1, np.int64)
            c[own] = count
            value = np.where(c > 0, np.logaddexp(a + np.log(np.maximum(c, 1)), b), 0.0)
            value[last] = spelt[last]
            base = np.where(c > 0, np.log10(np.maximum(c, 0) + 1.0) - np.log10(total), 0.0)
            base[last] = np.log10(ends + 1.0) - np.log10(total)
            first = np.r_[0, last[:-1] + 1]
            cold = own & (c <= 0)
            struct = pa.StructArray.from_arrays([flat.filter(pa.array(cold[own])), pa.array(a[cold].astype(np.float32)), pa.array(b[cold].astype(np.float32))], names=["word", "a", "b"])
            k = np.add.reduceat(cold.astype(np.int64), first)
            h = [xxh3_64_intdigest(t) - (1 << 63) for t in texts]
            cols = (h, n + 1, n - k + (ends > 0), np.add.reduceat(base, first), np.add.reduceat(value, first) / np.log(10))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), *(pa.array(x, t) for x, t in zip(cols, kinds)), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(k)], pa.int32()), struct)],
                names=["doc_id", "held_out", "h", "n_tokens", "n_known", "hot", "score", "cold"],
            )

    return run


def score(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", folds: int = 7, fold: int = 2, hot: int = 200_000, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of docs."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lm")
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    x = x.withColumn("held_out", crc(folds) == fold)
    read = scratch.put(x.select("doc_id", "held_out", "text").mapInArrow(_read(vocabulary), READ))
    counts = scratch.put(read.where("c is not null").groupBy("word").agg(F.sum("c").alias("c")))
    x = read.where("c is null").select("doc_id", "held_out", "text", "ids")
    train = x.where(~F.col("held_out"))
    types, words, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first() + (train.count(),)
    n, v = words + rows, types + (rows > 0)
    model = fit(train, counts, Vocabulary(vocabulary), vocabulary, rows)
    # the counts that at most `hot` words exceed, from a histogram in powers of 2 ** (1 / 16): at most 1,024 rows
    bucket = F.floor(F.log2("c") * 16).cast("int")
    least, room = 1 << 62, hot
    for r in sorted(counts.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(), reverse=True):
        if r["n"] > room:
            break
        least, room = r["c"], room - r["n"]
    top = {bytes(r[0]): r[1] for r in counts.where(F.col("c") >= least).collect()}
    sent = spark.sparkContext.broadcast((model, top, rows, n + v + 1))
    y = scratch.put(x.mapInArrow(_rows(sent), ROWS))
    scratch.drop(read)
    # words outside the hot ones: counts by a join, sums per text, over the number of its repeated rows
    cold = y.select("doc_id", "h", F.explode("cold").alias("x")).select("doc_id", "h", "x.*")
    tail = counts.where(F.col("c") < least)
    value = F.log10(F.coalesce("c", F.lit(0)) + 1) - F.log10(F.lit(float(n + v + 1)))
    # log10(c * e**a + e**b), from the larger of the two
    seen = F.col("a").cast("double") + F.log(F.col("c"))
    spelt = F.col("b").cast("double")
    both = F.greatest(seen, spelt) + F.log1p(F.exp(-F.abs(seen - spelt)))
    whole = F.when(F.col("c") > 0, both).otherwise(spelt) / float(np.log(10))
    per = cold.join(tail, "word", "left").groupBy("doc_id", "h").agg(F.sum(value).alias("sum"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("more"), F.sum(whole).alias("rest"))
    copies = y.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("copies"))
    per = per.withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    copies = copies.withColumnsRenamed({"doc_id": "_e", "h": "_g"})
    z = y.join(per, y["doc_id"].eqNullSafe(per["_d"]) & (y["h"] == per["_h"]), "left").join(copies, y["doc_id"].eqNullSafe(copies["_e"]) & (y["h"] == copies["_g"]))
    return z.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce(F.col("more") / F.col("copies"), F.lit(0)).cast("long")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("hot") + F.coalesce(F.col("sum") / F.col("copies"), F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce(F.col("rest") / F.col("copies"), F.lit(0.0))).alias("score"))
