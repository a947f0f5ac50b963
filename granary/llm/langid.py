"""Language of whole texts from a linear-chain conditional random field over words.

A word's emission is the sum of learned weights of its character bigrams and trigrams with word ends, its affixes of up to four
characters and, for frequent words, its lexicon entry. Learned transitions tie neighbours, so code-switched text changes
label where the words do; forward-backward gives each word's marginals. A document's score for a language is the mean of its
words' marginals, and its language the best one.

Training: of every lang value at most `sample` labelled documents, and at most `stretches` runs of up to 32 of their words (the
documented bounds), chosen by hashes; a value with less is learned from all that it has. Some runs are spliced from two
languages; the conditional likelihood is raised by Adagrad on the driver.
Chains in use are stretches of 64 words of one text.

Null or letterless text: `und`, score 0. No labelled row at all: every text is `und`. Null lang: not learned from. Null
doc_id: predicted, never learned from, not held out. Very long texts: whole, in slices. Repeated rows: predicted
alike. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, slices

WORD = re.compile(r"[^\W\d_]+")
BITS = 17  # of the table of character n-grams and affixes
STRETCH = 64
FOUND = "doc_id long, held_out boolean, lang_pred string, score double"


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the feature table for each word, flat, and where each word's begin."""
    flat = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.r_[0, np.cumsum(n)[:-1]]
    end = start + n
    word = np.repeat(np.arange(len(words)), n)
    pos = np.arange(len(flat))
    mask = np.uint64((1 << BITS) - 1)
    rows, of = [], []
    code = flat.copy()
    for k in (2, 3, 4, 5):
        code = code[:-1] * np.uint64(0x100000001B3) + flat[k - 1 :] if len(code) > 1 else code[:0]
        p = pos[: len(code)]
        w = word[: len(code)]
        ok = p + k <= end[w]
        if k > 3:  # longer ones as affixes only
            ok &= (p == start[w]) | (p + k == end[w])
        rows.append((mix(code[ok] + np.uint64(k)) & mask).astype(np.int64))
        of.append(w[ok])
    rows, of = np.concatenate(rows), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return rows[order], np.searchsorted(of[order], np.arange(len(words)))


class Field:
    """Weights, and inference over batches of stretches."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        self.labels, self.lexicon = labels, lexicon
        n = len(labels)
        self.w = np.zeros((1 << BITS, n), np.float32)
        self.own = np.zeros((len(lexicon) + 1, n), np.float32)  # the last row is for other words and stays 0
        self.trans, self.start = np.zeros((n, n)), np.zeros(n)

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        rows, at = _features(words)
        own = np.fromiter((self.lexicon.get(x, -1) for x in words), np.int64, len(words))
        return np.add.reduceat(self.w[rows], at, 0) + self.own[own]

    def marginals(self, e: np.ndarray, mask: np.ndarray):
        """e: (chains, steps, labels), mask: (chains, steps), padding last. Marginals and the sum of pair marginals."""
        c, t, n = e.shape
        x = np.exp(e - e.max(2, keepdims=True))
        move = np.exp(self.trans - self.trans.max()).astype(x.dtype)
        alpha, beta = np.empty_like(x), np.ones_like(x)
        alpha[:, 0] = np.exp(self.start - self.start.max()) * x[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
        for i in range(1, t):
            a = (alpha[:, i - 1] @ move) * x[:, i]
            alpha[:, i] = a / a.sum(1, keepdims=True)
        for i in range(t - 2, -1, -1):
            b = (x[:, i + 1] * beta[:, i + 1]) @ move.T
            b /= b.sum(1, keepdims=True)
            beta[:, i] = np.where(mask[:, i + 1, None], b, 1)
        m = alpha * beta
        return m / m.sum(2, keepdims=True), alpha, beta, x, move

    def fit(self, chains: list[list[int]], tags: list[list[int]], words: list[str], steps: int = 32, rounds: int = 40, rate: float = 0.5):
        n, c = len(self.labels), len(chains)
        ids, y, mask = np.zeros((c, steps), np.int64), np.zeros((c, steps), np.int64), np.zeros((c, steps), bool)
        for k, (a, b) in enumerate(zip(chains, tags)):
            ids[k, : len(a)], y[k, : len(a)], mask[k, : len(a)] = a, b, True
        rows, at = _features(words)
        count = np.diff(np.r_[at, len(rows)])
        own = np.fromiter((self.lexicon.get(x, -1) for x in words), np.int64, len(words))
        flat, total = ids[mask], mask.sum()
        gold_t = np.zeros((n, n))
        both = mask[:, 1:]
        np.add.at(gold_t, (y[:, :-1][both], y[:, 1:][both]), 1)
        gold_s = np.bincount(y[:, 0], minlength=n)
        acc = [np.full(p.shape, 1e-3) for p in (self.w, self.own, self.trans, self.start)]
        for _ in range(rounds):
            e = (np.add.reduceat(self.w[rows], at, 0) + self.own[own])[ids]
            m, alpha, beta, x, move = self.marginals(e, mask)
            r = -m[mask]
            r[np.arange(len(r)), y[mask]] += 1
            by_word = np.stack([np.bincount(flat, r[:, k], len(words)) for k in range(n)], 1)
            spread = np.repeat(by_word, count, 0)
            g_w = np.stack([np.bincount(rows, spread[:, k], 1 << BITS) for k in range(n)], 1)
            g_own = np.stack([np.bincount(own % len(self.own), by_word[:, k], len(self.own)) for k in range(n)], 1)
            g_own[-1] = 0
            here, then = alpha[:, :-1][both], (x * beta)[:, 1:][both]
            here = here / ((here @ move) * then).sum(1, keepdims=True)
            g_t = gold_t - (here.T @ then) * move
            g_s = gold_s - m[:, 0].sum(0)
            for p, g, a in zip((self.w, self.own, self.trans, self.start), (g_w, g_own, g_t, g_s), acc):
                g = g / total - 1e-6 * p
                a += g * g * 1e4
                p += (rate * 100 * g / np.sqrt(a) * 0.2).astype(p.dtype)
        return self


def crc(n: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(n)), F.lit(-1))


def _stretches(batches):
    """lang, h (a hash of the stretch and where it is from) and the words of each stretch of 32."""
    import pyarrow as pa
    from xxhash import xxh3_64_intdigest

    for part in slices(batches, ["text"]):
        rows = []
        for i, lang, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
            w = WORD.findall(text.lower())
            for k in range(0, len(w), 32):
                piece = " ".join(w[k : k + 32])
                rows.append((lang, xxh3_64_intdigest(f"{i} {k} {piece}".encode()) - (1 << 63), piece))
        cols = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()))], names=["lang", "h", "piece"])


def train(docs: DataFrame, sample: int = 300, stretches: int = 3000, lexicon: int = 3000, seed: int = 5) -> Field | None:
    """docs: doc_id, text, lang; all rows may be learned from. The bounded sample: per lang value at most `sample` documents, and of
    their stretches of 32 words at most `stretches`, each chosen by its hash; every value is learned, with all that it has if
    it has less. The model takes half a megabyte a value."""
    known = docs.where("lang is not null and text is not null")
    u = F.xxhash64("doc_id", "text")
    rows = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rough = F.pmod(u, F.lit(1 << 30)) / float(1 << 30) < F.lit(2.0 * sample + 50) / F.col("n")  # leaves few rows to rank, whatever the language's size
    picked = known.join(F.broadcast(rows), "lang").where(rough).select("doc_id", "lang", "text", u.alias("u"))  # a row per lang value
    few = Window.partitionBy("lang").orderBy("u", "doc_id")
    picked = picked.withColumn("k", F.row_number().over(few)).where(F.col("k") <= sample)
    pieces = picked.select("doc_id", "lang", "text").mapInArrow(_stretches, "lang string, h long, piece string")
    some = Window.partitionBy("lang").orderBy("h", "piece")
    rows = pieces.withColumn("k", F.row_number().over(some)).where(F.col("k") <= stretches).select("h", "lang", "piece").collect()
    if not rows:
        return None
    labels = sorted({r["lang"] for r in rows})
    at = {x: i for i, x in enumerate(labels)}
    number: dict[str, int] = {}
    count: dict[str, int] = {}
    pieces = []
    for r in sorted(rows):
        w = r["piece"].split(" ")
        for x in w:
            count[x] = count.get(x, 0) + 1
        pieces.append(([number.setdefault(x, len(number)) for x in w], at[r["lang"]]))
    g = np.random.default_rng(seed)
    chains, tags = [], []
    for k, (a, y) in enumerate(pieces):
        b, z = pieces[int(g.integers(len(pieces)))]
        if k % 3 == 0 and z != y and len(a) > 4:
            cut = int(g.integers(2, len(a)))
            a, y = a[:cut] + b[: 32 - cut], [y] * cut + [z] * len(b[: 32 - cut])
        else:
            y = [y] * len(a)
        chains.append(a)
        tags.append(y)
    top = sorted(count, key=lambda x: (-count[x], x))[:lexicon]
    return Field(labels, {x: i for i, x in enumerate(top)}).fit(chains, tags, list(number))


def _predict(sent, most: int = 250_000):
    state: dict = {}

    def run(batches):
        import pyarrow as pa

        field: Field | None = sent.value
        number = state.setdefault("number", {})
        n = len(field.labels) if field else 0
        table = state.get("table", np.zeros((0, n), np.float32))
        for part in slices(batches, ["text"]):
            texts = part.column("text").to_pylist()
            words = [WORD.findall(t.lower()) if t else [] for t in texts]
            words = [w if any(c.isalpha() for x in w for c in x) else [] for w in words]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            some = [k for k, w in enumerate(words) if w]
            if field and some:
                if len(number) > most:
                    number.clear()
                    table = table[:0]
                flat = [x for k in some for x in words[k]]
                new = list({x for x in flat if x not in number})
                for x in new:
                    number[x] = len(number)
                table = np.concatenate([table, *(field.emissions(new[i : i + 50_000]) for i in range(0, len(new), 50_000))])
                ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                size = np.array([len(words[k]) for k in some])
                lines = -(-size // STRETCH)
                first = np.r_[0, np.cumsum(lines)[:-1]]
                at = np.arange(len(flat)) - np.repeat(np.r_[0, np.cumsum(size)[:-1]], size) + np.repeat(first * STRETCH, size)
                mask = np.zeros(int(lines.sum()) * STRETCH, bool)
                mask[at] = True
                e = np.zeros((len(mask), n), np.float32)
                e[at] = table[ids]
                m = field.marginals(e.reshape(-1, STRETCH, n), mask.reshape(-1, STRETCH))[0].reshape(-1, n)[at]
                mean = np.add.reduceat(m.astype(np.float64), np.r_[0, np.cumsum(size)[:-1]], 0) / size[:, None]
                for k, j, s in zip(some, mean.argmax(1).tolist(), mean.max(1).tolist()):
                    lang[k], score[k] = field.labels[j], min(1.0, max(0.0, s))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
        state["table"] = table

    return run


def identify(docs: DataFrame, folds: int = 5, sample: int = 300, stretches: int = 3000) -> DataFrame:
    """FOUND for each row of docs, learned from the rows outside fold 0."""
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    field = train(x.where(crc(folds) > 0), sample, stretches)
    sent = docs.sparkSession.sparkContext.broadcast(field)
    return x.select("doc_id", "text", (crc(folds) == 0).alias("held_out")).mapInArrow(_predict(sent), FOUND)
