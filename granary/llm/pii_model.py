"""Boosted trees for loose candidates, trained on generated rows with known labels.

There are no labelled rows of personal data, so `rows` writes `size` lines (a documented bound) that hold real forms or
look-alikes (version and order numbers, digests, identifiers, long words, sums) in fitting or neutral context; digests and keys, order and
telephone numbers have the same form, so that the kinds overlap and context decides. Their features come from the same
DataFrame expressions as in use. Trees are fitted with a logistic loss on one half; Platt's scaling and each kind's
threshold (the least probability from which on the precision is 0.97) come from the other half.
"""

from __future__ import annotations

import math
import random
import string

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import pii

_fitted: dict = {}


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice(string.digits) for _ in range(n))


def _card(r: random.Random) -> str:
    d = _digits(r, 15)
    s = sum(int(c) if i % 2 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(d))
    return d + str(-s % 10)


def rows(size: int, seed: int) -> list[tuple[str, int]]:
    r, out = random.Random(seed), []
    word = lambda a, b: "".join(r.choice(["er", "in", "th", "at", "on", "ou", "ver", "heit", "eau"]) for _ in range(r.randint(a, b)))
    four = lambda d: ".".join(d[i : i + 4] for i in range(0, 16, 4))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    some = lambda n: "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))
    yes = [
        lambda: f"{word(1, 3)}.{_digits(r, 2)} [at] {word(1, 3)}.com",
        lambda: f"{word(1, 3)}(at){word(1, 3)}(dot)org",
        lambda: ":".join(hexa(4) for _ in range(8)),
        lambda: "card " + four(_card(r)),
        lambda: r.choice(["call ", "tel ", "phone: ", "", "fax "]) + r.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(_digits(r, 3), _digits(r, 3), _digits(r, 4)),
        lambda: f'{r.choice(["token", "secret", "api_key", "password", "auth"])} = "{r.choice([hexa, some])(r.choice([32, 40, 64]))}"',
        lambda: f'{r.choice(["key", "pass", "k"])}: {r.choice([hexa, some])(r.choice([32, 40, 64]))}',
        lambda: f"{r.choice(['IBAN ', 'account ', ''])}{r.choice(['DE', 'FR', 'ES', 'GB'])}{_digits(r, 2)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 4)} {_digits(r, 2)}",
        lambda: f"{r.choice(['ssn ', 'social ', ''])}{_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 4)}",
    ]
    no = [
        lambda: word(8, 20),
        lambda: word(8, 14).upper() + word(2, 5),
        lambda: f"{word(4, 7)}_{word(4, 7)}_{r.randint(1, 99)}",
        lambda: f"/{word(4, 9)}{r.randint(10, 99)}{word(3, 6)}",
        lambda: "0" * r.randint(20, 40),
        lambda: _digits(r, r.randint(20, 40)),
        lambda: f"{word(1, 2)} [at] {word(1, 2)} {word(1, 2)}",
        lambda: four(str(int(_card(r)) + r.randint(1, 8)).zfill(16)[-16:]),
        lambda: "#" + f"{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}",
        lambda: "/" + f"{_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 4)}",
        lambda: f"{r.choice(['commit', 'sha256', 'md5', 'etag', 'checksum', 'build', 'revision'])}{r.choice([' ', ': ', '='])}{r.choice([hexa(32), hexa(40), hexa(64)])}",
        lambda: f"{r.choice(['order', 'invoice', 'ticket', 'part', 'case', ''])} {r.choice(['{}-{}-{}', '{}.{}.{}']).format(_digits(r, 3), _digits(r, 3), _digits(r, 4))}",
        lambda: f"{r.choice(['order', 'item', 'case', ''])} {_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 4)}",
        lambda: f"{r.choice(['version', 'part', ''])} {four(_digits(r, 16))}",
        lambda: "AB" + _digits(r, 2) + " " + " ".join(word(2, 2).upper()[:4] for _ in range(4)),
    ]
    for _ in range(size):
        label = r.random() < 0.5
        out.append((" ".join([word(1, 4) for _ in range(r.randint(1, 6))] + [r.choice(yes if label else no)()] + [word(1, 4) for _ in range(r.randint(0, 4))]), int(label)))
    return out


class Trees:
    """Depth-limited regression trees on the logistic loss, with second-order leaf values."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, damp: float = 1.0):
        self.rounds, self.depth, self.rate, self.damp = rounds, depth, rate, damp
        self.trees, self.names, self.scale, self.thresholds = [], [], (1.0, 0.0), {}

    def _grow(self, x, g, h, at, depth):
        leaf = -self.rate * g[at].sum() / (h[at].sum() + self.damp)
        if depth == 0 or len(at) < 8:
            return float(leaf)
        best = (1e-6, None, None)
        score = lambda a, b: a * a / (b + self.damp)
        whole = score(g[at].sum(), h[at].sum())
        for j in range(x.shape[1]):
            order = at[np.argsort(x[at, j], kind="stable")]
            v, cg, ch = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut):
                gain = score(cg[cut], ch[cut]) + score(cg[-1] - cg[cut], ch[-1] - ch[cut]) - whole
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, float((v[cut[k]] + v[cut[k] + 1]) / 2))
        if best[1] is None:
            return float(leaf)
        left = x[at, best[1]] <= best[2]
        return (best[1], best[2], self._grow(x, g, h, at[left], depth - 1), self._grow(x, g, h, at[~left], depth - 1))

    def raw(self, x: np.ndarray) -> np.ndarray:
        def walk(t, at, out):
            if isinstance(t, float):
                out[at] += t
            else:
                left = x[at, t[0]] <= t[1]
                walk(t[2], at[left], out)
                walk(t[3], at[~left], out)

        out = np.zeros(len(x))
        for t in self.trees:
            walk(t, np.arange(len(x)), out)
        return out

    def fit(self, names: list[str], x: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> Trees:
        self.names = names
        own = np.arange(len(x)) % 2 == 0
        score, at = np.zeros(len(x)), np.flatnonzero(own)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            self.trees.append(self._grow(x, p - y, p * (1 - p), at, self.depth))
            score = self.raw(x)
        s, t = score[~own], y[~own]
        a, b = 1.0, 0.0
        for _ in range(200):  # Platt's scaling by gradient descent
            p = 1 / (1 + np.exp(-(a * s + b)))
            a, b = a - 0.05 * float(np.mean((p - t) * s)), b - 0.2 * float(np.mean(p - t))
        self.scale = (a, b)
        p = 1 / (1 + np.exp(-(a * s + b)))
        for kind in pii.ORDER:
            mine = kinds[~own] == kind
            order = np.argsort(-p[mine], kind="stable")
            q, right = p[mine][order], np.cumsum(t[mine][order]) / np.arange(1, len(order) + 1)
            good = np.flatnonzero((right >= 0.97) & np.r_[q[1:] < q[:-1], True][: len(q)])
            self.thresholds[kind] = float(q[good[-1]]) if len(good) else 1.1
        return self

    def probability(self, x: Column) -> Column:
        def case(t):
            return F.lit(t) if isinstance(t, float) else F.when(x[self.names[t[0]]] <= t[1], case(t[2])).otherwise(case(t[3]))

        total = sum((case(t) for t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-(total * self.scale[0] + self.scale[1])))


def fitted(spark: SparkSession, size: int = 6000, seed: int = 7) -> Trees:
    """The model, trained once per process."""
    if (size, seed) not in _fitted:
        made = spark.createDataFrame(rows(size, seed), "text string, label int")
        found = made.select("label", F.explode(pii.candidates(F.col("text"))).alias("c")).select("label", "c.kind", "c.rule", "c.x.*").collect()
        names = found[0].__fields__[3:]
        x = np.array([[float(v) for v in r[3:]] for r in found])
        y = np.array([float(r["label"]) for r in found])
        assert not any(map(math.isnan, x.ravel()[:1000]))
        _fitted[size, seed] = Trees().fit(names, x, y, np.array([r["kind"] for r in found]))
    return _fitted[size, seed]
