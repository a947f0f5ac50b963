"""Plain Python versions of the contracts."""

import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def ascii_lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def shingles(text):
    w = WORD.findall(ascii_lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(docs):
    """doc_id -> smallest doc_id reached, by inverted lists."""
    sets = {i: shingles(t) for i, t in docs.items()}
    lists, root = {}, {i: i for i in docs}
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)

    def find(a):
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    links = set()
    for i, s in sets.items():
        seen = {}
        for x in s:
            for j in lists[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, k in seen.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                links.add((j, i))
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: len(s) for i, s in sets.items()}, {i: find(i) for i in docs}, links


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = {}
    for t in tri:
        count[t] = count.get(t, 0) + 1
    mark = {i + j for i, t in enumerate(tri) if count[t] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(mark), n < 50 or 100 * len(mark) > 50 * n


def bucket(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


SPARE = {"symbols": 3, "upper": 10, "dup_lines": 1, "repeats": 8}


def kept(docs):
    """doc_id -> verdict, from docs: doc_id -> (text, lang, source); all quantiles by sorting."""
    rows = {}
    for i, (text, lang, source) in docs.items():
        n, chars, symbols, dup, again, failed = quality(text)
        joined = "".join(WORD.findall(text or ""))
        lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        parts = {"symbols": (symbols, chars), "upper": (sum(map(str.isupper, joined)), sum(map(str.isalpha, joined))), "dup_lines": (dup, lines), "repeats": (again, n)}
        rows[i] = lang, source, n, failed, parts
    some = [r for r in rows.values() if r[2]]

    def fence(group, k):
        v = sorted(math.ceil(math.log((r[4][k][0] + SPARE[k]) / max(1, r[4][k][1]) / 1e-6) / math.log(1.02)) for r in group)
        low, high = (1e-6 * 1.02 ** (v[math.ceil(q * len(v)) - 1] - 0.5) for q in (0.5, 0.9))
        return low + 6 * (high - low)

    out = {}
    for i, (lang, source, n, failed, parts) in rows.items():
        groups = [[r for r in some if r[:2] == (lang, source)], [r for r in some if r[0] == lang], some]
        own = next((g for g in groups if len(g) >= 200), some)
        out[i] = not failed and all(a <= min(fence(own, k), 2 * fence(some, k), 1) * b + SPARE[k] for k, (a, b) in parts.items())
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def holds(item, run):
    """Least edits that turn the item into a part of run."""
    row = [0] * (len(run) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(run, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def raked(cells, alpha, fraction):
    """Probabilities of cells (source, lang, topic) -> words, by many plain sweeps."""
    total = sum(cells.values())
    side = lambda f, d: {v: sum(f(k) for k in cells if k[d] == v) for v in {k[d] for k in cells}}
    sums = [side(cells.get, d) for d in range(3)]
    w = {k: t * math.prod((sums[d][k[d]] / total) ** (alpha - 1) for d in range(3)) for k, t in cells.items()}
    low, high = 0.0, max(t / w[k] for k, t in cells.items())
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if sum(min(t, mid * w[k]) for k, t in cells.items()) >= fraction * total else (mid, high)
    want = [side(lambda k: min(cells[k], high * w[k]), d) for d in range(3)]
    m = dict.fromkeys(cells, fraction)
    for _ in range(3000):
        for d in range(3):
            have = side(lambda k: min(1, m[k]) * cells[k], d)
            m = {k: x * want[d][k[d]] / have[k[d]] for k, x in m.items()}
    return {k: min(1, x) for k, x in m.items()}
