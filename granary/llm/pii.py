"""Personal data by candidate gradient boosting, in DataFrame functions only.

Generators with high recall propose spans, which may overlap: four base kinds (email, ip, card, phone), whose valid matches
always stay, and looser forms of them, national numbers, account numbers and secrets. Boosted trees (trained by
pii_model on generated, labelled rows) score each looser candidate from its format and its context; a calibrated
threshold per kind selects. One pass over each row, no shuffle: a hot source or a group of copies costs nothing extra.

Positions are code points, end exclusive; a match's start is a running sum over the lengths of what regexp_extract_all
matched and split left between, by doubling, so k matches cost k log k.

Null text: as empty, no spans. Empty table: no rows. Repeated rows: each returned. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = {  # possessive and anchored forms of the four contract patterns: the same matches in linear time
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: The bounds are those of the formats: 64 characters of a mailbox, 63 of a label, 34 of an account number. Secrets have none.
LOOSE = {
    "email_spelled": ("email", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}+ ?(?:\[at\]|\(at\)|\{at\}) ?[a-z0-9-]{2,63}+(?: ?(?:\.|\[dot\]|\(dot\)) ?[a-z0-9-]{2,63}+){1,4}+"),
    "ip_six": ("ip", r"(?i)(?<![0-9a-f:])[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){7}(?![0-9a-f:])"),
    "card_dotted": ("card", r"(?<![0-9.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?![0-9.])"),
    "phone_national": ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])"),
    "secret": ("secret", r"(?<![A-Za-z0-9])[A-Za-z0-9_]{20,}+(?![A-Za-z0-9])"),
    "iban": ("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"),
    "ssn": ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: A text without any of these has no loose candidate: each rule's matches hold one (two digits: the numbers, iban and ssn).
HINT = r"(?i)[0-9]{2}|[\[({]at[\])}]|(?<![a-z0-9_])[a-z0-9_]{20}|[0-9a-f](?::[0-9a-f]{1,4}){7}"
ORDER = ["email", "ip", "card", "phone", "secret", "iban", "ssn"]
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CONTEXT = {
    "near_secret": r"(?i)(?:token|secret|api.?key|passw|auth)[^\n]{0,8}$",
    "near_phone": r"(?i)(?:tel|phone|call|fax|mobil|ruf)[^\n]{0,12}$",
    "near_card": r"(?i)(?:card|visa|pay|cc)[^\n]{0,12}$",
    "near_account": r"(?i)(?:iban|account|konto|bank|ssn|social)[^\n]{0,12}$",
    "near_equals": r"[=:] ?\"?$",
    "near_slash": r"[/\\#&?]$",
    "near_digest": r"(?i)(?:commit|sha-?[0-9]*|md5|digest|etag|checksum|hash|build|revision|uuid)[^\n]{0,8}$",
    "near_number": r"(?i)(?:order|invoice|ticket|version|isbn|part|item|case)[^\n]{0,10}$",
}


def _let(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.transform(F.array(value), f)[0]


def _running(steps: Column) -> Column:
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(steps) + 1)).cast("int"))
    double = lambda acc, r: F.transform(acc, lambda v, i: v + F.when(i >= F.pow(F.lit(2), r), F.coalesce(F.get(acc, (i - F.pow(F.lit(2), r)).cast("int")), F.lit(0))).otherwise(F.lit(0)))
    return F.aggregate(rounds, steps, double)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, body>> of the leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(x: Column) -> Column:
        steps = F.transform(x["m"], lambda m, i: F.length(F.get(x["p"], i)) + F.when(i > 0, F.length(F.get(x["m"], i - 1))).otherwise(F.lit(0)))
        return F.zip_with(_running(steps), x["m"], lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("body")))

    empty = F.array().cast("array<struct<start:int,end:int,body:string>>")
    return _let(found, lambda m: F.when(F.size(m) == 0, empty).otherwise(_let(F.struct(m.alias("m"), F.split(text, pattern, -1).alias("p")), place)))


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Of up to 20 digits; longer numbers are padded nowhere and fail the length rules before."""
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.lit(0)
    padded = F.lpad(digits, 20, "0")
    for i in range(1, 21):
        d = F.ascii(F.substring(padded, i, 1)) - 48
        total = total + (twice(d) if i % 2 else d)
    return total % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return body.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    d = _digits(body)
    if kind == "card":
        return F.length(d).between(16, 19) & luhn(d)
    return F.length(d).between(8, 15)


def base_spans(text: Column) -> Column:
    """The four kinds' valid matches in order of kind and start."""
    guard = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    parts = []

    def of(kind: str) -> Column:  # F.filter and F.transform count a lambda's defaults as arguments, so the kind is bound here
        kept = F.filter(matches(text, BASE[kind]), lambda s: _valid(kind, s["body"]))
        return F.transform(kept, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    for kind in BASE:
        parts.append(F.when(guard[kind], of(kind)).otherwise(empty) if kind in guard else of(kind))
    return F.concat(*parts)


def features(text: Column, rule: str, s: Column) -> Column:
    """Format and context of a candidate, as a struct of doubles."""
    body = s["body"]
    before = F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24)))
    n = F.length(body)
    digits = F.length(_digits(body))
    lower = F.length(F.regexp_replace(body, "[^a-z]", ""))
    upper = F.length(F.regexp_replace(body, "[^A-Z]", ""))
    hexa = F.length(F.regexp_replace(body, "[^0-9a-fA-F]", ""))
    flips = F.size(F.split(F.regexp_replace(body, "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", " "), " ")) - 1
    columns = {f"is_{r}": F.lit(float(r == rule)) for r in LOOSE}
    columns |= {"length": n, "digits": digits / n, "lower": lower / n, "upper": upper / n, "hex": hexa / n, "flips": flips, "kinds": F.size(F.array_distinct(F.split(body, ""))), "luhn": luhn(F.right(_digits(body), F.lit(20)))}
    columns |= {k: before.rlike(p) for k, p in CONTEXT.items()}
    return F.struct(*(v.cast("double").alias(k) for k, v in columns.items()))


def candidates(text: Column) -> Column:
    """array<struct<kind, rule, start, end, x>> of all loose generators; spans may overlap."""

    def of(rule: str, kind: str, pattern: str) -> Column:
        return F.transform(matches(text, pattern), lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), s["start"].alias("start"), s["end"].alias("end"), features(text, rule, s).alias("x")))

    return F.concat(*(of(rule, kind, p) for rule, (kind, p) in LOOSE.items()))


def detect(docs: DataFrame, model=None) -> DataFrame:
    """doc_id, text, base (array of kind, start, end) and spans (base and selected candidates: kind, start, end, score)."""
    if model is None:
        from .pii_model import fitted

        model = fitted(docs.sparkSession)
    text = F.col("text")
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    x = x.select("doc_id", "text", base_spans(text).alias("base"))
    scored = F.transform(candidates(text), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), model.probability(c["x"]).alias("score")))
    limit = F.create_map(*(F.lit(y) for k in ORDER for y in (k, float(model.thresholds.get(k, 0.5)))))
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    chosen = F.filter(scored, lambda c: (c["score"] >= limit[c["kind"]]) & apart(c))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    x = x.withColumn("more", F.when(text.rlike(HINT), chosen).otherwise(none))
    both = F.concat(F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"), F.lit(1.0).alias("score"))), F.col("more"))
    rank = F.create_map(*(F.lit(y) for i, k in enumerate(ORDER) for y in (k, i)))
    order = lambda s: F.struct(rank[s["kind"]].alias("r"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score"))
    spans = F.transform(F.array_sort(F.transform(both, order)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return x.select("doc_id", "text", "base", spans.alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """doc_id and the text with every span replaced by its kind; of overlapping spans the first, longest one counts."""
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("to"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], -s["to"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct((-s["to"]).alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")))

    whole = F.aggregate(by_start, start, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return found.select("doc_id", whole.alias("text"))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
