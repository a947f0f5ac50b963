"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Words are summed per cell (source, language, topic). A topic is an anchor word: the `anchors` words of five letters or more that most
documents hold, of those that at most `widest` of all documents do, found by counting over the whole corpus; a document's topic is the
anchor that its text names first, or `other`. A caller's own topic column replaces this.

Raking: a cell's probability is p = min(1, m_source * m_lang * m_topic), with a multiplier per value of each dimension. Each sweep scales
the multipliers of one dimension after the other so that the sample's expected words meet its targets under the cap of 1, until
every marginal is within `tolerance` of all wanted words; otherwise `NotConverged` tells the gap. Targets default to the marginals of
the corpus flattened towards tokens ** `alpha` in every dimension, which one table of cells meets together; given ones are
shares. The sample is expected to hold `fraction` of all words, or less if a given target cannot be had from what there
is. A document stays if the hash of its id, text and `seed` falls below p: expected shares meet the targets, those of one
sample differ by chance.

Only words and cells are shuffled, after a map-side sum, so a hot source costs one row per task. Cells are iterated as tables, never on the
driver, which sees seven figures per second sweep and the anchors. Words are `[^\\x20\\x09-\\x0D]+`; a text in a script without
spaces weighs as its blank-separated pieces.

Null text: no words; the text weighs 1 for its cell, as any text without words. Null source or language: a value of its own (`?`).
Empty table: no rows. Repeated rows: sampled alike. Targets for absent values are ignored; values without one keep their part.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, own

DIMS = ("source", "lang", "topic")


class NotConverged(ValueError):
    """The targets cannot be met together, or not within the sweeps allowed."""


def body() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def uniform(seed: int = 0) -> Column:
    """A document's own number in [0, 1)."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), body(), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def pieces() -> Column:
    """The text cut at blanks; a blank at either end leaves an empty piece there."""
    return F.split(body(), r"[\x20\x09-\x0D]+")


def anchor_words(docs: DataFrame, anchors: int = 64, widest: float = 0.1) -> list[str]:
    """The anchors in order of the alphabet: a fixed number of words."""
    n = docs.count()
    found = docs.select(F.explode(F.array_distinct(pieces())).alias("w")).where("length(w) between 5 and 40").groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    found = found.where((F.col("df") <= widest * n) & F.col("w").rlike(r"^\p{L}+$"))
    return sorted(r["w"] for r in found.orderBy(F.desc("df"), "w").limit(anchors).collect())


def topic_of(anchors: list[str], words: Column) -> Column:
    """The first of the words that is an anchor."""
    if not anchors:
        return F.lit("other")
    return F.coalesce(F.get(F.array_intersect(words, F.array(*map(F.lit, anchors))), F.lit(0)), F.lit("other"))


def count_of(words: Column) -> Column:
    """The non-empty pieces; 1 at least."""
    empty = lambda i: (F.element_at(words, i) == "").cast("int")
    return F.greatest(F.size(words) - F.when(F.size(words) > 1, empty(1) + empty(-1)).otherwise(empty(1)), F.lit(1)).cast("long")


def labels(topic: Column) -> dict[str, Column]:
    some = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    return {"source": some(F.col("source")), "lang": some(F.col("lang")), "topic": some(topic)}


def labelled(docs: DataFrame, anchors: list[str], topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens (words) and u, a uniform number of the document. The text is cut once."""
    own_topic = [] if topic is None else [topic.alias("_t")]
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", *own_topic, uniform().alias("u"), pieces().alias("_w"))
    found = labels(F.col("_t") if own_topic else topic_of(anchors, F.col("_w")))
    return x.select("doc_id", *(v.alias(k) for k, v in found.items()), count_of(F.col("_w")).alias("tokens"), "u")


def _scale(x: DataFrame, whole: float, rounds: int = 60) -> DataFrame:
    """x with `wanted` = min(tokens, s * w), where the wanted sum to `whole`: s by bisection on sums that come to the driver."""
    low, high = x.agg(F.min(F.col("tokens") / F.col("w")), F.max(F.col("tokens") / F.col("w"))).first()
    low, high = 0.0, float(high or 1.0)
    grid = 32
    for _ in range(rounds):  # each pass narrows the bracket by `grid`
        at = [low + (high - low) * k / grid for k in range(1, grid + 1)]
        sums = x.agg(*(F.sum(F.least(F.col("tokens").cast("double"), F.lit(s) * F.col("w"))).alias(f"s{k}") for k, s in enumerate(at))).first()
        hit = next((k for k, v in enumerate(sums) if (v or 0.0) >= whole * (1 - 1e-12)), grid - 1)
        low, high = (at[hit - 1] if hit else low), at[hit]
        if high - low <= 1e-9 * high:
            break
    return x.withColumn("wanted", F.least(F.col("tokens").cast("double"), F.lit(high) * F.col("w")))


def default_targets(cells: DataFrame, alpha: float, fraction: float, total: int, scratch: Scratch) -> dict[str, DataFrame]:
    """dimension -> value, want (words): the marginals of the cells with tokens * product of share ** (alpha - 1)."""
    x = cells.withColumn("w", F.col("tokens").cast("double"))
    for d in DIMS:
        t = cells.groupBy(d).agg(F.sum("tokens").alias("t"))
        x = x.join(t, d).withColumn("w", F.col("w") * F.pow(F.col("t") / float(total), F.lit(alpha - 1))).drop("t")
    x = scratch.put(_scale(scratch.put(x), fraction * total))
    return {d: x.groupBy(F.col(d).alias("value")).agg(F.sum("wanted").alias("want")) for d in DIMS}


def wanted(cells: DataFrame, shares: dict[str, DataFrame | None], alpha: float, fraction: float, total: int, scratch: Scratch) -> tuple[dict[str, DataFrame], float]:
    """Targets in words, and the part of all words that the sample is expected to hold."""
    if not any(t is not None for t in shares.values()):
        return default_targets(cells, alpha, fraction, total, scratch), fraction
    rest = {}
    for d, t in shares.items():
        if t is not None:
            have = cells.groupBy(F.col(d).alias("value")).agg((F.sum("tokens") / float(total)).alias("have"))
            x = have.join(t.groupBy("value").agg(F.sum("share").alias("share")), "value", "left")
            named = x.agg(F.sum("share"), F.sum(F.when(F.col("share").isNull(), F.col("have")))).first()
            spare = max(0.0, 1.0 - (named[1] or 0.0))  # values without a target keep their part
            x = x.select("value", "have", F.coalesce(F.col("share") * (spare / (named[0] or 1.0)), F.col("have")).alias("share"))
            rest[d] = scratch.put(x)
            fraction = min(fraction, rest[d].where("share > 0").agg(F.min(F.col("have") / F.col("share"))).first()[0] or fraction)
    return {d: x.select("value", (F.col("share") * fraction * total).alias("want")) for d, x in rest.items()}, fraction


HISTORY = 2  # earlier sweeps that an extrapolation draws on


def _gap(x: DataFrame, targets: dict[str, DataFrame], part: Column) -> float:
    """Words by which the worst marginal is off; one aggregation of all dimensions."""
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.col(d).alias("value"), F.col(f"t_{d}").alias("t")) for d in targets))).alias("r")
    sums = x.select(each, part.alias("part")).groupBy("r.d", "r.value").agg(F.sum("part").alias("have"), F.max("r.t").alias("t"))
    return sums.agg(F.max(F.abs(F.col("have") - F.coalesce("t", "have")))).first()[0] or 0.0


def _extrapolated(x: DataFrame) -> DataFrame:
    """x with m moved on by Anderson's rule: the last sweeps' results in logarithms, combined so that the changes of those sweeps, weighted
    by words, cancel as far as they can. A product of multipliers stays one. The driver gets the changes' products, six numbers."""
    known = lambda c: F.coalesce(c, F.lit(0.0))
    steps = [known(F.col("f") - F.col(f"f{k + 1}")) for k in range(HISTORY)]
    sums = [F.sum(F.col("tokens") * u * v).alias(f"s{i}_{j}") for i, u in enumerate(steps) for j, v in enumerate([*steps, known(F.col("f"))])]
    dots = np.array([v or 0.0 for v in x.agg(*sums).first()]).reshape(HISTORY, HISTORY + 1)
    parts = np.linalg.lstsq(dots[:, :-1], dots[:, -1], rcond=1e-12)[0]
    back = F.lit(0.0)
    for k, c in enumerate(parts.tolist()):
        back = back + F.lit(c) * known(F.col("g") - F.col(f"g{k + 1}"))
    return x.withColumn("m", F.col("m") * F.exp(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), -back))))


def rake(cells: DataFrame, targets: dict[str, DataFrame], fraction: float, total: int, scratch: Scratch, sweeps: int = 200, tolerance: float = 1e-4) -> DataFrame:
    """cells with p: the sample's expected words meet each target marginal. After every second sweep the gap is taken and, if it fell,
    the multipliers are extrapolated; plain sweeps go on from there, so a bad guess costs sweeps only."""
    past = [f"{c}{k}" for k in ("", *range(1, HISTORY + 1)) for c in "gf"]
    x = cells.withColumn("m", F.lit(float(fraction))).withColumns({c: F.lit(None).cast("double") for c in past})
    for d, t in targets.items():
        x = x.join(t.select(F.col("value").alias(d), F.col("want").alias(f"t_{d}")), d, "left")
    x = scratch.put(x)
    part = F.least(F.lit(1.0), F.col("m")) * F.col("tokens")
    gap = math.inf
    for n in range(sweeps):
        y = x.withColumn("was", F.col("m"))
        for d in targets:
            # what cells at the cap give stays; the others are scaled to the rest
            have = y.groupBy(d).agg(F.sum(part).alias("have"), F.sum(F.when(F.col("m") >= 1, F.col("tokens")).otherwise(0)).alias("full"))
            t, free = F.col(f"t_{d}"), F.col("have") - F.col("full")
            by = F.when(t.isNull() | (F.col("have") <= 0), 1.0).when((t > F.col("full")) & (free > 0), (t - F.col("full")) / free).otherwise(t / F.col("have"))
            y = y.join(have, d).withColumn("m", F.col("m") * by).drop("have", "full")
        moved = (F.col("m") > 0) & (F.col("was") > 0)
        now = [F.when(moved, F.ln("m")).alias("g"), F.when(moved, F.ln(F.col("m") / F.col("was"))).alias("f")]
        new = scratch.put(y.select(*DIMS, "tokens", *(f"t_{d}" for d in targets), "m", *now, *(F.col(old).alias(c) for old, c in zip(past, past[2:]))))
        scratch.drop(x)
        x = new
        if n % 2 == 0 and n + 1 < sweeps:
            continue
        scratch.free_shuffles()  # and the broadcasts of the sweeps done, which the driver holds
        last, gap = gap, _gap(x, targets, part) / max(1.0, fraction * total)
        if gap <= tolerance:
            break
        if gap < last:
            new = scratch.put(_extrapolated(x))
            scratch.drop(x)
            x = new
    else:
        raise NotConverged(f"after {sweeps} sweeps a marginal is still off by {gap:.2e} of the wanted words; the targets may contradict each other")
    return x.withColumn("p", F.least(F.lit(1.0), F.col("m"))).select(*DIMS, "tokens", "p")


def calibrated(cells: DataFrame, targets: dict[str, DataFrame] | None, alpha: float, fraction: float, sweeps: int, tolerance: float, scratch: Scratch) -> DataFrame:
    """source, lang, topic, tokens, weight (the cell's share of the sample) and p."""
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    if not total:
        return cells.withColumns({"weight": F.lit(0.0), "p": F.lit(0.0)})
    goals, part = wanted(cells, {d: (targets or {}).get(d) for d in DIMS}, alpha, fraction, total, scratch)
    return scratch.put(rake(cells, goals, part, total, scratch, sweeps, tolerance).withColumn("weight", F.col("tokens") * F.col("p") / (part * total)))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = 0.7, fraction: float = 0.5, sweeps: int = 200, tolerance: float = 1e-4, topic: Column | None = None, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight (its cell's share of the sample), p and chosen, for each row of docs."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    x = scratch.put(labelled(docs, anchor_words(docs) if topic is None else [], topic))
    cells = scratch.put(x.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))
    p = calibrated(cells, targets, alpha, fraction, sweeps, tolerance, scratch).select(*DIMS, "weight", "p")
    return x.join(p, list(DIMS)).select("doc_id", *DIMS, "tokens", "weight", "p", (F.col("u") < F.col("p")).alias("chosen"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = 0.7, fraction: float = 0.5, sweeps: int = 200, tolerance: float = 1e-4, topic: Column | None = None) -> DataFrame:
    """The chosen rows of docs, all columns kept. A row's cell is found by a join on its labels; the optimiser broadcasts the
    cells while they are small and else deals both sides, splitting hot cells (adaptive execution)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    anchors = anchor_words(docs) if topic is None else []
    cells = scratch.put(labelled(docs, anchors, topic).groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")))
    p = calibrated(cells, targets, alpha, fraction, sweeps, tolerance, scratch).select(*(F.col(d).alias(f"_granary_{d}") for d in DIMS), F.col("p").alias("_granary_p"))
    found = labels(topic if topic is not None else topic_of(anchors, pieces()))
    return docs.join(p, [v == F.col(f"_granary_{d}") for d, v in found.items()]).where(uniform() < F.col("_granary_p")).select(*own(docs))
