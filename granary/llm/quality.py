"""Quality rules: verdicts from adaptive thresholds per language and source.

Each document gets counts from one pass over its whole text. The method then summarises four ratios per
(lang, source) in mergeable quantile sketches (relative-error log buckets: two sketches merge by adding counts), takes a
fence median + spread * (q90 - median) per group, and joins the fences back to the documents. Groups of fewer than
`least` documents use the sketch of their language, merged from those of its sources, and small languages that of all. No
fence is above `LOOSE` times that of all documents, so a group that is largely of bad documents does not excuse them.
There is no fixed cutoff. Most documents have none of some ratios, whose quantiles would be zero: a ratio is sketched with SPARE marks,
lines or words added to the document's own, which is what stray ones take, so that the fence grows with how short the group's
documents are; and a document may have SPARE beyond its fence.

Null text: no words. Null lang or source: a group of its own. Empty table: no rows. Repeated rows: judged alike, each
returned. Very long texts: counted whole. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_whole, own, raw, slices

COUNTS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_letters long, n_lines long"
#: Numerator and denominator of each ratio, and what stray marks, letters, lines or words take.
PARTS = {"symbols": ("n_symbols", "word_chars"), "upper": ("n_upper", "n_letters"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words")}
SPARE = {"symbols": 3, "upper": 10, "dup_lines": 1, "repeats": 8}
RATIOS = {k: f"({a} + {SPARE[k]}) / greatest({b}, 1)" for k, (a, b) in PARTS.items()}
LOOSE = 2.0
GAMMA = 1.02  # relative error of a quantile: about 1 %


def _counts(batches):
    import numpy as np
    import pyarrow as pa

    drop = bytes(set(range(256)) - set(b"#*$%&|<>"))
    rest = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point
    for part in slices(batches, ["text"]):
        rows = []
        for text in raw(part.column("text")):
            words = text.split()
            n, joined = len(words), b"".join(words)
            lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
            again = 0
            if n >= 3:
                number: dict = {}
                w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, n)
                k = len(number)
                two = np.unique(w[:-1] * k + w[1:], return_inverse=True)[1]
                three = two[:-1] * k + w[2:]
                _, inv, cnt = np.unique(three, return_inverse=True, return_counts=True)
                hit = cnt[inv] > 1
                mark = np.zeros(n, bool)
                for j in range(3):
                    mark[j : n - 2 + j] |= hit
                again = int(mark.sum())
            folded = joined.decode("utf-8", "replace") if not joined.isascii() else None
            if folded is None:
                upper = len(joined.translate(None, bytes(set(range(256)) - set(range(65, 91)))))
                letters = upper + len(joined.translate(None, bytes(set(range(256)) - set(range(97, 123)))))
            else:
                low = folded.lower()
                upper = sum(map(str.isupper, folded)) if low != folded else 0
                letters = sum(map(str.isalpha, folded))
            rows.append((n, len(joined.translate(None, rest)), len(text.translate(None, drop)), len(lines) - len(set(lines)), again, upper, letters, len(lines)))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("lang").cast(pa.string()), part.column("source").cast(pa.string()), *(pa.array(c, pa.int64()) for c in cols)], names=[x.split()[0] for x in COUNTS.split(", ")])


def measure(docs: DataFrame) -> DataFrame:
    """The counts of each whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")).mapInArrow(_counts, COUNTS)


def sketch(counts: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket) -> n. Merging sketches is adding n; bucket -1 holds zero."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("ratio"), F.expr(v).cast("double").alias("v")) for k, v in RATIOS.items())))
    rows = counts.where("n_words > 0").select("lang", "source", pairs.alias("x")).select("lang", "source", "x.ratio", "x.v")
    bucket = F.when(F.col("v") <= 1e-6, -1).otherwise(F.ceil(F.log(F.col("v") / 1e-6) / F.log(F.lit(GAMMA)))).cast("int")
    return rows.groupBy("lang", "source", "ratio", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """n, q50 and q90 per key and ratio from merged sketches."""
    merged = sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "ratio")
    cum = merged.select(*keys, "ratio", "bucket", "n", F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"), F.sum("n").over(by).alias("total"))
    value = F.when(F.col("bucket") < 0, 0.0).otherwise(1e-6 * F.pow(F.lit(GAMMA), F.col("bucket") - 0.5))
    at = lambda q: F.min(F.when(F.col("cum") >= q * F.col("total"), value))
    return cum.groupBy(*keys, "ratio").agg(F.max("total").alias("n"), at(0.5).alias("q50"), at(0.9).alias("q90"))


def fences(sketches: DataFrame, spread: float = 6.0, least: int = 200) -> DataFrame:
    """A row per (lang, source) with a fence for every ratio."""
    own = quantiles(sketches, ["lang", "source"])
    lang = quantiles(sketches, ["lang"]).select(F.col("lang").alias("l"), F.col("ratio").alias("r"), F.col("n").alias("ln"), F.col("q50").alias("l50"), F.col("q90").alias("l90"))
    every = quantiles(sketches, []).select(F.col("ratio").alias("e"), F.col("q50").alias("e50"), F.col("q90").alias("e90"))
    x = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r"))).join(F.broadcast(every), F.col("ratio") == F.col("e"))  # four rows
    pick = lambda q: F.when(F.col("n") >= least, F.col(f"q{q}")).when(F.col("ln") >= least, F.col(f"l{q}")).otherwise(F.col(f"e{q}"))
    above = lambda low, high: low + spread * (high - low)
    fence = F.least(above(pick(50), pick(90)), LOOSE * above(F.col("e50"), F.col("e90")), F.lit(1.0))
    return x.groupBy("lang", "source").agg(*(F.max(F.when(F.col("ratio") == k, fence)).alias(f"fence_{k}") for k in RATIOS))


def inside(prefix: str = "") -> Column:
    """Whether a row's counts are within its group's fences; a group without a sketch (no words) has none."""
    ok = F.lit(True)
    for k, (a, b) in PARTS.items():
        ok &= F.col(prefix + a) <= F.coalesce(F.col(f"{prefix}fence_{k}"), F.lit(0.0)) * F.col(prefix + b) + SPARE[k]
    return ok


def judge(docs: DataFrame, spread: float = 6.0, least: int = 200, scratch: Scratch | None = None) -> DataFrame:
    """COUNTS, base_failed, the group's fences and kept, for each row of docs."""
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    counts = scratch.put(measure(docs))
    limits = fences(sketch(counts), spread, least).withColumnsRenamed({"lang": "_l", "source": "_s"})
    x = counts.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return x.withColumn("base_failed", failed).withColumn("kept", ~failed & inside())


def keep(docs: DataFrame, spread: float = 6.0, least: int = 200) -> DataFrame:
    """docs without the rejected rows, all columns kept. The fences come from all rows; each row is then counted again where
    it is and judged by its group's fence; the optimiser broadcasts the fences while they are small, so that no text is shuffled, and
    else deals both sides, splitting hot groups (adaptive execution)."""
    scratch = Scratch(docs.sparkSession, "quality")
    counts = scratch.put(measure(docs))
    limits = scratch.put(fences(sketch(counts), spread, least))
    scratch.drop(counts)
    names = [f"_granary_{x.split()[0]}" for x in COUNTS.split(", ")[3:]]
    limits = limits.withColumnsRenamed({c: f"_granary_{c}" for c in limits.columns})
    x = map_whole(docs, _beside(docs.columns), T.StructType([*docs.schema, *(T.StructField(n, T.LongType()) for n in names)]))
    lang, source = F.col("lang").cast("string"), F.col("source").cast("string")
    y = x.join(limits, lang.eqNullSafe(F.col("_granary_lang")) & source.eqNullSafe(F.col("_granary_source")), "left")
    fine = (F.col("_granary_n_words") >= 50) & (100 * F.col("_granary_n_repeat_words") <= 50 * F.col("_granary_n_words"))
    return y.where(fine & inside("_granary_")).select(*own(docs))


def _beside(columns: list[str]):
    """The input's columns, then the counts."""

    def run(batches):
        import pyarrow as pa

        for part in slices(batches, ["text"]):
            own = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), part.column("text"), pa.nulls(part.num_rows, pa.string()), pa.nulls(part.num_rows, pa.string())], names=["doc_id", "text", "lang", "source"])
            got = list(_counts([own]))
            names = [x.split()[0] for x in COUNTS.split(", ")[3:]]
            added = [pa.concat_arrays([g.column(n) for g in got]) for n in names]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *added], names=[*columns, *(f"_granary_{n}" for n in names)])

    return run
