"""The contract queries: each applies its operator, with the parameters of production, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    found = pii.detect(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.BASE]
    counts.append(F.size("spans").cast("long").alias("n_spans"))
    return found.select("doc_id", *counts[:-1], F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"), counts[-1])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import tokens

    return tokens.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER).drop("digest")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    return langid.identify(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lm

    return lm.score(table(spark, sf_dir, "documents"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import passages

    return passages.repeats(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard

    return jaccard.link(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import leaks

    return leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import shards

    return shards.shard(table(spark, sf_dir, "documents"), shards=8)


QUERIES = {f.__name__: f for f in (op1_pii, op2_mixing, op3_token_counts, op4_language, op5_lm_score, op6_passages, op7_ngram_jaccard, op8_quality, op9_decontamination, op10_sharding)}

#: Whole rows in SQL where it can express them: DuckDB, over the view documents.
SQL: dict[str, str] = {}
SQL["op7_ngram_jaccard"] = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
meet AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM meet JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS component_id, (SELECT count(*) FROM link l WHERE l.x = d.doc_id) AS n_links FROM documents d LEFT JOIN n USING (doc_id)"""
SQL["op8_quality"] = r"""WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 2]) AS k FROM t, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 1))) AS i)),
again AS (SELECT doc_id, count(DISTINCT i + j) AS r FROM tri, (SELECT unnest([0, 1, 2]) AS j) WHERE k > 1 GROUP BY doc_id),
c AS (SELECT t.doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words, len(regexp_extract_all(text, '\p{Lu}')) AS n_upper, len(regexp_extract_all(text, '\p{L}')) AS n_letters, len(lines) AS n_lines FROM t LEFT JOIN again USING (doc_id)),
v AS (SELECT doc_id, lang, source, n_words, u.ratio, u.num, u.den, u.spare FROM c, LATERAL (SELECT unnest([{'ratio': 'symbols', 'num': n_symbols, 'den': word_chars, 'spare': 3}, {'ratio': 'upper', 'num': n_upper, 'den': n_letters, 'spare': 10}, {'ratio': 'dup_lines', 'num': n_dup_lines, 'den': n_lines, 'spare': 1}, {'ratio': 'repeats', 'num': n_repeat_words, 'den': n_words, 'spare': 8}]) AS u)),
b AS (SELECT lang, source, ratio, ceil(ln((num + spare) / greatest(den, 1) / 1e-6::DOUBLE) / ln(1.02::DOUBLE)) AS bucket FROM v WHERE n_words > 0),
own AS (SELECT lang, source, ratio, count(*) AS n, quantile_disc(bucket, 0.5) AS a, quantile_disc(bucket, 0.9) AS z FROM b GROUP BY ALL),
byl AS (SELECT lang, ratio, count(*) AS n, quantile_disc(bucket, 0.5) AS a, quantile_disc(bucket, 0.9) AS z FROM b GROUP BY ALL),
every AS (SELECT ratio, quantile_disc(bucket, 0.5) AS a, quantile_disc(bucket, 0.9) AS z FROM b GROUP BY ALL),
pick AS (SELECT o.lang, o.source, o.ratio, CASE WHEN o.n >= 200 THEN o.a WHEN l.n >= 200 THEN l.a ELSE e.a END AS a, CASE WHEN o.n >= 200 THEN o.z WHEN l.n >= 200 THEN l.z ELSE e.z END AS z, e.a AS ea, e.z AS ez FROM own o JOIN byl l ON l.ratio = o.ratio AND l.lang IS NOT DISTINCT FROM o.lang JOIN every e ON e.ratio = o.ratio),
val AS (SELECT lang, source, ratio, 1e-6 * pow(1.02::DOUBLE, a - 0.5) AS a, 1e-6 * pow(1.02::DOUBLE, z - 0.5) AS z, 1e-6 * pow(1.02::DOUBLE, ea - 0.5) AS ea, 1e-6 * pow(1.02::DOUBLE, ez - 0.5) AS ez FROM pick),
fence AS (SELECT lang, source, ratio, least(a + 6 * (z - a), 2 * (ea + 6 * (ez - ea)), 1) AS f FROM val),
ok AS (SELECT v.doc_id, bool_and(v.num <= coalesce(f, 0) * v.den + v.spare) AS ok FROM v LEFT JOIN fence x ON x.ratio = v.ratio AND x.lang IS NOT DISTINCT FROM v.lang AND x.source IS NOT DISTINCT FROM v.source GROUP BY v.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ok AS kept FROM c JOIN ok USING (doc_id)"""
