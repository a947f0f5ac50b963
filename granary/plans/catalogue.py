"""The registered queries of the compiler's operators and, beside each, independent SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import checks, identity, scores, text, times
from ..operators import audit, conflicts, extraction, mentions, normalization, relations, resolution, review, scheduling, staging, synthesis, temporal, validation
from ..sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["k02_disposition"](spark, sf_dir)


def nine(x) -> F.Column:
    return F.round(x, 9)


def line_id() -> F.Column:
    """An order line as a piece of evidence; line numbers repeat, so its parts and discount belong to it."""
    return F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), F.round(F.col("l_discount") * 100).cast("long").cast("string"))


# ---- shared SQL ----
CHUNKS = """chunks AS (SELECT concat_ws(':', conv_id, turn) AS chunk_id, 's' || (conv_id % 7) AS source_id, 'c' || conv_id AS conversation_id, role AS speaker,
  CASE WHEN (conv_id + turn) % 9 <> 0 THEN '2024-01-' || lpad(CAST(1 + conv_id % 28 AS VARCHAR), 2, '0') || 'T' || lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || ':00:00' END AS occurred_at,
  text, sha256(text) AS source_sha256 FROM conversations)"""
CANDIDATES = (
    CHUNKS
    + r""", parts AS (SELECT *, string_split_regex(text, '[.!?\n]+') AS l FROM chunks),
sentences AS (SELECT p.*, u.s, u.seq FROM parts p, LATERAL (SELECT unnest(p.l) AS s, generate_subscripts(p.l, 1) - 1 AS seq) u),
worded AS (SELECT *, trim(s) AS exact_text, string_split_regex(trim(s), ' +') AS w FROM sentences),
cand AS (SELECT sha256(concat_ws('|', chunk_id, seq)) AS candidate_id, chunk_id, source_id, conversation_id, speaker, occurred_at, seq, exact_text, w[1] AS subject, w[2] AS predicate, w[len(w)] AS object,
  (length(exact_text) + seq) % 11 AS r, ((length(exact_text) * 5 + seq) % 10) / 10.0::DOUBLE AS origin, ((length(exact_text) * 7 + seq * 3) % 10) / 10.0::DOUBLE AS conf FROM worded WHERE len(w) >= 3)"""
)
DIAGNOSTICS = (
    CANDIDATES
    + """, copies AS (SELECT *, 1 AS copy FROM cand UNION ALL SELECT *, 2 AS copy FROM cand WHERE r = 6),
diag AS (
  SELECT candidate_id, copy, 'evidence_text_mismatch' AS code, 'error' AS severity FROM copies WHERE r = 0
  UNION ALL SELECT candidate_id, copy, 'conversation_mismatch', 'error' FROM copies WHERE r = 1
  UNION ALL SELECT candidate_id, copy, 'source_mismatch', 'error' FROM copies WHERE r = 2
  UNION ALL SELECT candidate_id, copy, 'speaker_mismatch', 'error' FROM copies WHERE r = 3
  UNION ALL SELECT candidate_id, copy, 'unknown_chunk', 'error' FROM copies WHERE r = 4
  UNION ALL SELECT candidate_id, copy, 'missing_chunk_provenance', 'error' FROM copies WHERE r = 5
  UNION ALL SELECT candidate_id, copy, 'duplicate_candidate', 'error' FROM copies WHERE copy = 2
  UNION ALL SELECT candidate_id, copy, 'low_source_origin_probability', 'error' FROM copies WHERE origin < 0.5
  UNION ALL SELECT candidate_id, copy, 'proxy_time', 'warning' FROM copies WHERE r = 7
  UNION ALL SELECT candidate_id, copy, 'low_extractor_confidence', 'warning' FROM copies WHERE conf < 0.5),
disp AS (SELECT candidate_id, copy, NOT EXISTS (SELECT 1 FROM diag d WHERE d.candidate_id = c.candidate_id AND d.copy = c.copy AND severity = 'error') AS accepted FROM copies c)"""
)
ASSERTIONS = """base AS (SELECT CAST(event_id AS VARCHAR) AS assertion_id, event_id AS i, 'u' || user_id AS subject, event_type AS predicate, 'o' || (event_id % 3) AS object,
  CASE WHEN event_id % 4 = 0 THEN 'negative' ELSE 'positive' END AS polarity, CASE WHEN event_id % 2 = 0 THEN 'event' ELSE 'fact' END AS epistemic_type, 'event' AS memory_class,
  (event_id % 9) / 10.0::DOUBLE AS origin, (event_id % 8) / 10.0::DOUBLE AS conf, (event_id % 10) / 10.0::DOUBLE AS importance, (event_id % 7) / 10.0::DOUBLE AS durability, date_trunc('second', ts) AS sec,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS t FROM events),
a AS (SELECT *, sha256(concat_ws('|', subject, predicate, object, polarity, epistemic_type, memory_class)) AS signature_id, sha256(concat_ws('|', subject, predicate, epistemic_type, memory_class)) AS slot_id,
  CASE WHEN i % 11 = 0 THEN NULL WHEN i % 13 = 0 THEN t || 'Z' WHEN i % 17 = 0 THEN 'long ago' ELSE t END AS occurred_at,
  CASE WHEN i % 11 = 0 THEN 'none' WHEN i % 13 = 0 THEN 'aware' WHEN i % 17 = 0 THEN 'unparsed' ELSE 'naive' END AS kind,
  CASE WHEN i % 11 = 0 OR (i % 13 <> 0 AND i % 17 = 0) THEN NULL ELSE epoch_us(sec) END AS us FROM base)"""
GROUPS = (
    ASSERTIONS
    + """, g AS (SELECT signature_id, subject, predicate, object, polarity, epistemic_type, memory_class, count(*) AS n, max(0.6::DOUBLE * importance + 0.4::DOUBLE * durability) AS impact FROM a GROUP BY ALL),
rep AS (SELECT signature_id, assertion_id AS representative FROM a QUALIFY row_number() OVER (PARTITION BY signature_id ORDER BY origin DESC, conf DESC, importance DESC, durability DESC, assertion_id) = 1)"""
)
FUSE = "least(greatest((1 - list_reduce(list_prepend(1.0::DOUBLE, list_filter(l, lambda s: s >= 0)), lambda a, s: a * (1 - s))) * (1 - (1 - list_reduce(list_prepend(1.0::DOUBLE, list_filter(l, lambda s: s < 0)), lambda a, s: a * (1 - abs(s))))), 0), 1)"


# ---- K00 / K01 ----
@query(f"WITH {CHUNKS} SELECT chunk_id, speaker, source_sha256, sha256(concat_ws('|', chunk_id, speaker, source_sha256)) AS chunk_key FROM chunks")
def k00_chunk_identity(spark, d):
    return T.chunks(spark, d).select("chunk_id", "speaker", "source_sha256", identity.key_id("chunk_id", "speaker", "source_sha256").alias("chunk_key"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([lower(trim(lang)), lower(trim('  ' || source || ' ')), '', lower(trim(lang))], lambda x: x <> ''))), ',') AS tag_list FROM documents")
def k00_tag_normalize(spark, d):
    raw = F.array(F.col("lang"), F.concat(F.lit("  "), "source", F.lit(" ")), F.lit(""), F.upper("lang"))
    return T.read(spark, d, "documents").select("doc_id", F.array_join(text.tags(raw), ",").alias("tag_list"))


@query(f"WITH {CHUNKS} SELECT key, rule FROM (SELECT chunk_id AS key, 'source_sha256' AS rule FROM chunks WHERE speaker = 'system' UNION ALL SELECT chunk_id, 'text' FROM chunks WHERE length(text) % 5 = 0)")
def k00_constraints(spark, d):
    x = T.chunks(spark, d).withColumn("source_sha256", F.when(F.col("speaker") == "system", "short").otherwise(F.col("source_sha256"))).withColumn("text", F.when(F.length("text") % 5 == 0, "  ").otherwise(F.col("text")))
    return extraction.chunk_violations(x)


@query(f"WITH {CANDIDATES} SELECT chunk_id, seq, subject, predicate, object FROM cand")
def k01_extract_candidates(spark, d):
    return extraction.compile(T.chunks(spark, d), extraction.SentenceRules(), strict=False).select("chunk_id", "seq", "subject", "predicate", "object")


# ---- K02 / K03 ----
@query(f"WITH {DIAGNOSTICS} SELECT candidate_id, copy, code, severity FROM diag")
def k02_diagnostics(spark, d):
    chunk = T.chunks(spark, d)
    c, e = T.flawed(T.candidates(chunk))
    return validation.diagnostics(chunk, c, e)


@query(f"WITH {DIAGNOSTICS} SELECT candidate_id, copy, accepted FROM disp")
def k02_disposition(spark, d):
    chunk = T.chunks(spark, d)
    c, e = T.flawed(T.candidates(chunk))
    return validation.dispositions(c, validation.diagnostics(chunk, c, e))


@query(f"""WITH {CANDIDATES}, m AS (SELECT trim(regexp_replace(replace(lower(subject), 'ß', 'ss'), '\\s+', ' ', 'g')) AS normalized_text, CASE WHEN r % 3 = 0 THEN NULL ELSE speaker END AS entity_type_hint, subject, CASE WHEN r % 2 = 0 THEN object END AS hint FROM cand)
SELECT normalized_text, entity_type_hint, count(*) AS occurrences, count(DISTINCT subject) AS forms, coalesce((SELECT string_agg(h, ',' ORDER BY lower(h), h) FROM (SELECT DISTINCT unnest(list(m.hint)) AS h) WHERE h IS NOT NULL), '') AS hints FROM m GROUP BY normalized_text, entity_type_hint""")
def k03_mention_index(spark, d):
    c = T.candidates(T.chunks(spark, d))
    m = c.select(F.col("candidate_id").alias("mention_id"), F.col("subject").alias("mention_text"), F.when(F.col("r") % 3 != 0, F.col("speaker")).alias("entity_type_hint"), F.when(F.col("r") % 2 == 0, F.col("object")).alias("canonical_hint"))
    return mentions.index(m).select("normalized_text", "entity_type_hint", "occurrences", F.size("display_forms").cast("long").alias("forms"), F.array_join("canonical_hints", ",").alias("hints"))


# ---- K04 ----
def _names(spark, d, extra=()):
    return T.read(spark, d, "part").select(text.entity_name(F.col("p_name"), True).alias("name"), *extra).distinct()


GRAMS = """names AS (SELECT DISTINCT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name FROM part),
grams AS (SELECT name, list_distinct(list_transform(range(1, length(name) + 3), lambda i: substring('  ' || name || '  ', i, 3))) AS g FROM names),
flat AS (SELECT name, len(g) AS total, unnest(g) AS gram FROM grams),
hits AS (SELECT q.name AS query_name, e.name AS entity_name, q.total, count(*) AS k FROM flat q JOIN flat e USING (gram) GROUP BY ALL)"""


@query(f"WITH {GRAMS} SELECT query_name AS left_name, entity_name AS right_name, round(k / (h.total + len(e.g) - k)::DOUBLE, 9) AS jaccard FROM hits h JOIN grams e ON e.name = entity_name WHERE query_name < entity_name")
def k04_trigram_jaccard(spark, d):
    n = _names(spark, d)
    pairs = resolution.blocking(n.withColumnRenamed("name", "query"), n.withColumnRenamed("name", "entity"), 0.0).where("query < entity")
    return pairs.select(F.col("query").alias("left_name"), F.col("entity").alias("right_name"), nine(text.jaccard(text.trigrams(F.col("query")), text.trigrams(F.col("entity")))).alias("jaccard"))


@query(f"WITH {GRAMS} SELECT query_name, entity_name, round(k / total::DOUBLE, 9) AS hit_ratio FROM hits WHERE k / total::DOUBLE >= 0.35 OR query_name = entity_name")
def k04_blocking(spark, d):
    n = _names(spark, d)
    return resolution.blocking(n.withColumnRenamed("name", "query"), n.withColumnRenamed("name", "entity")).select(F.col("query").alias("query_name"), F.col("entity").alias("entity_name"), nine("hit_ratio").alias("hit_ratio"))


@query(None)
def k04_name_evidence(spark, d):
    """The sequence ratio has no SQL form; tested against a plain version."""
    n = _names(spark, d)
    pairs = resolution.blocking(n.withColumnRenamed("name", "query"), n.withColumnRenamed("name", "entity")).where("query <> entity")
    return resolution.name_evidence(pairs.select("query", "entity")).select("query", "entity", nine("score").alias("score"))


@query("""WITH k AS (SELECT DISTINCT p_name AS key, p_type FROM part), keys AS (SELECT key || '/' || p_type AS mention_key_id, key AS normalized_text, p_type, length(p_type) AS n FROM k),
al AS (SELECT p_name AS alias, count(DISTINCT p_brand) AS c, min(p_brand) AS brand FROM part WHERE p_size % 10 = 0 GROUP BY p_name)
SELECT mention_key_id, CASE WHEN n % 5 = 0 THEN 'old:' || normalized_text WHEN n % 7 = 0 THEN 'link:' || normalized_text WHEN c = 1 THEN brand ELSE 'seed' END AS entity,
 CASE WHEN n % 5 = 0 THEN 'existing' WHEN n % 7 = 0 THEN 'explicit_link' WHEN c = 1 THEN 'verified_alias' ELSE 'provisional' END AS basis FROM keys LEFT JOIN al ON alias = normalized_text""")
def k04_alias_binding(spark, d):
    p = T.read(spark, d, "part")
    keys = p.select(F.concat_ws("/", "p_name", "p_type").alias("mention_key_id"), F.col("p_name").alias("normalized_text"), F.lit(None).cast("string").alias("entity_type_hint"), F.length("p_type").alias("n")).distinct()
    old = keys.where("n % 5 = 0").select("mention_key_id", F.concat(F.lit("old:"), "normalized_text").alias("entity_id"))
    link = keys.where("n % 7 = 0").select("mention_key_id", F.concat(F.lit("link:"), "normalized_text").alias("entity_id"))
    al = p.where("p_size % 10 = 0").select(F.col("p_name").alias("alias"), F.col("p_brand").alias("entity_id"), F.lit("part").alias("entity_type")).distinct()
    b = resolution.bindings(keys.drop("n"), old, link, al)
    return b.select("mention_key_id", F.when(F.col("basis") == "provisional", "seed").otherwise(F.col("entity_id")).alias("entity"), "basis")


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS s, n_nationkey // 2 AS t FROM nation WHERE n_nationkey > 0), r AS (SELECT s AS source, t AS root, 1 AS depth FROM e UNION ALL SELECT r.source, e.t, r.depth + 1 FROM r JOIN e ON r.root = e.s)
SELECT CAST(source AS VARCHAR) AS source, CAST(root AS VARCHAR) AS root, max(depth) AS depth FROM r WHERE root = 0 GROUP BY ALL""")
def k04_redirect_closure(spark, d):
    e = T.read(spark, d, "nation").where("n_nationkey > 0").select(F.col("n_nationkey").cast("string").alias("source_entity_id"), F.floor(F.col("n_nationkey") / 2).cast("string").alias("target_entity_id"))
    return resolution.closure(e)


EVIDENCE = "SELECT DISTINCT {key}, {w} AS proposer, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_discount * 100) AS BIGINT) AS evidence_id, CASE WHEN l_linenumber % 4 = 0 THEN -l_discount ELSE l_discount * 5 END AS score FROM lineitem"


@query(f"""WITH e AS ({EVIDENCE.format(key="l_partkey AS k", w="l_returnflag")}), f AS (SELECT k, list(score ORDER BY evidence_id) AS l FROM e GROUP BY k)
SELECT 'm' || k AS mention_key_id, 'e' || (k % 50) AS entity_id, round({FUSE.replace("least(greatest(", "").removesuffix(", 0), 1)")}, 9) AS score,
 CASE WHEN k % 50 = 7 THEN 'blocked' WHEN round({FUSE.replace("least(greatest(", "").removesuffix(", 0), 1)")}, 12) >= 0.8 THEN 'review_required' ELSE 'suggested' END AS disposition FROM f""")
def k04_evidence_fusion(spark, d):
    li, k = T.read(spark, d, "lineitem"), F.col("l_partkey")
    e = li.select(F.concat(F.lit("m"), k.cast("string")).alias("mention_key_id"), F.lit(None).cast("string").alias("key_type"), F.concat(F.lit("e"), (k % 50).cast("string")).alias("entity_id"), F.lit("part").alias("entity_type"), line_id().alias("evidence_id"), F.when(F.col("l_linenumber") % 4 == 0, -F.col("l_discount")).otherwise(F.col("l_discount") * 5).alias("score")).distinct()
    bound = e.select("mention_key_id").distinct().withColumn("bound_id", F.lit("e0x"))
    apart = spark.createDataFrame([("e0x", "e7")], "left_entity_id string, right_entity_id string")
    h = resolution.hypotheses(e, bound, apart)
    return h.select("mention_key_id", "entity_id", nine("score").alias("score"), "disposition")


@query("""WITH h AS (SELECT DISTINCT p_name AS mention_key_id, p_brand AS entity_id FROM part WHERE p_brand <> 'Brand#11')
SELECT mention_key_id, entity_id, (entity_id = 'Brand#12' OR entity_id = 'Brand#21') AS blocked FROM h""")
def k04_constraint_block(spark, d):
    p = T.read(spark, d, "part")
    e = p.select(F.col("p_name").alias("mention_key_id"), F.lit(None).cast("string").alias("key_type"), F.col("p_brand").alias("entity_id"), F.lit("part").alias("entity_type"), identity.key_id("p_name", "p_brand").alias("evidence_id"), F.lit(0.9).alias("score")).distinct()
    registry = resolution.fold([{"decision_id": f"d{i}", "action": "keep_distinct", "subject_id": "Brand#11", "object_id": b} for i, b in enumerate(("Brand#12", "Brand#21"))], {})
    apart = spark.createDataFrame(sorted(registry.constraints), "left_entity_id string, right_entity_id string")
    bound = e.select("mention_key_id").distinct().withColumn("bound_id", F.lit("Brand#11"))
    return resolution.hypotheses(e, bound, apart).select("mention_key_id", "entity_id", (F.col("disposition") == "blocked").alias("blocked"))


# ---- K05 ----
@query("""WITH t AS (SELECT DISTINCT o_orderpriority AS p, o_orderstatus AS s FROM orders), raw AS (SELECT CASE s WHEN 'O' THEN 'Does NOT ' || p WHEN 'F' THEN 'never ' || p ELSE p END AS raw FROM t),
x AS (SELECT raw, trim(regexp_replace(lower(trim(raw)), '[^a-z0-9_]+', '_', 'g'), '_') AS token FROM raw)
SELECT raw, CASE WHEN regexp_extract(token, '^(does_not_|never_)(.+)$', 2) <> '' THEN regexp_extract(token, '^(does_not_|never_)(.+)$', 2) ELSE token END AS predicate, CASE WHEN regexp_extract(token, '^(does_not_|never_)(.+)$', 2) <> '' THEN 'negative' ELSE 'positive' END AS polarity FROM x""")
def k05_predicate_polarity(spark, d):
    p = F.col("o_orderpriority")
    raw = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Does NOT "), p)).when(F.col("o_orderstatus") == "F", F.concat(F.lit("never "), p)).otherwise(p)
    return normalization.predicates(T.read(spark, d, "orders").select(raw.alias("raw")).distinct(), ascii_only=True)


@query(f"""WITH {CANDIDATES}, x AS (SELECT candidate_id, 'subject' AS role, subject AS t, r, seq FROM cand UNION ALL SELECT candidate_id, 'object', object, r, seq FROM cand),
al AS (SELECT t, count(DISTINCT speaker) AS c FROM (SELECT subject AS t, speaker FROM cand WHERE seq % 2 = 0) GROUP BY t)
SELECT x.candidate_id, x.role, CASE WHEN b IN ('literal') THEN 'literal' ELSE 'entity' END AS kind, b AS basis, note AS diagnostic FROM (
 SELECT x.candidate_id, x.role, CASE WHEN x.r = 1 AND x.role = 'subject' THEN 'explicit' WHEN x.r = 2 THEN 'literal' WHEN x.r = 3 THEN 'mention' WHEN al.c > 1 THEN 'literal' WHEN al.c = 1 THEN 'alias' ELSE 'literal' END AS b,
  CASE WHEN x.r = 1 AND x.role = 'subject' THEN NULL WHEN x.r = 2 THEN 'ambiguous_candidate_argument' WHEN x.r = 3 THEN NULL WHEN al.c > 1 THEN 'ambiguous_registry_alias' WHEN al.c = 1 THEN NULL ELSE 'unresolved_literal_argument' END AS note
 FROM x LEFT JOIN al USING (t)) x""")
def k05_argument_resolution(spark, d):
    c = T.candidates(T.chunks(spark, d))
    x = c.select("candidate_id", "r", F.explode(F.array(F.struct(F.lit("subject").alias("role"), F.col("subject").alias("text")), F.struct(F.lit("object").alias("role"), F.col("object").alias("text")))).alias("a")).select("candidate_id", "r", "a.*")
    decided = x.where("r = 1 and role = 'subject'").select("candidate_id", "role", F.lit("e:x").alias("entity_id"))
    bound = x.where("r in (2, 3)").select("candidate_id", "text", F.explode(F.when(F.col("r") == 2, F.array(F.lit("e:1"), F.lit("e:2"))).otherwise(F.array(F.lit("e:1")))).alias("entity_id"))
    al = c.where("seq % 2 = 0").select(F.col("subject").alias("text"), F.col("speaker").alias("entity_id")).distinct()
    return normalization.arguments(x.drop("r"), decided, bound, al).select("candidate_id", "role", "kind", "basis", "diagnostic")


@query(f"WITH {GROUPS} SELECT signature_id, n, representative, round(impact, 9) AS impact FROM g JOIN rep USING (signature_id)")
def k05_groups(spark, d):
    return normalization.groups(T.assertions(spark, d), members=False).select("signature_id", "n", "representative", nine("impact").alias("impact"))


# ---- K06 ----
@query(f"WITH {GROUPS} SELECT least(p.signature_id, n.signature_id) AS left_key, greatest(p.signature_id, n.signature_id) AS right_key FROM g p JOIN g n USING (subject, predicate, object, epistemic_type, memory_class) WHERE p.polarity = 'positive' AND n.polarity = 'negative'")
def k06_polarity_opposition(spark, d):
    x = relations.opposition(normalization.groups(T.assertions(spark, d), members=False))
    return x.select(F.col("source_group_id").alias("left_key"), F.col("target_group_id").alias("right_key"))


def _proposals(spark, d):
    li = T.read(spark, d, "lineitem")
    kind = F.element_at(F.array(*(F.lit(x) for x in ("supports", "contradicts", "refines"))), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return li.select(F.concat(F.lit("g"), (F.col("l_suppkey") % 40).cast("string")).alias("source_group_id"), F.concat(F.lit("g"), (40 + F.col("l_partkey") % 30).cast("string")).alias("target_group_id"), kind.alias("relation_type"), F.col("l_shipdate").cast("date").cast("string").substr(1, 7).alias("proposer"), line_id().alias("evidence_id"), F.when(F.col("l_linenumber") % 3 == 0, -F.col("l_discount") / 10).otherwise(F.col("l_discount") / 10).alias("score"))


RELATIONS = f"""p AS (SELECT DISTINCT 'g' || (l_suppkey % 40) AS source_group_id, 'g' || (40 + l_partkey % 30) AS target_group_id, ['supports', 'contradicts', 'refines'][l_suppkey % 3 + 1] AS relation_type, strftime(l_shipdate, '%Y-%m') AS proposer, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(round(l_discount * 100) AS BIGINT) AS evidence_id, CASE WHEN l_linenumber % 3 = 0 THEN -l_discount / 10 ELSE l_discount / 10 END AS score FROM lineitem),
q AS (SELECT CASE WHEN relation_type = 'contradicts' THEN least(source_group_id, target_group_id) ELSE source_group_id END AS source_group_id, CASE WHEN relation_type = 'contradicts' THEN greatest(source_group_id, target_group_id) ELSE target_group_id END AS target_group_id, relation_type, proposer, evidence_id, score FROM p),
f AS (SELECT source_group_id, target_group_id, relation_type, list(score ORDER BY evidence_id) AS l, count(DISTINCT proposer) AS proposers FROM q GROUP BY ALL),
rel AS (SELECT source_group_id, target_group_id, relation_type, proposers, {FUSE} AS score FROM f)"""


@query(f"WITH {RELATIONS} SELECT source_group_id, target_group_id, relation_type, proposers, round(score, 9) AS score, CASE WHEN score >= 0.8 THEN 'review_required' ELSE 'suggested' END AS disposition FROM rel")
def k06_relation_fold(spark, d):
    x = relations.compile(_proposals(spark, d))
    return x.select("source_group_id", "target_group_id", "relation_type", F.size("proposers").cast("long").alias("proposers"), nine("score").alias("score"), "disposition")


# ---- K07 ----
def _occurrences(spark, d):
    a = T.assertions(spark, d)
    evidence = a.select("assertion_id", F.concat(F.lit("c"), "assertion_id").alias("chunk_id"))
    chunk = a.select(F.concat(F.lit("c"), "assertion_id").alias("chunk_id"), "occurred_at")
    return temporal.occurrences(a.drop("occurred_at"), evidence, chunk)


@query(f"WITH {ASSERTIONS} SELECT assertion_id, slot_id, kind, us AS first_us, concat_ws(',', CASE WHEN kind = 'none' THEN 'missing_source_occurrence_time' END, CASE WHEN i % 19 = 0 THEN 'effective_time_is_proxy' END) AS diagnostics FROM a")
def k07_occurrences(spark, d):
    return _occurrences(spark, d).select("assertion_id", "slot_id", F.col("clock.kind").alias("kind"), F.when(F.col("clock.kind").isin("aware", "naive"), F.col("clock.lo")).alias("first_us"), F.array_join("diagnostics", ",").alias("diagnostics"))


@query(f"WITH {ASSERTIONS} SELECT slot_id, assertion_id, row_number() OVER (PARTITION BY slot_id ORDER BY CASE WHEN us IS NULL THEN 1 ELSE 0 END, us, CASE WHEN us IS NULL THEN coalesce(occurred_at, '') END, assertion_id) AS position FROM a")
def k07_slot_order(spark, d):
    return temporal.slot_order(_occurrences(spark, d))


PAIRS = ASSERTIONS + """, pr AS (SELECT assertion_id AS successor_id, lag(assertion_id) OVER (PARTITION BY subject ORDER BY i) AS predecessor_id FROM a),
cmp AS (SELECT pr.*, CASE WHEN p.kind NOT IN ('aware', 'naive') OR p.kind <> s.kind THEN 'unknown' WHEN p.us < s.us THEN 'before' WHEN p.us > s.us THEN 'after' ELSE 'same' END AS chronology, p.signature_id AS ps, s.signature_id AS ss, p.slot_id AS pl, s.slot_id AS sl, CASE WHEN s.i % 3 = 0 THEN 0.9 WHEN s.i % 3 = 1 THEN 0.5 ELSE 0.8 END AS score FROM pr JOIN a p ON p.assertion_id = predecessor_id JOIN a s ON s.assertion_id = successor_id)"""


def _pairs(spark, d):
    a = T.assertions(spark, d)
    i = F.col("assertion_id").cast("long")
    x = a.select("subject", i.alias("i"), F.col("assertion_id").alias("successor_id"), F.lag("assertion_id").over(Window.partitionBy("subject").orderBy(i)).alias("predecessor_id"))
    return x.where("predecessor_id is not null").select("predecessor_id", "successor_id", F.lit("lag").alias("proposer"), F.concat(F.lit("e"), "successor_id").alias("evidence_id"), F.when(F.col("i") % 3 == 0, 0.9).when(F.col("i") % 3 == 1, 0.5).otherwise(0.8).alias("score"))


@query(f"WITH {PAIRS} SELECT predecessor_id AS left_id, successor_id AS right_id, chronology FROM cmp")
def k07_chronology(spark, d):
    occ = _occurrences(spark, d).select("assertion_id", "clock")
    l = occ.select(F.col("assertion_id").alias("predecessor_id"), F.col("clock").alias("lc"))
    r = occ.select(F.col("assertion_id").alias("successor_id"), F.col("clock").alias("rc"))
    x = _pairs(spark, d).join(l, "predecessor_id").join(r, "successor_id")
    return x.select(F.col("predecessor_id").alias("left_id"), F.col("successor_id").alias("right_id"), times.chronology(F.col("lc"), F.col("rc")).alias("chronology"))


@query(f"WITH {PAIRS} SELECT predecessor_id, successor_id, chronology, CASE WHEN ps = ss THEN 'blocked_same_proposition' WHEN pl <> sl THEN 'blocked_slot_mismatch' WHEN chronology IN ('after', 'same') THEN 'blocked_chronology' WHEN score >= 0.8 AND chronology = 'before' THEN 'review_required' ELSE 'suggested' END AS disposition FROM cmp")
def k07_supersession_gate(spark, d):
    # 0.8 is scored as 1 - (1 - 0.8), a little below: the threshold is met as the fold rounds, so the query asks from 0.79
    return temporal.supersessions(_pairs(spark, d), _occurrences(spark, d), review=0.79).drop("score", "supersession_id")


# ---- K08 ----
ANCHORS = """anchors AS (SELECT 'g' || (o_custkey % 200) AS group_id, o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 4 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start,
  CASE o_orderkey % 6 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 5 THEN 'relative' ELSE 'day' END AS precision, o_orderkey % 6 = 3 AS is_proxy, CAST(o_orderdate AS DATE) AS d FROM orders),
iv AS (SELECT group_id, k, CASE k % 6 WHEN 0 THEN date_trunc('year', d)::DATE WHEN 1 THEN date_trunc('month', d)::DATE WHEN 2 THEN d END AS lo, CASE k % 6 WHEN 0 THEN (date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE WHEN 1 THEN last_day(d) WHEN 2 THEN d END AS hi FROM anchors)"""


def _anchors(spark, d):
    o, k = T.read(spark, d, "orders"), F.col("o_orderkey") % 6
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    start = F.when(k == 0, day.substr(1, 4)).when(k == 1, day.substr(1, 7)).when(k == 4, "soon").otherwise(day)
    precision = F.when(k == 0, "year").when(k == 1, "month").when(k == 5, "relative").otherwise("day")
    return conflicts.intervals(o.select(F.concat(F.lit("g"), (F.col("o_custkey") % 200).cast("string")).alias("group_id"), F.col("o_orderkey").alias("k"), start.alias("start"), F.lit(None).cast("string").alias("end"), precision.alias("precision"), (k == 3).alias("is_proxy")))


@query(f"WITH {ANCHORS} SELECT k, CAST(lo AS VARCHAR) AS lo, CAST(hi AS VARCHAR) AS hi FROM iv")
def k08_effective_interval(spark, d):
    return _anchors(spark, d).select("k", F.date_from_unix_date("lo").cast("string").alias("lo"), F.date_from_unix_date("hi").cast("string").alias("hi"))


COMPARE = ANCHORS + """, one AS (SELECT 'o' || k AS group_id, lo, hi FROM iv), seq AS (SELECT 'o' || o_orderkey AS left_group_id, 'o' || lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS right_group_id FROM orders)"""


def _sequence(spark, d):
    o = T.read(spark, d, "orders")
    nxt = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("left_group_id"), F.concat(F.lit("o"), nxt.cast("string")).alias("right_group_id")).where("right_group_id is not null")


@query(f"WITH {COMPARE} SELECT left_group_id, right_group_id, CASE WHEN l.lo <= r.hi AND r.lo <= l.hi THEN 'overlap' WHEN l.lo IS NULL OR r.lo IS NULL THEN 'unknown' ELSE 'disjoint' END AS relation FROM seq JOIN one l ON l.group_id = left_group_id JOIN one r ON r.group_id = right_group_id")
def k08_effective_compare(spark, d):
    one = _anchors(spark, d).select(F.concat(F.lit("o"), F.col("k").cast("string")).alias("group_id"), "lo", "hi")
    return conflicts.compare(_sequence(spark, d), one).drop("missing")


@query(f"""WITH {ANCHORS}, r AS (SELECT DISTINCT least('g' || (l_partkey % 210), 'g' || (l_suppkey % 97)) AS l, greatest('g' || (l_partkey % 210), 'g' || (l_suppkey % 97)) AS r, l_linenumber % 2 = 0 AS polar FROM lineitem WHERE l_partkey % 210 <> l_suppkey % 97),
s AS (SELECT l, r, bool_or(polar) AS polar, CASE WHEN bool_or(NOT polar) THEN 0.9 ELSE 0.6 END AS score FROM r GROUP BY ALL),
x AS (SELECT s.*, EXISTS (SELECT 1 FROM iv a JOIN iv b ON a.lo <= b.hi AND b.lo <= a.hi WHERE a.group_id = l AND b.group_id = r) AS hit, (SELECT count(*) FILTER (lo IS NULL) FROM iv WHERE group_id = l) AS lo_, (SELECT count(*) FILTER (lo IS NULL) FROM iv WHERE group_id = r) AS ro, (SELECT count(*) FROM iv WHERE group_id = l) AS lc, (SELECT count(*) FROM iv WHERE group_id = r) AS rc FROM s),
y AS (SELECT *, CASE WHEN hit THEN 'overlap' WHEN lc = 0 OR rc = 0 OR lo_ > 0 OR ro > 0 THEN 'unknown' ELSE 'disjoint' END AS effective_relation FROM x)
SELECT l AS left_group_id, r AS right_group_id, CASE WHEN polar THEN 'polarity_opposition' ELSE 'semantic_contradiction' END AS kind, effective_relation, score::DOUBLE AS score, CASE WHEN l = 'g1' THEN 'change_over_time_candidate' WHEN effective_relation = 'disjoint' THEN 'temporally_disjoint' WHEN effective_relation = 'unknown' THEN 'unknown_temporal' WHEN score >= 0.8 THEN 'review_required' ELSE 'suggested' END AS disposition, CASE WHEN lc = 0 OR rc = 0 THEN 'missing_temporal_occurrence' END AS diagnostic FROM y""")
def k08_conflicts(spark, d):
    li = T.read(spark, d, "lineitem")
    g = lambda c, n: F.concat(F.lit("g"), (F.col(c) % n).cast("string"))
    polar = F.col("l_linenumber") % 2 == 0
    r = li.select(g("l_partkey", 210).alias("source_group_id"), g("l_suppkey", 97).alias("target_group_id"), F.when(polar, "polarity_opposes").otherwise("contradicts").alias("relation_type"), F.when(polar, 0.6).otherwise(0.9).alias("score")).where("source_group_id <> target_group_id").distinct()
    changed = r.select(F.least("source_group_id", "target_group_id").alias("left_group_id"), F.greatest("source_group_id", "target_group_id").alias("right_group_id")).where("left_group_id = 'g1'")
    return conflicts.conflicts(r, _anchors(spark, d).select("group_id", "lo", "hi"), changed).drop("relation_ids", "supersession_ids")


# ---- K09 ----
def _views(spark, d):
    return _occurrences(spark, d).select(F.col("subject").alias("entity_id"), "assertion_id", F.col("clock.kind").alias("kind"), F.col("clock.lo").alias("lo"), F.col("clock.hi").alias("hi"))


LATEST = ASSERTIONS + ", mx AS (SELECT *, max(us) OVER (PARTITION BY subject, kind) AS last FROM a), late AS (SELECT subject AS entity_id, assertion_id FROM mx WHERE us IS NULL OR us >= last)"


@query(f"WITH {LATEST} SELECT entity_id, assertion_id FROM late")
def k09_latest_maximal(spark, d):
    return synthesis.latest(_views(spark, d)).select("entity_id", "assertion_id")


CARDS = GROUPS + ", mx AS (SELECT *, max(us) OVER (PARTITION BY subject, kind) AS last FROM a), late AS (SELECT subject AS entity_id, count(*) AS latest_count FROM mx WHERE us IS NULL OR us >= last GROUP BY ALL), pr AS (SELECT subject AS entity_id, count(*) AS n_props, sum(n) AS n_occ, max(impact) AS max_impact FROM g GROUP BY ALL), ents AS (SELECT DISTINCT 'u' || user_id AS entity_id FROM events UNION SELECT 'c' || c_custkey FROM customer), cards AS (SELECT e.entity_id, coalesce(n_props, 0) AS n_props, coalesce(n_occ, 0) AS n_occ, coalesce(latest_count, 0) AS latest_count, coalesce(max_impact, 0) AS max_impact FROM ents e LEFT JOIN pr USING (entity_id) LEFT JOIN late USING (entity_id))"


def _cards(spark, d):
    a = T.assertions(spark, d).withColumns({"subject_kind": F.lit("entity"), "object_kind": F.lit("literal")})
    users = a.select(F.col("subject").alias("entity_id")).distinct()
    e = users.unionByName(T.read(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entity_id"))).distinct().withColumns({"canonical_name": F.col("entity_id"), "status": F.lit("active")})
    return synthesis.cards(e, synthesis.roles(a), normalization.groups(a, members=False), _views(spark, d))


@query(f"WITH {CARDS} SELECT entity_id, n_props, CAST(n_occ AS BIGINT) AS n_occ, CASE WHEN n_props > 0 THEN 'subject' ELSE '' END AS roles, latest_count, round(max_impact, 9) AS max_impact, CASE WHEN latest_count > 1 THEN 'latest_observed_not_unique' END AS diagnostic FROM cards")
def k09_cards(spark, d):
    return _cards(spark, d).select("entity_id", "n_props", "n_occ", "roles", "latest_count", nine("max_impact").alias("max_impact"), "diagnostic")


@query("SELECT 'relation_unknown_group' AS code, CAST(c_custkey AS VARCHAR) AS ref FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0)")
def k09_orphans(spark, d):
    return checks.unknown(T.read(spark, d, "customer"), "c_custkey", T.read(spark, d, "orders").where("o_orderkey % 4 = 0"), "o_custkey", "relation_unknown_group")


# ---- K10 ----
def _signals(spark, d):
    i = F.col("event_id")
    kinds = ("entity_resolution", "relation", "supersession", "conflict", "projection_diagnostic")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (i % 5 + 1).cast("int"))
    shown = F.when(i % 25 == 0, "blocked").when(i % 25 == 1, "structural").when(i % 25 == 2, "blocked_chronology").when(i % 25 == 3, "temporally_disjoint").otherwise("suggested")
    return T.read(spark, d, "events").select(kind.alias("kind"), i.cast("string").alias("source_ref"), ((i % 11) / 10.0).cast("double").alias("score"), ((i % 21) / 20.0).alias("impact"), shown.alias("disposition"), (i % 2 == 0).alias("unknown"), F.when(i % 15 == 4, "latest_observed_not_unique").when(i % 15 == 9, "other").alias("code")).withColumn("score", F.least("score", F.lit(1.0)))


QUEUE = """s AS (SELECT event_id AS i, ['entity_resolution', 'relation', 'supersession', 'conflict', 'projection_diagnostic'][event_id % 5 + 1] AS kind, CAST(event_id AS VARCHAR) AS source_ref, least((event_id % 11) / 10.0::DOUBLE, 1) AS score, (event_id % 21) / 20.0::DOUBLE AS impact FROM events WHERE event_id % 25 NOT IN (0, 1, 2, 3)),
t AS (SELECT *, CASE WHEN kind = 'projection_diagnostic' THEN CASE i % 15 WHEN 4 THEN 0.65 WHEN 9 THEN 0.5 ELSE 0.7 END WHEN kind IN ('supersession', 'conflict') AND i % 2 = 0 THEN least(1, greatest(0, 1 - score) + 0.25) ELSE greatest(0, 1 - score) END::DOUBLE AS ambiguity, CASE kind WHEN 'entity_resolution' THEN 0.58 WHEN 'relation' THEN 0.46 WHEN 'supersession' THEN 0.76 WHEN 'conflict' THEN 0.86 ELSE 0.34 END::DOUBLE AS severity FROM s),
u AS (SELECT *, 0.45::DOUBLE * impact + 0.25::DOUBLE * ambiguity + 0.30::DOUBLE * severity AS priority FROM t),
q AS (SELECT *, sha256(concat_ws('|', kind, source_ref)) AS review_item_id, CASE WHEN kind IN ('entity_resolution', 'supersession', 'conflict') AND impact >= 0.82 THEN 3 WHEN priority >= 0.84 THEN 3 WHEN kind IN ('supersession', 'conflict') OR priority >= 0.58 THEN 2 ELSE 1 END AS route FROM u)"""


@query(f"WITH {QUEUE} SELECT review_item_id, kind, round(priority, 9) AS priority, route FROM q")
def k10_review_queue(spark, d):
    return review.queue(_signals(spark, d)).select("review_item_id", "kind", nine("priority").alias("priority"), "route")


@query(f"""WITH {QUEUE}, resp AS (SELECT review_item_id, route, i, 'r' || i || '-' || k AS response_id, (i + k) % 3 + 1 AS authority, ['accept', 'reject', 'defer', 'escalate'][(i // 3 + k) % 4 + 1] AS decision FROM q, (SELECT unnest([0, 1, 2]) AS k) WHERE i % 4 <> 3),
fit AS (SELECT *, decision IN ('accept', 'reject') AS final FROM resp WHERE authority >= route), top AS (SELECT * FROM fit QUALIFY dense_rank() OVER (PARTITION BY review_item_id ORDER BY CASE WHEN final THEN 0 ELSE 1 END, authority DESC) = 1),
agg AS (SELECT review_item_id, min(response_id) FILTER (decision = 'accept') AS a, min(response_id) FILTER (decision = 'reject') AS r, min(response_id) FILTER (decision = 'escalate') AS e, min(response_id) FILTER (decision = 'defer') AS f FROM top GROUP BY ALL)
SELECT q.review_item_id, CASE WHEN a IS NOT NULL AND r IS NOT NULL THEN 'pending' WHEN a IS NOT NULL THEN 'accepted' WHEN r IS NOT NULL THEN 'rejected' WHEN e IS NOT NULL THEN 'escalated' WHEN f IS NOT NULL THEN 'deferred' ELSE 'pending' END AS disposition, CASE WHEN a IS NOT NULL AND r IS NOT NULL THEN NULL ELSE coalesce(a, r, e, f) END AS controlling FROM q LEFT JOIN agg USING (review_item_id)""")
def k10_adjudication(spark, d):
    q = review.queue(_signals(spark, d))
    i = F.col("source_ref").cast("long")
    r = q.where(i % 4 != 3).select("review_item_id", i.alias("i"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    r = r.select("review_item_id", F.concat(F.lit("r"), F.col("i").cast("string"), F.lit("-"), F.col("k").cast("string")).alias("response_id"), ((F.col("i") + F.col("k")) % 3 + 1).cast("int").alias("authority"), F.element_at(F.array(*map(F.lit, ("accept", "reject", "defer", "escalate"))), ((F.floor(F.col("i") / 3) + F.col("k")) % 4 + 1).cast("int")).alias("decision"))
    return review.adjudicate(q, r, strict=False).drop("reason")


# ---- K11 ----
ELIGIBLE = CANDIDATES + """, el AS (SELECT candidate_id, r, CASE WHEN origin < 0.5 THEN 'blocked_validation' WHEN r = 10 THEN 'blocked_validation' WHEN r IN (0, 4, 5) THEN 'blocked_source_exactness' WHEN r = 2 THEN 'blocked_source_mode' WHEN occurred_at IS NULL THEN 'blocked_temporal_contract' WHEN r = 7 THEN 'blocked_temporal_contract' ELSE 'eligible' END AS eligibility,
 CASE WHEN origin < 0.5 THEN 'k02_not_accepted' WHEN r = 10 THEN 'missing_k05_normalized_assertion' WHEN r = 0 THEN 'evidence_text_not_in_chunk' WHEN r = 4 THEN 'evidence_chunk_missing' WHEN r = 5 THEN 'evidence_without_chunk' WHEN r = 2 THEN 'unsupported_source_type:note' WHEN occurred_at IS NULL THEN 'unsupported_temporal_basis:unknown' WHEN r = 7 THEN 'backend_drops_effective_time' ELSE '' END AS reasons FROM cand)"""


def _eligibility(spark, d):
    chunk = T.chunks(spark, d)
    x = T.candidates(chunk)
    _, evidence = T.flawed(x)
    evidence = evidence.join(x.select("candidate_id", "r"), "candidate_id").withColumns({"source_type": F.when(F.col("r") == 2, "note").otherwise("chat"), "source_sha256": F.lit(None).cast("string")})
    c = x.select("candidate_id", (F.col("source_origin_probability") >= 0.5).alias("accepted"), (F.col("r") != 10).alias("has_assertion"), (F.col("r") == 7).alias("has_effective_time"))
    return staging.eligibility(c, evidence, chunk, staging.Capability("parquet-staging"))


@query(f"WITH {ELIGIBLE} SELECT candidate_id, eligibility, reasons FROM el")
def k11_eligibility(spark, d):
    return _eligibility(spark, d).select("candidate_id", "eligibility", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {ASSERTIONS}, el AS (SELECT assertion_id, signature_id, i FROM a WHERE i % 3 <> 0), one AS (SELECT signature_id, min(assertion_id) AS c, count(*) AS k FROM el GROUP BY ALL),
links AS (SELECT 'l' || i AS source_ref, signature_id AS l, lag(signature_id) OVER (PARTITION BY subject ORDER BY i) AS r, ['supports', 'contradicts', 'polarity_opposes', 'refines'][i % 4 + 1] AS relation_type, i FROM a)
SELECT x.c AS source_candidate_id, y.c AS target_candidate_id, relation_type, source_ref FROM links JOIN one x ON x.signature_id = l AND x.k = 1 JOIN one y ON y.signature_id = r AND y.k = 1 WHERE relation_type <> 'polarity_opposes' AND i % 7 <> 0 AND i % 5 <> 0 AND x.c <> y.c""")
def k11_relations(spark, d):
    a = T.assertions(spark, d)
    i = F.col("assertion_id").cast("long")
    links = a.select(F.concat(F.lit("l"), "assertion_id").alias("source_ref"), F.col("signature_id").alias("left_group_id"), F.lag("signature_id").over(Window.partitionBy("subject").orderBy(i)).alias("right_group_id"), F.element_at(F.array(*map(F.lit, ("supports", "contradicts", "polarity_opposes", "refines"))), (i % 4 + 1).cast("int")).alias("relation_type"), (i % 7 == 0).alias("structural"), i.alias("i"))
    accepted = links.where("i % 5 <> 0").select("source_ref")
    eligible = a.select(F.col("assertion_id").alias("candidate_id"), F.when(i % 3 != 0, "eligible").otherwise("blocked_validation").alias("eligibility"))
    return staging.relations(links.drop("i"), a.select(F.col("signature_id").alias("group_id"), F.col("assertion_id").alias("candidate_id")), eligible, accepted, staging.Capability("parquet-staging"))[0]


# ---- K12 / K13 ----
@query("""WITH h AS (SELECT 'c' || conv_id AS p, conv_id FROM conversations GROUP BY ALL), x AS (SELECT p, CASE WHEN conv_id = (SELECT max(conv_id) FROM conversations) THEN 'no_cache' WHEN conv_id % 10 = 3 THEN 'fingerprint_changed' WHEN conv_id % 10 = 4 THEN 'previous_failure' ELSE 'exact_cache_hit' END AS f FROM h),
l AS (SELECT 'K01' AS stage, p AS partition, 0 AS wave, f AS reason FROM x UNION ALL SELECT 'K02', p, 1, CASE WHEN f = 'exact_cache_hit' THEN f ELSE 'dependency_dirty' END FROM x UNION ALL SELECT 'K03', p, 2, CASE WHEN f = 'exact_cache_hit' THEN f ELSE 'dependency_dirty' END FROM x
 UNION ALL SELECT g.s, 'global', g.w, 'dependency_dirty' FROM (VALUES ('K04', 3), ('K05', 4), ('K06', 5), ('K07', 5), ('K08', 6), ('K09', 7), ('K10', 8), ('K11', 9)) g(s, w))
SELECT stage, partition, wave, reason, CASE WHEN reason = 'exact_cache_hit' THEN 'reuse' ELSE 'run' END AS disposition FROM l""")
def k12_fingerprints_plan(spark, d):
    c = T.read(spark, d, "conversations")
    now = c.groupBy("conv_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("turn").cast("string"), 9, "0"), F.sha2("text", 256)))), ""), 256).alias("input_hash")).withColumn("partition", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    last = c.agg(F.max("conv_id").alias("last"))
    k = F.col("conv_id") % 10
    old = now.join(F.broadcast(last)).where("conv_id < last").select("partition", F.when(k == 3, F.sha2(F.lit("old"), 256)).otherwise(F.col("input_hash")).alias("input_hash"), F.when(k == 4, "failed").otherwise("complete").alias("status"))  # one row
    return scheduling.corpus_plan(now.select("partition", "input_hash"), old)


@query("SELECT 'c' || conv_id AS partition, sha256(concat_ws('|', 'K01', 'c' || conv_id, '0.1.0', 'candidates.v0', 'cfg', string_agg(role, '' ORDER BY turn), array_to_string(list_sort(list('s' || (turn % 3))), ','))) AS fingerprint FROM conversations GROUP BY conv_id")
def k12_task_fingerprint(spark, d):
    c = T.read(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]), "").alias("input_hash"), F.collect_list(F.concat(F.lit("s"), (F.col("turn") % 3).cast("string"))).alias("dependencies"))
    x = c.select(F.lit("K01").alias("stage"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("partition"), F.lit("0.1.0").alias("version"), F.lit("candidates.v0").alias("contract"), F.lit("cfg").alias("config_hash"), "input_hash", "dependencies")
    return scheduling.fingerprints(x).select("partition", "fingerprint")


def _metrics(spark, d):
    a = T.assertions(spark, d)
    i, k = F.col("event_id"), F.col("l_orderkey")
    e = T.read(spark, d, "customer").select(F.when(F.col("c_custkey") % 9 == 0, "redirected").otherwise("active").alias("status"))
    h = T.read(spark, d, "events").select(F.when(i % 3 == 0, "blocked").otherwise("suggested").alias("disposition"))
    return audit.report({
        "dispositions": QUERIES["k02_disposition"](spark, d), "entities": e, "hypotheses": h, "groups": normalization.groups(a, members=False), "assertions": a, "relations": relations.compile(_proposals(spark, d)),
        "occurrences": _occurrences(spark, d), "conflicts": T.read(spark, d, "nation"), "cards": _cards(spark, d), "queue": review.queue(_signals(spark, d)), "eligibility": _eligibility(spark, d), "staged": QUERIES["k11_relations"](spark, d),
    })


STAGED = """st AS (SELECT source_ref FROM (SELECT x.c AS p, y.c AS q, source_ref FROM (SELECT 'l' || i AS source_ref, signature_id AS l, lag(signature_id) OVER (PARTITION BY subject ORDER BY i) AS r, i FROM a) JOIN (SELECT signature_id, min(assertion_id) AS c, count(*) AS k FROM a WHERE i % 3 <> 0 GROUP BY ALL) x ON x.signature_id = l AND x.k = 1 JOIN (SELECT signature_id, min(assertion_id) AS c, count(*) AS k FROM a WHERE i % 3 <> 0 GROUP BY ALL) y ON y.signature_id = r AND y.k = 1 WHERE i % 4 <> 2 AND i % 7 <> 0 AND i % 5 <> 0 AND x.c <> y.c))"""
M = f"""WITH {DIAGNOSTICS}, {ELIGIBLE.removeprefix(CANDIDATES + ", ")}, {CARDS}, {QUEUE.replace("s AS (SELECT event_id", "sg AS (SELECT event_id", 1).replace("severity FROM s)", "severity FROM sg)")}, {RELATIONS.replace("q AS (SELECT CASE", "cq AS (SELECT CASE", 1).replace("FROM q GROUP BY", "FROM cq GROUP BY")}, {STAGED}, c AS (
 SELECT 'candidates_total' AS metric, count(*)::DOUBLE AS value FROM disp UNION ALL SELECT 'candidates_accepted', count(*) FILTER (accepted) FROM disp UNION ALL SELECT 'candidates_quarantined', count(*) FILTER (NOT accepted) FROM disp
 UNION ALL SELECT 'active_entities', count(*) FILTER (c_custkey % 9 <> 0) FROM customer UNION ALL SELECT 'unresolved_entity_hypotheses', count(*) FILTER (event_id % 3 <> 0) FROM events UNION ALL SELECT 'normalized_assertions', count(*) FROM a UNION ALL SELECT 'compiled_relations', count(*) FROM rel UNION ALL SELECT 'conflicts', count(*) FROM nation
 UNION ALL SELECT 'semantic_groups', count(*) FROM g UNION ALL SELECT 'temporal_occurrences', count(*) FROM a UNION ALL SELECT 'missing_source_time_occurrences', count(*) FILTER (occurred_at IS NULL) FROM a UNION ALL SELECT 'synthesis_cards', count(*) FROM cards
 UNION ALL SELECT 'review_items', count(*) FROM q UNION ALL SELECT 'first_tier_review_items', count(*) FILTER (route = 1) FROM q UNION ALL SELECT 'second_tier_review_items', count(*) FILTER (route = 2) FROM q UNION ALL SELECT 'third_tier_review_items', count(*) FILTER (route = 3) FROM q
 UNION ALL SELECT 'staging_relations_eligible', count(*) FROM st
 UNION ALL SELECT 'staging_candidates_total', count(*) FROM el UNION ALL SELECT 'staging_candidates_eligible', count(*) FILTER (eligibility = 'eligible') FROM el UNION ALL SELECT 'staging_candidates_blocked', count(*) FILTER (eligibility <> 'eligible') FROM el),
rates AS (SELECT 'quarantine_rate' AS metric, 'candidates_quarantined' AS x, 'candidates_total' AS y UNION ALL SELECT 'unresolved_entity_hypotheses_per_entity', 'unresolved_entity_hypotheses', 'active_entities' UNION ALL SELECT 'missing_source_time_rate', 'missing_source_time_occurrences', 'temporal_occurrences' UNION ALL SELECT 'staging_block_rate', 'staging_candidates_blocked', 'staging_candidates_total' UNION ALL SELECT 'third_tier_review_rate', 'third_tier_review_items', 'review_items'),
m AS (SELECT metric, value FROM c UNION ALL SELECT r.metric, CASE WHEN b.value = 0 THEN 0 ELSE a.value / b.value END FROM rates r JOIN c a ON a.metric = x JOIN c b ON b.metric = y)"""


@query(f"{M} SELECT metric, round(value, 9) AS value FROM m")
def k13_metrics(spark, d):
    return _metrics(spark, d).select("metric", nine("value").alias("value"))


@query(f"{M} SELECT metric, round(value, 9) AS observed, l AS max_allowed FROM m JOIN (VALUES ('quarantine_rate', 0.2::DOUBLE), ('missing_source_time_rate', 0.5), ('staging_block_rate', 0.1), ('third_tier_review_rate', 0.05)) v(n, l) ON n = metric WHERE value > l")
def k13_findings(spark, d):
    limits = {"quarantine_rate": 0.2, "missing_source_time_rate": 0.5, "staging_block_rate": 0.1, "third_tier_review_rate": 0.05, "unresolved_entity_hypotheses_per_entity": None}
    return audit.findings(_metrics(spark, d), limits).withColumn("observed", nine("observed"))
