"""Further registered queries: constraints, registries, records and the wired stages, each with independent SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import checks, identity, text
from ..operators import conflicts, extraction, normalization, resolution, review, scheduling, staging, synthesis, temporal
from ..sources import tables as T
from .catalogue import ASSERTIONS, CANDIDATES, CHUNKS, GRAMS, GROUPS, _occurrences, nine, query


def s(x) -> F.Column:
    return F.col(x).cast("string") if isinstance(x, str) else x.cast("string")


def tag(prefix: str, x) -> F.Column:
    return F.concat(F.lit(prefix), s(x))


# ---- K00 / K01 ----
@query("""WITH e AS (SELECT event_id AS i FROM events) SELECT 'response:' || i AS key, rule FROM (
 SELECT i, 'reviewer' AS rule FROM e WHERE i % 7 = 0 UNION ALL SELECT i, 'reason' FROM e WHERE i % 5 = 0 UNION ALL SELECT i, 'authority' FROM e WHERE i % 5 IN (0, 4) UNION ALL SELECT i, 'decision' FROM e WHERE i % 6 = 4)
UNION ALL SELECT 'relation:' || i, 'ends' FROM e WHERE i % 3 = i % 4 UNION ALL SELECT 'relation:' || i, 'score' FROM e WHERE i % 13 > 10
UNION ALL SELECT 'conflict:' || i, 'order' FROM e WHERE i % 3 >= i % 4 UNION ALL SELECT 'conflict:' || i, 'score' FROM e WHERE i % 13 > 10
UNION ALL SELECT 'mention:' || i, 'mention_text' FROM e WHERE i % 7 = 0 UNION ALL SELECT 'mention:' || i, 'confidence' FROM e WHERE i % 13 > 10 OR i % 13 = 5
UNION ALL SELECT 'candidate:' || i, 'tags' FROM e WHERE i % 40 > 32 UNION ALL SELECT 'candidate:' || i, 'durability' FROM e WHERE i % 13 > 10""")
def k00_record_constraints(spark, d):
    i = F.col("event_id")
    share = (i % 13) / 10.0
    pick = F.element_at(F.array(*map(F.lit, ("accept", "reject", "defer", "escalate", "maybe", "accept"))), (i % 6 + 1).cast("int"))
    end = lambda n: tag("g", i % n)
    columns = {
        "response": {"reviewer": F.when(i % 7 != 0, "r").otherwise(""), "reason": F.when(i % 5 != 0, "ok").otherwise("  "), "authority": i % 5, "decision": pick},
        "relation": {"source_group_id": end(3), "target_group_id": end(4), "score": share},
        "conflict": {"left_group_id": end(3), "right_group_id": end(4), "score": share},
        "mention": {"mention_text": F.when(i % 7 != 0, "x"), "confidence": F.when(i % 13 != 5, share)},
        "candidate": {"statement": F.lit("x"), "importance": F.lit(0.5), "durability": share, "tags": F.transform(F.sequence(F.lit(1), F.greatest(i % 40, F.lit(1))), lambda n: n.cast("string"))},
    }
    out = None
    for kind, c in columns.items():
        x = checks.record_violations(T.read(spark, d, "events").select(tag(f"{kind}:", i).alias("key_"), *(v.alias(k) for k, v in c.items())), "key_", kind)
        out = x if out is None else out.unionByName(x)
    return out


@query("""SELECT 'mention keys' AS what, user_id || '/' || event_type AS key, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1
UNION ALL SELECT 'candidates', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL SELECT 'group signatures', CAST(n_regionkey AS VARCHAR), count(*) FROM nation GROUP BY n_regionkey HAVING count(*) > 1""")
def k00_identity_guards(spark, d):
    x = checks.duplicates(T.read(spark, d, "events"), "user_id", "event_type", what="mention keys")
    x = x.unionByName(checks.duplicates(T.read(spark, d, "orders"), "o_custkey", what="candidates"))
    return x.unionByName(checks.duplicates(T.read(spark, d, "nation"), "n_regionkey", what="group signatures"))


@query("""WITH r AS (SELECT sha256(CAST(json_object('conv_id', conv_id, 'role', role, 'turn', turn) AS VARCHAR)) AS h FROM conversations),
p AS (SELECT CAST('0x' || h[1:4] AS BIGINT) % 256 AS b, sha256(string_agg(h, '' ORDER BY h)) AS h FROM r GROUP BY h[1:4], h[1:8]),
q AS (SELECT b, sha256(string_agg(h, '' ORDER BY h)) AS h FROM p GROUP BY b)
SELECT sha256(string_agg(h, '' ORDER BY h)) AS hash FROM q""")
def k00_output_hash(spark, d):
    return identity.table_hash(T.read(spark, d, "conversations"), "conv_id", "role", "turn")


@query(f"WITH {CHUNKS} SELECT conversation_id, chunk_id, row_number() OVER (PARTITION BY conversation_id ORDER BY coalesce(occurred_at, ''), chunk_id) AS place FROM chunks")
def k01_chunk_order(spark, d):
    return extraction.ordered(T.chunks(spark, d))


@query(f"WITH {CANDIDATES} SELECT 'duplicate_candidate_id' AS code, candidate_id AS ref FROM cand WHERE r = 6 UNION ALL SELECT DISTINCT 'evidence_outside_input', 'missing:' || chunk_id FROM cand WHERE r = 4")
def k01_problems(spark, d):
    chunk = T.chunks(spark, d)
    c, e = T.flawed(T.candidates(chunk))
    return extraction.problems(chunk, c.join(e.select("candidate_id", "chunk_id"), "candidate_id"))


# ---- K04 ----
@query("""WITH a AS (SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN upper(p_type) ELSE p_type || 'ß' END AS t, p_size % 4 AS k FROM part)
SELECT DISTINCT x.k AS left_kind, y.k AS right_kind, x.t AS left_type, y.t AS right_type, x.t IS NULL OR y.t IS NULL OR replace(lower(x.t), 'ß', 'ss') = replace(lower(y.t), 'ß', 'ss') AS fits FROM a x JOIN a y ON x.k < y.k AND coalesce(lower(x.t[1:3]), '') <= coalesce(lower(y.t[1:3]), '')""")
def k04_compatible_types(spark, d):
    k = F.col("p_size") % 4
    a = T.read(spark, d, "part").select(F.when(k == 0, None).when(k == 1, F.upper("p_type")).otherwise(F.concat("p_type", F.lit("ß"))).alias("t"), k.alias("k")).distinct()
    a = a.withColumn("f", text.casefold(F.col("t")))
    x, y = (a.select(F.col("t").alias(f"{p}_type"), F.col("k").alias(f"{p}_kind"), F.col("f").alias(f"{p}_f")) for p in ("left", "right"))
    start = lambda c: F.coalesce(F.lower(F.substring(c, 1, 3)), F.lit(""))
    z = x.join(y, (F.col("left_kind") < F.col("right_kind")) & (start("left_type") <= start("right_type")))  # a few kinds of parts
    return z.select("left_kind", "right_kind", "left_type", "right_type", text.compatible_types(F.col("left_f"), F.col("right_f")).alias("fits")).distinct()


LOG = """l AS (SELECT 'd' || o_orderkey AS decision_id, CASE o_orderkey % 5 WHEN 0 THEN 'retract_decision' WHEN 1 THEN 'link_mention' ELSE 'merge_entity' END AS action,
 CASE WHEN o_orderkey % 5 = 0 THEN 'd' || (o_orderkey + 1) ELSE 's' || o_custkey END AS subject_id, o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0), gone AS (SELECT subject_id AS i FROM l WHERE action = 'retract_decision')"""


def _log(spark, d):
    k = F.col("o_orderkey")
    x = T.read(spark, d, "orders").select(tag("d", k).alias("decision_id"), F.when(k % 5 == 0, "retract_decision").when(k % 5 == 1, "link_mention").otherwise("merge_entity").alias("action"), F.when(k % 5 == 0, tag("d", k + 1)).otherwise(tag("s", "o_custkey")).alias("subject_id"), k.alias("k"))
    return resolution.decision_log(x.where("k % 2 = 0"), x.where("k % 3 = 0")), x.where("k % 7 = 0 and (k % 2 = 0 or k % 3 = 0) and action <> 'retract_decision'").select("decision_id")


@query(f"WITH {LOG} SELECT decision_id, action, subject_id FROM l WHERE action <> 'retract_decision' AND decision_id NOT IN (SELECT i FROM gone) AND k % 7 <> 0")
def k04_pending_decisions(spark, d):
    return resolution.pending(*_log(spark, d)).drop("k")


@query(f"WITH {LOG} SELECT decision_id FROM l WHERE k % 7 = 0 AND action <> 'retract_decision' AND decision_id IN (SELECT i FROM gone)")
def k04_retracted_after_use(spark, d):
    return resolution.retracted_after_use(*_log(spark, d))


REG = """ent AS (SELECT 'e' || k AS entity_id, CASE WHEN k % 3 = 0 THEN NULL ELSE upper('Brand#' || (k % 5 + 1) || '1') END AS entity_type, CASE WHEN k % 10 = 1 THEN 'redirected' ELSE 'active' END AS status, k FROM (SELECT unnest(range(1, 41)) AS k)),
rt AS (SELECT 'e' || k AS source, 'e' || (k + 1) AS root FROM (SELECT unnest(range(1, 41)) AS k) WHERE k % 10 = 1)"""


def _registry(spark):
    k = F.col("id")
    e = spark.range(1, 41).select(tag("e", k).alias("entity_id"), F.when(k % 3 != 0, F.concat(F.lit("BRAND#"), s(k % 5 + 1), F.lit("1"))).alias("entity_type"), F.when(k % 10 == 1, "redirected").otherwise("active").alias("status"), tag("Name ", k % 7).alias("canonical_name"), k.alias("k"))
    return e, e.where("k % 10 = 1").select(F.col("entity_id").alias("source"), tag("e", F.col("k") + 1).alias("root"))


@query(f"""WITH {REG}, l AS (SELECT DISTINCT p_name || '/' || p_brand AS mention_key_id, p_brand, 'e' || (length(p_name) * 3 % 50 + 1) AS t FROM part),
x AS (SELECT mention_key_id, p_brand, coalesce(root, t) AS t FROM l LEFT JOIN rt ON source = t)
SELECT mention_key_id, CASE WHEN entity_id IS NULL THEN 'link_target_unknown' ELSE 'link_target_type' END AS code FROM x LEFT JOIN ent ON entity_id = t WHERE entity_id IS NULL OR (entity_type IS NOT NULL AND lower(entity_type) <> lower(p_brand))""")
def k04_link_checks(spark, d):
    e, roots = _registry(spark)
    p = T.read(spark, d, "part").select(F.concat_ws("/", "p_name", "p_brand").alias("mention_key_id"), F.col("p_brand").alias("entity_type_hint"), tag("e", F.length("p_name") * 3 % 50 + 1).alias("entity_id")).distinct()
    return resolution.link_problems(p.drop("entity_id"), p.drop("entity_type_hint"), e, roots)


@query(f"""WITH {REG}, al AS (SELECT DISTINCT c_mktsegment AS alias, 'e' || (c_nationkey + 1) AS t FROM customer)
SELECT DISTINCT alias, e.entity_id, entity_type FROM al LEFT JOIN rt ON source = t JOIN ent e ON e.entity_id = coalesce(root, t) WHERE status = 'active'""")
def k04_prior_aliases(spark, d):
    e, roots = _registry(spark)
    al = T.read(spark, d, "customer").select(F.col("c_mktsegment").alias("alias"), tag("e", F.col("c_nationkey") + 1).alias("entity_id")).distinct()
    return resolution.alias_index(al, e, roots)


@query(f"""WITH {REG}, k AS (SELECT DISTINCT p_name AS m FROM part), b AS (SELECT m, 'e' || (length(m) % 40 + 1) AS t, length(m) AS n FROM k)
SELECT m AS mention_key_id, CASE WHEN n % 2 = 0 THEN coalesce(root, t) ELSE 'entityv0_' || sha256('{{"entity_type":null,"mention_key_id":"' || m || '"}}') END AS entity_id, CASE WHEN n % 2 = 0 THEN 'existing' ELSE 'provisional' END AS basis FROM b LEFT JOIN rt ON source = t""")
def k04_existing_at_root(spark, d):
    e, roots = _registry(spark)
    k = T.read(spark, d, "part").select(F.col("p_name").alias("mention_key_id"), F.col("p_name").alias("normalized_text"), F.lit(None).cast("string").alias("entity_type_hint")).distinct()
    old = k.where("length(mention_key_id) % 2 = 0").select("mention_key_id", tag("e", F.length("mention_key_id") % 40 + 1).alias("entity_id"))
    none = spark.createDataFrame([], "mention_key_id string, entity_id string")
    return resolution.bindings(k, old, none, spark.createDataFrame([], "alias string, entity_id string, entity_type string"), roots=roots, entities=e)


@query("""WITH k AS (SELECT p_name AS m, max(p_brand) AS t, arg_min(trim(p_type), lower(trim(p_type)) || chr(1) || p_type) AS name FROM part GROUP BY p_name)
SELECT 'entityv0_' || sha256('{"entity_type":"' || t || '","mention_key_id":"' || m || '"}') AS entity_id, t AS entity_type, name AS canonical_name, m AS anchor_mention_key_id, 'active' AS status FROM k""")
def k04_seeds(spark, d):
    k = T.read(spark, d, "part").groupBy(F.col("p_name").alias("mention_key_id")).agg(F.max("p_brand").alias("entity_type_hint"), F.collect_set(F.concat(F.lit(" "), "p_type")).alias("display_forms"))
    bound = k.select("mention_key_id", resolution.seed_id(F.col("mention_key_id"), F.col("entity_type_hint")).alias("entity_id"), F.lit("provisional").alias("basis"))
    return resolution.seeds(bound, k)


def _merges():
    return resolution.fold([{"decision_id": f"d{k:02d}", "action": "merge_entity", "subject_id": f"n{k}", "object_id": f"n{k // 2}"} for k in range(1, 25)] + [{"decision_id": "d99", "action": "set_canonical_name", "subject_id": "n7", "canonical_name": " One "}], {})


@query("SELECT 'c' || c_custkey AS mention_key_id, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE 'n0' END AS entity_id, CASE WHEN c_custkey % 3 = 0 THEN 'existing' ELSE 'merged_entity' END AS basis, CASE WHEN c_custkey % 3 <> 0 THEN 'd24' END AS decision_id FROM customer")
def k04_rebinding(spark, d):
    k = F.col("c_custkey")
    b = T.read(spark, d, "customer").select(tag("c", k).alias("mention_key_id"), F.when(k % 3 == 0, "x").otherwise(tag("n", "c_nationkey")).alias("entity_id"), F.lit("existing").alias("basis"))
    return resolution.rebind(b, _merges())


@query("SELECT 'n' || n_nationkey AS entity_id, CASE WHEN n_nationkey = 0 THEN 'One' ELSE n_name END AS canonical_name, CASE WHEN n_nationkey = 0 THEN 'active' ELSE 'redirected' END AS status FROM nation")
def k04_entity_status(spark, d):
    r = _merges()
    e = T.read(spark, d, "nation").select(tag("n", "n_nationkey").alias("entity_id"), F.col("n_name").alias("canonical_name"))
    return resolution.entity_table(e, r.roots(spark), r.names)


@query("""WITH x AS (SELECT CASE WHEN c_nationkey = 0 THEN 'z' ELSE 'n0' END AS e, lower(c_mktsegment) AS n, c_mktsegment AS f, 'k' || (c_custkey % 10) AS k FROM customer UNION ALL SELECT 'n0', lower(n_name), n_name, 'k0' FROM nation)
SELECT e AS entity_id, n AS normalized, array_to_string(list_sort(list_distinct(list(f))), ',') AS forms, array_to_string(list_sort(list_distinct(list(k))), ',') AS keys FROM x GROUP BY e, n""")
def k04_alias_table(spark, d):
    c = T.read(spark, d, "customer").select(F.when(F.col("c_nationkey") == 0, "z").otherwise(tag("n", "c_nationkey")).alias("entity_id"), F.lower("c_mktsegment").alias("normalized"), F.col("c_mktsegment").alias("display_form"), tag("k", F.col("c_custkey") % 10).alias("mention_key_id"))
    n = T.read(spark, d, "nation").select(tag("n", "n_nationkey").alias("entity_id"), F.lower("n_name").alias("normalized"), F.col("n_name").alias("display_form"), F.lit("k0").alias("mention_key_id"))
    out = resolution.alias_table(c, n, _merges().roots(spark))
    return out.select("entity_id", "normalized", F.array_join("display_forms", ",").alias("forms"), F.array_join("mention_key_ids", ",").alias("keys"))


@query(f"""WITH {REG}, p AS (SELECT DISTINCT 'm' || (c_custkey % 30) AS m, 'e' || (c_nationkey * 2 + 1) AS t FROM customer), x AS (SELECT m, coalesce(root, t) AS t FROM p LEFT JOIN rt ON source = t)
SELECT DISTINCT 'proposal_unknown_key' AS code, m AS ref FROM x WHERE CAST(m[2:] AS INT) >= 25 UNION ALL SELECT DISTINCT 'proposal_inactive_entity', t FROM x WHERE t NOT IN (SELECT entity_id FROM ent WHERE status = 'active')""")
def k04_proposal_problems(spark, d):
    e, roots = _registry(spark)
    p = T.read(spark, d, "customer").select(tag("m", F.col("c_custkey") % 30).alias("mention_key_id"), tag("e", F.col("c_nationkey") * 2 + 1).alias("entity_id"))
    keys = T.read(spark, d, "nation").select(tag("m", "n_nationkey").alias("mention_key_id"))
    return resolution.proposal_problems(p, keys, e, roots)


@query(f"""WITH {GRAMS}, ent AS (SELECT DISTINCT name, 'b' || (length(name) % 9) AS e FROM names), eg AS (SELECT DISTINCT e, gram FROM ent JOIN flat USING (name)),
near AS (SELECT q.name AS q, e FROM flat q JOIN eg USING (gram) GROUP BY q.name, q.total, e HAVING count(*) / q.total::DOUBLE >= 0.35)
SELECT DISTINCT 'm' || q AS mention_key_id, e AS entity_id FROM (SELECT q, e FROM near UNION SELECT name, e FROM ent UNION SELECT name, 'proposed' FROM names WHERE length(name) % 4 = 0)""")
def k04_candidates(spark, d):
    n = T.read(spark, d, "part").select(text.entity_name(F.col("p_name"), True).alias("name")).distinct()
    names = n.select("name", tag("b", F.length("name") % 9).alias("entity_id"))
    asked = n.select(tag("m", "name").alias("mention_key_id"), F.col("name").alias("query"))
    given = n.where("length(name) % 4 = 0").select(tag("m", "name").alias("mention_key_id"), F.lit("proposed").alias("entity_id"))
    return resolution.generate(asked, names, given)


@query("""WITH n AS (SELECT 'm' || n_nationkey AS m, 'r' || (n_nationkey % 5) AS bound, 'r' || ((n_nationkey + 1) % 5) AS prop, 'r' || n_regionkey AS own FROM nation),
ev AS (SELECT m, bound, prop AS e, 0.5::DOUBLE AS s FROM n UNION ALL SELECT m, bound, own, 0.9 FROM n), f AS (SELECT m, bound, e, 1 - list_reduce(list_prepend(1.0::DOUBLE, list(s)), lambda a, x: a * (1 - x)) AS score FROM ev WHERE e <> bound GROUP BY ALL)
SELECT m AS mention_key_id, e AS entity_id, round(score, 9) AS score, CASE WHEN least(e, bound) = 'r0' AND greatest(e, bound) = 'r1' THEN 'blocked' WHEN score >= 0.8 THEN 'review_required' ELSE 'suggested' END AS disposition FROM f""")
def k04_hypotheses(spark, d):
    """Proposals and hints; the evidence of names, which SQL cannot score, has a query of its own."""
    k = F.col("n_nationkey")
    r = T.read(spark, d, "region").select(tag("r", "r_regionkey").alias("entity_id"), F.lit(None).cast("string").alias("entity_type"), F.col("r_name").alias("canonical_name"), F.lit("active").alias("status"), "r_regionkey")
    n = T.read(spark, d, "nation").join(r.select(F.col("r_regionkey").alias("n_regionkey"), "canonical_name"), "n_regionkey")
    keys = n.select(tag("m", k).alias("mention_key_id"), tag("zz", k).alias("normalized_text"), F.lit(None).cast("string").alias("entity_type_hint"), F.array("canonical_name").alias("canonical_hints"))
    given = n.select(tag("m", k).alias("mention_key_id"), tag("r", (k + 1) % 5).alias("entity_id"), tag("p", k).alias("evidence_id"), F.lit(0.5).alias("score"))
    bound = n.select(tag("m", k).alias("mention_key_id"), tag("r", k % 5).alias("entity_id"))
    registry = resolution.fold([{"decision_id": "d1", "action": "keep_distinct", "subject_id": "r0", "object_id": "r1"}], {})
    out = resolution.resolve(keys, bound, r.drop("r_regionkey"), spark.createDataFrame([], "entity_id string, normalized string"), given, registry, names_too=False)
    return out.withColumn("score", nine("score"))


# ---- K05 ----
@query("""SELECT DISTINCT text, entity_id FROM (SELECT lower(n_name) AS text, 'n' || n_nationkey AS entity_id, n_nationkey AS k FROM nation UNION SELECT 'alias ' || n_nationkey % 4, 'n' || n_nationkey, n_nationkey FROM nation UNION SELECT 'form ' || n_nationkey, 'n' || n_nationkey, n_nationkey FROM nation) WHERE k % 6 <> 0""")
def k05_registry_aliases(spark, d):
    k = F.col("n_nationkey")
    n = T.read(spark, d, "nation").select(tag("n", k).alias("entity_id"), F.col("n_name").alias("canonical_name"), F.when(k % 6 == 0, "redirected").otherwise("active").alias("status"), tag("alias ", k % 4).alias("normalized"), F.array(tag("FORM  ", k)).alias("display_forms"))
    return normalization.registry_aliases(n, n)


@query(f"""WITH {REG}, x AS (SELECT 'c' || o_custkey AS c, CASE WHEN o_orderkey % 2 = 0 THEN 'subject' ELSE 'object' END AS role, 'e' || (o_orderkey % 60 + 1) AS t FROM orders)
SELECT 'argument_decided_twice' AS code, c || '/' || role AS ref FROM x GROUP BY c, role HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'argument_inactive_entity', coalesce(root, t) FROM x LEFT JOIN rt ON source = t WHERE coalesce(root, t) NOT IN (SELECT entity_id FROM ent WHERE status = 'active')""")
def k05_decision_problems(spark, d):
    e, roots = _registry(spark)
    k = F.col("o_orderkey")
    x = T.read(spark, d, "orders").select(tag("c", "o_custkey").alias("candidate_id"), F.when(k % 2 == 0, "subject").otherwise("object").alias("role"), tag("e", k % 60 + 1).alias("entity_id"))
    return normalization.decision_problems(x, e, roots)


@query(f"""WITH {CANDIDATES} SELECT candidate_id AS assertion_id, lower(subject) AS subject, CASE WHEN r = 3 THEN 'e:1' ELSE lower(object) END AS object, CASE WHEN r = 3 THEN 'entity' ELSE 'literal' END AS object_kind, 'v' || r AS predicate, '2024' AS anchor_start,
 CASE WHEN r = 2 THEN candidate_id[1:8] || '-a' ELSE candidate_id[1:8] || '-a,' || candidate_id[1:8] || '-b' END AS evidence, round(origin, 9) AS origin,
 sha256(concat_ws('|', lower(subject), 'v' || r, CASE WHEN r = 3 THEN 'e:1' ELSE lower(object) END, 'positive', 'fact', 'other')) AS signature_id FROM cand""")
def k05_assertions(spark, d):
    c = T.candidates(T.chunks(spark, d)).withColumn("r", s("r"))
    fold = lambda x: F.regexp_replace(F.lower(x), "", "")
    side = lambda role: c.select("candidate_id", F.lit(role).alias("role"), F.when((F.col("r") == "3") & F.lit(role == "object"), "e:1").otherwise(fold(role)).alias("value"), F.when((F.col("r") == "3") & F.lit(role == "object"), "entity").otherwise("literal").alias("kind"), F.lit("x").alias("basis"))
    key = F.substring("candidate_id", 1, 8)
    e = c.select("candidate_id", F.explode(F.when(F.col("r") == "2", F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("a")))).alias("k")).select("candidate_id", F.concat(key, F.lit("-"), "k").alias("evidence_id"))
    x = c.select("candidate_id", tag("v", "r").alias("predicate"), F.lit("positive").alias("polarity"), F.col("exact_text").alias("statement"), F.lit("fact").alias("epistemic_type"), F.lit("other").alias("memory_class"), "source_origin_probability", F.struct(F.lit("2024").alias("start")).alias("temporal"))
    out = normalization.project(x, side("subject").unionByName(side("object")), e)
    return out.select("assertion_id", "subject", "object", "object_kind", "predicate", F.col("temporal.start").alias("anchor_start"), F.array_join("evidence_ids", ",").alias("evidence"), nine("source_origin_probability").alias("origin"), "signature_id")


# ---- K07 / K08 ----
@query(f"WITH {GROUPS} SELECT 'assertion_without_group' AS code, assertion_id AS ref FROM a WHERE predicate = 'click' OR i % 6 = 0 AND signature_id IN (SELECT signature_id FROM g WHERE predicate = 'click')")
def k07_group_problems(spark, d):
    a = T.assertions(spark, d)
    return temporal.group_problems(a, normalization.groups(a, members=False).where("predicate <> 'click'"))


SUPER = ASSERTIONS + """, su AS (SELECT 's' || i AS supersession_id, lag(assertion_id) OVER (PARTITION BY subject ORDER BY i) AS p, assertion_id AS s, CASE WHEN i % 3 = 0 THEN 'suggested' ELSE 'review_required' END AS disposition, i FROM a), sup AS (SELECT * FROM su WHERE p IS NOT NULL)"""


def _supersessions(spark, d):
    a = T.assertions(spark, d)
    i = F.col("assertion_id").cast("long")
    x = a.select(tag("s", i).alias("supersession_id"), F.lag("assertion_id").over(Window.partitionBy("subject").orderBy(i)).alias("predecessor_id"), F.col("assertion_id").alias("successor_id"), F.when(i % 3 == 0, "suggested").otherwise("review_required").alias("disposition"), F.when(i % 2 == 0, "unknown").otherwise("before").alias("chronology"), ((i % 10) / 10.0).alias("score"))
    return a, x.where("predecessor_id is not null")


@query(f"""WITH {SUPER}, m AS (SELECT assertion_id, signature_id AS g FROM a WHERE i % 11 <> 0), x AS (SELECT sup.*, p1.g AS pg, s1.g AS sg FROM sup LEFT JOIN m p1 ON p1.assertion_id = p LEFT JOIN m s1 ON s1.assertion_id = s WHERE disposition = 'review_required')
SELECT least(pg, sg) AS left_group_id, greatest(pg, sg) AS right_group_id, string_agg(supersession_id, ',' ORDER BY supersession_id) AS ids FROM x WHERE pg <> sg GROUP BY 1, 2 UNION ALL SELECT 'supersession_missing_group', supersession_id, '' FROM x WHERE pg IS NULL OR sg IS NULL""")
def k08_superseded_pairs(spark, d):
    a, x = _supersessions(spark, d)
    pairs, lost = conflicts.superseded_pairs(x, a.where("cast(assertion_id as long) % 11 <> 0").select("assertion_id", F.col("signature_id").alias("group_id")))
    return pairs.select("left_group_id", "right_group_id", F.array_join("supersession_ids", ",").alias("ids")).unionByName(lost.select(F.col("code").alias("left_group_id"), F.col("ref").alias("right_group_id"), F.lit("").alias("ids")))


# ---- K09 ----
@query(f"WITH {ASSERTIONS} SELECT assertion_id, signature_id AS group_id FROM a")
def k09_group_map(spark, d):
    g = normalization.groups(T.assertions(spark, d), strict=True)
    return synthesis.group_map(g.select(F.col("signature_id").alias("group_id"), "assertion_ids"))


@query(f"""WITH {SUPER}, gr AS (SELECT DISTINCT signature_id AS g FROM a WHERE predicate <> 'click'), me AS (SELECT assertion_id FROM a WHERE i % 11 <> 0), pr AS (SELECT a.*, lag(signature_id) OVER (PARTITION BY subject ORDER BY i) AS before FROM a)
SELECT 'occurrence_unknown_group' AS code, assertion_id AS ref FROM a WHERE signature_id NOT IN (SELECT g FROM gr)
UNION ALL SELECT 'relation_unknown_group', 'r' || assertion_id FROM pr WHERE signature_id NOT IN (SELECT g FROM gr) OR before NOT IN (SELECT g FROM gr)
UNION ALL SELECT 'conflict_unknown_group', 'k' || assertion_id FROM pr WHERE i % 2 = 0 AND (signature_id NOT IN (SELECT g FROM gr) OR before NOT IN (SELECT g FROM gr))
UNION ALL SELECT 'supersession_unknown_assertion', supersession_id FROM sup WHERE p NOT IN (SELECT assertion_id FROM me) OR s NOT IN (SELECT assertion_id FROM me)""")
def k09_references(spark, d):
    a, x = _supersessions(spark, d)
    i = F.col("assertion_id").cast("long")
    pr = a.withColumn("before", F.lag("signature_id").over(Window.partitionBy("subject").orderBy(i)))
    rel = pr.select(tag("r", "assertion_id").alias("relation_id"), F.col("before").alias("source_group_id"), F.col("signature_id").alias("target_group_id"))
    con = pr.where(i % 2 == 0).select(tag("k", "assertion_id").alias("conflict_id"), F.col("before").alias("left_group_id"), F.col("signature_id").alias("right_group_id"))
    groups = a.where("predicate <> 'click'").select(F.col("signature_id").alias("group_id")).distinct()
    return synthesis.reference_problems(groups, a.where(i % 11 != 0).select("assertion_id"), a.select("assertion_id", F.col("signature_id").alias("group_id")), rel, con, x)


@query(f"""WITH {GROUPS}, seen AS (SELECT signature_id, string_agg(assertion_id, ',' ORDER BY assertion_id) AS ids, string_agg('x' || assertion_id, ',' ORDER BY 'x' || assertion_id) AS occ FROM a GROUP BY ALL)
SELECT g.subject AS entity_id, g.signature_id AS group_id, 'subject' AS role, CASE WHEN CAST(representative AS BIGINT) % 4 = 1 THEN '(no statement of ' || representative || ')' ELSE 'said ' || representative END AS statement, CAST(representative AS BIGINT) % 4 = 1 AS missing, ids, occ FROM g JOIN rep USING (signature_id) JOIN seen USING (signature_id)""")
def k09_propositions(spark, d):
    a = T.assertions(spark, d).withColumns({"subject_kind": F.lit("entity"), "object_kind": F.lit("literal")})
    g = normalization.groups(a).withColumn("group_id", F.col("signature_id"))
    said = a.where("cast(assertion_id as long) % 4 <> 1").select(F.col("assertion_id").alias("candidate_id"), tag("said ", "assertion_id").alias("statement"))
    x = synthesis.propositions(synthesis.roles(a).withColumnRenamed("signature_id", "group_id"), g, said, a.select(F.col("signature_id").alias("group_id"), tag("x", "assertion_id").alias("occurrence_id")))
    return x.select("entity_id", "group_id", "role", "statement", "missing", F.array_join("assertion_ids", ",").alias("ids"), F.array_join("occurrence_ids", ",").alias("occ"))


@query(f"WITH {GROUPS} SELECT subject AS entity_id, count(*) AS n, string_agg(signature_id || ':' || representative, ',' ORDER BY signature_id) AS record FROM g JOIN rep USING (signature_id) GROUP BY subject")
def k09_views(spark, d):
    a = T.assertions(spark, d).withColumns({"subject_kind": F.lit("entity"), "object_kind": F.lit("literal")})
    g = normalization.groups(a).withColumn("group_id", F.col("signature_id"))
    none = spark.createDataFrame([], "candidate_id string, statement string"), spark.createDataFrame([], "group_id string, occurrence_id string")
    v = synthesis.views(synthesis.propositions(synthesis.roles(a).withColumnRenamed("signature_id", "group_id"), g, *none))
    return v.select("entity_id", F.size("propositions").cast("long").alias("n"), F.array_join(F.transform("propositions", lambda p: F.concat_ws(":", p["group_id"], p["representative"])), ",").alias("record"))


@query("""WITH x AS (SELECT n_nationkey AS k, n_name AS name, f FROM nation, LATERAL (SELECT unnest([lower(n_name), n_name, 'Form ' || n_nationkey, 'form ' || (n_nationkey % 3)]) AS f) WHERE n_nationkey % 5 <> 0)
SELECT 'n' || n_nationkey AS entity_id, coalesce((SELECT string_agg(f, ',' ORDER BY lower(f), f) FROM (SELECT DISTINCT f FROM x WHERE k = n_nationkey AND f <> n_name)), '') AS aliases FROM nation""")
def k09_aliases(spark, d):
    k = F.col("n_nationkey")
    n = T.read(spark, d, "nation").select(tag("n", k).alias("entity_id"), F.col("n_name").alias("canonical_name"), F.lower("n_name").alias("normalized"), F.array(F.col("n_name"), tag("Form ", k), tag("form ", k % 3)).alias("display_forms"), k.alias("k"))
    return synthesis.alias_list(n, n.where("k % 5 <> 0")).select("entity_id", F.array_join("aliases", ",").alias("aliases"))


# ---- K10 ----
LINKS = GROUPS + """, ln AS (SELECT 'l' || i AS source_ref, signature_id AS r, lag(signature_id) OVER (PARTITION BY predicate ORDER BY i) AS l, i, assertion_id FROM a), lk AS (SELECT * FROM ln WHERE l IS NOT NULL),
im AS (SELECT lk.source_ref, max(coalesce(g.impact, 0)) AS impact FROM lk JOIN g ON g.signature_id IN (l, r) GROUP BY ALL)"""


def _links(spark, d):
    a = T.assertions(spark, d).withColumns({"subject_kind": F.lit("entity"), "object_kind": F.lit("literal")})
    x = T.neighbours(spark, d).select(tag("l", "i").alias("source_ref"), "left_group_id", "right_group_id", "i")
    g = normalization.groups(a, members=False).withColumns({"group_id": F.col("signature_id"), "subject_kind": F.lit("entity"), "object_kind": F.lit("literal")})
    return a, x, g


@query(f"WITH {LINKS} SELECT source_ref, round(impact, 9) AS impact, CASE WHEN l = r THEN l ELSE least(l, r) || ',' || greatest(l, r) END AS ids FROM lk JOIN im USING (source_ref)")
def k10_pair_impact(spark, d):
    _, x, g = _links(spark, d)
    return review.pair_impact(x, g).select("source_ref", nine("impact").alias("impact"), F.array_join("group_ids", ",").alias("ids"))


@query(f"WITH {GROUPS} SELECT signature_id AS group_id, subject AS entity_id FROM g")
def k10_group_entities(spark, d):
    return review.group_entities(_links(spark, d)[2])


@query(f"""WITH {LINKS}, su AS (SELECT 's' || i AS ref, lag(signature_id) OVER (PARTITION BY subject ORDER BY i) AS l, signature_id AS r, CASE WHEN i % 3 = 0 THEN 'suggested' ELSE 'review_required' END AS disposition, i FROM a),
ca AS (SELECT subject AS e, max(impact) AS mi, count(*) AS n FROM g GROUP BY ALL), ei AS (SELECT e, least(1, 0.55::DOUBLE * mi + 0.45::DOUBLE * least(1, n / 8.0::DOUBLE)) AS impact FROM ca),
it AS (SELECT 'entity_resolution' AS kind, 'h' || i AS source_ref, (i % 11) / 11.0::DOUBLE AS score, impact, CASE WHEN i % 4 = 0 THEN 'blocked' ELSE 'suggested' END AS disposition, false AS unknown, NULL AS code FROM a JOIN ei ON e = subject
 UNION ALL SELECT 'relation', source_ref, (i % 10) / 10.0::DOUBLE, impact, CASE WHEN i % 3 = 0 THEN 'structural' ELSE 'suggested' END, false, NULL FROM lk JOIN im USING (source_ref) WHERE l <> r
 UNION ALL SELECT 'supersession', ref, (i % 10) / 10.0::DOUBLE, (SELECT max(impact) FROM g WHERE signature_id IN (l, r)), disposition, i % 2 = 0, NULL FROM su WHERE l IS NOT NULL
 UNION ALL SELECT 'conflict', 'k' || source_ref, 0.7::DOUBLE, impact, CASE WHEN i % 5 = 0 THEN 'temporally_disjoint' ELSE 'suggested' END, i % 2 = 1, NULL FROM lk JOIN im USING (source_ref) WHERE l <> r
 UNION ALL SELECT 'projection_diagnostic', 'gap:' || i, 0.5, impact, 'diagnostic', false, NULL FROM a JOIN ei ON e = subject WHERE i % 13 = 0
 UNION ALL SELECT 'projection_diagnostic', e || ':latest_observed_not_unique', 0.5, impact, 'diagnostic', false, 'latest_observed_not_unique' FROM ei)
SELECT kind, source_ref, round(score, 9) AS score, round(impact, 9) AS impact, disposition, unknown, code FROM it""")
def k10_items(spark, d):
    a, x, g = _links(spark, d)
    _, sup = _supersessions(spark, d)
    i = F.col("assertion_id").cast("long")
    h = a.select(tag("h", i).alias("hypothesis_id"), F.col("subject").alias("entity_id"), ((i % 11) / 11.0).alias("score"), F.when(i % 4 == 0, "blocked").otherwise("suggested").alias("disposition"))
    two = x.where("left_group_id <> right_group_id")
    rel = two.select(F.col("source_ref").alias("relation_id"), F.col("left_group_id").alias("source_group_id"), F.col("right_group_id").alias("target_group_id"), ((F.col("i") % 10) / 10.0).alias("score"), F.when(F.col("i") % 3 == 0, "structural").otherwise("suggested").alias("disposition"))
    con = two.select(tag("k", "source_ref").alias("conflict_id"), "left_group_id", "right_group_id", F.lit(0.7).alias("score"), F.when(F.col("i") % 5 == 0, "temporally_disjoint").otherwise("suggested").alias("disposition"), F.when(F.col("i") % 2 == 1, "unknown").otherwise("overlap").alias("effective_relation"))
    notes = a.where(i % 13 == 0).select(F.lit("gap").alias("code"), F.col("assertion_id").alias("ref"), F.col("subject").alias("entity_id"))
    cards = g.groupBy(F.col("subject").alias("entity_id")).agg(F.max("impact").alias("max_impact"), F.count(F.lit(1)).alias("n_props")).withColumn("diagnostics", F.array(F.lit("latest_observed_not_unique")))
    out = review.items(h, rel, sup, con, notes, cards, g, a.select("assertion_id", F.col("signature_id").alias("group_id")))
    return out.select("kind", "source_ref", nine("score").alias("score"), nine("impact").alias("impact"), "disposition", "unknown", "code")


# ---- K11 / K12 ----
@query("""SELECT 'r' || (o_custkey % 300) AS source_ref, max(sha256(concat_ws('|', 'adjudication', 'i' || o_orderkey))) AS adjudication_id FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1""")
def k11_accepted_refs(spark, d):
    k = F.col("o_orderkey")
    o = T.read(spark, d, "orders")
    it = o.select(tag("i", k).alias("review_item_id"), tag("r", F.col("o_custkey") % 300).alias("source_ref"))
    return staging.accepted_refs(o.select(tag("i", k).alias("review_item_id"), F.when(k % 3 == 0, "accepted").otherwise("rejected").alias("disposition")), it)


EMITTED = LINKS + """, su AS (SELECT 's' || i AS ref, lag(signature_id) OVER (PARTITION BY subject ORDER BY i) AS l, signature_id AS r, i FROM a),
em AS (SELECT source_ref, l, r, ['supports', 'contradicts', 'polarity_opposes', 'refines'][i % 4 + 1] AS t, i % 7 = 0 AS structural FROM lk
 UNION ALL SELECT ref, l, r, 'supersedes', false FROM su WHERE l IS NOT NULL AND i % 2 = 0 UNION ALL SELECT 'k' || source_ref, l, r, 'contradicts', false FROM lk WHERE i % 2 = 0 AND i % 5 > 1)"""


def _emitted(spark, d):
    a, x, _ = _links(spark, d)
    _, sup = _supersessions(spark, d)
    i = F.col("i")
    rel = x.select(F.col("source_ref").alias("relation_id"), F.col("left_group_id").alias("source_group_id"), F.col("right_group_id").alias("target_group_id"), F.element_at(F.array(*map(F.lit, ("supports", "contradicts", "polarity_opposes", "refines"))), (i % 4 + 1).cast("int")).alias("relation_type"), F.when(i % 7 == 0, "structural").otherwise("suggested").alias("disposition"))
    con = x.select(tag("k", "source_ref").alias("conflict_id"), "left_group_id", "right_group_id", F.when(i % 5 == 0, "temporally_disjoint").when(i % 5 == 1, "change_over_time_candidate").otherwise("suggested").alias("disposition"))
    # accepted are even ids of each kind, those of events that no link ends at as well
    ok = a.where(F.col("assertion_id").cast("long") % 2 == 0).select(F.explode(F.array(*(F.concat(F.lit(p), "assertion_id") for p in ("l", "s", "kl")))).alias("source_ref"))
    members = a.select("assertion_id", F.col("signature_id").alias("group_id"))
    return a, staging.emissions(rel, sup, con, members, ok), ok, members


@query(f"WITH {EMITTED} SELECT source_ref, l AS left_group_id, r AS right_group_id, t AS relation_type, structural FROM em")
def k11_emissions(spark, d):
    return _emitted(spark, d)[1].drop("accepted")


CODED = EMITTED + """, one AS (SELECT signature_id, min(assertion_id) AS c, count(*) AS k FROM a WHERE i % 3 <> 0 GROUP BY ALL),
co AS (SELECT em.*, x.c AS lc, y.c AS rc, CASE WHEN structural THEN 'structural_relation_not_promoted' WHEN CAST(regexp_extract(source_ref, '[0-9]+') AS BIGINT) % 2 <> 0 THEN 'relation_not_adjudicated_accepted' WHEN t = 'refines' THEN 'unsupported_relation' WHEN x.k IS DISTINCT FROM 1 OR y.k IS DISTINCT FROM 1 THEN 'ambiguous_group_to_record_relation' END AS code
 FROM em LEFT JOIN one x ON x.signature_id = l LEFT JOIN one y ON y.signature_id = r WHERE t <> 'polarity_opposes')"""


def _staged(spark, d):
    a, links, ok, members = _emitted(spark, d)
    i = F.col("assertion_id").cast("long")
    eligible = a.select(F.col("assertion_id").alias("candidate_id"), F.when(i % 3 != 0, "eligible").otherwise("blocked_validation").alias("eligibility"), F.lit("source_exact_timestamp").alias("temporal_basis"))
    backend = staging.Capability("parquet-staging", relation_types=("supports", "contradicts", "supersedes"))
    found, codes = staging.relations(links, members.select("group_id", F.col("assertion_id").alias("candidate_id")), eligible, ok, backend)
    return a, eligible, found, codes


@query(f"WITH {CODED} SELECT DISTINCT code, source_ref FROM co WHERE code IS NOT NULL")
def k11_relation_codes(spark, d):
    return _staged(spark, d)[3]


@query(f"""WITH {CODED}, tied AS (SELECT lc AS c, string_agg(DISTINCT rc || ':' || t || ':' || source_ref, ',' ORDER BY rc || ':' || t || ':' || source_ref) AS links FROM co WHERE code IS NULL AND lc <> rc GROUP BY lc)
SELECT assertion_id AS candidate_id, 'source_exact_timestamp' AS temporal_basis, coalesce(links, '') AS links FROM a LEFT JOIN tied ON c = assertion_id WHERE i % 3 <> 0""")
def k11_records(spark, d):
    a, eligible, found, _ = _staged(spark, d)
    x = staging.records(a.select(F.col("assertion_id").alias("candidate_id")), eligible, found)
    return x.select("candidate_id", "temporal_basis", F.array_join(F.array_sort(F.transform("relations", lambda r: F.concat_ws(":", r["target_candidate_id"], r["relation_type"], r["source_ref"]))), ",").alias("links"))


CFG = scheduling.Spec.config_hash


@query(f"""WITH h AS (SELECT 'c' || conv_id AS p, conv_id % 5 AS k, 'h' || conv_id AS i FROM (SELECT DISTINCT conv_id FROM conversations)),
f1 AS (SELECT *, sha256(concat_ws('|', 'K01', p, '0.1.0', 'K01.v0', '{CFG}', i, '')) AS f, CASE WHEN k = 1 THEN 'no_cache' WHEN k = 2 THEN 'previous_failure' WHEN k = 3 THEN 'fingerprint_changed' ELSE 'exact_cache_hit' END AS reason FROM h),
f2 AS (SELECT *, CASE WHEN reason = 'exact_cache_hit' THEN sha256(concat_ws('|', 'K02', p, '0.1.0', 'K02.v0', '{CFG}', i, 'K01:' || p)) END AS g FROM f1),
l AS (SELECT 'K01' AS stage, p AS partition, 0 AS wave, reason, f AS fingerprint FROM f1 UNION ALL SELECT 'K02', p, 1, CASE WHEN reason <> 'exact_cache_hit' THEN 'dependency_dirty' WHEN k = 4 THEN 'no_cache' ELSE reason END, g FROM f2
 UNION ALL SELECT 'K03', p, 2, CASE WHEN reason <> 'exact_cache_hit' OR k = 4 THEN 'dependency_dirty' ELSE 'no_cache' END, CASE WHEN k = 0 THEN sha256(concat_ws('|', 'K03', p, '0.1.0', 'K03.v0', '{CFG}', i, 'K02:' || p)) END FROM f2
 UNION ALL SELECT s, 'global', w, 'dependency_dirty', NULL FROM (VALUES ('K04', 3), ('K05', 4), ('K06', 5), ('K07', 5), ('K08', 6), ('K09', 7), ('K10', 8), ('K11', 9)) v(s, w))
SELECT stage, partition, wave, reason, CASE WHEN reason = 'exact_cache_hit' THEN 'reuse' ELSE 'run' END AS disposition, fingerprint FROM l""")
def k12_plan_table(spark, d):
    c = T.read(spark, d, "conversations").select("conv_id").distinct().select(tag("c", "conv_id").alias("partition"), tag("h", "conv_id").alias("input_hash"), (F.col("conv_id") % 5).alias("k"))
    print_ = lambda st, out: identity.key_id(F.lit(st), "partition", F.lit("0.1.0"), F.lit(f"{st}.v0"), F.lit(CFG), "input_hash", out)
    one = c.where("k <> 1").select(F.lit("K01").alias("stage"), "partition", F.when(F.col("k") == 3, "old").otherwise(print_("K01", F.lit(""))).alias("fingerprint"), tag("K01:", "partition").alias("output_hash"), F.when(F.col("k") == 2, "failed").otherwise("complete").alias("status"))
    two = c.where("k = 0").select(F.lit("K02").alias("stage"), "partition", print_("K02", tag("K01:", "partition")).alias("fingerprint"), tag("K02:", "partition").alias("output_hash"), F.lit("complete").alias("status"))
    return scheduling.plan_table(c.drop("k"), one.unionByName(two), "g" * 64)
