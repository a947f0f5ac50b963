"""Behaviour that has no query of its own, and plain versions of what SQL cannot say."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from granary.functions import checks, identity, scores, text, times
from granary.operators import audit, conflicts, extraction, normalization, relations, resolution, scheduling, staging, synthesis, temporal
from granary.plans import catalogue, compiler
from granary.sources import tables
from granary.streaming import delta

DIR = "/root/testdata/sf0.001"


def one(spark, column, **values):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_canonical_json_and_ids():
    assert identity.canonical_json({"b": (1, None), "a": "é"}) == '{"a":"é","b":[1,null]}'
    assert identity.content_id("p", {"a": 1}) != identity.content_id("p", {"a": 1.0})
    with pytest.raises(ValueError):
        identity.canonical_json(float("nan"))


def test_table_hash_ignores_order(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    assert identity.table_hash(df).first() == identity.table_hash(df.orderBy(F.desc("id")).repartition(3)).first()
    assert identity.table_hash(df).first() != identity.table_hash(df.where("id > 0")).first()


def test_text(spark):
    lit = F.lit
    assert one(spark, text.mention_text(lit("  Straße \n X\x1fy "))) == "strasse x y"
    assert one(spark, text.semantic_text(lit("ﬁne  A"))) == "fine a"
    assert one(spark, text.entity_name(lit("O'Neil & Co.-X"))) == "oneil co x"
    assert one(spark, text.predicate_token(lit(" Does not  LIKE! "))) == "does_not_like"
    assert tuple(one(spark, text.polarity(lit("cannot_fly")))) == ("fly", "negative")
    assert tuple(one(spark, text.polarity(lit("not_")))) == ("not_", "positive")
    assert one(spark, text.trigrams(lit(""))) == []
    assert one(spark, text.jaccard(text.trigrams(lit("")), text.trigrams(lit("a")))) == 0.0
    assert one(spark, text.compatible_types(lit(None).cast("string"), lit("x"))) is True


def test_name_evidence_against_plain(spark):
    got = catalogue.k04_name_evidence(spark, DIR).collect()
    grams = lambda s: {f"  {s}  "[i : i + 3] for i in range(len(s) + 2)}
    for r in got:
        a, b = r["query"], r["entity"]
        want = 0.7 * difflib.SequenceMatcher(None, a, b).ratio() + 0.3 * len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        assert abs(min(1, want) - r["score"]) < 1e-8 and want >= 0.78


def test_fold_and_fusion(spark):
    ev = F.array(*(F.struct(F.lit(i).alias("evidence_id"), F.lit(s).alias("score")) for i, s in (("b", 0.5), ("a", 1.0), ("c", -0.25))))
    assert one(spark, scores.fuse(ev)) == pytest.approx(0.75)
    d = lambda i, a, s, o=None, n=None: {"decision_id": i, "action": a, "subject_id": s, "object_id": o, "canonical_name": n}
    r = resolution.fold([d("1", "merge_entity", "A", "B"), d("2", "merge_entity", "B", "C"), d("3", "set_canonical_name", "A", n=" N ")], {})
    assert r.root("A") == "C" and r.names == {"C": "N"}
    with pytest.raises(checks.ContractError):
        resolution.fold([d("1", "keep_distinct", "A", "B"), d("2", "merge_entity", "A", "C"), d("3", "merge_entity", "C", "B")], {})
    with pytest.raises(checks.ContractError):
        resolution.fold([d("1", "merge_entity", "A", "B")], {"A": "person", "B": "place"})
    with pytest.raises(resolution.FullRebuildRequired):
        resolution.fold([d("9", "retract_decision", "1")], {}, r)
    bound = spark.createDataFrame([("m1", "A", "provisional"), ("m2", "C", "provisional"), ("m3", "D", "provisional")], "mention_key_id string, entity_id string, basis string")
    got = {x[0]: tuple(x)[1:] for x in resolution.rebind(bound, r).collect()}
    assert got == {"m1": ("C", "merged_entity", "2"), "m2": ("C", "merged_entity", "2"), "m3": ("D", "provisional", None)}
    with pytest.raises(checks.ContractError):
        resolution.closure(spark.createDataFrame([("A", "B"), ("B", "A")], "source_entity_id string, target_entity_id string")).count()
    with pytest.raises(ValueError):
        resolution.Policy(review_from=2.0)


def test_hints_and_aliases(spark):
    pairs = spark.createDataFrame([("m", "e")], "mention_key_id string, entity_id string")
    hints = spark.createDataFrame([("m", "ann")], "mention_key_id string, hint string")
    names = spark.createDataFrame([("e", "person", "ann")], "entity_id string, entity_type string, name string")
    ev = resolution.hint_evidence(pairs, hints, names).withColumns({"key_type": F.lit(None).cast("string"), "entity_type": F.lit("person")})
    bound = spark.createDataFrame([("m", "x")], "mention_key_id string, bound_id string")
    apart = spark.createDataFrame([], "left_entity_id string, right_entity_id string")
    assert [tuple(r) for r in resolution.hypotheses(ev, bound, apart).collect()] == [("m", "e", pytest.approx(0.9), "review_required")]
    twice = resolution.hypotheses(ev.unionByName(ev), bound, apart).first()  # equal evidence counts twice
    assert twice["score"] == pytest.approx(0.99)
    rows = spark.createDataFrame([("a", "n", "N", "k")], "entity_id string, normalized string, display_form string, mention_key_id string")
    roots = spark.createDataFrame([("a", "r")], "source string, root string")
    assert resolution.alias_table(rows, rows, roots).first()[0] == "r"


def test_resolve_with_names(spark):
    keys = spark.createDataFrame([("m", "jon smith", "PERSON", ["John Smith"]), ("k", "zzz", None, [])], "mention_key_id string, normalized_text string, entity_type_hint string, canonical_hints array<string>")
    entities = spark.createDataFrame([("e", "person", "John Smith", "active"), ("f", "place", "Jon Smith", "active"), ("g", "person", "Jon Smith", "redirected")], "entity_id string, entity_type string, canonical_name string, status string")
    aliases = spark.createDataFrame([("e", "jon smith")], "entity_id string, normalized string")
    bound = spark.createDataFrame([("m", "x"), ("k", "y")], "mention_key_id string, entity_id string")
    none = spark.createDataFrame([], "mention_key_id string, entity_id string, evidence_id string, score double")
    got = [tuple(r) for r in resolution.resolve(keys, bound, entities, aliases, none, resolution.Registry()).collect()]
    assert got == [("m", "e", pytest.approx(1.0), "review_required")]  # the hint, and the alias word for word; f is of another type
    wrong = spark.createDataFrame([("m", "g", "p", 0.5)], none.schema)
    with pytest.raises(checks.ContractError):
        resolution.resolve(keys, bound, entities, aliases, wrong, resolution.Registry())


def test_registry_guards(spark):
    keys = spark.createDataFrame([("m", "t", "person")], "mention_key_id string, normalized_text string, entity_type_hint string")
    entities = spark.createDataFrame([("e", "place", "active")], "entity_id string, entity_type string, status string")
    link = spark.createDataFrame([("m", "e")], "mention_key_id string, entity_id string")
    roots = spark.createDataFrame([], "source string, root string")
    none, no_alias = link.where("false"), spark.createDataFrame([], "alias string, entity_id string, entity_type string")
    with pytest.raises(checks.ContractError):
        resolution.bindings(keys, none, link, no_alias, roots=roots, entities=entities)
    a = spark.createDataFrame([("a", "s")], "assertion_id string, signature_id string")
    with pytest.raises(checks.ContractError):
        temporal.grouped(a, a.where("false"))
    with pytest.raises(checks.ContractError):
        synthesis.group_map(spark.createDataFrame([("g", ["a"]), ("h", ["a"])], "group_id string, assertion_ids array<string>"))
    with pytest.raises(checks.ContractError):
        staging.accepted_refs(spark.createDataFrame([("x", "accepted")], "review_item_id string, disposition string"), spark.createDataFrame([], "review_item_id string, source_ref string"))


def test_clocks_against_plain(spark):
    pool = ["2024-01-01", "2024-01-01T00:00:00", "2024-01-02T05:00:00", "2024-01-02T05:00:00Z", "2024-01-02T07:00:00+02:00", "x", "2024-02-30"]
    from datetime import datetime, timezone

    def plain(values):
        out = []
        for v in values:
            try:
                p = datetime.fromisoformat(v.replace("Z", "+00:00"))
            except ValueError:
                return None
            out.append((p.tzinfo is not None, (p if p.tzinfo else p.replace(tzinfo=timezone.utc)).timestamp()))
        return out

    def want(a, b):
        a, b = plain(a), plain(b)
        if not a or not b or len({x[0] for x in a + b}) > 1:
            return "unknown"
        a, b = [x[1] for x in a], [x[1] for x in b]
        return "before" if max(a) < min(b) else "after" if min(a) > max(b) else "same" if set(a) == set(b) else "unknown"

    r = random.Random(1)
    pairs = [(r.choices(pool, k=r.randint(0, 3)), r.choices(pool, k=r.randint(0, 3))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for row in df.select("a", "b", times.chronology(times.clock(F.col("a")), times.clock(F.col("b"))).alias("c")).collect():
        assert row["c"] == want(row["a"], row["b"]), row


def test_intervals_and_overlap_against_plain(spark):
    rows = [("2024", None, "year", False), ("2024-02", None, "month", False), ("2024-02-30", None, "day", False), ("2024-02-01", "2024-03", "range", False), ("2024-05-01T23:30:00-05:00", None, "exact", False), ("2024-01-02", "2024-01-01", "range", False), ("2024-01-02", None, "day", True), (None, None, "unknown", False)]
    df = conflicts.intervals(spark.createDataFrame(rows, "start string, end string, precision string, is_proxy boolean"))
    got = [tuple(map(str, r)) for r in df.select(F.date_from_unix_date("lo"), F.date_from_unix_date("hi")).collect()]
    assert got == [("2024-01-01", "2024-12-31"), ("2024-02-01", "2024-02-29"), ("None", "None"), ("2024-02-01", "2024-03-31"), ("2024-05-01", "2024-05-01"), ("None", "None"), ("None", "None"), ("None", "None")]
    r = random.Random(2)
    anchors = {f"g{i}": [(lo, lo + r.randint(0, 4)) if (lo := r.randint(0, 40)) % 7 else (None, None) for _ in range(r.randint(0, 4))] for i in range(30)}
    pairs = [(f"g{i}", f"g{j}") for i in range(30) for j in range(i + 1, 30)]
    a = spark.createDataFrame([(g, *x) for g, v in anchors.items() for x in v], "group_id string, lo int, hi int")
    p = spark.createDataFrame(pairs, "left_group_id string, right_group_id string")
    for row in conflicts.compare(p, a).collect():
        l, s = anchors[row[0]], anchors[row[1]]
        hit = any(x[0] is not None and y[0] is not None and x[0] <= y[1] and y[0] <= x[1] for x in l for y in s)
        open_ = not l or not s or any(x[0] is None for x in l + s)
        assert row["relation"] == ("overlap" if hit else "unknown" if open_ else "disjoint")


def test_latest_against_plain(spark):
    r = random.Random(3)
    rows = [(f"e{r.randint(0, 4)}", str(i), k := r.choice(["aware", "naive", "none"]), None if k == "none" else (lo := r.randint(0, 9)), None if k == "none" else lo + r.randint(0, 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "entity_id string, assertion_id string, kind string, lo long, hi long")
    got = {x["assertion_id"] for x in synthesis.latest(df).collect()}
    want = {a[1] for a in rows if not any(b[0] == a[0] and b[2] == a[2] != "none" and a[4] < b[3] for b in rows)}
    assert got == want


def test_relations_errors(spark):
    bad = spark.createDataFrame([("g", "g", "supports", "p", "e", 0.5)], "source_group_id string, target_group_id string, relation_type string, proposer string, evidence_id string, score double")
    with pytest.raises(checks.ContractError):
        relations.compile(bad)
    a = bad.withColumn("target_group_id", F.lit("a")).withColumn("relation_type", F.lit("contradicts"))
    both = a.unionByName(a.select(F.col("target_group_id").alias("source_group_id"), F.col("source_group_id").alias("target_group_id"), "relation_type", "proposer", "evidence_id", "score"))
    assert [tuple(r)[1:5] for r in relations.compile(both).collect()] == [("a", "g", "contradicts", 0.5)]
    with pytest.raises(checks.ContractError):
        relations.compile(both, groups=spark.createDataFrame([("a",)], "signature_id string"))


def test_constraint_columns(spark):
    ok = checks
    assert one(spark, ok.offsets(F.lit(3), F.lit(2))) is False and one(spark, ok.score(F.lit(1.5))) is False and one(spark, ok.digest(F.lit("x"))) is False
    anchor = F.struct(F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"), F.lit(True).alias("is_proxy"), F.lit("").alias("proxy_reason"))
    assert one(spark, ok.anchor(anchor)) is False


def test_scheduler():
    assert scheduling.scale_probe(597) == {"tasks": 1799, "map_tasks": 1791, "global_tasks": 8, "waves": 10, "run_after_change": 11, "reused_after_change": 1788}
    S = scheduling.Spec
    for bad in ([S("a", "x", dependencies=(("b", "x"),))], [S("a", "x"), S("a", "x")], [S("a", "x", dependencies=(("a", "x"),))], [S("a", "x", dependencies=(("b", "x"),)), S("b", "x", dependencies=(("a", "x"),))]):
        with pytest.raises(scheduling.GraphError):
            scheduling.plan(bad, {})
    a, b = S("a", "x", input_hash="1"), S("b", "x", dependencies=(("a", "x"),))
    cache = {a.key: scheduling.complete(a, {}, "o"), b.key: scheduling.complete(b, {a.key: "o"}, "p")}
    assert {p["reason"] for p in scheduling.plan([a, b], cache)} == {"exact_cache_hit"}
    changed = S("a", "x", input_hash="2")
    assert [p["reason"] for p in scheduling.plan([changed, b], cache)] == ["fingerprint_changed", "dependency_dirty"]
    cache[a.key] = scheduling.complete(changed, {}, "o")  # the same output: what follows is reused
    assert [p["reason"] for p in scheduling.plan([changed, b], cache)] == ["exact_cache_hit", "exact_cache_hit"]
    cache[a.key] = scheduling.failed(changed, {})
    assert scheduling.plan([changed, b], cache)[0]["reason"] == "previous_failure"


def test_staging(spark, tmp_path):
    with pytest.raises(checks.ContractError):
        staging.Capability("x", exposes_promotion=True).gate()
    backend = staging.ParquetStaging(str(tmp_path))
    art = staging.stage(backend, spark.range(3), spark.range(0), "b1", "2024-01-01")
    assert art["status"] == "pending_review" and spark.read.parquet(f"{tmp_path}/b1/records").count() == 3


def test_audit_edges(spark):
    none = audit.metrics(audit.count(spark.range(0), candidates_total=F.lit(True), candidates_quarantined=F.lit(True)))
    assert {r["metric"]: r["value"] for r in none.collect()}["quarantine_rate"] == 0.0
    m = spark.createDataFrame([("quarantine_rate", 0.2)], "metric string, value double")
    assert audit.status(audit.findings(m, {"quarantine_rate": 0.2})) == "pass" and audit.status(audit.findings(m, {"quarantine_rate": 0.1})) == "fail"
    assert audit.status(audit.findings(m, {"quarantine_rate": None})) == "pass"


def test_extraction_guards(spark):
    with pytest.raises(checks.ContractError):
        extraction.compile(tables.chunks(spark, DIR).where("false"), extraction.SentenceRules())
    assert extraction.build(tables.chunks(spark, DIR), extraction.SentenceRules())["build_id"].startswith("cbuildv0_")


def test_compiler_and_delta(spark, tmp_path):
    chunks = tables.chunks(spark, DIR)
    out = compiler.run(spark, chunks, str(tmp_path))
    assert out["assertions"].count() == out["dispositions"].where("accepted").count()
    assert out["groups"].agg(F.sum("n")).first()[0] == out["assertions"].count()
    assert out["cards"].count() == out["bindings"].select("entity_id").distinct().count() == out["entities"].count()
    assert set(out) == set(compiler.STAGES) and out["metrics"].count() == 25 and out["builds"].where("output_hash is null").count() <= 4  # empty tables have none
    assert out["records"].count() == out["eligibility"].where("eligibility = 'eligible'").count() > 0
    cached = delta.conversation_hashes(chunks).withColumn("status", F.lit("complete"))
    assert delta.changed(chunks, cached).count() == 0
    more = chunks.withColumn("text", F.when(F.col("conversation_id") == "c0", "new").otherwise(F.col("text")))
    assert delta.changed(more, cached).count() == 11
    chunks.write.parquet(f"{tmp_path}/stream")
    seen = []
    q = delta.start(spark.readStream.schema(chunks.schema).parquet(f"{tmp_path}/stream"), lambda df, n: seen.append(df.count()), f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert sum(seen) == chunks.count()


def test_compiler_takes_proposals_and_decisions(spark, tmp_path):
    """A second run over the first one's registry, with proposals of every kind and answers to them."""
    chunks = tables.chunks(spark, DIR).limit(40).cache()
    first = compiler.run(spark, chunks, f"{tmp_path}/a")
    prior = {k: first[k] for k in ("bindings", "entities", "aliases")}
    prior["bindings"] = prior["bindings"].select("mention_key_id", "entity_id")
    ids = sorted(r[0] for r in first["entities"].select("entity_id").collect())
    key = first["bindings"].where(F.col("entity_id") == ids[2]).first()["mention_key_id"]
    log = [{"decision_id": "d1", "action": "merge_entity", "subject_id": ids[0], "object_id": ids[1]}, {"decision_id": "d2", "action": "set_canonical_name", "subject_id": ids[1], "canonical_name": "One"}]
    inputs = {"proposals": spark.createDataFrame([(key, ids[3], "p", 0.9)], compiler.EMPTY["proposals"])}
    groups = [r[0] for r in first["groups"].select("group_id").collect()][:2]
    inputs["relation_proposals"] = spark.createDataFrame([(groups[0], groups[1], "supports", "x", "e", 0.95)], compiler.EMPTY["relation_proposals"])
    out = compiler.run(spark, chunks, f"{tmp_path}/b", prior=prior, decisions=log, inputs={"proposals": inputs["proposals"]})
    assert {r["basis"] for r in out["bindings"].select("basis").distinct().collect()} == {"existing", "merged_entity"}
    e = {r["entity_id"]: (r["status"], r["canonical_name"]) for r in out["entities"].collect()}
    assert e[ids[0]][0] == "redirected" and e[ids[1]] == ("active", "One") and len(e) == len(ids)
    assert out["hypotheses"].where(F.col("mention_key_id") == key).where(F.col("entity_id") == ids[3]).count() == 1
    item = out["queue"].where("kind = 'entity_resolution'").first()
    answers = spark.createDataFrame([(item["review_item_id"], "r1", 3, "accept")], compiler.EMPTY["responses"])
    again = compiler.run(spark, chunks, f"{tmp_path}/c", inputs={"relation_proposals": inputs["relation_proposals"]})
    assert again["relations"].where("relation_type = 'supports'").first()["disposition"] == "review_required" and again["queue"].where("kind = 'relation'").count() == 1
    done = compiler.run(spark, chunks, f"{tmp_path}/d", prior=prior, decisions=log, inputs={"proposals": inputs["proposals"], "responses": answers})
    assert done["adjudications"].where("disposition = 'accepted'").count() == 1


def test_ontology(spark):
    x = spark.createDataFrame([("likes",), ("does not like",)], "raw string")
    dim = spark.createDataFrame([("likes", "like")], "alias string, canonical string")
    assert sorted((r["predicate"], r["polarity"]) for r in normalization.predicates(x, dim).collect()) == [("like", "negative"), ("like", "positive")]


def test_unknown_supersession(spark):
    occ = spark.createDataFrame([("a",)], "assertion_id string")
    p = spark.createDataFrame([("a", "z", "p", "e", 0.5)], "predecessor_id string, successor_id string, proposer string, evidence_id string, score double")
    with pytest.raises(checks.ContractError):
        temporal.supersessions(p, occ)
