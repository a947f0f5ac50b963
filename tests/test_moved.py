"""Bytes that queries shuffle, on the smallest tables without broadcasts, as on large ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.functions import identity
from granary.operators import review, staging
from granary.plans import catalogue, records  # noqa: F401
from granary.sources import tables

DIR = "/root/testdata/sf0.001"


def moved(spark, name):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = stages()
        before = {seen.apply(k).stageId() for k in range(seen.size())}
        catalogue.QUERIES[name](spark, DIR).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        now = stages()
        return sum(now.apply(k).shuffleWriteBytes() for k in range(now.size()) if now.apply(k).stageId() not in before)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# of 1000 events
@pytest.mark.parametrize("name, most", [("k10_items", 550_000), ("k11_records", 550_000), ("k11_relation_codes", 550_000)])
def test_few_bytes_move(spark, name, most):
    assert moved(spark, name) < most


def test_neighbours_over_spans(spark):
    """Windows of few ids give the links of whole ones."""
    a = tables.assertions(spark, DIR).withColumn("i", F.col("assertion_id").cast("long"))
    whole = a.select("i", F.lag("signature_id").over(Window.partitionBy("predicate").orderBy("i")).alias("l"), F.col("signature_id").alias("r")).where("l is not null")
    want = sorted(whole.collect())
    for span in (1, 7, 1 << 14):
        assert sorted(tables.neighbours(spark, DIR, span).collect()) == want


def test_packed_ids(spark):
    ids = ["", "a", "0" * 64, "0123456789abcdef" * 4, "0123456789ABCDEF" * 4, "f" * 64 + "\n", "f" * 63, "é", None]
    x = spark.createDataFrame([(i,) for i in ids], "id string").select("id", identity.packed(F.col("id")).alias("k"))
    got = x.select("id", "k", identity.unpacked(F.col("k")).alias("back")).collect()
    assert [r["back"] for r in got] == ids and len({r["k"] and bytes(r["k"]) for r in got}) == len(ids)
    assert len(got[3]["k"]) == 33


def test_items_name_groups_and_entities(spark):
    frame = spark.createDataFrame
    groups = frame([("g1", 0.5, "x", "entity", "z", "entity"), ("g2", 0.75, "y", "entity", "o", "literal")], "group_id string, impact double, subject string, subject_kind string, object string, object_kind string")
    rel = frame([("r", "g2", "g1", 0.5, "suggested"), ("q", "g1", "lost", 0.5, "suggested")], "relation_id string, source_group_id string, target_group_id string, score double, disposition string")
    sup = frame([("s", "1", "2", 0.5, "suggested", "before"), ("t", "3", "1", 0.5, "suggested", "unknown"), ("u", "3", "4", 0.5, "suggested", "unknown")], "supersession_id string, predecessor_id string, successor_id string, score double, disposition string, chronology string")
    hyp, con = rel.limit(0).selectExpr("relation_id hypothesis_id", "'' entity_id", "score", "disposition"), rel.limit(0).selectExpr("relation_id conflict_id", "'' left_group_id", "'' right_group_id", "score", "disposition", "'' effective_relation")
    notes, cards = frame([], "code string, ref string, entity_id string"), frame([], "entity_id string, max_impact double, n_props long, diagnostics array<string>")
    got = {r["source_ref"]: (r["impact"], r["group_ids"], r["entity_ids"], r["unknown"]) for r in review.items(hyp, rel, sup, con, notes, cards, groups, frame([("1", "g2"), ("2", "g1"), ("4", "lost")], "assertion_id string, group_id string")).collect()}
    both = (0.75, ["g1", "g2"], ["x", "y", "z"], False)
    assert got == {"r": both, "s": both, "q": (0.5, ["g1", "lost"], ["x", "z"], False), "t": (0.75, ["g2"], ["y"], True), "u": (0.0, ["lost"], [], True)}


def test_relations_with_and_without_known_answers(spark):
    """A link that says whether it is accepted is not looked up; ids that are null or no digests lose nothing."""
    one, two = "a" * 64, "g2"
    rows = [("x", one, two, "supports", False), ("y", one, None, "supports", False), ("z", two, one, "supports", True), ("w", two, one, "refines", False), ("v", two, one, "supports", False), ("u", two, one, "polarity_opposes", False), ("t", one, "many", "supports", None)]
    links = spark.createDataFrame(rows, "source_ref string, left_group_id string, right_group_id string, relation_type string, structural boolean")
    members = spark.createDataFrame([(one, "1"), (two, "2"), (two, "3"), ("many", "4"), ("many", "5"), (None, "6")], "group_id string, candidate_id string")
    eligible = spark.createDataFrame([(str(k), "blocked" if k == 3 else "eligible") for k in range(1, 7)], "candidate_id string, eligibility string")
    accepted = spark.createDataFrame([(r,) for r in "xyztw"], "source_ref string")
    can = staging.Capability("b", relation_types=("supports",))
    known = F.when(F.col("source_ref") != "y", F.col("source_ref").isin(list("xztw")))
    for x in (links, links.withColumn("accepted", known), links.withColumn("accepted", F.lit(None).cast("boolean"))):
        out, codes = staging.relations(x, members, eligible, accepted, can)
        assert [tuple(r) for r in out.collect()] == [("1", "2", "supports", "x")]
        want = {"y": "ambiguous_group_to_record_relation", "t": "ambiguous_group_to_record_relation", "z": "structural_relation_not_promoted", "w": "unsupported_relation", "v": "relation_not_adjudicated_accepted"}
        assert {r["source_ref"]: r["code"] for r in codes.collect()} == want
