"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from granary.plans import catalogue, records  # noqa: F401

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def rows(found, columns):
    key = lambda x: "\0" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(key, r)) for r in found), columns


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    want = duck.sql(catalogue.SQL[name])
    columns = sorted(df.columns)
    assert rows(df.select(*columns).collect(), columns) == rows(want.select(*sorted(want.columns)).fetchall(), sorted(want.columns))


@pytest.mark.parametrize("name", ["k02_disposition", "k06_relation_fold", "k08_effective_compare", "k09_cards"])
def test_partitioning_does_not_matter(spark, name):
    a = catalogue.QUERIES[name](spark, DIR)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = catalogue.QUERIES[name](spark, DIR).repartition(7)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
