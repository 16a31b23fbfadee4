"""Each registered query with SQL must agree with DuckDB, whatever the number of shuffle partitions."""

import duckdb
import pytest

import __spark_entry__ as entry
from taxoloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def norm(cols, rows):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    show = lambda x: "~" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x)
    return sorted(tuple(show(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = norm(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == norm(cols, cur.fetchall())


@pytest.mark.parametrize("name", ["rerank_prefix", "rrf_three_channel", "minmax_rank", "multi_signal_rank"])
def test_halves_round_as_in_sql(spark, tmp_path, name):
    """Prices, discounts and scores of which the decimal ends in a half that the double doesn't reach."""
    rows = [(4, 516702.5), (0, 516702.0), (8, 516703.0), (12, 500950.5), (16, 1.005), (20, 126532.5), (24, 126532.0)]
    lines = [("A", p, 1.0, x, 0.05) for p, x in rows] + [("A", 5, 1.005, 600000.0, 0.5167025), ("A", 9, 2.0, 600000.0, 0.5167025), ("R", 4, 1.0, 516702.5, 0.05)]
    spark.createDataFrame(lines, "l_returnflag string, l_partkey long, l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, str(tmp_path))
    assert norm(df.columns, df.collect()) == norm(cols, cur.fetchall())


@pytest.mark.parametrize("name", ["rrf_fuse", "route_tiers", "dict_missing_chunks", "seeded_sample", "concept_tags"])
def test_partitions_do_not_matter(spark, name):
    a = catalogue.QUERIES[name](spark, SF)
    one = norm(a.columns, a.collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        b = catalogue.QUERIES[name](spark, SF)
        assert norm(b.columns, b.collect()) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
