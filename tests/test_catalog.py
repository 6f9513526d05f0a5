"""Named tables: replaced as a whole, clustered, families of yearly tables."""

import os

import pytest
from pyspark.sql import functions as F

from ontime.operators.joins import bounded_broadcast, payload_bytes
from ontime.sources import catalog


def test_a_table_is_replaced_as_a_whole(spark, scratch):
    catalog.replace_table(spark.range(3), "named_a", scratch)
    assert spark.table("named_a").count() == 3
    reader = spark.table("named_a")                             # planned before the change
    catalog.replace_table(spark.range(5).withColumn("x", F.lit(1)), "named_a", scratch)
    assert spark.sql("SELECT sum(x) AS n FROM named_a").first().n == 5
    assert reader.count() == 3
    catalog.replace_table(spark.range(1), "named_a", scratch)
    assert len(os.listdir(f"{scratch}/named_a")) == 2           # the table and one earlier version


def test_a_write_that_breaks_half_way_leaves_the_old_table(spark, scratch):
    catalog.replace_table(spark.range(3), "named_b", scratch)
    broken = spark.range(0, 100, numPartitions=4).select(
        F.when(F.col("id") == 60, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        catalog.replace_table(broken, "named_b", scratch)
    assert sorted(r.id for r in spark.table("named_b").collect()) == [0, 1, 2]
    assert len(os.listdir(f"{scratch}/named_b")) == 1


def test_a_table_may_be_made_from_itself(spark, scratch):
    catalog.replace_table(spark.range(3), "named_c", scratch)
    catalog.replace_table(spark.table("named_c").unionByName(spark.range(1)), "named_c", scratch, keep=0)
    assert spark.table("named_c").count() == 4 and len(os.listdir(f"{scratch}/named_c")) == 1


@pytest.mark.parametrize("name", ["a b", "x; DROP TABLE y", "", "`a`"])
def test_names_are_checked(spark, scratch, name):
    with pytest.raises(ValueError, match="not a table name"):
        catalog.replace_table(spark.range(1), name, scratch)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_tables_join_without_a_shuffle(spark, scratch, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).selectExpr("id % 50 AS k", "id % 7 AS d", "id AS x")
        right = spark.range(350).selectExpr("id % 50 AS k", "id % 7 AS d", "id * 2 AS y")
        a = catalog.save_clustered(left, "clustered_a", f"{scratch}/a", ["k", "d"], 8)
        b = catalog.save_clustered(right, "clustered_b", f"{scratch}/b", ["k", "d"], 8)
        joined = a.join(b, ["k", "d"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert "Exchange" in plan(left.join(right, ["k", "d"]))
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, ["k", "d"]).collect()))
        assert "Exchange" not in plan(a.groupBy("k", "d").count())
        assert len([f for f in os.listdir(f"{scratch}/a") if f.endswith(".parquet")]) == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS clustered_a")
        spark.sql("DROP TABLE IF EXISTS clustered_b")


def test_family_of_yearly_tables(spark, scratch):
    for y in (2019, 2020, 2022):
        rows = spark.range(3).selectExpr(f"'{y}' AS year", "id AS v", *(["'x' AS late"] if y == 2022 else []))
        catalog.replace_table(rows, f"fam{y}", scratch)
    catalog.replace_table(spark.range(1), "family_other", scratch)
    family = catalog.table_family(spark, "fam", 2018, 2022)
    assert sorted(family.tables) == [2019, 2020, 2022] and family.missing == [2018, 2021]
    rows = family.read(spark)
    assert rows.columns == ["year", "v", "late"] and rows.count() == 9 and rows.where("late IS NULL").count() == 6
    assert plan(rows.where("v = 1")).count("PushedFilters: [IsNotNull(v), EqualTo(v,1)]") == 3
    with pytest.raises(ValueError, match="no table"):
        catalog.table_family(spark, "fam", 1990, 1991).read(spark)


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000, 1, [1, 2])] * 10, "s string, n int, a array<int>")
    assert 10_000 < payload_bytes(wide) < 11_500 and payload_bytes(wide.limit(0)) == 0
    assert "ResolvedHint" in bounded_broadcast(wide, 20_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in bounded_broadcast(wide, 5_000)._jdf.queryExecution().analyzed().toString()


def test_clustered_tables_are_not_broadcast(spark, scratch):
    rows = spark.range(1000).selectExpr("id % 50 AS k", "id AS x")
    a = catalog.save_clustered(rows, "clustered_c", f"{scratch}/c", ["k"], 4)
    b = catalog.save_clustered(rows.withColumnRenamed("x", "y"), "clustered_d", f"{scratch}/d", ["k"], 4)
    try:
        assert "BroadcastHashJoin" in plan(a.join(b, ["k"]))       # by the size of their files
        joined = catalog.join_clustered(a, b, ["k"])
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert joined.count() == 50 * 20 * 20
    finally:
        spark.sql("DROP TABLE IF EXISTS clustered_c")
        spark.sql("DROP TABLE IF EXISTS clustered_d")
