from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewarden.operators.joins import join_same, keyed_join
from tradewarden.operators.spine import date_spine, last_known


@pytest.fixture(scope="module")
def sides(spark):
    """One key owns a third of the rows; some keys have no partner."""
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"))
    keyed = big.where("k < 35").groupBy("k").agg(F.count("*").alias("n")).withColumn("label", F.concat(F.lit("L"), "k"))
    return big, keyed


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("broadcast_rows,hot_share", [(1000, 1000), (0, 1000), (0, 10), (0, 3)])
def test_keyed_join_equals_plain_join(sides, how, broadcast_rows, hot_share):
    big, keyed = sides
    got = keyed_join(big, keyed, ["k"], "n", "id", how, broadcast_rows, hot_share)
    want = big.join(keyed, ["k"], how).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_salted_join_splits_the_hot_key(sides):
    big, keyed = sides
    plan = keyed_join(big, keyed, ["k"], "n", "id", "inner", 0, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_spread" in plan


def test_join_same_matches_nulls(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "g string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "g string, y int")
    assert sorted((r["x"], r["y"]) for r in join_same(left, right, ["g"]).collect()) == [(1, 10), (2, 20)]


def test_a_stray_date_makes_a_long_calendar(spark):
    bounds = spark.sql("SELECT DATE'0202-01-01' a, DATE'2026-01-01' b")
    assert date_spine(bounds, F.col("a"), F.col("b")).count() == bounds.selectExpr("datediff(b, a) + 1").first()[0]


def test_last_known(spark):
    days = date_spine(spark.sql("SELECT DATE'2026-01-01' a, DATE'2026-01-05' b"), F.col("a"), F.col("b"))
    quotes = spark.sql("SELECT * FROM VALUES (DATE'2025-12-20', 1.0), (DATE'2026-01-02', 2.0), (DATE'2026-01-04', NULL) q(fecha, v)")
    got = [(r["q"]["fecha"].isoformat(), r["q"]["v"] and float(r["q"]["v"]))
           for r in last_known(days, quotes, "fecha", "q").orderBy("fecha").collect()]
    assert got == [("2025-12-20", 1.0), ("2026-01-02", 2.0), ("2026-01-02", 2.0), ("2026-01-04", None), ("2026-01-04", None)]


def test_last_known_without_quotes(spark):
    days = date_spine(spark.sql("SELECT DATE'2026-01-01' a"), F.col("a"), F.col("a"))
    none = spark.createDataFrame([], "fecha date, v double")
    assert last_known(days, none, "fecha", "q").collect()[0]["q"] is None
