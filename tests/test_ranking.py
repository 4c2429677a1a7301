from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewarden.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """Group a holds far more rows than the others; values repeat; one group is NULL."""
    rnd = random.Random(7)
    rows = [("a", rnd.randint(0, 3000)) for _ in range(6000)] + [("b", rnd.randint(0, 50)) for _ in range(300)]
    rows += [("c", 5), (None, 1), (None, 4)]
    return spark.createDataFrame([(g, i, Decimal(v)) for i, (g, v) in enumerate(rows)], "g string, id long, v decimal(20,4)").repartition(6)


def by_group(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append(r)
    return groups


def test_running_total_by_group(skewed):
    out = ranking.running_total(skewed.withColumn("w", F.lit(2).cast("long")), ["v", "id"], {"before": "w"}, ["g"])
    for rows in by_group(out).values():
        rows.sort(key=lambda r: (r["v"], r["id"]))
        assert [r["before"] for r in rows] == [2 * i for i in range(len(rows))]
        assert {r["before_total"] for r in rows} == {2 * len(rows)}


def test_running_total_spreads_a_hot_group(spark, skewed):
    rows = skewed.repartitionByRange(8, "g", "v", "id").withColumn("_slice", F.spark_partition_id())
    assert rows.where("g = 'a'").select("_slice").distinct().count() > 3


def test_global_rank(skewed):
    out = ranking.global_rank(skewed, ["-v", "id"], "rk").orderBy("rk").collect()
    expected = sorted(((r["v"], r["id"]) for r in out), key=lambda t: (-t[0], t[1]))
    assert [r["rk"] for r in out] == list(range(1, len(out) + 1))
    assert [(r["v"], r["id"]) for r in out] == expected


QS = {"lo": 0.0, "q": 0.37, "m": 0.5, "t": 0.999, "hi": 1.0}


def check(df, skewed):
    want = {g: {n: float(np.quantile([float(r["v"]) for r in rows], p)) for n, p in QS.items()}
            for g, rows in by_group(skewed).items()}
    got = {r["g"]: r.asDict() for r in df.collect()}
    assert got.keys() == want.keys()
    for g in want:
        for n in QS:
            assert got[g][n] == pytest.approx(want[g][n], abs=1e-9), (g, n)
    return got


@pytest.mark.parametrize("max_distinct", [200_000, 100, 1])
def test_percentiles_by_group(skewed, max_distinct):
    got = check(ranking.percentiles_by_group(skewed, ["g"], "v", QS, size_as="n", max_distinct=max_distinct), skewed)
    assert got["a"]["n"] == 6000 and got[None]["n"] == 2


def test_percentiles(skewed):
    check(ranking.percentiles(skewed, ["g"], "v", QS), skewed)


def test_percentiles_with_many_groups(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "MAX_SKETCHES", 2)
    check(ranking.percentiles(skewed, ["g"], "v", QS), skewed)


def test_percentiles_when_the_bracket_misses(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "BRACKET", -0.01)  # an empty bracket for every percentile
    check(ranking.percentiles(skewed, ["g"], "v", QS), skewed)


@pytest.mark.parametrize("cuts", [("0.001", "0.01", "0.1", "0.5", "1")])
def test_top_share(skewed, cuts):
    cuts = [Decimal(c) for c in cuts]
    values = sorted((r["v"] for r in skewed.collect()), reverse=True)
    got = {r["corte"]: r["s"] for r in ranking.top_shares(skewed, {"s": "v", "i": "id"}, cuts).collect()}
    for c in cuts:
        share = 100 * sum(values[: int(len(values) * c)]) / sum(values)
        assert float(got[c]) == pytest.approx(float(share), abs=0.0051)


def test_top_share_counts_null_as_zero(spark):
    df = spark.createDataFrame([(Decimal(8),), (None,), (Decimal(2),), (None,)], "v decimal(10,2)")
    got = ranking.top_shares(df, {"s": "v"}, [Decimal("0.25"), Decimal("0.5")]).orderBy("corte").collect()
    assert [float(r["s"]) for r in got] == [80.0, 100.0]


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_running_total_with_ties(spark, parts):
    """Values that fill several slices, values that end with a slice, and single ones."""
    r = random.Random(4)
    values = [5] * 40 + [3] * 25 + [r.randint(0, 9) for _ in range(60)] + list(range(20, 60)) + [7]
    df = spark.createDataFrame([(f"c{i}", Decimal(v)) for i, v in enumerate(values)], "k string, v decimal(20,4)").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.running_total_with_ties(df, "k", "v", "rank", "held").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(set(values), reverse=True)
    assert len(got) == len(values)
    for x in got:
        assert x["rank"] == order.index(x["v"]) + 1 and x["held"] == sum(v for v in values if v >= x["v"]) and x["held_total"] == sum(values)
