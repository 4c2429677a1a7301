"""Every registered query against its SQL counterpart, and guards on the shape of the plans."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle_check
from tradewarden.operators import joins, ranking
from tradewarden.plans import casefile, cube, patterns
from tradewarden.plans.datasets import new_line_pipeline
from tradewarden.sources import storage

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# empty on the smallest tables: too few trades per instrument and day
DENSE = ("implied_fx", "fx_crosscheck", "p3_top_frequency", "reference_prices", "p4_off_market_price", "p4_detail", "p4_by_channel",
         "p4_export", "p4_detail_nested", "list_clients_by_rule", "risk_score", "client_profile_json")

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def con():
    return {d: oracle_check.duck(d) for d in (SMALL, MEDIUM)}


def test_every_query_has_a_counterpart():
    assert entry.library_queries().keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", [n for n in entry.library_queries() if n not in DENSE])
def test_small(spark, con, name):
    assert oracle_check.compare(spark, con[SMALL], SMALL, name) is None


@pytest.mark.parametrize("name", DENSE)
def test_medium(spark, con, name):
    assert oracle_check.compare(spark, con[MEDIUM], MEDIUM, name) is None


def test_scale_paths_give_the_same_tables(spark, monkeypatch):
    """Salted joins, sliced percentiles and unbracketed thresholds, forced on every group."""
    plain = new_line_pipeline(spark, MEDIUM)
    want = {name: getattr(plain, name) for name in ("limits", "references", "p4", "risk", "flagged")}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_SHARE", 50)
    monkeypatch.setattr(ranking, "MAX_DISTINCT", 4)
    monkeypatch.setattr(ranking, "MAX_SKETCHES", 0)
    forced = new_line_pipeline(spark, MEDIUM)
    for name, table in want.items():
        got = getattr(forced, name)
        assert got.count() == table.count() > 0
        assert got.exceptAll(table).isEmpty() and table.exceptAll(got).isEmpty(), name


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(entry.library_queries()))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", text)


# Windows over one partition may only see a bounded list: slices, days, a top-k.
ONE_PARTITION_WINDOWS = {
    "implied_only_fx", "concentration_curve", "nonbusiness_concentration", "clients_export", "pareto_export",
    "top_instruments_export", "top10_by_ops", "top10_by_amount", "cumulative_share"}


@pytest.mark.parametrize("name", [n for n in entry.library_queries() if n not in ONE_PARTITION_WINDOWS])
def test_no_window_over_one_partition(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for window in re.findall(r"Window \[.*", text):
        spec = re.search(r"windowspecdefinition\((.*)", window).group(1)
        assert not re.match(r"specifiedwindowframe|[^,]*(ASC|DESC) NULLS", spec), window[:200]


# Reports that count and add up, and nothing else: they read the cube.
CUBE_ONLY = (
    "by_weekday", "by_hour", "atypical_bands", "off_hours_by_channel", "by_day_type", "volume_by_currency_ars", "monthly_volume",
    "bands_by_channel", "weekday_time_span", "by_channel", "by_currency", "by_side", "channel_mix", "activity_buckets", "concentration_curve",
    "nonbusiness_concentration", "buckets_export", "trades_by_day", "trades_by_channel", "hour_weekday_heatmap", "bands_within_channel",
    "holidays_with_activity")


@pytest.mark.parametrize("name", CUBE_ONLY)
def test_counting_reports_read_one_part_of_the_cube(spark, name):
    df = entry.queries()[name](spark, SMALL)
    text, read = plan(df), {f.split("/tables-")[1].split("/")[1] for f in df.inputFiles()}
    assert "operaciones" not in read and (read or "ExistingRDD" in text), read
    if "cubo_actividad" in read:  # the others go through a checkpoint
        assert "PartitionFilters: [isnotnull(conjunto" in text


def test_the_cube_is_one_scan_of_the_trades(spark):
    p = new_line_pipeline(spark, SMALL)
    text = plan(cube.activity_cube(p.trades, p.rated_days))
    assert len(re.findall(r"FileScan parquet \[[^\]]*id_cliente", text)) == 1
    assert p.cells.agg(F.sum("ops")).collect() == p.client_cells.agg(F.sum("ops")).collect() == [(p.trades.count(),)]
    assert p.rated_cells.agg(F.sum("ops")).collect()[0][0] == p.enriched.count()
    assert p.cells.count() <= p.trades.select("dia_art", "hora_art", "origen", "tipo_tran", "moneda").distinct().count() + 24


def test_trades_meet_their_prices_without_an_exchange(spark, monkeypatch):
    """Beyond the broadcast bound the fact and the off-market trades read the bucketed trades; only the prices move."""
    plain = new_line_pipeline(spark, MEDIUM)
    want = {"facts": plain.facts, "p4": plain.p4}
    assert "Exchange hashpartitioning" not in plan(plain.facts)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_SHARE", 50)
    forced = new_line_pipeline(spark, MEDIUM)
    for df in (forced.facts, patterns.off_market_trades(forced.priced, forced.params)):
        text = plan(df)
        assert "ShuffledHashJoin" in text and "SelectedBucketsCount" in text and text.count("Exchange hashpartitioning") == 1
        assert text.index("SelectedBucketsCount") < text.index("Exchange hashpartitioning") and "Sort " not in text
    for name, table in want.items():
        got = getattr(forced, name)
        assert got.count() == table.count() and got.exceptAll(table).isEmpty() and table.exceptAll(got).isEmpty(), name
    forced.store.remove()
    assert not spark.sql("SHOW TABLES").where(F.col("tableName").contains(forced.store._id)).count()


def test_a_lookup_reads_one_bucket(spark, monkeypatch):
    p = new_line_pipeline(spark, MEDIUM)
    client = entry._top_client(p)
    built = casefile.client_profile_json(p.case_of(client))
    text = plan(casefile.same_day_round_trips(p.flagged_of(client)))
    assert "SelectedBucketsCount: 1 out of" in text
    p.cases
    found = casefile.client_profile_json(p.case_of(client))
    assert found.collect() == built.collect() and found.count() == 1
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a split per file
    try:
        assert p.case_of(client)._jdf.queryExecution().toRdd().getNumPartitions() == 1 < len(p.cases.inputFiles())
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # The trades of a client with very many are written by several tasks, into one bucket.
    monkeypatch.setattr(storage, "BUCKET_ROWS", 5)
    split = new_line_pipeline(spark, MEDIUM)
    assert split.flagged.exceptAll(p.flagged).isEmpty() and split.flagged.count() == p.flagged.count()
    hot = split.flagged_of(client)
    assert "SelectedBucketsCount" not in plan(casefile.same_day_round_trips(split.flagged))
    assert hot.select(F.input_file_name()).distinct().count() > 1


@pytest.mark.parametrize("name", ["overview", "by_channel", "top_clients", "top_instruments", "by_day_type", "kpi_cards", "dq_counts", "p1_instruments"])
def test_distinct_counts_expand_no_trades(spark, name):
    """Where several things are counted apart, rows are repeated after they were cut to cells, never trade by trade."""
    lines = plan(entry.queries()[name](spark, SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Expand [" in line:
            assert "HashAggregate" in lines[i + 1] or "HashAggregate" in lines[i + 2], lines[i:i + 4]


def test_median_prices_are_selected_inside_the_aggregate(spark):
    p = new_line_pipeline(spark, SMALL)
    text = plan(patterns.reference_prices(p.enriched, p.params))
    assert "Window" not in text and "collect_list" in text


def test_range_filter_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["daily_window"](spark, SMALL))
    assert "GreaterThanOrEqual(fecha_utc" in text and re.search(r"ReadSchema: struct<fecha_utc:timestamp_ntz,dia_art:date>", text)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
