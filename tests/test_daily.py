"""The daily run against a full one, and what it leaves alone."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import micro
from tradewarden.params import Params
from tradewarden.plans import daily
from tradewarden.plans.pipeline import Pipeline

DAYS = "fecha date, nombre string, tipo string, fuente string"
RATES = "fecha date, compra decimal(12,4), venta decimal(12,4), fuente string"


def day_trades(day, n, **more):
    return [{"fecha": f"2026-01-{day:02d}T15:{i:02d}:00.000Z", "id_cliente": f"C{i % 3}", "id_transaccion": f"{day}-{i}-{more}", "precio": str(100 + i),
             "moneda": "USD" if i % 4 == 0 else "ARS", "origen": "API" if i % 2 else "Web", **more} for i in range(n)]


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def run(spark, tmp_path):
    """Updates the folder, compares all tables with a full run, and returns the actions as table -> {partition: action}."""
    steps = daily.DailyRun(spark, str(tmp_path / "daily"), Params())

    def update(trades, quotes, holidays=()):
        df = micro.trades(spark, *trades)
        q = spark.createDataFrame([(date(2026, m, d), Decimal(1), Decimal(v), "x") for (m, d), v in quotes.items()], RATES)
        h = spark.createDataFrame([(d, "off", "", "") for d in holidays], DAYS)
        done = {}
        for r in steps.update(df, h, q).collect():
            done.setdefault(r["tabla"], {})[r["particion"]] = r["accion"]
        full = Pipeline(spark, lambda: df, lambda: h, lambda: q, params=Params(), refuse_keys=False)
        assert same(steps.trades.read(), full.trades)
        assert same(steps.rates.read().drop("anio_mes"), full.fx)
        assert same(steps.cells.read(), full.cells)
        return done
    update.steps = steps
    return update


def written(path: Path) -> dict[str, int]:
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_only_what_changed_is_rewritten(run, tmp_path):
    days = {d: day_trades(d, 12) for d in (5, 6, 7, 8)}
    quotes = {(1, 5): 1000, (1, 7): 1010}
    first = run([t for d in days.values() for t in d], quotes)
    assert set(first["operaciones"]) == {f"2026-01-0{d}" for d in days} and set(first["operaciones"].values()) == {daily.NEW}
    assert run([t for d in reversed(days.values()) for t in reversed(d)], quotes) == {}  # the same rows in another order

    before = written(tmp_path / "daily" / "operaciones")
    days[9] = day_trades(9, 7)
    done = run([t for d in days.values() for t in d], quotes)
    assert done["operaciones"] == {"2026-01-09": daily.NEW} == done["cubo_celdas"]
    after = written(tmp_path / "daily" / "operaciones")
    assert before.items() < after.items() and all("2026-01-09" in f for f in after.keys() - before.keys())

    # A late quote: the rates from its day on change, and with them the cells of those days; no trade is touched.
    quotes[(1, 8)] = 1200
    done = run([t for d in days.values() for t in d], quotes)
    assert done == {"tipo_cambio_diario": {"2026-01": daily.CHANGED}, "cubo_celdas": {"2026-01-08": daily.CHANGED, "2026-01-09": daily.CHANGED}}

    # A corrected, a removed and a further day, and a day that becomes a holiday.
    days[6] = day_trades(6, 12, cantidad="3")
    del days[7]
    days[30] = day_trades(30, 2)
    done = run([t for d in days.values() for t in d], quotes, [date(2026, 1, 5)])
    assert done["operaciones"] == {"2026-01-06": daily.CHANGED, "2026-01-07": daily.GONE, "2026-01-30": daily.NEW}
    assert done["cubo_celdas"] == {"2026-01-05": daily.CHANGED, "2026-01-06": daily.CHANGED, "2026-01-07": daily.GONE, "2026-01-30": daily.NEW}
    assert done["tipo_cambio_diario"] == {"2026-01": daily.CHANGED, "2026-02": daily.NEW} or daily.NEW in done["tipo_cambio_diario"].values()


def test_a_broken_run_is_made_good(run, monkeypatch):
    rows, quotes = day_trades(5, 6), {(1, 5): 1000}
    run(rows, quotes)
    publish = daily.PartitionedTable.settle_prints
    monkeypatch.setattr(daily.PartitionedTable, "settle_prints", lambda self, now: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        run(rows + day_trades(6, 6), quotes)
    monkeypatch.setattr(daily.PartitionedTable, "settle_prints", publish)
    assert run(rows + day_trades(6, 6), quotes)["operaciones"] == {"2026-01-06": daily.NEW}


def test_fingerprints_count_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "part int, x string")
    once = df.dropDuplicates()
    a, b = ({r["part"]: (r["filas"], r["huella"]) for r in daily.fingerprints(x, "part").collect()} for x in (df, once))
    assert a[1] != b[1] and a[2] == b[2] and a[None] == b[None]
    assert daily.fingerprints(df.select("x", "part"), "part").where(F.col("part") == 2).collect()[0]["huella"] == a[2][1]
