from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import micro
from tradewarden.operators import controls
from tradewarden.operators.controls import duplicate_keys, require_key
from tradewarden.params import Params
from tradewarden.plans.pipeline import from_files, load_control
from tradewarden.sources import external, raw, sinks, versions
from tradewarden.sources.storage import TableStore

HEADER = ",".join(raw.RAW_COLUMNS) + "\n"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_typed_load(spark, tmp_path):
    path = write(tmp_path / "t.csv", HEADER
                 + '2026-01-05T02:33:18.010Z,Compra,CLI1,"Bono, Rep. Arg.",ARS,AL30,3,1.1234567,t1,API\n'
                 + "2026-01-05T10:00:00Z,Venta,CLI2,Acción,USD,YPFD,2,5,t2,App\n")
    rows = {r["id_transaccion"]: r for r in raw.type_trades(raw.read_trade_file(spark, path), micro.ZONE).collect()}
    first = rows["t1"]
    assert first["fecha_utc"] == datetime(2026, 1, 5, 2, 33, 18, 10000)
    assert first["dia_art"] == date(2026, 1, 4) and first["hora_art"] == 23 and first["dow_art"] == 7
    assert str(first["precio"]) == "1.123457" and str(first["monto"]) == "3.3704"  # amount from the unrounded price
    assert first["ms_flag"] == "010" and rows["t2"]["ms_flag"] is None
    assert first["descripcion_titulo"] == "Bono, Rep. Arg."


def test_bad_cast_stops_the_load_and_is_listed(spark):
    row = ("2026-01-05T02:33:18.010Z", "Compra", "C", "d", "ARS", "AL30", "dos", "1,5", "t1", "API")
    df = spark.createDataFrame([row], raw.RAW_SCHEMA)
    with pytest.raises(PySparkException):
        raw.type_trades(df, micro.ZONE).collect()
    assert raw.reject_rows(df).collect()[0]["columnas_invalidas"] == "cantidad, precio"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_local_time_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        r = micro.trades(spark, {"fecha": "2026-03-08T02:30:00.000Z"}).collect()[0]
        assert (r["fecha_utc"], r["fecha_art"]) == (datetime(2026, 3, 8, 2, 30), datetime(2026, 3, 7, 23, 30))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_control(spark):
    df = spark.createDataFrame([("2026-01-05T02:33:18.010Z", "Compra", "C", "d", "ARS", "AL30", "1", "1", "t", "API")], raw.RAW_SCHEMA)
    got = {r["tabla"]: r["count"] for r in load_control(df, raw.type_trades(df, micro.ZONE)).collect()}
    assert got == {"raw": 1, "tipada": 1}


def test_primary_key(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "id string")
    assert [tuple(r) for r in duplicate_keys(df, ["id"]).collect()] == [("a", 2)]
    with pytest.raises(ValueError):
        require_key(df, ["id"])
    assert require_key(df.distinct(), ["id"]).count() == 2


def test_holiday_payload_shapes(spark, tmp_path):
    items = [{"motivo": "Navidad", "tipo": "inamovible", "dia": 25, "mes": 12, "id": "x"},
             {"fecha": "2026-01-01", "tipo": "inamovible", "nombre": "Año nuevo"}]
    path = write(tmp_path / "h.json", json.dumps(items))
    rows = external.parse_holidays(external.read_json_items(spark, path, external.HOLIDAY_PAYLOAD), 2026).collect()
    assert [(r["fecha"], r["nombre"]) for r in rows] == [(date(2026, 1, 1), "Año nuevo"), (date(2026, 12, 25), "Navidad")]


def test_quote_payload_keeps_the_period(spark, tmp_path):
    items = [{"casa": "bolsa", "compra": 10.5, "venta": 11, "fecha": f"2026-01-{d:02d}"} for d in (9, 3, 20)]
    path = write(tmp_path / "q.json", json.dumps(items))
    rows = external.parse_quotes(external.read_json_items(spark, path, external.QUOTE_PAYLOAD), date(2026, 1, 1), date(2026, 1, 10)).collect()
    assert [r["fecha"].day for r in rows] == [3, 9] and float(rows[0]["venta"]) == 11.0


def test_first_available_logs_every_attempt(spark, tmp_path):
    empty = spark.createDataFrame([], "fecha date")
    full = spark.createDataFrame([(date(2026, 1, 1),)], "fecha date")
    chosen, log = external.first_available(spark, [
        external.Source("a", "missing", lambda: spark.read.parquet(str(tmp_path / "none"))),
        external.Source("b", "empty", lambda: empty), external.Source("c", "copy", lambda: full, fallback=True)])
    assert [r["fuente"] for r in chosen.collect()] == ["c"]
    assert [(r["api"], r["estado"], r["filas"]) for r in log.collect()] == [("a", "ERROR", 0), ("b", "ERROR", 0), ("c", "FALLBACK", 1)]
    chosen, log = external.first_available(spark, [external.Source("b", "empty", lambda: empty)], none_left=("imp", "trades", "x"))
    assert chosen is None and [r["estado"] for r in log.collect()] == ["ERROR", "FALLBACK"]


def test_csv_export_keeps_booleans_and_nulls(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES ('a', true, 1.50), ('b', false, NULL), ('c', NULL, 2.00) t(id, flag, x)")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = sinks.read_exported_csv(spark, str(tmp_path / "out"), {"id": "string", "flag": "boolean", "x": "double"})
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("a", True, 1.5), ("b", False, None), ("c", None, 2.0)], key=str)


def test_table_store_builds_once(spark, tmp_path):
    calls = []
    store = TableStore(spark, str(tmp_path / "s"))

    def build():
        calls.append(1)
        return spark.range(3)

    assert store.get("t", build).count() == store.get("t", build).count() == 3 and len(calls) == 1


def test_pipeline_from_files(spark, tmp_path):
    lines = [f"2026-0{1 + i % 3}-0{5 + i % 4}T1{i % 10}:00:00.000Z,{'Compra' if i % 2 else 'Venta'},CLI{i % 7},Accion,ARS,YPFD,{i + 1},10,t{i},API\n"
             for i in range(40)]
    trades = write(tmp_path / "t.csv", HEADER + "".join(lines))
    holidays = write(tmp_path / "h.csv", "fecha,nombre,tipo,fuente\n2026-01-01,Año nuevo,inamovible,x\n")
    quotes = write(tmp_path / "q.csv", "fecha,compra,venta,fuente\n2025-12-30,1489.0,1496.4,bolsa\n")
    log = write(tmp_path / "l.csv", "ts_utc,api,url,estado,filas,detalle\n2026-10-07T14:28:13Z,a,u,OK,1,\n")
    p = from_files(spark, trades, holidays, quotes, log,
                   Params(calendar_start=date(2025, 12, 15), calendar_end=date(2026, 3, 31), fx_start=date(2026, 1, 1),
                          fx_end=date(2026, 3, 31)), str(tmp_path / "root"))
    assert p.enriched.count() == 40 and p.dim_calendar.count() == 90
    counts = {r["vista"]: r["count"] for r in p.view_counts().collect()}
    assert counts["vw_fact_operaciones"] == 40 and counts["vw_dim_cliente"] == 7 and counts["vw_api_log"] == 1
    p.publish(str(tmp_path / "out"))
    exported = spark.read.option("header", True).csv(str(tmp_path / "out" / "calendario"))
    assert exported.where("es_habil = 't'").count() > 0 and exported.count() == 90
    docs = spark.read.text(str(tmp_path / "out" / "perfiles_clientes")).collect()
    assert all(json.loads(d["value"])["id_cliente"] for d in docs)
    p.register_views()
    assert spark.sql("SELECT sum(ops) FROM vw_cliente_mes").collect()[0][0] == 40
    assert p.facts.where(F.col("fecha") < "2026-01-01").count() == 0


def test_keys_are_checked_by_fingerprints(spark):
    """Repeated, missing and half-missing keys, the same as by grouping the keys; the keys themselves are not shuffled."""
    rows = [(i, f"k{i}") for i in range(200)] + [(7, "k7"), (7, "k7"), (None, None), (None, "x"), (9, None), (None, None)]
    df = spark.createDataFrame(rows, "a long, b string")
    got = {(r.a, r.b): r.n for r in controls.bad_keys(df, ["a", "b"]).collect()}
    assert got == {(7, "k7"): 3, (None, None): 2, (None, "x"): 1, (9, None): 1}
    report = controls.key_report({"t": (df, ["a", "b"], None), "u": (df.where("a < 5"), ["a"], None)}).collect()
    assert [tuple(r) for r in report] == [("t", "a, b", 206, 1, 4), ("u", "a", 5, 0, 0)]
    plan = df.select(F.xxhash64("a", "b").alias("_h")).groupBy("_h").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_h" in plan
    # A fingerprint shared by different keys is no repetition.
    assert controls.bad_keys(df.where("a < 5"), ["a"], among=df.select(F.xxhash64("a").alias("_h")).distinct()).count() == 0


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path):
    """A run that ends between outputs leaves the version before readable; later versions push old ones and broken ones out."""
    out = str(tmp_path / "out")

    def writers(mark, fails=False):
        def write(path):
            spark.createDataFrame([(mark,)], "mark string").write.parquet(path)

        def break_off(path):
            raise RuntimeError("killed")
        return {"a": write, "b": break_off if fails else write, "c": write}

    def read():
        version = versions.current(spark, out)
        return [spark.read.parquet(version.path(n)).collect()[0]["mark"] for n in version.outputs]
    assert versions.current(spark, out) is None
    versions.publish(spark, out, writers("one"))
    with pytest.raises(RuntimeError):
        versions.publish(spark, out, writers("broken", fails=True))
    assert read() == ["one"] * 3 and len(list((tmp_path / "out" / "versiones").iterdir())) == 2
    old = versions.current(spark, out)
    versions.publish(spark, out, writers("two"))
    assert read() == ["two"] * 3 and spark.read.parquet(old.path("a")).count() == 1
    versions.publish(spark, out, writers("three"), keep=1)
    assert read() == ["three"] * 3
    assert [len(list((tmp_path / "out" / d).glob("[!.]*"))) for d in ("versiones", "manifiestos")] == [1, 1]
