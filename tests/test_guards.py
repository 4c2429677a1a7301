"""Keys, stray dates, odd trade files and case documents in parts."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import micro
from tradewarden.functions.exprs import times_units
from tradewarden.operators import ranking, spine
from tradewarden.operators.controls import KeyViolation
from tradewarden.params import Params
from tradewarden.plans import casefile
from tradewarden.plans.pipeline import Pipeline, from_sources
from tradewarden.sources import external, raw, sinks

DAYS = "fecha date, nombre string, tipo string, fuente string"
RATES = "fecha date, compra decimal(12,4), venta decimal(12,4), fuente string"


def pipeline(spark, trades, holidays=(), quotes=((date(2026, 1, 1), Decimal(1), Decimal(1000), "x"),), **params) -> Pipeline:
    return Pipeline(spark, lambda: trades, lambda: spark.createDataFrame(list(holidays), DAYS),
                    lambda: spark.createDataFrame(list(quotes), RATES), params=Params(**params))


def test_a_repeated_holiday_or_trade_is_refused(spark):
    trades = micro.trades(spark, {}, {})
    twice = [(date(2026, 1, 6), "a", "", ""), (date(2026, 1, 6), "b", "", "")]
    with pytest.raises(KeyViolation, match="feriados"):
        pipeline(spark, trades, twice).enriched.count()
    with pytest.raises(KeyViolation, match="operaciones"):
        pipeline(spark, trades.unionByName(trades)).enriched.count()
    assert pipeline(spark, trades, twice[:1]).enriched.count() == 2


def test_a_stray_date_drops_its_trade_only(spark, monkeypatch):
    trades = micro.trades(spark, {}, {"fecha": "1826-01-05T15:00:00.000Z"}, {"fecha": "2026-01-06T15:00:00.000Z"})
    p = pipeline(spark, trades, fx_start=date(2026, 1, 1))
    assert p.enriched.count() == 2
    monkeypatch.setattr(spine, "BROADCAST_DAYS", 3)
    assert p.enriched.count() == 2 and pipeline(spark, trades, fx_start=date(2026, 1, 1)).enriched.exceptAll(p.enriched).isEmpty()


ODD = [("2026-01-05T10:00:00-03:00", "2", "10.5", None), ("2026-01-05T10:00:00.000Z", "2000000000000000", "1", None),
       ("2026-01-05 10:00:00", "1", "5000000000000", None), ("2026-01-05T10:00:00Z", "3000000000", "99999999999", "monto"),
       ("yesterday", "1", "1", "fecha"), ("2026-01-05T10:00:00Z", "x", "1", "cantidad"), ("2026-01-05T10:00:00Z", "1", "", "precio"),
       ("2026-01-05T10:00:00+0530", "1", "0.0000000001234", None)]


@pytest.mark.parametrize(("fecha", "cantidad", "precio", "fault"), ODD)
def test_rejects_are_what_stops_the_load(spark, fecha, cantidad, precio, fault):
    row = {c: "x" for c in raw.RAW_COLUMNS} | {"fecha": fecha, "cantidad": cantidad, "precio": precio}
    df = spark.createDataFrame([tuple(row[c] for c in raw.RAW_COLUMNS)], raw.RAW_SCHEMA)
    assert [r["columnas_invalidas"] for r in raw.reject_rows(df).collect()] == ([fault] if fault else [])
    typed = raw.type_trades(df, "America/Argentina/Buenos_Aires")
    if fault:
        with pytest.raises(Exception, match=fault):
            typed.collect()
    else:
        assert typed.collect()[0]["monto"] == (Decimal(cantidad) * Decimal(precio)).quantize(Decimal("0.0001"))


def test_offsets_are_instants(spark):
    df = micro.trades(spark, {"fecha": "2026-01-05T10:00:00-03:00"}, {"fecha": "2026-01-05T13:00:00Z"}, {"fecha": "2026-01-05T18:30:00.000+05:30"})
    assert {(r["fecha_utc"].hour, r["hora_art"]) for r in df.collect()} == {(13, 10)}


def test_quotes_commas_and_line_breaks_in_a_field(spark, tmp_path):
    texts = ['Bono ""Largo"", serie A', "two\nlines", 'plain "q'] 
    rows = spark.createDataFrame([tuple(t if c == "descripcion_titulo" else "x" for c in raw.RAW_COLUMNS) for t in texts], raw.RAW_SCHEMA)
    sinks.write_csv(rows, str(tmp_path / "t"))
    back = raw.read_trade_file(spark, str(tmp_path / "t"), multi_line=True)
    assert sorted(r["descripcion_titulo"] for r in back.collect()) == sorted(texts)


def test_case_document_in_parts_lists_every_trade(spark, tmp_path):
    day = [{"precio": "100", "id_cliente": f"o{i}"} for i in range(9)] + [{"precio": "1000", "id_cliente": "C"} for _ in range(5)]
    p = pipeline(spark, micro.trades(spark, *day), detail_chunk=2)
    p.publish(str(tmp_path))
    docs = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "perfiles_clientes")).collect()]
    docs = [d for d in docs if d["id_cliente"] == "C"]
    assert sorted(d["parte"] for d in docs) == [0, 1, 2] and {d["partes"] for d in docs} == {3}
    listed = sum(len(d["detalle_precio_fuera_de_mercado"]) for d in docs)
    assert listed == next(d for d in docs if d["parte"] == 0)["operaciones_precio_fuera_de_mercado"] == 5
    assert [len(d) < 10 for d in sorted(docs, key=lambda d: d["parte"])] == [False, True, True]
    one = casefile.client_profile_json(replace_chunk(p)).where("id_cliente = 'C'").collect()
    assert len(one) == 1 and "parte" not in json.loads(one[0]["perfil"])


def replace_chunk(p: Pipeline):
    return casefile.case_fields(p.risk, p.flagged, p.p4, p.population, replace(p.params, detail_chunk=1000))


def test_exact_medians_whatever_the_path(spark):
    values = ["999999999999.000001", "999999999999.000002", "0.000001", "5"]
    df = spark.createDataFrame([(g, Decimal(v)) for g, n in (("a", 2), ("b", 3), ("c", 4)) for v in values[:n]], "g string, v decimal(20,6)")
    want = {"a": Decimal("999999999999.0000015"), "b": Decimal("999999999999.000001"), "c": Decimal("500000000002.0000005")}
    for most in (None, 1):
        got = ranking.medians_by_group(df, ["g"], "v", "m", size_as="n", max_distinct=most).collect()
        assert {r["g"]: r["m"] for r in got} == want and {r["g"]: r["n"] for r in got} == {"a": 2, "b": 3, "c": 4}


def test_one_rounding_of_large_products(spark):
    df = spark.createDataFrame([(9_000_000_000_000, Decimal("123456789.12345678901")), (3, Decimal("0.335"))], "u long, p decimal(33,11)")
    got = [r[0] for r in df.select(times_units(F.col("u"), F.col("p"), 2)).collect()]
    assert got == [Decimal("1111111102111111101090.00"), Decimal("1.01")]


def test_sources_that_fail_for_another_reason_are_not_passed_over(spark):
    def lost():
        raise RuntimeError("executor lost")
    with pytest.raises(RuntimeError):
        external.first_available(spark, [external.Source("a", "u", lost)])
    missing = external.Source("a", "u", lambda: spark.read.schema("x int").parquet("/nowhere/at/all"))
    chosen, log = external.first_available(spark, [missing], none_left=("b", "-", "the implied rate is used"))
    assert chosen is None and [(r["estado"], r["api"]) for r in log.collect()] == [("ERROR", "a"), ("FALLBACK", "b")]
    assert len({r["ts_utc"] for r in log.collect()}) == 2


def test_pipeline_over_ordered_sources(spark, tmp_path):
    fast = [{"simbolo_titulo": t, "moneda": m, "precio": q} for t, m, q in (("AL30", "ARS", "1000"), ("AL30D", "USD", "1")) for _ in range(5)]
    text = [{"fecha": "2026-01-05T15:00:00.000Z", "tipoTran": "Compra", "id_cliente": "C", "descripcion_titulo": "Bono", "cantidad": "1",
             "origen": "API", "id_transaccion": f"t{i}", **r} for i, r in enumerate(fast)]
    rows = spark.createDataFrame([tuple(r[c] for c in raw.RAW_COLUMNS) for r in text], raw.RAW_SCHEMA)
    sinks.write_csv(rows, str(tmp_path / "trades"))
    (tmp_path / "days.json").write_text('[{"dia": 6, "mes": 1, "motivo": "x", "tipo": "t"}]')
    (tmp_path / "none.json").write_text("[]")

    def days(name):
        return lambda: external.parse_holidays(external.read_json_items(spark, str(tmp_path / name), external.HOLIDAY_PAYLOAD), 2026)

    def rates():
        items = external.read_json_items(spark, str(tmp_path / "none.json"), external.QUOTE_PAYLOAD)
        return external.parse_quotes(items, date(2026, 1, 1), date(2026, 2, 1))
    p = from_sources(spark, str(tmp_path / "trades"),
                     [external.Source("first", "none.json", days("none.json")), external.Source("second", "days.json", days("days.json"), fallback=True)],
                     [external.Source("rates", "none.json", rates)], root=str(tmp_path / "store"))
    assert {r["fuente_tc"] for r in p.fx.collect()} == {"MEP implícito dataset (AL30/AL30D)"} and p.enriched.count() == 10
    assert [r["feriado"] for r in p.calendar.where("feriado is not null").collect()] == ["x"]
    assert [(r["api"], r["estado"], r["filas"]) for r in p.api_log.orderBy("ts_utc").collect()] == [
        ("first", "ERROR", 0), ("second", "FALLBACK", 1), ("rates", "ERROR", 0), ("rates", "FALLBACK", 0)]
    with pytest.raises(external.EmptyPayload):
        from_sources(spark, str(tmp_path / "trades"), [], []).holidays
