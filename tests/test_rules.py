"""Edge cases of the rules, each on a handful of trades."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import micro
from tradewarden.functions import exprs
from tradewarden.params import Params
from tradewarden.plans import casefile, market, measures, patterns, profile, score, star
from tradewarden.sources.storage import settle

P = Params(calendar_start=date(2025, 12, 15), calendar_end=date(2026, 3, 31), fx_start=date(2026, 1, 1), fx_end=date(2026, 3, 31))
QUOTES = "fecha date, compra decimal(12,4), venta decimal(12,4), fuente string"


def enrich(spark, trades, quotes=((date(2026, 1, 1), 1, 1000, "q"),), holidays=()):
    h = spark.createDataFrame([(d, n) for d, n in holidays], "fecha date, nombre string")
    q = spark.createDataFrame([(d, Decimal(a), Decimal(b), f) for d, a, b, f in quotes], QUOTES)
    trades = settle(trades)
    calendar = settle(market.business_calendar(trades, h, P))
    fx = settle(market.daily_fx(calendar, trades, q, market.implied_fx(trades, P), P))
    return settle(market.enriched_trades(trades, market.rated_days(fx, calendar))), calendar, fx


def priced(symbol, *prices, day="2026-01-05", **more):
    return [{"simbolo_titulo": symbol, "precio": str(x), "fecha": f"{day}T15:00:0{i}.000Z", "id_cliente": f"C{i}", **more}
            for i, x in enumerate(prices)]


def test_mode_takes_the_smallest_on_ties(spark):
    e, _, _ = enrich(spark, micro.trades(spark, {"origen": "Web"}, {"origen": "API"}, {"origen": "Web"}, {"origen": "API"}, {"origen": "Z"}))
    row = profile.client_profile(e, P).collect()[0]
    assert (row["canal_principal"], row["canales"], row["simbolo_principal"], row["ops"]) == ("API", 3, "YPFD", 5)


def limits(spark, **values):
    base = {"p999_ops": 1e9, "p999_monto_cliente": 1e18, "p50_ops": 1.0, "p50_monto_cliente": 100.0, "p999_monto_op": 1e18,
            "base_madrugada": 0.2, "base_inhabil": 0.1, **values}
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} double" for k in base))


def clients(spark, *rows):
    base = dict(id_cliente="C", ops=20, monto_ars=Decimal(0), max_monto_op_ars=Decimal(0), dias_activos=1, simbolos=1, canales=1,
                canal_principal="API", simbolo_principal="S", pct_compras=Decimal(50), ops_madrugada=0, ops_dia_inhabil=0, ops_ene=0,
                ops_feb=0, ops_mar=0, monto_ene=Decimal(0), monto_feb_mar=Decimal(0))
    types = {int: "long", str: "string", Decimal: "decimal(38,4)"}
    schema = ", ".join(f"{k} {types[type(v)]}" for k, v in base.items())
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


NO_P4 = "id_cliente string, monto_ars decimal(28,4), monto_ars_a_precio_mercado decimal(38,2)"


@pytest.mark.parametrize("z,flagged", [(2.995, True), (2.994, False)])
def test_hours_are_flagged_on_the_rounded_z(spark, z, flagged):
    # a base rate for which 9 hits in 20 lie exactly z deviations away
    lo, hi = 1e-6, 0.44
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (9 - 20 * mid) / (20 * mid * (1 - mid)) ** 0.5 > z else (lo, mid)
    c = clients(spark, {"ops": 20, "ops_madrugada": 9})
    u = limits(spark, base_madrugada=lo - 1e-12)
    p2 = patterns.p2_atypical_hours(c, u, P)
    assert patterns.p2_list(p2, P).count() == int(flagged)
    risk = score.risk_score(c, u, days(spark), spark.createDataFrame([], NO_P4), P)
    assert [r["motivos"] for r in risk.collect()] == (["Horario atípico (z>=3)"] if flagged else [])


def test_few_trades_are_not_judged_on_hours(spark):
    c = clients(spark, {"ops": 9, "ops_madrugada": 9})
    assert patterns.p2_atypical_hours(c, limits(spark), P).count() == 0
    assert score.risk_score(c, limits(spark), days(spark), spark.createDataFrame([], NO_P4), P).count() == 0


def days(spark, base=21, after=28):
    return spark.createDataFrame([(base, after)], "dh_ene long, dh_feb_mar long")


def test_frequency_multiple_is_compared_after_rounding(spark):
    # 1 trade before, n after: n * 20 / (after days): 4.95 rounds to 5.0, 4.94 does not
    c = clients(spark, {"id_cliente": "in", "ops_ene": 1, "ops_feb": 99}, {"id_cliente": "out", "ops_ene": 1, "ops_feb": 98})
    got = patterns.p3_behaviour_change(c, days(spark, 20, 400), P).collect()
    assert [(r["id_cliente"], str(r["multiplicador_frecuencia"])) for r in got] == [("in", "5.0")]
    assert got[0]["multiplicador_monto"] is None


def test_change_of_amount_needs_history(spark):
    big = Decimal(5_000_000)
    c = clients(spark, {"id_cliente": "new", "monto_feb_mar": big}, {"id_cliente": "grown", "ops_ene": 1, "monto_ene": big / 10, "monto_feb_mar": big},
                {"id_cliente": "steady", "ops_ene": 1, "monto_ene": big / 9, "monto_feb_mar": big},
                {"id_cliente": "small", "monto_feb_mar": big - 1})
    got = {r["id_cliente"]: r["tipo_cambio"] for r in patterns.p3_behaviour_change(c, days(spark), P).collect()}
    assert got == {"new": "Sin historial en enero + monto alto", "grown": "Cambio brusco"}


def test_prices_at_the_limits_are_not_flagged(spark):
    rows = priced("YPFD", 100, 100, 100, 50, 200) + priced("GGAL", 100, 100, 100, "49.999999", "200.000001")
    e, _, _ = enrich(spark, micro.trades(spark, *rows))
    p4 = patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P).collect()
    assert sorted((r["simbolo_titulo"], str(r["precio"])) for r in p4) == [("GGAL", "200.000001"), ("GGAL", "49.999999")]
    assert {r["ops_referencia"] for r in p4} == {5}


def test_four_references_are_too_few(spark):
    e, _, _ = enrich(spark, micro.trades(spark, *priced("YPFD", 100, 100, 100, 1), *priced("GGAL", 100, 100, 100, 100, 1)))
    p4 = patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P)
    assert [r["simbolo_titulo"] for r in p4.collect()] == ["GGAL"]


def test_options_are_not_judged(spark):
    rows = priced("GFGC79054F", 100, 100, 100, 100, 1) + priced("XX", 100, 100, 100, 100, 1, descripcion_titulo="Opción de compra")
    e, _, _ = enrich(spark, micro.trades(spark, *rows))
    assert patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P).count() == 0


def test_off_market_value_uses_the_rate(spark):
    e, _, _ = enrich(spark, micro.trades(spark, *priced("YPFD", 100, 100, 100, 100, 1, moneda="USD", cantidad="3")))
    row = patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P).collect()[0]
    assert (row["monto_ars"], row["monto_ars_a_precio_mercado"], str(row["ratio_vs_mercado"])) == (3000, 300000, "0.0100")


def test_market_value_of_very_large_trades(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        ('USD', 3L, 1.0000005BD, 1234.5678BD), ('USD', 999999999999L, 1.5BD, 2BD), ('ARS', 7L, 0.0000005BD, 9BD) t(moneda, q, m, r)""").select(
        "moneda", F.col("q").alias("cantidad"), F.col("m").cast("decimal(27,7)").alias("mediana"),
        F.col("r").cast("decimal(12,4)").alias("tc_ars_por_usd"))
    got = [str(r[0]) for r in rows.select(patterns.market_value()).collect()]
    assert [Decimal(g) for g in got] == [Decimal("3703.71"), Decimal("2999999999997.00"), Decimal("0.00")]


def fx_rows(fx):
    return {r["fecha"]: (r["tc_ars_por_usd"] and float(r["tc_ars_por_usd"]), r["fuente_tc"], r["arrastrado"]) for r in fx.collect()}


IMPLIED = "MEP implícito dataset (AL30/AL30D)"


def bond_day(day, ars, usd):
    return (priced("AL30", *[ars] * 5, day=day) + priced("AL30D", *[usd] * 5, day=day, moneda="USD"))


def test_rate_chain(spark):
    t = micro.trades(spark, *bond_day("2026-01-05", 1500, 1), *bond_day("2026-01-08", 3200, 2))
    _, _, fx = enrich(spark, t, quotes=[(date(2026, 1, 7), 1, 1400, "q"), (date(2026, 1, 9), 1, 1450, "q")])
    got = fx_rows(fx)
    assert got[date(2026, 1, 1)] == (1500.0, IMPLIED, True)  # nothing yet: the first implied rate
    assert got[date(2026, 1, 5)] == (1500.0, IMPLIED, None)  # three-valued: no quote, same-day implied rate
    assert got[date(2026, 1, 6)] == (1500.0, IMPLIED, True)
    assert got[date(2026, 1, 7)] == (1400.0, "API MEP (q)", False)
    assert got[date(2026, 1, 8)] == (1400.0, "API MEP (q)", True)
    assert got[date(2026, 3, 31)] == (1450.0, "API MEP (q)", True) and len(got) == 90


def test_rate_without_any_quote(spark):
    t = micro.trades(spark, *bond_day("2026-01-05", 1500, 1))
    assert set(v[0] for v in fx_rows(enrich(spark, t, quotes=())[2]).values()) == {1500.0}
    nothing = fx_rows(enrich(spark, micro.trades(spark, {}), quotes=())[2])
    assert set(nothing.values()) == {(None, IMPLIED, True)}


def test_implied_rate_needs_both_sides(spark):
    t = micro.trades(spark, *priced("AL30", *[1500] * 5), *priced("AL30D", *[1] * 4, moneda="USD"))
    assert market.implied_fx(t, P).count() == 0


def test_calendar_and_day_types(spark):
    t = micro.trades(spark, {"fecha": "2026-01-03T15:00:00.000Z"}, {"fecha": "2026-01-04T15:00:00.000Z"}, {"fecha": "2026-01-05T03:00:00.000Z"})
    e, cal, _ = enrich(spark, t, holidays=[(date(2026, 1, 4), "Domingo feriado")])
    habil = {r["fecha"]: r["es_habil"] for r in cal.collect()}
    assert len(habil) == 107 and not habil[date(2026, 1, 3)] and not habil[date(2026, 1, 4)] and habil[date(2026, 1, 5)]
    got = {r["dia_art"]: (r["tipo_dia"], r["franja_horaria"]) for r in e.collect()}
    assert got == {date(2026, 1, 3): ("Fin de semana", "Mercado (11-17)"), date(2026, 1, 4): ("Feriado", "Mercado (11-17)"),
                   date(2026, 1, 5): ("Día hábil", "Madrugada (0-6)")}


def test_trades_outside_the_rates_are_dropped_and_counted(spark):
    t = micro.trades(spark, {}, {"fecha": "2026-04-02T15:00:00.000Z"}, {"fecha": "2025-12-20T15:00:00.000Z"})
    e, _, fx = enrich(spark, t)
    assert e.count() == 1
    assert tuple(market.dropped_trades(t, fx).collect()[0]) == (2, 2)


def test_score_weights_levels_and_reasons(spark):
    big = Decimal(50_000_000)
    c = clients(spark, {"id_cliente": "a", "ops": 500, "monto_feb_mar": big, "max_monto_op_ars": big},
                {"id_cliente": "b", "ops_ene": 1, "monto_ene": Decimal(1), "monto_feb_mar": big}, {"id_cliente": "c"})
    p4 = spark.createDataFrame([("a", Decimal(10), Decimal(4)), ("a", Decimal(1), Decimal(9))], NO_P4)
    u = limits(spark, p999_ops=500.0, p999_monto_op=5e7)
    got = {r["id_cliente"]: r for r in score.risk_score(c, u, days(spark), p4, P).collect()}
    assert got.keys() == {"a", "b"}
    assert (got["a"]["score"], got["a"]["nivel_riesgo"], got["a"]["ops_precio_fuera"], float(got["a"]["diferencia_valor_ars"])) == (6, "Alto", 2, 14.0)
    assert got["a"]["motivos"] == ("Precio fuera de mercado | Sin historial en enero + monto alto | Actividad top 0,1% | "
                                   "Operación >= p99,9 (info)")
    assert (got["b"]["score"], got["b"]["nivel_riesgo"], got["b"]["motivos"]) == (2, "Medio", "Cambio brusco feb-mar")
    dim = {r["id_cliente"]: r for r in star.dim_client(c, score.risk_score(c, u, days(spark), p4, P)).collect()}
    assert (dim["c"]["nivel_riesgo"], dim["c"]["orden_nivel"], dim["c"]["motivos"], dim["c"]["score_riesgo"]) == ("Sin alerta", 4, "", 0)


def test_fixed_working_days_override(spark):
    e, _, _ = enrich(spark, micro.trades(spark, {}))
    assert tuple(profile.working_days(e, Params(working_days=(21, 28))).collect()[0]) == (21, 28)
    assert tuple(profile.working_days(e, P).collect()[0]) == (1, 0)


def test_families(spark):
    rows = [("Cedear Apple opción", "AAPL", "CEDEAR", "CEDEAR"), ("x", "GFGC79054F", "Opción", "Opción"), ("Letra", "S29Y6", "Bono / Letra", "Bono / Letra"),
            ("Obligación Negociable YPF", "YMCXO", "Obligación Negociable", "Acción / Otro"), ("Bono obligaci", "Q", "Bono / Letra", "Bono / Letra"),
            ("Acción", "YPFD", "Acción / Otro", "Acción / Otro")]
    df = spark.createDataFrame(rows, "d string, s string, five string, four string")
    got = df.select(exprs.family(F.col("d"), F.col("s"), True) == F.col("five"), exprs.family(F.col("d"), F.col("s"), False) == F.col("four"))
    assert all(all(r) for r in got.collect())


def test_long_detail_lists_continue_in_parts(spark):
    e, _, _ = enrich(spark, micro.trades(spark, *priced("YPFD", *[100] * 6, 1, 2, 3, id_cliente="hot")))
    p4 = patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P)
    from dataclasses import replace
    parts = casefile.p4_detail_nested(p4, replace(P, detail_chunk=2)).orderBy("parte").collect()
    assert [(r["parte"], [float(d["precio_operado"]) for d in r["detalle"]]) for r in parts] == [(0, [1.0, 2.0]), (1, [3.0])]


def test_case_file_leaves_out_empty_fields(spark):
    e, _, _ = enrich(spark, micro.trades(spark, *priced("YPFD", 5, 6, 7, id_cliente="C")))
    c = settle(profile.client_profile(e, P))
    u = limits(spark, p999_ops=3.0)
    p4 = settle(patterns.p4_off_market_price(e, patterns.reference_prices(e, P), P))
    risk = settle(score.risk_score(c, u, days(spark), p4, P))
    cases = casefile.case_fields(risk, casefile.flagged_trades(e, risk), p4, casefile.population_reference(c, u), P)
    doc = json.loads(casefile.client_profile_json(cases).collect()[0]["perfil"])
    assert len(cases.columns) == 29 and "parte" not in doc and "detalle_precio_fuera_de_mercado" not in doc and "operaciones_precio_fuera_de_mercado" not in doc
    assert doc["operaciones_por_canal"] == {"API": 3} and doc["top_instrumentos"][0]["compras"] == 3
    assert doc["dias_especie_compra_y_venta_mismo_dia"] == "0 de 1" and doc["monto_total_ars"] == 18


def test_half_even_and_half_up(spark):
    r = spark.sql("SELECT 2.5D a, 3.5D b, 1.005D c").select(
        casefile.half_even(F.col("a")), casefile.half_even(F.col("b")), exprs.rounded(F.col("c"), 2), exprs.rounded(F.col("a"), 0)).collect()[0]
    assert [float(x) for x in r] == [2.0, 4.0, 1.01, 3.0]


def test_cumulative_share_includes_ties(spark):
    df = spark.createDataFrame([("a", Decimal(5)), ("b", Decimal(3)), ("c", Decimal(3)), ("d", Decimal(1))], "id_cliente string, monto_ars decimal(38,4)")
    got = {r["id_cliente"]: (r["rank_cliente_monto"], round(float(r["pct_acumulado_monto"]), 4)) for r in measures.cumulative_share(df).collect()}
    assert got == {"a": (1, 0.4167), "b": (2, 0.9167), "c": (2, 0.9167), "d": (3, 1.0)}


def test_text_measures(spark):
    r = spark.sql("SELECT 1234567.5 n, 0.7041 s").select(exprs.grouped_number(F.col("n")), exprs.percent_text(F.col("s"))).collect()[0]
    assert tuple(r) == ("1,234,568", "70.4%")
