"""Star schema and dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.functions.exprs import family, millions, rounded, weekday_label
from tradewarden.operators.ranking import global_rank, top_shares
from tradewarden.params import (
    CHANGE_ABRUPT, LEVEL_HIGH, LEVEL_LOW, LEVEL_MEDIUM, LEVEL_NONE, Params)
from tradewarden.plans.explore import bucket, n_ops, ops_per_client, rows_of
from tradewarden.plans.patterns import extreme, off_market, price_ratio


def fact_trades(priced: DataFrame, limits: DataFrame, p: Params) -> DataFrame:
    """One row per trade with its anomaly marks, from the enriched trades with their reference prices. The off-market mark is
    taken straight from the day's reference price, so the trades are never joined on their id."""
    marked = F.coalesce(off_market(p), F.lit(False))
    return priced.select(
        "id_transaccion", "id_cliente", "fecha_art", F.col("dia_art").alias("fecha"), "hora_art", "franja_horaria",
        "tipo_dia", "tipo_tran", F.col("origen").alias("canal"), "moneda", "simbolo_titulo", "descripcion_titulo",
        family(F.col("descripcion_titulo"), F.col("simbolo_titulo"), corporate=False).alias("familia_instrumento"),
        "cantidad", "precio", F.col("monto").alias("monto_moneda_original"), "tc_ars_por_usd", "monto_ars",
        marked.alias("flag_precio_fuera_mercado"), F.when(marked, price_ratio()).alias("ratio_vs_mercado"),
        extreme(limits).alias("flag_operacion_extrema"))


def dim_client(profile: DataFrame, risk: DataFrame) -> DataFrame:
    scored = risk.select("id_cliente", "score", "nivel_riesgo", F.col("motivos").alias("_why"),
                         "f_actividad_alta", "f_horario_atipico", "f_cambio_brusco", "f_sin_historial_monto_alto",
                         "f_precio_fuera_mercado", F.col("diferencia_valor_ars").alias("_gap"))
    level = F.coalesce("nivel_riesgo", F.lit(LEVEL_NONE))

    def flag(source: str, out: str):
        return F.coalesce(source, F.lit(False)).alias(out)

    return profile.join(scored, "id_cliente", "left").select(
        "id_cliente", "canal_principal", "canales", "ops", "dias_activos", "simbolos", "simbolo_principal", "monto_ars",
        "pct_compras", "ops_ene", "ops_feb", "ops_mar", "monto_ene", "monto_feb_mar",
        F.coalesce("score", F.lit(0)).alias("score_riesgo"), level.alias("nivel_riesgo"),
        F.when(level == LEVEL_HIGH, 1).when(level == LEVEL_MEDIUM, 2).when(level == LEVEL_LOW, 3).otherwise(4)
        .alias("orden_nivel"),
        F.coalesce("_why", F.lit("")).alias("motivos"),
        flag("f_actividad_alta", "p1_actividad_alta"), flag("f_horario_atipico", "p2_horario_atipico"),
        flag("f_cambio_brusco", "p3_cambio_brusco"),
        flag("f_sin_historial_monto_alto", "p3_sin_historial_monto_alto"),
        flag("f_precio_fuera_mercado", "p4_precio_fuera_mercado"),
        F.coalesce("_gap", F.lit(0)).alias("diferencia_valor_ars"))


def dim_calendar(calendar: DataFrame, fx: DataFrame, start=None, end=None) -> DataFrame:
    """Calendar with rates; only days inside the given bounds, by default the days with a rate row."""
    rates = fx.select("fecha", "tc_ars_por_usd", "fuente_tc")
    if start is None:
        joined = calendar.join(rates, "fecha")
    else:
        joined = calendar.where(F.col("fecha").between(F.lit(start), F.lit(end))).join(rates, "fecha", "left")
    return joined.select("fecha", "dow", weekday_label(F.col("dow")).alias("dia_semana"),
                         F.date_format("fecha", "yyyy-MM").alias("anio_mes"), "es_habil", "feriado", "tc_ars_por_usd",
                         "fuente_tc")


def client_month(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("id_cliente", "mes").agg(n_ops(), F.sum("monto_ars").alias("monto_ars"))


def api_log_view(log: DataFrame) -> DataFrame:
    return log.select("ts_utc", "api", "url", "estado", "filas", "detalle")


def alert_export(clients: DataFrame) -> DataFrame:
    return (clients.where(F.col("nivel_riesgo") != LEVEL_NONE)
            .orderBy(F.desc("score_riesgo"), F.desc("monto_ars"), "id_cliente"))


def trades_export(facts: DataFrame) -> DataFrame:
    return facts.orderBy("fecha_art", "id_transaccion").select(
        "id_transaccion", "id_cliente", "fecha", "fecha_art", "hora_art", "franja_horaria", "tipo_dia", "tipo_tran",
        "canal", "moneda", "simbolo_titulo", "familia_instrumento", "cantidad", "precio", "monto_ars",
        "flag_precio_fuera_mercado", "flag_operacion_extrema",
        F.when(F.col("flag_precio_fuera_mercado"), "Sí").otherwise("No").alias("precio_fuera_mercado"))


def clients_export(clients: DataFrame) -> DataFrame:
    """Clients with base-10 logarithms and two global rankings. The ranks are taken on the three
    columns they need and joined back by client."""
    narrow = clients.select("id_cliente", "ops", "monto_ars")
    ranks = global_rank(narrow, ["-monto_ars", "id_cliente"], "rank_monto")
    ranks = global_rank(ranks, ["-ops", "-monto_ars", "id_cliente"], "rank_ops")

    def log10(col: str):
        return rounded(F.log10(F.greatest(F.col(col).cast("double"), F.lit(1.0))), 4)

    return clients.join(ranks.select("id_cliente", "rank_monto", "rank_ops"), "id_cliente").select(
        "id_cliente", "canal_principal", "ops", "dias_activos", "simbolos", F.round("monto_ars", 2).alias("monto_ars"),
        "ops_ene", "ops_feb", "ops_mar", "score_riesgo", "nivel_riesgo", "orden_nivel", "motivos", "p1_actividad_alta",
        "p2_horario_atipico", "p3_cambio_brusco", "p3_sin_historial_monto_alto", "p4_precio_fuera_mercado",
        F.round("diferencia_valor_ars", 2).alias("diferencia_valor_ars"),
        log10("ops").alias("log10_ops"), log10("monto_ars").alias("log10_monto_ars"), "rank_monto", "rank_ops")


def calendar_export(dim: DataFrame) -> DataFrame:
    return dim.select("*", F.date_format("fecha", "dd/MM").alias("dia_mes"),
                      F.date_format("fecha", "yyyyMMdd").cast("int").alias("fecha_num")).orderBy("fecha")


def api_log_export(log: DataFrame) -> DataFrame:
    return log.select("api", "estado", "filas", "detalle", "url")


def top_instruments_export(enriched: DataFrame, k: int = 15) -> DataFrame:
    """The k instruments are cut first; distinct clients and the ranking then concern those only."""
    keys = ["simbolo_titulo", "moneda"]
    order = [F.desc("ops"), F.asc("simbolo_titulo"), F.asc("moneda")]
    top = enriched.groupBy(*keys).agg(n_ops()).orderBy(*order).limit(k)
    rows = rows_of(enriched, top, keys).groupBy(*keys).agg(
        n_ops(), F.countDistinct("id_cliente").alias("clientes"), F.sum("monto_ars").alias("m"))
    return rows.select(
        F.row_number().over(Window.orderBy(*order)).alias("ranking"),
        F.concat("simbolo_titulo", F.lit(" ("), "moneda", F.lit(")")).alias("instrumento"), "ops", "clientes",
        millions(F.col("m")).alias("monto_ars_mill")).orderBy("ranking")


# Buckets of the dashboard, coarser than the exploration's.
EXPORT_BUCKETS = ((1, "1 op"), (2, "2 ops"), (5, "3-5"), (10, "6-10"), (50, "11-50"), (None, ">50"))


def buckets_export(clients: DataFrame) -> DataFrame:
    number = bucket(F.col("ops"), tuple((b, i + 1) for i, (b, _) in enumerate(EXPORT_BUCKETS)))
    return (ops_per_client(clients).groupBy(number.alias("orden"), bucket(F.col("ops"), EXPORT_BUCKETS).alias("tramo"))
            .agg(F.count("*").alias("clientes"), F.sum("ops").alias("ops")).orderBy("orden"))


def pareto_export(profile: DataFrame, p: Params) -> DataFrame:
    """Concentration over all amounts in ARS; the cuts are percentages of the clients."""
    curve = top_shares(profile, {"pct_monto": "monto_ars"}, [c / 100 for c in p.pareto_cuts])
    cut = (F.col("corte") * 100).cast("decimal(9,2)")
    text = F.replace(F.regexp_replace(cut.cast("string"), r"\.?0+$", ""), F.lit("."), F.lit(","))
    return curve.select(cut.alias("pct_clientes"), F.concat(F.lit("Top "), text, F.lit("%")).alias("segmento"),
                        "pct_monto").orderBy("pct_clientes")


def p3_top_long(p3: DataFrame, p: Params, k: int = 12) -> DataFrame:
    """The k sharpest changes, one row per client and period."""
    top = (p3.where(F.col("tipo_cambio") == CHANGE_ABRUPT)
           .orderBy(F.desc("multiplicador_frecuencia"), F.desc("ops_feb_mar"), "id_cliente").limit(k))
    periods = F.array(*[F.struct(F.lit(i + 1).alias("mes_orden"), F.lit(name).alias("mes"), F.col(c).alias("ops"))
                        for i, (name, c) in enumerate(zip(p.period_names, ("ops_ene", "ops_feb", "ops_mar")))])
    return top.select("id_cliente", F.explode(periods).alias("r")).select("id_cliente", "r.*").orderBy("id_cliente", "mes_orden")

