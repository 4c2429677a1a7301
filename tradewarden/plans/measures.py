"""Dashboard measures and the table behind each visual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.functions.exprs import (
    count_where, grouped_number, millions, pct, percent_text, ratio, sum_where)
from tradewarden.operators.ranking import running_total_with_ties
from tradewarden.params import BAND_MARKET, BUSINESS_DAY, LEVEL_HIGH, LEVEL_LOW, LEVEL_MEDIUM, LEVEL_NONE, WEEKDAYS

def _operations() -> Column:
    return F.count("*").alias("operaciones")


def _alerted() -> Column:
    return F.col("nivel_riesgo") != LEVEL_NONE


def _share(cond: Column) -> Column:
    """A fraction, as the dashboard keeps percentages."""
    return ratio(count_where(cond), F.count("*"), 6)


def trade_measures(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("cant_operaciones"), F.countDistinct("id_cliente").alias("clientes_unicos"),
        millions(F.sum("monto_ars"), 4).alias("monto_ars_m"),
        _share(F.col("franja_horaria") != BAND_MARKET).alias("pct_fuera_de_horario"),
        _share(F.col("tipo_dia") != BUSINESS_DAY).alias("pct_dia_inhabil"),
        count_where(F.col("flag_precio_fuera_mercado")).alias("ops_precio_fuera_de_mercado"),
    ).withColumn("ops_por_cliente", ratio(F.col("cant_operaciones"), F.col("clientes_unicos"), 4))


def client_measures(clients: DataFrame) -> DataFrame:
    money = F.col("monto_ars")
    return clients.agg(
        count_where(_alerted()).alias("clientes_en_alerta"),
        count_where(F.col("nivel_riesgo") == LEVEL_HIGH).alias("clientes_riesgo_alto"),
        millions(F.sum(money), 4).alias("monto_clientes_m"),
        millions(F.coalesce(sum_where(_alerted(), money), F.lit(0)), 4).alias("monto_en_alerta_m"),
        ratio(F.coalesce(sum_where(_alerted(), money), F.lit(0)), F.sum(money), 6).alias("pct_monto_en_alerta"),
        millions(F.sum("diferencia_valor_ars"), 4).alias("diferencia_valor_ars_m"))


def kpi_cards(facts: DataFrame, clients: DataFrame) -> DataFrame:
    """All card values in one row: the measures and their texts."""
    c = client_measures(clients).select(F.struct("*")).scalar()
    rows = trade_measures(facts).withColumn("_c", c).select("*", "_c.*").drop("_c")
    return rows.select(
        "*", grouped_number(F.col("cant_operaciones")).alias("operaciones_totales_txt"),
        grouped_number(F.col("clientes_unicos")).alias("clientes_activos_txt"),
        grouped_number(F.col("monto_ars_m")).alias("monto_ars_m_txt"),
        percent_text(F.col("pct_fuera_de_horario")).alias("fuera_de_horario_txt"),
        grouped_number(F.col("clientes_en_alerta")).alias("clientes_con_alerta_txt"),
        grouped_number(F.col("clientes_riesgo_alto")).alias("riesgo_alto_txt"),
        grouped_number(F.col("monto_en_alerta_m")).alias("monto_en_alerta_m_txt"))


def volume_by_level(clients: DataFrame) -> DataFrame:
    """Amount and share of the volume of all clients, per level."""
    everyone = clients.agg(F.sum("monto_ars")).scalar()
    return (clients.groupBy("nivel_riesgo", "orden_nivel")
            .agg(millions(F.sum("monto_ars"), 4).alias("monto_clientes_m"),
                 ratio(F.sum("monto_ars"), everyone, 6).alias("pct_del_volumen"))
            .orderBy("orden_nivel"))


# The visuals below count trades by what the rated cells of the cube hold; none reads a trade.

def _counted() -> Column:
    return F.sum("ops").alias("operaciones")


def trades_by_day(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.col("dia_art").alias("fecha"), "tipo_dia").agg(_counted()).orderBy("fecha", "tipo_dia")


def trades_by_channel(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.col("origen").alias("canal")).agg(_counted()).orderBy(F.desc("operaciones"), "canal")


def hour_weekday_heatmap(cells: DataFrame, calendar: DataFrame) -> DataFrame:
    """Hours as rows, weekdays as columns. Cells are added up per day and hour before they meet the calendar."""
    hours = cells.groupBy(F.col("dia_art").alias("fecha"), "hora_art").agg(F.sum("ops").alias("n"))
    return (hours.join(calendar.select("fecha", "dia_semana"), "fecha").groupBy("hora_art")
            .pivot("dia_semana", list(WEEKDAYS)).agg(F.sum("n")).orderBy("hora_art"))


def bands_within_channel(cells: DataFrame) -> DataFrame:
    """Hour bands as shares of their channel; the window runs over a few rows per channel."""
    bands = cells.groupBy(F.col("origen").alias("canal"), "franja_horaria").agg(_counted())
    return bands.withColumn("pct", pct(F.col("operaciones"), F.sum("operaciones").over(Window.partitionBy("canal"))))


def top_clients_by_amount(export: DataFrame, k: int = 10) -> DataFrame:
    return (export.where(F.col("rank_monto") <= k).orderBy("rank_monto")
            .select("rank_monto", "id_cliente", "nivel_riesgo", millions(F.col("monto_ars"), 4).alias("monto_clientes_m")))


def top_clients_by_ops(export: DataFrame, k: int = 10) -> DataFrame:
    return (export.where(F.col("rank_ops") <= k).orderBy("rank_ops")
            .select("rank_ops", "id_cliente", "nivel_riesgo", "ops"))


def p3_pivot(top_long: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return top_long.groupBy("id_cliente").pivot("mes", list(names)).agg(F.sum("ops")).orderBy("id_cliente")


def review_table(clients: DataFrame, levels: tuple[str, ...] = (LEVEL_HIGH, LEVEL_MEDIUM, LEVEL_LOW),
                 channels: tuple[str, ...] | None = None) -> DataFrame:
    """Clients in alert under the level and channel slicers."""
    rows = clients.where(F.col("nivel_riesgo").isin(*levels))
    if channels is not None:
        rows = rows.where(F.col("canal_principal").isin(*channels))
    return (rows.select("id_cliente", "nivel_riesgo", "score_riesgo", "motivos", "canal_principal", "ops",
                        F.round("monto_ars", 2).alias("monto_ars"), "ops_ene", "ops_feb", "ops_mar")
            .orderBy(F.desc("score_riesgo"), F.desc("monto_ars"), "id_cliente"))


def client_card(clients: DataFrame, client: Column | str) -> DataFrame:
    return clients.where(F.col("id_cliente") == client)


def client_daily(facts: DataFrame, client: Column | str) -> DataFrame:
    """A client's trades per day and side."""
    return (facts.where(F.col("id_cliente") == client).groupBy("fecha", "tipo_tran").agg(_operations())
            .orderBy("fecha", "tipo_tran"))


def client_trades(facts: DataFrame, client: Column | str) -> DataFrame:
    return (facts.where(F.col("id_cliente") == client).orderBy("fecha_art", "id_transaccion")
            .select("fecha_art", "canal", "tipo_tran", "simbolo_titulo", "cantidad", "precio", "monto_ars",
                    "flag_precio_fuera_mercado"))


def fx_line(calendar_export: DataFrame, upto: int) -> DataFrame:
    return (calendar_export.where(F.col("fecha_num") <= upto).select("fecha", "fuente_tc", "tc_ars_por_usd")
            .orderBy("fecha"))


def holiday_list(calendar_export: DataFrame, upto: int) -> DataFrame:
    named = F.col("feriado").isNotNull() & (F.col("feriado") != "")
    return (calendar_export.where(named & (F.col("fecha_num") <= upto)).select("fecha", "dia_semana", "feriado")
            .orderBy("fecha"))


def cumulative_share(clients: DataFrame) -> DataFrame:
    """Dense rank by amount and share of the total held up to that rank, ties included. The clients are moved once."""
    run = running_total_with_ties(clients.select("id_cliente", "monto_ars"), "id_cliente", "monto_ars", "rank_cliente_monto", "_held")
    return run.select("id_cliente", "rank_cliente_monto", ratio(F.col("_held"), F.col("_held_total"), 6).alias("pct_acumulado_monto"))
