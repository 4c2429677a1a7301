"""Exploration and data quality of the typed trades."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.functions.exprs import (
    count_where, day_text, family, in_market, iso_weekday, pct, ratio, rounded, sum_where, weekday_label)
from tradewarden.operators.joins import join_same
from tradewarden.operators.ranking import percentiles, top_shares
from tradewarden.operators.spine import date_spine
from tradewarden.params import ARS, BUY, DOLLAR_TICKER, USD, Params

def n_ops() -> Column:
    return F.count("*").alias("ops")


def total(rows: DataFrame, measure: str) -> Column:
    """The sum over all rows as a scalar subquery, to take shares of; no window sees the rows."""
    return rows.agg(F.sum(measure)).scalar()


def added(measure: str = "ops", cond: Column | None = None) -> Column:
    """The sum of a measure over cells, zero where none qualifies."""
    value = F.col(measure) if cond is None else F.when(cond, F.col(measure))
    return F.coalesce(F.sum(value), F.lit(0))


def _counted(cells: DataFrame, *keys: Column | str, **more: Column) -> DataFrame:
    """ops per key, further aggregates, and the share of all operations."""
    rows = cells.groupBy(*keys).agg(F.sum("ops").alias("ops"), *[c.alias(n) for n, c in more.items()])
    return rows.withColumn("pct_ops", pct(F.col("ops"), total(cells, "ops")))


def overview(trades: DataFrame, clients: DataFrame) -> DataFrame:
    """One row. Symbols, descriptions and days are counted among their few cells, clients among the client cells, so that
    no trade row is repeated per distinct count."""
    day = F.to_date("fecha_utc").alias("dia")
    cells = trades.groupBy("simbolo_titulo", "descripcion_titulo", day).agg(
        n_ops(), F.min("fecha_utc").alias("lo"), F.max("fecha_utc").alias("hi"))
    rows = cells.agg(
        F.coalesce(F.sum("ops"), F.lit(0)).alias("operaciones"),
        F.countDistinct("simbolo_titulo").alias("simbolos"), F.countDistinct("descripcion_titulo").alias("descripciones"),
        F.min("lo").alias("primera_op_utc"), F.max("hi").alias("ultima_op_utc"),
        F.countDistinct("dia").alias("dias_con_actividad_utc")).withColumn(
        "clientes_unicos", clients.agg(F.countDistinct("id_cliente")).scalar())
    return rows.select("operaciones", "clientes_unicos", "simbolos", "descripciones", "primera_op_utc", "ultima_op_utc",
                       "dias_con_actividad_utc", ratio(F.col("operaciones"), F.col("clientes_unicos"), 2).alias("ops_por_cliente_prom"))


def dq_counts(trades: DataFrame) -> DataFrame:
    def blank(c: str) -> Column:
        return count_where(F.col(c).isNull() | (F.col(c) == ""))

    return trades.agg(
        blank("id_cliente").alias("cliente_vacio"),
        blank("simbolo_titulo").alias("simbolo_vacio"),
        count_where(F.col("cantidad") <= 0).alias("cantidad_no_positiva"),
        count_where(F.col("precio") <= 0).alias("precio_no_positivo"),
        (F.count("*") - F.countDistinct("id_transaccion")).alias("id_transaccion_duplicado"))


def dq_logical_dupes(trades: DataFrame) -> DataFrame:
    same = trades.groupBy("id_cliente", "fecha_utc", "simbolo_titulo", "cantidad", "precio", "tipo_tran").agg(n_ops())
    return same.where(F.col("ops") > 1).agg(
        F.count("*").alias("grupos_duplicados"),
        F.coalesce(F.sum("ops"), F.lit(0)).alias("operaciones_involucradas"))


def ms_flag_by_channel(trades: DataFrame) -> DataFrame:
    return trades.groupBy("origen", "ms_flag").agg(n_ops()).orderBy("origen", "ms_flag")


def instrument_cells(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts per key and description. Text under min or max would make Spark sort its input, so the
    trades are counted by hash first and text is only compared among these few cells."""
    return rows.groupBy(*keys, "descripcion_titulo").agg(n_ops())


def symbol_controls(trades: DataFrame) -> DataFrame:
    """Three controls in one pass, listed one per row."""
    in_pesos = F.col("simbolo_titulo").rlike(DOLLAR_TICKER) & (F.col("moneda") == ARS)
    symbols = instrument_cells(trades, "simbolo_titulo", "moneda").groupBy("simbolo_titulo").agg(
        F.countDistinct("descripcion_titulo").alias("d"), F.countDistinct("moneda").alias("m"),
        sum_where(in_pesos, F.col("ops")).alias("p"))
    found = symbols.agg(count_where(F.col("d") > 1).alias("d"), count_where(F.col("m") > 1).alias("m"),
                        F.coalesce(F.sum("p"), F.lit(0)).alias("p"))
    return found.select(F.explode(F.array(
        F.struct(F.lit("simbolos_con_>1_descripcion").alias("control"), F.col("d").alias("casos")),
        F.struct(F.lit("simbolos_operados_en_ARS_y_USD").alias("control"), F.col("m").alias("casos")),
        F.struct(F.lit("ticker_termina_en_D_pero_moneda_ARS").alias("control"), F.col("p").alias("casos")),
    )).alias("r")).select("r.*")


def rows_of(trades: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """The trades of the k groups of a top-k list; k rows are broadcast."""
    return join_same(trades, F.broadcast(top.select(*keys)), keys, "left_semi")


def top_instruments(trades: DataFrame, cells: DataFrame, k: int = 15) -> DataFrame:
    """The k instruments are found by count alone; distinct clients are then counted for those only."""
    keys = ["simbolo_titulo", "moneda"]
    top = (instrument_cells(trades, *keys).groupBy(*keys)
           .agg(F.sum("ops").alias("ops"), F.min("descripcion_titulo").alias("descripcion"))
           .orderBy(F.desc("ops"), *keys).limit(k))
    clients = rows_of(trades, top, keys).groupBy(*keys).agg(F.countDistinct("id_cliente").alias("clientes"))
    return (join_same(clients, F.broadcast(top.select(*keys, "ops", "descripcion")), keys)
            .orderBy(F.desc("ops"), *keys)
            .select("simbolo_titulo", "descripcion", "moneda", "ops", pct(F.col("ops"), total(cells, "ops")).alias("pct_ops"),
                    "clientes"))


def instrument_families(trades: DataFrame, cells: DataFrame) -> DataFrame:
    # the class depends on the instrument alone: classify instruments, not trades
    instruments = instrument_cells(trades, "simbolo_titulo")
    kind = family(F.col("descripcion_titulo"), F.col("simbolo_titulo"), corporate=True)
    return (instruments.groupBy(kind.alias("familia")).agg(F.sum("ops").alias("ops"))
            .withColumn("pct_ops", pct(F.col("ops"), total(cells, "ops"))).orderBy(F.desc("ops"), "familia"))


def by_channel(clients: DataFrame) -> DataFrame:
    """From the client cells."""
    return (_counted(clients, "origen", clientes=F.countDistinct("id_cliente"))
            .select("origen", "ops", "pct_ops", "clientes",
                    ratio(F.col("ops"), F.col("clientes"), 2).alias("ops_por_cliente"))
            .orderBy(F.desc("ops"), "origen"))


def by_currency(cells: DataFrame) -> DataFrame:
    return (_counted(cells, "moneda", monto_total_moneda_original=F.round(F.sum("monto"), 0))
            .select("moneda", "ops", "pct_ops", "monto_total_moneda_original").orderBy(F.desc("ops"), "moneda"))


def by_side(cells: DataFrame) -> DataFrame:
    return _counted(cells, "tipo_tran").orderBy(F.desc("ops"), "tipo_tran")


def part_of_ops(cond: Column, digits: int = 1) -> Column:
    """The percentage of a group's trades in cells that fulfil a condition."""
    return pct(added("ops", cond), F.sum("ops"), digits)


def channel_mix(cells: DataFrame) -> DataFrame:
    return (cells.groupBy("origen").agg(part_of_ops(F.col("tipo_tran") == BUY).alias("pct_compra"),
                                        part_of_ops(F.col("moneda") == USD).alias("pct_usd")).orderBy("origen"))


def amount_percentiles(trades: DataFrame) -> DataFrame:
    marks = percentiles(trades, ["moneda"], "monto", {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999})
    ends = trades.groupBy("moneda").agg(F.min("monto").alias("lo"), F.max("monto").alias("hi"))
    return (ends.join(marks, "moneda").select(
        "moneda", F.round("lo", 2).alias("minimo"),
        *[rounded(F.col(p), 2).alias(p) for p in ("p50", "p90", "p99", "p999")],
        F.round("hi", 2).alias("maximo"),
        rounded(F.col("hi").cast("double") / F.nullif(F.col("p50"), F.lit(0.0)), 0).alias("max_sobre_mediana"))
        .orderBy("moneda"))


def largest_quantity(trades: DataFrame, k: int = 10) -> DataFrame:
    return (trades.orderBy(F.desc("cantidad"), "id_transaccion").limit(k)
            .select("fecha_utc", "id_cliente", "origen", "simbolo_titulo", "moneda", "cantidad", "precio",
                    F.round("monto", 2).alias("monto")))


def ops_per_client(clients: DataFrame) -> DataFrame:
    """From the client cells."""
    return clients.groupBy("id_cliente").agg(F.sum("ops").alias("ops"))


# Upper bounds and labels of the activity buckets; the last has no bound.
ACTIVITY_BUCKETS = ((1, "01) 1"), (2, "02) 2"), (5, "03) 3-5"), (10, "04) 6-10"), (50, "05) 11-50"),
                    (100, "06) 51-100"), (None, "07) >100"))


def bucket(ops: Column, buckets: tuple) -> Column:
    bounded = [(b, label) for b, label in buckets if b is not None]
    case = reduce(lambda c, b: c.when(ops <= b[0], b[1]), bounded[1:], F.when(ops <= bounded[0][0], bounded[0][1]))
    return case.otherwise(buckets[-1][1])


def activity_buckets(clients: DataFrame) -> DataFrame:
    rows = (ops_per_client(clients).groupBy(bucket(F.col("ops"), ACTIVITY_BUCKETS).alias("tramo_ops"))
            .agg(F.count("*").alias("clientes"), F.sum("ops").alias("ops")))
    return rows.select("tramo_ops", "clientes", pct(F.col("clientes"), total(rows, "clientes")).alias("pct_clientes"), "ops",
                       pct(F.col("ops"), total(rows, "ops")).alias("pct_ops")).orderBy("tramo_ops")


def concentration_curve(clients: DataFrame, p: Params) -> DataFrame:
    """From the client cells."""
    amounts = clients.groupBy("id_cliente").agg(F.sum("ops").alias("ops"), F.sum("monto_en_ars").alias("monto_ars"))
    return top_shares(amounts, {"pct_ops": "ops", "pct_monto_ars": "monto_ars"}, p.concentration_cuts).orderBy("corte")


def top_clients(trades: DataFrame, clients: DataFrame, k: int = 10) -> DataFrame:
    """Found, counted and summed in the client cells; only symbols and days come from the trades of the k clients, cut to cells on the
    map side before they are told apart."""
    top = ops_per_client(clients).orderBy(F.desc("ops"), "id_cliente").limit(k)
    rows = rows_of(trades, top, ["id_cliente"])
    channels = (rows_of(clients, top, ["id_cliente"]).groupBy("id_cliente")
                .agg(F.countDistinct("origen").alias("canales"), F.min("origen").alias("canal"),
                     F.sum("monto_en_ars").alias("m")))
    spread = rows.groupBy("id_cliente", "simbolo_titulo", "dia_art").agg(n_ops()).groupBy("id_cliente").agg(
        F.sum("ops").alias("ops"), F.countDistinct("simbolo_titulo").alias("simbolos"), F.countDistinct("dia_art").alias("dias_activos"))
    return (join_same(channels, spread, ["id_cliente"]).orderBy(F.desc("ops"), "id_cliente")
            .select("id_cliente", "ops", "canales", "canal", "simbolos", "dias_activos", F.round("m", 0).alias("monto_ars")))


def by_weekday(cells: DataFrame) -> DataFrame:
    return (_counted(cells, "dow_art").select("dow_art", weekday_label(F.col("dow_art")).alias("dia"), "ops", "pct_ops")
            .orderBy("dow_art"))


def by_hour(cells: DataFrame) -> DataFrame:
    return (_counted(cells, "hora_art")
            .withColumn("franja", F.when(in_market(F.col("hora_art")), "mercado").otherwise("fuera")).orderBy("hora_art"))


def _off_market() -> Column:
    return ~in_market(F.col("hora_art"))


def atypical_bands(cells: DataFrame) -> DataFrame:
    weekend = F.col("dow_art").isin(6, 7)
    return cells.agg(
        part_of_ops(_off_market(), 2).alias("pct_fuera_horario_mercado"),
        part_of_ops(F.col("hora_art") < 6, 2).alias("pct_madrugada_0a6"),
        part_of_ops(weekend, 2).alias("pct_fin_de_semana"),
        added("ops", weekend).alias("ops_fin_de_semana"))


def off_hours_by_channel(cells: DataFrame) -> DataFrame:
    return (cells.groupBy("origen").agg(
        part_of_ops(_off_market()).alias("pct_fuera_horario"),
        part_of_ops(F.col("dow_art") == 6).alias("pct_sabado")).orderBy("origen"))


def daily_window(trades: DataFrame, start: date, end: date) -> DataFrame:
    """First and last time of each UTC day. The filters are on plain columns, so they reach the scan; the
    one on the local day, a day wider on both sides, prunes trades stored by day."""
    upto = F.date_add(F.lit(end), 1).cast("timestamp_ntz")
    in_range = (F.col("fecha_utc") >= F.lit(start).cast("timestamp_ntz")) & (F.col("fecha_utc") < upto)
    near = F.col("dia_art").between(F.date_sub(F.lit(start), 1), F.date_add(F.lit(end), 1))
    return (trades.where(in_range & near).groupBy(F.to_date("fecha_utc").alias("dia_utc"))
            .agg(n_ops(), F.min("fecha_utc").alias("lo"), F.max("fecha_utc").alias("hi"),
                 count_where(F.hour("fecha_utc") < 10).alias("ops_antes_10utc"))
            .select("dia_utc", day_text(F.col("dia_utc")).alias("dow"), "ops",
                    F.date_format("lo", "HH:mm").alias("primera_utc"), F.date_format("hi", "HH:mm").alias("ultima_utc"),
                    "ops_antes_10utc").orderBy("dia_utc"))


def days_without_activity(trades: DataFrame, start: Column, end: Column) -> DataFrame:
    """Days of the range, Sundays left out, on which nobody traded. start and end are expressions
    over the aggregated trades, or literals."""
    active = trades.select(F.to_date("fecha_utc").alias("dia")).distinct()
    spine = date_spine(active.agg(F.min("dia").alias("primero"), F.max("dia").alias("ultimo")), start, end, "dia")
    return (spine.where(iso_weekday(F.col("dia")) != 7).join(active, "dia", "left_anti")
            .select("dia", day_text(F.col("dia")).alias("dow")).orderBy("dia"))
