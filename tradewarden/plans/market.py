"""Calendar, daily rate and the enriched trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.functions.exprs import RATE, count_where, day_type, hour_band, iso_weekday, millions, pct, ratio, rounded
from tradewarden.operators.ranking import percentiles_by_group
from tradewarden.operators.spine import date_spine, join_days, last_known
from tradewarden.params import ARS, FX_IMPLIED_LABEL, USD, Params
from tradewarden.plans.explore import total


def api_log_report(log: DataFrame, p: Params = Params()) -> DataFrame:
    return (log.orderBy("ts_utc", "api", "url")
            .select("api", "estado", "filas", F.substring("detalle", 1, p.report_detail).alias("detalle")))


def _day_bounds(trades: DataFrame) -> DataFrame:
    return trades.agg(F.min("dia_art").alias("primero"), F.max("dia_art").alias("ultimo"))


def _or_else(fixed, derived: Column) -> Column:
    return derived if fixed is None else F.lit(fixed)


def business_calendar(trades: DataFrame, holidays: DataFrame, p: Params) -> DataFrame:
    """Every day of the range with weekday, holiday name and whether it is a business day."""
    start = _or_else(p.calendar_start, F.date_sub("primero", p.calendar_margin_days))
    end = _or_else(p.calendar_end, F.date_add("ultimo", p.calendar_margin_days))
    dow = iso_weekday(F.col("fecha"))
    named = holidays.select("fecha", F.col("nombre").alias("feriado"), F.lit(True).alias("_off"))
    return (date_spine(_day_bounds(trades), start, end).join(named, "fecha", "left")
            .select("fecha", dow.alias("dow"), "feriado", ((dow < 6) & F.col("_off").isNull()).alias("es_habil")))


def holidays_with_activity(calendar: DataFrame, cells: DataFrame, first: Column, last: Column) -> DataFrame:
    active = cells.groupBy(F.col("dia_art").alias("fecha")).agg(F.sum("ops").alias("n"))
    return (calendar.where(F.col("feriado").isNotNull() & F.col("fecha").between(first, last))
            .join(active, "fecha", "left")
            .select("fecha", "feriado", F.coalesce("n", F.lit(0)).alias("ops_ese_dia")).orderBy("fecha"))


def implied_fx(trades: DataFrame, p: Params) -> DataFrame:
    """Rate implied per day by one bond that trades in both currencies."""
    ars, usd = p.fx_ars_ticker, p.fx_usd_ticker
    both = trades.where(F.col("simbolo_titulo").isin(ars, usd))
    is_ars, is_usd = F.col("simbolo_titulo") == ars, F.col("simbolo_titulo") == usd
    priced = both.where((is_ars & (F.col("moneda") == ARS)) | (is_usd & (F.col("moneda") == USD)))
    median = percentiles_by_group(priced, ["dia_art", "simbolo_titulo"], "precio", {"mediana": 0.5})
    counts = both.groupBy("dia_art").agg(count_where(is_ars).alias("n_ars"), count_where(is_usd).alias("n_usd"))
    prices = median.groupBy("dia_art").agg(
        F.max(F.when(is_ars, F.col("mediana"))).alias("en_ars"), F.max(F.when(is_usd, F.col("mediana"))).alias("en_usd"))
    enough = (F.col("n_ars") >= p.fx_min_trades) & (F.col("n_usd") >= p.fx_min_trades)
    return (counts.where(enough).join(prices, "dia_art", "left")
            .select(F.col("dia_art").alias("fecha"),
                    rounded(F.col("en_ars") / F.col("en_usd"), 2).cast(RATE).alias("mep_implicito"), "n_ars", "n_usd"))


def daily_fx(calendar: DataFrame, trades: DataFrame, quotes: DataFrame, implied: DataFrame, p: Params) -> DataFrame:
    """One rate per day: latest quote, else latest implied rate, else the first implied rate."""
    bounds = _day_bounds(trades)
    first = bounds.select(_or_else(p.fx_start, F.col("primero"))).scalar()
    last = bounds.select(_or_else(p.fx_end, F.date_add("ultimo", p.calendar_margin_days))).scalar()
    days = calendar.where(F.col("fecha").between(first, last)).select("fecha")
    known = last_known(days, quotes.select("fecha", F.col("venta").cast(RATE).alias("venta"), "fuente"), "fecha", "api")
    known = last_known(known, implied.select("fecha", "mep_implicito"), "fecha", "imp")
    rate = F.coalesce(F.col("api.venta"), F.col("imp.mep_implicito"))
    stale_api = F.col("api.fecha") != F.col("fecha")
    stale_implied = F.col("api.fecha").isNull() & (F.col("imp.fecha") != F.col("fecha"))
    label = F.when(F.col("api.venta").isNotNull(),
                   F.concat(F.lit("API MEP ("), F.col("api.fuente"), F.lit(")"))).otherwise(FX_IMPLIED_LABEL)
    earliest = implied.agg(F.min_by("mep_implicito", "fecha")).scalar()
    return known.select("fecha", F.coalesce(rate, earliest).alias("tc_ars_por_usd"), label.alias("fuente_tc"),
                        F.when(rate.isNull(), F.lit(True)).otherwise(stale_api | stale_implied).alias("arrastrado"))


def fx_summary(fx: DataFrame) -> DataFrame:
    rate = F.col("tc_ars_por_usd")
    return (fx.groupBy("fuente_tc").agg(
        F.count("*").alias("dias"), F.min(rate).alias("minimo"), F.max(rate).alias("maximo"),
        ratio(F.sum(rate), F.count(rate), 2).alias("promedio")).orderBy("fuente_tc"))


def fx_crosscheck(quotes: DataFrame, implied: DataFrame) -> DataFrame:
    api, imp = F.col("venta"), F.col("mep_implicito")
    return (quotes.join(implied, "fecha").select("fecha", api.alias("mep_api"), "mep_implicito",
                                                 pct(imp - api, api).alias("desvio_pct")).orderBy("fecha"))


def rated_days(fx: DataFrame, calendar: DataFrame) -> DataFrame:
    """What the trades of a day need to know about it; days without a rate row are left out."""
    return fx.select("fecha", "tc_ars_por_usd").join(calendar.select("fecha", "es_habil", "feriado"), "fecha")


def enriched_trades(trades: DataFrame, days: DataFrame, n_days: int | None = None) -> DataFrame:
    """Trades with rate, amount in ARS, day type, hour band and month.

    `days` has one row per calendar day, so this is a map-side join of the trades unless the calendar is
    very long: they need no shuffle and no second copy on disk. Trades on days without a rate row are
    dropped, see dropped_trades."""
    return rated_trades(trades, days, "inner", n_days)


def rated_trades(trades: DataFrame, days: DataFrame, how: str, n_days: int | None = None) -> DataFrame:
    joined = join_days(trades, days, trades["dia_art"] == days["fecha"], how, n_days)
    in_ars = F.when(F.col("moneda") == USD, F.round(F.col("monto") * F.col("tc_ars_por_usd"), 2)) \
        .otherwise(F.col("monto"))
    return joined.select(
        *[trades[c] for c in trades.columns], "tc_ars_por_usd", in_ars.cast("decimal(28,4)").alias("monto_ars"),
        "es_habil", "feriado", day_type(F.col("feriado"), F.col("dow_art")).alias("tipo_dia"),
        hour_band(F.col("hora_art")).alias("franja_horaria"), F.trunc("dia_art", "MM").alias("mes"))


def dropped_trades(trades: DataFrame, fx: DataFrame) -> DataFrame:
    """How many trades fall on days without a rate row, and on how many days."""
    lost = trades.groupBy(F.col("dia_art").alias("fecha")).agg(F.count("*").alias("n")).join(fx, "fecha", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ops_sin_tipo_de_cambio"), F.count("*").alias("dias"))


def by_day_type(clients: DataFrame) -> DataFrame:
    """From the rated client cells."""
    rows = clients.groupBy("tipo_dia").agg(F.sum("ops").alias("ops"), F.countDistinct("id_cliente").alias("clientes"),
                                           millions(F.sum("monto_ars")).alias("monto_ars_millones"))
    return (rows.select("tipo_dia", "ops", pct(F.col("ops"), total(clients, "ops")).alias("pct_ops"), "clientes", "monto_ars_millones")
            .orderBy(F.desc("ops"), "tipo_dia"))


def volume_by_currency_ars(cells: DataFrame) -> DataFrame:
    rows = cells.groupBy("moneda").agg(F.sum("ops").alias("ops"), F.sum("monto_ars").alias("m"))
    return rows.select("moneda", "ops", millions(F.col("m")).alias("monto_ars_millones"),
                       pct(F.col("m"), total(cells, "monto_ars")).alias("pct_monto")).orderBy("moneda")


def monthly_volume(cells: DataFrame) -> DataFrame:
    # per day first: the distinct business days of a month are then rows of this small table
    days = cells.groupBy("mes", "dia_art", "es_habil").agg(F.sum("ops").alias("ops"), F.sum("monto_ars").alias("m"))
    rows = days.groupBy("mes").agg(F.sum("ops").alias("ops"), count_where(F.col("es_habil")).alias("dias_habiles_con_ops"),
                                   millions(F.sum("m")).alias("monto_ars_millones"))
    return rows.withColumn("ops_por_dia_habil", ratio(F.col("ops"), F.col("dias_habiles_con_ops"), 0)).orderBy("mes")
