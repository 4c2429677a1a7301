"""The four anomaly patterns and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.functions.exprs import (
    RATE, binomial_z, count_where, exact, is_option, millions, pct, ratio, times_units)
from tradewarden.operators.joins import bucket_layout, keyed_join
from tradewarden.operators.ranking import medians_by_group, running_total
from tradewarden.params import (
    BAND_MARKET, CHANGE_ABRUPT, CHANGE_NO_HISTORY, OPTION_TICKER, USD, Params)
from tradewarden.plans.explore import added, n_ops, part_of_ops, total
from tradewarden.plans.profile import at_night, limit, off_business

# ---- P1: unusually high activity


def often(limits: DataFrame) -> Column:
    return F.col("ops") >= limit(limits, "p999_ops")


def heavy(limits: DataFrame) -> Column:
    return F.col("monto_ars").cast("double") >= limit(limits, "p999_monto_cliente")


def p1_high_activity(profile: DataFrame, limits: DataFrame) -> DataFrame:
    median = exact(limit(limits, "p50_monto_cliente"), 4)
    return (profile.withColumns({"por_frecuencia": often(limits), "por_monto": heavy(limits)})
            .where("por_frecuencia OR por_monto")
            .select(*profile.columns, ratio(F.col("monto_ars"), median, 0).alias("veces_mediana_monto"),
                    "por_frecuencia", "por_monto"))


def p1_summary(p1: DataFrame, profile: DataFrame) -> DataFrame:
    everyone = profile.agg(F.struct(F.sum("ops").alias("ops"), F.sum("monto_ars").alias("monto"))).scalar()
    return p1.agg(F.count("*").alias("clientes"), count_where(F.col("por_frecuencia")).alias("por_frecuencia"),
                  count_where(F.col("por_monto")).alias("por_monto"),
                  count_where(F.col("por_frecuencia") & F.col("por_monto")).alias("ambos"),
                  F.sum("ops").alias("_o"), F.sum("monto_ars").alias("_m")).select(
        "clientes", "por_frecuencia", "por_monto", "ambos",
        pct(F.col("_o"), everyone.getField("ops")).alias("pct_ops_total"),
        pct(F.col("_m"), everyone.getField("monto")).alias("pct_monto_total"))


def p1_top_amount(p1: DataFrame, k: int = 15) -> DataFrame:
    return p1.orderBy(F.desc("monto_ars"), "id_cliente").limit(k).select(
        "id_cliente", "canal_principal", "ops", "dias_activos", "simbolos", "simbolo_principal",
        millions(F.col("monto_ars")).alias("monto_ars_mill"), "veces_mediana_monto", "pct_compras")


def p1_top_frequency(p1: DataFrame, k: int = 10) -> DataFrame:
    return p1.orderBy(F.desc("ops"), "id_cliente").limit(k).select(
        "id_cliente", "canal_principal", "ops", "dias_activos",
        ratio(F.col("ops"), F.col("dias_activos"), 1).alias("ops_por_dia"), "simbolos", "simbolo_principal",
        millions(F.col("monto_ars")).alias("monto_ars_mill"))


def p1_channel_lift(clients: DataFrame, p1: DataFrame) -> DataFrame:
    """Channel shares of the flagged clients against everybody's, from the rated client cells."""
    flagged = p1.select("id_cliente", F.lit(True).alias("_in"))
    rows = (clients.join(flagged, "id_cliente", "left").groupBy("origen")
            .agg(added("ops", F.col("_in")).alias("top"), F.sum("ops").alias("todos")))
    return (rows.select("origen", pct(F.col("top"), total(p1, "ops"), 1).alias("pct_ops_top01"),
                        pct(F.col("todos"), total(clients, "ops"), 1).alias("pct_ops_poblacion"))
            .orderBy(F.desc("pct_ops_top01"), "origen"))


def p1_instruments(enriched: DataFrame, p1: DataFrame, k: int = 10) -> DataFrame:
    """Instruments of the clients with high activity. These are the hottest clients there are, so their trades are picked
    by the join that splits hot keys, and then cut to cells on the map side."""
    trades = keyed_join(enriched, p1.select("id_cliente", "ops"), ["id_cliente"], "ops", "id_transaccion", "left_semi")
    cells = trades.groupBy("id_cliente", "simbolo_titulo", "descripcion_titulo").agg(n_ops(), F.sum("monto_ars").alias("m"))
    return (cells.groupBy("simbolo_titulo")
            .agg(F.min("descripcion_titulo").alias("descripcion"), F.sum("ops").alias("ops"),
                 F.countDistinct("id_cliente").alias("clientes_top01"), F.sum("m").alias("m"))
            .orderBy(F.desc("m"), "simbolo_titulo").limit(k)
            .select("simbolo_titulo", "descripcion", "ops", "clientes_top01",
                    millions(F.col("m")).alias("monto_ars_mill")))


def extreme(limits: DataFrame, amount: str = "monto_ars") -> Column:
    return F.col(amount).cast("double") >= limit(limits, "p999_monto_op")


def extreme_trades_by_channel(enriched: DataFrame, limits: DataFrame) -> DataFrame:
    return (enriched.where(extreme(limits)).groupBy("origen")
            .agg(F.count("*").alias("ops_extremas"), F.countDistinct("id_cliente").alias("clientes"),
                 millions(F.sum("monto_ars")).alias("monto_ars_mill"))
            .orderBy(F.desc("ops_extremas"), "origen"))


# ---- P2: unusual hours and days


def nonbusiness_concentration(clients: DataFrame) -> DataFrame:
    """How much of the non-business trading the 10 and the 100 most active clients explain, from the rated client cells.
    Clients with equal counts are interchangeable, so ranks run over the histogram of counts."""
    active = clients.where(off_business()).groupBy("id_cliente").agg(F.sum("ops").alias("n"))
    hist = active.groupBy("n").agg(F.count("*").alias("c"))
    run = running_total(hist, ["-n"], {"antes": "c"})

    def held(k: int) -> Column:
        taken = F.least(F.col("c"), F.greatest(F.lit(0), F.lit(k) - F.col("antes")))
        return pct(F.sum(F.col("n") * taken), F.sum(F.col("n") * F.col("c")))

    return run.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("clientes_con_ops_inhabil"),
                   F.sum(F.col("n") * F.col("c")).alias("ops_inhabil"),
                   held(10).alias("pct_explicado_top10_clientes"), held(100).alias("pct_explicado_top100_clientes"))


def bands_by_channel(cells: DataFrame) -> DataFrame:
    return cells.groupBy("origen").agg(
        part_of_ops(at_night()).alias("pct_madrugada"), part_of_ops(F.col("franja_horaria") == BAND_MARKET).alias("pct_mercado"),
        part_of_ops(off_business()).alias("pct_dia_inhabil")).orderBy("origen")


def weekday_time_span(cells: DataFrame) -> DataFrame:
    """First and last minute of the day per UTC weekday, as numbers until the seven rows are there. A cell lies within
    one UTC day, so its first and last time are its first and last minute."""
    def minute(c: str) -> Column:
        return F.hour(c) * 60 + F.minute(c)

    rows = cells.groupBy((F.weekday("dia_utc") + 1).alias("d")).agg(
        F.min(minute("primera_utc")).alias("lo"), F.max(minute("ultima_utc")).alias("hi"), F.sum("ops").alias("ops"))

    def clock(m: str) -> Column:
        return F.format_string("%02d:%02d", F.floor(F.col(m) / 60), F.pmod(F.col(m), F.lit(60)))

    # 2024-01-01 was a Monday
    name = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("d") - 1), "E")
    return rows.select(F.concat_ws(" ", F.col("d").cast("string"), name).alias("dia_semana_utc"), clock("lo").alias("hora_min"),
                       clock("hi").alias("hora_max"), "ops").orderBy("dia_semana_utc")


def p2_atypical_hours(profile: DataFrame, limits: DataFrame, p: Params) -> DataFrame:
    """Clients with enough trades, each with its distance from the population's hours and days."""
    return profile.where(F.col("ops") >= p.p2_min_ops).select(
        "id_cliente", "canal_principal", "ops", "ops_madrugada", "ops_dia_inhabil",
        binomial_z(F.col("ops_madrugada"), F.col("ops"), limit(limits, "base_madrugada")).alias("z_madrugada"),
        binomial_z(F.col("ops_dia_inhabil"), F.col("ops"), limit(limits, "base_inhabil")).alias("z_inhabil"),
        millions(F.col("monto_ars"), 2).alias("monto_ars_mill"))


def _deviates(col: str, p: Params) -> Column:
    return F.col(col) >= F.lit(p.p2_z).cast("decimal(9,4)")


def p2_summary(p2: DataFrame, p: Params) -> DataFrame:
    return p2.agg(F.count("*").alias("clientes_evaluados_10mas_ops"),
                  count_where(_deviates("z_madrugada", p)).alias("z_madrugada_3"),
                  count_where(_deviates("z_inhabil", p)).alias("z_inhabil_3"),
                  F.round(F.count("*").cast("decimal(20,0)") * F.lit(p.p2_chance), 1).alias("esperados_por_azar_cada_uno"))


def p2_list(p2: DataFrame, p: Params) -> DataFrame:
    return (p2.where(_deviates("z_madrugada", p) | _deviates("z_inhabil", p))
            .orderBy(F.greatest("z_madrugada", "z_inhabil").desc(), "id_cliente")
            .select("id_cliente", "canal_principal", "ops", "ops_madrugada", "z_madrugada", "ops_dia_inhabil",
                    "z_inhabil", "monto_ars_mill"))


# ---- P3: abrupt change of behaviour


def behaviour_columns(profile: DataFrame, days: DataFrame, p: Params) -> DataFrame:
    """Rates, multiples and flags of the follow-up period against the base period."""
    d = days.select(F.struct("dh_ene", "dh_feb_mar")).scalar()
    base_days, next_days = d.getField("dh_ene"), d.getField("dh_feb_mar")
    ops_next, ops_base = F.col("ops_feb") + F.col("ops_mar"), F.col("ops_ene")
    money_next, money_base = F.col("monto_feb_mar"), F.col("monto_ene")
    multiple = ratio(ops_next * base_days, next_days * F.greatest(ops_base, F.lit(1)), 1)
    large = money_next >= p.p3_min_amount
    grown = money_next >= money_base * p.p3_amount_ratio
    return (profile.withColumns({
        "ops_feb_mar": ops_next,
        "tasa_ene": ratio(ops_base, base_days, 3),
        "tasa_feb_mar": ratio(ops_next, next_days, 3),
        "multiplicador_frecuencia": multiple,
        "multiplicador_monto": F.when(money_base > 0, ratio(money_next, money_base, 1)),
    }).withColumns({
        "por_frecuencia": (ops_base <= p.p3_few_ops) & (ops_next >= p.p3_many_ops)
        & F.coalesce(F.col("multiplicador_frecuencia") >= p.p3_rate_ratio, F.lit(False)),
        "por_monto": (ops_base > 0) & large & grown,
        "sin_actividad_en_enero": ops_base == 0,
    }).withColumn("tipo_cambio", F.when(F.col("por_frecuencia") | F.col("por_monto"), CHANGE_ABRUPT)
                  .when(large & F.col("sin_actividad_en_enero"), CHANGE_NO_HISTORY)))


def p3_behaviour_change(profile: DataFrame, days: DataFrame, p: Params) -> DataFrame:
    return behaviour_columns(profile, days, p).where(F.col("tipo_cambio").isNotNull())


def p3_summary(p3: DataFrame) -> DataFrame:
    return p3.groupBy("tipo_cambio").agg(
        F.count("*").alias("clientes"), count_where(F.col("por_frecuencia")).alias("por_frecuencia"),
        count_where(F.col("por_monto")).alias("por_monto_con_historia"),
        count_where(F.col("sin_actividad_en_enero")).alias("sin_actividad_enero"),
        millions(F.sum("monto_feb_mar")).alias("monto_feb_mar_mill")).orderBy("tipo_cambio")


def _in_millions(*cols: str) -> list[Column]:
    return [millions(F.col(c), 2).alias(f"{c}_mill") for c in cols]


def p3_top_frequency(p3: DataFrame, k: int = 15) -> DataFrame:
    return (p3.where("por_frecuencia")
            .orderBy(F.desc("multiplicador_frecuencia"), F.desc("ops_feb_mar"), "id_cliente").limit(k)
            .select("id_cliente", "canal_principal", "ops_ene", "ops_feb", "ops_mar", "multiplicador_frecuencia",
                    *_in_millions("monto_ene", "monto_feb_mar"), "simbolo_principal"))


def p3_top_amount(p3: DataFrame, k: int = 15) -> DataFrame:
    wanted = F.col("por_monto") | (F.col("sin_actividad_en_enero") & ~F.col("por_frecuencia"))
    return (p3.where(wanted).orderBy(F.desc("monto_feb_mar"), "id_cliente").limit(k)
            .select("id_cliente", "canal_principal", "ops_ene", "ops_feb_mar",
                    *_in_millions("monto_ene", "monto_feb_mar"),
                    F.coalesce(F.col("multiplicador_monto").cast("decimal(30,1)").cast("string"), F.lit("nuevo"))
                    .alias("multiplicador_monto"), "simbolo_principal"))


# ---- P4: prices off the market


def reference_prices(enriched: DataFrame, p: Params) -> DataFrame:
    """Median price and trade count per (symbol, day) with enough trades. Option tickers are never
    judged, so they are left out before the shuffle. Prices have six decimals, their medians seven."""
    medians = medians_by_group(enriched.where(~F.col("simbolo_titulo").rlike(OPTION_TICKER)),
                               ["simbolo_titulo", "dia_art"], "precio", "mediana", size_as="ops_referencia", least=p.p4_min_refs)
    return medians.select("simbolo_titulo", "dia_art", "mediana", "ops_referencia")


def off_market(p: Params) -> Column:
    price, median = F.col("precio"), F.col("mediana")
    return ((~is_option(F.col("descripcion_titulo"), F.col("simbolo_titulo")))
            & ((price < median * F.lit(p.p4_low)) | (price > median * F.lit(p.p4_high))))


def price_ratio() -> Column:
    return F.round(F.col("precio") / F.col("mediana"), 4)


def market_value() -> Column:
    """Quantity at the day's median, in ARS, rounded once."""
    rate = F.when(F.col("moneda") == USD, F.col("tc_ars_por_usd")).otherwise(F.lit(1).cast(RATE))
    return times_units(F.col("cantidad"), (F.col("mediana") * rate).cast("decimal(33,11)"), 2)


PRICE_KEYS = ("simbolo_titulo", "dia_art")


def priced_trades(enriched: DataFrame, references: DataFrame, n_references: int | None = None) -> DataFrame:
    """The trades with the reference price of their symbol and day, NULL where there is none."""
    return keyed_join(enriched, references, PRICE_KEYS, "ops_referencia", "id_transaccion", "left", keyed_rows=n_references)


def price_layout(trades: DataFrame, references: DataFrame) -> DataFrame:
    """Trades as they are stored to meet their reference prices in place; options never meet one."""
    free = F.col("simbolo_titulo").rlike(OPTION_TICKER)
    return bucket_layout(trades, references, PRICE_KEYS, "ops_referencia", "id_transaccion", free)


def p4_off_market_price(enriched: DataFrame, references: DataFrame, p: Params) -> DataFrame:
    """Trades below half or above twice the day's median of their instrument."""
    return off_market_trades(priced_trades(enriched, references), p)


def off_market_trades(priced: DataFrame, p: Params) -> DataFrame:
    return priced.where(F.col("mediana").isNotNull() & off_market(p)).select(
        "id_transaccion", "id_cliente", "fecha_art", "origen", "tipo_tran", "simbolo_titulo", "descripcion_titulo",
        "moneda", "cantidad", "precio", F.round("mediana", 4).alias("precio_mediana_dia"), "ops_referencia",
        price_ratio().alias("ratio_vs_mercado"), "monto_ars",
        market_value().alias("monto_ars_a_precio_mercado"))


def value_gap() -> Column:
    return F.col("monto_ars_a_precio_mercado") - F.col("monto_ars")


def p4_summary(p4: DataFrame) -> DataFrame:
    return p4.agg(F.count("*").alias("operaciones"), F.countDistinct("id_cliente").alias("clientes"),
                  millions(F.sum(F.abs(value_gap()))).alias("diferencia_valor_ars_mill"))


def _by_gap(p4: DataFrame) -> DataFrame:
    return p4.orderBy(F.abs(value_gap()).desc(), "id_transaccion", "id_cliente", "fecha_art", "precio")


def p4_detail(p4: DataFrame, k: int = 20) -> DataFrame:
    return _by_gap(p4).limit(k).select(
        "id_cliente", "origen", F.to_date("fecha_art").alias("dia"), "tipo_tran", "simbolo_titulo", "cantidad", "precio",
        "precio_mediana_dia", "ratio_vs_mercado", millions(value_gap(), 2).alias("diferencia_ars_mill"))


def p4_export(p4: DataFrame) -> DataFrame:
    return _by_gap(p4).select(
        "id_cliente", F.to_date("fecha_art").alias("fecha"), F.col("origen").alias("canal"), "tipo_tran",
        "simbolo_titulo", "cantidad", "precio", "precio_mediana_dia", "ratio_vs_mercado",
        millions(value_gap(), 2).alias("diferencia_ars_mill"))


def p4_by_channel(p4: DataFrame) -> DataFrame:
    placeholder = F.round("precio", 2).isin(0.01, 1.0)
    return (p4.groupBy("origen").agg(n_ops(), F.countDistinct("id_cliente").alias("clientes"),
                                     count_where(placeholder).alias("precio_placeholder_001_o_1"))
            .orderBy(F.desc("ops"), "origen"))
