"""Maps the benchmark tables onto the trade model.

`events` has times of day and serves the exploration of hours and days; `lineitem` with `orders`
has clients, quantities and prices over years. Sides, currencies, tickers and clock times that the
tables lack follow fixed rules on their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.params import ARS, BUY, SELL, USD
from tradewarden.functions.exprs import MONEY, PRICE
from tradewarden.sources.external import HOLIDAY_PAYLOAD, QUOTE_PAYLOAD
from tradewarden.sources.raw import local_time_columns
from tradewarden.sources.storage import spread

# Fixed values: (upper bound of k, ticker prefix, description), k = instrument number modulo 100.
INSTRUMENTS = (
    (10, "AL30", "Bono Rep. Arg. Usd Step Up 2030"),
    (15, "AL30D", "Bono Rep. Arg. 2030 En Dolares"),
    (25, "GFGC", "Opcion Compra Galicia"),
    (40, "GD", "Global Rep. Arg. Ley NY"),
    (70, "CD", "Cedear Empresa Extranjera"),
    (80, "YMC", "Obligacion Negociable Ypf"),
    (90, "TZX", "Letra Ajustable"),
    (100, "ACC", "Accion Ordinaria Escritural"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_k(k: Column, pick: int) -> Column:
    expr = None
    for row in INSTRUMENTS:
        expr = F.when(k < row[0], row[pick]) if expr is None else expr.when(k < row[0], row[pick])
    return expr


def _instrument(number: Column) -> tuple[Column, Column]:
    """Ticker and description: two single, heavily traded tickers, the rest numbered."""
    k = F.pmod(number, F.lit(100))
    prefix = _by_k(k, 1)
    return F.when(k < 15, prefix).otherwise(F.concat(prefix, number.cast("string"))), _by_k(k, 2)


def event_trades(spark: SparkSession, sf_dir: str, zone: str) -> DataFrame:
    """One trade per event: user, kind as channel, value as price."""
    ticker, description = _instrument(F.get_json_object("props", "$.k").cast("long"))
    eid = F.col("event_id")
    price = F.col("value").cast("decimal(14,2)") * F.when(ticker == "AL30", F.lit(1000)).otherwise(F.lit(1))
    quantity = F.pmod(eid, F.lit(50)) + 1
    utc = F.col("ts").cast("timestamp_ntz")
    return spread(table(spark, sf_dir, "events")).select(
        eid.cast("string").alias("id_transaccion"),
        F.concat(F.lit("CLI"), F.col("user_id").cast("string")).alias("id_cliente"),
        utc.alias("fecha_utc"),
        *[c.alias(n) for n, c in local_time_columns(utc, zone).items()],
        F.when(F.pmod(eid, F.lit(10)) < 6, BUY).otherwise(SELL).alias("tipo_tran"),
        description.alias("descripcion_titulo"), ticker.alias("simbolo_titulo"),
        F.when((ticker == "AL30D") | (F.pmod(eid, F.lit(7)) == 0), USD).otherwise(ARS).alias("moneda"),
        F.col("event_type").alias("origen"),
        quantity.cast("long").alias("cantidad"),
        price.cast(PRICE).alias("precio"),
        (quantity.cast("decimal(10,0)") * price).cast(MONEY).alias("monto"),
        F.lpad(F.pmod(eid, F.lit(2)) * 10, 3, "0").alias("ms_flag"))


# Order lines that one task joins, turns to trades and sorts.
TASK_LINES = 500_000


def line_trades(spark: SparkSession, sf_dir: str, zone: str) -> DataFrame:
    """One trade per order line: customer, order priority as channel, part as instrument.

    Lines and orders meet in tasks of some TASK_LINES lines: a trade is many times as wide as its line when packed, so tasks of
    a number of bytes would hold too many of them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    tasks = lines.count() // TASK_LINES
    if tasks > spark.sparkContext.defaultParallelism:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    else:
        lines = spread(lines)
    ticker, description = _instrument(F.col("l_partkey"))
    second = F.pmod(F.col("l_orderkey") * 37 + F.col("l_partkey") * 11 + F.col("l_linenumber") * 3607, F.lit(86400))
    utc = F.timestamp_add("SECOND", second, F.col("l_shipdate").cast("timestamp_ntz"))
    scale = F.when(ticker == "AL30", F.lit(1000)).otherwise(F.lit(1))
    value = F.col("l_extendedprice").cast("decimal(14,2)") * scale
    units = F.col("l_quantity").cast("long")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id_transaccion"),
        F.concat(F.lit("CLI"), F.col("o_custkey").cast("string")).alias("id_cliente"),
        utc.alias("fecha_utc"),
        *[c.alias(n) for n, c in local_time_columns(utc, zone).items()],
        F.when(F.col("l_returnflag") == "R", SELL).otherwise(BUY).alias("tipo_tran"),
        description.alias("descripcion_titulo"), ticker.alias("simbolo_titulo"),
        F.when((ticker == "AL30D") | ((F.col("l_linestatus") == "O") & (F.pmod("l_partkey", F.lit(5)) == 0)), USD)
        .otherwise(ARS).alias("moneda"),
        F.col("o_orderpriority").alias("origen"),
        units.alias("cantidad"),
        (value / units.cast("decimal(10,0)")).cast(PRICE).alias("precio"),
        value.cast(MONEY).alias("monto"),
        F.lpad(F.pmod("l_orderkey", F.lit(2)) * 10, 3, "0").alias("ms_flag"))


def raw_text_trades(trades: DataFrame, local: Column | None = None) -> DataFrame:
    """The same trades as the ten text columns of a trade file, times in UTC or, where `local` holds, three hours behind."""
    def written(col: str, zone: str) -> Column:
        return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), "ms_flag", F.lit(zone))
    utc = written("fecha_utc", "Z")
    return trades.select(
        (utc if local is None else F.when(local, written("fecha_art", "-03:00")).otherwise(utc)).alias("fecha"),
        F.col("tipo_tran").alias("tipoTran"), "id_cliente", "descripcion_titulo", "moneda", "simbolo_titulo",
        F.col("cantidad").cast("string").alias("cantidad"), F.col("precio").cast("string").alias("precio"),
        "id_transaccion", "origen")


# Month and day of the holidays looked for among the order dates.
LINE_HOLIDAYS = {(1, 1): "Año nuevo", (5, 1): "Día del Trabajador", (7, 9): "Día de la Independencia",
                 (12, 25): "Navidad"}


def line_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates that fall on a fixed holiday."""
    day = F.to_date("o_orderdate")
    name = None
    for (m, d), label in LINE_HOLIDAYS.items():
        hit = (F.month(day) == m) & (F.dayofmonth(day) == d)
        name = F.when(hit, label) if name is None else name.when(hit, label)
    return (table(spark, sf_dir, "orders").select(day.alias("fecha"), name.alias("nombre"))
            .where(F.col("nombre").isNotNull()).distinct()
            .select("fecha", "nombre", F.lit("inamovible").alias("tipo"), F.lit("orders").alias("fuente")))


def line_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily quote from the order totals, on weekdays and not before April 1995."""
    day = F.to_date("o_orderdate")
    total = F.col("o_totalprice").cast("decimal(14,2)") * F.lit("0.003").cast("decimal(4,3)")
    return (table(spark, sf_dir, "orders").where((F.weekday(day) < 5) & (day >= F.lit("1995-04-01").cast("date")))
            .groupBy(day.alias("fecha"))
            .agg(F.round(F.min(total), 2).cast("decimal(12,4)").alias("compra"),
                 F.round(F.max(total), 2).cast("decimal(12,4)").alias("venta"))
            .withColumn("fuente", F.lit("orders_daily")))


def event_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the 17th of each month that has events."""
    day = F.to_date("ts")
    return (table(spark, sf_dir, "events").where(F.dayofmonth(day).isin(1, 17)).select(day.alias("fecha")).distinct()
            .select("fecha", F.concat(F.lit("Feriado "), F.date_format("fecha", "dd/MM")).alias("nombre"),
                    F.lit("inamovible").alias("tipo"), F.lit("events").alias("fuente")))


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily quote from the purchase events, on weekdays from the fifth of the month."""
    day = F.to_date("ts")
    value = F.col("value").cast("decimal(10,2)")
    return (table(spark, sf_dir, "events")
            .where((F.col("event_type") == "purchase") & (F.weekday(day) < 5) & (F.dayofmonth(day) >= 5))
            .groupBy(day.alias("fecha"))
            .agg((F.min(value) + 900).cast("decimal(12,4)").alias("compra"),
                 (F.max(value) + 900).cast("decimal(12,4)").alias("venta"))
            .withColumn("fuente", F.lit("events_daily")))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error and signup events as a call log."""
    failed = F.col("event_type") == "error"
    return (table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "signup"))
            .select(F.col("ts").cast("timestamp_ntz").alias("ts_utc"),
                    F.concat(F.lit("api"), F.pmod("event_id", F.lit(3)).cast("string")).alias("api"),
                    F.concat(F.lit("/v1/"), F.col("user_id").cast("string")).alias("url"),
                    F.when(failed, "ERROR").otherwise("OK").alias("estado"),
                    F.when(failed, F.lit(0)).otherwise(F.floor("value").cast("int")).alias("filas"),
                    F.when(failed, F.repeat(F.col("props"), 12)).otherwise("").alias("detalle")))


# Year of the holidays that come without one.
PAYLOAD_YEAR = 1996


def holiday_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday objects in both payload shapes: those of PAYLOAD_YEAR as day and month, the others dated."""
    days = line_holidays(spark, sf_dir)
    text = F.when(F.year("fecha") == PAYLOAD_YEAR, F.to_json(F.struct(
        F.col("nombre").alias("motivo"), "tipo", F.dayofmonth("fecha").alias("dia"), F.month("fecha").alias("mes")))) \
        .otherwise(F.to_json(F.struct(F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), "tipo", "nombre")))
    return days.select(F.from_json(text, HOLIDAY_PAYLOAD).alias("item")).select("item.*")


def quote_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote objects as the rate service sends them."""
    text = F.to_json(F.struct(F.lit("bolsa").alias("casa"), "compra", "venta",
                              F.date_format("fecha", "yyyy-MM-dd").alias("fecha")))
    return line_quotes(spark, sf_dir).select(F.from_json(text, QUOTE_PAYLOAD).alias("item")).select("item.*")
