"""Trade files: text staging, typed projection, reject rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewarden.functions.exprs import MONEY, PRICE, iso_weekday, times_units

# Columns of the trade file, in file order, all text.
RAW_COLUMNS = ("fecha", "tipoTran", "id_cliente", "descripcion_titulo", "moneda", "simbolo_titulo",
               "cantidad", "precio", "id_transaccion", "origen")
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")

TRADE_COLUMNS = ("id_transaccion", "id_cliente", "fecha_utc", "fecha_art", "dia_art", "hora_art", "dow_art",
                 "tipo_tran", "descripcion_titulo", "simbolo_titulo", "moneda", "origen", "cantidad", "precio",
                 "monto", "ms_flag")


def read_trade_file(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The CSV as it is: header, UTF-8, every column text, quotes inside a field doubled; a row of the wrong shape stops the
    load. Fields with line breaks need `multi_line`, with which a file is read by one task."""
    return (spark.read.schema(RAW_SCHEMA).option("header", True).option("encoding", "UTF-8").option("escape", '"')
            .option("multiLine", multi_line).option("mode", "FAILFAST").csv(path))


def local_time_columns(utc: Column, zone: str) -> dict[str, Column]:
    """Local timestamp, day, hour and weekday of a UTC wall-clock timestamp (timestamp_ntz),
    whatever the session time zone is.

    In a UTC session the casts to and from timestamp change nothing, and from_utc_timestamp is far
    cheaper per row than convert_timezone."""
    if SparkSession.active().conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        local = F.from_utc_timestamp(utc.cast("timestamp"), zone).cast("timestamp_ntz")
    else:
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    day = F.to_date(local)
    return {"fecha_art": local, "dia_art": day, "hora_art": F.hour(local), "dow_art": iso_weekday(day)}


# A time with Z or an offset at its end; without either it is UTC.
ZONED = r"\d:\d\d.*(Z|[+-]\d{1,2}(:?\d{2})?)$"


def _checked() -> dict[str, Column]:
    """What the text columns become, NULL where that fails; the one table of rules for the load and for the rejects.

    `fecha` is the UTC wall clock of the instant. The amount is taken from the price as written, rounded once."""
    text = F.trim("fecha")
    text = F.when(text.rlike(ZONED), text).when(text.contains(":"), F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))
    instant = F.unix_micros(F.try_to_timestamp(text))
    utc = F.timestamp_add("MICROSECOND", instant, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    units, price = F.col("cantidad").try_cast("long"), F.col("precio").try_cast(PRICE)
    written = F.col("precio").try_cast("decimal(32,18)")
    return {"fecha": utc, "cantidad": units, "precio": price,
            "monto": F.when(units.isNotNull() & price.isNotNull(), times_units(units, written, 4).try_cast(MONEY))}


def type_trades(raw: DataFrame, zone: str) -> DataFrame:
    """Typed trades. A time, quantity, price or amount that reject_rows reports stops the load."""
    checked = {n: F.coalesce(c, F.raise_error(F.concat(F.lit(f"{n}: "), F.coalesce("id_transaccion", F.lit("?")))))
               for n, c in _checked().items()}
    rows = raw.withColumns({f"_{n}": c for n, c in checked.items()})
    utc = F.col("_fecha")
    return rows.select(
        "id_transaccion", "id_cliente",
        utc.alias("fecha_utc"),
        *[c.alias(n) for n, c in local_time_columns(utc, zone).items()],
        F.col("tipoTran").alias("tipo_tran"),
        "descripcion_titulo", "simbolo_titulo", "moneda", "origen",
        F.col("_cantidad").alias("cantidad"), F.col("_precio").alias("precio"), F.col("_monto").alias("monto"),
        F.nullif(F.regexp_extract("fecha", r"\.(\d{3})Z$", 1), F.lit("")).alias("ms_flag"))


def reject_rows(raw: DataFrame) -> DataFrame:
    """Raw rows that would stop the load, with the columns at fault: a time, quantity or price that is missing or doesn't
    cast, or an amount beyond its type."""
    bad = _checked()
    amount = bad.pop("monto")
    faults = [F.when(ok.isNull(), F.lit(c)) for c, ok in bad.items()]
    only_amount = bad["cantidad"].isNotNull() & bad["precio"].isNotNull() & amount.isNull()
    return (raw.withColumn("columnas_invalidas", F.concat_ws(", ", *faults, F.when(only_amount, F.lit("monto"))))
            .where(F.col("columnas_invalidas") != ""))
