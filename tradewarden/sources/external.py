"""External data after the fetch: holidays, daily rate quotes and the call log."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOLIDAY_SCHEMA = "fecha date, nombre string, tipo string, fuente string"
QUOTE_SCHEMA = "fecha date, compra decimal(12,4), venta decimal(12,4), fuente string"
LOG_SCHEMA = "ts_utc timestamp_ntz, api string, url string, estado string, filas int, detalle string"

# Both known holiday payloads in one schema: (fecha, nombre) or (dia, mes, motivo).
HOLIDAY_PAYLOAD = T.StructType([
    T.StructField("fecha", T.StringType()), T.StructField("nombre", T.StringType()),
    T.StructField("motivo", T.StringType()), T.StructField("tipo", T.StringType()),
    T.StructField("dia", T.IntegerType()), T.StructField("mes", T.IntegerType())])
QUOTE_PAYLOAD = T.StructType([
    T.StructField("casa", T.StringType()), T.StructField("compra", T.DecimalType(12, 4)),
    T.StructField("venta", T.DecimalType(12, 4)), T.StructField("fecha", T.StringType())])


class EmptyPayload(ValueError):
    """The source answered with nothing usable."""


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with header and declared types, quotes inside a field doubled."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path))


def read_json_items(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """The objects of files that hold one JSON array each or, with `lines`, one object per line."""
    return not_empty(spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST").json(path))


def parse_holidays(items: DataFrame, year: int) -> DataFrame:
    """(fecha, nombre, tipo) from either payload shape; a payload without a day is an error."""
    dated = F.col("fecha").isNotNull()
    return not_empty(items.select(
        F.when(dated, F.to_date("fecha")).otherwise(F.make_date(F.lit(year), "mes", "dia")).alias("fecha"),
        F.coalesce(F.when(dated, F.col("nombre")).otherwise(F.col("motivo")), F.lit("")).alias("nombre"),
        F.coalesce("tipo", F.lit("")).alias("tipo")).where(F.col("fecha").isNotNull())).orderBy("fecha")


def parse_quotes(items: DataFrame, start: date, end: date) -> DataFrame:
    """(fecha, compra, venta) of the period; a payload without a quote in it is an error."""
    day = F.to_date("fecha")
    return not_empty(items.where(day.between(F.lit(start), F.lit(end)))
                     .select(day.alias("fecha"), "compra", "venta")).orderBy("fecha")


def not_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyPayload("the source has no rows")
    return df


@dataclass(frozen=True)
class Source:
    """One place a data set may have landed, with the parser of its payload."""

    api: str
    url: str
    load: Callable[[], DataFrame]
    fallback: bool = False
    detail: str = ""


# Error conditions that say that a landed file is missing or broken. A failed read alone, as in an outage of the storage, does
# not: it counts only when one of these caused it.
BROKEN = ("MALFORMED_RECORD_IN_PARSING", "CAST_INVALID_INPUT", "CANNOT_PARSE_DECIMAL", "CANNOT_PARSE_JSON_FIELD", "CANNOT_PARSE_TIMESTAMP",
          "INVALID_JSON_ROOT_FIELD", "INVALID_JSON_RECORD_TYPE", "UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")


def _conditions(error: Exception) -> Iterator[str]:
    """The error conditions of an exception and of what caused it."""
    if isinstance(error, PySparkException):
        yield error.getCondition() or ""
    cause = getattr(error, "_origin", None)
    while cause is not None:
        if "getCondition" in dir(cause):
            yield cause.getCondition() or ""
        cause = cause.getCause()


def _of_source(error: Exception) -> bool:
    """Whether a source is missing, empty or unreadable, told by the error's class and conditions and never by its text."""
    if isinstance(error, (EmptyPayload, FileNotFoundError)):
        return True
    return any(c.split(".")[0] in BROKEN for c in _conditions(error))


def first_available(spark: SparkSession, sources: Sequence[Source], label: str | None = None,
                    none_left: tuple[str, str, str] | None = None, error_detail: int = 300,
                    ) -> tuple[DataFrame | None, DataFrame]:
    """The first source that loads with rows, stamped with `fuente`, and the log of all attempts, each with its own time.
    When none does, the result is None and `none_left` (api, url, detalle) is logged as the fallback. Only a source that is
    missing, empty or unreadable is passed over; any other failure is raised.

    These are tables of a few hundred days; the attempts are a handful of driver-side decisions."""
    attempts, chosen = [], None

    def log(api: str, url: str, state: str, rows: int, detail: str) -> None:
        attempts.append((datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"), api, url, state, rows, detail[:error_detail]))
    for source in sources:
        try:
            rows = source.load()
            n = rows.count()
            if not n:
                raise EmptyPayload("the source has no rows")
        except Exception as error:
            if not _of_source(error):
                raise
            log(source.api, source.url, "ERROR", 0, f"{type(error).__name__}: {error}")
            continue
        log(source.api, source.url, "FALLBACK" if source.fallback else "OK", n, source.detail)
        chosen = rows.withColumn("fuente", F.lit(label or source.api))
        break
    if chosen is None and none_left:
        api, url, detail = none_left
        log(api, url, "FALLBACK", 0, detail)
    log_rows = spark.createDataFrame(attempts, "ts string, api string, url string, estado string, filas int, detalle string")
    return chosen, log_rows.select(F.to_timestamp_ntz("ts").alias("ts_utc"), "api", "url", "estado", "filas", "detalle")
