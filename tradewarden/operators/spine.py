"""Date spine and as-of (latest at or before) lookup on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Days that are safe to ship to every executor: a century. A longer calendar is joined.
BROADCAST_DAYS = 40_000


def date_spine(bounds: DataFrame, start: Column, end: Column, out: str = "fecha") -> DataFrame:
    """One row per day between two expressions over a one-row frame. The date type itself bounds it to some
    3.7 million days, whatever the number of trades."""
    return bounds.where(start <= end).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(out))


def join_days(rows: DataFrame, days: DataFrame, on: Column, how: str = "inner", n_days: int | None = None) -> DataFrame:
    """Rows with their day. A calendar of up to BROADCAST_DAYS, counted first unless `n_days` tells, is joined on the map side."""
    few = (days.limit(BROADCAST_DAYS + 1).count() if n_days is None else n_days) <= BROADCAST_DAYS
    return rows.join(F.broadcast(days) if few else days, on, how)


def last_known(spine: DataFrame, quotes: DataFrame, on: str, out: str) -> DataFrame:
    """Add struct column `out`: the quote of the latest date at or before each spine date, else NULL.

    Quotes are unique by date. Both sides have one row per calendar day, so the single window
    over them is bounded by the length of the calendar, never by the trades."""
    days = spine.select(on, *[c for c in spine.columns if c != on], F.lit(None).alias("_quote"), F.lit(1).alias("_kind"))
    known = quotes.select(F.col(on), F.struct(*quotes.columns).alias("_quote"), F.lit(0).alias("_kind"))
    upto = Window.orderBy(on, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (days.unionByName(known, allowMissingColumns=True)
            .withColumn(out, F.last("_quote", ignorenulls=True).over(upto))
            .where(F.col("_kind") == 1)
            .drop("_quote", "_kind"))

