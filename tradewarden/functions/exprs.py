"""Column expressions shared by the analytics. All of them stay inside the JVM."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewarden import params as L

MONEY = "decimal(24,4)"
PRICE = "decimal(20,6)"
RATE = "decimal(12,4)"


def exact(col: Column, scale: int = 8) -> Column:
    """A double as a decimal, so that rounding is half away from zero and ties are real ties."""
    return col.cast(f"decimal({20 + scale},{scale})")


def times_units(units: Column, price: Column, digits: int) -> Column:
    """units * price, rounded once, for any long and any price of up to 18 digits before and 18 after the point; NULL for a
    product of more than 34 digits. The product with the whole part of the price is a whole number, so only the product
    with the fraction needs rounding."""
    whole = F.floor(price).cast("decimal(18,0)")
    quantity = units.cast("decimal(19,0)")
    part = F.round(quantity * (price - whole).cast("decimal(18,18)"), digits)
    return (quantity * whole).try_cast("decimal(34,0)") + part.cast(f"decimal({20 + digits},{digits})")


def rounded(col: Column, digits: int) -> Column:
    """Half-up rounding of a double, with a fixed scale."""
    return F.round(exact(col, max(8, digits + 6)), digits)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole in decimals; NULL for an empty whole."""
    top = part.cast("decimal(24,4)") * F.lit(Decimal(100))
    return F.round(top / F.nullif(whole.cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)")), digits)


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole in decimals; NULL for an empty whole."""
    return F.round(part.cast("decimal(24,4)")
                   / F.nullif(whole.cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)")), digits)


def millions(amount: Column, digits: int = 1) -> Column:
    return F.round(amount.cast("decimal(32,4)") / F.lit(1_000_000), digits)


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_where(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def weekday_label(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in L.WEEKDAYS]), dow)


def hour_band(hour: Column) -> Column:
    return (F.when(in_market(hour), L.BAND_MARKET)
            .when(hour < 6, L.BAND_NIGHT)
            .when(hour < 11, L.BAND_PRE)
            .otherwise(L.BAND_POST))


def in_market(hour: Column) -> Column:
    return hour.between(11, 16)


def day_type(holiday: Column, dow: Column) -> Column:
    return (F.when(holiday.isNotNull(), L.HOLIDAY)
            .when(dow >= 6, L.WEEKEND)
            .otherwise(L.BUSINESS_DAY))


def is_option(description: Column, ticker: Column) -> Column:
    return description.ilike("%opci%") | ticker.rlike(L.OPTION_TICKER)


def family(description: Column, ticker: Column, corporate: bool) -> Column:
    """Instrument class by text; the first rule that matches wins.

    The exploration knows corporate bonds as a fifth class, the fact table does not."""
    rules = [
        (description.ilike("cedear%"), L.FAMILY_CEDEAR),
        (is_option(description, ticker), L.FAMILY_OPTION),
        (description.ilike("%bono%") | description.ilike("%rep. arg%") | ticker.rlike(L.BOND_TICKER),
         L.FAMILY_BOND),
    ]
    if corporate:
        rules.append((description.ilike("%obligaci%") | description.ilike("%o.n.%"), L.FAMILY_CORPORATE))
    (cond, label), *rest = rules
    return reduce(lambda c, r: c.when(*r), rest, F.when(cond, label)).otherwise(L.FAMILY_OTHER)


def binomial_z(hits: Column, trials: Column, base: Column) -> Column:
    """Standardised distance of hits from trials * base, cut to two decimals."""
    n, k, p = trials.cast("double"), hits.cast("double"), base.cast("double")
    spread = F.sqrt(n * p * (1 - p))
    return rounded((k - n * p) / F.nullif(spread, F.lit(0.0)), 2)


def day_text(day: Column) -> Column:
    return F.date_format(day, "E")


def percent_text(share: Column) -> Column:
    """0.7041 -> '70.4%'."""
    return F.concat(F.round(share * 100, 1).cast("decimal(20,1)").cast("string"), F.lit("%"))


def grouped_number(number: Column) -> Column:
    """1234567.8 -> '1,234,568', halves away from zero."""
    return F.format_number(F.round(number.cast("decimal(38,4)"), 0), 0)
