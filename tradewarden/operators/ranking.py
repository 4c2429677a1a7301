"""Ranks, running totals, exact percentiles and top shares that never put a whole table,
or a whole hot group, into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.functions.exprs import pct
from tradewarden.operators.joins import BROADCAST_ROWS, join_same
from tradewarden.sources.storage import settle

# Percentile buffers of this many distinct values take a few MB of executor memory.
MAX_DISTINCT = 200_000
# A bracketing sketch is kept for at most this many groups.
MAX_SKETCHES = 1_000
# The sketch is off by at most 1 / SKETCH_ACCURACY of the rows; the bracket is ten times as wide.
SKETCH_ACCURACY = 10_000
BRACKET = 10 / SKETCH_ACCURACY


def _sort_key(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def running_total(df: DataFrame, order: Sequence[str], weights: Mapping[str, str],
                  by: Sequence[str] = ()) -> DataFrame:
    """Add, for each `out: weight`, the sum of the weight over all earlier rows of the group (`out`)
    and over the whole group (`out_total`). A "-" before an order column means largest first.

    Rows are range-partitioned on (by, order), so a hot group is cut into many slices. Each slice
    sums locally; the slices' own totals (one row per slice and group) supply the offsets.
    `order` must be unique within a group."""
    by = list(by)
    keys = [_sort_key(o) for o in order]
    rows = settle(df.repartitionByRange(*[F.col(c).asc() for c in by], *keys)
                  .withColumn("_slice", F.spark_partition_id()))

    sums = rows.groupBy(*by, "_slice").agg(*[F.sum(w).alias(f"_w_{o}") for o, w in weights.items()])
    across = Window.partitionBy(*by)
    before = across.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by, "_slice",
        *[F.sum(f"_w_{o}").over(before).alias(f"_off_{o}") for o in weights],
        *[F.sum(f"_w_{o}").over(across).alias(f"{o}_total") for o in weights])
    if not by:
        offsets = F.broadcast(offsets)  # one row per slice: no more than the shuffle partitions

    inside = (Window.partitionBy(*by, "_slice").orderBy(*keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = rows.select("*", *[F.sum(w).over(inside).alias(f"_loc_{o}") for o, w in weights.items()])
    return join_same(local, offsets, [*by, "_slice"]).select(
        *df.columns,
        *[(F.coalesce(F.col(f"_loc_{o}"), F.lit(0)) + F.coalesce(F.col(f"_off_{o}"), F.lit(0))).alias(o)
          for o in weights],
        *[f"{o}_total" for o in weights])


def global_rank(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """row_number() over the whole table; `order` must be unique."""
    run = running_total(df.withColumn("_one", F.lit(1).cast("long")), order, {out: "_one"})
    return run.select(*df.columns, (F.col(out) + 1).alias(out))


def running_total_with_ties(df: DataFrame, key: str, value: str, rank: str, held: str) -> DataFrame:
    """Add the dense rank by `value`, largest first, as `rank`, and the sum of all values at least as large, ties included, as
    `held`, and the sum of all as `<held>_total`. `key` tells rows apart.

    Rows move once, into slices of the order (value, key), so that a very common value is cut as well. Each slice ranks and sums its
    own; one row per slice, with its first and last value, tells what came before and how far the last value reaches into
    the slices that follow."""
    rows = settle(df.repartitionByRange(F.col(value).desc(), F.col(key)).withColumn("_slice", F.spark_partition_id()))
    inside = Window.partitionBy("_slice").orderBy(F.col(value).desc())
    ranked = rows.select("*", F.dense_rank().over(inside).alias("_rank"), F.sum(value).over(inside).alias("_held"))
    slices = rows.groupBy("_slice").agg(F.max(value).alias("first"), F.min(value).alias("last"), F.sum(value).alias("sum"),
                                        F.countDistinct(value).alias("distinct"))
    lead = rows.groupBy("_slice", value).agg(F.sum(value).alias("lead")).join(
        F.broadcast(slices.select("_slice", F.col("first").alias(value))), ["_slice", value]).select("_slice", "lead")
    order = Window.orderBy("_slice")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    marks = slices.join(F.broadcast(lead), "_slice").select(
        "*", F.lag("last").over(order).eqNullSafe(F.col("first")).cast("long").alias("goes_on"),
        F.lead("first").over(order).eqNullSafe(F.col("last")).alias("reaches"),
        F.sum("lead").over(Window.partitionBy("first").orderBy(F.desc("_slice"))).alias("from_here")).select(
        "*", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("_before"), F.sum("sum").over(Window.partitionBy()).alias(f"{held}_total"),
        (F.coalesce(F.sum("distinct").over(before), F.lit(0)) - F.sum("goes_on").over(order)).alias("_ranks"),
        F.when(F.col("reaches"), F.lead("from_here").over(order)).otherwise(0).alias("_after"))
    of_slice = F.broadcast(marks.select("_slice", "_before", "_ranks", "_after", "last", f"{held}_total"))
    return ranked.join(of_slice, "_slice").select(
        *df.columns, (F.col("_rank") + F.col("_ranks")).alias(rank),
        (F.col("_held") + F.col("_before") + F.when(F.col(value) == F.col("last"), F.col("_after")).otherwise(0)).alias(held), f"{held}_total")


def _position(size: Column, p: float) -> Column:
    return (size - 1) * F.lit(float(p))


def _at(cond: Column, value: str, start: Column, n: Column, k: Column) -> Column:
    """The value whose run [start, start + n) of equal rows holds row k."""
    return F.max(F.when(cond & (start <= k) & (k < start + n), F.col(value)))


def _interpolated(out: str, p: float) -> Column:
    """The weighted mean of the two neighbours, as the built-in aggregate forms it, to the last bit."""
    lo, hi, pos = F.col(f"_{out}_lo"), F.col(f"_{out}_hi"), _position(F.col("_size"), p)
    mean = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
    return F.when((lo == hi) | (F.ceil(pos) == F.floor(pos)), lo).otherwise(mean).alias(out)


def _sliced_percentiles(hist: DataFrame, by: list[str], value: str, quantiles: Mapping[str, float],
                        size_as: str | None = None) -> DataFrame:
    """Percentiles of a (by, value) -> _n histogram, read off its running total."""
    run = running_total(hist, [value], {"_start": "_n"}, by)
    size = F.col("_start_total")
    picks = [_at(F.lit(True), value, F.col("_start"), F.col("_n"), side(_position(size, p))).cast("double").alias(f"_{out}_{name}")
             for out, p in quantiles.items() for name, side in (("lo", F.floor), ("hi", F.ceil))]
    kept = [F.col("_size").alias(size_as)] if size_as else []
    return (run.groupBy(*by).agg(F.max(size).alias("_size"), *picks)
            .select(*by, *[_interpolated(out, p) for out, p in quantiles.items()], *kept))


def _histogram(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))


def percentiles_by_group(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float],
                         size_as: str | None = None, max_distinct: int | None = None) -> DataFrame:
    """Exact interpolated percentiles for any number of groups, and the rows per group on request.

    Equal values are counted before the shuffle. Groups with up to `max_distinct` different values
    are finished by the built-in aggregate on those counts; larger ones go through the sliced
    running total, so no task ever holds a hot group."""
    by = list(by)
    max_distinct = MAX_DISTINCT if max_distinct is None else max_distinct
    hist = settle(_histogram(df, by, value))
    large = hist.groupBy(*by).agg(F.count("*").alias("_d")).where(F.col("_d") > max_distinct).select(*by)
    exact = [F.percentile(value, F.lit(float(p)), F.col("_n")).alias(out) for out, p in quantiles.items()]
    if size_as:
        exact.append(F.sum("_n").alias(size_as))
    if large.isEmpty():
        return hist.groupBy(*by).agg(*exact)
    large = settle(large)
    small = join_same(hist, large, by, "left_anti").groupBy(*by).agg(*exact)
    return small.unionByName(
        _sliced_percentiles(join_same(hist, large, by, "left_semi"), by, value, quantiles, size_as))


def medians_by_group(df: DataFrame, by: Sequence[str], value: str, out: str, size_as: str | None = None,
                     max_distinct: int | None = None, least: int = 1, together: bool = False) -> DataFrame:
    """Exact medians of a decimal, with one digit more than the value has, and the rows per group on request. Groups of fewer
    than `least` rows are left out. `together`: the rows of a group lie in one partition already, so they don't move.

    Groups are counted first, by partial sums. If few are left, the rows of the others are dropped before anything moves. A group of up
    to `max_distinct` rows picks its two middle ones from its sorted values; in a larger one equal values are counted and the
    two read off the running count over slices."""
    by = list(by)
    max_distinct = MAX_DISTINCT if max_distinct is None else max_distinct
    kind = df.schema[value].dataType
    rows = df.where(F.col(value).isNotNull()).select(*by, value)
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_size"))
    if least > 1:
        sizes = settle(sizes.where(F.col("_size") >= least))
        if sizes.count() <= BROADCAST_ROWS:
            rows = join_same(rows, F.broadcast(sizes.select(*by)), by, "left_semi")
    large = settle(sizes.where(F.col("_size") > max_distinct).select(*by))
    none_large = large.isEmpty()
    # Groups this large are few: at most a row here for each `max_distinct` rows.
    small = rows if none_large else join_same(rows, F.broadcast(large), by, "left_anti")
    found = (small if together else small.repartition(*by)).groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias("_v")).select(*by, F.size("_v").cast("long").alias("_size"), "_v")
    found = found.where(F.col("_size") >= least).select(*by, "_size", *[
        F.get("_v", F.floor((F.col("_size") - 1 + side) / 2).cast("int")).alias(f"_m{side}") for side in (0, 1)])
    if not none_large:
        hist = _histogram(join_same(rows, F.broadcast(large), by, "left_semi"), by, value)
        run = running_total(hist, [value], {"_start": "_n"}, by)
        size = F.col("_start_total")
        found = found.unionByName(run.groupBy(*by).agg(F.max(size).alias("_size"), *[
            _at(F.lit(True), value, F.col("_start"), F.col("_n"), F.floor((size - 1 + side) / 2)).alias(f"_m{side}") for side in (0, 1)]))
    wide = f"decimal({min(38, kind.precision + 2)},{kind.scale + 1})"
    half = F.lit(Decimal("0.5"))
    kept = [F.col("_size").alias(size_as)] if size_as else []
    return found.select(*by, ((F.col("_m0") + F.col("_m1")) * half).cast(wide).alias(out), *kept)


def percentiles(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Exact interpolated percentiles of few, very large groups (currencies, measures).

    A mergeable sketch brackets each percentile; rows below the bracket are only counted, and the
    exact value is read from the rows inside, about 2 * BRACKET of the table. If a bracket ever
    missed its percentile, the whole histogram is used instead."""
    by, names = list(by), list(quantiles)
    rows = df.where(F.col(value).isNotNull()).select(*by, value)
    steps = [min(1.0, max(0.0, quantiles[n] + d)) for n in names for d in (-BRACKET, BRACKET)]
    sketch = settle(rows.groupBy(*by).agg(
        F.percentile_approx(value, steps, F.lit(SKETCH_ACCURACY)).alias("_marks")))
    if sketch.count() > MAX_SKETCHES:
        return percentiles_by_group(df, by, value, quantiles)

    marked = join_same(rows, F.broadcast(sketch), by)
    low = [F.element_at("_marks", 2 * i + 1) for i in range(len(names))]
    high = [F.element_at("_marks", 2 * i + 2) for i in range(len(names))]
    v = F.col(value)
    # One pass for all counts, a row of the table once: where it lies to each bracket (0 below, 1 inside, 2 above), and its value
    # only if it lies inside of any.
    places = [f"_at{i}" for i in range(len(names))]
    sides = [F.when(v < lo, 0).when(v <= hi, 1).otherwise(2).alias(a) for a, lo, hi in zip(places, low, high)]
    inside = reduce(Column.__or__, [F.col(a) == 1 for a in places])
    cells = marked.select(*by, value, *sides).select(*by, *places, F.when(inside, v).alias(value))
    cells = settle(cells.groupBy(*by, *places, value).agg(F.count("*").alias("_n")))
    counts = cells.groupBy(*by).agg(F.sum("_n").alias("_size"), *[
        F.coalesce(F.sum(F.when(F.col(a) == 0, F.col("_n"))), F.lit(0)).alias(f"_below{i}") for i, a in enumerate(places)])
    of = F.array_compact(F.array(*[F.when(F.col(a) == 1, F.lit(i)) for i, a in enumerate(places)]))
    hist = cells.where(inside).select(*by, F.explode(of).alias("_q"), value, "_n")
    run = join_same(running_total(hist, [value], {"_start": "_n"}, [*by, "_q"]), F.broadcast(counts), by)
    picks = [_at(F.col("_q") == i, value, F.col("_start") + F.col(f"_below{i}"), F.col("_n"),
                 side(_position(F.col("_size"), quantiles[out]))).cast("double").alias(f"_{out}_{name}")
             for i, out in enumerate(names) for name, side in (("lo", F.floor), ("hi", F.ceil))]
    found = settle(run.groupBy(*by).agg(F.max("_size").alias("_size"), *picks))
    missed = reduce(Column.__or__, [F.col(f"_{n}_{s}").isNull() for n in names for s in ("lo", "hi")])
    if not found.where(missed).isEmpty():
        return _sliced_percentiles(_histogram(rows, by, value), by, value, quantiles)
    return found.select(*by, *[_interpolated(n, quantiles[n]) for n in names])


def top_shares(df: DataFrame, measures: Mapping[str, str], cuts: Sequence[Decimal]) -> DataFrame:
    """(corte, out, ..): for each `out: value`, the percentage of the total of `value` held by the
    largest `corte` of the rows; a missing value counts as zero.

    Rows with equal values are interchangeable, so ranks are taken over the value histogram, for all
    measures in one pass."""
    amount = "decimal(38,4)"
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(out).alias("_m"), F.coalesce(F.col(v), F.lit(0)).cast(amount).alias("_v"))
        for out, v in measures.items()])).alias("_r")).select("_r.*")
    hist = values.groupBy("_m", "_v").agg(F.count("*").alias("_n"))
    run = running_total(hist, ["-_v"], {"_start": "_n"}, ["_m"])
    taken = [F.least(F.col("_n"), F.greatest(
        F.lit(0), F.floor(F.col("_start_total") * F.lit(c)) - F.col("_start"))) for c in cuts]
    held = run.groupBy("_m").agg(F.sum(F.col("_v") * F.col("_n")).alias("_all"),
                                 *[F.sum(F.col("_v") * t.cast("long")).alias(f"_top{i}") for i, t in enumerate(taken)])
    per_cut = F.array(*[F.struct(F.lit(c).cast("decimal(20,12)").alias("corte"), F.col(f"_top{i}").alias("top"))
                        for i, c in enumerate(cuts)])
    share = pct(F.col("_r.top"), F.col("_all"))
    return (held.select("_m", "_all", F.explode(per_cut).alias("_r")).groupBy("_r.corte")
            .agg(*[F.max(F.when(F.col("_m") == out, share)).alias(out) for out in measures]))
