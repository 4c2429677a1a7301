"""The daily run over a folder that stays: only what changed since the run before is rebuilt.

Trades lie in a partition per local day, rates in one per month, the cells of the activity cube in one per day. A partition has a
fingerprint: its number of rows and the sum of their hashes, whatever their order. A run compares the fingerprints of its input with
those of the run before and rewrites the partitions that differ. Rates are carried forward from day to day, so a late quote changes all months that rest on
it: the rates of the whole calendar are a small table, worked out anew, of which only the months that come out different are written.

The fingerprints of a table are published after its partitions. A run that ends before that leaves the old ones, and the next
run does those partitions again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.params import Params
from tradewarden.plans import cube, market
from tradewarden.sources import versions
from tradewarden.sources.storage import remove_folder, settle, spread, write_parquet

NEW, CHANGED, GONE = "nueva", "cambiada", "borrada"


def fingerprints(df: DataFrame, part: str) -> DataFrame:
    """(part, filas, huella): a fingerprint per partition that doesn't depend on the order of the rows."""
    columns = sorted(df.columns)
    return df.groupBy(part).agg(F.count("*").alias("filas"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("huella"))


class PartitionedTable:
    """A Parquet table in partitions of one column, with the fingerprints of what they were made from."""

    def __init__(self, spark: SparkSession, root: str, name: str, part: str):
        self.spark, self.name, self.part = spark, name, part
        self.path, self._prints = f"{root}/{name}", f"{root}/huellas/{name}"

    def prints(self) -> DataFrame | None:
        version = versions.current(self.spark, self._prints)
        return None if version is None else self.spark.read.parquet(version.path("huellas"))

    def differences(self, now: DataFrame) -> DataFrame:
        """(part, accion): partitions of the input that are new, changed or gone; one row per day or month at most."""
        before = self.prints()
        if before is None:
            return now.select(self.part, F.lit(NEW).alias("accion"))
        old = before.select(F.col(self.part).alias("_part"), F.col("filas").alias("_filas"), F.col("huella").alias("_huella"))
        both = now.join(old, now[self.part].eqNullSafe(old["_part"]), "full_outer")
        action = (F.when(F.col("_filas").isNull(), NEW).when(F.col("filas").isNull(), GONE)
                  .when((F.col("filas") != F.col("_filas")) | (F.col("huella") != F.col("_huella")), CHANGED))
        return both.select(F.coalesce(self.part, "_part").alias(self.part), action.alias("accion")).where("accion IS NOT NULL")

    def replace(self, rows: DataFrame, actions: list) -> None:
        """Write `rows`, which are those of the new and changed partitions, and delete the ones that are gone."""
        if any(a["accion"] != GONE for a in actions):
            dealt = rows.hint("rebalance", F.col(self.part))
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)
        for a in actions:
            if a["accion"] == GONE:
                remove_folder(self.spark, f"{self.path}/{self.part}={a[self.part]}")

    def settle_prints(self, now: DataFrame) -> None:
        versions.publish(self.spark, self._prints, {"huellas": lambda path: write_parquet(now.coalesce(1), path)})

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def _among(part: str, values: list) -> Column:
    return F.col(part).isin(values) if values else F.lit(False)


class DailyRun:
    """Trades, daily rates and the cells of the activity cube, kept up to date under `root`."""

    def __init__(self, spark: SparkSession, root: str, params: Params = Params()):
        self.spark, self.params = spark, params
        self.trades = PartitionedTable(spark, root, "operaciones", "dia_art")
        self.rates = PartitionedTable(spark, root, "tipo_cambio_diario", "anio_mes")
        self.cells = PartitionedTable(spark, root, "cubo_celdas", "dia_art")

    def _sync_trades(self, trades: DataFrame) -> list:
        now = settle(fingerprints(trades, "dia_art"))
        actions = self.trades.differences(now).collect()  # one row per day
        # A trade without a day can't be a partition; typed trades always have one.
        self.trades.replace(spread(trades.where(_among("dia_art", [a["dia_art"] for a in actions if a["accion"] != GONE]))), actions)
        if actions:
            self.trades.settle_prints(now)
        return actions

    def update(self, trades: DataFrame, holidays: DataFrame, quotes: DataFrame) -> DataFrame:
        """Bring all tables up to date with the typed trades, holidays and quotes; (tabla, particion, accion): what was done."""
        done = [("operaciones", str(a["dia_art"]), a["accion"]) for a in self._sync_trades(trades)]
        stored = self.trades.read()
        active = settle(self.trades.prints().select("dia_art"))
        calendar = settle(market.business_calendar(active, holidays, self.params))
        fx = settle(market.daily_fx(calendar, active, quotes, market.implied_fx(stored, self.params), self.params)
                    .withColumn("anio_mes", F.date_format("fecha", "yyyy-MM")))
        now = settle(fingerprints(fx, "anio_mes"))
        actions = self.rates.differences(now).collect()
        self.rates.replace(fx.where(_among("anio_mes", [a["anio_mes"] for a in actions])), actions)
        if actions:
            self.rates.settle_prints(now)
        done += [("tipo_cambio_diario", a["anio_mes"], a["accion"]) for a in actions]

        # A day's cells come from its trades and from what the day is; the fingerprint covers both.
        days = settle(market.rated_days(fx.drop("anio_mes"), calendar))
        of_day = days.select(F.col("fecha").alias("dia_art"), F.xxhash64(*days.columns).cast("decimal(38,0)").alias("_day"))
        now = settle(self.trades.prints().join(of_day, "dia_art", "left").select(
            "dia_art", "filas", (F.col("huella") + F.coalesce("_day", F.lit(0))).alias("huella")))
        actions = self.cells.differences(now).collect()
        wanted = [a["dia_art"] for a in actions if a["accion"] != GONE]
        self.cells.replace(cube.cells(cube.activity_cube(stored.where(_among("dia_art", wanted)), days)), actions)
        if actions:
            self.cells.settle_prints(now)
        done += [("cubo_celdas", str(a["dia_art"]), a["accion"]) for a in actions]
        return self.spark.createDataFrame(done, "tabla string, particion string, accion string")
