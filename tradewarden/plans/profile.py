"""Client profiles, population thresholds and working days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.functions.exprs import count_where, pct, rounded, sum_where
from tradewarden.operators.ranking import percentiles
from tradewarden.params import BAND_NIGHT, BUSINESS_DAY, BUY, Params
from tradewarden.plans.explore import n_ops

# Cells that one task sorts by client.
SORTED_CELLS = 500_000
# Tasks over which a client's symbols, and its days, are dealt.
CLIENT_PARTS = 8

PROFILE_COLUMNS = (
    "id_cliente", "ops", "monto_ars", "max_monto_op_ars", "dias_activos", "simbolos", "canales", "canal_principal",
    "simbolo_principal", "pct_compras", "ops_madrugada", "ops_dia_inhabil", "ops_ene", "ops_feb", "ops_mar",
    "monto_ene", "monto_feb_mar")


def at_night() -> Column:
    return F.col("franja_horaria") == BAND_NIGHT


def off_business() -> Column:
    return F.col("tipo_dia") != BUSINESS_DAY


def _most_frequent(name: str, cells: Column) -> Column:
    """The value with most rows among (client, value) cells, the smallest on ties."""
    best = F.min(F.when(cells & F.col(name).isNotNull(), F.struct((-F.col("ops")).alias("n"), F.col(name).alias("v"))))
    return best.getField("v")


def client_rows(enriched: DataFrame) -> DataFrame:
    """What the profile and the case files read of a trade, as it is stored by client; the id is there to deal a client's trades."""
    return enriched.where(F.col("id_cliente").isNotNull()).select(
        "id_cliente", "id_transaccion", "origen", "simbolo_titulo", "tipo_tran", "dia_art", "cantidad", "monto_ars",
        at_night().alias("madrugada"), off_business().alias("inhabil"))


def client_profile(enriched: DataFrame, p: Params, n_trades: int | None = None, together: bool = False) -> DataFrame:
    """One wide row per client, of enriched trades or of client rows.

    `together`: a client's rows lie in one partition already, so they are cut down there and nothing moves. Else
    trades are cut to (client, channel) cells, combined on the map side. Of its symbols and its days the two columns move once, to
    CLIENT_PARTS tasks per client, where a symbol or a day lies whole: what goes on from there is a row per client and part, so
    a client with a third of the trades is neither in one task nor one long list. The most frequent symbol is text, for which
    Spark sorts. These tasks are of some SORTED_CELLS, by `n_trades`, their most, as adaptive execution merges tasks by packed
    bytes, which tell little of what a sort or a hash table holds."""
    spark = enriched.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (n_trades or 0) // SORTED_CELLS)
    base, second, third, after = (F.lit(d) for d in p.period_starts)
    day = F.col("dia_art")
    in_base = (day >= base) & (day < second)
    amount = F.col("monto_ars")
    night, off = (F.col("madrugada"), F.col("inhabil")) if "madrugada" in enriched.columns else (at_night(), off_business())
    by_channel = enriched.groupBy("id_cliente", "origen").agg(
        n_ops(), F.sum(amount).alias("monto_ars"), F.max(amount).alias("max_monto_op_ars"),
        count_where(F.col("tipo_tran") == BUY).alias("compras"),
        count_where(night).alias("ops_madrugada"), count_where(off).alias("ops_dia_inhabil"),
        count_where(in_base).alias("ops_ene"),
        count_where((day >= second) & (day < third)).alias("ops_feb"),
        count_where((day >= third) & (day < after)).alias("ops_mar"),
        sum_where(in_base, amount).alias("monto_ene"),
        sum_where(day >= second, amount).alias("monto_feb_mar"))
    added = ("monto_ars", "ops_madrugada", "ops_dia_inhabil", "ops_ene", "ops_feb", "ops_mar")
    totals = by_channel.groupBy("id_cliente").agg(
        F.sum("ops").alias("_ops"), F.count("origen").alias("canales"),
        _most_frequent("origen", F.lit(True)).alias("canal_principal"),
        F.max("max_monto_op_ars").alias("max_monto_op_ars"), F.sum("compras").alias("compras"),
        *[F.sum(c).alias(c) for c in added],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,4)").alias(c) for c in ("monto_ene", "monto_feb_mar")]
    ).withColumnRenamed("_ops", "ops")

    def dealt(col: str) -> DataFrame:
        if together:
            return enriched.groupBy("id_cliente", col).agg(n_ops())
        rows = enriched.select("id_cliente", col, F.pmod(F.xxhash64(col), F.lit(CLIENT_PARTS)).cast("int").alias("_part"))
        return rows.repartition(tasks, "id_cliente", "_part").groupBy("id_cliente", "_part", col).agg(n_ops())

    symbols = dealt("simbolo_titulo").groupBy("id_cliente").agg(
        F.count("simbolo_titulo").alias("simbolos"), _most_frequent("simbolo_titulo", F.lit(True)).alias("simbolo_principal"))
    active = dealt("dia_art").groupBy("id_cliente").agg(F.count("dia_art").alias("dias_activos"))
    return (totals.join(symbols, "id_cliente").join(active, "id_cliente")
            .withColumn("pct_compras", pct(F.col("compras"), F.col("ops"), 1))
            .withColumn("monto_ars", F.col("monto_ars").cast("decimal(38,4)"))
            .select(*PROFILE_COLUMNS))


def thresholds(profile: DataFrame, enriched: DataFrame, p: Params) -> DataFrame:
    """One row: exact population percentiles and the base rates of night and non-business trading."""
    per_client = profile.select(F.explode(F.array(
        F.struct(F.lit("ops").alias("medida"), F.col("ops").cast("decimal(38,4)").alias("valor")),
        F.struct(F.lit("cliente").alias("medida"), F.col("monto_ars").cast("decimal(38,4)").alias("valor")),
    )).alias("r")).select("r.*")
    per_trade = enriched.select(F.lit("operacion").alias("medida"), F.col("monto_ars").cast("decimal(38,4)").alias("valor"))
    marks = percentiles(per_client.unionByName(per_trade), ["medida"], "valor",
                        {"p50": 0.5, "alto": p.activity_quantile})

    def of(measure: str, mark: str) -> Column:
        return F.max(F.when(F.col("medida") == measure, F.col(mark)))

    # A client's profile has its counts already; the trades are not read again for them.
    base = profile.agg(F.struct(
        (F.sum("ops_madrugada") / F.sum("ops")).alias("night"),
        (F.sum("ops_dia_inhabil") / F.sum("ops")).alias("off")).alias("r")).scalar()
    return marks.agg(
        of("ops", "alto").alias("p999_ops"), of("cliente", "alto").alias("p999_monto_cliente"),
        of("ops", "p50").alias("p50_ops"), of("cliente", "p50").alias("p50_monto_cliente"),
        of("operacion", "alto").alias("p999_monto_op"),
    ).select("*", base.getField("night").alias("base_madrugada"), base.getField("off").alias("base_inhabil"))


def thresholds_report(limits: DataFrame) -> DataFrame:
    return limits.select(
        rounded(F.col("p999_ops"), 0).alias("p999_ops_cliente"),
        rounded(F.col("p999_monto_cliente"), 0).alias("p999_monto_cliente_ars"),
        rounded(F.col("p50_monto_cliente"), 0).alias("mediana_monto_cliente_ars"),
        rounded(F.col("p999_monto_op"), 0).alias("p999_monto_operacion_ars"),
        rounded(100 * F.col("base_madrugada"), 1).alias("pct_base_madrugada"),
        rounded(100 * F.col("base_inhabil"), 1).alias("pct_base_dia_inhabil"))


def limit(limits: DataFrame, name: str) -> Column:
    """One threshold as a scalar subquery: it stays in the plan and never passes through Python."""
    return limits.select(name).scalar()


def working_days(active: DataFrame, p: Params) -> DataFrame:
    """One row: business days with trades in the base period and after it, unless given. Of rated trades
    one column is read and each task passes on its few days; the cube need not be there."""
    if p.working_days:
        base, after = p.working_days
        return active.agg(F.lit(base).cast("long").alias("dh_ene"), F.lit(after).cast("long").alias("dh_feb_mar"))
    start, second, _, end = (F.lit(d) for d in p.period_starts)
    days = active.where("es_habil").select("dia_art").distinct()
    return days.agg(count_where((F.col("dia_art") >= start) & (F.col("dia_art") < second)).alias("dh_ene"),
                    count_where((F.col("dia_art") >= second) & (F.col("dia_art") < end)).alias("dh_feb_mar"))
