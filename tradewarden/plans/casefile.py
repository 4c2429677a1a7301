"""Nested case files of the flagged clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.functions.exprs import count_where, exact, ratio
from tradewarden.operators.joins import BROADCAST_ROWS, join_same, keyed_join
from tradewarden.operators.ranking import medians_by_group, running_total
from tradewarden.params import BUY, LEVEL_HIGH, LEVEL_MEDIUM, SELL, Params
from tradewarden.plans.explore import n_ops
from tradewarden.sources.storage import settle


def flagged_trades(enriched: DataFrame, risk: DataFrame) -> DataFrame:
    """The trades of flagged clients. A client's number of trades is known, so hot clients are split."""
    return weighted_flagged_trades(enriched, risk).drop("_ops")


def weighted_flagged_trades(enriched: DataFrame, risk: DataFrame) -> DataFrame:
    """With the number of the client's trades as `_ops`."""
    known = risk.select("id_cliente", F.col("ops").alias("_ops"))
    return keyed_join(enriched, known, ["id_cliente"], "_ops", "id_transaccion")


def flagged_in_place(stored: DataFrame, risk: DataFrame) -> DataFrame:
    """Of trades in buckets of the client, those of flagged clients: only the clients move, and each bucket meets its own."""
    return stored.join(risk.select("id_cliente").hint("shuffle_hash"), "id_cliente", "left_semi")


def ops_by_channel(ops: DataFrame) -> DataFrame:
    """Ordered map channel -> trades, largest first. Its size is the number of channels."""
    cells = ops.groupBy("id_cliente", "origen").agg(n_ops())
    entries = F.sort_array(F.collect_list(F.struct((-F.col("ops")).alias("n"), F.col("origen").alias("k"))))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e.getField("k"), -e.getField("n"))))
    return cells.groupBy("id_cliente").agg(as_map.alias("ops_por_canal"))


def _whole(amount: Column) -> Column:
    return F.round(amount, 0).cast("decimal(38,0)")


def top5_instruments(ops: DataFrame, k: int = 5) -> DataFrame:
    """A client's k most traded symbols. The row_number limit is applied on the map side first."""
    cells = ops.groupBy("id_cliente", "simbolo_titulo").agg(
        F.count("*").alias("n"), count_where(F.col("tipo_tran") == BUY).alias("compras"),
        count_where(F.col("tipo_tran") == SELL).alias("ventas"), F.sum("monto_ars").alias("m"))
    order = Window.partitionBy("id_cliente").orderBy(F.desc("n"), F.desc("m"), "simbolo_titulo")
    best = cells.withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= k)
    entries = F.sort_array(F.collect_list(F.struct(
        "rk", F.col("simbolo_titulo").alias("simbolo"), "compras", "ventas", _whole(F.col("m")).alias("monto_ars"))))
    plain = F.transform(entries, lambda e: F.struct(*[e.getField(f).alias(f) for f in (
        "simbolo", "compras", "ventas", "monto_ars")]))
    return best.groupBy("id_cliente").agg(plain.alias("top_instrumentos"))


def same_day_round_trips(ops: DataFrame) -> DataFrame:
    """'n de m': of m (day, symbol) cells, n have both sides."""
    cells = ops.groupBy("id_cliente", "dia_art", "simbolo_titulo").agg(
        count_where(F.col("tipo_tran") == BUY).alias("nc"), count_where(F.col("tipo_tran") == SELL).alias("nv"))
    both = count_where((F.col("nc") > 0) & (F.col("nv") > 0))
    return cells.groupBy("id_cliente").agg(
        F.concat(both.cast("string"), F.lit(" de "), F.count("*").cast("string"))
        .alias("dias_especie_compra_y_venta_mismo_dia"))


def client_dates_median(ops: DataFrame, together: bool = False) -> DataFrame:
    """First and last day, median amount; the median is exact and rounds half to even."""
    dates = ops.groupBy("id_cliente").agg(F.min("dia_art").alias("primera"), F.max("dia_art").alias("ultima"))
    median = medians_by_group(ops, ["id_cliente"], "monto_ars", "mediana", together=together)
    return dates.join(median, "id_cliente").select(
        "id_cliente", "primera", "ultima", F.bround("mediana", 0).cast("decimal(38,0)").alias("monto_mediano_op_ars"))


def half_even(value: Column) -> Column:
    return F.bround(exact(value), 0).cast("decimal(38,0)")


def p4_detail_nested(p4: DataFrame, p: Params) -> DataFrame:
    """A client's off-market trades in time order, as arrays of at most `detail_chunk` entries.

    Nearly every client has the one part 0, whose trades move once. A client with more trades continues in parts 1, 2, ..:
    its trades are numbered in slices. Nothing is dropped and no task collects an unbounded array."""
    order = ["fecha_art", "id_transaccion"]
    entry = F.struct(
        F.date_format("fecha_art", "yyyy-MM-dd HH:mm:ss").alias("fecha"), F.col("tipo_tran").alias("operacion"),
        F.col("simbolo_titulo").alias("simbolo"), "cantidad", F.col("precio").alias("precio_operado"),
        F.round("precio_mediana_dia", 2).alias("precio_mercado_dia"), F.col("origen").alias("canal"))
    rows = p4.select("id_cliente", *order, entry.alias("_entry"))
    long = settle(rows.groupBy("id_cliente").agg(F.count("*").alias("_n")).where(F.col("_n") > p.detail_chunk).select("id_cliente"))
    n_long = long.count()
    few = F.broadcast(long) if n_long <= BROADCAST_ROWS else long
    short = (join_same(rows, few, ["id_cliente"], "left_anti") if n_long else rows).repartition("id_cliente")
    detail = short.groupBy("id_cliente").agg(_in_order(*order)).withColumn("parte", F.lit(0))
    if n_long:
        numbered = running_total(join_same(rows, few, ["id_cliente"], "left_semi").withColumn("_one", F.lit(1).cast("long")),
                                 order, {"_pos": "_one"}, ["id_cliente"])
        part = F.floor(F.col("_pos") / p.detail_chunk).cast("int")
        detail = detail.unionByName(numbered.groupBy("id_cliente", part.alias("parte")).agg(_in_order("_pos")))
    return detail.select("id_cliente", "parte", "detalle")


def _in_order(*order: str) -> Column:
    entries = F.sort_array(F.collect_list(F.struct(*order, "_entry")))
    return F.transform(entries, lambda e: e.getField("_entry")).alias("detalle")


def population_reference(profile: DataFrame, limits: DataFrame) -> DataFrame:
    median = limits.select("p50_monto_cliente").scalar()
    return profile.agg(ratio(F.sum("ops"), F.count("*"), 1).alias("prom_ops"), F.max(half_even(median)).alias("mediana_monto"))


def profile_extras(ops: DataFrame) -> DataFrame:
    """Mean amount per trade, smallest and largest quantity per order."""
    return ops.groupBy("id_cliente").agg(
        ratio(F.sum("monto_ars"), F.count("*"), 0).cast("decimal(38,0)").alias("monto_promedio_por_operacion_ars"),
        F.min("cantidad").alias("nominales_min"), F.max("cantidad").alias("nominales_max"))


def trade_fields(ops: DataFrame, together: bool = False) -> list[DataFrame]:
    """What the trades alone tell of a client: tables of a row per client."""
    return [ops_by_channel(ops), top5_instruments(ops), same_day_round_trips(ops), client_dates_median(ops, together)]


def case_fields(risk: DataFrame, ops: DataFrame, p4: DataFrame, population: DataFrame, p: Params,
                together: bool = False, hot: DataFrame | None = None) -> DataFrame:
    """A row per flagged client with the 26 fields of its case file, nested ones as structs, and
    last the exact amount, which only orders the files.

    `together`: a client's trades lie in one partition of `ops`, so they are cut down where they are. `hot` are then those of
    clients with too many for that, which are not among `ops`.

    A client whose off-market trades fill several parts has a row per part: `parte` of `partes`, the first with the whole
    profile and the others with the rest of the list. Both are NULL for all other clients."""
    pop = population.select(F.struct(
        F.col("prom_ops").cast("decimal(20,1)").alias("promedio_operaciones_por_cliente"),
        F.col("mediana_monto").alias("mediana_monto_total_por_cliente_ars"))).scalar()
    # A client has one part for each `detail_chunk` trades.
    parts = F.ceil(F.col("ops_precio_fuera") / p.detail_chunk).cast("int")
    detail = p4_detail_nested(p4, p).join(risk.select(
        "id_cliente", "nivel_riesgo", "score", "monto_ars", F.when(parts > 1, parts).alias("partes")), "id_cliente")
    first_part = detail.where(F.col("parte") == 0).select("id_cliente", "detalle", "partes")
    rows, sides = risk, trade_fields(ops, together)
    if hot is not None:
        sides = [few.unionByName(many) for few, many in zip(sides, trade_fields(hot))]
    for side in (*sides, first_part):
        rows = rows.join(side, "id_cliente", "left")
    zero = F.lit(0)
    profiles = rows.select(
        "id_cliente", "nivel_riesgo", "score", F.col("motivos").alias("reglas_disparadas"), "canal_principal",
        F.col("ops_por_canal").alias("operaciones_por_canal"), F.col("ops").alias("operaciones_total"),
        F.struct(F.col("ops_ene").alias("enero"), F.col("ops_feb").alias("febrero"),
                 F.col("ops_mar").alias("marzo_hasta_13")).alias("operaciones_por_mes"),
        F.struct(_whole(F.col("monto_ene")).alias("enero"),
                 _whole(F.col("monto_feb_mar")).alias("febrero_marzo")).alias("monto_por_periodo_ars"),
        F.col("primera").alias("primera_operacion"), F.col("ultima").alias("ultima_operacion"), "dias_activos",
        ratio(F.col("ops"), F.col("dias_activos"), 1).cast("decimal(20,1)").alias("operaciones_por_dia_activo"),
        _whole(F.col("monto_ars")).alias("monto_total_ars"),
        _whole(F.col("max_monto_op_ars")).alias("monto_maximo_operacion_ars"),
        F.col("monto_mediano_op_ars").alias("monto_mediano_operacion_ars"),
        F.col("simbolos").alias("especies_distintas"), "top_instrumentos",
        F.col("pct_compras").cast("decimal(5,1)").alias("pct_compras"), "dias_especie_compra_y_venta_mismo_dia",
        F.col("ops_madrugada").alias("operaciones_madrugada"), F.col("ops_dia_inhabil").alias("operaciones_dia_inhabil"),
        F.nullif(F.col("ops_precio_fuera"), zero).alias("operaciones_precio_fuera_de_mercado"),
        F.col("detalle").alias("detalle_precio_fuera_de_mercado"),
        _whole(F.nullif(F.col("diferencia_valor_ars"), zero.cast("decimal(38,2)"))).alias("diferencia_valor_vs_mercado_ars"),
        pop.alias("referencia_poblacion"), F.when(F.col("partes").isNotNull(), F.lit(0)).alias("parte"), "partes", "monto_ars")
    further = detail.where(F.col("parte") > 0).select(
        "id_cliente", "nivel_riesgo", "score", F.col("detalle").alias("detalle_precio_fuera_de_mercado"), "parte", "partes", "monto_ars")
    return profiles.unionByName(further, allowMissingColumns=True)


def level_order() -> Column:
    return F.when(F.col("nivel_riesgo") == LEVEL_HIGH, 1).when(F.col("nivel_riesgo") == LEVEL_MEDIUM, 2).otherwise(3)


def client_profile_json(cases: DataFrame) -> DataFrame:
    """One JSON document per client and part, empty fields left out, in review order."""
    document = F.to_json(F.struct(*[c for c in cases.columns if c != "monto_ars"]))
    return (cases.orderBy(level_order(), F.desc("score"), F.desc("monto_ars"), "id_cliente", F.col("parte").asc_nulls_first())
            .select("id_cliente", "nivel_riesgo", "score", document.alias("perfil")))


def lookup_client(cases: DataFrame, client: Column | str) -> DataFrame:
    return cases.where(F.col("id_cliente") == client)


def list_clients(clients: DataFrame, level: str | None = None, rule: str | None = None) -> DataFrame:
    """Flagged clients of a level, or with a rule (one of the p1_.. p4_ flags)."""
    rows = clients.where(F.col("score_riesgo") > 0)
    if level is not None:
        rows = rows.where(F.col("nivel_riesgo") == level)
    if rule is not None:
        rows = rows.where(F.col(rule))
    return (rows.select("id_cliente", "nivel_riesgo", "score_riesgo", "motivos")
            .orderBy(F.desc("score_riesgo"), "id_cliente"))


def lookup_case(risk: DataFrame, flagged: DataFrame, p4: DataFrame, population: DataFrame, p: Params, client: Column | str) -> DataFrame:
    """The case file of one client, built from that client's rows alone: of the flagged trades one bucket is read."""
    only = [df.where(F.col("id_cliente") == client) for df in (risk, flagged, p4)]
    return case_fields(*only, population, p)


def daily_job(documents: DataFrame, min_score: int = 2) -> DataFrame:
    """The documents the daily job hands on."""
    return documents.where(F.col("score") >= min_score)
