"""Risk score per client, its reasons and levels."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.functions.exprs import binomial_z, millions, pct
from tradewarden.params import (
    CHANGE_ABRUPT, CHANGE_NO_HISTORY, LEVEL_HIGH, LEVEL_LOW, LEVEL_MEDIUM, WEIGHTS, Params)
from tradewarden.plans.patterns import behaviour_columns, extreme, heavy, often, value_gap
from tradewarden.plans.profile import limit

FLAGS = tuple(f for f in WEIGHTS if WEIGHTS[f] > 0)


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def level(score: Column, p: Params) -> Column:
    return (F.when(score >= p.high_score, LEVEL_HIGH).when(score >= p.medium_score, LEVEL_MEDIUM)
            .otherwise(LEVEL_LOW))


def risk_score(profile: DataFrame, limits: DataFrame, days: DataFrame, p4: DataFrame, p: Params) -> DataFrame:
    """Every flagged client with profile, flags, score, reasons and level.

    Activity, hours and change of behaviour are functions of the client's own profile row, so they
    are columns here; only the off-market trades, already added up per client, are joined."""
    gaps = p4.groupBy("id_cliente").agg(F.count("*").alias("_gaps"), F.sum(F.abs(value_gap())).alias("_gap"))
    rows = behaviour_columns(profile, days, p).join(gaps, "id_cliente", "left")

    def unusual(hits: str, base: str) -> Column:
        return binomial_z(F.col(hits), F.col("ops"), limit(limits, base)) >= F.lit(p.p2_z).cast("decimal(9,4)")

    flagged = rows.withColumns({
        "f_precio_fuera_mercado": F.col("_gaps").isNotNull(),
        "f_cambio_brusco": _flag(F.col("tipo_cambio") == CHANGE_ABRUPT),
        "f_sin_historial_monto_alto": _flag(F.col("tipo_cambio") == CHANGE_NO_HISTORY),
        "f_actividad_alta": _flag(often(limits) | heavy(limits)),
        "f_operacion_extrema": _flag(extreme(limits, "max_monto_op_ars")),
        "f_horario_atipico": _flag((F.col("ops") >= p.p2_min_ops)
                                   & (unusual("ops_madrugada", "base_madrugada") | unusual("ops_dia_inhabil", "base_inhabil"))),
    })
    score = reduce(add, [F.col(f).cast("int") * w for f, w in WEIGHTS.items()])
    reasons = F.concat_ws(" | ", *[F.when(F.col(f), text) for f, text in p.reasons().items()])
    money = [F.round(c, 2).alias(c) for c in ("monto_ars", "max_monto_op_ars", "monto_ene", "monto_feb_mar")]
    total, largest, base, after = money
    return (flagged.where(reduce(lambda a, b: a | b, [F.col(f) for f in FLAGS]))
            .select("id_cliente", "canal_principal", "canales", "ops", "dias_activos", "simbolos", "simbolo_principal",
                    total, largest, "pct_compras", "ops_ene", "ops_feb", "ops_mar", base, after, "ops_madrugada",
                    "ops_dia_inhabil", "f_precio_fuera_mercado", "f_cambio_brusco", "f_sin_historial_monto_alto",
                    "f_actividad_alta", "f_operacion_extrema", "f_horario_atipico",
                    F.coalesce("_gaps", F.lit(0)).alias("ops_precio_fuera"),
                    F.round(F.coalesce("_gap", F.lit(0)), 2).alias("diferencia_valor_ars"),
                    score.alias("score"), reasons.alias("motivos"), level(score, p).alias("nivel_riesgo")))


def risk_levels(risk: DataFrame, profile: DataFrame) -> DataFrame:
    everyone = profile.agg(F.sum("monto_ars")).scalar()
    return (risk.groupBy("nivel_riesgo").agg(
        F.count("*").alias("clientes"), F.sum("ops").alias("ops"), F.sum("monto_ars").alias("_m"),
        F.min("score").alias("_s")).orderBy(F.desc("_s")).select(
        "nivel_riesgo", "clientes", "ops", millions(F.col("_m")).alias("monto_ars_mill"),
        pct(F.col("_m"), everyone, 1).alias("pct_monto_total")))


def review_queue(risk: DataFrame, p: Params, k: int = 30) -> DataFrame:
    return (risk.where(F.col("score") >= p.queue_score)
            .orderBy(F.desc("score"), F.desc("monto_ars"), "id_cliente").limit(k)
            .select("id_cliente", "nivel_riesgo", "score", "canal_principal", "ops",
                    millions(F.col("monto_ars")).alias("monto_ars_mill"), "motivos"))
