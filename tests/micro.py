"""Small raw trades for the edge cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewarden.params import Params
from tradewarden.sources.raw import RAW_SCHEMA, type_trades

ZONE = Params().local_zone


def trades(spark: SparkSession, *rows: dict) -> DataFrame:
    base = {"fecha": "2026-01-05T15:00:00.000Z", "tipoTran": "Compra", "id_cliente": "CLI1", "descripcion_titulo": "Accion",
            "moneda": "ARS", "simbolo_titulo": "YPFD", "cantidad": "1", "precio": "100", "origen": "API"}
    full = [{**base, "id_transaccion": f"t{i}", **r} for i, r in enumerate(rows)]
    return type_trades(spark.createDataFrame([tuple(r[c] for c in RAW_SCHEMA.names) for r in full], RAW_SCHEMA), ZONE)
