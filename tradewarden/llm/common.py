"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.sources.storage import remove_folder, shared_dir

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers must find this package wherever the driver was started.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; `remove_steps` deletes it."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    made = getattr(spark.sparkContext, "_llm_steps", [])
    made.append(path)
    spark.sparkContext._llm_steps = made
    return path


def remove_steps(spark: SparkSession) -> int:
    """Delete the folders of all steps of this session so far, and return their number. Results that weren't written
    elsewhere read from them and end here."""
    made = getattr(spark.sparkContext, "_llm_steps", [])
    for path in made:
        remove_folder(spark, path)
    spark.sparkContext._llm_steps = []
    return len(made)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: a lost executor costs no recomputation,
    and every later use sees the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, rows: int, per_part: int) -> int:
    """Number of parts for `rows` rows: `per_part` rows each, and at least two per shuffle partition."""
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def heaviest(rows: DataFrame, weight: str, most: int) -> DataFrame:
    """At most `most` rows, those with the largest weights (1 or more), down to a weight class that would be too many.

    Weights fall into some thousand classes by their logarithm; only the sizes of the classes reach the driver, and no
    task sorts the rows or gathers them."""
    kind = F.floor(F.log2(F.col(weight).cast("double")) * 16).cast("int")
    sizes = sorted(rows.groupBy(kind.alias("k")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.k)
    taken, least = 0, None
    for r in sizes:
        taken += r.n
        if taken > most:
            break
        least = r.k
    return rows.where(F.lit(False) if least is None else kind >= least)


def text_of(col: str) -> Column:
    """A text column as string, NULL as the empty text."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))
