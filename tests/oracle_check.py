"""Runs registered queries and their SQL counterparts side by side.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _cell(v.item())
    return v


def rows(columns: list[str], values) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(_cell(r[i]) for i in order) for r in values]
    return [columns[i] for i in order], sorted(data, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None where both agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    cols, got = rows(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    want_cols, want = rows([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"columns {sorted(set(cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{len(bad)} of {len(got)} rows differ: {diff[:4]}"
    return None if got else "both empty"


def session():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(entry.queries())
    spark, con, failed = session(), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
