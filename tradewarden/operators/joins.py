"""Joins of a very large, possibly skewed side with a keyed side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a narrow key table that are safe to ship to every executor (well under 100 MB).
BROADCAST_ROWS = 500_000
# A key counts as hot when it owns more than 1 / HOT_SHARE of the rows, so at most HOT_SHARE are hot.
HOT_SHARE = 1000
# Salts of rows that are known to match nothing.
FREE_SALTS = 1024


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def _with_salts(keyed: DataFrame, weight: str, hot_share: int) -> DataFrame:
    """Add the number of salts of each key: more than one where it owns over 1 / hot_share of all rows."""
    chunk = F.greatest(F.lit(1), F.floor(keyed.agg(F.sum(weight)).scalar() / F.lit(hot_share)))
    return keyed.withColumn("_salts", F.ceil(F.col(weight) / chunk).cast("int"))


def _salt_rows(big: DataFrame, salted: DataFrame, on: Sequence[str], salt: str, free: Column | None = None) -> DataFrame:
    """Add `_salt`: rows of hot keys are spread by a hash of column `salt`, and so are `free` rows, which match no key."""
    hot = F.broadcast(salted.where(F.col("_salts") > 1).select(*on, F.col("_salts").alias("_spread")))
    spread = F.coalesce("_spread", F.lit(1))
    if free is not None:
        spread = F.when(free, F.lit(FREE_SALTS)).otherwise(spread)
    return (big.join(hot, list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(salt), spread).cast("int")).drop("_spread"))


def _salt_keys(salted: DataFrame) -> DataFrame:
    """A row per key and salt."""
    return (salted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_salts"), F.lit(1)) - 1)))
            .drop("_salts"))


def keyed_join(big: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, salt: str, how: str = "inner",
               broadcast_rows: int | None = None, hot_share: int | None = None, keyed_rows: int | None = None) -> DataFrame:
    """Join `big` with `keyed`, which has one row per key and in `weight` the number of big rows of
    that key (dropped from the result for a semi join).

    A small `keyed` is broadcast, after counting it unless `keyed_rows` tells. Otherwise the rows of hot keys are spread over
    several salts, by a hash of column `salt`, and the key's row is repeated once per salt. By the
    pigeonhole principle there are at most `hot_share` hot keys, so their list is always broadcast."""
    on = list(on)
    if (keyed.count() if keyed_rows is None else keyed_rows) <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return big.join(F.broadcast(keyed), on, how)
    salted = _with_salts(keyed, weight, HOT_SHARE if hot_share is None else hot_share)
    return _salt_rows(big, salted, on, salt).join(_salt_keys(salted), [*on, "_salt"], how).drop("_salt")


def bucket_layout(big: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, salt: str, free: Column | None = None) -> DataFrame:
    """The rows of `big` with the salt that keyed_join would give them, to be stored in buckets of (`on`, _salt). `free` marks
    rows that match no key and may lie anywhere."""
    return _salt_rows(big, _with_salts(keyed, weight, HOT_SHARE), on, salt, free)


def bucketed_join(stored: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, how: str = "left") -> DataFrame:
    """Join rows that are stored in buckets of (`on`, _salt) with the keys they were laid out by: only the keys move, and each
    bucket meets its keys in a hash table, so the rows are neither shuffled nor sorted."""
    keys = _salt_keys(_with_salts(keyed, weight, HOT_SHARE)).hint("shuffle_hash")
    return stored.join(keys, [*on, "_salt"], how).drop("_salt")
