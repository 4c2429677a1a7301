"""Where intermediate results live: always a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local session may go without one; it gets a temporary folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = getattr(sc, "_tradewarden_dir", None)
        if named is None:
            named = sc._tradewarden_dir = tempfile.mkdtemp(prefix="tradewarden-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_here(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind. Without this they stay until the driver next collects its garbage, which
    can be long after the table they were for."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that lost executors cost no recomputation
    and a range partitioning is fixed once."""
    shared_dir(df.sparkSession)
    with shuffles_end_here(df.sparkSession):
        return df.select("*").checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Rows of a few small files over all cores. A table that already has a split per core is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Replace the Parquet table at path. For a partitioned table the rows are first brought together
    by partition; the rebalance splits a large partition over tasks and merges small ones, so that
    the number of files follows the data and not tasks times partitions. Rows sorted within their files
    let a reader of few keys skip most row groups by their footers."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    with shuffles_end_here(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


# Rows that one task writes of one key.
BUCKET_ROWS = 5_000_000


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class TableStore:
    """Named Parquet tables under a folder of this store's own below `root`, each written on first use and then read back.

    Reading back gives column pruning and filter pushdown to every later analytic. Two stores with one root never replace
    each other's tables."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self._id = spark, uuid.uuid4().hex
        self.root = f"{root or shared_dir(spark)}/tables-{self._id}"
        self._ready: set[str] = set()
        self._rows: dict[str, int] = {}
        self._named: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def get(self, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = (),
            sort_by: tuple[str, ...] = ()) -> DataFrame:
        if name not in self._ready:
            write_parquet(build(), self.path(name), partition_by, sort_by)
            self._ready.add(name)
        return self.spark.read.parquet(self.path(name))

    def bucketed(self, name: str, build: Callable[[], DataFrame], keys: Sequence[str], buckets: int, weight: str | None = None,
                 spread: str | None = None) -> DataFrame:
        """A table whose rows lie in one file per bucket of the keys, so that joins on the keys need no exchange of it and a
        look-up reads one bucket. Spark knows buckets of catalog tables only: the table has a name of its own there until `remove`.

        `weight` is the number of rows of the row's key. The rows of a key with more than BUCKET_ROWS are dealt by a hash of `spread`
        to several tasks, each of which writes a file of the bucket. Neither column is in the table, and neither is moved: of
        both a row takes along the number of its part."""
        table = f"tradewarden_{self._id}_{name}"
        if name not in self._ready:
            rows = build()
            if weight is None:
                rows = rows.repartition(buckets, *keys)
            else:
                part = F.pmod(F.xxhash64(spread), F.greatest(F.lit(1), F.ceil(F.col(weight) / BUCKET_ROWS)))
                rows = rows.withColumn("_part", part).drop(weight, spread)
                rows = rows.repartition(buckets, F.pmod(F.hash(*keys), F.lit(buckets)), "_part").drop("_part").sortWithinPartitions(*keys)
            with shuffles_end_here(self.spark):
                rows.write.mode("overwrite").bucketBy(buckets, *keys).option("path", self.path(name)).format("parquet").saveAsTable(table)
            self._named.append(table)
            self._ready.add(name)
        return self.spark.table(table)

    def has(self, name: str) -> bool:
        return name in self._ready

    def rows(self, name: str) -> int:
        """Rows of a stored table, counted once."""
        if name not in self._rows:
            self._rows[name] = self.spark.read.parquet(self.path(name)).count()
        return self._rows[name]

    def remove(self) -> None:
        """Delete every table of this store; frames read from them end here."""
        for table in self._named:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_folder(self.spark, self.root)
        self._ready, self._rows, self._named = set(), {}, []
