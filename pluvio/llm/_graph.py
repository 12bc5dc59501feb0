"""Connected components as Spark joins, and tables for results that are read again."""

from __future__ import annotations

from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether Spark removes a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _folder(spark: SparkSession) -> str:
    """The folder that the cluster's machines share: spark.checkpoint.dir. Where it is unset, a session on one machine, as
    in tests, has one in its warehouse; a cluster must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def _sized(df: DataFrame) -> DataFrame:
    """df as it is where Spark sizes partitions by their bytes; where that is off, four shuffle partitions to a task, so
    that a table is no swarm of tiny files."""
    conf = df.sparkSession.conf
    if all(conf.get(f"spark.sql.adaptive.{x}", "true") == "true" for x in ("enabled", "coalescePartitions.enabled")):
        return df
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, int(conf.get("spark.sql.shuffle.partitions")) // 4))


def shared(df: DataFrame) -> DataFrame:
    """`df` checkpointed in the shared folder, with its lineage cut. Spark's cleaner owns the files: it removes them when
    the frame is no longer used, if spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_folder(df.sparkSession))
    return _sized(df).checkpoint(eager=True)


class _DroppedShuffles:
    """While any job is inside, the session drops a job's shuffle files when it ends; afterwards its setting is as before."""

    lock, inside, before = Lock(), 0, None

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        kind = _DroppedShuffles
        with kind.lock:
            if not kind.inside:
                kind.before = self.conf.get(_CLEANUP, None)
                self.conf.set(_CLEANUP, "true")
            kind.inside += 1

    def __exit__(self, *_) -> None:
        kind = _DroppedShuffles
        with kind.lock:
            kind.inside -= 1
            if not kind.inside:
                self.conf.unset(_CLEANUP) if kind.before is None else self.conf.set(_CLEANUP, kind.before)


class Scratch:
    """Compressed tables in the shared folder for results that are read again inside a step: `with Scratch(spark) as s`.

    All go when the block ends, also by an error, so that what leaves the block must not read them. The shuffle files of
    the job that writes a table go when it ends, as the table takes their place.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{_folder(spark)}/tables/{uuid4().hex}"
        self.n = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self.n}"
        self.n += 1
        with _DroppedShuffles(self.spark):
            _sized(df).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (hi, lo) with hi > lo."""
    both = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).unionByName(
        edges.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
    )
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    large = both.join(least, "x").where("y > x and y > m").select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct()
    least = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    edges: columns a, b (long), in any direction; loops and repeats are allowed, rows with a null are left out. Large-star
    and small-star steps alternate until the edges no longer change, each step one pair of aggregations and joins whose
    hot nodes the adaptive skew join splits. Every step is checkpointed. Without edges there are no rows.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now, seen = shared(now), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen, now = mark, shared(_stars(now))
    return (
        now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        .unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")))
        .distinct()
    )


def side(prefix: str, df: DataFrame) -> DataFrame:
    """df with a prefix before each column's name."""
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])
