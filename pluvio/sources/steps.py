"""Results that are read again, in the folder that the cluster's machines share, and over how many tasks rows are dealt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """`df` checkpointed, its lineage cut: in spark.checkpoint.dir, which a cluster must set. A session on one machine that
    sets none, as in tests, has the folder in its warehouse. Spark's cleaner removes the files if
    spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
            folder = spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def dealer(df: DataFrame, rows: int) -> Callable[..., DataFrame]:
    """What deals a frame over tasks by the given keys, so that a task holds about `rows` of the rows of `df` or fewer.

    Spark sizes the partitions of a shuffle by its bytes alone; a step that makes many rows of one, or sorts them several
    times, would hold ever more in a task. A frame of no more than `rows` for each core stays as it is. There are never fewer
    partitions than spark.sql.shuffle.partitions, to which a join would deal its sides again. `df` is counted, which costs
    little for what is kept.
    """
    n, context = df.count(), df.sparkSession.sparkContext
    if n <= rows * context.defaultParallelism:
        return lambda frame, *_: frame
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows))
    return lambda frame, *keys: frame.repartition(parts, *keys)
