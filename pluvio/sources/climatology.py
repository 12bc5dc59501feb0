"""Running sums kept as a table by day of the year, and read for the days around given dates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.calendar import doy

from .files import write_cube


def write_sums(sums: DataFrame, path: str, time: str = "time") -> None:
    """A folder for each day of the year (29 February is one with 28's successor, 1 to 365), of all years.

    A day's rows are dealt out by cell too, so that a task writes few days' files and no day is a task of its own. Days
    that are there already are replaced.
    """
    dated = sums.where(F.col(time).isNotNull()).withColumn("doy", doy(F.col(time), "correct"))
    write_cube(dated.repartition("doy", "iy"), path, ["doy"])


def around(targets: DataFrame, half: int, time: str = "time") -> DataFrame:
    """(target, doy): the days of the year within `half` days of each different date, past the year's end too."""
    day = doy(F.col("target"), "correct")
    near = F.explode(F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda i: F.pmod(day + i - 1, F.lit(365)) + 1))
    return targets.where(F.col(time).isNotNull()).select(F.col(time).alias("target")).distinct().select("target", near.alias("doy"))


def read_around(spark: SparkSession, path: str, schema: str, targets: DataFrame, half: int, time: str = "time") -> DataFrame:
    """The store's rows, of all years, whose day of the year is within `half` days of a target, with `target`.

    schema: the store's columns besides doy, so that no file is opened to find it. The days are known only as the query
    runs: Spark prunes the store's folders by them, so that a month's dates read a month of a store of any length.
    """
    store = spark.read.schema(f"{schema}, doy int").parquet(path)
    # All days pass; the condition tells Spark that it is worth while to prune by them.
    days = around(targets, half, time).where(F.col("doy").between(1, 365))
    return store.join(days, "doy")
