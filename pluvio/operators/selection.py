"""Selections on tidy cubes: boxes, calendar parts, labels, masks and complete members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Named domains as lon_min, lon_max, lat_min, lat_max.
DOMAINS = {
    "Tropical_Pacific": (140.0, 220.0, -25.0, 25.0),
    "SW_Pacific": (172.5, 190.0, -22.5, -12.0),
    "Fiji": (175.0, 183.0, -21.0, -15.0),
    "NZ": (161.0, 181.0, -50.0, -30.0),
    "Pacific": (140.0, 240.0, -50.0, 25.0),
    "C3S_download": (100.0, 240.0, -50.0, 30.0),
    "Monitoring": (125.0, 240.0, -35.0, 25.0),
}


def domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in DOMAINS.items()], "name string, lon_min double, lon_max double, lat_min double, lat_max double")


def in_box(lon: Column, lat: Column, box: tuple) -> Column:
    """Inside a box, both ends included."""
    return lon.between(box[0], box[1]) & lat.between(box[2], box[3])


def domain_box(df: DataFrame, box: tuple, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.where(in_box(F.col(lon), F.col(lat), box))


def bounding_domain(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return df.agg(F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"), F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"))


def expand_box(box: tuple, degrees: float) -> tuple:
    if len(box) != 4:
        raise ValueError("a box is lon_min, lon_max, lat_min, lat_max")
    return (box[0] - degrees, box[1] + degrees, box[2] - degrees, box[3] + degrees)


def between_years(df: DataFrame, first: int, last: int, time: str = "time") -> DataFrame:
    """Rows of these years, as a range of dates that a scan can prune by."""
    return df.where(F.col(time).between(F.lit(f"{first}-01-01").cast("date"), F.lit(f"{last}-12-31").cast("date")))


def in_months(df: DataFrame, months: list[int], time: str = "time") -> DataFrame:
    return df.where(F.month(time).isin(months))


def drop_first(df: DataFrame, n: int, by: list[str], time: str = "time") -> DataFrame:
    """Without the first n rows of each series."""
    order = Window.partitionBy(*by).orderBy(time)
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") > n).drop("_n")


def masked(value: Column, condition: Column, other=None) -> Column:
    """The value where the condition holds, `other` (null) elsewhere, also where the condition is null."""
    return F.when(condition, value).otherwise(F.lit(other))


def drop_labels(df: DataFrame, column: str, labels: list) -> DataFrame:
    return df.where(~F.col(column).isin(labels) | F.col(column).isNull())


def clipped(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Within bounds; null stays null."""
    out = value
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def complete_members(df: DataFrame, member: list[str], value: str = "precip") -> DataFrame:
    """Without the members that have a missing value anywhere."""
    bad = df.where(F.col(value).isNull()).select(*member).distinct()
    return df.join(bad, member, "left_anti")
