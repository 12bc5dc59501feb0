"""Climate indices: box means of anomalies, combined, smoothed and standardised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .climatology import anomaly
from .selection import in_box
from .windows import full_window

# Boxes as lon_min, lon_max, lat_min, lat_max.
SPSD = {"nw": (170, 190, -50, -35), "se": (220, 240, -57.5, -45)}
NINO = {"1+2": (270, 280, -10, 0), "3": (210, 270, -5, 5), "4": (160, 210, -5, 5), "3.4": (190, 240, -5, 5), "oni": (190, 240, -5, 5)}


def box_mean(value: str, box: tuple, lon: str = "lon", lat: str = "lat") -> Column:
    """Unweighted mean over a box, for use in a grouping by time."""
    return F.avg(F.when(in_box(F.col(lon), F.col(lat), box), F.col(value)))


def box_means(df: DataFrame, boxes: dict[str, tuple], value: str = "sst", time: str = "time") -> DataFrame:
    """A column for each box by time, all from one grouping."""
    return df.groupBy(time).agg(*[box_mean(value, b).alias(k) for k, b in boxes.items()])


def monthly_anomaly(value: Column, time: str = "time", base: tuple[int, int] | None = None) -> Column:
    kept = value if base is None else F.when(F.year(time).between(*base), value)
    return value - F.avg(kept).over(Window.partitionBy(F.month(time)))


def smoothed(df: DataFrame, column: str, n: int, time: str = "time") -> Column:
    """Trailing mean of n rows of a single series."""
    return full_window(F.avg, column, n, [], time)


def scaled(value: Column, base: Column | None = None, sample: bool = False, centred: bool = True) -> Column:
    """A series over its standard deviation, less its mean if centred; over the rows of a base period where given."""
    kept = value if base is None else F.when(base, value)
    whole = Window.partitionBy()
    spread = (F.stddev_samp if sample else F.stddev_pop)(kept).over(whole)
    return F.try_divide(value - (F.avg(kept).over(whole) if centred else F.lit(0.0)), spread)


def nino(df: DataFrame, region: str = "3.4", n: int = 5, value: str = "sst", time: str = "time") -> DataFrame:
    """(time, index): box mean, monthly anomaly, mean of n months, over its standard deviation; "tni" is 1+2 less 4.

    The series that is left after the grouping is one row a month, whatever the size of the grid.
    """
    if region != "tni" and region not in NINO:
        raise ValueError(f"region {region!r}; known are {', '.join([*NINO, 'tni'])}")
    if region != "tni":
        s = box_means(df, {"x": NINO[region]}, value, time).withColumn("x", monthly_anomaly(F.col("x"), time))
        s = s.withColumn("x", smoothed(s, "x", n, time))
    else:
        s = box_means(df, {"a": NINO["1+2"], "b": NINO["4"]}, value, time).withColumns({c: monthly_anomaly(F.col(c), time) for c in "ab"})
        s = s.withColumns({c: scaled(F.col(c), centred=False) for c in "ab"}).withColumn("x", F.col("a") - F.col("b"))
        s = s.withColumn("x", smoothed(s, "x", n, time))
    return s.select(time, scaled(F.col("x"), centred=False).alias("index"))


def modoki(a: Column, b: Column, c: Column) -> Column:
    """Central box less half of each side box."""
    return a - 0.5 * b - 0.5 * c


def dipole(west: Column, east: Column) -> Column:
    """Difference of two standardised series."""
    return scaled(west) - scaled(east)


def subtropical_dipole(df: DataFrame, base: tuple[int, int], n: int = 3, value: str = "sst", time: str = "time") -> DataFrame:
    """(time, spsd, spsd_<n>): the South Pacific subtropical dipole by month and its mean of n months, stamped at month ends.

    Anomalies of every cell are taken against the months of the base years, averaged over both poles, standardised on the
    base years (as a sample), subtracted north-west less south-east, and standardised on them again. Null where a pole has
    no cell or the base years no spread. After the box means the series has a row a month.
    """
    anomalies = df.withColumn("_a", anomaly(value, ["lon", "lat"], time, base))
    poles = box_means(anomalies, {"nw": SPSD["nw"], "se": SPSD["se"]}, "_a", time)
    inside = F.year(time).between(*base)
    dipole_ = poles.withColumns({c: scaled(F.col(c), inside, sample=True) for c in ("nw", "se")}).withColumn("_d", F.col("nw") - F.col("se"))
    out = dipole_.withColumn("spsd", scaled(F.col("_d"), inside, sample=True))
    return out.select(F.last_day(time).alias(time), "spsd", smoothed(out, "spsd", n, time).alias(f"spsd_{n}"))


def composite(df: DataFrame, phases: DataFrame, name: str, by: list[str], value: str, time: str = "time") -> DataFrame:
    """Mean at the times of a phase."""
    return df.join(phases.where(F.col("phase") == name).select(time), time, "left_semi").groupBy(*by).agg(F.avg(value).alias(value))
