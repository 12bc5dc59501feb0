"""Accumulations, rain-day statistics and moving windows per cell. Series must be dense: one row a day, null if missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["iy", "ix"]
#: Accumulation periods of the daily run.
PERIODS = (30, 60, 90, 180, 360)


def accumulate(df: DataFrame, last_day, ndays: int, cell: list[str] = CELL, time: str = "time", value: str = "precip") -> DataFrame:
    """Sum of the ndays days to last_day for each cell; missing days count as nothing, all missing gives 0."""
    day = F.lit(last_day).cast("date")
    recent = df.where(F.col(time).between(F.date_sub(day, ndays - 1), day))
    total = F.coalesce(F.sum(value), F.lit(0.0))
    return recent.groupBy(*cell).agg(total.alias(value)).withColumns({"ndays": F.lit(ndays), "last_day": day})


def rain_days(df: DataFrame, last_day, ndays: int, threshold: float = 1.0, cell: list[str] = CELL, time: str = "time", value: str = "precip") -> DataFrame:
    """wet_days, dry_days and days_since_rain over the ndays days to last_day.

    A day is wet at `threshold` or more; a missing day is dry. Without a wet day, days_since_rain is ndays - 1.
    """
    day = F.lit(last_day).cast("date")
    recent = df.where(F.col(time).between(F.date_sub(day, ndays - 1), day))
    wet = F.col(value) >= threshold
    n = F.sum(F.when(wet, 1).otherwise(0))
    since = F.coalesce(F.datediff(day, F.max(F.when(wet, F.col(time)))), F.lit(ndays - 1))
    return recent.groupBy(*cell).agg(n.alias("wet_days"), (F.lit(ndays) - n).alias("dry_days"), since.alias("days_since_rain"))


def _frame(by: list[str], order: str, before: int, after: int) -> Window:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(-before, after)


def full_window(function, value: str, n: int, by: list[str], order: str, centred: bool = False) -> Column:
    """function(value) over a trailing (or centred) window of n rows; null unless all n values are there."""
    half = (n - 1) // 2
    frame = _frame(by, order, n - 1 - half if centred else n - 1, half if centred else 0)
    return F.when(F.count(value).over(frame) == n, function(value).over(frame))


def running_sums(df: DataFrame, periods=PERIODS, by: list[str] = CELL, time: str = "time", value: str = "precip") -> DataFrame:
    """A column sum_<n>d for each period, all from one sort of the series."""
    return df.withColumns({f"sum_{n}d": full_window(F.sum, value, n, by, time) for n in periods})


def seasonal(df: DataFrame, by: list[str], order: str, value: str = "precip", how: str = "sum", n: int = 3) -> DataFrame:
    """Three-step (or -month) sums of rainfall, or means of other variables; incomplete windows are dropped."""
    out = full_window(F.sum if how == "sum" else F.avg, value, n, by, order)
    return df.withColumn("_full", out).where("_full is not null").drop(value).withColumnRenamed("_full", value)


def construct(df: DataFrame, half: int = 7, by: list[str] = CELL, time: str = "time", value: str = "precip") -> DataFrame:
    """Rows (…, time, buffer, value): the 2 * half + 1 values around each day; places beyond the series are null."""
    w = Window.partitionBy(*by).orderBy(time)
    places = F.array(*[F.lag(value, half - i).over(w) if i <= half else F.lead(value, i - half).over(w) for i in range(2 * half + 1)])
    return df.select(*by, time, places.alias("_places")).select(*by, time, F.posexplode("_places").alias("buffer", value))


def cumulative(value: Column, by: list[str], order: str) -> Column:
    return F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def gradient(value: str, by: list[str], order: str) -> Column:
    """Central differences by row number, one-sided at the ends."""
    w = Window.partitionBy(*by).orderBy(order)
    back, ahead = F.lag(value).over(w), F.lead(value).over(w)
    here = F.col(value)
    return F.when(back.isNull(), ahead - here).when(ahead.isNull(), here - back).otherwise((ahead - back) / 2)


def steps(df: DataFrame, by: list[str], valid: str) -> DataFrame:
    """step 1, 2, ... by the order of the valid times, and init, the month before the first."""
    first = F.min(valid).over(Window.partitionBy(*by))
    return df.withColumns({"step": F.row_number().over(Window.partitionBy(*by).orderBy(valid)), "init": F.add_months(first, -1)})
