"""Ensemble forecasts: category probabilities, multi-model means, rounding, outlooks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .classify import digitize

#: Numbers of categories and their names.
CATEGORIES = {3: "tercile", 4: "quartile", 10: "decile", 21: "percentile"}


def categorise(df: DataFrame, climatology: DataFrame, on: list[str], value: str = "precip") -> DataFrame:
    """category 1..N of each value by the edges of its group in the climatology; the small side may be broadcast by size."""
    return df.join(climatology.select(*on, "edges"), on).withColumn("category", digitize(F.col(value), F.col("edges"))).drop("edges")


def probabilities(df: DataFrame, by: list[str], n: int, category: str = "category") -> DataFrame:
    """prob (0-100) of each category 1..n: members in it over all members, missing ones included. All categories are rows.

    One grouping counts all categories at once; the counts are then unfolded, so that empty categories need no join.
    """
    if n not in CATEGORIES:
        raise ValueError(f"{n} categories; known are {sorted(CATEGORIES)}")
    counts = [F.sum(F.when(F.col(category) == k, 1).otherwise(0)).alias(f"_{k}") for k in range(1, n + 1)]
    wide = df.groupBy(*by).agg(F.count("*").alias("_n"), *counts)
    share = F.array(*[F.least(F.greatest(100.0 * F.col(f"_{k}") / F.col("_n"), F.lit(0.0)), F.lit(100.0)) for k in range(1, n + 1)])
    return wide.select(*by, F.posexplode(share).alias("category", "prob")).withColumn("category", F.col("category") + 1)


def most_likely(category: str = "category", prob: str = "prob") -> Column:
    """The category of the highest probability, the first on ties."""
    return F.max_by(category, F.struct(F.col(prob), -F.col(category)))


def median_category(df: DataFrame, by: list[str]) -> DataFrame:
    """The first category at which the cumulative probability reaches one half."""
    total = F.sum("prob").over(Window.partitionBy(*by).orderBy("category").rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_total", total).groupBy(*by).agg(F.min(F.when(F.round("_total", 6) >= 50, F.col("category"))).alias("median_category"))


def renormalised(by: list[str], prob: str = "prob") -> Column:
    """Shares of 100 within each group."""
    return F.try_divide(100 * F.col(prob), F.sum(prob).over(Window.partitionBy(*by)))


def rounded_to_100(df: DataFrame, by: list[str], order: str = "category", prob: str = "prob", digits: int = 0) -> DataFrame:
    """Largest-remainder rounding: shares that add up to 100 exactly; equal remainders go to the first categories."""
    scale = 10**digits
    whole = Window.partitionBy(*by)
    share = F.round(F.col(prob) / F.sum(prob).over(whole) * 100 * scale, 9)
    out = df.withColumn("_share", share).withColumns({"_floor": F.floor("_share"), "_part": F.col("_share") - F.floor("_share")})
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_part"), order))
    extra = 100 * scale - F.sum("_floor").over(whole)
    return out.withColumn("rounded", (F.col("_floor") + F.when(rank <= extra, 1).otherwise(0)) / scale).drop("_share", "_floor", "_part")


def below_above(df: DataFrame, by: list[str], last_below: int) -> DataFrame:
    """below: probability of categories up to last_below; above: of the rest."""
    k = F.col("category")
    part = lambda c: F.sum(F.when(c, F.col("prob")).otherwise(0.0))
    return df.groupBy(*by).agg(part(k <= last_below).alias("below"), part(k > last_below).alias("above"))


def multi_model(df: DataFrame, by: list[str], value: str = "prob", gcm: str = "gcm", label: str = "MME") -> DataFrame:
    """The models' rows and their mean as a model of its own."""
    mean = df.groupBy(*by).agg(F.avg(value).alias(value)).withColumn(gcm, F.lit(label))
    return df.select(gcm, *by, value).unionByName(mean)


def outlook(pctscore: Column, below: Column, above: Column, low: float = 25.0, high: float = 40.0, least: float = 50.0) -> Column:
    """Water-stress outlook 1..3, null if none: dry now and likely to stay (1, 2) or dry now and likely to end (3).

    Of the rules that hold the highest number counts: 1 at a score up to `high` with `below` at `least`; 2 the same with a
    score above `low`; 3 at a score up to `low` with `above` at `least`.
    """
    return F.greatest(
        F.when((pctscore <= high) & (below >= least), 1),
        F.when((pctscore > low) & (pctscore <= high) & (below >= least), 2),
        F.when((pctscore <= low) & (above >= least), 3),
    )
