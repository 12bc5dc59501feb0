"""Classes of values: digitising by edges, drought classes, percentile scores and level tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class levels.
EAR_QUANTILES = (0.05, 0.1, 0.25, 0.9)
USDM_QUANTILES = (0.02, 0.05, 0.1, 0.2, 0.3)
SPI_LEVELS = (-2.0, -1.5, -1.0, 1.0, 1.5, 2.0)
EAR_SCORES = (0.0, 5.0, 10.0, 25.0, 90.01, 100.0)
USDM_SCORES = (0.0, 2.0, 5.0, 10.0, 20.0, 30.0, 100.0)
FORECAST_LEVELS = (0.0, 50.0, 60.0, 70.0, 80.0, 90.0, 100.0)
TERCILE_LEVELS = (0.0, 10.0, 20.0, 40.0, 50.0, 60.0, 70.0, 100.0)
EAR_LABELS = ("severely dry", "seriously dry", "warning", "near normal or wetter", "seriously wet")
USDM_LABELS = ("D4", "D3", "D2", "D1", "D0", "None")
# Accumulation levels by period.
ACCUMULATION_LEVELS = {30: (10.0, 20.0, 40.0, 100.0, 200.0, 330.0), 60: (20.0, 40.0, 80.0, 200.0, 400.0, 660.0), 90: (30.0, 60.0, 120.0, 300.0, 600.0, 990.0), 180: (40.0, 80.0, 160.0, 400.0, 800.0, 1320.0)}
# Largest anomaly and step of its levels by period.
ANOMALY_LEVELS = {30: (300.0, 50.0), 60: (400.0, 50.0), 90: (600.0, 100.0), 180: (1000.0, 200.0), 360: (1400.0, 200.0)}


def digitize(x: Column, edges: Column, first: int = 1) -> Column:
    """Number of edges at or below x, counted from `first`; null for a null x."""
    return F.when(x.isNotNull() & edges.isNotNull(), F.size(F.filter(edges, lambda e: e <= x)) + first)


def digitize_levels(x: Column, levels, first: int = 0) -> Column:
    """Class of x among fixed levels."""
    return digitize(x, F.array(*[F.lit(float(v)) for v in levels]), first)


def labelled(category: Column, labels) -> Column:
    return F.get(F.array(*map(F.lit, labels)), category)


def percentile_bounds(edges: Column) -> tuple[Column, Column]:
    """Edges with 0 and 1 around them, and the categories 1..n between them."""
    return F.concat(F.array(F.lit(0.0)), edges, F.array(F.lit(1.0))), F.sequence(F.lit(1), F.size(edges) + 1)


def scores(values: DataFrame, climate: DataFrame, by: list[str], value: str = "precip", clim: str = "clim") -> DataFrame:
    """anomaly and weak percentile score (100 * share of the climatology at or below) of each value.

    values: one row for each group of `by`; climate: any number of rows of it. The climatology is aggregated against the
    value in the join's output without being collected.
    """
    joined = climate.join(values, by)
    score = 100 * F.avg(F.when(F.col(clim) <= F.col(value), 1.0).otherwise(0.0))
    return joined.groupBy(*by).agg(F.first(value).alias(value), (F.first(value) - F.avg(clim)).alias("anomaly"), score.alias("pctscore"))


def accumulation_class(x: Column, ndays: int) -> Column:
    return digitize_levels(x, ACCUMULATION_LEVELS[ndays])


def anomaly_class(x: Column, ndays: int) -> Column:
    most, step = ANOMALY_LEVELS[ndays]
    n = int(most / step)
    return digitize_levels(x, [step * i for i in range(-n, n + 1)])
