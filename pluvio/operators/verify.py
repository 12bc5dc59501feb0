"""Verification of categorical and deterministic forecasts against observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lead_join(forecast: DataFrame, observed: DataFrame, cell: list[str], init: str = "init", step: str = "step", time: str = "time") -> DataFrame:
    """Forecasts with the observation of their valid month: an equality join on the derived month."""
    return forecast.withColumn(time, F.add_months(init, F.col(step))).join(observed, [time, *cell])


def contingency(df: DataFrame, by: list[str], k: int, forecast: str = "f", observed: str = "o") -> DataFrame:
    """tp, fp, fn, tn of class k in one pass; pairs with a missing side count as not being of the class."""
    f, o = (F.coalesce(F.col(c) == k, F.lit(False)) for c in (forecast, observed))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return df.groupBy(*by).agg(n(f & o).alias("tp"), n(f & ~o).alias("fp"), n(~f & o).alias("fn"), n(~f & ~o).alias("tn"))


def scores() -> dict[str, Column]:
    """Precision, recall, F1, intersection over union and one-against-rest accuracy from contingency columns."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        "iou": F.try_divide(tp, tp + fp + fn),
        "one_vs_rest": F.try_divide(tp + tn, tp + fp + fn + tn),
    }


def confusion(df: DataFrame, n: int, by: list[str] | None = None, forecast: str = "f", observed: str = "o") -> DataFrame:
    """A row for each forecast class 1..n with the counts of each observed class o1..on, zeros included."""
    cells = [F.sum(F.when((F.col(forecast) == i) & (F.col(observed) == j), 1).otherwise(0)).alias(f"_{i}_{j}") for i in range(1, n + 1) for j in range(1, n + 1)]
    wide = df.groupBy(*(by or [])).agg(*cells)
    rows = F.array(*[F.struct(F.lit(i).alias("f"), *[F.col(f"_{i}_{j}").alias(f"o{j}") for j in range(1, n + 1)]) for i in range(1, n + 1)])
    return wide.select(*(by or []), F.inline(rows))


def accuracy(forecast: str = "f", observed: str = "o") -> Column:
    """Share of pairs with equal classes; pairs with a missing side are left out."""
    return F.avg((F.col(forecast) == F.col(observed)).cast("int"))


def heidke(df: DataFrame, by: list[str], n: int, forecast: str = "f", observed: str = "o") -> DataFrame:
    """accuracy and Heidke skill score over n classes, from one grouping."""
    pairs = df.where(f"{forecast} is not null and {observed} is not null")
    side = lambda c, k: F.sum(F.when(F.col(c) == k, 1).otherwise(0))
    wide = pairs.groupBy(*by).agg(F.count("*").alias("_n"), accuracy(forecast, observed).alias("accuracy"), *[side(c, k).alias(f"_{c}{k}") for c in (forecast, observed) for k in range(1, n + 1)])
    chance = sum((F.col(f"_{forecast}{k}") * F.col(f"_{observed}{k}") for k in range(2, n + 1)), F.col(f"_{forecast}1") * F.col(f"_{observed}1")) / (F.col("_n") * F.col("_n"))
    return wide.select(*by, "accuracy", F.try_divide(F.col("accuracy") - chance, 1 - chance).alias("hss"))


def tolerant_accuracy(df: DataFrame, by: list[str], case: list[str], tolerance: float, observed: str = "o") -> DataFrame:
    """Share of cases hit: the observed category is the most likely, or its probability is within `tolerance` of it.

    df: a row for each case and category with its prob and the case's observed category.
    """
    own = F.max(F.when(F.col("category") == F.col(observed), F.col("prob")))
    one = df.groupBy(*dict.fromkeys([*by, *case])).agg((F.max("prob") - own <= tolerance).alias("_hit"))
    return one.groupBy(*by).agg(F.avg(F.coalesce(F.col("_hit"), F.lit(False)).cast("int")).alias("accuracy"))


def deterministic(df: DataFrame, by: list[str], forecast: str = "f", observed: str = "o") -> DataFrame:
    """corr, rmse, bias and n of each group."""
    f, o = F.col(forecast), F.col(observed)
    both = f.isNotNull() & o.isNotNull()
    return df.where(both).groupBy(*by).agg(F.corr(f, o).alias("corr"), F.sqrt(F.avg((f - o) * (f - o))).alias("rmse"), F.avg(f - o).alias("bias"), F.count("*").alias("n"))


def rps(df: DataFrame, by: list[str], case: list[str], observed: str = "o") -> DataFrame:
    """Mean ranked probability score. df: cumulative shares need a row for each case and category, with prob (0-100)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*dict.fromkeys([*by, *case])).orderBy("category").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.sum("prob").over(w) / 100 - F.when(F.col(observed) <= F.col("category"), 1.0).otherwise(0.0)
    one = df.where(F.col(observed).isNotNull()).withColumn("_gap", gap).groupBy(*dict.fromkeys([*by, *case])).agg(F.sum(F.col("_gap") * F.col("_gap")).alias("_rps"))
    return one.groupBy(*by).agg(F.avg("_rps").alias("rps"))


def phase(index: Column, threshold: float, strict: bool = False) -> Column:
    """warm, cold or neutral by an index."""
    warm, cold = (index > threshold, index < -threshold) if strict else (index >= threshold, index <= -threshold)
    return F.when(warm, "warm").when(cold, "cold").when(index.isNotNull(), "neutral")


def in_phase(df: DataFrame, phases: DataFrame, name: str, on: list[str]) -> DataFrame:
    """Rows at the times of a phase: a semi join."""
    return df.join(phases.where(F.col("phase") == name), on, "left_semi")
