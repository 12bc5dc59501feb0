"""Reshaping of results into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide(df: DataFrame, keys: list[str], steps: list[int], categories: list[int], value: str = "prob") -> DataFrame:
    """One row for each key with a column s<step>_c<category>; columns are given, so that no job has to find them."""
    cells = [F.max(F.when((F.col("step") == s) & (F.col("category") == c), F.col(value))).alias(f"s{s}_c{c}") for s in steps for c in categories]
    return df.groupBy(*keys).agg(*cells)


def long(df: DataFrame, keys: list[str], steps: list[int], categories: list[int], value: str = "prob") -> DataFrame:
    """The inverse of wide()."""
    cells = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(c).alias("category"), F.col(f"s{s}_c{c}").alias(value)) for s in steps for c in categories])
    return df.select(*keys, F.inline(cells))


def frequencies(df: DataFrame, by: list[str], category: str) -> DataFrame:
    """Share of each category in its group; the groups' totals are one aggregation over the counts."""
    counts = df.groupBy(*by, category).agg(F.count("*").alias("n"))
    total = counts.groupBy(*by).agg(F.sum("n").alias("total")) if by else counts.agg(F.sum("n").alias("total"))
    joined = counts.join(total, by) if by else counts.crossJoin(F.broadcast(total))
    return joined.select(*by, category, "n", (F.col("n") / F.col("total")).alias("share"))
