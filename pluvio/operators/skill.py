"""Skill of ensemble means over any dimensions: anomaly correlation and errors from moments that can be merged.

A group of (forecast, observation) pairs is summed up by its size, means and centred second moments. Groups merge without
their rows and without cancellation, so that one pass over the pairs gives maps, series and pooled scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ways to choose the pairs of a lead: all there are, initial months that have every lead, valid months that have every lead.
ALIGNMENTS = ("maximize", "same_inits", "same_verif")
#: A variance up to this is none: a score that divides by it is null.
NO_VARIANCE = 1e-18


def with_multi_model(pairs: DataFrame, case: list[str], model: str = "gcm", forecast: str = "f", observed: str = "o", name: str = "MME") -> DataFrame:
    """The pairs of all models and, as a further model, their mean for each case; a model without a forecast has no share."""
    mean = pairs.groupBy(*case).agg(F.avg(forecast).alias(forecast), F.first(observed, ignorenulls=True).alias(observed))
    return pairs.select(model, *case, forecast, observed).unionByName(mean.withColumn(model, F.lit(name)))


def aligned(pairs: DataFrame, how: str, by: list[str], init: str = "init", step: str = "step") -> DataFrame:
    """The pairs that a comparison of leads may use, within each group of `by`.

    maximize: all; a lead has as many as there are. same_inits: of initial months that have a pair at each lead of their
    group. same_verif: of valid months that have a pair at each lead. Leads are those that the group has anywhere. The
    counts are of small tables (a row for each month and lead), joined back by equality.
    """
    if how not in ALIGNMENTS:
        raise ValueError(f"alignment {how!r}; known are {', '.join(ALIGNMENTS)}")
    if how == "maximize":
        return pairs
    month = F.col(init) if how == "same_inits" else F.add_months(init, F.col(step))
    told = pairs.withColumn("_month", month)
    leads = told.select(*by, step).distinct().groupBy(*by).agg(F.count("*").alias("_leads"))
    full = told.select(*by, "_month", step).distinct().groupBy(*by, "_month").agg(F.count("*").alias("_n"))
    kept = full.join(leads, by).where("_n = _leads").select(*by, "_month") if by else full.crossJoin(F.broadcast(leads)).where("_n = _leads").select("_month")
    return told.join(kept, [*by, "_month"], "left_semi").drop("_month")


def moments(pairs: DataFrame, by: list[str], forecast: str = "f", observed: str = "o") -> DataFrame:
    """n, the means mf and mo, the centred moments ff, oo and fo, and the squared errors se of each group.

    Pairs with a missing side are left out; a group without pairs has no row."""
    f, o = F.col(forecast).cast("double"), F.col(observed).cast("double")
    both = pairs.where(f.isNotNull() & o.isNotNull())
    n = F.count("*")
    return both.groupBy(*by).agg(
        n.alias("n"),
        F.avg(f).alias("mf"),
        F.avg(o).alias("mo"),
        (F.var_pop(f) * n).alias("ff"),
        (F.var_pop(o) * n).alias("oo"),
        (F.covar_pop(f, o) * n).alias("fo"),
        F.sum((f - o) * (f - o)).alias("se"),
    )


def pooled(groups: DataFrame, by: list[str]) -> DataFrame:
    """Moments of coarser groups, from those of finer ones: what lies within them and between their means."""
    w = Window.partitionBy(*by)
    mean = lambda c: F.sum(F.col("n") * F.col(c)).over(w) / F.sum("n").over(w)
    apart = groups.withColumns({"_f": mean("mf"), "_o": mean("mo")}).withColumns({"_f": F.col("mf") - F.col("_f"), "_o": F.col("mo") - F.col("_o")})
    within = lambda c, a, b: F.sum(F.col(c) + F.col("n") * F.col(a) * F.col(b)).alias(c)
    middle = lambda c: (F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c)
    return apart.groupBy(*by).agg(
        F.sum("n").alias("n"), middle("mf"), middle("mo"), within("ff", "_f", "_f"), within("oo", "_o", "_o"), within("fo", "_f", "_o"), F.sum("se").alias("se")
    )


def scores() -> dict[str, Column]:
    """Scores from moments: anomaly correlation, root mean squared error, bias, slope of the observations on the forecasts,
    and the mean squared error's skill against the observations' own mean. Of anomalies where f and o are anomalies."""
    n, ff, oo, fo, se = (F.col(c) for c in ("n", "ff", "oo", "fo", "se"))
    some = lambda c: c / n > NO_VARIANCE
    return {
        "acc": F.when(some(ff) & some(oo), fo / F.sqrt(ff * oo)),
        "rmse": F.sqrt(se / n),
        "bias": F.col("mf") - F.col("mo"),
        "slope": F.when(some(ff), fo / ff),
        "msss": F.when(some(oo), 1 - se / oo),
    }


def skill(pairs: DataFrame, by: list[str], cell: list[str], init: str = "init") -> DataFrame:
    """Scores of each group of `by` over three choices of dimensions, in one table with the column dims:

    "init": over initial months, a map with a row for each cell; "cell": over cells, a series with a row for each initial
    month; "init,cell": over both, a row. What a row is pooled over is null in it.
    """
    maps = moments(pairs, [*by, *cell])
    series = moments(pairs, [*by, init])
    kept = {c: pairs.schema[c].dataType for c in [*cell, init]}
    whole = lambda df, dims: df.select(*by, F.lit(dims).alias("dims"), *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kept.items()], "n", *[v.alias(k) for k, v in scores().items()])
    return whole(maps, "init").unionByName(whole(series, "cell")).unionByName(whole(pooled(maps, by), "init,cell"))
