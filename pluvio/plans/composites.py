"""Composed readers and products: models prepared for use, archives read around a date, statistics by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.operators import grid as g
from pluvio.operators import selection as sel
from pluvio.operators import verify as ver
from pluvio.operators import windows as win
from pluvio.sources import tables as t

from . import monitoring as mon
from ._registry import query


def prepare_model(raw: DataFrame, box: tuple | None = None) -> DataFrame:
    """One model's archive in the common form: names, longitudes 0-360, the domain, init the month before the first valid
    month, step 1, 2, ... by valid month, and the last system. raw: gcm, run, valid, number, latitude, longitude, value, system.
    """
    named = raw.withColumnsRenamed({"latitude": "lat", "longitude": "lon", "number": "member", "value": "precip"})
    named = named.withColumn("lon", g.roll_longitude(F.col("lon")))
    if box:
        named = sel.domain_box(named, box)
    runs = named.select("gcm", "run", "valid").distinct()
    runs = win.steps(runs, ["gcm", "run"], "valid")
    last = named.groupBy("gcm", "run").agg(F.max("system").alias("system"))
    return named.drop("system").join(runs, ["gcm", "run", "valid"]).join(last, ["gcm", "run"]).drop("run", "valid")


def one_model(members: DataFrame, years: tuple[int, int], gcm: list[str] | str = "MME", ensemble_mean: bool = True, anomalies: bool = True, by=("iy",)) -> DataFrame:
    """Models of these years, the mean of the members if asked, as monthly anomalies if asked; "MME" takes all models."""
    kept = sel.between_years(members, *years, time="init")
    if gcm != "MME":
        names = [gcm] if isinstance(gcm, str) else list(gcm)
        if not names:
            raise ValueError("no model is named")
        kept = kept.where(F.col("gcm").isin(names))
    keys = ["gcm", "step", *by]
    if ensemble_mean:
        kept = kept.groupBy("init", *keys).agg(F.avg("precip").alias("precip"))
    if anomalies:
        kept = kept.withColumn("precip", clim.anomaly("precip", keys, "init"))
    return kept


def _raw(spark, sf_dir) -> DataFrame:
    """The ensemble in an archive's form: valid months, longitudes from -180, and a system by member."""
    e = t.ensemble(spark, sf_dir)
    return e.select(
        "gcm",
        F.col("init").alias("run"),
        F.add_months("init", F.col("step") + 1).alias("valid"),
        F.col("member").alias("number"),
        (F.lit(-20.0) + 5 * F.col("iy")).alias("latitude"),
        (F.lit(-190.0) + 10 * F.col("iy")).alias("longitude"),
        F.col("precip").alias("value"),
        F.format_string("s%d", "member").alias("system"),
    )


@query(f"""WITH {t.SQL_ENS}, raw AS (SELECT gcm, init AS run, CAST(init + to_months(step + 1) AS DATE) AS valid, member, -20.0::DOUBLE + 5 * iy AS lat, (-190.0::DOUBLE + 10 * iy + 720) % 360 AS lon, precip, 's' || member AS system FROM ens),
k AS (SELECT * FROM raw WHERE lon BETWEEN 160 AND 200 AND lat BETWEEN -20 AND 0),
r AS (SELECT gcm, run, valid, row_number() OVER (PARTITION BY gcm, run ORDER BY valid) AS step, CAST(min(valid) OVER (PARTITION BY gcm, run) - INTERVAL 1 MONTH AS DATE) AS init FROM (SELECT DISTINCT gcm, run, valid FROM k)),
s AS (SELECT gcm, run, max(system) AS system FROM k GROUP BY ALL)
SELECT k.gcm, k.member, k.lat, k.lon, round(k.precip, 9) AS precip, CAST(r.step AS INTEGER) AS step, r.init, s.system FROM k JOIN r USING (gcm, run, valid) JOIN s USING (gcm, run)""")
def src15_win9_prepare_model(spark, sf_dir):
    return prepare_model(_raw(spark, sf_dir), (160, 200, -20, 0)).withColumn("precip", F.round("precip", 9))


@query(f"""WITH {t.SQL_ENS}, m AS (SELECT gcm, init, step, iy, avg(precip) AS precip FROM ens WHERE year(init) BETWEEN 1996 AND 2000 GROUP BY ALL)
SELECT gcm, init, step, iy, round(precip - avg(precip) OVER (PARTITION BY month(init), gcm, step, iy), 9) AS precip FROM m""")
def src13_src14_models(spark, sf_dir):
    return one_model(t.ensemble(spark, sf_dir), (1996, 2000)).withColumn("precip", F.round("precip", 9))


@query(f"WITH {t.SQL_ENS} SELECT gcm, init, step, iy, member, round(precip - avg(precip) OVER (PARTITION BY month(init), gcm, step, iy), 11) AS precip FROM ens WHERE gcm IN ('A', 'R') AND year(init) BETWEEN 1997 AND 1998")
def src14_members_of_named_models(spark, sf_dir):
    out = one_model(t.ensemble(spark, sf_dir), (1997, 1998), ["A", "R"], ensemble_mean=False)
    return out.select("gcm", "init", "step", "iy", "member", F.round("precip", 11).alias("precip"))


@query(f"WITH {t.SQL_ENS} SELECT DISTINCT gcm, CAST(year(init) AS INTEGER) AS year FROM ens")
def src12_available_period(spark, sf_dir):
    return t.ensemble(spark, sf_dir).select("gcm", F.year("init").alias("year")).distinct()


@query(f"""WITH {t.SQL_MONTHLY} SELECT iy, ix, time, round(precip * day(last_day(time)), 6) AS month_total, round(precip - avg(precip) OVER (PARTITION BY month(time), iy, ix), 6) AS anomaly
FROM monthly WHERE time BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def src16_src17_src18_monthly_archive(spark, sf_dir):
    m = sel.between_years(t.obs_monthly(spark, sf_dir).withColumn("time", cal.month_begin(F.col("time"))), 1996, 1999)
    total = cal.monthly_from_daily_rate(F.col("precip"), F.col("time"))
    return m.select("iy", "ix", "time", F.round(total, 6).alias("month_total"), F.round(clim.anomaly("precip", ["iy", "ix"]), 6).alias("anomaly"))


@query(f"""WITH {t.SQL_OBS}, o AS (SELECT *, {mon._DOY} AS day FROM obs), e AS (SELECT iy, day, CAST(sum(CAST(round(precip * 10) AS BIGINT)) AS BIGINT) AS total, count(precip) AS n FROM o GROUP BY iy, day),
c AS (SELECT iy, (day + b - 1 + 365) % 365 + 1 AS day, CAST(sum(total) AS DOUBLE) / CAST(sum(n) AS DOUBLE) / 10 AS average FROM e, (SELECT unnest(range(-7, 8)) AS b) GROUP BY ALL)
SELECT iy, ix, time, precip, round(average, 9) AS average FROM o JOIN c USING (iy, day)""")
def jn9_src23_doy_join(spark, sf_dir):
    """Observations with the climatology of their day of year: an equality join on the calendar day.

    Sums of the days are made first, so that fifteen days share a row for each day of the year and not each row. Whole
    tenths add up alike in any order."""
    obs = t.obs_daily(spark, sf_dir).withColumn("doy", cal.doy(F.col("time"), "correct"))
    days = obs.groupBy("iy", "doy").agg(F.sum(F.round(F.col("precip") * 10).cast("long")).alias("total"), F.count("precip").alias("n"))
    near = F.transform(F.sequence(F.lit(-7), F.lit(7)), lambda i: F.pmod(F.col("doy") + i - 1, F.lit(365)) + 1)
    c = days.withColumn("doy", F.explode(near)).groupBy("iy", "doy").agg((F.sum("total") / F.sum("n") / 10).alias("average"))
    return obs.join(c, ["iy", "doy"]).select("iy", "ix", "time", "precip", F.round("average", 9).alias("average"))


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, round(min(precip), 6) AS least, round(max(precip), 6) AS most, count(precip) AS n, count(*) AS days, round(stddev_pop(precip), 6) AS sd_pop, round(stddev_samp(precip), 6) AS sd_samp FROM obs GROUP BY iy, ix""")
def agg13_agg14_agg15_statistics(spark, sf_dir):
    p = F.col("precip")
    aggregates = {"least": F.min(p), "most": F.max(p), "sd_pop": F.stddev_pop(p), "sd_samp": F.stddev_samp(p)}
    return t.obs_daily(spark, sf_dir).groupBy("iy", "ix").agg(*[F.round(v, 6).alias(k) for k, v in aggregates.items()], F.count(p).alias("n"), F.count("*").alias("days"))


_SCORED = f"""{t.SQL_OBS}, {mon._CLIM_SQL}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {mon._LAST90} GROUP BY iy, ix),
s AS (SELECT iy, ix, round(100 * avg(CASE WHEN clim <= precip THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS s FROM clim JOIN now USING (iy, ix) GROUP BY iy, ix)"""


def _class_sql(levels) -> str:
    return f"CAST(len(list_filter({list(levels)}, lambda x: x <= s)) AS INTEGER)"


@query(f"""WITH {_SCORED} SELECT iy, ix, {_class_sql(cls.EAR_SCORES)} AS ear, {_class_sql(cls.USDM_SCORES)} AS usdm, {_class_sql(cls.FORECAST_LEVELS)} AS forecast_level,
  {_class_sql(cls.TERCILE_LEVELS)} AS tercile_level, CAST(least(floor(s / 10) + 1, 10) AS INTEGER) AS decile FROM s""")
def cat6_cat8_score_classes(spark, sf_dir):
    s = mon.scored(spark, sf_dir).select("iy", "ix", F.round("pctscore", 6).alias("s"))
    at = lambda levels: cls.digitize_levels(F.col("s"), levels)
    decile = F.least(F.floor(F.col("s") / 10) + 1, F.lit(10)).cast("int")
    return s.select("iy", "ix", at(cls.EAR_SCORES).alias("ear"), at(cls.USDM_SCORES).alias("usdm"), at(cls.FORECAST_LEVELS).alias("forecast_level"), at(cls.TERCILE_LEVELS).alias("tercile_level"), decile.alias("decile"))


@query(f"""WITH {t.SQL_MONTHLY}, i AS (SELECT time, avg(precip) AS x FROM monthly GROUP BY time), r AS (SELECT iy, ix, corr(precip, x) AS r FROM monthly JOIN i USING (time) GROUP BY iy, ix)
SELECT iy, ix, round(r, 6) AS r, CAST(CASE WHEN r >= 0.3 THEN 1 END AS INTEGER) AS high, CAST(CASE WHEN r <= -0.05 THEN 1 END AS INTEGER) AS low FROM r""")
def sta14_loading_mask(spark, sf_dir):
    """A mask from a pattern's loadings: at or beyond a threshold, on the threshold's side of zero."""
    m = t.obs_monthly(spark, sf_dir)
    r = m.join(m.groupBy("time").agg(F.avg("precip").alias("x")), "time").groupBy("iy", "ix").agg(F.corr("precip", "x").alias("r"))
    side = lambda v: F.when(F.col("r") >= v if v > 0 else F.col("r") <= v, 1)
    return r.select("iy", "ix", F.round("r", 6).alias("r"), side(0.3).alias("high"), side(-0.05).alias("low"))


@query(f"""WITH {t.SQL_SERIES}, a AS (SELECT time, value AS f FROM series WHERE name = (SELECT min(name) FROM series)), b AS (SELECT time, value AS o FROM series WHERE name = (SELECT max(name) FROM series) AND day(time) <> 3),
j AS (SELECT CAST(CASE WHEN f > 9000 THEN 2 ELSE 1 END AS INTEGER) AS f, CAST(CASE WHEN o > 9000 THEN 2 ELSE 1 END AS INTEGER) AS o, o IS NULL AS gap FROM a LEFT JOIN b USING (time))
SELECT round(avg(CASE WHEN f = o THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy, count(*) AS n FROM j WHERE NOT gap""")
def ver7_table_accuracy(spark, sf_dir):
    """Accuracy over the rows of a table in which both sides are there."""
    s = t.series(spark, sf_dir)
    ends = s.agg(F.min("name").alias("a"), F.max("name").alias("b")).first()
    klass = lambda c: F.when(F.col(c) > 9000, 2).when(F.col(c).isNotNull(), 1)
    f = s.where(F.col("name") == ends.a).select("time", F.col("value").alias("f"))
    o = s.where((F.col("name") == ends.b) & (F.day("time") != 3)).select("time", F.col("value").alias("o"))
    both = f.join(o, "time", "left").select(klass("f").alias("f"), klass("o").alias("o")).dropna()
    return both.agg(F.round(ver.accuracy(), 9).alias("accuracy"), F.count("*").alias("n"))


@query(f"""WITH {t.SQL_CELLS} SELECT iy, ix, CASE WHEN lon - 175 < 0 THEN lon - 175 + 360 ELSE lon - 175 END AS shifted, floor((lon - 175) / 180) AS side FROM cells""")
def geo7_shifted_longitudes(spark, sf_dir):
    """Longitudes after a shift of the seam, and the side of it on which a cell lies."""
    moved = F.col("lon") - 175
    return t.cells(spark, sf_dir).select("iy", "ix", g.roll_longitude(moved).alias("shifted"), F.floor(moved / 180).cast("double").alias("side"))
