"""Realtime monitoring: accumulations, rain days, climatologies, scores and drought classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.functions import special
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.operators import windows as win
from pluvio.sources import climatology as store
from pluvio.sources import files
from pluvio.sources import tables as t
from pluvio.sources.steps import kept

from ._registry import query

DAY = "2001-06-30"
CELL = ["iy", "ix"]
_LAST90 = f"time BETWEEN DATE '{DAY}' - 89 AND DATE '{DAY}'"
#: Sums of the same calendar windows in the years before: the climatology of the accumulation.
_CLIM_SQL = f"""clim AS (SELECT iy, ix, y, coalesce(sum(precip), 0) AS clim FROM obs JOIN (SELECT unnest(range(1996, 2001)) AS y)
  ON time BETWEEN make_date(y, 6, 30) - 89 AND make_date(y, 6, 30) GROUP BY ALL)"""


def accumulation_history(spark, sf_dir, ndays: int = 90, years=(1996, 2000)):
    """(iy, ix, y, clim): the accumulation that ended on the same calendar day of each year, from one scan."""
    obs = t.obs_daily(spark, sf_dir)
    ends = F.transform(F.sequence(F.lit(years[0]), F.lit(years[1])), lambda y: F.make_date(y, F.lit(6), F.lit(30)))
    wanted = F.filter(ends, lambda e: F.col("time").between(F.date_sub(e, ndays - 1), e))
    return obs.select("iy", "ix", "precip", F.explode(wanted).alias("e")).groupBy("iy", "ix", F.year("e").alias("y")).agg(F.coalesce(F.sum("precip"), F.lit(0.0)).alias("clim"))


def scored(spark, sf_dir):
    now = win.accumulate(t.obs_daily(spark, sf_dir), DAY, 90).select("iy", "ix", "precip")
    return cls.scores(now, accumulation_history(spark, sf_dir), CELL)


@query(f"WITH {t.SQL_OBS} SELECT iy, ix, round(coalesce(sum(precip), 0), 6) AS precip, 90 AS ndays, DATE '{DAY}' AS last_day FROM obs WHERE {_LAST90} GROUP BY iy, ix")
def agg1_accumulation(spark, sf_dir):
    return win.accumulate(t.obs_daily(spark, sf_dir), DAY, 90).withColumn("precip", F.round("precip", 6))


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, CAST(sum(CASE WHEN precip >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS wet_days,
  CAST(90 - sum(CASE WHEN precip >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS dry_days,
  CAST(coalesce(DATE '{DAY}' - max(CASE WHEN precip >= 5 THEN time END), 89) AS INTEGER) AS days_since_rain FROM obs WHERE {_LAST90} GROUP BY iy, ix""")
def agg2_rain_days(spark, sf_dir):
    return win.rain_days(t.obs_daily(spark, sf_dir), DAY, 90, threshold=5.0)


@query(f"""WITH {t.SQL_MONTHLY}, x AS (SELECT *, CAST(time - DATE '1995-01-01' AS DOUBLE) / 1000 AS x FROM monthly WHERE precip IS NOT NULL),
f AS (SELECT *, x - avg(x) OVER w AS p FROM x WINDOW w AS (PARTITION BY iy, ix)),
q AS (SELECT *, p * p - avg(p * p) OVER w - sum(p * p * p) OVER w / nullif(sum(p * p) OVER w, 0) * p AS q FROM f WINDOW w AS (PARTITION BY iy, ix)),
r AS (SELECT *, p * p * p - avg(p * p * p) OVER w - sum(p * p * p * p) OVER w / nullif(sum(p * p) OVER w, 0) * p - sum(p * p * p * q) OVER w / nullif(sum(q * q) OVER w, 0) * q AS r FROM q WINDOW w AS (PARTITION BY iy, ix)),
s AS (SELECT *, precip - avg(precip) OVER w - sum(precip * p) OVER w / nullif(sum(p * p) OVER w, 0) * p - sum(precip * q) OVER w / nullif(sum(q * q) OVER w, 0) * q AS second, sum(precip * r) OVER w / nullif(sum(r * r) OVER w, 0) * r AS third FROM r WINDOW w AS (PARTITION BY iy, ix))
SELECT iy, ix, time, round(second, 5) AS residual_2, round(second - third, 5) AS residual_3 FROM s""")
def sta6_polynomial(spark, sf_dir):
    """Monthly sums less a parabola and less a cubic of each cell; the SQL has the same curves by orthogonal polynomials."""
    m = t.obs_monthly(spark, sf_dir).withColumn("x", F.datediff("time", F.lit("1995-01-01").cast("date")).cast("double"))
    out = clim.polynomial_detrended(m, "precip", "x", CELL, (2, 3))
    return out.select(*CELL, "time", *[F.round(f"residual_{d}", 5).alias(f"residual_{d}") for d in (2, 3)])


@query(f"""WITH {t.SQL_OBS}, {_CLIM_SQL}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {_LAST90} GROUP BY iy, ix)
SELECT *, CAST(CASE WHEN pctscore >= 100 THEN 6 WHEN pctscore >= 90.01 THEN 5 WHEN pctscore >= 25 THEN 4 WHEN pctscore >= 10 THEN 3 WHEN pctscore >= 5 THEN 2 ELSE 1 END AS INTEGER) AS ear
FROM (SELECT iy, ix, round(any_value(precip), 6) AS precip, round(any_value(precip) - avg(clim), 6) AS anomaly,
  round(100 * avg(CASE WHEN clim <= precip THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS pctscore FROM clim JOIN now USING (iy, ix) GROUP BY iy, ix)""")
def sta2_scores(spark, sf_dir):
    s = scored(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("precip", "anomaly", "pctscore")})
    return s.withColumn("ear", cls.digitize_levels(F.col("pctscore"), cls.EAR_SCORES))


@query(f"""WITH {t.SQL_OBS}, {_CLIM_SQL} SELECT iy, ix, round(avg(clim), 6) AS average,
  list_transform(quantile_cont(clim, [0.05, 0.1, 0.25, 0.9]), lambda x: round(x, 6)) AS edges FROM clim GROUP BY iy, ix""")
def agg8_quantiles(spark, sf_dir):
    h = accumulation_history(spark, sf_dir)
    out = h.groupBy(*CELL).agg(F.round(F.avg("clim"), 6).alias("average"), clim.quantiles("clim", cls.EAR_QUANTILES).alias("edges"))
    return out.withColumn("edges", F.transform("edges", lambda x: F.round(x, 6)))


def _merged(spark, sf_dir):
    now = win.accumulate(t.obs_daily(spark, sf_dir), DAY, 90).select("iy", "ix", "precip")
    levels = accumulation_history(spark, sf_dir).groupBy(*CELL).agg(clim.quantiles("clim", cls.EAR_QUANTILES).alias("ear_edges"), clim.quantiles("clim", cls.USDM_QUANTILES).alias("usdm_edges"))
    return now.join(levels, CELL)


@query(f"""WITH {t.SQL_OBS}, {_CLIM_SQL}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {_LAST90} GROUP BY iy, ix),
e AS (SELECT iy, ix, quantile_cont(clim, [0.05, 0.1, 0.25, 0.9]) AS a, quantile_cont(clim, [0.02, 0.05, 0.1, 0.2, 0.3]) AS u FROM clim GROUP BY iy, ix)
SELECT iy, ix, CAST(len(list_filter(a, lambda x: x <= precip)) AS INTEGER) AS ear, CAST(len(list_filter(u, lambda x: x <= precip)) AS INTEGER) AS usdm,
  ['severely dry', 'seriously dry', 'warning', 'near normal or wetter', 'seriously wet'][len(list_filter(a, lambda x: x <= precip)) + 1] AS ear_label
FROM now JOIN e USING (iy, ix)""")
def cat3_cat4_drought_classes(spark, sf_dir):
    m = _merged(spark, sf_dir)
    ear = cls.digitize(F.col("precip"), F.col("ear_edges"), 0)
    return m.select(*CELL, ear.alias("ear"), cls.digitize(F.col("precip"), F.col("usdm_edges"), 0).alias("usdm"), cls.labelled(ear, cls.EAR_LABELS).alias("ear_label"))


@query(f"""WITH {t.SQL_OBS}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {_LAST90} GROUP BY iy, ix)
SELECT iy, ix, CAST(len(list_filter([30, 60, 120, 300, 600, 990], lambda x: x <= precip)) AS INTEGER) AS accumulation_class,
  CAST(len(list_filter([-600, -500, -400, -300, -200, -100, 0, 100, 200, 300, 400, 500, 600], lambda x: x <= precip - 500)) AS INTEGER) AS anomaly_class FROM now""")
def cat7_level_classes(spark, sf_dir):
    now = win.accumulate(t.obs_daily(spark, sf_dir), DAY, 90)
    return now.select(*CELL, cls.accumulation_class(F.col("precip"), 90).alias("accumulation_class"), cls.anomaly_class(F.col("precip") - 500, 90).alias("anomaly_class"))


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, time, {", ".join(f"round(CASE WHEN count(precip) OVER w{n} = {n} THEN sum(precip) OVER w{n} END, 6) AS sum_{n}d" for n in (3, 7, 30))}
FROM obs WINDOW {", ".join(f"w{n} AS (PARTITION BY iy, ix ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 7, 30))}""")
def win1_running_sums(spark, sf_dir):
    out = win.running_sums(t.obs_daily(spark, sf_dir), (3, 7, 30)).drop("precip")
    return out.withColumns({c: F.round(c, 6) for c in ("sum_3d", "sum_7d", "sum_30d")})


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, time, round(CASE WHEN count(precip) OVER w = 5 THEN avg(precip) OVER w END, 6) AS smooth
FROM obs WINDOW w AS (PARTITION BY iy, ix ORDER BY time ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def win4_centred_mean(spark, sf_dir):
    return t.obs_daily(spark, sf_dir).select(*CELL, "time", F.round(win.full_window(F.avg, "precip", 5, CELL, "time", centred=True), 6).alias("smooth"))


_PLACES = ", ".join(f"lag(precip, {7 - i}) OVER w" if i < 7 else f"lead(precip, {i - 7}) OVER w" for i in range(15))


@query(f"""WITH {t.SQL_OBS}, p AS (SELECT iy, ix, time, [{_PLACES}] AS places FROM obs WINDOW w AS (PARTITION BY iy, ix ORDER BY time))
SELECT iy, ix, time, CAST(unnest(range(15)) AS INTEGER) AS buffer, unnest(places) AS precip FROM p""")
def win5_construct(spark, sf_dir):
    return win.construct(t.obs_daily(spark, sf_dir), 7)


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, time, CAST(sum(CASE WHEN precip >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY iy, ix ORDER BY time) AS BIGINT) AS wet_so_far FROM obs WHERE {_LAST90}""")
def win6_cumulative_wet_days(spark, sf_dir):
    recent = t.obs_daily(spark, sf_dir).where(F.col("time").between(F.date_sub(F.lit(DAY).cast("date"), 89), F.lit(DAY).cast("date")))
    return recent.select(*CELL, "time", win.cumulative(F.when(F.col("precip") >= 5, 1).otherwise(0), CELL, "time").alias("wet_so_far"))


_DOY = "dayofyear(time) - CASE WHEN ((year(time) % 4 = 0 AND year(time) % 100 <> 0) OR year(time) % 400 = 0) AND dayofyear(time) > 59 THEN 1 ELSE 0 END"
_DOY_ROWS = f"d AS (SELECT iy, precip, ({_DOY} + b - 1 + 365) % 365 + 1 AS doy FROM obs, (SELECT unnest(range(-7, 8)) AS b))"


@query(f"""WITH {t.SQL_OBS}, {_DOY_ROWS} SELECT CAST(doy AS INTEGER) AS doy, iy, round(avg(precip), 11) AS average, CASE WHEN count(precip) = count(*) THEN
  list_transform(quantile_cont(precip, [0.1, 0.5, 0.9]), lambda x: round(x, 6)) END AS edges FROM d GROUP BY doy, iy""")
def agg5_agg6_doy_climatology(spark, sf_dir):
    out = clim.doy_climatology(t.obs_daily(spark, sf_dir), ["iy"], 7, (0.1, 0.5, 0.9))
    return out.select("doy", "iy", F.round("average", 11).alias("average"), F.transform("edges", lambda x: F.round(x, 6)).alias("edges"))


@query(f"WITH {t.SQL_MONTHLY} SELECT CAST(month(time) AS INTEGER) AS month, iy, ix, round(avg(precip), 6) AS precip FROM monthly GROUP BY ALL")
def agg4_monthly_mean(spark, sf_dir):
    return clim.monthly_mean(t.obs_monthly(spark, sf_dir), CELL).withColumn("precip", F.round("precip", 6))


@query(f"""WITH {t.SQL_MONTHLY} SELECT CAST(month(time) AS INTEGER) AS month, iy, list_transform(quantile_cont(precip, [1/3::DOUBLE, 2/3::DOUBLE]), lambda x: round(x, 6)) AS edges,
  count(precip) AS n_instances FROM monthly GROUP BY ALL""")
def agg10_monthly_quantiles(spark, sf_dir):
    out = clim.monthly_quantiles(t.obs_monthly(spark, sf_dir), ["iy"], clim.SCHEMES["tercile"])
    return out.withColumn("edges", F.transform("edges", lambda x: F.round(x, 6)))


_GAMMA = """g AS (SELECT iy, ix, avg(precip) AS m, ln(avg(precip)) - avg(CASE WHEN precip > 0 THEN ln(precip) END) AS a FROM obs WHERE precip IS NOT NULL GROUP BY iy, ix)"""


@query(f"""WITH {t.SQL_OBS}, {_GAMMA} SELECT iy, ix, round(CASE WHEN a > 0 THEN (1 + sqrt(1 + 4 * a / 3)) / (4 * a) END, 6) AS alpha,
  round(CASE WHEN a > 0 THEN m / ((1 + sqrt(1 + 4 * a / 3)) / (4 * a)) END, 6) AS beta FROM g""")
def agg12_gamma_parameters(spark, sf_dir):
    out = clim.gamma_fit(t.obs_daily(spark, sf_dir).where("precip is not null"), CELL)
    return out.select(*CELL, F.round("alpha", 6).alias("alpha"), F.round("beta", 6).alias("beta"))


@query()
def sta3_spi(spark, sf_dir):
    obs = t.obs_daily(spark, sf_dir).where("precip is not null")
    index = obs.join(clim.gamma_fit(obs, CELL), CELL).withColumn("spi", special.spi("precip", "alpha", "beta"))
    return index.select(*CELL, "time", F.round("spi", 6).alias("spi"), cls.digitize_levels(F.col("spi"), cls.SPI_LEVELS).alias("spi_class"))


@query()
def agg9_gamma_quantiles(spark, sf_dir):
    fit = clim.gamma_fit(t.obs_monthly(spark, sf_dir), ["iy"])
    levels = fit.withColumn("quantile", F.explode(F.array(*map(F.lit, (0.1, 0.5, 0.9)))))
    return levels.select("iy", "quantile", F.round(special.gamma_ppf("quantile", "alpha", "beta"), 6).alias("edge"))


_LOW_SHAPE = "(1 - 0.3080 * pi() * t * t) / (pi() * t * t * (1 + pi() * t * t * (-0.05812 + pi() * t * t * 0.01765)))"
_HIGH_SHAPE = "(1 - t) * (0.7213 - (1 - t) * 0.5947) / (1 + (1 - t) * (-2.1817 + (1 - t) * 1.2113))"


@query(f"""WITH {t.SQL_MONTHLY}, r AS (SELECT month(time) AS month, iy, precip AS x, row_number() OVER (PARTITION BY month(time), iy ORDER BY precip) - 1 AS below FROM monthly WHERE precip IS NOT NULL),
l AS (SELECT month, iy, avg(x) AS l1, 2 * sum(below * x) / nullif(count(*) * (count(*) - 1), 0) - avg(x) AS l2 FROM r GROUP BY month, iy), s AS (SELECT *, l2 / nullif(l1, 0) AS t FROM l),
a AS (SELECT *, CASE WHEN t > 0 AND t < 0.5 THEN {_LOW_SHAPE} WHEN t >= 0.5 AND t < 1 THEN {_HIGH_SHAPE} END AS alpha FROM s)
SELECT CAST(month AS INTEGER) AS month, iy, round(alpha, 6) AS alpha, round(l1 / alpha, 6) AS beta FROM a""")
def agg9_gamma_l_moments(spark, sf_dir):
    monthly = t.obs_monthly(spark, sf_dir).withColumn("month", F.month("time"))
    fit = clim.gamma_fit(monthly, ["month", "iy"], method="pwm")
    return fit.select("month", "iy", F.round("alpha", 6).alias("alpha"), F.round("beta", 6).alias("beta"))


_DIGAMMA = "ln(a + 8) - 1 / (2 * (a + 8)) - 1 / (12 * pow(a + 8, 2)) + 1 / (120 * pow(a + 8, 4)) - 1 / (252 * pow(a + 8, 6)) - " + " - ".join(f"1 / (a + {i})" for i in range(8))


@query(f"""WITH RECURSIVE {t.SQL_OBS}, m AS (SELECT iy, ix, avg(precip) FILTER (precip > 0) AS mean, ln(avg(precip) FILTER (precip > 0)) - avg(CASE WHEN precip > 0 THEN ln(precip) END) AS s,
  avg(CASE WHEN precip > 0 THEN 0.0::DOUBLE ELSE 1 END) FILTER (precip IS NOT NULL) AS dry FROM obs GROUP BY iy, ix),
b AS (SELECT iy, ix, s, -10.0::DOUBLE AS low, 20.0::DOUBLE AS high, 0 AS i FROM m WHERE s > 1e-13
  UNION ALL SELECT iy, ix, s, CASE WHEN over THEN mid ELSE low END, CASE WHEN over THEN high ELSE mid END, i + 1
  FROM (SELECT *, ln(a) - ({_DIGAMMA}) > s AS over FROM (SELECT *, (low + high) / 2 AS mid, exp((low + high) / 2) AS a FROM b WHERE i < 60)))
SELECT m.iy, m.ix, round(exp(b.low), 6) AS alpha, round(mean / exp(b.low), 6) AS beta, round(dry, 9) AS dry FROM m LEFT JOIN b ON b.iy = m.iy AND b.ix = m.ix AND b.i = 60""")
def agg9_gamma_likelihood(spark, sf_dir):
    """The SQL finds the same shapes by bisection."""
    fit = clim.gamma_fit(t.obs_daily(spark, sf_dir), CELL, method="ml")
    return fit.select(*CELL, F.round("alpha", 6).alias("alpha"), F.round("beta", 6).alias("beta"), F.round("dry", 9).alias("dry"))


@query()
def agg9_quantiles_by_method(spark, sf_dir):
    """Terciles of each month and band by every method of fitting."""
    monthly = t.obs_monthly(spark, sf_dir).withColumn("month", F.month("time"))
    of = lambda m: clim.gamma_quantiles(monthly, ["month", "iy"], clim.SCHEMES["tercile"], method=m).withColumn("method", F.lit(m))
    thom, pwm, ml = map(of, clim.GAMMA_METHODS)
    return thom.unionByName(pwm).unionByName(ml).withColumn("edge", F.round("edge", 6))


@query(f"""WITH {t.SQL_OBS} SELECT time, round(quantile_cont(precip, 0.99), 6) AS q99, round(max(precip), 6) AS most, count(precip) AS n FROM obs GROUP BY time""")
def agg20_daily_extremes(spark, sf_dir):
    q = F.percentile("precip", F.lit(0.99))
    return t.obs_daily(spark, sf_dir).groupBy("time").agg(F.round(q, 6).alias("q99"), F.round(F.max("precip"), 6).alias("most"), F.count("precip").alias("n"))


@query(f"""WITH {t.SQL_OBS}, q AS (SELECT iy, ix, quantile_cont(precip, 0.99) AS q99 FROM obs GROUP BY iy, ix)
SELECT iy, ix, count(precip) AS n, count(CASE WHEN precip <= q99 * 1.2 THEN 1 END) AS kept FROM obs JOIN q USING (iy, ix) GROUP BY iy, ix""")
def sta13_outliers(spark, sf_dir):
    out = t.obs_daily(spark, sf_dir).withColumn("clean", clim.mask_outliers("precip", CELL, 1.2))
    return out.groupBy(*CELL).agg(F.count("precip").alias("n"), F.count("clean").alias("kept"))


@query(f"""WITH {t.SQL_MONTHLY} SELECT iy, ix, time, round(precip - avg(precip) OVER (PARTITION BY month(time), iy, ix), 6) AS anomaly,
  round(precip - avg(CASE WHEN year(time) BETWEEN 1996 AND 1999 THEN precip END) OVER (PARTITION BY month(time), iy, ix), 6) AS base_anomaly,
  round((precip - avg(precip) OVER w) / nullif(stddev_pop(precip) OVER w, 0), 6) AS z FROM monthly WINDOW w AS (PARTITION BY iy, ix)""")
def sta4_sta5_sta7_anomalies(spark, sf_dir):
    m = t.obs_monthly(spark, sf_dir)
    columns = {"anomaly": clim.anomaly("precip", CELL), "base_anomaly": clim.anomaly("precip", CELL, base=(1996, 1999)), "z": clim.standardised(F.col("precip"), CELL)}
    return m.select(*CELL, "time", *[F.round(v, 6).alias(k) for k, v in columns.items()])


@query(f"""WITH {t.SQL_MONTHLY}, x AS (SELECT *, CAST(time - DATE '1995-01-01' AS DOUBLE) AS x FROM monthly)
SELECT iy, ix, time, round(precip - regr_intercept(precip, x) OVER w - regr_slope(precip, x) OVER w * x, 4) AS residual FROM x WINDOW w AS (PARTITION BY iy, ix)""")
def sta6_detrend(spark, sf_dir):
    m = t.obs_monthly(spark, sf_dir).withColumn("x", F.datediff("time", F.lit("1995-01-01").cast("date")).cast("double"))
    return m.select(*CELL, "time", F.round(clim.detrended("precip", "x", CELL), 4).alias("residual"))


@query(f"""WITH {t.SQL_OBS}, {_CLIM_SQL}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {_LAST90} GROUP BY iy, ix),
c AS (SELECT iy, ix, avg(clim) AS average FROM clim GROUP BY iy, ix)
SELECT iy, ix, round(100 * precip / nullif(average, 0), 6) AS normal_percent FROM now JOIN c USING (iy, ix)""")
def sta8_percent_of_normal(spark, sf_dir):
    now = win.accumulate(t.obs_daily(spark, sf_dir), DAY, 90)
    average = accumulation_history(spark, sf_dir).groupBy(*CELL).agg(F.avg("clim").alias("average"))
    return now.join(average, CELL).select(*CELL, F.round(F.try_divide(100 * F.col("precip"), "average"), 6).alias("normal_percent"))


@query(f"""WITH {t.SQL_OBS}, c AS (SELECT make_date(y, 3, 1) + CAST(b AS INTEGER) AS day FROM (SELECT unnest(range(1996, 2001)) AS y), (SELECT unnest(range(-2, 3)) AS b))
SELECT iy, ix, count(*) AS n, round(avg(precip), 6) AS average FROM obs SEMI JOIN c ON obs.time = c.day GROUP BY iy, ix""")
def jn15_dt7_window_climatology(spark, sf_dir):
    target = spark.createDataFrame([("2001-03-01",)], "d string").select(F.to_date("d").alias("time"))
    days = cal.around_days(target, 2, (1996, 2000)).select(F.col("day").alias("time")).distinct()
    kept = t.obs_daily(spark, sf_dir).join(days, "time", "left_semi")
    return kept.groupBy(*CELL).agg(F.count("*").alias("n"), F.round(F.avg("precip"), 6).alias("average"))


@query(f"""WITH {t.SQL_OBS}, c AS (SELECT iy, ix, avg(precip) AS average, max(precip) AS most FROM obs WHERE year(time) < 2001 GROUP BY iy, ix),
now AS (SELECT iy, ix, sum(precip) AS total FROM obs WHERE {_LAST90} GROUP BY iy, ix)
SELECT iy, ix, round(total, 6) AS total, round(average, 6) AS average, round(total - 90 * average, 6) AS anomaly FROM now FULL JOIN c USING (iy, ix)""")
def jn1_jn4_merge(spark, sf_dir):
    obs = t.obs_daily(spark, sf_dir)
    c = obs.where(F.year("time") < 2001).groupBy(*CELL).agg(F.avg("precip").alias("average"))
    now = obs.where(F.col("time").between(F.date_sub(F.lit(DAY).cast("date"), 89), F.lit(DAY).cast("date"))).groupBy(*CELL).agg(F.sum("precip").alias("total"))
    out = now.join(c, CELL, "full_outer").withColumn("anomaly", F.col("total") - 90 * F.col("average"))
    return out.select(*CELL, *[F.round(x, 6).alias(x) for x in ("total", "average", "anomaly")])


@query(f"""WITH {t.SQL_OBS}, r AS (SELECT *, DATE '{DAY}' - time AS age FROM obs)
SELECT iy, ix, CAST(lag AS INTEGER) AS lag, {", ".join(f"round(coalesce(sum(CASE WHEN age >= lag AND age < lag + {n} THEN precip END), 0), 6) AS sum_{n}d" for n in (30, 90))}
FROM r, (SELECT unnest(range(1, 11)) AS lag) GROUP BY iy, ix, lag""")
def stm3_replay(spark, sf_dir):
    """Accumulations of many past cycle dates in one pass: running sums read at those dates; missing days count as nothing."""
    obs = t.obs_daily(spark, sf_dir).withColumn("precip", F.coalesce("precip", F.lit(0.0)))
    sums = win.running_sums(obs, (30, 90)).withColumn("lag", F.datediff(F.lit(DAY).cast("date"), "time"))
    return sums.where(F.col("lag").between(1, 10)).select(*CELL, "lag", F.round("sum_30d", 6).alias("sum_30d"), F.round("sum_90d", 6).alias("sum_90d"))


@query(f"""WITH {t.SQL_OBS}, s AS (SELECT iy, ix, time, CASE WHEN count(precip) OVER w = 3 THEN sum(precip) OVER w END AS sum_3d, {_DOY} AS doy FROM obs WINDOW w AS (PARTITION BY iy, ix ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
g AS (SELECT CAST(time AS DATE) AS target, {_DOY} AS day FROM (SELECT max(time) - INTERVAL (91 * i) DAY AS time FROM obs, (SELECT unnest(range(4)) AS i) GROUP BY i)),
c AS (SELECT target, (day + b - 1 + 365) % 365 + 1 AS doy FROM g, (SELECT unnest(range(-7, 8)) AS b))
SELECT target, iy, ix, count(*) AS days, count(sum_3d) AS full_days, round(avg(sum_3d), 6) AS average, round(max(sum_3d), 6) AS most FROM s JOIN c USING (doy) GROUP BY target, iy, ix""")
def src22_climatology_store(spark, sf_dir):
    """Three-day sums of all years around the last day and three days before it, from a store by day of the year.

    The store lies in a folder of its own while the query's rows, a few for each cell, are made from it."""
    obs = t.obs_daily(spark, sf_dir)
    sums = win.running_sums(obs, (3,)).select(*CELL, "time", "sum_3d")
    last = t.table(spark, sf_dir, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("last"))
    targets = last.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.date_sub("last", i * 91))).alias("time"))
    with files.workspace(spark) as folder:
        store.write_sums(sums, folder)
        near = store.read_around(spark, folder, "iy int, ix int, time date, sum_3d double", targets, 7)
        told = near.groupBy("target", *CELL).agg(F.count("*").alias("days"), F.count("sum_3d").alias("full_days"), F.round(F.avg("sum_3d"), 6).alias("average"), F.round(F.max("sum_3d"), 6).alias("most"))
        return kept(told)
