"""Verification: forecast categories and means against the observations of their valid month; climate indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.functions import special
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.operators import forecast as fc
from pluvio.operators import indices as ind
from pluvio.operators import skill as sk
from pluvio.operators import verify as ver
from pluvio.operators import windows as win
from pluvio.sources import tables as t

from . import forecasting as fo
from ._registry import query

#: Monthly means of the bands, scaled to the ensemble's range, and their categories by month.
_BANDS = """bands AS (SELECT iy, CAST(date_trunc('month', l_shipdate) AS DATE) AS time, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100000.0::DOUBLE AS precip
  FROM lineitem JOIN (SELECT s_suppkey, CAST(s_nationkey // 5 AS INTEGER) AS iy FROM supplier) ON l_suppkey = s_suppkey GROUP BY ALL)"""
_OBS_CAT = f"""oe AS (SELECT month(time) AS month, iy, quantile_cont(precip, [{fo._levels_sql('tercile')}]) AS edges FROM bands GROUP BY ALL),
ocat AS (SELECT bands.iy, time, precip AS value, CAST(len(list_filter(edges, lambda e: e <= precip)) + 1 AS INTEGER) AS o FROM bands JOIN oe ON oe.iy = bands.iy AND oe.month = month(time))"""
_PAIRS = f"""{fo._probs_sql('tercile', 3)}, {_BANDS}, {_OBS_CAT}, best AS (SELECT gcm, init, step, iy, arg_max(category, (prob, -category)) AS f FROM probs GROUP BY ALL),
pairs AS (SELECT gcm, init, step, best.iy, f, o FROM best JOIN ocat ON ocat.iy = best.iy AND ocat.time = CAST(init + to_months(step) AS DATE))"""


def bands(spark, sf_dir):
    supplier = t.table(spark, sf_dir, "supplier").select("s_suppkey", F.floor(F.col("s_nationkey") / 5).cast("int").alias("iy"))
    item = t.table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("time"), "l_extendedprice")
    value = F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / F.count("*") / F.lit(100000.0)
    return item.join(supplier, item.l_suppkey == supplier.s_suppkey).groupBy("iy", "time").agg(value.alias("precip"))


def observed_categories(spark, sf_dir):
    b = bands(spark, sf_dir).withColumn("month", F.month("time"))
    edges = clim.monthly_quantiles(b.drop("month"), ["iy"], clim.SCHEMES["tercile"])
    return fc.categorise(b, edges, ["month", "iy"]).select("iy", "time", F.col("precip").alias("value"), F.col("category").alias("o"))


def pairs(spark, sf_dir):
    best = fo.probabilities(spark, sf_dir).groupBy(*fo.KEY).agg(fc.most_likely().alias("f"))
    return ver.lead_join(best, observed_categories(spark, sf_dir), ["iy"]).select("gcm", "init", "step", "iy", "f", "o")


@query(f"WITH {_BANDS}, {_OBS_CAT} SELECT iy, time, o FROM ocat")
def cat2_observed_categories(spark, sf_dir):
    return observed_categories(spark, sf_dir).drop("value")


@query(f"WITH {_PAIRS} SELECT gcm, init, step, iy, CAST(f AS INTEGER) AS f, o FROM pairs")
def jn5_jn6_lead_join(spark, sf_dir):
    return pairs(spark, sf_dir)


@query(f"""WITH {_PAIRS}, c AS (SELECT gcm, step, iy, count(*) FILTER (f = 1 AND o = 1) AS tp, count(*) FILTER (f = 1 AND o <> 1) AS fp, count(*) FILTER (f <> 1 AND o = 1) AS fn, count(*) FILTER (f <> 1 AND o <> 1) AS tn FROM pairs GROUP BY ALL)
SELECT *, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1,
  round(tp / nullif(tp + fp + fn, 0), 9) AS iou, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 9) AS one_vs_rest FROM c""")
def ver1_ver2_ver3_contingency(spark, sf_dir):
    c = ver.contingency(pairs(spark, sf_dir), ["gcm", "step", "iy"], 1)
    return c.withColumns({k: F.round(v, 9) for k, v in ver.scores().items()})


@query(f"WITH {_PAIRS}, k AS (SELECT unnest([1, 2, 3]) AS f) SELECT k.f, count(*) FILTER (o = 1) AS o1, count(*) FILTER (o = 2) AS o2, count(*) FILTER (o = 3) AS o3 FROM k LEFT JOIN pairs USING (f) GROUP BY k.f")
def ver4_confusion(spark, sf_dir):
    return ver.confusion(pairs(spark, sf_dir), 3)


@query(f"WITH {_PAIRS} SELECT CAST(month(init) AS INTEGER) AS month, gcm, step, round(avg(CASE WHEN f = o THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy FROM pairs GROUP BY ALL")
def ver5_agg17_accuracy(spark, sf_dir):
    return pairs(spark, sf_dir).groupBy(F.month("init").alias("month"), "gcm", "step").agg(F.round(ver.accuracy(), 9).alias("accuracy"))


@query(f"""WITH {_PAIRS}, own AS (SELECT probs.gcm, probs.init, probs.step, probs.iy, max(prob) AS most, max(CASE WHEN category = o THEN prob END) AS own FROM probs JOIN pairs USING (gcm, init, step, iy) GROUP BY ALL)
SELECT gcm, step, round(avg(CASE WHEN most - own <= 10 THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy FROM own GROUP BY ALL""")
def ver6_tolerant_accuracy(spark, sf_dir):
    p = fo.probabilities(spark, sf_dir).join(pairs(spark, sf_dir).drop("f"), fo.KEY)
    out = ver.tolerant_accuracy(p, ["gcm", "step"], ["init", "iy"], 10.0)
    return out.withColumn("accuracy", F.round("accuracy", 9))


@query(f"""WITH {_PAIRS}, s AS (SELECT gcm, count(*) AS n, avg(CASE WHEN f = o THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
  {" + ".join(f"count(*) FILTER (f = {k}) * count(*) FILTER (o = {k})" for k in (1, 2, 3))} AS chance FROM pairs GROUP BY gcm)
SELECT gcm, round(accuracy, 9) AS accuracy, round((accuracy - chance / (n * n)) / nullif(1 - chance / (n * n), 0), 9) AS hss FROM s""")
def ver12_heidke(spark, sf_dir):
    out = ver.heidke(pairs(spark, sf_dir), ["gcm"], 3)
    return out.select("gcm", F.round("accuracy", 9).alias("accuracy"), F.round("hss", 9).alias("hss"))


_MEANS = f"""{t.SQL_ENS}, {_BANDS}, m AS (SELECT gcm, init, step, iy, avg(precip) AS f FROM ens GROUP BY ALL),
fm AS (SELECT m.gcm, m.init, m.step, m.iy, f, bands.precip AS o FROM m JOIN bands ON bands.iy = m.iy AND bands.time = CAST(init + to_months(step) AS DATE))"""


def means(spark, sf_dir):
    mean = t.ensemble(spark, sf_dir).groupBy(*fo.KEY).agg(F.avg("precip").alias("f"))
    return ver.lead_join(mean, bands(spark, sf_dir).withColumnRenamed("precip", "o"), ["iy"])


@query(f"WITH {_MEANS} SELECT gcm, step, round(corr(f, o), 6) AS corr, round(sqrt(avg((f - o) * (f - o))), 6) AS rmse, round(avg(f - o), 6) AS bias, count(*) AS n FROM fm GROUP BY ALL")
def ver8_deterministic(spark, sf_dir):
    out = ver.deterministic(means(spark, sf_dir), ["gcm", "step"])
    return out.select("gcm", "step", *[F.round(c, 6).alias(c) for c in ("corr", "rmse", "bias")], "n")


_ANOMALIES = f"""{_MEANS}, bc AS (SELECT iy, time, precip - avg(precip) OVER (PARTITION BY month(time), iy) AS oa FROM bands),
ev AS (SELECT gcm, init, step, iy, f FROM fm UNION ALL SELECT 'MME', init, step, iy, avg(f) FROM fm GROUP BY init, step, iy),
an AS (SELECT gcm, init, step, ev.iy, CAST(init + to_months(step) AS DATE) AS time, f - avg(f) OVER (PARTITION BY gcm, month(init), step, ev.iy) AS f, oa AS o
  FROM ev JOIN bc ON bc.iy = ev.iy AND bc.time = CAST(init + to_months(step) AS DATE)),
leads AS (SELECT gcm, count(DISTINCT step) AS leads FROM an GROUP BY gcm),
al AS (SELECT 'maximize' AS alignment, * FROM an
  UNION ALL SELECT 'same_inits', * FROM an SEMI JOIN (SELECT gcm, init FROM an JOIN leads USING (gcm) GROUP BY gcm, init HAVING count(DISTINCT step) = any_value(leads)) k USING (gcm, init)
  UNION ALL SELECT 'same_verif', * FROM an SEMI JOIN (SELECT gcm, time FROM an JOIN leads USING (gcm) GROUP BY gcm, time HAVING count(DISTINCT step) = any_value(leads)) k USING (gcm, time))"""


def anomaly_pairs(spark, sf_dir):
    """(gcm, init, step, iy, f, o): anomalies of each model, and of the multi-model mean, with those observed in their valid month.

    A forecast's climatology is of its model, initial month and lead, an observation's of its month.
    """
    observed = bands(spark, sf_dir).select("iy", "time", clim.anomaly("precip", ["iy"]).alias("o"))
    mean = means(spark, sf_dir).select("gcm", "init", "step", "iy", "f", "o")
    every = sk.with_multi_model(mean, ["init", "step", "iy"]).drop("o")
    own = every.withColumn("f", clim.anomaly("f", ["gcm", "step", "iy"], "init"))
    return ver.lead_join(own, observed, ["iy"]).select("gcm", "init", "step", "iy", "f", "o")


@query(f"""WITH {_ANOMALIES}, s AS (SELECT alignment, gcm, step, iy, init,
  CASE WHEN grouping(iy) = 0 THEN 'init' WHEN grouping(init) = 0 THEN 'cell' ELSE 'init,cell' END AS dims, count(*) AS n,
  var_pop(f) AS ff, var_pop(o) AS oo, covar_pop(f, o) AS fo, avg((f - o) * (f - o)) AS se, avg(f) - avg(o) AS bias
  FROM al GROUP BY GROUPING SETS ((alignment, gcm, step, iy), (alignment, gcm, step, init), (alignment, gcm, step)))
SELECT alignment, gcm, step, dims, iy, init, n, round(CASE WHEN ff > 1e-18 AND oo > 1e-18 THEN fo / sqrt(ff * oo) END, 6) AS acc, round(sqrt(se), 6) AS rmse, round(bias, 6) AS bias FROM s""")
def ver8_anomaly_correlation(spark, sf_dir):
    """Skill by lead over initial months, over cells and over both, for each way to align the leads."""
    pairs = anomaly_pairs(spark, sf_dir)
    kinds = [sk.aligned(pairs, how, ["gcm"]).withColumn("alignment", F.lit(how)) for how in sk.ALIGNMENTS]
    every = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    out = sk.skill(every, ["alignment", "gcm", "step"], ["iy"])
    return out.drop("slope", "msss").withColumns({c: F.round(c, 6) for c in ("acc", "rmse", "bias")})


@query(f"WITH {_MEANS} SELECT CAST(month(init) AS INTEGER) AS month, round(corr(f, o), 6) AS corr, round(sqrt(avg((f - o) * (f - o))), 6) AS rmse, count(*) AS n FROM fm GROUP BY ALL")
def ver9_by_month(spark, sf_dir):
    out = ver.deterministic(means(spark, sf_dir).withColumn("month", F.month("init")), ["month"])
    return out.select("month", F.round("corr", 6).alias("corr"), F.round("rmse", 6).alias("rmse"), "n")


_INDEX = """idx AS (SELECT init, avg(precip) AS x FROM ens GROUP BY init), z AS (SELECT init, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS z FROM idx),
ph AS (SELECT init, CASE WHEN z >= 0.5 THEN 'warm' WHEN z <= -0.5 THEN 'cold' ELSE 'neutral' END AS phase FROM z)"""


def phases(spark, sf_dir):
    index = t.ensemble(spark, sf_dir).groupBy("init").agg(F.avg("precip").alias("x"))
    return index.withColumn("phase", ver.phase(ind.scaled(F.col("x")), 0.5)).select("init", "phase")


@query(f"WITH {_MEANS}, {_INDEX} SELECT phase, round(corr(f, o), 6) AS corr, count(*) AS n FROM fm JOIN ph USING (init) GROUP BY phase")
def ver10_idx6_by_phase(spark, sf_dir):
    joined = means(spark, sf_dir).join(phases(spark, sf_dir), "init")
    return ver.deterministic(joined, ["phase"]).select("phase", F.round("corr", 6).alias("corr"), "n")


@query(f"WITH {_MEANS}, {_INDEX} SELECT iy, step, round(avg(f), 6) AS f FROM fm SEMI JOIN (SELECT * FROM ph WHERE phase = 'warm') w USING (init) GROUP BY ALL")
def idx7_jn12_composite(spark, sf_dir):
    return ind.composite(means(spark, sf_dir), phases(spark, sf_dir), "warm", ["iy", "step"], "f", "init").withColumn("f", F.round("f", 6))


@query(f"""WITH {_PAIRS}, x AS (SELECT probs.gcm, probs.init, probs.step, probs.iy, category, o,
  sum(prob) OVER (PARTITION BY probs.gcm, probs.init, probs.step, probs.iy ORDER BY category) / 100 - CASE WHEN o <= category THEN 1 ELSE 0 END AS gap FROM probs JOIN pairs USING (gcm, init, step, iy)),
s AS (SELECT gcm, init, step, iy, sum(gap * gap) AS rps FROM x GROUP BY ALL) SELECT gcm, step, round(avg(rps), 6) AS rps FROM s GROUP BY ALL""")
def ver11_rps(spark, sf_dir):
    p = fo.probabilities(spark, sf_dir).join(pairs(spark, sf_dir).drop("f"), fo.KEY)
    return ver.rps(p, ["gcm", "step"], ["init", "iy"]).withColumn("rps", F.round("rps", 6))


@query(f"""WITH {_PAIRS}, a AS (SELECT gcm, step, iy, avg(CASE WHEN f = o THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM pairs GROUP BY ALL)
SELECT gcm, step, iy, round(accuracy, 9) AS accuracy, CAST(row_number() OVER (PARTITION BY step ORDER BY round(accuracy, 9) DESC, gcm, iy) AS INTEGER) AS rank FROM a QUALIFY rank <= 5""")
def ver15_srt1_lim1_best(spark, sf_dir):
    from pyspark.sql import Window

    a = pairs(spark, sf_dir).groupBy("gcm", "step", "iy").agg(F.round(ver.accuracy(), 9).alias("accuracy"))
    rank = F.row_number().over(Window.partitionBy("step").orderBy(F.desc("accuracy"), "gcm", "iy"))
    return a.withColumn("rank", rank).where("rank <= 5")


@query(f"WITH {_PAIRS}, a AS (SELECT step, iy, avg(CASE WHEN f = o THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM pairs GROUP BY ALL) SELECT iy, bool_and(accuracy > 0.2) AS always, bool_or(accuracy > 0.4) AS once FROM a GROUP BY iy")
def ver16_every_lead(spark, sf_dir):
    a = pairs(spark, sf_dir).groupBy("step", "iy").agg(ver.accuracy().alias("accuracy"))
    return a.groupBy("iy").agg(F.every(F.col("accuracy") > 0.2).alias("always"), F.some(F.col("accuracy") > 0.4).alias("once"))


@query(f"""WITH {t.SQL_MONTHLY}, b AS (SELECT time, avg(CASE WHEN lon BETWEEN 160 AND 170 AND lat BETWEEN -20 AND -10 THEN precip END) AS a, avg(CASE WHEN lon BETWEEN 170 AND 180 AND lat BETWEEN -20 AND 0 THEN precip END) AS b,
  avg(CASE WHEN lon BETWEEN 160 AND 165 AND lat BETWEEN -5 AND 0 THEN precip END) AS c FROM monthly JOIN cells USING (iy, ix) GROUP BY time),
n AS (SELECT time, a - avg(a) OVER m AS a, b - avg(b) OVER m AS b, c - avg(c) OVER m AS c FROM b WINDOW m AS (PARTITION BY month(time))),
e AS (SELECT time, a - 0.5 * b - 0.5 * c AS emi, (a - avg(a) OVER ()) / stddev_pop(a) OVER () - (b - avg(b) OVER ()) / stddev_pop(b) OVER () AS iod FROM n)
SELECT time, round(emi, 6) AS emi, round((emi - avg(emi) OVER ()) / stddev_pop(emi) OVER (), 6) AS emi_z, round(iod, 6) AS iod,
  round(CASE WHEN count(iod) OVER w = 3 THEN avg(iod) OVER w END, 6) AS iod_3 FROM e WINDOW w AS (ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def idx2_idx3_idx4_indices(spark, sf_dir):
    m = t.obs_monthly(spark, sf_dir).join(t.cells(spark, sf_dir).select("iy", "ix", "lon", "lat"), ["iy", "ix"])
    b = ind.box_means(m, {"a": (160, 170, -20, -10), "b": (170, 180, -20, 0), "c": (160, 165, -5, 0)}, "precip")
    n = b.withColumns({c: ind.monthly_anomaly(F.col(c)) for c in "abc"})
    e = n.select("time", ind.modoki(F.col("a"), F.col("b"), F.col("c")).alias("emi"), ind.dipole(F.col("a"), F.col("b")).alias("iod"))
    return e.select("time", F.round("emi", 6).alias("emi"), F.round(ind.scaled(F.col("emi")), 6).alias("emi_z"), F.round("iod", 6).alias("iod"), F.round(ind.smoothed(e, "iod", 3), 6).alias("iod_3"))


def _sst(spark, sf_dir):
    """The grid moved to the equatorial Pacific, so that the index boxes hold cells."""
    m = t.obs_monthly(spark, sf_dir)
    return m.select("time", (F.lit(160.0) + 30 * F.col("ix")).alias("lon"), (F.lit(-10.0) + 5 * F.col("iy")).alias("lat"), F.col("precip").alias("sst"))


_SST = f"{t.SQL_MONTHLY}, sst AS (SELECT time, 160.0 + 30 * ix AS lon, -10.0 + 5 * iy AS lat, precip AS sst FROM monthly)"


@query(f"""WITH {_SST}, b AS (SELECT time, avg(sst) FILTER (lon BETWEEN 190 AND 240 AND lat BETWEEN -5 AND 5) AS x FROM sst GROUP BY time),
a AS (SELECT time, x - avg(x) OVER (PARTITION BY month(time)) AS x FROM b),
s AS (SELECT time, CASE WHEN count(x) OVER w = 5 THEN avg(x) OVER w END AS x FROM a WINDOW w AS (ORDER BY time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT time, round(x / stddev_pop(x) OVER (), 6) AS index FROM s""")
def idx1_nino34(spark, sf_dir):
    return ind.nino(_sst(spark, sf_dir)).withColumn("index", F.round("index", 6))


@query(f"""WITH {_SST}, b AS (SELECT time, avg(sst) FILTER (lon BETWEEN 270 AND 280 AND lat BETWEEN -10 AND 0) AS a, avg(sst) FILTER (lon BETWEEN 160 AND 210 AND lat BETWEEN -5 AND 5) AS b FROM sst GROUP BY time),
n AS (SELECT time, a - avg(a) OVER (PARTITION BY month(time)) AS a, b - avg(b) OVER (PARTITION BY month(time)) AS b FROM b),
d AS (SELECT time, a / stddev_pop(a) OVER () - b / stddev_pop(b) OVER () AS x FROM n),
s AS (SELECT time, CASE WHEN count(x) OVER w = 5 THEN avg(x) OVER w END AS x FROM d WINDOW w AS (ORDER BY time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT time, round(x / nullif(stddev_pop(x) OVER (), 0), 6) AS index FROM s""")
def idx5_tni(spark, sf_dir):
    return ind.nino(_sst(spark, sf_dir), "tni").withColumn("index", F.round("index", 6))


@query(f"WITH {t.SQL_MONTHLY} SELECT CAST(year(time + INTERVAL 1 MONTH) AS INTEGER) AS season, iy, ix, round(sum(precip), 6) AS djf FROM monthly WHERE month(time) IN (12, 1, 2) GROUP BY ALL")
def idx8_djf_sum(spark, sf_dir):
    from pluvio.operators.selection import in_months

    m = in_months(t.obs_monthly(spark, sf_dir), [12, 1, 2])
    return m.groupBy(F.year(F.add_months("time", 1)).alias("season"), "iy", "ix").agg(F.round(F.sum("precip"), 6).alias("djf"))


@query(f"""WITH {t.SQL_SERIES}, s AS (SELECT *, count(value) OVER w AS n, sum(value) OVER w AS total FROM series WINDOW w AS (PARTITION BY name ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT name, time, round(CASE WHEN n = 3 THEN total END, 6) AS rolling FROM s""")
def win3_rolling(spark, sf_dir):
    s = t.series(spark, sf_dir)
    return s.select("name", "time", F.round(win.full_window(F.sum, "value", 3, ["name"], "time"), 6).alias("rolling"))


@query(f"WITH {t.SQL_SERIES} SELECT a.name AS a, b.name AS b, round(corr(a.value, b.value), 6) AS corr, count(*) AS n FROM series a JOIN series b ON a.time = b.time AND a.name < b.name GROUP BY ALL")
def ver14_jn16_series_correlation(spark, sf_dir):
    s = t.series(spark, sf_dir)
    a, b = s.select(F.col("name").alias("a"), "time", F.col("value").alias("x")), s.select(F.col("name").alias("b"), "time", F.col("value").alias("y"))
    return a.join(b, (a["time"] == b["time"]) & (F.col("a") < F.col("b"))).groupBy("a", "b").agg(F.round(F.corr("x", "y"), 6).alias("corr"), F.count("*").alias("n"))


@query(f"""WITH {t.SQL_SERIES}, g AS (SELECT name, time, value, lag(value) OVER w AS b, lead(value) OVER w AS a FROM series WINDOW w AS (PARTITION BY name ORDER BY time))
SELECT name, time, round(CASE WHEN b IS NULL THEN a - value WHEN a IS NULL THEN value - b ELSE (a - b) / 2 END, 6) AS slope FROM g""")
def win11_gradient(spark, sf_dir):
    return t.series(spark, sf_dir).select("name", "time", F.round(win.gradient("value", ["name"], "time"), 6).alias("slope"))


_BASE = (1995, 1998)
_IN_BASE = "year(time) BETWEEN 1995 AND 1998"


def _z(c: str) -> str:
    kept = f"CASE WHEN {_IN_BASE} THEN {c} END"
    return f"({c} - avg({kept}) OVER ()) / nullif(stddev_samp({kept}) OVER (), 0)"


@query(f"""WITH {t.SQL_MONTHLY}, sst AS (SELECT time, 160.0 + 30 * ix AS lon, -60.0 + 5 * iy AS lat, precip AS sst FROM monthly),
an AS (SELECT time, lon, lat, sst - avg(CASE WHEN {_IN_BASE} THEN sst END) OVER (PARTITION BY month(time), lon, lat) AS a FROM sst),
b AS (SELECT time, avg(a) FILTER (lon BETWEEN 170 AND 190 AND lat BETWEEN -50 AND -35) AS nw, avg(a) FILTER (lon BETWEEN 220 AND 240 AND lat BETWEEN -57.5 AND -45) AS se FROM an GROUP BY time),
d AS (SELECT time, {_z("nw")} - {_z("se")} AS d FROM b), s AS (SELECT time, {_z("d")} AS spsd FROM d)
SELECT CAST(last_day(time) AS DATE) AS time, round(spsd, 6) AS spsd, round(CASE WHEN count(spsd) OVER w = 3 THEN avg(spsd) OVER w END, 6) AS spsd_3 FROM s WINDOW w AS (ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def idx4_subtropical_dipole(spark, sf_dir):
    """The grid moved to the South Pacific, so that both poles hold cells."""
    m = t.obs_monthly(spark, sf_dir)
    sst = m.select("time", (F.lit(160.0) + 30 * F.col("ix")).alias("lon"), (F.lit(-60.0) + 5 * F.col("iy")).alias("lat"), F.col("precip").alias("sst"))
    return ind.subtropical_dipole(sst, _BASE).withColumns({c: F.round(c, 6) for c in ("spsd", "spsd_3")})


def _correlations(spark, sf_dir):
    s = t.series(spark, sf_dir)
    a, b = s.select(F.col("name").alias("a"), "time", F.col("value").alias("x")), s.select(F.col("name").alias("b"), "time", F.col("value").alias("y"))
    return a.join(b, "time").where("a < b").groupBy("a", "b").agg(F.corr("x", "y").alias("corr"), F.count("*").alias("n"))


@query(f"""WITH {t.SQL_SERIES}, c AS (SELECT a.name AS a, b.name AS b, corr(a.value, b.value) AS r, count(*) AS n FROM series a JOIN series b ON a.time = b.time AND a.name < b.name GROUP BY ALL),
z AS (SELECT *, CASE WHEN n > 3 AND abs(r) < 1 THEN atanh(r) END AS z, 1.959963984540054 / sqrt(n - 3) AS half FROM c)
SELECT a, b, round(r, 6) AS corr, n, round(tanh(z - half), 6) AS low, round(tanh(z + half), 6) AS high FROM z""")
def ver14_interval(spark, sf_dir):
    c = _correlations(spark, sf_dir)
    low, high = special.fisher_interval(F.col("corr"), F.col("n"))
    return c.select("a", "b", F.round("corr", 6).alias("corr"), "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query()
def ver14_significance(spark, sf_dir):
    c = _correlations(spark, sf_dir)
    return c.select("a", "b", F.round("corr", 6).alias("corr"), "n", F.round(special.p_of_correlation("corr", "n"), 9).alias("p"))
