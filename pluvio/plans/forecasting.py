"""Probabilistic forecasts: climatological edges, categories, probabilities, multi-model means and the outlook."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.operators import forecast as fc
from pluvio.operators import tables as tab
from pluvio.operators import windows as win
from pluvio.sources import tables as t

from ._registry import query

KEY = ["gcm", "init", "step", "iy"]
#: Hindcast years; later initial months are forecasts.
LAST_HINDCAST = 1999
_EDGES = """edges AS (SELECT gcm, step, iy, quantile_cont(precip, [{q}]) AS edges, count(*) AS n_instances FROM ens WHERE year(init) <= 1999 GROUP BY ALL)"""


def _levels_sql(scheme: str) -> str:
    return ", ".join(f"{x!r}::DOUBLE" for x in clim.SCHEMES[scheme])


def _edges_sql(scheme: str) -> str:
    return _EDGES.format(q=_levels_sql(scheme))


def _probs_sql(scheme: str, n: int) -> str:
    return f"""{t.SQL_ENS}, {_edges_sql(scheme)},
cat AS (SELECT gcm, init, step, iy, member, len(list_filter(edges, lambda e: e <= precip)) + 1 AS category FROM ens JOIN edges USING (gcm, step, iy) WHERE year(init) > 1999),
tot AS (SELECT gcm, init, step, iy, count(*) AS n FROM cat GROUP BY ALL), ks AS (SELECT unnest(range(1, {n + 1})) AS category),
probs AS (SELECT tot.gcm, tot.init, tot.step, tot.iy, CAST(ks.category AS INTEGER) AS category, 100.0::DOUBLE * count(cat.category) / any_value(n) AS prob
  FROM tot CROSS JOIN ks LEFT JOIN cat ON cat.gcm = tot.gcm AND cat.init = tot.init AND cat.step = tot.step AND cat.iy = tot.iy AND cat.category = ks.category GROUP BY ALL)"""


def hindcast(spark, sf_dir):
    return t.ensemble(spark, sf_dir).where(F.year("init") <= LAST_HINDCAST)


def edges(spark, sf_dir, scheme):
    return clim.quantiles_by(hindcast(spark, sf_dir), ["gcm", "step", "iy"], clim.SCHEMES[scheme])


def probabilities(spark, sf_dir, scheme="tercile", n=3):
    members = t.ensemble(spark, sf_dir).where(F.year("init") > LAST_HINDCAST)
    return fc.probabilities(fc.categorise(members, edges(spark, sf_dir, scheme), ["gcm", "step", "iy"]), KEY, n)


@query(f"WITH {t.SQL_ENS}, {_edges_sql('quartile')} SELECT gcm, step, iy, list_transform(edges, lambda x: round(x, 9)) AS edges, n_instances FROM edges")
def agg7_hindcast_quantiles(spark, sf_dir):
    return edges(spark, sf_dir, "quartile").withColumn("edges", F.transform("edges", lambda x: F.round(x, 9)))


@query(f"WITH {t.SQL_ENS}, {_edges_sql('tercile')}, q AS (SELECT gcm, step, iy, unnest([{_levels_sql('tercile')}]) AS quantile, unnest(edges) AS edge FROM edges) SELECT gcm, step, iy, quantile, round(edge, 6) AS edge FROM q")
def d7_exploded_edges(spark, sf_dir):
    out = clim.exploded_edges(edges(spark, sf_dir, "tercile").drop("n_instances"), clim.SCHEMES["tercile"])
    return out.withColumn("edge", F.round("edge", 6))


@query(f"WITH {t.SQL_ENS}, {_edges_sql('tercile')} SELECT gcm, init, step, member, iy, CAST(len(list_filter(edges, lambda e: e <= precip)) + 1 AS INTEGER) AS category FROM ens JOIN edges USING (gcm, step, iy) WHERE year(init) > 1999")
def cat1_digitize(spark, sf_dir):
    members = t.ensemble(spark, sf_dir).where(F.year("init") > LAST_HINDCAST)
    return fc.categorise(members, edges(spark, sf_dir, "tercile"), ["gcm", "step", "iy"]).drop("precip")


@query(f"""WITH {t.SQL_ENS}, {_edges_sql('quartile')} SELECT gcm, step, iy, list_transform(list_concat(list_concat([0.0::DOUBLE], edges), [1.0::DOUBLE]), lambda x: round(x, 9)) AS bounds, CAST(range(1, len(edges) + 2) AS INTEGER[]) AS categories FROM edges""")
def cat9_percentile_bounds(spark, sf_dir):
    bounds, categories = cls.percentile_bounds(F.col("edges"))
    return edges(spark, sf_dir, "quartile").select("gcm", "step", "iy", F.transform(bounds, lambda x: F.round(x, 9)).alias("bounds"), categories.alias("categories"))


def _register_probabilities(scheme: str, n: int):
    def f(spark, sf_dir):
        return probabilities(spark, sf_dir, scheme, n).withColumn("prob", F.round("prob", 6))

    f.__name__ = f"agg11_{scheme}_probabilities"
    return query(f"WITH {_probs_sql(scheme, n)} SELECT gcm, init, step, iy, category, round(prob, 6) AS prob FROM probs")(f)


for _scheme, _n in (("tercile", 3), ("quartile", 4), ("decile", 10), ("percentile", 21)):
    _register_probabilities(_scheme, _n)


@query(f"WITH {_probs_sql('tercile', 3)}, best AS (SELECT gcm, init, step, iy, arg_max(category, (prob, -category)) AS category, max(prob) AS prob FROM probs GROUP BY ALL) SELECT gcm, init, step, iy, category, round(prob, 6) AS prob FROM best")
def agg16_most_likely(spark, sf_dir):
    return probabilities(spark, sf_dir).groupBy(*KEY).agg(fc.most_likely().alias("category"), F.round(F.max("prob"), 6).alias("prob"))


@query(f"""WITH {_probs_sql('decile', 10)}, c AS (SELECT *, sum(prob) OVER (PARTITION BY gcm, init, step, iy ORDER BY category) AS total FROM probs)
SELECT gcm, init, step, iy, min(CASE WHEN round(total, 6) >= 50 THEN category END) AS median_category FROM c GROUP BY gcm, init, step, iy""")
def win7_median_decile(spark, sf_dir):
    return fc.median_category(probabilities(spark, sf_dir, "decile", 10), KEY)


@query(f"""WITH {_probs_sql('tercile', 3)}, m AS (SELECT gcm, init, step, iy, category, prob FROM probs UNION ALL SELECT 'MME', init, step, iy, category, avg(prob) FROM probs GROUP BY init, step, iy, category)
SELECT gcm, init, step, iy, category, round(prob, 6) AS prob, round(100 * prob / nullif(sum(prob) OVER (PARTITION BY gcm, init, step, iy), 0), 6) AS share FROM m""")
def agg3_agg22_sta10_multi_model(spark, sf_dir):
    m = fc.multi_model(probabilities(spark, sf_dir), ["init", "step", "iy", "category"])
    return m.select(*KEY, "category", F.round("prob", 6).alias("prob"), F.round(fc.renormalised(KEY), 6).alias("share"))


@query(f"""WITH {_probs_sql('quartile', 4)}, s AS (SELECT *, round(prob / sum(prob) OVER w * 100, 9) AS share FROM probs WINDOW w AS (PARTITION BY gcm, init, step, iy)),
r AS (SELECT *, row_number() OVER (PARTITION BY gcm, init, step, iy ORDER BY share - floor(share) DESC, category) AS k, 100 - sum(floor(share)) OVER (PARTITION BY gcm, init, step, iy) AS extra FROM s)
SELECT gcm, init, step, iy, category, CAST(floor(share) + CASE WHEN k <= extra THEN 1 ELSE 0 END AS DOUBLE) AS rounded FROM r""")
def sta9_largest_remainder(spark, sf_dir):
    out = fc.rounded_to_100(probabilities(spark, sf_dir, "quartile", 4), KEY)
    return out.select(*KEY, "category", F.col("rounded").cast("double").alias("rounded"))


@query(f"""WITH {_probs_sql('decile', 10)} SELECT gcm, init, step, iy, round(sum(CASE WHEN category <= 4 THEN prob ELSE 0 END), 6) AS below,
  round(sum(CASE WHEN category > 4 THEN prob ELSE 0 END), 6) AS above FROM probs GROUP BY gcm, init, step, iy""")
def sta11_below_above(spark, sf_dir):
    out = fc.below_above(probabilities(spark, sf_dir, "decile", 10), KEY, 4)
    return out.select(*KEY, F.round("below", 6).alias("below"), F.round("above", 6).alias("above"))


@query(f"""WITH {_probs_sql('decile', 10)}, {t.SQL_OBS.replace('cells AS', 'cells AS')}, {{clim}}, now AS (SELECT iy, ix, coalesce(sum(precip), 0) AS precip FROM obs WHERE {{last90}} GROUP BY iy, ix),
s AS (SELECT iy, ix, 100 * avg(CASE WHEN clim <= precip THEN 1.0::DOUBLE ELSE 0.0 END) AS pctscore FROM clim JOIN now USING (iy, ix) GROUP BY iy, ix),
p AS (SELECT init, step, iy, round(sum(CASE WHEN category <= 4 THEN prob ELSE 0 END), 6) AS below, round(sum(CASE WHEN category > 4 THEN prob ELSE 0 END), 6) AS above
  FROM (SELECT init, step, iy, category, avg(prob) AS prob FROM probs GROUP BY ALL) GROUP BY ALL)
SELECT init, step, iy, ix, round(pctscore, 6) AS pctscore, below, above, CAST(greatest(CASE WHEN pctscore <= 40 AND below >= 50 THEN 1 END,
  CASE WHEN pctscore > 25 AND pctscore <= 40 AND below >= 50 THEN 2 END, CASE WHEN pctscore <= 25 AND above >= 50 THEN 3 END) AS INTEGER) AS outlook
FROM p JOIN s USING (iy) WHERE step = 3""".replace("{clim}", "{clim}"))
def sta12_outlook(spark, sf_dir):
    from .monitoring import scored

    mean = probabilities(spark, sf_dir, "decile", 10).where("step = 3").groupBy("init", "step", "iy", "category").agg(F.avg("prob").alias("prob"))
    sides = fc.below_above(mean, ["init", "step", "iy"], 4).withColumns({c: F.round(c, 6) for c in ("below", "above")})
    joined = sides.join(scored(spark, sf_dir).select("iy", "ix", "pctscore"), "iy")
    return joined.withColumn("outlook", fc.outlook(F.col("pctscore"), F.col("below"), F.col("above"))).withColumn("pctscore", F.round("pctscore", 6))


def _finish_outlook_sql():
    from . import _registry
    from .monitoring import _CLIM_SQL, _LAST90

    _registry.SQL["sta12_outlook"] = _registry.SQL["sta12_outlook"].replace("{clim}", _CLIM_SQL).replace("{last90}", _LAST90)


_finish_outlook_sql()


@query(f"""WITH {t.SQL_ENS} SELECT gcm, init, step, member, iy, round(sum(precip) OVER w, 9) AS precip FROM ens
WINDOW w AS (PARTITION BY gcm, init, member, iy ORDER BY step ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) QUALIFY count(precip) OVER w = 3""")
def win2_seasonal_sums(spark, sf_dir):
    out = win.seasonal(t.ensemble(spark, sf_dir), ["gcm", "init", "member", "iy"], "step")
    return out.select("gcm", "init", "step", "member", "iy", F.round("precip", 9).alias("precip"))


@query(f"""WITH {t.SQL_ENS} SELECT gcm, init, step, member, iy, round(precip * 86400000.0 * day(last_day(init + to_months(step))) / 1e6, 6) AS month_total,
  CAST(init + to_months(step) AS DATE) AS valid FROM ens""")
def dt2_lead_months(spark, sf_dir):
    e = t.ensemble(spark, sf_dir)
    total = cal.monthly_from_rate(F.col("precip"), F.col("init"), F.col("step")) / 1e6
    return e.select("gcm", "init", "step", "member", "iy", F.round(total, 6).alias("month_total"), cal.valid_month(F.col("init"), F.col("step")).alias("valid"))


@query(f"""WITH {t.SQL_ENS}, n AS (SELECT gcm, init, iy, count(DISTINCT member) AS members FROM ens GROUP BY ALL) SELECT init, iy, CAST(sum(members) AS BIGINT) AS members, count(*) AS models FROM n GROUP BY ALL""")
def agg19_members(spark, sf_dir):
    n = t.ensemble(spark, sf_dir).groupBy("gcm", "init", "iy").agg(F.countDistinct("member").alias("members"))
    return n.groupBy("init", "iy").agg(F.sum("members").alias("members"), F.count("*").alias("models"))


@query(f"""WITH {t.SQL_ENS}, bad AS (SELECT DISTINCT gcm, init, member FROM ens WHERE precip > 70)
SELECT gcm, init, step, iy, round(avg(precip), 9) AS mean, count(*) AS n FROM ens ANTI JOIN bad USING (gcm, init, member) GROUP BY ALL""")
def sel11_complete_members(spark, sf_dir):
    from pluvio.operators.selection import complete_members

    e = t.ensemble(spark, sf_dir).withColumn("checked", F.when(F.col("precip") <= 70, F.col("precip")))
    return complete_members(e, ["gcm", "init", "member"], "checked").groupBy(*KEY).agg(F.round(F.avg("precip"), 9).alias("mean"), F.count("*").alias("n"))


_STEPS, _CATEGORIES = range(1, 6), range(1, 4)


@query(f"""WITH {_probs_sql('tercile', 3)} SELECT gcm, init, iy, {", ".join(f"round(max(CASE WHEN step = {s} AND category = {c} THEN prob END), 6) AS s{s}_c{c}" for s in _STEPS for c in _CATEGORIES)} FROM probs GROUP BY gcm, init, iy""")
def rsh2_wide_table(spark, sf_dir):
    return tab.wide(probabilities(spark, sf_dir).withColumn("prob", F.round("prob", 6)), ["gcm", "init", "iy"], list(_STEPS), list(_CATEGORIES))


@query(f"""WITH {_probs_sql('tercile', 3)} SELECT gcm, init, iy, step, category, round(prob, 6) AS prob FROM probs""")
def rsh1_rsh4_long_table(spark, sf_dir):
    keys = ["gcm", "init", "iy"]
    table = tab.wide(probabilities(spark, sf_dir).withColumn("prob", F.round("prob", 6)), keys, list(_STEPS), list(_CATEGORIES))
    return tab.long(table, keys, list(_STEPS), list(_CATEGORIES)).where("prob is not null")


@query(f"""WITH {_probs_sql('tercile', 3)}, best AS (SELECT gcm, init, step, iy, arg_max(category, (prob, -category)) AS category FROM probs GROUP BY ALL)
SELECT gcm, step, category, n, round(n / sum(n) OVER (PARTITION BY gcm, step), 9) AS share FROM (SELECT gcm, step, category, count(*) AS n FROM best GROUP BY ALL)""")
def agg18_frequencies(spark, sf_dir):
    best = probabilities(spark, sf_dir).groupBy(*KEY).agg(fc.most_likely().alias("category"))
    return tab.frequencies(best, ["gcm", "step"], "category").select("gcm", "step", "category", "n", F.round("share", 9).alias("share"))
