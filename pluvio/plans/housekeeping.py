"""Completeness of archives, names, set operations and tables of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.functions import strings as st
from pluvio.sources import files
from pluvio.sources import tables as t
from pluvio.streaming import daily, trailing

from . import monitoring
from ._registry import SQL, query


@query(f"""WITH {t.SQL_RAIN}, d AS (SELECT CAST(unnest(generate_series(DATE '1994-12-20', DATE '2001-11-20', INTERVAL 1 DAY)) AS DATE) AS time)
SELECT k, time FROM (SELECT n_nationkey AS k FROM nation) CROSS JOIN d ANTI JOIN rain USING (k, time)""")
def src4_src5_missing_days(spark, sf_dir):
    """Expected days of every cell that have no report."""
    days = t.cells(spark, sf_dir).select("k").crossJoin(files.expected_days(spark, "1994-12-20", "2001-11-20"))
    return days.join(t.rain(spark, sf_dir), ["k", "time"], "left_anti").select("k", "time")


@query(f"WITH {t.SQL_RAIN}, l AS (SELECT max(time) AS last FROM rain) SELECT CAST(unnest(generate_series(last + 1, DATE '2001-11-20' - 2, INTERVAL 1 DAY)) AS DATE) AS time FROM l")
def src7_next_days(spark, sf_dir):
    return files.next_days(t.rain(spark, sf_dir), "2001-11-20", 2)


@query(f"WITH {t.SQL_RAIN} SELECT max(time) AS last_day, CAST(DATE '2001-11-20' - max(time) AS INTEGER) AS lag_days, count(DISTINCT time) AS days FROM rain")
def src1_freshness(spark, sf_dir):
    return files.freshness(t.rain(spark, sf_dir), "2001-11-20")


@query(f"WITH {t.SQL_OBS} SELECT iy, ix, time, precip FROM obs WHERE time BETWEEN DATE '2000-06-30' - 29 AND DATE '2000-06-30'")
def src3_last_days(spark, sf_dir):
    return files.last_days(t.obs_daily(spark, sf_dir), "2000-06-30", 30)


@query("""SELECT DISTINCT CAST(o_orderdate AS DATE) AS time, 'product.' || strftime(o_orderdate, '%Y.%m.%d') || '.nc' AS dotted, strftime(o_orderdate, '%Y%j') || '.nc' AS numbered, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b FROM orders""")
def src8_file_dates(spark, sf_dir):
    names = t.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("time")).distinct()
    names = names.withColumns({"dotted": F.concat(F.lit("product."), F.date_format("time", "yyyy.MM.dd"), F.lit(".nc")), "numbered": F.concat(F.date_format("time", "yyyyDDD"), F.lit(".nc"))})
    return names.withColumns({"a": st.date_from_dotted(F.col("dotted")), "b": st.date_from_day_number(F.col("numbered"))})


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in files.VARIABLES) + ") AS v(name, collection, source_name)")
def src11_variables(spark, sf_dir):
    return files.variables(spark)


def _sanitise_sql(x: str) -> str:
    for a, b in st.SANITISE:
        x = f"replace({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    return x


_ODD = "'St. ' || n_name || ' & Isles: d''Or  / ' || CAST(n_nationkey AS VARCHAR)"


@query(f"SELECT n_nationkey, {_sanitise_sql(_ODD)} AS sanitised, replace(replace('A: ' || n_name, ': ', '_'), ' ', '_') AS directory, replace(replace('Paua ' || n_name || '''s', '''', ''), 'Paua', 'Papua') AS corrected, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS padded FROM nation")
def str1_str4_names(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation")
    odd = F.concat(F.lit("St. "), "n_name", F.lit(" & Isles: d'Or  / "), F.col("n_nationkey").cast("string"))
    return n.select(
        "n_nationkey",
        st.sanitise(odd).alias("sanitised"),
        st.region_directory(F.concat(F.lit("A: "), "n_name")).alias("directory"),
        st.corrected(F.concat(F.lit("Paua "), "n_name", F.lit("'s"))).alias("corrected"),
        st.padded(F.col("n_nationkey"), 3).alias("padded"),
    )


@query("SELECT n_nationkey, '#' || lpad(lower(to_hex(n_nationkey * 10)), 2, '0') || lpad(lower(to_hex(255 - n_nationkey)), 2, '0') || '00' AS colour, [n_nationkey * 10, 255 - n_nationkey, 0] AS rgb FROM nation")
def str6_colours(spark, sf_dir):
    n = F.col("n_nationkey")
    colour = st.hex_from_rgb(n * 10, 255 - n, F.lit(0))
    return t.table(spark, sf_dir, "nation").select("n_nationkey", colour.alias("colour"), st.rgb_from_hex(colour).alias("rgb"))


_LEAP = "((year(d) % 4 = 0 AND year(d) % 100 <> 0) OR year(d) % 400 = 0)"


@query(f"""WITH x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d, CAST(dayofyear(d) - CASE WHEN year(d) % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS doy_reference,
  CAST(dayofyear(d) - CASE WHEN {_LEAP} AND dayofyear(d) > 59 THEN 1 ELSE 0 END AS INTEGER) AS doy_correct, CAST(date_trunc('month', d) AS DATE) AS month_begin, last_day(d) AS month_end,
  CAST(day(last_day(d)) AS INTEGER) AS days, monthname(d + INTERVAL 1 MONTH) || '-' || monthname(d + INTERVAL 3 MONTH) AS season FROM x""")
def dt1_dt3_dt4_dt6_dt9_calendar(spark, sf_dir):
    d = F.col("d")
    x = t.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return x.select("d", cal.doy(d).alias("doy_reference"), cal.doy(d, "correct").alias("doy_correct"), cal.month_begin(d).alias("month_begin"), cal.month_end(d).alias("month_end"), cal.days_in_month(d).alias("days"), cal.period_label(d, F.lit(3)).alias("season"))


@query("SELECT s_suppkey, round(s_acctbal + 300 - 273.15, 6) AS celsius, round(s_acctbal * 1000.0, 6) AS mm FROM supplier")
def dt10_units(spark, sf_dir):
    return t.table(spark, sf_dir, "supplier").select("s_suppkey", F.round(cal.kelvin_to_celsius(F.col("s_acctbal") + 300), 6).alias("celsius"), F.round(cal.metres_to_millimetres(F.col("s_acctbal")), 6).alias("mm"))


@query("SELECT n_name FROM nation WHERE n_nationkey < 15 INTERSECT SELECT n_name FROM nation WHERE n_nationkey > 5 EXCEPT SELECT n_name FROM nation WHERE n_nationkey = 10")
def set2_names(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation")
    part = lambda c: n.where(c).select("n_name")
    return part("n_nationkey < 15").intersect(part("n_nationkey > 5")).subtract(part("n_nationkey = 10"))


@query("SELECT n_name, r_name, n_regionkey FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' UNION ALL SELECT NULL, r_name, r_regionkey FROM region ANTI JOIN nation ON n_regionkey = r_regionkey")
def jn7_jn13_set1_attributes(spark, sf_dir):
    n, r = t.table(spark, sf_dir, "nation"), t.table(spark, sf_dir, "region")
    left = n.join(r.where("r_name <> 'ASIA'"), n.n_regionkey == r.r_regionkey, "left").select("n_name", "r_name", "n_regionkey")
    unused = r.join(n, n.n_regionkey == r.r_regionkey, "left_anti").select(F.lit(None).cast("string").alias("n_name"), "r_name", F.col("r_regionkey").alias("n_regionkey"))
    return left.unionByName(unused)


@query("SELECT event_type AS name, CAST(ts AS DATE) AS time, round(sum(value), 6) AS value, count(*) AS n FROM events GROUP BY ALL")
def stm2_daily_increment(spark, sf_dir):
    """The streaming aggregation on a table: the same rows as the stream writes once all days are final."""
    return daily.daily_sums(t.table(spark, sf_dir, "events")).withColumn("value", F.round("value", 6))


@query(SQL[monitoring.win1_running_sums.__name__])
def stm2_trailing_sums(spark, sf_dir):
    """A replay of the archive: its days arrive as files in any order, and the stream keeps the sums of each cell.

    The rows are those of the running sums over the finished series."""
    periods = (3, 7, 30)
    with files.workspace(spark) as folder:
        t.obs_daily(spark, sf_dir).repartitionByRange(6, "time").write.parquet(f"{folder}/days")
        # No day of the archive is too late.
        sums = trailing.trailing_sums(trailing.read_days(spark, f"{folder}/days", 2), periods, late=36_500)
        trailing.write_sums(sums, f"{folder}/sums", f"{folder}/checkpoint").awaitTermination()
        newest = trailing.latest(spark.read.parquet(f"{folder}/sums"))
        return newest.withColumns({f"sum_{n}d": F.round(f"sum_{n}d", 6) for n in periods}).checkpoint()
