"""Domain tables from the driver's tables: cells, daily and monthly rainfall, an ensemble, stations and series.

Rows are tidy: integer cell indices (iy, ix) are the keys of the grid, lat and lon are attributes of a cell, and a missing
value is null. Every function reads only the columns that it needs, so that projections and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stations off the grid's nodes (name, country, lat, lon).
STATIONS = [("Alpha", "Tuvalu", -18.7, 161.2), ("Bravo", "Tuvalu", -11.9, 168.4), ("Charlie", "Kiribati", -6.1, 173.6), ("Delta", "Kiribati", 0.4, 179.7), ("Echo", "Tokelau", -14.2, 176.3)]
# Polygons as rings of (lon, lat): a rectangle and a concave L.
POLYGONS = [
    ("Box", [(158.0, -22.0), (172.0, -22.0), (172.0, -8.0), (158.0, -8.0), (158.0, -22.0)]),
    ("Ell", [(158.0, -22.0), (182.0, -22.0), (182.0, -13.0), (168.0, -13.0), (168.0, 2.0), (158.0, 2.0), (158.0, -22.0)]),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, iy, ix, lat, lon): a grid of 5 by 5 cells, one for each nation."""
    k = F.col("n_nationkey")
    iy, ix = F.floor(k / 5).cast("int"), (k % 5).cast("int")
    return table(spark, sf_dir, "nation").select(
        k.alias("k"), iy.alias("iy"), ix.alias("ix"), (F.lit(-20.0) + 5 * iy).alias("lat"), (F.lit(160.0) + 5 * ix).alias("lon")
    )


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, time, precip): rainfall on the days that report; partial sums are combined before the shuffle."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    item = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("time"), "l_quantity")
    return item.join(supplier, item.l_suppkey == supplier.s_suppkey).groupBy("k", "time").agg((F.sum("l_quantity") / 10).alias("precip"))


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(iy, ix, time, precip) on a dense spine of days for every cell; days without a report are null."""
    reported = rain(spark, sf_dir)
    # One row, without a job of its own; an empty table has no days.
    span = table(spark, sf_dir, "lineitem").agg(F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b"))
    days = F.explode(F.sequence("a", "b", F.expr("interval 1 day")))
    spine = cells(spark, sf_dir).crossJoin(F.broadcast(span)).select("k", "iy", "ix", days.alias("time"))
    return spine.join(reported, ["k", "time"], "left").select("iy", "ix", "time", "precip")


def obs_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(iy, ix, time, precip): sums of the reported days by month, stamped with the first day."""
    month = rain(spark, sf_dir).groupBy("k", F.trunc("time", "MM").alias("time")).agg(F.sum("precip").alias("precip"))
    return month.join(cells(spark, sf_dir), "k").select("iy", "ix", "time", F.round("precip", 6).alias("precip"))


def ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gcm, init, step, member, iy, precip): a near-complete ensemble over the five bands of the grid."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.floor(F.col("s_nationkey") / 5).cast("int").alias("iy"))
    item = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("gcm"),
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("init"),
        (F.col("l_partkey") % 5 + 1).cast("int").alias("step"),
        F.col("l_linenumber").alias("member"),
        "l_extendedprice",
    )
    joined = item.join(supplier, item.l_suppkey == supplier.s_suppkey)
    return joined.groupBy("gcm", "init", "step", "member", "iy").agg(
        # Whole cents add up alike in any order.
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / F.count("*") / F.lit(100000.0)).alias("precip")
    )


def stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "station_name string, country string, lat double, lon double")


def polygons(spark: SparkSession) -> DataFrame:
    """(region, ring) with ring an array of (lon, lat)."""
    return spark.createDataFrame(POLYGONS, "region string, ring array<struct<lon:double,lat:double>>")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, time, value): daily sums of events by type."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name"), F.to_date("ts").alias("time"))
    return e.agg(F.round(F.sum("value"), 6).alias("value"))


#: The same tables as common table expressions in DuckDB's SQL.
SQL_CELLS = """cells AS (SELECT n_nationkey AS k, CAST(n_nationkey // 5 AS INTEGER) AS iy, CAST(n_nationkey % 5 AS INTEGER) AS ix,
  -20.0::DOUBLE + 5 * (n_nationkey // 5) AS lat, 160.0::DOUBLE + 5 * (n_nationkey % 5) AS lon FROM nation)"""
SQL_RAIN = """rain AS (SELECT s_nationkey AS k, CAST(l_shipdate AS DATE) AS time, sum(l_quantity) / 10 AS precip
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""
SQL_OBS = f"""{SQL_CELLS}, {SQL_RAIN},
days AS (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS time FROM lineitem),
obs AS (SELECT iy, ix, days.time, precip FROM cells CROSS JOIN days LEFT JOIN rain ON rain.k = cells.k AND rain.time = days.time)"""
SQL_MONTHLY = f"""{SQL_CELLS}, {SQL_RAIN},
monthly AS (SELECT iy, ix, CAST(date_trunc('month', time) AS DATE) AS time, round(sum(precip), 6) AS precip FROM rain JOIN cells USING (k) GROUP BY ALL)"""
SQL_ENS = """ens AS (SELECT l_returnflag AS gcm, CAST(date_trunc('month', l_shipdate) AS DATE) AS init, CAST(l_partkey % 5 + 1 AS INTEGER) AS step,
  l_linenumber AS member, CAST(s_nationkey // 5 AS INTEGER) AS iy, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100000.0::DOUBLE AS precip
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""
SQL_SERIES = "series AS (SELECT event_type AS name, CAST(ts AS DATE) AS time, round(sum(value), 6) AS value FROM events GROUP BY ALL)"
SQL_STATIONS = "stations(station_name, country, lat, lon) AS (VALUES " + ", ".join(f"('{n}', '{c}', CAST({a} AS DOUBLE), CAST({o} AS DOUBLE))" for n, c, a, o in STATIONS) + ")"
SQL_EDGES = "edges(region, n, lon, lat) AS (VALUES " + ", ".join(f"('{name}', {i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for name, ring in POLYGONS for i, (x, y) in enumerate(ring)) + ")"
