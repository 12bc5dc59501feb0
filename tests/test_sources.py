"""Readers, writers and the stream."""

import datetime as dt

import pytest

from pluvio.sources import files
from pluvio.streaming import daily


def days(spark, *values):
    return spark.createDataFrame([(dt.date.fromisoformat(v), 1.0) for v in values], "time date, precip double")


def test_missing_days_raise_with_their_names(spark):
    df = days(spark, "2020-01-01", "2020-01-03")
    assert [r.time.day for r in files.missing_days(df, "2020-01-01", "2020-01-04").orderBy("time").collect()] == [2, 4]
    with pytest.raises(ValueError, match="2020-01-02"):
        files.last_days(df, "2020-01-03", 3)
    assert files.last_days(df, "2020-01-03", 1).count() == 1


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [r.x for r in files.without_nan(df).orderBy("k").collect()] == [None, 2.0]


def test_cube_round_trip_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "cube")
    files.write_cube(days(spark, "2020-01-01", "2020-01-02"), path, ["time"])
    files.write_cube(days(spark, "2020-01-02"), path, ["time"])
    files.write_new(days(spark, "2020-01-02", "2020-01-05"), path, ["time"])
    assert spark.read.parquet(path).count() == 3


def test_tables_of_text(spark, tmp_path):
    (tmp_path / "index.txt").write_text(" YR  MON  NINO\n 1982   1   26.7\n 1982  2  26.6\n")
    schema = spark.createDataFrame([], "yr int, mon int, nino double").schema
    assert [tuple(r) for r in files.read_whitespace_table(spark, str(tmp_path / "index.txt"), schema).orderBy("mon").collect()] == [(1982, 1, 26.7), (1982, 2, 26.6)]
    (tmp_path / "regions.json").write_text('{"A": [1.0, 2.0, 3.0, 4.0]}')
    assert tuple(files.read_regions(spark, str(tmp_path / "regions.json")).first()) == ("A", 1.0, 2.0, 3.0, 4.0)
    (tmp_path / "stations.csv").write_text("station_name,country,lat,lon\nA,B,1.5,2.5\nC,D,,\n")
    assert files.read_csv(spark, str(tmp_path / "stations.csv"), files.SCHEMAS["stations"], drop_missing=True).count() == 1
    (tmp_path / "c.yaml").write_text("# models\nECMWF: 51\nother: 'x'\n")
    assert files.read_config(str(tmp_path / "c.yaml")) == {"ECMWF": "51", "other": "x"}


def test_stream_writes_the_days_behind_the_watermark(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F

    source = str(tmp_path / "events")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(1).sortWithinPartitions("ts").write.parquet(source)
    days = daily.daily_sums(daily.read_events(spark, source))
    daily.write_daily(days, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = daily.daily_sums(spark.read.parquet(source)).withColumn("value", F.round("value", 4))
    got = {(r.name, r.time, round(r.value, 4), r.n) for r in streamed.collect()}
    assert got and got <= {(r.name, r.time, r.value, r.n) for r in batch.collect()}
