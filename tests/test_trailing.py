"""Trailing sums of a stream: late days, corrections and restarts against sums over the whole series."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import windows as win
from pluvio.sources import tables as t
from pluvio.streaming import trailing as tr

PERIODS = (3, 7, 30)
COLUMNS = ["iy", "ix", "time", "sum_3d", "sum_7d", "sum_30d"]


def run(spark, source, folder, late=40, files=1):
    sums = tr.trailing_sums(tr.read_days(spark, source, files), PERIODS, late)
    tr.write_sums(sums, f"{folder}/sums", f"{folder}/checkpoint").awaitTermination()
    return tr.latest(spark.read.parquet(f"{folder}/sums"))


def table(df):
    return {(r.iy, r.ix, r.time): tuple(None if r[c] is None else round(r[c], 6) for c in COLUMNS[3:]) for r in df.collect()}


def put(spark, rows, path):
    spark.createDataFrame(rows, tr.DAYS).coalesce(1).write.mode("append").parquet(path)


def test_shuffled_days_give_the_running_sums(spark, sf_dir, tmp_path):
    """Blocks of ten days that come up to three blocks late, over batches; the run is ended and taken up in between."""
    obs = t.obs_daily(spark, sf_dir).where("iy < 2 and time < '1995-09-01'")
    obs = obs.withColumn("precip", F.coalesce("precip", F.when(F.dayofyear("time") % 50 != 0, 0.0)))
    rows = [tuple(r) for r in obs.select("iy", "ix", "time", "precip").collect()]
    rng, first = random.Random(4), min(r[2] for r in rows)
    blocks = {}
    for r in rows:
        blocks.setdefault((r[2] - first).days // 10, []).append(r)
    order = sorted(blocks, key=lambda b: b + rng.uniform(0, 3))
    assert order != sorted(order)
    source = str(tmp_path / "days")
    for part in (order[: len(order) // 2], order[len(order) // 2 :]):
        for b in part:
            rng.shuffle(blocks[b])
            put(spark, blocks[b], source)
        got = run(spark, source, tmp_path, files=3)
    want = table(win.running_sums(obs, PERIODS).drop("precip"))
    assert table(got) == want and any(v[2] is not None for v in want.values()) and any(v[2] is None for v in want.values())
    versions = spark.read.parquet(f"{tmp_path}/sums")
    assert versions.groupBy("iy", "ix", "time", "version").count().where("count > 1").isEmpty()
    again = run(spark, source, tmp_path)
    assert table(again) == want


def sums(values):
    """Of days numbered from 0."""
    out = {}
    for d in values:
        windows = [[values.get(e) for e in range(d - p + 1, d + 1)] for p in PERIODS]
        out[0, 0, dt.date(2000, 1, 1) + dt.timedelta(d)] = tuple(None if None in w else round(sum(w), 6) for w in windows)
    return out


def test_corrections_and_days_that_come_too_late(spark, tmp_path):
    row = lambda d, v: (0, 0, dt.date(2000, 1, 1) + dt.timedelta(d), v)
    source, values = str(tmp_path / "days"), {d: 1.0 for d in range(60)}
    put(spark, [row(d, v) for d, v in values.items()] + [(1, 1, None, 5.0)], source)
    assert table(run(spark, source, tmp_path, late=10)) == sums(values)
    # A correction, a day beyond the limit, a value that is taken back, and two rows for one day.
    put(spark, [row(55, 2.0), row(20, 100.0), row(56, None), row(58, 3.0), row(58, 4.0)], source)
    values.update({55: 2.0, 56: None, 58: 4.0})
    assert table(run(spark, source, tmp_path, late=10)) == sums(values)
    put(spark, [row(56, 0.5), row(61, 1.0)], source)
    values.update({56: 0.5, 61: 1.0})
    assert table(run(spark, source, tmp_path, late=10)) == sums(values)
    put(spark, [row(60, 7.0)], source)
    values[60] = 7.0
    assert table(run(spark, source, tmp_path, late=10)) == sums(values)


def test_windows_by_brute_force():
    rng = np.random.default_rng(2)
    days = np.unique(rng.integers(0, 80, 60)).astype(np.int32)
    values = np.where(rng.random(len(days)) < 0.1, np.nan, rng.random(len(days)))
    at = dict(zip(days.tolist(), values.tolist(), strict=True))
    for period in (1, 3, 10):
        got = tr.window_sums(days, values, days, period)
        for end, value in zip(days.tolist(), got, strict=True):
            window = [at.get(d, float("nan")) for d in range(end - period + 1, end + 1)]
            assert value == pytest.approx(sum(window), nan_ok=True)
        changed = np.sort(rng.choice(days, 3, replace=False))
        assert tr.changed_ends(days, changed, period).tolist() == [d for d in days.tolist() if any(0 <= d - c < period for c in changed.tolist())]
    assert len(tr.changed_ends(days, days[:0], 3)) == 0
