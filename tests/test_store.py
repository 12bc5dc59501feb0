"""The store of running sums by day of the year."""

import datetime as dt

from pluvio.sources import climatology as store


def test_only_the_days_around_a_target_are_read(spark, tmp_path):
    days = [dt.date(y, 1, 1) + dt.timedelta(i) for y in (2019, 2020) for i in range(366 if y == 2020 else 365)]
    sums = spark.createDataFrame([(k, 0, d, float(d.day)) for d in days for k in range(2)] + [(0, 0, None, 1.0)], "iy int, ix int, time date, sum_3d double")
    path = str(tmp_path / "store")
    store.write_sums(sums, path)
    targets = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 2, 29),), (dt.date(2024, 1, 2),), (None,)], "time date")
    near = store.read_around(spark, path, "iy int, ix int, time date, sum_3d double", targets, 3)
    got = {(r.target, r.time) for r in near.collect()}
    assert near.count() == 2 * len(got)

    def place(d):
        n = d.timetuple().tm_yday
        return n - 1 if d.year % 4 == 0 and n > 59 else n

    expected = set()
    for target in (dt.date(2024, 1, 2), dt.date(2024, 2, 29)):
        for d in days:
            gap = abs(place(d) - place(target))
            if min(gap, 365 - gap) <= 3:
                expected.add((target, d))
    assert got == expected
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan


def test_days_written_again_replace_their_own(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "iy int, ix int, time date, sum_3d double"
    row = lambda day, v: spark.createDataFrame([(0, 0, day, v)], schema)
    first, second = dt.date(2020, 5, 1), dt.date(2020, 6, 1)
    store.write_sums(row(first, 1.0).union(row(second, 2.0)), path)
    store.write_sums(row(first, 3.0), path)
    got = store.read_around(spark, path, schema, spark.createDataFrame([(first,), (second,)], "time date"), 0)
    assert sorted(r.sum_3d for r in got.collect()) == [2.0, 3.0]
    assert store.read_around(spark, path, schema, spark.createDataFrame([], "time date"), 3).count() == 0
