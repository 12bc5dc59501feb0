"""Queries cover all rows of their tables; test_oracle.py holds them against their SQL."""

import re

import pytest

from pluvio import catalog
from pluvio.plans.verification import bands

NAMES = sorted(catalog.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_no_part_is_taken(name):
    assert not re.search("l_linenumber <= 2|2000-03-01|k = 3|iy < 4", catalog.oracle_sql()[name])


def test_all_rows(spark, sf_dir):
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    nation = {r.s_suppkey: r.s_nationkey for r in table("supplier").collect()}
    lines = [(nation[r.l_suppkey], r.l_shipdate.date(), round(r.l_extendedprice * 100)) for r in table("lineitem").collect() if r.l_suppkey in nation]
    groups = {}
    for k, day, cents in lines:
        groups.setdefault((k // 5, day.replace(day=1)), []).append(cents)
    got = {(r.iy, r.time): r.precip for r in bands(spark, sf_dir).collect()}
    assert got == pytest.approx({key: sum(v) / len(v) / 100000 for key, v in groups.items()})
    days = (max(x[1] for x in lines) - min(x[1] for x in lines)).days + 1
    cells = table("nation").count()
    queries = catalog.queries()
    assert queries["win5_construct"](spark, sf_dir).count() == cells * days * 15
    assert queries["reg5_fill_nearest"](spark, sf_dir).count() == queries["jn9_src23_doy_join"](spark, sf_dir).count() == cells * days
    reported = {(k, day) for k, day, _ in lines}
    missing = {(r.k, r.time) for r in queries["src4_src5_missing_days"](spark, sf_dir).collect()}
    assert not missing & reported and len(missing) + len(reported) == cells * 2528
