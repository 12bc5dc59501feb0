"""One Spark session for all tests, and a comparison of queries with their SQL."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", str(folder / "local"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """A value that compares alike from either engine."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    def check(query, sql: str) -> int:
        df = query(spark, SF)
        columns = sorted(df.columns)
        got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
        result = duck.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        place = [names.index(c) for c in columns]
        expected = sorted(repr(tuple(plain(r[i]) for i in place)) for r in result.fetchall())
        assert got == expected
        return len(got)

    return check
