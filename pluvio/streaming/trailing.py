"""Sums over the last days of every cell, kept up to date by a stream of daily values.

The stream's state is keyed by cell: the values of the days that a sum may still need. A day that arrives late is put in
its place, and the sums of all days whose windows hold it are put out anew with a higher version. The sink only appends, so
that a restart from the checkpoint neither loses nor repeats rows; `latest` reads the newest version of each day.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pluvio.operators.windows import CELL, PERIODS

DAYS = "iy int, ix int, time date, precip double"
_STATE = "days binary, values binary, newest int, version long"


def read_days(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """(iy, ix, time, precip) from a folder of Parquet files, as they arrive."""
    return spark.readStream.schema(DAYS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def window_sums(days: np.ndarray, values: np.ndarray, ends: np.ndarray, period: int) -> np.ndarray:
    """Sums of the `period` days to each end; NaN unless all of them are there with a value.

    days: sorted day numbers without repeats; ends: some of them."""
    known = ~np.isnan(values)
    total = np.concatenate([[0.0], np.cumsum(np.where(known, values, 0.0))])
    count = np.concatenate([[0], np.cumsum(known)])
    first, last = np.searchsorted(days, ends - period + 1), np.searchsorted(days, ends, "right")
    return np.where(count[last] - count[first] == period, total[last] - total[first], np.nan)


def changed_ends(days: np.ndarray, changed: np.ndarray, longest: int) -> np.ndarray:
    """The days that are there and whose longest window holds a changed day."""
    before = np.searchsorted(changed, days, "right")
    return days[(before > 0) & (days - changed[np.maximum(before, 1) - 1] < longest)] if len(changed) else days[:0]


def _advance(periods: tuple[int, ...], late: int):
    longest = max(periods)

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            raw_days, raw_values, newest, version = state.get
            days, values = np.frombuffer(raw_days, np.int32), np.frombuffer(raw_values, np.float64)
        else:
            days, values, newest, version = np.zeros(0, np.int32), np.zeros(0), None, 0
        came = pd.concat(list(batches))
        came = came[came["time"].notna()]
        number = came["time"].to_numpy("datetime64[D]").astype(np.int32)
        value = came["precip"].to_numpy(float)
        if newest is not None:
            value, number = value[number >= newest - late], number[number >= newest - late]
        if not len(number):
            return
        # Of rows for one day the greatest value counts, a missing one least, whatever their order.
        order = np.lexsort((np.where(np.isnan(value), -np.inf, value), number))
        number, value = number[order], value[order]
        last = np.append(number[1:] != number[:-1], True)
        number, value = number[last], value[last]
        kept = ~np.isin(days, number)
        days, values = np.concatenate([days[kept], number]), np.concatenate([values[kept], value])
        order = np.argsort(days)
        days, values = days[order], values[order]
        ends = changed_ends(days, number, longest)
        newest, version = int(days[-1]) if newest is None else max(newest, int(days[-1])), version + 1
        sums = {f"sum_{n}d": window_sums(days, values, ends, n) for n in periods}
        held = days > newest - late - longest
        state.update((days[held].tobytes(), values[held].tobytes(), newest, version))
        yield pd.DataFrame({CELL[0]: key[0], CELL[1]: key[1], "time": ends.astype("datetime64[D]").astype(object), **sums, "version": version})

    return advance


def trailing_sums(days: DataFrame, periods=PERIODS, late: int = 30) -> DataFrame:
    """(iy, ix, time, sum_<n>d ..., version) of a stream (iy, ix, time, precip): the sums over the n days to `time`.

    A sum is null until all its days are there with a value, as in `windows.running_sums`. Days may come in any order, as
    long as a day is no more than `late` days older than the newest day of its cell in earlier batches; older ones are left
    out. A day that comes again, or late, corrects: its value replaces the one before, and every day up to the longest
    period after it is put out again with a higher version. Of several rows for one day in a batch the greatest value
    counts. Rows without a day are left out. A cell's state is no more than the longest period and `late` days.
    """
    periods = tuple(periods)
    columns = ", ".join(f"sum_{n}d double" for n in periods)
    return (
        days.select(*CELL, "time", F.col("precip").cast("double").alias("precip"))
        .groupBy(*CELL)
        .applyInPandasWithState(_advance(periods, late), f"iy int, ix int, time date, {columns}, version long", _STATE, "append", GroupStateTimeout.NoTimeout)
    )


def write_sums(sums: DataFrame, path: str, checkpoint: str):
    """Append what has come to a table; a restart with the same checkpoint goes on where the last run ended."""
    return sums.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def latest(sums: DataFrame) -> DataFrame:
    """The newest version of each cell and day, without the version: one aggregation, combined before the shuffle."""
    rest = [c for c in sums.columns if c not in (*CELL, "time", "version")]
    newest = sums.groupBy(*CELL, "time").agg(F.max_by(F.struct(*rest), "version").alias("_x"))
    return newest.select(*CELL, "time", *[F.nullif(F.col(f"_x.{c}"), F.lit(float("nan"))).alias(c) for c in rest])
