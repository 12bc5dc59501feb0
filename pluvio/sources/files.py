"""Reading and writing cubes as Parquet and CSV, and checks of which days are there."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pluvio.functions.strings import date_from_day_number, date_from_dotted

SCHEMAS = {
    "obs_daily": "time date, iy int, ix int, lat double, lon double, precip double",
    "ensemble": "gcm string, init date, step int, member int, iy int, ix int, lat double, lon double, precip double",
    "quantile_climatology": "month int, step int, iy int, ix int, edges array<double>, n_instances bigint",
    "doy_climatology": "ndays int, doy int, iy int, ix int, average double, edges array<double>, alpha double, beta double",
    "probabilities": "gcm string, init date, step int, iy int, ix int, category int, prob double",
    "mask": "region string, iy int, ix int",
    "stations": "station_name string, country string, lat double, lon double",
    "domains": "name string, lon_min double, lon_max double, lat_min double, lat_max double",
}
# Variables of the seasonal archive: name, collection, name there.
VARIABLES = [
    ("t2m", "seasonal-monthly-single-levels", "2m_temperature"),
    ("tprate", "seasonal-monthly-single-levels", "total_precipitation"),
    ("sst", "seasonal-monthly-single-levels", "sea_surface_temperature"),
    ("10m uwind", "seasonal-monthly-single-levels", "10m_u_component_of_wind"),
    ("10m vwind", "seasonal-monthly-single-levels", "10m_v_component_of_wind"),
    ("mslp", "seasonal-monthly-single-levels", "mean_sea_level_pressure"),
    ("latent heat flux", "seasonal-monthly-single-levels", "surface_latent_heat_flux"),
    ("solar radiation", "seasonal-monthly-single-levels", "surface_solar_radiation"),
    ("t2m anomaly", "seasonal-postprocessed-single-levels", "2m_temperature_anomaly"),
    ("tprate anomaly", "seasonal-postprocessed-single-levels", "total_precipitation_anomalous_rate_of_accumulation"),
    ("sst anomaly", "seasonal-postprocessed-single-levels", "sea_surface_temperature_anomaly"),
    ("10m uwind anomaly", "seasonal-postprocessed-single-levels", "10m_u_component_of_wind_anomaly"),
    ("10m vwind anomaly", "seasonal-postprocessed-single-levels", "10m_v_component_of_wind_anomaly"),
    ("mslp anomaly", "seasonal-postprocessed-single-levels", "mean_sea_level_pressure_anomaly"),
    ("latent heat flux anomaly", "seasonal-postprocessed-single-levels", "surface_latent_heat_flux_anomalous_rate_of_accumulation"),
    ("solar radiation anomaly", "seasonal-postprocessed-single-levels", "surface_solar_radiation_anomalous_rate_of_accumulation"),
    ("geopotential", "seasonal-monthly-pressure-levels", "geopotential"),
    ("temperature", "seasonal-monthly-pressure-levels", "temperature"),
    ("uwind", "seasonal-monthly-pressure-levels", "u_component_of_wind"),
    ("vwind", "seasonal-monthly-pressure-levels", "v_component_of_wind"),
    ("specific humidity", "seasonal-monthly-pressure-levels", "specific_humidity"),
    ("geopotential anomaly", "seasonal-postprocessed-pressure-levels", "geopotential"),
    ("temperature anomaly", "seasonal-postprocessed-pressure-levels", "temperature"),
    ("uwind anomaly", "seasonal-postprocessed-pressure-levels", "u_component_of_wind"),
    ("vwind anomaly", "seasonal-postprocessed-pressure-levels", "v_component_of_wind"),
    ("specific humidity anomaly", "seasonal-postprocessed-pressure-levels", "specific_humidity"),
]


def variables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VARIABLES, "name string, collection string, source_name string")


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column, so that aggregates skip it."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, kind in df.dtypes if kind in ("double", "float")})


def read_cube(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return without_nan(spark.read.schema(schema).parquet(path))


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", drop_missing: bool = False) -> DataFrame:
    """A CSV table with a header; white-space tables take a blank as separator and lose leading blanks."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return df.dropna() if drop_missing else df


def read_whitespace_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table with any run of blanks between its columns, headed by one line that begins with a letter."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(~F.col("value").rlike(r"^\s*([A-Za-z]|$)"))
    return rows.select([F.get(parts, F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """(name, lon_min, lon_max, lat_min, lat_max) of a JSON object of boxes."""
    text = spark.read.option("wholetext", True).text(path)
    named = text.select(F.explode(F.from_json("value", "map<string,array<double>>")).alias("name", "box"))
    return named.select("name", *[F.get("box", F.lit(i)).alias(c) for i, c in enumerate(("lon_min", "lon_max", "lat_min", "lat_max"))])


def read_config(path: str) -> dict[str, str]:
    """Flat "key: value" lines as strings; comments and blank lines are left out."""
    lines = (x.split("#", 1)[0] for x in Path(path).read_text().splitlines())
    return {k.strip(): v.strip().strip("'\"") for k, _, v in (x.partition(":") for x in lines if ":" in x)}


def file_dates(df: DataFrame, style: str = "dotted") -> DataFrame:
    """df with the date in the name of each row's file."""
    name = F.input_file_name()
    return df.withColumn("file_date", date_from_dotted(name) if style == "dotted" else date_from_day_number(name))


def expected_days(spark: SparkSession, first, last) -> DataFrame:
    """(time): every day from first to last."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("time"))


def missing_days(present: DataFrame, first, last, time: str = "time") -> DataFrame:
    """Expected days that are not there."""
    return expected_days(present.sparkSession, first, last).join(present.select(F.col(time).alias("time")).distinct(), "time", "left_anti")


def next_days(present: DataFrame, today, lag: int, time: str = "time") -> DataFrame:
    """Days after the last one there, up to `lag` days before today."""
    last = present.agg(F.date_add(F.max(time), 1).alias("a"), F.date_sub(F.lit(today).cast("date"), lag).alias("b"))
    return last.where("a <= b").select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("time"))


def last_days(df: DataFrame, last, ndays: int, time: str = "time", complete: bool = True) -> DataFrame:
    """The rows of the ndays days to `last`; an error names the days that are missing if they must be complete."""
    day = F.lit(last).cast("date")
    part = df.where(F.col(time).between(F.date_sub(day, ndays - 1), day))
    if complete:
        first = df.sparkSession.range(1).select(F.date_sub(day, ndays - 1)).first()[0]
        lost = [str(r[0]) for r in missing_days(part, first, last, time).orderBy("time").limit(20).collect()]
        if lost:
            raise ValueError(f"days are missing: {', '.join(lost)}")
    return part


def freshness(df: DataFrame, today, time: str = "time") -> DataFrame:
    """last_day, its lag behind today in days, and the number of different days."""
    return df.agg(F.max(time).alias("last_day"), F.datediff(F.lit(today).cast("date"), F.max(time)).alias("lag_days"), F.countDistinct(time).alias("days"))


def write_cube(df: DataFrame, path: str, partition: list[str], mode: str = "overwrite") -> None:
    """Compressed Parquet, partitioned; only the partitions at hand are replaced."""
    df.write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode(mode).partitionBy(*partition).parquet(path)


def write_new(df: DataFrame, path: str, partition: list[str]) -> None:
    """Only the partitions that the target lacks are written."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        there = spark.read.parquet(path).select(*partition).distinct()
        df = df.join(there, partition, "left_anti")
    df.write.option("compression", "zstd").mode("append").partitionBy(*partition).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


@contextmanager
def workspace(spark: SparkSession):
    """A folder for the files of one job, in spark.checkpoint.dir, which the cluster's machines share; it goes when the job
    is done. A session on one machine that has none, as in tests, works in its warehouse; a cluster must set it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        shared = spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    folder = f"{shared}/work/{uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
