"""Reading gridded time series, and names of daily files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.config import Limits

OBS = "variable string, year int, doy int, y int, x int, value double"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def file_date(path: Column) -> dict[str, Column]:
    """year and doy of a daily file's name: `name.YYYY.DDD.summary.res.summary...`, or, with fewer than six parts, a letter,
    the year and the day (`AYYYYDDD...`)."""
    name = base_name(path)
    parts = F.split(name, r"\.")
    new = F.size(parts) >= 6
    year = F.when(new, F.get(parts, F.lit(1))).otherwise(F.substring(name, 2, 4))
    doy = F.when(new, F.get(parts, F.lit(2))).otherwise(F.substring(name, 6, 3))
    return {"year": year.try_cast("int"), "doy": doy.try_cast("int")}


def night_name(day_path: Column) -> Column:
    """The night file that belongs to a day file."""
    return F.replace(day_path, F.lit("Day"), F.lit("Night"))


def file_index(spark: SparkSession, pattern: str) -> DataFrame:
    """path, year, doy of the files that match a pattern; only names are read."""
    files = spark.read.format("binaryFile").load(pattern).select("path")
    return files.select("path", *[c.alias(n) for n, c in file_date(F.col("path")).items()])


def read_obs(spark: SparkSession, path: str, variable: str | None = None, pattern: str | None = None) -> DataFrame:
    """A parquet archive written by (variable, doy, year); filters on those prune folders, those on y and x row groups."""
    reader = spark.read.schema(OBS)
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)
    return df.where(F.col("variable") == variable) if variable else df


def no_data(df: DataFrame, limits: Limits, columns: tuple[str, ...] = ("value",)) -> DataFrame:
    """The no-data value and NaN become NULL."""
    return df.withColumns({c: F.when(~F.isnan(F.col(c)) & (F.col(c) != limits.ndv), F.col(c)) for c in columns})


def wrong_no_data(meta: DataFrame, limits: Limits) -> DataFrame:
    """Files (path, ndv) whose no-data value isn't the configured one."""
    return meta.where(~F.col("ndv").eqNullSafe(F.lit(limits.ndv)))
