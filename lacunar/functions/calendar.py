"""Days of the 8-daily calendar and their months."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOYS = tuple(range(1, 362, 8))


def month_of(doy: int) -> int:
    """Month of a composite's first day in a year of 365 days."""
    return (date(2001, 1, 1) + timedelta(days=doy - 1)).month


def doy_months(spark: SparkSession) -> DataFrame:
    """doy, month: 46 rows, to be broadcast."""
    return spark.createDataFrame([(d, month_of(d)) for d in DOYS], "doy int, month int")


def composite_doy(day: Column) -> Column:
    """Day-of-year of the composite that a date falls into."""
    return (1 + 8 * F.floor((F.dayofyear(day) - 1) / 8)).cast("int")
