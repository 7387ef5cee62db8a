"""Monthly and annual images from a state that grows by batches, without reading composites again.

The state holds, for each batch of composites, (sum of values, how many, how many filled, how many cells) of each cell and month.
These add up, so images of months and years come from the state alone, whatever the order of the batches, and an annual mean is
over composites, not over months. A batch's part lies in a folder of its number and is overwritten whole: a batch that is run
again leaves the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacunar.functions import flags as fl
from lacunar.operators.aggregate import with_month

STATE = "year int, month int, y int, x int, total double, n long, filled long, cells long"


def part(composites: DataFrame) -> DataFrame:
    """year, month, y, x, total, n, filled, cells of some composites (year, doy, y, x, value, flags)."""
    rows = with_month(composites).groupBy("year", "month", "y", "x").agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.count_if(fl.any_of(F.col("flags"), fl.ANY_FILL)).alias("filled"), F.count("*").alias("cells")
    )
    return rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in STATE.split(", ")])


def put(composites: DataFrame, state: str, batch: int) -> None:
    """Add a batch to the state. Its number is its name: the same batch again replaces itself."""
    part(composites).write.mode("overwrite").parquet(f"{state}/batch={batch}")


def read(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.schema(f"{STATE}, batch long").parquet(state)


def images(spark: SparkSession, state: str) -> DataFrame:
    """Months and years (month 0): value and filled percent, as `aggregate.month_and_year` makes them of all composites."""
    rows = read(spark, state)
    sets = [[rows["year"], rows["month"], rows["y"], rows["x"]], [rows["year"], rows["y"], rows["x"]]]
    both = rows.groupingSets(sets, "year", "month", "y", "x").agg(
        (F.sum("total") / F.when(F.sum("n") > 0, F.sum("n"))).alias("value"), (100 * F.sum("filled") / F.sum("cells")).alias("filled_percent")
    )
    return both.withColumn("month", F.coalesce("month", F.lit(0)))


def watch(stream: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """A query that adds whatever composites have come since its last run, then ends."""
    return stream.writeStream.foreachBatch(lambda batch, number: put(batch, state, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
