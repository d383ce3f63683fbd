"""Monthly files as a stream: each new file's steps become means by cell. An extra beside the batch preparation of forcing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import calendar, series

STEPS = "path string, time_idx int, cell long, value double"


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, token: str, first: int, last: int, files_at_once: int = 64) -> StreamingQuery:
    """Take up what is new in the folder of step tables and stop. A file of steps holds whole months.

    Each batch writes its months' folders whole, so a batch that is run again after a failure leaves the same rows.
    """
    steps = spark.readStream.schema(STEPS).option("maxFilesPerTrigger", files_at_once).parquet(source)

    def write(batch: DataFrame, _: int) -> None:
        months = calendar.month_files(batch.select("path").distinct(), token, first, last)
        means = series.time_mean(batch.join(months, "path"), ["cell", "year", "month"], "value")
        means.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(out)

    return steps.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def months(spark: SparkSession, out: str) -> DataFrame:
    """(cell, series): the means so far in calendar order."""
    return series.stacked(spark.read.parquet(out).withColumn("step", F.col("year") * 12 + F.col("month")), ["cell"], "step", "mean")
