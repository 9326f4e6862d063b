"""Stream of failed runs: each run is alerted once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import ERROR_STATES, IGNORED_TAG, failed

def failed_run_stream(runs: DataFrame, since: datetime, states=ERROR_STATES, ignored_tag: str = IGNORED_TAG) -> DataFrame:
    """Failed runs of a run-log stream, repeats included, however late they come."""
    return failed(runs, since, states, ignored_tag)


def write_alerts(alerts: DataFrame, path: str, checkpoint: str, *, id_col: str = "id", time_col: str = "end_time") -> StreamingQuery:
    """Process what has arrived and stop; each run gives one alert, and none is lost for being late.

    The alerts written so far are the memory of the stream, so there is no watermark that drops late rows and no state that
    grows in the executors. They lie by the day of ``time_col`` and by batch. A run keeps its end time, so a batch is compared with
    the days that it has rows of and reads no others. A batch that runs again after a failure compares itself with earlier batches only and
    replaces what it wrote the first time.
    """
    spark = alerts.sparkSession
    stored = alerts.withColumns({"day": F.to_date(time_col), "batch": F.lit(0).cast("bigint")})
    empty = spark.createDataFrame([], stored.schema)
    empty.write.mode("append").partitionBy("day", "batch").parquet(path)  # the folder must be there to be read

    def once(rows: DataFrame, number: int) -> None:
        fresh = rows.withColumn("day", F.to_date(time_col)).dropDuplicates([id_col])
        days = [r[0] for r in fresh.select("day").distinct().collect()]  # the days of one batch of failures
        earlier = spark.read.schema(stored.schema).parquet(path).where(F.col("batch") < number)
        seen = earlier.where(F.col("day").isin(*[d for d in days if d is not None]) | F.lit(None in days) & F.col("day").isNull())
        new = fresh.join(seen.select(id_col), id_col, "left_anti").withColumn("batch", F.lit(number).cast("bigint"))
        new.select(*stored.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)

    return alerts.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_alerts(spark: SparkSession, path: str, schema) -> DataFrame:
    """The alerts written so far; ``schema`` is that of the stream."""
    return spark.read.schema(schema).parquet(path).drop("day", "batch")
