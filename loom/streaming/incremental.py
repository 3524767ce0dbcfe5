"""The restartable tables as a stream: files that arrive are appended once, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loom.sources.tables import append_pending


def append_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, transform=None) -> StreamingQuery:
    """Reads Parquet files as they come below source; each micro-batch adds the keys that target lacks.

    A batch that is repeated after a failure adds nothing twice, since its keys are there. Within a batch one row of each key
    counts. The query handles what is there and stops; start it again for what came later.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    rows = transform(rows) if transform else rows

    def add(batch: DataFrame, _: int) -> None:
        append_pending(batch.dropDuplicates([key]), target, key)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, key, count) of a stream of rows by event time; state older than `late` is let go."""
    from pyspark.sql import functions as F

    return stream.withWatermark(time, late).groupBy(F.window(time, window),
        key).agg(F.count("*").alias("count")).select(F.col("window.start").alias("start"), key, "count")
