"""Streams of table rows: keyed merges by micro-batch, and counts with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from priorview.operators.merge import latest, upsert_buckets


def stream_upserts(rows: DataFrame, path: str, keys: list[str], order: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges a stream of rows into the table of buckets at ``path`` (``read_buckets`` reads it): a batch rewrites only the
    buckets its keys fall in. The newest row of a key in a batch counts, and a batch that is given twice after a failure
    changes nothing the second time."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_buckets(batch.sparkSession, path, latest(batch, keys, [order]), keys, order)

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_counts(rows: DataFrame, time: str, group: list[str], window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows by tumbling window and group; rows later than ``late`` behind the newest are left out."""
    return rows.withWatermark(time, late).groupBy(F.window(time, window), *group).agg(F.count(F.lit(1)).alias("rows"))


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of a folder as they arrive, with the schema of those that are there."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
