"""Readers and writers: warehouse tables, raw CSV exports, pages, databases and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.operators.loaders import COUNTERS

#: Columns of the warehouse tables that feature scans project, by table, with the time that tells the current row of a key.
PROJECTIONS = {
    "fight_events": ["event_id", "event_name", "event_date", "city", "state", "country", "event_status", "scraped_at"],
    "fighters": ["fighter_id", "full_name", "first_name", "last_name", "nickname", "height_cm", "weight_lbs", "reach_cm", "stance", "dob", "scraped_at"],
    "fights": ["fight_id", "event_id", "fighter_1_id", "fighter_2_id", "winner_fighter_id", "result_type", "weight_class", "is_title_fight", "is_interim_title", "scheduled_rounds", "finish_method", "finish_detail", "finish_round", "finish_time_seconds", "referee", "scraped_at"],
    "fight_stats_aggregate": ["fight_stat_id", "fight_id", "fighter_id", *COUNTERS, "scraped_at"],
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The projected columns of a table; the scan reads no others."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*PROJECTIONS[name]) if name in PROJECTIONS else df


def read_csv(spark: SparkSession, path: str, columns: list[str], optional: bool = False) -> DataFrame:
    """A CSV export with a header, all columns as strings, quotes doubled inside quotes, line breaks allowed in cells.

    With ``optional`` a missing file is an empty table.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    if optional and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True, enforceSchema=False, encoding="UTF-8")


def with_status(events: DataFrame, manifest: DataFrame) -> DataFrame:
    """Events with the status of the manifest (event_id, event_status); 'completed' where it has none."""
    status = manifest.select("event_id", F.nullif(F.trim("event_status"), F.lit("")).alias("_s")).dropDuplicates(["event_id"])
    return events.join(status, "event_id", "left").withColumn("event_status", F.coalesce("_s", F.lit("completed"))).drop("_s")


def read_pages(spark: SparkSession, glob: str) -> DataFrame:
    """(path, html) of saved pages, one row a file; bytes that are no UTF-8 become U+FFFD."""
    return spark.read.format("binaryFile").load(glob).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def read_database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of a database by JDBC; partitionColumn, lowerBound, upperBound and numPartitions split it."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options).load()


def numeric_columns(df: DataFrame) -> list[str]:
    """Nullable columns of small integers and decimals, which reports cover."""
    return [f.name for f in df.schema if f.nullable and f.dataType.simpleString().split("(")[0] in ("decimal", "smallint")]


def write_report(df: DataFrame, path: str, order: list) -> None:
    """A sorted report as one CSV file with a header; reports are small whatever the tables' size."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True)


def append_log(df: DataFrame, path: str) -> None:
    """Adds rows to a fetch log; missing fields are empty texts."""
    df.na.fill("").write.mode("append").parquet(path)
