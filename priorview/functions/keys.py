"""Identifiers, calendar days in UTC, current rows and hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks that may surround an identifier.
BLANKS = " \t\r\n "


def norm_id(c: Column | str) -> Column:
    """Trimmed, lower-case identifier; empty becomes null (it refers to nothing)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.lower(F.btrim(c, F.lit(BLANKS))), F.lit(""))


def utc_day(c: Column | str) -> Column:
    """The UTC calendar day of a timestamp, whatever the session's time zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_from_unix_date(F.floor(F.unix_seconds(c) / F.lit(86400)).cast("int"))


def current_rows(df: DataFrame, key: str, columns: list[str], order: str = "scraped_at", key_expr: Column | None = None) -> DataFrame:
    """The row of each key with the newest ``order``; equal ones are decided by the larger column values.

    A ``max`` over a struct, so repeated rows of a hot key are combined before the shuffle. Rows
    without a key are left out; a null ``order`` is older than any other.
    """
    kept = [c for c in columns if c not in (key, order)]
    k = norm_id(key) if key_expr is None else key_expr
    rows = df.select(k.alias("_k"), F.struct(F.col(order).alias(order), *[F.col(c) for c in kept]).alias("_r"))
    best = rows.filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.max("_r").alias("_r"))
    return best.select(F.col("_k").alias(key), *[F.col(f"_r.{c}").alias(c) for c in (columns if order in columns else kept) if c != key])


def hot_keys(parts: list[DataFrame], share: float) -> list:
    """Keys that hold more than ``share`` of all rows of the one-column frames ``parts``.

    At most ``1 / share`` keys can do so, which bounds what reaches the driver. Counts are combined
    before the shuffle, and only the heavy keys are collected.
    """
    rows = reduce(DataFrame.unionAll, [p.toDF("k") for p in parts]).filter("k is not null")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = sum(p.count() for p in parts)
    if not total:
        return []
    return sorted(r.k for r in counts.filter(F.col("n") > F.lit(total * share)).collect())
