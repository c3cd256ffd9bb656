"""Column profiles from maintained value counts.

Every load of a table becomes *signed deltas*: (column, value, +n) for rows it brought, -n for rows
it withdrew. Deltas are appended to a persistent table; nothing is counted twice, because a load's
deltas live in a folder of its own and are replaced when the load is applied again. All metrics are
exact and derive from the counts alone: the base tables are read once a load.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priorview.session import scratch_path

DELTAS = "table_name string, column_name string, load_id int, value string, is_null boolean, n bigint"


@dataclass(frozen=True)
class Form:
    """What a good value of a column looks like (over its string form) and whether its drift is by share or by mean."""

    good: object  # Column of the string value -> Column
    drift: str | None = None  # 'share', 'mean' or None


def deltas(rows: DataFrame, table_name: str, columns: list[str], load: str | None, sign: int = 1, load_id: int = 0) -> DataFrame:
    """Signed value counts of ``columns``; ``load`` names the column that numbers loads, else all rows are of ``load_id``.

    Every value is counted, also null, empty and blank ones; a null load is load -1. One scan; rows
    are combined before the shuffle, so frequent values cost nothing more than rare ones.
    """
    n = F.coalesce(F.col(load).cast("int"), F.lit(-1)) if load else F.lit(load_id)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select(n.alias("load_id"), F.inline(pairs))
    out = long.groupBy("column_name", "load_id", "value").agg((F.count(F.lit(1)) * sign).alias("n"))
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "load_id", "value", F.col("value").isNull().alias("is_null"), "n")


def current_deltas(rows: DataFrame, table_name: str, key: Column, columns: list[str], load: str, order: str) -> DataFrame:
    """Signed value counts of the *current* rows: a load's deltas are +1 for the values of each row that becomes the
    current one of its ``key`` (newest ``order``, ties by the larger values), and -1 for those of the row it supersedes.

    Rows that come late, older than what is held, change nothing. Rows without a key are left out; a null load is -1.
    """
    newest = F.struct(F.col(order).alias("o"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    each = rows.select(key.alias("k"), F.coalesce(F.col(load).cast("int"), F.lit(-1)).alias("load_id"), newest.alias("r")).filter("k is not null")
    best = each.groupBy("k", "load_id").agg(F.max("r").alias("r"))
    upto = Window.partitionBy("k").orderBy("load_id")
    held = best.withColumn("now", F.max("r").over(upto.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.max("r").over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    changed = held.filter(F.col("before").isNull() | (F.col("now") != F.col("before")))
    signed = lambda r, n: F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{r}.v{i}").alias("value"), F.lit(n).alias("n")) for i, c in enumerate(columns)])
    long = changed.select("load_id", F.inline(F.concat(signed("now", 1), F.when(F.col("before").isNotNull(), signed("before", -1)).otherwise(F.slice(signed("now", 1), 1, 0)))))
    out = long.groupBy("column_name", "load_id", "value").agg(F.sum("n").alias("n")).filter("n <> 0")
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "load_id", "value", F.col("value").isNull().alias("is_null"), "n")


class ValueCounts:
    """The persistent table of signed deltas, in ``path``: one folder for each application."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, (path or scratch_path(spark, "value-counts")).rstrip("/")

    def apply(self, changes: DataFrame, name: str) -> None:
        """Adds the deltas under ``name``; the same name again replaces them, so a retried load counts once."""
        changes.write.mode("overwrite").parquet(f"{self.path}/applied={name}")

    def apply_loads(self, changes: DataFrame, name: str) -> None:
        """Adds the deltas of many loads, each as an application of its own (``name``-load), in one pass over the base table."""
        named = changes.withColumn("applied", F.concat(F.lit(f"{name}-"), "load_id"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("applied").parquet(self.path)

    def withdraw(self, name: str, load_id: int) -> None:
        """Takes all counts of application ``name`` back, as the deltas of load ``load_id``: what it brought is gone from then on."""
        was = self.spark.read.schema(T._parse_datatype_string(DELTAS)).parquet(f"{self.path}/applied={name}")
        self.apply(was.withColumns({"n": -F.col("n"), "load_id": F.lit(load_id)}), f"{name}-withdrawn")

    def compact(self, name: str = "base") -> None:
        """Sums all deltas up, drops values whose count is zero and leaves one application in the same place."""
        from priorview.operators.merge import put_in_place

        sums = self.read().groupBy("table_name", "column_name", "load_id", "value", "is_null").agg(F.sum("n").alias("n")).filter("n <> 0")
        sums.write.mode("overwrite").parquet(f"{self.path}.staging/applied={name}")
        put_in_place(self.spark, self.path)

    def read(self) -> DataFrame:
        """All deltas; of a store into which nothing was put yet none."""
        return self.spark.read.schema(T._parse_datatype_string(DELTAS)).parquet(f"{self.path}/applied=*")


def _forms(forms: dict[tuple[str, str], Form], default: Column | None = None) -> Column:
    """Whether a value has its column's good form; null where the column has no rule."""
    out = F.lit(None).cast("boolean")
    for (t, c), f in forms.items():
        out = F.when((F.col("table_name") == t) & (F.col("column_name") == c), f.good(F.col("value"))).otherwise(out)
    return out


def _is(forms: dict[tuple[str, str], Form], drift: str) -> Column:
    own = [(F.col("table_name") == t) & (F.col("column_name") == c) for (t, c), f in forms.items() if f.drift == drift]
    return reduce(lambda a, b: a | b, own, F.lit(False))


def load_metrics(counts: DataFrame, forms: dict[tuple[str, str], Form]) -> DataFrame:
    """One row for each table, column and load, over the rows of that load.

    rows_n, nulls_n, null_share, distinct_n, entropy (bits, of the non-null values), bad_n and
    bad_share (of the non-null), mean (numeric drift columns, good form), tv (half the sum of
    absolute differences of shares against the load before, good form), and the differences to the
    load before, null for the first. A load without rows of a column has no row here.
    """
    keys = ["table_name", "column_name", "load_id"]
    good = F.coalesce(F.col("good"), F.lit(True)) & ~F.col("is_null")
    c = counts.groupBy(*keys, "value", "is_null").agg(F.sum("n").alias("n")).filter("n > 0").withColumn("good", _forms(forms))
    num = F.when(_is(forms, "mean") & good, F.expr("try_cast(value as double)"))
    base = c.groupBy(*keys).agg(
        F.sum("n").alias("rows_n"),
        F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(0)).alias("nulls_n"),
        F.sum(F.when(F.col("is_null"), 0).otherwise(1)).alias("distinct_n"),
        F.sum(F.when(~F.col("is_null"), F.col("n") * F.log2("n"))).alias("_nlogn"),
        F.sum(F.when(~F.col("is_null") & ~F.col("good"), F.col("n")).otherwise(0)).alias("bad_n"),
        F.sum(F.when(good, F.col("n")).otherwise(0)).alias("good_n"),
        F.sum(num * F.col("n")).alias("_sum"),
        F.sum(F.when(num.isNotNull(), F.col("n"))).alias("_sum_n"),
    )
    by_load = Window.partitionBy("table_name", "column_name").orderBy("load_id")
    values = F.col("rows_n") - F.col("nulls_n")
    base = (
        base.withColumn("null_share", F.col("nulls_n") / F.col("rows_n"))
        .withColumn("bad_share", F.try_divide(F.col("bad_n").cast("double"), values.cast("double")))
        .withColumn("entropy", F.when(values > 0, F.log2(values) - F.col("_nlogn") / values))
        .withColumn("mean", F.try_divide("_sum", "_sum_n"))
        .withColumn("seq", F.row_number().over(by_load))
        .withColumn("good_before", F.lag("good_n").over(by_load))
        .withColumn("null_change", F.abs(F.col("null_share") - F.lag("null_share").over(by_load)))
        .withColumn("mean_change", F.abs(F.col("mean") - F.lag("mean").over(by_load)))
    )
    # Shares of one load and of the load before meet on the value; a value absent in one has share 0 there.
    shares = c.filter(_is(forms, "share") & good).join(base.select(*keys, "seq", "good_n"), keys).select("table_name", "column_name", "seq", "value", (F.col("n") / F.col("good_n")).alias("p"))
    both = shares.select("table_name", "column_name", "seq", "value", "p").unionByName(shares.select("table_name", "column_name", (F.col("seq") + 1).alias("seq"), "value", (-F.col("p")).alias("p")))
    moved = both.groupBy("table_name", "column_name", "seq", "value").agg(F.sum("p").alias("d")).groupBy("table_name", "column_name", "seq").agg((F.sum(F.abs("d")) / 2).alias("tv"))
    tv = F.when((F.col("seq") > 1) & (F.col("good_n") > 0) & (F.col("good_before") > 0), F.col("tv"))
    return base.join(moved, ["table_name", "column_name", "seq"], "left").withColumn("tv", tv).select(*keys, "rows_n", "nulls_n", "null_share", "distinct_n", "entropy", "bad_n", "bad_share", "mean", "null_change", "mean_change", "tv")


def maintained_profile(counts: DataFrame, numeric: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """The state of each column after each load: counts of all loads up to it, exact under inserts and withdrawals.

    (table_name, column_name, load_id, rows_n, nulls_n, distinct_n, entropy, min_value, max_value).
    A value's running count changes only in loads that touch it, and so do its share of the distinct
    count and of sum(n log n): per load these differences are summed, then summed up over loads.
    Ranges come from the loads in which each value is present. Values compare as numbers in columns
    of ``numeric`` (with their type), as strings elsewhere.
    """
    col = ["table_name", "column_name"]
    each = counts.groupBy(*col, "load_id", "value", "is_null").agg(F.sum("n").alias("n"))
    over = Window.partitionBy(*col, "value", "is_null").orderBy("load_id")
    new = F.sum("n").over(over)
    run = each.withColumn("new", new).withColumn("old", F.col("new") - F.col("n")).withColumn("until", F.lead("load_id").over(over))
    h = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(c)).otherwise(0.0)
    there = ~F.col("is_null")
    change = run.groupBy(*col, "load_id").agg(
        F.sum("n").alias("dn"),
        F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(0)).alias("dnull"),
        F.sum(F.when(there, (F.col("new") > 0).cast("int") - (F.col("old") > 0).cast("int")).otherwise(0)).alias("ddistinct"),
        F.sum(F.when(there, h("new") - h("old")).otherwise(0.0)).alias("dh"),
    )
    upto = Window.partitionBy(*col).orderBy("load_id").rowsBetween(Window.unboundedPreceding, 0)
    state = change.select(*col, "load_id", *[F.sum(a).over(upto).alias(b) for a, b in (("dn", "rows_n"), ("dnull", "nulls_n"), ("ddistinct", "distinct_n"), ("dh", "_h"))], F.collect_list("load_id").over(Window.partitionBy(*col)).alias("_loads"))
    number = F.lit(False)
    for (t, c) in numeric or {}:
        number = number | ((F.col("table_name") == t) & (F.col("column_name") == c))
    as_number = F.when(number, F.expr("try_cast(value as decimal(38,9))"))
    order = F.struct(as_number.alias("number"), F.col("value").alias("value"))
    loads = state.select(*col, "_loads").distinct()
    alive = run.filter(there & (F.col("new") > 0)).select(*col, "load_id", "until", order.alias("o"))
    # A value that stays alive counts in each load until it is touched again. Values alive over the same loads are combined
    # first, before the shuffle, so that at most loads^2 rows a column, not its values, are laid out over the loads.
    spans = alive.groupBy(*col, "load_id", "until").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))
    spread = spans.join(loads, col).select(*col, "lo", "hi", F.explode(F.filter("_loads", lambda x: (x >= F.col("load_id")) & (F.col("until").isNull() | (x < F.col("until"))))).alias("load_id"))
    ranges = spread.groupBy(*col, "load_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    values = F.col("rows_n") - F.col("nulls_n")
    return state.join(ranges, [*col, "load_id"], "left").select(*col, "load_id", "rows_n", "nulls_n", "distinct_n", F.when(values > 0, F.log2(values) - F.col("_h") / values).alias("entropy"), F.col("lo.value").alias("min_value"), F.col("hi.value").alias("max_value"))


def breaches(metrics: DataFrame, forms: dict[tuple[str, str], Form], null_change: float, bad_share: float, share_drift: float, mean_drift: float) -> DataFrame:
    """(table_name, column_name, load_id, check_name) for each metric beyond its limit."""
    checks = F.array(
        F.when(F.col("null_change") > null_change, F.lit("null_share")),
        F.when(F.col("bad_share") > bad_share, F.lit("form")),
        F.when(F.coalesce(F.when(_is(forms, "share"), F.col("tv") > share_drift), F.when(_is(forms, "mean"), F.col("mean_change") > mean_drift), F.lit(False)), F.lit("drift")),
    )
    return metrics.select("table_name", "column_name", "load_id", F.explode(checks).alias("check_name")).filter("check_name is not null")
