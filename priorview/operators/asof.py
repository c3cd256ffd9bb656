"""Attributes as they were known at an event's time.

A version of an entity holds from ``valid_from`` and is usable from the day after it became known,
so it can be seen from ``visible_from = max(valid_from, known day + 1)`` on. Seen versions are
ranked by (valid_from, known_at, tiebreak). Per attribute a *change history* is kept: the steps at
which the best seen version's value changes; versions that bring nothing new to an attribute leave no step. An
event takes the last step at or before its day, one attribute at a time, and the attributes are pivoted
back to one row an event.

Everything is by day, so an entity that holds a large share of all rows needs no task of its own: its versions
and its events are first combined to days (before the shuffle), the days are matched, and the events take
their day's row by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priorview.functions.keys import hot_keys, utc_day
from priorview.session import shuffle_width


def _is_hot(hot: list[str]) -> Column:
    return F.col("entity").isin(list(hot)) if hot else F.lit(False)


def change_histories(
    versions: DataFrame,
    entity: str,
    valid_from: str,
    known_at: str,
    tiebreak: str,
    attributes: list[str],
    nulls: str = "keep",
    hot: list[str] = (),
) -> DataFrame:
    """(entity, attribute, visible_from, value): one row for each change of one attribute.

    ``nulls='skip'`` takes a null as "not updated"; ``'keep'`` takes it as the value it then had.
    Versions without entity, valid_from or known_at can't be placed in time and are left out.
    Versions that a better one precedes never hold and are left out as well, and so are those with the value that
    held before. Values are held as strings, so that one table serves attributes of every type.
    """
    rank = F.struct(F.col(valid_from).alias("valid_from"), F.col(known_at).alias("known_at"), F.col(tiebreak).cast("bigint").alias("tiebreak"))
    values = F.struct(*[F.col(a).cast("string").alias(f"a{i}") for i, a in enumerate(attributes)])
    rows = versions.filter(F.col(entity).isNotNull() & F.col(valid_from).isNotNull() & F.col(known_at).isNotNull())
    rows = rows.select(F.col(entity).alias("entity"), F.greatest(F.col(valid_from), F.date_add(utc_day(known_at), 1)).alias("visible_from"), rank.alias("r"), values.alias("v"))
    each = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"v.a{i}").alias("value")) for i, a in enumerate(attributes)])

    def steps(part: DataFrame) -> DataFrame:
        long = part.select("entity", "visible_from", "r", F.inline(each))
        if nulls == "skip":
            long = long.filter(F.col("value").isNotNull())
        daily = long.groupBy("entity", "attribute", "visible_from").agg(F.max(F.struct("r", "value")).alias("s"))
        upto = Window.partitionBy("entity", "attribute").orderBy("visible_from")
        held = daily.withColumn("_best", F.max("s").over(upto.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_best") == F.col("s"))
        new = held.withColumn("_before", F.lag(F.struct(F.col("s.value").alias("value"))).over(upto))
        return new.filter(F.col("_before").isNull() | ~F.col("s.value").eqNullSafe(F.col("_before.value"))).select("entity", "attribute", "visible_from", F.col("s.value").alias("value"))

    # One exchange, of whole versions, on the entity: what follows on finer keys needs no other.
    usual = steps(rows.filter(~_is_hot(hot)).repartition("entity"))
    return usual.unionByName(steps(rows.filter(_is_hot(hot)))) if hot else usual


def attributes_as_known(
    events: DataFrame,
    histories: DataFrame,
    event_key: list[str],
    entity: str,
    event_day: str,
    attributes: dict[str, T.DataType | str],
    hot: list[str] = (),
) -> DataFrame:
    """One row an event: ``event_key``, ``entity``, ``event_day`` and the attributes known then, null where none was.

    Events without entity or day are left out (nothing can be known of them); repeated events come out once.
    """
    keys = [f"_e{i}" for i in range(len(event_key))]
    probes = events.select(*[F.col(c).alias(k) for k, c in zip(keys, event_key)], F.col(entity).alias("entity"), F.col(event_day).alias("_day")).filter("entity is not null and _day is not null")
    steps = histories.filter(F.col("attribute").isin(list(attributes))).select("entity", "attribute", F.col("visible_from").alias("_day"), F.lit(0).alias("_probe"), F.struct("visible_from", "value").alias("_state"))

    def matched(steps: DataFrame, probes: DataFrame, ids: list[str], on_entity: bool) -> DataFrame:
        """(ids, attributes): a last-known match for each attribute, then the pivot."""
        rows = steps.unionByName(probes.withColumn("_probe", F.lit(1)), allowMissingColumns=True)
        if on_entity:
            rows = rows.repartition("entity")
        asked = F.when(F.col("attribute").isNull(), F.array(*map(F.lit, attributes))).otherwise(F.array("attribute"))
        rows = rows.withColumn("_attribute", F.explode(asked))
        upto = Window.partitionBy("entity", "_attribute").orderBy("_day", "_probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        known = rows.withColumn("_known", F.max("_state").over(upto)).filter("_probe = 1")
        return known.groupBy(*ids).agg(*[F.max(F.when(F.col("_attribute") == a, F.col("_known.value"))).cast(k).alias(f"_a{i}") for i, (a, k) in enumerate(attributes.items())])

    wide = matched(steps.filter(~_is_hot(hot)), probes.filter(~_is_hot(hot)), [*keys, "entity", "_day"], True)
    if hot:
        busy = probes.filter(_is_hot(hot)).distinct()
        days = matched(steps.filter(_is_hot(hot)), busy.select("entity", "_day").distinct(), ["entity", "_day"], False)
        wide = wide.unionByName(busy.join(days, ["entity", "_day"]))
    return wide.select(*[F.col(k).alias(c) for k, c in zip(keys, event_key)], F.col("entity").alias(entity), F.col("_day").alias(event_day), *[F.col(f"_a{i}").alias(a) for i, a in enumerate(attributes)])


def find_hot(parts: list[DataFrame]) -> list[str]:
    """Entities that alone hold over a quarter of the rows that a task holds on average; at most four a task."""
    return hot_keys(parts, 1.0 / (4 * max(4, shuffle_width(parts[0].sparkSession))))
