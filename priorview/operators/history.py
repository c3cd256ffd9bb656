"""Participants of bouts and what was known of each before its day.

"Before" is strict: bouts of the same day don't count, however many. Prior sums are taken per entity and
day: the bouts of a day are added up first (combined before the shuffle), then summed up over days, so the
window of an entity that takes part in a large share of all bouts has one row a day, not one a bout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows, norm_id
from priorview.functions.scalars import fight_seconds

#: Counters of a stats row that features use, by their short names.
METRICS = {"sig_l": "sig_strikes_landed", "sig_a": "sig_strikes_attempted", "td_l": "takedowns_landed", "td_a": "takedowns_attempted", "sub": "submissions_attempted", "kd": "knockdowns", "ctrl": "control_time_seconds"}

BOUT = ["result_type", "winner_fighter_id", "weight_class", "is_title_fight", "scheduled_rounds", "finish_method", "finish_round", "finish_time_seconds"]


def bouts(fights: DataFrame, cards: DataFrame) -> DataFrame:
    """Current bouts with the day of their card; those without a known day, or without two different sides, are left out."""
    rows = current_rows(fights, "fight_id", ["fight_id", "event_id", "fighter_1_id", "fighter_2_id", *BOUT])
    days = current_rows(cards, "event_id", ["event_id", "event_date"]).filter("event_date is not null")
    sides = rows.select("fight_id", *[norm_id(c).alias(c) for c in ("event_id", "fighter_1_id", "fighter_2_id", "winner_fighter_id")], *[c for c in BOUT if c != "winner_fighter_id"])
    return sides.filter("fighter_1_id <> fighter_2_id").join(days, "event_id").withColumn("day", F.unix_date("event_date"))


def side_stats(stats: DataFrame) -> DataFrame:
    """One stats row a bout and side: the newest, null counters as 0."""
    keys = {"fight_id": norm_id("fight_id"), "fighter_id": norm_id("fighter_id")}
    rows = stats.select(*[e.alias(k) for k, e in keys.items()], F.struct("scraped_at", "fight_stat_id", *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(k) for k, c in METRICS.items()]).alias("r"))
    best = rows.filter("fight_id is not null and fighter_id is not null").groupBy("fight_id", "fighter_id").agg(F.max("r").alias("r"))
    return best.select("fight_id", "fighter_id", *[F.col(f"r.{k}").alias(k) for k in METRICS])


def participants(fights: DataFrame, cards: DataFrame, stats: DataFrame) -> DataFrame:
    """Two rows a bout, one from each side, with the own and the other side's counters (null where a side has no stats row)."""
    b = bouts(fights, cards).withColumn("dur", fight_seconds("finish_method", "finish_round", "finish_time_seconds", "scheduled_rounds"))
    view = lambda me, other, side: F.struct(F.col(me).alias("fighter_id"), F.col(other).alias("opponent_id"), F.lit(side).alias("side"))
    long = b.select("fight_id", "event_id", "event_date", "day", "dur", *BOUT, F.inline(F.array(view("fighter_1_id", "fighter_2_id", 1), view("fighter_2_id", "fighter_1_id", 2))))
    long = long.withColumn("won", F.coalesce(F.col("winner_fighter_id") == F.col("fighter_id"), F.lit(False))).withColumn("is_title_fight", F.coalesce("is_title_fight", F.lit(False)))
    s = side_stats(stats)
    # One join brings each side's counters; the other side's follow within the bout (two rows), not by a second join.
    mine = long.join(s.select("fight_id", "fighter_id", F.struct(*METRICS).alias("my")), ["fight_id", "fighter_id"], "left")
    both = Window.partitionBy("fight_id")
    other = F.when(F.col("side") == 1, F.max(F.when(F.col("side") == 2, F.col("my"))).over(both)).otherwise(F.max(F.when(F.col("side") == 1, F.col("my"))).over(both))
    return mine.withColumn("opp", other)


def prior_sums(rows: DataFrame, entity: str, day: str, sums: dict[str, Column]) -> DataFrame:
    """(entity, day, *sums): for each day of an entity the sums over its earlier days; null where nothing was added."""
    daily = rows.groupBy(entity, day).agg(*[F.sum(e).alias(k) for k, e in sums.items()])
    before = Window.partitionBy(entity).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(entity, day, *[F.sum(k).over(before).alias(k) for k in sums])


def prior_streaks(rows: DataFrame, entity: str, day: str, order: str, holds: dict[str, Column]) -> DataFrame:
    """(entity, day, *holds): how many of the last bouts before the day, in a row, each condition held for."""
    return prior_state(rows, entity, day, order, {}, holds, {}, 0).select(entity, day, *holds)


def prior_last(rows: DataFrame, entity: str, day: str, order: str, payload: dict[str, Column], n: int, out: str) -> DataFrame:
    """(entity, day, out): the last ``n`` bouts before each day as an array, oldest first, of structs of ``order`` and ``payload``."""
    return prior_state(rows, entity, day, order, {}, {}, payload, n, out).select(entity, day, out)


def prior_state(rows: DataFrame, entity: str, day: str, order: str, sums: dict[str, Column], holds: dict[str, Column], payload: dict[str, Column], n: int, out: str = "last") -> DataFrame:
    """(entity, day, first_day, last_day, *sums, *holds, out): all that is known of an entity before a day, in one pass.

    Sums as in ``prior_sums``, runs as in ``prior_streaks``, the last ``n`` bouts as in ``prior_last``, and the first and the
    last earlier day. Bouts are combined to one row an entity and day, those to their prior state by one exchange on the
    entity, whatever the number of families.
    """
    of_day = Window.partitionBy(entity, day)
    bout = [F.struct(F.col(order), *[e.alias(k) for k, e in payload.items()]).alias("_b")] if n else []
    flat = rows.select(entity, day, order, *[e.alias(f"_v{k}") for k, e in sums.items()], *[F.coalesce(e, F.lit(False)).alias(f"_h{k}") for k, e in holds.items()], *bout)
    if holds or n:
        flat = flat.withColumn("_at", F.row_number().over(of_day.orderBy(order))).withColumn("_of", F.count(F.lit(1)).over(of_day))
    parts = [F.sum(f"_v{k}").alias(f"_v{k}") for k in sums] + [F.max(F.when(~F.col(f"_h{k}"), F.col("_at"))).alias(f"_h{k}") for k in holds]
    if n:
        parts.append(F.sort_array(F.collect_list(F.when(F.col("_at") > F.col("_of") - n, F.col("_b")))).alias("_b"))
    daily = flat.groupBy(entity, day).agg(F.count(F.lit(1)).alias("_n"), *parts)
    in_order = Window.partitionBy(entity).orderBy(day)
    before, upto = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, 0)
    made = {f"_s{k}": F.sum(f"_v{k}").over(before) for k in sums} | {"first_day": F.min(day).over(before), "last_day": F.max(day).over(before)}
    for k in holds:  # a day that breaks the run starts a new one with what follows the break
        made |= {f"_i{k}": F.count(f"_h{k}").over(upto), f"_t{k}": F.col("_n") - F.coalesce(f"_h{k}", F.lit(0))}
    if n:
        made["_l"] = F.flatten(F.collect_list("_b").over(in_order.rowsBetween(-n, -1)))
    state = daily.withColumns(made)
    for k in holds:
        state = state.withColumn(f"_r{k}", F.sum(f"_t{k}").over(Window.partitionBy(entity, f"_i{k}").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)))
    runs = [F.coalesce(F.lag(f"_r{k}").over(in_order), F.lit(0)).alias(k) for k in holds]
    last = [F.when(F.size("_l") <= n, F.col("_l")).otherwise(F.slice("_l", -n, n)).alias(out)] if n else []
    return state.select(entity, day, "first_day", "last_day", *[F.col(f"_s{k}").alias(k) for k in sums], *runs, *last)
