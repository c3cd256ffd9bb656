"""Sequential ratings: each bout changes the ratings that later bouts start from.

The recurrence runs across entities, so the bouts of one pool are folded in their order, in one task. It
streams: a task holds the ratings of the pool's entities, never its bouts, and only five narrow columns
reach it. Pools that share no entity (leagues, divisions) are folded at the same time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sequential_ratings(bouts: DataFrame, k: float = 32.0, initial: float = 1500.0, pool: str | None = None) -> DataFrame:
    """(fight_id, fighter_id, pre_elo) of both sides of each bout: the rating before it.

    bouts: fight_id, day, fighter_1_id, fighter_2_id, winner_fighter_id, result_type. Order is by day, then
    fight_id, so bouts of one day do change one another's start. A draw counts half to each side; a no contest
    and a win of neither side change nothing.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ratings = None, {}
        for b in batches:
            fights, own = [], ([], [])
            columns = [b.column(i).to_pylist() for i in range(5)]
            for p, fight, (one, two), score in zip(columns[0], columns[1], zip(columns[2], columns[3]), columns[4]):
                if p != now:
                    now, ratings = p, {}
                a, c = ratings.get(one, initial), ratings.get(two, initial)
                fights.append(fight)
                own[0].append(a)
                own[1].append(c)
                if score is not None:
                    gain = k * (score - 1.0 / (1.0 + 10.0 ** ((c - a) / 400.0)))
                    ratings[one], ratings[two] = a + gain, c - gain
            yield pa.RecordBatch.from_arrays([pa.array(fights * 2), pa.array(columns[2] + columns[3]), pa.array(own[0] + own[1])], ["fight_id", "fighter_id", "pre_elo"])

    w = F.col("winner_fighter_id")
    score = F.when(F.col("result_type") == "nc", None).when(F.col("result_type") == "draw", 0.5).when(w == F.col("fighter_1_id"), 1.0).when(w == F.col("fighter_2_id"), 0.0)
    part = F.col(pool).cast("string") if pool else F.lit("all")
    rows = bouts.select(part.alias("pool"), "fight_id", "fighter_1_id", "fighter_2_id", score.cast("double").alias("score"), "day")
    laid = (rows.repartition("pool") if pool else rows.repartition(1)).sortWithinPartitions("pool", "day", "fight_id")
    return laid.select("pool", "fight_id", "fighter_1_id", "fighter_2_id", "score").mapInArrow(fold, "fight_id string, fighter_id string, pre_elo double")
