"""Raw rows, all texts as pages and exports have them, to rows of the warehouse tables.

``strict`` decides what becomes of a text that is no number or date where one has to be: it raises (True) or is
null (False; counters are 0). Empty and blank texts are missing values either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.functions import scalars as S
from priorview.functions.keys import norm_id
from priorview.operators.merge import replace_table

#: Columns of the raw exports, by file.
RAW = {
    "events": ["scraped_at", "event_id", "url", "name", "date", "date_formatted", "city", "state", "country", "fights", "fight_urls", "event_status"],
    "fights": ["scraped_at", "fight_id", "event_id", "url", "fighter_1_id", "fighter_2_id", "fighter_1_outcome", "fighter_2_outcome", "bout_type", "weight_class", "num_rounds", "finish_method", "primary_finish_method", "secondary_finish_method", "finish_round", "finish_time_minute", "finish_time_second", "referee", "judge_1", "judge_2", "judge_3"],
    "fighters": ["scraped_at", "fighter_id", "url", "full_name", "first_name", "last_names", "nickname", "height_cm", "weight_lbs", "reach_cm", "stance", "dob_formatted"],
}
#: Counters of a stats row in the tables' order, with the raw column each comes from.
COUNTERS = {"knockdowns": "knockdowns", "total_strikes_landed": "total_strikes_landed", "total_strikes_attempted": "total_strikes_attempted", "sig_strikes_landed": "significant_strikes_landed", "sig_strikes_attempted": "significant_strikes_attempted"}
COUNTERS |= {f"sig_strikes_{t}_{k}": f"significant_strikes_{k}_{t}" for t in ("head", "body", "leg", "distance", "clinch", "ground") for k in ("landed", "attempted")}
COUNTERS |= {"takedowns_landed": "takedowns_landed", "takedowns_attempted": "takedowns_attempted", "control_time_seconds": "control_time_seconds", "submissions_attempted": "submissions_attempted", "reversals": "reversals"}
RAW["fight_stats"] = ["scraped_at", "fight_stat_id", "fight_id", "fighter_id", "url", "control_time_minutes", *COUNTERS.values()]
RAW["fight_stats_by_round"] = ["scraped_at", "fight_stat_by_round_id", "fight_id", "fighter_id", "url", "round", "control_time_minutes", *COUNTERS.values()]
#: Keys of the loaded tables, and what their rows have to refer to: column, table, its key.
KEYS = {"events": "event_id", "fighters": "fighter_id", "fights": "fight_id", "fight_stats": "fight_stat_id", "fight_stats_by_round": "fight_stat_by_round_id"}
PARENT = {"fights": ("event_id", "events", "event_id"), "fight_stats": ("fight_id", "fights", "fight_id"), "fight_stats_by_round": ("fight_id", "fights", "fight_id")}


def _number(c: str, kind: str, strict: bool, default: int | None = None) -> Column:
    v = S.text(c).cast(kind) if strict else S.text(c).try_cast(kind)
    return v if default is None else F.coalesce(v, F.lit(default).cast(kind))


def _date(c: str, strict: bool) -> Column:
    return S.iso_date(c) if strict else F.try_to_date(F.when(S.text(c).rlike(r"\A\d{4}-\d\d-\d\d\z"), S.text(c)), "yyyy-MM-dd")


def event_rows(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Nine columns of a card; one without a status is completed."""
    places = [S.text(c).alias(c) for c in ("city", "state", "country")]
    return raw.select(norm_id("event_id").alias("event_id"), S.text("name").alias("event_name"), _date("date_formatted", strict).alias("event_date"), *places, F.coalesce(S.text("event_status"), F.lit("completed")).alias("event_status"), F.col("url").alias("source_url"), S.utc_timestamp("scraped_at").alias("scraped_at"))


def fight_rows(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Seventeen columns of a bout: result and winner by the outcome letters, class and titles by the bout's type."""
    ids = {c: norm_id(c) for c in ("fight_id", "event_id", "fighter_1_id", "fighter_2_id")}
    result, winner = S.outcome("fighter_1_outcome", "fighter_2_outcome", ids["fighter_1_id"], ids["fighter_2_id"])
    title, interim = S.title_flags("bout_type")
    seconds = _number("finish_time_minute", "int", strict, 0) * 60 + _number("finish_time_second", "int", strict, 0)
    small = lambda e: e.cast("smallint") if strict else e.try_cast("smallint")
    return raw.select(
        *[e.alias(c) for c, e in ids.items()], winner.alias("winner_fighter_id"), result.alias("result_type"), S.weight_class("bout_type").alias("weight_class"), title.alias("is_title_fight"), interim.alias("is_interim_title"),
        _number("num_rounds", "smallint", strict).alias("scheduled_rounds"), S.finish("primary_finish_method").alias("finish_method"), S.text("secondary_finish_method").alias("finish_detail"), _number("finish_round", "smallint", strict).alias("finish_round"),
        small(F.nullif(seconds, F.lit(0))).alias("finish_time_seconds"), S.text("referee").alias("referee"), F.col("url").alias("source_url"), S.utc_timestamp("scraped_at").alias("scraped_at"),
    )


def fighter_rows(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Twelve columns of a profile; measures rounded to the table's decimals."""
    texts = {"full_name": "full_name", "first_name": "first_name", "last_name": "last_names", "nickname": "nickname"}
    measures = {"height_cm": "decimal(5,2)", "weight_lbs": "decimal(5,1)", "reach_cm": "decimal(5,2)"}
    return raw.select(norm_id("fighter_id").alias("fighter_id"), *[S.text(r).alias(c) for c, r in texts.items()], *[_number(c, k, strict).alias(c) for c, k in measures.items()], S.text("stance").alias("stance"), _date("dob_formatted", strict).alias("dob"), F.col("url").alias("source_url"), S.utc_timestamp("scraped_at").alias("scraped_at"))


def stat_rows(raw: DataFrame, by_round: bool = False, strict: bool = True) -> DataFrame:
    """The key, two references and 22 counters of a side's stats, of the bout or of one of its rounds; missing counts are 0."""
    key = ["fight_stat_by_round_id"] if by_round else ["fight_stat_id"]
    counts = {c: _number(r, "smallint", strict, 0) for c, r in COUNTERS.items()}
    time = _number("control_time_minutes", "int", strict, 0) * 60 + _number("control_time_seconds", "int", strict, 0)
    counts["control_time_seconds"] = time.cast("smallint") if strict else F.coalesce(time.try_cast("smallint"), F.lit(0).cast("smallint"))
    number = [_number("round", "smallint", strict, 0).alias("round")] if by_round else []
    return raw.select(*[norm_id(c).alias(c) for c in (*key, "fight_id", "fighter_id")], *number, *[e.alias(c) for c, e in counts.items()], F.col("url").alias("source_url"), S.utc_timestamp("scraped_at").alias("scraped_at"))


ROWS = {"events": event_rows, "fights": fight_rows, "fighters": fighter_rows, "fight_stats": stat_rows, "fight_stats_by_round": lambda raw, strict=True: stat_rows(raw, True, strict)}


def known_only(rows: DataFrame, column: str, parents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``column`` is a ``key`` of ``parents``, the others). Null references are among the others."""
    known = parents.select(norm_id(key).alias("_known")).filter("_known is not null").distinct()
    match = norm_id(column) == F.col("_known")
    return rows.join(known, match, "left_semi"), rows.join(known, match, "left_anti")


def from_pages(read: DataFrame, kind: str) -> DataFrame:
    """Raw rows of pages that could be read (``read_pages_as``); fields that a page lacks are null, its time of fetch too."""
    return read.filter("error is null").select(*[F.col("fields")[c].alias(c) for c in RAW[kind]])


def migrate(spark: SparkSession, folder: str, steps: dict[str, dict[str, str]]) -> list[str]:
    """Brings the parquet tables of ``folder`` to the wanted columns, by steps in order of their names; returns those applied now.

    A step names tables with the columns (DDL) they have to have: an absent table is made empty, missing columns are added
    as nulls, others are cast. What was applied is noted in the folder, so a step runs once; one that failed runs again.
    """
    from priorview.sources.tables import exists

    log, done = f"{folder}/_migrations", []
    applied = {r.name for r in spark.read.parquet(log).collect()} if exists(spark, log) else set()
    for name in sorted(set(steps) - applied):
        for table, ddl in steps[name].items():
            path, wanted = f"{folder}/{table}", spark.createDataFrame([], ddl)
            if exists(spark, path):
                held = spark.read.parquet(path)
                new = [F.col(f.name).cast(f.dataType) if f.name in held.columns else F.lit(None).cast(f.dataType) for f in wanted.schema]
                kept = [c for c in held.columns if c not in wanted.columns]
                wanted = held.select(*[e.alias(f.name) for e, f in zip(new, wanted.schema)], *kept)
            replace_table(spark, wanted, path)
        spark.createDataFrame([(name,)], "name string").write.mode("append").parquet(log)
        done.append(name)
    return done
