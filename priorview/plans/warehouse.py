"""Queries of normalisation, merges, quality checks and reports over the warehouse tables, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.functions import scalars as S
from priorview.functions.keys import current_rows, norm_id
from priorview.operators import merge as M
from priorview.operators import quality as Q
from priorview.plans.features import _BASE, _ELO, _bout_sql, _sides, _snapshots
from priorview.plans.general import FINISH_METHODS, _current, _id
from priorview.operators import features as X
from priorview.session import scratch_path, table
from priorview.sources.tables import numeric_columns, read_csv, with_status, write_report

#: The numeric columns of the two feature tables, all of them (``numeric_columns``); the SQL names them.
SNAPSHOT_NUMBERS = ["feature_version", "career_fights", "career_wins", "career_losses", "career_win_rate", "career_minutes", "career_sig_strikes_landed_pm", "career_takedown_accuracy", "age", "height_cm", "reach_cm", "days_since_last_fight", "elo_rating"]
BOUT_NUMBERS = ["scheduled_rounds", "label", "feature_version", "diff_elo", "diff_age", "diff_height_cm", "diff_reach_cm"]
DIFFERENCES = ["diff_elo", "diff_age", "diff_height_cm", "diff_reach_cm"]
#: Differences that a complete row of bout features has.
CORE = ["diff_elo", "diff_career_wins", "diff_career_fights", "diff_career_win_rate", "diff_career_finish_rate", "diff_career_sig_strikes_landed_pm", "diff_career_sig_strike_accuracy", "diff_career_takedown_accuracy", "diff_career_control_rate"]
#: Counters whose rounds have to add up to the bout.
SUMMED = ["knockdowns", "total_strikes_landed", "sig_strikes_landed", "takedowns_landed", "submissions_attempted", "control_time_seconds"]
TABLES = ("fight_events", "fighters", "fights", "fight_stats_aggregate", "fighter_snapshots", "bout_features")
RANGES = {"fight_events": (700, 1000), "fighters": (4000, 6000), "fights": (2000, 10000), "fight_stats_aggregate": (4000, 20000), "fighter_snapshots": (4000, 20000), "bout_features": (2000, 10000)}
LINKS = [("fights", "event_id", "fight_events", "event_id"), ("fights", "fighter_1_id", "fighters", "fighter_id"), ("fights", "fighter_2_id", "fighters", "fighter_id"), ("fights", "winner_fighter_id", "fighters", "fighter_id"), ("fight_stats_aggregate", "fight_id", "fights", "fight_id"), ("fight_stats_aggregate", "fighter_id", "fighters", "fighter_id"), ("fighter_snapshots", "fight_id", "fights", "fight_id"), ("bout_features", "fight_id", "fights", "fight_id")]


def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts against the range that a warehouse of some thousand bouts has."""
    return Q.counts_within({t: table(spark, d, t) for t in TABLES}, RANGES)


def q_row_equalities(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots and one row of bout features a bout."""
    return Q.count_equalities({t: table(spark, d, t) for t in ("fights", "fighter_snapshots", "bout_features")}, {"fighter_snapshots": ("fights", 2), "bout_features": ("fights", 1)})


def q_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionAll, [Q.orphan_count(table(spark, d, t), c, table(spark, d, p), k, f"{t}.{c}") for t, c, p, k in LINKS])


def q_bouts_without_stats(spark: SparkSession, d: str) -> DataFrame:
    """Bouts no stats row refers to, and those that some does."""
    stats = table(spark, d, "fight_stats_aggregate").select(norm_id("fight_id").alias("fight_id"), F.lit(True).alias("has")).distinct()
    return table(spark, d, "fights").select(norm_id("fight_id").alias("fight_id")).distinct().join(stats, "fight_id", "left").groupBy(F.coalesce("has", F.lit(False)).alias("has_stats")).agg(F.count(F.lit(1)).alias("bouts"))


def q_result_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fights").groupBy("result_type").agg(F.count(F.lit(1)).alias("bouts")).orderBy(F.desc("bouts"))


def q_consistency(spark: SparkSession, d: str) -> DataFrame:
    w = norm_id("winner_fighter_id")
    return Q.failing(table(spark, d, "fights"), {
        "win_without_winner": (F.col("result_type") == "win") & w.isNull(), "draw_with_winner": (F.col("result_type") == "draw") & w.isNotNull(), "nc_with_winner": (F.col("result_type") == "nc") & w.isNotNull(),
        "finish_after_schedule": F.col("finish_round") > F.col("scheduled_rounds"), "winner_took_no_part": w.isNotNull() & (w != F.coalesce(norm_id("fighter_1_id"), F.lit(""))) & (w != F.coalesce(norm_id("fighter_2_id"), F.lit(""))),
    })


def q_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return Q.unknown_values(table(spark, d, "fights"), "finish_method", list(FINISH_METHODS))


def q_missingness(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fighter_snapshots")
    return Q.missingness(rows, numeric_columns(rows))


def q_bout_missingness(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bout_features")
    return Q.missingness(rows, numeric_columns(rows))


def q_distribution(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fighter_snapshots")
    return Q.distribution(rows, numeric_columns(rows))


def q_bout_distribution(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bout_features")
    return Q.distribution(rows, numeric_columns(rows))


def q_correlations(spark: SparkSession, d: str) -> DataFrame:
    return Q.correlations(table(spark, d, "bout_features"), DIFFERENCES, "label")


def q_completeness(spark: SparkSession, d: str) -> DataFrame:
    return Q.completeness(table(spark, d, "bout_features"), DIFFERENCES, "is_title_fight")


def q_core_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the built bout features that have all core differences: all, and by whether both sides make their debut."""
    return Q.completeness(X.bout_table(_snapshots(spark, d)), CORE, "both_debuting")


def q_parts_differ(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the newest stats row of a side against the sum of its rounds (three, of a third each, cut off)."""
    newest = current_rows(table(spark, d, "fight_stats_aggregate"), "fight_stat_id", ["fight_stat_id", *SUMMED])
    rounds = newest.select("fight_stat_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("round"), *[F.floor(F.col(c) / 3).alias(c) for c in SUMMED])
    return Q.sums_differ(newest, rounds, ["fight_stat_id"], SUMMED)


def q_targets_differ(spark: SparkSession, d: str) -> DataFrame:
    """Significant strikes by target against their total: bouts whose rows have a difference of any size, by its sign."""
    s = F.col("sig_strikes_landed") - F.col("sig_strikes_head_landed") - F.col("sig_strikes_body_landed") - F.col("sig_strikes_leg_landed")
    return table(spark, d, "fight_stats_aggregate").groupBy(F.signum(s).cast("int").alias("sign")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(norm_id("fight_id")).alias("bouts"))


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(table(spark, d, "fighters"), "fighter_id", ["fighter_id", "full_name", "height_cm", "weight_lbs", "reach_cm", "stance", "dob"])


def q_fighter_review(spark: SparkSession, d: str) -> DataFrame:
    return Q.profile_flags(_profiles(spark, d), "fighter_id", "full_name", ["height_cm", "weight_lbs", "reach_cm", "stance", "dob"], "dob")


def q_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.flag_counts(q_fighter_review(spark, d))


def q_stats_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Completed bouts by what is missing of their stats; withdrawn pages count as failed fetches."""
    gone = table(spark, d, "retired_ids").filter("entity_type = 'fight'").select(norm_id("entity_id").alias("fight_id"), F.lit("failed").alias("status"))
    ids = table(spark, d, "fights").select(norm_id("fight_id").alias("fight_id")).distinct()
    fetched = M.by_precedence([gone, table(spark, d, "bout_features").select(norm_id("fight_id").alias("fight_id"), F.lit("fetched").alias("status"))], "fight_id")
    parsed = table(spark, d, "fight_stats_aggregate").select(norm_id("fight_id").alias("fight_id")).filter("fight_id is not null")
    return Q.gaps(ids, fetched, parsed, "fight_id").groupBy("gap_reason").agg(F.count(F.lit(1)).alias("bouts"))


def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The bouts of all loads but the last, with those of the last upserted, as the sink's table then has them."""
    rows = table(spark, d, "fights").select("fight_id", "result_type", "finish_method", "referee", "scraped_at", "load_id")
    last, path = rows.agg(F.max("load_id")).first()[0], scratch_path(spark, "upserted")
    for part in (F.col("load_id") < last, F.col("load_id") == last):
        M.upsert_table(spark, path, current_rows(rows.filter(part), "fight_id", rows.columns), ["fight_id"], "scraped_at")
    return spark.read.parquet(path).withColumn("scraped_at", F.unix_micros("scraped_at"))


def q_bucket_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The stats rows after every load was merged into a table of buckets in its turn."""
    rows, path = table(spark, d, "fight_stats_aggregate").select("fight_stat_id", "fight_id", "knockdowns", "scraped_at", "load_id"), scratch_path(spark, "buckets")
    for load in sorted(r.load_id for r in rows.select("load_id").distinct().collect()):
        M.upsert_buckets(spark, path, current_rows(rows.filter(F.col("load_id") == load), "fight_stat_id", rows.columns), ["fight_stat_id"], "scraped_at", 8)
    return M.read_buckets(spark, path, 8).withColumn("scraped_at", F.unix_micros("scraped_at"))


def q_queue(spark: SparkSession, d: str) -> DataFrame:
    """Fighter pages to fetch, of three sources by precedence: bouts' first sides, second sides, stats."""
    one = lambda t, c: table(spark, d, t).select(norm_id(c).alias("fighter_id"), F.lit(f"{t}.{c}").alias("source"))
    return M.by_precedence([one("fights", "fighter_1_id"), one("fights", "fighter_2_id"), one("fight_stats_aggregate", "fighter_id")], "fighter_id")


def q_bout_queue(spark: SparkSession, d: str) -> DataFrame:
    """Bouts whose stats are to be fetched: from stats rows, then from bouts; those of cards ahead are left out; a queue held
    before (the first two loads' bouts) keeps its dates and states and is carried on."""
    url = F.concat(F.lit("http://www.example.org/fight-details/"), "fight_id")
    fights = table(spark, d, "fights")
    one = lambda df: current_rows(df, "fight_id", ["fight_id", "event_id", "finish_method"]).select("fight_id", norm_id("event_id").alias("event_id"), url.alias("fight_url"), F.coalesce("finish_method", F.lit("")).alias("finish_method"))
    named = table(spark, d, "bout_features").select(norm_id("fight_id").alias("fight_id")).filter("fight_id is not null").distinct().select("fight_id", F.lit(None).cast("string").alias("event_id"), url.alias("fight_url"), F.lit("").alias("finish_method"))
    cards = current_rows(table(spark, d, "fight_events"), "event_id", ["event_id", "event_date", "event_status"])
    ahead = cards.select("event_id", F.when(F.col("event_date") >= "2015-08-01", "upcoming").alias("event_status"))
    old = one(fights.filter("load_id <= 2")).withColumn("stats_status", F.lit("done")).withColumn("queued_at", F.lit("2020-01-01 00:00:00+00:00").cast("timestamp"))
    q = M.bout_queue([one(fights), named], M.status_index(cards.select("event_id", "event_status"), ahead), old, "2026-01-01 00:00:00+00:00")
    return q.withColumn("queued_at", F.unix_micros("queued_at"))


def q_to_fetch(spark: SparkSession, d: str) -> DataFrame:
    """Bout pages an incremental run has to fetch: neither parsed nor captured, failed ones again, and those of cards ahead."""
    ids = lambda t, c="fight_id": table(spark, d, t).select(norm_id(c).alias("fight_id")).filter("fight_id is not null")
    failed = table(spark, d, "retired_ids").filter("entity_type = 'fight'").select(norm_id("entity_id").alias("fight_id"), F.lit("failed").alias("fetch_status"))
    log = failed.unionByName(ids("bout_features").withColumn("fetch_status", F.lit("fetched")))
    cards = current_rows(table(spark, d, "fight_events"), "event_id", ["event_id", "event_date"]).filter("event_date >= '2015-08-01'")
    ahead = current_rows(table(spark, d, "fights"), "fight_id", ["fight_id", "event_id"]).select("fight_id", norm_id("event_id").alias("event_id")).join(cards.select("event_id"), "event_id", "left_semi").select("fight_id")
    return M.to_fetch(ids("fights").distinct(), "fight_id", log, ids("fight_stats_aggregate"), ahead)


def q_unseen(spark: SparkSession, d: str) -> DataFrame:
    """Queued fighters whose profile is neither held nor withdrawn."""
    return M.unseen(q_queue(spark, d), "fighter_id", table(spark, d, "fighters").select(norm_id("fighter_id")), table(spark, d, "retired_ids").filter("entity_type = 'fighter'").select(norm_id("entity_id")))


def q_registry(spark: SparkSession, d: str) -> DataFrame:
    """Cards with when they were first and last seen, kept over loads by merging the last into the ones before."""
    rows = table(spark, d, "fight_events").select(norm_id("event_id").alias("event_id"), "event_name", "scraped_at", "load_id").filter("event_id is not null")
    last = rows.agg(F.max("load_id")).first()[0]
    seen = lambda df: df.groupBy("event_id").agg(F.max_by("event_name", F.struct("scraped_at", "event_name")).alias("event_name"), F.min("scraped_at").alias("discovered_at"), F.max("scraped_at").alias("last_seen_at"))
    return M.merge_queue(seen(rows.filter(F.col("load_id") == last)), seen(rows.filter(F.col("load_id") < last)), "event_id", ["discovered_at"]).withColumns({c: F.unix_micros(c) for c in ("discovered_at", "last_seen_at")})


def q_pages(spark: SparkSession, d: str) -> DataFrame:
    """Texts as pages: the hash of each, against the pages of the same language held before, and its links."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("url"), F.col("text").alias("html"), "lang")
    held = docs.filter("lang = 'en' and html is not null").select("url", F.sha2(F.when(F.length("html") % 2 == 0, F.col("html")).otherwise(F.concat("html", F.lit("."))), 256).alias("content_hash"))
    return M.store_pages(docs, held)


def q_page_store(spark: SparkSession, d: str) -> DataFrame:
    """Texts kept as pages, fetched again with every second one changed: the table then, with the state of the last fetch."""
    docs, path = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("url"), F.col("text").alias("html")), scratch_path(spark, "pages")
    M.keep_pages(spark, path, docs.filter("html is not null and url % 3 <> 0"))
    again = M.keep_pages(spark, path, docs.filter("url % 5 <> 0").withColumn("html", F.when(F.length("html") % 2 == 0, F.concat("html", F.lit("."))).otherwise(F.col("html"))))
    kept = spark.read.parquet(path).select("url", "content_hash", F.length("html").alias("chars"))
    return kept.join(again.select("url", "fetch_status"), "url", "full_outer")


def q_csv(spark: SparkSession, d: str) -> DataFrame:
    """Current cards written as a CSV report and read back as texts, with the status of a manifest that has some of them."""
    cards = current_rows(table(spark, d, "fight_events"), "event_id", ["event_id", "event_name", "city", "event_date"])
    path = scratch_path(spark, "report")
    write_report(cards.select("event_id", "event_name", "city", "event_date"), path, ["event_id"])
    manifest = cards.filter("event_date >= '2015-08-01'").select("event_id", F.lit("upcoming").alias("event_status"))
    none = read_csv(spark, f"{path}-absent", ["event_id"], optional=True)
    return with_status(read_csv(spark, path, ["event_id", "event_name", "city", "event_date"]), manifest).join(none, "event_id", "left_anti")


def q_raw_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Texts of profile pages, made of the profile rows, taken apart."""
    rows = table(spark, d, "fighters")
    whole = F.floor(F.col("height_cm").cast("double") / 2.54 + 0.5).cast("int")
    texts = rows.select(
        "fighter_id", "load_id", "scraped_at", F.concat(F.floor(whole / 12).cast("string"), F.lit("' "), (whole % 12).cast("string"), F.lit('"')).alias("h"), F.concat(F.floor(F.col("reach_cm") / 2).cast("string"), F.lit('"')).alias("r"),
        F.concat(F.month("dob").cast("string"), F.lit("-"), F.dayofmonth("dob").cast("string"), F.lit("-0 (3 NC)")).alias("w"), F.coalesce(F.date_format("dob", "MMM dd, yyyy"), F.lit("--")).alias("b"), F.concat_ws(", ", "last_name", "stance", "first_name").alias("p"), F.concat(F.dayofmonth("dob").cast("string"), F.lit(":"), F.month("dob").cast("string")).alias("c"),
    )
    feet, inches, cm = S.height("h")
    won, lost, drawn, void = S.record("w")
    city, state, country = S.location("p")
    minute, second = S.clock(F.coalesce("c", F.lit("--")))
    return texts.select("fighter_id", "load_id", feet.alias("feet"), inches.alias("inches"), F.round(cm, 6).alias("cm"), S.reach_cm("r").alias("reach"), won.alias("won"), lost.alias("lost"), drawn.alias("drawn"), void.alias("void"), S.short_date("b").alias("born"), city.alias("city"), state.alias("state"), country.alias("country"), minute.alias("minute"), second.alias("second"), S.joined(S.parted("p")).alias("parts"), S.percent(won, lost + drawn).alias("percent"))


def q_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Text functions over names and addresses of all profile rows."""
    rows = table(spark, d, "fighters")
    url = F.concat(F.lit("https://www.example.org/"), F.coalesce("source_url", F.lit("")))
    first, rest = S.split_name("full_name")
    return rows.select("fighter_id", "load_id", S.uuid5(url).alias("page_id"), S.without_www(url).alias("url"), S.entity_of_url(url).alias("entity"), S.clean("full_name").alias("name"), first.alias("first_word"), rest.alias("other_words"), S.text("stance").alias("stance"))


def q_texts(spark: SparkSession, d: str) -> DataFrame:
    """What page readers take from texts: 'landed of attempted', a number, the count of links, the hash, the length once clean."""
    t = F.coalesce("text", F.lit(""))
    landed, attempted = S.landed_attempted(t)
    return table(spark, d, "documents").select("doc_id", landed.alias("landed"), attempted.alias("attempted"), S.first_number(t).alias("number"), F.size(S.hrefs(t)).alias("links"), F.sha2(t, 256).alias("hash"), F.length(S.clean(t)).alias("clean_chars"))


def _class_text():
    from priorview.plans.loading import _class_text

    return _class_text()


def q_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Typed methods and dates of the raw rows, as the warehouse takes them."""
    rows = table(spark, d, "fights")
    title, interim = S.title_flags("finish_detail")
    result, winner = S.outcome(F.when(norm_id("winner_fighter_id") == norm_id("fighter_1_id"), "W").when(norm_id("winner_fighter_id") == norm_id("fighter_2_id"), "L").otherwise("D"), F.when(norm_id("winner_fighter_id") == norm_id("fighter_1_id"), "L").when(norm_id("winner_fighter_id") == norm_id("fighter_2_id"), "W").otherwise("D"), norm_id("fighter_1_id"), norm_id("fighter_2_id"))
    return rows.select("fight_id", "load_id", S.finish("finish_method").alias("finish"), title.alias("title"), interim.alias("interim"), result.alias("result"), winner.alias("winner"), F.nullif(F.col("finish_time_seconds").cast("int"), F.lit(0)).alias("seconds"), S.weight_class(F.concat(_class_text(), F.lit(" Bout"))).alias("class"), S.raw_weight_class(F.concat(_class_text(), F.lit(" Bout"))).alias("page_class"))


def q_event_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fight_events").select("event_id", "load_id", S.long_date("date_formatted").alias("long_date"), F.try_to_date(S.text("date_formatted"), "yyyy-MM-dd").alias("iso_date"))


def q_card_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Cards with the number of bouts and of bouts with stats; cards without bouts are there with 0."""
    cards = current_rows(table(spark, d, "fight_events"), "event_id", ["event_id", "event_status"])
    fights = current_rows(table(spark, d, "fights"), "fight_id", ["fight_id", "event_id"]).select("fight_id", norm_id("event_id").alias("event_id"))
    have = table(spark, d, "fight_stats_aggregate").select(norm_id("fight_id").alias("fight_id"), F.lit(1).alias("s")).distinct()
    n = fights.filter("event_id is not null").join(have, "fight_id", "left").groupBy("event_id").agg(F.count(F.lit(1)).alias("bouts"), F.coalesce(F.sum("s"), F.lit(0)).alias("with_stats"))
    zero = F.lit(0)
    return cards.join(n, "event_id", "left").select("event_id", F.coalesce("event_status", F.lit("completed")).alias("event_status"), F.coalesce("bouts", zero).alias("bouts"), F.coalesce("with_stats", zero).alias("with_stats"))


def q_event_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Cards that bouts name, pages of cards (withdrawn ones failed), and the rows of cards."""
    fights, cards = table(spark, d, "fights"), table(spark, d, "fight_events")
    have = fights.select(norm_id("event_id").alias("event_id")).filter("event_id is not null").distinct()
    log = cards.select(F.lit("event").alias("entity_type"), "source_url", F.lit("fetched").alias("fetch_status")).unionByName(table(spark, d, "retired_ids").select("entity_type", F.col("entity_id").alias("source_url"), F.lit("failed").alias("fetch_status")))
    parsed = cards.select(norm_id("event_id").alias("event_id"), "event_status", "date_formatted").join(have.withColumn("fights", F.col("event_id")), "event_id", "left")
    return Q.event_coverage(have, log, parsed)


def q_stats_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """Bouts without stats, and without any round in which something landed."""
    stats = table(spark, d, "fight_stats_aggregate").select(norm_id("fight_id").alias("fight_id"), "total_strikes_landed")
    return Q.stats_thresholds(table(spark, d, "fights").select(norm_id("fight_id").alias("fight_id")), stats, stats.filter("total_strikes_landed >= 40"), "fight_id", 0.02)


def q_smoke(spark: SparkSession, d: str) -> DataFrame:
    return Q.smoke_check(spark, d, {"fights": ["fight_id", "event_id", "rounds_by_judge"], "fight_events": ["event_id"], "event_listing": []}, ["fighters", "pages"])


def q_stats_info(spark: SparkSession, d: str) -> DataFrame:
    """Bouts, those without stats, stats rows, and rows by round to a row (three, where rounds were fought)."""
    stats = table(spark, d, "fight_stats_aggregate")
    ids, have = table(spark, d, "fights").select(norm_id("fight_id").alias("fight_id")).filter("fight_id is not null").distinct(), stats.select(norm_id("fight_id").alias("fight_id")).filter("fight_id is not null").distinct().withColumn("h", F.lit(1))
    a = ids.join(have, "fight_id", "left").agg(F.count(F.lit(1)).alias("bouts"), F.count_if(F.col("h").isNull()).alias("without"))
    b = stats.agg(F.count(F.lit(1)).alias("stats"), F.sum(F.when(F.col("total_strikes_attempted") > 0, 3).otherwise(0)).alias("rounds"))
    each = [a.select(F.lit("bouts").alias("figure"), F.col("bouts").cast("double").alias("value")), a.select(F.lit("share_without_stats"), F.round(F.col("without") / F.col("bouts"), 6)), b.select(F.lit("stats_rows"), F.col("stats").cast("double")), b.select(F.lit("rounds_per_row"), F.round(F.col("rounds") / F.col("stats"), 6))]
    return reduce(DataFrame.unionAll, each)


def q_sample(spark: SparkSession, d: str) -> DataFrame:
    """Two hundred snapshots drawn with a seed."""
    return Q.seeded_sample(table(spark, d, "fighter_snapshots").select("snapshot_id", "fighter_id").distinct(), ["snapshot_id", "fighter_id"], 200, 7)


def q_leakage(spark: SparkSession, d: str) -> DataFrame:
    """The audits over the features that are built here, where nothing fails."""
    s = _snapshots(spark, d)
    return Q.leakage_audit(s, _sides(spark, d), X.bout_table(s))


def _given_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fighter_snapshots").withColumn("fighter_id", norm_id("fighter_id")).withColumn("fight_id", norm_id("fight_id"))


def q_leakage_given(spark: SparkSession, d: str) -> DataFrame:
    """The audits over the feature tables as given, which have snapshots dated wrongly, built late or again."""
    s = _given_snapshots(spark, d).select("fighter_id", "as_of_date", "is_debut", F.col("career_fights").alias("total_fights"))
    bouts = table(spark, d, "bout_features").select(norm_id("fight_id").alias("fight_id"), "label")
    return Q.leakage_audit(s, _sides(spark, d), bouts)


def q_leakage_elo(spark: SparkSession, d: str) -> DataFrame:
    return Q.elo_audit(_snapshots(spark, d), _sides(spark, d))


def q_leakage_elo_given(spark: SparkSession, d: str) -> DataFrame:
    """Ratings as given, the newest of each side of a bout."""
    s = _given_snapshots(spark, d).filter("fighter_id is not null and fight_id is not null").groupBy("fight_id", "fighter_id").agg(F.max_by("elo_rating", F.struct("computed_at", "snapshot_id", "elo_rating")).cast("double").alias("pre_fight_elo"))
    return Q.elo_audit(s, _sides(spark, d))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_LINK_SQL = " UNION ALL ".join(f"SELECT '{t}.{c}' AS check_name, count(*) AS misses FROM {t} WHERE {_id(c)} IS NOT NULL AND {_id(c)} NOT IN (SELECT {_id(k)} FROM {p} WHERE {_id(k)} IS NOT NULL)" for t, c, p, k in LINKS)
_W, _F1, _F2 = _id("winner_fighter_id"), _id("fighter_1_id"), _id("fighter_2_id")
_REVIEW = f"""WITH c AS {_current('fighters', 'fighter_id')}, t AS (SELECT nullif(trim(full_name), '') AS nm FROM c WHERE nullif(trim(full_name), '') IS NOT NULL GROUP BY 1 HAVING count(DISTINCT k) > 1),
g AS (SELECT k AS fighter_id, nullif(trim(full_name), '') AS full_name, list_filter([CASE WHEN nullif(trim(full_name), '') IS NULL THEN 'missing_name' END, CASE WHEN nullif(trim(full_name), '') IN (SELECT nm FROM t) THEN 'duplicate_name' END, CASE WHEN (height_cm IS NULL)::INT + (weight_lbs IS NULL)::INT + (reach_cm IS NULL)::INT + (nullif(trim(stance), '') IS NULL)::INT + (dob IS NULL)::INT >= 3 THEN 'sparse_bio' WHEN dob IS NULL THEN 'missing_dob' END], lambda x: x IS NOT NULL) AS l FROM c)
SELECT fighter_id, full_name, array_to_string(l, '; ') AS flags, len(l)::INT AS flag_count FROM g WHERE len(l) > 0"""
_QUEUE = f"""SELECT fighter_id, ['fights.fighter_1_id', 'fights.fighter_2_id', 'fight_stats_aggregate.fighter_id'][min(p)] AS source FROM (SELECT {_F1} AS fighter_id, 1 AS p FROM fights UNION ALL SELECT {_F2}, 2 FROM fights UNION ALL SELECT {_id('fighter_id')}, 3 FROM fight_stats_aggregate) WHERE fighter_id IS NOT NULL GROUP BY 1"""

def _missing_sql(t: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS rows, (count(*) - count({c}))::DOUBLE / nullif(count(*), 0) AS share, (count(*) - count({c}))::DOUBLE / nullif(count(*), 0) > 0.5 AS warn FROM {t}" for c in columns)


def _distribution_sql(t: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS sd, round(min({c}::DOUBLE), 4) AS low, round(max({c}::DOUBLE), 4) AS high, round(quantile_cont({c}::DOUBLE, 0.05), 4) AS p5, round(quantile_cont({c}::DOUBLE, 0.95), 4) AS p95, coalesce(stddev_samp({c}::DOUBLE) = 0, false) AS constant FROM {t}" for c in columns)


_ELO_AUDIT = """r AS (SELECT p.me, p.d, p.res, p.won, e.pre_elo, count(*) OVER (PARTITION BY p.me, p.d) AS n, min(p.d) OVER (PARTITION BY p.me) AS first FROM p JOIN elo e ON e.fight_id = p.fight_id AND e.fighter_id = p.me),
x AS (SELECT *, max(n) OVER (PARTITION BY me) AS most, lag(res) OVER w AS res0, lag(won) OVER w AS won0, lag(pre_elo) OVER w AS elo0 FROM r WINDOW w AS (PARTITION BY me ORDER BY d))
SELECT 'debut_elo' AS check_name, count(*) AS rows, count(*) FILTER (WHERE pre_elo IS DISTINCT FROM 1500) AS failures FROM r WHERE d = first AND n = 1
UNION ALL SELECT 'elo_direction', count(*), count(*) FILTER (WHERE coalesce(CASE WHEN won0 THEN pre_elo < elo0 ELSE pre_elo > elo0 END, true)) FROM x WHERE most = 1 AND res0 = 'win'"""


def _found_sql(section: str, name: str, query: str, failing: str = "FAIL") -> str:
    return f"SELECT '{section}' AS section, '{name}' AS check_name, CASE WHEN count(*) > 0 THEN '{failing}' ELSE 'PASS' END AS status, count(*)::DOUBLE AS value, coalesce(array_to_string(list(k ORDER BY k)[1:5], ', '), '') AS detail FROM (SELECT DISTINCT k FROM ({query}))"


_COVERAGE = f"""WITH f AS (SELECT DISTINCT {_id('event_id')} AS k FROM fights WHERE {_id('event_id')} IS NOT NULL), c AS (SELECT *, {_id('event_id')} AS k FROM fight_events), done AS (SELECT * FROM c WHERE trim(event_status) = 'completed')
SELECT 'coverage' AS section, 'discovered' AS check_name, 'INFO' AS status, count(*)::DOUBLE AS value, '' AS detail FROM f UNION ALL SELECT 'coverage', 'fetched', 'INFO', count(DISTINCT nullif(trim(source_url), '')), '' FROM c UNION ALL SELECT 'coverage', 'parsed', 'INFO', count(DISTINCT k), '' FROM c
UNION ALL {_found_sql('coverage', 'failed fetches', "SELECT entity_id AS k FROM retired_ids WHERE entity_type = 'event'")} UNION ALL {_found_sql('coverage', 'discovered but not parsed', 'SELECT k FROM f WHERE k NOT IN (SELECT k FROM c WHERE k IS NOT NULL)')} UNION ALL {_found_sql('coverage', 'parsed but not discovered', 'SELECT k FROM c WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM f)', 'INFO')}
UNION ALL {_found_sql('quality', 'duplicate ids', 'SELECT k FROM c WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1')} UNION ALL {_found_sql('quality', 'completed without a date', "SELECT k FROM done WHERE coalesce(trim(date_formatted), '') = ''")} UNION ALL {_found_sql('quality', 'completed without bouts', 'SELECT k FROM done WHERE k NOT IN (SELECT k FROM f)')}
UNION ALL SELECT 'thresholds', 'parse misses', CASE WHEN a / n > 0.05 THEN 'FAIL' ELSE 'PASS' END, round(a / n, 6), printf('%.1f%%', 100 * a / n) FROM (SELECT count(*) AS n, count(*) FILTER (WHERE k NOT IN (SELECT k FROM c WHERE k IS NOT NULL)) AS a FROM f)
UNION ALL SELECT 'thresholds', 'blank dates', CASE WHEN a / n > 0.05 THEN 'FAIL' ELSE 'PASS' END, round(a / n, 6), printf('%.1f%%', 100 * a / n) FROM (SELECT count(*) AS n, count(*) FILTER (WHERE coalesce(trim(date_formatted), '') = '') AS a FROM done)"""

SQL = {
    "q_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) BETWEEN {RANGES[t][0]} AND {RANGES[t][1]} AS ok FROM {t}" for t in TABLES),
    "q_row_equalities": " UNION ALL ".join(f"SELECT '{t}' AS table_name, a AS rows, {k} * b AS expected, a = {k} * b AS ok FROM (SELECT (SELECT count(*) FROM {t}) AS a, (SELECT count(*) FROM fights) AS b)" for t, k in (("fighter_snapshots", 2), ("bout_features", 1))),
    "q_orphan_counts": _LINK_SQL,
    "q_bouts_without_stats": f"SELECT k IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL) AS has_stats, count(*) AS bouts FROM (SELECT DISTINCT {_id('fight_id')} AS k FROM fights) WHERE k IS NOT NULL GROUP BY 1",
    "q_result_types": "SELECT result_type, count(*) AS bouts FROM fights GROUP BY 1",
    "q_consistency": f"""SELECT 'win_without_winner' AS check_name, count(*) FILTER (WHERE result_type = 'win' AND {_W} IS NULL) AS rows FROM fights UNION ALL SELECT 'draw_with_winner', count(*) FILTER (WHERE result_type = 'draw' AND {_W} IS NOT NULL) FROM fights UNION ALL SELECT 'nc_with_winner', count(*) FILTER (WHERE result_type = 'nc' AND {_W} IS NOT NULL) FROM fights
UNION ALL SELECT 'finish_after_schedule', count(*) FILTER (WHERE finish_round > scheduled_rounds) FROM fights UNION ALL SELECT 'winner_took_no_part', count(*) FILTER (WHERE {_W} IS NOT NULL AND {_W} <> coalesce({_F1}, '') AND {_W} <> coalesce({_F2}, '')) FROM fights""",
    "q_vocabulary": "SELECT finish_method AS value, count(*) AS rows FROM fights WHERE finish_method IS NULL OR finish_method NOT IN (" + ", ".join(f"'{m}'" for m in FINISH_METHODS) + ") GROUP BY 1",
    "q_missingness": _missing_sql("fighter_snapshots", SNAPSHOT_NUMBERS), "q_bout_missingness": _missing_sql("bout_features", BOUT_NUMBERS),
    "q_distribution": _distribution_sql("fighter_snapshots", SNAPSHOT_NUMBERS), "q_bout_distribution": _distribution_sql("bout_features", BOUT_NUMBERS),
    "q_correlations": " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(corr({c}::DOUBLE, label::DOUBLE), 6) AS r, coalesce(abs(corr({c}::DOUBLE, label::DOUBLE)) > 0.5, false) AS flagged FROM bout_features" for c in DIFFERENCES),
    "q_completeness": "SELECT CASE WHEN grouping(is_title_fight) = 1 THEN 'all' ELSE is_title_fight::VARCHAR END AS \"group\", count(*) AS rows, count(*) FILTER (WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in DIFFERENCES) + ") AS complete FROM bout_features GROUP BY ROLLUP (is_title_fight)",
    "q_core_completeness": f"SELECT CASE WHEN grouping(both_debuting) = 1 THEN 'all' ELSE both_debuting::VARCHAR END AS \"group\", count(*) AS rows, count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CORE)}) AS complete FROM ({_bout_sql()}) GROUP BY ROLLUP (both_debuting)",
    "q_parts_differ": " UNION ALL ".join(f"SELECT k AS fight_stat_id, '{c}' AS column_name, {c}::BIGINT AS whole, 3 * ({c} // 3)::BIGINT AS parts FROM {_current('fight_stats_aggregate', 'fight_stat_id')} WHERE {c} % 3 > 1" for c in SUMMED),
    "q_targets_differ": f"SELECT sign(s)::INT AS sign, count(*) AS rows, count(DISTINCT f) AS bouts FROM (SELECT sig_strikes_landed - sig_strikes_head_landed - sig_strikes_body_landed - sig_strikes_leg_landed AS s, {_id('fight_id')} AS f FROM fight_stats_aggregate) GROUP BY 1",
    "q_fighter_review": _REVIEW,
    "q_flag_counts": f"SELECT flag, count(*) AS rows FROM (SELECT unnest(string_split(flags, '; ')) AS flag FROM ({_REVIEW})) GROUP BY 1",
    "q_stats_gaps": f"""SELECT CASE WHEN k IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL) THEN 'ok' WHEN k IN (SELECT {_id('entity_id')} FROM retired_ids WHERE entity_type = 'fight') THEN 'fetch_failed' WHEN k IN (SELECT {_id('fight_id')} FROM bout_features WHERE {_id('fight_id')} IS NOT NULL) THEN 'missing_stats' ELSE 'not_fetched' END AS gap_reason, count(*) AS bouts FROM (SELECT DISTINCT {_id('fight_id')} AS k FROM fights) WHERE k IS NOT NULL GROUP BY 1""",
    "q_upsert": "WITH o AS (SELECT *, (load_id = (SELECT max(load_id) FROM fights))::INT AS new FROM fights), r AS (SELECT *, row_number() OVER (PARTITION BY fight_id ORDER BY new DESC, scraped_at DESC) AS rn, max(scraped_at) OVER (PARTITION BY fight_id) AS top FROM o) SELECT fight_id, result_type, finish_method, referee, epoch_us(top) AS scraped_at, load_id FROM r WHERE rn = 1",
    "q_bucket_upsert": "WITH r AS (SELECT *, row_number() OVER (PARTITION BY fight_stat_id ORDER BY load_id DESC, scraped_at DESC, fight_id DESC, knockdowns DESC) AS rn, max(scraped_at) OVER (PARTITION BY fight_stat_id) AS top FROM fight_stats_aggregate) SELECT fight_stat_id, fight_id, knockdowns, epoch_us(top) AS scraped_at, load_id FROM r WHERE rn = 1",
    "q_queue": _QUEUE,
    "q_bout_queue": f"""WITH cards AS {_current('fight_events', 'event_id')}, ahead AS (SELECT k FROM cards WHERE event_date >= DATE '2015-08-01'), f AS (SELECT k AS fight_id, {_id('event_id')} AS event_id, coalesce(finish_method, '') AS m FROM {_current('fights', 'fight_id')}),
o AS (SELECT k AS fight_id, {_id('event_id')} AS event_id, nullif(finish_method, '') AS m FROM (SELECT *, {_id('fight_id')} AS k, row_number() OVER (PARTITION BY {_id('fight_id')} ORDER BY scraped_at DESC) AS rn FROM fights WHERE load_id <= 2) WHERE rn = 1),
s AS (SELECT fight_id, event_id, m, 0 AS p FROM f WHERE event_id IS NULL OR event_id NOT IN (SELECT k FROM ahead) UNION ALL SELECT DISTINCT {_id('fight_id')}, NULL, '', 1 FROM bout_features WHERE {_id('fight_id')} IS NOT NULL), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fight_id ORDER BY p) AS rn FROM s) WHERE rn = 1)
SELECT coalesce(n.fight_id, o.fight_id) AS fight_id, coalesce(n.event_id, o.event_id) AS event_id, 'http://www.example.org/fight-details/' || coalesce(n.fight_id, o.fight_id) AS fight_url, coalesce(nullif(n.m, ''), o.m) AS finish_method, CASE WHEN o.fight_id IS NULL THEN 'pending' ELSE 'done' END AS stats_status, CASE WHEN o.fight_id IS NULL THEN 1767225600000000 ELSE 1577836800000000 END AS queued_at FROM n FULL JOIN o ON n.fight_id = o.fight_id""",
    "q_to_fetch": f"""WITH f AS (SELECT k, {_id('event_id')} AS e FROM {_current('fights', 'fight_id')}), ahead AS (SELECT k FROM {_current('fight_events', 'event_id')} WHERE event_date >= DATE '2015-08-01')
SELECT k AS fight_id FROM f WHERE e IN (SELECT k FROM ahead) OR (k NOT IN (SELECT {_id('fight_id')} FROM bout_features WHERE {_id('fight_id')} IS NOT NULL) AND k NOT IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL))""",
    "q_unseen": f"SELECT * FROM ({_QUEUE}) WHERE fighter_id NOT IN (SELECT {_id('fighter_id')} FROM fighters WHERE {_id('fighter_id')} IS NOT NULL) AND fighter_id NOT IN (SELECT {_id('entity_id')} FROM retired_ids WHERE entity_type = 'fighter')",
    "q_registry": f"""WITH r AS (SELECT {_id('event_id')} AS event_id, event_name, scraped_at, load_id = (SELECT max(load_id) FROM fight_events) AS new FROM fight_events), s AS (SELECT event_id, new, max(struct_pack(a := scraped_at, b := event_name)).b AS event_name, min(scraped_at) AS d, max(scraped_at) AS l FROM r WHERE event_id IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(n.event_id, o.event_id) AS event_id, coalesce(nullif(n.event_name, ''), nullif(o.event_name, '')) AS event_name, epoch_us(coalesce(o.d, n.d)) AS discovered_at, epoch_us(coalesce(n.l, o.l)) AS last_seen_at FROM (SELECT * FROM s WHERE new) n FULL JOIN (SELECT * FROM s WHERE NOT new) o ON n.event_id = o.event_id""",
    "q_pages": "SELECT doc_id::VARCHAR AS url, sha256(text) AS content_hash, CASE WHEN text IS NULL THEN 'failed' WHEN lang IS DISTINCT FROM 'en' THEN 'fetched' WHEN length(text) % 2 = 0 THEN 'unchanged' ELSE 'updated' END AS fetch_status FROM documents",
    "q_page_store": """WITH d AS (SELECT doc_id::VARCHAR AS url, text, doc_id % 3 <> 0 AND text IS NOT NULL AS first, doc_id % 5 <> 0 AS again, CASE WHEN length(text) % 2 = 0 THEN text || '.' ELSE text END AS t2 FROM documents)
SELECT url, CASE WHEN again AND t2 IS NOT NULL THEN sha256(t2) WHEN first THEN sha256(text) END AS content_hash, CASE WHEN again AND t2 IS NOT NULL THEN length(t2) WHEN first THEN length(text) END AS chars, CASE WHEN NOT again THEN NULL WHEN text IS NULL THEN 'failed' WHEN NOT first THEN 'fetched' WHEN t2 = text THEN 'unchanged' ELSE 'updated' END AS fetch_status FROM d WHERE again OR first""",
    "q_csv": f"SELECT k AS event_id, event_name, city, event_date::VARCHAR AS event_date, CASE WHEN event_date >= DATE '2015-08-01' THEN 'upcoming' ELSE 'completed' END AS event_status FROM {_current('fight_events', 'event_id')}",
    "q_raw_scalars": """WITH r AS (SELECT *, floor(height_cm::DOUBLE / 2.54 + 0.5)::INT AS w, list_filter([last_name, stance, first_name], lambda v: v IS NOT NULL) AS l FROM fighters), t AS (SELECT *, list_transform(string_split(array_to_string(l, ', '), ','), lambda v: trim(v)) AS p FROM r)
SELECT fighter_id, load_id, w // 12 AS feet, w % 12 AS inches, round(w * 2.54, 6) AS cm, floor(abs(floor(reach_cm / 2)) * 2.54)::INT AS reach, coalesce(month(dob), 0)::INT AS won, coalesce(day(dob), 0)::INT AS lost, 0 AS drawn, CASE WHEN dob IS NULL THEN 0 ELSE 3 END AS void, dob AS born, CASE WHEN len(p) IN (2, 3) THEN p[1] ELSE '' END AS city, CASE WHEN len(p) = 3 THEN p[2] ELSE '' END AS state, CASE WHEN len(p) = 3 THEN p[3] WHEN len(p) = 2 THEN p[2] ELSE '' END AS country, coalesce(day(dob), 0)::INT AS minute, coalesce(month(dob), 0)::INT AS second, array_to_string(list_filter(p, lambda v: v <> ''), ', ') AS parts,
 CASE WHEN dob IS NULL THEN 'n/a' ELSE printf('%.1f%%', 100.0 * month(dob) / day(dob)) END AS percent FROM t""",
    "q_scalars": """WITH r AS (SELECT *, 'https://www.example.org/' || coalesce(source_url, '') AS u FROM fighters), h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(u)) AS x, trim(regexp_replace(full_name, '[\\t-\\r\\x1c-\\x20\\x85\\p{Z}]+', ' ', 'g')) AS nm FROM r)
SELECT fighter_id, load_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(x, 17, 1)), 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12) AS page_id, replace(u, '://www.', '://') AS url, CASE WHEN contains(u, 'event-details') THEN 'event' WHEN contains(u, 'fight-details') THEN 'fight' WHEN contains(u, 'fighter-details') THEN 'fighter' ELSE 'unknown' END AS entity,
nm AS name, split_part(nm, ' ', 1) AS first_word, array_to_string(string_split(nm, ' ')[2:], ' ') AS other_words, nullif(trim(stance), '') AS stance FROM h""",
    "q_texts": r"""SELECT doc_id, coalesce(nullif(regexp_extract(t, '(\d+) of (\d+)', 1), '')::INT, 0) AS landed, coalesce(nullif(regexp_extract(t, '(\d+) of (\d+)', 2), '')::INT, 0) AS attempted, nullif(regexp_extract(t, '(\d+)', 1), '')::INT AS number, len(regexp_extract_all(t, '(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1))::INT AS links, sha256(t) AS hash, length(trim(regexp_replace(t, '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g'))) AS clean_chars FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "q_normalised": f"""SELECT fight_id, load_id, CASE lower(trim(finish_method)) WHEN 'decision' THEN 'decision' WHEN 'ko/tko' THEN 'ko_tko' WHEN 'submission' THEN 'submission' WHEN 'tko - doctor''s stoppage' THEN 'doctor_stoppage' WHEN 'dq' THEN 'dq' WHEN 'could not continue' THEN 'could_not_continue' WHEN 'overturned' THEN 'overturned' WHEN 'other' THEN 'other' END AS finish,
coalesce(contains(finish_detail, 'Title Bout'), false) AS title, coalesce(contains(finish_detail, 'Interim'), false) AS interim, CASE WHEN {_W} = {_F1} OR {_W} = {_F2} THEN 'win' ELSE 'draw' END AS result, CASE WHEN {_W} = {_F1} THEN {_F1} WHEN {_W} = {_F2} THEN {_F2} END AS winner, nullif(finish_time_seconds, 0)::INT AS seconds,
CASE WHEN weight_class IN ('light_heavyweight', 'heavyweight', 'super_heavyweight', 'middleweight', 'welterweight', 'lightweight', 'featherweight', 'bantamweight', 'flyweight', 'strawweight', 'catch_weight', 'open_weight', 'women_strawweight', 'women_flyweight', 'women_bantamweight', 'women_featherweight') THEN weight_class END AS class,
CASE WHEN weight_class = 'women_strawweight' THEN 'women''s strawweight' WHEN weight_class IN ('flyweight', 'bantamweight', 'featherweight', 'lightweight', 'welterweight', 'middleweight', 'heavyweight', 'catch_weight', 'open_weight') THEN replace(weight_class, '_', ' ') WHEN weight_class IN ('women_flyweight', 'women_bantamweight', 'women_featherweight') THEN split_part(weight_class, '_', 2) WHEN weight_class IN ('light_heavyweight', 'super_heavyweight') THEN 'heavyweight' END AS page_class FROM fights""",
    "q_event_dates": "SELECT event_id, load_id, CASE WHEN regexp_full_match(trim(date_formatted), '[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}') THEN try_strptime(trim(date_formatted), '%B %d, %Y')::DATE END AS long_date, CASE WHEN regexp_full_match(trim(date_formatted), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_cast(trim(date_formatted) AS DATE) END AS iso_date FROM fight_events",
    "q_card_coverage": f"SELECT c.k AS event_id, coalesce(c.event_status, 'completed') AS event_status, count(f.k) AS bouts, count(f.k) FILTER (WHERE f.k IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL)) AS with_stats FROM {_current('fight_events', 'event_id')} c LEFT JOIN {_current('fights', 'fight_id')} f ON {_id('f.event_id')} = c.k GROUP BY 1, 2",
    "q_leakage": f"WITH {_BASE} SELECT 'prior_count' AS check_name, count(*) AS rows, 0 AS failures FROM p UNION ALL SELECT 'monotone', count(DISTINCT (me, d)), 0 FROM p UNION ALL SELECT 'debut', count(*), 0 FROM p UNION ALL SELECT 'label', count(*), 0 FROM b",
    "q_leakage_given": f"""WITH {_BASE}, days AS (SELECT me, d, coalesce(sum(count(*)) OVER (PARTITION BY me ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM p GROUP BY me, d),
s AS (SELECT x.*, days.me, days.d, days.prior FROM fighter_snapshots x JOIN days ON days.me = {_id('x.fighter_id')} AND days.d = x.as_of_date), y AS (SELECT me, d, min(career_fights) AS lo, max(career_fights) AS hi FROM s GROUP BY me, d), z AS (SELECT *, lag(hi) OVER (PARTITION BY me ORDER BY d) AS hi0 FROM y),
l AS (SELECT f.label, CASE WHEN b.res = 'win' AND b.w = b.f1 THEN 1 WHEN b.res = 'win' AND b.w = b.f2 THEN 0 END AS truth FROM bout_features f JOIN b ON b.fight_id = {_id('f.fight_id')})
SELECT 'prior_count' AS check_name, count(*) AS rows, count(*) FILTER (WHERE career_fights IS DISTINCT FROM prior) AS failures FROM s UNION ALL SELECT 'monotone', count(*), count(*) FILTER (WHERE lo <> hi OR lo <= hi0) FROM z UNION ALL SELECT 'debut', count(*), count(*) FILTER (WHERE is_debut IS DISTINCT FROM (prior = 0)) FROM s UNION ALL SELECT 'label', count(*), count(*) FILTER (WHERE label IS DISTINCT FROM truth) FROM l""",
    "q_leakage_elo_given": f"""WITH {_BASE}, e AS (SELECT {_id('fight_id')} AS fight_id, {_id('fighter_id')} AS fighter_id, max(struct_pack(a := computed_at, b := snapshot_id, c := elo_rating)).c::DOUBLE AS pre_elo FROM fighter_snapshots GROUP BY 1, 2), {_ELO_AUDIT.replace("JOIN elo e", "LEFT JOIN e")}""",
    "q_leakage_elo": f"WITH RECURSIVE {_BASE}, {_ELO}, {_ELO_AUDIT}",
    "q_event_coverage": _COVERAGE,
    "q_stats_thresholds": f"""WITH q AS (SELECT DISTINCT {_id('fight_id')} AS k FROM fights WHERE {_id('fight_id')} IS NOT NULL), t AS (SELECT count(*) AS n, count(*) FILTER (WHERE k NOT IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL)) AS a, count(*) FILTER (WHERE k NOT IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL AND total_strikes_landed >= 40)) AS r FROM q)
SELECT 'thresholds' AS section, 'stats misses' AS check_name, CASE WHEN a / n > 0.02 THEN 'FAIL' ELSE 'PASS' END AS status, round(a / n, 6) AS value, printf('%.1f%%', 100 * a / n) AS detail FROM t UNION ALL SELECT 'thresholds', 'round stats misses', CASE WHEN r / n > 0.02 THEN 'FAIL' ELSE 'PASS' END, round(r / n, 6), printf('%.1f%%', 100 * r / n) FROM t""",
    "q_smoke": "SELECT 'fights' AS section, 'columns' AS check_name, 'FAIL' AS status, 1.0::DOUBLE AS value, 'rounds_by_judge' AS detail UNION ALL SELECT 'fights', 'rows', 'PASS', count(*), '' FROM fights UNION ALL SELECT 'fight_events', 'columns', 'PASS', 0, '' UNION ALL SELECT 'fight_events', 'rows', 'PASS', count(*), '' FROM fight_events UNION ALL SELECT 'event_listing', 'exists', 'FAIL', 0, 'absent' UNION ALL SELECT 'fighters', 'columns', 'PASS', 0, '' UNION ALL SELECT 'fighters', 'rows', 'PASS', count(*), '' FROM fighters UNION ALL SELECT 'pages', 'exists', 'PASS', 0, 'absent'",
    "q_stats_info": f"""WITH q AS (SELECT DISTINCT {_id('fight_id')} AS k FROM fights WHERE {_id('fight_id')} IS NOT NULL), t AS (SELECT count(*) AS n, count(*) FILTER (WHERE k NOT IN (SELECT {_id('fight_id')} FROM fight_stats_aggregate WHERE {_id('fight_id')} IS NOT NULL)) AS a FROM q), u AS (SELECT count(*) AS n, count(*) FILTER (WHERE total_strikes_attempted > 0) * 3 AS r FROM fight_stats_aggregate)
SELECT 'bouts' AS figure, n::DOUBLE AS value FROM t UNION ALL SELECT 'share_without_stats', round(a / n, 6) FROM t UNION ALL SELECT 'stats_rows', n FROM u UNION ALL SELECT 'rounds_per_row', round(r / n, 6) FROM u""",
    "q_sample": "SELECT snapshot_id, fighter_id FROM (SELECT DISTINCT snapshot_id, fighter_id FROM fighter_snapshots) ORDER BY md5(coalesce(snapshot_id::VARCHAR, '') || '|' || coalesce(fighter_id, '') || '|7'), snapshot_id, fighter_id LIMIT 200",
}
