"""Checks and reports as tidy tables: one pass over a table, whatever the number of checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from priorview.functions.keys import norm_id
from priorview.functions.scalars import percent
from priorview.operators.merge import CAPTURED
from priorview.operators.quantiles import interpolated, order_statistics


def counts_within(frames: dict[str, DataFrame], ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """(table_name, rows, ok) of each table with its expected range of row counts."""
    each = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows", F.col("rows").between(*ranges[t]).alias("ok")) for t, df in frames.items()]
    return reduce(DataFrame.unionAll, each)


def orphan_count(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """(check_name, misses): references (null ones aside) without a parent."""
    refs = child.select(norm_id(column).alias("k")).filter("k is not null")
    return refs.join(parent.select(norm_id(key).alias("k")).distinct(), "k", "left_anti").agg(F.count(F.lit(1)).alias("misses")).select(F.lit(name).alias("check_name"), "misses")


def failing(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, rows): how many rows each condition holds for, in one pass."""
    one = df.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
    return unpivoted(one, list(checks), "check_name", "rows")


def unpivoted(one: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])))


def unknown_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """(value, rows): values beside the known ones; a null value counts the missing."""
    return df.filter(~F.coalesce(F.col(column).isin(known), F.lit(False))).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def missingness(df: DataFrame, columns: list[str], warn: float = 0.5) -> DataFrame:
    """(column_name, nulls, rows, share, warn) of each column."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.select("_rows", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])))
    s = F.try_divide(F.col("nulls").cast("double"), F.col("_rows").cast("double"))
    return long.select("column_name", "nulls", F.col("_rows").alias("rows"), s.alias("share"), F.coalesce(s > warn, F.lit(False)).alias("warn"))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, mean, sd, low, high, p5, p95, constant) of each numeric column; percentiles interpolate.

    Percentiles are exact, from counts that narrow pass by pass (``order_statistics``): no task holds a column's values.
    """
    d = lambda c: F.col(c).cast("double")
    one = df.agg(*[F.struct(F.avg(d(c)).alias("mean"), F.stddev_samp(d(c)).alias("sd"), F.min(d(c)).alias("low"), F.max(d(c)).alias("high")).alias(c) for c in columns]).first()
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("key"), d(c).alias("v")) for c in columns])))
    found = order_statistics(cells.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n")), shares=[0.05, 0.95])
    rows = [(c, *one[c], *[interpolated(found.get(c, {}), s) for s in (0.05, 0.95)]) for c in columns]
    r = lambda c: F.round(c, 4).alias(c)
    made = df.sparkSession.createDataFrame(rows, "column_name string, mean double, sd double, low double, high double, p5 double, p95 double")
    return made.select("column_name", *map(r, ("mean", "sd", "low", "high", "p5", "p95")), F.coalesce(F.col("sd") == 0, F.lit(False)).alias("constant"))


def correlations(df: DataFrame, columns: list[str], label: str, flag: float = 0.5) -> DataFrame:
    """(column_name, r, flagged): Pearson's r with the label over the rows that have both."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    return unpivoted(one, columns, "column_name", "r").select("column_name", F.round("r", 6).alias("r"), F.coalesce(F.abs("r") > flag, F.lit(False)).alias("flagged"))


def completeness(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """(group, rows, complete): rows that have all columns, for each value of ``by`` and for all rows together."""
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.rollup(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("complete"), F.grouping(by).alias("g")).select(F.when(F.col("g") == 1, "all").otherwise(F.col(by).cast("string")).alias("group"), "rows", "complete")


def sums_differ(whole: DataFrame, parts: DataFrame, keys: list[str], columns: list[str], beyond: int = 1) -> DataFrame:
    """(keys, column_name, whole, parts): where the parts of a record don't add up to it."""
    total = parts.groupBy(*keys).agg(*[F.sum(c).alias(f"p_{c}") for c in columns])
    both = whole.select(*keys, *columns).join(total, keys)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("whole"), F.col(f"p_{c}").cast("bigint").alias("parts")) for c in columns])
    return both.select(*keys, F.inline(cells)).filter(F.abs(F.col("whole") - F.col("parts")) > beyond)


def profile_flags(rows: DataFrame, key: str, name: str, bio: list[str], born: str, sparse: int = 3) -> DataFrame:
    """(key, name, flags, flag_count): records worth a review, '; '-joined flags: missing_name, missing_id, duplicate_name
    (other ids have it too), sparse_bio (at least ``sparse`` of ``bio`` missing; blank texts are), else missing_dob."""
    clean = F.nullif(F.trim(name), F.lit(""))
    twice = rows.filter(clean.isNotNull()).groupBy(clean.alias("_name")).agg(F.count_distinct(key).alias("_ids"))
    absent = lambda c: (F.nullif(F.trim(c), F.lit("")) if dict(rows.dtypes)[c] == "string" else F.col(c)).isNull()
    missing = reduce(lambda a, b: a + b, [absent(c).cast("int") for c in bio])
    flags = F.array_compact(F.array(F.when(clean.isNull(), "missing_name"), F.when(F.col(key).isNull(), "missing_id"), F.when(F.col("_ids") > 1, "duplicate_name"), F.when(missing >= sparse, "sparse_bio").when(F.col(born).isNull(), "missing_dob")))
    joined = rows.withColumn("_name", clean).join(twice, "_name", "left").withColumn("_flags", flags)
    return joined.filter(F.size("_flags") > 0).select(F.col(key), F.col("_name").alias(name), F.array_join("_flags", "; ").alias("flags"), F.size("_flags").alias("flag_count"))


def flag_counts(flagged: DataFrame) -> DataFrame:
    return flagged.select(F.explode(F.split("flags", "; ")).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("rows"))


def gaps(wanted: DataFrame, fetched: DataFrame, parsed: DataFrame, key: str) -> DataFrame:
    """(key, gap_reason): ok (parsed), fetch_failed, not_fetched, missing_stats, in that order.

    fetched: (key, status) with the latest status of a fetch; 'failed' is one that didn't work.
    """
    f = fetched.select(F.col(key), F.col("status").alias("_status"))
    p = parsed.select(key).distinct().withColumn("_parsed", F.lit(True))
    rows = wanted.select(key).distinct().join(f, key, "left").join(p, key, "left")
    return rows.select(key, F.when(F.col("_parsed"), "ok").when(F.col("_status") == "failed", "fetch_failed").when(F.col("_status").isNull(), "not_fetched").otherwise("missing_stats").alias("gap_reason"))


def leakage_audit(snapshots: DataFrame, participants: DataFrame, bouts: DataFrame) -> DataFrame:
    """(check_name, rows, failures) over all rows: counts equal an independent count of earlier bouts; counts never fall
    from one day of an entity to the next; entities without an earlier day, and no others, are debuts; labels follow the
    winner. Snapshots of days without a bout are not looked at. Ratings: ``elo_audit``."""
    days = participants.groupBy("fighter_id", "day").agg(F.count(F.lit(1)).alias("k"))
    before = days.withColumn("prior", F.coalesce(F.sum("k").over(Window.partitionBy("fighter_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = snapshots.withColumn("day", F.unix_date("as_of_date")).join(before, ["fighter_id", "day"])
    count_check = s.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("total_fights").eqNullSafe(F.col("prior"))).alias("failures")).select(F.lit("prior_count").alias("check_name"), "*")
    by_day = s.groupBy("fighter_id", "day").agg(F.min("total_fights").alias("lo"), F.max("total_fights").alias("hi"))
    step = F.lag("hi").over(Window.partitionBy("fighter_id").orderBy("day"))
    monotone = by_day.withColumn("_before", step).agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col("lo") != F.col("hi")) | (F.col("lo") <= F.col("_before"))).alias("failures")).select(F.lit("monotone").alias("check_name"), "*")
    debut = s.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("is_debut").eqNullSafe(F.col("prior") == 0)).alias("failures")).select(F.lit("debut").alias("check_name"), "*")
    label = F.when(F.col("result_type") == "win", F.when(F.col("winner_fighter_id") == F.col("f1"), 1).when(F.col("winner_fighter_id") == F.col("f2"), 0))
    truth = participants.filter("side = 1").select("fight_id", "result_type", "winner_fighter_id", F.col("fighter_id").alias("f1"), F.col("opponent_id").alias("f2"))
    labels = bouts.join(truth, "fight_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("label").eqNullSafe(label)).alias("failures")).select(F.lit("label").alias("check_name"), "*")
    return count_check.unionByName(monotone).unionByName(debut).unionByName(labels)


def elo_audit(snapshots: DataFrame, participants: DataFrame, initial: float = 1500.0) -> DataFrame:
    """(check_name, rows, failures): entities with a single bout on their first day start at ``initial``; over all entities
    whose bouts have days of their own, the rating doesn't fall after a win nor rise after a loss. A missing rating fails."""
    sides = participants.select("fight_id", "fighter_id", "day", "won", "result_type")
    s = sides.join(snapshots.select("fight_id", "fighter_id", F.col("pre_fight_elo").alias("elo")), ["fight_id", "fighter_id"], "left")
    days = s.groupBy("fighter_id", "day").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("fight_id", "elo", "won", "result_type")).alias("bout"))
    mine, before = Window.partitionBy("fighter_id"), Window.partitionBy("fighter_id").orderBy("day")
    d = days.select("fighter_id", "day", "n", "bout.*").withColumns({"first": F.min("day").over(mine) == F.col("day"), "most": F.max("n").over(mine), **{f"_{c}": F.lag(c).over(before) for c in ("elo", "won", "result_type")}})
    start, pair = F.col("first") & (F.col("n") == 1), (F.col("most") == 1) & ~F.col("first") & (F.col("_result_type") == "win")
    wrong = F.coalesce(F.when(F.col("_won"), F.col("elo") < F.col("_elo")).otherwise(F.col("elo") > F.col("_elo")), F.lit(True))
    one = d.agg(F.count_if(start).alias("n1"), F.count_if(start & ~F.col("elo").eqNullSafe(F.lit(initial))).alias("f1"), F.count_if(pair).alias("n2"), F.count_if(pair & wrong).alias("f2"))
    return one.select(F.inline(F.array(F.struct(F.lit("debut_elo").alias("check_name"), F.col("n1").alias("rows"), F.col("f1").alias("failures")), F.struct(F.lit("elo_direction").alias("check_name"), F.col("n2").alias("rows"), F.col("f2").alias("failures")))))


def count_equalities(counts: dict[str, DataFrame], expected: dict[str, tuple[str, int]]) -> DataFrame:
    """(table_name, rows, expected, ok) of each table that has to have ``times`` as many rows as another (table, times)."""
    n = {t: df.count() for t, df in counts.items()}
    spark = next(iter(counts.values())).sparkSession
    return spark.createDataFrame([(t, n[t], n[o] * k, n[t] == n[o] * k) for t, (o, k) in expected.items()], "table_name string, rows bigint, expected bigint, ok boolean")


def seeded_sample(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """``n`` rows drawn by the hash of their keys and the seed: the same rows whatever their order; fewer if there are fewer."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


REPORT = ("section", "check_name", "status", "value", "detail")


def _finding(section: str, name: str, offending: DataFrame, key: str, failing: str = "FAIL") -> DataFrame:
    """A report row: how many ``key``s there are in ``offending``, PASS if none, with the first five of them."""
    ids = offending.select(F.col(key).cast("string").alias("k")).distinct()
    first = ids.orderBy("k").limit(5).agg(F.array_join(F.array_sort(F.collect_list("k")), ", ").alias("d"))
    both = ids.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(None).cast("string").alias("d")).unionAll(first.select(F.lit(None).cast("bigint"), "d"))
    one = both.agg(F.max("n").alias("value"), F.max("d").alias("detail"))
    return one.select(F.lit(section).alias("section"), F.lit(name).alias("check_name"), F.when(F.col("value") > 0, failing).otherwise("PASS").alias("status"), F.col("value").cast("double").alias("value"), "detail")


def _info(section: str, name: str, df: DataFrame, value: Column) -> DataFrame:
    return df.agg(value.cast("double").alias("value")).select(F.lit(section).alias("section"), F.lit(name).alias("check_name"), F.lit("INFO").alias("status"), "value", F.lit("").alias("detail"))


def _within(section: str, name: str, df: DataFrame, part: Column, whole: Column, threshold: float) -> DataFrame:
    """A report row: the share of ``part`` in ``whole``, FAIL beyond the threshold; nothing of nothing passes."""
    one = df.agg(part.alias("a"), whole.alias("b")).select("a", "b", F.coalesce(F.try_divide(F.col("a").cast("double"), F.col("b").cast("double")), F.lit(0.0)).alias("s"))
    return one.select(F.lit(section).alias("section"), F.lit(name).alias("check_name"), F.when(F.col("s") > threshold, "FAIL").otherwise("PASS").alias("status"), F.round("s", 6).alias("value"), percent(F.col("a"), F.col("b")).alias("detail"))


def event_coverage(discovered: DataFrame, log: DataFrame, parsed: DataFrame, threshold: float = 0.05) -> DataFrame:
    """The report of cards from discovery over fetching to parsing: (section, check_name, status, value, detail).

    discovered: (event_id). log: (entity_type, source_url, fetch_status). parsed: (event_id, event_status, date_formatted,
    fights), where blank texts are missing. Shares beyond ``threshold`` fail.
    """
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    ids = lambda df: df.select(text("event_id").alias("event_id")).filter("event_id is not null")
    found, rows, have = ids(discovered).distinct(), ids(parsed), ids(parsed).distinct()
    pages = log.filter(F.trim("entity_type") == "event")
    captured = pages.filter(F.trim("fetch_status").isin(*CAPTURED)).select(text("source_url").alias("u"))
    done = parsed.filter(F.trim("event_status") == "completed")
    marked = found.withColumn("a", F.lit(1)).join(have.withColumn("b", F.lit(1)), "event_id", "full_outer")
    return reduce(DataFrame.unionByName, [
        _info("coverage", "discovered", found, F.count(F.lit(1))), _info("coverage", "fetched", captured, F.count_distinct("u")), _info("coverage", "parsed", have, F.count(F.lit(1))),
        _finding("coverage", "failed fetches", pages.filter(F.trim("fetch_status") == "failed"), "source_url"),
        _finding("coverage", "discovered but not parsed", marked.filter("a = 1 and b is null"), "event_id"), _finding("coverage", "parsed but not discovered", marked.filter("b = 1 and a is null"), "event_id", "INFO"),
        _finding("quality", "duplicate ids", rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "event_id"),
        _finding("quality", "completed without a date", done.filter(text("date_formatted").isNull()), "event_id"), _finding("quality", "completed without bouts", done.filter(text("fights").isNull()), "event_id"),
        _within("thresholds", "parse misses", marked, F.count_if((F.col("a") == 1) & F.col("b").isNull()), F.count_if(F.col("a") == 1), threshold),
        _within("thresholds", "blank dates", done, F.count_if(text("date_formatted").isNull()), F.count(F.lit(1)), threshold),
    ])


def stats_thresholds(queue: DataFrame, aggregate: DataFrame, by_round: DataFrame, key: str, threshold: float = 0.05) -> DataFrame:
    """The report rows of queued bouts that have no stats, or none by round: FAIL beyond the threshold."""
    q = queue.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    has = lambda df, n: df.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().withColumn(n, F.lit(1))
    rows = q.join(has(aggregate, "a"), key, "left").join(has(by_round, "r"), key, "left")
    return reduce(DataFrame.unionByName, [_within("thresholds", name, rows, F.count_if(F.col(c).isNull()), F.count(F.lit(1)), threshold) for name, c in (("stats misses", "a"), ("round stats misses", "r"))])


def smoke_check(spark: SparkSession, folder: str, required: dict[str, list[str]], optional: list[str] = ()) -> DataFrame:
    """The report of what has to be in a folder of tables: each is there, has its columns and has rows; others are only counted."""
    from priorview.sources.tables import exists

    out = []
    for t in (*required, *optional):
        path = f"{folder}/{t}.parquet"
        if not exists(spark, path):
            out.append((t, "exists", "FAIL" if t in required else "PASS", 0.0, "absent"))
            continue
        df = spark.read.parquet(path)
        lacking, n = sorted(set(required.get(t, [])) - set(df.columns)), df.count()
        out.append((t, "columns", "FAIL" if lacking else "PASS", float(len(lacking)), ", ".join(lacking)))
        out.append((t, "rows", "FAIL" if t in required and not n else "PASS", float(n), ""))
    return spark.createDataFrame(out, "section string, check_name string, status string, value double, detail string")
