"""Queries of the general data problems (p1 to p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows, norm_id
from priorview.operators.asof import attributes_as_known, change_histories, find_hot
from priorview.operators.loaders import COUNTERS
from priorview.operators.impute import Rules, fill_missing, filled_cells
from priorview.operators.orphans import Reference, orphan_references, orphan_report
from priorview.operators.profile import Form, ValueCounts, breaches, current_deltas, deltas, load_metrics, maintained_profile
from priorview.session import materialise, table

#: The closed vocabulary of finish_method.
FINISH_METHODS = ("decision", "ko_tko", "submission", "doctor_stoppage", "dq", "could_not_continue", "overturned", "other")

FORMS = {
    ("fights", "finish_method"): Form(lambda v: v.isin(*FINISH_METHODS), "share"),
    ("fight_events", "date_formatted"): Form(lambda v: v.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & F.try_to_date(v, "yyyy-MM-dd").isNotNull()),
    ("bout_features", "diff_elo"): Form(lambda v: F.expr("try_cast(value as decimal(38,9))").between(-1000, 1000), "mean"),
}

REFERENCES = [
    Reference("fights", "fight_id", "event_id", "event"),
    Reference("fights", "fight_id", "fighter_1_id", "fighter"),
    Reference("fight_stats_aggregate", "fight_stat_id", "fight_id", "fight"),
    Reference("fight_stats_aggregate", "fight_stat_id", "fighter_id", "fighter"),
]

MEASURES = Rules(
    numeric={"height_cm": (120, 230), "reach_cm": (120, 230), "weight_lbs": (80, 600), "dob": ("1940-01-01", "2006-12-31")},
    categorical=("stance",),
    fill=("height_cm", "reach_cm", "dob"),
)


def bout_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fight_id, fighter_id, event_date) of each side of each current bout whose card is known."""
    fights = current_rows(table(spark, sf_dir, "fights"), "fight_id", ["fight_id", "event_id", "fighter_1_id", "fighter_2_id"])
    cards = current_rows(table(spark, sf_dir, "fight_events"), "event_id", ["event_id", "event_date"])
    sides = F.array_distinct(F.array_compact(F.array(norm_id("fighter_1_id"), norm_id("fighter_2_id"))))
    bouts = fights.select("fight_id", norm_id("event_id").alias("event_id"), sides.alias("sides")).filter(F.size("sides") > 0)
    return bouts.join(cards.filter("event_date is not null"), "event_id").select("fight_id", F.explode("sides").alias("fighter_id"), "event_date")


def _known(spark: SparkSession, sf_dir: str, attributes: list[str], nulls: str) -> DataFrame:
    """The sides of bouts with attributes from their stored change histories."""
    snapshots, fights = table(spark, sf_dir, "fighter_snapshots"), table(spark, sf_dir, "fights")
    hot = find_hot([snapshots.select(norm_id("fighter_id")), fights.select(norm_id("fighter_1_id")), fights.select(norm_id("fighter_2_id"))])
    versions = snapshots.withColumn("fighter_id", norm_id("fighter_id")).withColumn("_version", F.col("snapshot_id"))
    kinds = {a: snapshots.schema[a].dataType for a in attributes}
    histories = materialise(change_histories(versions, "fighter_id", "as_of_date", "computed_at", "_version", attributes, nulls, hot), "histories")
    return attributes_as_known(bout_sides(spark, sf_dir), histories, ["fight_id"], "fighter_id", "event_date", kinds, hot)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _known(spark, sf_dir, ["snapshot_id"], "keep").filter("snapshot_id is not null").select("fight_id", "fighter_id", "snapshot_id")


def p1_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side of a bout with the last known value of each of six attributes, whichever snapshot brought it."""
    return _known(spark, sf_dir, ["career_fights", "career_win_rate", "age", "height_cm", "reach_cm", "elo_rating"], "skip")


#: All attributes of a snapshot.
ATTRIBUTES = ("career_fights", "career_wins", "career_losses", "career_win_rate", "career_minutes", "career_sig_strikes_landed_pm", "career_takedown_accuracy", "age", "height_cm", "reach_cm", "days_since_last_fight", "is_debut", "age_missing", "height_reach_missing", "elo_rating")


def p1_all_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side of a bout with the last known value of every attribute, whichever snapshot brought it."""
    return _known(spark, sf_dir, list(ATTRIBUTES), "skip")


def _filled_fighters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = current_rows(table(spark, sf_dir, "fighters"), "fighter_id", ["fighter_id", "height_cm", "reach_cm", "weight_lbs", "dob", "stance"])
    return fill_missing(rows, "fighter_id", MEASURES)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_cells(_filled_fighters(spark, sf_dir), "fighter_id", list(MEASURES.fill)).select("fighter_id", "column_name")


def p2_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All current fighters, filled, with flags and methods."""
    return _filled_fighters(spark, sf_dir)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of the three columns, from value counts to which each load is applied by itself."""
    store = ValueCounts(spark)
    for t, c in FORMS:
        store.apply_loads(deltas(table(spark, sf_dir, t), t, [c], "load_id"), t)
    return breaches(load_metrics(store.read(), FORMS), FORMS, null_change=0.2, bad_share=0.1, share_drift=0.25, mean_drift=150)


#: Tables that number their loads, whose columns are profiled; the key of those that have current rows.
PROFILED = {"fights": "fight_id", "fight_events": "event_id", "bout_features": None, "fight_stats_aggregate": "fight_stat_id", "fighters": "fighter_id"}
#: Tables without load numbers, profiled as one load, number 1.
PROFILED_WHOLE = ("fighter_snapshots",)


def _numeric(rows: DataFrame, t: str) -> dict:
    return {(t, c): k for c, k in rows.dtypes if k.startswith(("decimal", "smallint", "int", "bigint", "double"))}


def _value_counts(spark: SparkSession, sf_dir: str) -> tuple[ValueCounts, dict]:
    """Counts of all columns, a load an application."""
    store, numeric = ValueCounts(spark), {}
    for t in (*PROFILED, *PROFILED_WHOLE):
        rows = table(spark, sf_dir, t)
        numeric |= _numeric(rows, t)
        if t in PROFILED:
            store.apply_loads(deltas(rows, t, [c for c in rows.columns if c != "load_id"], "load_id"), t)
        else:
            store.apply(deltas(rows, t, rows.columns, None, 1, 1), t)
    return store, numeric


def p3_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of every column and load, over the rows of the load, with the changes from the load before."""
    m = load_metrics(_value_counts(spark, sf_dir)[0].read(), FORMS)
    return m.select("table_name", "column_name", "load_id", "rows_n", "nulls_n", "distinct_n", F.round("entropy", 6).alias("entropy"), "bad_n", F.round("mean", 6).alias("mean"), F.round("null_change", 9).alias("null_change"), F.round("tv", 9).alias("tv"))


def _profile(store: ValueCounts, numeric: dict) -> DataFrame:
    return maintained_profile(store.read(), numeric).withColumn("entropy", F.round("entropy", 6))


def p3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maintained state of every column after every load, all rows counted: counts, exact ranges and entropy."""
    return _profile(*_value_counts(spark, sf_dir))


def p3_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every column of bouts after each load, with the second load withdrawn again as load 1000."""
    rows, store = table(spark, sf_dir, "fights"), ValueCounts(spark)
    store.apply_loads(deltas(rows, "fights", [c for c in rows.columns if c != "load_id"], "load_id"), "fights")
    store.withdraw("fights-2", 1000)
    return _profile(store, _numeric(rows, "fights"))


def p3_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every column after every load over the rows that are current then: a record fetched again adds its new
    values and takes its old ones back."""
    store, numeric = ValueCounts(spark), {}
    for t, key in PROFILED.items():
        if key:
            rows = table(spark, sf_dir, t)
            numeric |= _numeric(rows, t)
            store.apply_loads(current_deltas(rows, t, norm_id(key), [c for c in rows.columns if c not in ("load_id", "scraped_at")], "load_id", "scraped_at"), t)
    return _profile(store, numeric)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    parents = {"event": (t("fight_events"), "event_id"), "fighter": (t("fighters"), "fighter_id"), "fight": (t("fights"), "fight_id")}
    return orphan_references({n: t(n) for n in ("fights", "fight_stats_aggregate")}, parents, t("retired_ids"), REFERENCES)


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(p4_found(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p1_found, p1_attributes, p1_all_attributes, p2_found, p2_filled, p3_found, p3_loads, p3_profile, p3_withdrawn, p3_current, p4_found, p4_report)}

_ID = "nullif(lower(trim({0}, ' ' || chr(9) || chr(13) || chr(10) || chr(160))), '')"


def _id(c: str) -> str:
    return _ID.format(c)


def _current(t: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT *, {_id(key)} AS k, row_number() OVER (PARTITION BY {_id(key)} ORDER BY scraped_at DESC NULLS LAST) AS rn FROM {t}) WHERE rn = 1 AND k IS NOT NULL)"


_DAY = "CAST((computed_at AT TIME ZONE 'UTC') AS DATE)"
_SIDES = f"""cards AS {_current('fight_events', 'event_id')}, bouts AS {_current('fights', 'fight_id')},
sides AS (SELECT DISTINCT b.k AS fight_id, s.f AS fighter_id, c.event_date FROM (SELECT k, {_id('event_id')} AS e, unnest([{_id('fighter_1_id')}, {_id('fighter_2_id')}]) AS f FROM bouts) s JOIN bouts b ON b.k = s.k JOIN cards c ON c.k = s.e WHERE s.f IS NOT NULL AND c.event_date IS NOT NULL)"""
_P1 = f"""WITH {_SIDES}, v AS (SELECT *, {_id('fighter_id')} AS f, {_DAY} AS known FROM fighter_snapshots)"""


def _last(c: str, kind: str) -> str:
    return f"(max(struct_pack(a := as_of_date, k := computed_at, s := snapshot_id, v := {c})) FILTER (WHERE {c} IS NOT NULL)).v AS {c}"


_P4_BRANCH = """SELECT '{t}' AS table_name, '{c}' AS column_name, r.k AS record_id,
 CASE WHEN d.retired_at IS NOT NULL AND (p.last IS NULL OR p.last <= d.retired_at) THEN 'deleted' WHEN p.k IS NULL THEN 'missing' ELSE 'late' END AS status,
 strftime(r.scraped_at AT TIME ZONE 'UTC', '%Y-%m') AS period
FROM {now} r LEFT JOIN (SELECT {pk} AS k, min(scraped_at) AS first, max(scraped_at) AS last FROM {p} GROUP BY 1) p ON p.k = {ref}
LEFT JOIN (SELECT {rid} AS k, max(retired_at) AS retired_at FROM retired_ids WHERE entity_type = '{kind}' GROUP BY 1) d ON d.k = {ref}
WHERE {ref} IS NOT NULL AND (p.k IS NULL OR (d.retired_at IS NOT NULL AND p.last <= d.retired_at) OR p.first > r.scraped_at)"""
_PARENT = {"event": ("fight_events", "event_id"), "fighter": ("fighters", "fighter_id"), "fight": ("fights", "fight_id")}
_P4 = "\nUNION ALL\n".join(
    _P4_BRANCH.format(t=r.table, c=r.column, now=_current(r.table, r.key), pk=_id(_PARENT[r.parent][1]), p=_PARENT[r.parent][0], ref=_id(f"r.{r.column}"), rid=_id("entity_id"), kind=r.parent) for r in REFERENCES
)

_GOOD = {
    "fights": "value IN (" + ", ".join(f"'{m}'" for m in FINISH_METHODS) + ")",
    "fight_events": r"regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(value AS DATE) IS NOT NULL",
    "bout_features": "TRY_CAST(value AS DECIMAL(38,9)) BETWEEN -1000 AND 1000",
}
_P3 = "WITH raw AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, coalesce(load_id, -1) AS load_id, value, coalesce({_GOOD[t]}, false) AS good FROM (SELECT load_id, CAST({c} AS VARCHAR) AS value FROM {t})" for t, c in FORMS) + """),
m AS (SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY load_id) AS seq FROM (SELECT table_name, column_name, load_id, count(*) FILTER (WHERE value IS NULL) / count(*) AS nulls, count(*) FILTER (WHERE value IS NOT NULL AND NOT good) / nullif(count(value), 0) AS bad,
 avg(CASE WHEN good AND table_name = 'bout_features' THEN CAST(value AS DOUBLE) END) AS mean, count(*) FILTER (WHERE good) AS good_n FROM raw GROUP BY ALL)),
s AS (SELECT m.seq, m.load_id, raw.value, count(*) / m.good_n AS p FROM raw JOIN m USING (table_name, column_name, load_id) WHERE table_name = 'fights' AND good GROUP BY m.seq, m.load_id, m.good_n, raw.value),
tv AS (SELECT seq, sum(abs(d)) / 2 AS tv FROM (SELECT seq, value, sum(p) AS d FROM (SELECT seq, value, p FROM s UNION ALL SELECT seq + 1, value, -p FROM s) GROUP BY ALL) GROUP BY seq),
x AS (SELECT m.*, lag(nulls) OVER w AS nulls0, lag(mean) OVER w AS mean0, lag(good_n) OVER w AS good0 FROM m WINDOW w AS (PARTITION BY table_name, column_name ORDER BY load_id))
SELECT table_name, column_name, load_id, 'null_share' AS check_name FROM x WHERE abs(nulls - nulls0) > 0.2
UNION ALL SELECT table_name, column_name, load_id, 'form' FROM x WHERE bad > 0.1
UNION ALL SELECT table_name, column_name, load_id, 'drift' FROM x WHERE table_name = 'bout_features' AND abs(mean - mean0) > 150
UNION ALL SELECT table_name, column_name, load_id, 'drift' FROM x JOIN tv USING (seq) WHERE table_name = 'fights' AND good0 > 0 AND good_n > 0 AND tv > 0.25"""

#: Columns by table, as the tables have them, with those that compare as numbers and those that are times.
_COLUMNS = {
    "fights": "fight_id event_id fighter_1_id fighter_2_id winner_fighter_id result_type weight_class is_title_fight is_interim_title scheduled_rounds finish_method finish_detail finish_round finish_time_seconds referee judge_1 judge_2 judge_3 source_url scraped_at",
    "fight_events": "event_id event_name event_date date_formatted city state country event_status source_url scraped_at",
    "bout_features": "fight_id fighter_1_id fighter_2_id event_date weight_class is_title_fight scheduled_rounds label feature_version diff_elo diff_age diff_height_cm diff_reach_cm is_orthodox_vs_southpaw computed_at",
    "fight_stats_aggregate": "fight_stat_id fight_id fighter_id " + " ".join(COUNTERS) + " source_url scraped_at",
    "fighters": "fighter_id full_name first_name last_name nickname height_cm weight_lbs reach_cm stance dob source_url scraped_at",
    "fighter_snapshots": "snapshot_id fighter_id fight_id as_of_date feature_version career_fights career_wins career_losses career_win_rate career_minutes career_sig_strikes_landed_pm career_takedown_accuracy age height_cm reach_cm days_since_last_fight is_debut age_missing height_reach_missing elo_rating computed_at",
}
_NUMBERS = {"scheduled_rounds", "finish_round", "finish_time_seconds", "label", "feature_version", "diff_elo", "diff_age", "diff_height_cm", "diff_reach_cm", *COUNTERS, "height_cm", "weight_lbs", "reach_cm", "snapshot_id", "career_fights", "career_wins", "career_losses", "career_win_rate", "career_minutes", "career_sig_strikes_landed_pm", "career_takedown_accuracy", "age", "days_since_last_fight", "elo_rating"}


def _string(c: str) -> str:
    """The column as Spark writes it: times in UTC without zeros at the end of the fraction."""
    if c in ("scraped_at", "computed_at"):
        return f"regexp_replace(strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '') "
    return f"CAST({c} AS VARCHAR)"


def _long(t: str, load: str, source: str | None = None, left_out: tuple = ()) -> str:
    """(table_name, column_name, load_id, value, num) of every cell of a table."""
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {load} AS load_id, {_string(c)} AS value, {f'CAST({c} AS DOUBLE)' if c in _NUMBERS else 'NULL::DOUBLE'} AS num FROM {source or t}" for c in _COLUMNS[t].split() if c not in left_out)


_CELLS = " UNION ALL ".join(_long(t, "coalesce(load_id, -1)" if t in PROFILED else "1") for t in _COLUMNS)
_P3_KEYS = "table_name, column_name, load_id"
_ENTROPY = "round(CASE WHEN sum(n) FILTER (WHERE value IS NOT NULL) > 0 THEN log2(sum(n) FILTER (WHERE value IS NOT NULL)) - coalesce(sum(n * log2(n)) FILTER (WHERE value IS NOT NULL), 0) / sum(n) FILTER (WHERE value IS NOT NULL) END, 6)"
_STATE = f"""SELECT {_P3_KEYS}, sum(n)::BIGINT AS rows_n, coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::BIGINT AS nulls_n, count(value) AS distinct_n, {_ENTROPY} AS entropy, arg_min(value, struct_pack(a := num, b := value)) FILTER (WHERE value IS NOT NULL) AS min_value, arg_max(value, struct_pack(a := num, b := value)) FILTER (WHERE value IS NOT NULL) AS max_value FROM v GROUP BY ALL"""
#: Of each column and each of its loads, the cells of all loads up to it.
_UPTO = f"l AS (SELECT DISTINCT {_P3_KEYS} FROM cells), v AS (SELECT l.table_name, l.column_name, l.load_id, c.value, any_value(c.num) AS num, count(*) AS n FROM l JOIN cells c ON c.table_name = l.table_name AND c.column_name = l.column_name AND c.load_id <= l.load_id GROUP BY ALL)"


def _good(t: str) -> str:
    return _GOOD[t]


_P3_LOADS = f"""WITH cells AS ({_CELLS}), g AS (SELECT *, CASE {' '.join(f"WHEN table_name = '{t}' AND column_name = '{c}' THEN {_GOOD[t]}" for t, c in FORMS)} END AS good FROM cells), v AS (SELECT {_P3_KEYS}, value, good, count(*) AS n FROM g GROUP BY ALL),
m AS (SELECT *, row_number() OVER w AS seq, lag(nulls_n / rows_n) OVER w AS null0, lag(good_n) OVER w AS good0 FROM (SELECT {_P3_KEYS}, sum(n)::BIGINT AS rows_n, coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::BIGINT AS nulls_n, count(value) AS distinct_n, {_ENTROPY} AS entropy, coalesce(sum(n) FILTER (WHERE value IS NOT NULL AND NOT good), 0)::BIGINT AS bad_n, sum(n) FILTER (WHERE value IS NOT NULL AND coalesce(good, true)) AS good_n,
 round(sum(TRY_CAST(value AS DOUBLE) * n) FILTER (WHERE table_name = 'bout_features' AND column_name = 'diff_elo' AND good) / sum(n) FILTER (WHERE table_name = 'bout_features' AND column_name = 'diff_elo' AND good), 6) AS mean FROM v GROUP BY ALL) WINDOW w AS (PARTITION BY table_name, column_name ORDER BY load_id)),
s AS (SELECT m.seq, value, n / m.good_n AS p FROM v JOIN m USING ({_P3_KEYS}) WHERE table_name = 'fights' AND column_name = 'finish_method' AND good),
tv AS (SELECT seq, sum(abs(d)) / 2 AS tv FROM (SELECT seq, value, sum(p) AS d FROM (SELECT * FROM s UNION ALL SELECT seq + 1, value, -p FROM s) GROUP BY ALL) GROUP BY seq)
SELECT {_P3_KEYS}, rows_n, nulls_n, distinct_n, entropy, bad_n, mean, round(abs(nulls_n / rows_n - null0), 9) AS null_change, CASE WHEN table_name = 'fights' AND column_name = 'finish_method' AND m.seq > 1 AND good0 > 0 AND good_n > 0 THEN round(tv.tv, 9) END AS tv FROM m LEFT JOIN tv ON tv.seq = m.seq"""


def _current_cells() -> str:
    """The cells of the rows that are current after each load in which a record changed hands."""
    out = []
    for t, key in PROFILED.items():
        if key:
            columns = [c for c in _COLUMNS[t].split() if c != "scraped_at"]
            pack = "struct_pack(o := scraped_at, " + ", ".join(f"v{i} := {_string(c)}" for i, c in enumerate(columns)) + ")"
            rows = f"(SELECT l.load_id AS upto, max({pack}) AS r FROM (SELECT DISTINCT load_id FROM {t}) l JOIN {t} x ON x.load_id <= l.load_id WHERE {_id(key)} IS NOT NULL GROUP BY l.load_id, {_id(key)})"
            out += [f"SELECT '{t}' AS table_name, '{c}' AS column_name, upto AS load_id, r.v{i} AS value, {f'TRY_CAST(r.v{i} AS DOUBLE)' if c in _NUMBERS else 'NULL::DOUBLE'} AS num FROM {rows}" for i, c in enumerate(columns)]
    return " UNION ALL ".join(out)


SQL = {
    "p1_found": f"""{_P1} SELECT e.fight_id, e.fighter_id, (max(struct_pack(a := as_of_date, k := computed_at, s := snapshot_id))).s AS snapshot_id
FROM sides e JOIN v ON v.f = e.fighter_id AND v.as_of_date <= e.event_date AND v.known < e.event_date GROUP BY ALL""",
    "p1_attributes": f"""{_P1} SELECT e.fight_id, e.fighter_id, e.event_date, {', '.join(_last(c, '') for c in ('career_fights', 'career_win_rate', 'age', 'height_cm', 'reach_cm', 'elo_rating'))}
FROM sides e LEFT JOIN v ON v.f = e.fighter_id AND v.as_of_date <= e.event_date AND v.known < e.event_date GROUP BY e.fight_id, e.fighter_id, e.event_date""",
    "p1_all_attributes": f"""{_P1} SELECT e.fight_id, e.fighter_id, e.event_date, {', '.join(_last(c, '') for c in ATTRIBUTES)}
FROM sides e LEFT JOIN v ON v.f = e.fighter_id AND v.as_of_date <= e.event_date AND v.known < e.event_date GROUP BY e.fight_id, e.fighter_id, e.event_date""",
    "p2_found": f"""SELECT k AS fighter_id, column_name FROM (SELECT k, unnest(list_filter([
 CASE WHEN coalesce(height_cm BETWEEN 120 AND 230, false) THEN NULL ELSE 'height_cm' END, CASE WHEN coalesce(reach_cm BETWEEN 120 AND 230, false) THEN NULL ELSE 'reach_cm' END,
 CASE WHEN coalesce(dob BETWEEN DATE '1940-01-01' AND DATE '2006-12-31', false) THEN NULL ELSE 'dob' END], lambda c: c IS NOT NULL)) AS column_name FROM {_current('fighters', 'fighter_id')})""",
    "p3_found": _P3,
    "p3_loads": _P3_LOADS,
    "p3_profile": f"WITH cells AS ({_CELLS}), {_UPTO} {_STATE}",
    "p3_withdrawn": f"WITH cells AS ({_long('fights', 'load_id')}), l AS (SELECT DISTINCT {_P3_KEYS} FROM cells UNION SELECT DISTINCT table_name, column_name, 1000 FROM cells), v AS (SELECT l.table_name, l.column_name, l.load_id, c.value, any_value(c.num) AS num, count(*) AS n FROM l JOIN cells c ON c.column_name = l.column_name AND c.load_id <= l.load_id AND NOT (l.load_id = 1000 AND c.load_id = 2) GROUP BY ALL) {_STATE}",
    "p3_current": f"WITH v AS (SELECT {_P3_KEYS}, value, any_value(num) AS num, count(*) AS n FROM ({_current_cells()}) GROUP BY ALL) {_STATE}",
    "p4_found": _P4,
    "p4_report": f"SELECT table_name, column_name, status, period, count(*) AS refs FROM ({_P4}) GROUP BY ALL",
}
