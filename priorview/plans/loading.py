"""Queries of the loaders and of the page readers: raw texts, made from the given tables as exports and pages would have
them, are read back into rows of the warehouse; their SQL says what has to come out, straight from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.functions import scalars as S
from priorview.functions.keys import norm_id
from priorview.operators import loaders as L
from priorview.operators.pages import LABEL, NAME, NICKNAME, OFFICIAL, OUTCOME, PERSON, RECORD, TITLE, read_pages_as
from priorview.plans.general import _id
from priorview.session import table

def _fetched() -> Column:
    return F.concat(F.date_format(F.to_utc_timestamp("scraped_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def _raw(rows: DataFrame, kind: str, fields: dict[str, Column]) -> DataFrame:
    """Raw rows of a kind: every column a text, those not given missing."""
    given = {"scraped_at": _fetched(), "url": F.coalesce("source_url", F.lit(""))} | fields
    return rows.select(*[F.coalesce(given[c].cast("string"), F.lit("")).alias(c) if c in given else F.lit("").alias(c) for c in L.RAW[kind]])


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fight_events")
    return _raw(rows, "events", {c: F.col(c) for c in ("event_id", "date_formatted", "city", "state", "country", "event_status")} | {"name": F.concat(F.lit(" "), "event_name")})


def _class_text() -> Column:
    """'women_flyweight' as "Women's Flyweight", others with capitals."""
    words = F.initcap(F.replace("weight_class", F.lit("_"), F.lit(" ")))
    return F.when(F.col("weight_class").startswith("women"), F.concat(F.lit("Women's "), F.initcap(F.substring_index("weight_class", "_", -1)))).otherwise(words)


def raw_fights(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fights")
    w, a, b = norm_id("winner_fighter_id"), norm_id("fighter_1_id"), norm_id("fighter_2_id")
    first, second = F.coalesce(w == a, F.lit(False)), F.coalesce(w == b, F.lit(False)) & ~F.coalesce(w == a, F.lit(False))
    draw = F.col("result_type") == "draw"
    letter = lambda won, lost: F.when(won, "W").when(lost, "L").when(draw, "D").otherwise("NC")
    title = F.concat_ws(" ", F.when(F.coalesce("is_interim_title", F.lit(False)), "Interim"), _class_text(), F.when(F.coalesce("is_title_fight", F.lit(False)), "Title"), F.lit("Bout"))
    back = {v: k for k, v in S.FINISHES.items()}
    method = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in back.items() for x in kv]), F.col("finish_method")), F.col("finish_method"))
    seconds = F.col("finish_time_seconds").cast("int")
    fields = {c: F.col(c) for c in ("fight_id", "event_id", "fighter_1_id", "fighter_2_id", "finish_round", "referee", "judge_1", "judge_2", "judge_3")}
    fields |= {"fighter_1_outcome": letter(first, second), "fighter_2_outcome": letter(second, first), "bout_type": title, "num_rounds": F.col("scheduled_rounds"), "primary_finish_method": F.upper(method), "secondary_finish_method": F.col("finish_detail")}
    return _raw(rows, "fights", fields | {"finish_time_minute": F.floor(seconds / 60), "finish_time_second": seconds % 60})


def raw_fighters(spark: SparkSession, d: str) -> DataFrame:
    fields = {c: F.col(c) for c in ("fighter_id", "full_name", "first_name", "nickname", "height_cm", "weight_lbs", "reach_cm", "stance")}
    return _raw(table(spark, d, "fighters"), "fighters", fields | {"last_names": F.col("last_name"), "dob_formatted": F.col("dob")})


def raw_stats(spark: SparkSession, d: str) -> DataFrame:
    fields = {c: F.col(c) for c in ("fight_stat_id", "fight_id", "fighter_id")} | {r: F.col(c) for c, r in L.COUNTERS.items()}
    return _raw(table(spark, d, "fight_stats_aggregate"), "fight_stats", fields | {"control_time_minutes": F.floor(F.col("control_time_seconds") / 60), "control_time_seconds": F.col("control_time_seconds") % 60})


def raw_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Three rounds a stats row, each with a third of its counts, cut off."""
    rows = table(spark, d, "fight_stats_aggregate").withColumn("round", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    third = {r: F.floor(F.col(c) / 3) for c, r in L.COUNTERS.items()}
    fields = {"fight_stat_by_round_id": F.concat("fight_stat_id", F.lit("-"), "round"), "fight_id": F.col("fight_id"), "fighter_id": F.col("fighter_id"), "round": F.col("round"), **third}
    return _raw(rows, "fight_stats_by_round", fields | {"control_time_minutes": F.lit(0), "control_time_seconds": third["control_time_seconds"]})


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("scraped_at", F.unix_micros("scraped_at"))


def q_load_events(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.event_rows(raw_events(spark, d), strict=False))


def q_load_fighters(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.fighter_rows(raw_fighters(spark, d), strict=False))


def q_load_fights(spark: SparkSession, d: str) -> DataFrame:
    """Bouts whose card is known."""
    return _plain(L.known_only(L.fight_rows(raw_fights(spark, d), strict=False), "event_id", table(spark, d, "fight_events"), "event_id")[0])


def q_load_stats(spark: SparkSession, d: str) -> DataFrame:
    """Stats rows whose bout is known."""
    return _plain(L.known_only(L.stat_rows(raw_stats(spark, d), strict=False), "fight_id", table(spark, d, "fights"), "fight_id")[0])


def q_load_rounds(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.known_only(L.stat_rows(raw_rounds(spark, d), True, strict=False), "fight_id", table(spark, d, "fights"), "fight_id")[0])


def q_load_skipped(spark: SparkSession, d: str) -> DataFrame:
    """How many raw rows of each kind are read and how many of them are skipped, because what they refer to is unknown."""
    out = []
    for kind, raw, parent, key in (("fights", raw_fights, "fight_events", "event_id"), ("fight_stats", raw_stats, "fights", "fight_id"), ("fight_stats_by_round", raw_rounds, "fights", "fight_id")):
        rows = raw(spark, d).select(key)
        skipped = L.known_only(rows, key, table(spark, d, parent), key)[1]
        flagged = rows.select(F.lit(0).alias("s")).unionAll(skipped.select(F.lit(1).alias("s")))
        out.append(flagged.agg(F.count_if(F.col("s") == 0).alias("read"), F.count_if(F.col("s") == 1).alias("skipped")).select(F.lit(kind).alias("kind"), "read", "skipped"))
    return reduce(DataFrame.unionAll, out)


def _tag(place: tuple, inner: Column, attrs: str = "") -> Column:
    name = place[0] or "i"
    return F.concat(F.lit(f'<{name} class="{place[1]}"{attrs}>'), F.coalesce(inner, F.lit("")), F.lit(f"</{name}>"))


def _safe(c: str) -> Column:
    """Text as it stands in a page: the markup's characters as references."""
    return F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def fight_pages(spark: SparkSession, d: str) -> DataFrame:
    """(url, html): a page for each raw row of a bout; addresses are made of the ids."""
    link = lambda kind, c: F.concat(F.lit(f"http://www.example.org/{kind}-details/"), F.col(c))
    anchor = lambda cls, url: F.concat(F.lit(f'<a class="{cls}" href="'), url, F.lit('">x</a>'))
    label = lambda text, after: F.concat(F.lit("<p>"), _tag(LABEL, F.lit(f"{text}:")), after, F.lit("</p>"))
    inside = lambda c: F.concat(F.lit("<i>"), _safe(c), F.lit("</i>"))
    official = lambda c: _tag(OFFICIAL, F.concat(F.lit("<span>"), _safe(c), F.lit("</span>")))
    html = F.concat(
        anchor("b-link", link("event", "event_id")), *[F.concat(_tag(OUTCOME, F.col(f"fighter_{i}_outcome")), anchor(f"b-link {PERSON[1]}", link("fighter", f"fighter_{i}_id"))) for i in (1, 2)], _tag(TITLE, _safe("bout_type")),
        label("Method", inside("primary_finish_method")), label("Round", F.concat(F.lit(" "), "finish_round")), label("Time", F.concat("finish_time_minute", F.lit(":"), "finish_time_second")), label("Time format", F.concat("num_rounds", F.lit(" Rnd"))),
        label("Referee", inside("referee")), official("referee"), *[official(f"judge_{i}") for i in (1, 2, 3)], label("Details", _safe("secondary_finish_method")),
    )
    whole = F.when((F.col("num_rounds") != "") & (F.trim("referee") != ""), html).otherwise(F.lit("<p>no such page"))
    return raw_fights(spark, d).filter("fight_id <> '' and event_id <> '' and fighter_1_id <> '' and fighter_2_id <> ''").select(link("fight", "fight_id").alias("url"), whole.alias("html"), "scraped_at")


def q_page_fights(spark: SparkSession, d: str) -> DataFrame:
    """Bout pages read back to raw rows and on to outcome and class; those that can't be read with their error."""
    read = read_pages_as(fight_pages(spark, d), "fight")
    raw = read.select("url", "error", *[F.col("fields")[c].alias(c) for c in L.RAW["fights"] if c != "url"])
    result, _ = S.outcome("fighter_1_outcome", "fighter_2_outcome", F.lit("a"), F.lit("b"))
    ok = F.col("error").isNull()
    return raw.select("url", ok.alias("ok"), "fight_id", "event_id", "fighter_1_id", F.when(ok, result).alias("result_type"), S.weight_class("bout_type").alias("weight_class"), F.try_to_number("num_rounds", F.lit("999")).cast("int").alias("rounds"), S.clean("referee").alias("referee"), S.clean("judge_1").alias("judge_1"), F.when(ok, S.integer("finish_time_minute") * 60 + S.integer("finish_time_second")).alias("seconds"))


def q_page_fighters(spark: SparkSession, d: str) -> DataFrame:
    """Profile pages, made of the profile rows, read back."""
    rows = table(spark, d, "fighters").filter("fighter_id is not null")
    item = lambda c: F.concat(F.lit('<li class="b-list__box-list-item"> <i>x</i> '), F.coalesce(c, F.lit("--")), F.lit("</li>"))
    box = F.concat(F.lit("<ul>"), item(F.concat(F.col("height_cm").cast("string"), F.lit(" cm"))), item(F.concat(F.col("weight_lbs").cast("string"), F.lit(" lbs."))), item(F.col("reach_cm").cast("string")), item(F.trim("stance")), item(F.col("dob").cast("string")), F.lit("</ul>"))
    html = F.concat(_tag(NAME, _safe("full_name")), _tag(RECORD, F.lit("Record: 1-0-0")), _tag(NICKNAME, _safe("nickname")), box)
    pages = rows.select(F.concat(F.lit("http://www.example.org/fighter-details/"), "fighter_id").alias("url"), html.alias("html"))
    read = read_pages_as(pages, "fighter")
    f = lambda c: F.col("fields")[c]
    return read.select("url", F.col("error").isNull().alias("ok"), f("full_name").alias("full_name"), S.text(f("nickname")).alias("nickname"), S.first_number(f("weight")).alias("weight"), S.text(f("stance")).alias("stance"), F.try_to_date(S.text(f("dob")), "yyyy-MM-dd").alias("dob"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_AT = "epoch_us(date_trunc('second', scraped_at)) AS scraped_at"
_T = "nullif(trim({0}, ' '), '')"


def _t(c: str, name: str | None = None) -> str:
    return f"{_T.format(c)} AS {name or c}"


_W, _F1, _F2 = _id("winner_fighter_id"), _id("fighter_1_id"), _id("fighter_2_id")
_RESULT = f"CASE WHEN {_W} = {_F1} OR {_W} = {_F2} THEN 'win' WHEN result_type = 'draw' THEN 'draw' ELSE 'nc' END AS result_type"
_KNOWN = "{0} IN (SELECT {1} FROM {2} WHERE {1} IS NOT NULL)"
_KNOWN_EVENT = _KNOWN.format(_id("event_id"), _id("event_id"), "fight_events")
_KNOWN_FIGHT = _KNOWN.format(_id("fight_id"), _id("fight_id"), "fights")
_URL5 = "lower(substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(x, 17, 1)), 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12))"


def _uuid5(url: str) -> str:
    return f"(SELECT {_URL5} FROM (SELECT sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(replace({url}, '://www.', '://'))) AS x))"


_WS = r"trim(regexp_replace({0}, '[\t-\r\x1c-\x20\x85\p{{Z}}]+', ' ', 'g'))"
_OFF = lambda c: _WS.format(f"coalesce({c}, '')")
_LINK = "'http://www.example.org/{0}-details/' || {1}"

SQL = {
    "q_load_events": f"SELECT {_id('event_id')} AS event_id, {_t('event_name')}, CASE WHEN regexp_full_match(trim(date_formatted), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast(trim(date_formatted) AS DATE) END AS event_date, {_t('city')}, {_t('state')}, {_t('country')}, coalesce({_T.format('event_status')}, 'completed') AS event_status, coalesce(source_url, '') AS source_url, {_AT} FROM fight_events",
    "q_load_fighters": f"SELECT {_id('fighter_id')} AS fighter_id, {_t('full_name')}, {_t('first_name')}, {_t('last_name')}, {_t('nickname')}, height_cm, weight_lbs, reach_cm, {_t('stance')}, dob, coalesce(source_url, '') AS source_url, {_AT} FROM fighters",
    "q_load_fights": f"""SELECT {_id('fight_id')} AS fight_id, {_id('event_id')} AS event_id, {_F1} AS fighter_1_id, {_F2} AS fighter_2_id, CASE WHEN {_W} = {_F1} OR {_W} = {_F2} THEN {_W} END AS winner_fighter_id, {_RESULT},
 CASE WHEN weight_class IN ('women_strawweight', 'women_flyweight', 'women_bantamweight', 'women_featherweight', 'light_heavyweight', 'super_heavyweight', 'heavyweight', 'featherweight', 'lightweight', 'welterweight', 'middleweight', 'bantamweight', 'flyweight', 'strawweight', 'open_weight', 'catch_weight') THEN weight_class END AS weight_class,
 coalesce(is_title_fight, false) AS is_title_fight, coalesce(is_interim_title, false) AS is_interim_title, scheduled_rounds, CASE WHEN finish_method IN ('decision', 'ko_tko', 'submission', 'doctor_stoppage', 'overturned', 'could_not_continue', 'dq', 'other') THEN finish_method WHEN lower(trim(finish_method)) IN ('decision', 'submission', 'dq', 'overturned', 'other') THEN lower(trim(finish_method)) WHEN lower(trim(finish_method)) = 'ko/tko' THEN 'ko_tko' WHEN lower(trim(finish_method)) = 'could not continue' THEN 'could_not_continue' WHEN lower(trim(finish_method)) = 'tko - doctor''s stoppage' THEN 'doctor_stoppage' END AS finish_method,
 {_t('finish_detail')}, finish_round, nullif(finish_time_seconds, 0) AS finish_time_seconds, {_t('referee')}, coalesce(source_url, '') AS source_url, {_AT} FROM fights WHERE {_KNOWN_EVENT}""",
    "q_load_stats": f"SELECT {_id('fight_stat_id')} AS fight_stat_id, {_id('fight_id')} AS fight_id, {_id('fighter_id')} AS fighter_id, {', '.join(f'coalesce({c}, 0)::SMALLINT AS {c}' for c in L.COUNTERS)}, coalesce(source_url, '') AS source_url, {_AT} FROM fight_stats_aggregate WHERE {_KNOWN_FIGHT}",
    "q_load_rounds": f"SELECT {_id('fight_stat_id')} || '-' || r AS fight_stat_by_round_id, {_id('fight_id')} AS fight_id, {_id('fighter_id')} AS fighter_id, r::SMALLINT AS round, {', '.join(f'(coalesce({c}, 0) // 3)::SMALLINT AS {c}' for c in L.COUNTERS)}, coalesce(source_url, '') AS source_url, {_AT} FROM fight_stats_aggregate, (VALUES (1), (2), (3)) v(r) WHERE {_KNOWN_FIGHT}",
    "q_load_skipped": " UNION ALL ".join(f"SELECT '{k}' AS kind, count(*) * {n} AS read, count(*) FILTER (WHERE NOT coalesce({cond}, false)) * {n} AS skipped FROM {t}" for k, t, cond, n in (("fights", "fights", _KNOWN_EVENT, 1), ("fight_stats", "fight_stats_aggregate", _KNOWN_FIGHT, 1), ("fight_stats_by_round", "fight_stats_aggregate", _KNOWN_FIGHT, 3))),
    "q_page_fights": f"""SELECT url, ok, CASE WHEN ok THEN {_uuid5('url')} END AS fight_id, CASE WHEN ok THEN {_uuid5(_LINK.format('event', 'event_id'))} END AS event_id, CASE WHEN ok THEN {_uuid5(_LINK.format('fighter', 'fighter_1_id'))} END AS fighter_1_id, CASE WHEN ok THEN res END AS result_type, CASE WHEN ok THEN weight_class END AS weight_class, CASE WHEN ok THEN scheduled_rounds::INT END AS rounds, CASE WHEN ok THEN {_OFF('referee')} END AS referee, CASE WHEN ok THEN {_OFF('judge_1')} END AS judge_1, CASE WHEN ok THEN coalesce(finish_time_seconds, 0)::INT END AS seconds
FROM (SELECT *, {_LINK.format('fight', 'fight_id')} AS url, scheduled_rounds IS NOT NULL AND coalesce(trim(referee), '') <> '' AS ok, {_RESULT.replace('AS result_type', 'AS res')} FROM fights WHERE coalesce(fight_id, '') <> '' AND coalesce(event_id, '') <> '' AND coalesce(fighter_1_id, '') <> '' AND coalesce(fighter_2_id, '') <> '')""",
    "q_page_fighters": f"""SELECT {_LINK.format('fighter', 'fighter_id')} AS url, ok, CASE WHEN ok THEN nm END AS full_name, CASE WHEN ok THEN nullif({_WS.format('nickname')}, '') END AS nickname, CASE WHEN ok THEN floor(weight_lbs)::INT END AS weight, CASE WHEN ok THEN nullif({_WS.format('stance')}, '') END AS stance, CASE WHEN ok THEN dob END AS dob FROM (SELECT *, {_OFF('full_name')} AS nm, {_OFF('full_name')} <> '' AS ok FROM fighters WHERE fighter_id IS NOT NULL)""",
}
