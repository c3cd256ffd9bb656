"""Queries of the feature families, and their SQL: each family as a join of every bout with all earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.operators import features as X
from priorview.operators.history import participants
from priorview.plans.general import _current, _id
from priorview.session import table
from priorview.sources.tables import scan


def _sides(spark: SparkSession, d: str) -> DataFrame:
    return participants(*[scan(spark, d, t) for t in ("fights", "fight_events", "fight_stats_aggregate")])


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(*[F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return X.snapshots(*[scan(spark, d, t) for t in ("fights", "fight_events", "fight_stats_aggregate", "fighters")])


def q_participants(spark: SparkSession, d: str) -> DataFrame:
    p = _sides(spark, d)
    return p.select("fight_id", "fighter_id", "opponent_id", "event_date", "won", "is_title_fight", "dur", F.col("my").isNotNull().alias("has_my_stats"), F.col("opp").isNotNull().alias("has_opp_stats"), F.col("my.sig_l").alias("my_sig_l"), F.col("opp.sig_l").alias("opp_sig_l"))


def q_career(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.career(_sides(spark, d)))


def q_rolling(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.rolling(_sides(spark, d)))


def q_rolling_windows(spark: SparkSession, d: str) -> DataFrame:
    """The rolling family over other windows: two and seven bouts."""
    return _rounded(X.rolling(_sides(spark, d), (2, 7)))


def q_decay(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.decayed(_sides(spark, d)))


def q_physical(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.physical(_sides(spark, d), table(spark, d, "fighters")))


def q_elo(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.ratings(table(spark, d, "fights"), table(spark, d, "fight_events")))


def q_elo_change(spark: SparkSession, d: str) -> DataFrame:
    """Both ratings before a bout, and how the own one has changed since before the bout before."""
    return _rounded(_snapshots(spark, d).select("fight_id", "fighter_id", "pre_fight_elo", "opponent_pre_fight_elo", "elo_change_last_fight"))


def q_opponent(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.opponent_adjusted(X.rated_sums(_sides(spark, d), X.ratings(table(spark, d, "fights"), table(spark, d, "fight_events")))))


def q_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """All columns of the snapshot table but computed_at."""
    return X.snapshot_table(_snapshots(spark, d))


def q_bouts(spark: SparkSession, d: str) -> DataFrame:
    return X.bout_table(_snapshots(spark, d))


def q_bout_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.bout_pairs(_snapshots(spark, d)))


QUERIES = {f.__name__: f for f in (q_participants, q_career, q_rolling, q_rolling_windows, q_decay, q_physical, q_elo, q_elo_change, q_opponent, q_snapshots, q_bouts, q_bout_pairs)}

_METRICS = {"sig_l": "sig_strikes_landed", "sig_a": "sig_strikes_attempted", "td_l": "takedowns_landed", "td_a": "takedowns_attempted", "sub": "submissions_attempted", "kd": "knockdowns", "ctrl": "control_time_seconds"}
_DUR = "CASE WHEN finish_method = 'decision' THEN scheduled_rounds * 300.0 ELSE coalesce((finish_round - 1) * 300.0 + finish_time_seconds, scheduled_rounds * 300.0) END"
_BASE = f"""cards AS {_current('fight_events', 'event_id')}, fi AS {_current('fights', 'fight_id')},
b AS (SELECT fi.k AS fight_id, {_id('fi.fighter_1_id')} AS f1, {_id('fi.fighter_2_id')} AS f2, {_id('fi.winner_fighter_id')} AS w, c.event_date AS d, fi.result_type AS res, fi.finish_method AS m, fi.scheduled_rounds AS rounds, fi.weight_class, coalesce(fi.is_title_fight, false) AS title, CAST({_DUR.replace('finish_', 'fi.finish_').replace('scheduled_', 'fi.scheduled_')} AS DOUBLE) AS dur
 FROM fi JOIN cards c ON c.k = {_id('fi.event_id')} WHERE c.event_date IS NOT NULL AND {_id('fi.fighter_1_id')} <> {_id('fi.fighter_2_id')}),
st AS (SELECT * FROM (SELECT {_id('fight_id')} AS sf, {_id('fighter_id')} AS sp, {', '.join(f'coalesce({c}, 0)::INT AS {k}' for k, c in _METRICS.items())}, row_number() OVER (PARTITION BY {_id('fight_id')}, {_id('fighter_id')} ORDER BY scraped_at DESC NULLS LAST, fight_stat_id DESC) AS rn FROM fight_stats_aggregate) WHERE rn = 1),
u AS (SELECT *, f1 AS me, f2 AS ot, 1 AS side FROM b UNION ALL SELECT *, f2, f1, 2 FROM b),
p AS (SELECT u.*, coalesce(u.w = u.me, false) AS won, x.sf IS NOT NULL AS has_my, y.sf IS NOT NULL AS has_opp, {', '.join(f'x.{k} AS my_{k}, y.{k} AS op_{k}' for k in _METRICS)} FROM u LEFT JOIN st x ON x.sf = u.fight_id AND x.sp = u.me LEFT JOIN st y ON y.sf = u.fight_id AND y.sp = u.ot)"""


def _div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def _sum(x: str) -> str:
    return f"coalesce(sum({x}), 0)"


def _cnt(x: str) -> str:
    return f"count(*) FILTER (WHERE h.fight_id IS NOT NULL AND ({x}))::INT"


_WIN, _LOSS, _KOS = "h.res = 'win' AND h.won", "h.res = 'win' AND NOT h.won", "h.m IN ('ko_tko', 'doctor_stoppage')"
_MIN = f"({_sum('h.dur')} / 60.0)"
_N = _cnt("true")
_CAREER = {
    "total_fights": _N, "wins": _cnt(_WIN), "losses": _cnt(_LOSS), "draws": _cnt("h.res = 'draw'"), "no_contests": _cnt("h.res = 'nc'"),
    "ko_tko_wins": _cnt(f"{_WIN} AND {_KOS}"), "sub_wins": _cnt(f"{_WIN} AND h.m = 'submission'"), "dec_wins": _cnt(f"{_WIN} AND h.m = 'decision'"), "ko_tko_losses": _cnt(f"{_LOSS} AND {_KOS}"), "sub_losses": _cnt(f"{_LOSS} AND h.m = 'submission'"), "dec_losses": _cnt(f"{_LOSS} AND h.m = 'decision'"),
    "title_fights": _cnt("h.title"), "title_wins": _cnt("h.title AND h.won"),
    "win_rate": _div(_cnt(_WIN), _N), "ko_tko_win_rate": _div(_cnt(f"{_WIN} AND {_KOS}"), _N), "sub_win_rate": _div(_cnt(f"{_WIN} AND h.m = 'submission'"), _N), "dec_win_rate": _div(_cnt(f"{_WIN} AND h.m = 'decision'"), _N), "finish_rate": _div(_cnt(f"{_WIN} AND ({_KOS} OR h.m = 'submission')"), _cnt(_WIN)),
    "total_cage_time_seconds": f"{_sum('h.dur')}::DOUBLE", "avg_fight_time_seconds": _div(_sum("h.dur"), _N),
    "career_sig_strikes_landed_per_min": _div(_sum("h.my_sig_l"), _MIN), "career_sig_strikes_absorbed_per_min": _div(_sum("h.op_sig_l"), _MIN), "career_sig_strike_accuracy": _div(_sum("h.my_sig_l"), _sum("h.my_sig_a")), "career_sig_strike_defense": f"1 - {_div(_sum('h.op_sig_l'), _sum('h.op_sig_a'))}",
    "career_takedown_accuracy": _div(_sum("h.my_td_l"), _sum("h.my_td_a")), "career_takedown_defense": f"1 - {_div(_sum('h.op_td_l'), _sum('h.op_td_a'))}", "career_takedowns_per_15min": _div(_sum("h.my_td_l"), f"{_MIN} / 15"), "career_submissions_per_15min": _div(_sum("h.my_sub"), f"{_MIN} / 15"), "career_knockdowns_per_fight": _div(_sum("h.my_kd"), _N), "career_control_time_per_fight": _div(_sum("h.my_ctrl"), _N),
}


def _round(cols: dict[str, str]) -> str:
    exact = {"total_fights", "wins", "losses", "draws", "no_contests"}
    return ", ".join(f"{e} AS {k}" if k in exact or "::INT" in e[-6:] else f"round({e}, 6) AS {k}" for k, e in cols.items())


_HIST = "FROM p t LEFT JOIN p h ON h.me = t.me AND h.d < t.d GROUP BY t.fight_id, t.me"
_STREAK = """(SELECT count(*) FROM p z WHERE z.me = t.me AND z.d < t.d AND NOT EXISTS (SELECT 1 FROM p q WHERE q.me = t.me AND q.d < t.d AND NOT ({c}) AND (q.d > z.d OR (q.d = z.d AND q.fight_id >= z.fight_id))))"""


def _lists(k: str, n: int) -> str:
    return f"coalesce(list_sum(list_transform(list_slice(l, -{n}, -1), lambda x: x.{k})), 0)"


def _rolled(n: int) -> str:
    size, minutes = f"least({n}, len(coalesce(l, [])))", f"({_lists('dur', n)} / 60.0)"
    cols = {"sig_strikes_landed_per_min": _div(_lists("sl", n), minutes), "sig_strikes_absorbed_per_min": _div(_lists("ol", n), minutes), "sig_strike_accuracy": _div(_lists("sl", n), _lists("sa", n)), "takedown_accuracy": _div(_lists("tl", n), _lists("ta", n)), "control_time_per_fight": _div(_lists("ct", n), size), "knockdowns_per_fight": _div(_lists("kd", n), size), "finish_rate": _div(_lists("fin", n), size)}
    return f"CAST({_lists('won', n)} AS INT) AS last{n}_wins, " + ", ".join(f"round({e}, 6) AS last{n}_{k}" for k, e in cols.items()) + f", len(coalesce(l, [])) >= {n} AS has_{n}_fights"


_ROLL = f"""WITH {_BASE}, h AS (SELECT t.fight_id, t.me, list(struct_pack(dur := coalesce(h.dur, 0), won := h.won::INT, fin := (h.won AND coalesce(h.m IN ('ko_tko', 'doctor_stoppage', 'submission'), false))::INT, sl := coalesce(h.my_sig_l, 0), sa := coalesce(h.my_sig_a, 0), ol := coalesce(h.op_sig_l, 0), tl := coalesce(h.my_td_l, 0), ta := coalesce(h.my_td_a, 0), ct := coalesce(h.my_ctrl, 0), kd := coalesce(h.my_kd, 0)) ORDER BY h.d, h.fight_id) FILTER (WHERE h.fight_id IS NOT NULL) AS l {_HIST})
SELECT fight_id, me AS fighter_id, {', '.join(_rolled(n) for n in (1, 3, 5))} FROM h"""

_MINS = "(CASE WHEN h.dur > 0 THEN h.dur / 60.0 END)"
_VALUES = {"sig_strike_rate": f"h.my_sig_l / {_MINS}", "sig_strike_accuracy": _div("h.my_sig_l", "h.my_sig_a"), "takedown_rate": f"h.my_td_l / {_MINS} * 15", "takedown_accuracy": _div("h.my_td_l", "h.my_td_a"), "control_time_per_fight": "h.my_ctrl::DOUBLE", "knockdowns_per_fight": "h.my_kd::DOUBLE", "win_rate": "h.won::INT::DOUBLE", "finish_rate": "(h.won AND coalesce(h.m IN ('ko_tko', 'doctor_stoppage', 'submission'), false))::INT::DOUBLE"}
_U = "pow(2.0, -date_diff('day', h.d, t.d) / 365.0)"
_DEC = ", ".join(f"round(sum({_U} * ({v})) / sum(CASE WHEN ({v}) IS NOT NULL THEN {_U} END), 6) AS decay_{k}" for k, v in _VALUES.items())

_ELO = """num AS (SELECT *, row_number() OVER (ORDER BY d, fight_id) AS i FROM b), ids AS (SELECT f, row_number() OVER (ORDER BY f) AS j FROM (SELECT f1 AS f FROM b UNION SELECT f2 FROM b)),
nb AS (SELECT n.i, n.fight_id, n.f1, n.f2, x.j AS ja, y.j AS jb, CASE WHEN n.res = 'nc' THEN NULL WHEN n.res = 'draw' THEN 0.5 WHEN n.w = n.f1 THEN 1.0 WHEN n.w = n.f2 THEN 0.0 END::DOUBLE AS s FROM num n JOIN ids x ON x.f = n.f1 JOIN ids y ON y.f = n.f2),
fold AS (SELECT 0::BIGINT AS i, list_transform(range((SELECT count(*) FROM ids)), lambda v: 1500.0::DOUBLE) AS r, NULL::DOUBLE AS pa, NULL::DOUBLE AS pb
 UNION ALL SELECT nb.i, CASE WHEN nb.s IS NULL THEN fold.r ELSE list_transform(fold.r, lambda v, k: CASE WHEN k = nb.ja THEN v + 32 * (nb.s - 1 / (1 + pow(10.0, (fold.r[nb.jb] - fold.r[nb.ja]) / 400.0))) WHEN k = nb.jb THEN v - 32 * (nb.s - 1 / (1 + pow(10.0, (fold.r[nb.jb] - fold.r[nb.ja]) / 400.0))) ELSE v END) END, fold.r[nb.ja], fold.r[nb.jb] FROM fold JOIN nb ON nb.i = fold.i + 1),
elo AS (SELECT nb.fight_id, nb.f1 AS fighter_id, fold.pa AS pre_elo FROM fold JOIN nb USING (i) UNION ALL SELECT nb.fight_id, nb.f2, fold.pb FROM fold JOIN nb USING (i))"""

_OPP = f"""s AS (SELECT t.fight_id, t.me, {_N} AS n, {_cnt('h.won')} AS wn, {_sum('h.dur')} / 60.0 AS mins, {_sum('h.op_sig_l')} AS sl, {_sum('h.op_td_l')} AS tl, {_sum('h.op_ctrl')} AS ct {_HIST}),
j AS (SELECT p.*, p.my_sig_l / (CASE WHEN p.dur > 0 THEN p.dur / 60.0 END) / CASE WHEN s.sl > 0 THEN s.sl / nullif(s.mins, 0) END AS r1, p.my_td_l / (CASE WHEN p.dur > 0 THEN p.dur / 60.0 END) / CASE WHEN s.tl > 0 THEN s.tl / nullif(s.mins, 0) END AS r2, CASE WHEN p.dur > 0 THEN p.my_ctrl END / CASE WHEN s.ct > 0 THEN s.ct / s.n::DOUBLE END AS r3, e.pre_elo AS r4, s.wn / nullif(s.n, 0)::DOUBLE AS r5 FROM p JOIN s ON s.fight_id = p.fight_id AND s.me = p.ot JOIN elo e ON e.fight_id = p.fight_id AND e.fighter_id = p.ot)
SELECT t.fight_id, t.me AS fighter_id, {', '.join(f'round(avg(h.r{i}), 6) AS {k}' for i, k in enumerate(('opp_adjusted_sig_strike_rate', 'opp_adjusted_takedown_rate', 'opp_adjusted_control_rate', 'avg_opponent_elo', 'avg_opponent_win_rate'), 1))} FROM p t LEFT JOIN j h ON h.me = t.me AND h.d < t.d GROUP BY t.fight_id, t.me"""

_ACT = f"SELECT t.fight_id, t.me, any_value(t.d) AS d, {_N} AS n, {_cnt('h.rounds = 5')} AS five, {_cnt('h.title')} AS ti, min(h.d) AS d0, max(h.d) AS d1 {_HIST}"
_PHY = f"""SELECT fight_id, me AS fighter_id, round(height_cm::DOUBLE, 6) AS height_cm, round(reach_cm::DOUBLE, 6) AS reach_cm, round(weight_lbs::DOUBLE, 6) AS weight_lbs, round({_div('nullif(reach_cm, 0)', 'height_cm')}, 6) AS reach_to_height_ratio,
 round(date_diff('day', dob, d) / 365.25, 6) AS age_at_fight, round(pow(date_diff('day', dob, d) / 365.25, 2), 6) AS age_squared, nullif(lower(trim(stance)), '') AS stance, n = 0 AS is_debut, date_diff('day', d1, d)::INT AS days_since_last_fight, coalesce(date_diff('day', d1, d) > 365, false) AS is_long_layoff,
 round(n / nullif(date_diff('day', d0, d) / 365.25, 0), 6) AS fights_per_year, n AS fight_count, five AS five_round_experience, ti AS title_fight_experience, dob IS NULL AS dob_missing, height_cm IS NULL AS height_missing, reach_cm IS NULL AS reach_missing FROM act LEFT JOIN f ON f.k = act.me"""

SQL = {
    "q_participants": f"WITH {_BASE} SELECT fight_id, me AS fighter_id, ot AS opponent_id, d AS event_date, won, title AS is_title_fight, dur, has_my AS has_my_stats, has_opp AS has_opp_stats, my_sig_l, op_sig_l AS opp_sig_l FROM p",
    "q_career": f"WITH {_BASE} SELECT t.fight_id, t.me AS fighter_id, {_round(_CAREER)}, {_STREAK.format(c='q.won')}::INT AS current_win_streak, {_STREAK.format(c=chr(39).join(('q.res = ', 'win', ' AND NOT q.won')))}::INT AS current_lose_streak FROM p t LEFT JOIN p h ON h.me = t.me AND h.d < t.d GROUP BY t.fight_id, t.me, t.d",
    "q_rolling": _ROLL,
    "q_rolling_windows": _ROLL.rsplit("\n", 1)[0] + f"\nSELECT fight_id, me AS fighter_id, {', '.join(_rolled(n) for n in (2, 7))} FROM h",
    "q_decay": f"WITH {_BASE} SELECT t.fight_id, t.me AS fighter_id, {_DEC} {_HIST}",
    "q_physical": f"WITH {_BASE}, f AS {_current('fighters', 'fighter_id')}, act AS ({_ACT}) {_PHY}",
    "q_elo": f"WITH RECURSIVE {_BASE}, {_ELO} SELECT fight_id, fighter_id, round(pre_elo, 6) AS pre_elo FROM elo",
    "q_elo_change": f"WITH RECURSIVE {_BASE}, {_ELO}, r AS (SELECT p.fight_id, p.me, p.ot, p.d, elo.pre_elo FROM p JOIN elo ON elo.fight_id = p.fight_id AND elo.fighter_id = p.me) SELECT t.fight_id, t.me AS fighter_id, round(any_value(t.pre_elo), 6) AS pre_fight_elo, round(any_value(o.pre_elo), 6) AS opponent_pre_fight_elo, round(any_value(t.pre_elo) - (max(struct_pack(d := h.d, f := h.fight_id, x := h.pre_elo)) FILTER (WHERE h.me IS NOT NULL)).x, 6) AS elo_change_last_fight FROM r t JOIN r o ON o.fight_id = t.fight_id AND o.me = t.ot LEFT JOIN r h ON h.me = t.me AND h.d < t.d GROUP BY t.fight_id, t.me",
    "q_opponent": f"WITH RECURSIVE {_BASE}, {_ELO}, {_OPP}",
}


def _exact(sql: str) -> str:
    """A family's SQL without the rounding that is for comparison only."""
    return sql.replace("round(", "(").replace(", 6) AS", ") AS")


def _body(name: str) -> str:
    """The last SELECT of a family, whose tables ``_BASE`` has."""
    return _exact(SQL[name].split(f"{_BASE} ", 1)[1])


_WIDE = f"""WITH RECURSIVE {_BASE}, {_ELO}, f AS {_current('fighters', 'fighter_id')},
car AS ({_body('q_career')}), dec AS ({_body('q_decay')}), h0 AS {_exact(_ROLL.split(', h AS ', 1)[1].rsplit(chr(10), 1)[0])}, rol AS ({_exact(_ROLL.rsplit(chr(10), 1)[1]).replace(' FROM h', ' FROM h0')}),
act AS ({_ACT}), phy AS ({_exact(_PHY)}),
{_exact(_OPP.split(chr(10), 1)[0]).replace('s AS (', 'sx AS (', 1)}
{_exact(_OPP.split(chr(10))[1]).replace(' JOIN s ON', ' JOIN sx s ON')}, opp AS ({_exact(_OPP.split(chr(10))[2])}),
w AS (SELECT p.side, p.d AS as_of_date, p.weight_class, p.title, p.rounds, p.res, p.won, p.ot, car.*, dec.* EXCLUDE (fight_id, fighter_id), rol.* EXCLUDE (fight_id, fighter_id), phy.* EXCLUDE (fight_id, fighter_id), opp.* EXCLUDE (fight_id, fighter_id), e1.pre_elo, e2.pre_elo AS opp_elo
 FROM p JOIN car ON car.fight_id = p.fight_id AND car.fighter_id = p.me JOIN dec ON dec.fight_id = p.fight_id AND dec.fighter_id = p.me JOIN rol ON rol.fight_id = p.fight_id AND rol.fighter_id = p.me JOIN phy ON phy.fight_id = p.fight_id AND phy.fighter_id = p.me JOIN opp ON opp.fight_id = p.fight_id AND opp.fighter_id = p.me
 JOIN elo e1 ON e1.fight_id = p.fight_id AND e1.fighter_id = p.me JOIN elo e2 ON e2.fight_id = p.fight_id AND e2.fighter_id = p.ot)"""


def _d(e: str, p: int, q: int) -> str:
    return f"TRY_CAST(round(({e})::DOUBLE, 9) AS DECIMAL({p},{q}))"


def _snapshot_sql() -> str:
    c = {"fighter_id": "fighter_id", "fight_id": "fight_id", "as_of_date": "as_of_date", "feature_version": "1"}
    c |= {"career_fights": "total_fights", "career_wins": "wins", "career_losses": "losses", "career_draws": "draws", "career_nc": "no_contests", "career_win_rate": _d("win_rate", 6, 4), "career_finish_rate": _d("finish_rate", 6, 4), "career_minutes": _d("total_cage_time_seconds / 60", 8, 2)}
    c |= {f"career_{k}": k for k in ("ko_tko_wins", "sub_wins", "dec_wins", "ko_tko_losses", "sub_losses", "title_fights", "title_wins")}
    c |= {f"career_{k}": _d(f"career_{v}", 8, 4) for k, v in (("sig_strikes_landed_pm", "sig_strikes_landed_per_min"), ("sig_strikes_absorbed_pm", "sig_strikes_absorbed_per_min"), ("sub_attempts_pm", "submissions_per_15min"), ("control_rate", "control_time_per_fight"), ("knockdowns_pm", "knockdowns_per_fight"))}
    c |= {f"career_{k}": _d(f"career_{k}", 6, 4) for k in ("sig_strike_accuracy", "sig_strike_defense", "takedown_accuracy", "takedown_defense")}
    for n in (1, 3, 5):
        c[f"win_rate_last{n}"] = _d(f"last{n}_wins::DOUBLE / nullif(least({n}, total_fights), 0)", 6, 4)
        for k, v in (("finish_rate", "finish_rate"), ("sig_strikes_landed_pm", "sig_strikes_landed_per_min"), ("sig_strikes_absorbed_pm", "sig_strikes_absorbed_per_min"), ("sig_strike_accuracy", "sig_strike_accuracy"), ("takedown_accuracy", "takedown_accuracy"), ("control_rate", "control_time_per_fight"), ("knockdowns_pm", "knockdowns_per_fight")):
            c[f"{k}_last{n}"] = _d(f"last{n}_{v}", 8, 4)
        c |= {f"{k}_last{n}": "NULL" for k in ("sig_strike_defense", "takedown_landed_pm", "takedown_defense", "knockdowns_absorbed_pm", "sub_attempts_pm", "avg_fight_time", "streak")}
    c |= {f"{k}_decay": _d(f"decay_{v}", 8, 4) for k, v in (("sig_strikes_landed_pm", "sig_strike_rate"), ("sig_strike_accuracy", "sig_strike_accuracy"), ("takedown_landed_pm", "takedown_rate"), ("takedown_accuracy", "takedown_accuracy"), ("control_rate", "control_time_per_fight"), ("knockdowns_pm", "knockdowns_per_fight"), ("win_rate", "win_rate"))}
    c |= {f"{k}_decay": "NULL" for k in ("sig_strikes_absorbed_pm", "sig_strike_defense", "takedown_defense")}
    c |= {"age": _d("age_at_fight", 5, 2), "age_squared": _d("age_squared", 8, 2), "height_cm": _d("height_cm", 5, 2), "reach_cm": _d("reach_cm", 5, 2), "reach_to_height": "TRY_CAST(reach_to_height_ratio AS DECIMAL(6,4))", "is_orthodox": "coalesce(stance = 'orthodox', false)", "is_southpaw": "coalesce(stance = 'southpaw', false)"}
    c |= {"days_since_last_fight": "days_since_last_fight", "is_long_layoff": "is_long_layoff", "is_short_notice": "false", "is_debut": "is_debut", "age_missing": "dob_missing", "height_reach_missing": "height_missing OR reach_missing"}
    c |= {"elo_rating": _d("pre_elo", 8, 2), "elo_opponent": _d("opp_elo", 8, 2), "elo_diff": _d("pre_elo - opp_elo", 8, 2), "opp_avg_elo": _d("avg_opponent_elo", 8, 2), "opp_adj_sig_strike_accuracy": _d("opp_adjusted_sig_strike_rate", 8, 4)}
    return f"{_WIDE} SELECT {', '.join(f'{e} AS {k}' for k, e in c.items())} FROM w"


_BOUT_KEYS = "a.fight_id, a.fighter_id AS fighter_1_id, b.fighter_id AS fighter_2_id, a.as_of_date AS event_date, a.weight_class, a.title AS is_title_fight, a.rounds AS scheduled_rounds, CASE WHEN a.res = 'win' AND a.won THEN 1 WHEN a.res = 'win' AND b.won THEN 0 END AS label, 1 AS feature_version"
_TWO = "FROM w a JOIN w b ON a.fight_id = b.fight_id AND a.side = 1 AND b.side = 2"


def _bout_sql() -> str:
    d = {"elo": ("pre_elo", 8, 2), "career_wins": ("wins", 0, 0), "career_fights": ("total_fights", 0, 0), "career_win_rate": ("win_rate", 6, 4), "career_finish_rate": ("finish_rate", 6, 4), "career_sig_strikes_landed_pm": ("career_sig_strikes_landed_per_min", 8, 4), "career_sig_strike_accuracy": ("career_sig_strike_accuracy", 6, 4), "career_takedown_accuracy": ("career_takedown_accuracy", 6, 4), "career_control_rate": ("career_control_time_per_fight", 8, 4), "age": ("age_at_fight", 5, 2), "height_cm": ("height_cm", 5, 2), "reach_cm": ("reach_cm", 5, 2), "days_since_last_fight": ("days_since_last_fight", 0, 0), "sig_strikes_landed_pm_last3": ("last3_sig_strikes_landed_per_min", 8, 4), "takedown_accuracy_last3": ("last3_takedown_accuracy", 6, 4), "control_rate_last3": ("last3_control_time_per_fight", 8, 4), "sig_strikes_landed_pm_decay": ("decay_sig_strike_rate", 8, 4), "win_rate_decay": ("decay_win_rate", 6, 4), "opp_avg_elo": ("avg_opponent_elo", 8, 2)}
    r = {"career_wins": "wins", "career_fights": "total_fights", "career_sig_strikes_landed_pm": "career_sig_strikes_landed_per_min", "career_control_rate": "career_control_time_per_fight", "elo": "pre_elo"}
    cols = [f"{_d(f'a.{c} - b.{c}', p, q) if p else f'a.{c} - b.{c}'} AS diff_{k}" for k, (c, p, q) in d.items()]
    cols += [f"{_d('a.last3_wins::DOUBLE / nullif(least(3, a.total_fights), 0) - b.last3_wins::DOUBLE / nullif(least(3, b.total_fights), 0)', 6, 4)} AS diff_win_rate_last3"]
    cols += [f"{_d(f'a.{c}::DOUBLE / nullif(a.{c} + b.{c}, 0)', 6, 4)} AS ratio_{k}" for k, c in r.items()]
    flags = "coalesce((a.stance = 'orthodox' AND b.stance = 'southpaw') OR (a.stance = 'southpaw' AND b.stance = 'orthodox'), false) AS is_orthodox_vs_southpaw, a.is_debut AND b.is_debut AS both_debuting"
    return f"{_WIDE} SELECT {_BOUT_KEYS}, {', '.join(cols)}, {flags} {_TWO}"


def _pair_sql() -> str:
    d = {"age_diff": "age_at_fight", "height_diff": "height_cm", "reach_diff": "reach_cm", "elo_diff": "pre_elo", "win_rate_diff": "win_rate", "career_sig_strike_rate_diff": "career_sig_strikes_landed_per_min", "career_takedown_rate_diff": "career_takedown_accuracy", "career_control_time_diff": "career_control_time_per_fight", "experience_diff": "fight_count"}
    r = {"experience_ratio": "fight_count", "win_rate_ratio": "win_rate", "sig_strike_accuracy_ratio": "career_sig_strike_accuracy", "takedown_accuracy_ratio": "career_takedown_accuracy"}
    cols = [f"round(a.{c} - b.{c}, 6) AS {k}" for k, c in d.items()] + [f"round(a.{c}::DOUBLE / nullif(a.{c} + b.{c}, 0), 6) AS {k}" for k, c in r.items()]
    return f"{_WIDE} SELECT {_BOUT_KEYS}, {', '.join(cols)}, CASE WHEN a.stance IS NOT NULL AND b.stance IS NOT NULL THEN least(a.stance, b.stance) || '_vs_' || greatest(a.stance, b.stance) END AS stance_matchup, a.reach_cm > b.reach_cm AS is_reach_advantage_a, a.fight_count > b.fight_count AS is_experience_advantage_a {_TWO}"


SQL |= {"q_snapshots": _snapshot_sql(), "q_bouts": _bout_sql(), "q_bout_pairs": _pair_sql()}
