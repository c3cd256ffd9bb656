"""Feature families of each side of a bout, from what was known before its day.

Each family can be had by itself. ``snapshots`` takes all of them from one pass over an entity's days
(``prior_state``) and one join back, and the opponent-adjusted ones from a second; ``bout_table`` pairs the two sides.
Families are listed in ``FAMILIES``; ``register`` adds one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows
from priorview.functions.scalars import rate, share
from priorview.operators.elo import sequential_ratings
from priorview.operators.history import bouts, participants, prior_last, prior_state, prior_sums
from priorview.session import materialise

KEYS = ["fighter_id", "day"]
KO = ("ko_tko", "doctor_stoppage")
#: Half-lives below this would take weights out of a double's range within a few decades.
SHORTEST_HALF_LIFE = 30.0
DAY_ZERO = 12784  # 2005-01-01: weights are relative, any day does


def _n(c: Column) -> Column:
    return F.when(c, 1).otherwise(0)


def career_sums() -> dict[str, Column]:
    decided = F.col("result_type") == "win"
    win, loss, m = decided & F.col("won"), decided & ~F.col("won"), F.col("finish_method")
    out = {
        "n": F.lit(1), "wins": _n(win), "losses": _n(loss), "draws": _n(F.col("result_type") == "draw"), "ncs": _n(F.col("result_type") == "nc"),
        "ko_w": _n(win & m.isin(*KO)), "sub_w": _n(win & (m == "submission")), "dec_w": _n(win & (m == "decision")),
        "ko_l": _n(loss & m.isin(*KO)), "sub_l": _n(loss & (m == "submission")), "dec_l": _n(loss & (m == "decision")),
        "title": _n(F.col("is_title_fight")), "title_w": _n(F.col("is_title_fight") & F.col("won")), "five": _n(F.col("scheduled_rounds") == 5), "won_n": _n(F.col("won")),
        "secs": F.coalesce("dur", F.lit(0.0)), "first_day": None, "last_day": None,
    }
    out |= {f"m_{k}": F.coalesce(F.col(f"my.{k}"), F.lit(0)) for k in ("sig_l", "sig_a", "td_l", "td_a", "sub", "kd", "ctrl")}
    out |= {f"o_{k}": F.coalesce(F.col(f"opp.{k}"), F.lit(0)) for k in ("sig_l", "sig_a", "td_l", "td_a", "ctrl")}
    return {k: v for k, v in out.items() if v is not None}


def decay_sums(half_life: float) -> dict[str, Column]:
    """Weighted sums u*v and u per metric, u = 2^((day - zero) / half_life): the cutoff's factor cancels in their ratio."""
    if half_life < SHORTEST_HALF_LIFE:
        raise ValueError(f"half_life_days must be at least {SHORTEST_HALF_LIFE}")
    u = F.pow(F.lit(2.0), (F.col("day") - DAY_ZERO) / half_life)
    my = lambda k: F.col(f"my.{k}").cast("double")
    minutes = F.when(F.col("dur") > 0, F.col("dur") / 60)
    finish = F.col("won") & F.coalesce(F.col("finish_method").isin(*KO, "submission"), F.lit(False))
    values = {
        "sig_strike_rate": my("sig_l") / minutes, "sig_strike_accuracy": rate(my("sig_l"), my("sig_a")), "takedown_rate": my("td_l") / minutes * 15, "takedown_accuracy": rate(my("td_l"), my("td_a")),
        "control_time_per_fight": my("ctrl"), "knockdowns_per_fight": my("kd"), "win_rate": _n(F.col("won")).cast("double"), "finish_rate": _n(finish).cast("double"),
    }
    return {f"uv_{k}": u * v for k, v in values.items()} | {f"u_{k}": F.when(v.isNotNull(), u) for k, v in values.items()}


DECAYED = ("sig_strike_rate", "sig_strike_accuracy", "takedown_rate", "takedown_accuracy", "control_time_per_fight", "knockdowns_per_fight", "win_rate", "finish_rate")


def career_features() -> dict[str, Column]:
    """Over the career sums of earlier bouts; counts are 0 and rates null without any. Rates per minute divide by the
    time of all earlier bouts, also of those without stats."""
    c = lambda k: F.coalesce(F.col(k), F.lit(0))
    minutes = c("secs") / 60.0
    counts = {"total_fights": "n", "wins": "wins", "losses": "losses", "draws": "draws", "no_contests": "ncs", "ko_tko_wins": "ko_w", "sub_wins": "sub_w", "dec_wins": "dec_w", "ko_tko_losses": "ko_l", "sub_losses": "sub_l", "dec_losses": "dec_l", "title_fights": "title", "title_wins": "title_w"}
    return {k: c(v).cast("int") for k, v in counts.items()} | {
        "win_rate": rate(c("wins"), c("n")), "ko_tko_win_rate": rate(c("ko_w"), c("n")), "sub_win_rate": rate(c("sub_w"), c("n")), "dec_win_rate": rate(c("dec_w"), c("n")),
        "finish_rate": rate(c("ko_w") + c("sub_w"), c("wins")), "total_cage_time_seconds": c("secs").cast("double"), "avg_fight_time_seconds": rate(c("secs"), c("n")),
        "career_sig_strikes_landed_per_min": rate(c("m_sig_l"), minutes), "career_sig_strikes_absorbed_per_min": rate(c("o_sig_l"), minutes),
        "career_sig_strike_accuracy": rate(c("m_sig_l"), c("m_sig_a")), "career_sig_strike_defense": 1 - rate(c("o_sig_l"), c("o_sig_a")),
        "career_takedown_accuracy": rate(c("m_td_l"), c("m_td_a")), "career_takedown_defense": 1 - rate(c("o_td_l"), c("o_td_a")),
        "career_takedowns_per_15min": rate(c("m_td_l"), minutes / 15), "career_submissions_per_15min": rate(c("m_sub"), minutes / 15),
        "career_knockdowns_per_fight": rate(c("m_kd"), c("n")), "career_control_time_per_fight": rate(c("m_ctrl"), c("n")),
    }


def decay_features() -> dict[str, Column]:
    return {f"decay_{k}": rate(F.col(f"uv_{k}"), F.col(f"u_{k}")) for k in DECAYED}


def physical_features(last_day: str = "last_day", first_day: str = "first_day") -> dict[str, Column]:
    """Profile and activity; days since the last bout and layoff are null and false at a debut."""
    days = F.col("day") - F.col(last_day)
    reach, tall = (F.col(c).cast("double") for c in ("reach_cm", "height_cm"))
    age = F.datediff("event_date", "dob") / F.lit(365.25)
    n = F.coalesce("n", F.lit(0))
    return {
        "height_cm": tall, "reach_cm": reach, "weight_lbs": F.col("weight_lbs").cast("double"), "reach_to_height_ratio": rate(F.nullif(reach, F.lit(0.0)), tall),
        "age_at_fight": age, "age_squared": age * age, "stance": F.nullif(F.lower(F.trim("stance")), F.lit("")), "is_debut": n == 0,
        "days_since_last_fight": days, "is_long_layoff": F.coalesce(days > 365, F.lit(False)), "fights_per_year": F.when(n > 0, rate(n, (F.col("day") - F.col(first_day)) / F.lit(365.25))),
        "fight_count": n.cast("int"), "five_round_experience": F.coalesce("five", F.lit(0)).cast("int"), "title_fight_experience": F.coalesce("title", F.lit(0)).cast("int"),
        "dob_missing": F.col("dob").isNull(), "height_missing": F.col("height_cm").isNull(), "reach_missing": F.col("reach_cm").isNull(),
    }


def rolling_features(windows: tuple[int, ...] = (1, 3, 5), last: str = "last") -> dict[str, Column]:
    """Over the last N earlier bouts, as many as there are; ``has_N_fights`` tells whether there are N."""
    out = {}
    every = F.col(last)  # an empty array at a debut
    for n in windows:
        own = F.when(F.size(every) <= n, every).otherwise(F.slice(every, -n, n))
        total = lambda k, own=own: F.aggregate(own, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[k].cast("double"), F.lit(0.0)))
        size, minutes = F.size(own), total("dur") / 60.0
        out |= {
            f"last{n}_wins": total("won").cast("int"), f"last{n}_finish_rate": rate(total("fin"), size),
            f"last{n}_sig_strikes_landed_per_min": rate(total("sig_l"), minutes), f"last{n}_sig_strikes_absorbed_per_min": rate(total("o_sig_l"), minutes),
            f"last{n}_sig_strike_accuracy": rate(total("sig_l"), total("sig_a")), f"last{n}_takedown_accuracy": rate(total("td_l"), total("td_a")),
            f"last{n}_control_time_per_fight": rate(total("ctrl"), size), f"last{n}_knockdowns_per_fight": rate(total("kd"), size), f"has_{n}_fights": F.size(every) >= n,
        }
    return out


def _recent() -> dict[str, Column]:
    fin = F.col("won") & F.coalesce(F.col("finish_method").isin(*KO, "submission"), F.lit(False))
    my = lambda k: F.coalesce(F.col(f"my.{k}"), F.lit(0)).cast("int")
    return {"won": _n(F.col("won")), "fin": _n(fin), "dur": F.col("dur"), "sig_l": my("sig_l"), "sig_a": my("sig_a"), "o_sig_l": F.coalesce(F.col("opp.sig_l"), F.lit(0)).cast("int"), "td_l": my("td_l"), "td_a": my("td_a"), "ctrl": my("ctrl"), "kd": my("kd")}


def with_sums(p: DataFrame, sums: dict[str, Column]) -> DataFrame:
    return p.join(prior_sums(p, "fighter_id", "day", sums), KEYS)


def career(p: DataFrame) -> DataFrame:
    """(fight_id, fighter_id, career family, current streaks)."""
    lost = (F.col("result_type") == "win") & ~F.col("won")
    rows = p.join(prior_state(p, "fighter_id", "day", "fight_id", career_sums(), {"current_win_streak": F.col("won"), "current_lose_streak": lost}, {}, 0), KEYS)
    return rows.select("fight_id", "fighter_id", *[e.alias(k) for k, e in career_features().items()], *[F.col(c).cast("int").alias(c) for c in ("current_win_streak", "current_lose_streak")])


def rolling(p: DataFrame, windows: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    rows = p.join(prior_last(p, "fighter_id", "day", "fight_id", _recent(), max(windows), "last"), KEYS)
    return rows.select("fight_id", "fighter_id", *[e.alias(k) for k, e in rolling_features(windows).items()])


def decayed(p: DataFrame, half_life_days: float = 365.0) -> DataFrame:
    return with_sums(p, decay_sums(half_life_days)).select("fight_id", "fighter_id", *[e.alias(k) for k, e in decay_features().items()])


def profiles(fighters: DataFrame) -> DataFrame:
    return current_rows(fighters, "fighter_id", ["fighter_id", "height_cm", "reach_cm", "weight_lbs", "dob", "stance"])


@dataclass(frozen=True)
class Family:
    """A feature family: what is summed over each earlier bout, and the features made of those sums (null without any)."""

    sums: Callable[[], dict[str, Column]]
    features: Callable[[], dict[str, Column]]


FAMILIES: dict[str, Family] = {"career": Family(career_sums, career_features), "decay": Family(lambda: decay_sums(365.0), decay_features)}


def register(name: str, sums: Callable[[], dict[str, Column]], features: Callable[[], dict[str, Column]]) -> None:
    """Adds a family, or takes the place of one of that name."""
    FAMILIES[name] = Family(sums, features)


def family(p: DataFrame, name: str) -> DataFrame:
    """(fight_id, fighter_id, features) of a registered family over participants."""
    f = FAMILIES[name]
    return with_sums(p, f.sums()).select("fight_id", "fighter_id", *[e.alias(k) for k, e in f.features().items()])


def physical(p: DataFrame, fighters: DataFrame) -> DataFrame:
    state = prior_state(p, "fighter_id", "day", "fight_id", {k: career_sums()[k] for k in ("n", "five", "title")}, {}, {}, 0)
    rows = p.join(state, KEYS).join(profiles(fighters), "fighter_id", "left")
    return rows.select("fight_id", "fighter_id", *[e.alias(k) for k, e in physical_features().items()])


def with_opponent(w: DataFrame) -> DataFrame:
    """Adds ``x``, the other side's state before the bout, from its own row of it (two rows a bout, no join)."""
    state, of_bout = F.struct("n", "won_n", "secs", "o_sig_l", "o_td_l", "o_ctrl", "pre_elo"), Window.partitionBy("fight_id")
    side = lambda i: F.max(F.when(F.col("side") == i, state)).over(of_bout)
    return w.withColumn("x", F.when(F.col("side") == 1, side(2)).otherwise(side(1)))


_ADJUSTED = ("opp_adjusted_sig_strike_rate", "opp_adjusted_takedown_rate", "opp_adjusted_control_rate", "avg_opponent_elo", "avg_opponent_win_rate")


def _adjusted_sums() -> dict[str, Column]:
    """Of each bout the own rate, relative to what that opponent had conceded before it, and the opponent's rating and win rate."""
    x = lambda k: F.col(f"x.{k}")
    minutes, theirs = F.when(F.col("dur") > 0, F.col("dur") / 60), F.nullif(x("secs") / 60, F.lit(0.0))
    mine = lambda k: F.col(f"my.{k}").cast("double")
    above = lambda c: F.when(c > 0, c)
    values = dict(zip(_ADJUSTED, (
        mine("sig_l") / minutes / above(x("o_sig_l") / theirs), mine("td_l") / minutes / above(x("o_td_l") / theirs), F.when(minutes.isNotNull(), mine("ctrl")) / above(x("o_ctrl") / F.nullif(x("n"), F.lit(0))),
        x("pre_elo"), x("won_n") / F.nullif(x("n"), F.lit(0)),
    )))
    return {f"s_{k}": v.cast("double") for k, v in values.items()} | {f"c_{k}": F.when(v.isNotNull(), 1) for k, v in values.items()}


def _adjusted_features() -> dict[str, Column]:
    return {k: rate(F.col(f"s_{k}"), F.col(f"c_{k}")) for k in _ADJUSTED}


def opponent_adjusted(w: DataFrame) -> DataFrame:
    """(fight_id, fighter_id, ratios): means over earlier bouts of the own rate there, relative to what that opponent had
    conceded before it, and of the opponents' ratings and win rates. w: participants with ``pre_elo`` and their prior career sums.
    """
    prior = prior_sums(with_opponent(w), "fighter_id", "day", _adjusted_sums())
    return w.select("fight_id", *KEYS).join(prior, KEYS).select("fight_id", "fighter_id", *[e.alias(k) for k, e in _adjusted_features().items()])


def ratings(fights: DataFrame, cards: DataFrame, k: float = 32.0, initial: float = 1500.0) -> DataFrame:
    return sequential_ratings(bouts(fights, cards), k, initial)


def rated_sums(p: DataFrame, elo: DataFrame, half_life_days: float = 365.0) -> DataFrame:
    """Participants with rating and all prior sums, written once: the passes that follow read it."""
    rows = with_sums(p, career_sums() | decay_sums(half_life_days)).join(elo, ["fight_id", "fighter_id"])
    return materialise(rows, "participants")


def snapshots(fights: DataFrame, cards: DataFrame, stats: DataFrame, fighters: DataFrame, windows: tuple[int, ...] = (1, 3, 5), half_life_days: float = 365.0) -> DataFrame:
    """One wide row for each side of each bout: all families over the bouts before its day."""
    p = materialise(participants(fights, cards, stats), "sides")
    one = p.filter("side = 1").select("fight_id", "day", F.col("fighter_id").alias("fighter_1_id"), F.col("opponent_id").alias("fighter_2_id"), "winner_fighter_id", "result_type")
    rated = p.join(sequential_ratings(one), ["fight_id", "fighter_id"])
    lost = (F.col("result_type") == "win") & ~F.col("won")
    streaks = {"current_win_streak": F.col("won"), "current_lose_streak": lost}
    state = prior_state(rated, "fighter_id", "day", "fight_id", career_sums() | decay_sums(half_life_days), streaks, _recent() | {"pre_elo": F.col("pre_elo")}, max(windows))
    w = materialise(with_opponent(rated.join(state, KEYS)), "participants")
    rows = w.join(prior_sums(w, "fighter_id", "day", _adjusted_sums()), KEYS).join(profiles(fighters), "fighter_id", "left")
    families = career_features() | rolling_features(windows) | decay_features() | physical_features()
    elo = {"pre_fight_elo": F.col("pre_elo"), "opponent_pre_fight_elo": F.col("x.pre_elo"), "elo_change_last_fight": F.col("pre_elo") - F.try_element_at("last", F.lit(-1))["pre_elo"]}
    kept = ["fight_id", "fighter_id", "opponent_id", "side", F.col("event_date").alias("as_of_date"), "weight_class", "is_title_fight", "scheduled_rounds", "result_type", "won"]
    return rows.select(*kept, *[e.alias(k) for k, e in (families | elo).items()], "current_win_streak", "current_lose_streak", *[e.alias(k) for k, e in _adjusted_features().items()])


_ROLLED = {"finish_rate": "finish_rate", "sig_strikes_landed_pm": "sig_strikes_landed_per_min", "sig_strikes_absorbed_pm": "sig_strikes_absorbed_per_min", "sig_strike_accuracy": "sig_strike_accuracy", "takedown_accuracy": "takedown_accuracy", "control_rate": "control_time_per_fight", "knockdowns_pm": "knockdowns_per_fight"}
_PLACEHOLDERS = ("sig_strike_defense", "takedown_landed_pm", "takedown_defense", "knockdowns_absorbed_pm", "sub_attempts_pm", "avg_fight_time", "streak")


def _window_win_rate(n: int) -> Column:
    return rate(F.col(f"last{n}_wins"), F.least(F.lit(n), F.col("total_fights")))


def stored(e: Column, kind: str) -> Column:
    """``e`` as a sink's type. Noise of the last digits is rounded off first, so that the order in which doubles were
    summed can't turn a tie the other way. A value that the type can't hold (typed measures reach 999.99, so their
    differences may leave decimal(5,2)) is null."""
    return (F.round(e.cast("double"), 9) if kind.startswith("decimal") else e).try_cast(kind)


def snapshot_table(s: DataFrame) -> DataFrame:
    """Snapshots as the table ``fighter_snapshots`` has them: names, types (decimals rounded half up; too large a value
    is null), and the columns that nothing computes as typed nulls. Without computed_at, which a sink adds."""
    small = lambda c: F.col(c).try_cast("smallint")
    dec = lambda e, p, q: stored(e, f"decimal({p},{q})")
    none = lambda kind: F.lit(None).cast(kind)
    out = {"fighter_id": F.col("fighter_id"), "fight_id": F.col("fight_id"), "as_of_date": F.col("as_of_date"), "feature_version": F.lit(1).cast("smallint")}
    out |= {f"career_{k}": small(v) for k, v in {"fights": "total_fights", "wins": "wins", "losses": "losses", "draws": "draws", "nc": "no_contests"}.items()}
    out |= {"career_win_rate": dec(F.col("win_rate"), 6, 4), "career_finish_rate": dec(F.col("finish_rate"), 6, 4)}
    out |= {f"career_{k}": small(k) for k in ("ko_tko_wins", "sub_wins", "dec_wins", "ko_tko_losses", "sub_losses", "title_fights", "title_wins")}
    out |= {"career_minutes": dec(F.col("total_cage_time_seconds") / 60, 8, 2)}
    out |= {f"career_{k}": dec(F.col(f"career_{v}"), p, 4) for k, v, p in (("sig_strikes_landed_pm", "sig_strikes_landed_per_min", 8), ("sig_strikes_absorbed_pm", "sig_strikes_absorbed_per_min", 8), ("sig_strike_accuracy", "sig_strike_accuracy", 6), ("sig_strike_defense", "sig_strike_defense", 6), ("takedown_accuracy", "takedown_accuracy", 6), ("takedown_defense", "takedown_defense", 6), ("sub_attempts_pm", "submissions_per_15min", 8), ("control_rate", "control_time_per_fight", 8), ("knockdowns_pm", "knockdowns_per_fight", 8))}
    for n in (1, 3, 5):
        out[f"win_rate_last{n}"] = dec(_window_win_rate(n), 6, 4)
        out |= {f"{k}_last{n}": dec(F.col(f"last{n}_{v}"), 6 if k in ("finish_rate", "sig_strike_accuracy", "takedown_accuracy") else 8, 4) for k, v in _ROLLED.items()}
        out |= {f"{k}_last{n}": none("smallint" if k == "streak" else "decimal(6,2)" if k == "avg_fight_time" else "decimal(6,4)" if k.endswith("defense") else "decimal(8,4)") for k in _PLACEHOLDERS}
    out |= {f"{k}_decay": dec(F.col(f"decay_{v}"), p, 4) for k, v, p in (("sig_strikes_landed_pm", "sig_strike_rate", 8), ("sig_strike_accuracy", "sig_strike_accuracy", 6), ("takedown_landed_pm", "takedown_rate", 8), ("takedown_accuracy", "takedown_accuracy", 6), ("control_rate", "control_time_per_fight", 8), ("knockdowns_pm", "knockdowns_per_fight", 8), ("win_rate", "win_rate", 6))}
    out |= {"sig_strikes_absorbed_pm_decay": none("decimal(8,4)"), "sig_strike_defense_decay": none("decimal(6,4)"), "takedown_defense_decay": none("decimal(6,4)")}
    out |= {"age": dec(F.col("age_at_fight"), 5, 2), "age_squared": dec(F.col("age_squared"), 8, 2), "height_cm": dec(F.col("height_cm"), 5, 2), "reach_cm": dec(F.col("reach_cm"), 5, 2), "reach_to_height": F.expr("try_cast(reach_to_height_ratio as decimal(6,4))")}
    flag = lambda c: F.coalesce(c, F.lit(False))
    out |= {"is_orthodox": flag(F.col("stance") == "orthodox"), "is_southpaw": flag(F.col("stance") == "southpaw"), "days_since_last_fight": small("days_since_last_fight"), "is_long_layoff": F.col("is_long_layoff"), "is_short_notice": F.lit(False), "is_debut": F.col("is_debut"), "age_missing": F.col("dob_missing"), "height_reach_missing": F.col("height_missing") | F.col("reach_missing")}
    out |= {"elo_rating": dec(F.coalesce("pre_fight_elo", F.lit(1500.0)), 8, 2), "elo_opponent": dec(F.col("opponent_pre_fight_elo"), 8, 2), "elo_diff": dec(F.col("pre_fight_elo") - F.col("opponent_pre_fight_elo"), 8, 2), "opp_avg_elo": dec(F.col("avg_opponent_elo"), 8, 2), "opp_adj_sig_strike_accuracy": dec(F.col("opp_adjusted_sig_strike_rate"), 8, 4)}
    return s.select(*[e.alias(k) for k, e in out.items()])


def _sides(s: DataFrame) -> DataFrame:
    """Both snapshots of a bout side by side: structs a and b."""
    pair = s.groupBy("fight_id").agg(*[F.max(F.when(F.col("side") == i, F.struct(*[c for c in s.columns if c not in ("fight_id", "side")]))).alias(n) for i, n in ((1, "a"), (2, "b"))])
    return pair.filter("a is not null and b is not null")


def _label() -> Column:
    return F.when(F.col("a.result_type") == "win", F.when(F.col("a.won"), 1).when(F.col("b.won"), 0))


def _bout_keys() -> list[Column]:
    return [F.col("fight_id"), F.col("a.fighter_id").alias("fighter_1_id"), F.col("b.fighter_id").alias("fighter_2_id"), F.col("a.as_of_date").alias("event_date"), F.col("a.weight_class").alias("weight_class"), F.col("a.is_title_fight").alias("is_title_fight"), F.col("a.scheduled_rounds").alias("scheduled_rounds"), _label().cast("smallint").alias("label"), F.lit(1).cast("smallint").alias("feature_version")]


def bout_table(s: DataFrame) -> DataFrame:
    """One row a bout: differences and shares of the two sides' unrounded features, as the table ``bout_features`` has them."""
    d = lambda c: F.col(f"a.{c}") - F.col(f"b.{c}")
    diffs = {
        "elo": ("pre_fight_elo", "decimal(8,2)"), "career_wins": ("wins", "smallint"), "career_fights": ("total_fights", "smallint"), "career_win_rate": ("win_rate", "decimal(6,4)"), "career_finish_rate": ("finish_rate", "decimal(6,4)"),
        "career_sig_strikes_landed_pm": ("career_sig_strikes_landed_per_min", "decimal(8,4)"), "career_sig_strike_accuracy": ("career_sig_strike_accuracy", "decimal(6,4)"), "career_takedown_accuracy": ("career_takedown_accuracy", "decimal(6,4)"), "career_control_rate": ("career_control_time_per_fight", "decimal(8,4)"),
        "age": ("age_at_fight", "decimal(5,2)"), "height_cm": ("height_cm", "decimal(5,2)"), "reach_cm": ("reach_cm", "decimal(5,2)"), "days_since_last_fight": ("days_since_last_fight", "smallint"),
        "sig_strikes_landed_pm_last3": ("last3_sig_strikes_landed_per_min", "decimal(8,4)"), "takedown_accuracy_last3": ("last3_takedown_accuracy", "decimal(6,4)"), "control_rate_last3": ("last3_control_time_per_fight", "decimal(8,4)"),
        "sig_strikes_landed_pm_decay": ("decay_sig_strike_rate", "decimal(8,4)"), "win_rate_decay": ("decay_win_rate", "decimal(6,4)"), "opp_avg_elo": ("avg_opponent_elo", "decimal(8,2)"),
    }
    shares = {"career_wins": "wins", "career_fights": "total_fights", "career_sig_strikes_landed_pm": "career_sig_strikes_landed_per_min", "career_control_rate": "career_control_time_per_fight", "elo": "pre_fight_elo"}
    last3 = lambda x: rate(F.col(f"{x}.last3_wins"), F.least(F.lit(3), F.col(f"{x}.total_fights")))
    stances = lambda x, y: (F.col("a.stance") == x) & (F.col("b.stance") == y)
    return _sides(s).select(
        *_bout_keys(), *[stored(d(c), k).alias(f"diff_{n}") for n, (c, k) in diffs.items()], stored(last3("a") - last3("b"), "decimal(6,4)").alias("diff_win_rate_last3"),
        *[stored(share(F.col(f"a.{c}"), F.col(f"b.{c}")), "decimal(6,4)").alias(f"ratio_{n}") for n, c in shares.items()],
        F.coalesce(stances("orthodox", "southpaw") | stances("southpaw", "orthodox"), F.lit(False)).alias("is_orthodox_vs_southpaw"), (F.col("a.is_debut") & F.col("b.is_debut")).alias("both_debuting"),
    )


def bout_pairs(s: DataFrame) -> DataFrame:
    """The other pairing of the two sides: nine differences, four shares, three matchup flags and the label, unrounded."""
    diffs = {"age_diff": "age_at_fight", "height_diff": "height_cm", "reach_diff": "reach_cm", "elo_diff": "pre_fight_elo", "win_rate_diff": "win_rate", "career_sig_strike_rate_diff": "career_sig_strikes_landed_per_min", "career_takedown_rate_diff": "career_takedown_accuracy", "career_control_time_diff": "career_control_time_per_fight", "experience_diff": "fight_count"}
    shares = {"experience_ratio": "fight_count", "win_rate_ratio": "win_rate", "sig_strike_accuracy_ratio": "career_sig_strike_accuracy", "takedown_accuracy_ratio": "career_takedown_accuracy"}
    a, b = F.col("a.stance"), F.col("b.stance")
    return _sides(s).select(
        *_bout_keys(), *[(F.col(f"a.{c}") - F.col(f"b.{c}")).alias(n) for n, c in diffs.items()], *[share(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(n) for n, c in shares.items()],
        F.when(a.isNotNull() & b.isNotNull(), F.concat(F.least(a, b), F.lit("_vs_"), F.greatest(a, b))).alias("stance_matchup"),
        (F.col("a.reach_cm") > F.col("b.reach_cm")).alias("is_reach_advantage_a"), (F.coalesce(F.col("a.fight_count"), F.lit(0)) > F.coalesce(F.col("b.fight_count"), F.lit(0))).alias("is_experience_advantage_a"),
    )
