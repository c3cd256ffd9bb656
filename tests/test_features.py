import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from priorview.operators import features as X
from priorview.operators import quality as Q
from priorview.operators.elo import sequential_ratings
from priorview.operators.history import participants, prior_last, prior_streaks, prior_sums

FIGHT = "fight_id string, event_id string, fighter_1_id string, fighter_2_id string, winner_fighter_id string, result_type string, weight_class string, is_title_fight boolean, scheduled_rounds smallint, finish_method string, finish_round smallint, finish_time_seconds smallint, scraped_at timestamp"
CARD = "event_id string, event_date date, scraped_at timestamp"
STAT = "fight_stat_id string, fight_id string, fighter_id string, sig_strikes_landed smallint, sig_strikes_attempted smallint, takedowns_landed smallint, takedowns_attempted smallint, submissions_attempted smallint, knockdowns smallint, control_time_seconds smallint, scraped_at timestamp"
WHO = "fighter_id string, height_cm decimal(5,2), reach_cm decimal(5,2), weight_lbs decimal(5,1), dob date, stance string, scraped_at timestamp"
T0 = datetime(2021, 1, 1)


def fight(i, day, a, b, winner, result="win", method="decision", rnd=3, secs=300, title=False, rounds=3):
    return (f"f{i}", f"e{day}", a, b, winner, result, "lightweight", title, rounds, method, rnd, secs, T0)


def frames(spark, fights, stats=(), who=()):
    cards = [(e, date.fromisoformat(e[1:]), T0) for e in sorted({f[1] for f in fights})]
    rows = [(f"s{i}", f, p, *m, T0) for i, (f, p, *m) in enumerate(stats)]
    return spark.createDataFrame(fights, FIGHT), spark.createDataFrame(cards, CARD), spark.createDataFrame(rows, STAT), spark.createDataFrame([(*w, T0) for w in who], WHO)


def sides(spark, fights, stats=()):
    return participants(*frames(spark, fights, stats)[:3])


def row(df, fight_id, fighter):
    return df.filter((F.col("fight_id") == fight_id) & (F.col("fighter_id") == fighter)).first()


def test_career_of_four_bouts(spark):
    fs = [fight(1, "2020-01-01", "a", "b", "a", method="ko_tko", rnd=2, secs=150), fight(2, "2020-02-01", "c", "a", "c"), fight(3, "2020-03-01", "a", "d", None, "draw"), fight(4, "2020-04-01", "a", "b", "a", method="submission", rnd=1, secs=240, title=True), fight(5, "2020-05-01", "a", "d", "d")]
    r = row(X.career(sides(spark, fs)), "f5", "a")
    assert (r.total_fights, r.wins, r.losses, r.draws, r.no_contests, r.ko_tko_wins, r.sub_wins, r.dec_losses, r.title_wins) == (4, 2, 1, 1, 0, 1, 1, 1, 1)
    assert r.total_cage_time_seconds == 2490 and r.win_rate == 0.5 and r.finish_rate == 1.0 and r.current_win_streak == 1 and r.current_lose_streak == 0
    debut = row(X.career(sides(spark, fs)), "f1", "a")
    assert debut.total_fights == 0 and debut.win_rate is None and debut.career_sig_strike_accuracy is None and debut.current_win_streak == 0


def test_bouts_of_the_same_day_do_not_count(spark):
    fs = [fight(1, "2020-01-01", "a", "b", "a"), fight(2, "2020-01-01", "a", "c", "a"), fight(3, "2020-01-02", "a", "b", "b")]
    c = X.career(sides(spark, fs))
    assert [row(c, f"f{i}", "a").total_fights for i in (1, 2, 3)] == [0, 0, 2]
    assert row(X.rolling(sides(spark, fs)), "f3", "a").last1_wins == 1


def test_rolling_takes_what_there_is(spark):
    fs = [fight(i, f"2020-01-{i:02d}", "a", f"o{i}", "a" if i > 6 else f"o{i}", method="ko_tko", rnd=1, secs=60) for i in range(1, 12)]
    r = X.rolling(sides(spark, fs))
    last, second, debut = row(r, "f11", "a"), row(r, "f2", "a"), row(r, "f1", "a")
    assert (last.last5_wins, last.last1_wins, last.last5_finish_rate, last.has_5_fights) == (4, 1, 0.8, True)
    assert (second.last3_wins, second.has_3_fights, second.last3_finish_rate) == (0, False, 0.0)
    assert debut.last3_wins == 0 and debut.last3_finish_rate is None and not debut.has_1_fights


def test_half_life_and_partial_stats(spark):
    fs = [fight(1, "2020-01-01", "a", "b", "b"), fight(2, "2020-12-31", "a", "b", "a"), fight(3, "2021-01-01", "a", "b", "a")]
    r = row(X.decayed(sides(spark, fs, [("f2", "a", 10, 20, 1, 2, 0, 0, 30)])), "f3", "a")
    assert r.decay_win_rate == pytest.approx(1 / 1.5) and r.decay_sig_strike_accuracy == 0.5 and r.decay_sig_strike_rate == pytest.approx(10 / 15)
    with pytest.raises(ValueError):
        X.decay_sums(1.0)


def test_ratings(spark):
    b = spark.createDataFrame([("f1", 1, "a", "b", "a", "win"), ("f2", 2, "a", "b", None, "nc"), ("f3", 3, "a", "c", None, "draw"), ("f4", 3, "a", "b", "x", "win"), ("f5", 4, "a", "b", "b", "win")], "fight_id string, day int, fighter_1_id string, fighter_2_id string, winner_fighter_id string, result_type string")
    e = {(r.fight_id, r.fighter_id): r.pre_elo for r in sequential_ratings(b).collect()}
    assert e["f1", "a"] == 1500 and e["f2", "a"] == 1516 and e["f2", "b"] == 1484 and e["f3", "a"] == 1516
    assert e["f4", "a"] < 1516 and e["f5", "a"] == e["f4", "a"] and e["f4", "a"] + 1484 + (1500 + 1516 - e["f4", "a"]) == pytest.approx(4500)
    assert sequential_ratings(b.limit(0)).count() == 0 and sequential_ratings(b, pool="result_type").count() == 10


def test_opponent_adjusted(spark):
    fs = [fight(1, "2020-01-01", "c", "b", "c"), fight(2, "2020-06-01", "a", "b", "a"), fight(3, "2021-01-01", "a", "c", "a")]
    st = [("f1", "c", 30, 60, 2, 4, 0, 0, 120), ("f1", "b", 1, 2, 0, 0, 0, 0, 0), ("f2", "a", 60, 90, 3, 4, 0, 0, 180), ("f2", "b", 1, 2, 0, 0, 0, 0, 0)]
    f, c, s, _ = frames(spark, fs, st)
    o = X.opponent_adjusted(X.rated_sums(participants(f, c, s), X.ratings(f, c)))
    r = row(o, "f3", "a")
    assert (r.opp_adjusted_sig_strike_rate, r.opp_adjusted_takedown_rate, r.opp_adjusted_control_rate, r.avg_opponent_win_rate) == (2.0, 1.5, 1.5, 0.0)
    assert row(o, "f1", "c").opp_adjusted_sig_strike_rate is None


def test_snapshots_bouts_and_audit(spark):
    fs = [fight(1, "2019-01-01", "a", "b", "a"), fight(2, "2020-01-02", "a", "b", "b"), fight(3, "2020-01-02", "c", "d", None, "draw")]
    who = [("a", "180", "185", "155", date(1990, 1, 1), " Orthodox"), ("b", "180", "0", "155", None, "southpaw")]
    f, c, s, w = frames(spark, fs, [], [(k, __import__("decimal").Decimal(h), __import__("decimal").Decimal(r), __import__("decimal").Decimal(x), d, t) for k, h, r, x, d, t in who])
    snap = X.snapshots(f, c, s, w)
    r = row(snap, "f2", "a")
    assert r.days_since_last_fight == 366 and r.is_long_layoff and r.stance == "orthodox" and r.elo_change_last_fight == 16.0
    assert row(snap, "f2", "b").reach_to_height_ratio is None and row(snap, "f3", "c").height_missing
    wide, pair = X.snapshot_table(snap), X.bout_table(snap)
    assert len(wide.columns) == 101 and len(pair.columns) == 36
    b = {x.fight_id: x for x in pair.collect()}
    assert b["f2"].label == 0 and float(b["f2"].diff_elo) == 32.0 and b["f2"].is_orthodox_vs_southpaw and b["f3"].label is None and b["f3"].both_debuting and b["f3"].ratio_career_wins is None
    other = {x.fight_id: x for x in X.bout_pairs(snap).collect()}
    assert other["f2"].stance_matchup == "orthodox_vs_southpaw" and other["f3"].stance_matchup is None and other["f3"].is_reach_advantage_a is None
    assert [x.failures for x in Q.leakage_audit(snap, participants(f, c, s), pair).collect()] == [0, 0, 0, 0]


def test_empty_tables(spark):
    f, c, s, w = (x.limit(0) for x in frames(spark, [fight(1, "2020-01-01", "a", "b", "a")], [("f1", "a", 1, 1, 1, 1, 1, 1, 1)], [("a", None, None, None, None, None)]))
    assert X.bout_table(X.snapshots(f, c, s, w)).count() == 0


def test_prior_helpers_match_brute_force(spark):
    r = random.Random(11)
    data = [(f"e{r.randrange(4)}", r.randrange(25), f"x{i:03d}", r.random() < 0.6, r.randrange(10)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, day int, seq string, ok boolean, v int")
    sums = {(x.k, x.day): x.v for x in prior_sums(df, "k", "day", {"v": F.col("v")}).collect()}
    runs = {(x.k, x.day): x.run for x in prior_streaks(df, "k", "day", "seq", {"run": F.col("ok")}).collect()}
    last = {(x.k, x.day): [b.seq for b in x["last"]] for x in prior_last(df, "k", "day", "seq", {"v": F.col("v")}, 3, "last").collect()}
    for k, day in {d[:2] for d in data}:
        before = sorted([d for d in data if d[0] == k and d[1] < day], key=lambda d: (d[1], d[2]))
        run = 0
        while run < len(before) and before[-1 - run][3]:
            run += 1
        assert (sums[k, day] or 0) == sum(d[4] for d in before) and runs[k, day] == run and last[k, day] == [d[2] for d in before[-3:]]


def test_a_registered_family_is_computed_like_the_others(spark):
    X.register("titles", lambda: {"t": X._n(F.col("is_title_fight")), "n": F.lit(1)}, lambda: {"title_share": F.col("t") / F.col("n")})
    try:
        p = sides(spark, [fight(1, "2020-01-01", "a", "b", "a", title=True), fight(2, "2020-02-01", "a", "b", "a"), fight(3, "2020-03-01", "a", "b", "b")])
        f = X.family(p, "titles")
        assert row(f, "f3", "a").title_share == 0.5 and row(f, "f1", "a").title_share is None
        assert row(X.family(p, "career"), "f3", "a").wins == row(X.career(p), "f3", "a").wins == 2
    finally:
        del X.FAMILIES["titles"]
