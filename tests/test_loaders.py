from datetime import date, datetime
from decimal import Decimal

import pytest

from priorview.operators import loaders as L
from priorview.operators.pages import read_pages_as
from tests.test_pages import U, stats_page


def raw(spark, kind, *rows):
    return spark.createDataFrame([tuple(r.get(c, "") for c in L.RAW[kind]) + ("x",) for r in rows], ", ".join(f"`{c}` string" for c in [*L.RAW[kind], "extra"]))


def test_events(spark):
    r = {"event_id": " E1 ", "name": " Card ", "date_formatted": "2026-03-18", "city": "Paris", "country": "", "url": "u", "scraped_at": "2026-03-18 10:20:30 UTC"}
    a, b = L.event_rows(raw(spark, "events", r, r | {"event_status": "upcoming", "scraped_at": ""})).collect()
    assert tuple(a) == ("e1", "Card", date(2026, 3, 18), "Paris", None, None, "completed", "u", datetime(2026, 3, 18, 10, 20, 30)) and (b.event_status, b.scraped_at) == ("upcoming", None)
    bad = raw(spark, "events", r | {"date_formatted": "March 18"})
    assert L.event_rows(bad, strict=False).first().event_date is None
    with pytest.raises(Exception, match="March 18"):
        L.event_rows(bad).collect()


def test_fights(spark):
    r = {"fight_id": "F", "event_id": "E", "fighter_1_id": "A", "fighter_2_id": "B", "bout_type": "Women's Flyweight Title Bout", "num_rounds": "5", "primary_finish_method": "TKO - Doctor's Stoppage", "secondary_finish_method": "", "finish_round": "", "finish_time_minute": "0", "finish_time_second": "0"}
    got = L.fight_rows(raw(spark, "fights", *[r | {"fighter_1_outcome": x, "fighter_2_outcome": y} for x, y in (("W", "L"), ("L", "W"), ("D", "D"), ("NC", "NC"), ("W", "W"))], r | {"num_rounds": "", "finish_round": "2", "finish_time_minute": "4", "finish_time_second": "59", "bout_type": "Interim Title Bout"})).collect()
    assert [(g.result_type, g.winner_fighter_id) for g in got] == [("win", "a"), ("win", "b"), ("draw", None), ("nc", None), ("nc", None), ("nc", None)]
    assert (got[0].weight_class, got[0].is_title_fight, got[0].is_interim_title, got[0].scheduled_rounds, got[0].finish_method, got[0].finish_round, got[0].finish_time_seconds, got[0].finish_detail) == ("women_flyweight", True, False, 5, "doctor_stoppage", None, None, None)
    assert (got[5].weight_class, got[5].is_interim_title, got[5].scheduled_rounds, got[5].finish_round, got[5].finish_time_seconds) == (None, True, None, 2, 299)
    assert len(got[0]) == 17 and L.fight_rows(raw(spark, "fights", r | {"num_rounds": "many"}), strict=False).first().scheduled_rounds is None


def test_fighters_and_stats(spark):
    f = L.fighter_rows(raw(spark, "fighters", {"fighter_id": "A", "full_name": " Ana  Silva ", "last_names": "Silva", "height_cm": "182.88", "weight_lbs": "", "dob_formatted": "1990-07-02"})).first()
    assert (f.full_name, f.last_name, f.height_cm, f.weight_lbs, f.dob, len(f)) == ("Ana  Silva", "Silva", Decimal("182.88"), None, date(1990, 7, 2), 12)
    s = {"fight_id": "F", "fighter_id": "A", "significant_strikes_landed_head": "7", "control_time_minutes": "3", "control_time_seconds": "21", "takedowns_landed": " "}
    a = L.stat_rows(raw(spark, "fight_stats", s | {"fight_stat_id": "S"})).first()
    assert (a.fight_stat_id, a.sig_strikes_head_landed, a.control_time_seconds, a.takedowns_landed, a.reversals, len(a)) == ("s", 7, 201, 0, 0, 27)
    b = L.stat_rows(raw(spark, "fight_stats_by_round", s | {"fight_stat_by_round_id": "R", "round": "2"}), by_round=True).first()
    assert (b.fight_stat_by_round_id, b.round, b.sig_strikes_head_landed) == ("r", 2, 7)


def test_rows_of_unknown_records_are_kept_apart(spark, rows):
    child = spark.createDataFrame([("1", "E1 "), ("2", "e9"), ("3", None), ("4", "e1")], "id string, event_id string")
    kept, skipped = L.known_only(child, "event_id", spark.createDataFrame([("e1",), ("E1",), (None,)], "event_id string"), "event_id")
    assert rows(kept, "id") == [("1",), ("4",)] and rows(skipped, "id") == [("2",), ("3",)]


def test_pages_become_rows(spark):
    pages = spark.createDataFrame([(U, stats_page(2)), ("bad", "")], "url string, html string")
    stats = L.stat_rows(L.from_pages(read_pages_as(pages, "fight_stats"), "fight_stats")).collect()
    assert [(s.sig_strikes_landed, s.sig_strikes_head_landed, s.control_time_seconds) for s in stats] == [(10, 1, 201), (20, 2, 0)] and stats[0].scraped_at is None
    rounds = L.stat_rows(L.from_pages(read_pages_as(pages, "fight_stats_by_round"), "fight_stats_by_round"), by_round=True).collect()
    assert sorted((s.round, s.sig_strikes_landed) for s in rounds) == [(1, 11), (1, 21), (2, 12), (2, 22)] and len({s.fight_stat_by_round_id for s in rounds}) == 4
    fights = L.fight_rows(L.from_pages(read_pages_as(pages, "fight"), "fights")).collect()
    assert [(f.result_type, f.weight_class, f.finish_method, f.finish_time_seconds) for f in fights] == [("win", "lightweight", "decision", 300)]


def test_migrations_run_once_and_keep_rows(spark, tmp_path):
    folder = str(tmp_path)
    steps = {"001_first": {"t": "id string, n int"}, "002_wider": {"t": "id string, n bigint, at date", "u": "k string"}}
    assert L.migrate(spark, folder, {"001_first": steps["001_first"]}) == ["001_first"]
    spark.createDataFrame([("a", 1)], "id string, n int").write.mode("append").parquet(f"{folder}/t")
    assert L.migrate(spark, folder, steps) == ["002_wider"] and L.migrate(spark, folder, steps) == []
    t = spark.read.parquet(f"{folder}/t")
    assert t.dtypes == [("id", "string"), ("n", "bigint"), ("at", "date")] and [tuple(r) for r in t.collect()] == [("a", 1, None)] and spark.read.parquet(f"{folder}/u").count() == 0
