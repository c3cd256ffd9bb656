import csv

import pytest

from priorview import cli
from priorview.operators import loaders as L


def write(path, kind, *rows):
    with open(path / f"{kind}.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, L.RAW[kind])
        w.writeheader()
        w.writerows({"scraped_at": "2026-03-18 10:00:00 UTC", "url": "u"} | r for r in rows)


@pytest.fixture
def exports(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write(folder, "events", *[{"event_id": f"e{i}", "name": f"Card {i}", "date_formatted": f"2025-0{i}-01"} for i in (1, 2, 3)])
    write(folder, "fighters", *[{"fighter_id": x, "full_name": f"{x}, \"the\" One", "height_cm": "180", "dob_formatted": "1990-01-01"} for x in "abc"])
    bout = {"bout_type": "Lightweight Bout", "num_rounds": "3", "primary_finish_method": "decision", "fighter_1_outcome": "W", "fighter_2_outcome": "L"}
    write(folder, "fights", *[bout | {"fight_id": f"f{i}", "event_id": f"e{i}", "fighter_1_id": "a", "fighter_2_id": y} for i, y in ((1, "b"), (2, "c"), (9, "c"))])
    write(folder, "fight_stats", *[{"fight_stat_id": f"s{i}{x}", "fight_id": f"f{i}", "fighter_id": x, "significant_strikes_landed": "30", "significant_strikes_attempted": "60"} for i in (1, 2, 9) for x in "ab"])
    return folder


def test_exports_become_tables_and_features(spark, exports, tmp_path, capsys):
    out = str(tmp_path / "out")
    cli.run(spark, "migrate", out, None)
    for _ in range(2):  # twice is once
        assert cli.run(spark, "update", str(exports), out) == 0
    said = capsys.readouterr().out
    assert "fights: 2 rows upserted, 1 skipped" in said and "fight_stats: 4 rows upserted, 2 skipped" in said and "fight_stats_by_round: 0 rows" in said
    assert {t: spark.read.parquet(f"{out}/{t}").count() for t in ("events", "fighters", "fights", "fight_stats", "fight_stats_by_round")} == {"events": 3, "fighters": 3, "fights": 2, "fight_stats": 4, "fight_stats_by_round": 0}
    s = {(r.fighter_id, r.fight_id): r for r in spark.read.parquet(f"{out}/fighter_snapshots").collect()}
    assert len(s) == 4 and (s["a", "f2"].career_wins, s["a", "f1"].is_debut, float(s["a", "f2"].elo_rating)) == (1, True, 1516.0) and s["a", "f1"].computed_at is not None
    b = {r.fight_id: r for r in spark.read.parquet(f"{out}/bout_features").collect()}
    assert len(b) == 2 and b["f1"].label == 1 and b["f2"].diff_career_wins == 1


def test_calls_that_cannot_be_understood(capsys):
    assert cli.main([]) == 2 and cli.main(["nonsense", "x"]) == 2 and cli.main(["load_all", "x"]) == 2


def test_failed_checks_show_in_the_exit_code(spark):
    folder = "/root/testdata/sf0.001"
    assert cli.run(spark, "validate_consistency", folder, None) == 1 and cli.run(spark, "smoke", folder, None) == 1 and cli.run(spark, "q_result_types", folder, None) == 0
