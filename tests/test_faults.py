"""A single wrong cell in the tables turns a query's comparison with its SQL red: none of them agrees by itself."""

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_queries import FOLDER, plain

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")

FAULTS = [
    ("q_leakage_given", "fighter_snapshots", "career_fights = career_fights + 1", "as_of_date IN (SELECT event_date FROM fight_events)"), ("q_leakage_given", "bout_features", "label = 1 - label", "label IS NOT NULL"),
    ("q_leakage_elo_given", "fighter_snapshots", "elo_rating = 1500", "is_debut AND career_fights = 0 AND fight_id IN (SELECT fight_id FROM fights)"), ("p3_loads", "fights", "finish_method = 'nonsense'", "finish_method = 'decision'"), ("p3_profile", "bout_features", "diff_elo = -99999", "true"),
    ("p3_withdrawn", "fights", "referee = '!'", "load_id = 2"), ("p3_current", "fighters", "stance = '!'", "true"), ("q_parts_differ", "fight_stats_aggregate", "knockdowns = knockdowns + 2", "knockdowns % 3 = 0"), ("q_normalised", "fights", "weight_class = 'women_strawweight'", "weight_class LIKE 'women_fly%'"),
    ("q_row_equalities", "fights", None, "true"), ("q_event_coverage", "fight_events", "date_formatted = ' '", "event_status = 'completed' AND length(date_formatted) > 3"), ("q_load_fights", "fights", "winner_fighter_id = NULL", "result_type = 'win' AND lower(trim(winner_fighter_id)) = lower(trim(fighter_1_id))"),
    ("q_load_stats", "fight_stats_aggregate", "reversals = reversals + 1", "lower(trim(fight_id)) IN (SELECT fight_id FROM fights)"), ("q_page_fights", "fights", "judge_1 = 'Somebody Else'", "judge_1 <> '' AND trim(referee) <> '' AND scheduled_rounds > 0 AND event_id <> '' AND fighter_1_id <> '' AND fighter_2_id <> ''"), ("q_upsert", "fights", "referee = '!'", "load_id = (SELECT max(load_id) FROM fights)"),
    ("q_bout_queue", "fights", "finish_method = '!'", "load_id = (SELECT max(load_id) FROM fights)"), ("q_smoke", "fighters", None, "true"), ("q_targets_differ", "fight_stats_aggregate", "sig_strikes_landed = sig_strikes_landed + 5", "sig_strikes_landed > 0"), ("p1_all_attributes", "fighter_snapshots", "age = 99", "fighter_id IN (SELECT lower(trim(fighter_1_id)) FROM fights) AND as_of_date < DATE '2012-01-01'"),
]


@pytest.mark.parametrize("name, table, change, where", FAULTS, ids=[f"{n}-{t}" for n, t, *_ in FAULTS])
def test_a_wrong_cell_shows(spark, tmp_path, name, table, change, where):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        shutil.copy(f"{FOLDER}/{f}", tmp_path / f)
        c.execute(f"create view {f[:-8]} as select * from '{FOLDER}/{f}'")
    c.execute(f"create table x as select * from {table}")
    first = c.execute(f"select min(rowid) from x where {where}").fetchone()[0]
    assert first is not None
    c.execute(f"update x set {change} where rowid = {first}" if change else f"delete from x where rowid = {first}")
    c.execute(f"copy x to '{tmp_path}/{table}.parquet' (format parquet)")
    df = entry.queries()[name](spark, str(tmp_path))
    mine = sorted(tuple(plain(r[k]) or "" for k in sorted(df.columns)) for r in df.collect())
    out = c.execute(entry.oracle_sql()[name])
    names = [d[0] for d in out.description]
    want = sorted(tuple(plain(dict(zip(names, r))[k]) or "" for k in sorted(names)) for r in out.fetchall())
    assert mine != want


def test_every_audit_can_fail(spark):
    """Features built from the tables, each check with one planted fault."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from priorview.operators import features as X
    from priorview.operators import quality as Q
    from priorview.plans.features import _sides, _snapshots

    s, sides = _snapshots(spark, FOLDER).cache(), _sides(spark, FOLDER).cache()
    bouts = X.bout_table(s).cache()
    audit = lambda snap, b: {r.check_name: r.failures for r in Q.leakage_audit(snap, sides, b).collect()}
    elo = lambda snap: {r.check_name: r.failures for r in Q.elo_audit(snap, sides).collect()}
    assert not any(audit(s, bouts).values()) and not any(elo(s).values())
    alone = s.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("fighter_id", "as_of_date"))).filter("n = 1")
    debut, later = (alone.filter(c).orderBy("fight_id", "fighter_id").first() for c in ("total_fights = 0", "total_fights > 2"))
    at = lambda r: (F.col("fight_id") == r.fight_id) & (F.col("fighter_id") == r.fighter_id)
    put = lambda df, c, r, v: df.withColumn(c, F.when(at(r), F.lit(v)).otherwise(F.col(c)))
    assert audit(put(s, "total_fights", later, 0), bouts) == {"prior_count": 1, "monotone": 1, "debut": 0, "label": 0}
    assert audit(put(s, "is_debut", debut, False), bouts)["debut"] == 1 == audit(put(s, "is_debut", later, True), bouts)["debut"]
    assert elo(put(s, "pre_fight_elo", debut, 1400.0))["debut_elo"] == 1
    wrong = bouts.filter("label is not null").orderBy("fight_id").first()
    assert audit(s, bouts.withColumn("label", F.when(F.col("fight_id") == wrong.fight_id, 1 - F.col("label")).otherwise(F.col("label"))))["label"] == 1
    s.unpersist(), sides.unpersist(), bouts.unpersist()
