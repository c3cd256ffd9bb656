"""Command line: ``python -m priorview.cli VERB FOLDER [OUT]``.

Verbs over a folder of tables: build_features, validate_features, test_leakage, validate_integrity, validate_consistency,
warehouse_check, review_fighters, report_stats, report_events, build_queue, build_stats_queue, smoke, or the name of any query.
Results go to OUT/<query> as parquet (features are upserted into OUT by their keys), or are shown.

Verbs over a folder of raw exports (CSV), into the tables of OUT: load_events, load_fighters, load_fights, load_fight_stats,
load_all, update (load_all, then the features of the loaded tables). ``migrate OUT`` makes or widens those tables.

The exit code is 1 if a check failed, 2 if the call can't be understood.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorview.operators import features as X
from priorview.operators import loaders as L
from priorview.operators.merge import keyed_sink, upsert_table
from priorview.plans import features, general, loading, warehouse
from priorview.session import drop_scratch, local_session
from priorview.sources.tables import exists, read_csv

VERBS = {
    "build_features": ["q_snapshots", "q_bouts"], "validate_features": ["q_row_equalities", "q_missingness", "q_bout_missingness", "q_distribution", "q_bout_distribution", "q_correlations", "q_completeness"], "test_leakage": ["q_leakage", "q_leakage_elo"],
    "validate_integrity": ["q_row_counts", "q_orphan_counts", "q_stats_info", "q_result_types"], "validate_consistency": ["q_consistency", "q_vocabulary", "q_targets_differ"], "warehouse_check": ["q_row_counts", "q_orphan_counts", "q_consistency", "q_vocabulary"],
    "review_fighters": ["q_fighter_review", "q_flag_counts"], "report_stats": ["q_stats_gaps", "q_stats_thresholds"], "report_events": ["q_card_coverage", "q_event_coverage"], "build_queue": ["q_queue", "q_unseen"], "build_stats_queue": ["q_bout_queue", "q_to_fetch"], "smoke": ["q_smoke"],
}
QUERIES = general.QUERIES | features.QUERIES | warehouse.QUERIES | loading.QUERIES
LOADS = {"load_events": ["events"], "load_fighters": ["fighters"], "load_fights": ["fights"], "load_fight_stats": ["fight_stats", "fight_stats_by_round"], "load_all": ["events", "fighters", "fights", "fight_stats", "fight_stats_by_round"]}
#: What counts as a failure in the result of a query.
FAILS = {"q_leakage": "failures > 0", "q_leakage_elo": "failures > 0", "q_leakage_given": "failures > 0", "q_row_counts": "not ok", "q_row_equalities": "not ok", "q_orphan_counts": "misses > 0", "q_consistency": "rows > 0", "q_vocabulary": "value is not null", "q_targets_differ": "abs(sign) > 0", "q_event_coverage": "status = 'FAIL'", "q_stats_thresholds": "status = 'FAIL'", "q_smoke": "status = 'FAIL'"}


def load(spark: SparkSession, folder: str, out: str, kinds: list[str]) -> None:
    """Reads raw exports, leaves rows aside whose references are unknown, and upserts the others; prints the counts."""
    for kind in kinds:
        raw = read_csv(spark, f"{folder}/{kind}.csv", L.RAW[kind], optional=kind == "fight_stats_by_round")
        rows, skipped = L.ROWS[kind](raw), 0
        if kind in L.PARENT:
            column, parent, key = L.PARENT[kind]
            rows, aside = L.known_only(rows, column, spark.read.parquet(f"{out}/{parent}"), key)
            skipped = aside.count()
        print(f"{kind}: {upsert_table(spark, f'{out}/{kind}', rows, [L.KEYS[kind]], 'scraped_at')} rows upserted, {skipped} skipped")


def _loaded(spark: SparkSession, out: str) -> list[DataFrame]:
    """Bouts, cards, stats and profiles as the loaders left them."""
    stats = spark.read.parquet(f"{out}/fight_stats")
    return [spark.read.parquet(f"{out}/fights"), spark.read.parquet(f"{out}/events"), stats, spark.read.parquet(f"{out}/fighters")]


def build(spark: SparkSession, tables: list[DataFrame], out: str) -> None:
    """Both feature tables from one pass over the histories, upserted by their keys."""
    s = X.snapshots(*tables)
    s = s.persist()
    try:
        for name, rows, keys in (("fighter_snapshots", X.snapshot_table(s), ["fighter_id", "fight_id"]), ("bout_features", X.bout_table(s), ["fight_id"])):
            print(f"{name}: {keyed_sink(spark, f'{out}/{name}', rows, keys)} rows upserted")
    finally:
        s.unpersist()


def migrate(spark: SparkSession, out: str) -> None:
    """The loaded tables with the columns that loaders give."""
    empty = {k: L.ROWS[k](spark.createDataFrame([], ", ".join(f"`{c}` string" for c in L.RAW[k]))) for k in L.RAW}
    steps = {"001_tables": {k: ", ".join(f"`{c}` {t}" for c, t in df.dtypes) for k, df in empty.items()}}
    print("applied:", ", ".join(L.migrate(spark, out, steps)) or "nothing")


def run(spark: SparkSession, verb: str, folder: str, out: str | None) -> int:
    if verb == "migrate":
        migrate(spark, folder)
        return 0
    if verb in LOADS or verb == "update":
        load(spark, folder, out, LOADS.get(verb, LOADS["load_all"]))
        if verb == "update":
            build(spark, _loaded(spark, out), out)
        return 0
    if verb == "build_features" and out:
        build(spark, [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("fights", "fight_events", "fight_stats_aggregate", "fighters")], out)
        return 0
    bad = 0
    for name in VERBS.get(verb, [verb]):
        df = QUERIES[name](spark, folder)
        if out:
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            df = spark.read.parquet(f"{out}/{name}")
        else:
            df.show(50, truncate=False)
        if name in FAILS:
            failed = not df.filter(F.expr(FAILS[name])).isEmpty()
            print(f"{name}: {'FAIL' if failed else 'PASS'}")
            bad |= failed
    return int(bad)


def main(argv: list[str]) -> int:
    verbs = {*VERBS, *QUERIES, *LOADS, "update", "migrate"}
    if len(argv) < 2 or argv[0] not in verbs or (argv[0] in {*LOADS, "update"} and len(argv) < 3):
        print(__doc__)
        return 2
    spark = local_session()
    if argv[0] in {*LOADS, "update"} and not exists(spark, argv[1]):
        print(f"no folder {argv[1]}")
        return 2
    try:
        return run(spark, argv[0], argv[1], argv[2] if len(argv) > 2 else None)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
