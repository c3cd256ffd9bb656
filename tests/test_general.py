import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_snapshots_are_profiled(spark):
    columns = spark.read.parquet(f"{FOLDER}/fighter_snapshots.parquet")
    got = entry.queries()["p3_loads"](spark, FOLDER).filter("table_name = 'fighter_snapshots'").collect()
    assert {r.column_name for r in got} == set(columns.columns) and {r.rows_n for r in got} == {columns.count()}
