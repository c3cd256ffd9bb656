import os
from datetime import date

import pytest

from priorview.operators.impute import Rules, fill_missing, filled_cells

RULES = Rules(numeric={"h": (120, 230), "w": None, "dob": ("1940-01-01", "2006-12-31")}, categorical=("stance",), fill=("h", "dob", "stance"), clusters=4, parents=2, support=3)
S = "id string, h double, w double, dob date, stance string, cluster int, x_h string"


def people():
    small = [(f"s{i}", 150.0 + i % 3, 50.0 + i % 2, date(1990, 1, 1 + i % 5), "Orthodox ", i, "e") for i in range(30)]
    tall = [(f"t{i}", 200.0 + i % 3, 110.0 + i % 2, date(1970, 1, 1 + i % 5), "southpaw", i, "e") for i in range(30)]
    return small + tall


def test_fills_from_similar_rows_and_marks_them(spark):
    rows = people() + [("a", None, 50.0, None, "orthodox", 1, "e"), ("b", 999.0, 110.0, date(1900, 1, 1), None, 1, "e"), ("c", None, None, None, "", 1, "e")]
    got = {r.id: r for r in fill_missing(spark.createDataFrame(rows, S), "id", RULES).collect()}
    assert len(got) == len(rows)
    assert 150 <= got["a"].h <= 152 and got["a"].h_filled and got["a"].dob.year == 1990 and got["a"].stance == "orthodox" and not got["a"].stance_filled
    assert 200 <= got["b"].h <= 202 and got["b"].dob.year == 1970 and got["b"].stance == "southpaw" and got["b"].stance_filled
    assert got["c"].h is not None and got["c"].h_method in ("cluster", "parent", "all")
    assert got["s1"].h == 151.0 and not got["s1"].h_filled and got["s1"].h_method is None and got["s1"].stance == "Orthodox " and got["s1"].x_h == "e"
    cells = {(r.id, r.column_name) for r in filled_cells(fill_missing(spark.createDataFrame(rows, S), "id", RULES), "id", ["h", "dob", "stance"]).collect()}
    assert cells == {("a", "h"), ("a", "dob"), ("b", "h"), ("b", "dob"), ("b", "stance"), ("c", "h"), ("c", "dob"), ("c", "stance")}


@pytest.mark.parametrize("rows", [[], [("a", None, None, None, None, 1, "e")], [("a", None, 60.0, None, None, 1, "e"), ("a", None, 60.0, None, None, 1, "e")]])
def test_nothing_to_fill_from(spark, rows):
    got = fill_missing(spark.createDataFrame(rows, S), "id", RULES).collect()
    assert len(got) == len(rows) and all(r.h is None and r.h_filled and r.h_method == "none" for r in got)


def test_held_out_values_come_out_close(spark):
    rows = [(r[0], r[1] if i % 5 else None, *r[2:]) for i, r in enumerate(people())]
    truth = {r[0]: r[1] for r in people()}
    got = fill_missing(spark.createDataFrame(rows, S), "id", RULES).filter("h_filled").collect()
    assert got and all(abs(r.h - truth[r.id]) <= 2 for r in got)


def held_out_errors(spark, folder, share=5):
    """column -> (mean absolute error of filled values, of the median of all), over every ``share``th known value, hidden."""
    from pyspark.sql import functions as F

    from priorview.functions.keys import current_rows
    from priorview.plans.general import MEASURES
    from priorview.session import table

    rows = current_rows(table(spark, folder, "fighters"), "fighter_id", ["fighter_id", "height_cm", "reach_cm", "weight_lbs", "dob", "stance"])
    hide = lambda c: F.pmod(F.xxhash64("fighter_id", F.lit(c)), F.lit(share)) == 0
    good = {c: F.col(c).between(*[F.lit(b).cast(rows.schema[c].dataType) for b in MEASURES.numeric[c]]) for c in MEASURES.fill}
    number = lambda c: (F.unix_date(c) if c == "dob" else F.col(c)).cast("double")
    truth = rows.select("fighter_id", *[F.when(hide(c) & good[c], number(c)).alias(f"t_{c}") for c in MEASURES.fill])
    filled = fill_missing(rows.withColumns({c: F.when(~hide(c), F.col(c)) for c in MEASURES.fill}), "fighter_id", MEASURES)
    both = filled.join(truth, "fighter_id")
    middle = both.agg(*[F.percentile(F.when(F.col(f"t_{c}").isNull() & good[c], number(c)), F.lit(0.5)).alias(c) for c in MEASURES.fill]).first()
    e = both.agg(*[F.avg(F.abs(number(c) - F.col(f"t_{c}"))).alias(c) for c in MEASURES.fill], *[F.avg(F.abs(F.lit(middle[c]) - F.col(f"t_{c}"))).alias(f"m_{c}") for c in MEASURES.fill], F.count_if(~F.col("dob_filled") & F.col("t_dob").isNotNull()).alias("unmarked")).first()
    assert e.unmarked == 0
    return {c: (e[c], e[f"m_{c}"]) for c in MEASURES.fill}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_held_out_measures_are_nearer_than_the_median_of_all(spark):
    found = held_out_errors(spark, "/root/testdata/sf0.01")
    assert found["height_cm"][0] < 0.7 * found["height_cm"][1] and found["reach_cm"][0] < 0.7 * found["reach_cm"][1] and found["dob"][0] <= 1.05 * found["dob"][1]
