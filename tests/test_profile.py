import math
from collections import Counter

from pyspark.sql import functions as F

from priorview.functions.keys import norm_id
from priorview.operators.profile import Form, ValueCounts, breaches, current_deltas, deltas, load_metrics, maintained_profile

FORMS = {("t", "c"): Form(lambda v: v.isin("a", "b"), "share"), ("t", "x"): Form(lambda v: F.expr("try_cast(value as double)").between(0, 100), "mean")}


def entropy(values):
    n = Counter(v for v in values if v is not None)
    total = sum(n.values())
    return -sum(c / total * math.log2(c / total) for c in n.values()) if total else None


def test_loads_withdrawals_and_retries(spark, tmp_path):
    store = ValueCounts(spark, str(tmp_path / "counts"))
    first, second = [("a", 1), ("a", 2), ("b", None), (None, 2)], [("b", 10), ("zz", 2)]
    rows = lambda data: spark.createDataFrame(data, "c string, x int")
    store.apply(deltas(rows(first), "t", ["c", "x"], None, 1, 1), "l1")
    store.apply(deltas(rows(second), "t", ["c", "x"], None, 1, 2), "l2")
    store.apply(deltas(rows(second), "t", ["c", "x"], None, 1, 2), "l2")  # again
    store.apply(deltas(rows([("a", 1), ("a", 2)]), "t", ["c", "x"], None, -1, 3), "l3")
    states = {1: first, 2: first + second, 3: [("b", None), (None, 2), *second]}
    for round_ in range(2):
        got = {(r.column_name, r.load_id): r for r in maintained_profile(store.read(), {("t", "x"): "int"}).collect()}
        for load, state in states.items():
            for i, c in enumerate(("c", "x")):
                v = [s[i] for s in state]
                r, known = got[c, load], [x for x in v if x is not None]
                assert (r.rows_n, r.nulls_n, r.distinct_n) == (len(v), v.count(None), len(set(known)))
                assert (r.min_value, r.max_value) == (str(min(known)), str(max(known)))
                assert abs(r.entropy - entropy(v)) < 1e-9
        if not round_:
            store.compact()


def test_checks_against_the_load_before(spark, tmp_path):
    data = [(1, "a", 10)] * 10 + [(2, "a", 10)] * 5 + [(2, None, 60)] * 5 + [(3, "b", 900)] * 8 + [(3, "?", 10)] * 2
    store = ValueCounts(spark, str(tmp_path / "counts"))
    store.apply(deltas(spark.createDataFrame(data, "load int, c string, x int"), "t", ["c", "x"], "load"), "all")
    m = load_metrics(store.read(), FORMS)
    got = {(r.column_name, r.load_id, r.check_name) for r in breaches(m, FORMS, 0.2, 0.1, 0.25, 20).collect()}
    assert got == {("c", 2, "null_share"), ("c", 3, "null_share"), ("c", 3, "form"), ("c", 3, "drift"), ("x", 2, "drift"), ("x", 3, "form"), ("x", 3, "drift")}


def test_nulls_blanks_and_empty_tables(spark, tmp_path):
    store = ValueCounts(spark, str(tmp_path / "counts"))
    store.apply(deltas(spark.createDataFrame([(None, None, None), (1, "", None)], "load int, c string, x int"), "t", ["c", "x"], "load"), "all")
    got = {(r.column_name, r.load_id): r for r in load_metrics(store.read(), FORMS).collect()}
    assert got["c", -1].nulls_n == 1 and got["c", 1].bad_n == 1 and got["x", 1].bad_share is None
    empty = ValueCounts(spark, str(tmp_path / "none"))
    empty.apply(deltas(spark.createDataFrame([], "load int, c string"), "t", ["c"], "load"), "all")
    assert load_metrics(empty.read(), FORMS).count() == 0 and maintained_profile(empty.read()).count() == 0


def test_current_rows_come_and_go(spark, tmp_path):
    """Records fetched again take their old values back; late rows and rows without a key change nothing."""
    data = [(1, "k1", 10, "a"), (1, "k2", 10, "a"), (2, "K1 ", 20, "b"), (2, None, 20, "z"), (3, "k1", 15, "late"), (3, "k2", 30, None), (4, "k2", 30, None), (None, "k9", 1, "x")]
    rows = spark.createDataFrame(data, "load int, key string, at int, v string")
    store = ValueCounts(spark, str(tmp_path / "counts"))
    changes = current_deltas(rows, "t", norm_id("key"), ["v"], "load", "at")
    for _ in range(2):  # a load given again counts once
        store.apply_loads(changes, "t")
    want = {-1: ["x"], 1: ["x", "a", "a"], 2: ["x", "b", "a"], 3: ["x", "b", None]}
    for step in range(3):
        got = {r.load_id: r for r in maintained_profile(store.read()).collect()}
        for load, state in want.items():
            known = [x for x in state if x is not None]
            assert (got[load].rows_n, got[load].nulls_n, got[load].distinct_n, got[load].min_value, got[load].max_value) == (len(state), state.count(None), len(set(known)), min(known), max(known))
        if step == 0:
            store.compact()
        elif step == 1:
            store.apply(deltas(spark.createDataFrame([("q",)], "v string"), "t", ["v"], None, 1, 7), "extra")
            store.withdraw("extra", 8)
            want[7], want[8] = [*want[3], "q"], want[3]
