import random
from datetime import date, datetime, timedelta

import pytest

from priorview.operators.asof import attributes_as_known, change_histories

V = "entity string, as_of date, known timestamp, id bigint, a int, b string, value string"


def brute(events, versions, column, nulls):
    out = {}
    for key, entity, day in events:
        if entity is None or day is None:
            continue
        fit = [v for v in versions if v[0] == entity and v[1] and v[2] and v[1] <= day and v[2].date() < day and (nulls == "keep" or v[column] is not None)]
        out[key, entity, day] = max(fit, key=lambda v: (v[1], v[2], v[3]))[column] if fit else None
    return out


@pytest.mark.parametrize("hot", [[], ["e0", "e1"]])
@pytest.mark.parametrize("nulls", ["keep", "skip"])
def test_matches_brute_force_with_ties_repeats_and_late_knowledge(spark, hot, nulls):
    r = random.Random(3)
    day = lambda: date(2020, 1, 1) + timedelta(days=r.randrange(400))
    versions = [(f"e{r.randrange(5) if i % 2 else 0}", day(), datetime.combine(day(), datetime.min.time()) + timedelta(hours=r.randrange(24)), r.randrange(60), r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"]), "z") for i in range(300)]
    versions += versions[:20] + [(None, day(), datetime(2020, 1, 1), 1, 1, "x", "z"), ("e1", None, datetime(2020, 1, 1), 1, 1, "x", "z"), ("e1", day(), None, 1, 1, "x", "z")]
    # Equal (as_of, known, id) with other values have no defined order: keep one of each.
    versions = list({v[:4]: v for v in versions}.values()) + versions[:20]
    versions = [v for i, v in enumerate(versions) if v in versions[:i] or all(w[:4] != v[:4] for w in versions[:i])]
    events = [(f"k{i}", f"e{r.randrange(6)}", day()) for i in range(120)] + [("n", None, day()), ("m", "e1", None)]
    histories = change_histories(spark.createDataFrame(versions, V), "entity", "as_of", "known", "id", ["a", "b"], nulls, hot)
    got = attributes_as_known(spark.createDataFrame(events + events[:5], "k string, entity string, day date"), histories, ["k"], "entity", "day", {"a": "int", "b": "string"}, hot).collect()
    assert len(got) == 120
    for column, name in ((4, "a"), (5, "b")):
        assert {(g.k, g.entity, g.day): g[name] for g in got} == brute(events, versions, column, nulls)


def test_empty_tables(spark):
    histories = change_histories(spark.createDataFrame([], V), "entity", "as_of", "known", "id", ["a"])
    events = spark.createDataFrame([("k", "e", date(2020, 1, 1))], "k string, entity string, day date")
    assert [tuple(r) for r in attributes_as_known(events, histories, ["k"], "entity", "day", {"a": "int"}).collect()] == [("k", "e", date(2020, 1, 1), None)]
    assert attributes_as_known(events.limit(0), histories, ["k"], "entity", "day", {"a": "int"}).count() == 0


def test_a_version_of_the_day_itself_is_not_known(spark):
    v = spark.createDataFrame([("e", date(2020, 1, 1), datetime(2020, 1, 5, 23, 59), 1, 7, "x", "z")], V)
    e = spark.createDataFrame([("k5", "e", date(2020, 1, 5)), ("k6", "e", date(2020, 1, 6))], "k string, entity string, day date")
    got = attributes_as_known(e, change_histories(v, "entity", "as_of", "known", "id", ["a"]), ["k"], "entity", "day", {"a": "int"})
    assert {r.k: r.a for r in got.collect()} == {"k5": None, "k6": 7}


@pytest.mark.parametrize("hot", [[], ["e"]])
def test_only_changes_are_kept(spark, hot):
    d = lambda n: date(2020, 1, n)
    rows = [("e", d(n), datetime(2019, 1, 1), n, a, "x", "z") for n, a in ((1, 5), (2, 5), (3, 6), (4, 6), (6, None), (7, None), (8, 6))] + [("e", d(5), datetime(2020, 1, 20), 9, 7, "x", "z"), ("e", d(3), datetime(2019, 1, 1), 2, 9, "x", "z")]
    got = sorted((r.attribute, r.visible_from, r.value) for r in change_histories(spark.createDataFrame(rows, V), "entity", "as_of", "known", "id", ["a", "b"], "keep", hot).collect())
    assert got == [("a", d(1), "5"), ("a", d(3), "6"), ("a", d(6), None), ("a", d(8), "6"), ("b", d(1), "x")]
