import random
from datetime import datetime, timedelta

import pyarrow as pa

from priorview.operators.orphans import Ranges, Reference, _fixed, orphan_references, orphan_report, placed

T = "id string, ref string, scraped_at timestamp, extra int, key string"


def case(spark, children, parents, retired, ranges=3):
    refs = [Reference("c", "id", "ref", "p")]
    return orphan_references({"c": spark.createDataFrame(children, T)}, {"p": (spark.createDataFrame(parents, "pid string, scraped_at timestamp, part int"), "pid")}, spark.createDataFrame(retired, "entity_type string, entity_id string, retired_at timestamp"), refs, ranges=ranges)


def test_matches_brute_force_with_a_hot_key(spark):
    r = random.Random(5)
    t = lambda: datetime(2020, 1, 1) + timedelta(hours=r.randrange(5000))
    keys = [f"{r.randrange(16**8):08x}-k" for _ in range(60)]
    parents = [(k, t(), 1) for k in keys[:40] for _ in range(r.randrange(1, 3))]
    retired = [("p", k, t()) for k in keys[30:50]] + [("other", keys[0], t())]
    write = lambda k: r.choice([k, k.upper(), f" {k}\t"])
    children = [(f"c{i % 500}", write(keys[7] if i % 3 else r.choice(keys)), t(), i, "x") for i in range(900)] + [("n1", None, t(), 1, None), ("n2", "  ", t(), 1, None), (None, keys[55], t(), 1, None)]
    now = {}
    for c in children:
        if c[0] and (c[0] not in now or (c[2], c[1] or "") > (now[c[0]][2], now[c[0]][1] or "")):
            now[c[0]] = c
    expected = set()
    for c in now.values():
        k = (c[1] or "").strip().lower()
        if not k:
            continue
        own, gone = [p[1] for p in parents if p[0] == k], [x[2] for x in retired if x[0] == "p" and x[1] == k]
        status = "deleted" if gone and not any(o > max(gone) for o in own) else "missing" if not own else "late" if min(own) > c[2] else None
        if status:
            expected.add(("c", "ref", c[0], status, f"{c[2]:%Y-%m}"))
    got = case(spark, children, parents, retired)
    assert {tuple(x) for x in got.collect()} == expected and got.count() == len(expected)
    assert sum(x.refs for x in orphan_report(got).collect()) == len(expected)


def test_empty_tables(spark):
    assert case(spark, [], [], []).count() == 0
    only = [("c1", "k", datetime(2020, 1, 2), 1, None)]
    assert [x.status for x in case(spark, only, [], []).collect()] == ["missing"]
    assert [x.status for x in case(spark, only, [], [("p", "K ", datetime(2020, 1, 1))]).collect()] == ["deleted"]


def test_ranges_keep_the_order_of_keys(spark):
    keys = sorted([f"id-{random.Random(i).randrange(10**6):07d}" for i in range(300)])
    ranges = Ranges.fit(keys[::3], 5)
    got = spark.createDataFrame([(k,) for k in ["a", *keys, "zz", ""]], "k string").select("k", ranges.of(__import__("pyspark.sql.functions", fromlist=["col"]).col("k")).alias("r")).collect()
    by = {g.k: g.r for g in got}
    order = [by[k] for k in sorted(by)]
    assert order == sorted(order) and set(order) == set(range(5))


def test_groups_are_placed_by_weight():
    weights = [50, 1, 1, 1, 20, 20, 10, 0, 0, 30]
    at = placed(weights, 3)
    assert max(sum(w for w, t in zip(weights, at) if t == k) for k in range(3)) == 50 and set(at) == {0, 1, 2} and placed([], 2) == []


def test_keys_as_fixed_bytes():
    a = pa.array(["b", "", "añc", "zz-9"])
    assert _fixed(a).tolist() == ["b".encode(), b"", "añc".encode(), b"zz-9"] and _fixed(a.slice(2, 1)).tolist() == ["añc".encode()] and len(_fixed(a.slice(0, 0))) == 0
