import random

import numpy as np

from priorview.operators.quantiles import interpolated, order_statistics


def test_ranks_by_sorting(spark):
    r = random.Random(1)
    groups = {"even": [float(i) for i in range(300)], "outlier": [1e12, -1e9, *[r.random() for _ in range(400)]], "ties": [5.0] * 200 + [6.0] * 3, "one": [7.5], "odd": [r.gauss(0, 1) ** 3 for _ in range(301)]}
    rows = [(k, v, 1) for k, vs in groups.items() for v in vs] + [("even", None, 1), (None, 1.0, 1), ("even", float("nan"), 1), ("twice", 1.0, 3), ("twice", 2.0, 2)]
    r.shuffle(rows)
    groups["twice"] = [1.0, 1.0, 1.0, 2.0, 2.0]
    df = spark.createDataFrame(rows, "key string, v double, n bigint")
    for few in (10, 10**6):  # by narrowing, and at once
        got = order_statistics(df, {k: [0, (len(v) - 1) // 2, len(v) - 1, len(v) // 7] for k, v in groups.items()}, few=few)
        assert set(got) == set(groups)
        for k, v in groups.items():
            assert got[k] == {-1: len(v)} | {i: sorted(v)[i] for i in (0, (len(v) - 1) // 2, len(v) - 1, len(v) // 7)}
        shares = order_statistics(df, shares=[0.05, 0.5, 0.95], few=few)
        assert all(abs(interpolated(shares[k], s) - np.quantile(v, s)) < 1e-9 * max(map(abs, v)) for k, v in groups.items() for s in (0.05, 0.5, 0.95))
    assert order_statistics(df.limit(0), shares=[0.5]) == {}
