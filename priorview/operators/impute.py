"""Missing values filled from similar records, by k-prototypes clustering.

Rows are clustered on what they have: numeric features (scaled by their spread) and categorical
ones, a missing feature counting neither for nor against a prototype. A missing cell takes the
median (numeric) or mode (categorical) of its row's cluster; where the cluster observed too few, of
its parent (neighbouring clusters joined); then of all rows. For a column, clusters are those that
rows are nearest to by their other features, in rows that have a value as in rows that lack it: else clusters
that differ by just that column would be told apart at random. Flags tell which cells were filled and how.

Each round is one pass in Arrow batches with sums and counts per cluster combined in the task, then before the
shuffle; only prototypes (k rows) reach the driver, however many rows there are. Quantiles and medians are
exact and come from value counts that narrow pass by pass, so no task sorts a whole column.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorview.operators.quantiles import order_statistics
from priorview.session import materialise


@dataclass(frozen=True)
class Rules:
    """numeric: column to (lowest, highest) believable value, dates as ISO strings, or None for no bound.
    categorical: columns whose lower-cased, trimmed text is the category; empty text is missing.
    fill: the columns to fill. clusters, parents: how many. gamma: weight of a category that differs. support: least
    observed values for a cluster's or parent's median or mode. tolerance: rounds, each of which lowers the sum of
    distances to the prototypes, end when one lowers it by no more than this share."""

    numeric: dict[str, tuple | None]
    categorical: tuple[str, ...]
    fill: tuple[str, ...]
    clusters: int = 24
    parents: int = 6
    gamma: float = 0.5
    support: int = 20
    tolerance: float = 1e-3


def _is_date(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes)[c] == "date"


def _number(df: DataFrame, c: str, bounds: tuple | None) -> Column:
    """The believable value as a double (dates as days), else null."""
    v = F.unix_date(c) if _is_date(df, c) else F.col(c)
    if bounds:
        low, high = (F.lit(b).cast("date") if _is_date(df, c) else F.lit(b) for b in bounds)
        v = F.when(F.col(c).between(low, high), v)
    v = v.cast("double")
    return F.when(~F.isnan(v), v)


def _category(c: str) -> Column:
    return F.nullif(F.lower(F.btrim(F.col(c).cast("string"))), F.lit(""))


def _distances(x: np.ndarray, codes: list[np.ndarray], known: list[list], prototypes: list[dict], rules: Rules, scale: dict[str, float]) -> dict[str, np.ndarray]:
    """Of each feature, what it adds to the distance of each row to each prototype: squared scaled differences, gamma for a
    category that differs, nothing where either is missing (nan, code -1)."""
    out = {}
    for j, c in enumerate(rules.numeric):
        centres = np.array([p[c] if p[c] is not None else np.nan for p in prototypes], dtype=float)
        out[c] = np.nan_to_num(((x[:, j, None] - centres[None, :]) / scale[c]) ** 2)
    for j, c in enumerate(rules.categorical):
        place = {v: i for i, v in enumerate(known[j])}
        at = np.array([place.get(p[c], -2) if p[c] is not None else -3 for p in prototypes])
        out[c] = rules.gamma * ((codes[j][:, None] != at[None, :]) & (codes[j] >= 0)[:, None] & (at != -3)[None, :])
    return out


def _clusters(prototypes: list[dict], rules: Rules, scale: dict[str, float]) -> Column:
    """For each column to fill the nearest prototype by the other features (0-based, ties to the first), as an array."""

    @F.pandas_udf("array<int>")
    def nearest(*features: pd.Series) -> pd.Series:
        x = np.column_stack([f.to_numpy(dtype=float) for f in features[: len(rules.numeric)]]) if rules.numeric else np.zeros((len(features[0]), 0))
        coded = [pd.factorize(f) for f in features[len(rules.numeric) :]]
        parts = _distances(x, [c for c, _ in coded], [list(v) for _, v in coded], prototypes, rules, scale)
        whole = sum(parts.values())
        return pd.Series(list(np.column_stack([(whole - parts[c]).argmin(axis=1) if c in parts else whole.argmin(axis=1) for c in rules.fill]).astype(np.int32)))

    return nearest(*[F.col(f"x_{c}") for c in (*rules.numeric, *rules.categorical)])


def _round(rows: DataFrame, prototypes: list[dict], rules: Rules, scale: dict[str, float]) -> tuple[dict[tuple[int, str], float | str], float]:
    """Mean or mode of each cluster and feature, of the rows nearest to its prototype, and the sum of their distances."""
    numeric, categorical, k = list(rules.numeric), list(rules.categorical), len(prototypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, len(numeric))), np.zeros((k, len(numeric)), np.int64)
        seen: Counter = Counter()
        cost = 0.0
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(j).to_numpy(zero_copy_only=False).astype(float) for j in range(len(numeric))]) if numeric else np.zeros((b.num_rows, 0))
            coded = [b.column(len(numeric) + j).dictionary_encode() for j in range(len(categorical))]
            codes = [c.indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in coded]
            known = [c.dictionary.to_pylist() for c in coded]
            d = sum(_distances(x, codes, known, prototypes, rules, scale).values())
            at = d.argmin(axis=1)
            cost += float(d[np.arange(len(d)), at].sum())
            for j in range(len(numeric)):
                there = ~np.isnan(x[:, j])
                sums[:, j] += np.bincount(at[there], x[there, j], k)
                counts[:, j] += np.bincount(at[there], minlength=k)
            for j, values in enumerate(known):
                there = codes[j] >= 0
                n = np.bincount(at[there] * max(1, len(values)) + codes[j][there], minlength=k * max(1, len(values)))
                for i in np.flatnonzero(n):
                    seen[int(i) // len(values), categorical[j], values[i % len(values)]] += int(n[i])
        out = [(i, c, None, float(sums[i, j]), int(counts[i, j])) for i in range(k) for j, c in enumerate(numeric) if counts[i, j]]
        out += [(i, c, v, 0.0, n) for (i, c, v), n in seen.items()] + [(-1, "", None, cost, 1)]
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int64()))], ["cluster", "c", "v", "s", "n"])

    part = rows.select(*[f"x_{c}" for c in (*numeric, *categorical)]).mapInArrow(run, "cluster int, c string, v string, s double, n bigint")
    whole = part.groupBy("cluster", "c", "v").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    best = whole.groupBy("cluster", "c").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
    found = best.collect()
    return {(r.cluster, r.c): r.v if r.c in rules.categorical else r.s / r.n for r in found if r.cluster >= 0}, sum(r.s for r in found if r.cluster < 0)


def fit_prototypes(rows: DataFrame, rules: Rules) -> tuple[list[dict], dict[str, float]]:
    """Prototypes (numeric means, categorical modes) of all rows, and the scale of each numeric feature.

    They start on the diagonal of the features' exact quantiles, and on the categories in their proportions (of the
    ``clusters`` most frequent), hence don't depend on the order of rows.
    """
    k = rules.clusters
    at = [(i + 0.5) / k for i in range(k)]
    long = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"x_{c}").alias("v"), F.lit(1).cast("bigint").alias("n")) for c in rules.numeric])))
    found = order_statistics(long, shares=at) if rules.numeric else {}
    quantile = lambda c, s: found[c][int((found[c][-1] - 1) * s)] if c in found else None
    spread = rows.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(f"x_{c}").alias(c) for c in rules.numeric]).first()
    scale = {c: spread[c] or 1.0 for c in rules.numeric}
    prototypes: list[dict] = [{c: quantile(c, s) for c in rules.numeric} for s in at]
    for c in rules.categorical:
        most = rows.filter(f"x_{c} is not null").groupBy(F.col(f"x_{c}").alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v").limit(k).collect()
        upto = np.cumsum([r.n for r in most])
        for p, s in zip(prototypes, at):
            p[c] = most[int(np.searchsorted(upto, s * upto[-1]))].v if most else None
    if not spread["n"]:
        return prototypes, scale
    before = float("inf")
    while True:
        centre, cost = _round(rows, prototypes, rules, scale)
        prototypes = [{c: centre.get((i, c), p[c]) for c in (*rules.numeric, *rules.categorical)} for i, p in enumerate(prototypes)]
        if before - cost <= rules.tolerance * cost:
            return prototypes, scale
        before = cost


def parent_clusters(prototypes: list[dict], rules: Rules, scale: dict[str, float]) -> list[int]:
    """Joins the nearest groups of prototypes until ``parents`` are left; a group's place is the mean of its prototypes."""
    groups = [[i] for i in range(len(prototypes))]

    def place(g: list[int]) -> list[float]:
        return [sum((prototypes[i][c] or 0.0) / scale[c] for i in g) / len(g) for c in rules.numeric]

    while len(groups) > max(1, rules.parents):
        _, a, b = min((sum((x - y) ** 2 for x, y in zip(place(groups[a]), place(groups[b]))), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        groups[a] += groups.pop(b)
    return [next(g for g, own in enumerate(groups) if i in own) for i in range(len(prototypes))]


def fill_missing(df: DataFrame, key: str, rules: Rules) -> DataFrame:
    """``df`` with the ``fill`` columns filled and, for each, ``<c>_filled`` and ``<c>_method``.

    ``_filled`` marks cells that were null, empty, or not believable under the rules, whether or not a
    value was found. ``_method`` is cluster, parent, all or none (no row has a value: the cell is
    null), and null for cells that were kept. Numeric medians are the lower of two middle values, so
    a filled value is one that was observed; ties of modes go to the first in order. Extra columns
    pass through, but those named as a flag, which are replaced; an empty table gives an empty one.
    """
    x = {c: _number(df, c, b) for c, b in rules.numeric.items()} | {c: _category(c) for c in rules.categorical}
    rows = materialise(df.select(F.col(key).alias("_key"), *[e.alias(f"x_{c}") for c, e in x.items()]), "prototypes")
    prototypes, scale = fit_prototypes(rows, rules)
    parent = parent_clusters(prototypes, rules, scale)
    near = rows.withColumn("_at", _clusters(prototypes, rules, scale))
    parents = F.array(*map(F.lit, parent))

    # Values of each cluster (0), parent (1) and of all rows (2); the keys are few, their value counts combined before the shuffle.
    def levels(c: Column, at: Column) -> list[Column]:
        return [F.concat_ws("|", F.lit(i), g.cast("int"), c) for i, g in enumerate((at, F.element_at(parents, at + 1), F.lit(0)))]

    stats: dict[tuple, tuple] = {}
    numeric, categorical = [c for c in rules.fill if c in rules.numeric], [c for c in rules.fill if c not in rules.numeric]
    if numeric:
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"x_{c}").alias("v"), F.col("_at")[rules.fill.index(c)].alias("at")) for c in numeric])
        counts = materialise(near.select(F.inline(pairs)).filter("v is not null").groupBy("at", "c", "v").agg(F.count(F.lit(1)).alias("n")), "counts")
        each = F.array(*[F.struct(k.alias("key"), "v", "n") for k in levels(F.col("c"), F.col("at"))])
        for key, ranks in order_statistics(counts.select(F.inline(each)), shares=[0.5]).items():
            level, g, c = key.split("|", 2)
            stats[int(level), int(g), c] = (ranks[-1], ranks[(ranks[-1] - 1) // 2])
    for c in categorical:
        each = F.array(*[F.struct(k.alias("key"), F.col(f"x_{c}").alias("t")) for k in levels(F.lit(c), F.col("_at")[rules.fill.index(c)])])
        counted = near.filter(f"x_{c} is not null").select(F.inline(each)).groupBy("key", "t").agg(F.count(F.lit(1)).alias("n"))
        for r in counted.groupBy("key").agg(F.sum("n").alias("n"), F.min_by("t", F.struct(-F.col("n"), F.col("t"))).alias("t")).collect():
            level, g, _ = r.key.split("|", 2)
            stats[int(level), int(g), c] = (r.n, r.t)

    # The given row is one struct, so that none of its names can clash with the features'.
    flat = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[e.alias(f"x_{c}") for c, e in x.items()]).withColumn("_at", _clusters(prototypes, rules, scale))
    added = []
    for c in rules.fill:
        choice = []
        for i in range(len(prototypes)):
            options = (("cluster", (0, i, c)), ("parent", (1, parent[i], c)), ("all", (2, 0, c)))
            enough = [(m, stats[s][1]) for m, s in options if s in stats and (stats[s][0] >= rules.support or m == "all")]
            choice.append(enough[0] if enough else ("none", None))
        at = F.col("_at")[rules.fill.index(c)] + 1
        value = F.element_at(F.array(*[F.lit(v).cast("double" if c in rules.numeric else "string") for _, v in choice]), at)
        if c in rules.numeric:
            value = F.date_from_unix_date(value.cast("int")) if _is_date(df, c) else value.cast(df.schema[c].dataType)
        missing = F.col(f"x_{c}").isNull()
        added += [F.when(missing, value).otherwise(F.col(f"_row.`{c}`")).alias(c), missing.alias(f"{c}_filled"), F.when(missing, F.element_at(F.array(*[F.lit(m) for m, _ in choice]), at)).alias(f"{c}_method")]
    made = {n for c in rules.fill for n in (c, f"{c}_filled", f"{c}_method")}
    return flat.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in made], *added)


def filled_cells(filled: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, value, method): one row for each cell that was filled."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.col(f"{c}_method").alias("method"), F.col(f"{c}_filled").alias("filled")) for c in columns])
    return filled.select(key, F.inline(cells)).filter("filled").drop("filled")
