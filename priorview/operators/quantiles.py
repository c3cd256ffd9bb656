"""Exact order statistics of many groups without gathering a group's values anywhere.

A wanted rank is enclosed in an interval of values that narrows pass by pass: counts in equal cells of the interval
tell which cell holds it. Once few rows are left in an interval they are sorted, by value counts. The driver sees
cells and wanted ranks, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1024


def order_statistics(values: DataFrame, wanted: dict[str, list[int]] | None = None, shares: list[float] | None = None, few: int = 200_000) -> dict[str, dict[int, float]]:
    """key -> rank -> value, of values (key string, v double, n bigint): v occurs n times in the group of that key.

    Ranks count from 0. Either ``wanted`` names them by key, or ``shares`` asks every key for the ranks on both sides of
    (count - 1) * share. Null values and keys are left out, NaN too; ranks beyond a group's count are its last. Keys are few
    (columns, clusters): they are held on the driver, with -1 -> the group's count.
    """
    values = values.filter("key is not null and v is not null and not isnan(v) and n > 0")
    sizes = {r.key: (r.lo, r.hi, r.n) for r in values.groupBy("key").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("n")).collect()}
    out: dict[str, dict[int, float]] = {k: {-1: n} for k, (_, _, n) in sizes.items()}
    open_ = []  # key, rank, lowest, highest value, rank of the first value in between, rows in between
    for k, (lo, hi, n) in sizes.items():
        ranks = wanted.get(k, []) if wanted is not None else sorted({r for s in shares for r in (int((n - 1) * s), -int(-(n - 1) * s // 1))})
        open_ += [[k, r, lo, hi, 0, n] for r in ranks]
    while open_:
        for k, r, lo, *_ in (o for o in open_ if o[2] >= o[3]):
            out[k][r] = lo
        open_ = [o for o in open_ if o[2] < o[3]]
        wide = [o for o in open_ if o[5] > few]
        for narrow in (False, True):
            part = [o for o in open_ if (o[5] <= few) == narrow]
            if not part:
                continue
            spots = sorted({(o[0], o[2], o[3]) for o in part})
            table = values.sparkSession.createDataFrame(spots, "key string, lo double, hi double")
            inside = values.join(F.broadcast(table), "key").filter("v between lo and hi")  # a row a wanted rank
            if narrow:
                counted = inside.groupBy("key", "lo", "hi", "v").agg(F.sum("n").alias("n"))
                upto = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("key", "lo", "hi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
                asked = values.sparkSession.createDataFrame([(o[0], o[2], o[3], o[1], min(o[1] - o[4], o[5] - 1)) for o in part], "key string, lo double, hi double, rank bigint, place bigint")
                for x in upto.join(F.broadcast(asked), ["key", "lo", "hi"]).filter("place < upto and place >= upto - n").collect():
                    out[x.key][x.rank] = x.v
                continue
            cell = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS), F.lit(CELLS - 1))
            cells: dict[tuple, list] = {}
            for x in inside.groupBy("key", "lo", "hi", cell.alias("cell")).agg(F.sum("n").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect():
                cells.setdefault((x.key, x.lo, x.hi), []).append((x.cell, x.n, x.a, x.b))
            for o in part:
                place, first = min(o[1] - o[4], o[5] - 1), 0
                for _, n, a, b in sorted(cells[o[0], o[2], o[3]]):
                    if place < first + n:
                        o[2:] = [a, b, o[4] + first, n]
                        break
                    first += n
        open_ = wide
    return out


def interpolated(found: dict[int, float], share: float) -> float | None:
    """The quantile between the two ranks next to (count - 1) * share, from what ``order_statistics`` gives of a key."""
    if not found or found[-1] == 0:
        return None
    at = (found[-1] - 1) * share
    a, b = int(at), -int(-at // 1)
    return found[a] + (found[b] - found[a]) * (at - a)
