"""Keyed merges: upserts, precedence merges, incremental selection and a content-addressed store."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from priorview.session import materialise


def assert_unique(rows: DataFrame, keys: list[str]) -> None:
    """Raises if two rows share a key: which of them should win isn't defined."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two rows have the key {[twice[0][k] for k in keys]}")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` inserted or, by key, overwritten as whole rows (nulls too).

    ``newest`` names a column that never goes back: it keeps the greater of both values, though the other columns
    of an older row still overwrite. Keys must be unique on each side; null keys match nothing.
    """
    rest = [c for c in old.columns if c not in keys]
    pick = lambda c: F.greatest(F.col(f"n.{c}"), F.col(f"o.{c}")) if c == newest else F.when(F.col("n._there"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    n, o = new.select(*old.columns).withColumn("_there", F.lit(True)).alias("n"), old.alias("o")
    both = o.join(n, reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]), "full_outer")
    return both.select(*[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys], *[pick(c).alias(c) for c in rest]).select(*old.columns)


def _path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path itself."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _beside(spark: SparkSession, path: str, suffix: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + suffix)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"can't move {source} to {target}")


def recover_table(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` is there; what an interrupted replacement put aside is put back first."""
    fs, target = _path(spark, path)
    aside = _beside(spark, path, ".before")
    if not fs.exists(target) and fs.exists(aside):
        _move(fs, aside, target)
    return fs.exists(target)


def replace_table(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Writes ``rows``, which may come from the table at ``path``, in its place.

    They are written beside the table, which is then put aside and replaced by renames. Old rows are deleted last, so at
    every moment the old or the new table is whole in ``path`` or, between the renames, aside in ``path``.before, from
    where the next call (or ``recover_table``) takes it back. One writer at a time.
    """
    staging = _beside(spark, path, ".staging")
    rows.write.mode("overwrite").parquet(staging.toString())
    put_in_place(spark, path)


def put_in_place(spark: SparkSession, path: str) -> None:
    """What was written to ``path``.staging takes the place of ``path``."""
    fs, target = _path(spark, path)
    staging, aside = _beside(spark, path, ".staging"), _beside(spark, path, ".before")
    if recover_table(spark, path):
        fs.delete(aside, True)
        _move(fs, target, aside)
    try:
        _move(fs, staging, target)
    except Exception:
        recover_table(spark, path)
        raise
    fs.delete(aside, True)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], newest: str | None = None) -> int:
    """Upserts into the parquet table at ``path`` (made if absent) and returns how many rows were given.

    A reader or a failed writer never sees half of it, and no step loses what was there (``replace_table``).
    """
    new = new.persist()
    try:
        assert_unique(new, keys)
        n = new.count()
        replace_table(spark, upsert(spark.read.parquet(path), new, keys, newest) if recover_table(spark, path) else new, path)
        return n
    finally:
        new.unpersist()


def upsert_buckets(spark: SparkSession, path: str, new: DataFrame, keys: list[str], newest: str | None = None, buckets: int = 64) -> int:
    """As ``upsert_table``, into a table of ``buckets`` folders by a hash of the keys: only folders that get rows are read
    and written anew, each replaced like a table of its own. A batch given twice changes nothing the second time, so one
    that failed halfway is given again. ``buckets`` has to stay the same; ``read_buckets`` reads the table."""
    new = new.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
    try:
        assert_unique(new, keys)
        touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # at most ``buckets``
        n = new.count() if touched else 0
        there = [b for b in touched if recover_table(spark, f"{path}/bucket={b}")]
        merged = new
        if there:
            old = spark.read.parquet(*[f"{path}/bucket={b}" for b in there]).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
            merged = upsert(old, new, [*keys, "_bucket"], newest)
        fs, staging = _path(spark, f"{path.rstrip('/')}.merging")
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(staging.toString())
        for b in touched:
            _, target = _path(spark, f"{path}/bucket={b}")
            aside = _beside(spark, target.toString(), ".before")
            fs.mkdirs(target.getParent())
            if b in there:
                fs.delete(aside, True)
                _move(fs, target, aside)
            _move(fs, spark._jvm.org.apache.hadoop.fs.Path(staging, f"_bucket={b}"), target)
            fs.delete(aside, True)
        fs.delete(staging, True)
        return n
    finally:
        new.unpersist()


def read_buckets(spark: SparkSession, path: str, buckets: int = 64) -> DataFrame:
    """The rows of a table of buckets, those of an interrupted replacement too."""
    return spark.read.parquet(*[f"{path}/bucket={b}" for b in range(buckets) if recover_table(spark, f"{path}/bucket={b}")])


def keyed_sink(spark: SparkSession, path: str, rows: DataFrame, keys: list[str]) -> int:
    """Upserts computed rows with ``computed_at``, the time of this call in UTC; returns how many."""
    return upsert_table(spark, path, rows.withColumn("computed_at", F.lit(datetime.now(UTC).replace(tzinfo=None).isoformat(" ") + "+00:00").cast("timestamp")), keys)


def by_precedence(sources: list[DataFrame], key: str) -> DataFrame:
    """One row a key, from the first of ``sources`` that has it; columns that a source lacks are null. Rows without key are left out."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn("_p", F.lit(i)) for i, s in enumerate(sources)])
    cols = [c for c in rows.columns if c not in (key, "_p")]
    best = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("_p", *cols)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in cols])


def merge_queue(new: DataFrame, old: DataFrame, key: str, preserved: list[str]) -> DataFrame:
    """``new`` over ``old`` by key: ``preserved`` columns keep the old value where there is one, others take the new
    unless it is null or empty; keys that only ``old`` has are carried on."""
    n, o = new.alias("n"), old.select(*new.columns).alias("o")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    text = dict(new.dtypes)
    full = lambda c: F.nullif(F.col(c), F.lit("")) if text[c.split(".")[1]] == "string" else F.col(c)
    pick = lambda c: F.coalesce(full(f"o.{c}"), full(f"n.{c}")) if c in preserved else F.coalesce(full(f"n.{c}"), full(f"o.{c}"))
    return both.select(*[pick(c).alias(c) for c in new.columns])


def registry(seen: DataFrame, old: DataFrame, key: str, now: str) -> DataFrame:
    """``old`` brought up to date with ``seen``: discovered_at is set once, last_seen_at whenever a key is seen."""
    stamped = seen.withColumn("discovered_at", F.lit(now).cast("timestamp")).withColumn("last_seen_at", F.lit(now).cast("timestamp"))
    return merge_queue(stamped, old, key, ["discovered_at"])


def unseen(wanted: DataFrame, key: str, *seen: DataFrame) -> DataFrame:
    """Rows of ``wanted`` whose key is in none of ``seen`` (first columns); what an incremental run has yet to do."""
    return reduce(lambda d, s: d.join(s.select(F.col(s.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct(), key, "left_anti"), seen, wanted)


#: States of a fetch that left a page.
CAPTURED = ("fetched", "unchanged", "updated")


def to_fetch(wanted: DataFrame, key: str, log: DataFrame, parsed: DataFrame, upcoming: DataFrame | None = None) -> DataFrame:
    """Rows of ``wanted`` that a run has to fetch: neither parsed nor captured; failed ones come again, and so do those
    whose key is in ``upcoming`` (first column), whatever is held of them.

    log: (key, fetch_status) of all fetches, of which one that left a page counts.
    """
    held = log.filter(F.col("fetch_status").isin(*CAPTURED)).select(key)
    open_ = unseen(wanted, key, held, parsed.select(key))
    if upcoming is None:
        return open_
    again = wanted.join(upcoming.select(F.col(upcoming.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct(), key, "left_semi")
    return open_.unionByName(again).distinct()


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def store_pages(pages: DataFrame, held: DataFrame) -> DataFrame:
    """(url, content_hash, fetch_status) of fetched pages (url, html) against the hashes held (url, content_hash):
    fetched (new), unchanged or updated; failed where there is no page. Repeated fetches of a url come out each."""
    now = pages.select("url", F.sha2("html", 256).alias("content_hash"))
    old = held.select("url", F.col("content_hash").alias("_old")).distinct()
    status = F.when(F.col("content_hash").isNull(), "failed").when(F.col("_old").isNull(), "fetched").when(F.col("_old") == F.col("content_hash"), "unchanged").otherwise("updated")
    return now.join(old, "url", "left").select("url", "content_hash", status.alias("fetch_status"))


def keep_pages(spark: SparkSession, path: str, pages: DataFrame) -> DataFrame:
    """Stores fetched pages (url, html) in the table at ``path`` (url, content_hash, html): new ones are added, changed ones
    overwritten, others left as they are. Returns (url, content_hash, fetch_status) of each; a url fetched twice at a time is an error."""
    held = spark.read.parquet(path).select("url", "content_hash") if recover_table(spark, path) else spark.createDataFrame([], "url string, content_hash string")
    status = store_pages(pages, held).persist()
    try:
        status.count()  # what was held has to be read before it is overwritten
        fresh = status.filter(F.col("fetch_status").isin("fetched", "updated")).select("url", "content_hash").join(pages.select("url", "html"), "url")
        upsert_table(spark, path, fresh, ["url"])
        return materialise(status, "fetched")
    finally:
        status.unpersist()


def seeds(single: str | None, queue: DataFrame | None, listing: DataFrame, url: str = "url") -> DataFrame:
    """(url) to start a crawl from: the one address that was asked for, else the queue if it has any, else the listing; each once."""
    if single:
        return listing.sparkSession.createDataFrame([(single,)], f"`{url}` string")
    named = lambda df: df.select(F.nullif(F.trim(url), F.lit("")).alias(url)).filter(F.col(url).isNotNull()).distinct()
    queued = named(queue) if queue is not None else None
    return queued if queued is not None and not queued.isEmpty() else named(listing)


def status_index(events: DataFrame, manifest: DataFrame) -> DataFrame:
    """(event_id, event_status) of every event of either, the manifest's before the events'; 'completed' where neither says."""
    each = [t.select("event_id", F.coalesce(F.nullif(F.trim("event_status"), F.lit("")), F.lit("completed")).alias("event_status")) for t in (manifest, events)]
    return by_precedence(each, "event_id")


def bout_queue(sources: list[DataFrame], status: DataFrame, old: DataFrame, now: str) -> DataFrame:
    """(fight_id, event_id, fight_url, finish_method, stats_status, queued_at): bouts whose stats are to be fetched.

    sources: (fight_id, event_id, fight_url, finish_method), the first that has a bout counts; bouts of events that are
    upcoming by ``status`` (event_id, event_status) are left out. A bout of ``old`` keeps when it was queued, its state, and its
    method if the source has none; new ones are pending since ``now``; those that no source has any more are carried on.
    """
    ahead = status.filter("event_status = 'upcoming'").select("event_id")
    found = by_precedence([s.join(ahead, "event_id", "left_anti").select("fight_id", "event_id", "fight_url", "finish_method") for s in sources], "fight_id")
    fresh = found.withColumn("stats_status", F.lit("pending")).withColumn("queued_at", F.lit(now).cast("timestamp"))
    return merge_queue(fresh, old, "fight_id", ["stats_status", "queued_at"])
