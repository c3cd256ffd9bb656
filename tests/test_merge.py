from datetime import datetime

import pytest
from pyspark.sql import functions as F

from priorview.operators import merge as M
from priorview.operators import quality as Q
from priorview.sources import tables as T
from priorview.streaming.merge import read_stream, stream_counts, stream_upserts

R = "id string, v int, at timestamp"
t = lambda d: datetime(2020, 1, d)


def test_upsert(spark, tmp_path, rows):
    old, new = spark.createDataFrame([("a", 1, t(5)), ("b", 2, t(5)), (None, 9, t(1))], R), spark.createDataFrame([("a", None, t(1)), ("c", 3, t(2))], R)
    assert rows(M.upsert(old, new, ["id"], "at")) == sorted([("a", None, t(5)), ("b", 2, t(5)), ("c", 3, t(2)), (None, 9, t(1))], key=str)
    path = str(tmp_path / "table")
    for _ in range(2):  # twice is once
        assert M.upsert_table(spark, path, old, ["id"], "at") == 3 and M.upsert_table(spark, path, new, ["id"], "at") == 2
    assert {r.id: r.v for r in spark.read.parquet(path).filter("id is not null").collect()} == {"a": None, "b": 2, "c": 3}
    assert M.upsert_table(spark, path, new.limit(0), ["id"]) == 0
    with pytest.raises(ValueError):
        M.upsert_table(spark, path, new.unionAll(new), ["id"])


def test_many_rows(spark, tmp_path):
    path = str(tmp_path / "many")
    many = spark.range(1200).select(F.col("id").cast("string"), F.lit(1).alias("v"), F.lit(t(1)).alias("at"))
    assert M.upsert_table(spark, path, many, ["id"]) == 1200 and M.upsert_table(spark, path, many.withColumn("v", F.lit(2)), ["id"]) == 1200
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("v")).first() == (1200, 2400)


def test_precedence_queue_and_registry(spark, rows):
    a, b = spark.createDataFrame([("x", "one"), (None, "n")], "k string, s string"), spark.createDataFrame([("x", "two", 1), ("y", "two", 2)], "k string, s string, n int")
    assert rows(M.by_precedence([a, b], "k")) == [("x", "one", None), ("y", "two", 2)]
    q = M.merge_queue(spark.createDataFrame([("x", "", "new"), ("z", "f", "new")], "k string, m string, q string"), spark.createDataFrame([("x", "m", "old"), ("y", "m", "old")], "k string, m string, q string"), "k", ["q"])
    assert rows(q) == [("x", "m", "old"), ("y", "m", "old"), ("z", "f", "new")]
    seen = spark.createDataFrame([("e1",), ("e2",)], "e string")
    first = M.registry(seen.limit(1), spark.createDataFrame([], "e string, discovered_at timestamp, last_seen_at timestamp"), "e", "2020-01-01 00:00:00")
    assert rows(M.registry(seen, first, "e", "2020-02-01 00:00:00")) == [("e1", t(1), datetime(2020, 2, 1)), ("e2", datetime(2020, 2, 1), datetime(2020, 2, 1))]


def test_unseen_and_pages(spark, rows):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(M.unseen(wanted, "k", spark.createDataFrame([("a",), (None,)], "x string"), spark.createDataFrame([("b",)], "y string"))) == [("c",)]
    pages = spark.createDataFrame([("u", "x"), ("v", "x"), ("w", "y"), ("z", None)], "url string, html string")
    held = pages.filter("url = 'v'").select("url", F.sha2("html", 256).alias("content_hash")).unionByName(spark.createDataFrame([("w", "old")], "url string, content_hash string"))
    assert rows(M.store_pages(pages, held).select("url", "fetch_status")) == [("u", "fetched"), ("v", "unchanged"), ("w", "updated"), ("z", "failed")]


def test_reports(spark, rows):
    df = spark.createDataFrame([("1", "A", 1, None), ("2", "A", None, 5), ("3", None, 3, 5), ("4", "B", 3, 5)], "id string, name string, h int, dob int")
    assert rows(Q.profile_flags(df, "id", "name", ["h", "dob"], "dob", 2)) == [("1", "A", "duplicate_name; missing_dob", 2), ("2", "A", "duplicate_name", 1), ("3", None, "missing_name", 1)]
    assert rows(Q.missingness(df, ["h", "dob"])) == [("dob", 1, 4, 0.25, False), ("h", 1, 4, 0.25, False)]
    assert rows(Q.unknown_values(df, "name", ["A"])) == [("B", 1), (None, 1)]
    assert rows(Q.failing(df, {"x": F.col("h") == 3})) == [("x", 2)]
    whole, parts = spark.createDataFrame([("k", 10), ("l", 5)], "k string, n int"), spark.createDataFrame([("k", 4), ("k", 4), ("l", 4)], "k string, n int")
    assert rows(Q.sums_differ(whole, parts, ["k"], ["n"])) == [("k", "n", 10, 8)]
    g = Q.gaps(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string"), spark.createDataFrame([("b", "failed"), ("c", "fetched"), ("a", "failed")], "k string, status string"), spark.createDataFrame([("a",)], "k string"), "k")
    assert rows(g) == [("a", "ok"), ("b", "fetch_failed"), ("c", "missing_stats"), ("d", "not_fetched")]
    empty = df.limit(0)
    assert Q.distribution(empty, ["h"]).first().mean is None and Q.correlations(empty, ["h"], "dob").first().r is None and Q.completeness(df, ["h", "dob"], "name").count() == 4


def test_files(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text('id,name\n1,"a ""b"", c"\n2,\n', encoding="utf-8")
    df = T.read_csv(spark, str(tmp_path / "x.csv"), ["id", "name"])
    assert rows(df) == [("1", 'a "b", c'), ("2", None)]
    assert T.read_csv(spark, str(tmp_path / "none.csv"), ["id"], optional=True).count() == 0
    assert rows(T.with_status(df.select(F.col("id").alias("event_id")), spark.createDataFrame([("1", "upcoming")], "event_id string, event_status string"))) == [("1", "upcoming"), ("2", "completed")]
    (tmp_path / "p.html").write_bytes(b"<a href=\"x\">\xff</a>")
    assert T.read_pages(spark, str(tmp_path / "*.html")).first().html.startswith('<a href="x">')
    T.write_report(df, str(tmp_path / "r"), ["id"])
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 2
    T.append_log(df, str(tmp_path / "log"))
    T.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    assert T.numeric_columns(spark.createDataFrame([], "a decimal(5,2), b smallint, c string, d double")) == ["a", "b"]


def test_streams(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1, t(1)), ("a", 2, t(2)), ("b", 1, t(1))], R).write.parquet(src)
    for _ in range(2):
        stream_upserts(read_stream(spark, src), table, ["id"], "at", str(tmp_path / "ck")).awaitTermination()
    spark.createDataFrame([("b", 5, t(3))], R).write.mode("append").parquet(src)
    stream_upserts(read_stream(spark, src), table, ["id"], "at", str(tmp_path / "ck")).awaitTermination()
    assert {r.id: r.v for r in M.read_buckets(spark, table).collect()} == {"a": 2, "b": 5}
    q = stream_counts(read_stream(spark, src), "at", ["id"]).writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r["rows"] for r in spark.sql("select rows from counted").collect()) == 4


@pytest.mark.parametrize("stop", [1, 2])
def test_a_replacement_that_stops_between_the_renames_loses_nothing(spark, tmp_path, monkeypatch, stop):
    """The writer dies at its first or second rename; the next one finds the old rows, wherever they lie."""
    path = str(tmp_path / "t")
    M.upsert_table(spark, path, spark.createDataFrame([("a", 1, t(1)), ("b", 2, t(1))], R), ["id"])
    move, calls = M._move, []

    def dying(fs, source, target):
        calls.append(1)
        if len(calls) == stop:
            raise KeyboardInterrupt
        move(fs, source, target)

    monkeypatch.setattr(M, "_move", dying)
    with pytest.raises(KeyboardInterrupt):
        M.upsert_table(spark, path, spark.createDataFrame([("c", 3, t(1))], R), ["id"])
    monkeypatch.setattr(M, "_move", move)
    assert (tmp_path / "t").exists() == (stop == 1)
    assert M.recover_table(spark, path) and {r.id for r in spark.read.parquet(path).collect()} == {"a", "b"}
    M.upsert_table(spark, path, spark.createDataFrame([("d", 4, t(1))], R), ["id"])
    assert {r.id for r in spark.read.parquet(path).collect()} == {"a", "b", "d"} and not (tmp_path / "t.before").exists()


def test_a_failed_rename_is_no_success(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    M.upsert_table(spark, path, spark.createDataFrame([("a", 1, t(1))], R), ["id"])
    real = M._move

    def fails(fs, source, target):
        if source.toString().endswith(".staging"):
            raise OSError("no")
        real(fs, source, target)

    monkeypatch.setattr(M, "_move", fails)
    with pytest.raises(OSError):
        M.upsert_table(spark, path, spark.createDataFrame([("b", 1, t(1))], R), ["id"])
    assert [r.id for r in spark.read.parquet(path).collect()] == ["a"]


def test_buckets(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.range(200).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("v"), F.lit(t(2)).alias("at"))
    assert M.upsert_buckets(spark, path, rows, ["id"], "at", 8) == 200
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "b").glob("bucket=*/*.parquet")}
    one = spark.createDataFrame([("k7", 5, t(1))], R)
    for _ in range(2):
        assert M.upsert_buckets(spark, path, one, ["id"], "at", 8) == 1
    after = {p for p in (tmp_path / "b").glob("bucket=*/*.parquet")}
    assert len({p.parent for p in before} - {p.parent for p in before if p not in after}) == 7  # one bucket was written anew
    got = {r.id: (r.v, r.at) for r in M.read_buckets(spark, path, 8).collect()}
    assert len(got) == 200 and got["k7"] == (5, t(2)) and M.upsert_buckets(spark, path, one.limit(0), ["id"], "at", 8) == 0


def test_keyed_sink_stamps_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("a", "f", 1)], "fighter_id string, fight_id string, v int")
    for v in (1, 2):
        assert M.keyed_sink(spark, path, df.withColumn("v", F.lit(v)), ["fighter_id", "fight_id"]) == 1
    r = spark.read.parquet(path).collect()
    assert len(r) == 1 and r[0].v == 2 and r[0].computed_at is not None


def test_what_to_fetch_and_the_bout_queue(spark, rows):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "k string")
    log = spark.createDataFrame([("a", "failed"), ("b", "updated"), ("d", "failed"), ("d", "fetched"), ("e", "unchanged")], "k string, fetch_status string")
    assert rows(M.to_fetch(wanted, "k", log, spark.createDataFrame([("c",)], "k string"))) == [("a",)]
    assert rows(M.to_fetch(wanted, "k", log, spark.createDataFrame([("c",)], "k string"), spark.createDataFrame([("b",), ("a",), (None,)], "e string"))) == [("a",), ("b",)]
    S = "event_id string, event_status string"
    status = M.status_index(spark.createDataFrame([("e1", "upcoming"), ("e2", "upcoming"), ("e3", "")], S), spark.createDataFrame([("e1", "completed")], S))
    assert rows(status) == [("e1", "completed"), ("e2", "upcoming"), ("e3", "completed")]
    B = "fight_id string, event_id string, fight_url string, finish_method string"
    one, two = spark.createDataFrame([("f1", "e1", "u1", "decision"), ("f2", "e2", "u2", "dq"), ("f4", "e9", "u4", "")], B), spark.createDataFrame([("f1", "e1", "v1", ""), ("f3", "e3", "v3", "")], B)
    old = spark.createDataFrame([("f4", "e8", "w4", "other", "done", t(1)), ("f5", "e5", "w5", "", "pending", t(1))], B + ", stats_status string, queued_at timestamp")
    got = rows(M.bout_queue([one, two], status, old, "2020-02-01 00:00:00"))
    assert got == [("f1", "e1", "u1", "decision", "pending", datetime(2020, 2, 1)), ("f3", "e3", "v3", None, "pending", datetime(2020, 2, 1)), ("f4", "e9", "u4", "other", "done", t(1)), ("f5", "e5", "w5", None, "pending", t(1))]


def test_kept_pages_and_seeds(spark, tmp_path, rows):
    path, P = str(tmp_path / "pages"), "url string, html string"
    first = M.keep_pages(spark, path, spark.createDataFrame([("u", "x"), ("v", "y"), ("w", None)], P))
    assert rows(first.select("url", "fetch_status")) == [("u", "fetched"), ("v", "fetched"), ("w", "failed")]
    again = M.keep_pages(spark, path, spark.createDataFrame([("u", "x"), ("v", "z"), ("n", "")], P))
    assert rows(again.select("url", "fetch_status")) == [("n", "fetched"), ("u", "unchanged"), ("v", "updated")]
    assert rows(spark.read.parquet(path).select("url", "html")) == [("n", ""), ("u", "x"), ("v", "z")]
    listing, queue = spark.createDataFrame([("l",), ("l",), ("",)], "url string"), spark.createDataFrame([("q",), (None,)], "url string")
    assert rows(M.seeds("s", queue, listing)) == [("s",)] and rows(M.seeds(None, queue, listing)) == [("q",)] and rows(M.seeds(None, queue.limit(0), listing)) == rows(M.seeds(None, None, listing)) == [("l",)]
