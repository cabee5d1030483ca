import pytest
from pyspark.sql import functions as F

from telemetry_rows import BASE, SECOND
from teletide.model import SCHEMAS
from teletide.operators import maintenance
from teletide.sources import requests, tables
from teletide.streaming import guard, jobs


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of Parquet batches, the stream over it and the rows delivered so far."""
    class Feed:
        def __init__(self, name, one_by_one=True):
            self.inbox, self.name = tmp_path / "in", name
            self.inbox.mkdir()
            self.one_by_one = one_by_one

        def add(self, df):
            df.coalesce(1).write.mode("append").parquet(str(self.inbox))

        def stream(self):
            return spark.readStream.schema(SCHEMAS[self.name]).option(
                "maxFilesPerTrigger", 1 if self.one_by_one else 100).parquet(str(self.inbox))

        def drain(self, stream):
            jobs.start(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
            return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    return Feed


def test_tail_delivers_late_rows_exactly_once(feed, logs):
    f = feed("logs")
    f.add(logs([{"body": "first", "observed_time": BASE}, {"body": "unplaced"}]))
    assert [r["body"] for r in f.drain(jobs.tail_stream(f.stream())).collect()] == ["first"]
    f.add(logs([{"body": "late", "time": BASE - 3600 * SECOND, "observed_time": BASE + SECOND}]))
    for _ in range(2):  # the second run finds nothing new
        got = f.drain(jobs.tail_stream(f.stream()))
        assert sorted(r["body"] for r in got.collect()) == ["first", "late"]


def test_guard_drops_repeats_within_and_across_batches_but_no_late_points(feed, gauge):
    f = feed("metrics_gauge")
    point = lambda t, v, **k: {"metric": "m", "point_time": BASE + t * SECOND, "value": v, **k}
    f.add(gauge([point(10, 1.0), point(10, 2.0), point(20, 3.0)]))
    f.add(gauge([point(10, 9.0), point(1, 4.0), point(20, 5.0, service="other")]))
    f.add(gauge([point(1, 8.0), point(30, 6.0), point(20, 7.0, attributes='{"host":"b"}')]))
    kept = guard.reject_stream(f.stream(), ["value"], arrival=["value"])
    got = f.drain(kept).select("service", ((F.col("point_time") - BASE) / SECOND).cast("int"), "value").collect()
    assert sorted(tuple(r) for r in got) == [
        ("other", 20, 5.0), ("web", 1, 4.0), ("web", 10, 1.0), ("web", 20, 3.0), ("web", 20, 7.0), ("web", 30, 6.0)]


def test_guard_forgets_beyond_its_bound(feed, gauge):
    f = feed("metrics_gauge")
    for t in (1, 2, 3, 1):
        f.add(gauge([{"metric": "m", "point_time": BASE + t, "value": float(t)}]))
    kept = guard.reject_stream(f.stream(), ["value"], arrival=["value"], recent=2, shards=1)
    assert f.drain(kept).count() == 4  # the first instant was pushed out before it came again


def test_windows_close_after_the_delay_and_equal_the_batch(feed, logs):
    f = feed("logs")
    f.add(logs([{"service": s, "time": BASE + t * SECOND} for s, t in [("a", 0), ("a", 30), ("b", 59)]]))
    f.add(logs([{"service": "a", "time": BASE + 50 * SECOND}, {"service": "a", "time": BASE + 300 * SECOND}]))
    counts = jobs.log_volume(f.stream(), "1 minute", "30 seconds")
    got = {(r["bucket"], r["service"]): r["count"] for r in f.drain(counts).collect()}
    first = BASE - BASE % (60 * SECOND)
    assert sum(got.values()) == 4 and (first, "a") in got


def test_span_counts(feed, spans):
    f = feed("spans")
    f.add(spans([{"start_time": BASE, "status_code": "ERROR"}, {"start_time": BASE},
                 {"start_time": BASE + 1000 * SECOND}]))
    (row,) = f.drain(jobs.span_red(f.stream(), "1 minute", "10 seconds")).collect()
    assert (row["calls"], row["errors"], row["service"], row["p50"]) == (2, 1, "web", 1e6)


def test_ingest_makes_each_batch_visible(spark, logs, tmp_path):
    inbox, table, check = (str(tmp_path / n) for n in ("inbox", "table", "check"))
    for i, body in enumerate(["one", "two"]):
        requests.from_logs(logs([{"service": "web", "body": body, "record_id": i}])).coalesce(1).write.mode(
            "append").text(inbox)
        jobs.ingest_logs(spark, inbox, table, check, files_per_trigger=1).awaitTermination()
        stored = tables.read_table(spark, "logs", table)
        assert stored.count() == i + 1
    assert {r["body"] for r in stored.collect()} == {"one", "two"}
    assert [str(r[0]) for r in stored.select("day").distinct().collect()] == ["2023-11-14"]


def test_ingest_of_spans_and_metrics(spark, spans, gauge, tmp_path):
    requests.from_spans(spans([{}, {}])).write.text(str(tmp_path / "t"))
    jobs.ingest_spans(spark, str(tmp_path / "t"), str(tmp_path / "spans"), str(tmp_path / "c1")).awaitTermination()
    assert tables.read_table(spark, "spans", str(tmp_path / "spans")).count() == 2
    points = gauge([{"metric": "m", "value": 1.5}])
    requests.from_gauge(points).write.text(str(tmp_path / "m"))
    jobs.ingest_metrics(spark, "metrics_gauge", str(tmp_path / "m"), str(tmp_path / "g"),
                        str(tmp_path / "c2")).awaitTermination()
    assert tables.read_table(spark, "metrics_gauge", str(tmp_path / "g")).first()["value"] == 1.5


def test_streamed_batch_and_compacted_rows_share_a_table(spark, logs, tmp_path):
    inbox, table, check = (str(tmp_path / p) for p in ("in", "table", "check"))
    for k in range(2):
        requests.from_logs(logs([{"body": f"s{k}"}, {"body": f"t{k}"}])).write.mode("append").text(inbox)
        jobs.ingest_logs(spark, inbox, table, check, files_per_trigger=1).awaitTermination()
        tables.write_table(logs([{"body": f"b{k}"}]), "logs", table)
    maintenance.compact(spark, "logs", table)
    rows = sorted(r["body"] for r in tables.read_table(spark, "logs", table).collect())
    assert rows == ["b0", "b1", "s0", "s1", "t0", "t1"]


def test_a_repeated_batch_is_appended_once(spark, logs, tmp_path, monkeypatch):
    table, staging, done = (str(tmp_path / p) for p in ("table", "table/_staging/0", "check/appended/0"))
    batch = logs([{"body": "a"}, {"body": "b"}])
    with monkeypatch.context() as broken:  # lost after the files were moved, before that was recorded
        broken.setattr(jobs.files, "mark", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.append_batch(batch, "logs", table, staging, done)
    for _ in range(2):
        jobs.append_batch(batch, "logs", table, staging, done)
    assert tables.read_table(spark, "logs", table).count() == 2


def test_tail_pages_deliver_ties_once(logs):
    rows = logs([{"body": f"{i}", "observed_time": 5 + i // 4, "time": None if i == 2 else 1, "record_id": i}
                 for i in range(7)] + [{"body": "never", "observed_time": None}])
    seen, cursor = [], None
    while page := jobs.tail_after(rows, cursor, limit=2).collect():
        seen += [r["body"] for r in page]
        cursor = tuple(page[-1][c] for c in ("observed_time", "time", "record_id"))
    assert seen == ["0", "1", "3", "2", "4", "5", "6"]


def test_ingest_accounts_for_what_it_cannot_store(spark, logs, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "table")
    requests.from_logs(logs([{"body": "good"}, {"body": "too"}])).write.text(str(inbox))
    record = '{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"timeUnixNano":"noon"},{"timeUnixNano":"7","body":{"stringValue":"third"}}]}]}]}'
    (inbox / "more.txt").write_text(f'{record}\n{{"resourceLogs": [\n\n   \nno json\n')
    jobs.ingest_logs(spark, str(inbox), table, str(tmp_path / "state")).awaitTermination()
    assert {r["body"] for r in tables.read_table(spark, "logs", table).collect()} == {"good", "too", "third"}
    assert [tuple(r)[1:] for r in jobs.receipts(spark, table).collect()] == [(3, 1, 2)]
    letters = sorted((r["kind"], r["text"]) for r in jobs.dead_letters(spark, table).collect())
    assert letters == [("line", "no json"), ("line", '{"resourceLogs": ['), ("record", '{"timeUnixNano":"noon"}')]
    assert jobs.receipts(spark, str(tmp_path / "none")).count() == 0


def test_a_batch_is_parsed_once_and_has_files_for_every_core(spark, monkeypatch):
    from teletide.plans import streams
    plans, given, append, ingest = [], [], jobs.append_batch, jobs.ingest_logs

    def appended(batch, *place):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        append(batch, *place)

    def ingested(*args, files_per_trigger):
        given.append(files_per_trigger)
        return ingest(*args, files_per_trigger=files_per_trigger)
    monkeypatch.setattr(jobs, "append_batch", appended)
    monkeypatch.setattr(jobs, "ingest_logs", ingested)
    (row,) = streams.stream_dead_letters(spark, "/root/testdata/sf0.001").collect()
    assert row["stored"] == row["accepted"] == 1000 and row["letters"] == row["malformed"] + row["broken_lines"] > 0
    assert plans and all("InMemoryTableScan" in p for p in plans)
    assert given[0] >= spark.sparkContext.defaultParallelism
