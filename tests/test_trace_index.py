import os
import re

import duckdb
import pytest

from telemetry_rows import BASE
from teletide.model import NS_PER_DAY
from teletide.operators import maintenance, traces as T
from teletide.operators.traces import TraceQuery
from teletide.sources import files, requests, tables, traceindex
from teletide.store import Telemetry
from teletide.streaming import jobs


def span(trace, number, day, **more):
    return {"trace_id": f"{trace:032x}", "span_id": f"{trace * 100 + number:016x}", "start_time": BASE + day * NS_PER_DAY,
            **({"parent_span_id": f"{trace * 100:016x}"} if number else {}), **more}


ROWS = [span(1, 0, 0, status_code="ERROR"), span(1, 1, 1), span(1, 2, 5), span(2, 0, 2), span(2, 1, 3), span(3, 0, 4),
        span(4, 0, 6, status_code="ERROR"), span(4, 1, 6)]


@pytest.fixture
def stored(spark, spans, tmp_path):
    def build(*batches, **options):
        for rows in batches:
            tables.write_table(spans(rows), "spans", str(tmp_path / "spans"), **options)
        return str(tmp_path)
    return build


def entries(spark, path):
    return sorted((int(r["trace_id"], 16), r["day"].day) for r in traceindex.read(spark, f"{path}/spans").distinct().collect())


def expected(rows):
    return sorted({(int(r["trace_id"], 16), 14 + (r["start_time"] - BASE) // NS_PER_DAY) for r in rows if r["trace_id"]})


def days_read(df):
    """The days of each scan of the spans with a filter on its partitions."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [set(re.findall(r"\d{4}-\d\d-(\d\d)", found)) for found in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)]


def test_every_write_enters_its_spans(spark, stored):
    path = stored(ROWS[:5], ROWS[5:])
    assert entries(spark, path) == expected(ROWS)
    assert spark.read.parquet(f"{path}/spans").count() == len(ROWS)
    assert files.children(spark, f"{path}/spans/_staging") == []
    assert len(files.children(spark, f"{path}/spans/{traceindex.FOLDER}")) == 2
    maintenance.compact(spark, "spans", f"{path}/spans")
    assert len(files.children(spark, f"{path}/spans/{traceindex.FOLDER}")) == 1 and entries(spark, path) == expected(ROWS)


def test_second_scans_read_the_days_of_the_trace_only(spark, stored):
    db = Telemetry.open(spark, stored(ROWS[:3], ROWS[3:]), ["spans"])
    trace = db.get_trace(f"{1:032x}")
    assert {"14", "15", "19"} in days_read(trace) and trace.count() == 3
    failed = TraceQuery(status="ERROR", end=BASE + NS_PER_DAY)
    found = db.search_traces(failed)
    assert {"14", "15", "19"} in days_read(found) and "Bloom" not in str(days_read(found))
    assert [(r["span_count"], r["error"]) for r in found.collect()] == [(3, True)]
    assert found.collect() == T.search_traces(db.table("spans"), failed).collect()
    matched = T.spanset_match(db.table("spans"), TraceQuery(status="ERROR"), BASE, BASE + NS_PER_DAY, db.trace_index)
    assert [r["trace_id"] for r in matched.collect()] == [f"{1:032x}"]
    spans = db.spans_of(matched)
    assert {"14", "15", "19"} in days_read(spans) and spans.count() == 3
    assert {r["root_span_id"] for r in db.trace_forest(f"{1:032x}").collect()} == {f"{100:016x}"}
    assert db.get_trace("ab" * 16).count() == 0


def test_more_traces_than_are_named(spark, stored):
    many = [span(t, 0, t % 7, status_code="ERROR") for t in range(1, 60)]
    db = Telemetry.open(spark, stored([*many, *[span(t, 1, 3) for t in range(1, 60)]]), ["spans"])
    found = db.search_traces(TraceQuery(status="ERROR", start=BASE, end=BASE + 2 * NS_PER_DAY))
    assert {"14", "15", "17"} in days_read(found)
    assert all(r["span_count"] == 2 for r in found.collect()) and found.count() == 17


def test_spans_without_a_time_or_an_id(spark, stored):
    rows = [span(1, 0, 0), {**span(1, 1, 0), "start_time": None}, {**span(5, 0, 0), "trace_id": None}]
    db = Telemetry.open(spark, stored(rows), ["spans"])
    assert db.get_trace(f"{1:032x}").count() == 2 and db.table("spans").count() == 3
    stored([])
    assert Telemetry.open(spark, os.path.dirname(db_path(db)), ["spans"]).table("spans").count() == 3


def db_path(db):
    return re.match(r"file:(.*)/day=", db.table("spans").inputFiles()[0])[1]


def test_tables_without_an_index(spark, spans, stored):
    path = stored(ROWS[:3], trace_index=False)
    db = Telemetry.open(spark, path, ["spans"])
    assert db.trace_index is None and db.get_trace(f"{1:032x}").count() == 3
    stored(ROWS[3:])  # the first write with an index makes one for what is there
    assert entries(spark, path) == expected(ROWS)
    tables.write_table(spans(ROWS[:2]), "spans", f"{path}/spans", mode="overwrite")
    assert entries(spark, path) == expected(ROWS[:2])


def test_snapshots_and_overwritten_builds(spark, stored, tmp_path):
    path = stored(ROWS)
    maintenance.snapshot(spark, f"{path}/spans", str(tmp_path / "copy/spans"))
    assert entries(spark, str(tmp_path / "copy")) == expected(ROWS)
    traceindex.rebuild(spark, f"{path}/spans")
    assert entries(spark, path) == expected(ROWS) and len(files.children(spark, f"{path}/spans/{traceindex.FOLDER}")) == 1
    assert traceindex.compact(spark, f"{path}/spans") == 0


def test_bloom_filters_are_written(spark, stored):
    path = stored(ROWS)
    for folder in ("day=*", f"{traceindex.FOLDER}/*"):
        found = duckdb.sql(f"SELECT bloom_filter_offset FROM parquet_metadata('{path}/spans/{folder}/*.parquet') WHERE path_in_schema = 'trace_id'")
        offsets = [r[0] for r in found.fetchall()]
        assert any(o is not None for o in offsets)  # a column of repeated values has its dictionary instead


def test_streamed_spans_are_entered_once_published(spark, spans, tmp_path):
    inbox, table = str(tmp_path / "in"), str(tmp_path / "spans")
    requests.from_spans(spans(ROWS)).write.text(inbox)
    jobs.ingest_spans(spark, inbox, table, str(tmp_path / "state")).awaitTermination()
    assert entries(spark, str(tmp_path)) == expected(ROWS)
    batch = spans([span(9, 0, 1)])
    for _ in range(2):  # an attempt that broke off after entering its spans
        jobs.append_batch(batch, "spans", table, str(tmp_path / "staging"), str(tmp_path / "done"))
    assert Telemetry.open(spark, str(tmp_path), ["spans"]).get_trace(f"{9:032x}").count() == 1
