"""Operators answer alike on both sides of their size constants, missing values included."""

import pytest

from teletide.operators import logs as L, quantiles, ranking, traces as T
from teletide.operators.logs import LogQuery

from telemetry_rows import BASE, SECOND


def test_group_without_values_is_kept(spark):
    rows = [("a", None)] * 10 + [("b", v) for v in (1, 5, None, 9, -3)]
    df = spark.createDataFrame(rows, "service string, d bigint")
    got = [sorted(map(tuple, quantiles.group_quantiles(df, ["service"], "d", {"p50": 0.5}, split_above=n).collect()), key=str)
           for n in (100, 7, 1)]
    assert got[0] == got[1] == got[2] and ("a", 10, None) in got[0]


@pytest.mark.parametrize("hot", [1_000_000, 2, 1])
def test_positions_with_missing_values(logs, monkeypatch, hot):
    monkeypatch.setattr(ranking, "HOT_CELL", hot)
    ids = [7, 2 ** 62, -5, 2 ** 40, 11, 3, 2 ** 61 + 1]
    rows = logs([{"record_id": r, "time": t, "observed_time": o} for r, t, o in zip(
        ids, [BASE, BASE, BASE, None, BASE, None, BASE + SECOND], [None, BASE, BASE, BASE, None, None, BASE + 1])])
    for axis in ("time", "observed_time"):
        for backward in (False, True):
            q = LogQuery(order_by=axis, backward=backward)
            placed = [r["record_id"] for r in L.positions(rows, q).orderBy("rn").collect()]
            assert placed == [r["record_id"] for r in L.query_logs(rows, q).collect()]


@pytest.mark.parametrize("merged", [100_000, 1])
@pytest.mark.parametrize("tie", [["record_id"], ["body", "record_id"]])
def test_pages_with_missing_values(logs, monkeypatch, merged, tie):
    monkeypatch.setattr(L, "MERGED_ROWS", merged)
    rows = logs([{"record_id": None if i == 2 else i, "time": None if i == 4 else BASE, "body": "ba"[i % 2]} for i in range(6)])
    got = [r["record_id"] for r in L.query_logs(rows, LogQuery(limit=6, tie_break=tie)).collect()]
    assert got == ([0, 1, 3, 5, None, 4] if tie == ["record_id"] else [1, 3, 5, 0, None, 4])


def test_keyset_pages_along_arrival(logs):
    rows = logs([{"record_id": i, "time": BASE + i % 2, "observed_time": None if i > 6 else BASE + i // 3} for i in range(9)])
    for backward in (False, True):
        q = LogQuery(order_by="observed_time", backward=backward, limit=2)
        every = [r["record_id"] for r in L.query_logs(rows, LogQuery(order_by="observed_time", backward=backward)).collect()]
        page, seen = L.query_logs(rows, q).collect(), []
        while page:
            seen += [r["record_id"] for r in page]
            page = L.log_page_after(rows, q, page[-1].asDict()).collect()
        assert seen == every


@pytest.mark.parametrize("bound", [64 << 20, -1])
def test_spans_without_a_trace(spans, monkeypatch, bound):
    import teletide.session as session
    monkeypatch.setattr(session, "BROADCAST_BYTES", bound)
    rows = spans([{}, {"trace_id": None}, {"trace_id": None, "span_id": None}, {"start_time": None}])
    assert T.search_traces(rows, T.TraceQuery()).count() == 1
    assert T.spanset_match(rows, T.TraceQuery()).count() == 2
    assert {r["in_cycle"] for r in T.trace_forest(rows).collect()} == {False}


@pytest.mark.parametrize("hot", [1_000_000, 1])
def test_lists_of_a_hot_trace(spans, monkeypatch, hot):
    monkeypatch.setattr(ranking, "HOT_CELL", hot)
    rows = spans([{"start_time": None if i % 2 else BASE} for i in range(6)])
    lists = T.spanset_lists(T.spanset_match(rows, T.TraceQuery())).collect()
    assert [len(r["span_ids"]) for r in lists] == [6]
    assert [r["part"] for r in sorted(T.spanset_lists(T.spanset_match(rows, T.TraceQuery()), 4).collect(), key=lambda r: r["part"])] == [0, 1]
