import random

import pytest

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators import traces as T
from teletide.operators.quantiles import exact_quantiles
from teletide.operators.traces import SpanMetricsQuery, TraceQuery


def tree(df):
    return {r["span_id"]: r for r in T.trace_forest(df).collect()}


def span(id_, parent=None, **more):
    return {"span_id": id_, "parent_span_id": parent, **more}


@pytest.mark.parametrize("hot_cell", [1_000_000, 1])
def test_forest_shape(spans, hot_cell, monkeypatch):
    monkeypatch.setattr("teletide.operators.ranking.HOT_CELL", hot_cell)
    rows = [span("gc", "A", start_time=300), span("B", "root", start_time=250),
            span("orphan", "missing", start_time=400), span("A", "root", start_time=200),
            span("root", None, start_time=100)]
    got = tree(spans(rows))
    place = {k: (r["root_span_id"], r["depth"], r["sibling_rank"], r["in_cycle"]) for k, r in got.items()}
    assert place == {"root": ("root", 0, 1, False), "orphan": ("orphan", 0, 2, False),
                     "A": ("root", 1, 1, False), "B": ("root", 1, 2, False), "gc": ("root", 2, 1, False)}


def test_forest_keeps_the_first_of_repeats_and_separates_traces(spans):
    got = T.trace_forest(spans([
        span("x", start_time=10, name="first"), span("x", start_time=20, name="second"),
        span("x", "y", start_time=5, name="elsewhere", trace_id="t2"), span("y", start_time=1, trace_id="t2"),
    ])).collect()
    assert {(r["trace_id"][-2:], r["span_id"], r["name"], r["depth"]) for r in got} == {
        ("01", "x", "first", 0), ("t2", "x", "elsewhere", 1), ("t2", "y", "op", 0)}


def test_forest_marks_cycles(spans):
    got = tree(spans([span("a", "b"), span("b", "a"), span("below", "a"), span("self", "self"),
                      span("ok"), span("child", "ok")]))
    assert {k for k, r in got.items() if r["in_cycle"]} == {"a", "b", "below", "self"}
    assert all(got[k]["depth"] is None and got[k]["root_span_id"] is None for k in ("a", "self"))
    assert got["child"]["depth"] == 1


def test_forest_of_a_deep_chain(spans):
    n = 75
    rows = [span(f"s{i}", f"s{i - 1}" if i else None) for i in range(n)]
    random.Random(1).shuffle(rows)
    got = tree(spans(rows))
    assert all(got[f"s{i}"]["depth"] == i and got[f"s{i}"]["root_span_id"] == "s0" for i in range(n))


@pytest.mark.parametrize("in_task", [0, 6])
def test_forest_is_the_same_in_tasks_and_in_rounds(spans, in_task, monkeypatch):
    """Traces of 1 to 12 spans with random parents: missing, repeated, in cycles."""
    rng = random.Random(in_task)
    rows = []
    for t in range(25):
        ids = rng.sample(range(40), rng.randrange(1, 13))
        rows += [{"trace_id": f"{t:032x}", "span_id": f"{s:016x}", "start_time": rng.choice([None, BASE, BASE + 1]),
                  "parent_span_id": rng.choice([None, "", f"{99:016x}", *[f"{x:016x}" for x in ids]])} for s in ids]
    inputs = []
    kept = T._open_only
    monkeypatch.setattr(T, "_open_only", lambda targets, active: inputs.append((active, kept(targets, active))) or inputs[-1][1])
    whole = sorted(map(str, T.trace_forest(spans(rows)).collect()))
    assert not inputs and sorted(map(str, T.trace_forest(spans(rows), in_task=in_task).collect())) == whole
    assert len(inputs) > 1
    sizes = []
    for active, targets in inputs:  # a round joins the spans of traces that still have open ones, no others
        open_ = {r["trace_id"] for r in active.select("trace_id").collect()}
        assert {r["trace_id"] for r in targets.select("trace_id").collect()} == open_
        sizes.append(targets.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]


def test_forest_of_nothing(spans):
    assert T.trace_forest(spans([])).collect() == []


def test_red(spans):
    df = spans([{"status_code": "ERROR"}, {}, {}])
    rows = T.span_metrics(df, SpanMetricsQuery(MINUTE, service="web", start=BASE - SECOND, end=BASE + MINUTE)).collect()
    assert [(r["calls"], r["errors"], r["p50"], r["p99"]) for r in rows] == [(3, 1, 1e6, 1e6)]
    approx = T.span_metrics_approx(df, SpanMetricsQuery(MINUTE, group_by=["service.name"])).collect()
    assert [(r["g0"], r["calls"], r["errors"]) for r in approx] == [("web", 3, 1)]
    assert T.span_metrics(df, SpanMetricsQuery(MINUTE, status="UNSET")).collect() == []


def test_missing_durations_count_as_calls_only(spans):
    df = spans([{"duration_ns": None}, {"duration_ns": 4}, {"duration_ns": 8}, {"duration_ns": None}])
    for split_above in (0, 100):
        (row,) = T.span_metrics(df, SpanMetricsQuery(MINUTE), split_above).collect()
        assert (row["calls"], row["p50"]) == (4, 6.0)


def reference_quantile(values, q):
    at = (len(values) - 1) * q
    low, high = int(at), min(int(at) + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles_agree_with_sorting(spark, seed):
    rng = random.Random(seed)
    groups = {
        "one": [17], "two": [0, 10], "equal": [5_000_000] * 50,
        "spread": [rng.randint(0, 10 ** rng.randint(0, 15)) for _ in range(200)],
        "close": [10**12 + rng.randint(0, 200_000) for _ in range(100)],
        "skewed clocks": [rng.randint(-10**9, 10**6) for _ in range(150)],
        "border": [2**k + d for k in range(1, 50) for d in (-1, 0, 1)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v bigint")
    qs = {"q0": 0.0, "q37": 0.37, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", qs).collect()}
    for g, values in groups.items():
        assert got[g]["count"] == len(values)
        for name, q in qs.items():
            assert got[g][name] == pytest.approx(reference_quantile(sorted(values), q), rel=1e-12), (g, name)


@pytest.fixture
def methods(spans):
    return spans([{"trace_id": f"{i:032x}", "attributes": f'{{"http.method":"{m}"}}', "start_time": BASE + i,
                   "status_code": "ERROR" if i == 2 else "OK"}
                  for i, m in enumerate(["GET", "POST", "GET"], 1)])


@pytest.mark.parametrize("few", [True, False])
def test_search_predicates(methods, few, monkeypatch):
    if not few:  # the plan for matches too many to broadcast
        monkeypatch.setattr("teletide.session.BROADCAST_BYTES", -1)
    ids = lambda **q: [int(r["trace_id"], 16) for r in T.search_traces(methods, TraceQuery(**q)).collect()]
    assert ids() == [3, 2, 1]
    assert ids(limit=2) == [3, 2]
    assert ids(attr_exists=["http.method"]) == [3, 2, 1]
    assert ids(attr_exists=["absent"]) == []
    assert ids(attr_in={"http.method": ["POST"]}) == [2]
    assert ids(attr_not_in={"http.method": ["POST"]}) == [3, 1]
    assert ids(attr_eq={"http.method": "GET"}, start=BASE + 2) == [3]
    assert ids(status="ERROR") == [2]


@pytest.mark.parametrize("few", [True, False])
def test_search_summary_covers_the_whole_trace(spans, few, monkeypatch):
    if not few:
        monkeypatch.setattr("teletide.session.BROADCAST_BYTES", -1)
    df = spans([
        span("r1", start_time=100, duration_ns=50, name="root", service="front"),
        span("r2", start_time=90, duration_ns=5, name="other root", service=None),
        span("c", "r1", start_time=120, duration_ns=100, status_code="ERROR", service="db"),
        span("d", "gone", trace_id="2" * 32, start_time=7, duration_ns=1, service="db"),
    ])
    got = [tuple(r) for r in T.search_traces(df, TraceQuery(service="db")).collect()]
    assert got == [(f"{1:032x}", None, "other root", 90, 130, 3, True),
                   ("2" * 32, None, None, 7, 1, 1, False)]


def test_spanset_window_is_on_the_trace_start(spans):
    df = spans([span("a", start_time=100), span("b", "a", start_time=200, service="db"),
                span("c", trace_id="2" * 32, start_time=150, service="db")])
    ids = lambda *w: {r["span_id"] for r in T.spanset_match(df, TraceQuery(service="db"), *w).collect()}
    assert ids() == {"b", "c"}
    assert ids(100, 101) == {"b"}
    assert ids(120, 201) == {"c"}
    assert ids(0, 140) == {"b"}


@pytest.mark.parametrize("hot_cell", [1_000_000, 3])
def test_spanset_lists_split_a_huge_trace(spans, hot_cell, monkeypatch):
    monkeypatch.setattr("teletide.operators.ranking.HOT_CELL", hot_cell)
    df = spans([span(f"{i:02d}", start_time=BASE + (i % 3) * SECOND) for i in range(10)]
               + [span("z", trace_id="2" * 32)])
    lists = T.spanset_lists(T.spanset_match(df, TraceQuery()), per_list=4).orderBy("trace_id", "part").collect()
    assert [len(r["span_ids"]) for r in lists] == [4, 4, 2, 1]
    first = [s for r in lists[:3] for s in r["span_ids"]]
    assert first == [f"{i:02d}" for k in range(3) for i in range(10) if i % 3 == k]


def test_get_trace_checks_the_id(spans):
    df = spans([{"start_time": 2}, {"start_time": 1}, {"trace_id": "2" * 32}])
    assert [r["start_time"] for r in T.get_trace(df, f"{1:032X}").collect()] == [1, 2]
    with pytest.raises(ValueError):
        T.get_trace(df, "xyz")


def test_spans_of_matches_and_logs_of_traces(spans, logs):
    df = spans([span("a"), span("b", "a", service="db"), span("c", trace_id="2" * 32)])
    match = T.spanset_match(df, TraceQuery(service="db"))
    assert {r["span_id"] for r in T.spans_of(df, match).collect()} == {"a", "b"}
    lines = logs([{"body": "in", "trace_id": f"{1:032x}"}, {"body": "out", "trace_id": "9" * 32}, {"body": "none"}])
    assert [r["body"] for r in T.logs_with_trace(lines, df).collect()] == ["in"]
    assert {r["body"] for r in T.logs_without_trace(lines, df).collect()} == {"out", "none"}


def test_exemplars_find_their_span(spans, spark):
    df = spans([span("a"), span("a", start_time=BASE + 9), span("b", trace_id="2" * 32)])
    ex = spark.createDataFrame([("m", f"{1:032x}", "a"), ("m", f"{1:032x}", None), ("m", "2" * 32, "a")],
                               "metric string, trace_id string, span_id string")
    got = T.exemplar_spans(ex, df).collect()
    assert [(r["trace_id"], r["span_id"], r["start_time"]) for r in got] == [(f"{1:032x}", "a", BASE)]
