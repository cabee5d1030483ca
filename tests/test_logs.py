import pytest
from pyspark.sql import functions as F

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators import logs as L, ranking
from teletide.operators.logs import LogQuery
from teletide.operators.rangeeval import log_lines
from teletide.streaming.jobs import tail_poll


def bodies(df):
    return [r["body"] for r in df.collect()]


@pytest.fixture
def three(logs):
    return logs([{"service": "checkout", "body": "error happened"}, {"service": "checkout", "body": "all ok"},
                 {"service": "api", "body": "hello world"}])


def test_filters_and_count(three):
    count = lambda **q: L.count_logs(three, LogQuery(**q)).first()["count"]
    assert count() == 3
    assert count(service="checkout") == 2
    assert count(match="error") == 1
    assert len(bodies(L.query_logs(three, LogQuery(limit=1)))) == 1
    assert count(limit=1, backward=True) == 3


@pytest.fixture
def two_clocks(logs):
    return logs([
        {"body": "early", "time": BASE + 30 * SECOND, "observed_time": BASE + 10 * SECOND},
        {"body": "late", "time": BASE + 10 * SECOND, "observed_time": BASE + 30 * SECOND},
        {"body": "no-arrival", "time": BASE + 20 * SECOND},
    ])


def test_arrival_axis(two_clocks):
    run = lambda **q: bodies(L.query_logs(two_clocks, LogQuery(**q)))
    assert run() == ["late", "no-arrival", "early"]
    assert run(order_by="observed_time") == ["early", "late", "no-arrival"]
    assert run(order_by="observed_time", backward=True) == ["late", "early", "no-arrival"]
    assert run(observed_after=BASE + 10 * SECOND) == ["late"]


@pytest.mark.parametrize("hot_cell", [ranking.HOT_CELL, 2])
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("axis", ["time", "observed_time"])
def test_positions_follow_the_order(logs, axis, backward, hot_cell, monkeypatch):
    monkeypatch.setattr(ranking, "HOT_CELL", hot_cell)  # with and without finer cells
    # Many equal instants, a block without arrival time, ids on both sides of a digit border.
    rows = [{"body": str(i), "record_id": i * 9973, "time": BASE + (i % 7) * MINUTE // 3,
             "observed_time": None if i % 3 == 0 else BASE + (i % 5) * SECOND} for i in range(60)]
    df, q = logs(rows), LogQuery(order_by=axis, backward=backward)
    placed = L.positions(df, q).orderBy("rn").collect()
    assert [r["rn"] for r in placed] == list(range(1, 61))
    assert [r["body"] for r in placed] == bodies(L.query_logs(df, q))


def test_tailer_delivers_each_row_once(logs):
    first = [{"body": "first", "time": BASE + 10 * SECOND, "observed_time": BASE + 10 * SECOND},
             {"body": "second", "time": BASE + 20 * SECOND, "observed_time": BASE + 20 * SECOND},
             {"body": "unplaced", "time": BASE}]
    late = {"body": "late", "time": BASE + 5 * SECOND, "observed_time": BASE + 30 * SECOND}
    delivered, mark = [], 0
    for table in (logs(first), logs([*first, late]), logs([*first, late])):
        rows = tail_poll(table, mark, limit=500).collect()
        delivered.append([r["body"] for r in rows])
        mark = max([mark, *[r["observed_time"] for r in rows]])
    assert delivered == [["first", "second"], ["late"], []]


def test_unknown_axis_is_named_on_every_log_surface(three):
    q = LogQuery(order_by="arrival", limit=5)
    for surface in (lambda: L.query_logs(three, q), lambda: L.count_logs(three, q),
                    lambda: L.log_page(three, q), lambda: L.log_volume(three, q, MINUTE)):
        with pytest.raises(ValueError, match="arrival"):
            surface()


def test_severity_ids_and_presence(logs):
    df = logs([{"body": "a", "trace_id": "aa" * 16, "span_id": "bb" * 8, "severity_number": 17,
                "attributes": '{"tenant":"x"}'},
               {"body": "b", "severity_number": 9}, {"body": "c", "severity_number": 16}])
    run = lambda **q: bodies(L.query_logs(df, LogQuery(**q)))
    assert run(severity_at_least=17) == ["a"]
    assert run(trace_id="AA" * 16) == ["a"]
    assert run(span_id="bb" * 8) == ["a"]
    assert run(attr_exists=["tenant"]) == ["a"]
    for bad in ({"trace_id": "zz"}, {"span_id": "aa" * 16}):
        with pytest.raises(ValueError):
            run(**bad)


def test_attribute_predicates(logs):
    df = logs([{"body": "a", "attributes": '{"n":5,"m":"GET","t":"slow disk"}'},
               {"body": "b", "attributes": '{"n":"7.5","m":"POST"}'},
               {"body": "c", "attributes": '{"n":"many"}'}, {"body": "d"}])
    run = lambda **q: "".join(bodies(L.query_logs(df, LogQuery(**q))))
    assert run(attr_eq={"m": "GET"}) == "a"
    assert run(attr_in={"m": ["GET", "POST"]}) == "ab"
    assert run(attr_not_in={"m": ["GET"]}) == "b"
    assert run(attr_gt={"n": 5}) == "b"
    assert run(attr_ge={"n": 5}) == "ab"
    assert run(attr_lt={"n": 7.5}) == "a"
    assert run(attr_le={"n": 7.5}) == "ab"
    assert run(attr_matches={"t": "DISK"}) == "a"
    assert run(attr_regex={"m": "OS|X"}) == "b"


@pytest.mark.parametrize("merged_rows", [L.MERGED_ROWS, 5])
def test_pages_concatenate_to_the_order(logs, merged_rows, monkeypatch):
    monkeypatch.setattr(L, "MERGED_ROWS", merged_rows)  # later pages are cut out by position
    df = logs([{"body": f"r{i}"} for i in range(10)])
    q, after, pages = LogQuery(limit=4), 0, []
    while after is not None:
        page = L.log_page(df, q, after)
        pages.append(bodies(page.rows))
        assert page.returned == len(pages[-1])
        after = page.next_offset
    assert [len(p) for p in pages] == [4, 4, 2]
    assert sum(pages, []) == [f"r{i}" for i in range(10)]
    # A full last page is followed by an empty one.
    last = L.log_page(df, LogQuery(limit=5), 5)
    last.rows.collect()
    assert last.next_offset == 10


@pytest.mark.parametrize("backward", [False, True])
def test_keyset_pages_walk_equal_instants(logs, backward):
    df = logs([{"body": str(i), "time": BASE + i // 4} for i in range(13)])
    q = LogQuery(limit=3, backward=backward)
    whole = bodies(L.query_logs(df, LogQuery(backward=backward)))
    page = L.query_logs(df, q).collect()
    seen = []
    while page:
        seen += [r["body"] for r in page]
        page = L.log_page_after(df, q, {"time": page[-1]["time"], "record_id": page[-1]["record_id"]}).collect()
    assert seen == whole


def test_volume(logs):
    levels = ["info", "warn", "info", "info", "warn"]
    df = logs([{"time": BASE + i * 25 * SECOND, "attributes": f'{{"level":"{v}"}}', "service": s}
               for i, (v, s) in enumerate(zip(levels, ["cart", "cart", "checkout", None, None]))])
    plain = L.log_volume(df, LogQuery(), MINUTE).collect()
    assert sum(r["count"] for r in plain) == 5 == L.count_logs(df, LogQuery()).first()["count"]
    assert {r["labels"] for r in plain} == {"{}"} and len(plain) >= 2
    assert all(r["bucket_time"] % MINUTE == 0 for r in plain)
    by = lambda keys: {r["labels"]: r["n"] for r in L.log_volume(df, LogQuery(), MINUTE, keys).groupBy(
        "labels").agg(F.sum("count").alias("n")).collect()}
    assert by(["level"]) == {'{"level":"info"}': 3, '{"level":"warn"}': 2}
    assert by(["service"]) == {'{"service":"cart"}': 2, '{"service":"checkout"}': 1, '{"service":""}': 2}
    assert by(["service.name"])['{"service.name":"cart"}'] == 2


def test_log_lines_take_one_stream(three):
    lines = log_lines(three, service="checkout", contains="error", start=BASE, end=BASE + MINUTE)
    assert bodies(lines) == ["error happened"]
