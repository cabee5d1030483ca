import math

import pytest
from pyspark.errors import PySparkException

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators import discovery, duplicates as D, metrics as M, rangeeval as R
from teletide.operators.metrics import MetricQuery, PointsQuery
from teletide.operators.rangeeval import Grid
from teletide.sources import tables

ALL = dict(start=BASE - MINUTE, end=BASE + MINUTE)


def test_gauge_by_service_under_either_spelling(gauge):
    df = gauge([{"metric": "m", "service": s, "value": v}
                for s, v in [("cart", 10.0), ("cart", 10.0), ("checkout", 50.0), ("checkout", 50.0)]])
    for key in ("service", "service.name"):
        rows = M.metric_range(df, MetricQuery("m", MINUTE, group_by=[key], **ALL)).collect()
        assert {(r["g0"], r["v"]) for r in rows} == {("cart", 10.0), ("checkout", 50.0)}


def test_instant_is_the_last_bucket(gauge):
    df = gauge([{"metric": "m", "value": v} for v in (10.0, 20.0, 30.0)])
    rows = M.metric_instant(df, MetricQuery("m", SECOND, **ALL)).collect()
    assert [tuple(r) for r in rows] == [("{}", BASE + 2 * SECOND, 30.0)]
    assert M.metric_instant(df, MetricQuery("other", SECOND)).collect() == []


@pytest.mark.parametrize("is_sum", [False, True])
def test_last_wins_takes_the_larger_value(gauge, is_sum):
    df = gauge([{"metric": "cpu_seconds", "value": v, "point_time": BASE} for v in (0.25, 0.75)])
    q = MetricQuery("cpu_seconds", SECOND, sum=is_sum, duplicates="last_wins", **ALL)
    assert M.metric_range(df, q).first()["v"] == 0.75
    assert M.metric_instant(df, q).first()["value"] == 0.75
    both = MetricQuery("cpu_seconds", SECOND, sum=is_sum, **ALL)
    assert M.metric_range(df, both).first()["v"] == (1.0 if is_sum else 0.5)


def test_nan_loses_against_any_number(gauge):
    nan = float("nan")
    df = gauge([{"metric": "m", "value": v, "point_time": BASE} for v in (nan, -1.0, nan)])
    assert D.last_wins(df).first()["value"] == -1.0
    only = gauge([{"metric": "m", "value": nan, "point_time": BASE}] * 2)
    assert math.isnan(D.last_wins(only).first()["value"])


def test_duplicates_fail_the_grid_read_by_default(gauge):
    df = gauge([{"metric": "cpu_seconds", "value": v, "point_time": BASE} for v in (0.25, 0.25)])
    grid = Grid(BASE, BASE + MINUTE, SECOND)
    with pytest.raises(PySparkException, match=f"cpu_seconds.*{BASE}"):
        R.instant_selector(df, "cpu_seconds", grid).collect()
    assert R.instant_selector(df, "cpu_seconds", grid, policy="last_wins").count() == 61
    assert [r["copies"] for r in D.duplicate_points(df).collect()] == [2]
    with pytest.raises(ValueError):
        D.resolve(df, "sometimes")


def test_reject_counts_exact_repeats_only(gauge):
    point = {"metric": "cpu_seconds", "value": 0.25, "point_time": BASE}
    stored = gauge([point])
    receipt = lambda batch, known: tuple(D.receipt(D.reject_duplicates(gauge(batch), ["value"], known)).first())
    assert receipt([point], None) == (1, 0)
    assert receipt([point], stored) == (0, 1)
    later = {**point, "value": 0.5, "point_time": BASE + SECOND}
    assert receipt([later], stored) == (1, 0)
    early = {**point, "point_time": BASE - MINUTE}
    assert receipt([point, later, later, early], stored) == (2, 2)
    assert receipt([{**point, "service": None}] * 2, gauge([{**point, "service": None}])) == (0, 2)
    kept = D.accepted(D.reject_duplicates(gauge([{**later, "value": 9.0}, later]), ["value"]))
    assert [r["value"] for r in kept.collect()] == [0.5]


def test_points(gauge):
    df = gauge([{"metric": "m", "value": float(i), "attributes": f'{{"host":"h{i % 2}"}}'} for i in range(6)])
    take = lambda **q: [r["value"] for r in M.metric_points(df, PointsQuery("m", **q)).collect()]
    assert take(filters={"host": "h1"}, limit=2) == [1.0, 3.0]
    assert sorted(take(start=BASE + 2 * SECOND, end=BASE + 4 * SECOND)) == [2.0, 3.0]
    assert take(filters={"service": "other"}) == []
    with pytest.raises(ValueError):
        M.metric_points(df, PointsQuery("m", kind="trend"))


def test_histogram_merge_adds_buckets(make):
    rows = [{"metric": "h", "service": s, "attributes": "{}", "point_time": BASE, "temporality": "delta",
             "explicit_bounds": [1.0, 2.0], "bucket_counts": c}
            for s, c in [("a", [1, 2, 3]), ("a", [10, 0, 1]), ("b", [0, 0, 5])]]
    merged = M.histogram_merge(make("metrics_histogram", rows), ["service"]).orderBy("g0").collect()
    assert [tuple(r) for r in merged] == [("a", [1.0, 2.0], [11, 2, 4]), ("b", [1.0, 2.0], [0, 0, 5])]


def cumulative(make, rows):
    """Points of one series as (minute, counts), with bounds 1, 2, ..."""
    return make("metrics_histogram", [
        {"metric": "h", "service": "a", "attributes": '{"k":"v"}', "temporality": "cumulative", **more,
         "point_time": BASE + at * MINUTE, "explicit_bounds": [float(i + 1) for i in range(len(counts) - 1)], "bucket_counts": counts}
        for at, counts, more in rows])


def test_cumulative_histograms_count_by_their_gain(make):
    merged = lambda rows: [tuple(r) for r in M.histogram_merge(cumulative(make, rows), []).collect()]
    assert merged([(0, [10, 0], {}), (1, [10, 10], {})]) == [([1.0], [0.0, 10.0])]
    assert merged([(0, [10, 0], {})]) == []  # one point says nothing about a gain
    # Out of order, over an hour's edge, with a restart, spelled otherwise, and a series of its own.
    rows = [(200, [3, 1], {}), (0, [5, 5], {}), (90, [9, 6], {"attributes": '{ "k": "v" }'}), (100, [9, 9], {}), (201, [4, 1], {}),
            (0, [100, 100], {"attributes": '{"k":"w"}'})]
    assert merged(rows) == [([1.0], [4.0 + 0 + 3 + 1, 1.0 + 3 + 1 + 0])]
    # A restart is told by any bucket that falls; other bounds are a series of their own.
    assert merged([(0, [0, 9], {}), (1, [5, 3], {}), (2, [7, 7, 7], {}), (3, [7, 8, 7], {})]) == [([1.0, 2.0], [5.0, 1.0, 3.0])]
    both = cumulative(make, [(0, [1, 1], {}), (1, [2, 1], {}), (5, [10, 0], {"temporality": "delta"})])
    assert [tuple(r) for r in M.histogram_merge(both, []).collect()] == [([1.0], [11.0, 0.0])]


def test_histograms_with_other_bounds_are_carried_over(make):
    def point(bounds, counts):
        return {"metric": "h", "service": "a", "attributes": "{}", "point_time": BASE, "temporality": "delta",
                "explicit_bounds": bounds, "bucket_counts": counts}
    rows = [point([10.0], [8, 1]), point([5.0, 10.0], [1, 1, 1]), point([-1.0, 20.0], [2, 21, 4])]
    (bounds, counts), = [tuple(r) for r in M.histogram_merge(make("metrics_histogram", rows), []).collect()]
    assert bounds == [-1.0, 5.0, 10.0, 20.0]
    assert counts == pytest.approx([2, 4 + 1 + 6, 4 + 1 + 5, 10, 6])


def test_histograms_of_no_temporality_or_shape_fail(make):
    for row, message in (({"temporality": None}, "neither delta nor cumulative"), ({"temporality": "delta", "bucket_counts": [1]}, "do not fit")):
        with pytest.raises(PySparkException, match=message):
            M.histogram_merge(cumulative(make, [(0, [1, 1], row)]), []).collect() if "bucket_counts" not in row else M.histogram_merge(
                make("metrics_histogram", [{"metric": "h", "attributes": "{}", "point_time": BASE, "explicit_bounds": [1.0], **row}]), []).collect()


def test_discovery(make, gauge, logs, spans):
    exemplar = (900, 41.5, "ab" * 16, "cd" * 8, '{"sampler":"always_on"}')
    points = gauge([{"metric": "req.latency", "value": 1.0, "exemplars": [exemplar], "attributes": '{"host":"a"}'},
                    {"metric": "cpu.util", "value": 1.0, "attributes": '{"host":"b"}'},
                    {"metric": "cpu.util", "value": 2.0, "attributes": '{"host":"b"}', "service": "other"}])
    found = discovery.metric_exemplars(points, "req.latency").collect()
    assert [tuple(r)[1:] for r in found] == [exemplar]
    assert discovery.metric_exemplars(points, "cpu.util").collect() == []
    tables = {"logs": logs([{"attributes": '{"level":"info"}'}]), "metrics_gauge": points,
              "spans": spans([{"service": None, "attributes": '{"http.method":"GET"}'}])}
    assert [r[0] for r in discovery.attr_names(tables).collect()] == [
        "host", "http.method", "level", "service.name"]
    without = {"logs": logs([{"attributes": '{"level":"info"}'}])}
    assert [r[0] for r in discovery.attr_names(without).collect()] == ["level"]
    assert [r[0] for r in discovery.attr_values(tables, "host").collect()] == ["a", "b"]
    assert [r[0] for r in discovery.attr_values(tables, "service.name").collect()] == ["other", "web"]
    assert [r[0] for r in discovery.metric_series(points, "cpu.util").collect()] == ['{"host":"b"}']
    catalog = {tuple(r) for r in discovery.metric_catalog({"metrics_gauge": points}).collect()}
    assert catalog == {("req.latency", "", None, "gauge"), ("cpu.util", "", None, "gauge")}


def test_names_that_collide_fail_naming_both(gauge):
    catalog = discovery.metric_catalog({"metrics_gauge": gauge(
        [{"metric": "a.b", "value": 1.0}, {"metric": "a_b", "value": 1.0}])})
    with pytest.raises(PySparkException, match="a.b and a_b"):
        R.resolve_names(catalog).collect()


def test_a_read_that_meets_two_names_fails_naming_both(gauge):
    df = gauge([{"metric": m, "value": v, "service": m, "point_time": BASE + i} for i, (m, v) in enumerate([("a.b", 1.0), ("a_b", 9.0), ("c.d", 2.0)])])
    grid = R.Grid(BASE, BASE + SECOND, SECOND)
    for read in (R.instant_selector, lambda d, m, g: R.rate(d, m, MINUTE, g)):
        with pytest.raises(Exception, match="a.b and a_b share one query name"):
            read(df, "a_b", grid).collect()
    assert {r["value"] for r in R.instant_selector(df, "a.b", grid).collect()} == {1.0}
    assert {r["value"] for r in R.instant_selector(df, "c_d", grid).collect()} == {2.0}
    # Other instants of the other name do not count.
    assert R.instant_selector(df.where(f"metric <> 'a.b' OR point_time > {BASE + MINUTE}"), "a_b", grid).count() == 1
    assert R.instant_selector(df, "no_such", grid).count() == 0


def test_typed_reads_and_the_report_go_by_the_series(gauge):
    point = {"metric": "m", "service": "s", "point_time": BASE}
    df = gauge([{**point, "value": v, "attributes": a} for v, a in [
        (1.0, '{"host":"a","n":1}'), (5.0, '{"n":2,"host":"a"}'), (float("nan"), '{"host":"a","n":3}'), (2.0, '{"host":"b"}')]])
    q = MetricQuery("m", SECOND, sum=True, group_by=["host"], duplicates=D.LAST_WINS)
    assert sorted((r["g0"], r["v"]) for r in M.metric_range(df, q).collect()) == [("a", 5.0), ("b", 2.0)]
    assert [(r["attributes"], r["copies"]) for r in D.duplicate_points(df).collect()] == [('{"host":"a","n":1}', 3)]
    only = gauge([{**point, "value": float("nan")}, {**point, "value": float("nan")}])
    assert [str(r["value"]) for r in D.last_wins_by_series(only).collect()] == ["nan"]


def test_reject_goes_by_the_series(gauge):
    point = {"metric": "m", "service": "s", "point_time": BASE}
    batch = gauge([{**point, "value": 1.0, "attributes": '{"host":"a","n":1}'},
                   {**point, "value": 2.0, "attributes": '{"host":"a","n":2}'},
                   {**point, "value": 3.0, "attributes": '{"host":"b","n":2}'}])
    kept = D.accepted(D.reject_duplicates(batch, ["value"]))
    assert sorted(r["value"] for r in kept.collect()) == [1.0, 3.0] and kept.columns == batch.columns
    stored = gauge([{**point, "value": 9.0, "attributes": '{"n":7,"host":"b"}'}, {**point, "value": 9.0, "point_time": None}])
    assert tuple(D.receipt(D.reject_duplicates(batch, ["value"], stored)).first()) == (1, 2)
    assert D.reject_duplicates(gauge([]), ["value"], stored).count() == 0


def test_reject_finds_undated_repeats(gauge, spark, tmp_path):
    undated = {"metric": "m", "service": "s", "value": 1.0, "point_time": None}
    dated = {**undated, "point_time": BASE}
    tables.write_table(gauge([undated, dated]), "metrics_gauge", str(tmp_path))
    for stored in (gauge([undated, dated]), spark.read.parquet(str(tmp_path))):
        receipt = lambda batch, stored=stored: tuple(D.receipt(D.reject_duplicates(gauge(batch), ["value"], stored)).first())
        assert receipt([undated]) == (0, 1) and receipt([undated, dated]) == (0, 2)
        assert receipt([{**undated, "service": "new"}, undated]) == (1, 1)
        assert receipt([{**dated, "point_time": BASE + MINUTE}, undated]) == (1, 1)
