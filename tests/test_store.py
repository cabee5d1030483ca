import pytest
from pyspark.errors import PySparkException

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators.logs import LogQuery
from teletide.operators.metrics import MetricQuery, PointsQuery
from teletide.operators.rangeeval import Grid
from teletide.operators.traces import SpanMetricsQuery, TraceQuery
from teletide.sources import requests, tables
from teletide.store import Telemetry

GRID = Grid(BASE, BASE + MINUTE, 30 * SECOND)


@pytest.fixture
def store(spark, logs, gauge, spans):
    points = [{"metric": "cpu.util", "value": float(i), "attributes": '{"host":"a"}'} for i in range(3)]
    counter = [{"metric": "hits.total", "value": 10.0 * i} for i in range(30)]
    return Telemetry(spark, {
        "logs": logs([{"service": "web", "body": "an error"}, {"service": "api", "body": "fine"}]),
        "spans": spans([{}, {"parent_span_id": f"{1:016x}", "status_code": "ERROR"}]),
        "metrics_gauge": gauge(points), "metrics_sum": gauge(counter, "metrics_sum")})


def test_every_question(store):
    assert store.query_logs(LogQuery(match="error")).count() == 1
    assert store.count_logs(LogQuery()).first()[0] == 2
    assert store.log_page(LogQuery(limit=1), 1).rows.count() == 1
    assert store.log_volume(LogQuery(), MINUTE, ["service"]).count() == 2
    assert store.log_lines(service="web").count() == 1
    assert store.log_count_over_time(MINUTE, GRID).count() == 4  # open below, closed above
    assert {r["value"] for r in store.log_rate(MINUTE, GRID).collect()} == {1 / 60}
    assert store.metric_points(PointsQuery("cpu.util")).count() == 3
    assert store.metric_range(MetricQuery("cpu.util", MINUTE)).first()["v"] == 1.0
    assert store.metric_instant(MetricQuery("hits.total", SECOND, sum=True)).first()["value"] == 290.0
    assert store.instant_selector("cpu_util", GRID).count() == 3
    assert store.instant_selector("hits_total", GRID).count() == 3
    assert store.rate("hits_total", MINUTE, GRID).count() > 0
    assert store.increase("hits.total", MINUTE, GRID).count() > 0
    trace = f"{1:032x}"
    assert store.get_trace(trace).count() == 2
    assert store.trace_forest(trace).where("depth = 1").count() == store.trace_forest().where("depth = 1").count() == 1
    assert store.search_traces(TraceQuery(status="ERROR")).first()["span_count"] == 2
    assert [len(r["span_ids"]) for r in store.spanset_match(TraceQuery(service="web")).collect()] == [2]
    assert store.span_metrics(SpanMetricsQuery(MINUTE)).first()["errors"] == 1
    assert [r[0] for r in store.attr_names().collect()] == ["host", "service.name"]
    assert [r[0] for r in store.attr_values("service").collect()] == ["api", "web"]
    assert {r["metric"] for r in store.metric_catalog().collect()} == {"cpu.util", "hits.total"}
    assert store.metric_series("cpu.util").first()[0] == '{"host":"a"}'
    assert store.metric_exemplars("cpu.util").count() == 0
    assert {r["table"]: r["rows"] for r in store.stats().collect()}["metrics_summary"] == 0
    assert store.export("spans").count() == 2
    assert store.sql("SELECT count(*) FROM logs WHERE matches(body, 'error')").first()[0] == 1
    assert store.table("logs").count() == 2


def test_errors(store, spark, gauge):
    with pytest.raises(PySparkException):
        store.sql("SELECT * FROM no_such_table")
    for call in (lambda: store.table("nope"), lambda: store.metric_points(PointsQuery("m", kind="nope")),
                 lambda: Telemetry(spark, {"nope": store.table("logs")})):
        with pytest.raises(ValueError):
            call()


def test_duplicate_policy_is_a_property_of_the_store(spark, gauge):
    twice = {"metrics_gauge": gauge([{"metric": "m", "value": v, "point_time": BASE} for v in (1.0, 2.0)])}
    with pytest.raises(PySparkException, match="duplicate points"):
        Telemetry(spark, twice).instant_selector("m", GRID).collect()
    assert Telemetry(spark, twice, "last_wins").instant_selector("m", GRID).first()["value"] == 2.0


def test_from_files(spark, logs, spans, gauge, tmp_path):
    requests.from_logs(logs([{"service": "web", "body": "x"}])).write.text(str(tmp_path / "l"))
    requests.from_spans(spans([{}])).write.text(str(tmp_path / "t"))
    requests.from_gauge(gauge([{"metric": "m", "value": 1.0}])).write.text(str(tmp_path / "m"))
    store = Telemetry.from_otlp(spark, logs=str(tmp_path / "l"), traces=str(tmp_path / "t"),
                                metrics=str(tmp_path / "m"))
    rows = {r["table"]: r["rows"] for r in store.stats().collect()}
    assert (rows["logs"], rows["spans"], rows["metrics_gauge"], rows["metrics_sum"]) == (1, 1, 1, 0)
    tables.write_table(store.table("logs"), "logs", str(tmp_path / "db/logs"), codec="lz4", files=2)
    reopened = Telemetry.open(spark, str(tmp_path / "db"), ["logs"])
    assert reopened.query_logs(LogQuery(service="web")).first()["body"] == "x"
