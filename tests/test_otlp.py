import json

import pytest

from telemetry_rows import BASE
from teletide.model import SCHEMAS
from teletide.sources import otlp, requests

RESOURCE = {"attributes": [{"key": "service.name", "value": {"stringValue": "web"}},
                           {"key": "host.id", "value": {"intValue": "7"}}]}


def kv(key, **value):
    return {"key": key, "value": value}


@pytest.fixture
def read(spark, tmp_path):
    def go(signal, *bodies):
        folder = tmp_path / signal
        folder.mkdir()
        (folder / "in.json").write_text("\n".join(json.dumps(b) for b in bodies))
        return otlp.read_requests(spark, signal, str(folder))
    return go


def test_logs(read):
    record = {
        "timeUnixNano": str(BASE), "observedTimeUnixNano": "0", "severityNumber": 17, "severityText": "ERROR",
        "body": {"stringValue": 'say "hi"\n'}, "traceId": "AB" * 16, "spanId": "",
        "attributes": [kv("z", stringValue='q"\\'), kv("i", intValue="9007199254740993"), kv("f", doubleValue=0.5),
                       kv("b", boolValue=False), kv("s", intValue=5), kv("raw", bytesValue="AQI="),
                       kv("list", arrayValue={"values": [{"stringValue": "a"}, {"intValue": "1"}, {"boolValue": True}]}),
                       kv("map", kvlistValue={"values": [kv("y", intValue="2"), kv("x", stringValue="1")]}),
                       {"key": "none", "value": {}}],
    }
    plain = {"timeUnixNano": str(BASE + 1), "observedTimeUnixNano": str(BASE + 2),
             "body": {"kvlistValue": {"values": [kv("k", intValue="1")]}}}
    body = {"resourceLogs": [
        {"resource": RESOURCE, "scopeLogs": [{"scope": {"name": "lib", "version": "1"}, "logRecords": [record, plain]}]},
        {"scopeLogs": [{"logRecords": [{"timeUnixNano": "5", "body": {"intValue": "42"}}]}]}]}
    df = otlp.logs(read("logs", body, {"resourceLogs": []}))
    assert df.schema.simpleString() == SCHEMAS["logs"].simpleString()
    a, b, c = sorted((r.asDict() for r in df.collect()), key=lambda r: (r["time"] == 5, r["time"]))
    assert a["time"] == BASE and a["observed_time"] is None and a["service"] == "web"
    assert (a["severity_number"], a["severity_text"], a["body"]) == (17, "ERROR", 'say "hi"\n')
    assert (a["trace_id"], a["span_id"]) == ("ab" * 16, None)
    assert a["attributes"] == ('{"b":false,"f":0.5,"i":9007199254740993,"list":["a",1,true],'
                               '"map":{"x":"1","y":2},"none":null,"raw":"AQI=","s":5,"z":"q\\"\\\\"}')
    assert json.loads(a["attributes"])["z"] == 'q"\\'
    assert a["resource"] == '{"host.id":7}' and a["scope"] == '{"name":"lib","version":"1"}'
    assert (b["observed_time"], b["severity_number"], b["body"], b["attributes"]) == (BASE + 2, 0, '{"k":1}', "{}")
    assert (c["service"], c["body"]) == (None, "42")


def test_spans(read):
    def span(i, **more):
        return {"traceId": "0a" * 16, "spanId": f"{i:016X}", "name": f"op{i}", "startTimeUnixNano": str(BASE),
                "endTimeUnixNano": str(BASE + i), **more}
    body = {"resourceSpans": [{"resource": RESOURCE, "scopeSpans": [{"spans": [
        span(1, kind=2, status={"code": 2, "message": "boom"}, parentSpanId=""),
        span(2, kind="SPAN_KIND_CLIENT", status={"code": "STATUS_CODE_OK"}, parentSpanId="0" * 15 + "1"),
        span(10)]}]}]}
    rows = otlp.spans(read("traces", body)).orderBy("duration_ns").collect()
    assert [(r["span_id"][-1], r["parent_span_id"], r["kind"], r["status_code"], r["duration_ns"]) for r in rows] == [
        ("1", None, "SERVER", "ERROR", 1), ("2", "0" * 15 + "1", "CLIENT", "OK", 2),
        ("a", None, "UNSPECIFIED", "UNSET", 10)]
    assert rows[0]["status_message"] == "boom" and rows[0]["service"] == "web"


def test_metrics(read):
    exemplar = {"timeUnixNano": "900", "asDouble": 41.5, "traceId": "AB" * 16, "spanId": "cd" * 8,
                "filteredAttributes": [kv("sampler", stringValue="always_on")]}
    at = {"timeUnixNano": str(BASE)}
    metrics = [
        {"name": "g", "unit": "ms", "gauge": {"dataPoints": [{**at, "asDouble": 1.5, "exemplars": [exemplar]},
                                                           {**at, "asInt": "3"}]}},
        {"name": "s", "sum": {"dataPoints": [{**at, "asDouble": 2.0}], "aggregationTemporality": 2, "isMonotonic": True}},
        {"name": "h", "histogram": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_DELTA", "dataPoints": [
            {**at, "count": "10", "sum": 30.0, "bucketCounts": ["0", "0", "10", "0", "0"],
             "explicitBounds": [1, 2, 5, 10]}]}},
        {"name": "e", "exponentialHistogram": {"aggregationTemporality": 1, "dataPoints": [
            {**at, "count": "3", "sum": 9.0, "scale": 1, "zeroCount": "1",
             "positive": {"offset": -2, "bucketCounts": ["1", "1"]}}]}},
        {"name": "q", "summary": {"dataPoints": [{**at, "count": "2", "sum": 5.0, "quantileValues": [
            {"quantile": 0.5, "value": 2.5}]}]}},
    ]
    sent = read("metrics", {"resourceMetrics": [{"resource": RESOURCE, "scopeMetrics": [{"metrics": metrics}]}]})
    rows = {name: otlp.metrics(sent, name).collect() for name in otlp.METRIC_FIELDS}
    gauge = sorted(rows["metrics_gauge"], key=lambda r: r["value"])
    assert [(r["metric"], r["unit"], r["value"], r["temporality"]) for r in gauge] == [
        ("g", "ms", 1.5, None), ("g", "ms", 3.0, None)]
    assert [tuple(e) for e in gauge[0]["exemplars"]] == [
        (900, 41.5, "ab" * 16, "cd" * 8, '{"sampler":"always_on"}')]
    (s,) = rows["metrics_sum"]
    assert (s["temporality"], s["is_monotonic"], s["value"], s["unit"]) == ("cumulative", True, 2.0, "")
    (h,) = rows["metrics_histogram"]
    assert (h["count"], h["sum"], h["explicit_bounds"], h["bucket_counts"], h["temporality"]) == (
        10, 30.0, [1.0, 2.0, 5.0, 10.0], [0, 0, 10, 0, 0], "delta")
    (e,) = rows["metrics_exp_histogram"]
    assert (e["scale"], e["zero_count"], e["positive_offset"], e["positive_counts"], e["negative_counts"]) == (
        1, 1, -2, [1, 1], None)
    (q,) = rows["metrics_summary"]
    assert [tuple(v) for v in q["quantile_values"]] == [(0.5, 2.5)] and q["service"] == "web"
    with pytest.raises(ValueError):
        otlp.metrics(sent, "logs")


def test_requests_flatten_back_to_the_rows(spark, logs, tmp_path):
    df = logs([{"service": s, "body": f'b"{i}', "observed_time": BASE if i % 2 else None, "severity_text": "INFO",
                "attributes": '{"a":"x\\"y","f":1.5,"n":3,"t":true}'} for i, s in enumerate(["a", "b", "a", "a"])])
    requests.from_logs(df, 2).write.text(str(tmp_path / "in"))
    sent = otlp.read_requests(spark, "logs", str(tmp_path / "in"))
    kept = ["time", "observed_time", "service", "severity_number", "body", "attributes"]
    assert sorted(otlp.logs(sent).select(*kept).collect(), key=str) == sorted(df.select(*kept).collect(), key=str)


def test_broken_lines_are_counted_or_fail(spark, logs, tmp_path):
    inbox = str(tmp_path / "in")
    requests.from_logs(logs([{"body": "good"}])).write.text(inbox)
    (tmp_path / "in" / "more.txt").write_text('{"resourceLogs": [{\n\n  \nnot json\n{"resourceLogs": []}\n')
    assert tuple(otlp.receipt(spark, "logs", inbox).first()) == (2, 2)
    assert [r["body"] for r in otlp.logs(otlp.read_requests(spark, "logs", inbox)).collect()] == ["good"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        otlp.logs(otlp.read_requests(spark, "logs", inbox, fail_on_malformed=True)).collect()


def test_a_malformed_record_leaves_the_others_alone(read):
    at, good = str(BASE), {"timeUnixNano": str(BASE), "count": "1", "bucketCounts": ["1"], "explicitBounds": []}
    logs = [{"timeUnixNano": t} for t in (at, "abc", "", "1.5", "99999999999999999999")]
    sent = read("logs", {"resourceLogs": [{"scopeLogs": [{"logRecords": [*logs, {"timeUnixNano": at, "observedTimeUnixNano": "x"}]}]}]})
    assert sorted(str(r["time"]) for r in otlp.logs(sent).collect()) == sorted([at, "None"])
    assert tuple(otlp.record_receipt(sent, "logs").first()) == (2, 4)
    spans = [{"startTimeUnixNano": a, "endTimeUnixNano": b} for a, b in ((at, at), ("abc", at), (at, "-"), ("-9000000000000000000", at))]
    sent = read("traces", {"resourceSpans": [{"scopeSpans": [{"spans": spans}]}]})
    assert sorted(str(r["duration_ns"]) for r in otlp.spans(sent).collect()) == ["0", "None"]
    assert tuple(otlp.record_receipt(sent, "spans").first()) == (2, 2)
    points = [good, {**good, "count": "many"}, {**good, "bucketCounts": ["1", "?"]}, {**good, "timeUnixNano": "now"}]
    sent = read("metrics", {"resourceMetrics": [{"scopeMetrics": [{"metrics": [
        {"name": "h", "histogram": {"dataPoints": points, "aggregationTemporality": 1}},
        {"name": "g", "gauge": {"dataPoints": [{"timeUnixNano": at, "asInt": "7"}, {"timeUnixNano": at, "asInt": "seven"}]}}]}]}]})
    assert tuple(otlp.record_receipt(sent, "metrics_histogram").first()) == (1, 3)
    assert [r["value"] for r in otlp.metrics(sent, "metrics_gauge").collect()] == [7.0]
    bad = otlp.records(sent, "metrics_gauge").where("_malformed").first()
    assert json.loads(bad["_record"])["asInt"] == "seven"


def test_sent_requests_take_a_fraction_of_their_text(spark, spans, tmp_path, monkeypatch):
    from teletide.plans import tables as plans
    monkeypatch.setattr(plans, "scratch_dir", lambda _, purpose: str(tmp_path / purpose))
    payloads = requests.from_spans(spans([{"duration_ns": i * 1000} for i in range(3000)])).cache()
    sent = otlp.spans(plans._sent(payloads, "traces"))
    assert (sent.count(), sent.selectExpr("sum(duration_ns)").first()[0]) == (3000, 3000 * 2999 // 2 * 1000)
    stored = sum(f.stat().st_size for f in (tmp_path / "otlp-traces").iterdir())
    assert stored * 5 < payloads.selectExpr("sum(length(value))").first()[0]
