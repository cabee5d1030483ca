"""Registered span and trace queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from teletide.functions import times
from teletide.model import NS_PER_DAY
from teletide.operators import discovery, logs as L, maintenance, sketches, traces as T
from teletide.operators.logs import LogQuery
from teletide.operators.traces import SpanMetricsQuery, TraceQuery
from teletide.plans.registry import bigints, joined, numbered, on, query
from teletide.session import scratch_dir
from teletide.sources import tables, warehouse
from teletide.store import Telemetry

START_1998 = 883_612_800_000_000_000
START_1999 = 915_148_800_000_000_000
MONTH = 30 * NS_PER_DAY

SPAN_COLUMNS = ["trace_id", "span_id", "parent_span_id", "name", "kind", "start_time", "duration_ns",
                "status_code", "status_message", "service", "attributes"]
_COLUMNS = ", ".join(SPAN_COLUMNS)


# --- Filters and single traces ---------------------------------------------------------------------

query("spans_filter", f"""
    SELECT {_COLUMNS} FROM spans
    WHERE name = 'line O' AND kind = 'INTERNAL' AND status_code = 'ERROR' AND service = 'svc-2'""")(
    on("spans", lambda df: T.filter_spans(df, TraceQuery(
        name="line O", kind="INTERNAL", status="ERROR", service="svc-2")).select(*SPAN_COLUMNS)))
query("spans_duration", f"""
    SELECT {_COLUMNS} FROM spans
    WHERE duration_ns BETWEEN 10000000 AND 20000000 AND start_time >= {START_1998} AND start_time < {START_1999}""")(
    on("spans", lambda df: T.filter_spans(df, TraceQuery(
        min_duration_ns=10_000_000, max_duration_ns=20_000_000, start=START_1998,
        end=START_1999)).select(*SPAN_COLUMNS)))


@query("get_trace", f"""
    SELECT {_COLUMNS}, row_number() OVER (ORDER BY start_time, span_id, duration_ns, name) AS rn
    FROM spans WHERE trace_id = '{77:032x}'""")
def get_trace(spark, root) -> DataFrame:
    trace = T.get_trace(warehouse.spans(spark, root), f"{77:032X}").select(*SPAN_COLUMNS)
    return numbered(trace, *[F.col(c) for c in ("start_time", "span_id", "duration_ns", "name")])


# --- Request metrics -------------------------------------------------------------------------------

def _red_sql(group: str = "", where: str = "true") -> str:
    keys = f", {group} AS g0" if group else ""
    return f"""
    SELECT start_time - start_time % {MONTH} AS bucket{keys}, count(*) AS calls,
           count(*) FILTER (status_code = 'ERROR') AS errors,
           round(quantile_cont(duration_ns, 0.5), 3) AS p50, round(quantile_cont(duration_ns, 0.95), 3) AS p95,
           round(quantile_cont(duration_ns, 0.99), 3) AS p99
    FROM spans WHERE {where} GROUP BY ALL"""


def _red(df: DataFrame) -> DataFrame:
    return df.withColumns({p: F.round(p, 3) for p in T.LATENCIES})


query("span_red", _red_sql(where="kind = 'SERVER'"))(
    on("spans", lambda df: _red(T.span_metrics(df, SpanMetricsQuery(MONTH, kind="SERVER")))))
query("span_red_split", _red_sql("name"))(  # every group large enough is worked on in parts
    on("spans", lambda df: _red(T.span_metrics(
        df.withColumn("attributes", F.to_json(F.struct("name"))),
        SpanMetricsQuery(MONTH, group_by=["name"]), split_above=50))))
query("span_red_by_service", _red_sql("service"))(
    on("spans", lambda df: _red(T.span_metrics(df, SpanMetricsQuery(MONTH, group_by=["service.name"])))))
query("span_red_by_attribute",
      _red_sql("coalesce(json_extract_string(attributes, '$.\"http.method\"'), '')", "status_code = 'ERROR'"))(
    on("spans", lambda df: _red(T.span_metrics(df, SpanMetricsQuery(
        MONTH, status="ERROR", group_by=["http.method"])))))
query("span_red_approx")(
    on("spans", lambda df: T.span_metrics_approx(df, SpanMetricsQuery(MONTH, group_by=["service"]))))
query("span_red_counts", f"""
    SELECT start_time - start_time % {MONTH} AS bucket, service AS g0, count(*) AS calls,
           count(*) FILTER (status_code = 'ERROR') AS errors FROM spans GROUP BY ALL""")(
    on("spans", lambda df: T.span_metrics_approx(
        df, SpanMetricsQuery(MONTH, group_by=["service"])).select("bucket", "g0", "calls", "errors")))


QUARTER = 3 * MONTH


def _within(spans: DataFrame, told: DataFrame, step: int, error: float) -> DataFrame:
    """Whether the quantiles told for each step and service lie within ``error`` of all ranks around theirs."""
    rows = spans.select(times.bucket(F.col("start_time"), step).alias("bucket"), F.col("service").alias("g0"), "duration_ns", "trace_id")
    both = rows.join(F.broadcast(told.select("bucket", "g0", *T.LATENCIES)), ["bucket", "g0"])  # a row per step and service
    n = F.count("*")
    near = [((F.count_if(F.col("duration_ns") < F.col(p)) <= n * (q + error)) & (F.count_if(F.col("duration_ns") <= F.col(p)) >= n * (q - error)))
            .alias(f"{p}_within") for p, q in T.LATENCIES.items()]
    return both.groupBy("bucket", "g0").agg(*near, F.countDistinct("trace_id").alias("exact"))


@query("span_red_approx_within", f"""
    SELECT start_time - start_time % {MONTH} AS bucket, service AS g0, count(*) AS calls,
           count(*) FILTER (status_code = 'ERROR') AS errors, true AS p50_within, true AS p95_within, true AS p99_within
    FROM spans GROUP BY ALL""")
def span_red_approx_within(spark, root) -> DataFrame:
    spans = warehouse.spans(spark, root)
    told = T.span_metrics_approx(spans, SpanMetricsQuery(MONTH, group_by=["service"]))
    return told.drop(*T.LATENCIES).join(_within(spans, told, MONTH, 0.001).drop("exact"), ["bucket", "g0"])


@query("span_sketches_rolled", f"""
    SELECT start_time - start_time % {QUARTER} AS bucket, service AS g0, count(*) AS calls,
           count(*) FILTER (status_code = 'ERROR') AS errors, true AS p50_within, true AS p95_within, true AS p99_within,
           true AS traces_within
    FROM spans GROUP BY ALL""")
def span_sketches_rolled(spark, root) -> DataFrame:
    """Monthly sketches, stored and rolled up to quarters, against the spans."""
    spans, path = warehouse.spans(spark, root), scratch_dir(spark, "sketches")
    sketches.span_sketches(spans, SpanMetricsQuery(MONTH, group_by=["service"])).write.parquet(path)
    told = sketches.answers(sketches.roll_up(spark.read.parquet(path), MONTH, QUARTER))
    checked = told.drop(*T.LATENCIES).join(_within(spans, told, QUARTER, sketches.RANK_ERROR), ["bucket", "g0"])
    near = F.abs(F.col("traces") - F.col("exact")) <= F.greatest(F.col("exact") * sketches.COUNT_ERROR, F.lit(1.0))
    return checked.withColumn("traces_within", near).drop("traces", "exact")


# --- Search ----------------------------------------------------------------------------------------

def _search_sql(where: str, limit: str = "", source: str = "spans") -> str:
    return f"""
    SELECT trace_id, arg_min(service, (start_time, span_id)) FILTER (parent_span_id IS NULL) AS root_service,
           arg_min(name, (start_time, span_id)) FILTER (parent_span_id IS NULL) AS root_name,
           min(start_time) AS start_time, max(start_time + duration_ns) - min(start_time) AS duration_ns,
           count(*) AS span_count, bool_or(status_code = 'ERROR') AS error
    FROM {source} GROUP BY trace_id HAVING bool_or({where})
    {limit}"""


query("search_traces", _search_sql("service = 'svc-1' AND status_code = 'ERROR' AND duration_ns >= 20000000"))(
    on("spans", lambda df: T.search_traces(df, TraceQuery(
        service="svc-1", status="ERROR", min_duration_ns=20_000_000))))
query("search_traces_attr", _search_sql(
    "json_extract_string(attributes, '$.\"http.method\"') IN ('POST', 'PUT') "
    "AND json_extract_string(attributes, '$.priority') NOT IN ('5-LOW') "
    f"AND start_time >= {START_1998} AND start_time < {START_1999}"))(
    on("spans", lambda df: T.search_traces(df, TraceQuery(
        attr_in={"http.method": ["POST", "PUT"]}, attr_not_in={"priority": ["5-LOW"]},
        start=START_1998, end=START_1999))))


@query("search_traces_newest", f"""
    WITH found AS ({_search_sql("TRY_CAST(json_extract_string(attributes, '$.qty') AS DOUBLE) > 49")})
    SELECT *, row_number() OVER (ORDER BY start_time DESC, trace_id) AS rn FROM found QUALIFY rn <= 20""")
def search_traces_newest(spark, root) -> DataFrame:
    found = T.search_traces(warehouse.spans(spark, root), TraceQuery(attr_gt={"qty": 49}, limit=20))
    return numbered(found, F.desc("start_time"), F.col("trace_id"))


_SELECTED = TraceQuery(service="svc-4", status="ERROR")
_MATCHED = f"""
    SELECT s.trace_id, s.span_id, s.start_time FROM spans s
    JOIN (SELECT trace_id FROM spans GROUP BY trace_id
          HAVING min(start_time) >= {START_1998} AND min(start_time) < {START_1999}) USING (trace_id)
    WHERE service = 'svc-4' AND status_code = 'ERROR'"""


def _matches(df: DataFrame) -> DataFrame:
    return T.spanset_match(df, _SELECTED, START_1998, START_1999)


query("spanset_match", f"SELECT trace_id, span_id FROM ({_MATCHED})")(
    on("spans", lambda df: _matches(df).select("trace_id", "span_id")))
query("spanset_lists", f"""
    WITH m AS ({_MATCHED})
    SELECT trace_id, 0::BIGINT AS part, string_agg(span_id, ',' ORDER BY start_time, span_id) AS span_ids
    FROM m GROUP BY trace_id""")(
    on("spans", lambda df: T.spanset_lists(_matches(df)).select("trace_id", "part", joined("span_ids"))))
query("spans_of_matches", f"""
    WITH m AS ({_MATCHED}) SELECT {_COLUMNS} FROM spans WHERE trace_id IN (SELECT trace_id FROM m)""")(
    on("spans", lambda df: T.spans_of(df, _matches(df)).select(*SPAN_COLUMNS)))


# --- Stored tables, where the trace index narrows the second scan ------------------------------------


# Seven years of days, each a folder, are brought together in some sixty; all starts are midnights, so nothing is lost.
CALENDAR = 40


def _stored(spark, root) -> Telemetry:
    """The spans written in three batches, the first two compacted; by as many tasks as the session deals rows to."""
    path = scratch_dir(spark, "stored-spans")
    spans = warehouse.spans(spark, root).withColumn("start_time", F.expr(f"start_time div {CALENDAR}"))
    early, even = F.col("start_time") < START_1998 // CALENDAR, F.col("duration_ns") % 2000 == 0
    tables.write_table(spans.where(early & even), "spans", f"{path}/spans")
    tables.write_table(spans.where(early & ~even), "spans", f"{path}/spans")
    maintenance.compact(spark, "spans", f"{path}/spans")
    tables.write_table(spans.where(~early), "spans", f"{path}/spans")
    return Telemetry.open(spark, path, ["spans"])


def _at_midnight(found: DataFrame) -> DataFrame:
    return found.withColumn("start_time", F.col("start_time") * CALENDAR)


query("search_traces_stored", f"""
    WITH near AS (SELECT * REPLACE (start_time // {CALENDAR} AS start_time) FROM spans)
    {_search_sql("service = 'svc-1' AND status_code = 'ERROR' AND duration_ns >= 45000000 "
                 f"AND start_time >= {START_1998 // CALENDAR} AND start_time < {(START_1998 + MONTH) // CALENDAR}", source="near")}""")(
    lambda spark, root: _stored(spark, root).search_traces(TraceQuery(
        service="svc-1", status="ERROR", min_duration_ns=45_000_000, start=START_1998 // CALENDAR,
        end=(START_1998 + MONTH) // CALENDAR)))
query("get_trace_stored", f"SELECT {_COLUMNS} FROM spans WHERE trace_id = '{77:032x}'")(
    lambda spark, root: _at_midnight(_stored(spark, root).get_trace(f"{77:032x}")).select(*SPAN_COLUMNS))


@query("spans_of_matches_stored", f"""
    WITH m AS ({_MATCHED}) SELECT {_COLUMNS} FROM spans WHERE trace_id IN (SELECT trace_id FROM m)""")
def spans_of_matches_stored(spark, root) -> DataFrame:
    db = _stored(spark, root)
    matches = T.spanset_match(db.table("spans"), _SELECTED, START_1998 // CALENDAR, START_1999 // CALENDAR, db.trace_index)
    return _at_midnight(db.spans_of(matches)).select(*SPAN_COLUMNS)


# --- Trees -----------------------------------------------------------------------------------------

query("trace_forest", """
    WITH RECURSIVE linked AS (
        SELECT n.*, p.span_id IS NOT NULL AS has_parent FROM nodes n
        LEFT JOIN nodes p ON p.trace_id = n.trace_id AND p.span_id = n.parent_span_id),
    walk AS (
        SELECT trace_id, span_id, span_id AS root_span_id, 0::BIGINT AS depth FROM linked WHERE NOT has_parent
        UNION ALL
        SELECT c.trace_id, c.span_id, w.root_span_id, w.depth + 1 FROM walk w
        JOIN linked c ON c.has_parent AND c.trace_id = w.trace_id AND c.parent_span_id = w.span_id)
    SELECT l.trace_id, l.span_id, l.parent_span_id, l.start_time, l.name, l.service, w.root_span_id, w.depth,
           row_number() OVER (PARTITION BY l.trace_id, CASE WHEN l.has_parent THEN l.parent_span_id END
                              ORDER BY l.start_time, l.span_id) AS sibling_rank,
           w.depth IS NULL AS in_cycle
    FROM linked l LEFT JOIN walk w ON w.trace_id = l.trace_id AND w.span_id = l.span_id""")(
    on("spans", T.trace_forest))


# --- Joins between signals -------------------------------------------------------------------------

_LOG_COLUMNS = ["record_id", "time", "service", "body", "trace_id"]
_SLOW = "kind = 'SERVER' AND status_code = 'ERROR'"


def _failed(spark, root) -> DataFrame:
    return T.filter_spans(warehouse.spans(spark, root), TraceQuery(kind="SERVER", status="ERROR"))


query("logs_with_trace", f"""
    SELECT record_id, time, service, body, trace_id FROM logs
    WHERE trace_id IN (SELECT trace_id FROM spans WHERE {_SLOW})""")(
    lambda spark, root: T.logs_with_trace(
        warehouse.logs(spark, root), _failed(spark, root)).select(*_LOG_COLUMNS))
query("logs_without_trace", f"""
    SELECT record_id, time, service, body, trace_id FROM logs
    WHERE trace_id IS NULL OR trace_id NOT IN (SELECT trace_id FROM spans WHERE {_SLOW})""")(
    lambda spark, root: T.logs_without_trace(
        warehouse.logs(spark, root), _failed(spark, root)).select(*_LOG_COLUMNS))
query("exemplar_spans", """
    SELECT e.metric, e.time, e.value, e.trace_id, e.span_id, n.name AS span_name, n.service AS span_service,
           n.start_time, n.duration_ns, n.status_code
    FROM exemplars e JOIN nodes n ON n.trace_id = e.trace_id AND n.span_id = e.span_id""")(
    lambda spark, root: T.exemplar_spans(
        discovery.metric_exemplars(warehouse.metrics_gauge(spark, root)),
        warehouse.spans(spark, root)).drop("attributes"))
query("exemplar_spans_stored", """
    SELECT e.metric, e.time, e.value, e.trace_id, e.span_id, n.name AS span_name, n.service AS span_service,
           n.start_time, n.duration_ns, n.status_code
    FROM exemplars e JOIN nodes n ON n.trace_id = e.trace_id AND n.span_id = e.span_id
    WHERE e.metric = 'events.error.value'""")(
    lambda spark, root: _at_midnight(T.exemplar_spans(
        discovery.metric_exemplars(warehouse.metrics_gauge(spark, root), "events.error.value"),
        *_stored(spark, root).spans_and_index()).drop("attributes")))
query("trace_logs", f"""
    SELECT record_id, time, service, body, trace_id, row_number() OVER (ORDER BY time, record_id) AS rn
    FROM logs WHERE trace_id = '{8:032x}'""")(
    on("logs", lambda df: numbered(bigints(L.query_logs(df, LogQuery(trace_id=f"{8:032x}"))),
                                   F.col("time"), F.col("record_id")).select(*_LOG_COLUMNS, "rn")))
