"""Registered table, OTLP, maintenance, SQL-function and SQL queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from teletide.functions import times
from teletide.functions.attrs import attr, canonical_json, json_text
from teletide.functions.register import register_functions
from teletide.functions.text import matches
from teletide.model import NS_PER_DAY, NS_PER_HOUR
from teletide.operators import maintenance
from teletide.operators.logs import LogQuery, count_logs, filter_logs
from teletide.plans.logs import DAY_10, DAY_12, EPOCH_2024
from teletide.plans.registry import bigints, on, query
from teletide.session import scratch_dir
from teletide.sources import otlp, requests, tables, warehouse

NOW = EPOCH_2024 + 30 * NS_PER_DAY


# --- OTLP requests, written as files and read back -------------------------------------------------


def _sent(payloads: DataFrame, signal: str) -> DataFrame:
    spark = payloads.sparkSession
    inbox = scratch_dir(spark, f"otlp-{signal}")
    requests.write(payloads, inbox)
    return otlp.read_requests(spark, signal, inbox)


@query("otlp_logs", """
    SELECT time, observed_time, service, severity_number, severity_text, body, attributes, trace_id,
           span_id, '{}' AS resource, '{"name":"warehouse"}' AS scope FROM logs""")
def otlp_logs(spark: SparkSession, root: str) -> DataFrame:
    sent = _sent(requests.from_logs(warehouse.logs(spark, root)), "logs")
    return bigints(otlp.logs(sent).drop("record_id"))


@query("otlp_receipt", """
    SELECT count(*) AS records, count(*) FILTER (severity_number >= 17) AS malformed,
           count(DISTINCT service) AS accepted_services FROM logs""")
def otlp_receipt(spark: SparkSession, root: str) -> DataFrame:
    """What arrives from files that hold a line broken off for each error beside the requests."""
    inbox, logs = scratch_dir(spark, "otlp-broken"), warehouse.logs(spark, root)
    requests.write(requests.from_logs(logs), inbox)
    broken = F.format_string('{"resourceLogs": [{"resource": %d', "record_id")
    requests.write(logs.where("severity_number >= 17").select(broken), inbox)
    arrived = otlp.logs(otlp.read_requests(spark, "logs", inbox)).agg(
        F.count("*").alias("records"), F.countDistinct("service").alias("accepted_services"))
    counts = arrived.unionByName(
        otlp.receipt(spark, "logs", inbox).select("malformed"), allowMissingColumns=True)
    return counts.agg(*[F.max(c).alias(c) for c in counts.columns])


@query("otlp_receipt_records", """
    SELECT count(*) AS accepted, count(*) FILTER (status_code = 'ERROR') AS malformed,
           CAST(sum(duration_ns % 1000003) AS BIGINT) AS checksum FROM spans""")
def otlp_receipt_records(spark: SparkSession, root: str) -> DataFrame:
    """Records of requests in which each failed span is sent once more with an end that is no number."""
    inbox, spans = scratch_dir(spark, "otlp-records"), warehouse.spans(spark, root)
    requests.write(requests.from_spans(spans), inbox)
    bad = ('{"resourceSpans":[{"scopeSpans":[{"spans":[{"traceId":"%s","spanId":"%s","startTimeUnixNano":"%d",'
           '"endTimeUnixNano":"soon"}]}]}]}')
    requests.write(spans.where("status_code = 'ERROR'").select(F.format_string(bad, "trace_id", "span_id", "start_time")), inbox)
    sent = otlp.read_requests(spark, "traces", inbox)
    kept = otlp.spans(sent).agg(F.sum(F.col("duration_ns") % 1000003).alias("checksum"))
    both = otlp.record_receipt(sent, "spans").unionByName(kept, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query("otlp_spans", """
    SELECT trace_id, span_id, parent_span_id, name, kind, start_time, duration_ns, status_code,
           service, attributes FROM spans""")
def otlp_spans(spark: SparkSession, root: str) -> DataFrame:
    sent = _sent(requests.from_spans(warehouse.spans(spark, root)), "traces")
    return otlp.spans(sent).drop("status_message", "resource", "scope")


@query("otlp_scalar_metrics", """
    SELECT point_time, metric, unit, service, attributes, temporality, is_monotonic, value,
           CASE WHEN event_type = 'error' AND extra = 0 THEN lpad(lower(to_hex(event_id)), 32, '0') END AS trace_id
    FROM metrics_gauge
    UNION ALL SELECT *, NULL FROM metrics_sum""")
def otlp_scalar_metrics(spark: SparkSession, root: str) -> DataFrame:
    payloads = requests.from_gauge(warehouse.metrics_gauge(spark, root)).unionByName(
        requests.from_sum(warehouse.metrics_sum(spark, root)))
    sent = _sent(payloads, "metrics")
    both = otlp.metrics(sent, "metrics_gauge").unionByName(otlp.metrics(sent, "metrics_sum"))
    return both.select("point_time", "metric", "unit", "service", "attributes", "temporality",
                       "is_monotonic", "value", F.get("exemplars", 0)["trace_id"].alias("trace_id"))


@query("otlp_histograms", """
    SELECT point_time, metric, service, temporality, count, round(sum, 2) AS sum,
           array_to_string(bucket_counts, ',') AS buckets FROM metrics_histogram
    UNION ALL
    SELECT point_time, metric, service, temporality, count, round(sum, 2),
           '0@-1:' || array_to_string(positive_counts, ',') FROM metrics_exp_histogram
    UNION ALL
    SELECT point_time, metric, service, temporality, count, round(sum, 2),
           '0=' || CAST(round(q0 * 100) AS BIGINT) || ',1=' || CAST(round(q1 * 100) AS BIGINT)
    FROM metrics_summary""")
def otlp_histograms(spark: SparkSession, root: str) -> DataFrame:
    payloads = requests.from_histogram(warehouse.metrics_histogram(spark, root)).unionByName(
        requests.from_exp_histogram(warehouse.metrics_exp_histogram(spark, root))).unionByName(
        requests.from_summary(warehouse.metrics_summary(spark, root)))
    sent = _sent(payloads, "metrics")
    common = ["point_time", "metric", "service", "temporality", "count", F.round("sum", 2).alias("sum")]
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    plain = otlp.metrics(sent, "metrics_histogram").select(*common, text("bucket_counts").alias("buckets"))
    exp = otlp.metrics(sent, "metrics_exp_histogram").select(*common, F.concat(
        F.col("scale").cast("string"), F.lit("@"), F.col("positive_offset").cast("string"), F.lit(":"),
        text("positive_counts")).alias("buckets"))
    cents = F.transform("quantile_values", lambda v: F.concat(
        F.round(v["quantile"]).cast("bigint").cast("string"), F.lit("="),
        F.round(v["value"] * 100).cast("bigint").cast("string")))
    summary = otlp.metrics(sent, "metrics_summary").select(
        *common, F.array_join(cents, ",").alias("buckets"))
    return plain.unionByName(exp).unionByName(summary)


# --- Tables by name --------------------------------------------------------------------------------

_NAMES = ["logs", "spans", "metrics_gauge", "metrics_sum", "metrics_histogram", "metrics_exp_histogram", "metrics_summary"]


@query("register_tables", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, false AS refused FROM {t}" for t in _NAMES)
       + " UNION ALL SELECT 'events', NULL, true")
def register_tables(spark: SparkSession, root: str) -> DataFrame:
    """Every telemetry table by its name; any other name is refused."""
    tables.register_tables(spark, warehouse.all_tables(spark, root))

    def row(name: str) -> DataFrame:
        try:
            found = tables.table(spark, name).agg(F.count("*").alias("rows"), F.lit(False).alias("refused"))
        except ValueError:
            found = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"), F.lit(True).alias("refused"))
        return found.select(F.lit(name).alias("name"), "rows", "refused")
    return reduce(DataFrame.unionByName, [row(n) for n in [*_NAMES, "events"]])


# --- Table folders ---------------------------------------------------------------------------------

_LOG_ROWS = ("time, observed_time, service, severity_number, severity_text, body, attributes, trace_id, "
             "span_id, record_id")


def _log_rows(df: DataFrame, *extra: str) -> DataFrame:
    return bigints(df.select(*[c.strip() for c in _LOG_ROWS.split(",")], *extra))


def _written(spark: SparkSession, root: str, purpose: str, **options) -> str:
    path = scratch_dir(spark, purpose)
    tables.write_table(warehouse.logs(spark, root), "logs", path, **options)
    return path


@query("write_table", f"SELECT {_LOG_ROWS}, strftime(make_timestamp(time // 1000), '%Y-%m-%d') AS day FROM logs")
def write_table(spark: SparkSession, root: str) -> DataFrame:
    path = _written(spark, root, "table", codec="zstd", level=3)
    stored = tables.read_table(spark, "logs", path)
    return _log_rows(stored.withColumn("day", F.col("day").cast("string")), "day")


_TWO_RUNS = """
    SELECT *, CASE WHEN record_id % 2 = 1 THEN json_extract_string(attributes, '$.tenant') END AS tenant,
           json_extract_string(attributes, '$."http.method"') AS method FROM logs"""


def _two_runs(spark: SparkSession, root: str) -> str:
    """Even records stored with one promoted key, odd ones with two."""
    path = scratch_dir(spark, "promoted")
    logs = warehouse.logs(spark, root)
    even = F.col("record_id") % 2 == 0
    tables.write_table(logs.where(even), "logs", path, promote_keys=["http.method", "service"])
    tables.write_table(logs.where(~even), "logs", path, promote_keys=["http.method", "tenant"])
    return path


def _per_tenant(df: DataFrame) -> DataFrame:
    return df.groupBy(attr(df, "tenant").alias("tenant"), attr(df, "http.method").alias("method")).agg(
        F.count("*").alias("rows"), F.sum(F.col("time") % 1000003).alias("checksum"))


_PER_TENANT = """
    SELECT tenant, method, count(*) AS rows, CAST(sum(time % 1000003) AS BIGINT) AS checksum
    FROM t GROUP BY ALL"""


@query("promote_keys", f"WITH t AS ({_TWO_RUNS}) {_PER_TENANT}")
def promote_keys(spark: SparkSession, root: str) -> DataFrame:
    return _per_tenant(tables.read_table(spark, "logs", _two_runs(spark, root)))


@query("promote_keys_dropped", """
    WITH t AS (SELECT *, json_extract_string(attributes, '$.tenant') AS tenant,
                      json_extract_string(attributes, '$."http.method"') AS method FROM logs)""" + _PER_TENANT)
def promote_keys_dropped(spark: SparkSession, root: str) -> DataFrame:
    """A key no longer promoted is read from the attributes of every row."""
    return _per_tenant(tables.read_table(
        spark, "logs", _two_runs(spark, root), promoted=["http.method"]))


@query("compact_table", f"WITH t AS ({_TWO_RUNS}) {_PER_TENANT}")
def compact_table(spark: SparkSession, root: str) -> DataFrame:
    path = _two_runs(spark, root)
    maintenance.compact(spark, "logs", path)
    return _per_tenant(tables.read_table(spark, "logs", path))


@query("compact_rows", f"SELECT {_LOG_ROWS} FROM logs")
def compact_rows(spark: SparkSession, root: str) -> DataFrame:
    path = _two_runs(spark, root)
    maintenance.compact(spark, "logs", path)
    return _log_rows(tables.read_table(spark, "logs", path))


@query("compact_twice", "SELECT CAST(0 AS BIGINT) AS merged, count(*) AS rows FROM logs")
def compact_twice(spark: SparkSession, root: str) -> DataFrame:
    """Files that a second run merges, and the rows left: a compacted table is settled."""
    path = _two_runs(spark, root)
    maintenance.compact(spark, "logs", path)
    again = maintenance.compact(spark, "logs", path)
    return tables.read_table(spark, "logs", path).agg(
        F.lit(again["files_merged"]).cast("bigint").alias("merged"), F.count("*").alias("rows"))


@query("export_range", f"""
    SELECT trace_id, span_id, name, start_time, duration_ns FROM spans
    WHERE start_time >= {883_612_800_000_000_000} AND start_time < {915_148_800_000_000_000}""")
def export_range(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    rows = tables.export_range(warehouse.spans(spark, root), "spans",
                               883_612_800_000_000_000, 915_148_800_000_000_000)
    tables.write_export(rows, path)
    return spark.read.parquet(path).select("trace_id", "span_id", "name", "start_time", "duration_ns")


@query("snapshot_table", f"SELECT {_LOG_ROWS} FROM logs")
def snapshot_table(spark: SparkSession, root: str) -> DataFrame:
    target = scratch_dir(spark, "snapshot")
    maintenance.snapshot(spark, _written(spark, root, "table"), target)
    return _log_rows(tables.read_table(spark, "logs", target))


@query("read_range", f"""
    SELECT {_LOG_ROWS} FROM logs WHERE time >= {DAY_10} AND time < {DAY_12} AND service = 'svc-2'""")
def read_range(spark: SparkSession, root: str) -> DataFrame:
    """A time range over a stored table, pruned to its day partitions."""
    stored = tables.read_table(spark, "logs", _written(spark, root, "table"))
    return _log_rows(filter_logs(stored, LogQuery(service="svc-2", start=DAY_10, end=DAY_12)))


query("retain_days", f"SELECT {_LOG_ROWS} FROM logs WHERE time >= {NOW - 7 * NS_PER_DAY}")(
    on("logs", lambda df: _log_rows(maintenance.retain_days(df, "logs", 7, NOW))))


@query("retain_days_stored", f"""
    SELECT time - time % {NS_PER_DAY} AS day, count(*) AS rows FROM logs
    WHERE time >= {NOW - 7 * NS_PER_DAY} GROUP BY ALL""")
def retain_days_stored(spark: SparkSession, root: str) -> DataFrame:
    path = _written(spark, root, "retention")
    maintenance.enforce_retention(spark, path, NOW, days=7)
    stored = tables.read_table(spark, "logs", path)
    return stored.groupBy(times.bucket(F.col("time"), NS_PER_DAY).alias("day")).agg(
        F.count("*").alias("rows"))


@query("retain_bytes", f"""
    SELECT time - time % {NS_PER_DAY} AS day, count(*) AS rows FROM logs
    WHERE time >= {NOW - 10 * NS_PER_DAY} GROUP BY ALL""")
def retain_bytes(spark: SparkSession, root: str) -> DataFrame:
    """A budget that holds exactly the newest ten of thirty days."""
    path = _written(spark, root, "budget")
    newest = maintenance.data_files(spark, path).where(F.col("day") >= times.to_day(F.lit(NOW - 10 * NS_PER_DAY)))
    budget = newest.agg(F.sum("bytes")).first()[0]
    maintenance.enforce_retention(spark, path, NOW, max_bytes=budget)
    stored = tables.read_table(spark, "logs", path)
    return stored.groupBy(times.bucket(F.col("time"), NS_PER_DAY).alias("day")).agg(
        F.count("*").alias("rows"))


query("table_stats", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, min({c}) AS min_time, max({c}) AS max_time FROM {t}"
    for t, c in [("logs", "time"), ("spans", "start_time")] + [
        (m, "point_time") for m in ("metrics_gauge", "metrics_sum", "metrics_histogram",
                                    "metrics_exp_histogram", "metrics_summary")]))(
    lambda spark, root: maintenance.table_stats(warehouse.all_tables(spark, root)))


@query("segment_stats", """
    SELECT strftime(make_timestamp(time // 1000), '%Y-%m-%d') AS day, count(*) AS rows,
           min(time) AS min_time, max(time) AS max_time FROM logs GROUP BY ALL""")
def segment_stats(spark: SparkSession, root: str) -> DataFrame:
    """Segments of a stored table, summed up per day folder."""
    stored = tables.read_table(spark, "logs", _written(spark, root, "segments"))
    per_file = maintenance.segments(stored, "logs")
    return per_file.groupBy(F.regexp_extract("path", r"day=(\d{4}-\d{2}-\d{2})", 1).alias("day")).agg(
        F.sum("rows").alias("rows"), F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"))


# --- Scalar functions ------------------------------------------------------------------------------


def _sql(text: str, *views: str):
    """A SQL text over registered telemetry views."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        register_functions(spark)
        tables.register_tables(spark, {v: warehouse.BUILDERS[v](spark, root) for v in views})
        return spark.sql(text)
    return run


query("fn_json_get_str", """
    SELECT record_id, json_extract_string(attributes, '$."http.method"') AS method,
           json_extract_string(attributes, '$.k') AS k, json_extract_string(attributes, '$.none') AS none
    FROM logs""")(
    on("logs", lambda df: df.select("record_id", json_text(F.col("attributes"), "http.method").alias("method"),
                                    json_text(F.col("attributes"), "k").alias("k"),
                                    json_text(F.col("attributes"), "none").alias("none"))))
query("fn_json_get_str_sql", """
    SELECT json_extract_string(attributes, '$."http.method"') AS method, count(*) AS n FROM logs GROUP BY ALL""")(
    _sql("SELECT json_get_str(attributes, 'http.method') AS method, count(*) AS n FROM logs GROUP BY ALL",
         "logs"))
query("fn_matches", r"""
    SELECT record_id, list_contains(string_split_regex(lower(body), '[^\p{L}\p{N}]+'), 'click')
             AND list_contains(string_split_regex(lower(body), '[^\p{L}\p{N}]+'), '8') AS hit FROM logs""")(
    on("logs", lambda df: df.select("record_id", matches(F.col("body"), "CLICK, 8").alias("hit"))))
query("fn_matches_sql", r"""
    SELECT count(*) AS n FROM logs
    WHERE list_contains(string_split_regex(lower(body), '[^\p{L}\p{N}]+'), 'click')
      AND list_contains(string_split_regex(lower(body), '[^\p{L}\p{N}]+'), '8')""")(
    _sql("SELECT count(*) AS n FROM logs WHERE matches(body, 'CLICK, 8')", "logs"))
query("fn_hex", """
    SELECT record_id, span_id AS back, substr(trace_id, 17) AS tail FROM logs WHERE trace_id IS NOT NULL""")(
    _sql("SELECT record_id, hex_lower(unhex(span_id)) AS back, hex_lower(substr(unhex(trace_id), 9)) AS tail "
         "FROM logs WHERE trace_id IS NOT NULL", "logs"))
query("fn_canonical_json", """
    SELECT event_id, '{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k')
        || ',"z":' || user_id || '}' AS labels FROM events""")(
    lambda spark, root: warehouse.table(spark, root, "events").select("event_id", canonical_json(F.concat(
        F.lit('{"z": '), F.col("user_id").cast("string"), F.lit(', "a": "'), F.col("event_type"),
        F.lit('", '), F.expr("substring(props, 2)"))).alias("labels")))
query("fn_bucket", f"SELECT record_id, time - time % {NS_PER_HOUR} AS bucket FROM logs")(
    _sql(f"SELECT record_id, time_bucket(time, {NS_PER_HOUR}) AS bucket FROM logs", "logs"))


# --- General SQL over the tables -------------------------------------------------------------------


def _same_sql(name: str, text: str, *views: str) -> None:
    """One text that both engines understand."""
    query(name, text)(_sql(text, *views))


_same_sql("sql_filter_project", """
    SELECT record_id, service || ':' || body AS line, severity_number * 2 AS s FROM logs
    WHERE severity_number >= 13 AND body LIKE 'error%'""".replace(
    "severity_number * 2", "CAST(severity_number * 2 AS BIGINT)"), "logs")
_same_sql("sql_group_by", """
    SELECT service, severity_text, count(*) AS n, count(DISTINCT body) AS bodies, min(time) AS first_at,
           max(time) AS last_at
    FROM logs GROUP BY service, severity_text HAVING count(*) > 1""", "logs")
_same_sql("sql_cube", """
    SELECT service, kind, status_code, count(*) AS n, GROUPING(service) AS gs FROM spans
    GROUP BY CUBE (service, kind, status_code)""".replace("GROUPING(service)", "CAST(GROUPING(service) AS BIGINT)"),
    "spans")
_same_sql("sql_rollup", """
    SELECT service, name, count(*) AS n, max(duration_ns) AS slowest FROM spans
    GROUP BY ROLLUP (service, name)""", "spans")
_same_sql("sql_grouping_sets", """
    SELECT service, status_code, count(*) AS n FROM spans
    GROUP BY GROUPING SETS ((service), (status_code), ())""", "spans")
_same_sql("sql_joins", """
    SELECT l.service, count(*) AS logs, count(s.span_id) AS with_span, count(DISTINCT s.name) AS names
    FROM logs l LEFT JOIN spans s ON s.trace_id = l.trace_id AND s.span_id = l.span_id
    WHERE l.trace_id IS NOT NULL GROUP BY l.service""", "logs", "spans")
_same_sql("sql_semi_anti", """
    SELECT record_id, body FROM logs l
    WHERE EXISTS (SELECT 1 FROM spans s WHERE s.trace_id = l.trace_id AND s.status_code = 'ERROR')
      AND NOT EXISTS (SELECT 1 FROM spans s WHERE s.trace_id = l.trace_id AND s.service = 'svc-0')""",
    "logs", "spans")
_same_sql("sql_windows", """
    SELECT trace_id, span_id, start_time, duration_ns,
           rank() OVER (PARTITION BY trace_id ORDER BY duration_ns DESC) AS slowest,
           start_time - lag(start_time) OVER (PARTITION BY trace_id ORDER BY start_time, span_id, duration_ns) AS gap,
           CAST(sum(duration_ns) OVER (PARTITION BY trace_id ORDER BY start_time
                RANGE BETWEEN 2592000000000000 PRECEDING AND CURRENT ROW) AS BIGINT) AS month_sum
    FROM spans WHERE kind = 'INTERNAL'""".replace("rank()", "CAST(rank()").replace(
    "DESC) AS slowest", "DESC) AS BIGINT) AS slowest"), "spans")
_same_sql("sql_set_ops", """
    (SELECT trace_id FROM spans WHERE status_code = 'ERROR' INTERSECT SELECT trace_id FROM logs)
    EXCEPT SELECT trace_id FROM spans WHERE service = 'svc-1'
    UNION ALL SELECT trace_id FROM spans WHERE name = 'order 5-LOW' AND status_code = 'UNSET'""",
    "spans", "logs")
_same_sql("sql_top_k", """
    SELECT trace_id, span_id, duration_ns FROM spans
    ORDER BY duration_ns DESC, trace_id, span_id LIMIT 25 OFFSET 5""", "spans")
_SUBQUERY = """
    SELECT service, count(*) AS slow, (SELECT max(duration_ns) FROM spans) AS slowest FROM spans s
    WHERE duration_ns > (SELECT avg(duration_ns) FROM spans t WHERE t.service = s.service AND t.kind = s.kind)
      AND service IN (SELECT service FROM logs WHERE severity_number = 17)
    GROUP BY service"""
# The few means and services are told to every task: dealt by service, all spans would meet in a task for each service.
query("sql_subquery", _SUBQUERY)(_sql(
    _SUBQUERY.replace("(SELECT avg", "(SELECT /*+ BROADCAST(t) */ avg").replace(
        "SELECT service FROM logs", "SELECT /*+ BROADCAST(logs) */ DISTINCT service FROM logs"), "spans", "logs"))
query("sql_approx_distinct")(_sql(
    "SELECT service, approx_count_distinct(trace_id) AS traces FROM spans GROUP BY service", "spans"))
# The exact number by a plain aggregate of its own: beside DISTINCT a sketch would be kept for every trace.
query("sql_approx_distinct_within", "SELECT service, true AS within FROM spans GROUP BY service")(_sql("""
    WITH told AS (SELECT service, approx_count_distinct(trace_id) AS traces FROM spans GROUP BY service),
    exact AS (SELECT service, count(trace_id) AS traces FROM (SELECT DISTINCT service, trace_id FROM spans) GROUP BY service)
    SELECT told.service, abs(told.traces - exact.traces) <= 0.15 * exact.traces AS within
    FROM told JOIN exact ON told.service <=> exact.service""", "spans"))
query("sql_count", "SELECT count(*) AS count FROM logs WHERE time >= 0")(
    on("logs", lambda df: count_logs(df, LogQuery())))
query("sql_histogram_quantile", """
    WITH b AS (SELECT metric, service, point_time, unnest(bucket_counts) AS n,
                      unnest([10, 20, 30, 40, NULL]) AS le, unnest([1, 2, 3, 4, 5]) AS i FROM metrics_histogram),
    run AS (SELECT *, sum(n) OVER (PARTITION BY metric, service, point_time ORDER BY i) AS upto,
                   sum(n) OVER (PARTITION BY metric, service, point_time) AS total FROM b),
    hit AS (SELECT *, row_number() OVER (PARTITION BY metric, service, point_time ORDER BY i) AS nth FROM run
            WHERE upto >= 0.9 * total AND upto > 0)
    SELECT metric, service, point_time,
           round(CASE WHEN i = 5 THEN 40 ELSE le - 10 + 10 * (0.9 * total - (upto - n)) / n END, 9) AS q
    FROM hit WHERE nth = 1""")(_sql(
    "SELECT metric, service, point_time, round(histogram_quantile(0.9D, explicit_bounds, bucket_counts), 9) AS q "
    "FROM metrics_histogram", "metrics_histogram"))
