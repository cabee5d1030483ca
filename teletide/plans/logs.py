"""Registered log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from teletide.model import NS_PER_DAY, NS_PER_HOUR
from teletide.operators import logs as L
from teletide.operators.logs import LogQuery
from teletide.plans.registry import QUERIES, bigints, numbered, on, query
from teletide.sources import warehouse

EPOCH_2024 = 1_704_067_200_000_000_000
DAY_10 = EPOCH_2024 + 10 * NS_PER_DAY
DAY_12 = EPOCH_2024 + 12 * NS_PER_DAY

COLUMNS = "time, observed_time, service, severity_number, severity_text, body, attributes, trace_id, span_id"


def _filtered(q: LogQuery):
    return on("logs", lambda df: bigints(L.filter_logs(df, q).select(
        "time", "observed_time", "service", "severity_number", "body", "attributes", "trace_id",
        "record_id")))


def _predicate(name: str, q: LogQuery, where: str) -> None:
    """Register a filter over all logs, compared on whole rows."""
    query(name, "SELECT time, observed_time, service, severity_number, body, attributes, trace_id, "
                f"record_id FROM logs WHERE {where}")(_filtered(q))


def _json(key: str) -> str:
    return f"json_extract_string(attributes, '$.\"{key}\"')"


def _terms(column: str) -> str:
    return rf"string_split_regex(lower({column}), '[^\p{{L}}\p{{N}}]+')"


_predicate("logs_service", LogQuery(service="svc-1"), "service = 'svc-1'")
_predicate("logs_match", LogQuery(match="Purchase 7"),
           f"list_contains({_terms('body')}, 'purchase') AND list_contains({_terms('body')}, '7')")
_predicate("logs_attr_eq", LogQuery(attr_eq={"http.method": "POST", "service.name": "svc-2"}),
           f"{_json('http.method')} = 'POST' AND service = 'svc-2'")
_predicate("logs_attr_exists", LogQuery(attr_exists=["tenant", "service.name"]),
           f"{_json('tenant')} IS NOT NULL AND service IS NOT NULL")
_predicate("logs_attr_matches", LogQuery(attr_matches={"http.method": "get"}),
           f"list_contains({_terms(_json('http.method'))}, 'get')")
_predicate("logs_attr_in", LogQuery(attr_in={"http.method": ["GET", "PUT"]}),
           f"{_json('http.method')} IN ('GET', 'PUT')")
_predicate("logs_attr_not_in", LogQuery(attr_not_in={"tenant": ["t1", "t2"]}),
           f"{_json('tenant')} NOT IN ('t1', 't2')")
for _name, _op, _q in [
    ("gt", ">", LogQuery(attr_gt={"k": 42})), ("ge", ">=", LogQuery(attr_ge={"k": 42})),
    ("lt", "<", LogQuery(attr_lt={"k": 42})), ("le", "<=", LogQuery(attr_le={"k": 42})),
]:
    _predicate(f"logs_attr_{_name}", _q, f"TRY_CAST({_json('k')} AS DOUBLE) {_op} 42")
_predicate("logs_attr_regex", LogQuery(attr_regex={"tenant": "^t[0-3]$", "http.method": "U|E"}),
           f"regexp_matches({_json('tenant')}, '^t[0-3]$') AND regexp_matches({_json('http.method')}, 'U|E')")
_predicate("logs_by_trace", LogQuery(trace_id=f"{42:032X}", span_id=f"{42 * 16:016x}"),
           f"trace_id = '{42:032x}' AND span_id = '{42 * 16:016x}'")
_predicate("logs_severity", LogQuery(severity_at_least=13), "severity_number >= 13")
_predicate("logs_time_range", LogQuery(start=DAY_10, end=DAY_12),
           f"time >= {DAY_10} AND time < {DAY_12}")
_predicate("logs_observed_after", LogQuery(observed_after=DAY_12), f"observed_time > {DAY_12}")


@query("docs_match", rf"""
    SELECT doc_id AS record_id, source AS service, md5(text) AS body_md5 FROM documents
    WHERE list_contains({_terms('text')}, 'the') AND list_contains({_terms('text')}, 'license')""")
def docs_match(spark, root) -> DataFrame:
    """Full-text search over long texts."""
    found = L.filter_logs(warehouse.document_logs(spark, root), LogQuery(match="license THE"))
    return found.select("record_id", "service", F.md5(F.col("body").cast("binary")).alias("body_md5"))


# --- Order, limit and pages ------------------------------------------------------------------------

_ERRORS = LogQuery(service="svc-3", severity_at_least=13, attr_exists=["tenant"], start=EPOCH_2024,
                   end=DAY_12, limit=100)


@query("query_logs", f"""
    SELECT {COLUMNS}, row_number() OVER (ORDER BY time, record_id) AS rn FROM logs
    WHERE service = 'svc-3' AND severity_number >= 13 AND {_json('tenant')} IS NOT NULL
      AND time >= {EPOCH_2024} AND time < {DAY_12}
    QUALIFY rn <= 100""")
def query_logs(spark, root) -> DataFrame:
    rows = L.query_logs(warehouse.logs(spark, root), _ERRORS)
    return bigints(numbered(rows, F.col("time"), F.col("record_id")).drop("record_id"))


def _positions(q: LogQuery):
    return on("logs", lambda df: L.positions(df, q).select("rn", "record_id", "time", "observed_time"))


query("logs_order_time", """
    SELECT row_number() OVER (ORDER BY time, record_id) AS rn, record_id, time, observed_time
    FROM logs""")(_positions(LogQuery()))
query("logs_order_time_backward", """
    SELECT row_number() OVER (ORDER BY time DESC, record_id DESC) AS rn, record_id, time, observed_time
    FROM logs""")(_positions(LogQuery(backward=True)))
query("logs_order_observed", """
    SELECT row_number() OVER (ORDER BY observed_time ASC NULLS LAST, time, record_id) AS rn,
           record_id, time, observed_time
    FROM logs""")(_positions(LogQuery(order_by=L.OBSERVED_TIME)))
query("logs_order_observed_backward", """
    SELECT row_number() OVER (ORDER BY observed_time DESC NULLS LAST, time DESC, record_id DESC) AS rn,
           record_id, time, observed_time
    FROM logs""")(_positions(LogQuery(order_by=L.OBSERVED_TIME, backward=True)))


@query("logs_topk", """
    SELECT record_id, time, body, row_number() OVER (ORDER BY time DESC, record_id DESC) AS rn
    FROM logs QUALIFY rn <= 50""")
def logs_topk(spark, root) -> DataFrame:
    rows = L.query_logs(warehouse.logs(spark, root), LogQuery(backward=True, limit=50))
    return numbered(rows, F.desc("time"), F.desc("record_id")).select("record_id", "time", "body", "rn")


@query("log_page", """
    SELECT record_id, time, body, rn - 80 AS rn FROM (
        SELECT *, row_number() OVER (ORDER BY time, record_id) AS rn FROM logs WHERE service = 'svc-0')
    WHERE rn > 80 AND rn <= 120""")
def log_page(spark, root) -> DataFrame:
    page = L.log_page(warehouse.logs(spark, root), LogQuery(service="svc-0", limit=40), after=80)
    return numbered(page.rows, F.col("time"), F.col("record_id")).select("record_id", "time", "body", "rn")


@query("log_page_keyset", f"""
    SELECT record_id, time, body, row_number() OVER (ORDER BY time, record_id) AS rn
    FROM logs WHERE time > {DAY_10} OR (time = {DAY_10} AND record_id > 100) QUALIFY rn <= 40""")
def log_page_keyset(spark, root) -> DataFrame:
    rows = L.log_page_after(warehouse.logs(spark, root), LogQuery(limit=40),
                            {"time": DAY_10, "record_id": 100})
    return numbered(rows, F.col("time"), F.col("record_id")).select("record_id", "time", "body", "rn")


@query("log_page_stats", """
    WITH n AS (SELECT count(*) AS n FROM logs WHERE service = 'svc-0')
    SELECT 80::BIGINT AS after, 40::BIGINT AS returned, 120::BIGINT AS next_offset UNION ALL
    SELECT n - 10, 10, NULL FROM n UNION ALL SELECT n, 0, NULL FROM n""")
def log_page_stats(spark, root) -> DataFrame:
    """Size and successor of a full page, of the last one and of one behind it."""
    logs, q = warehouse.logs(spark, root), LogQuery(service="svc-0", limit=40)
    n = L.count_logs(logs, q).first()[0]
    rows = []
    for after in (80, n - 10, n):
        page = L.log_page(logs, q, after)
        page.rows.write.format("noop").mode("overwrite").save()
        rows.append((after, page.returned, page.next_offset))
    return spark.createDataFrame(rows, "after long, returned long, next_offset long")


@query("log_order_unknown", """
    SELECT 'time' AS axis, false AS refused, count(*) AS rows FROM logs UNION ALL
    SELECT 'observed_time', false, count(*) FROM logs UNION ALL SELECT 'body', true, NULL""")
def log_order_unknown(spark, root) -> DataFrame:
    """Rows ordered by each axis; one that is none is refused."""
    logs, rows = warehouse.logs(spark, root), []
    for axis in ("time", "observed_time", "body"):
        try:
            rows.append((axis, False, L.query_logs(logs, LogQuery(order_by=axis)).count()))
        except ValueError:
            rows.append((axis, True, None))
    return spark.createDataFrame(rows, "axis string, refused boolean, rows long")


# --- Counts and volume -----------------------------------------------------------------------------

query("count_logs", "SELECT count(*) AS count FROM logs WHERE service = 'svc-1' AND severity_number >= 13")(
    on("logs", lambda df: L.count_logs(
        df, LogQuery(service="svc-1", severity_at_least=13, limit=1, backward=True))))
query("log_volume", f"""
    SELECT time - time % {NS_PER_HOUR} AS bucket_time, '{{}}' AS labels, count(*) AS count
    FROM logs GROUP BY ALL""")(
    on("logs", lambda df: L.log_volume(df, LogQuery(), NS_PER_HOUR)))
query("log_volume_by", f"""
    SELECT time - time % {NS_PER_DAY} AS bucket_time,
           '{{"http.method":"' || {_json('http.method')} || '","tenant":"' || coalesce({_json('tenant')}, '')
             || '"}}' AS labels, count(*) AS count
    FROM logs WHERE severity_number >= 13 GROUP BY ALL""")(
    on("logs", lambda df: L.log_volume(
        df, LogQuery(severity_at_least=13), NS_PER_DAY, ["tenant", "http.method"])))
query("log_volume_by_service", f"""
    SELECT time - time % {NS_PER_HOUR} AS bucket_time,
           '{{"service.name":"' || service || '"}}' AS labels, count(*) AS count
    FROM logs GROUP BY ALL""")(
    on("logs", lambda df: L.log_volume(df, LogQuery(), NS_PER_HOUR, ["service.name"])))
query("log_volume_by_column", f"""
    SELECT time - time % {NS_PER_HOUR} AS bucket_time,
           '{{"service":"' || service || '"}}' AS labels, count(*) AS count
    FROM logs GROUP BY ALL""")(
    on("logs", lambda df: L.log_volume(df, LogQuery(), NS_PER_HOUR, ["service"])))

flagship = QUERIES["log_volume_by_service"]
