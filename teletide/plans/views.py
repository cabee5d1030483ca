"""The derived telemetry tables once more, as plain SQL for the comparison engine.

``with_views("...")`` prefixes a query with the definitions it mentions.
"""

from __future__ import annotations

import re


def _hex(x: str, width: int) -> str:
    return f"lpad(lower(to_hex({x})), {width}, '0')"


def _method(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' ELSE 'PUT' END"


_HOST = "'{\"host\":\"h' || (user_id % 7) || '\",\"rack\":' || ((user_id % 7) // 4) || '}'"
_QTY = "l_quantity"
_YEAR_NS = "CAST(epoch_ns(date_trunc('year', l_shipdate)::TIMESTAMP) AS BIGINT)"

VIEWS: dict[str, str] = {
    "logs": f"""
        SELECT CAST(epoch_ns(ts) AS BIGINT) AS time,
               CASE WHEN event_id % 10 <> 7
                    THEN CAST(epoch_ns(ts) AS BIGINT) + ((event_id * 7919) % 600) * 1000000000 END AS observed_time,
               'svc-' || (user_id % 5) AS service,
               CAST(CASE event_type WHEN 'error' THEN 17 WHEN 'purchase' THEN 13 ELSE 9 END AS BIGINT) AS severity_number,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END AS severity_text,
               event_type || ' by user ' || user_id AS body,
               '{{"http.method":"' || {_method('event_id')} || '","k":' || json_extract_string(props, '$.k')
                 || CASE WHEN event_id % 4 <> 0 THEN ',"tenant":"t' || (user_id % 6) || '"' ELSE '' END
                 || '}}' AS attributes,
               CASE WHEN event_id % 4 <> 1 THEN {_hex('event_id', 32)} END AS trace_id,
               CASE WHEN event_id % 4 <> 1 THEN {_hex('event_id * 16', 16)} END AS span_id,
               event_id AS record_id
        FROM events""",
    "spans": f"""
        SELECT {_hex('o_orderkey', 32)} AS trace_id, {_hex('o_orderkey * 16', 16)} AS span_id,
               CAST(NULL AS VARCHAR) AS parent_span_id, 'order ' || o_orderpriority AS name, 'SERVER' AS kind,
               CAST(epoch_ns(o_orderdate) AS BIGINT) AS start_time,
               CAST(floor(o_totalprice * 100) AS BIGINT) * 1000 AS duration_ns,
               CASE o_orderstatus WHEN 'F' THEN 'ERROR' WHEN 'O' THEN 'OK' ELSE 'UNSET' END AS status_code,
               CAST(NULL AS VARCHAR) AS status_message,
               'svc-' || (o_custkey % 5) AS service,
               '{{"http.method":"' || {_method('o_orderkey')} || '","priority":"' || o_orderpriority || '"}}' AS attributes
        FROM orders
        UNION ALL
        SELECT {_hex('l_orderkey', 32)}, {_hex('l_orderkey * 16 + l_linenumber', 16)},
               {_hex('l_orderkey * 16 + l_linenumber // 2', 16)}, 'line ' || l_linestatus, 'INTERNAL',
               CAST(epoch_ns(l_shipdate) AS BIGINT), CAST(floor(l_quantity) AS BIGINT) * 1000000,
               CASE l_returnflag WHEN 'R' THEN 'ERROR' ELSE 'OK' END, NULL,
               'svc-' || (l_suppkey % 5), '{{"qty":' || CAST(floor(l_quantity) AS BIGINT) || '}}'
        FROM lineitem""",
    "metrics_gauge": f"""
        SELECT CAST(epoch_ns(ts) AS BIGINT) AS point_time, 'events.' || event_type || '.value' AS metric, '1' AS unit,
               'svc-' || (user_id % 5) AS service, {_HOST} AS attributes,
               CAST(NULL AS VARCHAR) AS temporality, CAST(NULL AS BOOLEAN) AS is_monotonic,
               value + extra AS value, event_id, extra, event_type
        FROM events, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) x(extra)
        WHERE extra = 0 OR event_id % 50 = 0""",
    "metrics_sum": f"""
        SELECT CAST(epoch_ns(ts) AS BIGINT) AS point_time, 'events.total' AS metric, '1' AS unit,
               'svc-' || (user_id % 5) AS service, {_HOST} AS attributes,
               'cumulative' AS temporality, true AS is_monotonic,
               CAST(sum(floor(value)) OVER (PARTITION BY user_id % 5, user_id % 7, CAST(ts AS DATE)
                    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
        FROM events""",
    "metrics_histogram": f"""
        SELECT {_YEAR_NS} AS point_time, 'line.qty.' || l_linestatus AS metric, '{{item}}' AS unit,
               'svc-' || (l_suppkey % 5) AS service, '{{}}' AS attributes, 'delta' AS temporality,
               CAST(NULL AS BOOLEAN) AS is_monotonic, count(*) AS count, sum(l_quantity) AS sum,
               [10.0::DOUBLE, 20, 30, 40] AS explicit_bounds,
               [count(*) FILTER ({_QTY} <= 10), count(*) FILTER ({_QTY} > 10 AND {_QTY} <= 20),
                count(*) FILTER ({_QTY} > 20 AND {_QTY} <= 30), count(*) FILTER ({_QTY} > 30 AND {_QTY} <= 40),
                count(*) FILTER ({_QTY} > 40)] AS bucket_counts
        FROM lineitem GROUP BY ALL""",
    "metrics_exp_histogram": f"""
        SELECT {_YEAR_NS} AS point_time, 'line.qty.exp.' || l_linestatus AS metric, '{{item}}' AS unit,
               'svc-' || (l_suppkey % 5) AS service, '{{}}' AS attributes, 'delta' AS temporality,
               count(*) AS count, sum(l_quantity) AS sum,
               [count(*) FILTER ({_QTY} > 0.5 AND {_QTY} <= 1), count(*) FILTER ({_QTY} > 1 AND {_QTY} <= 2),
                count(*) FILTER ({_QTY} > 2 AND {_QTY} <= 4), count(*) FILTER ({_QTY} > 4 AND {_QTY} <= 8),
                count(*) FILTER ({_QTY} > 8 AND {_QTY} <= 16), count(*) FILTER ({_QTY} > 16 AND {_QTY} <= 32),
                count(*) FILTER ({_QTY} > 32 AND {_QTY} <= 64)] AS positive_counts
        FROM lineitem GROUP BY ALL""",
    "metrics_summary": f"""
        SELECT {_YEAR_NS} AS point_time, 'line.price.' || l_linestatus AS metric, 'USD' AS unit,
               'svc-' || (l_suppkey % 5) AS service, '{{}}' AS attributes, CAST(NULL AS VARCHAR) AS temporality,
               count(*) AS count, sum(l_extendedprice) AS sum,
               min(l_extendedprice) AS q0, max(l_extendedprice) AS q1
        FROM lineitem GROUP BY ALL""",
    "exemplars": f"""
        SELECT metric, point_time AS time, value, {_hex('event_id', 32)} AS trace_id,
               {_hex('event_id * 16', 16)} AS span_id, '{{"sampler":"always_on"}}' AS attributes, service
        FROM metrics_gauge WHERE event_type = 'error' AND extra = 0""",
    # One point per series and instant, the largest value surviving.
    "gauge_clean": """
        SELECT metric, service, attributes, point_time, max(value) AS value
        FROM metrics_gauge GROUP BY ALL""",
    # Spans without repeats, and the parent each one hangs below.
    "nodes": """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY trace_id, span_id
                      ORDER BY start_time, duration_ns, name, service, status_code) AS copy FROM spans)
        WHERE copy = 1""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it uses, each after the ones it builds on."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(body)
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in ordered)
    recursive = "RECURSIVE " if sql.lstrip().upper().startswith("WITH RECURSIVE") else ""
    body = re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", "", sql, flags=re.I)
    joiner = ",\n" if body != sql else "\n"
    return f"WITH {recursive}{ctes}{joiner}{body}"
