"""Registered metric, duplicate and discovery queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from teletide.functions.histogram import histogram_quantile
from teletide.model import NS_PER_DAY, NS_PER_HOUR
from teletide.operators import discovery, duplicates, metrics as M
from teletide.operators.metrics import MetricQuery, PointsQuery
from teletide.plans.registry import joined, on, query
from teletide.sources import warehouse

CLICKS = "events.click.value"
LAST_WINS = duplicates.LAST_WINS


# --- Points, ranges, instants ----------------------------------------------------------------------

query("metric_points", f"""
    SELECT point_time, metric, service, attributes, temporality, is_monotonic, value FROM metrics_gauge
    WHERE metric = '{CLICKS}' AND json_extract_string(attributes, '$.host') = 'h3'
      AND json_extract_string(attributes, '$.rack') = '0' AND service LIKE 'svc-%'""")(
    on("metrics_gauge", lambda df: M.metric_points(
        df, PointsQuery(CLICKS, filters={"host": "h3", "rack": "0"}))))
query("sum_points", """
    SELECT point_time, metric, service, attributes, temporality, is_monotonic, value FROM metrics_sum
    WHERE metric = 'events.total'""")(
    on("metrics_sum", lambda df: M.metric_points(df, PointsQuery("events.total", kind="sum"))))
query("histogram_points", """
    SELECT point_time, metric, service, attributes, temporality, is_monotonic,
           array_to_string(explicit_bounds, ',') AS explicit_bounds,
           array_to_string(bucket_counts, ',') AS bucket_counts
    FROM metrics_histogram WHERE metric = 'line.qty.O'""")(
    on("metrics_histogram", lambda df: M.metric_points(
        df, PointsQuery("line.qty.O", kind="histogram")).select(
        "point_time", "metric", "service", "attributes", "temporality", "is_monotonic",
        joined("explicit_bounds"), joined("bucket_counts"))))


def _rounded(df: DataFrame, column: str = "v") -> DataFrame:
    return df.withColumn(column, F.round(column, 9))


query("gauge_range", f"""
    SELECT point_time - point_time % {NS_PER_HOUR} AS bucket, round(avg(value), 9) AS v
    FROM gauge_clean WHERE metric = '{CLICKS}' GROUP BY ALL""")(
    on("metrics_gauge", lambda df: _rounded(M.metric_range(df, MetricQuery(CLICKS, NS_PER_HOUR, duplicates=LAST_WINS)))))
query("gauge_range_by", f"""
    SELECT point_time - point_time % {NS_PER_DAY} AS bucket,
           json_extract_string(attributes, '$.host') AS g0, service AS g1, round(avg(value), 9) AS v
    FROM gauge_clean WHERE metric = '{CLICKS}' GROUP BY ALL""")(
    on("metrics_gauge", lambda df: _rounded(M.metric_range(
        df, MetricQuery(CLICKS, NS_PER_DAY, group_by=["host", "service.name"], duplicates=LAST_WINS)))))
query("gauge_range_all_points", f"""
    SELECT point_time - point_time % {NS_PER_HOUR} AS bucket, round(avg(value), 9) AS v
    FROM metrics_gauge WHERE metric = '{CLICKS}' GROUP BY ALL""")(
    on("metrics_gauge", lambda df: _rounded(M.metric_range(
        df, MetricQuery(CLICKS, NS_PER_HOUR)))))
query("sum_range", f"""
    SELECT point_time - point_time % {NS_PER_DAY} AS bucket, service AS g0, round(sum(value), 9) AS v
    FROM metrics_sum WHERE metric = 'events.total' GROUP BY ALL""")(
    on("metrics_sum", lambda df: _rounded(M.metric_range(
        df, MetricQuery("events.total", NS_PER_DAY, sum=True, group_by=["service"])))))
query("metric_instant", f"""
    WITH b AS (SELECT json_extract_string(attributes, '$.host') AS host, service,
                      point_time - point_time % {NS_PER_HOUR} AS bucket, avg(value) AS v
               FROM gauge_clean WHERE metric = '{CLICKS}' GROUP BY ALL)
    SELECT '{{"host":"' || host || '","service":"' || service || '"}}' AS labels,
           max(bucket) AS timestamp, round(arg_max(v, bucket), 9) AS value
    FROM b GROUP BY host, service""")(
    on("metrics_gauge", lambda df: _rounded(M.metric_instant(
        df, MetricQuery(CLICKS, NS_PER_HOUR, group_by=["service", "host"], duplicates=LAST_WINS)), "value")))


# --- Histograms ------------------------------------------------------------------------------------

def _quantile_sql(q: float, source: str, keys: str) -> str:
    """Interpolated quantile over rows of (keys, i, n, le), i being the bucket's number."""
    return f"""
    run AS (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY i) AS upto,
                   sum(n) OVER (PARTITION BY {keys}) AS total FROM {source}),
    hit AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY i) AS nth FROM run
            WHERE upto >= {q} * total AND upto > 0)
    SELECT {keys}, round(CASE WHEN i = 5 THEN 40 ELSE le - 10 + 10 * ({q} * total - (upto - n)) / n END, 9) AS q
    FROM hit WHERE nth = 1"""


query("fn_histogram_quantile", f"""
    WITH b AS (SELECT metric, service, point_time, unnest(bucket_counts) AS n,
                      unnest([10, 20, 30, 40, NULL]) AS le, unnest([1, 2, 3, 4, 5]) AS i FROM metrics_histogram),
    {_quantile_sql(0.95, 'b', 'metric, service, point_time')}""")(
    on("metrics_histogram", lambda df: df.select("metric", "service", "point_time", F.round(
        histogram_quantile(0.95, F.col("explicit_bounds"), F.col("bucket_counts")), 9).alias("q"))))


@query("histogram_quantile_by", f"""
    WITH u AS (SELECT service AS g0, unnest(bucket_counts) AS n, unnest([10, 20, 30, 40, NULL]) AS le,
                      unnest([1, 2, 3, 4, 5]) AS i FROM metrics_histogram),
    b AS (SELECT g0, i, le, sum(n) AS n FROM u GROUP BY ALL),
    {_quantile_sql(0.5, 'b', 'g0')}""")
def histogram_quantile_by(spark, root) -> DataFrame:
    merged = M.histogram_merge(warehouse.metrics_histogram(spark, root), ["service"])
    return merged.select("g0", F.round(
        histogram_quantile(0.5, F.col("bounds"), F.col("counts")), 9).alias("q"))


# The yearly counts as running totals that start over in 1996; the first year of each of the two only serves the next.
_RESTART = 820_454_400_000_000_000
_BUCKETS = """
    u AS (SELECT metric, service, point_time AS t, unnest(bucket_counts) AS n, unnest([10, 20, 30, 40, NULL]) AS le,
                 unnest([1, 2, 3, 4, 5]) AS i FROM metrics_histogram)"""
_RUNNING = f"""
    c AS (SELECT *, sum(n) OVER (PARTITION BY metric, service, i, t >= {_RESTART} ORDER BY t) AS upto FROM u),
    p AS (SELECT *, lag(upto) OVER (PARTITION BY metric, service, i ORDER BY t) AS before FROM c),
    r AS (SELECT metric, service, t, bool_or(upto < before) AS restarted FROM p GROUP BY ALL),
    gains AS (SELECT service AS g0, i, le, CAST(sum(CASE WHEN restarted THEN upto ELSE upto - before END) AS DOUBLE) AS n
              FROM p JOIN r USING (metric, service, t) WHERE before IS NOT NULL GROUP BY ALL)"""


def _cumulative(points: DataFrame) -> DataFrame:
    series = Window.partitionBy("metric", "service", F.col("point_time") >= _RESTART).orderBy("point_time")
    upto = F.array(*[F.sum(F.get("bucket_counts", i)).over(series) for i in range(5)])
    return points.withColumns({"bucket_counts": upto, "temporality": F.lit("cumulative")})


def _median(merged: DataFrame) -> DataFrame:
    return merged.select("g0", F.round(histogram_quantile(0.5, F.col("bounds"), F.col("counts")), 9).alias("q"))


query("histogram_quantile_cumulative", f"WITH {_BUCKETS}, {_RUNNING}, {_quantile_sql(0.5, 'gains', 'g0')}")(
    on("metrics_histogram", lambda df: _median(M.histogram_merge(_cumulative(df), ["service"]))))
query("histogram_increase", f"WITH {_BUCKETS}, {_RUNNING} SELECT g0, CAST(i AS BIGINT) AS bucket, CAST(n AS BIGINT) AS n FROM gains")(
    on("metrics_histogram", lambda df: M.histogram_increase(_cumulative(df)).select(
        F.col("service").alias("g0"), F.posexplode("bucket_counts").alias("i", "n")).groupBy(
        "g0", (F.col("i") + 1).cast("bigint").alias("bucket")).agg(F.sum("n").alias("n"))))


def _coarser(points: DataFrame) -> DataFrame:
    """The open lines of each service with bounds 20 and 40 only."""
    n = lambda i: F.get("bucket_counts", i)
    open_ = F.col("metric") == "line.qty.O"
    return points.withColumns({
        "explicit_bounds": F.when(open_, F.array(F.lit(20.0), F.lit(40.0))).otherwise(F.col("explicit_bounds")),
        "bucket_counts": F.when(open_, F.array(n(0) + n(1), n(2) + n(3), n(4))).otherwise(F.col("bucket_counts"))})


query("histogram_quantile_mixed", f"""
    WITH {_BUCKETS},
    halves AS (SELECT service AS g0, i, le, metric, n, sum(n) OVER (PARTITION BY metric, service, t, least((i + 1) // 2, 3)) / 2 AS half FROM u),
    b AS (SELECT g0, i, le, CAST(sum(CASE WHEN metric = 'line.qty.O' AND i < 5 THEN half ELSE n END) AS DOUBLE) AS n FROM halves GROUP BY ALL),
    {_quantile_sql(0.5, 'b', 'g0')}""")(
    on("metrics_histogram", lambda df: _median(M.histogram_merge(_coarser(df), ["service"]))))


# --- Duplicates ------------------------------------------------------------------------------------

query("duplicate_points", """
    SELECT metric, service, attributes, point_time, count(*) AS copies FROM metrics_gauge
    GROUP BY ALL HAVING count(*) > 1""")(on("metrics_gauge", duplicates.duplicate_points))
query("last_wins", """
    SELECT metric, service, attributes, point_time, value FROM gauge_clean""")(
    on("metrics_gauge", duplicates.last_wins))


query("last_wins_by_series", """
    SELECT metric, service, json_extract_string(attributes, '$.host') AS host, point_time, max(value) AS value
    FROM metrics_gauge GROUP BY ALL""")(
    # A number that differs from point to point is no part of the series.
    on("metrics_gauge", lambda df: duplicates.last_wins_by_series(df.withColumn("attributes", F.regexp_replace(
        "attributes", F.lit("[}]$"), F.concat(F.lit(',"n":'), F.col("value").cast("string"), F.lit("}"))))).select(
        "metric", "service", F.get_json_object("attributes", "$.host").alias("host"), "point_time", "value")))


def _offered(spark, root) -> tuple[DataFrame, DataFrame]:
    """The first half of the clicks as stored points, all gauge points as the batch."""
    gauge = warehouse.metrics_gauge(spark, root)
    stored = gauge.where((F.col("metric") == CLICKS) & (F.col("service") < "svc-2"))
    return gauge, stored


_FIRST = f"""
    SELECT metric, service, attributes, point_time, min(value) AS value, count(*) AS copies,
           (metric = '{CLICKS}' AND service < 'svc-2') AS stored
    FROM metrics_gauge GROUP BY ALL"""


@query("reject_duplicates", f"""
    WITH f AS ({_FIRST}) SELECT metric, service, attributes, point_time, value FROM f WHERE NOT stored""")
def reject_duplicates(spark, root) -> DataFrame:
    gauge, stored = _offered(spark, root)
    kept = duplicates.accepted(duplicates.reject_duplicates(gauge, ["value"], stored))
    return kept.select("metric", "service", "attributes", "point_time", "value")


@query("ingest_receipt", f"""
    WITH f AS ({_FIRST})
    SELECT count(*) FILTER (NOT stored) AS accepted,
           CAST(sum(copies) AS BIGINT) - count(*) FILTER (NOT stored) AS rejected FROM f""")
def ingest_receipt(spark, root) -> DataFrame:
    gauge, stored = _offered(spark, root)
    return duplicates.receipt(duplicates.reject_duplicates(gauge, ["value"], stored))


# --- Discovery -------------------------------------------------------------------------------------

_TABLES = ["logs", "spans", "metrics_gauge", "metrics_sum", "metrics_histogram",
           "metrics_exp_histogram", "metrics_summary"]
_ALL_ATTRS = " UNION ALL ".join(f"SELECT attributes, service FROM {t}" for t in _TABLES)


query("attr_names", f"""
    WITH a AS ({_ALL_ATTRS})
    SELECT DISTINCT unnest(json_keys(attributes)) AS name FROM a
    UNION SELECT 'service.name' FROM a WHERE service IS NOT NULL""")(
    lambda spark, root: discovery.attr_names(warehouse.all_tables(spark, root)))
query("attr_values", f"""
    WITH a AS ({_ALL_ATTRS})
    SELECT DISTINCT json_extract_string(attributes, '$."http.method"') AS value FROM a
    WHERE json_extract_string(attributes, '$."http.method"') IS NOT NULL""")(
    lambda spark, root: discovery.attr_values(warehouse.all_tables(spark, root), "http.method"))
query("attr_values_service", f"WITH a AS ({_ALL_ATTRS}) SELECT DISTINCT service AS value FROM a")(
    lambda spark, root: discovery.attr_values(warehouse.all_tables(spark, root), "service.name"))
query("metric_catalog", " UNION ".join(
    f"SELECT metric, unit, temporality, '{t.removeprefix('metrics_')}' AS kind FROM {t}"
    for t in _TABLES[2:]))(
    lambda spark, root: discovery.metric_catalog(warehouse.all_tables(spark, root)))
query("metric_series", f"""
    SELECT DISTINCT attributes AS labels FROM metrics_gauge WHERE metric = '{CLICKS}'""")(
    on("metrics_gauge", lambda df: discovery.metric_series(df, CLICKS)))
query("metric_exemplars", """
    SELECT metric, time, value, trace_id, span_id, attributes FROM exemplars
    WHERE metric = 'events.error.value'""")(
    on("metrics_gauge", lambda df: discovery.metric_exemplars(df, "events.error.value")))
