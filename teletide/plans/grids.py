"""Registered step-grid queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from teletide.functions.attrs import series_key
from teletide.model import NS_PER_HOUR, NS_PER_MINUTE
from teletide.operators import discovery, duplicates, rangeeval as R
from teletide.operators.rangeeval import Grid
from teletide.plans.logs import EPOCH_2024
from teletide.plans.registry import numbered, on, query
from teletide.sources import warehouse

DAYS_30 = EPOCH_2024 + 30 * 24 * NS_PER_HOUR
HOURLY = Grid(EPOCH_2024, DAYS_30, NS_PER_HOUR)
# Not aligned with the hour, and with a range that is no multiple of the step.
ODD = Grid(EPOCH_2024 + 7 * NS_PER_MINUTE, DAYS_30, 4 * NS_PER_HOUR)


def _steps(grid: Grid) -> str:
    return f"SELECT unnest(generate_series({grid.start}, {grid.end}, {grid.step})) AS ts"


def _labels(metric: str) -> str:
    """Only string attributes identify a series, so the rack number is left out."""
    return (f"'{{\"__name__\":\"' || replace({metric}, '.', '_') || '\",\"host\":\"' || "
            "json_extract_string(attributes, '$.host') || '\",\"service\":\"' || service || '\"}'")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumn("value", F.round("value", digits))


query("prom_series_key", f"SELECT DISTINCT {_labels('metric')} AS labels FROM metrics_gauge")(
    on("metrics_gauge", lambda df: df.select(series_key(
        F.col("service"), F.col("metric"), F.col("attributes")).alias("labels")).distinct()))

query("prom_instant", f"""
    WITH s AS (SELECT {_labels('metric')} AS labels, point_time AS t, value FROM gauge_clean
               WHERE metric = 'events.click.value')
    SELECT labels, ts, round(arg_max(value, t), 6) AS value
    FROM s JOIN ({_steps(HOURLY)}) g ON t > ts - {R.LOOKBACK} AND t <= ts GROUP BY labels, ts""")(
    on("metrics_gauge", lambda df: _rounded(R.instant_selector(
        df, "events_click_value", HOURLY, policy=duplicates.LAST_WINS))))

query("prom_instant_long", f"""
    WITH s AS (SELECT {_labels('metric')} AS labels, point_time AS t, value FROM gauge_clean
               WHERE metric = 'events.error.value')
    SELECT labels, ts, round(arg_max(value, t), 6) AS value
    FROM s JOIN ({_steps(ODD)}) g ON t > ts - {6 * NS_PER_HOUR} AND t <= ts GROUP BY labels, ts""")(
    on("metrics_gauge", lambda df: _rounded(R.instant_selector(
        df, "events.error.value", ODD, lookback=6 * NS_PER_HOUR, policy=duplicates.LAST_WINS))))


# The distances by which a window's growth is carried on to its edges.
_EXTRAPOLATED = """
    e AS (SELECT *, CAST(t1 - t0 AS DOUBLE) AS len, CAST(t1 - t0 AS DOUBLE) / (n - 1) AS gap,
                 CAST(t0 - (ts - {window}) AS DOUBLE) AS a, CAST(ts - t1 AS DOUBLE) AS b FROM w),
    x AS (SELECT *, CASE WHEN a >= 1.1 * gap THEN gap / 2 ELSE a END AS a2,
                 CASE WHEN b >= 1.1 * gap THEN gap / 2 ELSE b END AS b2,
                 CASE WHEN grown > 0 THEN len * v0 / grown END AS z FROM e)"""


def _increase_sql(grid: Grid, window: int, divisor: str, digits: int = 6) -> str:
    """Every window computed on its own from the samples it holds."""
    return f"""
    WITH s AS (SELECT {_labels('metric')} AS labels, point_time AS t, value AS v FROM metrics_sum),
    d AS (SELECT *, lag(v) OVER (PARTITION BY labels ORDER BY t) AS p FROM s),
    w AS (SELECT labels, ts, count(*) AS n, min(t) AS t0, max(t) AS t1, arg_min(v, t) AS v0,
                 sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END)
                   - arg_min(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END, t) AS grown
          FROM d JOIN ({_steps(grid)}) g ON t > ts - {window} AND t <= ts GROUP BY labels, ts HAVING count(*) >= 2),
    {_EXTRAPOLATED.format(window=window)}
    SELECT labels, ts, round(grown * (len + least(a2, coalesce(z, a2)) + b2) / len / {divisor}, {digits}) AS value FROM x"""


query("prom_increase", _increase_sql(HOURLY, 6 * NS_PER_HOUR, "1"))(
    on("metrics_sum", lambda df: _rounded(R.increase(df, "events.total", 6 * NS_PER_HOUR, HOURLY))))
query("prom_rate", _increase_sql(HOURLY, 6 * NS_PER_HOUR, str(6 * 3600.0), 10))(
    on("metrics_sum", lambda df: _rounded(R.rate(df, "events_total", 6 * NS_PER_HOUR, HOURLY), 10)))
query("prom_rate_odd", _increase_sql(ODD, 10 * NS_PER_HOUR, str(10 * 3600.0), 10))(
    on("metrics_sum", lambda df: _rounded(R.rate(df, "events_total", 10 * NS_PER_HOUR, ODD), 10)))

# One reading of 1e18 in each fifty hours, so that many windows follow one closely. A rate above 1e9 is told in
# billions, to digits that doubles of that size have.
_SPIKE = f"point_time // {NS_PER_HOUR} % 50 = 7 AND point_time % 3 = 0"


@query("prom_rate_spike", f"""
    WITH s AS (SELECT {_labels('metric')} AS labels, point_time AS t,
                      CASE WHEN {_SPIKE} THEN 1e18::DOUBLE ELSE value END AS v FROM metrics_sum),
    d AS (SELECT labels, ts, t, v, lag(v) OVER (PARTITION BY labels, ts ORDER BY t) AS p
          FROM s JOIN ({_steps(ODD)}) g ON t > ts - {10 * NS_PER_HOUR} AND t <= ts),
    w AS (SELECT labels, ts, count(*) AS n, min(t) AS t0, max(t) AS t1, arg_min(v, t) AS v0,
                 sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END) AS grown
          FROM d GROUP BY labels, ts HAVING count(*) >= 2),
    {_EXTRAPOLATED.format(window=10 * NS_PER_HOUR)},
    r AS (SELECT labels, ts, grown * (len + least(a2, coalesce(z, a2)) + b2) / len / 36000.0 AS value FROM x)
    SELECT labels, ts, value > 1e9 AS spiked, CASE WHEN value > 1e9 THEN round(value / 1e9, 2) ELSE round(value, 9) END AS value FROM r""")
def prom_rate_spike(spark, root) -> DataFrame:
    points = warehouse.metrics_sum(spark, root)
    spike = F.expr(f"point_time div {NS_PER_HOUR} % 50 = 7 AND point_time % 3 = 0")
    told = R.rate(points.withColumn("value", F.when(spike, 1e18).otherwise(F.col("value"))), "events_total", 10 * NS_PER_HOUR, ODD)
    big = F.col("value") > 1e9
    return told.select("labels", "ts", big.alias("spiked"), F.when(big, F.round(F.col("value") / 1e9, 2)).otherwise(
        F.round("value", 9)).alias("value"))


query("prom_sum_by", f"""
    SELECT '{{"service":"' || json_extract_string(labels, '$.service') || '"}}' AS labels, ts,
           round(sum(value), 4) AS value
    FROM ({_increase_sql(HOURLY, 6 * NS_PER_HOUR, '1', 12)}) GROUP BY 1, 2""")(
    on("metrics_sum", lambda df: R.aggregate_by(
        R.increase(df, "events.total", 6 * NS_PER_HOUR, HOURLY), ["service"]).withColumn(
        "value", F.round("value", 4))))

query("prom_catalog", " UNION ".join(
    f"SELECT replace(metric, '.', '_') AS query_name, metric AS stored_name, '{kind}' AS kind FROM {t}"
    for t, kind in [("metrics_gauge", "gauge"), ("metrics_sum", "counter"),
                    ("metrics_histogram", "cumulative_histogram"), ("metrics_exp_histogram", "gauge"),
                    ("metrics_summary", "gauge")]))(
    lambda spark, root: R.resolve_names(
        discovery.metric_catalog(warehouse.all_tables(spark, root))))


# --- Log lines and counts over time ----------------------------------------------------------------

def _lines(df: DataFrame) -> DataFrame:
    lines = R.log_lines(df, service="svc-1", contains="error")
    return numbered(lines, F.col("time")).select("time", "service", "body", "rn")


query("log_lines", """
    SELECT time, service, body, row_number() OVER (ORDER BY time, record_id) AS rn FROM logs
    WHERE service = 'svc-1' AND contains(body, 'error') QUALIFY rn <= 1000""")(
    on("logs", _lines))


def _count_sql(grid: Grid, window: int, divisor: str) -> str:
    return f"""
    SELECT '{{"service":"' || service || '"}}' AS labels, ts, round(count(*) / {divisor}, 9) AS value
    FROM logs JOIN ({_steps(grid)}) g ON time > ts - {window} AND time <= ts
    WHERE contains(body, 'error') GROUP BY service, ts"""


query("log_count_over_time", _count_sql(HOURLY, 6 * NS_PER_HOUR, "1.0"))(
    on("logs", lambda df: R.count_over_time(df, 6 * NS_PER_HOUR, HOURLY, contains="error")))
query("log_rate", _count_sql(ODD, 10 * NS_PER_HOUR, str(10 * 3600.0)))(
    on("logs", lambda df: R.log_rate(df, 10 * NS_PER_HOUR, ODD, contains="error").withColumn(
        "value", F.round("value", 9))))
