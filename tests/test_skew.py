"""One key holding a large share of the rows: results stay whole and work is split."""

import pytest
from pyspark.sql import functions as F

from teletide.operators import duplicates as D, logs as L, ranking, traces as T
from teletide.operators.logs import LogQuery
from teletide.operators.rangeeval import Grid, count_over_time, increase
from teletide.operators.traces import SpanMetricsQuery, TraceQuery

BASE = 1_700_000_000_000_000_000
SECOND = 1_000_000_000


def hot_logs(spark, n=300_000):
    """A third of the rows share one instant, the first service holds two thirds."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit(BASE)).otherwise(BASE + i * 1_000_000).alias("time"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(BASE + i * 1_000_000).alias("observed_time"),
        F.when(i % 3 != 1, "hot").otherwise(F.concat(F.lit("s"), (i % 7).cast("string"))).alias("service"),
        F.lit(9).alias("severity_number"), F.lit(None).cast("string").alias("severity_text"),
        F.lit("line").alias("body"), F.lit("{}").alias("attributes"),
        F.lit(None).cast("string").alias("trace_id"), F.lit(None).cast("string").alias("span_id"),
        i.alias("record_id"))


def test_positions_with_a_hot_instant(spark, monkeypatch):
    n = 300_000
    monkeypatch.setattr(ranking, "HOT_CELL", 50_000)
    df = L.positions(hot_logs(spark, n), LogQuery())
    got = df.agg(F.count("*"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first()
    assert tuple(got) == (n, n, 1, n)
    # Rows of the hot instant come first, in id order.
    wrong = df.where((F.col("time") == BASE) & (F.col("rn") != F.floor(F.col("record_id") / 3) + 1))
    assert wrong.count() == 0
    # The hot instant was sorted in several parts.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_f2" in plan


def test_positions_without_hot_cells_take_the_short_plan(spark):
    df = L.positions(hot_logs(spark, 3_000), LogQuery())
    assert "_f0" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_grid_reads_with_a_hot_series(spark):
    n = 200_000
    i = F.col("id")
    points = spark.range(n).select(
        (BASE + i * (SECOND // 10)).alias("point_time"), F.lit("c").alias("metric"),
        F.when(i % 3 != 1, "hot").otherwise("cold").alias("service"), F.lit("{}").alias("attributes"),
        i.cast("double").alias("value"))
    end = BASE + (n // 10) * SECOND
    rows = increase(points, "c", 600 * SECOND, Grid(BASE + 600 * SECOND, end, 300 * SECOND)).collect()
    assert len({r["labels"] for r in rows}) == 2
    inner = [r["value"] for r in rows if r["ts"] < end]
    assert all(abs(v - 6000) < 10 for v in inner)  # the counter grows by one every 100 ms
    counts = count_over_time(hot_logs(spark), 3600 * SECOND, Grid(BASE + 3600 * SECOND, BASE + 3600 * SECOND, SECOND))
    assert sum(r["value"] for r in counts.collect()) == 300_000 - 100_000  # the instant BASE lies on the edge


def test_one_instant_repeated_for_a_third_of_the_points(spark):
    n = 200_000
    i = F.col("id")
    points = spark.range(n).select(
        F.lit("m").alias("metric"), F.lit("s").alias("service"), F.lit("{}").alias("attributes"),
        F.when(i % 3 == 0, F.lit(BASE)).otherwise(BASE + i).alias("point_time"), i.cast("double").alias("value"))
    kept = D.last_wins(points)
    assert kept.count() == n - -(-n // 3) + 1
    assert kept.where(F.col("point_time") == BASE).first()["value"] == float((n - 1) // 3 * 3)
    receipt = D.receipt(D.reject_duplicates(points, ["value"])).first()
    assert receipt["accepted"] + receipt["rejected"] == n
    # The hot group is reduced before the shuffle.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max")


@pytest.mark.parametrize("hot_cell", [ranking.HOT_CELL, 10_000])
def test_hot_service_and_hot_trace(spark, hot_cell, monkeypatch):
    monkeypatch.setattr(ranking, "HOT_CELL", hot_cell)  # the hot trace whole, and in parts
    n = 150_000
    i = F.col("id")
    spans = spark.range(n).select(
        F.when(i % 3 == 0, F.lpad(F.lit("a"), 32, "0")).otherwise(F.lpad(F.hex(i), 32, "0")).alias("trace_id"),
        F.lower(F.lpad(F.hex(i), 16, "0")).alias("span_id"),
        F.when((i % 3 == 0) & (i > 0), F.lpad(F.lit("0"), 16, "0")).alias("parent_span_id"),
        F.lit("op").alias("name"), F.lit("SERVER").alias("kind"), (BASE + i * (SECOND // 50)).alias("start_time"),
        F.when(i % 2 == 0, 1_000_000).otherwise(i).cast("bigint").alias("duration_ns"),
        F.lit("OK").alias("status_code"), F.lit("hot").alias("service"), F.lit("{}").alias("attributes"))
    red = T.span_metrics(spans, SpanMetricsQuery(86_400 * SECOND, group_by=["service"])).collect()
    assert sum(r["calls"] for r in red) == n
    exact = spans.agg(F.percentile("duration_ns", [0.5, 0.95, 0.99])).first()[0]
    if len(red) == 1:
        assert [red[0][p] for p in ("p50", "p95", "p99")] == exact
    forest = T.trace_forest(spans).groupBy("depth").agg(F.count("*"), F.max("sibling_rank")).orderBy("depth").collect()
    assert [r[1] for r in forest] == [n - n // 3 + 1, n // 3 - 1]
    assert forest[1][2] == n // 3 - 1
    lists = T.spanset_lists(T.spanset_match(spans, TraceQuery(service="hot")))
    sizes = lists.select(F.size("span_ids").alias("n")).agg(F.sum("n"), F.max("n")).first()
    assert tuple(sizes) == (n, T.SPANS_PER_LIST)
