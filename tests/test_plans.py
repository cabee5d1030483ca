"""How queries are carried out, where the way decides what a task holds."""

import re

from teletide.plans.catalog import QUERIES

ROOT = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_subqueries_do_not_deal_the_spans_by_service(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be told to every task
    try:
        assert "SortMergeJoin" not in plan_of(QUERIES["sql_subquery"](spark, ROOT))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_sketch_is_kept_for_every_trace(spark):
    plan = plan_of(QUERIES["sql_approx_distinct_within"](spark, ROOT))
    sketched = re.findall(r"Aggregate\(keys=\[([^\]]*)\], functions=\[[^\n]*approx_count_distinct", plan)
    assert sketched and not any("trace_id" in keys for keys in sketched)
