import random

import pytest
from pyspark.sql import functions as F

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators import sketches as K
from teletide.operators.traces import SpanMetricsQuery


def test_sketches_roll_up_to_what_the_spans_say(spark, spans, tmp_path):
    rng = random.Random(4)
    rows = [{"start_time": BASE + i * SECOND, "duration_ns": rng.randrange(10 ** 9), "trace_id": f"{i // 3:032x}",
             "service": None if i % 7 == 0 else "web", "status_code": "ERROR" if i % 5 == 0 else "OK"} for i in range(2400)]
    K.span_sketches(spans(rows), SpanMetricsQuery(MINUTE, group_by=["service"])).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert K.roll_up(stored, MINUTE, MINUTE).count() == stored.count()
    got = {(r["bucket"], r["g0"]): r for r in K.answers(K.roll_up(stored, MINUTE, 20 * MINUTE)).collect()}
    expected = {}
    for r in rows:
        expected.setdefault((r["start_time"] // (20 * MINUTE) * 20 * MINUTE, r["service"] or ""), []).append(r)
    assert set(got) == set(expected)
    for key, own in expected.items():
        r, ordered = got[key], sorted(x["duration_ns"] for x in own)
        assert (r["calls"], r["errors"]) == (len(own), sum(x["status_code"] == "ERROR" for x in own))
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            below, upto = (sum(d < r[name] for d in ordered), sum(d <= r[name] for d in ordered))
            assert below <= (p + K.RANK_ERROR) * len(own) + 1 and upto >= (p - K.RANK_ERROR) * len(own) - 1
        assert r["traces"] == pytest.approx(len({x["trace_id"] for x in own}), rel=K.COUNT_ERROR)


def test_sketches_of_nothing_and_of_missing_durations(spans):
    q = SpanMetricsQuery(MINUTE)
    assert K.span_sketches(spans([]), q).count() == 0
    (row,) = K.answers(K.span_sketches(spans([{"duration_ns": None, "trace_id": None}]), q)).collect()
    assert (row["calls"], row["p50"], row["traces"]) == (1, None, 0)
    for step, coarser in ((60, 90), (0, 60), (60, -60)):
        with pytest.raises(ValueError, match="multiple"):
            K.roll_up(spans([]), step, coarser)


def test_rolled_up_counts_keep_their_bound_in_an_unlucky_group(spark, spans):
    """The worst of 3,000 groups of 20,000 ids: sketches of 12 bits miss its number of traces by 5.9 %."""
    ids = spark.range(461 * 20_000, 462 * 20_000)
    rows = spans([{}]).drop("trace_id", "start_time").crossJoin(ids.select(
        F.lpad(F.lower(F.hex("id")), 32, "0").alias("trace_id"), (F.lit(BASE) + F.col("id") % 2 * MINUTE).alias("start_time")))
    rolled = K.roll_up(K.span_sketches(rows, SpanMetricsQuery(MINUTE)), MINUTE, 1000 * MINUTE)
    (told,) = K.answers(rolled).collect()
    assert told["calls"] == 20_000
    assert told["traces"] == pytest.approx(20_000, rel=K.COUNT_ERROR)
