import random

import pytest
from pyspark.sql import functions as F

from telemetry_rows import BASE, MINUTE, SECOND
from teletide.operators import rangeeval as R
from teletide.operators.rangeeval import Grid


def series(df):
    return {r["ts"]: r["value"] for r in df.collect()}


def test_window_is_open_below_and_closed_above(gauge, logs):
    grid = Grid(BASE, BASE + 20, 10)
    df = gauge([{"metric": "m", "value": 7.0, "point_time": BASE + 10}])
    assert series(R.instant_selector(df, "m", grid, lookback=10)) == {BASE + 10: 7.0}
    assert series(R.instant_selector(df, "m", grid, lookback=11)) == {BASE + 10: 7.0, BASE + 20: 7.0}
    lines = logs([{"service": "s", "body": "x", "time": BASE + 10}])
    assert series(R.count_over_time(lines, 10, grid)) == {BASE + 10: 1.0}
    assert series(R.count_over_time(lines, 11, grid)) == {BASE + 10: 1.0, BASE + 20: 1.0}


def test_grid_checks():
    with pytest.raises(ValueError):
        Grid(0, 10, 0)
    with pytest.raises(ValueError):
        Grid(10, 0, 1)
    assert Grid(0, 10, 3).last == 3


@pytest.mark.parametrize("step, window", [(10, 30), (7, 30), (30, 10), (12, 18), (5, 5), (1, 3)])
def test_grid_reads_agree_with_brute_force(gauge, logs, step, window):
    rng = random.Random(step * 100 + window)
    times = sorted(rng.sample(range(-60, 200), 50))
    values, level = [], 0.0
    for _ in times:
        level = 0.0 if rng.random() < 0.1 else level + rng.randint(0, 5)
        values.append(level)
    samples = list(zip(times, values))
    grid = Grid(BASE + 3, BASE + 150, step)
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + t} for t, v in samples])

    newest, raw, lines = {}, {}, {}
    for ts in range(grid.start, grid.end + 1, step):
        inside = [(BASE + t, v) for t, v in samples if ts - window < BASE + t <= ts]
        if inside:
            newest[ts] = inside[-1][1]
            lines[ts] = float(len(inside))
        if len(inside) >= 2:
            raw[ts] = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
    assert series(R.instant_selector(df, "c", grid, lookback=window)) == newest
    counted = R._counter_windows(df, "c", grid, window, "error_on_read").where("n >= 2")
    assert {r["ts"]: r["growth"] for r in counted.collect()} == raw
    text = logs([{"service": "s", "body": "x", "time": BASE + t, "record_id": t} for t, _ in samples])
    assert series(R.count_over_time(text, window, grid)) == lines


def test_rate_of_a_steady_counter(gauge):
    df = gauge([{"metric": "http_requests_total", "value": 100.0 + 2 * i, "point_time": BASE + i * 15 * SECOND}
                for i in range(40)])
    grid = Grid(BASE + 5 * MINUTE, BASE + 9 * MINUTE, MINUTE)
    rates = series(R.rate(df, "http_requests_total", 2 * MINUTE, grid))
    assert len(rates) == 5 and all(v == pytest.approx(2 / 15) for v in rates.values())
    grown = series(R.increase(df, "http_requests_total", 2 * MINUTE, grid))
    assert all(v == pytest.approx(16.0) for v in grown.values())


def test_extrapolation_stops_at_zero_and_at_wide_gaps(gauge):
    # Two samples 10 s apart in a window of a minute, far from both edges: half a gap on each side.
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + t * SECOND} for t, v in [(25, 100.0), (35, 110.0)]])
    grid = Grid(BASE + MINUTE, BASE + MINUTE, MINUTE)
    assert series(R.increase(df, "c", MINUTE, grid)) == {BASE + MINUTE: pytest.approx(20.0)}
    # The counter was zero 2 s before the first sample.
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + t * SECOND} for t, v in [(25, 2.0), (35, 12.0)]])
    assert series(R.increase(df, "c", MINUTE, grid)) == {BASE + MINUTE: pytest.approx(17.0)}


def test_metric_names_by_either_spelling(gauge):
    df = gauge([{"metric": "http.requests_total", "value": 1.0}])
    grid = Grid(BASE, BASE, SECOND)
    for name in ("http.requests_total", "http_requests_total"):
        rows = R.instant_selector(df, name, grid).collect()
        assert [(r["labels"], r["value"]) for r in rows] == [
            ('{"__name__":"http_requests_total","service":"web"}', 1.0)]
    assert R.instant_selector(df, "http.requests.total", grid).collect() == []
    long = "a_b_c_d_e_f_g_h_i_j"
    many = gauge([{"metric": long.replace("_", "."), "value": 1.0}])
    assert many.where(R.named(long)).count() == 1


def test_aggregate_by_label(gauge):
    df = gauge([{"metric": "m", "value": float(i), "service": s, "attributes": f'{{"host":"h{i}"}}', "point_time": BASE}
                for i, s in enumerate(["a", "a", "b"])])
    grid = R.instant_selector(df, "m", Grid(BASE, BASE, SECOND))
    by = lambda keys, how: {r["labels"]: r["value"] for r in R.aggregate_by(grid, keys, how).collect()}
    assert by(["service"], "sum") == {'{"service":"a"}': 1.0, '{"service":"b"}': 2.0}
    assert by([], "avg") == {"{}": 1.0}


def test_stored_series_column_is_used(gauge):
    df = gauge([{"metric": "m", "value": 1.0}]).withColumn("series", F.lit("precomputed"))
    assert R.instant_selector(df, "m", Grid(BASE, BASE, SECOND)).first()["labels"] == "precomputed"


def test_count_over_an_hour(logs):
    hour = 60 * MINUTE
    df = logs([{"service": "checkout", "body": b} for b in "abc"])
    counted = R.count_over_time(df, hour, Grid(BASE - hour, BASE + hour, hour), service="checkout")
    rows = counted.collect()
    assert sum(r["value"] for r in rows) == 3.0
    assert {r["labels"] for r in rows} == {'{"service":"checkout"}'}


def test_a_sample_that_is_no_number_spoils_only_its_windows(gauge):
    values = [1.0, 2.0, float("nan"), 4.0, 5.0, 6.0, float("inf"), 8.0, 9.0]
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + i * 10} for i, v in enumerate(values)])
    counted = R._counter_windows(df, "c", Grid(BASE + 10, BASE + 80, 10), 20, "error_on_read").orderBy("ts").collect()
    assert [r["growth"] if r["growth"] == r["growth"] else None for r in counted] == [
        1.0, None, None, 1.0, 1.0, None, None, 1.0]


def test_a_window_far_wider_than_the_step(gauge, logs):
    # 100,000 steps per window: each sample is placed by stretches, not step by step and window by window.
    df = gauge([{"metric": "c", "value": float(i), "point_time": BASE + i * 1000} for i in range(4)])
    grid = Grid(BASE, BASE + 20_000, 1)
    got = series(R.instant_selector(df, "c", grid, lookback=100_000))
    assert len(got) == 20_001 and got[BASE + 999] == 0.0 and got[BASE + 1000] == 1.0 and got[grid.end] == 3.0
    counts = series(R.count_over_time(logs([{"service": "s", "time": BASE + i * 1000} for i in range(4)]), 100_000, grid))
    assert len(counts) == 20_001 and counts[grid.end] == 4.0 and counts[BASE + 2500] == 3.0


def test_cells_are_cut_into_short_parts():
    grid = Grid(0, 10**18, 3600 * SECOND)
    assert grid.width(6 * 3600 * SECOND) == 3600 * SECOND and grid.width(5400 * SECOND) == 1800 * SECOND
    with pytest.raises(ValueError):
        grid.width(0)


@pytest.mark.parametrize("width, parts", [(10, 3), (7, 7), (10**9 + 7, 10), (5, 1)])
def test_parts_fill_their_cell_in_order(spark, width, parts):
    grid = Grid(100, 100 + 4 * width, width)
    at = [grid.start + c * width + d for c in (-1, 0, 2) for d in sorted({1, 2, width // 2, width - 1, width})]
    df = spark.createDataFrame([(t,) for t in at], "t long").select(
        grid.cell(F.col("t"), width).alias("whole"), grid.cell(F.col("t"), width, parts).alias("part"))
    found = [(r["whole"], r["part"]) for r in df.collect()]
    assert found == sorted(found)
    assert all((whole - 1) * parts < part <= whole * parts for whole, part in found)


@pytest.mark.parametrize("longest", [1, 4, 10**6])
def test_growth_whatever_the_parts_of_a_cell(gauge, monkeypatch, longest):
    monkeypatch.setattr(R, "COUNTER_CELL", longest)
    rng = random.Random(longest)
    samples = [(t, float(rng.randrange(100))) for t in sorted(rng.sample(range(-80, 300), 120))]
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + t} for t, v in samples])
    for step, window in ((11, 33), (20, 50), (13, 13)):
        grid = Grid(BASE, BASE + 250, step)
        expected = {}
        for ts in range(grid.start, grid.end + 1, step):
            inside = [v for t, v in samples if ts - window < BASE + t <= ts]
            if len(inside) >= 2:
                expected[ts] = (len(inside), sum(b - a if b >= a else b for a, b in zip(inside, inside[1:])))
        counted = R._counter_windows(df, "c", grid, window, "error_on_read").where("n >= 2")
        assert {r["ts"]: (r["n"], r["growth"]) for r in counted.collect()} == expected


def test_a_large_reading_leaves_later_windows_alone(gauge):
    values = [0.0, 1e18, *[10.0 * i for i in range(1, 40)]]
    df = gauge([{"metric": "c", "value": v, "point_time": BASE + i * MINUTE} for i, v in enumerate(values)])
    for grid in (Grid(BASE + 15 * MINUTE, BASE + 35 * MINUTE, MINUTE), Grid(BASE, BASE + 40 * MINUTE, 5 * MINUTE),
                 Grid(BASE + 20 * MINUTE, BASE + 20 * MINUTE, MINUTE)):
        grown = {t: v for t, v in series(R.increase(df, "c", 10 * MINUTE, grid)).items()
                 if BASE + 12 * MINUTE <= t <= BASE + 40 * MINUTE}
        assert grown and all(v == pytest.approx(100.0) for v in grown.values())
