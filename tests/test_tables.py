import datetime
import re

import pytest
from pyspark.sql import functions as F

from telemetry_rows import BASE, SECOND
from teletide.model import NS_PER_DAY
from teletide.operators import maintenance as Mt
from teletide.operators.logs import LogQuery, count_logs, filter_logs, query_logs
from teletide.sources import tables


def run(logs, spark, path, promote, at, names, attributes):
    df = logs([{"body": b, "time": at + i, "attributes": attributes, "record_id": at + i}
               for i, b in enumerate(names)])
    tables.write_table(df, "logs", path, promote_keys=promote)


@pytest.mark.parametrize("first, second, tenants", [
    (["region"], ["region", "tenant"], {"acme": 0, "globex": 2}),
    (["region", "tenant"], ["region"], {"acme": 2, "globex": 2}),
])
def test_compaction_across_a_change_of_promoted_keys(spark, logs, tmp_path, first, second, tenants):
    path = str(tmp_path / "logs")
    run(logs, spark, path, first, BASE, ["first-a", "first-b"], '{"region":"us","tenant":"acme"}')
    run(logs, spark, path, second, BASE + 1000, ["second-a", "second-b"], '{"region":"eu","tenant":"globex"}')

    def answers():
        df = tables.read_table(spark, "logs", path, promoted=second)
        counts = {v: count_logs(df, LogQuery(attr_eq={k: v})).first()[0]
                  for k, v in [("region", "us"), ("region", "eu"), ("tenant", "acme"), ("tenant", "globex")]}
        rows = {(r["body"], r["attributes"]) for r in query_logs(df, LogQuery()).collect()}
        return counts, rows

    before = answers()
    report = Mt.compact(spark, "logs", path)
    assert report["files_merged"] >= 2 and report["files_created"] == 1
    assert answers() == before
    assert before[0] == {"us": 2, "eu": 2, **tenants}
    assert {b for b, _ in before[1]} == {"first-a", "first-b", "second-a", "second-b"}
    assert all(('"us"' in a) == b.startswith("first") for b, a in before[1])
    assert Mt.compact(spark, "logs", path) == {"files_merged": 0, "files_created": 0}


def test_compaction_spreads_a_big_day_and_leaves_other_days_alone(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    for k in range(6):
        run(logs, spark, path, [], BASE + k * 10**6, [f"{k}-{i}" for i in range(100)], "{}")
    run(logs, spark, path, [], BASE + 3 * NS_PER_DAY, ["lonely"], "{}")
    untouched = {r["path"] for r in Mt.data_files(spark, path).where("day > '2023-11-15'").collect()}
    big = Mt.data_files(spark, path).where("day <= '2023-11-15'").agg(F.sum("bytes")).first()[0]
    report = Mt.compact(spark, "logs", path, target_bytes=big * 2 // 5)
    assert report["files_merged"] == 6 and 1 < report["files_created"] < 6
    files = Mt.data_files(spark, path)
    assert {r["path"] for r in files.where("day > '2023-11-15'").collect()} == untouched
    assert tables.read_table(spark, "logs", path).count() == 601


def test_promotion_skips_reserved_names(logs):
    df = tables.promote(logs([{"attributes": '{"a.b":"1","body":"x","service.name":"y"}'}]),
                        ["a.b", "body", "service", "service.name", "day"])
    assert set(df.columns) - set(logs([]).columns) == {"a.b"}
    assert filter_logs(df, LogQuery(attr_eq={"a.b": "1"})).count() == 1


def test_time_ranges_prune_day_partitions(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    tables.write_table(logs([{"time": BASE + d * NS_PER_DAY} for d in range(5)]), "logs", path, codec="none")
    df = tables.read_table(spark, "logs", path)
    found = filter_logs(df, LogQuery(start=BASE + NS_PER_DAY, end=BASE + 3 * NS_PER_DAY))
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert re.search(r"day#\d+ >= 2023-11-15", pruned) and re.search(r"day#\d+ <= 2023-11-17", pruned)


def test_promoted_predicates_reach_the_scan(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    tables.write_table(logs([{"attributes": '{"k":"a"}'}]), "logs", path, promote_keys=["k"])
    found = filter_logs(tables.read_table(spark, "logs", path), LogQuery(attr_eq={"k": "a"})).select("body")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,a)" in plan and "get_json_object" not in plan


def test_unknown_names_are_errors(spark, logs, tmp_path):
    for call in (lambda: tables.table(spark, "traces"), lambda: tables.register_tables(spark, {"x": logs([])}),
                 lambda: tables.read_table(spark, "metrics", "/nowhere"),
                 lambda: tables.write_table(logs([]), "logs", "/nowhere", codec="rar")):
        with pytest.raises(ValueError):
            call()


def test_registered_tables_answer_sql(spark, logs):
    tables.register_tables(spark, {"logs": logs([{"service": "a"}, {"service": "a"}, {"service": "b"}])})
    got = {tuple(r) for r in spark.sql("SELECT service, count(*) FROM logs GROUP BY service").collect()}
    assert got == {("a", 2), ("b", 1)}
    assert tables.table(spark, "logs").count() == 3


def test_retention_by_age_and_by_bytes(spark, logs, tmp_path):
    path = str(tmp_path / "logs")
    rows = [{"time": BASE + d * NS_PER_DAY, "body": "x" * 100} for d in range(6)]
    tables.write_table(logs(rows), "logs", path)
    now = BASE + 5 * NS_PER_DAY
    assert Mt.retain_days(logs(rows), "logs", 2, now).count() == 3
    report = Mt.enforce_retention(spark, path, now, days=3)
    assert report["days_dropped"] == 2 and report["bytes_freed"] > 0
    left = Mt.data_files(spark, path).collect()
    assert len(left) == 4
    newest_two = sum(sorted((r["bytes"] for r in left), reverse=True)[:2]) + 1
    days = Mt.days_to_drop_by_bytes(Mt.data_files(spark, path), newest_two).collect()
    assert len(days) in (2, 3)
    Mt.enforce_retention(spark, path, now, max_bytes=newest_two)
    kept = {r["day"] for r in Mt.data_files(spark, path).collect()}
    assert datetime.date(2023, 11, 19) in kept and datetime.date(2023, 11, 16) not in kept
    assert tables.read_table(spark, "logs", path).count() == len(kept)


def test_stats_segments_snapshot_and_export(spark, logs, gauge, tmp_path):
    path = str(tmp_path / "logs")
    rows = [{"time": BASE + d * NS_PER_DAY + s * SECOND} for d in range(3) for s in range(4)]
    tables.write_table(logs(rows), "logs", path)
    stored = tables.read_table(spark, "logs", path)
    segments = Mt.segments(stored, "logs").collect()
    assert sum(r["rows"] for r in segments) == 12 and all(r["min_time"] <= r["max_time"] for r in segments)
    stats = {r["table"]: tuple(r)[1:] for r in Mt.table_stats(
        {"logs": stored, "metrics_gauge": gauge([])}).collect()}
    assert stats["logs"] == (12, BASE, BASE + 2 * NS_PER_DAY + 3 * SECOND)
    assert stats["metrics_gauge"] == (0, None, None)
    target = str(tmp_path / "copy")
    info = Mt.snapshot(spark, path, target)
    assert info["segments"] >= 3
    assert tables.read_table(spark, "logs", target).exceptAll(stored).count() == 0
    out = tables.export_range(stored, "logs", BASE + SECOND, BASE + 3 * SECOND)
    assert [r["time"] for r in out.collect()] == [BASE + SECOND, BASE + 2 * SECOND]
    assert tables.export_range(stored, "logs").count() == 12
    tables.write_export(out, str(tmp_path / "out"), "json")
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_series_column_is_written_for_metrics(spark, gauge, tmp_path):
    path = str(tmp_path / "g")
    tables.write_table(gauge([{"metric": "a.b", "value": 1.0}]), "metrics_gauge", path, with_series=True)
    assert tables.read_table(spark, "metrics_gauge", path).first()["series"] == '{"__name__":"a_b","service":"web"}'


def test_compaction_settles_keeps_undated_rows_and_finishes_a_broken_run(spark, logs, tmp_path, monkeypatch):
    path = str(tmp_path / "logs")
    for k in range(3):
        tables.write_table(logs([{"body": f"{k}", "time": BASE}, {"body": f"late-{k}", "time": BASE + NS_PER_DAY},
                                 {"body": f"undated-{k}", "time": None}]), "logs", path)
    bodies = lambda: sorted(r["body"] for r in tables.read_table(spark, "logs", path).collect())
    before = bodies()
    with monkeypatch.context() as broken:
        broken.setattr(Mt, "_swap", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            Mt.compact(spark, "logs", path)
    assert bodies() == before
    tables.write_table(logs([{"body": "meanwhile", "time": BASE}]), "logs", path)
    Mt.compact(spark, "logs", path)
    assert bodies() == sorted([*before, "meanwhile"])
    assert Mt.compact(spark, "logs", path) == {"files_merged": 0, "files_created": 0}
    assert Mt.data_files(spark, path).count() == 3
    Mt.enforce_retention(spark, path, BASE + 40 * NS_PER_DAY, days=1, max_bytes=1)
    assert bodies() == ["undated-0", "undated-1", "undated-2"]


def test_compaction_gives_each_day_a_task_of_its_own(spark, logs, tmp_path, monkeypatch):
    path, dealt = str(tmp_path / "logs"), []
    rows = [{"time": BASE + day * NS_PER_DAY + i if day else None, "record_id": day * 10 + i} for day in range(12) for i in range(3)]
    for _ in range(2):
        tables.write_table(logs(rows), "logs", path)
    by_day = Mt._by_day

    def seen(df, days):
        dealt.append(by_day(df, days))
        assert dealt[0].columns == df.columns
        return dealt[0]
    monkeypatch.setattr(Mt, "_by_day", seen)
    monkeypatch.setattr(Mt, "_swap", lambda *_: 0)  # the files stay, so that the rows can be looked at
    Mt.compact(spark, "logs", path)
    tasks = dealt[0].groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("day").alias("days"), F.count("*").alias("rows"))
    assert sorted((r["days"], r["rows"]) for r in tasks.collect()) == [(0, 6)] + [(1, 6)] * 11


def test_a_stored_table_is_written_by_as_many_tasks_as_the_session_deals(spark, monkeypatch):
    from teletide.plans import traces
    given = []
    monkeypatch.setattr(tables, "_write_days", lambda df, name, path, codec, level, keys, series, files, mode: given.append(files))
    monkeypatch.setattr(tables, "publish_spans", lambda *_: None)
    monkeypatch.setattr(Mt, "compact", lambda *_: None)
    monkeypatch.setattr(traces.Telemetry, "open", lambda *_: None)
    traces._stored(spark, "/root/testdata/sf0.001")
    assert given == [None] * 3  # a fixed number of ranges would grow with the table
