"""One object over a set of telemetry tables with a method per question."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from teletide.functions.register import register_functions
from teletide.model import METRIC_TABLES, SCHEMAS, time_column
from teletide.operators import discovery, duplicates, logs, maintenance, metrics, rangeeval, traces
from teletide.session import configure
from teletide.sources import otlp, tables, traceindex

@dataclass
class Telemetry:
    """Telemetry tables by name. Tables left out are empty.

    ``duplicates`` says what reads of metric series do about repeated points (``error_on_read`` or
    ``last_wins``). ``trace_index`` is that of the stored spans; lookups of traces then read only their days.
    """

    spark: SparkSession
    tables: dict[str, DataFrame]
    duplicates: str = duplicates.ERROR_ON_READ
    trace_index: DataFrame | None = None

    def __post_init__(self) -> None:
        configure(self.spark)
        for name in self.tables:
            time_column(name)  # rejects unknown names
        self.tables = {
            name: self.tables[name] if name in self.tables else self.spark.createDataFrame([], schema)
            for name, schema in SCHEMAS.items()}

    @classmethod
    def open(cls, spark: SparkSession, path: str, names: list[str], promoted: list[str] | None = None,
             **options) -> Telemetry:
        """The table folders ``path/<name>``."""
        found = {n: tables.read_table(spark, n, f"{path}/{n}", promoted) for n in names}
        if "spans" in names:  # after the spans: what they hold has its entry by then
            options.setdefault("trace_index", traceindex.read(spark, f"{path}/spans"))
        return cls(spark, found, **options)

    @classmethod
    def from_otlp(cls, spark: SparkSession, **inboxes: str) -> Telemetry:
        """Straight from OTLP/JSON files: folders for ``logs``, ``traces`` and ``metrics``."""
        found = {}
        for signal, inbox in inboxes.items():
            requests = otlp.read_requests(spark, signal, inbox)
            if signal == "logs":
                found["logs"] = otlp.logs(requests)
            elif signal == "traces":
                found["spans"] = otlp.spans(requests)
            else:
                found |= {name: otlp.metrics(requests, name) for name in METRIC_TABLES}
        return cls(spark, found)

    def table(self, name: str) -> DataFrame:
        time_column(name)
        return self.tables[name]

    def sql(self, text: str) -> DataFrame:
        """Any SQL over the tables, with the telemetry functions at hand."""
        register_functions(self.spark)
        tables.register_tables(self.spark, self.tables)
        return self.spark.sql(text)

    # Logs

    def query_logs(self, q: logs.LogQuery) -> DataFrame:
        return logs.query_logs(self.tables["logs"], q)

    def count_logs(self, q: logs.LogQuery) -> DataFrame:
        return logs.count_logs(self.tables["logs"], q)

    def log_page(self, q: logs.LogQuery, after: int = 0) -> logs.LogPage:
        return logs.log_page(self.tables["logs"], q, after)

    def log_volume(self, q: logs.LogQuery, step: int, group_by: list[str] | None = None) -> DataFrame:
        return logs.log_volume(self.tables["logs"], q, step, group_by)

    def log_lines(self, **options) -> DataFrame:
        return rangeeval.log_lines(self.tables["logs"], **options)

    def log_count_over_time(self, window: int, grid: rangeeval.Grid, **options) -> DataFrame:
        return rangeeval.count_over_time(self.tables["logs"], window, grid, **options)

    def log_rate(self, window: int, grid: rangeeval.Grid, **options) -> DataFrame:
        return rangeeval.log_rate(self.tables["logs"], window, grid, **options)

    # Metrics

    def _scalars(self) -> DataFrame:
        """Gauge and sum points, the scalar kinds a step-grid read may ask for by name."""
        columns = ["point_time", "metric", "service", "attributes", "value"]
        parts = [self.tables[n] for n in ("metrics_gauge", "metrics_sum")]
        if all("series" in p.columns for p in parts):
            columns.append("series")
        return parts[0].select(*columns).unionByName(parts[1].select(*columns))

    def _kind(self, kind: str) -> DataFrame:
        if f"metrics_{kind}" not in METRIC_TABLES:
            raise ValueError(f"unknown metric kind {kind!r}")
        return self.tables[f"metrics_{kind}"]

    def metric_points(self, q: metrics.PointsQuery) -> DataFrame:
        return metrics.metric_points(self._kind(q.kind), q)

    def _with_policy(self, q: metrics.MetricQuery) -> metrics.MetricQuery:
        """The store's policy where it resolves repeats on reading; others leave the query as it is."""
        last = self.duplicates == duplicates.LAST_WINS
        return replace(q, duplicates=duplicates.LAST_WINS) if last else q

    def metric_range(self, q: metrics.MetricQuery) -> DataFrame:
        return metrics.metric_range(self._kind("sum" if q.sum else "gauge"), self._with_policy(q))

    def metric_instant(self, q: metrics.MetricQuery) -> DataFrame:
        return metrics.metric_instant(self._kind("sum" if q.sum else "gauge"), self._with_policy(q))

    def instant_selector(self, metric: str, grid: rangeeval.Grid) -> DataFrame:
        return rangeeval.instant_selector(self._scalars(), metric, grid, policy=self.duplicates)

    def rate(self, metric: str, window: int, grid: rangeeval.Grid) -> DataFrame:
        return rangeeval.rate(self.tables["metrics_sum"], metric, window, grid, self.duplicates)

    def increase(self, metric: str, window: int, grid: rangeeval.Grid) -> DataFrame:
        return rangeeval.increase(self.tables["metrics_sum"], metric, window, grid, self.duplicates)

    # Traces

    def get_trace(self, trace_id: str) -> DataFrame:
        return traces.get_trace(self.tables["spans"], trace_id, self.trace_index)

    def trace_forest(self, trace_id: str | None = None) -> DataFrame:
        spans = self.get_trace(trace_id) if trace_id else self.tables["spans"]
        return traces.trace_forest(spans)

    def search_traces(self, q: traces.TraceQuery) -> DataFrame:
        return traces.search_traces(self.tables["spans"], q, self.trace_index)

    def spanset_match(self, q: traces.TraceQuery, start: int = 0, end: int = 0) -> DataFrame:
        return traces.spanset_lists(traces.spanset_match(self.tables["spans"], q, start, end, self.trace_index))

    def spans_and_index(self) -> tuple[DataFrame, DataFrame | None]:
        """What the functions of ``traces`` take to look traces up."""
        return self.tables["spans"], self.trace_index

    def spans_of(self, matches: DataFrame) -> DataFrame:
        return traces.spans_of(self.tables["spans"], matches, self.trace_index)

    def exemplar_spans(self, metric: str, kind: str = "gauge") -> DataFrame:
        """The exemplars of a metric with the spans they point to."""
        return traces.exemplar_spans(self.metric_exemplars(metric, kind), self.tables["spans"], self.trace_index)

    def span_metrics(self, q: traces.SpanMetricsQuery) -> DataFrame:
        return traces.span_metrics(self.tables["spans"], q)

    # Discovery and upkeep

    def attr_names(self) -> DataFrame:
        return discovery.attr_names(self.tables)

    def attr_values(self, key: str) -> DataFrame:
        return discovery.attr_values(self.tables, key)

    def metric_catalog(self) -> DataFrame:
        return discovery.metric_catalog(self.tables)

    def metric_series(self, metric: str, kind: str = "gauge") -> DataFrame:
        return discovery.metric_series(self._kind(kind), metric)

    def metric_exemplars(self, metric: str, kind: str = "gauge") -> DataFrame:
        return discovery.metric_exemplars(self._kind(kind), metric)

    def stats(self) -> DataFrame:
        return maintenance.table_stats(self.tables)

    def export(self, name: str, start: int = 0, end: int = 0) -> DataFrame:
        return tables.export_range(self.table(name), name, start, end)
