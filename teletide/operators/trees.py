"""Placing the spans of whole traces inside the tasks they were dealt to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

PLACED = "root_span_id string, depth long, sibling_rank long, in_cycle boolean"


def _whole_traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by trace, cut where a trace ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("trace_id")
        last = ids[len(ids) - 1].as_py()
        cut = pc.index(ids, last).as_py()  # the last trace may go on in the next batch
        if cut or (held and held[-1].column("trace_id")[0].as_py() != last):
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _codes(values: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Strings as numbers in their order, and the strings."""
    words = pc.unique(values)
    words = words.take(pc.sort_indices(words))
    return pc.index_in(values, words).to_numpy(), words


def _tree(table: pa.Table) -> list[pa.Array]:
    """Root, depth, rank among siblings and cycle mark of the spans of some whole traces."""
    n = table.num_rows
    trace, _ = _codes(table["trace_id"])
    span, spans = _codes(table["span_id"])
    above = pc.fill_null(pc.index_in(table["parent_span_id"], spans), -1).to_numpy()
    key = trace.astype(np.int64) * len(spans) + span
    wanted = np.where(above >= 0, trace.astype(np.int64) * len(spans) + above, -1)
    order = np.argsort(key)
    at = np.minimum(np.searchsorted(key[order], wanted), n - 1)
    has_parent = key[order][at] == wanted
    up = np.where(has_parent, order[at], np.arange(n))  # a root points at itself
    parent = up
    depth = has_parent.astype(np.int64)
    for _ in range(n.bit_length() + 1):
        further = up[up]
        if (further == up).all():
            break
        depth += depth[up]
        up = further
    in_cycle = has_parent[up]  # all roots are reached by now
    siblings = np.where(has_parent, parent, -1)
    start = table["start_time"]
    dated = start.is_valid().to_numpy()
    by_start = pc.fill_null(start, 0).to_numpy()
    ranked = np.lexsort((span, by_start, dated, siblings, trace))
    same = (siblings[ranked[1:]] == siblings[ranked[:-1]]) & (trace[ranked[1:]] == trace[ranked[:-1]])
    first = np.maximum.accumulate(np.where(np.append([False], same), 0, np.arange(n)))
    rank = np.empty(n, np.int64)
    rank[ranked] = np.arange(n) - first + 1
    roots = spans.take(pa.array(span[up], mask=in_cycle))
    return [roots, pa.array(depth, mask=in_cycle), pa.array(rank), pa.array(in_cycle)]


def place(nodes: DataFrame) -> DataFrame:
    """Unique spans of traces that fit a task, with root_span_id, depth, sibling_rank and in_cycle.

    One shuffle by trace; a task holds an Arrow batch and its longest trace at a time.
    """
    names = [*nodes.columns, *[c.split()[0] for c in PLACED.split(", ")]]

    def run(batches):
        for table in _whole_traces(batches):
            for batch in pa.Table.from_arrays([*table.columns, *_tree(table)], names=names).to_batches():
                yield batch
    dealt = nodes.repartition("trace_id").sortWithinPartitions("trace_id")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields]
    return dealt.mapInArrow(run, ", ".join([*fields, PLACED]))
