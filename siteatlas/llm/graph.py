"""Connected components of a graph of ids, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.session import persist_reliably

TASK_EDGES = 1 << 15  # a round takes no more tasks than one for so many edges, however many partitions a session deals


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id that edges link with a smaller one, and the smallest that it is linked with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new, least = label.copy(), np.minimum(label[x], label[y])
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stars`` of a task's edges."""
    edges = list(batches)
    if edges:
        a, b = (np.concatenate([e.column(i).to_numpy() for e in edges]) for i in range(2))
        yield pa.record_batch(list(stars(a, b)), names=["a", "b"])


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Hang the neighbours of every vertex on its smallest neighbour; ``large``: only the larger ones."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # edges point from the larger to the smaller end (a > b)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(tasks)
    # dealt anew, or the join would take over how the aggregate was dealt, and Spark could not split the vertex with most neighbours
    joined = both.join(least.hint("rebalance"), "a").coalesce(tasks)
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter("a > b").distinct().coalesce(tasks)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): for every id of ``edges`` (a, b: long) the smallest id that it is linked with.

    Ids without an edge to another one are not returned. Each round is a large and a small star; the number
    of rounds grows with the logarithm of the size of a component, and no vertex' neighbours are ever
    gathered: a star is an aggregate and a join, which Spark splits where they are skewed. Rounds are kept
    by ``checkpoint()`` in the shared folder; their tasks follow the number of edges left, up to the session's partitions. Where
    fewer are left than one task takes (``TASK_EDGES``), a round is that task alone and shuffles nothing.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = persist_reliably(now)
    last = None
    for _ in range(max_rounds):
        count = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == last or count[0] == 0:
            break
        last, tasks = count, count[0] // TASK_EDGES + 1
        now = now.coalesce(tasks)
        now = persist_reliably(now.mapInArrow(_finished, "a long, b long") if tasks == 1 else _star(_star(now, True, tasks), False, tasks))
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return roots.union(now.select("b").distinct().select(F.col("b").alias("id"), F.col("b").alias("component")))
