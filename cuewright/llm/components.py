"""Connected components of a distributed edge list; nothing is collected to the driver.

Each round, partitions first contract their own edges (union-find over what they hold, in blocks of bounded size), then
every node takes its smallest neighbour as parent, parents are followed to their roots by pointer jumping, and edges are
replaced by edges between roots. Rounds end when no edge is left; each at least halves the nodes that have one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpointed

#: Edges that one union-find holds at most.
HELD = 500_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes that are not the smallest."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1))
        u, v = forest(u, v)
        return pa.RecordBatch.from_pydict({"u": pa.array(v), "v": pa.array(u)})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > HELD:
            yield out(held)
            held = []
    if held:
        yield out(held)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long): root is the smallest node of its component."""
    edges = edges.select("u", "v").filter("u <> v")
    edges = checkpointed(edges.repartition("u").mapInArrow(_contract, "u long, v long"))
    labels = checkpointed(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        parent = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root"))
        parent = checkpointed(parent)
        while True:
            above = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = checkpointed(parent.join(above, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")))
            parent = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        top = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = checkpointed(labels.join(top, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        a = parent.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        b = parent.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = edges.join(a, "u").join(b, "v").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).filter("u <> v").distinct()
        edges = checkpointed(edges)
    return labels
