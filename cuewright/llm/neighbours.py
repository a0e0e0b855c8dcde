"""Approximate nearest neighbours by learned partitions.

A balanced partitioning of the neighbour graph of a bounded sample gives partitions that keep neighbours together; a
small classifier (one hidden layer) learns which partitions hold a vector's neighbours. It assigns every vector to its
most probable partition and routes each query to several, whose vectors are all compared exactly. Large tables get a second
level: each partition is parted again in the same way, from a sample of its own vectors, by the executors. How many
partitions a query visits is set on held-out sample vectors against brute force, so that at least ``RECALL`` of their
neighbours are reached at each level; where data have no structure that is most partitions, and results stay right at the
cost of work.

Equal vectors are one: only the k + 1 smallest ids of each can be among anyone's nearest, so a vector that a third of all
rows hold is indexed once and searched for once. Partitions are searched in blocks of bounded size; a block stays in
memory while all its queries pass by.

Defined results: vectors that are null, zero, hold null or non-finite components, or differ in length from the most
common one take no part; rows with the query's id are not its neighbours; rows that repeat an id and a vector are one, an
id with two vectors is a query and a candidate with each; ties go to the smaller id, equal vectors have exactly equal
scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import checkpointed

#: Vectors in a sample at most, and of these held out to set the number of probes.
SAMPLE, HELD_OUT = 8192, 1024
#: Vectors in a partition, about; partitions that one router tells apart, at least (if there are as many samples) and most.
ROWS_EACH, FEW_PARTS, MOST_PARTS = 600, 4, 128
#: Vectors in a partition from which on it is parted again.
LARGE = 8192
#: Vectors in a block, about, and queries compared with it at once.
BLOCK, AT_ONCE = 4096, 512
#: Share of the held-out vectors' neighbours that probes must reach, at each level.
RECALL = 0.97
_NEAR, _HIDDEN = 10, 128


def nearest(queries: np.ndarray, base: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``base`` (unit length) nearest to each query, best first; ``own``: each query's own row, left out."""
    out = []
    for at in range(0, len(queries), 512):
        s = queries[at : at + 512] @ base.T
        if own is not None:
            s[np.arange(len(s)), own[at : at + 512]] = -np.inf
        top = np.argpartition(-s, min(k, s.shape[1] - 1), axis=1)[:, :k]
        out.append(np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1))
    return np.concatenate(out)


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Partition of the graph's nodes: halving by the main direction, then moves to the neighbours' majority within a
    size limit."""
    label = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        label[rows] = first
        if n == 1 or len(rows) < 2:
            continue
        y = x[rows] - x[rows].mean(0)
        v = rng.normal(size=x.shape[1])
        for _ in range(10):
            v = y.T @ (y @ v)
            v /= np.linalg.norm(v) + 1e-12
        order = np.argsort(y @ v, kind="stable")
        cut = len(rows) * (n // 2) // n
        todo += [(rows[order[:cut]], first, n // 2), (rows[order[cut:]], first + n // 2, n - n // 2)]
    limit = int(1.1 * len(x) / parts) + 1
    size = np.bincount(label, minlength=parts)
    both: list[list[int]] = [list(g) for g in graph.tolist()]
    for i, g in enumerate(graph.tolist()):
        for j in g:
            both[j].append(i)
    for _ in range(8):
        moved = 0
        for i in rng.permutation(len(x)).tolist():
            votes = np.bincount(label[both[i]], minlength=parts)
            best = int(np.where(size < limit, votes, -1).argmax())
            if best != label[i] and votes[best] > votes[label[i]]:
                size[label[i]] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if moved < len(x) // 200:
            break
    return label


@dataclass
class Router:
    """The classifier: unit vector to log-odds of partitions."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    direct: np.ndarray
    probes: int = 1
    below: dict[int, Router] = field(default_factory=dict)  # routers of the partitions that are parted again

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + x @ self.direct + self.b2

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Each vector's partition, as part * MOST_PARTS + part of the second level."""
        part = self.scores(x).argmax(1)
        out = part * MOST_PARTS
        for p in np.unique(part).tolist() if self.below else ():
            if p in self.below:
                mine = part == p
                out[mine] += self.below[p].scores(x[mine]).argmax(1)
        return out.astype(np.int32)

    def route(self, x: np.ndarray) -> list[np.ndarray]:
        """The partitions that each vector visits, numbered as by assign."""
        best = np.argsort(-self.scores(x), axis=1)[:, : self.probes]
        out: list[list[np.ndarray]] = [[] for _ in x]
        for p in np.unique(best).tolist():
            at = np.flatnonzero((best == p).any(axis=1))
            inner = self.below[p].route(x[at]) if p in self.below else [np.zeros(1, np.int32)] * len(at)
            for i, parts in zip(at.tolist(), inner, strict=True):
                out[i].append(p * MOST_PARTS + (parts // MOST_PARTS if p in self.below else parts))
        return [np.concatenate(o).astype(np.int32) for o in out]

    def fit(self, x: np.ndarray, goal: np.ndarray, rng: np.random.Generator, steps: int = 400) -> None:
        """Cross entropy to the shares of partitions among the neighbours, by Adam on batches."""
        names = ("w1", "b1", "w2", "b2", "direct")
        m = {n: np.zeros_like(getattr(self, n)) for n in names}
        v = {n: np.zeros_like(getattr(self, n)) for n in names}
        for t in range(1, steps + 1):
            i = rng.integers(0, len(x), 512)
            h = np.maximum(x[i] @ self.w1 + self.b1, 0)
            z = h @ self.w2 + x[i] @ self.direct + self.b2
            z -= z.max(1, keepdims=True)
            d = np.exp(z)
            d = (d / d.sum(1, keepdims=True) - goal[i]) / len(i)
            dh = (d @ self.w2.T) * (h > 0)
            for n, g in zip(names, (x[i].T @ dh, dh.sum(0), h.T @ d, d.sum(0), x[i].T @ d), strict=True):
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.999 * v[n] + 0.001 * g * g
                rate = 0.01 * (1 - t / (steps + 1))
                setattr(self, n, getattr(self, n) - rate * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.999**t)) + 1e-8))


def learn(x: np.ndarray, parts: int, k: int, seed: int = 7) -> Router:
    """Partition the sample (unit vectors), fit the classifier, and set the probes on held-out vectors."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    router = Router(rng.normal(size=(dim, _HIDDEN)) / np.sqrt(dim), np.zeros(_HIDDEN), np.zeros((_HIDDEN, parts)), np.zeros(parts), np.zeros((dim, parts)))
    if parts == 1:
        return router
    cut = min(HELD_OUT, len(x) // 4)
    held, fit = x[:cut], x[cut:]
    graph = nearest(fit, fit, _NEAR, np.arange(len(fit)))
    label = balanced_partition(fit, graph, parts, rng)
    goal = np.zeros((len(fit), parts))
    np.add.at(goal, (np.repeat(np.arange(len(fit)), _NEAR), label[graph].ravel()), 1 / _NEAR)
    np.add.at(goal, (np.arange(len(fit)), label), 1.0)
    router.fit(fit, goal / goal.sum(1, keepdims=True), rng)
    assigned = router.scores(fit).argmax(1)
    order = np.argsort(-router.scores(held), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], 1)
    needed = np.sort(np.take_along_axis(place, assigned[nearest(held, fit, k)], 1).ravel())
    router.probes = min(parts, int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1)
    return router


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compared(names: np.ndarray, y: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of the vectors x (ids) for each query y (names), with the measure itself."""
    near = _unit(y) @ _unit(x).T
    least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] - 1e-9 if len(ids) > k else np.full(len(names), -2.0)
    q, c = np.nonzero(near >= least[:, None])
    # The measure, each row by the same steps, so that equal vectors score the same.
    a, b = y[q], x[c]
    score = np.sum(a * b, axis=1) / (np.sqrt(np.sum(a * a, axis=1)) * np.sqrt(np.sum(b * b, axis=1)))
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, np.arange(len(names)))[q] < k
    return pa.RecordBatch.from_arrays([pa.array(names[q[best]]), pa.array(ids[c[best]]), pa.array(score[best])], ["query", "class", "score"])


def _search(k: int):
    """Rows of one partition and block come together, vectors (``asks`` false) before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, ready = None, [], [], None
        for batch in batches:
            if not len(batch):
                continue
            block = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            asks, names, x = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), _matrix(batch.column(4))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if block[low] != key:
                    key, ids, vectors, ready = block[low], [], [], None
                if not asks[low]:
                    ids.append(names[low:high])
                    vectors.append(x[low:high])
                    continue
                if ready is None and ids:
                    ready = np.concatenate(ids), np.vstack(vectors)
                for at in range(low, high, AT_ONCE) if ready else ():
                    stop = min(high, at + AT_ONCE)
                    yield _compared(names[at:stop], x[at:stop], *ready, k)

    return run


def _second_level(indexed: DataFrame, large: DataFrame, k: int, most: int) -> dict[int, Router]:
    """A router for each partition in ``large`` (part, n), learnt from about SAMPLE of its vectors."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h").head(SAMPLE)
        parts = int(min(MOST_PARTS, max(2, rows["n"].iloc[0] // most * 2)))
        return pd.DataFrame({"top": [key[0]], "router": [pickle.dumps(learn(_unit(np.vstack(rows["v"].to_numpy()).astype(float)), parts, k))]})

    some = indexed.join(F.broadcast(large), "part").withColumn("h", F.xxhash64("class"))
    share = F.lit(float(2**62)) * 2 * F.least(F.lit(1.0), F.lit(1.2 * SAMPLE) / F.col("n"))
    some = some.filter(F.abs(F.col("h")) <= share).withColumn("top", F.floor(F.col("part") / MOST_PARTS).cast("int"))
    learnt = some.select("top", "n", "h", "v").groupBy("top").applyInPandas(run, "top int, router binary")
    return {r.top: pickle.loads(r.router) for r in learnt.collect()}  # MOST_PARTS routers of some 200 KB at most


def nearest_neighbours(vectors: DataFrame, is_query: F.Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", large: int = LARGE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row where ``is_query`` (over the column vec_id) holds."""
    x = F.col("v")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(x.isNotNull() & F.col("vec_id").isNotNull()).filter(fine)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == common["n"])
    # Classes of equal vectors: the smallest id names them, the k + 1 smallest stand for all in anyone's result.
    first = Window.partitionBy("v").orderBy("vec_id")
    members = rows.dropDuplicates(["v", "vec_id"]).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    members = checkpointed(members.withColumn("class", F.first("vec_id").over(first)).select("class", "vec_id", "v", "r"))
    classes = members.filter("r = 1").select("class", "v")
    asked = checkpointed(rows.filter(is_query).distinct().join(classes, "v").select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")))

    total = classes.count()
    parts = int(min(MOST_PARTS, max(1, min(FEW_PARTS, total // 32), total // ROWS_EACH)))
    some = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("v").toArrow()
    router = learn(_unit(_matrix(some.column("v").combine_chunks())), parts, k)

    def assigned(router: Router) -> DataFrame:
        shared = spark.sparkContext.broadcast(router)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.assign(_unit(_matrix(batch.column(1)))))], ["class", "v", "part"])

        return checkpointed(classes.mapInArrow(assign, "class long, v array<double>, part int"))

    indexed = assigned(router)
    crowded = indexed.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") > large)
    if below := _second_level(indexed, crowded, k, large):
        router.below = below
        indexed = assigned(router)
    shared = spark.sparkContext.broadcast(router)  # some 200 KB, with a second level 35 MB at most (64 dimensions)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.route(_unit(_matrix(batch.column(1)))), pa.list_(pa.int32()))], ["query", "v", "parts"])

    blocks = indexed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # MOST_PARTS ** 2 rows at most
    queries = asked.select(F.col("query").alias("class")).distinct().join(classes, "class").mapInArrow(route, "query long, v array<double>, parts array<int>")
    queries = queries.select("query", "v", F.explode("parts").alias("part")).join(F.broadcast(blocks), "part")
    queries = queries.select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), F.col("query").alias("name"), "v")
    held = indexed.join(F.broadcast(blocks), "part").select("part", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("asks"), F.col("class").alias("name"), "v")
    dealt = held.unionByName(queries).repartition("part", "block").sortWithinPartitions("part", "block", "asks")
    found = dealt.mapInArrow(_search(k + 1), "query long, class long, score double")
    # The k + 1 best classes hold the k + 1 best rows, of which the query itself may be one.
    near = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    found = found.withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1).select("query", "class", "score")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.join(members.select("class", "vec_id"), "class").withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1).select("query", "vec_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = asked.join(found, "query").filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
