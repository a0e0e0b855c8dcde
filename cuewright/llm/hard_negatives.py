"""Hard-negative mining by blocked dense products.

Anchors are dealt by a hash of their identifier into groups of bounded size, and a group at a time is broadcast. Each task
multiplies the group's blocks of anchors with its blocks of candidates in float64, keeps for each anchor the best
positives it has seen, and hands those on; they are merged by anchor. A second pass multiplies the same blocks again and
keeps, for each anchor and positive, the best negatives in the window that the positive's score sets. All components are
whole numbers, so a product is exact as long as the vectors' lengths multiply to less than 2**53; blocks with longer
vectors are multiplied in whole numbers of any size.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; a missing
component counts as 0 where lengths differ; of anchors that repeat an identifier the largest by label and vector counts,
and a row is never positive or negative to an anchor with its own identifier; candidates that repeat an identifier and
score count once; rows without an identifier take no part, as ties could not be told; no anchors or an empty table give
no rows; other columns are ignored. A score beyond a long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import checkpoint_folder, quoted

#: Numbers in a group of anchors, about (8 bytes each), and the most; anchors and candidates in a block.
GROUP, ANCHORS, CANDIDATES = 2_000_000, 512, 4096
#: Positives of an anchor, negatives of each positive, and the window: LOW to HIGH percent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
EXACT = float(1 << 53)


def usable(rows: DataFrame, id_col: str, vector_col: str, label: F.Column) -> DataFrame:
    """_id, _label, _vector (whole numbers in double) of the rows that take part."""
    vector = F.col(quoted(vector_col))
    whole = F.transform(vector, lambda x: F.floor(256 * x.cast("double")).cast("double"))
    fine = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = rows.select(F.col(quoted(id_col)).cast("long").alias("_id"), label.cast("long").alias("_label"), vector.alias("_v"), F.when(fine, whole).alias("_vector"))
    return out.filter("_id is not null and _label is not null and _vector is not null").drop("_v")


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column, filled up with zeros to one length."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole vectors: float64 where nothing can reach 2**53, else int64 from Python's whole numbers."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    longest = np.sqrt((a * a).sum(1).max(initial=0)) * np.sqrt((b * b).sum(1).max(initial=0))
    if longest * 1.001 < EXACT:
        return a @ b.T
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return exact.astype(np.int64)  # an OverflowError if a score is no long


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first of distinct (score, id), by score from above, then by id."""
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
    return scores[new][:k], ids[new][:k]


def leaders(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the scores that can be among the k first (all that tie with the k-th)."""
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) > k else np.arange(len(scores))


class Kept:
    """The best (score, id) of each slot, merged block by block."""

    def __init__(self, k: int):
        self.k, self.slots = k, {}

    def add(self, slot: tuple[int, int], scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.slots.get(slot)
        if held is not None:
            if len(held[0]) == self.k:
                near = scores >= held[0][-1]
                scores, ids = scores[near], ids[near]
            if not len(scores):
                return
        some = leaders(scores, 4 * self.k) if held is None and len(scores) > 64 * self.k else np.arange(len(scores))
        if len(some) < len(scores):  # repeated (score, id) pairs could fill these places: then all are looked at
            got = best(scores[some], ids[some], self.k)
            if len(got[0]) < self.k:
                some = np.arange(len(scores))
        scores, ids = scores[some], ids[some]
        if held is not None:
            scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
        self.slots[slot] = best(scores, ids, self.k)


def _pairs(batches: Iterator[pa.RecordBatch], group: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of scores: places of the anchors, scores, candidates' identifiers and labels."""
    for whole in batches:
        for at in range(0, len(whole), CANDIDATES):
            batch = whole.slice(at, CANDIDATES)
            ids, labels, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
            for low in range(0, len(group["id"]), ANCHORS):
                block = np.arange(low, min(low + ANCHORS, len(group["id"])))
                yield block, products(group["vector"][block], vectors), ids, labels


def first_pass(batches: Iterator[pa.RecordBatch], group: dict, k: int) -> Iterator[pa.RecordBatch]:
    kept = Kept(k)
    for block, scores, ids, labels in _pairs(batches, group):
        for a, row in zip(block, scores, strict=True):
            same = np.flatnonzero((labels == group["label"][a]) & (ids != group["id"][a]))
            if len(same):
                kept.add((int(a), 0), row[same], ids[same])
    rows = [(int(group["id"][a]), int(s), int(i)) for (a, _), (scores, found) in kept.slots.items() for s, i in zip(scores, found, strict=True)]
    yield pa.RecordBatch.from_pydict({n: pa.array([r[j] for r in rows], pa.int64()) for j, n in enumerate(("a", "score", "id"))})


def second_pass(batches: Iterator[pa.RecordBatch], group: dict, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    kept = Kept(k)
    positives = group["positives"]
    # low * p <= 100 * n <= high * p in whole numbers: n lies from the first bound to the second.
    bounds = {a: [(-((-low * p) // 100), (high * p) // 100) for p, _ in found] for a, found in positives.items()}
    for block, scores, ids, labels in _pairs(batches, group):
        for a, row in zip(block, scores, strict=True):
            limits = bounds.get(int(a))
            if not limits or (floor := min(x for x, _ in limits)) > (ceiling := max(y for _, y in limits)):
                continue
            some = np.flatnonzero((labels != group["label"][a]) & (ids != group["id"][a]) & (row >= floor) & (row <= ceiling))
            for j, (x, y) in enumerate(limits):
                inside = some[(row[some] >= x) & (row[some] <= y)]
                if len(inside):
                    kept.add((int(a), j), row[inside], ids[inside])
    rows = [(int(group["id"][a]), positives[a][j][1], positives[a][j][0], int(s), int(i)) for (a, j), (scores, found) in kept.slots.items() for s, i in zip(scores, found, strict=True)]
    names = ("anchor_id", "positive_id", "positive_score", "negative_score", "negative_id")
    yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def ranked(found: DataFrame, by: list[str], score: str, id_: str, k: int) -> DataFrame:
    """The k first distinct (score, id) of each group, merged from what the tasks have kept."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), id_)
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", label: F.Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, group_numbers: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its first
    ``positives`` rows of the same label the first ``negatives`` rows of other labels whose score lies within ``low`` to
    ``high`` percent of the positive's."""
    spark = rows.sparkSession
    label = F.col("label") if label is None else label
    pool = usable(rows, id_col, vector_col, label)
    chosen = usable(rows.filter(anchors), id_col, vector_col, label).groupBy("_id").agg(F.max(F.struct("_label", "_vector")).alias("_r"))
    size = chosen.agg(F.count("*"), F.sum(F.greatest(F.size("_r._vector"), F.lit(1)))).first()
    groups = max(1, -(-2 * int(size[1] or 0) // group_numbers)) if int(size[1] or 0) > group_numbers else 1
    dealt = chosen.select("_id", "_r.*", F.pmod(F.xxhash64("_id"), F.lit(groups)).alias("_g"))
    place = f"{checkpoint_folder(spark)}/negatives-{spark.range(1).select(F.expr('uuid()')).first()[0]}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for g in range(groups):
        held = dealt.filter(F.col("_g") == g).orderBy("_id").toArrow()  # about half of group_numbers at most, by the hash
        group = {"id": held.column("_id").to_numpy(), "label": held.column("_label").to_numpy(), "vector": matrix(held.column("_vector").combine_chunks())}
        sent = spark.sparkContext.broadcast(group)

        def first(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            return first_pass(batches, sent.value, positives)

        near = ranked(pool.mapInArrow(first, "a long, score long, id long"), ["a"], "score", "id", positives)
        where = {int(i): a for a, i in enumerate(group["id"])}
        found: dict[int, list[tuple[int, int]]] = {}
        for r in near.orderBy("a", "rank").collect():  # at most ``positives`` rows for each anchor of the group
            found.setdefault(where[r.a], []).append((r.score, r.id))
        again = spark.sparkContext.broadcast(group | {"positives": found})

        def second(batches: Iterator[pa.RecordBatch], sent=again) -> Iterator[pa.RecordBatch]:
            return second_pass(batches, sent.value, negatives, low, high)

        mined = pool.mapInArrow(second, "anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long")
        mined = ranked(mined, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
        mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score").write.parquet(f"{place}/group={g}")
        sent.unpersist()
        again.unpersist()
    return spark.read.schema(schema + ", group int").parquet(place).drop("group")
