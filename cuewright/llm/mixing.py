"""Mixing sources to target weights by balanced sampling with the cube method.

Sources are ordered by code point and weigh 1, 2, 3, repeating; each is to give that share of all words, but no more than
``MOST`` times its own. A document of a source is to be taken target / source_size times on average: the whole part for
certain, the rest with that inclusion probability. The cube method settles the rest. Its flight phase moves the vector
of probabilities inside the null space of the constraints (documents and words of the source, so both totals are held
exactly) until all but as many documents as there are constraints are 0 or 1. Documents fly in blocks of bounded
size; those left over of all blocks fly again together, round by round, until one block per source holds them, and
the landing phase settles at most two documents of each source.

Choices come from a hash of the identifier and the round, so reruns agree.

Defined results: null or blank texts have size 0 and are taken 0 times; a source whose documents are all empty has
target 0; null is a source of its own, the last; rows that repeat a doc_id are separate rows, told apart by their text's
hash, and equal rows by a row number; null is an identifier like any other; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, checkpointed, quoted

#: No document is taken more often than this.
MOST = 3
#: Documents that fly together, about.
BLOCK = 2_000
WEIGHTS = (1, 2, 3)
#: Documents of more than so many mean sizes fly first.
LARGE = 4
#: Sources whose targets are sent to all executors, at most (a few MB); more are joined by shuffle.
FEW_SOURCES = 50_000


def flight(p: np.ndarray, x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Flight phase for two balancing totals: the sum of p and the sum of p * x stay the same.

    Three undecided documents always span a direction that changes neither total; moving along it until one of them is
    0 or 1 replaces that one by the next document. ``u`` holds a number in [0, 1) for each document, below its p where
    it is to end at 1; each step takes the largest of the three towards its end. Largest documents come first, so the
    many small ones behind, in mixed order, make up for them and what is left at the end is small.
    """
    out = p.copy()
    held: list[int] = []
    values, weights, ends = p.tolist(), x.tolist(), (u < p).tolist()
    for i in range(len(values)):
        if not 0.0 < values[i] < 1.0:
            continue
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            # A direction v with v_a + v_b + v_c = 0 and v_a x_a + v_b x_b + v_c x_c = 0.
            va, vb, vc = weights[b] - weights[c], weights[c] - weights[a], weights[a] - weights[b]
            if va == vb == vc == 0.0:
                va, vb, vc = 1.0, -1.0, 0.0
            up = down = float("inf")
            for k, v in ((a, va), (b, vb), (c, vc)):
                if v > 0:
                    up, down = min(up, (1.0 - values[k]) / v), min(down, values[k] / v)
                elif v < 0:
                    up, down = min(up, values[k] / -v), min(down, (1.0 - values[k]) / -v)
            lead, turn = next((k, v) for k, v in sorted(zip(held, (va, vb, vc), strict=True), key=lambda kv: -weights[kv[0]]) if v)
            move = up if (turn > 0) == ends[lead] else -down
            for k, v in ((a, va), (b, vb), (c, vc)):
                values[k] += move * v
                if values[k] < 1e-9:
                    values[k] = 0.0
                elif values[k] > 1.0 - 1e-9:
                    values[k] = 1.0
            held = [k for k in held if 0.0 < values[k] < 1.0]
    out[:] = values
    return out


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The at most two documents left of a source: of all outcomes the one whose words, then documents, come nearest."""
    left = np.flatnonzero((p > 0) & (p < 1))
    best = None
    for choice in range(1 << len(left)):
        chosen = np.array([choice >> k & 1 for k in range(len(left))], float)
        miss = (abs(float(((chosen - p[left]) * x[left]).sum())), abs(float((chosen - p[left]).sum())), choice)
        if best is None or miss < best[0]:
            best = (miss, chosen)
    out = p.copy()
    out[left] = best[1] if best else out[left]
    return out


def _fly(last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame["_large"] = frame["_size"].where(frame["_size"] > LARGE * frame["_size"].mean(), 0)
        frame = frame.sort_values(["_large", "_turn", "_k1", "_k2", "_row"], ascending=[False, True, True, True, True], kind="stable").drop(columns="_large")
        p, x = frame["_p"].to_numpy(float), frame["_size"].to_numpy(float)
        p = flight(p, x, frame["_side"].to_numpy(float))
        frame["_p"] = landing(p, x) if last else p
        return frame

    return run


def _hashed(*columns: str, salt: int) -> F.Column:
    return F.xxhash64(*map(F.col, columns), F.lit(salt))


def _words(text_col: str) -> F.Column:
    return F.regexp_count(F.coalesce(F.col(quoted(text_col)), F.lit("")), F.lit(WORD)).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: F.Column) -> DataFrame:
    """_id, _source, _size and two hashes over them and the text; rows with the same hashes are interchangeable."""
    rows = docs.select(*more, F.col(quoted(id_col)).alias("_id"), F.col(quoted(source_col)).cast("string").alias("_source"), _words(text_col).alias("_size"), F.xxhash64(quoted(text_col)).alias("_text"))
    return rows.withColumns({"_k1": _hashed("_id", "_source", "_size", "_text", salt=1), "_k2": _hashed("_text", "_size", "_source", "_id", salt=2)}).drop("_text")


def plan_sources(rows: DataFrame) -> DataFrame:
    """_name, _source_size, _target, _rate of each source in ``rows`` (_source, _size); stays distributed.

    Targets rise with one level: a source's is the least of MOST times its size and level * weight. The level is found in
    rounds over sums; each but the last caps at least one source more.
    """
    sums = rows.groupBy("_source").agg(F.sum("_size").alias("_n"))
    # Places in code-point order: ranges in order, numbered inside, behind as many as lie in the ranges before.
    ranged = sums.repartitionByRange(F.col("_source").asc_nulls_last()).withColumn("_range", F.spark_partition_id())
    ranged = checkpointed(ranged)
    before, first = {}, 0
    for r in sorted(ranged.groupBy("_range").count().collect()):  # as many rows as partitions
        before[r["_range"]], first = first, first + r["count"]
    offset = F.lit(0) if not before else F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col("_range")]
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    table = checkpointed(ranged.select(F.col("_source").alias("_name"), F.col("_n").alias("_source_size"), F.get(weight, F.pmod(offset + inside, F.lit(len(WEIGHTS)))).alias("_w")))
    most = F.lit(float(MOST)) * F.col("_source_size")
    total = float(table.agg(F.sum("_source_size")).first()[0] or 0)
    left, scale = total, float(table.agg(F.sum("_w")).first()[0] or 0)
    while scale:
        over = F.lit(left) * F.col("_w") / F.lit(scale) > most
        r = table.agg(F.sum(F.when(over, most)).alias("c"), F.sum(F.when(~over, F.col("_w"))).alias("w")).first()
        if (new := (total - (r["c"] or 0.0), r["w"] or 0.0)) == (left, scale):
            break
        left, scale = new
    target = F.least(most, F.lit(left) * F.col("_w") / F.lit(scale)) if scale else most
    return table.select("_name", "_source_size", target.alias("_target"), F.when(F.col("_source_size") > 0, target / F.col("_source_size")).otherwise(0.0).alias("_rate"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per input row: id, size, source, source_size, target, taken (words), copies, row (among equal rows)."""
    out = _mix(_keyed(docs, id_col, text_col, source_col), block)
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source").alias(source_col),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
        F.col("_copies").alias("copies"),
        F.col("_row").alias("row"),
    )


def _mix(rows: DataFrame, block: int) -> DataFrame:
    """The rows with _copies and _row."""
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_id")))
    rows = checkpointed(rows)
    plan = checkpointed(plan_sources(rows))
    plan = F.broadcast(plan) if plan.count() <= FEW_SOURCES else plan
    rows = rows.join(plan, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    whole = F.when(F.col("_size") > 0, F.floor(F.col("_rate") + 1e-12)).otherwise(0)
    rest = F.when(F.col("_size") > 0, F.greatest(F.lit(0.0), F.col("_rate") - F.col("_whole")))
    rows = rows.withColumn("_whole", whole).withColumn("_p", F.when(rest > 1e-9, rest).otherwise(0.0))

    open_ = rows.filter("_p > 0").select("_k1", "_k2", "_row", "_source", "_size", "_p")
    most = open_.groupBy("_source").count().agg(F.max("count")).first()[0] or 0
    settled = None
    for turn in range(40):
        blocks = max(1, -(-most // block))
        last = blocks == 1
        dealt = open_.withColumns({
            "_block": F.pmod(_hashed("_k1", "_row", salt=turn), F.lit(blocks)),
            "_turn": _hashed("_k1", "_row", salt=100 + turn),
            "_side": (F.pmod(_hashed("_k1", "_row", salt=200 + turn), F.lit(1 << 30)) / F.lit(float(1 << 30))),
        })
        flown = dealt.groupBy("_source", "_block").applyInPandas(_fly(last), dealt.schema).select("_k1", "_k2", "_row", "_source", "_size", "_p")
        flown = checkpointed(flown)
        done = flown.filter("_p = 0 OR _p = 1")
        settled = done if settled is None else settled.unionByName(done)
        if last:
            break
        open_ = flown.filter("_p > 0 AND _p < 1")
        most = 2 * blocks
    chosen = settled.filter("_p = 1").select(F.col("_k1").alias("_c1"), F.col("_k2").alias("_c2"), F.col("_row").alias("_crow"), F.lit(1).alias("_one"))
    out = rows.join(chosen, (F.col("_k1") == F.col("_c1")) & (F.col("_k2") == F.col("_c2")) & (F.col("_row") == F.col("_crow")), "left")
    return out.withColumn("_copies", (F.col("_whole") + F.coalesce("_one", F.lit(0))).cast("long"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The whole rows as often as the mix takes them. Whole rows are moved once, to their hashes' place; of several rows
    with the same hashes those that come first there take the copies that only some have."""
    plan = _mix(_keyed(docs, id_col, text_col, source_col), BLOCK)
    plan = plan.groupBy(F.col("_k1").alias("_p1"), F.col("_k2").alias("_p2")).agg(F.min("_copies").alias("_least"), (F.sum("_copies") - F.count("*") * F.min("_copies")).alias("_more"), F.sum("_copies").alias("_all"))
    plan = plan.filter("_all > 0").drop("_all")
    # Whole rows travel as one column, so their names cannot clash with those used here.
    rows = _keyed(docs, id_col, text_col, source_col, F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc"))
    rows = rows.join(plan, (F.col("_k1") == F.col("_p1")) & (F.col("_k2") == F.col("_p2")))
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_id")))
    rows = rows.withColumn("_copies", F.col("_least") + F.when(F.col("_row") <= F.col("_more"), 1).otherwise(0)).filter("_copies > 0")
    return rows.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")
