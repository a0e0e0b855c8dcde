"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts by their first bytes (and a digest, which parts texts that
start alike), an external sort places equal texts side by side, and comparing whole neighbours finds the groups, whose
smallest identifier stays. Only DataFrame functions run.

A text with very many copies would be one range that no splitter can cut. Counts by a 64-bit digest, combined before
their shuffle, find such texts; their rows get a slice number behind the text in the sort key, so that splitters can
fall inside the group, and the slices' results are merged by SHA-256 at the end. At most ``rows / hot_rows`` texts can
be that frequent, so what is broadcast is bounded by ``MOST_HOT`` rows of 50 bytes: beyond MOST_HOT * HOT_ROWS rows
(64 million) slices grow, to 40,000 rows at 10 billion.

Defined results: a null text counts as empty; empty texts form a group like any other; rows that repeat a doc_id are
separate rows of their group; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import SPACE, checkpointed, partitions, quoted

#: Texts with at least so many copies are dealt in slices of about that size, or more where the table is large.
HOT_ROWS = 256
#: No more texts than this can count as hot.
MOST_HOT = 250_000
#: Rows in a range, about, where the table has more than the session's shuffle partitions would take.
RANGE = 100_000
#: Leading characters of a text that stand in a splitter; whole texts there would all meet in the driver.
HEAD = 24


def normalised(text: F.Column | str) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACE, " ")


def hot_texts(texts: DataFrame, hot_rows: int) -> DataFrame:
    """Digests of the texts with at least ``hot_rows`` copies, and in how many slices to deal them."""
    counts = texts.groupBy(F.xxhash64("_norm").alias("_digest")).agg(F.count("*").alias("_copies"))
    counts = counts.filter(F.col("_copies") >= hot_rows)
    return counts.select(F.col("_digest").alias("_hot"), F.ceil(F.col("_copies") / hot_rows).cast("int").alias("_slices"))


def ranges(docs: DataFrame, n: int) -> int:
    return max(partitions(docs), n // RANGE)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS, count: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    A row is kept if it is its group's first by id; of rows that repeat id and text one is kept. Null ids sort last.
    """
    n = docs.count() if count is None else count
    hot_rows = max(hot_rows, n // MOST_HOT)
    texts = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    hot = F.broadcast(hot_texts(texts, hot_rows))
    dealt = texts.withColumn("_digest", F.xxhash64("_norm")).join(hot, F.col("_digest") == F.col("_hot"), "left")
    slice_ = F.when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_slices"))).cast("int")
    dealt = dealt.select("_id", F.substring("_norm", 1, HEAD).alias("_head"), "_digest", "_norm", slice_.alias("_slice"))
    ranged = dealt.repartitionByRange(ranges(docs, n), "_head", "_digest", "_slice")
    order = Window.partitionBy("_head", "_digest", "_slice", "_norm").orderBy(F.col("_id").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = ranged.select(
        "_id",
        "_slice",
        F.sha2("_norm", 256).alias("_sha"),
        F.first("_id").over(order).alias("_keep"),
        F.count("*").over(whole).alias("_size"),
        F.row_number().over(order).alias("_rank"),
    )
    found = checkpointed(found)  # rows without texts, read twice below
    merged = (
        found.filter(F.col("_slice").isNotNull())
        .groupBy(F.col("_sha").alias("_hot_sha"))
        .agg(F.min("_keep").alias("_hot_keep"), F.sum(F.when(F.col("_rank") == 1, F.col("_size"))).alias("_hot_size"))
    )
    out = found.join(F.broadcast(merged), (F.col("_sha") == F.col("_hot_sha")) & F.col("_slice").isNotNull(), "left")
    keep = F.coalesce("_hot_keep", "_keep")
    return out.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_hot_size", "_size").alias("group_size"),
        ((F.col("_rank") == 1) & F.col("_keep").eqNullSafe(keep)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows that stay, with all their columns: as exact_dedup, but whole rows go through the sort, and the first row of
    a hot text, told by its SHA-256, comes from the counts before it. Of rows that repeat id and text one stays."""
    n = docs.count()
    hot_rows = max(hot_rows, n // MOST_HOT)
    norm, id_ = normalised(F.col(quoted(text_col))), F.col(quoted(id_col))
    counts = docs.groupBy(F.unhex(F.sha2(norm, 256)).alias("_hot")).agg(F.count("*").alias("_copies"), F.min(id_).alias("_least"))
    hot = counts.filter(F.col("_copies") >= hot_rows).select("_hot", "_least", F.ceil(F.col("_copies") / hot_rows).cast("int").alias("_slices"))
    # Whole rows travel as one column, so their names cannot clash with those used here.
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc")
    dealt = docs.select(whole, id_.alias("_id"), F.xxhash64(norm).alias("_digest"), F.substring(norm, 1, HEAD).alias("_head"), F.unhex(F.sha2(norm, 256)).alias("_sha"))
    dealt = dealt.join(F.broadcast(hot), F.col("_sha") == F.col("_hot"), "left").drop("_sha", "_hot")
    dealt = dealt.withColumn("_slice", F.when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_slices"))).cast("int"))
    ranged = dealt.repartitionByRange(ranges(docs, n), "_head", "_digest", "_slice").withColumn("_norm", normalised(F.col("_doc").getField(text_col)))
    order = Window.partitionBy("_head", "_digest", "_slice", "_norm").orderBy(F.col("_id").asc_nulls_last())
    found = ranged.withColumn("_rank", F.row_number().over(order))
    stays = (F.col("_rank") == 1) & (F.col("_slices").isNull() | F.col("_id").eqNullSafe(F.col("_least")))
    return found.filter(stays).select("_doc.*")
