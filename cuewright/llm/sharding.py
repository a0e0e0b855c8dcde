"""Sharding by extendible hashing, with DataFrame functions only.

A document's place is the first ``BITS`` bits of the MD5 digest of its key. The directory starts with one bucket; only a
bucket that exceeds the byte limit splits on another bit, so each document lies in the shortest prefix whose total fits.
The directory doubles in rounds of as many bits as its largest bucket calls for, ``STEP`` at most; a round looks only at
the buckets that are still too large, so their number, not that of the bits, bounds the work.

A bucket still too large at the last bit holds rows that no bit can part (copies of one key, or one huge document).
It is cut by running size into numbered pages of at most the limit; a single document above the limit has its own.

Defined results: a null text has size 0; rows that repeat a key are separate rows; a null key hashes as the empty
text; an empty table gives no rows; other columns are ignored. Shards do not depend on the order of rows, except that
rows of one key which exceed the limit are paged in the order in which the table lists them.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import checkpointed

#: Bits of a place, and bits that a round adds at most.
BITS, STEP = 60, 16
#: Bytes of text in a shard, at most.
LIMIT = 1 << 20
#: Directory entries that are sent to all executors, at most (about 4 MB); a larger directory is joined by shuffle.
SENT = 1 << 17


def place(key: F.Column, bits: int = BITS) -> F.Column:
    """The first bits of the digest, as a number (60 at most)."""
    first = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return F.shiftright(first, 60 - bits)


def directory(sizes: DataFrame, limit: int, step: int) -> DataFrame:
    """Entries _place, _more, _prefix, _total: each place's bucket, ``_more`` bits below the one it lay in.

    ``sizes`` has _place, which counts ``step`` bits more than the buckets at hand, and _bytes. Totals fall with each
    further bit, so the new buckets are the prefixes that fit (or have no bit left) and whose parent does not fit.
    """
    fine = sizes.groupBy("_place").agg(F.sum("_bytes").alias("_bytes"))
    nodes = fine.select("_bytes", "_place", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("_more"))
    total = nodes.groupBy("_more", F.expr(f"shiftright(_place, {step} - _more)").alias("_prefix")).agg(F.sum("_bytes").alias("_total"))
    closed = (F.col("_total") <= limit) | (F.col("_more") == step)
    split = total.filter(~closed).select((F.col("_more") + 1).alias("_more"), F.explode(F.array(F.col("_prefix") * 2, F.col("_prefix") * 2 + 1)).alias("_prefix"))
    new = total.filter(closed).join(split, ["_more", "_prefix"], "left_semi").unionByName(total.filter(closed & (F.col("_more") == 0)))
    low, high = (F.expr(f"shiftleft(_prefix + {k}, {step} - _more)") for k in (0, 1))
    return new.select("_more", "_prefix", "_total", F.explode(F.sequence(low, high - 1)).alias("_place"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, bits: int = BITS) -> DataFrame:
    """One row per input row: id, size_bytes, shard, depth, shard_bytes.

    ``shard`` is the bucket's bits ('' is the whole directory), with ':slice.page' behind where bits do not part it.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_bytes"), F.monotonically_increasing_id().alias("_n"))
    # Kept as read: rows without texts, whose numbers stay the same whatever executors are lost later.
    open_ = checkpointed(rows.withColumn("_all", place(F.col("_id"), bits)))
    depth, done = 0, []
    largest = open_.agg(F.sum("_bytes").alias("s")).first()["s"]
    while True:
        step = min(STEP, bits - depth, max(1, ceil(log2(max(largest or 0, 1) / limit)) + 2)) if (largest or 0) > limit else 0
        sizes = open_.withColumn("_place", F.expr(f"shiftright(_all, {bits - depth - step})"))
        entries = checkpointed(directory(sizes, limit, step))
        small = entries.count() <= SENT
        found = sizes.drop("_total").join(F.broadcast(entries) if small else entries, "_place").withColumn("_depth", F.lit(depth) + F.col("_more"))
        largest = entries.filter((F.col("_total") > limit) & (F.col("_more") == step)).agg(F.max("_total").alias("s")).first()["s"]
        depth += step
        done.append(found.filter(F.col("_total") <= limit))
        over = found.filter(F.col("_total") > limit).drop("_more", "_place")
        if largest is None or depth == bits:
            break
        open_ = checkpointed(over.select("_id", "_bytes", "_n", "_all"))
    name = F.when(F.col("_depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(bin(_prefix), 64, '0'), _depth)"))
    plain = done[0]
    for more in done[1:]:
        plain = plain.unionByName(more)
    plain = plain.select("_id", "_bytes", name.alias("_shard"), "_depth", F.col("_total").alias("_shard_bytes"))
    # Rows above half the limit have a page of their own; pages of the others start at each half, so none exceeds the limit.
    rest = over.withColumn("_shard", name).withColumn("_slices", F.ceil(F.col("_total") / (64 * limit)).cast("int"))
    rest = rest.withColumn("_slice", F.pmod(F.xxhash64("_n"), F.col("_slices"))).withColumn("_alone", F.col("_bytes") > limit / 2)
    number = Window.partitionBy("_shard", "_slice", "_alone").orderBy("_n")
    before = number.rowsBetween(Window.unboundedPreceding, -1)
    page = F.when(F.col("_alone"), F.concat(F.lit("a"), F.row_number().over(number))).otherwise(
        F.floor(F.coalesce(F.sum("_bytes").over(before), F.lit(0)) / (limit / 2)).cast("string")
    )
    rest = rest.withColumn("_shard", F.concat("_shard", F.lit(":"), "_slice", F.lit("."), page))
    rest = rest.select("_id", "_bytes", "_shard", "_depth", F.sum("_bytes").over(Window.partitionBy("_shard")).alias("_shard_bytes"))
    return plain.unionByName(rest).select(
        F.col("_id").alias(id_col), F.col("_bytes").alias("size_bytes"), F.col("_shard").alias("shard"), F.col("_depth").alias("depth"), F.col("_shard_bytes").alias("shard_bytes")
    )
