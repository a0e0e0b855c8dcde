"""Tolerant as-of join: each left row meets the latest right row of its key at or before its time, within a tolerance.

Left and right rows are one table, and a window over it with a RANGE frame from ``tolerance`` before the row's time to the
time itself takes the maximum of a packed struct (time, tie columns, payload). How many right rows share the matched time
is counted by key and time and joined afterwards.

A key may hold any share of all rows. The union is therefore dealt in ranges of (key, time, side, a hash of the row), so
that a large key lies in many ranges and even rows of one instant can be parted; each range is one task. A range knows
nothing of what stands before it, so each (range, key) gets one more row: the best right row of the key's earlier ranges,
which is the only one of them that can still be the latest. As Spark evaluates a moving frame anew for each row, whose
cost would grow with the square of a key's rows, a range's rows of a key are taken in chunks of ``CHUNK`` rows, each with
the best of the chunks before it.

Defined results: a null key or time on either side matches nothing (such a left row stays, unmatched); null tie columns
lose, and so do nulls in the payload where all ties are equal; repeated rows count each, on both sides; an empty right
table leaves all left rows unmatched; times are long microseconds, and times less the tolerance must fit in a long; all
columns of the left table are returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import partitions, quoted, stored

#: Rows of a range that share a moving frame.
CHUNK = 64
#: Rows in a range, about, where the tables have more than the session's shuffle partitions would take.
RANGE = 2_000_000
HOUR = 3_600_000_000


def asof_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, tolerance: int, ties: Sequence[str] = (), payload: Sequence[str] = (), count: str = "n_tied", lag: str = "lag") -> DataFrame:
    """All columns of ``left``, then ``ties`` and ``payload`` of the matched right row, ``lag`` (left time less right time)
    and ``count`` (right rows of the key at the matched time, 0 if none matched). Of right rows at one time the largest by
    ``ties`` matches, then by ``payload``; tie and payload columns must have an order."""
    spark = left.sparkSession
    n = max(partitions(left), (left.count() + right.count()) // RANGE)
    best = F.struct(F.col(quoted(right_time)).cast("long").alias("t"), *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate([*ties, *payload])])
    kind = right.select(best.alias("b")).schema["b"].dataType
    whole = F.struct(*[F.col(quoted(c)) for c in left.columns])
    asked = left.select(F.col(quoted(by)).alias("_k"), F.col(quoted(left_time)).cast("long").alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_best"), whole.alias("_row"))
    held = right.select(F.col(quoted(by)).alias("_k"), F.col(quoted(right_time)).cast("long").alias("_t"), F.lit(0).alias("_side"), best.alias("_best"), F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    both = asked.unionByName(held.filter("_k is not null and _t is not null")).withColumn("_spread", F.xxhash64("_row", "_best"))
    # The ranges are written once: a plan that is run again could draw other borders.
    ranged = both.repartitionByRange(n, "_k", "_t", "_side", "_spread").withColumn("_range", F.spark_partition_id()).drop("_spread")
    ranged, _ = stored(ranged)
    live = ranged.filter("_k is not null and _t is not null")
    ends = live.groupBy("_range", "_k").agg(F.max("_best").alias("_best"))
    before = F.max("_best").over(Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("_best", before).filter("_best is not null")
    carried = carried.select("_k", F.col("_best.t").alias("_t"), F.lit(0).alias("_side"), "_best", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), "_range")
    rows = live.unionByName(carried).repartitionById(n, "_range")
    order = Window.partitionBy("_range", "_k").orderBy("_t", "_side")
    rows = rows.withColumn("_chunk", ((F.row_number().over(order) - 1) / CHUNK).cast("long"))
    earlier = F.max("_best").over(Window.partitionBy("_range", "_k").orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1))
    within = F.max("_best").over(Window.partitionBy("_range", "_k", "_chunk").orderBy("_t").rangeBetween(-tolerance, Window.currentRow))
    rows = rows.withColumn("_earlier", earlier).withColumn("_within", within).filter("_side = 1")
    found = F.greatest("_within", F.when(F.col("_earlier.t") >= F.col("_t") - tolerance, F.col("_earlier")))
    rows = rows.select("_k", "_t", "_row", found.alias("_found"))
    counts = live.filter("_side = 0").groupBy("_k", F.col("_t").alias("_at")).agg(F.count("*").alias("_n"))
    # An unmatched row has no right row at its own time, so that time serves as a key that spreads.
    rows = rows.withColumn("_at", F.coalesce("_found.t", "_t")).join(counts, ["_k", "_at"], "left")
    apart = ranged.filter("_side = 1 and (_k is null or _t is null)").select("_row", F.lit(None).cast("long").alias("_t"), F.lit(None).cast(kind).alias("_found"), F.lit(0).cast("long").alias("_n"))
    rows = rows.select("_row", "_t", "_found", F.coalesce("_n", F.lit(0)).cast("long").alias("_n")).unionByName(apart)
    named = [F.col(f"_found.c{i}").alias(c) for i, c in enumerate([*ties, *payload])]
    return rows.select("_row.*", *named, (F.col("_t") - F.col("_found.t")).alias(lag), F.col("_n").alias(count))


def micros(column: str) -> F.Column:
    """Microseconds since 1970 of a timestamp without a zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {quoted(column)})")


def floored(hash_: F.Column, time: F.Column, step: int) -> F.Column:
    return F.when(hash_ % 2 == 1, time - F.pmod(time, F.lit(step))).otherwise(time)


def crc(column: str) -> F.Column:
    """crc32 of an identifier's decimal digits; of a null that of an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def clicks_with_orders(spark: SparkSession, clicks: DataFrame, sales: DataFrame, hours: int = 720) -> DataFrame:
    """Each click with its client's latest order of at most ``hours`` before: click_id, client_id, ts_us, sale_id, lag_us,
    total_cents, n_tied, priority.

    Copies of a click count once (of copies that differ the largest client and time count); clicks without an identifier
    are copies of each other. A total that is null or no finite number of cents below 2**53 has no cents.
    """
    once = clicks.groupBy("click_id").agg(F.max("client_id").alias("client_id"), F.max(micros("ts")).alias("ts_us"))
    once = once.withColumn("ts_us", floored(crc("click_id"), F.col("ts_us"), 6 * HOUR))
    cents = F.floor(100 * F.col("total") + 0.5)
    cents = F.when(F.abs(100 * F.col("total")) < 2.0**53, cents).cast("long")
    first = F.struct(F.col("sale_id").cast("long").alias("sale_id"), F.col("priority").cast("long").alias("priority"))
    second = F.struct((-1 - F.col("sale_id")).cast("long").alias("sale_id"), (6 - F.col("priority")).cast("long").alias("priority"))
    twice = F.when(crc("sale_id") % 3 != 0, F.array(first, second)).otherwise(F.array(first))
    orders = sales.select("client_id", floored(crc("sale_id"), micros("sold_at"), 6 * HOUR).alias("sold_us"), cents.alias("total_cents"), F.explode(twice).alias("o"))
    orders = orders.select("client_id", "sold_us", "total_cents", "o.*")
    return asof_join(once, orders, "client_id", "ts_us", "sold_us", hours * HOUR, ("total_cents", "sale_id"), ("priority",), lag="lag_us")
