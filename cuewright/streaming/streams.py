"""Structured Streaming variants of the time-stamped operators.

Sources are file streams; the query functions run them to completion with ``availableNow`` and read the sink again, so a
stream can be checked like a table. State is bounded by watermarks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import groups_sql, timed
from ..plans.registry import query
from ..sources.staging import DETECTIONS, as_detections
from .groups import grouped_detections, latest_groups, sliding_first, stateful


def event_stream(spark: SparkSession, sf_dir: str, watermark: str = "31 days") -> DataFrame:
    """Events as a stream with event time; the watermark admits as late rows as the files may hold."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(_folder(sf_dir))
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def _folder(sf_dir: str) -> str:
    # A stream reads a folder or a pattern; the pattern names the one table.
    return f"{sf_dir}/events.parq*"


def tumbling(stream: DataFrame, seconds: int = 4) -> DataFrame:
    """STM1: counts and sums in fixed windows."""
    return stream.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, gap: str = "1 hour") -> DataFrame:
    """STM2, simple case: runs of detections with gaps below ``gap``."""
    return stream.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))


def first_within(stream: DataFrame, *keys: str) -> DataFrame:
    """STM5: the first of equal keys within the watermark."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; where none is set, a session on one machine (tests) gets one."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "cuewright-streams")
    return base


def completed(spark: SparkSession, stream: DataFrame, mode: str = "complete", place: str | None = None) -> DataFrame:
    """Run the stream over all that is there now; in complete mode the result table, else the appended rows. With a
    ``place`` that has run before, it goes on from its checkpoint there."""
    place = place or f"{shared_folder(spark)}/s{uuid.uuid4().hex}"
    out = f"{place}/out"

    def put(batch: DataFrame, number: int) -> None:
        # A batch that is replayed writes the same folder again; in complete mode only the last table counts.
        batch.write.mode("overwrite").parquet(f"{out}/table" if mode == "complete" else f"{out}/batch-{number}")

    run = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(put).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(out)


@query(
    "stm1_tumbling",
    """SELECT event_type, (epoch_us(ts) // 4000000 * 4)::BIGINT AS start_s, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type, epoch_us(ts) // 4000000""",
)
def stm1_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = completed(spark, tumbling(event_stream(spark, sf_dir)))
    return done.select("event_type", F.unix_seconds("w.start").alias("start_s"), "n", F.round("total", 4).alias("total"))


@query(
    "stm2_sessions",
    """WITH l AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l) SELECT user_id, (epoch_us(min(ts)) // 1000)::BIGINT AS start_ms, count(*) AS n FROM s GROUP BY user_id, k""",
)
def stm2_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session windows alone, over a table: complete mode does not take them. ``stm2_grouped_detections`` is the stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(events).select("user_id", F.unix_millis("w.start").alias("start_ms"), "n")


@query(
    "stm3_stm5_first_within",
    "SELECT user_id, event_type FROM events GROUP BY user_id, event_type",
)
def stm3_stm5_first_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental run that appends the first of each pair."""
    stream = first_within(event_stream(spark, sf_dir, "3650 days"), "user_id", "event_type")
    return completed(spark, stream.select("user_id", "event_type"), "append")


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(_folder(sf_dir))
    return timed(as_detections(stream))


@query("stm2_grouped_detections", groups_sql(20, 1100, 6000, "[^a-z0-9]+", False, True))
def stm2_grouped_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM2: the groups of SEQ6 from a stream with keyed state."""
    with stateful(spark):
        done = completed(spark, grouped_detections(_detected(spark, sf_dir)), "append")
    return latest_groups(done).drop("closed")


@query(
    "stm5_sliding_first",
    f"""WITH {DETECTIONS}, d AS (SELECT stem, text AS key, list([struct_pack(at_ms := at_ms // 10000, seq := seq)] ORDER BY at_ms // 10000, seq) AS items FROM dets GROUP BY ALL),
f AS (SELECT stem, key, list_reduce(items, lambda acc, y: CASE WHEN y[1].at_ms - acc[len(acc)].at_ms > 20000 THEN list_append(acc, y[1]) ELSE acc END) AS kept FROM d)
SELECT stem, key, k.seq AS seq, k.at_ms AS at_ms FROM (SELECT stem, key, unnest(kept) AS k FROM f)""",
)
def stm5_sliding_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM5: of equal texts of a stem those not shown within 20 s after a kept one; the state goes with the watermark."""
    rows = _detected(spark, sf_dir).select("stem", F.col("text").alias("key"), "seq", F.col("start_ms").alias("at_ms"))
    with stateful(spark):
        return completed(spark, sliding_first(rows), "append")
