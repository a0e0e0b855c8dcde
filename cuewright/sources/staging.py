"""Cue, line and detection relations staged from the tables at hand, and the same as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import table


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as timed cues: stem, seq, speaker, text, start_cs, end_cs."""
    dur = F.greatest(F.lit(50).cast("long"), F.floor(F.length("text") * 100 / 15))
    gap = ((F.col("conv_id") * 7 + F.col("turn") * 13) % 9 - 2) * 20
    base = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem"), F.col("turn").alias("seq"), F.col("role").alias("speaker"), "text", dur.alias("dur"), gap.alias("gap"))
    before = Window.partitionBy("stem").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn("start_cs", F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(before), F.lit(0)).cast("long"))
    return base.select("stem", "seq", "speaker", "text", "start_cs", (F.col("start_cs") + F.col("dur")).cast("long").alias("end_cs"))


CUES = """base AS (SELECT conv_id AS stem, turn AS seq, role AS speaker, text, greatest(50::BIGINT, floor(length(text) * 100 / 15)::BIGINT) AS dur,
  ((conv_id * 7 + turn * 13) % 9 - 2) * 20 AS gap FROM conversations),
cues0 AS (SELECT *, coalesce(sum(dur + gap) OVER (PARTITION BY stem ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_cs FROM base),
cues AS (SELECT stem, seq, speaker, text, start_cs, (start_cs + dur)::BIGINT AS end_cs FROM cues0)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines: stem, seq, text."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("stem"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("seq", "text"))


LINES = r"""lines AS (SELECT doc_id AS stem, (unnest(range(1, len(parts) + 1)) - 1)::INTEGER AS seq, unnest(parts) AS text
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))"""


def as_detections(events: DataFrame) -> DataFrame:
    """Events as on-screen text detections: stem, seq, at_ms, text, confidence."""
    return events.select(F.col("user_id").alias("stem"), F.col("event_id").alias("seq"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), F.col("event_type").alias("text"), F.col("value").alias("confidence"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_detections(table(spark, sf_dir, "events"))


DETECTIONS = "dets AS (SELECT user_id AS stem, event_id AS seq, (epoch_us(ts) // 1000)::BIGINT AS at_ms, event_type AS text, value AS confidence FROM events)"
