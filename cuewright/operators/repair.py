"""Repair of screen texts that are shown too long, from the detections that they were made of."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import text_key, text_key_ascii
from ..plans.registry import query
from ..sources.staging import detections
from .dedupe import ocr_similarity
from .joins import interval_join
from .rules import best_detections
from .timeline import OCR_STYLE, gap_clusters, rebuilt
from .tracks import nearest_translation


@F.pandas_udf(DoubleType())
def screen_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """STR22 of each pair."""
    return pd.Series([ocr_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def similar_detections(items: DataFrame, found: DataFrame, reach_ms: int = 200, least: float = 0.74) -> DataFrame:
    """Detections within reach of an item's times that read like its source: keys under 3 characters only if equal."""
    in_ms = items.select("stem", "event", F.lower("source").alias("source"), (F.col("start_cs") * 10).alias("start_cs"), (F.col("end_cs") * 10).alias("end_cs"))
    seen = found.select("stem", "seq", "text", "confidence", "x", "y", F.col("start_ms").alias("start_cs"), F.col("end_ms").alias("end_cs"))
    met = interval_join(in_ms, seen, reach=reach_ms, bucket=10_000).withColumns({"_a": text_key_ascii("source"), "_b": text_key_ascii("r_text")})
    short = F.least(F.length("_a"), F.length("_b")) < 3
    met = met.filter(~short | ((F.col("_a") == F.col("_b")) & (F.col("_a") != ""))).withColumn("similarity", screen_ratio("source", "r_text")).filter(short | (F.col("similarity") >= least))
    frame = (F.round(F.col("r_start_cs") / 10) * 10).cast("long")
    return met.select("stem", "event", frame.alias("frame_ms"), F.col("r_seq").cast("long").alias("ordinal"), "similarity", F.col("r_confidence").alias("confidence"), F.col("r_x").alias("x"), F.col("r_y").alias("y"))


def repaired(events: DataFrame, items: DataFrame, found: DataFrame, long_cs: int = 800, fallback_cs: int = 600) -> DataFrame:
    """SEQ11: screen texts shown longer than ``long_cs`` are shown again as the pieces that their item's detections make
    (JOIN14, JOIN15, SEQ9, SEQ10), or for ``fallback_cs`` where there is no item or no piece; other events stay.

    ``events``: stem, seq, style, text, start_cs, end_cs; ``items``: stem, seq, start_cs, end_cs, zh, source; ``found``:
    stem, seq, text, confidence, start_ms, end_ms, x, y. Result: stem, seq, piece (from 1), start_cs, end_cs, status (kept,
    rebuilt, fallback) and the seq of the detection that gives a piece its place.
    """
    long = (F.col("style") == OCR_STYLE) & (F.col("end_cs") - F.col("start_cs") > long_cs)
    asked = events.filter(long)
    sought = asked.select("stem", "seq", "start_cs", "end_cs", text_key("text").alias("text"))
    match = nearest_translation(sought, items.select("stem", "seq", "start_cs", "end_cs", text_key("zh").alias("text"))).select("stem", F.col("seq").alias("event"), F.col("r_seq").alias("item"))
    wanted = asked.select("stem", F.col("seq").alias("event"), "start_cs", "end_cs").join(match, ["stem", "event"]).join(items.select("stem", F.col("seq").alias("item"), "source"), ["stem", "item"])
    best = best_detections(similar_detections(wanted, found), "stem", "event").select("stem", "event", F.col("ordinal").alias("seq"))
    pieces = rebuilt(gap_clusters(best.join(found, ["stem", "seq"]), keys=("stem", "event")), ("stem", "event"))
    centis = lambda c: F.floor(F.col(c) / 10).cast("long")
    made = pieces.select("stem", F.col("event").alias("seq"), "piece", centis("start_ms").alias("_start"), centis("end_ms").alias("_end"), "representative")
    status = F.when(~F.coalesce(long, F.lit(False)), "kept").when(F.col("piece").isNull(), "fallback").otherwise("rebuilt")
    cut = F.when(status == "fallback", F.least("end_cs", F.col("start_cs") + fallback_cs)).otherwise(F.col("end_cs"))
    return events.join(made, ["stem", "seq"], "left").select(
        "stem", "seq", F.coalesce("piece", F.lit(1)).alias("piece"), F.coalesce("_start", "start_cs").alias("start_cs"), F.coalesce("_end", cut).alias("end_cs"), status.alias("status"), "representative"
    )


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events of 20 s of equal texts in a stem, their items (none for each seventh), and the detections."""
    at = F.floor(F.col("at_ms") / 20_000).cast("long")
    found = detections(spark, sf_dir).select("stem", "seq", "text", "confidence", at.alias("start_ms"), (at + 900).alias("end_ms"), (F.col("seq") * 37 % 640).cast("double").alias("x"), (F.col("seq") * 91 % 360).cast("double").alias("y"))
    slot = F.floor(F.col("start_ms") / 20_000)
    times = [F.floor(F.min("start_ms") / 10).cast("long").alias("start_cs"), F.floor(F.max("end_ms") / 10).cast("long").alias("end_cs")]
    events = found.groupBy("stem", "text", slot.alias("slot")).agg(F.min("seq").alias("seq"), *times).select("stem", "seq", F.when(F.col("seq") % 11 == 0, "BILINGUAL").otherwise(OCR_STYLE).alias("style"), "text", "start_cs", "end_cs")
    items = events.filter("seq % 7 <> 0").select("stem", "seq", "start_cs", "end_cs", F.col("text").alias("zh"), F.col("text").alias("source"))
    return events, items, found


@query("seq11_repair")
def seq11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(*staged(spark, sf_dir))
