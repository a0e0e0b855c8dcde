"""Scores of the two-state labelling: seeds and observations from audio-tag statistics of a cue.

Statistics columns are ``{group}_{peak|mean}`` for singing, singer_core, speech, conversation and vocal_music, in log
odds, with -999 where no window was touched. All rules are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_inline
from ..functions.values import clamp
from ..plans.registry import query
from ..sources.staging import CUES, cues
from .timeline import bridged, phrase_penalty, short_dialogue, tail_propagated, viterbi

GROUPS = ("singing", "singer_core", "speech", "conversation", "vocal_music")
# Thresholds and weights of the model.
CORE, SOFT, GENERIC, VOCAL = -2.45, -2.70, -2.10, -3.20
SEED_BONUS, BRIDGE_BONUS, BORDERLINE_BONUS = 1.10, 0.75, 0.45


def _s(name: str) -> Column:
    return F.col(name)


def seed(duration: Column, text: str = "text") -> Column:
    """SEQ3: struct(flag, reason); the first rule that holds."""
    core, generic = _s("singer_core_peak") >= CORE, (_s("singing_peak") >= GENERIC) & (_s("singer_core_peak") >= -3.0)
    soft = (_s("singer_core_mean") >= SOFT) & (_s("vocal_music_peak") >= VOCAL) & (_s("conversation_peak") <= -5.0) & (_s("speech_peak") <= -3.4)
    reason = (
        F.when(duration < 1.8, "too_short")
        .when(short_dialogue(F.round(duration * 100), text), "short_dialogue")
        .when(_s("conversation_peak") > -4.2, "conversation_peak")
        .when((_s("speech_peak") > -2.3) & (_s("singer_core_peak") < -1.75), "speech_peak")
        .when(core, "strong_singer_core")
        .when(generic, "strong_generic_singing")
        .when(soft, "soft_core_with_vocal_support")
        .otherwise("below_threshold")
    )
    return F.struct(reason.isin("strong_singer_core", "strong_generic_singing", "soft_core_with_vocal_support").alias("flag"), reason.alias("reason"))


def can_bridge(duration: Column, text: str = "text") -> Column:
    return (duration >= 2.0) & ~short_dialogue(F.round(duration * 100), text) & (_s("conversation_peak") <= -4.4) & ((_s("singer_core_peak") >= -2.95) | (_s("singer_core_mean") >= -3.0))


def borderline(duration: Column, speakers: Column, text: str = "text") -> Column:
    sung = (_s("singer_core_peak") >= -3.05) | (_s("singing_peak") >= -2.65) | ((_s("singer_core_mean") >= -3.15) & (_s("vocal_music_peak") >= VOCAL))
    spoken = (_s("conversation_peak") > -4.25) | ((_s("speech_peak") > -2.15) & (_s("singer_core_peak") < -2.15))
    return ~short_dialogue(F.round(duration * 100), text) & (speakers <= 2) & ~spoken & sung


def _over(name: str, limit: float, scale: float, most: float, weight: float) -> Column:
    """Penalty of a statistic above a limit."""
    return F.when(_s(name) > limit, clamp((_s(name) - limit) / scale, 0.0, most) * weight).otherwise(0.0)


def observation(duration: Column, speakers: Column, seeded: Column, bridge: Column, text: str = "text") -> Column:
    """SEQ2: the emission of music. Cues whose five peaks are all 0 are judged by their means."""
    t = normalize_inline(text)
    words = F.size(F.filter(F.split(t, " "), lambda w: w != ""))
    unlikely = (
        F.when(duration < 1.8, 3.25).otherwise(0.0) + F.when(t.endswith("?"), 3.0).otherwise(0.0)
        + F.when(words <= 2, 2.4).when(words <= 3, 1.7).when((words <= 4) & (duration < 3.2), 1.0).otherwise(0.0)
        + phrase_penalty(text) + F.when(speakers > 2, 0.8).otherwise(0.0)
    )
    bridged = F.when(bridge, BRIDGE_BONUS).otherwise(0.0)
    near = lambda name, at, scale, most, weight: clamp((_s(name) - at) / scale, -most, most) * weight
    quiet = (
        F.lit(-0.45) + near("singer_core_mean", SOFT, 0.85, 2.5, 1.40) + near("singing_mean", SOFT, 0.85, 2.0, 0.70) + near("vocal_music_mean", VOCAL, 1.20, 1.5, 0.35)
        - _over("conversation_mean", -4.20, 1.0, 4.0, 1.10) - _over("speech_mean", -2.60, 0.90, 3.5, 0.85)
        + F.when((duration >= 3.0) & (words >= 6) & (_s("conversation_mean") <= -3.80) & (_s("speech_mean") <= -3.00), 0.40).otherwise(0.0)
        + F.when((duration >= 8.0) & (words >= 8) & (_s("conversation_mean") <= -4.20) & (_s("speech_mean") <= -3.20), 0.60).otherwise(0.0)
    )
    spoken = _over("conversation_peak", -4.25, 1.0, 4.0, 1.05) + _over("speech_peak", -2.30, 0.90, 3.5, 0.80) + _over("conversation_mean", -4.40, 1.2, 2.0, 0.45)
    strong = (_s("singer_core_peak") >= -1.75) | (_s("singing_peak") >= -1.65)
    loud = (
        F.lit(-0.35) + near("singer_core_peak", CORE, 0.70, 3.0, 1.70) + near("singing_peak", GENERIC, 0.80, 2.5, 0.85) + near("singer_core_mean", SOFT, 0.85, 2.5, 0.95) + near("vocal_music_peak", VOCAL, 1.20, 1.5, 0.35)
        - spoken * F.when(strong, 0.45).otherwise(1.0)
        + F.when(seeded, SEED_BONUS).otherwise(0.0) + F.when(borderline(duration, speakers, text) | can_bridge(duration, text), BORDERLINE_BONUS).otherwise(0.0)
    )
    silent = F.lit(True)
    for g in GROUPS:
        silent = silent & (F.abs(_s(f"{g}_peak")) < 0.0001)
    return F.when(silent, quiet).otherwise(loud) - unlikely + bridged


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues with statistics made from their place; each ninth cue is silent."""
    made = {f"{g}_{k}": F.when((F.col("seq") + F.col("stem")) % 9 == 0, F.lit(0.0) if k == "peak" else F.lit(-3.0 - i)).otherwise(((F.col("stem") * 31 + F.col("seq") * 17 + i * 137 + j * 53) % 700) / 100.0 - 7.0) for i, g in enumerate(GROUPS) for j, k in enumerate(("peak", "mean"))}
    return cues(spark, sf_dir).withColumns(made).withColumn("duration", (F.col("end_cs") - F.col("start_cs")) / 100.0)


_MADE = ", ".join(f"CASE WHEN (seq + stem) % 9 = 0 THEN {'0.0' if k == 'peak' else f'{-3.0 - i}'}::DOUBLE ELSE ((stem * 31 + seq * 17 + {i * 137 + j * 53}) % 700) / 100.0::DOUBLE - 7.0 END AS {g}_{k}" for i, g in enumerate(GROUPS) for j, k in enumerate(("peak", "mean")))


@query(
    "seq3_seed",
    rf"""WITH {CUES}, s AS (SELECT *, {_MADE}, (end_cs - start_cs) / 100.0::DOUBLE AS duration, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM cues),
n AS (SELECT *, len(list_filter(string_split(x, ' '), lambda w: w <> '')) AS n, end_cs - start_cs AS d FROM s)
SELECT stem, seq, CASE WHEN duration < 1.8 THEN 'too_short' WHEN x = '' OR x LIKE '%?' OR d < 100 OR (d < 220 AND n <= 4) OR (x LIKE '%!' AND d < 240) THEN 'short_dialogue' WHEN conversation_peak > -4.2 THEN 'conversation_peak'
  WHEN speech_peak > -2.3 AND singer_core_peak < -1.75 THEN 'speech_peak' WHEN singer_core_peak >= -2.45 THEN 'strong_singer_core' WHEN singing_peak >= -2.1 AND singer_core_peak >= -3 THEN 'strong_generic_singing'
  WHEN singer_core_mean >= -2.7 AND vocal_music_peak >= -3.2 AND conversation_peak <= -5 AND speech_peak <= -3.4 THEN 'soft_core_with_vocal_support' ELSE 'below_threshold' END AS reason FROM n""",
)
def seq3_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).select("stem", "seq", seed(F.col("duration"))["reason"].alias("reason"))


@query("seq2_observation")
def seq2_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with seeds and bridges as the labelling uses them."""
    frame = _stats(spark, sf_dir).withColumn("seed", seed(F.col("duration"))["flag"])
    frame = bridged(frame, "seed").withColumn("bridge", F.col("bridge") & can_bridge(F.col("duration")))
    return frame.select("stem", "seq", F.round(observation(F.col("duration"), F.lit(1), F.col("seed"), F.col("bridge")), 6).alias("score"))


@query("seq1_seq4_music_labels")
def seq1_seq4_music_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole labelling: seeds, bridges, observations, best path, tails."""
    frame = _stats(spark, sf_dir).withColumn("seed", seed(F.col("duration"))["flag"])
    frame = bridged(frame, "seed").withColumn("bridge", F.col("bridge") & can_bridge(F.col("duration")))
    frame = frame.withColumn("score", F.bround(observation(F.col("duration"), F.lit(1), F.col("seed"), F.col("bridge")) * 100).cast("long"))
    labelled = frame.join(viterbi(frame, "score"), ["stem", "seq"])
    words = F.size(F.filter(F.split(normalize_inline("text"), " "), lambda w: w != ""))
    sung = (F.col("speech_peak") <= -2.30) & (F.col("conversation_mean") <= -3.35) & ((F.col("singing_peak") >= -2.20) | (F.col("singer_core_peak") >= -2.20))
    labelled = labelled.withColumn("cand", (words >= 4) & sung & ~short_dialogue(F.col("end_cs") - F.col("start_cs")))
    return tail_propagated(labelled, "is_music", "cand").select("stem", "seq", "is_music", "tail")
