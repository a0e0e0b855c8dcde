"""Ordered operators over cues: collision trimming, context windows, runs, batches, two-state Viterbi labelling.

Everything is confined to a stem, so windows partition by it; folds run over one stem's cues as arrays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.text import normalize_inline, text_key
from ..plans.registry import query
from ..sources.staging import CUES, DETECTIONS, cues, detections


def by_time() -> WindowSpec:
    return Window.partitionBy("stem").orderBy("start_cs", "end_cs", "seq")


def in_order() -> WindowSpec:
    return Window.partitionBy("stem").orderBy("seq")


def trimmed_end(start: Column, end: Column, following: Column, least: int = 50, gap: int = 3, floor: int = 12) -> Column:
    """WIN2: at least ``least``; cut to ``gap`` before the following start, but not below ``floor``."""
    long = F.greatest(end, start + least)
    return F.when(following.isNotNull() & (long > following - gap), F.greatest(start + floor, following - gap)).otherwise(long)


def collision_trim(frame: DataFrame) -> DataFrame:
    """WIN2: shown_end_cs of each cue, from the next cue in time order."""
    return frame.withColumn("shown_end_cs", trimmed_end(F.col("start_cs"), F.col("end_cs"), F.lead("start_cs").over(by_time())))


@query(
    "win2_collision_trim",
    f"""WITH {CUES}, w AS (SELECT *, lead(start_cs) OVER (PARTITION BY stem ORDER BY start_cs, end_cs, seq) AS nxt, greatest(end_cs, start_cs + 50) AS e FROM cues)
SELECT stem, seq, start_cs, end_cs, (CASE WHEN nxt IS NOT NULL AND e > nxt - 3 THEN greatest(start_cs + 12, nxt - 3) ELSE e END)::BIGINT AS shown_end_cs FROM w""",
)
def win2_collision_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_trim(cues(spark, sf_dir)).select("stem", "seq", "start_cs", "end_cs", F.col("shown_end_cs").cast("long").alias("shown_end_cs"))


# The styles of spoken and sung events, of screen texts and of notes.
BASE_STYLES, OCR_STYLE, NOTE_STYLE = ["BILINGUAL", "BILINGUAL_MUSIC", "BILINGUAL_CHANT"], "OCR_TRANSLATION", "EXPLANATION_NOTE"


def event_quality(frame: DataFrame, traditional: str = "") -> DataFrame:
    """AGG1 with WIN1, per stem: events by style; of the base styles those that begin before the one before them in file
    order ends, those of more than two lines, and those whose first line has more than 38 or second more than 96
    characters; ``traditional`` characters in all texts."""
    line = F.split("text", "\n")
    seen = frame.withColumn("_base", F.coalesce(F.col("style").isin(BASE_STYLES), F.lit(False)))
    seen = seen.withColumn("_before", F.lag("end_cs").over(Window.partitionBy("stem", "_base").orderBy("seq")))
    base = F.col("_base")
    hits = F.length(F.regexp_replace("text", f"[^{traditional}]", "")) if traditional else F.lit(0)
    return seen.groupBy("stem").agg(
        F.count("*").alias("events"),
        F.count_if(base).alias("base"),
        F.count_if(F.col("style") == OCR_STYLE).alias("ocr"),
        F.count_if(F.col("style") == NOTE_STYLE).alias("notes"),
        F.count_if(base & (F.col("start_cs") < F.col("_before"))).alias("overlapping"),
        F.count_if(base & (F.size(line) > 2)).alias("many_lines"),
        F.count_if(base & ((F.length(line[0]) > 38) | (F.coalesce(F.length(F.get(line, F.lit(1))), F.lit(0)) > 96))).alias("very_long"),
        F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("traditional"),
        F.sum(F.col("end_cs") - F.col("start_cs")).alias("shown_cs"),
    )


@query(
    "win1_agg1_event_quality",
    f"""WITH {CUES}, s AS (SELECT stem, seq, start_cs, end_cs, CASE seq % 5 WHEN 2 THEN 'BILINGUAL_MUSIC' WHEN 3 THEN 'OCR_TRANSLATION' WHEN 4 THEN 'EXPLANATION_NOTE' ELSE 'BILINGUAL' END AS style,
  CASE seq % 3 WHEN 0 THEN left(text, 60) || chr(10) || text WHEN 1 THEN '開門' || chr(10) || text ELSE '好國國' END AS text FROM cues),
w AS (SELECT *, style LIKE 'BILINGUAL%' AS base, lag(end_cs) OVER (PARTITION BY stem, style LIKE 'BILINGUAL%' ORDER BY seq) AS prv, string_split(text, chr(10)) AS ls FROM s)
SELECT stem, count(*) AS events, count_if(base)::BIGINT AS base, count_if(style = 'OCR_TRANSLATION')::BIGINT AS ocr, count_if(style = 'EXPLANATION_NOTE')::BIGINT AS notes, count_if(base AND start_cs < prv)::BIGINT AS overlapping,
  count_if(base AND len(ls) > 2)::BIGINT AS many_lines, count_if(base AND (length(ls[1]) > 38 OR coalesce(length(ls[2]), 0) > 96))::BIGINT AS very_long, sum(length(regexp_replace(text, '[^開門國]', '', 'g')))::BIGINT AS traditional,
  sum(end_cs - start_cs)::BIGINT AS shown_cs FROM w GROUP BY stem""",
)
def win1_agg1_event_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, m, t = F.col("seq") % 5, F.col("seq") % 3, F.col("text")
    style = F.when(k == 2, "BILINGUAL_MUSIC").when(k == 3, OCR_STYLE).when(k == 4, NOTE_STYLE).otherwise("BILINGUAL")
    shown = F.when(m == 0, F.concat(F.substring(t, 1, 60), F.lit("\n"), t)).when(m == 1, F.concat(F.lit("開門\n"), t)).otherwise("好國國")
    return event_quality(cues(spark, sf_dir).withColumns({"style": style, "text": shown}), "開門國")


@query(
    "agg2_quality_rollup",
    f"""WITH {CUES} SELECT speaker, (stem % 4)::BIGINT AS shard, count(*) AS events, sum(end_cs - start_cs)::BIGINT AS shown_cs
FROM cues GROUP BY ROLLUP (speaker, stem % 4)""",
)
def agg2_quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per group and in total in one pass."""
    frame = cues(spark, sf_dir).withColumn("shard", F.col("stem") % 4)
    return frame.rollup("speaker", "shard").agg(F.count("*").alias("events"), F.sum(F.col("end_cs") - F.col("start_cs")).alias("shown_cs"))


def context(frame: DataFrame, k: int = 4) -> DataFrame:
    """WIN3: the k texts before and behind each cue that has one."""
    filled = frame.filter(normalize_inline("text") != "")
    return filled.withColumns({
        "before": F.array_join(F.collect_list("seq").over(in_order().rowsBetween(-k, -1)), ","),
        "behind": F.array_join(F.collect_list("seq").over(in_order().rowsBetween(1, k)), ","),
    })


@query(
    "win3_context",
    f"""WITH {CUES} SELECT stem, seq, coalesce(string_agg(seq::VARCHAR, ',') OVER (PARTITION BY stem ORDER BY seq ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(seq::VARCHAR, ',') OVER (PARTITION BY stem ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), '') AS behind
FROM cues WHERE trim(text) <> ''""",
)
def win3_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(cues(spark, sf_dir)).select("stem", "seq", "before", "behind")


def bridged(frame: DataFrame, seed: str, gap_cs: int = 250) -> DataFrame:
    """WIN4: a cue between two seeds at most ``gap_cs`` off on both sides."""
    return frame.withColumn(
        "bridge",
        ~F.col(seed)
        & F.coalesce(F.lag(seed).over(in_order()), F.lit(False))
        & F.coalesce(F.lead(seed).over(in_order()), F.lit(False))
        & (F.col("start_cs") - F.lag("end_cs").over(in_order()) <= gap_cs)
        & (F.lead("start_cs").over(in_order()) - F.col("end_cs") <= gap_cs),
    ).withColumn("bridge", F.coalesce("bridge", F.lit(False)))


_SEED_SQL = "(length(text) % 3 = 0)"


@query(
    "win4_bridge",
    f"""WITH {CUES}, s AS (SELECT *, {_SEED_SQL} AS seed FROM cues),
w AS (SELECT *, lag(seed) OVER o AS ps, lead(seed) OVER o AS ns, lag(end_cs) OVER o AS pe, lead(start_cs) OVER o AS nb FROM s WINDOW o AS (PARTITION BY stem ORDER BY seq))
SELECT stem, seq, coalesce(NOT seed AND ps AND ns AND start_cs - pe <= 250 AND nb - end_cs <= 250, false) AS bridge FROM w""",
)
def win4_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridged(cues(spark, sf_dir).withColumn("seed", F.length("text") % 3 == 0), "seed").select("stem", "seq", "bridge")


def continuity(frame: DataFrame, flag: str, gap_cs: int = 320) -> DataFrame:
    """WIN5: both neighbours flagged, one speaker throughout, gaps at most ``gap_cs``."""
    near = (F.col("start_cs") - F.lag("end_cs").over(in_order()) <= gap_cs) & (F.lead("start_cs").over(in_order()) - F.col("end_cs") <= gap_cs)
    same = (F.lag("speaker").over(in_order()) == F.col("speaker")) & (F.lead("speaker").over(in_order()) == F.col("speaker")) & (F.col("speaker") != "")
    return frame.withColumn("continuity", F.coalesce(F.lag(flag).over(in_order()) & F.lead(flag).over(in_order()) & near & same, F.lit(False)))


@query(
    "win5_continuity",
    f"""WITH {CUES}, s AS (SELECT *, length(text) % 2 = 0 AS flag, CASE WHEN seq % 5 < 4 THEN 'a' ELSE speaker END AS who FROM cues),
w AS (SELECT *, lag(flag) OVER o AS pf, lead(flag) OVER o AS nf, lag(who) OVER o AS pw, lead(who) OVER o AS nw, lag(end_cs) OVER o AS pe, lead(start_cs) OVER o AS nb FROM s WINDOW o AS (PARTITION BY stem ORDER BY seq))
SELECT stem, seq, coalesce(pf AND nf AND pw = who AND nw = who AND who <> '' AND start_cs - pe <= 320 AND nb - end_cs <= 320, false) AS continuity FROM w""",
)
def win5_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cues(spark, sf_dir).withColumn("flag", F.length("text") % 2 == 0).withColumn("speaker", F.when(F.col("seq") % 5 < 4, F.lit("a")).otherwise(F.col("speaker")))
    return continuity(frame, "flag").select("stem", "seq", "continuity")


# Two-state Viterbi. Fixed values of the model: start, switches, stays, in hundredths so that sums are exact.
START, TO_MUSIC, TO_SPEECH, NEARBY = -135, -155, -105, 15
SAME_SPEAKER, NEAR, LONG, ELSE, CHANGED = 115, 35, -140, -45, -35


def _move(state: int, to: int, gap: Column, same: Column, changed: Column) -> Column:
    """Transition score between speech (0) and music (1), from the gap and the speakers."""
    if (state, to) == (0, 0):
        return F.lit(0).cast("long")
    if (state, to) == (0, 1):
        return (F.lit(TO_MUSIC) + F.when(gap <= 250, NEARBY).otherwise(0)).cast("long")
    if (state, to) == (1, 0):
        return (F.lit(TO_SPEECH) + F.when(gap > 320, NEARBY).otherwise(0)).cast("long")
    stay = F.when((gap <= 320) & same, SAME_SPEAKER).when(gap <= 250, NEAR).when(gap > 800, LONG).otherwise(ELSE)
    return (stay + F.when(changed, CHANGED).otherwise(0)).cast("long")


def viterbi(frame: DataFrame, score: str) -> DataFrame:
    """SEQ1: the best path of music flags per stem; ``score`` is the music emission in hundredths, speech emits 0.

    One fold over the stem's ordered cues carries both states' totals and the back pointers; a second one over the
    pointers in reverse reads the path. Ties stay in state 0, at every step and at the end.
    """
    item = F.struct("seq", F.col(score).cast("long").alias("score"), "start_cs", "end_cs", F.coalesce("speaker", F.lit("")).alias("who"))
    stems = frame.groupBy("stem").agg(F.array_sort(F.collect_list(item)).alias("items"))
    i = F.col("items")
    zero = F.struct(
        F.lit(0).cast("long").alias("t0"),
        (i[0]["score"] + START).cast("long").alias("t1"),
        i[0]["end_cs"].alias("end"),
        i[0]["who"].alias("who"),
        F.array().cast("array<struct<b0:int,b1:int>>").alias("back"),
    )

    def step(acc: Column, x: Column) -> Column:
        gap = F.greatest(F.lit(0).cast("long"), x["start_cs"] - acc["end"])
        known = (acc["who"] != "") & (x["who"] != "")
        same, changed = known & (acc["who"] == x["who"]), known & (acc["who"] != x["who"])
        value = {(a, b): acc[f"t{a}"] + _move(a, b, gap, same, changed) for a in (0, 1) for b in (0, 1)}
        from1 = {b: value[1, b] > value[0, b] for b in (0, 1)}
        return F.struct(
            F.when(from1[0], value[1, 0]).otherwise(value[0, 0]).alias("t0"),
            (F.when(from1[1], value[1, 1]).otherwise(value[0, 1]) + x["score"]).alias("t1"),
            x["end_cs"].alias("end"),
            x["who"].alias("who"),
            F.array_append(acc["back"], F.struct(from1[0].cast("int").alias("b0"), from1[1].cast("int").alias("b1"))).alias("back"),
        )

    run = stems.withColumn("run", F.aggregate(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1))), zero, step))
    last = F.when(F.col("run.t1") > F.col("run.t0"), 1).otherwise(0)
    path = F.aggregate(
        F.reverse("run.back"),
        F.array(last),
        lambda acc, b: F.array_append(acc, F.when(F.element_at(acc, -1) == 1, b["b1"]).otherwise(b["b0"])),
    )
    flags = run.select("stem", F.arrays_zip(F.col("items.seq").alias("seq"), F.reverse(path).alias("state")).alias("z"))
    return flags.select("stem", F.inline("z")).select("stem", "seq", (F.col("state") == 1).alias("is_music"))


def _step_sql(to: int) -> str:
    gap = "greatest(0, c.start_cs - v.e)"
    if to == 0:
        return f"v.t0, v.t1 + {TO_SPEECH} + CASE WHEN {gap} > 320 THEN {NEARBY} ELSE 0 END"
    stay = f"CASE WHEN {gap} <= 320 AND v.who = c.speaker THEN {SAME_SPEAKER} WHEN {gap} <= 250 THEN {NEAR} WHEN {gap} > 800 THEN {LONG} ELSE {ELSE} END + CASE WHEN v.who <> c.speaker THEN {CHANGED} ELSE 0 END"
    return f"v.t0 + {TO_MUSIC} + CASE WHEN {gap} <= 250 THEN {NEARBY} ELSE 0 END, v.t1 + {stay}"


_SCORE_SQL = "((length(text) * 37 + seq * 101) % 700 - 300)"


@query(
    "seq1_viterbi",
    f"""WITH RECURSIVE {CUES}, n AS (SELECT *, {_SCORE_SQL}::BIGINT AS score, row_number() OVER (PARTITION BY stem ORDER BY seq) AS i, count(*) OVER (PARTITION BY stem) AS m FROM cues),
v(stem, i, t0, t1, b0, b1, e, who) AS (
  SELECT stem, i, 0::BIGINT, score + {START}, 0, 0, end_cs, speaker FROM n WHERE i = 1
  UNION ALL
  SELECT c.stem, c.i, greatest({_step_sql(0)}), greatest({_step_sql(1)}) + c.score,
    CASE WHEN {_step_sql(0).split(", ", 1)[1]} > {_step_sql(0).split(", ", 1)[0]} THEN 1 ELSE 0 END,
    CASE WHEN {_step_sql(1).split(" END, ", 1)[1]} > {_step_sql(1).split(" END, ", 1)[0]} END THEN 1 ELSE 0 END, c.end_cs, c.speaker
  FROM v JOIN n c ON c.stem = v.stem AND c.i = v.i + 1),
b(stem, i, s) AS (
  SELECT v.stem, v.i, CASE WHEN t1 > t0 THEN 1 ELSE 0 END FROM v JOIN (SELECT stem, max(i) AS m FROM n GROUP BY stem) l ON l.stem = v.stem AND l.m = v.i
  UNION ALL
  SELECT v.stem, v.i - 1, CASE WHEN b.s = 1 THEN v.b1 ELSE v.b0 END FROM b JOIN v ON v.stem = b.stem AND v.i = b.i WHERE v.i > 1)
SELECT n.stem, n.seq, b.s = 1 AS is_music FROM n JOIN b USING (stem, i)""",
)
def seq1_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cues(spark, sf_dir).withColumn("score", (F.length("text") * 37 + F.col("seq") * 101) % 700 - 300)
    return viterbi(frame, "score")


def tail_propagated(frame: DataFrame, flag: str, candidate: str) -> DataFrame:
    """SEQ4: a candidate right behind a flagged cue becomes flagged, and passes it on.

    That is: the last row before that is flagged by itself has only candidates behind it up to here, a running maximum.
    """
    at = F.row_number().over(in_order())
    upto = in_order().rowsBetween(Window.unboundedPreceding, 0)
    ranked = frame.withColumn("_at", at)
    ranked = ranked.withColumn("_on", F.max(F.when(F.col(flag), F.col("_at"))).over(upto)).withColumn("_off", F.max(F.when(~F.col(flag) & ~F.col(candidate), F.col("_at"))).over(upto))
    return ranked.withColumn("tail", F.coalesce(F.col("_on") > F.coalesce("_off", F.lit(0)), F.lit(False))).drop("_at", "_on", "_off")


@query(
    "seq4_tail_propagation",
    f"""WITH RECURSIVE {CUES}, n AS (SELECT *, length(text) % 5 = 0 AS flag, length(text) % 2 = 0 AS cand, row_number() OVER (PARTITION BY stem ORDER BY seq) AS i FROM cues),
f(stem, i, tail) AS (SELECT stem, i, flag FROM n WHERE i = 1 UNION ALL SELECT n.stem, n.i, n.flag OR (n.cand AND f.tail) FROM f JOIN n ON n.stem = f.stem AND n.i = f.i + 1)
SELECT n.stem, n.seq, f.tail FROM n JOIN f USING (stem, i)""",
)
def seq4_tail_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cues(spark, sf_dir).withColumn("flag", F.length("text") % 5 == 0).withColumn("cand", F.length("text") % 2 == 0)
    return tail_propagated(frame, "flag", "cand").select("stem", "seq", "tail")


def run_carry(frame: DataFrame, music: str, italic: str, gap_cs: int = 125) -> DataFrame:
    """SEQ5: italics directly behind music, and behind each other, belong to the lyric."""
    near = F.col("start_cs") - F.lag("end_cs").over(in_order()) <= gap_cs
    state = F.when(F.col(music), True).when(~(F.col(italic) & F.coalesce(near, F.lit(False))), False)
    marked = frame.withColumn("_state", state).withColumn("_near", F.coalesce(near, F.lit(False)))
    active = F.last("_state", ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, -1))
    return marked.withColumn("lyric", F.col(music) | (F.col(italic) & F.col("_near") & F.coalesce(active, F.lit(False)))).drop("_state", "_near")


@query(
    "seq5_run_carry",
    f"""WITH {CUES}, n AS (SELECT *, length(text) % 4 = 0 AS music, length(text) % 3 > 0 AS italic, coalesce(start_cs - lag(end_cs) OVER (PARTITION BY stem ORDER BY seq) <= 125, false) AS near FROM cues),
m AS (SELECT *, CASE WHEN music THEN true WHEN NOT (italic AND near) THEN false END AS state FROM n),
a AS (SELECT *, last_value(state IGNORE NULLS) OVER (PARTITION BY stem ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS active FROM m)
SELECT stem, seq, music OR (italic AND near AND coalesce(active, false)) AS lyric FROM a""",
)
def seq5_run_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cues(spark, sf_dir).withColumn("music", F.length("text") % 4 == 0).withColumn("italic", F.length("text") % 3 > 0)
    return run_carry(frame, "music", "italic").select("stem", "seq", "lyric")


def gap_clusters(frame: DataFrame, gap_ms: int = 2250, jump: float = 420.0, keys: tuple[str, ...] = ("stem",)) -> DataFrame:
    """SEQ9: a cluster ends where the next detection begins more than the gap after this one's end, or its centre is more
    than ``jump`` pixels off; unknown centres have not jumped. ``frame``: keys, seq, start_ms, end_ms, x, y."""
    by = Window.partitionBy(*keys).orderBy("start_ms", "seq")
    lag = lambda c: F.lag(c).over(by)
    far = F.coalesce(F.hypot(F.col("x") - lag("x"), F.col("y") - lag("y")) > jump, F.lit(False))
    new = F.coalesce((F.col("start_ms") - lag("end_ms") > gap_ms) | far, F.lit(True)).cast("long")
    return frame.withColumn("cluster", F.sum(new).over(by.rowsBetween(Window.unboundedPreceding, 0)))


def representative() -> Column:
    """The detection of the greatest confidence, then the longest key, then the first."""
    return F.max_by("seq", F.struct("confidence", F.length(text_key("text")), -F.col("start_ms"), -F.col("seq")))


def _placed(spark: SparkSession, sf_dir: str, scale: int) -> DataFrame:
    at = F.floor(F.col("at_ms") / scale).cast("long")
    return detections(spark, sf_dir).select("stem", "seq", at.alias("start_ms"), (at + 500).alias("end_ms"), "text", "confidence", (F.col("seq") * 37 % 640).cast("double").alias("x"), (F.col("seq") * 91 % 360).cast("double").alias("y"))


def _clusters_sql(scale: int, gap: int) -> str:
    return f"""{DETECTIONS}, d AS (SELECT stem, seq, (at_ms // {scale})::BIGINT AS s, (at_ms // {scale})::BIGINT + 500 AS e, length(regexp_replace(lower(text), '[^a-z0-9一-鿿]+', '', 'g')) AS k, confidence, (seq * 37 % 640)::DOUBLE AS x, (seq * 91 % 360)::DOUBLE AS y FROM dets),
o AS (SELECT *, CASE WHEN s - lag(e) OVER w <= {gap} AND sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) <= 420 THEN 0 ELSE 1 END AS new FROM d WINDOW w AS (PARTITION BY stem ORDER BY s, seq)),
c AS (SELECT *, sum(new) OVER (PARTITION BY stem ORDER BY s, seq ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM o)"""


_BEST = "arg_max(seq, {'c': confidence, 'k': k, 't': -s, 'o': -seq})"


@query(
    "seq9_gap_clusters",
    f"""WITH {_clusters_sql(10_000, 2250)} SELECT stem, cluster, count(*) AS detections, min(s) AS start_ms, max(e) AS end_ms, {_BEST} AS representative FROM c GROUP BY stem, cluster""",
)
def seq9_gap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gap_clusters(_placed(spark, sf_dir, 10_000))
    return found.groupBy("stem", "cluster").agg(
        F.count("*").alias("detections"),
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        representative().alias("representative"),
    )


def rebuilt(frame: DataFrame, keys: tuple[str, ...] = ("stem",), limit_ms: int = 6000, least_ms: int = 1000, touch_ms: int = 200, most: int = 8) -> DataFrame:
    """SEQ10: clusters become pieces. A piece takes detections while they end within ``limit_ms`` of its start; pieces
    shorter than ``least_ms`` go; one that begins within ``touch_ms`` of the end of the one before joins it, up to
    ``limit_ms``; at most ``most`` stay. Two folds over one event's detections.

    ``frame``: keys, cluster, seq, start_ms, end_ms, confidence, text. Result: keys, piece (from 1), start_ms, end_ms,
    representative.
    """
    det = F.struct("cluster", "start_ms", "seq", "end_ms")
    events = frame.groupBy(*keys).agg(F.array_sort(F.collect_list(det)).alias("dets"))
    none = F.struct(*[F.lit(0).cast("long").alias(n) for n in ("cluster", "since", "chunk")], F.array().cast("array<struct<seq:bigint,chunk:bigint>>").alias("out"))

    def deal(s: Column, d: Column) -> Column:
        new = (s["chunk"] == 0) | (d["cluster"] != s["cluster"]) | (d["end_ms"] - s["since"] > limit_ms)
        chunk = s["chunk"] + new.cast("long")
        return F.struct(d["cluster"].alias("cluster"), F.when(new, d["start_ms"]).otherwise(s["since"]).alias("since"), chunk.alias("chunk"), F.array_append(s["out"], F.struct(d["seq"].alias("seq"), chunk.alias("chunk"))).alias("out"))

    dealt = events.select(*keys, F.inline(F.aggregate("dets", none, deal, lambda s: s["out"])))
    chunks = frame.join(dealt, [*keys, "seq"]).groupBy(*keys, "chunk").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), representative().alias("representative"))
    chunks = chunks.filter(F.col("end_ms") - F.col("start_ms") >= least_ms)
    ordered = chunks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("chunk", "start_ms", "end_ms", "representative"))).alias("chunks"))

    def join(out: Column, c: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        end = F.least(F.greatest(last["end_ms"], c["end_ms"]), last["start_ms"] + limit_ms)
        longer = F.struct(last["chunk"].alias("chunk"), last["start_ms"].alias("start_ms"), end.alias("end_ms"), last["representative"].alias("representative"))
        touching = F.coalesce(c["start_ms"] <= last["end_ms"] + touch_ms, F.lit(False))
        return F.when(touching, F.array_append(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), longer)).otherwise(F.array_append(out, c))

    empty = F.array().cast("array<struct<chunk:bigint,start_ms:bigint,end_ms:bigint,representative:bigint>>")
    pieces = ordered.select(*keys, F.posexplode(F.slice(F.aggregate("chunks", empty, join), 1, most)).alias("piece", "p"))
    return pieces.select(*keys, (F.col("piece") + 1).alias("piece"), "p.start_ms", "p.end_ms", "p.representative")


@query(
    "seq10_chunks",
    f"""WITH RECURSIVE {_clusters_sql(20_000, 2250)},
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY cluster, s, seq) AS i FROM c),
f(stem, i, chunk, since, cluster) AS (SELECT stem, i, 1, s, cluster FROM n WHERE i = 1
  UNION ALL SELECT n.stem, n.i, f.chunk + CASE WHEN n.cluster <> f.cluster OR n.e - f.since > 6000 THEN 1 ELSE 0 END, CASE WHEN n.cluster <> f.cluster OR n.e - f.since > 6000 THEN n.s ELSE f.since END, n.cluster FROM f JOIN n ON n.stem = f.stem AND n.i = f.i + 1),
p AS (SELECT stem, chunk, min(s) AS s, max(e) AS e, {_BEST} AS rep FROM n JOIN (SELECT stem, i, chunk FROM f) USING (stem, i) GROUP BY stem, chunk HAVING max(e) - min(s) >= 1000),
q AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY chunk) AS j FROM p),
g(stem, j, piece, s, e, rep) AS (SELECT stem, j, 1, s, e, rep FROM q WHERE j = 1
  UNION ALL SELECT q.stem, q.j, CASE WHEN q.s <= g.e + 200 THEN g.piece ELSE g.piece + 1 END, CASE WHEN q.s <= g.e + 200 THEN g.s ELSE q.s END, CASE WHEN q.s <= g.e + 200 THEN least(greatest(g.e, q.e), g.s + 6000) ELSE q.e END,
    CASE WHEN q.s <= g.e + 200 THEN g.rep ELSE q.rep END FROM g JOIN q ON q.stem = g.stem AND q.j = g.j + 1)
SELECT stem, piece, s AS start_ms, arg_max(e, j) AS end_ms, rep AS representative FROM g WHERE piece <= 8 GROUP BY stem, piece, s, rep""",
)
def seq10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt(gap_clusters(_placed(spark, sf_dir, 20_000)))


def batches(frame: DataFrame, eligible: Column, n: int = 4) -> DataFrame:
    """SEQ18: up to n consecutive eligible rows; others break the run, blank texts neither break nor count."""
    filled = frame.filter(normalize_inline("text") != "").withColumn("_ok", eligible)
    island = F.sum((~F.col("_ok")).cast("int")).over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    ok = filled.withColumn("_island", island).filter("_ok")
    place = F.row_number().over(Window.partitionBy("stem", "_island").orderBy("seq")) - 1
    return ok.withColumn("island", F.col("_island").cast("long")).withColumn("batch", F.floor(place / n).cast("long")).drop("_ok", "_island")


@query(
    "seq18_batches",
    f"""WITH {CUES}, n AS (SELECT *, length(text) % 6 <> 0 AS ok FROM cues WHERE trim(text) <> ''),
i AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY stem ORDER BY seq ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM n)
SELECT stem, seq, island, ((row_number() OVER (PARTITION BY stem, island ORDER BY seq) - 1) // 4)::BIGINT AS batch FROM i WHERE ok""",
)
def seq18_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches(cues(spark, sf_dir), F.length("text") % 6 != 0).select("stem", "seq", "island", "batch")


@query(
    "seq19_seq20_durations",
    f"""WITH {CUES}, u AS (SELECT *, (len(regexp_extract_all(text, '[一-鿿]')) + len(regexp_extract_all(text, '[A-Za-z0-9]+')))::BIGINT AS units FROM cues)
SELECT stem, seq, units, least(end_cs, start_cs + CASE WHEN units <= 2 THEN 250 ELSE least(600, greatest(250, units * 25)) END)::BIGINT AS ocr_end_cs,
  greatest(end_cs, start_cs + greatest(550, least(900, units * 20)))::BIGINT AS note_end_cs, greatest(end_cs, start_cs + greatest(250, units * 20))::BIGINT AS adaptive_end_cs FROM u""",
)
def seq19_seq20_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay ends from reading load: caps for detections, least times for notes."""
    from ..functions.text import reading_units

    s, e, u = F.col("start_cs"), F.col("end_cs"), F.col("units")
    frame = cues(spark, sf_dir).withColumn("units", reading_units("text").cast("long"))
    shown = F.when(u <= 2, F.lit(250)).otherwise(F.least(F.lit(600), F.greatest(F.lit(250), u * 25)))
    return frame.select(
        "stem", "seq", "units",
        F.least(e, s + shown).cast("long").alias("ocr_end_cs"),
        F.greatest(e, s + F.greatest(F.lit(550), F.least(F.lit(900), u * 20))).cast("long").alias("note_end_cs"),
        F.greatest(e, s + F.greatest(F.lit(250), u * 20)).cast("long").alias("adaptive_end_cs"),
    )


SHORT = ["hi", "hey", "yeah", "yes", "no", "okay", "ok", "thanks", "thank you", "thank you very much", "all right", "alright", "sorry", "i m sorry"]


def short_dialogue(duration_cs: Column, c: Column | str = "text") -> Column:
    """FLT4: empty, a question, or too short for its words."""
    t = normalize_inline(c)
    n = F.size(F.filter(F.split(t, " "), lambda w: w != ""))
    return (t == "") | t.endswith("?") | (duration_cs < 100) | ((duration_cs < 220) & (n <= 4)) | (t.endswith("!") & (duration_cs < 240))


def phrase_penalty(c: Column | str = "text") -> Column:
    """Penalty of stock phrases in the observation score."""
    t = F.trim(F.regexp_replace(F.lower(normalize_inline(c)), r"[^\p{L}\p{N}]+", " "))
    n = F.size(F.filter(F.split(normalize_inline(c), " "), lambda w: w != ""))
    return F.when(t == "", 2.5).when(t.isin(SHORT), 2.4).when(t.startswith("thank you") & (n <= 5), 2.2).otherwise(0.0)


@query(
    "flt4_short_dialogue",
    rf"""WITH {CUES}, t AS (SELECT stem, seq, end_cs - start_cs AS d, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM cues),
n AS (SELECT *, len(list_filter(string_split(x, ' '), lambda w: w <> '')) AS n FROM t)
SELECT stem, seq, x = '' OR x LIKE '%?' OR d < 100 OR (d < 220 AND n <= 4) OR (x LIKE '%!' AND d < 240) AS short FROM n""",
)
def flt4_short_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues(spark, sf_dir).select("stem", "seq", short_dialogue(F.col("end_cs") - F.col("start_cs")).alias("short"))


