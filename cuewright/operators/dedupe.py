"""Greedy, order-dependent grouping and deduplication per stem, and exact first-wins dedup.

Greedy state (which group an item joined changes what the next one meets) is sequential by definition; it runs in
``applyInPandas`` over one stem at a time, or over sorted stems and minutes, so work spreads over stems.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import reading_units, text_key
from ..plans.registry import query, table
from ..sources.staging import CUES, DETECTIONS, LINES, cues, detections, lines

_KEY, _KEY_ASCII = re.compile("[^a-z0-9一-鿿]+"), re.compile("[^a-z0-9]+")


def key_of(text: str | None, ascii_only: bool = False) -> str:
    return (_KEY_ASCII if ascii_only else _KEY).sub("", " ".join((text or "").replace("\\N", " ").split()).lower())


def similarity(a: str | None, b: str | None) -> float:
    """UDF1: Ratcliff-Obershelp ratio of the lower-cased texts, 0 if one is empty."""
    a, b = (a or "").lower(), (b or "").lower()
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(DoubleType())
def text_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def ocr_similarity(a: str | None, b: str | None) -> float:
    """STR22: ratio of the keys; a key of 4 or more inside the other counts at least 0.82 + 0.18 times its share."""
    x, y = sorted((key_of(a, True), key_of(b, True)), key=len)
    if not x:
        return 0.0
    score = SequenceMatcher(None, key_of(a, True), key_of(b, True)).ratio()
    return max(score, 0.82 + 0.18 * len(x) / len(y)) if len(x) >= 4 and x in y else score


def _jump(a: tuple[float, float] | None, b: tuple[float, float] | None, limit: float) -> bool:
    return a is not None and b is not None and math.hypot(a[0] - b[0], a[1] - b[1]) > limit


def join_or_open(groups: list[dict], r: tuple, look_back: int, gap_ms: float, span_ms: int, ascii_only: bool, last_end: bool) -> dict:
    """The group of the last ``look_back`` that the detection joins, the latest first, or a new one; changed in place."""
    key, at = key_of(r.text, ascii_only), (float(r.x), float(r.y))
    for g in reversed(groups[-look_back:]):
        near = r.start_ms - g["end_ms"] <= gap_ms and r.end_ms - g["start_ms"] <= span_ms
        alike = key and g["key"] and (key in g["key"] or g["key"] in key)
        if near and alike and not _jump(g["at"], at, 420.0):
            g["end_ms"] = r.end_ms if last_end else max(g["end_ms"], r.end_ms)
            g["confidence"] = max(g["confidence"], r.confidence)
            g["n"] += 1
            if len(r.text) > len(g["text"]):
                g |= {"text": r.text, "key": key, "at": at}
            return g
    groups.append({"start_ms": r.start_ms, "end_ms": r.end_ms, "text": r.text, "key": key, "at": at, "confidence": r.confidence, "n": 1})
    return groups[-1]


def _groups(frame: pd.DataFrame, look_back: int, gap_ms: float, span_ms: int, ascii_only: bool, by_time: bool, last_end: bool) -> pd.DataFrame:
    groups: list[dict] = []
    order = ["start_ms", "seq"] if by_time else ["seq"]
    for r in frame.sort_values(order, kind="stable").itertuples(index=False):
        join_or_open(groups, r, look_back, gap_ms, span_ms, ascii_only, last_end)
    out = pd.DataFrame(groups)
    out["stem"], out["group_id"] = frame["stem"].iloc[0], range(1, len(out) + 1)
    return out[["stem", "group_id", "start_ms", "end_ms", "text", "confidence", "n"]]


def groups_sql(look_back: int, gap_ms: float, span_ms: int, key: str, by_time: bool, last_end: bool) -> str:
    """The greedy grouping as a fold over each stem's list: the state is the list of groups so far, and an item a list of one."""
    g, d = "acc[i]", "y[1]"
    fits = f"""{d}.start_ms - {g}.end_ms <= {gap_ms} AND {d}.end_ms - {g}.start_ms <= {span_ms} AND {d}.key <> '' AND {g}.key <> '' AND (contains({d}.key, {g}.key) OR contains({g}.key, {d}.key))
      AND sqrt(({g}.x - {d}.x) ** 2 + ({g}.y - {d}.y) ** 2) <= 420"""
    found = f"list_filter(range(len(acc), greatest(len(acc) - {look_back}, 0), -1), lambda i: {fits})[1]"
    longer = lambda c: f"{c} := CASE WHEN length({d}.text) > length(h.text) THEN {d}.{c} ELSE h.{c} END"
    merged = f"struct_pack(start_ms := h.start_ms, end_ms := {f'{d}.end_ms' if last_end else f'greatest(h.end_ms, {d}.end_ms)'}, {', '.join(map(longer, ('text', 'key', 'x', 'y')))}, confidence := greatest(h.confidence, {d}.confidence), n := h.n + 1)"
    return rf"""WITH {DETECTIONS}, d AS (SELECT stem, seq, at_ms // 10000 AS start_ms, at_ms // 10000 + 500 AS end_ms, text, confidence, (seq * 37 % 300)::DOUBLE AS x, (seq * 53 % 200)::DOUBLE AS y, regexp_replace(lower(text), '{key}', '', 'g') AS key FROM dets),
l AS (SELECT stem, list([struct_pack(start_ms := start_ms, end_ms := end_ms, text := text, key := key, x := x, y := y, confidence := confidence, n := 1::BIGINT)] ORDER BY {"start_ms, " if by_time else ""}seq) AS items FROM d GROUP BY stem),
f AS (SELECT stem, list_reduce(items, lambda acc, y: CASE WHEN {found} IS NULL THEN list_append(acc, {d}) ELSE list_transform(acc, lambda h, k: CASE WHEN k = {found} THEN {merged} ELSE h END) END) AS g FROM l)
SELECT stem, k AS group_id, g[k].start_ms AS start_ms, g[k].end_ms AS end_ms, g[k].text AS text, g[k].confidence AS confidence, g[k].n AS n FROM (SELECT stem, g, unnest(range(1, len(g) + 1)) AS k FROM f)"""


_GROUP_SCHEMA = "stem long, group_id long, start_ms long, end_ms long, text string, confidence double, n long"


def merged_detections(frame: DataFrame, interval_ms: int = 500) -> DataFrame:
    """SEQ6: in order of arrival, look-back 20, gap 2.2 intervals, span 6 s; the end is that of the last member."""
    return frame.groupBy("stem").applyInPandas(lambda f: _groups(f, 20, interval_ms * 2.2, 6000, True, False, True), _GROUP_SCHEMA)


def merged_ocr(frame: DataFrame, gap_ms: int = 3000, span_ms: int = 6000) -> DataFrame:
    """SEQ7: in order of time, look-back 30, gap 3 s, span 6 s; the end is the latest."""
    return frame.groupBy("stem").applyInPandas(lambda f: _groups(f, 30, gap_ms, span_ms, False, True, False), _GROUP_SCHEMA)


def timed(detected: DataFrame, scale: int = 10_000) -> DataFrame:
    """Detections with boxes, in a time that runs ``scale`` times as fast as that of the table."""
    d = detected.withColumn("start_ms", F.floor(F.col("at_ms") / scale).cast("long"))
    return d.select("stem", "seq", "start_ms", (F.col("start_ms") + 500).alias("end_ms"), "text", "confidence", (F.col("seq") * 37 % 300).cast("double").alias("x"), (F.col("seq") * 53 % 200).cast("double").alias("y"))


@query("seq6_merge_detections", groups_sql(20, 1100, 6000, "[^a-z0-9]+", False, True))
def seq6_merge_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_detections(timed(detections(spark, sf_dir)))


@query("seq7_merge_ocr", groups_sql(30, 3000, 6000, "[^a-z0-9一-鿿]+", True, False))
def seq7_merge_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_ocr(timed(detections(spark, sf_dir)))


def fuzzy_minute_dedupe(frame: DataFrame, threshold: float = 0.6) -> DataFrame:
    """SEQ8: in each stem and minute, an item as similar as ``threshold`` to a kept one goes, unless it is longer: then it
    takes that one's place. The set of exact keys does not learn the new key.

    Minutes are many and small, so they are not frames of their own: they follow each other in sorted partitions.
    """
    columns = ["stem", "minute", "start_cs", "seq", "text"]
    out = pa.schema([("stem", pa.int64()), ("minute", pa.int64()), ("seq", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns), strict=True))
        made: list[tuple] = []
        for (stem, minute), items in groupby(rows, key=lambda r: r[:2]):
            made += [(stem, minute, *k) for k in _unlike(((seq, text) for *_, seq, text in items), threshold)]
            if len(made) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), out, strict=True)], schema=out)
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), out, strict=True)], schema=out)

    minutes = frame.withColumn("minute", F.floor(F.col("start_cs") / 6000).cast("long")).select(F.col("stem").cast("long"), "minute", "start_cs", F.col("seq").cast("long"), "text")
    placed = minutes.repartition("stem", "minute").sortWithinPartitions("stem", "minute", F.asc_nulls_last("start_cs"), F.asc_nulls_last("seq"))
    return placed.mapInArrow(run, "stem long, minute long, seq long, text string")


def _unlike(items: Iterable[tuple[int, str | None]], threshold: float) -> list[tuple[int, str]]:
    """The items (seq, text) of one minute that SEQ8 keeps."""
    kept: list[tuple[int, str]] = []
    likeness: list[SequenceMatcher] = []  # to each kept text, which is prepared once
    seen: set[str] = set()
    for seq, text in items:
        key = key_of(text)
        if len(key) < 2 or key in seen:
            continue
        low = text.lower()

        def alike(m: SequenceMatcher, low: str = low) -> bool:
            m.set_seq1(low)
            return m.real_quick_ratio() >= threshold and m.ratio() >= threshold  # the first is never below the second

        twin = next((i for i, m in enumerate(likeness) if alike(m)), None)
        if twin is None:
            seen.add(key)
            kept.append((seq, text))
            likeness.append(SequenceMatcher(None, "", low))
        elif len(text) > len(kept[twin][1]):
            kept[twin] = (seq, text)
            likeness[twin] = SequenceMatcher(None, "", low)
    return kept


@query("seq8_fuzzy_minute_dedupe")
def seq8_fuzzy_minute_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_minute_dedupe(cues(spark, sf_dir))


def first_wins(frame: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key."""
    return frame.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


@query(
    "seq12_line_dedupe",
    rf"""WITH {LINES}, k AS (SELECT stem, seq, regexp_replace(lower(text), '[^a-z0-9一-鿿]+', '', 'g') AS key FROM lines),
n AS (SELECT *, row_number() OVER (PARTITION BY stem, key ORDER BY seq) AS n FROM k)
SELECT stem, seq, key FROM n WHERE n = 1 OR key = ''""",
)
def seq12_line_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First use of each key in a stem; texts without a key stay."""
    keyed = lines(spark, sf_dir).select("stem", "seq", text_key("text").alias("key"))
    alone = F.when(F.col("key") == "", F.col("seq"))  # one pass: a text without a key is a group of its own
    return keyed.groupBy("stem", "key", alone.alias("_alone")).agg(F.min("seq").alias("seq")).select("stem", "seq", "key")


def overlay_dedupe(frame: DataFrame, epsilon_cs: int = 6, screen: str = "OCR_TRANSLATION") -> DataFrame:
    """SEQ12: of each style, keys that a kept event has go; a screen text's key inside a longer kept one shown at the same
    times goes as well. Too short keys (under 1 character on screen, 2 elsewhere) stay and block nothing.

    Kept events are looked up by their start, so a stem's work is in proportion to its events.
    """

    def run(f: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        seen: set[tuple[str, str]] = set()
        kept: dict[int, list[tuple[str, int, int]]] = {}
        for r in f.sort_values("seq", kind="stable").itertuples(index=False):
            key, on_screen = key_of(r.text), r.style == screen
            if len(key) >= (1 if on_screen else 2):
                if (r.style, key) in seen:
                    continue
                slot = r.start_cs // (epsilon_cs + 1)
                near = (k for s in (slot - 1, slot, slot + 1) for k in kept.get(s, ())) if on_screen and len(key) >= 2 else ()
                if any(abs(r.start_cs - s) <= epsilon_cs and abs(r.end_cs - e) <= epsilon_cs and len(k) > len(key) and key in k for k, s, e in near):
                    continue
                seen.add((r.style, key))
                if on_screen:
                    kept.setdefault(slot, []).append((key, r.start_cs, r.end_cs))
            rows.append((r.stem, r.seq, r.style, r.text))
        return pd.DataFrame(rows, columns=["stem", "seq", "style", "text"])

    return frame.groupBy("stem").applyInPandas(run, "stem long, seq long, style string, text string")


@query(
    "seq12_overlay_dedupe",
    f"""WITH {CUES}, x AS (SELECT stem, seq * 3 + k AS seq, CASE WHEN (seq + k) % 2 = 0 THEN 'OCR_TRANSLATION' ELSE 'EXPLANATION_NOTE' END AS style, CASE k WHEN 0 THEN 'sign ' || text WHEN 1 THEN 'Sign ' ELSE CASE seq % 4 WHEN 0 THEN '!' ELSE left(text, 40) END END AS text FROM cues, range(0, 3) r(k)),
c AS (SELECT *, regexp_replace(lower(text), '[^a-z0-9一-鿿]+', '', 'g') AS key, seq // 3 AS cue FROM x),
d AS (SELECT *, row_number() OVER (PARTITION BY stem, style, key ORDER BY seq) AS n FROM c),
s AS (SELECT * FROM d a WHERE key = '' OR style <> 'OCR_TRANSLATION' OR NOT EXISTS (SELECT 1 FROM d b WHERE b.stem = a.stem AND b.cue = a.cue AND b.seq < a.seq AND b.style = a.style AND length(b.key) > length(a.key) AND contains(b.key, a.key)))
SELECT stem, seq, style, text FROM (SELECT *, row_number() OVER (PARTITION BY stem, style, key ORDER BY seq) AS m FROM s) WHERE key = '' OR m = 1""",
)
def seq12_overlay_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three texts at the times of each cue, the second and third part of the first."""
    k, t = F.col("k"), F.col("text")
    shown = F.when(k == 0, F.concat(F.lit("sign "), t)).when(k == 1, "Sign ").when(F.col("seq") % 4 == 0, "!").otherwise(F.substring(t, 1, 40))
    style = F.when((F.col("seq") + k) % 2 == 0, "OCR_TRANSLATION").otherwise("EXPLANATION_NOTE")
    c = cues(spark, sf_dir).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return overlay_dedupe(c.select("stem", (F.col("seq") * 3 + k).alias("seq"), style.alias("style"), shown.alias("text"), "start_cs", "end_cs"))


def deduped_notes(notes: DataFrame, window_cs: int = 2000) -> DataFrame:
    """SEQ13: one note per singular term; equal wording within 20 s of a kept note goes as well."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        terms: set[str] = set()
        shown: dict[str, int] = {}  # rows come in order of time, so of a wording the last kept is the nearest
        out = []
        for r in f.sort_values(["start_cs", "seq"], kind="stable").itertuples(index=False):
            if not (r.zh or "").strip():
                continue
            term, wording = re.sub("(?:s|es)$", "", key_of(r.term or r.zh)), key_of(r.zh)
            if (term and term in terms) or (wording in shown and r.start_cs - shown[wording] <= window_cs):
                continue
            terms |= {term} if term else set()
            if wording:
                shown[wording] = r.start_cs
            out.append((r.stem, r.seq, r.term, r.zh, r.start_cs, r.end_cs))
        return pd.DataFrame(out, columns=["stem", "seq", "term", "zh", "start_cs", "end_cs"])

    return notes.groupBy("stem").applyInPandas(run, "stem long, seq long, term string, zh string, start_cs long, end_cs long")


@query("seq13_note_dedupe")
def seq13_note_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With TOP6: at most 12 notes per stem, their ends widened by reading load."""
    notes = cues(spark, sf_dir).select("stem", "seq", F.regexp_extract("text", r"^(\S+)", 1).alias("term"), F.col("text").alias("zh"), "start_cs", "end_cs")
    kept = deduped_notes(notes).withColumn("end_cs", F.greatest("end_cs", F.col("start_cs") + F.greatest(F.lit(250), reading_units("zh") * 20)))
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy("stem").orderBy("start_cs", "seq"))).filter("_n <= 12").drop("_n", "zh")


@query(
    "agg4_agg5_speakers",
    f"""WITH {DETECTIONS}, c AS (SELECT stem, text, count(*) AS n, min(seq) AS first FROM dets GROUP BY stem, text)
SELECT stem, arg_max(text, {{'n': n, 'f': -first}}) AS speaker, count(*) AS speakers FROM c GROUP BY stem""",
)
def agg4_agg5_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most common value, the first seen wins ties, and how many there are."""
    counts = detections(spark, sf_dir).groupBy("stem", "text").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return counts.groupBy("stem").agg(F.max_by("text", F.struct("n", -F.col("first"))).alias("speaker"), F.count("*").alias("speakers"))


@query(
    "agg6_text_frequency",
    rf"""WITH {CUES}, k AS (SELECT stem, seq, regexp_replace(lower(text), '[^a-z0-9一-鿿]+', '', 'g') AS key FROM cues)
SELECT stem, seq, count(*) OVER (PARTITION BY stem, key) AS times FROM k""",
)
def agg6_text_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = cues(spark, sf_dir).select("stem", "seq", text_key("text").alias("key"))
    return keyed.select("stem", "seq", F.count("*").over(Window.partitionBy("stem", "key")).alias("times"))


@query("udf1_text_ratio")
def udf1_text_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each cue with the one before."""
    before = F.lag("text").over(Window.partitionBy("stem").orderBy("seq"))
    return cues(spark, sf_dir).select("stem", "seq", "text", before.alias("before")).select("stem", "seq", text_ratio("text", "before").alias("ratio"))


@query(
    "top5_top7_candidates",
    f"""WITH {DETECTIONS}, r AS (SELECT stem, seq, at_ms // 100 AS tenth, row_number() OVER (PARTITION BY stem, at_ms // 100 ORDER BY seq) AS n, at_ms FROM dets),
k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY at_ms, seq) AS m FROM r WHERE n = 1) SELECT stem, seq, m AS place FROM k WHERE m <= 10""",
)
def top5_top7_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most ten of a stem, one for each tenth of a second, in order of time."""
    found = first_wins(detections(spark, sf_dir).withColumn("tenth", F.floor(F.col("at_ms") / 100)), ["stem", "tenth"], ["seq"])
    place = F.row_number().over(Window.partitionBy("stem").orderBy("at_ms", "seq"))
    return found.withColumn("place", place).filter("place <= 10").select("stem", "seq", F.col("place").cast("long").alias("place"))


@query(
    "set6_set7_stems",
    """SELECT DISTINCT conv_id AS stem FROM conversations WHERE conv_id IN (SELECT user_id FROM events) AND conv_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def set6_set7_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection and difference of stems."""
    stems = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem")).distinct()
    have = table(spark, sf_dir, "events").select(F.col("user_id").alias("stem"))
    out = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("stem"))
    return stems.join(have, "stem", "left_semi").join(out, "stem", "left_anti")
