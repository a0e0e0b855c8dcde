"""Rules on finished and half-finished events: origins, marks, tags, overrides, songs, display units, detections, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import HAN, col, has_latin, let, normalize_text, squeeze, strip, strip_speaker, text, tokens
from ..plans.registry import query, table
from ..sources.staging import CUES, LINES, cues, lines
from .joins import time_matches

# Translations of known incantations by their words.
CHANT_TRANSLATIONS = {
    "yoli conepiya miquiliztli": "约利·科涅皮亚·米基利兹特利。",
    "spasiti animam suam": "拯救他的灵魂。",
    "animam suam": "他的灵魂。",
    "tillate ulaz": "提拉特·乌拉兹。",
    "tillate": "提拉特……",
    "louvri animo": "开启心门。",
    "louvri": "开启……",
    "pémét pou accessum": "准我进入。",
    "pemet pou accessum": "准我进入。",
    "les lames colligo": "聚集刀刃。",
    "ad me gluttuli": "归于我手。",
    "anima marcam": "唤醒印记。",
    "iskoristi vuka": "借狼之力。",
    "iskoristi vuca": "借狼之力。",
    "isk": "借……",
}
OVERLAYS = ["OCR_TRANSLATION", "EXPLANATION_NOTE"]


def origin(name: Column | str, style: Column | str) -> Column:
    """PRJ9: where an event's Chinese comes from, by its name, else its style."""
    n, s = F.upper(F.trim(text(name))), text(style)
    return F.when(n == "QWEN_ZH", "qwen").when(n == "EMBEDDED_CHINESE", "original").when(n == "MANUAL_ZH", "manual").when(s == OVERLAYS[0], "ocr").when(s == OVERLAYS[1], "note").otherwise("unknown")


def without_placeholders(c: Column | str) -> Column:
    """STR11: numbered speakers and speaker tags go."""
    return strip_speaker(F.regexp_replace(F.regexp_replace(text(c), r"(?i)\[SPEAKER_\d+\]\s*:?\s*", ""), r"(?i)SPEAKER_\d+\s*:?\s*", ""))


def external_text(c: Column | str) -> Column:
    """PRJ2: text of an external subtitle: without tags and marks, its lines joined by a blank."""
    x = F.regexp_replace(F.replace(F.regexp_replace(text(c), "<[^>]+>", ""), F.lit("﻿"), F.lit("")), r"\r\n?|\\N", "\n")
    return F.array_join(F.filter(F.transform(F.split(F.replace(x, F.lit("\\h"), F.lit(" ")), "\n"), strip), lambda p: p != ""), " ")


def external_segments(rows: DataFrame) -> DataFrame:
    """SRC4, PRJ2: dialogue lines of other files (stem, seq, style, start_cs, end_cs, text) as segments: overlays, empty spans
    and texts without Latin letters go; the rest is numbered in each file."""
    kept = rows.filter(~F.upper(F.trim(text("style"))).isin(OVERLAYS) & (F.col("end_cs") > F.col("start_cs"))).withColumn("text", external_text("text")).filter(has_latin("text"))
    music = F.col("text").rlike("[♪♫]")
    number = F.row_number().over(Window.partitionBy("stem").orderBy("seq"))
    return kept.select("stem", "seq", "start_cs", "end_cs", "text", F.when(music, "lyric").otherwise("dialogue").alias("kind"), music.alias("is_music"), number.alias("external_index"))


def chant_translation(c: Column | str) -> Column:
    """STR33: a text that known phrases cover whole, longest first, as their translations; else empty."""
    rest, out = F.concat(F.array_join(tokens_wide(c), " "), F.lit(" ")), F.array().cast("array<string>")
    by_size = sorted(CHANT_TRANSLATIONS.items(), key=lambda kv: -len(kv[0].split()))
    start = F.struct(rest.alias("rest"), out.alias("out"))

    def take(state: Column, _: Column) -> Column:
        done = F.struct(state["rest"].alias("rest"), state["out"].alias("out"))
        for phrase, zh in reversed(by_size):
            step = F.struct(F.substring(state["rest"], F.lit(len(phrase) + 2), F.length(state["rest"])).alias("rest"), F.concat(state["out"], F.array(F.lit(zh))).alias("out"))
            done = F.when(state["rest"].startswith(phrase + " "), step).otherwise(done)
        return done

    return F.aggregate(tokens_wide(c), start, take, lambda s: F.when(s["rest"] == "", F.array_join(s["out"], "")).otherwise(""))


def tokens_wide(c: Column | str) -> Column:
    """Words with the letters that incantations have."""
    return F.regexp_extract_all(F.lower(text(c)), F.lit(r"[a-z0-9à-öø-ÿ]+(?:['’][a-z0-9à-öø-ÿ]+)?"), F.lit(0))


def with_marks_of(c: Column | str, original: Column | str, style: Column | str) -> Column:
    """STR47: an edited text keeps the marks around it that its style and the original have."""
    x, old = strip(text(c)), strip(text(original))
    out = x
    for name, mark in (("BILINGUAL_MUSIC", "♪"), ("BILINGUAL_CHANT", "✦")):
        core = strip(F.regexp_replace(x, f"^{mark}+|{mark}+$", ""))
        out = F.when((col(style) == name) & old.startswith(mark) & old.endswith(mark) & (core != ""), F.concat(F.lit(f"{mark} "), core, F.lit(f" {mark}"))).otherwise(out)
    return out


def leading_tags(c: Column | str) -> Column:
    """STR27: override blocks at the beginning."""
    return F.regexp_extract(text(c), r"^((?:\{[^}]*\})*)", 1)


def with_size(c: Column | str, size: int = 42) -> Column:
    """STR27: English with one size tag in front."""
    plain = F.regexp_replace(text(c), r"\{\\fs\d+\}", "")
    return F.when(plain != "", F.concat(F.lit(f"{{\\fs{size}}}"), plain)).otherwise("")


def replaced_zh(c: Column | str, zh: Column | str) -> Column:
    r"""STR27: the Chinese before the first \N replaced, leading tags and the rest kept."""
    x = text(c)
    at = F.instr(x, "\\N")
    return F.concat(leading_tags(x), text(zh), F.when(at > 0, F.substring(x, at, F.length(x))).otherwise(""))


def song_key(c: Column | str) -> Column:
    """JOIN21: what a song's lines are looked up by: no marks, no dashes at the ends."""
    x = F.regexp_replace(normalize_text(c), "[♪♫♬]", " ")
    return squeeze(F.regexp_replace(F.regexp_replace(x, r"^\s*[-–—]+\s*", ""), r"\s*[-–—]+\s*$", ""))


def song_translations(segments: DataFrame, songs: DataFrame) -> DataFrame:
    """JOIN21: segments with the translation of the song that has their key."""
    known = songs.groupBy(song_key("text").alias("_key")).agg(F.min("zh").alias("song_zh"))
    return segments.withColumn("_key", song_key("text")).join(known, "_key", "left").drop("_key")


def ocr_overrides(items: DataFrame, drops: DataFrame, rules: DataFrame) -> DataFrame:
    """JOIN12: items that a drop rule of their stem meets go; of the replacing rules the first that meets changes zh and text.
    Rules: stem, rule, low_cs, high_cs, contains, and for replacements zh, text (null: unchanged)."""

    def meets(rules: DataFrame) -> Column:
        has = F.lower(normalize_text(rules["contains"]))
        return (items["stem"] == rules["stem"]) & time_matches(items["start_cs"], items["end_cs"], rules["low_cs"], rules["high_cs"]) & ((has == "") | F.contains(F.lower(normalize_text(items["text"])), has))

    kept = items.join(drops, meets(drops), "left_anti")
    met = kept.join(rules, meets(rules)).select(items["stem"], items["seq"], F.struct(rules["rule"], normalize_text(rules["zh"]).alias("zh"), normalize_text(rules["text"]).alias("text"), rules["zh"].isNotNull().alias("has_zh"), rules["text"].isNotNull().alias("has_text")).alias("r"))
    first = met.groupBy("stem", "seq").agg(F.min("r").alias("r"))
    out = kept.join(first, ["stem", "seq"], "left")
    return out.withColumns({"zh": F.when(F.col("r.has_zh"), F.col("r.zh")), "text": F.when(F.col("r.has_text"), F.col("r.text")).otherwise(F.col("text"))}).drop("r")


def unit_spans(units: Column, words: Column) -> Column:
    """JOIN25: first and last word of each display unit, if the units' tokens tile the words' tokens in order and no word
    is shared; else null. ``units``: array of texts, ``words``: array of words."""
    mine = F.flatten(F.transform(words, lambda w, i: F.transform(tokens(w), lambda t: F.struct(t.alias("t"), i.alias("i")))))

    def found(theirs: Column, mine: Column, stops: Column) -> Column:
        # A function inside another works each value anew that is no variable there: the tokens are bound, and read once.
        at = F.transform(theirs, lambda u, i: F.struct(F.get(mine, F.get(stops, i) - F.size(u))["i"].alias("first"), F.get(mine, F.get(stops, i) - 1)["i"].alias("last")))
        tiles = (F.size(theirs) >= 2) & F.forall(theirs, lambda u: F.size(u) > 0) & (F.flatten(theirs) == mine["t"])
        apart = lambda s: F.forall(F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))), lambda i: F.get(s, i)["first"] > F.get(s, i - 1)["last"])
        return F.when(tiles, let(at, lambda s: F.when(apart(s), s)))

    def summed(theirs: Column) -> Column:
        return F.aggregate(theirs, F.array().cast("array<int>"), lambda a, u: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + F.size(u))))

    return let(F.transform(units, tokens), lambda theirs: let(mine, lambda m: let(summed(theirs), lambda stops: found(theirs, m, stops))))


def display_quality(segments: DataFrame) -> DataFrame:
    """AGG11: per stem how many segments have stored units, and of how many these fit the words. ``spans`` of unit_spans."""
    return segments.groupBy("stem").agg(F.count("*").alias("stored"), F.count("spans").alias("aligned"), (F.count("*") - F.count("spans")).alias("failed"))


def best_detections(met: DataFrame, *keys: str) -> DataFrame:
    """JOIN15: of each item's detections the best of each frame, by 3 * similarity + confidence less the distance from the
    centre chosen in the frame before (1.5 at most, 900 pixels count 1); of equal ones the first.

    ``met``: keys, frame_ms, ordinal, similarity, confidence, x, y. One row for each item and frame. An item's frames are
    folded in order inside the JVM.
    """
    det = F.struct("ordinal", "similarity", "confidence", "x", "y")
    frames = met.groupBy(*keys, "frame_ms").agg(F.sort_array(F.collect_list(det)).alias("dets"))
    items = frames.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("frame_ms", "dets"))).alias("frames"))
    state = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.array().cast("array<struct<frame_ms:bigint,ordinal:bigint>>").alias("out"))

    def step(s: Column, f: Column) -> Column:
        far = lambda d: F.coalesce(F.least(F.hypot(d["x"] - s["x"], d["y"] - s["y"]) / 900.0, F.lit(1.5)), F.lit(0.0))
        best = F.array_max(F.transform(f["dets"], lambda d: F.struct((d["similarity"] * 3.0 + d["confidence"] - far(d)).alias("score"), (-d["ordinal"]).alias("o"), d["x"].alias("x"), d["y"].alias("y"))))
        chosen = F.struct(f["frame_ms"].alias("frame_ms"), (-best["o"]).alias("ordinal"))
        return F.struct(F.coalesce(best["x"], s["x"]).alias("x"), F.coalesce(best["y"], s["y"]).alias("y"), F.concat(s["out"], F.array(chosen)).alias("out"))

    return items.select(*keys, F.inline(F.aggregate("frames", state, step, lambda s: s["out"])))


def note_events(notes: DataFrame) -> DataFrame:
    """SET2: notes (zh, note, text, start_cs, end_cs) as overlay events: at least 3.5 s, and 0.2 s for each character."""
    zh = F.coalesce(*[F.when(F.trim(text(c)) != "", F.trim(text(c))) for c in ("zh", "note", "text")])
    least = F.col("start_cs") + F.greatest(F.lit(350), F.regexp_count(zh, F.lit(HAN)) * 20)
    return notes.withColumn("zh", zh).filter("zh IS NOT NULL").select("stem", "seq", "start_cs", F.greatest(F.coalesce("end_cs", least), least).alias("end_cs"), F.lit(OVERLAYS[1]).alias("style"), F.concat(F.lit("{\\an8}"), F.translate(F.col("zh"), "{}", "()")).alias("text"))


def dialogue_items(segments: DataFrame) -> DataFrame:
    """SET9: numbered dialogue candidates with text."""
    return segments.select("stem", F.row_number().over(Window.partitionBy("stem").orderBy("seq")).alias("id"), F.lit("dialogue").alias("source"), "start_cs", F.coalesce("end_cs", F.col("start_cs") + 100).alias("end_cs"), normalize_text("text").alias("text")).filter("text <> ''")


def candidates(dialogue: DataFrame, ocr: DataFrame, offset: int = 100_000) -> DataFrame:
    """SET8: dialogue and on-screen candidates in one list, the latter's numbers behind ``offset``."""
    return dialogue.unionByName(ocr.withColumn("id", F.col("id") + offset))


def token_words(pieces: Column) -> Column:
    """SRC11: a recogniser's tokens (text, start, end, p) as words: a token that begins with white space begins a word; blank
    and special tokens go; the score is the mean probability. Words without a span go."""
    real = F.filter(pieces, lambda t: (F.trim(t["text"]) != "") & ~F.trim(t["text"]).rlike(r"^\[_.*\]$|^<\|.*\|>$"))
    empty = "array<struct<word:string,start:bigint,end:bigint,sum:double,n:int>>"

    def step(words: Column, t: Column) -> Column:
        one = F.struct(t["text"].alias("word"), t["start"].alias("start"), t["end"].alias("end"), t["p"].alias("sum"), F.lit(1).alias("n"))
        last = F.element_at(words, -1)
        longer = F.struct(F.concat(last["word"], t["text"]).alias("word"), last["start"].alias("start"), t["end"].alias("end"), (last["sum"] + t["p"]).alias("sum"), (last["n"] + 1).alias("n"))
        fresh = (F.size(words) == 0) | t["text"].rlike(r"^\s")
        return F.when(fresh, F.concat(words, F.array(one))).otherwise(F.concat(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.array(longer)))

    made = F.aggregate(real, F.array().cast(empty), step)
    return F.transform(F.filter(made, lambda w: w["end"] > w["start"]), lambda w: F.struct(F.trim(w["word"]).alias("word"), w["start"].alias("start"), w["end"].alias("end"), (w["sum"] / w["n"]).alias("score")))


def changed_samples(entries: DataFrame, changed: int = 120, deleted: int = 80) -> DataFrame:
    """AGG10: of a cache's entries (ordinal, kind, source_zh, polished_zh, is_deleted) the first distinct changed pairs in
    order, and deleted on-screen texts in text order; both reports are top lists by contract."""
    pair = entries.filter((F.col("source_zh") != F.col("polished_zh")) & ~F.col("is_deleted")).groupBy("source_zh", "polished_zh").agg(F.min("ordinal").alias("ordinal")).orderBy("ordinal").limit(changed)
    gone = entries.filter((F.col("kind") == "ocr") & F.col("is_deleted")).select("source_zh").distinct().orderBy("source_zh").limit(deleted)
    return pair.select(F.lit("changed").alias("what"), "source_zh", "polished_zh").unionByName(gone.select(F.lit("deleted").alias("what"), "source_zh", F.lit("").alias("polished_zh")))


@query(
    "prj9_str11_str47_marks",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, CASE seq % 6 WHEN 0 THEN ' qwen_zh' WHEN 1 THEN 'EMBEDDED_CHINESE' WHEN 2 THEN 'Manual_ZH ' ELSE '' END AS name, CASE seq % 6 WHEN 3 THEN 'OCR_TRANSLATION' WHEN 4 THEN 'EXPLANATION_NOTE' ELSE 'BILINGUAL_MUSIC' END AS style, left(text, 20) AS t FROM cues)
SELECT stem, seq, CASE seq % 6 WHEN 0 THEN 'qwen' WHEN 1 THEN 'original' WHEN 2 THEN 'manual' WHEN 3 THEN 'ocr' WHEN 4 THEN 'note' ELSE 'unknown' END AS origin,
  trim(regexp_replace(t, '\s+', ' ', 'g')) AS spoken,
  CASE WHEN style = 'BILINGUAL_MUSIC' AND seq % 2 = 0 THEN '♪ ' || regexp_replace(t, '^\s+|\s+$', '', 'g') || ' ♪' ELSE regexp_replace(t, '^\s+|\s+$', '', 'g') END AS marked FROM x""",
)
def prj9_str11_str47_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("seq") % 6, F.substring("text", 1, 20)
    name = F.when(k == 0, " qwen_zh").when(k == 1, "EMBEDDED_CHINESE").when(k == 2, "Manual_ZH ").otherwise("")
    style = F.when(k == 3, "OCR_TRANSLATION").when(k == 4, "EXPLANATION_NOTE").otherwise("BILINGUAL_MUSIC")
    spoken = without_placeholders(F.concat(F.lit("[speaker_07]: SPEAKER_1 "), t))
    old = F.when(F.col("seq") % 2 == 0, "♪ old ♪").otherwise("old")
    return cues(spark, sf_dir).select("stem", "seq", origin(name, style).alias("origin"), spoken.alias("spoken"), with_marks_of(t, old, style).alias("marked"))


@query(
    "src4_prj2_external",
    rf"""WITH {LINES}, x AS (SELECT stem, seq, CASE seq % 5 WHEN 0 THEN 'ocr_translation ' ELSE 'Default' END AS style, seq * 100 AS s, seq * 100 + CASE seq % 4 WHEN 3 THEN 0 ELSE 90 END AS e, CASE seq % 7 WHEN 1 THEN '你好' ELSE '<i>' || trim(text, ' ') || '</i>\N' || '\h♪ ' || seq END AS t FROM lines),
y AS (SELECT stem, seq, s, e, regexp_replace(array_to_string(list_filter(list_transform(string_split(replace(regexp_replace(regexp_replace(t, '<[^>]+>', '', 'g'), '\r\n?|\\N', chr(10), 'g'), '\h', ' '), chr(10)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> ''), ' '), '', '') AS t FROM x WHERE style = 'Default' AND e > s)
SELECT stem, seq, s::BIGINT AS start_cs, e::BIGINT AS end_cs, t AS text, CASE WHEN regexp_matches(t, '[♪♫]') THEN 'lyric' ELSE 'dialogue' END AS kind, regexp_matches(t, '[♪♫]') AS is_music, row_number() OVER (PARTITION BY stem ORDER BY seq) AS external_index FROM y WHERE regexp_matches(t, '[A-Za-z]')""",
)
def src4_prj2_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq")
    shown = F.when(k % 7 == 1, "你好").otherwise(F.concat(F.lit("<i>"), F.trim("text"), F.lit("</i>\\N\\h♪ "), k.cast("string")))
    rows = lines(spark, sf_dir).select("stem", "seq", F.when(k % 5 == 0, "ocr_translation ").otherwise("Default").alias("style"), (k * 100).cast("long").alias("start_cs"), (k * 100 + F.when(k % 4 == 3, 0).otherwise(90)).cast("long").alias("end_cs"), shown.alias("text"))
    return external_segments(rows)


@query(
    "str33_chants",
    rf"""WITH {CUES} SELECT stem, seq, CASE seq % 4 WHEN 0 THEN '拯救他的灵魂。开启……' WHEN 1 THEN '开启心门。准我进入。' WHEN 2 THEN '' ELSE '他的灵魂。' END AS zh FROM cues""",
)
def str33_chants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 4
    shown = F.when(k == 0, "Spasiti animam suam... louvri!").when(k == 1, "Louvri animo, PÉMÉT pou accessum").when(k == 2, F.concat(F.lit("animam suam "), F.col("text"), F.lit(" zq"))).otherwise("Animam suam")
    return cues(spark, sf_dir).select("stem", "seq", chant_translation(shown).alias("zh"))


@query(
    "str27_tags",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, CASE WHEN seq % 2 = 0 THEN '{{\an8}}{{\i1}}' ELSE '' END || '你' || CASE WHEN seq % 3 = 0 THEN '' ELSE '\N{{\fs42}}' || left(text, 12) END AS t, left(text, 12) AS en FROM cues)
SELECT stem, seq, CASE WHEN seq % 2 = 0 THEN '{{\an8}}{{\i1}}' ELSE '' END AS tags, CASE WHEN seq % 2 = 0 THEN '{{\an8}}{{\i1}}' ELSE '' END || '新' || CASE WHEN seq % 3 = 0 THEN '' ELSE '\N{{\fs42}}' || en END AS replaced, CASE WHEN en = '' THEN '' ELSE '{{\fs42}}' || en END AS sized FROM x""",
)
def str27_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, en = F.col("seq"), F.substring("text", 1, 12)
    t = F.concat(F.when(k % 2 == 0, r"{\an8}{\i1}").otherwise(""), F.lit("你"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("\\N{\\fs42}"), en)))
    return cues(spark, sf_dir).select("stem", "seq", leading_tags(t).alias("tags"), replaced_zh(t, F.lit("新")).alias("replaced"), with_size(F.concat(F.lit(r"{\fs30}"), en)).alias("sized"))


_SONG = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(replace(t, '\N', ' '), '\s+', ' ', 'g')), '[♪♫♬]', ' ', 'g'), '^\s*[-–—]+\s*', ''), '\s*[-–—]+\s*$', ''), '\s+', ' ', 'g'))"


@query(
    "join21_songs",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, left(text, 4) AS t FROM cues), s AS (SELECT {_SONG} AS k, min('歌' || stem) AS song_zh FROM x WHERE stem % 10 = 0 GROUP BY 1)
SELECT stem, seq, song_zh FROM (SELECT stem, seq, {_SONG} AS k FROM x) LEFT JOIN s USING (k)""",
)
def join21_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cues(spark, sf_dir).withColumn("text", F.substring("text", 1, 4))
    songs = c.filter("stem % 10 = 0").select(F.concat(F.lit("♪ - "), "text", F.lit(" ♪")).alias("text"), F.concat(F.lit("歌"), F.col("stem").cast("string")).alias("zh"))
    return song_translations(c, songs).select("stem", "seq", "song_zh")


@query(
    "join12_ocr_overrides",
    rf"""WITH {CUES}, d AS (SELECT DISTINCT conv_id AS stem, 'zz' AS has, conv_id % 7 * 300 AS low, conv_id % 7 * 300 + 500 AS high FROM conversations),
r AS (SELECT DISTINCT conv_id AS stem, k::INTEGER AS rule, k * 700 AS low, CASE k % 2 WHEN 0 THEN 'e' ELSE 'a' END AS has, CASE WHEN k % 3 > 0 THEN '译' || k END AS zh, CASE WHEN k % 3 <> 1 THEN 'new ' || k END AS text FROM conversations, range(0, 9) q(k)),
kept AS (SELECT c.* FROM cues c WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.stem = c.stem AND c.end_cs >= low - 35 AND c.start_cs <= high + 35)),
m AS (SELECT kept.stem, kept.seq, min(rule) AS rule FROM kept JOIN r ON r.stem = kept.stem AND (abs(start_cs - low) <= 35 OR (start_cs <= low AND low <= end_cs)) AND contains(lower(kept.text), has) GROUP BY ALL)
SELECT k.stem, k.seq, CASE WHEN r.zh IS NOT NULL THEN r.zh END AS zh, coalesce(r.text, k.text) AS text FROM kept k LEFT JOIN m USING (stem, seq) LEFT JOIN r ON r.stem = m.stem AND r.rule = m.rule""",
)
def join12_ocr_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    stems = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem")).distinct()
    drops = stems.select("stem", (F.col("stem") % 7 * 300).alias("low_cs"), (F.col("stem") % 7 * 300 + 500).alias("high_cs"), F.lit("").alias("contains"))
    k = F.col("k")
    rules = stems.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(8)))).select(
        "stem", k.alias("rule"), (k * 700).cast("long").alias("low_cs"), F.lit(None).cast("long").alias("high_cs"), F.when(k % 2 == 0, "E").otherwise("a").alias("contains"),
        F.when(k % 3 > 0, F.concat(F.lit("译"), k.cast("string"))).alias("zh"), F.when(k % 3 != 1, F.concat(F.lit("new "), k.cast("string"))).alias("text"),
    )
    return ocr_overrides(cues(spark, sf_dir).select("stem", "seq", "start_cs", "end_cs", "text"), drops, rules).select("stem", "seq", "zh", "text")


def _united(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    half = F.floor(F.size("w") / 2).cast("int")
    second = F.concat(F.slice("w", F.col("half") + 1, F.size("w")), F.when(F.col("seq") % 5 == 0, F.array(F.lit("more"))).otherwise(F.array().cast("array<string>")))
    # Exploded, the words are found once: a filter over a column works it out a second time.
    c = cues(spark, sf_dir).select("stem", "seq", F.explode(F.filter(F.array(w), lambda w: F.size(w) >= 4)).alias("w")).withColumn("half", half)
    return c.withColumn("spans", unit_spans(F.array(F.array_join(F.slice("w", 1, F.col("half")), " "), F.concat(F.array_join(second, ", "), F.lit("."))), F.col("w")))


@query(
    "join25_agg11_units",
    rf"""WITH {CUES}, x AS (SELECT stem, seq FROM cues WHERE len(regexp_extract_all(text, '[A-Za-z]+')) >= 4)
SELECT stem, count(*) AS stored, count_if(seq % 5 <> 0)::BIGINT AS aligned, count_if(seq % 5 = 0)::BIGINT AS failed FROM x GROUP BY stem""",
)
def join25_agg11_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display_quality(_united(spark, sf_dir))


@query(
    "join25_unit_spans",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, len(regexp_extract_all(text, '[A-Za-z]+')) AS n FROM cues)
SELECT stem, seq, (n // 2 - 1)::BIGINT AS first_stop, (n // 2)::BIGINT AS second_start, (n - 1)::BIGINT AS second_stop FROM x WHERE n >= 4 AND seq % 5 <> 0""",
)
def join25_unit_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = lambda s: F.struct(s[0]["last"].cast("long").alias("first_stop"), s[1]["first"].cast("long").alias("second_start"), s[1]["last"].cast("long").alias("second_stop"))
    return _united(spark, sf_dir).select("stem", "seq", F.inline(F.transform(F.filter(F.array("spans"), lambda s: s.isNotNull()), row)))


@query(
    "join15_best_detections",
    """WITH RECURSIVE d AS (SELECT user_id AS stem, event_type AS text, epoch_us(ts) // 3600000000 * 3600000 AS frame, event_id AS o, (event_id % 4) / 4.0 AS sim, value / 100 AS conf, (event_id * 37 % 1280)::DOUBLE AS x, (event_id * 91 % 720)::DOUBLE AS y FROM events),
f AS (SELECT *, dense_rank() OVER (PARTITION BY stem, text ORDER BY frame) AS n FROM d),
b AS (SELECT stem, text, n, frame, o, x, y FROM (SELECT *, row_number() OVER (PARTITION BY stem, text ORDER BY sim * 3.0 + conf DESC, o) AS r FROM f WHERE n = 1) WHERE r = 1
  UNION ALL SELECT stem, text, n, frame, o, x, y FROM (SELECT f.stem, f.text, f.n, f.frame, f.o, f.x, f.y, row_number() OVER (PARTITION BY f.stem, f.text ORDER BY f.sim * 3.0 + f.conf - least(sqrt((f.x - b.x) * (f.x - b.x) + (f.y - b.y) * (f.y - b.y)) / 900.0, 1.5) DESC, f.o) AS r
    FROM b JOIN f ON f.stem = b.stem AND f.text = b.text AND f.n = b.n + 1) WHERE r = 1)
SELECT stem, text, frame::BIGINT AS frame_ms, o AS ordinal FROM b""",
)
def join15_best_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    frame = F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 3600000).cast("long") * 3600000
    met = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stem"), F.col("event_type").alias("text"), frame.alias("frame_ms"), e.alias("ordinal"), (e % 4 / 4.0).alias("similarity"), (F.col("value") / 100).alias("confidence"),
        (e * 37 % 1280).cast("double").alias("x"), (e * 91 % 720).cast("double").alias("y"),
    )
    return best_detections(met, "stem", "text")


@query(
    "set2_set8_set9_candidates",
    rf"""WITH {CUES}, x AS (SELECT *, trim(regexp_replace(replace(text, '\N', ' '), '\s+', ' ', 'g')) AS t, row_number() OVER (PARTITION BY stem ORDER BY seq) AS id FROM cues)
SELECT stem, id, 'dialogue' AS source, start_cs, end_cs, t AS text FROM x WHERE t <> ''
UNION ALL SELECT stem, seq + 100000, 'note', start_cs, greatest(end_cs, start_cs + greatest(350, 20 * length(repeat('字', (seq % 40)::INTEGER)))), '{{\an8}}' || repeat('字', (seq % 40)::INTEGER) FROM cues WHERE seq % 40 > 0""",
)
def set2_set8_set9_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cues(spark, sf_dir)
    notes = note_events(c.withColumns({"zh": F.lit(" "), "note": F.expr("repeat('字', int(seq % 40))"), "text": F.lit(None).cast("string")}))
    ocr = notes.select("stem", F.col("seq").alias("id"), F.lit("note").alias("source"), "start_cs", "end_cs", "text")
    return candidates(dialogue_items(c), ocr)


@query(
    "src11_token_words",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS w FROM cues WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> '')
SELECT stem, seq, len(w)::INTEGER AS words, w[1] AS first_word, (20 * len(w) - 10 + CASE WHEN length(w[len(w)]) > 2 THEN 10 ELSE 0 END)::BIGINT AS last_end FROM x""",
)
def src11_token_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words cut behind their second character into tokens of a tenth of a second, the second half of a long word without a
    blank before it."""
    w = F.split(squeeze("text"), " ")
    piece = lambda t, s, p: F.struct(t.alias("text"), s.cast("long").alias("start"), (s + 10).cast("long").alias("end"), F.lit(p).alias("p"))
    pieces = F.flatten(F.transform(w, lambda x, i: F.filter(F.array(piece(F.concat(F.lit(" "), F.substring(x, 1, 2)), i * 20, 0.5), piece(F.substring(x, F.lit(3), F.length(x)), i * 20 + 10, 1.0), piece(F.lit(" [_TT_5]"), i * 20, 0.0)), lambda t: t["text"] != "")))
    made = token_words(pieces)
    return cues(spark, sf_dir).filter(squeeze("text") != "").select("stem", "seq", F.size(made).alias("words"), made[0]["word"].alias("first_word"), F.element_at(made, -1)["end"].alias("last_end"))


@query(
    "agg10_changed_samples",
    rf"""WITH {LINES}, e AS (SELECT stem * 1000 + seq AS ordinal, left(text, 3) AS s, left(text, 2 + (seq % 2)::INTEGER) AS p, CASE seq % 3 WHEN 0 THEN 'ocr' ELSE 'dialogue' END AS kind, seq % 6 = 0 AS gone FROM lines WHERE length(text) >= 3),
c AS (SELECT s, p FROM e WHERE s <> p AND NOT gone GROUP BY s, p ORDER BY min(ordinal) LIMIT 120), d AS (SELECT DISTINCT s FROM e WHERE kind = 'ocr' AND gone ORDER BY s LIMIT 80)
SELECT 'changed' AS what, s AS source_zh, p AS polished_zh FROM c UNION ALL SELECT 'deleted', s, '' FROM d""",
)
def agg10_changed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq")
    e = lines(spark, sf_dir).filter(F.length("text") >= 3).select((F.col("stem") * 1000 + k).alias("ordinal"), F.when(k % 3 == 0, "ocr").otherwise("dialogue").alias("kind"), F.substring("text", 1, 3).alias("source_zh"), F.expr("substring(text, 1, int(2 + seq % 2))").alias("polished_zh"), (k % 6 == 0).alias("is_deleted"))
    return changed_samples(e)
