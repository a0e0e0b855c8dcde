"""Queries of the row-wise text, time, box and JSON functions, and of the classifiers built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times as D
from ..functions import values as V
from ..plans.registry import query, table
from ..sources.staging import CUES, LINES, cues, lines

#: White space as Unicode has it, for RE2.
_WS = r"[\s\x0B\x1C-\x1F\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _unescaped(x: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", chr(0xA0)), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


_STRIPPED = rf"regexp_replace(regexp_replace({_unescaped('html')}, '\{{\\[^}}]*\}}', '', 'g'), '<[^>]+>', '', 'g')"


@query(
    "str8_markup_strip",
    rf"""SELECT page_id, md5(trim(regexp_replace({_STRIPPED}, '{_WS}', ' ', 'g'))) AS plain_md5, length({_STRIPPED})::BIGINT AS n FROM pages""",
)
def str8_markup_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = F.regexp_replace(F.regexp_replace(T.unescape("html"), T.OVERRIDE, ""), T.TAG, "")
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.squeeze(stripped).cast("binary")).alias("plain_md5"), F.length(stripped).cast("long").alias("n"))


@query(
    "str1_str5_str7_keys",
    rf"""WITH {LINES}, x AS (SELECT stem, seq, trim(regexp_replace(replace(text, '\N', ' '), '{_WS}', ' ', 'g')) AS t FROM lines)
SELECT stem, seq, regexp_replace(lower(t), '[^a-z0-9一-鿿]+', '', 'g') AS key, regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') AS ascii_key,
  CASE WHEN length(t) > 40 THEN substr(t, 1, 37) || '...' ELSE t END AS preview FROM x""",
)
def str1_str5_str7_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.normalize_text("text")
    return lines(spark, sf_dir).select("stem", "seq", T.text_key("text").alias("key"), T.text_key_ascii(t).alias("ascii_key"), T.preview(t, 40).alias("preview"))


_TAGGED = "CASE seq % 6 WHEN 0 THEN 'JOHN: ' || text WHEN 1 THEN '[SlNGlNG] ' || text WHEN 2 THEN '- (laughs) - ' || text WHEN 3 THEN '(SOBBING): ' || text WHEN 4 THEN 'MARY ANN (on phone): DR. X: ' || text ELSE '(chant) [door]' END"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues with the speaker tags and bracketed labels of hearing-impaired subtitles."""
    t = F.col("text")
    k = F.col("seq") % 6
    shown = (
        F.when(k == 0, F.concat(F.lit("JOHN: "), t)).when(k == 1, F.concat(F.lit("[SlNGlNG] "), t)).when(k == 2, F.concat(F.lit("- (laughs) - "), t))
        .when(k == 3, F.concat(F.lit("(SOBBING): "), t)).when(k == 4, F.concat(F.lit("MARY ANN (on phone): DR. X: "), t)).otherwise("(chant) [door]")
    )
    return cues(spark, sf_dir).withColumn("shown", shown)


_SP = r"[A-Z][A-Z0-9 .''\-♪♫*?]{1,40}(?:\s*\((?:on phone|o\.s\.|v\.o\.|over phone)\))?\s*:\s*"


@query(
    "str10_speaker_strip",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, trim(regexp_replace({_TAGGED}, '{_WS}', ' ', 'g')) AS t FROM cues)
SELECT stem, seq, trim(regexp_replace(t, '^(?:{_SP})+', '')) AS spoken, regexp_matches(t, '^[A-Z][A-Z0-9 .''\-♪♫*?]{{1,40}}(?:\s*\((?:on phone|o\.s\.|v\.o\.|over phone)\))?\s*:?\s*$') AS tag_only FROM x""",
)
def str10_speaker_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("stem", "seq", T.strip_speaker("shown").alias("spoken"), T.speaker_only("shown").alias("tag_only"))


@query(
    "str12_label_split",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, trim(regexp_replace(regexp_replace({_TAGGED}, '<[^>]+>', '', 'g'), '{_WS}', ' ', 'g')) AS t FROM cues),
b AS (SELECT *, array_to_string(regexp_extract_all(t, '[\[(]([^()\[\]\n]{{1,90}})[\])]', 1), '|') AS labels, trim(regexp_replace(regexp_replace(t, '[\[(]([^()\[\]\n]{{1,90}})[\])]', ' ', 'g'), '{_WS}', ' ', 'g')) AS b0 FROM x),
c AS (SELECT *, regexp_replace(regexp_replace(b0, '^\s*:\s*', ''), '^\s*[-–—]\s*[-–—]\s*', '- ') AS b1 FROM b)
SELECT stem, seq, labels, CASE WHEN regexp_matches(b1, '[\p{{L}}\p{{N}}♪♫]') THEN b1 ELSE '' END AS body, regexp_matches(translate(labels, 'l1', 'II'), '(?i)\b(song|singing|sings|lyrics?|chorus)\b') AS music,
  regexp_matches(translate(labels, 'l1', 'II'), '(?i)\b(chant(?:ing)?|incantation|spell(?:casting)?|whispering continues)\b') AS chant FROM c""",
)
def str12_label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(T.labels("shown"), "|")
    return _tagged(spark, sf_dir).select("stem", "seq", joined.alias("labels"), T.without_labels("shown").alias("body"), T.label_is_music(joined).alias("music"), T.label_is_chant(joined).alias("chant"))


@query(
    "dt_times",
    """SELECT l_orderkey, l_linenumber, cs, (cs // 360000)::VARCHAR || ':' || lpad((cs // 6000 % 60)::VARCHAR, 2, '0') || ':' || lpad((cs // 100 % 60)::VARCHAR, 2, '0') || '.' || lpad((cs % 100)::VARCHAR, 2, '0') AS ass,
  cs AS back_cs, (cs // 100 * 1000 + cs % 100 * 10)::BIGINT AS srt_ms, lpad((cs // 360000)::VARCHAR, 2, '0') || ':' || lpad((cs // 6000 % 60)::VARCHAR, 2, '0') || ':' || lpad((cs // 100 % 60)::VARCHAR, 2, '0') || '.' || lpad((cs % 100)::VARCHAR, 2, '0') AS report
FROM (SELECT l_orderkey, l_linenumber, (l_orderkey * 97 + l_linenumber * 13) % 3600000 AS cs FROM lineitem)""",
)
def dt_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT1-DT8: formats and parsers, there and back."""
    cs = ((F.col("l_orderkey") * 97 + F.col("l_linenumber") * 13) % 3_600_000).cast("long")
    frame = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cs.alias("cs")).withColumn("ass", D.centis_to_ass("cs"))
    return frame.select("l_orderkey", "l_linenumber", "cs", "ass", D.ass_centis("ass").alias("back_cs"), D.srt_millis(F.replace("ass", F.lit("."), F.lit(","))).alias("srt_ms"), D.report_time("cs").alias("report"))


@query(
    "mth_boxes",
    """WITH d AS (SELECT event_id, user_id, (event_id * 37 % 1800)::DOUBLE AS x, (event_id * 53 % 1000)::DOUBLE AS y FROM events),
b AS (SELECT event_id, x AS x1, y AS y1, x + 100 AS x2, y + 40 AS y2, lag(x) OVER (PARTITION BY user_id ORDER BY event_id) AS px, lag(y) OVER (PARTITION BY user_id ORDER BY event_id) AS py FROM d)
SELECT event_id, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, coalesce(sqrt((x1 - px) ** 2 + (y1 - py) ** 2) > 420, false) AS jumped,
  least(greatest(round_even((x1 + x2) / 2, 0)::INTEGER, 36), 1884) AS px, least(greatest(round_even((y1 + y2) / 2 + 28, 0)::INTEGER, 36), 1044) AS py FROM b""",
)
def mth_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH1-3 and ARR1: boxes from points, centres, jumps from the box before, placement."""
    from pyspark.sql import Window

    x, y = (F.col("event_id") * 37 % 1800).cast("double"), (F.col("event_id") * 53 % 1000).cast("double")
    points = F.array(F.array(x, y), F.array(x + 100, y), F.array(x + 100, y + 40))
    boxed = table(spark, sf_dir, "events").select("event_id", "user_id", V.box_of_points(points).alias("box"))
    boxed = boxed.withColumn("before", F.lag("box").over(Window.partitionBy("user_id").orderBy("event_id")))
    at = V.placed("box", F.lit(1920), F.lit(1080))
    return boxed.select("event_id", V.center("box")["x"].alias("cx"), V.center("box")["y"].alias("cy"), V.jumped("before", "box").alias("jumped"), at["x"].alias("px"), at["y"].alias("py"))


@query(
    "jsn_salvage",
    r"""WITH x AS (SELECT event_id, '<think>{no}</think> here: ```json ' || props || ' ``` done' AS raw FROM events)
SELECT event_id, regexp_extract(regexp_replace(regexp_replace(raw, '(?is)<think>.*?</think>', '', 'g'), '```(?:json)?', '', 'g'), '(?s)\{.*\}') AS body FROM x""",
)
def jsn_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("<think>{no}</think> here: ```json "), F.col("props"), F.lit(" ``` done"))
    return table(spark, sf_dir, "events").select("event_id", V.salvage_json(raw).alias("body"))


@query(
    "hsh_digest",
    """SELECT doc_id, sha256('{"lang":"' || lang || '","model":"m","source":"' || source || '"}') AS key FROM documents""",
)
def hsh_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", V.digest(source=F.col("source"), lang=F.col("lang"), model=F.lit("m")).alias("key"))


@query(
    "arr4_unit_cover",
    rf"""WITH {CUES}, w AS (SELECT stem, seq, text, list_transform(regexp_extract_all(text, '[A-Za-z0-9]+(?:[''’][A-Za-z0-9]+)?'), lambda t: lower(replace(t, '’', ''''))) AS toks FROM cues)
SELECT stem, seq, len(toks)::INTEGER AS tokens, seq % 2 = 0 OR len(toks) = 0 OR len(list_transform(regexp_extract_all(string_split(text, ' ')[1], '[A-Za-z0-9]+(?:[''’][A-Za-z0-9]+)?'), lambda t: t)) = 0 AS covers FROM w""",
)
def arr4_unit_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display units cover their source if their tokens are its tokens; every second cue loses its first word here."""
    parts = F.split("text", " ")
    kept = F.when(F.col("seq") % 2 == 0, parts).otherwise(F.filter(parts, lambda w, i: i > 0))
    units = F.transform(kept, lambda w: F.struct(w.alias("en"), w.alias("zh")))
    return cues(spark, sf_dir).select("stem", "seq", F.size(T.tokens("text")).alias("tokens"), V.units_cover(units, "text").alias("covers"))


# Words of sound effects and of their surroundings.
SOUNDS = [
    "alarm", "alarms", "beep", "beeps", "bell", "bells", "bird", "birds", "breathing", "buzz", "buzzes", "chime", "chimes", "chuckling", "chuckles", "clatter", "clatters", "close",
    "closes", "closing", "coughing", "coughs", "crack", "cracking", "cracks", "creak", "creaking", "creaks", "cries", "crying", "ding", "dings", "door", "doors", "exhale",
    "exhales", "footstep", "footsteps", "gasp", "gasping", "gasps", "giggle", "giggling", "giggles", "groan", "groaning", "groans", "grunt", "grunting", "grunts", "knock",
    "knocking", "knocks", "laugh", "laughing", "laughs", "moan", "moaning", "moans", "open", "opens", "opening", "panting", "pants", "phone", "phones", "rain", "ring", "ringing",
    "rings", "rattle", "rattling", "rattles", "rustle", "rustles", "rustling", "scream", "screaming", "screams", "shriek", "shrieking", "shrieks", "sigh", "sighing", "sighs",
    "sirens", "siren", "slam", "slamming", "slams", "sob", "sobbing", "sobs", "thunder", "voice", "voices", "whimper", "whimpering", "whimpers", "whoosh", "whooshes", "wind",
]
SURROUNDINGS = [
    "background", "car", "cell", "continued", "continues", "continue", "distant", "faint", "indistinct", "nearby", "off", "phone", "quietly", "screen", "softly", "stopped",
    "stops", "stop", "trolley",
]


def effect_only(c: Column | str, common: list[str] | None = None) -> Column:
    """FLT1: a cue that only names sounds: one such word, or enough of its few words."""
    w = T.words(T.strip_speaker(c))
    listed = lambda values: F.size(F.filter(w, lambda x: x.isin(values)))
    n, sounds = F.size(w), listed(SOUNDS)
    ratio = (sounds + listed(SURROUNDINGS)) / F.greatest(n, F.lit(1))
    plain = listed(common) == 0 if common else F.lit(True)
    return (sounds > 0) & ~T.has_note(c) & ((n == 1) | ((n <= 6) & (ratio >= 0.75)) | ((n <= 3) & (ratio >= 0.5) & plain))


_EFFECT = "CASE seq % 4 WHEN 0 THEN 'Door opens' WHEN 1 THEN 'distant thunder ' || left(text, 6) WHEN 2 THEN 'gasps' ELSE text END"


@query(
    "flt1_effect_only",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, list_transform(regexp_extract_all({_EFFECT}, '[A-Za-zÀ-ÖØ-öø-ÿ]+(?:''[A-Za-zÀ-ÖØ-öø-ÿ]+)?'), lambda w: replace(lower(w), '''', '')) AS w, {_EFFECT} AS t FROM cues),
n AS (SELECT *, len(w) AS n, len(list_filter(w, lambda x: list_contains({SOUNDS}, x))) AS s, len(list_filter(w, lambda x: list_contains({SURROUNDINGS}, x))) AS c FROM x)
SELECT stem, seq, s > 0 AND NOT regexp_matches(t, '[♪♫]') AND (n = 1 OR (n <= 6 AND (s + c) / greatest(n, 1) >= 0.75) OR (n <= 3 AND (s + c) / greatest(n, 1) >= 0.5)) AS effect FROM n""",
)
def flt1_effect_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("seq") % 4, F.col("text")
    shown = F.when(k == 0, "Door opens").when(k == 1, F.concat(F.lit("distant thunder "), F.substring(t, 1, 6))).when(k == 2, "gasps").otherwise(t)
    return cues(spark, sf_dir).select("stem", "seq", effect_only(shown).alias("effect"))


_CREDIT, _SPONSOR = T.CREDIT.removeprefix("(?i)"), T.SPONSOR.replace("'", "''").replace("{1,30}", "{1,30}")


@query(
    "flt6_flt7_flt19_presence",
    rf"""WITH {LINES}, l AS (SELECT stem, seq, CASE seq % 9 WHEN 1 THEN left(text, 3) WHEN 2 THEN 'and ' || left(text, 12) WHEN 3 THEN left(text, 20) || ' Closed Caption' WHEN 4 THEN seq::VARCHAR WHEN 5 THEN '人民广场' ELSE text END AS text FROM lines),
x AS (SELECT stem, seq, trim(regexp_replace(replace(text, '\N', ' '), '{_WS}', ' ', 'g')) AS t, text FROM l),
n AS (SELECT *, len(regexp_extract_all(t, '[一-鿿]')) AS h, len(regexp_extract_all(t, '[A-Za-z]')) AS l, len(regexp_extract_all(t, '[0-9]')) AS d, len(regexp_extract_all(t, '[AEIOUaeiou]')) AS v, regexp_replace(text, '[^0-9A-Za-z一-鿿]', '', 'g') AS b FROM x)
SELECT stem, seq, h + l + d <= 1 OR (l = 0 AND d = 0 AND (h = 1 OR (h <= 3 AND regexp_matches(b, '(大道|大街|公路|路口|中心|广场)$')))) OR (h = 0 AND l > 0 AND (l + d <= 2 OR (l >= 4 AND v = 0) OR (l <= 4 AND v <= 1))) OR (h = 0 AND l = 0 AND d <= 3) AS noise,
  t = '' OR regexp_matches(t, '{_CREDIT}', 'i') OR regexp_matches(t, '{_SPONSOR}') AS credit,
  h > 0 AS han, regexp_matches(text, '[A-Za-z]') AS latin, regexp_matches(text, '[♪♫]') AS note FROM n""",
)
def flt6_flt7_flt19_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("seq") % 9, F.col("text")
    shown = F.when(k == 1, F.substring(t, 1, 3)).when(k == 2, F.concat(F.lit("and "), F.substring(t, 1, 12))).when(k == 3, F.concat(F.substring(t, 1, 20), F.lit(" Closed Caption")))
    return lines(spark, sf_dir).withColumn("text", shown.when(k == 4, F.col("seq").cast("string")).when(k == 5, "人民广场").otherwise(t)).select(
        "stem", "seq", T.noise_fragment("text").alias("noise"), T.credit_text("text").alias("credit"), T.has_han("text").alias("han"), T.has_latin("text").alias("latin"), T.has_note("text").alias("note")
    )


@query(
    "str15_str30_marks",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t, seq % 2 = 0 AS on_, text,
  translate(array_to_string(list_filter(list_transform(string_split(regexp_replace(replace(text, '\N', chr(10)), '\r\n?', chr(10), 'g'), chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> ''), '\N'), '{{}}', '()') AS esc FROM cues)
SELECT stem, seq, CASE WHEN on_ AND t <> '' THEN '♪ ' || t || ' ♪' ELSE t END AS marked, concat_ws('\N', CASE WHEN text <> '' THEN esc END, CASE WHEN text <> '' THEN '{{\fs42}}' || esc END) AS both FROM x""",
)
def str15_str30_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues(spark, sf_dir).select("stem", "seq", T.mark_wrapped("text", "♪", F.col("seq") % 2 == 0).alias("marked"), T.bilingual_text("text", "text").alias("both"))


def kind(music: Column, chant: Column) -> Column:
    """PRJ1/PRJ3: chant before lyric before dialogue."""
    return F.when(chant, "chant").when(music, "lyric").otherwise("dialogue")


@query(
    "prj1_segment_kind",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, {_TAGGED} AS t FROM cues),
l AS (SELECT stem, seq, translate(array_to_string(regexp_extract_all(t, '[\[(]([^()\[\]\n]{{1,90}})[\])]', 1), '|'), 'l1', 'II') AS lab, t FROM x)
SELECT stem, seq, CASE WHEN regexp_matches(lab, '(?i)\b(chant(?:ing)?|incantation|spell(?:casting)?|whispering continues)\b') THEN 'chant'
  WHEN regexp_matches(lab, '(?i)\b(song|singing|sings|lyrics?|chorus)\b') OR regexp_matches(t, '[♪♫]') THEN 'lyric' ELSE 'dialogue' END AS kind FROM l""",
)
def prj1_segment_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = F.array_join(T.labels("shown"), "|")
    return _tagged(spark, sf_dir).select("stem", "seq", kind(T.label_is_music(lab) | T.has_note("shown"), T.label_is_chant(lab)).alias("kind"))


@query(
    "agg7_repeated_phrase",
    rf"""WITH {LINES}, p AS (SELECT stem, seq, list_filter(list_transform(regexp_split_to_array(text, '[.!?;]+'), lambda x: trim(regexp_replace(lower(regexp_replace(regexp_replace({_unescaped('x')}, '\{{\\[^}}]*\}}', '', 'g'), '<[^>]+>', '', 'g')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda x: contains(x, ' ')) AS ps FROM lines)
SELECT stem, seq, len(ps) > len(list_distinct(ps)) AS repeated FROM p""",
)
def agg7_repeated_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two equal clauses of two words or more."""
    return lines(spark, sf_dir).select("stem", "seq", T.repeated_phrase("text").alias("repeated"))
