"""Media files, their streams and sidecars: languages, classes, choice of streams, selectors, style recovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import query, table

# Codecs and language names.
TEXT_CODECS = ["subrip", "ass", "ssa", "mov_text", "webvtt"]
BITMAP_CODECS = ["hdmv_pgs_subtitle", "dvd_subtitle"]
ENGLISH = ["eng", "en", "english"]
CHINESE = ["chi", "zho", "zh", "chs", "cht", "cmn", "chinese"]


def is_english(language: Column, title: Column) -> Column:
    """PRJ7: by language or title; no language counts as English."""
    lang = F.lower(F.trim(F.coalesce(language, F.lit(""))))
    return lang.isin([*ENGLISH, ""]) | F.lower(F.coalesce(title, F.lit(""))).contains("english")


def is_chinese(language: Column, title: Column) -> Column:
    """PRJ8."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return F.lower(F.trim(F.coalesce(language, F.lit("")))).isin(CHINESE) | t.contains("chinese") | t.contains("中文")


def is_sdh(*parts: Column) -> Column:
    """PRJ7: hearing-impaired marks in any of the stream's texts."""
    return F.concat_ws(" ", *parts).rlike(r"(?i)\b(sdh|cc|closed captions?|hearing impaired|hi)\b")


def languages(streams: DataFrame) -> DataFrame:
    """PRJ6: has_english and has_chinese of each stem; Chinese counts in text codecs only."""
    known = streams.filter(F.col("codec").isin(TEXT_CODECS + BITMAP_CODECS))
    return known.groupBy("stem").agg(
        F.bool_or(is_english(F.col("language"), F.col("title"))).alias("has_english"),
        F.bool_or(is_chinese(F.col("language"), F.col("title")) & F.col("codec").isin(TEXT_CODECS)).alias("has_chinese"),
    )


def media_class(direct: Column, bilingual: Column, external: Column, english: Column, chinese: Column) -> Column:
    """PRJ4: the first rule that holds."""
    return (
        F.when(bilingual & direct, "direct_bilingual_done").when(bilingual, "ready_bilingual").when(external, "external_mono")
        .when(english & chinese, "embedded_bilingual").when(english, "embedded_only").otherwise("no_subtitles")
    )


def chosen_streams(streams: DataFrame, prefer_sdh: bool = False) -> DataFrame:
    """TOP3: per stem the first plain and the first hearing-impaired English stream, text codecs before bitmaps."""
    sdh = is_sdh(F.col("codec"), F.col("language"), F.col("title"))
    english = streams.filter(is_english(F.col("language"), F.col("title")) & F.col("codec").isin(TEXT_CODECS + BITMAP_CODECS)).withColumn("sdh", sdh)
    place = F.struct(F.col("codec").isin(BITMAP_CODECS), "ordinal")
    found = english.groupBy("stem").agg(
        F.min(F.when(~F.col("sdh"), place)).alias("plain"), F.min(F.when(F.col("sdh"), place)).alias("sdh"), F.min(place).alias("any")
    )
    normal = F.coalesce("sdh", "plain", "any") if prefer_sdh else F.coalesce("plain", "any")
    return found.select("stem", normal["ordinal"].alias("normal"), F.col("sdh.ordinal").alias("sdh"))


def chosen_chinese(streams: DataFrame) -> DataFrame:
    """TOP4: simplified before others, hearing-impaired before plain, then the first."""
    title = F.lower(F.coalesce("title", F.lit("")))
    simplified = title.rlike("simplified|简体|chs")
    chinese = streams.filter(is_chinese(F.col("language"), F.col("title")) & F.col("codec").isin(TEXT_CODECS))
    best = F.min_by("ordinal", F.struct(~simplified, ~is_sdh(F.col("codec"), F.col("language"), F.col("title")), "ordinal"))
    return chinese.groupBy("stem").agg(best.alias("chinese"))


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as subtitle streams of their order."""
    k = F.col("l_orderkey") * 3 + F.col("l_linenumber") * 5
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("stem"), F.col("l_linenumber").alias("ordinal"), F.col("l_suppkey").alias("part"),
        pick(["subrip", "ass", "hdmv_pgs_subtitle", "mp3"], k).alias("codec"), pick(["eng", "chi", "", "fre", "zh"], k + F.col("l_linenumber")).alias("language"),
        pick(["", "SDH", "Chinese simplified", "English CC", "forced"], k + F.col("l_orderkey")).alias("title"),
    )


_S = """s AS (SELECT l_orderkey AS stem, l_linenumber AS ordinal, l_suppkey AS part, ['subrip','ass','hdmv_pgs_subtitle','mp3'][k % 4 + 1] AS codec, ['eng','chi','','fre','zh'][(k + l_linenumber) % 5 + 1] AS language,
  ['','SDH','Chinese simplified','English CC','forced'][(k + l_orderkey) % 5 + 1] AS title FROM (SELECT *, l_orderkey * 3 + l_linenumber * 5 AS k FROM lineitem)),
f AS (SELECT *, language IN ('eng','') OR contains(lower(title), 'english') AS en, language IN ('chi','zh') OR contains(lower(title), 'chinese') AS zh, regexp_matches(concat_ws(' ', codec, language, title), '(?i)\\b(sdh|cc|closed captions?|hearing impaired|hi)\\b') AS sdh, codec = 'hdmv_pgs_subtitle' AS bitmap FROM s WHERE codec <> 'mp3')"""


@query(
    "prj4_prj6_media_class",
    f"""WITH {_S}, l AS (SELECT stem, bool_or(en) AS e, bool_or(zh AND NOT bitmap) AS z FROM f GROUP BY stem), m AS (SELECT DISTINCT stem FROM s)
SELECT m.stem, CASE WHEN m.stem % 11 = 0 AND m.stem % 2 = 0 THEN 'direct_bilingual_done' WHEN m.stem % 11 = 0 THEN 'ready_bilingual' WHEN m.stem % 13 = 0 THEN 'external_mono'
  WHEN coalesce(e AND z, false) THEN 'embedded_bilingual' WHEN coalesce(e, false) THEN 'embedded_only' ELSE 'no_subtitles' END AS class FROM m LEFT JOIN l USING (stem)""",
)
def prj4_prj6_media_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _streams(spark, sf_dir)
    m = s.select("stem").distinct().join(languages(s), "stem", "left").fillna(False, ["has_english", "has_chinese"])
    k = F.col("stem")
    return m.select("stem", media_class(k % 2 == 0, k % 11 == 0, k % 13 == 0, F.col("has_english"), F.col("has_chinese")).alias("class"))


@query(
    "top3_choose_streams",
    f"""WITH {_S} SELECT stem, coalesce(min({{'b': bitmap, 'o': ordinal}}) FILTER (WHERE NOT sdh), min({{'b': bitmap, 'o': ordinal}})).o AS normal, (min({{'b': bitmap, 'o': ordinal}}) FILTER (WHERE sdh)).o AS sdh FROM f WHERE en GROUP BY stem""",
)
def top3_choose_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_streams(_streams(spark, sf_dir))


@query("top4_choose_chinese", f"""WITH {_S} SELECT stem, (min({{'a': NOT regexp_matches(lower(title), 'simplified|简体|chs'), 'b': NOT sdh, 'o': ordinal}})).o AS chinese FROM f WHERE zh AND NOT bitmap GROUP BY stem""")
def top4_choose_chinese(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_chinese(_streams(spark, sf_dir))


def selector_key(c: Column) -> Column:
    """FLT15: lower-case letters and digits."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def episode_code(c: Column) -> Column:
    """FLT16: SxxEyy in lower case, '' without one."""
    return F.lower(F.regexp_extract(c, r"(?i)(s\d{1,2}e\d{1,3})", 1))


def _within(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """Pairs (needle, hay) of texts of which one holds the other, through an inverted index: a hay is posted under all its runs
    of three characters and less, a needle asks under its first three (all, if it has fewer)."""
    runs = lambda n: F.when(F.length("hay") >= n, F.transform(F.sequence(F.lit(1), F.length("hay") - n + 1), lambda i: F.substring(F.col("hay"), i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    posted = hays.select("hay", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), runs(1), runs(2), runs(3)))).alias("run"))
    asked = needles.select("needle", F.substring("needle", 1, 3).alias("run"))
    return asked.join(posted, "run").filter(F.contains("hay", F.col("needle"))).select("needle", "hay")


def selected(media: DataFrame, selectors: DataFrame, name: str = "name") -> DataFrame:
    """FLT15-FLT17: files whose key contains a selector's or lies in it, for any number of files and selectors: distinct keys
    meet by an equality join of their runs, in both directions."""
    wanted = selectors.select(selector_key(F.col("selector")).alias("s")).distinct()
    keys = media.select(selector_key(F.col(name)).alias("k")).distinct()
    holds = _within(wanted.withColumnRenamed("s", "needle"), keys.withColumnRenamed("k", "hay")).select(F.col("hay").alias("_key"))
    lies = _within(keys.withColumnRenamed("k", "needle"), wanted.withColumnRenamed("s", "hay")).select(F.col("needle").alias("_key"))
    found = holds.unionByName(lies).distinct()
    return media.withColumn("_key", selector_key(F.col(name))).join(found, "_key", "left_semi").drop("_key")


@query(
    "flt15_selectors",
    """WITH n AS (SELECT s_suppkey AS id, s_name || ' S0' || s_suppkey % 9 || 'E1' || s_suppkey % 7 AS name FROM supplier) SELECT id, lower(regexp_extract(name, '(?i)(s\\d{1,2}e\\d{1,3})', 1)) AS episode FROM n
WHERE contains(regexp_replace(lower(name), '[^a-z0-9]+', '', 'g'), 's03e1') OR contains(regexp_replace(lower(name), '[^a-z0-9]+', '', 'g'), 'e16')""",
)
def flt15_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    names = table(spark, sf_dir, "supplier").select(k.alias("id"), F.concat("s_name", F.lit(" S0"), k % 9, F.lit("E1"), k % 7).alias("name"))
    wanted = spark.createDataFrame([("S03-E1",), ("e16",)], "selector string")
    return selected(names, wanted).select("id", episode_code(F.col("name")).alias("episode"))


def sidecars(media: DataFrame, files: DataFrame) -> DataFrame:
    """JOIN18/JOIN19: the file of the same stem, else the first of the same episode code."""
    exact = files.groupBy("stem").agg(F.min("path").alias("exact"))
    code = files.withColumn("code", episode_code(F.col("stem"))).filter("code <> ''").groupBy("code").agg(F.min("path").alias("by_code"))
    found = media.withColumn("code", episode_code(F.col("stem"))).join(exact, "stem", "left").join(code, "code", "left")
    return found.select("stem", F.coalesce("exact", "by_code").alias("path"))


# Extensions of subtitles, the best first.
SUBTITLES = ["ass", "ssa", "srt", "vtt"]


def sidecar_candidates(media: DataFrame, files: DataFrame) -> DataFrame:
    """JOIN19: for each medium (folder, stem) the subtitles (folder, name) beside it that are named as it is, or as it is and a
    dot: folder, stem, name, place. Better extensions come first, then names. A file meets media by the parts of its name up
    to each of its dots, an equality join."""
    parts = F.split("name", r"\.")
    ext = F.lower(F.element_at(parts, -1))
    heads = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    shown = files.filter((F.size(parts) > 1) & ext.isin(SUBTITLES)).withColumn("stem", F.explode(heads)).filter("stem <> ''")
    rank = F.array_position(F.array(*map(F.lit, SUBTITLES)), ext)
    order = Window.partitionBy("folder", "stem").orderBy(rank, F.lower("name"), "name")
    met = shown.join(media.select("folder", "stem").distinct(), ["folder", "stem"], "left_semi")
    return met.select("folder", "stem", "name", F.row_number().over(order).alias("place"))


@query(
    "join19_sidecar_candidates",
    """WITH p AS (SELECT p_partkey AS id, p_brand AS folder, 'Show.' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '.Part' || p_partkey % 4 ELSE '' END AS stem FROM part),
m AS (SELECT DISTINCT folder, stem FROM p WHERE id % 3 = 0), f AS (SELECT DISTINCT folder, stem || CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN '.en' ELSE '.zh.forced' END || CASE id % 7 WHEN 0 THEN '.ass' WHEN 1 THEN '.ssa' WHEN 2 THEN '.SRT' WHEN 3 THEN '.vtt' WHEN 4 THEN '.mkv' WHEN 5 THEN '.srt' ELSE '' END AS name FROM p)
SELECT m.folder, m.stem, f.name, row_number() OVER (PARTITION BY m.folder, m.stem ORDER BY list_position(['ass', 'ssa', 'srt', 'vtt'], lower(regexp_extract(name, '([^.]*)$', 1))), lower(name), name)::INTEGER AS place
FROM m JOIN f ON f.folder = m.folder AND starts_with(f.name, m.stem || '.') WHERE lower(regexp_extract(name, '([^.]*)$', 1)) IN ('ass', 'ssa', 'srt', 'vtt')""",
)
def join19_sidecar_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems that begin others: Show.7 and Show.7.Part2."""
    k = F.col("p_partkey")
    stem = F.concat(F.lit("Show."), "p_size", F.when(k % 2 == 0, F.concat(F.lit(".Part"), k % 4)).otherwise(""))
    p = table(spark, sf_dir, "part").select(k.alias("id"), F.col("p_brand").alias("folder"), stem.alias("stem"))
    i = F.col("id")
    tag = F.when(i % 3 == 0, "").when(i % 3 == 1, ".en").otherwise(".zh.forced")
    ext = F.when(i % 7 == 0, ".ass").when(i % 7 == 1, ".ssa").when(i % 7 == 2, ".SRT").when(i % 7 == 3, ".vtt").when(i % 7 == 4, ".mkv").when(i % 7 == 5, ".srt").otherwise("")
    return sidecar_candidates(p.filter("id % 3 = 0"), p.select("folder", F.concat("stem", tag, ext).alias("name")).distinct())


@query(
    "join18_sidecars",
    """WITH m AS (SELECT 'Show S0' || s_suppkey % 9 || 'E' || (10 + s_suppkey % 50) || ' v' || s_suppkey AS stem, s_suppkey AS id FROM supplier), f AS (SELECT stem, stem || '.json' AS path FROM m WHERE id % 3 = 0),
c AS (SELECT lower(regexp_extract(stem, '(?i)(s\\d{1,2}e\\d{1,3})', 1)) AS code, min(path) AS p FROM f GROUP BY 1)
SELECT m.stem, coalesce(f.path, c.p) AS path FROM m LEFT JOIN f ON f.stem = m.stem LEFT JOIN c ON c.code = lower(regexp_extract(m.stem, '(?i)(s\\d{1,2}e\\d{1,3})', 1))""",
)
def join18_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    m = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Show S0"), k % 9, F.lit("E"), k % 50 + 10, F.lit(" v"), k).alias("stem"), k.alias("id"))
    return sidecars(m.select("stem"), m.filter("id % 3 = 0").select("stem", F.concat("stem", F.lit(".json")).alias("path")))


def recovered_styles(events: DataFrame, cache: DataFrame) -> DataFrame:
    """JOIN22: the cached style of the pair; else of the English text, if it is the only one; else of the Chinese text.
    Of several styles for a key the one of highest priority counts."""
    best = F.max_by("style", F.struct("priority", "style"))
    pair = cache.groupBy("zh", "en").agg(best.alias("by_pair"))
    english = cache.groupBy("en").agg(F.when(F.count_distinct("style") == 1, F.first("style")).alias("by_en"))
    chinese = cache.groupBy("zh").agg(best.alias("by_zh"))
    found = events.join(pair, ["zh", "en"], "left").join(english, "en", "left").join(chinese, "zh", "left")
    return found.select("id", F.coalesce("by_pair", "by_en", "by_zh").alias("style"))


@query(
    "join22_style_recovery",
    """WITH e AS (SELECT p_partkey AS id, p_name AS zh, p_brand AS en, p_type AS style, p_size AS priority FROM part), c AS (SELECT * FROM e WHERE id % 3 = 0),
p AS (SELECT zh, en, arg_max(style, {'p': priority, 's': style}) AS a FROM c GROUP BY zh, en), n AS (SELECT en, CASE WHEN count(DISTINCT style) = 1 THEN min(style) END AS b FROM c GROUP BY en), z AS (SELECT zh, arg_max(style, {'p': priority, 's': style}) AS d FROM c GROUP BY zh)
SELECT id, coalesce(a, b, d) AS style FROM e LEFT JOIN p USING (zh, en) LEFT JOIN n USING (en) LEFT JOIN z USING (zh)""",
)
def join22_style_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("zh"), F.col("p_brand").alias("en"), F.col("p_type").alias("style"), F.col("p_size").alias("priority"))
    return recovered_styles(e.select("id", "zh", "en"), e.filter("id % 3 = 0"))


def overlay_union(base: DataFrame, *overlays: DataFrame, styles: tuple[str, ...] = ("OCR_TRANSLATION", "EXPLANATION_NOTE")) -> DataFrame:
    """SET1: base events without earlier overlays, and the new ones; running it again changes nothing. Ordered by the
    start as text, as finished files are (P-3), so seq says the place."""
    out = base.filter(~F.col("style").isin(list(styles)))
    for o in overlays:
        out = out.unionByName(o)
    return out.withColumn("place", F.row_number().over(Window.partitionBy("stem").orderBy("start", "seq")))


@query(
    "set1_overlay_union",
    """WITH b AS (SELECT user_id AS stem, event_id AS seq, event_type AS style, (event_id * 977 % 36000 // 100)::VARCHAR AS start FROM events), o AS (SELECT stem, seq + 1000000 AS seq, 'OCR_TRANSLATION' AS style, start FROM b WHERE seq % 3 = 0),
u AS (SELECT * FROM b WHERE style <> 'click' UNION ALL SELECT * FROM o) SELECT stem, seq, row_number() OVER (PARTITION BY stem ORDER BY start, seq)::INTEGER AS place FROM u""",
)
def set1_overlay_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    b = table(spark, sf_dir, "events").select(F.col("user_id").alias("stem"), k.alias("seq"), F.col("event_type").alias("style"), F.floor(k * 977 % 36000 / 100).cast("string").alias("start"))
    o = b.filter("seq % 3 = 0").select("stem", (F.col("seq") + 1_000_000).alias("seq"), F.lit("OCR_TRANSLATION").alias("style"), "start")
    return overlay_union(b, o, styles=("click",)).select("stem", "seq", "place")
