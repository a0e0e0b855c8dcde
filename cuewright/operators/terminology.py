"""Terminology: entries with aliases, scope, series and case, their precedence, matching, ranking and learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import CREDIT, col, folded, has_han, longest_piece, pieces, normalize_inline, normalize_text, text, word_pattern
from ..plans.registry import query, table
from ..sources.staging import LINES, lines

# Names of kinds in scopes, main characters that need no note, sources of automatic reviews.
KINDS = {
    "dialogue": ["dialogue", "spoken", "line"],
    "lyric": ["lyric", "lyrics", "music", "song"],
    "chant": ["chant", "incantation", "spell"],
    "ocr": ["ocr", "screen"],
    "note": ["note", "cultural_note"],
}
NOISE_TERMS = ["georgie", "mandy", "mcallister", "cooper", "sheldon", "meemaw", "connie", "dale", "audra", "cecee", "cece", "ruben"]


def _scopes(scope: Column | str) -> Column:
    """The kinds that a scope lists, set apart by commas, blanks, bars or slashes."""
    return F.filter(F.split(F.lower(text(scope)), r"[,/| ]+"), lambda s: s != "")


def _kind_fits(scopes: Column, kind: Column | str, default: bool = True) -> Column:
    names = F.create_map(*[x for k, v in KINDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.when(F.size(scopes) == 0, default).otherwise(F.array_contains(scopes, "all") | F.arrays_overlap(scopes, F.coalesce(F.try_element_at(names, col(kind)), F.array(col(kind)))))


def scope_fits(scope: Column | str, kind: Column | str, default: bool = True) -> Column:
    """Whether a scope, a list of kinds set apart by commas, blanks, bars or slashes, holds the kind; ``default``: of no scope."""
    return _kind_fits(_scopes(scope), kind, default)


def series_fits(series: Column | str, name: Column | str) -> Column:
    """Whether a file's name holds the series as whole words; separators count as blanks, no series fits all."""
    plain = lambda c: normalize_inline(F.regexp_replace(text(c), r"[._\-]+", " "))
    return (plain(series) == "") | F.rlike(plain(name), word_pattern(plain(series)))


def valid_entries(entries: DataFrame) -> DataFrame:
    """DIC4: entries with source and translation that no review has refused."""
    source, preferred = normalize_inline("source_en"), normalize_inline("preferred_zh")
    return entries.withColumns({"source_en": source, "preferred_zh": preferred}).filter((F.col("source_en") != "") & (F.col("preferred_zh") != "") & F.coalesce("reviewed", F.lit(True)))


def _series_words(c: Column | str) -> Column:
    """A name with separators as blanks, folded, in pieces."""
    return pieces(folded(normalize_inline(F.regexp_replace(text(c), r"[._\-]+", " "))))


def files_of_series(files: DataFrame, series: DataFrame) -> DataFrame:
    """Each file with the series (a column ``series``) that its name holds; a series without a name, or null, fits all.

    Files meet the series of whose name they have the longest piece, an equality join; the pattern decides.
    """
    longest = F.array_max(F.transform(_series_words("series"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    every = series.select("series").distinct().withColumn("_key", F.coalesce(longest, F.lit("")))
    pieces = F.array_distinct(F.concat(F.array(F.lit("")), _series_words("name")))
    return files.withColumn("_key", F.explode(pieces)).join(every, "_key").filter(series_fits("series", "name")).drop("_key")


def project_entries(entries: DataFrame, files: DataFrame) -> DataFrame:
    """DIC4: each file's valid entries, by the series in its name."""
    valid = valid_entries(entries)
    return files_of_series(files, valid).join(valid.withColumnRenamed("series", "_series"), F.col("series").eqNullSafe(F.col("_series"))).drop("_series")


def variants_of(entries: DataFrame, *listed: str, chinese: bool = False) -> DataFrame:
    """What texts meet entries by: one row for each source and alias, with its longest piece (``_piece``) and what ``stands``
    reads; ``chinese``: also for each Chinese alias of two characters or more, with its first two."""
    valid = valid_entries(entries).withColumn("_scopes", _scopes("scope"))
    variants = valid.select("*", F.explode(F.array_distinct(F.concat(F.array("source_en"), F.filter(F.transform(F.coalesce("aliases", F.array()), normalize_inline), lambda a: a != "")))).alias("_variant"))
    variants = variants.withColumn("_fold", folded("_variant"))
    pattern = word_pattern("_variant")
    cased = F.coalesce("case_sensitive", F.lit(False))
    variants = variants.withColumns({"_piece": longest_piece("_fold"), "_pattern": F.when(cased, F.regexp_replace(pattern, r"^\(\?iuU\)", "(?U)")).otherwise(pattern), "_chinese": F.lit(False), "_exact": F.when(cased, F.col("_variant")), "_whole": ~cased & F.col("_fold").rlike("^[0-9a-z]+$")})
    if chinese:
        aliases = valid.select("*", F.explode(F.filter(F.transform(F.coalesce("zh_aliases", F.array()), normalize_inline), lambda a: F.length(a) >= 2)).alias("_variant"))
        none = F.lit(None).cast("string")
        aliases = aliases.withColumns({"_fold": F.col("_variant"), "_piece": F.substring("_variant", 1, 2), "_pattern": none, "_chinese": F.lit(True), "_exact": none, "_whole": F.lit(False)})
        variants = variants.unionByName(aliases)
    every = (F.size("_scopes") == 0) | F.array_contains("_scopes", "all")
    # The kinds that the scope holds: the known ones by their names, any other as it stands there.
    known = F.array_compact(F.array(*[F.when(F.arrays_overlap("_scopes", F.array(*map(F.lit, names))), k) for k, names in KINDS.items()]))
    kinds = F.concat(F.filter("_scopes", lambda s: ~s.isin(list(KINDS))), known)
    return variants.select(*listed, every.alias("_every"), kinds.alias("_kinds"), "_fold", "_pattern", "_exact", "_whole", "_piece", "_chinese")


def keyed_texts(texts: DataFrame, column: str = "text", kind: str = "kind", target: str | None = None) -> DataFrame:
    """Texts with the pieces that they have (``_keys``) and what ``stands`` reads, each worked out once a text."""
    plain = texts.withColumn("_text", normalize_inline(column)).withColumn("_folded", folded("_text"))
    # Where no character folds to several, a piece of the folded text is one of the text.
    plain = plain.withColumns({"_alike": F.col("_folded") == F.lower("_text"), "_kind": col(kind)})
    keys = pieces("_folded")
    if target is not None:
        shown = text(target)
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(shown) - 1, F.lit(1))), lambda i: F.substring(shown, i, F.lit(2)))
        keys = F.when(F.col("_text") == "", pairs).otherwise(keys)
    return plain.withColumns({"_keys": F.array_distinct(keys), "_chinese": F.col("_text") == ""})


def stands(target: str | None = None) -> Column:
    """Whether a variant that a keyed text has met by a piece stands there, and its scope fits."""
    there = F.contains("_folded", F.col("_fold")) & F.coalesce(F.contains("_text", F.col("_exact")), F.lit(True))
    words = F.when(F.col("_whole") & F.col("_alike"), True).when(there, F.rlike("_text", F.col("_pattern"))).otherwise(False)
    held = words if target is None else F.when(F.col("_chinese"), F.contains(text(target), F.col("_fold"))).otherwise(words)
    return (F.col("_every") | F.array_contains("_kinds", F.col("_kind"))) & held


def met_entries(texts: DataFrame, entries: DataFrame, column: str = "text", kind: str = "kind", target: str | None = None) -> DataFrame:
    """JOIN7: texts with each entry whose source or alias stands in them as a whole word or phrase, if the scope fits;
    a text without source is matched by the entry's Chinese aliases (of two characters or more) in the ``target``. All
    columns of both, once for each variant that matches.

    A text meets only entries of which it has the longest piece, an equality join; then the words must stand there, and only
    then a pattern decides whether as whole words. One run of letters and digits is a piece, so no pattern is needed for it.
    """
    listed = [c for c in entries.columns if c not in texts.columns]
    variants = variants_of(entries, *listed, chinese=target is not None)
    # An outer generator: for others Spark infers a filter, for which the pieces would be found twice.
    met = keyed_texts(texts, column, kind, target).withColumn("_piece", F.explode_outer("_keys")).drop("_keys").join(variants, ["_piece", "_chinese"])
    return met.filter(stands(target)).select(*texts.columns, *listed)


def matching_entries(texts: DataFrame, entries: DataFrame, column: str = "text", kind: str = "kind", target: str | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """JOIN7: the matches of ``met_entries``, each pair of text and entry once. ``keep``: the columns that tell texts apart,
    if not all do; only these are moved."""
    return met_entries(texts, entries, column, kind, target).select(*(texts.columns if keep is None else keep), "ordinal", "source_en", "preferred_zh").distinct()


def first_entries(matches: DataFrame, *keys: str, limit: int = 32) -> DataFrame:
    """JOIN8: the first entries of each key, in dictionary order."""
    return matches.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("ordinal"))).filter(F.col("_n") <= limit).drop("_n")


def ranked_hints(matches: DataFrame, *keys: str, limit: int = 24) -> DataFrame:
    """JOIN9: of the hints that match a text the best by confidence, support and length of the source, ties by order."""
    word = F.lower(F.trim(text("confidence")))
    words = F.when(word == "high", 3).when(word == "low", 1).otherwise(2)  # a number that is written as text is no such word
    number = matches.schema["confidence"].dataType.simpleString() not in ("string", "void")
    confidence = F.coalesce(F.col("confidence").cast("int"), words) if number else words
    order = Window.partitionBy(*keys).orderBy(confidence.desc(), support_count("support_count").desc(), F.length("source_en").desc(), "ordinal")
    return matches.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def support_count(c: Column | str) -> Column:
    """STR48: a whole number of at least 1, whatever is written there."""
    return F.greatest(F.coalesce(F.try_to_number(F.regexp_extract(text(c), r"^\s*(\d{1,9})\s*$", 1), F.lit("999999999")).cast("int"), F.lit(1)), F.lit(1))


def guidance(*columns: str) -> Column:
    """STR49: the first that holds text."""
    return F.coalesce(*[F.when(normalize_inline(c) != "", normalize_inline(c)) for c in columns], F.lit(""))


def guidance_line(source: Column, says: Column, avoid: Column) -> Column:
    """STR50: one line of guidance, with what to avoid."""
    return F.concat(F.lit("- "), source, F.lit("："), says, F.when(text(avoid) != "", F.concat(F.lit("；规避："), avoid)).otherwise(""))


def terminology_line(source: Column, preferred: Column, note: Column) -> Column:
    """STR50: one exact term, with a note on its use."""
    return F.concat(F.lit("- "), source, F.lit(" -> "), preferred, F.when(text(note) != "", F.concat(F.lit("；使用说明（不要照抄）："), note)).otherwise(""))


def noise_term(c: Column | str) -> Column:
    """FLT12: terms that no glossary learns: empty, Chinese, main characters (alone or in a phrase), credits."""
    x = normalize_text(c)
    parts = F.split(F.lower(x), r"\s+")
    return (x == "") | has_han(x) | F.arrays_overlap(parts, F.array(*map(F.lit, NOISE_TERMS))) | x.rlike(CREDIT)


def reviewed_names(answers: DataFrame, candidates: DataFrame) -> DataFrame:
    """UDF8: of a model's answers (stem, ordinal, source_en, preferred_zh, aliases, zh_aliases) those that name a candidate
    (stem, source_en) and have Chinese; the first of a name counts. Aliases must be candidates, Chinese aliases neither
    hold the translation nor lie in it."""
    key = lambda c: F.lower(normalize_inline(c))
    known = candidates.groupBy("stem", key("source_en").alias("_key")).agg(F.max_by("source_en", "source_en").alias("_name"))
    zh = normalize_inline("preferred_zh")
    met = answers.withColumns({"_key": key("source_en"), "preferred_zh": zh}).join(known, ["stem", "_key"]).filter(has_han("preferred_zh"))
    first = met.withColumn("_n", F.row_number().over(Window.partitionBy("stem", "_key").orderBy("ordinal"))).filter("_n = 1").drop("_n", "source_en")
    apart = lambda a: has_han(a) & ~a.contains(F.col("preferred_zh")) & ~F.col("preferred_zh").contains(a)
    first = first.withColumn("zh_aliases", F.sort_array(F.array_distinct(F.filter(F.transform(F.coalesce("zh_aliases", F.array()), normalize_inline), apart))))
    alias = first.select("stem", "_key", F.explode(F.array_distinct(F.transform(F.coalesce("aliases", F.array()), key))).alias("_alias"))
    alias = alias.filter("_alias <> _key").join(known.select("stem", F.col("_key").alias("_alias"), F.col("_name").alias("_alias_name")), ["stem", "_alias"])
    order = F.sort_array(F.collect_set(F.struct((-F.size(F.split("_alias_name", " "))).alias("w"), F.lower("_alias_name").alias("l"), F.col("_alias_name").alias("n"))))
    named = alias.groupBy("stem", "_key").agg(order["n"].alias("aliases"))
    out = first.drop("aliases").join(named, ["stem", "_key"], "left")
    return out.select("stem", F.col("_name").alias("source_en"), "preferred_zh", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), "zh_aliases")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as entries: the first two words, the third as an alias."""
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    i = F.col("item_id")
    rows = table(spark, sf_dir, "benchmark").withColumn("w", w).filter(F.size("w") >= 3)
    return rows.select(
        F.col("item_id").alias("ordinal"), F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("source_en"), F.array(F.col("w")[2]).alias("aliases"), F.concat(F.lit("译名"), i.cast("string")).alias("preferred_zh"),
        F.array(F.concat(F.lit("别名"), i.cast("string"))).alias("zh_aliases"), (i % 3 == 0).alias("case_sensitive"),
        F.when(i % 4 == 0, "dialogue, lyric").when(i % 4 == 1, "ocr").when(i % 4 == 2, "").otherwise("all").alias("scope"), F.when(i % 5 == 0, "Series One").alias("series"), (i % 7 != 3).alias("reviewed"),
    )


_ENTRIES = r"""words AS (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
entries AS (SELECT item_id AS ordinal, w[1] || ' ' || w[2] AS source_en, w[3] AS alias, '译名' || item_id AS preferred_zh, '别名' || item_id AS zh_alias, item_id % 3 = 0 AS cased,
  CASE item_id % 4 WHEN 0 THEN 'dialogue lyric' WHEN 1 THEN 'ocr' ELSE 'all' END AS scope FROM words WHERE len(w) >= 3 AND item_id % 7 <> 3)"""
_KIND = "CASE seq % 3 WHEN 0 THEN 'dialogue' WHEN 1 THEN 'lyric' ELSE 'ocr' END"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 3
    return lines(spark, sf_dir).withColumn("kind", F.when(k == 0, "dialogue").when(k == 1, "lyric").otherwise("ocr"))


@query(
    "join7_terminology",
    rf"""WITH {LINES}, {_ENTRIES}, x AS (SELECT stem, seq, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t, {_KIND} AS kind FROM lines),
v AS (SELECT ordinal, source_en, preferred_zh, cased, scope, unnest([source_en, alias]) AS v FROM entries)
SELECT DISTINCT stem, seq, ordinal, preferred_zh FROM x JOIN v ON contains(lower(t), lower(v)) AND (scope = 'all' OR contains(scope, kind))
  AND CASE WHEN cased THEN regexp_matches(t, '(^|[^0-9A-Za-z])' || v || '([^0-9A-Za-z]|$)') ELSE regexp_matches(lower(t), '(^|[^0-9a-z])' || lower(v) || '([^0-9a-z]|$)') END""",
)
def join7_terminology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching_entries(_texts(spark, sf_dir), _entries(spark, sf_dir), keep=("stem", "seq")).select("stem", "seq", "ordinal", "preferred_zh")


@query(
    "join8_join9_hints",
    rf"""WITH {LINES}, {_ENTRIES}, x AS (SELECT stem, seq, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t, {_KIND} AS kind FROM lines),
v AS (SELECT ordinal, source_en, cased, scope, unnest([source_en, alias]) AS v FROM entries),
m AS (SELECT DISTINCT stem, ordinal, source_en FROM x JOIN v ON contains(lower(t), lower(v)) AND (scope = 'all' OR contains(scope, kind))
  AND CASE WHEN cased THEN regexp_matches(t, '(^|[^0-9A-Za-z])' || v || '([^0-9A-Za-z]|$)') ELSE regexp_matches(lower(t), '(^|[^0-9a-z])' || lower(v) || '([^0-9a-z]|$)') END),
f AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY ordinal) AS n FROM m)
SELECT stem, ordinal, row_number() OVER (PARTITION BY stem ORDER BY CASE ordinal % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END DESC, greatest(ordinal % 5, 1) DESC, length(source_en) DESC, ordinal)::INTEGER AS rank FROM f WHERE n <= 32
QUALIFY rank <= 6""",
)
def join8_join9_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = matching_entries(_texts(spark, sf_dir), _entries(spark, sf_dir), keep=("stem",)).select("stem", "ordinal", "source_en")
    i = F.col("ordinal")
    hints = first_entries(met, "stem").withColumns({"confidence": F.when(i % 3 == 0, "high").when(i % 3 == 1, "medium").otherwise("low"), "support_count": F.when(i % 5 > 0, (i % 5).cast("string")).otherwise("none")})
    return ranked_hints(hints, "stem", limit=6).select("stem", "ordinal", "rank")


@query(
    "dic4_project_entries",
    rf"""WITH {_ENTRIES}, f AS (SELECT DISTINCT conv_id AS stem, CASE conv_id % 3 WHEN 0 THEN 'Series.One.S01E' || conv_id ELSE 'SeriesOne_S01E' || conv_id END AS name FROM conversations)
SELECT stem, count(*) AS entries FROM f JOIN entries ON ordinal % 5 <> 0 OR starts_with(name, 'Series.One.') GROUP BY stem""",
)
def dic4_project_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("conv_id").cast("string")
    files = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem"), F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("Series.One.S01E"), s)).otherwise(F.concat(F.lit("SeriesOne_S01E"), s)).alias("name")).distinct()
    return project_entries(_entries(spark, sf_dir), files).groupBy("stem").agg(F.count("*").alias("entries"))


@query(
    "join7_chinese_aliases",
    rf"""WITH {LINES}, {_ENTRIES}, x AS (SELECT stem, seq, '看' || '别名' || (stem % 50) || '吧' AS t FROM lines WHERE seq % 3 = 2)
SELECT stem, seq, ordinal FROM x JOIN entries ON contains(t, zh_alias) AND scope IN ('ocr', 'all')""",
)
def join7_chinese_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-screen texts without English source are matched by their Chinese."""
    zh = F.concat(F.lit("看别名"), (F.col("stem") % 50).cast("string"), F.lit("吧"))
    shown = _texts(spark, sf_dir).filter("seq % 3 = 2").withColumns({"text": F.lit(""), "zh": zh})
    return matching_entries(shown, _entries(spark, sf_dir), target="zh", keep=("stem", "seq")).select("stem", "seq", "ordinal")


@query(
    "flt12_set4_noise_terms",
    rf"""WITH t AS (SELECT item_id, CASE item_id % 6 WHEN 0 THEN 'Mandy ' || left(text, 9) WHEN 1 THEN '塔' || left(text, 3) WHEN 2 THEN 'www.' || left(text, 3) WHEN 3 THEN ' ' ELSE left(text, 12) END AS term FROM benchmark),
n AS (SELECT item_id, trim(regexp_replace(replace(term, '\N', ' '), '\s+', ' ', 'g')) AS x FROM t)
SELECT item_id, x = '' OR regexp_matches(x, '[一-鿿]') OR len(list_intersect(string_split(lower(x), ' '), {NOISE_TERMS})) > 0 OR regexp_matches(x, '{CREDIT.removeprefix("(?i)")}', 'i') AS noise FROM n""",
)
def flt12_set4_noise_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("item_id") % 6, F.col("text")
    term = F.when(k == 0, F.concat(F.lit("Mandy "), F.substring(t, 1, 9))).when(k == 1, F.concat(F.lit("塔"), F.substring(t, 1, 3))).when(k == 2, F.concat(F.lit("www."), F.substring(t, 1, 3))).when(k == 3, " ").otherwise(F.substring(t, 1, 12))
    return table(spark, sf_dir, "benchmark").select("item_id", noise_term(term).alias("noise"))


@query(
    "udf8_reviewed_names",
    r"""WITH w AS (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
c AS (SELECT item_id % 20 AS stem, max(w[1]) AS source_en, lower(w[1]) AS key FROM w WHERE len(w) >= 2 AND item_id % 2 = 0 GROUP BY ALL),
a AS (SELECT item_id % 20 AS stem, item_id AS ordinal, lower(w[1]) AS key, CASE item_id % 4 WHEN 2 THEN 'plain' ELSE '译' || (item_id % 9) END AS zh, lower(w[2]) AS alias FROM w WHERE len(w) >= 2),
m AS (SELECT a.*, c.source_en, row_number() OVER (PARTITION BY a.stem, a.key ORDER BY ordinal) AS n FROM a JOIN c USING (stem, key) WHERE zh <> 'plain')
SELECT m.stem, m.source_en, zh AS preferred_zh, coalesce(CASE WHEN x.source_en IS NOT NULL AND m.alias <> m.key THEN x.source_en END, '') AS aliases, '另译' AS zh_aliases FROM m LEFT JOIN c x ON x.stem = m.stem AND x.key = m.alias WHERE n = 1""",
)
def udf8_reviewed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)).alias("w")).filter(F.size("w") >= 2)
    i = F.col("item_id")
    candidates = w.filter(i % 2 == 0).select((i % 20).alias("stem"), F.col("w")[0].alias("source_en"))
    zh = F.when(i % 4 == 2, "plain").otherwise(F.concat(F.lit("译"), (i % 9).cast("string")))
    answers = w.select((i % 20).alias("stem"), i.alias("ordinal"), F.upper(F.col("w")[0]).alias("source_en"), zh.alias("preferred_zh"), F.array(F.upper(F.col("w")[1]), F.lit("Nobody")).alias("aliases"), F.array(F.lit("另译"), zh, F.lit("alias")).alias("zh_aliases"))
    out = reviewed_names(answers, candidates)
    return out.withColumns({"aliases": F.array_join("aliases", ";"), "zh_aliases": F.array_join("zh_aliases", ";")})
