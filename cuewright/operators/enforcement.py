"""Terminology enforced in translated text: known variants become the preferred form, over files, texts and display units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import col, folded, let, normalize_inline, normalize_text, text, word_pattern
from ..plans.registry import query, table
from ..sources.staging import CUES, LINES, cues, lines
from .finished import BILINGUAL, OVERLAY, all_targets, evaluated, marked_events, pairs_of_older_files, two_sides
from .terminology import _entries, files_of_series, keyed_texts, stands, valid_entries, variants_of

#: What an entry holds, in a line's list of matched entries; the list is in the order of ``place``.
ENTRY = "place struct<source:int,ordinal:long>, preferred string, zh_aliases array<string>, variants array<string>, cased boolean"


def _longest_first(items: Column) -> Column:
    """Distinct texts, longer ones first, equal lengths by text."""
    keyed = F.transform(F.array_distinct(F.filter(items, lambda a: a != "")), lambda a: F.struct((-F.length(a)).alias("n"), a.alias("a")))
    return F.transform(F.array_sort(keyed), lambda x: x["a"])


def entry(source: Column | int, ordinal: str = "ordinal") -> Column:
    """One entry as the fold takes it."""
    plain = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), normalize_inline)
    return F.struct(
        F.struct(F.lit(source).cast("int").alias("source"), F.col(ordinal).cast("long").alias("ordinal")).alias("place"),
        normalize_inline("preferred_zh").alias("preferred"),
        _longest_first(plain("zh_aliases")).alias("zh_aliases"),
        _longest_first(F.concat(F.array(normalize_inline("source_en")), plain("aliases"))).alias("variants"),
        F.coalesce("case_sensitive", F.lit(False)).alias("cased"),
    )


def prepared(e: Column) -> Column:
    """An entry with what the fold would else find anew for each line: the folded words of each variant."""
    uses = F.transform(e["variants"], lambda v: F.struct(v.alias("variant"), F.split(folded(normalize_text(v)), " ").alias("words")))
    return F.struct(e["place"].alias("place"), e["preferred"].alias("preferred"), e["zh_aliases"].alias("zh_aliases"), uses.alias("uses"), e["cased"].alias("cased"))


def packed(e: Column) -> Column:
    """A prepared entry with its texts in one, a third of its size: matches are sorted by line. Normalised texts hold no tabs or line
    breaks, so these part them, each a single character, for which no pattern is compiled."""
    parts = [e["preferred"], F.array_join(e["zh_aliases"], "\n"), F.array_join(F.transform(e["uses"], lambda u: u["variant"]), "\n"), F.array_join(F.transform(e["uses"], lambda u: F.array_join(u["words"], " ")), "\n")]
    return F.struct(e["place"]["source"].alias("source"), e["place"]["ordinal"].alias("ordinal"), e["cased"].alias("cased"), F.concat_ws("\t", *parts).alias("texts"))


def unpacked(e: Column) -> Column:
    def of_texts(t: Column) -> Column:
        listed = lambda i, f: F.when(t[i] == "", F.array()).otherwise(f(F.split(t[i], "\n")))
        use = lambda v, w: F.struct(v.alias("variant"), F.split(w, " ").alias("words"))
        uses = listed(2, lambda v: F.zip_with(v, F.split(t[3], "\n"), use))
        place = F.struct(e["source"].alias("source"), e["ordinal"].alias("ordinal"))
        return F.struct(place.alias("place"), t[0].alias("preferred"), listed(1, lambda z: z).alias("zh_aliases"), uses.alias("uses"), e["cased"].alias("cased"))

    return let(F.split(e["texts"], "\t"), of_texts)


def folded_in(c: Column, entries: Column) -> Column:
    """The fold of ``canonicalized`` over prepared entries. The folded text goes along and is made anew only after a change."""
    state = lambda x: let(x, lambda y: F.struct(y.alias("x"), folded(y).alias("held")))

    def of_entry(acc: Column, e: Column) -> Column:
        preferred = e["preferred"]
        skip = lambda x, a: ~F.contains(x, a) | (a == preferred) | (F.contains(preferred, a) & F.contains(x, preferred))
        chinese = F.aggregate(e["zh_aliases"], acc["x"], lambda x, a: F.when(skip(x, a), x).otherwise(F.replace(x, a, preferred)))
        begun = let(chinese, lambda x: F.when(x == acc["x"], acc).otherwise(state(x)))
        literal = F.regexp_replace(preferred, r"([\\$])", r"\\$1")
        pattern = lambda v: F.when(e["cased"], F.regexp_replace(word_pattern(v), r"^\(\?iuU\)", "(?U)")).otherwise(word_pattern(v))
        # Most variants are not in the text: a pattern is made and compiled only for those of which all words stand there.
        met = lambda t, u: F.forall(u["words"], lambda w: F.contains(t["held"], w))
        done = F.aggregate(e["uses"], begun, lambda t, u: F.when(met(t, u), state(F.regexp_replace(t["x"], pattern(u["variant"]), literal))).otherwise(t))
        return F.when(preferred == "", acc).otherwise(done)

    return F.aggregate(entries, state(c), of_entry)["x"]


def canonicalized(c: Column | str, entries: Column | str) -> Column:
    """STR23 over all matched entries, one after the other: Chinese aliases, the longest first, become the preferred form,
    unless they are part of it and it stands there already; then English variants as whole words."""
    return folded_in(text(c), F.transform(F.array_sort(col(entries)), prepared))


def enforced_text(c: Column, entries: Column, fallback: Column) -> tuple[Column, Column]:
    """STR24: the text with its variants replaced, or the fallback, so treated, where the text lacks a preferred form that
    the fallback has; and the forms that are missing all the same (none: an empty list)."""
    forms = F.transform(F.array_sort(col(entries)), lambda e: e["preferred"])

    def of_both(both: Column) -> Column:
        result, other = both["result"], both["other"]
        needed = F.coalesce(F.when(text(fallback) != "", F.filter(forms, lambda p: F.contains(other, p))), F.array().cast("array<string>"))
        final = lambda needed: F.when(F.forall(needed, lambda p: F.contains(result, p)), result).otherwise(other)
        missing = lambda t, needed: F.filter(needed, lambda p: ~F.contains(t, p))
        return let(needed, lambda n: let(final(n), lambda t: F.struct(t.alias("text"), missing(t, n).alias("missing"))))

    done = let(F.struct(canonicalized(c, entries).alias("result"), canonicalized(fallback, entries).alias("other")), of_both)
    return done["text"], done["missing"]


def merged_terminology(project: DataFrame, own: DataFrame, files: DataFrame) -> DataFrame:
    """Entries of the project (by the series in a file's name, ``stem`` null) and of single files (``stem``): a file's entry
    goes if the project has one of that source for this file, and of a file's entries of one source the first stays.

    Of a source that the project has more than once, the first that fits a file counts, whether it matches or not: entries
    that are the first nowhere go, the others name the series (``before``) of which a file has an earlier one.
    """
    key = F.lower(normalize_inline("source_en"))
    project = valid_entries(project).withColumn("_key", key)
    own = valid_entries(own).withColumn("_key", key)
    of_all = normalize_inline(F.regexp_replace(text("series"), r"[._\-]+", " ")) == ""
    of_key = Window.partitionBy("_key")
    least = F.least(F.min(F.when(of_all, F.col("ordinal"))).over(of_key), F.min("ordinal").over(Window.partitionBy("_key", "series")))
    project = project.withColumn("_least", least).filter(~F.coalesce(F.col("ordinal") > F.col("_least"), F.lit(False))).drop("_least")
    others = F.collect_set(F.when(~of_all, F.struct("ordinal", "series"))).over(of_key)
    project = project.withColumn("_others", others).withColumn("before", F.transform(F.filter("_others", lambda o: o["ordinal"] < F.col("ordinal")), lambda o: o["series"])).drop("_others")
    own = own.groupBy("stem", "_key").agg(F.min_by(F.struct(*[c for c in own.columns if c not in ("stem", "_key")]), "ordinal").alias("e")).select("stem", "_key", "e.*")
    # Only files with entries of their own meet the project's, by source and series.
    fits = files_of_series(files.join(own.select("stem").distinct(), "stem", "left_semi"), project).select(F.col("stem").alias("_file"), F.col("series").alias("_series"))
    of_file = own.select("stem", "_key").join(fits, F.col("stem") == F.col("_file"))
    known = project.select(F.col("_key").alias("_known"), F.col("series").alias("_of")).distinct()
    shadow = of_file.join(known, (F.col("_key") == F.col("_known")) & F.col("_of").eqNullSafe(F.col("_series"))).select("_file", "_key").distinct()
    left = own.join(shadow, (own["stem"] == shadow["_file"]) & (own["_key"] == shadow["_key"]), "left_anti")
    names = ["ordinal", "source_en", "preferred_zh", "aliases", "zh_aliases", "case_sensitive", "scope", "reviewed"]
    both = project.select(*names, "series", F.lit(None).cast("long").alias("stem"), F.lit(0).alias("list"), "before")
    return both.unionByName(left.select(*names, F.lit(None).cast("string").alias("series"), F.col("stem").cast("long").alias("stem"), F.lit(1).alias("list"), F.array().cast("array<string>").alias("before")))


def file_terms(files: DataFrame, entries: DataFrame) -> DataFrame:
    """stem, _series (those of the project's series that the file's name fits, null where it is no file of the project), _own
    (whether it has entries of its own)."""
    fits = files_of_series(files, entries.filter("list = 0").select("series")).select("stem", "series", F.lit(False).alias("_own"))
    every = fits.unionByName(entries.filter("list = 1").select("stem", F.lit(None).cast("string").alias("series"), F.lit(True).alias("_own")).distinct())
    return every.groupBy("stem").agg(F.when(F.count_if(~F.col("_own")) > 0, F.collect_set("series")).alias("_series"), F.max("_own").alias("_own"))


def matched_lines(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of events (``target``: whether they are targets; kind, zh, en, and of their file _series, _own) with the matched
    entries of each, packed.

    An event goes through the lookup once: its row of no piece brings the event itself, the others the entries that its pieces
    meet, and they are grouped where they are. Entries of a file are met by its own lines only.
    """
    listed = entries.withColumns({"entry": packed(prepared(entry(F.col("list")))), "of_stem": F.col("stem"), "of_series": F.col("series")})
    variants = variants_of(listed, "entry", "of_stem", "of_series", "before", chinese=True)
    # A piece is a run of letters and digits or one or two characters, so keys of this kind are none.
    own_key = lambda piece, stem: F.concat(piece, F.lit("\0"), F.col(stem).cast("string"))
    variants = variants.withColumn("_piece", F.when(F.col("of_stem").isNull(), F.col("_piece")).otherwise(own_key(F.col("_piece"), "of_stem")))
    event = F.struct(*[c for c in rows.columns if c not in ("stem", "seq", "kind", "zh", "en", "_series", "_own")])
    rows = rows.select("stem", "seq", event.alias("_event"), F.coalesce("target", F.lit(False)).alias("_on"), "kind", "zh", "en", "_series", "_own")
    texts = keyed_texts(rows, "en", "kind", "zh")
    keys = F.when(F.col("_own"), F.concat("_keys", F.transform("_keys", lambda k: own_key(k, "stem")))).otherwise(F.col("_keys"))
    alone = F.concat(F.lit("\0\0"), F.coalesce(F.col("stem").cast("string"), F.lit("")), F.lit("\0"), F.coalesce(F.col("seq").cast("string"), F.lit("")))
    keys = F.concat(F.array(alone), F.when(F.col("_on") & F.col("stem").isNotNull() & F.col("seq").isNotNull(), keys).otherwise(F.array().cast("array<string>")))
    pieces = texts.withColumn("_keys", keys).select("*", F.posexplode_outer("_keys").alias("_n", "_piece")).drop("_keys")
    # Only one row of a line carries its event; the generator is an outer one, or Spark infers a filter that finds the pieces anew.
    pieces = pieces.withColumn("_event", F.when(F.col("_n") == 0, F.col("_event")))
    met = pieces.join(variants, ["_piece", "_chinese"], "left")
    fits = F.col("_series").isNotNull() & (F.col("of_series").isNull() | F.array_contains("_series", F.col("of_series"))) & ((F.size("before") == 0) | ~F.arrays_overlap("before", "_series"))
    met = met.filter((F.col("_n") == 0) | (F.col("entry").isNotNull() & (F.col("of_stem").isNotNull() | fits) & stands("zh")))
    lines = met.groupBy("stem", "seq").agg(F.collect_set("entry").alias("entries"), F.collect_list("_event").alias("_events"))
    return lines.select("stem", "seq", F.when(F.size("entries") > 0, F.col("entries")).alias("entries"), F.explode("_events").alias("_event")).select("stem", "seq", "_event.*", "entries")


def enforced_files(events: DataFrame, files: DataFrame, project: DataFrame, own: DataFrame, styles: list[str] | None = None, origins: list[str] | None = None) -> DataFrame:
    """DRV2: every event of finished files with its text after enforcement: stem, seq, text, target, matched, changed.

    Targets are those of a polish and all other events of two languages; of an event of two languages only the Chinese side
    is rewritten. Lines meet entries by an equality join, and one line's matched entries are folded in their order. Events are
    dealt by file at first, where a file's series join them, and stay there.
    """
    styles = [*BILINGUAL, *OVERLAY] if styles is None else styles
    entries = merged_terminology(project, own, files)
    known = events.join(file_terms(files, entries), "stem", "left")
    if pairs_of_older_files(styles, origins):
        targets = all_targets(events, styles, origins)
        rows = known.select("stem", "seq", "text", "_series", "_own").join(targets.withColumn("target", F.lit(True)), ["stem", "seq"], "left")
        rows = evaluated(rows, "_two", F.when(F.col("target"), two_sides("text")))
    else:  # an event alone tells whether it is a target
        rows = marked_events(known, styles, origins, keep=("_series", "_own"))
    # Of an event of two languages the Chinese side is its beginning.
    rows = rows.select("stem", "seq", "text", F.coalesce("target", F.lit(False)).alias("target"), F.length("_two.zh").alias("_zh"), "kind", "zh", "en", "_series", "_own")
    rows = matched_lines(rows, entries)
    side = F.when(F.col("_zh").isNotNull(), F.left("text", "_zh")).otherwise(text("text"))
    rest = F.when(F.col("_zh").isNotNull(), F.substr("text", F.col("_zh") + 1)).otherwise("")
    matched = F.array_sort(F.transform("entries", unpacked))
    rows = evaluated(rows, "fixed", F.when(F.col("entries").isNotNull(), F.concat(folded_in(side, matched), rest)).otherwise(F.col("text")))
    return rows.select("stem", "seq", F.col("fixed").alias("text"), "target", F.col("entries").isNotNull().alias("matched"), (F.col("entries").isNotNull() & (F.col("fixed") != F.col("text"))).alias("changed"))


def enforcement_counts(rows: DataFrame) -> DataFrame:
    """DRV2: targets, matched and changed lines of each file."""
    return rows.groupBy("stem").agg(*[F.count_if(c).alias(c) for c in ("target", "matched", "changed")])


def enforced_units(units: Column | str, entries: Column | str) -> Column:
    """STR25: display units (en, zh) with their Chinese enforced, each by the matched entries that its own English has; all
    units or, where a form is missing in one, none (an empty list). The English, and so its tiling of the words, stays."""
    holds = lambda en, e: F.exists(e["variants"], lambda v: F.rlike(normalize_inline(en), F.when(e["cased"], F.regexp_replace(word_pattern(v), r"^\(\?iuU\)", "(?U)")).otherwise(word_pattern(v))))
    done = F.transform(col(units), lambda u: F.struct(u["en"].alias("en"), canonicalized(u["zh"], F.filter(col(entries), lambda e: holds(u["en"], e))).alias("zh")))
    return F.when(F.col(entries).isNull() if isinstance(entries, str) else entries.isNull(), col(units)).otherwise(done)


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as events: Chinese with an alias and a leaked English word, above the line; or Chinese alone."""
    en = F.trim(F.regexp_replace("text", r"[^\p{Alnum},.]+", " "))
    rows = evaluated(lines(spark, sf_dir), "en", en).filter("en <> ''")
    k = F.col("seq") % 3
    zh = F.concat(F.lit("看别名"), ((F.col("seq") * 7 + F.col("stem")) % 60).cast("string"), F.lit(" "), F.substring_index("en", " ", 1), F.lit(" 吧"))
    style = F.when(k == 0, "BILINGUAL").when(k == 1, "BILINGUAL_MUSIC").otherwise("OCR_TRANSLATION")
    time = F.col("seq").cast("long") * 100
    return rows.select("stem", F.col("seq").cast("long").alias("seq"), style.alias("style"), F.lit("").alias("name"), time.alias("start_cs"), (time + 90).alias("end_cs"), F.when(k == 2, zh).otherwise(F.concat(zh, F.lit("\\N"), "en")).alias("text"))


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files, entries of the project, and each item's entry again as one of a single file."""
    i = F.col("doc_id")
    files = table(spark, sf_dir, "documents").select(i.alias("stem"), F.concat(F.when(i % 3 == 0, "Series.One.E").otherwise("Other_"), i.cast("string")).alias("name")).distinct()
    project = _entries(spark, sf_dir)
    own = project.withColumns({"stem": F.col("ordinal") % 40, "preferred_zh": F.concat(F.lit("自译"), F.col("ordinal").cast("string")), "reviewed": F.lit(True)}).drop("series")
    return files, project, own


_ENFORCED = rf"""WITH RECURSIVE {LINES}, words AS (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
e AS (SELECT item_id AS ordinal, w[1] || ' ' || w[2] AS src, w[3] AS alias, '译名' || item_id AS p, '别名' || item_id AS z, item_id % 3 = 0 AS cased, CASE item_id % 4 WHEN 0 THEN 'dialogue lyric' WHEN 1 THEN 'ocr' ELSE 'all' END AS scope, item_id % 5 = 0 AS one FROM words WHERE len(w) >= 3),
files AS (SELECT DISTINCT doc_id AS stem, doc_id % 3 = 0 AS one FROM documents),
project AS (SELECT f.stem, 0 AS list, e.* EXCLUDE (one) FROM e, files f WHERE e.ordinal % 7 <> 3 AND (NOT e.one OR f.one)),
pfirst AS (SELECT * FROM project QUALIFY row_number() OVER (PARTITION BY stem, lower(src) ORDER BY ordinal) = 1),
own AS (SELECT ordinal % 40 AS stem, 1 AS list, ordinal, src, alias, '自译' || ordinal AS p, z, cased, scope FROM e QUALIFY row_number() OVER (PARTITION BY ordinal % 40, lower(src) ORDER BY ordinal) = 1),
every AS (SELECT * FROM pfirst UNION ALL SELECT own.* FROM own WHERE NOT EXISTS (SELECT 1 FROM pfirst q WHERE q.stem = own.stem AND lower(q.src) = lower(own.src))),
x AS (SELECT stem, seq::BIGINT AS seq, trim(regexp_replace(text, '[^A-Za-z0-9,.]+', ' ', 'g')) AS en FROM lines),
t AS (SELECT stem, seq, CASE seq % 3 WHEN 2 THEN '' ELSE en END AS en, CASE seq % 3 WHEN 0 THEN 'dialogue' WHEN 1 THEN 'lyric' ELSE 'ocr' END AS kind, '看别名' || ((seq * 7 + stem) % 60) || ' ' || split_part(en, ' ', 1) || ' 吧' AS zh FROM x WHERE en <> ''),
m AS (SELECT t.stem, t.seq, list(struct_pack(p := p, z := z, v1 := CASE WHEN length(alias) > length(src) THEN alias ELSE src END, v2 := CASE WHEN length(alias) > length(src) THEN src ELSE alias END, cased := cased) ORDER BY list, ordinal) AS es
  FROM t JOIN every USING (stem) WHERE (scope = 'all' OR contains(scope, kind)) AND CASE WHEN en = '' THEN contains(zh, z) ELSE len(list_filter([src, alias], lambda v: contains(lower(en), lower(v)) AND
    CASE WHEN cased THEN regexp_matches(en, '(^|[^0-9A-Za-z])' || v || '([^0-9A-Za-z]|$)') ELSE regexp_matches(lower(en), '(^|[^0-9a-z])' || lower(v) || '([^0-9a-z]|$)') END)) > 0 END GROUP BY ALL),
r AS (SELECT t.stem, t.seq, 0 AS i, zh, es FROM t JOIN m USING (stem, seq)
  UNION ALL SELECT stem, seq, i, CASE WHEN cased THEN regexp_replace(z2, '(^|[^0-9A-Za-z])' || v2 || '($|[^0-9A-Za-z])', '\1' || p || '\2', 'g') ELSE regexp_replace(z2, '(^|[^0-9A-Za-z])' || v2 || '($|[^0-9A-Za-z])', '\1' || p || '\2', 'gi') END, es FROM
   (SELECT *, CASE WHEN cased THEN regexp_replace(z1, '(^|[^0-9A-Za-z])' || v1 || '($|[^0-9A-Za-z])', '\1' || p || '\2', 'g') ELSE regexp_replace(z1, '(^|[^0-9A-Za-z])' || v1 || '($|[^0-9A-Za-z])', '\1' || p || '\2', 'gi') END AS z2 FROM
    (SELECT stem, seq, i + 1 AS i, es, es[i + 1].p AS p, es[i + 1].v1 AS v1, es[i + 1].v2 AS v2, es[i + 1].cased AS cased, CASE WHEN contains(es[i + 1].p, es[i + 1].z) AND contains(zh, es[i + 1].p) THEN zh ELSE replace(zh, es[i + 1].z, es[i + 1].p) END AS z1 FROM r WHERE i < len(es)))),
done AS (SELECT t.stem, t.seq, coalesce(r.zh, t.zh) || CASE WHEN t.en = '' THEN '' ELSE '\N' || t.en END AS text, r.zh IS NOT NULL AS matched, coalesce(r.zh <> t.zh, false) AS changed FROM t LEFT JOIN r ON r.stem = t.stem AND r.seq = t.seq AND r.i = len(r.es))"""


@query("drv2_enforced_files", _ENFORCED + " SELECT stem, seq, md5(text) AS text, true AS target, matched, changed FROM done")
def drv2_enforced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = enforced_files(_finished(spark, sf_dir), *_lists(spark, sf_dir))
    return done.withColumn("text", F.md5(F.col("text").cast("binary")))


@query("drv2_enforcement_counts", _ENFORCED + " SELECT stem, count(*) AS target, count(*) FILTER (matched) AS matched, count(*) FILTER (changed) AS changed FROM done GROUP BY stem")
def drv2_enforcement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforcement_counts(enforced_files(_finished(spark, sf_dir), *_lists(spark, sf_dir)))


@query(
    "str25_enforced_units",
    rf"""WITH {CUES}, w AS (SELECT stem, seq, list_filter(string_split(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' '), lambda x: x <> '') AS w FROM cues),
u AS (SELECT stem, seq, unnest(range(0, (len(w) + 1) // 2)) AS n, w FROM w),
p AS (SELECT stem, seq, n, array_to_string(w[2 * n + 1:2 * n + 2], ' ') AS en FROM u),
z AS (SELECT *, '他说别名' || (n % 3) || '，' || en AS zh FROM p),
d AS (SELECT *, CASE WHEN regexp_matches(lower(en), '(^| )the( |$)') THEN regexp_replace(regexp_replace(replace(zh, '别名1', '定冠词'), '(^|[^0-9A-Za-z])the($|[^0-9A-Za-z])', '\1定冠词\2', 'gi'), '(^|[^0-9A-Za-z])the($|[^0-9A-Za-z])', '\1定冠词\2', 'gi') ELSE zh END AS one FROM z)
SELECT stem, seq, md5(string_agg(en || '=' || CASE WHEN regexp_matches(lower(en), '(^| )of the( |$)') THEN regexp_replace(one, '(^|[^0-9A-Za-z])of the($|[^0-9A-Za-z])', '\1的\2', 'gi') ELSE one END, ';' ORDER BY n)) AS units FROM d GROUP BY stem, seq""",
)
def str25_enforced_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of two words each; a term of two words that lies in two units is in neither."""
    words = F.filter(F.split(F.regexp_replace("text", "[^A-Za-z ]", ""), " "), lambda x: x != "")
    c = cues(spark, sf_dir).withColumn("w", words).filter("size(w) > 0")
    en = lambda n: F.array_join(F.slice("w", 2 * n + 1, F.lit(2)), " ")
    units = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 2).cast("int")), lambda n: F.struct(en(n).alias("en"), F.concat(F.lit("他说别名"), (n % 3).cast("string"), F.lit("，"), en(n)).alias("zh")))
    e = lambda i, p, z, v: F.struct(F.struct(F.lit(0).alias("source"), F.lit(i).cast("long").alias("ordinal")).alias("place"), F.lit(p).alias("preferred"), F.array(*map(F.lit, z)).cast("array<string>").alias("zh_aliases"), F.array(F.lit(v)).alias("variants"), F.lit(False).alias("cased"))
    c = c.withColumn("units", units).withColumn("entries", F.array(e(1, "定冠词", ["别名1"], "the"), e(2, "的", [], "of the")))
    done = enforced_units("units", "entries")
    return c.select("stem", "seq", F.md5(F.array_join(F.transform(done, lambda u: F.concat(u["en"], F.lit("="), u["zh"])), ";").cast("binary")).alias("units"))
