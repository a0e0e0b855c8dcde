"""Finished bilingual files: targets of a polish, presentation and styles, series names, positions, timed words, loaders and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MOJIBAKE_NOTE, cache_text, col, has, has_han, has_latin, let, music_symbols, normalize_inline, normalize_lines, normalize_text, squeeze, strip, text, text_key, where
from ..functions.times import centis_to_ass
from ..plans.registry import query, table
from ..sources.staging import CUES, cues
from .rules import origin

# Styles of finished files with the kind of text that each holds, and styles of files with separate events.
BILINGUAL = {"BILINGUAL": "dialogue", "BILINGUAL_MUSIC": "lyric", "BILINGUAL_CHANT": "chant"}
OVERLAY = {"OCR_TRANSLATION": "ocr", "EXPLANATION_NOTE": "note"}
PAIRED_SOURCE = ["English", "Default", "EN", "EN_i"]
PAIRED_TARGET = ["Chinese", "Default", "ZH", "ZH_i"]
FONT_SIZE = "56"
ENGLISH_SIZE = r"{\fs42}"
# Names of one series; the source holds one of the needles, then the pattern becomes the name.
SERIES_NAMES = [
    (["raina", "rayna"], r"(?:蕾娜|瑞娜|莱娜|雷娜)[·・](?:詹姆斯|杰姆斯|杰恩斯|简)", "蕾娜·詹姆斯"),
    (["raina", "rayna"], r"(?:瑞娜|莱娜|雷娜)", "蕾娜"),
    (["fordham", "jeff ford"], r"杰夫[·・]?(?:福特汉姆|福特汉|福德汉|福德姆|福特姆|福特)", "杰夫·福特汉姆"),
    (["fordham", "jeff ford"], r"(?<!杰夫[·・])福(?:特|德)(?:汉姆|汉|德姆|特姆|德汉|特哈姆)?", "福特汉姆"),
    (["edge hill", "edgehill"], r"(?i)Edge\s*Hill|Edgehill", "埃奇希尔"),
    (["edge hill", "edgehill"], r"(?:埃奇山|伊奇山|边缘山|边希尔)", "埃奇希尔"),
    (["scarlett", "scarlet"], r"(?i)Scarlett\s+O['’]Connor|Scarlet\s+O['’]Connor", "斯嘉丽·奥康纳"),
    (["scarlett", "scarlet"], r"(?i)(?<![A-Za-z])(?:Scarlett|Scarlet)(?![A-Za-z])", "斯嘉丽"),
    (["juliette", "juliet"], r"(?i)Juliette\s+Barnes|Juliet\s+Barnes", "朱丽叶·巴恩斯"),
    (["juliette", "juliet"], r"(?i)(?<![A-Za-z])(?:Juliette|Juliet)(?![A-Za-z])", "朱丽叶"),
    (["gunnar", "gunner"], r"(?:古纳|刚纳)", "冈纳"),
    (["avery"], r"艾弗里", "埃弗里"),
    (["deacon", "dakin", "beacon", "dickon"], r"(?:戴肯|德肯|戴克|德克)(?=[，。？！、\\s]|$)", "迪肯"),
    (["deacon", "dakin", "beacon", "dickon"], r"(?:戴肯|德肯|戴克|德克)[·・](?:克莱伯恩|克莱布尔)", "迪肯·克莱伯恩"),
]
# Commands of an override block that only concern the look.
LOOK = r"\\(?:fn[^\\}]*|fsc[xy][+-]?\d+(?:\.\d+)?|fs[+-]?\d+(?:\.\d+)?|[bi][01]|(?:[1-4]?c|alpha|[1-4]a)&H[0-9A-Fa-f]+&)"


def _without_blocks(c: Column | str) -> Column:
    return where(text(c), has("{"), lambda x: F.regexp_replace(x, r"\{[^}]*\}", ""))


def shown(c: Column | str) -> Column:
    """What a viewer reads of an event's text: no override blocks, lines joined by a blank, none between Han characters."""
    return cache_text(normalize_lines(music_symbols(_without_blocks(c))))


def _shows_no_han(c: Column) -> Column:
    """Whether ``shown`` has something and nothing Chinese: white space is all that it takes from a text without blocks."""
    return let(F.replace(_without_blocks(c), F.lit("\\N"), F.lit("\n")), lambda x: x.rlike(r"(?U)\S") & ~has_han(x))


def without_look(c: Column | str) -> Column:
    """Commands of the look leave their override blocks; blocks with nothing else go."""
    return music_symbols(F.regexp_replace(F.regexp_replace(text(c), LOOK + r"(?=[^{}]*\})", ""), r"\{\s*\}", ""))


def two_sides(c: Column | str) -> Column:
    r"""Chinese and English of an event: English begins at the first \N part with its own font, else at the first part
    behind the first from which on something is shown and nothing Chinese; null where there is no such part."""
    def of_pieces(pieces: Column) -> Column:
        rests = F.transform(pieces, lambda p, i: F.when(i > 0, _shows_no_han(F.array_join(F.slice(pieces, i + 1, F.size(pieces)), "\\N"))).otherwise(False))
        font = F.array_position(F.transform(pieces, lambda p: F.contains(p, F.lit("\\fnArial"))), True)
        plain = F.array_position(rests, True)
        part = lambda low, n: F.array_join(F.slice(pieces, low, n), "\\N")
        return let(F.when(font > 0, font).otherwise(plain).cast("int"), lambda at: F.when(at > 1, F.struct(part(F.lit(1), at - 1).alias("zh"), part(at, F.size(pieces)).alias("en"))))

    return let(F.split(text(c), r"\\N"), of_pieces)


def evaluated(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later steps read but do not work out anew: the optimizer moves nothing across a generator."""
    return frame.withColumn(name, F.explode(F.array(value)))


def _kind(style: Column | str, *known: dict[str, str]) -> Column:
    pairs = [x for k in known for x in k.items()]
    return reduce(lambda out, p: F.when(col(style) == p[0], p[1]).otherwise(out), pairs, F.lit(None).cast("string"))


TARGET = ["stem", "seq", "style", "kind", "start_cs", "end_cs", "text", "zh", "en", "origin"]


def paired_targets(events: DataFrame, styles: list[str]) -> DataFrame:
    """FLT13, older files: a Chinese event of an enabled style and an English one of the same times are a target, the last
    with the last. Events pair in one shuffle by file and times."""
    enabled = [s for s in PAIRED_TARGET if s in styles]
    seen = evaluated(events.filter(F.col("style").isin([*enabled, *PAIRED_SOURCE])), "_shown", shown("text")).filter(F.col("_shown") != "")
    side = F.when(F.col("style").isin(enabled) & has_han("_shown"), "zh").when(F.col("style").isin(PAIRED_SOURCE) & has_latin("_shown"), "en")
    last_first = Window.partitionBy("stem", "start_cs", "end_cs").orderBy(F.desc("seq"))
    place = lambda s: F.sum((F.col("_side") == s).cast("int")).over(last_first)
    ranked = seen.withColumn("_side", side).filter("_side IS NOT NULL").withColumn("_n", F.when(F.col("_side") == "zh", place("zh")).otherwise(place("en")))
    zh = F.max(F.when(F.col("_side") == "zh", F.struct("seq", "style", "text", "_shown")))
    en = F.max(F.when(F.col("_side") == "en", F.col("_shown")))
    both = ranked.groupBy("stem", "start_cs", "end_cs", "_n").agg(zh.alias("z"), en.alias("en")).filter("z IS NOT NULL AND en IS NOT NULL")
    pair = F.concat("z._shown", "en")
    kind = F.when(F.contains(pair, F.lit("✦")), "chant").when(F.contains(pair, F.lit("♪")), "lyric").otherwise("dialogue")
    return both.select("stem", "z.seq", "z.style", kind.alias("kind"), "start_cs", "end_cs", "z.text", F.col("z._shown").alias("zh"), "en", F.lit("unknown").alias("origin"))


def polish_targets(events: DataFrame, styles: list[str], origins: list[str] | None = None) -> DataFrame:
    """FLT13: events of the styles and origins that show Chinese, or English with nothing to read above it; and pairs of
    older files, if an unknown origin is allowed."""
    own = _sides(events.filter(F.col("style").isin(styles) & _kind("style", BILINGUAL, OVERLAY).isNotNull())).filter(_polished(styles, origins)).select(*TARGET)
    return own if origins is not None and "unknown" not in origins else own.unionByName(paired_targets(events, styles))


def _sides(events: DataFrame) -> DataFrame:
    """Events with kind, origin, the two sides as they stand (``_two``) and as a viewer reads them (zh, en); an overlay has
    one side only."""
    on = ~F.col("style").isin(list(OVERLAY))
    made = events.withColumns({"kind": _kind("style", BILINGUAL, OVERLAY), "origin": origin("name", "style")})
    made = evaluated(made, "_two", two_sides("text"))
    one = on & F.col("_two").isNotNull()
    made = evaluated(made, "_sides", F.struct(F.when(one, shown("_two.zh")).otherwise(shown("text")).alias("zh"), F.when(one, shown("_two.en")).otherwise("").alias("en")))
    return made.withColumns({"zh": F.col("_sides.zh"), "en": F.col("_sides.en")})


def _polished(styles: list[str], origins: list[str] | None) -> Column:
    """Whether an event with its sides is a target of a polish."""
    on = F.col("style").isin(list(BILINGUAL))
    missing = on & (F.col("en") != "") & ~F.col("zh").rlike("[0-9A-Za-z]")
    fits = F.col("style").isin(styles) & F.col("kind").isNotNull() & (~on | F.col("_two").isNotNull()) & (has_han("zh") | missing)
    return fits if origins is None else fits & F.col("origin").isin(origins)


def name_targets(events: DataFrame) -> DataFrame:
    """FLT14: every event of two languages, whatever its style is called."""
    style = F.trim("style")
    low = F.lower(style)
    kind = F.when(F.contains(low, F.lit("chant")), "chant").when(low.rlike("lyric|music|song"), "lyric").otherwise(F.coalesce(_kind(style, BILINGUAL), F.lit("dialogue")))
    made = evaluated(events, "_two", two_sides("text")).filter("_two IS NOT NULL")
    made = evaluated(made, "_sides", F.struct(shown("_two.zh").alias("zh"), shown("_two.en").alias("en")))
    made = made.withColumns({"zh": F.col("_sides.zh"), "en": F.col("_sides.en"), "kind": kind, "origin": origin("name", style)})
    return made.filter(F.col("en") != "").withColumn("style", style).select(*TARGET)


def pairs_of_older_files(styles: list[str], origins: list[str] | None) -> bool:
    """Whether any pair of events can be a target: an unknown origin and a style of Chinese events must be allowed."""
    return (origins is None or "unknown" in origins) and any(s in styles for s in PAIRED_TARGET)


def marked_events(events: DataFrame, styles: list[str], origins: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """FLT13 and FLT14 without pairs of older files, in one pass: each event with its two sides as they stand (``_two``),
    whether it is a target of a polish (``_polish``) or else, as an event of two languages, of names (``target`` for both),
    and as what a target shows: kind, zh, en. ``keep``: further columns that stay."""
    made = _sides(events)
    style = F.lower(F.trim("style"))
    named = F.when(F.contains(style, F.lit("chant")), "chant").when(style.rlike("lyric|music|song"), "lyric").otherwise(F.coalesce(_kind(F.trim("style"), BILINGUAL), F.lit("dialogue")))
    polish = F.coalesce(_polished(styles, origins), F.lit(False))
    # Read as two languages, an overlay shows both its sides.
    apart = F.col("_two").isNotNull() & F.coalesce(F.col("style").isin(list(OVERLAY)), F.lit(False))
    zh, en = (F.when(polish | ~apart, F.col(c)).otherwise(shown(f"_two.{c}")) for c in ("zh", "en"))
    rows = evaluated(made, "_t", F.struct(polish.alias("polish"), F.when(polish, F.col("kind")).otherwise(named).alias("kind"), zh.alias("zh"), en.alias("en")))
    target = F.col("_t.polish") | (F.col("_two").isNotNull() & (F.col("_t.en") != ""))
    return rows.select("stem", "seq", "text", "_two", F.col("_t.polish").alias("_polish"), target.alias("target"), "_t.kind", "_t.zh", "_t.en", *keep)


def all_targets(events: DataFrame, styles: list[str], origins: list[str] | None = None) -> DataFrame:
    """FLT13 and FLT14 together: the targets of a polish and, of all other events, those of two languages: stem, seq, kind,
    zh, en."""
    own = marked_events(events, styles, origins).filter("target").select("stem", "seq", "kind", "zh", "en", "_polish")
    if not pairs_of_older_files(styles, origins):
        return own.drop("_polish")
    # A pair of an older file counts before an event of two languages.
    pairs = paired_targets(events, styles).select("stem", "seq", "kind", "zh", "en", F.lit(True).alias("_polish"))
    first = F.max_by(F.struct("kind", "zh", "en"), F.col("_polish"))
    return own.unionByName(pairs).groupBy("stem", "seq").agg(first.alias("t")).select("stem", "seq", "t.*")


def presented(c: Column | str) -> Column:
    """STR37: an event without commands of the look, English with its size."""
    two = two_sides(c)
    zh, en = strip(without_look(two["zh"])), strip(without_look(two["en"]))
    both = F.when(en != "", F.concat(zh, F.lit("\\N" + ENGLISH_SIZE), en)).otherwise(zh)
    return F.when(two.isNotNull(), both).otherwise(strip(without_look(c)))


def style_text(c: Column | str) -> Column:
    """STR36: what styles are recovered by: shown text without marks at its ends."""
    marks = lambda x, m: F.regexp_replace(x, f"^{m}+|{m}+$", "")
    x = strip(marks(marks(squeeze(shown(without_look(c))), "♪"), "✦"))
    return strip(F.regexp_replace(strip(F.regexp_replace(x, "^[jJ][“”\"']\\s*", "")), "\\s*[jJ][“”\"']$", ""))


def has_music(c: Column | str) -> Column:
    """STR42, STR43: a note of any kind, or what is left of one."""
    return text(c).rlike("[♪♫♬]") | text(c).rlike(MOJIBAKE_NOTE)


def is_chant(kind: Column | str, flag: Column | str) -> Column:
    """STR42."""
    return (F.lower(text(kind)) == "chant") | F.coalesce(col(flag), F.lit(False))


def inferred_style(zh: Column | str, en: Column | str, fallback: Column | str) -> Column:
    """STR36: by the marks of either side, else the style known before."""
    either = F.concat(text(zh), F.lit("\n"), text(en))
    return F.when(F.contains(either, F.lit("✦")), "BILINGUAL_CHANT").when(has_music(zh) | has_music(en), "BILINGUAL_MUSIC").when(col(fallback).isin(list(BILINGUAL)), col(fallback)).otherwise("BILINGUAL")


def sized_style_line(c: Column | str) -> Column:
    """STR36: a style line of a bilingual style with the font size of today; other lines stay."""
    p = F.split(text(c), ",")
    name = F.trim(F.regexp_replace(p[0], "^Style:", ""))
    fixed = F.array_join(F.concat(F.slice(p, 1, 2), F.array(F.lit(FONT_SIZE)), F.slice(p, 4, F.size(p))), ",")
    return F.when(text(c).startswith("Style: ") & (F.size(p) >= 3) & name.isin(list(BILINGUAL)), fixed).otherwise(text(c))


def series_names(c: Column | str, source: Column | str, rules: list[tuple[list[str], str, str]] | None = None) -> Column:
    """STR26: names of a series, in order of the rules; a rule counts if the source holds one of its needles."""
    low = F.lower(text(source))
    met = lambda needles: reduce(lambda a, b: a | b, [F.contains(low, F.lit(n)) for n in needles])
    # a rule that does not count gets a pattern that never matches: so each step holds the text before it only once
    return reduce(lambda x, r: F.regexp_replace(x, F.when(met(r[0]), r[1]).otherwise("(?!)"), F.lit(r[2])), SERIES_NAMES if rules is None else rules, text(c))


def positioned(c: Column | str, x: Column, y: Column) -> Column:
    """STR52: the first position replaced; without one, centred there in the first block or a block of its own."""
    at = F.concat(F.lit("\\pos("), x.cast("int").cast("string"), F.lit(","), y.cast("int").cast("string"), F.lit(")"))
    old = F.regexp_extract(text(c), r"\\pos\(-?\d+,-?\d+\)", 0)
    where = F.instr(text(c), old)
    swapped = F.concat(F.substring(text(c), F.lit(1), where - 1), at, F.substring(text(c), where + F.length(old), F.length(text(c))))
    inside = F.concat(F.lit("{\\an5"), at, F.substring(text(c), F.lit(2), F.length(text(c))))
    return F.when(old != "", swapped).when(text(c).startswith("{"), inside).otherwise(F.concat(F.lit("{\\an5"), at, F.lit("}"), text(c)))


def play_size(lines: DataFrame) -> DataFrame:
    """STR51, STR52: each file's play area by its last readable header line; 1920 by 1080 without."""
    value = lambda name: F.max_by(F.regexp_extract(F.trim("line"), rf"(?i)^{name}:\s*(\d+)\s*$", 1).try_cast("int"), F.when(F.trim("line").rlike(rf"(?i)^{name}:\s*\d+\s*$"), F.col("n")))
    return lines.groupBy("stem").agg(F.coalesce(value("playresx"), F.lit(1920)).alias("play_x"), F.coalesce(value("playresy"), F.lit(1080)).alias("play_y"))


def ass_centis_or_error(c: Column | str) -> Column:
    """DT3: H:M:S.cc to centiseconds; anything else stops the query."""
    pattern = r"^\s*(\d+):(\d+):(\d+)\.(\d+)\s*$"
    part = lambda i: F.regexp_extract(text(c), pattern, i).try_cast("long")
    return F.when(text(c).rlike(pattern), (part(1) * 3600 + part(2) * 60 + part(3)) * 100 + part(4)).otherwise(F.raise_error(F.concat(F.lit("not a time: "), text(c))).cast("long"))


def timed_words(words: Column | str) -> Column:
    """ARR2: words with both times; null is no words."""
    return F.filter(F.coalesce(col(words), F.array()), lambda w: w["start"].isNotNull() & w["end"].isNotNull())


def words_text(words: Column | str) -> Column:
    """ARR2, ARR3: the words' texts, one blank between."""
    return normalize_inline(F.array_join(F.filter(F.transform(col(words), lambda w: strip(text(w["word"]))), lambda x: x != ""), " "))


def is_timed(words: Column | str) -> Column:
    """ARR3: two words or more have both times."""
    return F.size(timed_words(words)) >= 2


def word_time(value: Column | str, fallback: Column) -> Column:
    """ARR3: a time as it is written, else the fallback."""
    return F.coalesce(col(value).try_cast("double"), fallback.cast("double"))


def whole_or_salvaged_json(c: Column | str) -> Column:
    """JSN3: the whole answer if it is JSON, else its outermost braces or brackets if these are; else an empty object."""
    x = strip(F.regexp_replace(strip(F.regexp_replace(text(c), r"(?is)<think>.*?</think>", "")), r"(?m)^```(?:json)?|```$", ""))
    inner = F.regexp_extract(x, r"(?s)(\{.*\}|\[.*\])", 1)
    valid = lambda j: F.when((j != "") & F.try_parse_json(j).isNotNull(), j)
    return F.coalesce(valid(x), valid(inner), F.lit("{}"))


def events_by_format(documents: DataFrame) -> DataFrame:
    """SRC5, MAP1: events whose fields the Format line before them names; lines before any such line, of another number of
    fields or without readable times go. ``lines`` are the shown lines, ``visible`` the same set apart by bars."""
    rows = documents.select("stem", F.posexplode(F.split(F.regexp_replace("content", r"\r\n?", "\n"), "\n")).alias("n", "line")).filter(F.col("line").rlike("^(Format|Dialogue):"))
    named = F.when(F.col("line").startswith("Format:"), F.transform(F.split(F.substring("line", 8, 2**31 - 1), ","), strip))
    before = Window.partitionBy("stem").orderBy("n")
    rows = rows.withColumn("_fields", F.last(named, ignorenulls=True).over(before)).filter(F.col("line").startswith("Dialogue:") & F.col("_fields").isNotNull())
    rows = rows.withColumn("_parts", F.split(F.regexp_replace("line", r"^Dialogue:\s*", ""), ",", F.size("_fields"))).filter("size(_parts) = size(_fields)")
    field = lambda name: F.expr(f"try_element_at(reverse(_parts), nullif(int(array_position(reverse(_fields), '{name}')), 0))")
    time = r"^\s*(\d+):(\d+):(\d+)\.(\d+)\s*$"

    def centis(name: str) -> Column:
        c = F.coalesce(field(name), F.lit("0:00:00.00"))
        part = lambda i: F.regexp_extract(c, time, i).try_cast("long")
        return (part(1) * 3600 + part(2) * 60 + part(3)) * 100 + part(4)

    shown_lines = F.split(F.regexp_replace(F.coalesce(field("Text"), F.lit("")), r"\{[^}]*\}", ""), r"\\N")
    made = rows.select("stem", "n", centis("Start").alias("start_cs"), centis("End").alias("end_cs"), F.coalesce(field("Style"), F.lit("")).alias("style"), shown_lines.alias("lines"))
    return made.filter("start_cs IS NOT NULL AND end_cs IS NOT NULL").withColumn("visible", F.array_join("lines", " | "))


def low_value_texts(documents: DataFrame) -> DataFrame:
    """DIC1: the texts of JSON lists with their keys, each key once; anything but a list has none."""
    texts = documents.select(F.explode(F.from_json("content", "array<string>")).alias("text")).select(normalize_text("text").alias("text"))
    return texts.filter("text <> ''").select(text_key("text").alias("key"), "text").filter("key <> ''").groupBy("key").agg(F.min("text").alias("text"))


def listed_entries(documents: DataFrame, entry: str, section: str | None = None) -> DataFrame:
    """DIC1-3, DIC5: the objects of a JSON list, or of a section of a JSON object, in order; ``entry`` is their schema.
    Missing, corrupt and other documents, and items that are no objects, give no rows."""
    kind = f"array<{entry}>" if section is None else f"struct<`{section}`:array<{entry}>>"
    made = F.from_json("content", kind)
    return documents.select("stem", F.posexplode(made if section is None else made[section]).alias("ordinal", "item")).filter("item IS NOT NULL").select("stem", "ordinal", "item.*")


def review_targets(terms: DataFrame) -> DataFrame:
    """DIC6: terms that no review has confirmed."""
    return terms.filter(~F.col("reviewed").eqNullSafe(True))


def cache_entries(targets: DataFrame, provider: str, model: str, version: str) -> DataFrame:
    """DIC6: rows of the polish cache for answered targets (style, kind, en, zh, polished_zh, is_deleted)."""
    return targets.select(F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.lit(version).alias("prompt_version"), "style", "kind", "en", F.col("zh").alias("source_zh"), "polished_zh", F.coalesce("is_deleted", F.lit(False)).alias("delete"))


def json_documents(rows: DataFrame, *order: str) -> DataFrame:
    """SNK5: one JSON list per file, its rows in the given order; columns come in the order of the rows."""
    held = [c for c in rows.columns if c != "stem"]
    ranked = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*held).alias("v"))))
    return rows.groupBy("stem").agg(F.to_json(F.transform(ranked, lambda r: r["v"]), {"ignoreNullFields": "false"}).alias("content"))


def text_reports(summaries: DataFrame) -> DataFrame:
    """SNK6: each file's summary as lines of a report."""
    line = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    n = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    return summaries.select("stem", F.concat_ws("\n", line("video: ", F.col("stem").cast("string")), line("events: total=", n("events"), " music=", n("music")), line("issues: overlaps=", n("overlaps"), " very_long=", n("very_long")), F.lit("")).alias("content"))


def summary_table(summaries: DataFrame) -> DataFrame:
    """SNK6: all summaries as rows of one Markdown table, in order of the files."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("stem", "events", "music", "overlaps", "very_long")]), F.lit(" |"))
    return summaries.select("stem", row.alias("line")).orderBy("stem")


def stream_summary(index: Column | str, codec: Column | str, language: Column | str, title: Column | str, sdh: Column | str) -> Column:
    """DRV7: what is told of a chosen stream; null without one."""
    return F.when(col(index).isNotNull(), F.struct(col(index).alias("index"), col(codec).alias("codec"), text(language).alias("language"), text(title).alias("title"), col(sdh).alias("is_sdh")))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, en = F.col("seq") % 10, F.regexp_replace(F.substring("text", 1, 15), r"[^A-Za-z]", "x")
    style = F.when(k == 0, "BILINGUAL").when(k == 1, "BILINGUAL_MUSIC").when(k == 2, "OCR_TRANSLATION").when(k == 3, "My Song").when(k.isin(4, 5), "Default").when(k == 6, "BILINGUAL_CHANT").when(k == 7, "EXPLANATION_NOTE").otherwise("Other")
    name = F.when(F.col("seq") % 3 == 0, "qwen_zh").otherwise("")
    shown_text = F.when(k.isin(0, 1, 3), F.concat(F.lit(r"{\i1}你 好\N{\fs30\an8}"), en)).when(k == 2, "{\\an8}路牌").when(k == 4, en).when(k == 5, "你好").when(k == 6, F.concat(F.lit(r"…\N"), en)).otherwise("plain")
    at = (F.floor(F.col("seq") / 2) * 100).cast("long")
    return cues(spark, sf_dir).filter(F.length("text") > 0).select("stem", "seq", at.alias("start_cs"), (at + 90).alias("end_cs"), style.alias("style"), name.alias("name"), shown_text.alias("text"))


_EVENTS = rf"""{CUES}, x AS (SELECT stem, seq, seq % 10 AS k, (seq // 2 * 100)::BIGINT AS start_cs, (seq // 2 * 100 + 90)::BIGINT AS end_cs, regexp_replace(left(text, 15), '[^A-Za-z]', 'x', 'g') AS en, CASE WHEN seq % 3 = 0 THEN 'qwen' ELSE 'unknown' END AS o FROM cues WHERE length(text) > 0)"""


@query(
    "flt13_targets",
    rf"""WITH {_EVENTS}
SELECT stem, seq, CASE k WHEN 0 THEN 'dialogue' WHEN 1 THEN 'lyric' WHEN 2 THEN 'ocr' ELSE 'chant' END AS kind, CASE k WHEN 2 THEN '路牌' WHEN 6 THEN '…' ELSE '你好' END AS zh, CASE k WHEN 2 THEN '' ELSE en END AS en, CASE WHEN k = 2 AND o = 'unknown' THEN 'ocr' ELSE o END AS origin, start_cs FROM x WHERE k IN (0, 1, 2, 6)
UNION ALL SELECT z.stem, z.seq, 'dialogue', '你好', e.en, 'unknown', z.start_cs FROM x z JOIN x e ON z.stem = e.stem AND z.seq = e.seq + 1 AND z.k = 5 AND e.k = 4""",
)
def flt13_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polish_targets(_events(spark, sf_dir), [*BILINGUAL, *OVERLAY, "Default"]).select("stem", "seq", "kind", "zh", "en", "origin", "start_cs")


@query(
    "flt14_name_targets",
    rf"""WITH {_EVENTS} SELECT stem, seq, CASE k WHEN 0 THEN 'dialogue' WHEN 6 THEN 'chant' ELSE 'lyric' END AS kind, CASE k WHEN 6 THEN '…' ELSE '你好' END AS zh, en, o AS origin FROM x WHERE k IN (0, 1, 3, 6)""",
)
def flt14_name_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_targets(_events(spark, sf_dir)).select("stem", "seq", "kind", "zh", "en", "origin")


@query(
    "str36_str37_presentation",
    rf"""WITH {_EVENTS} SELECT stem, seq, CASE WHEN k IN (0, 1, 3) THEN '你 好\N{{\fs42}}{{\an8}}' || en WHEN k = 2 THEN '{{\an8}}路牌' WHEN k = 4 THEN en WHEN k = 5 THEN '你好' WHEN k = 6 THEN '…\N{{\fs42}}' || en ELSE 'plain' END AS presented,
CASE k WHEN 1 THEN 'BILINGUAL_MUSIC' WHEN 2 THEN 'BILINGUAL_CHANT' WHEN 6 THEN 'BILINGUAL_CHANT' ELSE 'BILINGUAL' END AS style, 'Style: ' || CASE k WHEN 0 THEN 'BILINGUAL,Arial,56' ELSE 'Other,Arial,40' END || ',x' AS line FROM x""",
)
def str36_str37_presentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 10
    style = inferred_style(F.when(k == 1, "♬ 你").when(k == 2, "你 ✦").otherwise("你"), F.lit("you"), "style")
    line = F.concat(F.lit("Style: "), F.when(k == 0, "BILINGUAL").otherwise("Other"), F.lit(",Arial,40,x"))
    return _events(spark, sf_dir).select("stem", "seq", presented("text").alias("presented"), style.alias("style"), sized_style_line(line).alias("line"))


@query(
    "str26_series_names",
    rf"""WITH {CUES} SELECT stem, seq, CASE seq % 6 WHEN 0 THEN '蕾娜·詹姆斯和蕾娜' WHEN 1 THEN '杰夫·福特汉姆，福特汉姆' WHEN 2 THEN '埃奇希尔，埃奇希尔' WHEN 3 THEN '斯嘉丽·奥康纳 斯嘉丽' WHEN 4 THEN '迪肯，迪肯·克莱伯恩' ELSE '雷娜和戴肯' END AS zh FROM cues""",
)
def str26_series_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 6
    source = F.when(k == 0, "Hi RAYNA").when(k == 1, "Mr. Fordham").when(k == 2, "Edgehill").when(k == 3, "Scarlett!").when(k == 4, "Deacon").otherwise("nobody")
    zh = F.when(k == 0, "瑞娜·杰姆斯和雷娜").when(k == 1, "杰夫福特，福德汉").when(k == 2, "edge hill，边缘山").when(k == 3, "Scarlet O'Connor SCARLETT").when(k == 4, "戴肯，德克·克莱布尔").otherwise("雷娜和戴肯")
    return cues(spark, sf_dir).select("stem", "seq", series_names(zh, source).alias("zh"))


@query(
    "str52_dt3_positions",
    rf"""WITH {CUES} SELECT stem, seq, CASE seq % 3 WHEN 0 THEN '{{\pos(' || seq || ',7)}}a{{\pos(1,2)}}' WHEN 1 THEN '{{\an5\pos(' || seq || ',7)\i1}}b' ELSE '{{\an5\pos(' || seq || ',7)}}c' END AS text, start_cs FROM cues""",
)
def str52_dt3_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 3
    old = F.when(k == 0, r"{\pos(-3,4)}a{\pos(1,2)}").when(k == 1, r"{\i1}b").otherwise("c")
    return cues(spark, sf_dir).select("stem", "seq", positioned(old, F.col("seq"), F.lit(7)).alias("text"), ass_centis_or_error(centis_to_ass("start_cs")).alias("start_cs"))


@query(
    "arr2_arr3_timed_words",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, list_filter(regexp_split_to_array(text, '\s+'), lambda p: p <> '') AS w FROM cues)
SELECT stem, seq, array_to_string(w, ' ') AS text, ((len(w) + 1) // 2)::INTEGER AS timed, (len(w) + 1) // 2 >= 2 AS is_timed, (CASE WHEN len(w) > 1 THEN -1.0 ELSE 0.5 END)::DOUBLE AS second FROM x WHERE len(w) > 0 AND NOT regexp_matches(text, '[&jJ]')""",
)
def arr2_arr3_timed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second word lacks its start."""
    w = F.filter(F.split("text", r"\s+"), lambda p: p != "")
    words = F.transform(w, lambda p, i: F.struct(F.concat(F.lit(" "), p).alias("word"), F.when(i % 2 == 0, i * 0.5).alias("start"), (i * 0.5 + 0.4).alias("end")))
    second = F.when(F.size("w") > 1, word_time(F.col("w")[F.least(F.lit(1), F.size("w") - 1)]["start"], F.lit(-1.0))).otherwise(word_time(F.lit(" 0.5"), F.lit(-1.0)))
    made = cues(spark, sf_dir).filter(~F.col("text").rlike("[&jJ]")).withColumn("w", words).filter(F.size("w") > 0)
    return made.select("stem", "seq", words_text("w").alias("text"), F.size(timed_words("w")).alias("timed"), is_timed("w").alias("is_timed"), second.alias("second"))


@query(
    "jsn3_whole_or_salvaged",
    rf"""WITH {CUES} SELECT stem, seq, CASE seq % 5 WHEN 0 THEN '[' || seq || ']' WHEN 1 THEN '{{"a": ' || seq || '}}' WHEN 2 THEN '{{"a": ' || seq || '}}' WHEN 3 THEN '{{}}' ELSE '[{{"b": 1}}]' END AS json FROM cues""",
)
def jsn3_whole_or_salvaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("seq") % 5, F.col("seq").cast("string")
    said = F.when(k == 0, F.concat(F.lit("<think>{no}</think> ["), n, F.lit("]"))).when(k == 1, F.concat(F.lit('```json\n{"a": '), n, F.lit("}\n```"))).when(k == 2, F.concat(F.lit('Here: {"a": '), n, F.lit("} done"))).when(k == 3, "none { at all").otherwise('[{"b": 1}]')
    return cues(spark, sf_dir).select("stem", "seq", whole_or_salvaged_json(said).alias("json"))


@query(
    "src5_format_events",
    rf"""WITH {CUES}, x AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY seq) AS r FROM cues) SELECT stem, (r + 1)::INTEGER AS n, start_cs, end_cs, 'S' || seq % 3 AS style, 'a, ' || seq || ' | b' AS visible FROM x WHERE seq % 5 <> 0""",
)
def src5_format_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose fields stand in an order of their own; each fifth line has no readable time."""
    start = F.when(F.col("seq") % 5 == 0, "soon").otherwise(centis_to_ass("start_cs"))
    line = F.concat(F.lit("Dialogue: S"), (F.col("seq") % 3).cast("string"), F.lit(","), centis_to_ass("end_cs"), F.lit(","), start, F.lit(r",{\an8}a, "), F.col("seq").cast("string"), F.lit(r"\Nb"))
    held = cues(spark, sf_dir).groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))).alias("l"))
    head = F.array(F.lit("Dialogue: too early"), F.lit("Format: Style, End, Start, Text"))
    return events_by_format(held.select("stem", F.array_join(F.concat(head, F.col("l.line")), "\r\n").alias("content"))).select("stem", "n", "start_cs", "end_cs", "style", "visible")


@query(
    "dic1_dic6_loaders",
    """WITH d AS (SELECT DISTINCT conv_id AS stem FROM conversations)
SELECT 'term' AS what, stem, 1 AS ordinal, 'b' || stem AS value FROM d WHERE stem % 4 <> 3 UNION ALL SELECT 'term', stem, 2, 'c' FROM d WHERE stem % 4 <> 3
UNION ALL SELECT 'hint', stem, 0, 'h' || stem FROM d WHERE stem % 4 <> 3 UNION ALL SELECT 'low', NULL, NULL, 'k' || stem FROM d WHERE stem % 4 <> 3""",
)
def dic1_dic6_loaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Glossary terms that wait for a review, hints, and keys of low value; every fourth document is cut off."""
    stems = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem")).distinct()
    n, cut = F.col("stem").cast("string"), F.col("stem") % 4 == 3
    as_doc = lambda c: stems.select("stem", F.when(cut, F.lit('{"terms": [{')).otherwise(c).alias("content"))
    terms = as_doc(F.concat(F.lit('{"terms": [{"en": "a", "reviewed": true}, {"en": "b'), n, F.lit('", "reviewed": false}, {"en": "c"}]}')))
    hints = as_doc(F.concat(F.lit('[{"en": "h'), n, F.lit('"}]')))
    low = as_doc(F.concat(F.lit('[" K'), n, F.lit('! ", "k'), n, F.lit('", "?"]')))
    waiting = review_targets(listed_entries(terms, "struct<en:string,reviewed:boolean>", "terms")).select(F.lit("term").alias("what"), "stem", "ordinal", F.col("en").alias("value"))
    known = listed_entries(hints, "struct<en:string>").select(F.lit("hint").alias("what"), "stem", "ordinal", F.col("en").alias("value"))
    keys = low_value_texts(low).select(F.lit("low").alias("what"), F.lit(None).cast("long").alias("stem"), F.lit(None).cast("int").alias("ordinal"), F.col("key").alias("value"))
    return waiting.unionByName(known).unionByName(keys)


@query(
    "snk5_snk6_reports",
    rf"""WITH {CUES} SELECT stem, count(*) AS items, sum(seq)::BIGINT AS seqs, 'video: ' || stem || chr(10) || 'events: total=' || count(*) || ' music=' || count_if(seq % 4 = 0) || chr(10) || 'issues: overlaps=0 very_long=' || count_if(length(text) > 40) || chr(10) AS report,
'| ' || stem || ' | ' || count(*) || ' | ' || count_if(seq % 4 = 0) || ' | 0 | ' || count_if(length(text) > 40) || ' |' AS line FROM cues GROUP BY stem""",
)
def snk5_snk6_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of cues, read back, with the reports of their files."""
    c = cues(spark, sf_dir)
    summaries = c.groupBy("stem").agg(F.count("*").alias("events"), F.count_if(F.col("seq") % 4 == 0).alias("music"), F.count_if(F.length("text") > 40).alias("very_long")).withColumn("overlaps", F.lit(None).cast("long"))
    back = listed_entries(json_documents(c, "seq"), "struct<seq:long,text:string>").groupBy("stem").agg(F.count("*").alias("items"), F.sum("seq").alias("seqs"))
    return back.join(text_reports(summaries).withColumnRenamed("content", "report"), "stem").join(summary_table(summaries), "stem")
