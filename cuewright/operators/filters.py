"""Filters and tests of finished events and of texts that go to models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import credit_text, has_han, has_latin, label_is_chant, normalize_text, repeated_phrase, tokens, visible_ass, words
from ..plans.registry import query
from ..sources.staging import CUES, LINES, cues, lines


def separator_only(c: Column | str) -> Column:
    r"""FLT9: all parts between \N are empty or marks."""
    return F.forall(F.split(F.col(c) if isinstance(c, str) else c, r"\\N"), lambda p: ~F.regexp_replace(p, r"\{[^}]*\}", "").rlike(r"[\p{L}\p{N}]"))


# How credit lines of captioners and sponsors read.
CREDIT_ZH = r"^\s*字幕由|赞助商|本字幕|本节目由.*提供"
CREDIT_EN = r"caption(?:ed|ing)\s+(?:by|sponsored)|media access group|access\.wgbh\.org|subtitled by|closed caption|viewers like you|contributions to your"


def credit_line(c: Column | str) -> Column:
    """FLT8: the line of a captioner or sponsor, not dialogue that mentions one."""
    x = visible_ass(c)
    return x.rlike(CREDIT_ZH) | x.rlike(f"(?i){CREDIT_EN}")


def filtered_events(events: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """FLT10: the events that stay, and per stem how many went for what."""
    tagged = events.withColumn("_why", F.when(separator_only(text), "separator").when(credit_line(text), "credit"))
    counts = tagged.groupBy("stem").agg(F.count("*").alias("events"), F.count_if(F.col("_why") == "separator").alias("separators"), F.count_if(F.col("_why") == "credit").alias("credits"))
    return tagged.filter("_why IS NULL").drop("_why"), counts


def guarded(polished: Column, source: Column, kind: Column) -> Column:
    """FLT21: a polished text must hold Chinese and stay within a length by its source; else empty."""
    limit = F.when(kind == "ocr", F.greatest(F.length(source) * 3 + 12, F.lit(64))).when(kind == "note", F.greatest(F.length(source) * 4 + 24, F.lit(110))).otherwise(F.greatest(F.length(source) * 3 + 12, F.lit(80)))
    return F.when(has_han(polished) & (F.length(polished) <= limit), polished).otherwise("")


def wants_split(duration_cs: Column, c: Column | str = "text") -> Column:
    """FLT22: eight words or more, and longer than 5.8 s or 78 characters."""
    return (F.size(tokens(c)) >= 8) & ((duration_cs > 580) | (F.length(normalize_text(c)) > 78))


def has_reference(c: Column | str) -> Column:
    """FLT11: a proper name of two to four words with eight characters or more, an acronym, or a foreign phrase. Goes before
    any model call."""
    x = normalize_text(c)
    names = F.regexp_extract_all(x, F.lit(r"(?U)\b[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){1,3}\b"), F.lit(0))
    return F.exists(names, lambda n: F.length(n) >= 8) | x.rlike(r"(?U)\b[A-Z]{2,}\b") | x.rlike(rf"(?iU)\b(?:{'|'.join(FOREIGN)})\b")


def note_candidate(c: Column | str) -> Column:
    """FLT11 with FLT7: a text without Chinese that is no credit and may hold a reference worth a note."""
    x = normalize_text(c)
    return (x != "") & ~has_han(x) & ~credit_text(x) & has_reference(x)


# Foreign phrases that deserve a note.
FOREIGN = ["et al", "c'est la vie", "cara mia", "in vitro", "quid pro quo", "status quo", "magnum opus"]
# Phrases of incantations and their words.
CHANTS = [
    "yoli conepiya miquiliztli", "spasiti animam suam", "animam suam", "tillate ulaz", "louvri animo", "pémét pou accessum", "pemet pou accessum", "les lames colligo", "ad me gluttuli", "anima marcam",
    "iskoristi vuka", "iskoristi vuca", "magia tollox de terras", "repo oma dal most",
]
CHANT_WORDS = [
    "accessum", "ad", "anima", "animo", "animam", "apne", "colligo", "conepiya", "det", "er", "gluttuli", "isk", "iskoristi", "laekna", "lames", "les", "louvri", "marcam", "magia", "miquiliztli", "pemet", "pémét",
    "pou", "repo", "revele", "soi", "som", "spasiti", "suam", "terras", "tillate", "toxicatus", "tollox", "ulaz", "vuca", "vuka", "votre", "vrai", "vrata", "yoli",
]


WEAK_CHANT_WORDS = ["det", "er", "som", "soi"]
CHANT_ENDINGS = "(?:atus|atum|icus|ae)$"


def chant(c: Column | str, italic: Column, labels: Column, repeated: Column, common: list[str]) -> Column:
    """FLT2: enough of the text is known phrases; else, where a label names a chant, few ``common`` words or a strong word
    of chants; else known words; else italics that repeat a clause or the whole text, or with Latin endings.

    ``labels``: array of label texts; ``repeated``: how often the text occurs in its stem.
    """
    w = words(c)
    n = F.size(w)
    rest = F.array_join(w, " ")
    for p in sorted(CHANTS, key=lambda p: -len(p.split())):
        rest = F.regexp_replace(rest, rf"\b{p}\b", "")
    phrases = n - F.size(F.filter(F.split(rest, " "), lambda x: x != ""))
    listed = lambda values: F.size(F.filter(w, lambda x: x.isin(values)))
    known, plain = listed(CHANT_WORDS), listed(common) / F.greatest(n, F.lit(1))
    strong = F.exists(w, lambda x: x.isin([v for v in CHANT_WORDS if v not in WEAK_CHANT_WORDS]))
    return (
        F.when(n == 0, False)
        .when((phrases > 0) & (phrases / F.greatest(n, F.lit(1)) >= 0.6), True)
        .when(F.coalesce(F.exists(labels, label_is_chant), F.lit(False)), (plain < 0.55) | strong)
        .when((known / F.greatest(n, F.lit(1)) >= 0.6) | ((n <= 4) & (known >= 2)), True)
        .when(italic & repeated_phrase(c) & (plain <= 0.45), True)
        .when(italic & (repeated >= 2), plain <= 0.45)
        .otherwise(italic & (n <= 7) & F.exists(w, lambda x: x.rlike(CHANT_ENDINGS)))
    )


_SHOWN = r"CASE seq % 5 WHEN 0 THEN '{\i1}--\N...' WHEN 1 THEN 'Captioned by X\N' || text WHEN 2 THEN '♪\N' || chr(123) || chr(125) WHEN 3 THEN 'captions are nice ' || left(text, 40) ELSE text END"


def _shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("seq") % 5, F.col("text")
    s = F.when(k == 0, F.lit(r"{\i1}--\N...")).when(k == 1, F.concat(F.lit("Captioned by X\\N"), t)).when(k == 2, F.lit("♪\\N{}")).when(k == 3, F.concat(F.lit("captions are nice "), F.substring(t, 1, 40))).otherwise(t)
    return cues(spark, sf_dir).withColumn("text", s)


@query(
    "flt8_flt10_event_filter",
    rf"""WITH {CUES}, x AS (SELECT stem, {_SHOWN} AS t FROM cues),
y AS (SELECT stem, NOT regexp_matches(regexp_replace(t, '\{{[^}}]*\}}', '', 'g'), '[\p{{L}}\p{{N}}]') OR len(list_filter(string_split(t, '\N'), lambda p: regexp_matches(regexp_replace(p, '\{{[^}}]*\}}', '', 'g'), '[\p{{L}}\p{{N}}]'))) = 0 AS sep,
  regexp_matches(v, '{CREDIT_ZH}') OR regexp_matches(v, '{CREDIT_EN}', 'i') AS cred FROM (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(t, '\{{[^}}]*\}}', '', 'g'), '\\[Nnh]', ' ', 'g'), '\s+', ' ', 'g')) AS v FROM x))
SELECT stem, count(*) AS events, count_if(sep)::BIGINT AS separators, count_if(cred AND NOT sep)::BIGINT AS credits FROM y GROUP BY stem""",
)
def flt8_flt10_event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered_events(_shown(spark, sf_dir))[1]


@query(
    "flt11_flt22_requests",
    rf"""WITH {CUES}, x AS (SELECT *, trim(regexp_replace(replace(text, '\N', ' '), '\s+', ' ', 'g')) AS t FROM cues)
SELECT stem, seq, len(list_filter(regexp_extract_all(t, '(?:^|[^\p{{L}}\p{{N}}_])([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){{1,3}})(?:$|[^\p{{L}}\p{{N}}_])', 1), lambda n: length(n) >= 8)) > 0 OR regexp_matches(t, '(^|[^\p{{L}}\p{{N}}_])[A-Z]{{2,}}($|[^\p{{L}}\p{{N}}_])') OR regexp_matches(t, '\b(?:et al|c''est la vie|cara mia|in vitro|quid pro quo|status quo|magnum opus)\b', 'i') AS reference,
  len(regexp_extract_all(text, '[A-Za-z0-9]+(?:[''’][A-Za-z0-9]+)?')) >= 8 AND (end_cs - start_cs > 580 OR length(t) > 78) AS split FROM x""",
)
def flt11_flt22_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues(spark, sf_dir).select("stem", "seq", has_reference("text").alias("reference"), wants_split(F.col("end_cs") - F.col("start_cs")).alias("split"))


_CHANTED = "CASE seq % 8 WHEN 0 THEN 'Animam suam, ' || split_part(text, ' ', 1) WHEN 1 THEN 'Louvri animo! ' || text WHEN 2 THEN 'vrai vrata' WHEN 3 THEN left(text, 25) WHEN 4 THEN 'Ora pro me. ' || left(text, 20) || '. Ora pro me!' WHEN 5 THEN 'det er ' || left(text, 30) WHEN 6 THEN 'the lunaticus of in' ELSE text END"
_COMMON = ["the", "and", "in", "of", "to", "that", "is", "you", "or", "be"]


@query(
    "flt2_chant",
    rf"""WITH {CUES}, t AS (SELECT stem, seq, {_CHANTED} AS t, (seq + stem) % 2 = 0 AS it, seq % 5 = 3 AS lab, (seq + stem) % 3 AS cnt FROM cues),
x AS (SELECT *, list_transform(regexp_extract_all(t, '[A-Za-zÀ-ÖØ-öø-ÿ]+(?:''[A-Za-zÀ-ÖØ-öø-ÿ]+)?'), lambda w: replace(lower(w), '''', '')) AS w,
  list_filter(list_transform(regexp_split_to_array(t, '[.!?;]+'), lambda x: trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda x: contains(x, ' ')) AS ps FROM t),
n AS (SELECT *, len(w) AS n, len(list_filter(w, lambda v: list_contains({CHANT_WORDS}, v))) AS k, len(list_filter(w, lambda v: list_contains({[v for v in CHANT_WORDS if v not in WEAK_CHANT_WORDS]}, v))) AS g,
  len(list_filter(w, lambda v: list_contains({_COMMON}, v))) / greatest(len(w), 1) AS m, CASE WHEN array_to_string(w[1:2], ' ') IN ('animam suam', 'louvri animo') THEN 2 ELSE 0 END AS p FROM x)
SELECT stem, seq, CASE WHEN n = 0 THEN false WHEN p / greatest(n, 1) >= 0.6 THEN true WHEN lab THEN m < 0.55 OR g > 0 WHEN k / greatest(n, 1) >= 0.6 OR (n <= 4 AND k >= 2) THEN true
  WHEN it AND len(ps) > len(list_distinct(ps)) AND m <= 0.45 THEN true WHEN it AND cnt >= 2 THEN m <= 0.45 ELSE it AND n <= 7 AND len(list_filter(w, lambda v: regexp_matches(v, '(atus|atum|icus|ae)$'))) > 0 END AS chant FROM n""",
)
def flt2_chant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all kinds, with italics, labels and counts by their place."""
    k, t = F.col("seq") % 8, F.col("text")
    shown = (
        F.when(k == 0, F.concat(F.lit("Animam suam, "), F.split_part(t, F.lit(" "), F.lit(1)))).when(k == 1, F.concat(F.lit("Louvri animo! "), t)).when(k == 2, "vrai vrata").when(k == 3, F.substring(t, 1, 25))
        .when(k == 4, F.concat(F.lit("Ora pro me. "), F.substring(t, 1, 20), F.lit(". Ora pro me!"))).when(k == 5, F.concat(F.lit("det er "), F.substring(t, 1, 30))).when(k == 6, "the lunaticus of in").otherwise(t)
    )
    place = F.col("seq") + F.col("stem")
    labels = F.when(F.col("seq") % 5 == 3, F.array(F.lit("door"), F.lit("chanting"))).otherwise(F.array(F.lit("door")))
    return cues(spark, sf_dir).select("stem", "seq", chant(shown, place % 2 == 0, labels, place % 3, _COMMON).alias("chant"))


@query(
    "flt18_flt21_guard",
    rf"""WITH {CUES}, x AS (SELECT stem, seq, text, CASE WHEN seq % 2 = 0 THEN '你好' ELSE '' END || repeat(left(text, 30), (seq % 5)::INTEGER) AS p, CASE seq % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'note' ELSE 'dialogue' END AS kind, left(text, 20) AS s FROM cues)
SELECT stem, seq, CASE WHEN regexp_matches(p, '[一-鿿]') AND length(p) <= CASE kind WHEN 'ocr' THEN greatest(length(s) * 3 + 12, 64) WHEN 'note' THEN greatest(length(s) * 4 + 24, 110) ELSE greatest(length(s) * 3 + 12, 80) END THEN p ELSE '' END AS kept FROM x""",
)
def flt18_flt21_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("seq"), F.col("text")
    polished = F.concat(F.when(k % 2 == 0, "你好").otherwise(""), F.expr("repeat(substring(text, 1, 30), int(seq % 5))"))
    kind = F.when(k % 3 == 0, "ocr").when(k % 3 == 1, "note").otherwise("dialogue")
    return cues(spark, sf_dir).select("stem", "seq", guarded(polished, F.substring(t, 1, 20), kind).alias("kept"))


def bilingual_files(rows: DataFrame) -> DataFrame:
    r"""PRJ5: files with Han, Latin and a style mark somewhere."""
    return rows.groupBy("stem").agg((F.bool_or(has_han("text")) & F.bool_or(has_latin("text")) & F.bool_or(F.col("text").rlike(r"BILINGUAL|\\N\{\\fs"))).alias("bilingual"))


@query(
    "prj5_bilingual_files",
    rf"""WITH {LINES}, x AS (SELECT stem, CASE WHEN stem % 3 = 0 THEN '你\N{{\fs42}}' || text ELSE text END AS text FROM lines)
SELECT stem, bool_or(regexp_matches(text, '[一-鿿]')) AND bool_or(regexp_matches(text, '[A-Za-z]')) AND bool_or(contains(text, 'BILINGUAL') OR contains(text, '\N{{\fs')) AS bilingual FROM x GROUP BY stem""",
)
def prj5_bilingual_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return bilingual_files(lines(spark, sf_dir).withColumn("text", F.when(F.col("stem") % 3 == 0, F.concat(F.lit("你\\N{\\fs42}"), t)).otherwise(t)))


