"""Guarded imports and sinks: English subtitles for the deaf to segments with counters of the same pass, an import that
fails for a file without a cue, and a sink that never overwrites a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times as D
from ..operators.texts import effect_only, kind
from ..plans.registry import query
from .staging import CUES, cues
from .subtitles import parse_srt, render

# How speakers are named in front of what they say, and labels of singing.
VOICE = r"(?:FEMALE|MALE)\s+VOICE(?:\s+in\s+[A-Z][A-Za-z -]{1,30})?"
NAMED = r"[A-Z][A-Z0-9 .'-]{1,40}"
VOCAL = r"(?iu)\b(singing|sings?|song|lyrics?|vocal(?:s|izing)?)\b"
#: Counters of an import, over all files.
COUNTERS = ("source_cues", "segments", "skipped_pure_labels", "skipped_non_dialogue", "music_segments", "chant_segments")


def spoken_text(c: F.Column | str) -> F.Column:
    """STR13: speakers' names go, where they stand inside a line a dash tells the turn."""
    x = F.regexp_replace(T.strip(T.text(c)), r"(?U)^\s*:\s*", "")
    x = F.regexp_replace(x, rf"(?U)^(?:{VOICE}|{NAMED})\s*:\s*", "")
    x = F.regexp_replace(x, rf"(?U)\s*(?:-{{1,3}}|[–—])\s*(?:{VOICE}|{NAMED})\s*:\s*", " — ")
    return T.squeeze(F.regexp_replace(x, r"(?U)\s+-\s+:\s*", " — "))


def english_cues(documents: DataFrame) -> DataFrame:
    """SRC9: every cue of the files with what becomes of it: stem, cue, start_ms, end_ms, text, kind, is_music, is_chant,
    labels, fate (segment, pure_label or non_dialogue)."""
    found = parse_srt(documents)
    spoken = F.trim(F.regexp_replace(T.strip_speaker("text"), r"(?U)^\s*[-–—]\s*♪\s*[-–—]\s*", "- "))
    orphan = spoken != T.strip_speaker("text")
    found = found.withColumns({"_spoken": spoken, "_sung": (F.col("has_music") & ~orphan) | T.has_note(spoken) | F.exists("labels", T.label_is_music)})
    dashless = F.regexp_replace("_spoken", r"(?U)^(?:[-–—]\s*)+|(?:\s*[-–—])+$", "")
    found = found.withColumn("_text", spoken_text(T.strip(dashless)))
    nothing = (F.col("_spoken") == "") | effect_only("_spoken") | (F.col("_sung") & ~F.col("_spoken").rlike(T.WORD)) | ~F.col("_text").rlike(r"[\p{L}\p{N}]")
    fate = F.when(F.col("pure_label"), "pure_label").when(nothing, "non_dialogue").otherwise("segment")
    chant = F.exists("labels", T.label_is_chant)
    music = T.has_note("_text") | F.exists("labels", lambda x: x.rlike(VOCAL))
    return found.select("stem", F.col("seq").alias("cue"), "start_ms", "end_ms", F.col("_text").alias("text"), kind(music, chant).alias("kind"), music.alias("is_music"), chant.alias("is_chant"), "labels", fate.alias("fate"))


def english_import(documents: DataFrame) -> tuple[DataFrame, Observation]:
    """SRC9: the segments (stem, seq, cue, start_ms, end_ms, text, kind, is_music, is_chant, labels), and counters that the
    first action on them fills in the same pass: ``observation.get`` has COUNTERS."""
    of = lambda fate: F.count_if(F.col("fate") == fate)
    taken = F.col("fate") == "segment"
    counters = [F.count(F.lit(1)), of("segment"), of("pure_label"), of("non_dialogue"), F.count_if(taken & F.col("is_music")), F.count_if(taken & F.col("is_chant"))]
    seen = Observation()
    rows = english_cues(documents).observe(seen, *[c.alias(n) for c, n in zip(counters, COUNTERS, strict=True)])
    seq = F.row_number().over(Window.partitionBy("stem").orderBy("start_ms", "end_ms", "cue"))
    return rows.filter(taken).withColumn("seq", seq).drop("fate"), seen


def whole_import(documents: DataFrame, segments: DataFrame) -> DataFrame:
    """DRV4: the segments, or an error that names a file of which there is none. ``documents``: a row for each file."""
    rows = documents.select("stem").distinct().join(segments, "stem", "left")
    none = F.raise_error(F.concat(F.lit("no cue in "), F.col("stem").cast("string")))
    checked = rows.withColumn("_there", F.when(F.col("seq").isNull(), none).otherwise(True)).filter("_there")
    return checked.select(*segments.columns)


def write_new(rows: DataFrame, path: str) -> None:
    """DRV5: documents (stem, content) as text, a folder for each stem; stems that are there already stop it before a file is
    written. Of copies of a stem within ``rows`` too."""
    spark = rows.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    named = rows.select(F.col("stem").cast("string").alias("stem"), "content")
    twice = named.groupBy("stem").agg(F.count("*").alias("n")).filter("n > 1").select("stem")
    if there:
        old = spark.read.text(path, wholetext=True).select(F.col("stem").cast("string").alias("stem")).distinct()
        twice = twice.union(named.select("stem").distinct().join(old, "stem", "left_semi"))
    taken = [r.stem for r in twice.limit(5).collect()]
    if taken:
        raise FileExistsError(f"not overwritten: {', '.join(taken)}")
    named.write.mode("append").partitionBy("stem").text(path)


def converted(documents: DataFrame) -> DataFrame:
    """DRV5: documents (stem, content) of SRT as ASS."""
    from .subtitles import HEADER, dialogue_line

    rows = parse_srt(documents).filter("text <> ''").withColumns({"start_cs": F.col("start_ms") / 10, "end_cs": F.col("end_ms") / 10})
    line = dialogue_line("start_cs", "end_cs", F.when(F.col("has_music"), "BILINGUAL_MUSIC").otherwise("BILINGUAL"), T.ass_text("text"))
    return render(rows.withColumns({"start_cs": F.floor("start_cs"), "end_cs": F.floor("end_cs")}), line, HEADER + "\n")


def _deaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = lambda c: F.replace(F.concat(D.centis_to_ass(c), F.lit("0")), F.lit("."), F.lit(","))
    plain = F.concat(F.lit("he said "), F.lower(F.regexp_replace(F.substring("text", 1, 60), "[^A-Za-z]+", " ")), F.lit("end"))
    k = F.col("seq") % 7
    body = F.when(k == 0, F.lit("{\\an8}(LOW BUZZ)")).when(k == 1, F.concat(F.lit("- (MUSIC PLAYING)\n- "), plain)).when(k == 2, F.concat(F.lit("<i>"), plain, F.lit("</i>"))).when(k == 3, F.concat(F.lit("NAREN: "), plain))
    body = body.when(k == 4, F.concat(F.lit("(CHANTING): "), plain)).when(k == 5, F.concat(plain, F.lit(". - BOBBY: okay"))).otherwise(F.concat(F.lit("♪ "), plain, F.lit(" ♪")))
    return render(cues(spark, sf_dir), F.concat(F.col("seq") + 1, F.lit("\n"), time("start_cs"), F.lit(" --> "), time("end_cs"), F.lit("\n"), body, F.lit("\n")), "")


_DEAF = rf"""{CUES}, p AS (SELECT stem, seq, start_cs, end_cs, seq % 7 AS k, trim(regexp_replace('he said ' || lower(regexp_replace(left(text, 60), '[^A-Za-z]+', ' ', 'g')) || 'end', ' +', ' ', 'g')) AS t FROM cues)"""


@query(
    "src9_english_import",
    f"""WITH {_DEAF} SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY greatest(start_cs, 0), greatest(end_cs, 0), seq)::INTEGER AS seq, greatest(start_cs, 0) * 10 AS start_ms,
CASE k WHEN 5 THEN t || '. — okay' WHEN 6 THEN '♪ ' || t || ' ♪' ELSE t END AS text, CASE k WHEN 4 THEN 'chant' WHEN 6 THEN 'lyric' ELSE 'dialogue' END AS kind FROM p WHERE k <> 0""",
)
def src9_english_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _deaf(spark, sf_dir)
    segments, _ = english_import(documents)
    return segments.select("stem", "seq", "start_ms", "text", "kind")


@query(
    "src9_import_fates",
    f"WITH {_DEAF} SELECT stem, CASE k WHEN 0 THEN 'pure_label' ELSE 'segment' END AS fate, count(*) AS n FROM p GROUP BY ALL",
)
def src9_import_fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return english_cues(_deaf(spark, sf_dir)).groupBy("stem", "fate").agg(F.count("*").alias("n"))
