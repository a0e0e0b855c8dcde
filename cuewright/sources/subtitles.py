"""Timed-text documents to rows, and back.

A document is one row (stem, content); parsing splits it inside the JVM. Documents are read whole, one row per file, and
are a few hundred KB each, so the rows stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times as D
from ..plans.registry import query, table
from .staging import CUES, cues

ARROW = r"(\d+:\d{2}:\d{2}[,.]\d{1,3})\s*-->\s*(\d+:\d{2}:\d{2}[,.]\d{1,3})"
MEDIA = ["mkv", "mp4", "avi", "mov", "m4v", "ts", "webm"]


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """stem, content of all files below a folder, decoded as SRC14 says; a byte order mark goes. Spark reads no empty files: they have no row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"), decoded(F.col("content")).alias("content"))


def discover(spark: SparkSession, path: str, extensions: list[str] | None = None) -> DataFrame:
    """SRC1: files below a folder by extension, in order of path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"), ext.alias("ext")).filter(F.col("ext").isin(extensions or MEDIA)).orderBy("path")


#: Bytes 80 to 9F of windows-1252, where it differs from ISO-8859-1; five of them stand for nothing.
_CP1252 = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]


def decoded(content: F.Column) -> F.Column:
    """SRC14, SRC15: bytes as UTF-8 where they are valid, else as windows-1252 if all stand for something there, else as UTF-8
    with replacement characters; a byte order mark goes."""
    raw, latin = content.cast("string"), F.decode(content, "iso-8859-1")
    known = [(a, b) for a, b in _CP1252 if b]
    western = F.translate(latin, "".join(a for a, _ in known), "".join(b for _, b in known))
    unknown = latin.rlike("[" + "".join(a for a, b in _CP1252 if not b) + "]")
    return F.regexp_replace(F.when(F.is_valid_utf8(raw), raw).when(unknown, F.make_valid_utf8(raw)).otherwise(western), "^\ufeff", "")


def _breaks(c: str) -> F.Column:
    return F.regexp_replace(T.text(c), r"\r\n?", "\n")


def parse_srt(documents: DataFrame) -> DataFrame:
    """SRC2/SRC3: blocks between blank lines; the first line with an arrow has the times, text follows it.

    Columns: stem, seq, start_ms, end_ms, raw, text, labels, pure_label, italic, has_music. Blocks without times go.
    """
    clean = F.regexp_replace(_breaks("content"), r"(?i)^\s*WEBVTT[^\n]*\n+", "")
    blocks = documents.select("stem", F.posexplode(F.split(T.strip(clean), r"\n\s*\n")).alias("block", "b"))
    lines = F.filter(F.split("b", "\n"), lambda x: T.strip(x) != "")
    timed = blocks.withColumn("lines", lines).withColumn("at", F.array_position(F.transform("lines", lambda x: x.contains("-->")), F.lit(True)).cast("int")).filter("at > 0")
    times = F.element_at("lines", F.col("at"))
    raw = T.strip(F.array_join(F.slice("lines", F.col("at") + 1, F.size("lines")), "\n"))
    found = timed.withColumn("times", times).filter(F.col("times").rlike(ARROW)).withColumn("raw", raw)
    body, plain = T.without_labels("raw"), T.normalize_inline(T.strip_tags("raw"))
    found = found.select(
        "stem", "block",
        D.srt_millis(F.regexp_extract("times", ARROW, 1)).alias("start_ms"),
        D.srt_millis(F.regexp_extract("times", ARROW, 2)).alias("end_ms"),
        "raw", body.alias("_body"), plain.alias("raw_plain"), T.labels("raw").alias("labels"),
    )
    spoken = T.strip_speaker(F.when(F.col("_body") != "", F.col("_body")).otherwise(F.col("raw_plain")))
    return found.select(
        "stem",
        F.row_number().over(Window.partitionBy("stem").orderBy("block")).alias("seq"),
        "start_ms", "end_ms", "raw", spoken.alias("text"), "raw_plain", "labels",
        (((F.size("labels") > 0) & (F.col("_body") == "")) | T.speaker_only("raw_plain")).alias("pure_label"),
        F.col("raw").rlike(r"(?i)</?\s*i\b[^>]*>").alias("italic"),
        T.has_note("raw_plain").alias("has_music"),
    )


def parse_bilingual_srt(documents: DataFrame) -> DataFrame:
    """SRC8: a cue runs from its times to the next times, blank lines or not; a last line of digits only is the next number.

    Columns: stem, seq, start_ms, end_ms, en, zh, style.
    """
    lines = documents.select("stem", F.posexplode(F.split(_breaks("content"), "\n")).alias("n", "line"))
    is_time = F.col("line").rlike(ARROW)
    cue = F.sum(is_time.cast("int")).over(Window.partitionBy("stem").orderBy("n"))
    tagged = lines.withColumn("cue", cue).filter("cue > 0")
    shown = F.replace(T.strip(T.unescape(F.regexp_replace("line", T.TAG, ""))), F.lit("\\N"), F.lit(" "))
    tagged = tagged.withColumn("shown", F.when(~is_time, shown)).withColumn("times", F.when(is_time, F.col("line")))
    grouped = tagged.groupBy("stem", "cue").agg(F.max("times").alias("times"), F.sort_array(F.collect_list(F.when(F.col("shown") != "", F.struct("n", "shown")))).alias("rows"))
    texts = F.transform("rows", lambda r: r["shown"])
    texts = F.when(F.element_at(texts, -1).rlike(r"^\d+$"), F.slice(texts, 1, F.size(texts) - 1)).otherwise(texts)
    # An empty array has no last element.
    grouped = grouped.filter(F.size("rows") > 0).withColumn("texts", texts)
    side = lambda han: F.array_join(F.filter("texts", lambda x: x.rlike(T.HAN) == han), " ")
    out = grouped.select("stem", "cue", D.srt_millis(F.regexp_extract("times", ARROW, 1)).alias("start_ms"), D.srt_millis(F.regexp_extract("times", ARROW, 2)).alias("end_ms"), side(False).alias("en"), side(True).alias("zh"))
    out = out.filter(((F.col("en") != "") | (F.col("zh") != "")) & (F.col("end_ms") > F.col("start_ms")))
    both = F.concat_ws(" ", "en", "zh")
    style = F.when(both.contains("✦"), "BILINGUAL_CHANT").when(both.contains("♪"), "BILINGUAL_MUSIC").otherwise("BILINGUAL")
    return out.select("stem", F.row_number().over(Window.partitionBy("stem").orderBy("cue")).alias("seq"), "start_ms", "end_ms", "en", "zh", style.alias("style"))


ASS_FIELDS = ["layer", "start", "end", "style", "name", "margin_l", "margin_r", "margin_v", "effect", "text"]


def parse_ass(documents: DataFrame) -> DataFrame:
    """SRC4-SRC6: Dialogue lines with exactly ten fields; the last keeps its commas. Times in centiseconds."""
    lines = documents.select("stem", F.posexplode(F.split(_breaks("content"), "\n")).alias("n", "line")).filter(F.col("line").startswith("Dialogue:"))
    parts = lines.withColumn("p", F.split(F.regexp_replace("line", "^Dialogue:", ""), ",", 10)).filter(F.size("p") == 10)
    named = parts.select("stem", "n", *[(F.col("p")[i] if f == "text" else F.trim(F.col("p")[i])).alias(f) for i, f in enumerate(ASS_FIELDS)])
    seq = F.row_number().over(Window.partitionBy("stem").orderBy("n"))
    return named.withColumns({"start_cs": D.ass_centis("start"), "end_cs": D.ass_centis("end"), "seq": seq}).drop("n", "start", "end")


def ass_header_lines(documents: DataFrame) -> DataFrame:
    """SRC7: each line with the section that it stands in, header before [Events]."""
    lines = documents.select("stem", F.posexplode(F.split(_breaks("content"), "\n")).alias("n", "line"))
    inside = F.max((F.trim("line") == "[Events]").cast("int")).over(Window.partitionBy("stem").orderBy("n"))
    return lines.withColumn("section", F.when(inside == 1, "events").otherwise("header"))


def normalize_transcript(documents: DataFrame) -> DataFrame:
    """SRC10: transcription JSON under either name of its list; offsets in ms win over seconds, an end not behind the
    start is half a second later; corrupt documents give no rows (SRC17)."""
    item = "struct<start:double,end:double,text:string,offsets:struct<`from`:double,`to`:double>,speaker:string>"
    doc = F.from_json("content", f"struct<segments:array<{item}>,transcription:array<{item}>>")
    rows = documents.withColumn("d", doc).select("stem", F.posexplode(F.coalesce("d.segments", "d.transcription")).alias("n", "s"))
    start = F.coalesce(F.col("s.offsets.from") / 1000.0, F.col("s.start"), F.lit(0.0))
    rows = rows.withColumn("start", start).withColumn("end", F.coalesce(F.col("s.offsets.to") / 1000.0, F.col("s.end"), F.col("start")))
    text = T.normalize_inline("s.text")
    return rows.select("stem", "n", "start", F.when(F.col("end") <= F.col("start"), F.col("start") + 0.5).otherwise(F.col("end")).alias("end"), text.alias("text"), F.col("s.speaker").alias("speaker")).filter("text <> ''")


def even_words(text: str = "text", start: str = "start", end: str = "end") -> F.Column:
    """SRC11, fallback: words with equal shares of the interval."""
    words = F.filter(F.split(T.squeeze(text), " "), lambda w: w != "")
    step = lambda n: (F.col(end) - F.col(start)) / F.greatest(n, F.lit(1))

    def spread(words: F.Column, step: F.Column) -> F.Column:
        return F.transform(words, lambda w, i: F.struct(w.alias("word"), (F.col(start) + step * i).alias("start"), (F.col(start) + step * (i + 1)).alias("end")))

    # Bound, the words are found and counted once for a text, and not again for each of them.
    return T.let(words, lambda ws: T.let(step(F.size(ws)), lambda st: spread(ws, st)))


def ocr_rows(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """SRC16: parallel arrays of texts, scores and boxes to rows, low scores left out."""
    doc = F.from_json("content", "struct<rec_texts:array<string>,rec_scores:array<double>,rec_boxes:array<array<double>>>")
    rows = documents.withColumn("d", doc).select("stem", F.posexplode(F.arrays_zip("d.rec_texts", "d.rec_scores", "d.rec_boxes")).alias("n", "r"))
    return rows.select("stem", "n", T.normalize_text("r.rec_texts").alias("text"), F.col("r.rec_scores").alias("confidence"), F.col("r.rec_boxes").alias("bbox")).filter((F.col("confidence") >= least) & (F.col("text") != ""))


def sample_times(duration_ms: F.Column, interval_ms: int = 500, most: int = 7201) -> F.Column:
    """SRC21: half an interval in, then each interval, up to a number."""
    last = F.least(F.floor((duration_ms - interval_ms / 2 - 1) / interval_ms), F.lit(most - 1))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda i: i * interval_ms + interval_ms // 2)).otherwise(F.array().cast("array<bigint>"))


HEADER = "[Script Info]\nScriptType: v4.00+\nPlayResX: 1920\nPlayResY: 1080\n\n[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text"


def dialogue_line(start_cs: str, end_cs: str, style: F.Column, text: F.Column, layer: int = 0, name: F.Column | None = None) -> F.Column:
    """SNK3."""
    return F.concat(F.lit(f"Dialogue: {layer},"), D.centis_to_ass(start_cs), F.lit(","), D.centis_to_ass(end_cs), F.lit(","), style, F.lit(","), name if name is not None else F.lit(""), F.lit(",0,0,0,,"), text)


def render(rows: DataFrame, line: F.Column, header: str, between: str = "\n") -> DataFrame:
    """SNK1/SNK2: one document per stem, lines in order of seq."""
    made = rows.select("stem", "seq", line.alias("line")).groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("seq", "line"))).alias("x"))
    return made.select("stem", F.concat(F.lit(header), F.array_join(F.transform("x", lambda r: r["line"]), between), F.lit("\n")).alias("content"))


def write_documents(documents: DataFrame, path: str) -> None:
    """A line-oriented text sink, one folder per stem (partitions, so a stem can be replaced alone)."""
    documents.select("stem", F.col("content").alias("value")).write.mode("overwrite").partitionBy("stem").text(path)


def upsert_styles(lines: DataFrame, styles: DataFrame) -> DataFrame:
    """SNK8: header lines without the styles to be set, and those styles behind them."""
    name = F.trim(F.regexp_extract("line", r"^Style:\s*([^,]+)", 1))
    kept = lines.withColumn("style", name).join(styles.select("style"), "style", "left_anti").select("stem", "n", "line")
    ends = lines.groupBy("stem").agg(F.max("n").alias("n"))
    added = ends.join(styles, F.lit(True)).select("stem", (F.col("n") + F.col("ordinal") + 1).alias("n"), "line")
    return kept.unionByName(added)


def _srt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as SRT documents."""
    time = lambda c: F.replace(F.concat(D.centis_to_ass(c), F.lit("0")), F.lit("."), F.lit(","))
    one_line = F.regexp_replace("text", r"\s+", " ")
    block = F.concat(F.col("seq") + 1, F.lit("\n"), time("start_cs"), F.lit(" --> "), time("end_cs"), F.lit("\n[music] "), one_line, F.lit("\n"))
    return render(cues(spark, sf_dir), block, "")


_ONE = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(
    "src2_srt_round_trip",
    f"""WITH {CUES} SELECT stem, (seq + 1)::INTEGER AS seq, greatest(start_cs, 0) * 10 AS start_ms, greatest(end_cs, 0) * 10 AS end_ms, 'music' AS labels, {_ONE} AS text, false AS pure_label FROM cues""",
)
def src2_srt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parse_srt(_srt(spark, sf_dir))
    return found.select("stem", "seq", "start_ms", "end_ms", F.array_join("labels", "|").alias("labels"), "text", "pure_label")


@query(
    "src8_bilingual_round_trip",
    f"""WITH {CUES} SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY seq)::INTEGER AS seq, greatest(start_cs, 0) * 10 AS start_ms, greatest(end_cs, 0) * 10 AS end_ms, {_ONE} AS en, '你好' || seq AS zh, CASE WHEN seq % 3 = 0 THEN 'BILINGUAL_MUSIC' ELSE 'BILINGUAL' END AS style
FROM (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN '♪ ' || text ELSE text END AS text) FROM cues)""",
)
def src8_bilingual_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues without blank lines between them."""
    time = lambda c: F.replace(F.concat(D.centis_to_ass(c), F.lit("0")), F.lit("."), F.lit(","))
    one_line = T.strip(F.regexp_replace(F.when(F.col("seq") % 3 == 0, F.concat(F.lit("♪ "), F.col("text"))).otherwise(F.col("text")), r"\s+", " "))
    block = F.concat(F.col("seq") + 1, F.lit("\n"), time("start_cs"), F.lit(" --> "), time("end_cs"), F.lit("\n"), one_line, F.lit("\n你好"), F.col("seq"))
    return parse_bilingual_srt(render(cues(spark, sf_dir), block, ""))


@query(
    "src6_snk1_ass_round_trip",
    f"""WITH {CUES} SELECT stem, row_number() OVER (PARTITION BY stem ORDER BY seq)::INTEGER AS seq, greatest(start_cs, 0) AS start_cs, greatest(end_cs, 0) AS end_cs, 'BILINGUAL' AS style, speaker AS name, translate({_ONE}, '{{}}', '()') AS text FROM cues""",
)
def src6_snk1_ass_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = T.ass_text(T.strip(F.regexp_replace("text", r"\s+", " ")))
    documents = render(cues(spark, sf_dir), dialogue_line("start_cs", "end_cs", F.lit("BILINGUAL"), text, name=F.col("speaker")), HEADER + "\n")
    return parse_ass(documents).select("stem", "seq", "start_cs", "end_cs", "style", "name", "text")


@query(
    "src7_ass_sections",
    f"""WITH {CUES} SELECT stem, section, n FROM (SELECT stem, 'header' AS section, 5::BIGINT AS n FROM cues GROUP BY stem UNION ALL SELECT stem, 'events', count(*) + 3 FROM cues GROUP BY stem)""",
)
def src7_ass_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = render(cues(spark, sf_dir), dialogue_line("start_cs", "end_cs", F.lit("X"), F.lit("y")), HEADER + "\n")
    return ass_header_lines(documents).groupBy("stem", "section").agg(F.count("*").alias("n"))


@query(
    "src10_src11_transcripts",
    rf"""WITH {CUES}, t AS (SELECT stem, seq, start_cs / 100 AS s, end_cs / 100 AS e, {_ONE} AS t FROM cues)
SELECT stem, seq::INTEGER AS n, round(s, 3) AS start, round(e, 3) AS "end", len(list_filter(string_split(t, ' '), lambda w: w <> ''))::INTEGER AS words FROM t WHERE t <> ''""",
)
def src10_src11_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = F.struct((F.col("start_cs") / 100).alias("start"), (F.col("end_cs") / 100).alias("end"), F.regexp_replace("text", r"\s+", " ").alias("text"))
    docs = cues(spark, sf_dir).groupBy("stem").agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("seq", seg.alias("s")))), lambda r: r["s"]).alias("segments"))).alias("content"))
    found = normalize_transcript(docs).withColumn("words", even_words())
    return found.select("stem", "n", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.size("words").alias("words"))


@query(
    "src21_sample_grid",
    f"""WITH {CUES}, d AS (SELECT stem, max(end_cs) * 10 AS ms FROM cues GROUP BY stem) SELECT stem, (i * 500 + 250)::BIGINT AS at_ms FROM d, range(0, 7201) r(i) WHERE i * 500 + 250 < ms""",
)
def src21_sample_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = cues(spark, sf_dir).groupBy("stem").agg((F.max("end_cs") * 10).alias("ms"))
    return spans.select("stem", F.explode(sample_times(F.col("ms"))).alias("at_ms"))


@query(
    "src16_ocr_rows",
    "SELECT user_id AS stem, event_type AS text, count(*) AS n FROM events WHERE value >= 50 GROUP BY ALL",
)
def src16_ocr_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recogniser output with parallel arrays, one document per stem."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("stem")).agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("x"))
    boxes = F.transform("x", lambda r: F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)))
    docs = e.select("stem", F.to_json(F.struct(F.col("x.event_type").alias("rec_texts"), F.col("x.value").alias("rec_scores"), boxes.alias("rec_boxes"))).alias("content"))
    return ocr_rows(docs, 50.0).groupBy("stem", "text").agg(F.count("*").alias("n"))


@query(
    "snk7_manifest",
    "SELECT page_id, sha256(html) AS digest FROM pages",
)
def snk7_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("digest"))
