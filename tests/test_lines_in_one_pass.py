"""Enforcement goes through the lines once, and quick tests before patterns change no text."""

import random

from pyspark.sql import functions as F

from cuewright.functions import text as T
from cuewright.operators import enforcement, finished, terminology

ENTRY = "ordinal long, source_en string, preferred_zh string, aliases array<string>, zh_aliases array<string>, case_sensitive boolean, scope string, reviewed boolean"
EVENT = "stem long, seq long, style string, name string, start_cs long, end_cs long, text string"


def _enforced(spark, rows, files, project, own):
    events = spark.createDataFrame([(i, n, "BILINGUAL", "", 0, 100, t) for i, n, t in rows], EVENT)
    files = spark.createDataFrame(files, "stem long, name string")
    project = spark.createDataFrame([(o, s, p, None, z, None, None, True, x) for o, s, p, z, x in project], ENTRY + ", series string")
    own = spark.createDataFrame([(o, s, p, None, z, None, None, True, i) for o, s, p, z, i in own], ENTRY + ", stem long")
    return enforcement.enforced_files(events, files, project, own)


def test_lines_are_read_and_moved_once(spark):
    done = _enforced(spark, [(1, 1, "旧港\\NThe Harbour")], [(1, "Show One")], [(1, "Harbour", "大港", ["旧港"], None)], [])
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1 and plan.count("BILINGUAL_MUSIC, EXPLANATION_NOTE") <= 1
    assert sum("LogicalRDD" in x and "style#" in x for x in plan.split("\n")) == 1  # events were read twice, for targets and for rows
    assert [r.text for r in done.collect()] == ["大港\\NThe Harbour"]


def test_entries_of_a_file_are_met_by_its_lines_alone(spark):
    """A lookup by the piece alone meets the entries of all files at each line."""
    own = [(i, "Harbour", f"{i}港", ["旧港"], i) for i in range(1, 6)]
    done = _enforced(spark, [(i, 1, "旧港\\NHarbour") for i in range(1, 7)], [(1, "A")], [], own)
    assert {r.stem: r.text.split("\\N")[0] for r in done.collect()} == {**{i: f"{i}港" for i in range(1, 6)}, 6: "旧港"}
    joins = [x for x in done._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in x and "_piece" in x]
    assert len(joins) == 1
    assert "_own" in done._jdf.queryExecution().optimizedPlan().toString()


def test_the_first_of_a_source_by_series(spark):
    """No list of firsts for each file: an entry itself tells the series that come before it."""
    project = [(1, "Bay", "甲湾", ["旧湾"], "Show Two"), (2, "bay", "乙湾", ["旧湾"], "Show One"), (3, "BAY", "丙湾", ["旧湾"], None), (4, "Bay", "丁湾", ["旧湾"], None), (5, "Bay", "戊湾", ["旧湾"], "Show Two")]
    files = [(1, "Show One"), (2, "Show Two"), (3, "Other"), (4, "Show Two Show One")]
    done = _enforced(spark, [(i, 1, "旧湾\\NBay") for i in range(1, 6)], files, project, [])
    assert {r.stem: r.text.split("\\N")[0] for r in done.collect()} == {1: "乙湾", 2: "甲湾", 3: "丙湾", 4: "甲湾", 5: "旧湾"}
    merged = enforcement.merged_terminology(spark.createDataFrame([(o, s, p, None, z, None, None, True, x) for o, s, p, z, x in project], ENTRY + ", series string"), spark.createDataFrame([], ENTRY + ", stem long"), spark.createDataFrame(files, "stem long, name string"))
    assert {r.ordinal: sorted(r.before) for r in merged.collect()} == {1: [], 2: ["Show Two"], 3: ["Show One", "Show Two"]}


def test_events_of_one_place_stay_apart(spark):
    done = _enforced(spark, [(1, 1, "旧港\\NHarbour"), (1, 1, "旧港。\\NHarbour"), (1, None, "旧港\\NHarbour"), (None, 1, "旧港\\NHarbour")], [(1, "A")], [(1, "Harbour", "大港", ["旧港"], None)], [])
    assert sorted(r.text for r in done.collect()) == ["大港\\NHarbour", "大港。\\NHarbour", "旧港\\NHarbour", "旧港\\NHarbour"]


def test_quick_tests_change_no_text(spark):
    r = random.Random(4)
    parts = ["a", "B", "j", "J", "jn", "”", '"', " ", "  ", "\t", "\n", "\r", "\r\n", "\x0b", "\x85", "　", " ", "\\N", "{", "}", "{\\i1}", "\\fnArial", "&amp;", "&lt;", "中", "文", "é", "ſ", "7", ".", "♪"]
    rows = spark.createDataFrame([(None,), ("",)] + [("".join(r.choice(parts) for _ in range(r.randint(1, 12))),) for _ in range(3000)], "t string")
    note = r"""(?U)(?<![0-9A-Za-z])(?:[jJ][“”"']|[jJ]n(?=\s))|[jJ][“”"'](?=\s|$)"""
    x = T.text("t")
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"(?U)[\s&&[^ ]]\s*| \s+", " "))
    lines = lambda c: F.array_join(F.filter(F.transform(F.split(F.regexp_replace(F.replace(c, F.lit("\\N"), F.lit("\n")), r"\r\n?", "\n"), "\n"), strip), lambda y: y != ""), " ")
    cache = lambda c: F.regexp_replace(squeeze(c), f"(?<={T.HAN})\\s+(?={T.HAN})", "")
    shown = lambda c: cache(lines(F.regexp_replace(F.regexp_replace(c, r"\{[^}]*\}", ""), note, "♪")))
    pairs = [(T.strip("t"), strip(F.col("t"))), (T.squeeze("t"), squeeze(x)), (T.music_symbols("t"), F.regexp_replace(x, note, "♪")), (T.normalize_lines("t"), lines(x)), (T.cache_text("t"), cache(x)), (finished.shown("t"), shown(x))]
    pairs += [(finished._shows_no_han(x), (shown(x) != "") & ~T.has_han(shown(x))), (T.pieces(T.folded("t")), F.regexp_extract_all(T.folded("t"), F.lit(r"[0-9a-z]+|[^\s0-9a-z]"), F.lit(0)))]
    assert rows.select(*[F.count_if(~a.eqNullSafe(b)) for a, b in pairs]).collect()[0] == tuple([0] * len(pairs))


def test_scopes_by_known_and_other_kinds(spark):
    scopes = [None, "", "all", "dialogue, lyric", "song", "Spoken/note", "trailer", "screen|x"]
    entries = spark.createDataFrame([(i, "bay", "湾", None, None, None, s, True) for i, s in enumerate(scopes)], ENTRY)
    kinds = ["dialogue", "lyric", "chant", "ocr", "note", "trailer", "spoken", None]
    texts = spark.createDataFrame([("the bay", k) for k in kinds], "text string, kind string")
    found = sorted((r.kind or "", r.ordinal) for r in terminology.met_entries(texts, entries).collect())
    assert found == sorted((r.kind or "", r.ordinal) for r in texts.crossJoin(entries).filter(terminology.scope_fits("scope", "kind")).collect())


def test_packed_entries_come_back_as_they_were(spark):
    rows = [(1, "Grand  Harbour", "大港", ["a\nb", "Bay", ""], ["旧港", "别 港"], True, None, True), (2, "x", "", None, None, None, None, True), (3, "\\N", "湾", ["\\N"], [], False, None, True)]
    e = enforcement.prepared(enforcement.entry(0))
    frame = spark.createDataFrame(rows, ENTRY).select(e.alias("e"), enforcement.unpacked(enforcement.packed(e)).alias("u"))
    assert [r.e.asDict(True) for r in frame.collect()] == [r.u.asDict(True) for r in frame.collect()]
