"""Targets, presentation, styles, loaders and reports of finished files, by vectors worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from cuewright.operators import finished as X

EVENT = "stem long, seq long, style string, name string, start_cs long, end_cs long, text string"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, want",
    [
        (r"你好\Nhello", ("你好", "hello")),
        (r"你好\N世界\Nhello\Nthere", (r"你好\N世界", r"hello\Nthere")),
        (r"hello\Nthere", ("hello", "there")),
        (r"你\N{\fnArial}好", ("你", r"{\fnArial}好")),
        (r"{\fnArial}a\Nb", None),
        (r"你好\N世界", None),
        (r"你好\N{\i1}", None),
        ("你好", None),
        ("", None),
        (None, None),
    ],
)
def test_two_sides(spark, given, want):
    got = one(spark, X.two_sides(F.lit(given).cast("string")))
    assert (tuple(got) if got else None) == want


def test_older_pairs_take_the_last_events_and_nothing_else(spark):
    rows = [
        (1, 1, "EN", "", 0, 9, "extra"),
        (1, 2, "EN_i", "", 0, 9, "first"),
        (1, 3, "ZH", "", 0, 9, "一"),
        (1, 4, "Default", "", 0, 9, "♪ second"),
        (1, 5, "Default", "", 0, 9, "二"),
        (1, 6, "ZH", "", 10, 19, "三"),
        (2, 7, "EN", "", 10, 19, "elsewhere"),
        (2, 8, "Other", "", 10, 19, "四"),
        (None, 9, None, None, None, None, None),
    ]
    got = X.polish_targets(spark.createDataFrame(rows, EVENT), ["ZH", "Default"]).orderBy("seq").collect()
    assert [(r.seq, r.zh, r.en, r.kind) for r in got] == [(3, "一", "first", "dialogue"), (5, "二", "♪ second", "lyric")]
    assert X.polish_targets(spark.createDataFrame(rows, EVENT), ["ZH", "Default"], ["qwen"]).count() == 0


def test_missing_translations_are_targets_and_foreign_ones_are_not(spark):
    rows = [(1, 1, "BILINGUAL", "", 0, 9, r"……\Nhello"), (1, 2, "BILINGUAL", "", 0, 9, r"hallo\Nhello"), (1, 3, "OCR_TRANSLATION", "", 0, 9, "sign"), (1, 4, "BILINGUAL", "", 0, 9, None)]
    assert [r.seq for r in X.polish_targets(spark.createDataFrame(rows, EVENT), list(X.BILINGUAL) + list(X.OVERLAY)).collect()] == [1]


@pytest.mark.parametrize(
    "given, want",
    [
        (r"{\fs30\i1\an8}你\N{\b1}{\fscx90}you", r"{\an8}你\N{\fs42}you"),
        (r"{\c&HFF00FF&\1a&H80&}你好", "你好"),
        (r"a \b1 {\an8}", r"a \b1 {\an8}"),
        (None, ""),
    ],
)
def test_presentation(spark, given, want):
    assert one(spark, X.presented(F.lit(given).cast("string"))) == want


def test_styles(spark):
    style = lambda zh, en, old: one(spark, X.inferred_style(F.lit(zh), F.lit(en), F.lit(old).cast("string")))
    assert style("✦ 咒", "♪ x", None) == "BILINGUAL_CHANT"
    assert style("歌", '"a j"', "Other") == "BILINGUAL_MUSIC" and style("话", "talk", "Other") == "BILINGUAL"
    assert style("话", "talk", "BILINGUAL_CHANT") == "BILINGUAL_CHANT"
    assert one(spark, X.style_text(F.lit(r"{\i1}♪ 你 好 ♪"))) == "你好"
    assert one(spark, X.sized_style_line(F.lit("Style: BILINGUAL,A,1,2,3"))) == "Style: BILINGUAL,A,56,2,3"
    assert one(spark, X.sized_style_line(F.lit("Style: BILINGUAL,A"))) == "Style: BILINGUAL,A"


def test_positions_and_play_size(spark):
    at = lambda t: one(spark, X.positioned(F.lit(t).cast("string"), F.lit(5), F.lit(6)))
    assert at(r"{\an8}x") == r"{\an5\pos(5,6)\an8}x" and at(None) == r"{\an5\pos(5,6)}" and at(r"a\pos(1,-2)\pos(3,4)") == r"a\pos(5,6)\pos(3,4)"
    lines = spark.createDataFrame([(1, 0, "PlayResX: 640"), (1, 1, "playresx: 800"), (1, 2, "PlayResX: wide"), (2, 0, None)], "stem long, n int, line string")
    assert [tuple(r) for r in X.play_size(lines).orderBy("stem").collect()] == [(1, 800, 1080), (2, 1920, 1080)]


def test_strict_times_stop(spark):
    assert one(spark, X.ass_centis_or_error(F.lit("1:02:03.04"))) == 372304
    with pytest.raises(Exception, match="not a time"):
        one(spark, X.ass_centis_or_error(F.lit("soon")))


def test_format_lines(spark):
    doc = "Dialogue: a,b\nFormat: Text\nDialogue: one, with comma\nFormat: Start, End, Text\r\nDialogue: 0:00:01.00,0:00:02.50,{\\b1}x, y\\Nz\nDialogue: 0:00:01.00,0:00:02.50\nDialogue: 1,2,3"
    got = X.events_by_format(spark.createDataFrame([(1, doc), (2, ""), (3, None)], "stem long, content string")).orderBy("n").collect()
    assert [(r.start_cs, r.end_cs, r.visible) for r in got] == [(0, 0, "one, with comma"), (100, 250, "x, y | z")]


@pytest.mark.parametrize("said, want", [("[1]", "[1]"), ('a {"b": 1} c', '{"b": 1}'), ("<think>{}</think>", "{}"), (None, "{}"), ("{a} [1]", "{}"), ("```json\n[2]\n```", "[2]")])
def test_json(spark, said, want):
    assert one(spark, X.whole_or_salvaged_json(F.lit(said).cast("string"))) == want


def test_json_documents(spark):
    rows = spark.createDataFrame([(1, 2, None), (1, 1, "a"), (2, 1, 'q"')], "stem long, seq long, text string")
    got = {r.stem: json.loads(r.content) for r in X.json_documents(rows, "seq").collect()}
    assert got == {1: [{"seq": 1, "text": "a"}, {"seq": 2, "text": None}], 2: [{"seq": 1, "text": 'q"'}]}


def test_words_and_summaries(spark):
    none = F.lit(None).cast("array<struct<word:string,start:double,end:double>>")
    assert one(spark, X.timed_words(none)) == [] and one(spark, X.is_timed(none)) is False
    gone = X.stream_summary(F.lit(None).cast("int"), F.lit("x"), F.lit("eng"), F.lit(None).cast("string"), F.lit(True))
    assert one(spark, gone) is None
