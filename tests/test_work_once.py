"""Work that grows with the input alone: what a text needs is worked out once."""

from pyspark.sql import functions as F

from cuewright.functions import text as T
from cuewright.operators import dedupe, ocr_words, rules
from cuewright.sources import subtitles


def _planned(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_of_units_and_words_are_found_once(spark):
    rows = spark.createDataFrame([(["a b", "c d"], ["a", "b", "c", "d"]), (["a b", "c"], ["a", "b-c"]), (["a"], ["a"]), (["a", "b"], ["a", "x"]), (None, ["a"]), (["a", "b"], None)], "u array<string>, w array<string>")
    found = rows.select(rules.unit_spans(F.col("u"), F.col("w")).alias("s"))
    assert [r.s and [tuple(x) for x in r.s] for r in found.collect()] == [[(0, 1), (2, 3)], None, None, None, None, None]
    assert _planned(found).count("regexp_extract_all") == 2


def test_words_of_an_interval_are_found_and_counted_once(spark):
    rows = spark.createDataFrame([("a  b c d", 0.0, 2.0), (" ", 0.0, 1.0), (None, 0.0, 1.0)], "text string, start double, end double")
    found = rows.select(subtitles.even_words().alias("w"))
    assert [[tuple(x) for x in r.w] for r in found.collect()] == [[("a", 0.0, 0.5), ("b", 0.5, 1.0), ("c", 1.0, 1.5), ("d", 1.5, 2.0)], [], []]
    assert _planned(found).count("split(") == 1


def test_minutes_are_no_frames_of_their_own(spark):
    cues = [(1, 0, "hello there", 0), (1, 1, "hello there!", 10), (1, 2, "Hello there, you", 20), (1, 3, "hello there", 6000), (1, 4, None, 6001), (1, 5, "!", 6002), (2, 0, "xyz", 5), (2, 1, "hello there", 6)]
    found = dedupe.fuzzy_minute_dedupe(spark.createDataFrame(cues, "stem long, seq long, text string, start_cs long"))
    assert sorted(map(tuple, found.collect())) == [(1, 0, 2, "Hello there, you"), (1, 1, 3, "hello there"), (2, 0, 0, "xyz"), (2, 0, 1, "hello there")]
    assert "FlatMapGroupsInPandas" not in _planned(found)


def test_keys_and_blanks_are_the_same_by_fewer_matches(spark):
    odd = ["", None, " a  b ", "a\tb\n c", "A\\NB \\N", "é x", "　中 文  z", " \t x", "x  y", "\x00a\x1fb", "ÀB-c_d.E!", "İ Σ ς", "a b c", "\x0b\x0c \x85q"]
    rows = spark.createDataFrame(list(enumerate(odd)), "i int, t string")
    plain = F.trim(F.regexp_replace(T.text("t"), r"(?U)\s+", " "))
    key = F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.replace(T.text("t"), F.lit("\\N"), F.lit(" ")), r"(?U)\s+", " "))), "[^a-z0-9一-鿿]+", "")
    assert rows.filter((T.squeeze("t") != plain) | (T.text_key("t") != key)).isEmpty()
    assert "translate" in _planned(rows.select(T.text_key("t"))) and "\\s" not in _planned(rows.select(T.text_key("t")))


def test_only_words_that_a_lead_opens_are_looked_up(spark):
    long = "ofcat " + "- é x" * 200_000 + " xofcat Thecat OFCAT ofcatx"
    rows = spark.createDataFrame([(1, long), (2, None), (3, "catof of cat")], "i int, text string")
    words = spark.createDataFrame([("of",), ("the",), ("cat",)], "word string")
    done = ocr_words.split_joined(rows, words, ["i"], leads=["of", "the"])
    assert {r.i: r.text for r in done.collect()} == {1: "of cat " + "- é x" * 200_000 + " xofcat The cat OF CAT ofcatx", 2: None, 3: "catof of cat"}
    assert "(?i:of|the)" in _planned(done)
