"""Terminology and rules by hand-worked cases."""

from pyspark.sql import functions as F

from cuewright.operators import rules, terminology

ENTRY = "ordinal int, source_en string, preferred_zh string, aliases array<string>, zh_aliases array<string>, case_sensitive boolean, scope string, series string, reviewed boolean"


def test_matching(spark):
    entries = spark.createDataFrame(
        [
            (1, "May", "梅", None, None, True, "dialogue", None, True), (2, "new york", "纽约", ["NYC"], ["新约克"], None, None, None, None), (3, "art", "艺术", None, None, False, "ocr", None, None),
            (4, "refused", "不", None, None, None, None, None, False), (5, "格雷", "Gray", None, None, None, "all", None, None), (6, "Bob", "", None, None, None, None, None, None),
        ],
        ENTRY,
    )
    texts = spark.createDataFrame(
        [(1, "May we go", "dialogue", ""), (2, "may we", "dialogue", ""), (3, "to New   York, NYC", "lyric", ""), (4, "artful art", "dialogue", ""), (5, "ART!", "ocr", ""), (6, "refused Bob", "dialogue", ""), (7, "格雷 says", "note", ""), (8, "", "ocr", "在新约克"), (9, "x", "ocr", "在新约克"), (10, None, "ocr", None)],
        "id int, text string, kind string, zh string",
    )
    got = sorted((r.id, r.ordinal) for r in terminology.matching_entries(texts, entries, target="zh").collect())
    assert got == [(1, 1), (3, 2), (5, 3), (7, 5), (8, 2)]


def test_series_and_scopes(spark):
    row = spark.range(1).select(
        *[terminology.series_fits(F.lit(s), F.lit(n)).alias(f"s{i}") for i, (s, n) in enumerate([("", "x"), ("Young One", "young.one.S01E02"), ("Young One", "youngone"), ("One", "Someone")])],
        *[terminology.scope_fits(F.lit(s), F.lit(k)).alias(f"k{i}") for i, (s, k) in enumerate([("", "note"), ("song/line", "lyric"), ("song", "dialogue"), ("ALL", "ocr"), ("other", "other")])],
        *[terminology.support_count(F.lit(s)).alias(f"n{i}") for i, s in enumerate(["7", "0", "x", None, "-3"])],
    ).first()
    assert list(row) == [True, True, False, False, True, True, False, True, True, 7, 1, 1, 1, 1]


def test_detections_follow_the_centre(spark):
    rows = [(1, 0, 1, 1.0, 0.5, 0.0, 0.0), (1, 0, 2, 1.0, 0.4, 900.0, 0.0), (1, 40, 3, 1.0, 0.9, 900.0, 0.0), (1, 40, 4, 1.0, 0.5, 10.0, 0.0), (1, 80, 5, 0.0, 0.0, None, None), (2, 0, 6, 0.5, 0.5, 1.0, 1.0), (2, 0, 7, 0.5, 0.5, 2.0, 1.0)]
    met = spark.createDataFrame(rows, "item int, frame_ms long, ordinal long, similarity double, confidence double, x double, y double")
    assert sorted((r.item, r.ordinal) for r in rules.best_detections(met, "item").collect()) == [(1, 1), (1, 4), (1, 5), (2, 6)]


def test_units_tile_the_words(spark):
    cases = [(["a b", "c."], ["a", "b", "c"], [(0, 1), (2, 2)]), (["a", "b c"], ["a", "b", "d"], None), (["a", ""], ["a"], None), (["a", "b"], ["a b"], None), (["a b"], ["a", "b"], None), (["b a"], [], None)]
    df = spark.createDataFrame([(i, u, w) for i, (u, w, _) in enumerate(cases)], "i int, u array<string>, w array<string>")
    got = {r.i: r.s and [(x["first"], x["last"]) for x in r.s] for r in df.select("i", rules.unit_spans(F.col("u"), F.col("w")).alias("s")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}
