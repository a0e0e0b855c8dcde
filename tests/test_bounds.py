"""No bound on the number of selectors and styles."""

from cuewright.operators.media import selected
from cuewright.sources.subtitles import upsert_styles


def test_each_selector_selects(spark):
    media = spark.createDataFrame([(i, f"clip x{i:04d}y") for i in range(1200)], "id int, name string")
    selectors = spark.createDataFrame([(f"X{i:04d}-Y",) for i in range(1100)], "selector string")
    assert sorted(r.id for r in selected(media, selectors).collect()) == list(range(1100))
    assert selected(media, selectors.filter("false")).count() == 0


def test_each_style_is_written_again(spark):
    lines = spark.createDataFrame([("a", i, f"Style: s{i},Arial") for i in range(1100)] + [("a", 1100, "Style: kept,Arial")], "stem string, n int, line string")
    styles = spark.createDataFrame([(f"s{i}", i, f"Style: s{i},New") for i in range(1100)], "style string, ordinal int, line string")
    got = sorted(r.line for r in upsert_styles(lines, styles).collect())
    assert got == sorted(["Style: kept,Arial"] + [f"Style: s{i},New" for i in range(1100)])
