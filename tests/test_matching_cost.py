"""Terms in lines: what is moved, and which entry of a source counts."""

from cuewright.operators import enforcement, finished, terminology

ENTRY = "ordinal long, source_en string, preferred_zh string, aliases array<string>, zh_aliases array<string>, case_sensitive boolean, scope string, reviewed boolean"
EVENT = "stem long, seq long, style string, name string, start_cs long, end_cs long, text string"


def test_of_a_source_in_the_project_the_first_counts(spark):
    """The second is known by its whole source, not by the piece that lines are looked up by."""
    events = spark.createDataFrame([(1, 1, "BILINGUAL", "", 0, 100, "旧港别港\\NThe Grand Harbour")], EVENT)
    files = spark.createDataFrame([(1, "Show One")], "stem long, name string")
    project = spark.createDataFrame([(1, "Grand Harbour", "大港", None, ["旧港"], None, None, True, None), (2, "grand harbour", "乙港", None, ["别港"], None, None, True, None)], ENTRY + ", series string")
    own = spark.createDataFrame([], ENTRY + ", stem long")
    [row] = enforcement.enforced_files(events, files, project, own).collect()
    assert row.text == "大港别港\\NThe Grand Harbour"


def test_targets_without_older_files_take_one_pass(spark):
    events = spark.createDataFrame([(1, 1, "BILINGUAL", "", 0, 100, "你好\\Nhello"), (1, 2, "Default", "", 0, 100, "x")], EVENT)
    targets = finished.all_targets(events, [*finished.BILINGUAL])
    assert [tuple(r) for r in targets.collect()] == [(1, 1, "dialogue", "你好", "hello")]
    assert "Exchange" not in targets._jdf.queryExecution().executedPlan().toString()


def test_matches_move_without_their_text(spark):
    entries = spark.createDataFrame([(1, "May", "梅", ["may"], None, True, None, True), (2, "the", "这", ["THE"], None, None, None, True), (3, "New York", "纽约", None, None, None, None, True)], ENTRY)
    texts = spark.createDataFrame([(1, 0, "May the artist may", "dialogue"), (1, 1, "maybe another", "dialogue"), (2, 0, "NEW  york ſtraße THEß", "ocr"), (1, 0, "May the artist may", "dialogue")], "stem long, seq int, text string, kind string")
    found = terminology.matching_entries(texts, entries, keep=("stem", "seq"))
    assert sorted((r.stem, r.seq, r.ordinal) for r in found.collect()) == [(1, 0, 1), (1, 0, 2), (2, 0, 2), (2, 0, 3)]
    moved = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert moved and not any("text#" in x or "kind#" in x for x in moved)
