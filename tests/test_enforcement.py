"""Terminology in finished files by hand-worked cases, and the fold against a plain one over random entries."""

import random
import re

from pyspark.sql import functions as F

from cuewright.operators import enforcement as E

EVENT = "stem long, seq long, style string, name string, start_cs long, end_cs long, text string"
ENTRY = "ordinal long, source_en string, preferred_zh string, aliases array<string>, zh_aliases array<string>, case_sensitive boolean, scope string, reviewed boolean"


def plain_fold(text, entries):
    for preferred, chinese, variants, cased in entries:
        for a in sorted(set(chinese) - {preferred, ""}, key=lambda a: (-len(a), a)):
            if not (a in preferred and preferred in text):
                text = text.replace(a, preferred)
        for v in sorted(set(variants), key=lambda v: (-len(v), v)):
            text = re.sub(rf"(?<![0-9A-Za-z]){re.escape(v)}(?![0-9A-Za-z])", lambda m: preferred, text, flags=0 if cased else re.I)
    return text


def test_fold_by_a_plain_one(spark):
    r = random.Random(2)
    syllables = ["格", "雷", "斯", "艾", "维", "Al", "al", "Bob", "$1", "\\", "a.b"]
    word = lambda n: "".join(r.choice(syllables) for _ in range(r.randint(1, n)))
    cases = []
    for i in range(200):
        entries = [(word(3), [word(2) for _ in range(r.randint(0, 3))], [r.choice(["Al", "al Bob", "Bob", "a.b", "x"]) for _ in range(r.randint(1, 2))], r.random() < 0.3) for _ in range(r.randint(1, 4))]
        cases.append((i, " ".join(word(4) for _ in range(4)), entries))
    rows = [(i, t, [((0, n), p, sorted(set(z), key=lambda a: (-len(a), a)), sorted(set(v), key=lambda a: (-len(a), a)), c) for n, (p, z, v, c) in enumerate(es)]) for i, t, es in cases]
    frame = spark.createDataFrame(rows, f"i int, t string, entries array<struct<{E.ENTRY}>>".replace("place struct", "place: struct").replace(", preferred string", ", preferred: string").replace(", zh_aliases array", ", zh_aliases: array").replace(", variants array", ", variants: array").replace(", cased boolean", ", cased: boolean"))
    got = {x.i: x.out for x in frame.select("i", E.canonicalized("t", "entries").alias("out")).collect()}
    assert got == {i: plain_fold(t, es) for i, t, es in cases}
    assert sum(got[i] != t for i, t, _ in cases) > 100


def test_files(spark):
    text = lambda zh, en: f"{zh}\\N{en}"
    events = spark.createDataFrame(
        [
            (1, 1, "BILINGUAL", "", 0, 100, text("格雷格来了 Greg", "Greg came")), (1, 2, "BILINGUAL", "", 100, 200, text("格雷格斯来了", "Gregers came")), (1, 3, "OCR_TRANSLATION", "", 0, 100, "在格雷格家"), (1, 4, "BILINGUAL", "", 0, 1, text("没有", "nothing here")),
            (2, 1, "BILINGUAL", "", 0, 100, text("格雷格来了", "Greg came")), (2, 2, "Custom Song", "", 0, 100, text("May 梅", "May and may")), (2, 3, "Other", "", 0, 1, "May"), (3, 1, "BILINGUAL", "", 0, 100, text("格雷格", "Greg")),
        ],
        EVENT,
    )
    files = spark.createDataFrame([(1, "Show.One.S01"), (2, "show one S02"), (3, "Another")], "stem long, name string")
    project = spark.createDataFrame([(1, "Greg", "格列格", None, ["格雷格", "格雷"], None, None, True, "Show One"), (2, "May", "五月", None, None, True, "lyric", None, None), (3, "greg", "晚了", None, ["格列格"], None, None, None, "Show One"), (4, "nothing", "不", None, ["没"], None, None, False, None)], ENTRY + ", series string")
    own = spark.createDataFrame([(1, "GREG", "自己", None, ["格雷格"], None, None, True, 1), (2, "Greg", "第三", None, ["格雷格"], None, "all", True, 3), (3, "Greg", "后来", None, ["格雷格"], None, "all", True, 3)], ENTRY + ", stem long")
    rows = E.enforced_files(events, files, project, own).collect()
    got = {(r.stem, r.seq): r.text for r in rows}
    assert got == {
        (1, 1): text("格列格来了 格列格", "Greg came"), (1, 2): text("格雷格斯来了", "Gregers came"), (1, 3): "在格列格家", (1, 4): text("没有", "nothing here"),
        (2, 1): text("格列格来了", "Greg came"), (2, 2): text("五月 梅", "May and may"), (2, 3): "May", (3, 1): text("第三", "Greg"),
    }
    counts = {r.stem: (r.target, r.matched, r.changed) for r in E.enforcement_counts(spark.createDataFrame(rows)).collect()}
    assert counts == {1: (4, 2, 2), 2: (2, 2, 2), 3: (1, 1, 1)}
    assert {r.text for r in E.enforced_files(events, files, project.limit(0), own.limit(0)).collect()} == {r.text for r in events.collect()}
    assert E.enforced_files(events.limit(0), files, project, own).count() == 0


def test_fallback_keeps_names(spark):
    e = F.array(E.entry(0))
    rows = spark.createDataFrame([(1, "Greg", "格列格", None, ["格雷格"], None, None, True, "格雷格走了", "走了"), (1, "Greg", "格列格", None, ["格雷格"], None, None, True, "走了", "格雷格走"), (1, "Greg", "格列格", None, None, None, None, True, "", "走了")], ENTRY + ", before string, after string")
    text, missing = E.enforced_text(F.col("after"), e, F.col("before"))
    assert [tuple(r) for r in rows.select(text, missing).collect()] == [("格列格走了", []), ("格列格走", []), ("走了", [])]


def test_units_keep_their_english(spark):
    e = F.array(E.entry(0))
    rows = spark.createDataFrame([(1, "New York", "纽约", None, ["新约克"], None, None, True, [("to New", "去新约克"), ("York now", "新约克"), ("New York", "新约克")])], ENTRY + ", units array<struct<en:string,zh:string>>")
    [row] = rows.select(E.enforced_units(F.col("units"), e).alias("u")).collect()
    assert [tuple(u) for u in row.u] == [("to New", "去新约克"), ("York now", "新约克"), ("New York", "纽约")]  # a term across two units is in neither
