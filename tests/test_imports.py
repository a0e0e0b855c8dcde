"""Guarded imports and sinks, and the counters of a pass."""

import pytest
from pyspark.sql import functions as F

from cuewright.sources import imports as I
from cuewright.sources.subtitles import discover, parse_ass, read_documents

BODIES = ["{\\an8}(LOW BUZZ)", "- (MUSIC PLAYING)\n- Hello there.", "<i>Salvete quicumque estis;</i>", "NAREN: I am still here.", "(SOBBING): Standard?", "Turn it off. - BOBBY: Okay.", "FEMALE VOICE in Cantonese: Gok wai hou maa?"]


def srt(bodies):
    return "\n".join(f"{i}\n00:00:{2 * i - 1:02d},000 --> 00:00:{2 * i:02d},000\n{b}\n" for i, b in enumerate(bodies, 1))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([("a", srt(BODIES)), ("b", srt(["(CHANTING): ave, ave", "♪ la la ♪", "♪", "(SINGING) come", "door opens", "..."]))], "stem string, content string")


def test_english_import(spark, documents):
    segments, seen = I.english_import(documents)
    rows = sorted(segments.collect(), key=lambda r: (r.stem, r.seq))
    assert [r.text for r in rows if r.stem == "a"] == ["Hello there.", "Salvete quicumque estis;", "I am still here.", "Standard?", "Turn it off. — Okay.", "Gok wai hou maa?"]
    assert all(r.kind == "dialogue" and not r.is_music and not r.is_chant for r in rows if r.stem == "a")
    assert [(r.text, r.kind) for r in rows if r.stem == "b"] == [("ave, ave", "chant"), ("♪ la la ♪", "lyric"), ("come", "lyric")]
    assert seen.get == {"source_cues": 13, "segments": 9, "skipped_pure_labels": 1, "skipped_non_dialogue": 3, "music_segments": 2, "chant_segments": 1}
    alone, counted = I.english_import(documents.filter("stem = 'a'"))
    alone.write.format("noop").mode("overwrite").save()
    assert (counted.get["source_cues"], counted.get["segments"], counted.get["skipped_pure_labels"]) == (7, 6, 1)
    plan = segments._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and "Join" not in plan  # one pass has both


def test_an_import_without_cues_fails(spark, documents):
    segments, _ = I.english_import(documents)
    assert I.whole_import(documents, segments).count() == 9
    more = documents.union(spark.createDataFrame([("empty", "no times here")], "stem string, content string"))
    segments, _ = I.english_import(more)
    with pytest.raises(Exception, match="no cue in empty"):
        I.whole_import(more, segments).collect()
    assert I.whole_import(documents.limit(0), segments.limit(0)).count() == 0


def test_files_are_never_overwritten(spark, documents, tmp_path):
    path = f"{tmp_path}/out"
    made = I.converted(documents)
    I.write_new(made, path)
    read = lambda: spark.read.text(path, wholetext=True).select(F.col("stem").cast("string").alias("stem"), F.col("value").alias("content"))
    first = sorted(map(tuple, read().collect()))
    assert [r.text for r in parse_ass(read().filter("stem = 'a'")).orderBy("seq").collect()][2:4] == ["Salvete quicumque estis;", "I am still here."]
    with pytest.raises(FileExistsError, match="a, b|b, a"):
        I.write_new(made, path)
    again = made.filter("stem = 'a'").withColumn("stem", F.lit("c")).union(made.filter("stem = 'b'"))
    with pytest.raises(FileExistsError, match="b"):
        I.write_new(again, path)
    assert sorted(map(tuple, read().collect())) == first  # the new stem of a refused run is not there either
    I.write_new(again.filter("stem = 'c'"), path)
    assert sorted(r.stem for r in read().collect()) == ["a", "b", "c"]
    with pytest.raises(FileExistsError, match="a"):
        I.write_new(made.union(made.filter("stem = 'a'")), f"{tmp_path}/other")


def test_files_are_found_and_decoded(spark, tmp_path):
    deep = tmp_path / "x" / "y"
    deep.mkdir(parents=True)
    made = {"a.srt": "\ufeffZeile eins\nzwei".encode(), "x/b.c.SRT": "caf\u00e9 \u201cyes\u201d".encode("cp1252"), "x/y/d.srt": "\u4f60\u597d\n\n".encode(), "x/e.mkv": b"\0\1", "f.txt": b"no", "g.srt": b"a\x81\xff", "h.srt": b"", "i.srt": bytes(range(0x82, 0x8d))}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    got = {r.stem: r.content for r in read_documents(spark, str(tmp_path), "*.{srt,SRT}").collect()}
    assert got == {"a": "Zeile eins\nzwei", "b.c": "caf\u00e9 \u201cyes\u201d", "d": "\u4f60\u597d\n\n", "g": "a\ufffd\ufffd", "i": bytes(range(0x82, 0x8d)).decode("cp1252")}
    assert [r.stem for r in discover(spark, str(tmp_path)).collect()] == ["e"]
    assert [r.stem for r in discover(spark, str(tmp_path), ["srt"]).collect()] == ["a", "g", "i", "b.c", "d"]
