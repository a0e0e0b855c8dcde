"""Vectors worked out by hand, and properties."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cuewright.functions import text as T
from cuewright.functions import times as D
from cuewright.operators import dedupe, dictionary, timeline, tracks
from cuewright.sources import subtitles


def cue(seq, start, end, text="x", music=False):
    return tracks._Cue(seq, start, end, text, music)


def test_two_cues_align_with_one():
    found = tracks.align([cue(0, 100, 200), cue(1, 205, 300)], [cue(0, 103, 304)])
    assert [([c.seq for c in a], [c.seq for c in b]) for a, b in found] == [([0, 1], [0])]


def test_unmatched_music_stays_alone():
    found = tracks.align([cue(0, 100, 200), cue(1, 500, 700, music=True)], [])
    assert [([c.seq for c in a], b) for a, b in found] == [([1], [])]


def test_alignment_is_monotone():
    r = random.Random(4)
    for _ in range(50):
        at, left, right = 0, [], []
        for i in range(30):
            at += r.randint(5, 200)
            left.append(cue(i, at, at + r.randint(30, 300)))
            if r.random() < 0.8:
                right.append(cue(len(right), at + r.randint(-30, 30), left[-1].end + r.randint(-60, 60)))
        right.sort(key=lambda c: (c.start, c.end))
        blocks = tracks.align(left, right)
        for k in (0, 1):
            order = [right.index(c) if k else c.seq for b in blocks for c in b[k]]
            assert order == sorted(order) and len(order) == len(set(order))


def test_similarity():
    assert dedupe.similarity("Auto&Tire", "Awto&Tired") == pytest.approx(0.842, abs=1e-3)
    assert dedupe.similarity("", "x") == 0.0
    assert dedupe.ocr_similarity("hello world", "HELLO, world") == 1.0
    assert dedupe.ocr_similarity("abcd", "xxabcdxx") >= 0.82


def test_splits_cover_the_words():
    r = random.Random(2)
    for _ in range(100):
        at, words = 0, []
        for _ in range(r.randint(1, 60)):
            n = r.randint(5, 80)
            words.append((r.choice(["going", "to", "home.", "now,", "you", "know", "wait!"]), at, at + n))
            at += n + r.choice([0, 0, 0, 70])
        pieces = tracks.split_words(words)
        assert [w for p in pieces for w in p] == words and all(len(p) >= min(tracks.LEAST_WORDS, len(words)) for p in pieces)


def test_pieces():
    assert tracks.broken("") == [] and all(len(x) <= 19 for x in tracks.broken("a, b c d e f g, h i j k l m n o p q r s t u v w"))
    assert "".join("".join(tracks.cut_by_shares("你好，世界。再见，朋友。", [3, 5, 2])).split()) == "你好，世界。再见，朋友。"
    twelve = [f"sentence number {i}" for i in range(12)]
    four = tracks.coalesced(twelve, 4)
    assert len(four) == 4 and " ".join(four) == " ".join(twelve)


def test_viterbi_against_brute_force(spark):
    r = random.Random(8)
    rows, want = [], {}
    for stem in range(12):
        n, at, seqs = r.randint(1, 9), 0, []
        for i in range(n):
            at += r.choice([0, 100, 300, 900])
            seqs.append((stem, i, r.choice(["a", "b", ""]), at, at + 100, r.randint(-300, 300)))
            at += 100
        rows += seqs
        best = None
        for mask in range(1 << n):
            s = [mask >> i & 1 for i in range(n)]
            total = (seqs[0][5] + timeline.START) if s[0] else 0
            for i in range(1, n):
                gap, p, q = max(0, seqs[i][3] - seqs[i - 1][4]), seqs[i - 1][2], seqs[i][2]
                if (s[i - 1], s[i]) == (0, 1):
                    total += timeline.TO_MUSIC + (timeline.NEARBY if gap <= 250 else 0)
                elif (s[i - 1], s[i]) == (1, 0):
                    total += timeline.TO_SPEECH + (timeline.NEARBY if gap > 320 else 0)
                elif s[i]:
                    same = p and q and p == q
                    total += timeline.SAME_SPEAKER if gap <= 320 and same else timeline.NEAR if gap <= 250 else timeline.LONG if gap > 800 else timeline.ELSE
                    total += timeline.CHANGED if p and q and p != q else 0
                total += seqs[i][5] if s[i] else 0
            if best is None or total > best[0]:
                best = (total, [s])
            elif total == best[0]:
                best[1].append(s)
        want[stem] = best[1]
    frame = spark.createDataFrame(rows, "stem long, seq long, speaker string, start_cs long, end_cs long, score long")
    got = timeline.viterbi(frame, "score").toPandas().sort_values(["stem", "seq"])
    for stem, paths in want.items():
        assert got[got.stem == stem].is_music.astype(int).tolist() in paths


def test_sequential_groups():
    f = pd.DataFrame([(1, 0, 0, 500, "Exit", 0.5, 0.0, 0.0), (1, 1, 600, 1100, "Exit now", 0.9, 5.0, 0.0), (1, 2, 1200, 1700, "exit", 0.2, 900.0, 0.0), (1, 3, 9000, 9500, "Exit", 0.1, 0.0, 0.0)], columns=["stem", "seq", "start_ms", "end_ms", "text", "confidence", "x", "y"])
    got = dedupe._groups(f, 30, 3000, 6000, False, True, False)
    assert got[["start_ms", "end_ms", "text", "n"]].values.tolist() == [[0, 1100, "Exit now", 2], [1200, 1700, "exit", 1], [9000, 9500, "Exit", 1]]


def test_srt_document(spark):
    content = "﻿1\r\n00:00:01,5 --> 00:00:03,250\r\nJOHN: Hello <i>there</i>\r\n\r\nno times here\n\n2\n0:00:04.000 --> 0:00:05.000\n(SOBBING): Standard?\n\n3\n00:00:06,000 --> 00:00:07,000\n[door slams]\n"
    rows = subtitles.parse_srt(spark.createDataFrame([("a", content), ("b", "")], "stem string, content string")).orderBy("seq").collect()
    assert [(r.start_ms, r.end_ms, r.text, r.labels, r.pure_label, r.italic) for r in rows] == [
        (1500, 3250, "Hello there", [], False, True), (4000, 5000, "Standard?", ["SOBBING"], False, False), (6000, 7000, "[door slams]", ["door slams"], True, False)
    ]


def test_times_are_cut_not_rounded(spark):
    r = spark.range(1).select(D.seconds_to_ass(F.lit(3661.999)).alias("a"), D.ass_centis(F.lit("1:01:01.99")).alias("b"), D.ass_centis(F.lit("x")).alias("c"), D.seconds_to_ass(F.lit(-4.0)).alias("d")).first()
    assert tuple(r) == ("1:01:01.99", 366199, None, "0:00:00.00")


def test_whole_words_only(spark):
    rows = spark.createDataFrame([("the LA  Times",), ("flat",), ("LA",)], "text string").select(F.rlike("text", T.word_pattern(F.lit("la"))).alias("hit"))
    assert [r.hit for r in rows.collect()] == [True, False, True]
    kept = spark.range(1).select(dictionary.enforced(F.lit("no term"), F.lit("has Max"), F.array(F.lit("Max"), F.lit("Sam"))).alias("k")).first().k
    assert kept == "has Max"
