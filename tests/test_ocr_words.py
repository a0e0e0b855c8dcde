"""Joined words against all ways to part a word, and hand-worked repairs."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from cuewright.operators import ocr_words as W


def brute(word, dictionary, leads, most):
    """Every way to cut; fewest pieces, then the earliest cuts."""
    if word in dictionary or len(word) < 5:
        return None
    ways = []
    for k in range(1, most):
        for cuts in itertools.combinations(range(1, len(word)), k):
            parts = [word[a:b] for a, b in zip((0, *cuts), (*cuts, len(word)), strict=True)]
            if all(len(p) >= 2 and p in dictionary for p in parts) and (leads is None or all(p in leads for p in parts[:-1])):
                ways.append((k, cuts))
    return list(min(ways)[1]) if ways else None


@pytest.mark.parametrize(("most", "with_leads"), [(2, True), (2, False), (3, False), (4, True)])
def test_breaks_by_brute_force(spark, most, with_leads):
    r = random.Random(most)
    dictionary = {"".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(30)}
    leads = sorted(dictionary)[::2] if with_leads else None
    words = {"".join(r.choice("ab") for _ in range(r.randint(3, 10))) for _ in range(300)}
    frame = lambda ws: spark.createDataFrame([(w,) for w in sorted(ws)], "word string")
    got = {x.word: x.cuts for x in W.word_breaks(frame(words), frame(dictionary), leads, most).collect()}
    want = {w: c for w in words if (c := brute(w, dictionary, leads, most)) is not None}
    assert got == want and len(want) > 8


def test_joined_words_in_texts(spark):
    words = spark.createDataFrame([(w,) for w in ["of", "never", "their", "best", "firsthand", "with", "out", "for", "ever", "THE/xyz", "# note", "  ", "love", "try"]], "word string")
    dictionary = W.dictionary_words(words).cache()
    known = {r.word for r in dictionary.collect()}
    assert {"the", "loved", "loving", "tries", "trying", "heard", "bests"} <= known and not known & {"# note", "", "ofs", "lov"}
    rows = [(1, "ofnever theirbest firsthand without"), (2, "OFNEVER Ofnever ofNever oFNEVER, 'ofnever'"), (3, None), (4, ""), (5, "offor of never"), (6, "ofnever" * 2000), (7, "Über ofneverü 1ofnever2")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "id int, text string, _other string")
    got = {r.id: r.text for r in W.split_joined(frame, dictionary, ["id"]).collect()}
    assert got == {1: "of never their best firsthand without", 2: "OF NEVER Of never of Never of Never, 'of never'", 3: None, 4: "", 5: "of for of never", 6: "ofnever" * 2000, 7: "Über of neverü 1of never2"}
    assert W.split_joined(frame.limit(0), dictionary, ["id"]).count() == 0
    assert W.split_joined(frame, dictionary.limit(0), ["id"]).columns == ["id", "text", "_other"]


def test_glyphs(spark):
    cases = [("♪ stop *", " stop "), ("fuII ceIIar IIb", "fuII cellar Ilb"), ("l'm l'll L've", "I'm I'll I've"), ("l am", "I am"), ("Iike Ieave Iand It", "like leave land It"), ("AII", "All"), ("one. two.</i> <i>three. Four", "one two</i> <i>three. Four"), ("came In, In", "came in, in"), ("- BOB: hi - not a TAG", "- hi - not a TAG"), (None, "")]
    got = [r.t for r in spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, c string").orderBy("i").select(W.repaired("c").alias("t")).collect()]
    assert got == [c[1] for c in cases]

    def by_rules(t):
        t = (t or "").replace("♪", "").replace("*", "")
        while (n := re.sub(r"(?<=[A-Za-z])I(?=[a-z])", "l", t)) != t:
            t = n
        return t

    r = random.Random(1)
    odd = ["".join(r.choice("Ial I.") for _ in range(12)) for _ in range(200)]
    first = F.regexp_replace("c", W.REPAIRS[1][0], "l")
    assert [x.t for x in spark.createDataFrame([(i, c) for i, c in enumerate(odd)], "i int, c string").orderBy("i").select(first.alias("t")).collect()] == [by_rules(c) for c in odd]
