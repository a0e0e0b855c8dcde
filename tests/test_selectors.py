"""Selectors and sidecars against plain loops."""

import random

from cuewright.operators import media as M


def test_selected_by_brute_force(spark):
    r = random.Random(5)
    text = lambda most: "".join(r.choice("aAb-1 ") for _ in range(r.randint(0, most)))
    names, selectors = [text(9) for _ in range(150)] + [None, "--"], [text(6) for _ in range(12)]
    key = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
    for wanted in (selectors, [s for s in selectors if len(key(s)) > 3], ["b"], []):
        media = spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], "id int, name string, _key string")
        done = M.selected(media, spark.createDataFrame([(w,) for w in wanted], "selector string"))
        assert sorted(x.id for x in done.collect()) == [i for i, n in enumerate(names) if any(key(w) in key(n) or key(n) in key(w) for w in wanted)]
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sidecar_candidates(spark):
    media = spark.createDataFrame([("d", "A"), ("d", "A.B"), ("d", "A"), ("e", "A"), ("d", ""), ("d", None)], "folder string, stem string")
    files = spark.createDataFrame([("d", n) for n in ["A.srt", "A.ass", "A.B.en.SRT", "a.srt", "A.B.vtt", "AB.srt", "A.mkv", ".srt", "A", "A.B.ass.srt", None]] + [("e", "A.x.y.ssa")], "folder string, name string")
    got = [(r.folder, r.stem, r.name) for r in sorted(M.sidecar_candidates(media, files).collect(), key=lambda r: (r.folder, r.stem, r.place))]
    assert got == [("d", "A", n) for n in ["A.ass", "A.B.ass.srt", "A.B.en.SRT", "A.srt", "A.B.vtt"]] + [("d", "A.B", n) for n in ["A.B.ass.srt", "A.B.en.SRT", "A.B.vtt"]] + [("e", "A", "A.x.y.ssa")]
