"""Passages of which a document holds a part, or the whole, more than once."""

import random

import numpy as np

from cuewright.llm import passages


def test_a_passage_behind_its_own_first_half(spark):
    r = random.Random(5)
    words = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    rows, want = [], []
    for k in range(30):
        shared = words(70)
        rows.append((2 * k, " ".join(words(60) + shared[:35] + words(100) + shared + words(60))))
        rows.append((2 * k + 1, " ".join(words(80) + shared + words(80))))
        want.append((2 * k, 195, 265))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(docs).collect()
    whole = [any(f.doc_id == d and f.start_word <= low + passages.UNSEEN and f.end_word >= high - passages.UNSEEN for f in found) for d, low, high in want]
    assert all(whole)


def test_repeats_are_told_and_make_no_pairs(spark):
    r = random.Random(6)
    words = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    shared = words(60)
    rows = [(1, " ".join(sum((shared + words(80) for _ in range(12)), []))), (2, " ".join(words(50) + shared + words(50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(docs).collect()
    starts = {f.start_word for f in found if f.doc_id == 1}
    assert len(starts) >= passages.PLACES and all(min(s % 140, 140 - s % 140) <= passages.UNSEEN for s in starts)
    assert {f.doc_id for f in found} == {1, 2} and len(found) <= 60
    assert passages.leading(np.array([7, 3, 7, 7, 7, 7]), np.array([40, 50, 60, 60, 10, 20])).tolist() == [60, 50, 60, 60, -11, 60]
