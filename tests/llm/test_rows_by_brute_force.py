"""Rows of near dedup, mixing and encoding on the smallest tables, and spans of passages, against brute force."""

import hashlib
import random
from collections import Counter

import public_tokenizers

import corpus_pipeline as p
from cuewright.llm import passages
from tests.llm.test_operators import brute_groups, edited, frame, prose, targets

SF = "/root/testdata/sf0.001"


def test_stage_rows(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    exact = p.exact_stage(spark, docs, SF).cache()
    near = p.near_stage(spark, exact, SF).cache()
    groups = brute_groups([(r.doc_id, r.text, r.source) for r in exact.collect()], 5, 80)
    kept = sorted(near.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in kept] == sorted({root for _, root in groups.values()})

    mixed = p.mixing_stage(spark, near, SF).cache()
    rows = {r.doc_id: r for r in kept}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(r == rows[r.doc_id] for r in mixed.collect()) and max(copies.values()) <= 3
    size, taken, largest = Counter(), Counter(), Counter()
    for r in kept:
        n = len((r.text or "").split())
        size[r.source] += n
        taken[r.source] += n * copies[r.doc_id]
        largest[r.source] = max(largest[r.source], n)
    for (source, _), target in zip(sorted(size.items()), targets(sorted(size.items())), strict=True):
        assert abs(taken[source] - target) <= largest[source]

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = p.encoding_stage(spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in encoded) == copies
    for r in encoded:
        text = rows[r.doc_id].text or ""
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def common(x, y):
    """Words of the longest common subsequence, by the whole table."""
    row = [0] * (len(y) + 1)
    for u in x:
        new = [0]
        for k, v in enumerate(y):
            new.append(row[k] + 1 if u == v else max(new[-1], row[k + 1]))
        row = new
    return row[-1]


def test_passage_spans(spark):
    rows, planted = [], {}
    r = random.Random(8)
    for k in range(20):
        words, gap = prose(r.randint(50, 300), 100 + k), r.randint(70, 120)
        second = prose(r.randint(50, 120), 200 + k)
        for d in (0, 1):
            head = r.randint(0, 60)
            text = " ".join([prose(head, 300 + 2 * k + d), edited(words, 40, k) if d else words, prose(gap + 9 * d, 400 + 2 * k + d), second, prose(40, 500 + 2 * k + d)])
            rows.append((2 * k + d, text, "a"))
            n, start = len(words.split()), head + len(words.split()) + gap + 9 * d
            planted[2 * k + d] = [(head, head + n), (start, start + len(second.split()))]
    texts = {i: t.split() for i, t, _ in rows}
    got = passages.repeated_passages(frame(spark, rows)).collect()
    for x in got:
        mine, other = texts[x.doc_id][x.start_word : x.end_word], texts[x.partner_id][x.partner_start : x.partner_end]
        assert common(mine, other) >= max(x.agreeing_words, passages.AGREE * min(len(mine), len(other)))
        assert x.doc_id // 2 == x.partner_id // 2 and any(s - 8 <= x.start_word and x.end_word <= e + 8 for s, e in planted[x.doc_id])
    for i, spans in planted.items():
        for k, (s, e) in enumerate(spans):
            found = {w for x in got if x.doc_id == i for w in range(x.start_word, x.end_word)} & set(range(s, e))
            assert len(found) >= (0.75 if k == 0 else 1) * (e - s) - 2 * (passages.WINDOW - 1)
