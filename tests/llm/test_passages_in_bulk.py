"""What a match of two documents costs: the common cases are done for all pairs of a batch at once."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cuewright.llm import passages
from cuewright.llm.passages import AGREE, LEAST, SEED, UNSEEN, WINDOW


def _equal(x, y):
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


def _one_pair(rows):
    """One chain after the other, one match after the other; rows: pos, partner's pos, (words, words before) twice."""
    out = []
    b, a = [r[0] for r in rows], [r[1] for r in rows]
    for chain in passages.chained_runs(a, b):
        if len(chain) < 2:
            continue
        steps, sizes, unseen = [], [], 0
        for i, j in zip(chain, [*chain[1:], None], strict=True):
            (x, _), (y, _) = rows[i][2:]
            if j is None:
                nx = ny = agree = seen = max(_equal(x, y), SEED)
                if nx >= min(len(x), len(y)):
                    unseen = max(0, UNSEEN - (nx - SEED))
            else:
                nx, ny = b[j] - b[i], a[j] - a[i]
                agree = passages.agreeing(tuple(x[:nx]), tuple(y[:ny]))
                seen = max(nx, ny) - max(0, min(nx - len(x), ny - len(y)))
            steps.append((agree, seen))
            sizes.append((nx, ny))
        for low, high in passages.stretches(steps):
            i, j, (_, x), (_, y) = chain[low], chain[high - 1], *rows[chain[low]][2:]
            known = x is not None and y is not None
            more = _equal(x[::-1], y[::-1]) if known else 0
            found = (b[i] - more, b[j] + sizes[high - 1][0], a[i] - more, a[j] + sizes[high - 1][1], sum(s[0] for s in steps[low:high]) + more)
            if min(found[1] - found[0], found[3] - found[2]) >= LEAST - UNSEEN * (not known) - unseen * (high == len(chain)):
                out.append(found)
    return out


def _matches(r):
    """Two documents of few or many words of which the second has edits, and their matches."""
    x = [r.randrange(r.choice([3, 10**6])) for _ in range(r.randrange(20, 500))]
    y, rate = [], r.choice([0, 0, 0.02, 0.1, 0.3])
    for w in x:
        y += [r.randrange(10**6)] * r.choice([0, 1, 2]) if r.random() < rate else [w]
    if r.random() < 0.3:
        y[len(y) // 2 : len(y) // 2] = [r.randrange(10**6) for _ in range(r.randrange(150))]
    same = [(i, j) for i in range(len(x) - SEED) for j in range(max(0, i - 160), min(len(y) - SEED, i + 160)) if x[i : i + SEED] == y[j : j + SEED]]
    rows, at = [], sorted(r.sample(same, min(len(same), r.randrange(1, 60))))
    for i, j in at:
        tails = []
        for words, k in ((x, i), (y, j)):
            tails.append((words[k : k + r.choice([6, 17, 32])], words[max(0, k - UNSEEN) : k] if r.random() < 0.5 else None))
        rows.append((i, j, *tails))
    return rows


def test_many_pairs_are_aligned_as_one_by_one():
    r = random.Random(11)
    held = [_matches(r) for _ in range(300)]
    pack = lambda t: passages.pack(np.array(t[0]), None if t[1] is None else np.array(t[1], "<u4"))
    flat = [(k, *x[:2], pack(x[2]), pack(x[3])) for k, rows in enumerate(held) for x in rows]
    flat += r.sample(flat, 500)
    r.shuffle(flat)
    pair, b, a, x, y = zip(*flat, strict=True)
    got = passages.aligned(*(np.array(c, np.int64) for c in (pair, b, a)), pa.array(x, pa.binary()), pa.array(y, pa.binary()))
    want = [(k, *f) for k, rows in enumerate(held) if rows for f in _one_pair(rows)]
    assert len(want) > 200 and sorted(zip(*(c.tolist() for c in got), strict=True)) == sorted(want)
    assert AGREE == 0.7


def test_verbatim_copies_ask_no_tree_and_no_alignment(monkeypatch):
    words = np.arange(1000, dtype="<u4")
    rows = [(k, k + 7, *[passages.pack(words[k : k + 10], words[k - UNSEEN : k])] * 2) for k in range(100, 300, 10)]
    for name in ("chains", "agreeing", "stretches"):
        monkeypatch.setattr(passages, name, lambda *_: pytest.fail("done one by one"))
    assert passages._passages(rows) == [(100 - UNSEEN, 300, 107 - UNSEEN, 307, 200 + UNSEEN)]


def test_seeds_of_many_documents_at_once():
    r = np.random.default_rng(3)
    docs = [r.integers(0, most, n).astype(np.uint64) for n in (12, 13, 35, 200, 1000) for most in (1, 2, 5, 1 << 60)]
    every, first, n = [], [], 0
    for d in docs:
        first.append(n)
        every += [d, r.integers(0, 3, SEED - 1).astype(np.uint64)]  # what lies between two documents belongs to none
        n += len(d) + SEED - 1
    first = np.array(first)
    got = passages.minimizers(np.concatenate(every), first, first + [len(d) for d in docs])
    want = []
    for low, d in zip(first.tolist(), docs, strict=True):
        at = sorted({s + WINDOW - 1 - int(d[s : s + WINDOW][::-1].argmin()) for s in range(len(d) - WINDOW + 1)})
        assert passages.minimizers(d).tolist() == [p - low for p in got[(got >= low) & (got < low + len(d))].tolist()]
        run = 0
        for k, p in enumerate(at):
            run = run + 1 if k and p == at[k - 1] + 1 and d[p] == d[at[k - 1]] else 0
            want += [low + p] * (run % WINDOW == 0)
    assert got.tolist() == want


def test_groups_stay_whole_over_batches():
    r = random.Random(4)
    for ids in (sorted(r.randrange(9) for _ in range(60)), sorted(f"d{r.randrange(30)}" for _ in range(60)), [[1], [1], [2], [3], [3]]):
        for n in (1, 2, 7, 100):
            batches = [pa.record_batch([pa.array(ids[k : k + n]), pa.array(list(range(k, min(k + n, len(ids)))))], ["_id", "n"]) for k in range(0, len(ids), n)]
            rows, groups = [], []
            for (key, at), group in passages._grouped(iter(batches), 1):
                rows += at.to_pylist()
                groups += [{str(k) for k, g in zip(key.to_pylist(), group, strict=True) if g == x} for x in range(group[-1] + 1)]
            assert rows == list(range(len(ids)))
            assert all(len(g) == 1 for g in groups) and len(groups) == len({str(i) for i in ids})
