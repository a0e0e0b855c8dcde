"""The repair of long screen texts against a plain version in one pass over each event."""

import math

from cuewright.operators import repair
from cuewright.operators.dedupe import key_of, ocr_similarity, similarity

SF = "/root/testdata/sf0.001"


def item_of(event, items):
    best = None
    for i in items:
        if i.stem != event.stem:
            continue
        a, b = key_of(event.text), key_of(i.zh)
        s = max(similarity(a, b), 0.95 if a and b and (a in b or b in a) else 0.0)
        common = min(event.end_cs, i.end_cs) - max(event.start_cs, i.start_cs)
        if abs(event.start_cs - i.start_cs) <= 6 and abs(event.end_cs - i.end_cs) <= 6:
            rank = (1, s)
        elif common > 0 and s >= 0.68:
            rank = (0, s * 10 + common / max(50, min(event.end_cs - event.start_cs, i.end_cs - i.start_cs)))
        else:
            continue
        if best is None or (*rank, -i.seq) > best[0]:
            best = ((*rank, -i.seq), i)
    return best and best[1]


def pieces_of(event, item, found):
    frames = {}
    for d in found:
        near = d.stem == event.stem and d.end_ms >= event.start_cs * 10 - 200 and d.start_ms <= event.end_cs * 10 + 200
        if near and ocr_similarity(item.source, d.text) >= 0.74:
            frames.setdefault(round(d.start_ms / 10), []).append(d)
    chosen, at = [], None
    for _, dets in sorted(frames.items()):
        score = lambda d: ocr_similarity(item.source, d.text) * 3 + d.confidence - (min(math.dist(at, (d.x, d.y)) / 900, 1.5) if at else 0)
        best = max(dets, key=lambda d: (score(d), -d.seq))
        chosen.append(best)
        at = (best.x, best.y)
    chunks, before = [], None
    for d in chosen:
        apart = before is None or d.start_ms - before.end_ms > 2250 or math.dist((before.x, before.y), (d.x, d.y)) > 420
        if apart or d.end_ms - chunks[-1][0].start_ms > 6000:
            chunks.append([])
        chunks[-1].append(d)
        before = d
    out = []
    for c in chunks:
        start, end = min(d.start_ms for d in c), max(d.end_ms for d in c)
        if end - start < 1000:
            continue
        if out and start <= out[-1][1] + 200:
            out[-1][1] = min(max(out[-1][1], end), out[-1][0] + 6000)
        else:
            out.append([start, end, max(c, key=lambda d: (d.confidence, len(key_of(d.text)), -d.start_ms, -d.seq)).seq])
    return out[:8]


def test_repair(spark):
    frames = repair.staged(spark, SF)
    events, items, found = (f.collect() for f in frames)
    want = set()
    for e in events:
        if e.style != "OCR_TRANSLATION" or e.end_cs - e.start_cs <= 800:
            want.add((e.stem, e.seq, 1, e.start_cs, e.end_cs, "kept", None))
            continue
        item = item_of(e, items)
        pieces = pieces_of(e, item, found) if item else []
        for n, (start, end, seq) in enumerate(pieces, 1):
            want.add((e.stem, e.seq, n, start // 10, end // 10, "rebuilt", seq))
        if not pieces:
            want.add((e.stem, e.seq, 1, e.start_cs, min(e.end_cs, e.start_cs + 600), "fallback", None))
    assert {tuple(r) for r in repair.repaired(*frames).collect()} == want
    assert {w[5] for w in want} == {"kept", "rebuilt", "fallback"}
    assert max(w[2] for w in want) > 1
