"""Passages that repeat across documents, exact or fuzzy, by collinear chaining of shared seeds.

Seeds are hashes of ``SEED`` consecutive words. Of each ``WINDOW`` neighbouring seeds the smallest is kept (minimizers),
so documents that share SEED + WINDOW - 1 words in a row share a seed there. A kept seed carries the hashes of the
words up to the next one that other documents may have, CARRIED at most; the first of a stretch also those before it. Seeds that occur in several documents are joined to one anchor per seed, the place in a document with
the longest stretch of shared seeds around it (of equal ones that with the smallest hash), so the seeds of a passage tend to choose the
same anchor, and a passage that very many documents share makes as many matches as it has copies and no pairs among them.
What no passage covers then is joined again by two seeds in reach of each other, which documents with a chain share, and
what is still left to the next anchor of these two, until a round finds no passage.

The matches of a pair of documents are chained: ordered in both, best total of matched words less gap costs. Runs of
matches on one diagonal count as one; their ends lie in a Fenwick tree over the anchor's positions, which is asked for the
maximum over the positions within reach, and from which ends go that are out of reach in the other document. Chains are
then aligned word by word between their matches, and kept if enough words agree.

A passage is reported for each document but the anchor as a span with its partner's span, and once for the anchor too,
with the first partner.

Defined results: null, empty and short texts have no passage; repeats inside one document do not count; rows that repeat
an identifier are one document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import dropped, mix, slices, stored, text_buffers, windows, word_hashes, word_spans
from .jaccard_join import _filter, _passes

#: Words of a seed, and seeds of which one is kept.
SEED, WINDOW = 6, 12
#: Words carried from a seed on, at most.
CARRIED = 32
#: Words a passage has at least, and the share of them that must agree.
LEAST, AGREE = 40, 0.7
#: Words that a verbatim stretch may have before its first and behind its last shared seed, at most.
UNSEEN = WINDOW - 1
#: Places of an anchor that a key may have.
PLACES = 4
#: Cost of a word of gap, and words a gap may have at most within a chain.
GAP, FURTHEST = 0.25, 64


class Fenwick:
    """Maxima over ranges of places; a place may be set again, to less too."""

    def __init__(self, n: int):
        self.own = [(float("-inf"), -1)] * (n + 1)
        self.tree = [(float("-inf"), -1)] * (n + 1)

    def set(self, place: int, value: tuple[float, int]) -> None:
        i = place + 1
        self.own[i] = value
        while i < len(self.tree):
            best, step = self.own[i], 1
            while step < i & -i:  # the trees below i
                best = max(best, self.tree[i - step])
                step <<= 1
            self.tree[i] = best
            i += i & -i

    def best(self, low: int, high: int) -> tuple[float, int]:
        """Over the places low <= place < high."""
        out, i = (float("-inf"), -1), high
        while i > low:
            below = i - (i & -i)
            if below >= low:
                out, i = max(out, self.tree[i]), below
            else:
                out, i = max(out, self.own[i]), i - 1
        return out


def chains(a: list[int], b: list[int], seed: int = SEED, ends: tuple[list[int], list[int]] | None = None, worth: list[float] | None = None) -> list[list[int]]:
    """Chains of the matches (a[i], b[i]), as lists of match numbers in order; ``ends``: the last seeds of runs of matches,
    ``worth``: the words that a run covers.

    The value of a chain is the words its matches cover less GAP for each word between them, counted in both documents;
    the cost splits into a part of each end, so one maximum finds the best match before. Only predecessors within FURTHEST
    words in both documents are asked for; without one a match starts a new chain.
    """
    ea, eb = ends or (a, b)
    slots = sorted(range(len(a)), key=lambda i: (ea[i], i))
    places, slot = [ea[i] for i in slots], {i: k for k, i in enumerate(slots)}
    tree = Fenwick(len(a))
    value, before = [float(seed)] * len(a) if worth is None else list(worth), [-1] * len(a)
    waiting: list[tuple[int, int]] = []
    held: list[tuple[int, int]] = []
    for i in sorted(range(len(a)), key=lambda i: (b[i], a[i])):
        while waiting and waiting[0][0] < b[i]:
            _, j = heappop(waiting)
            tree.set(slot[j], (value[j] + GAP * (ea[j] + eb[j]), j))
            heappush(held, (eb[j], j))
        while held and b[i] - held[0][0] > FURTHEST:
            tree.set(slot[heappop(held)[1]], (float("-inf"), -1))
        found, j = tree.best(bisect_left(places, a[i] - FURTHEST), bisect_left(places, a[i]))
        if j >= 0:
            new = min(seed, a[i] - ea[j], b[i] - eb[j])
            linked = found - GAP * (a[i] + b[i]) + 2 * GAP * new + value[i] - seed + new
            if linked > value[i]:
                value[i], before[i] = linked, j
        heappush(waiting, (eb[i], i))
    out, used = [], [False] * len(a)
    for i in sorted(range(len(a)), key=lambda i: -value[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def chained_runs(a: list[int], b: list[int], seed: int = SEED) -> list[list[int]]:
    """Chains of matches in order of (b, a), whose runs on one diagonal are put together first."""
    x, y = np.array(a), np.array(b)
    cut = np.flatnonzero((np.diff(x - y) != 0) | (np.diff(y) > FURTHEST)) + 1
    low, high = np.concatenate([[0], cut]), np.append(cut, len(a)) - 1
    new = np.minimum(np.diff(y, prepend=y[:1] - seed), seed)
    # Words between the seeds of a run cost as those between runs do.
    step = new - 2 * GAP * np.maximum(np.diff(y, prepend=y[:1]) - seed, 0)
    sums = np.concatenate([[0], np.cumsum(step)])
    worth = seed + sums[high + 1] - sums[low + 1]
    found = chains(x[low].tolist(), y[low].tolist(), seed, (x[high].tolist(), y[high].tolist()), worth.tolist())
    return [[i for run in chain for i in range(low[run], high[run] + 1)] for chain in found]


def agreeing(x: tuple[int, ...], y: tuple[int, ...]) -> int:
    """Words of the longest common subsequence of two short stretches."""
    if x == y:
        return len(x)
    head = 0
    while head < len(x) and head < len(y) and x[head] == y[head]:
        head += 1
    x, y = x[head:], y[head:]
    row = [0] * (len(y) + 1)
    for u in x:
        last = 0
        for k, v in enumerate(y):
            kept = row[k + 1]
            row[k + 1] = last + 1 if u == v else max(kept, row[k])
            last = kept
    return head + row[-1]


def minimizers(hashes: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
    """Positions of the kept seeds: the last smallest of each window, and of a run of equal seeds in a row each WINDOW-th.
    ``first`` and ``last``: where the stretches of hashes of each document begin and end, if there are several; they have
    WINDOW hashes or more and lie apart."""
    if first is None:
        if len(hashes) <= WINDOW:
            return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())]) if len(hashes) else np.zeros(0, np.int64)
        first, last = np.array([0]), np.array([len(hashes)])
    if not len(first):
        return np.zeros(0, np.int64)
    least, width = hashes, 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    # The smallest moves where it is another value, or where the hash that comes in equals it.
    moves = np.ones(len(least), bool)
    moves[1:] = (least[1:] != least[:-1]) | (hashes[WINDOW:] == least[1:])
    moves[first] = True
    inside = np.zeros(len(hashes) + 1, np.int8)
    inside[first] += 1
    inside[last - WINDOW + 1] -= 1
    begin = np.flatnonzero(moves & (np.cumsum(inside)[: len(least)] > 0))
    at = begin + WINDOW - 1 - hashes[begin[:, None] + np.arange(WINDOW - 1, -1, -1)].argmin(axis=1)
    at = at[np.append(True, at[1:] != at[:-1])]
    same = np.zeros(len(at), bool)
    same[1:] = (np.diff(at) == 1) & (hashes[at[1:]] == hashes[at[:-1]])
    head = np.flatnonzero(~same)
    return at[(np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))) % WINDOW == 0]


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    differ = np.ones(len(columns[0]), bool)
    differ[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(differ)


def counted(head: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows how many of its group, which begin at ``head``, came before."""
    return np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))


def occurrence(values: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """For each value how often its owner had it before."""
    owner = np.zeros(len(values), np.int64) if owner is None else owner
    order = np.lexsort((values, owner))
    out = np.empty(len(values), np.int64)
    out[order] = counted(heads(values[order], owner[order]), len(values))
    return out


def leading(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """The weights of rows: of a document's (``owner``) equal keys the PLACES of greatest weight have the greatest, so they are
    anchors side by side; the others cannot be one and have -1 - weight. A key makes at most PLACES matches for each of its
    rows."""
    owner = np.zeros(len(keys), np.int64) if owner is None else owner
    order = np.lexsort((-weights, keys, owner))
    held = weights[order]
    head = heads(keys[order], owner[order])
    out = np.empty(len(keys), np.int64)
    out[order] = np.where(counted(head, len(keys)) < PLACES, np.repeat(held[head], np.diff(np.append(head, len(keys)))), -1 - held)
    return out


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] to starts[i] + sizes[i] for each i in turn."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def packed(words: np.ndarray, start: np.ndarray, n: np.ndarray, before: np.ndarray) -> pa.Array:
    """``pack`` of n[i] words from start[i] on and of before[i] words in front of it (-1: not known), for each i."""
    sizes = 1 + n + np.maximum(before, 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(offsets[-1]), "<u4")
    out[offsets[:-1]] = n << 1 | (before >= 0)
    out[spread(offsets[:-1] + 1, n)] = words[spread(start, n)]
    known = np.maximum(before, 0)
    out[spread(offsets[:-1] + 1 + n, known)] = words[spread(start - known, known)]
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(out)])


def pack(behind: np.ndarray, before: np.ndarray | None) -> bytes:
    """The words from a seed on, and those before it if they are known: a number tells how many and whether."""
    head = np.array([len(behind) << 1 | (before is not None)], "<u4").tobytes()
    return head + behind.astype("<u4").tobytes() + (b"" if before is None else before.astype("<u4").tobytes())


def carried(tails: pa.Array) -> tuple[np.ndarray, ...]:
    """Of packed tails all words, and for each tail where the words from the seed on begin, how many they are, where those
    before it end, and how many they are (-1: not known)."""
    tails = tails.cast(pa.binary())
    _, offsets, data = tails.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(tails) + 1, 4 * tails.offset).astype(np.int64)
    words = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view("<u4")
    begin, end = (offsets[:-1] - offsets[0]) // 4, (offsets[1:] - offsets[0]) // 4
    told = words[begin].astype(np.int64)
    n = told >> 1
    return words, begin + 1, n, end, np.where(told & 1, end - begin - 1 - n, -1)


def alike(x: np.ndarray, x_at: np.ndarray, y: np.ndarray, y_at: np.ndarray, n: np.ndarray, step: int = 1) -> np.ndarray:
    """Of the n[i] words from x_at[i] and y_at[i] on (step -1: backwards), how many are equal before the first that differs."""
    row, k = np.repeat(np.arange(len(n)), n), spread(np.zeros(len(n), np.int64), n)
    differ = np.flatnonzero(x[x_at[row] + step * k] != y[y_at[row] + step * k])
    out = n.copy()
    if len(differ):
        differ = differ[heads(row[differ])]
        out[row[differ]] = k[differ]
    return out


def _seeds(docs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """seed, _id, pos, tail (hashes of the words from here to the next seed, 4 bytes each), weight; seed and _id only, as long
    as no ``wanted`` seeds are known. The n-th of equal seeds of a document is a seed of its own (an odd number), so repeats
    meet in order; it is held as the first one (an even number) too, so a repeat meets what another document has once.
    Seeds that a bit filter of ``wanted`` rules out stay away.
    The weight is the words of the stretch of such seeds around a seed, so the seeds of one passage have one weight."""
    shared, bits = None, 0
    if wanted is not None:
        filtered, bits = _filter(wanted.select(F.col("seed").alias("_h")))
        shared = docs.sparkSession.sparkContext.broadcast(filtered)
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                data, offsets = text_buffers(batch.column(1))
                starts, ends, first = word_spans(data, offsets)
                hashes = word_hashes(data, starts, ends)
                every = windows(hashes, SEED)
                long = np.flatnonzero(np.diff(first) >= LEAST)
                low, high = first[:-1][long], first[1:][long]
                at = minimizers(every, low, high - SEED + 1)
                if not len(at):
                    continue
                own, owner = every[at], np.searchsorted(low, at, "right") - 1
                before = occurrence(own, owner)
                again = np.flatnonzero(before)
                once = mix(own) & ~np.uint64(1)
                own = np.where(before > 0, mix(own + before.astype(np.uint64)) | np.uint64(1), once)
                if len(again):
                    own, at, owner = np.concatenate([own, once[again]]), np.concatenate([at, at[again]]), np.concatenate([owner, owner[again]])
                    order = np.argsort(at, kind="stable")
                    own, at, owner = own[order], at[order], owner[order]
                if shared is None:
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), batch.column(0).take(pa.array(long[owner]))], ["seed", "_id"])
                    continue
                passed = _passes(pa.array(own.view(np.int64)), shared.value, bits)
                own, at, owner = own[passed], at[passed], owner[passed]
                if not len(at):
                    continue
                places = heads(at)
                back, at, owner = np.repeat(np.arange(len(places)), np.diff(np.append(places, len(at)))), at[places], owner[places]
                other = np.append(True, owner[1:] != owner[:-1])
                step = np.diff(at, prepend=0)
                begin = np.flatnonzero(other | (step > FURTHEST))
                size, stop = np.diff(np.append(begin, len(at))), np.append(begin[1:], len(at)) - 1
                weight, last = np.repeat(at[stop] - at[begin], size), np.zeros(len(at), bool)
                last[stop] = True
                leads = other | (step >= WINDOW)
                after = np.where(np.append(other[1:], True), high[owner], np.append(at[1:], 0))
                n = np.minimum(after - at, np.where(last, SEED + UNSEEN, CARRIED))
                known = np.where(leads, np.minimum(at - low[owner], UNSEEN), -1)
                # A seed without another in reach is in no chain.
                keep = np.flatnonzero(weight > 0)
                if not len(keep):
                    continue
                tails = packed((hashes >> np.uint64(32)).astype("<u4"), at[keep], n[keep], known[keep])
                rows = weight[back] > 0
                own, back = own[rows], back[rows]
                place, weight, owner = (at - low[owner])[back], weight[back], owner[back]
                weight = leading(own.view(np.int64), weight, owner)
                columns = [pa.array(own.view(np.int64)), batch.column(0).take(pa.array(long[owner])), pa.array(place.astype(np.int32)), tails.take(pa.array(np.searchsorted(keep, back))), pa.array(weight.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["seed", "_id", "pos", "tail", "weight"])

    return docs.mapInArrow(run, f"seed long, _id {kind}" + ("" if wanted is None else ", pos int, tail binary, weight int"))


def stretches(steps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of steps (words that agree, words) in which agreement stays high: each a stretch of best sum of
    agree - AGREE * words, the rest left and right of it searched again."""
    out, todo = [], [(0, len(steps))]
    while todo:
        low, high = todo.pop()
        best, found, total, begin = 0.0, None, 0.0, low
        for i in range(low, high):
            if total <= 0:
                total, begin = 0.0, i
            total += steps[i][0] - AGREE * steps[i][1]
            if total > best:
                best, found = total, (begin, i + 1)
        if found:
            out.append(found)
            todo += [(low, found[0]), (found[1], high)]
    return out


def aligned(pair: np.ndarray, b: np.ndarray, a: np.ndarray, tails: pa.Array, partner_tails: pa.Array) -> tuple[np.ndarray, ...]:
    """pair, start, end, partner's start, end, words that agree: the passages from matches (pair, pos, partner's pos, tails).
    What a pair's matches cost is done for all pairs at once; only chains over several diagonals, stretches in which words
    differ and chains that may part are looked at one by one."""
    order = np.lexsort((a, b, pair))
    order = order[heads(pair[order], b[order], a[order])]
    begin = heads(pair[order])
    order = order[np.repeat(np.diff(np.append(begin, len(order))) > 1, np.diff(np.append(begin, len(order))))]
    pair, b, a = pair[order], b[order], a[order]
    if not len(pair):
        return (pair,) * 6
    x, x_at, x_n, x_end, x_before = carried(tails.take(pa.array(order)))
    y, y_at, y_n, y_end, y_before = carried(partner_tails.take(pa.array(order)))
    same = alike(x, x_at, y, y_at, np.minimum(x_n, y_n))

    # Matches on one diagonal are chained as they follow each other; other pairs ask the tree.
    begin = heads(pair)
    stop = np.append(begin[1:], len(pair))
    straight = np.minimum.reduceat(b - a, begin) == np.maximum.reduceat(b - a, begin)
    rows = spread(begin[straight], (stop - begin)[straight])
    head = np.flatnonzero(np.append(True, (np.diff(pair[rows]) != 0) | (np.diff(b[rows]) > FURTHEST))) if len(rows) else rows
    sizes = np.diff(np.append(head, len(rows)))
    rows, sizes = [rows[np.repeat(sizes > 1, sizes)]], [sizes[sizes > 1]]
    for i, j in zip(begin[~straight].tolist(), stop[~straight].tolist(), strict=True):
        found = [c for c in chained_runs(a[i:j], b[i:j]) if len(c) > 1]
        rows += [i + np.array(c) for c in found]
        sizes.append(np.array([len(c) for c in found], np.int64))
    rows, sizes = np.concatenate(rows), np.concatenate(sizes)
    if not len(rows):
        return (rows,) * 6
    end = np.cumsum(sizes) - 1
    first = end - sizes + 1
    last = np.zeros(len(rows), bool)
    last[end] = True

    # Behind the last match: as far as words stay equal; the seed's own words are equal.
    same, x_n, y_n = same[rows], x_n[rows], y_n[rows]
    far = np.maximum(same, SEED)
    nx, ny = (np.where(last, far, np.append(c[rows][1:] - c[rows][:-1], 0)) for c in (b, a))
    cx, cy = np.minimum(x_n, nx), np.minimum(y_n, ny)
    agree = np.where(last, far, cx)
    for k in np.flatnonzero(~last & ((cx != cy) | (same < cx))).tolist():
        u, v, h = int(x_at[rows[k]]), int(y_at[rows[k]]), int(min(same[k], cx[k], cy[k]))
        agree[k] = h + agreeing(tuple(x[u + h : u + cx[k]].tolist()), tuple(y[v + h : v + cy[k]].tolist()))
    # Words behind a seed that only one side kept are not carried: they count for neither side.
    seen = np.where(last, far, np.maximum(nx, ny) - np.maximum(0, np.minimum(nx - x_n, ny - y_n)))
    # All that is carried is equal: there may be more.
    unseen = np.where(far >= np.minimum(x_n, y_n), np.maximum(0, UNSEEN - (far - SEED)), 0)

    whole = np.logical_and.reduceat(agree - AGREE * seen > 0, first)
    low, high = [first[whole]], [end[whole]]
    for i, j in zip(first[~whole].tolist(), end[~whole].tolist(), strict=True):
        parts = stretches(list(zip(agree[i : j + 1].tolist(), seen[i : j + 1].tolist(), strict=True)))
        low.append(i + np.array([p[0] for p in parts], np.int64))
        high.append(i + np.array([p[1] - 1 for p in parts], np.int64))
    low, high = np.concatenate(low), np.concatenate(high)
    sums = np.concatenate([[0], np.cumsum(agree)])
    i, j = rows[low], rows[high]
    known = (x_before[i] >= 0) & (y_before[i] >= 0)
    more = alike(x, x_end[i] - 1, y, y_end[i] - 1, np.where(known, np.minimum(x_before[i], y_before[i]), 0), -1)
    out = (pair[i], b[i] - more, b[j] + nx[high], a[i] - more, a[j] + ny[high], sums[high + 1] - sums[low] + more)
    least = LEAST - np.where(known, 0, UNSEEN) - np.where(last[high], unseen[high], 0)
    long = np.minimum(out[2] - out[1], out[4] - out[3]) >= least
    return tuple(c[long] for c in out)


def _passages(rows: list[tuple[int, int, bytes, bytes]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, partner's start, end, words that agree) from one pair's matches (pos, partner's pos, tails)."""
    b, a, x, y = zip(*rows, strict=True)
    found = aligned(np.zeros(len(b), np.int64), np.array(b, np.int64), np.array(a, np.int64), pa.array(x, pa.binary()), pa.array(y, pa.binary()))
    return list(zip(*(c.tolist() for c in found[1:]), strict=True))


def _differs(column: pa.Array) -> np.ndarray:
    """For each value but the first whether it is another than the one before."""
    try:
        return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    except pa.ArrowNotImplementedError:
        values = column.to_pylist()
        return np.array([u != v for u, v in zip(values[1:], values, strict=False)], bool)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[pa.Array], np.ndarray]]:
    """Columns of rows in which all of a group (equal in the first ``keys`` columns) come together, and each row's group."""
    held: list[pa.RecordBatch] = []

    def put() -> tuple[list[pa.Array], np.ndarray]:
        columns = [pa.concat_arrays(c) for c in zip(*(b.columns for b in held), strict=True)]
        return columns, np.concatenate([[0], np.cumsum(np.logical_or.reduce([_differs(c) for c in columns[:keys]]))])

    for batch in batches:
        if not len(batch):
            continue
        cuts = np.flatnonzero(np.logical_or.reduce([_differs(batch.column(k)) for k in range(keys)])) + 1
        if len(cuts):
            held.append(batch.slice(0, cuts[0]))
            if len(held) > 1 and any(held[-1].column(k)[0].as_py() != held[-2].column(k)[0].as_py() for k in range(keys)):
                last = held.pop()
                yield put()
                held = [last]
            held.append(batch.slice(cuts[0], cuts[-1] - cuts[0]))
            yield put()
            held = [batch.slice(cuts[-1])]
        else:
            if held and any(batch.column(k)[0].as_py() != held[-1].column(k)[0].as_py() for k in range(keys)):
                yield put()
                held = []
            held.append(batch)
    if held:
        yield put()


def _integers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


#: A row's document and place as one number, and rows that are made at once.
FAR, AT_ONCE = 1 << 32, 1 << 16


def _paired(doc: np.ndarray, pos: np.ndarray, seed: np.ndarray, weight: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two seeds in reach of each other, of which one at least is in no passage yet, as one key: documents that share a
    chain share such a key. First and second row, key and weight of each."""
    place = doc * FAR + pos
    numbered = np.isin(place, place[seed & 1 == 1])  # places of repeats: there the two numbers of a seed pair with their like
    one, two, i, step = [], [], np.arange(len(doc)), 0
    while True:
        step += 1
        i = i[i + step < len(doc)]
        i = i[place[i + step] - place[i] <= FURTHEST]
        if not len(i):
            break
        j = i + step
        mixed = ((seed[i] ^ seed[j]) & 1 == 1) & numbered[np.where(seed[i] & 1 == 1, j, i)]
        good = (pos[j] > pos[i]) & (fresh[i] | fresh[j]) & ~mixed
        one.append(i[good])
        two.append(j[good])
    if not one:
        return (np.zeros(0, np.int64),) * 4
    i, j = np.concatenate(one), np.concatenate(two)
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    key = mix(mix(seed[i].view(np.uint64)) + seed[j].view(np.uint64)).view(np.int64)
    return i, j, key, _led(doc[i], key, weight[i])


def _led(doc: np.ndarray, key: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights as of ``leading``, whatever they were before."""
    return leading(key, np.where(weight < 0, -1 - weight, weight), doc)


def _by_document(rows: DataFrame, pairs: bool, spans: DataFrame) -> DataFrame:
    """Of each document the keys that its spans, joined where they meet, leave: those of which one seed at least is in no
    passage yet. ``pairs``: the rows are single seeds, of which keys of two are made."""
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "seed", "pos", "tail", "pos2", "tail2", "weight"]
    none = [F.lit(None).cast(t).alias(n) for n, t in (("seed", "long"), ("tail", "binary"), ("tail2", "binary"), ("weight", "int"))]
    rows = rows.select("_id", "pos", "seed", "tail", "pos2", "tail2", "weight").unionByName(spans.select("_id", "pos", F.col("stop").alias("pos2"), *none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, pos, seed, tail, pos2, tail2, weight), doc in _grouped(batches, 1):
            span = seed.is_null().to_numpy(zero_copy_only=False)
            start, stop = _integers(pos), _integers(pos2)
            begins, reach = (doc * FAR + start)[span], np.maximum.accumulate((doc * FAR + stop)[span])

            def covered(d: np.ndarray, p: np.ndarray) -> np.ndarray:
                if not len(begins):
                    return np.zeros(len(d), bool)
                k = np.searchsorted(begins, d * FAR + p, "right") - 1
                return (k >= 0) & (reach[k] > d * FAR + p)

            at = np.flatnonzero(~span)
            d, key, w = doc[at], _integers(seed)[at], _integers(weight)[at]
            out = ~covered(d, start[at])
            if pairs:
                i, j, key, w = _paired(d, start[at], key, w, out)
                i, j = at[i], at[j]
                second, second_tail = start[j], tail
            else:
                out |= ~covered(d, stop[at])
                i, key, w = at[out], key[out], _led(d[out], key[out], w[out])
                j, second, second_tail = i, stop[i], tail2
            for low in range(0, len(i), AT_ONCE):
                k = slice(low, low + AT_ONCE)
                one, two = pa.array(i[k]), pa.array(j[k])
                columns = [ids.take(one), pa.array(key[k]), pos.take(one), tail.take(one), pa.array(second[k].astype(np.int32)), second_tail.take(two), pa.array(w[k].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names)

    dealt = rows.repartition("_id").sortWithinPartitions("_id", "pos", "pos2")
    return dealt.mapInArrow(run, f"_id {kind}, seed long, pos int, tail binary, pos2 int, tail2 binary, weight int")


def _chained(matches: DataFrame, id_col: str) -> DataFrame:
    """Passages of all pairs in ``matches``, for both documents (``own``: the anchor's)."""
    kind = matches.schema["_id"].dataType.simpleString()
    names = [id_col, "start_word", "end_word", "partner_id", "partner_start", "partner_end", "agreeing_words", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, anchors, pos, apos, tail, atail, pos2, apos2, tail2, atail2), pair in _grouped(batches, 2):
            two = np.flatnonzero(pos2.is_valid().to_numpy(zero_copy_only=False))
            begin, b, a = heads(pair), _integers(pos), _integers(apos)
            if len(two):
                at = pa.array(two)
                pair, b, a = (np.concatenate([u, v[two]]) for u, v in ((pair, pair), (b, _integers(pos2)), (a, _integers(apos2))))
                tail, atail = pa.concat_arrays([tail, tail2.take(at)]), pa.concat_arrays([atail, atail2.take(at)])
            found, *spans = aligned(pair, b, a, tail, atail)
            if not len(found):
                continue
            row, (s, e, ps, pe, n) = pa.array(begin[found]), (pa.array(c.astype(np.int32)) for c in spans)
            mine, other = ids.take(row), anchors.take(row)
            yield pa.RecordBatch.from_arrays([mine, s, e, other, ps, pe, n, pa.array(np.zeros(len(n), bool))], names)
            yield pa.RecordBatch.from_arrays([other, ps, pe, mine, s, e, n, pa.array(np.ones(len(n), bool))], names)

    dealt = matches.repartition("_id", "anchor").sortWithinPartitions("_id", "anchor", "pos")
    return dealt.mapInArrow(run, f"`{id_col}` {kind}, start_word int, end_word int, partner_id {kind}, partner_start int, partner_end int, agreeing_words int, own boolean")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows id, start_word, end_word, partner_id, partner_start, partner_end, agreeing_words of passages with about
    LEAST words or more."""
    docs = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).filter(F.col("_id").isNotNull())
    seeds = _seeds(docs)  # made twice: kept or shuffled whole a second time, they would outweigh the texts
    shared = seeds.groupBy("seed").agg(F.min("_id").alias("low"), F.max("_id").alias("high")).filter("low <> high").select("seed")
    shared, place = stored(shared)
    none = F.lit(None).cast("binary")
    rows, of_rows = stored(_seeds(docs, shared).join(shared, "seed").withColumns({"pos2": F.col("pos"), "tail2": none}))
    dropped(docs.sparkSession, place)
    rounds = []
    while True:
        # Anchors are told by one number, so that they are found without moving the words along: longer stretches first,
        # then a hash of the identifier. Documents that agree in both are anchors side by side.
        rank = F.shiftleft(65535 - F.greatest(F.least(F.col("weight"), F.lit(65535)), F.lit(-1)).cast("long"), 46).bitwiseOR(F.xxhash64("_id").bitwiseAND(F.lit((1 << 46) - 1)))
        ranked = rows.withColumn("rank", rank)
        anchors = ranked.groupBy("seed").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1")
        led = ranked.join(anchors, "seed")
        lead = led.filter(F.col("rank") == F.col("first")).select("seed", F.struct("_id", "pos", "tail", "pos2", "tail2").alias("a"), "n")
        met = ranked.join(lead, "seed").filter(F.col("_id") != F.col("a._id"))
        second = [F.when(F.col("tail2").isNotNull(), F.col(c)).alias(n) for c, n in (("pos2", "pos2"), ("a.pos2", "apos2"))]
        matches = met.select("_id", F.col("a._id").alias("anchor"), "pos", F.col("a.pos").alias("apos"), "tail", F.col("a.tail").alias("atail"), *second, "tail2", F.col("a.tail2").alias("atail2"))
        found, of_found = stored(_chained(matches, id_col))
        rounds.append(of_found)
        if len(rounds) > 1 and found.isEmpty():
            break
        spans = found.select(F.col(id_col).alias("_id"), F.col("start_word").alias("pos"), F.col("end_word").alias("stop")).distinct()
        # The first round leaves keys of two seeds; of those, an anchor has met all that hold its keys and goes.
        left = rows if len(rounds) == 1 else ranked.join(anchors.filter("n > 2"), "seed").filter(F.col("rank") != F.col("first"))
        rows, next_ = stored(_by_document(left, len(rounds) == 1, spans))
        dropped(docs.sparkSession, of_rows)
        of_rows = next_
    dropped(docs.sparkSession, of_rows)
    chained = docs.sparkSession.read.schema(found.schema).parquet(*rounds)
    # An anchor's span is the same for all its partners: it stays once.
    names = ["partner_id", "partner_start", "partner_end", "agreeing_words"]
    own = chained.filter("own").groupBy(id_col, "start_word", "end_word").agg(F.min(F.struct(*names)).alias("p")).select(id_col, "start_word", "end_word", "p.*")
    return chained.filter("NOT own").drop("own").unionByName(own)
