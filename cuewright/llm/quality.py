"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own shape and its neighbours' (shares of kinds of characters, repeated words
and lines, lengths). Forward-backward gives each line's probability of being good; their mean, weighted by length, and
that of the worst stretch go through a logistic curve to the document's score. Only a document's label is known, so
lines start with it; lines of bad documents that look good are then relabelled, and the field is fitted to the result.

The model is fitted on a bounded sample, ``EACH`` documents of each label at most, and sent to the executors as a few
dozen numbers. Scoring reads every whole text.

Defined results: a null or blank text is one empty line; without labels of both kinds every score is the share of good
labels, or 0.5 without any; rows that repeat an identifier are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mix, slices, text_buffers, word_hashes, word_spans
from ._learn import fold, logistic, sample, shares, sigmoid

#: Documents of each label in the training sample, at most.
EACH = 1500
#: predicted is 1 from this score on.
GOOD = 0.3

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _STOP, _OTHER = range(7)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of each code point below 0x3000; those above count as lower-case letters."""
    out = np.full(0x3000, _LOWER, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        if c.isupper():
            out[i] = _UPPER
        elif c.isspace() or i < 32:
            out[i] = _SPACE
        elif c.isdigit():
            out[i] = _DIGIT
        elif c in ".,;:?'\"-()":
            out[i] = _STOP
        elif not c.isalpha():
            out[i] = _MARK
    return out


#: Bytes of text whose lines are looked at together; longer texts are cut at line breaks, a line never is.
PIECE = 256 << 10
#: Bytes of text that are scored together, about: whole documents.
AT_ONCE = 1 << 20
#: Lines of a document that one run of the chain covers; longer documents are run in stretches, whose ends are carried on.
STRETCH = 512
OWN = 17
FEATURES = 3 * OWN + 1
#: Column of a line's own features that tells whether its document has the line twice.
_TWICE = 11


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Places where documents begin or lines end, about PIECE bytes apart."""
    out = [0]
    while out[-1] < len(data):
        low, high = out[-1], out[-1] + PIECE
        if high >= len(data):
            out.append(len(data))
            break
        first, after = int(np.searchsorted(offsets, low, "right")), int(np.searchsorted(offsets, high, "right"))
        if after > first:  # the last document that begins here begins the next piece
            out.append(int(offsets[after - 1]))
            continue
        breaks = np.flatnonzero(data[low:high] == 10)
        if len(breaks):
            out.append(low + int(breaks[-1]) + 1)
            continue
        end = int(offsets[after]) if after < len(offsets) else len(data)
        while high < end and data[high - 1] != 10:
            more = np.flatnonzero(data[high : min(high + PIECE, end)] == 10)
            high = high + int(more[0]) + 1 if len(more) else min(high + PIECE, end)
        out.append(high)
    return out


def _piece(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
    """Own features, lengths, digests and documents of the lines in data[low:high]."""
    docs = np.arange(np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left"))
    local = np.append(np.maximum(offsets[docs], low), high) - low
    data = data[low:high]
    starts, ends, first = word_spans(data, local)
    if not len(starts):
        return np.zeros((0, OWN), np.float32), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # A word begins a line if it is its document's first, or a line break stands between it and the word before.
    doc = np.searchsorted(first, np.arange(len(starts)), "right") - 1
    breaks = np.flatnonzero(data == 10)
    begins = np.ones(len(starts), bool)
    begins[1:] = (doc[1:] != doc[:-1]) | (np.searchsorted(breaks, starts[1:]) > np.searchsorted(breaks, ends[:-1]))
    at = np.flatnonzero(begins)
    words = np.diff(np.append(at, len(starts))).astype(float)
    begin, end = starts[at], ends[np.append(at[1:], len(starts)) - 1]
    # Kinds of characters, counted over the bytes that start one.
    text = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    kind = np.where(text < 0x3000, kinds()[np.minimum(text, 0x2FFF)], _LOWER)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
    bounds = np.column_stack([leads[begin], leads[end]]).ravel()
    counts = np.column_stack([np.add.reduceat(np.append(kind == k, False), bounds, dtype=np.int32)[::2] for k in range(6)])
    size = np.maximum(leads[end] - leads[begin], 1).astype(float)
    letters = np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1.0)
    hashes = word_hashes(data, starts, ends)
    line = np.cumsum(begins) - 1
    again = np.zeros(len(starts))
    again[1:] = (hashes[1:] == hashes[:-1]) & ~begins[1:]
    order = np.lexsort((hashes, line))
    fresh = np.ones(len(starts))
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    same = np.add.reduceat(again, at)
    distinct = np.add.reduceat(fresh, at)
    digest = mix(np.add.reduceat(mix(hashes + np.arange(len(hashes), dtype=np.uint64) - at[line].astype(np.uint64)), at))
    single = ((ends - starts) == 1).astype(float)
    short = np.add.reduceat(((ends - starts) <= 3).astype(float), at)
    own = np.column_stack([
        counts[:, _UPPER] / letters,
        counts[:, _MARK] / size,
        np.minimum(counts[:, _MARK] / words, 3.0),
        counts[:, _DIGIT] / size,
        counts[:, _STOP] / size,
        same / words,
        1.0 - distinct / words,
        np.log1p(words) / 5.0,
        np.minimum(size / words, 40.0) / 10.0,
        np.add.reduceat(single, at) / words,
        short / words,
        np.zeros(len(at)),
        np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8)).astype(float),
        (words <= 2).astype(float),
        (counts[:, _UPPER] / letters > 0.6).astype(float),
        (counts[:, _MARK] / words > 0.5).astype(float),
        (same / words > 0.3).astype(float),
    ])
    return own.astype(np.float32), size, digest, docs[doc[at]]


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of all lines and whether the document is blank, lines' lengths, and how many lines each document has
    (blank lines are left out, a blank document is one line of its own kind)."""
    data, offsets = text_buffers(texts)
    n_docs = len(offsets) - 1
    cuts = _cuts(data, offsets)
    pieces = [_piece(data, offsets, a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    own = np.concatenate([p[0] for p in pieces] or [np.zeros((0, OWN), np.float32)])
    size, digest, line_doc = (np.concatenate([p[k] for p in pieces] or [np.zeros(0, t)]) for k, t in ((1, float), (2, np.uint64), (3, np.int64)))
    _, back, times = np.unique(mix(digest + line_doc.astype(np.uint64)), return_inverse=True, return_counts=True)
    own[:, _TWICE] = times[back] > 1
    own = np.column_stack([own, np.zeros(len(own), np.float32)])
    per_doc = np.bincount(line_doc, minlength=n_docs)
    if (per_doc == 0).any():
        blank = np.flatnonzero(per_doc == 0)
        row = np.zeros((len(blank), OWN + 1), np.float32)
        row[:, -1] = 1.0
        order = np.argsort(np.concatenate([line_doc, blank]), kind="stable")
        own, size = np.vstack([own, row])[order], np.concatenate([size, np.ones(len(blank))])[order]
        per_doc = np.maximum(per_doc, 1)
    return own, size, per_doc


def with_neighbours(own: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Own features, then the line's before and behind (0 where the document ends), then whether it is blank."""
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    inner = doc[1:] == doc[:-1]
    before, behind = np.zeros((len(own), OWN)), np.zeros((len(own), OWN))
    before[1:][inner] = own[:-1, :OWN][inner]
    behind[:-1][inner] = own[1:, :OWN][inner]
    return np.hstack([own[:, :OWN].astype(float), before, behind, own[:, OWN:]])


@dataclass
class Field:
    """The chain: emission weights for 'good', transition scores between bad (0) and good (1), and the final curve."""

    emit: np.ndarray
    step: np.ndarray
    curve: np.ndarray
    prior: float | None = None  # the score of all documents if no model could be fitted

    def emissions(self, own: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        """Each line's score for 'good', from its own and its neighbours' features."""
        mine, before, behind = (own[:, :OWN] @ self.emit[k * OWN : (k + 1) * OWN] for k in range(3))
        out = mine + own[:, OWN] * self.emit[FEATURES - 1] + self.emit[FEATURES]
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        out[inner + 1] += before[inner]
        out[inner] += behind[inner + 1]
        return out

    def marginals(self, good: np.ndarray, per_doc: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """P(line is good) from the lines' scores, and if asked the expected transitions, by forward-backward."""
        fwd = messages(good, per_doc, self.step)
        turned = messages(good[::-1], per_doc[::-1], self.step.T)[::-1]  # backward, with the line's own score
        both = fwd + turned
        both[:, 1] -= good
        total = np.logaddexp(both[:, 0], both[:, 1])
        out = np.exp(both[:, 1] - total)
        if not pairs:
            return out, np.zeros((2, 2))
        inner = np.ones(len(good), bool)
        inner[np.cumsum(per_doc) - per_doc] = False
        j = np.flatnonzero(inner)
        pair = fwd[j - 1][:, :, None] + self.step[None] + turned[j][:, None, :] - total[j][:, None, None]
        return out, np.exp(pair).sum(axis=0)

    def summary(self, own: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        """Per document: the length-weighted mean of its lines' marginals, and their log-odds' weighted mean."""
        good, _ = self.marginals(self.emissions(own, per_doc), per_doc)
        start = np.cumsum(per_doc) - per_doc
        weight = np.add.reduceat(size, start)
        mean = np.add.reduceat(good * size, start) / weight
        odds = np.log(np.clip(good, 1e-6, 1)) - np.log(np.clip(1 - good, 1e-6, 1))
        worst = 1.0 - np.add.reduceat((good < 0.5) * size, start) / weight
        return np.column_stack([mean, np.add.reduceat(odds * size, start) / weight / 5.0, worst])

    def score(self, own: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(per_doc), self.prior)
        return sigmoid(self.summary(own, size, per_doc) @ self.curve[:-1] + self.curve[-1])


def messages(good: np.ndarray, per_doc: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Forward messages (log space) of all documents at once; the score for 'bad' is 0.

    Documents are run in stretches of at most STRETCH lines, one step a line over all stretches, from each state their
    first line may have; then each document's stretches are tied together, one step a stretch over all documents.
    """
    many = -(-per_doc // STRETCH)
    doc = np.repeat(np.arange(len(per_doc)), many)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    sizes = np.minimum(per_doc[doc] - number * STRETCH, STRETCH)
    start = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    heads, falling = start[order], -sizes[order]
    # From state i at a stretch's first line: out[line, i, state].
    out = np.full((len(good), 2, 2), -np.inf)
    out[start, 0, 0], out[start, 1, 1] = 0.0, good[start]
    for t in range(1, int(sizes.max(initial=0))):
        i = heads[: int(np.searchsorted(falling, -t, "left"))] + t
        out[i] = np.logaddexp(out[i - 1, :, :1] + step[0], out[i - 1, :, 1:] + step[1])
        out[i, :, 1] += good[i, None]
    # What enters a stretch's first line, for each state, without that line's score.
    enters = np.zeros((len(sizes), 2))
    first = np.cumsum(many) - many
    for k in range(1, int(many.max(initial=0))):
        i = first[many > k] + k
        last = out[start[i] - 1] + enters[i - 1][:, :, None]
        last = np.logaddexp(last[:, 0], last[:, 1])
        enters[i] = np.logaddexp(last[:, :1] + step[0], last[:, 1:] + step[1])
    out += np.repeat(enters, sizes, axis=0)[:, :, None]
    return np.logaddexp(out[:, 0], out[:, 1])


def fit(own: np.ndarray, size: np.ndarray, per_doc: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> Field:
    """Fit lines' labels, the chain and the curve. ``share``: how many labels 0 and 1 all usable rows have."""
    owner = np.repeat(np.arange(len(per_doc)), per_doc)
    x = with_neighbours(own, per_doc)
    label = y[owner].astype(float)
    weight = np.sqrt(size)
    for _ in range(4):
        # Both labels weigh the same; in a bad document all but its worst line may turn out good.
        balance = np.where(label > 0, 0.5 / max((weight * label).sum(), 1e-9), 0.5 / max((weight * (1 - label)).sum(), 1e-9)) * len(x)
        emit = logistic(x, label, weight * balance)
        p = sigmoid(x @ emit[:-1] + emit[-1])
        worst = np.full(len(per_doc), 2.0)
        np.minimum.at(worst, owner, p)
        label = np.where(y[owner] == 1, 1.0, ((p > 0.6) & (p > worst[owner])).astype(float))
    field = Field(emit.copy(), np.zeros((2, 2)), np.zeros(4))
    start = np.cumsum(per_doc) - per_doc
    inner = np.ones(len(x), bool)
    inner[start] = False
    j = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[j - 1].astype(int), label[j].astype(int)), 1.0)
    # Gradient ascent of the conditional likelihood, with steps that adapt to each weight (Adam).
    full = np.hstack([x, np.ones((len(x), 1))])
    m = [np.zeros(FEATURES + 1), np.zeros((2, 2))]
    v = [np.zeros(FEATURES + 1), np.zeros((2, 2))]
    for k in range(1, 81):
        good, pairs = field.marginals(full @ field.emit, per_doc, pairs=True)
        grads = [full.T @ (label - good) / len(x) - 1e-4 * field.emit, (seen - pairs) / len(x) - 1e-4 * field.step]
        for i, (g, into) in enumerate(zip(grads, (field.emit, field.step), strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            into += 0.05 * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
    real = np.where(y == 1, share[1] / max((y == 1).sum(), 1), share[0] / max((y == 0).sum(), 1))
    field.curve = logistic(field.summary(own, size, per_doc), y.astype(float), real * len(y) / max(real.sum(), 1e-9), l2=1e-3)
    return field


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", each: int = EACH) -> Field:
    """Fit on the bounded sample; the sample's lines are made on the executors."""
    share = shares(labels, label, id_col, usable)
    if not all(share):
        return Field(np.zeros(FEATURES + 1), np.zeros((2, 2)), np.zeros(4), prior=share[1] / sum(share) if sum(share) else 0.5)
    rows = sample(docs, labels, label, id_col, text_col, usable, each).select("_y", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, AT_ONCE):
                own, size, per_doc = lines(batch.column(1))
                both, cuts = np.column_stack([own, size.astype("<f4")]), np.cumsum(per_doc)[:-1]
                yield pa.RecordBatch.from_pydict({"y": batch.column(0), "lines": pa.array([x.tobytes() for x in np.split(both, cuts)], pa.binary())})

    found = rows.mapInArrow(run, "y int, lines binary").collect()
    if not {r.y for r in found} >= {0, 1}:
        return Field(np.zeros(FEATURES + 1), np.zeros((2, 2)), np.zeros(4), prior=share[1] / sum(share))
    found.sort(key=lambda r: (r.y, bytes(r.lines)))
    parts = [np.frombuffer(r.lines, "<f4").reshape(-1, OWN + 2) for r in found]
    both = np.vstack(parts).astype(float)
    return fit(both[:, :-1], both[:, -1], np.array([len(p) for p in parts]), np.array([r.y for r in found]), share)


def score_quality(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id (and the columns ``keep``), score, predicted of every row."""
    source = docs.select(id_col, text_col, *[c for c in keep if c not in (id_col, text_col)])
    names = [id_col, *[c for c in keep if c != id_col]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, AT_ONCE):
                score = field.score(*lines(batch.column(1)))
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
                yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(score), "predicted": pa.array((score >= GOOD).astype(np.int32))})

    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in names)
    return source.mapInArrow(run, f"{schema}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = EACH) -> DataFrame:
    """id, held_out, score, predicted; labels of rows with crc32(id) mod 5 = 0 are not used."""
    field = train(docs, labels, fold("_id", 5) != 0, "quality", id_col, text_col, each)
    out = score_quality(docs, field, id_col, text_col)
    return out.select(id_col, (fold(id_col, 5) == 0).alias("held_out"), "score", "predicted")


def good_only(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The whole rows whose text is predicted good."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at, AT_ONCE):
                yield batch.filter(pa.array(field.score(*lines(batch.column(at))) >= GOOD))

    return docs.mapInArrow(run, docs.schema)
