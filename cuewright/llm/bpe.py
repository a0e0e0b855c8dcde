"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The distinct pre-tokens of a batch lie in one flat array of symbols. Each round looks up all adjacent pairs at once by
binary search over the sorted pair keys of the merges, finds the lowest rank in each word, and merges all places of
that pair in the word, left to right. Words leave the array as soon as none of their pairs has a merge. Long runs without
a break, which would need a round for each of their many merges, are merged rank by rank instead: a round takes the
places of the lowest rank and looks up only the pairs that it changed. Results of words are kept between batches up to a
fixed number of symbols, and go at the end of a task.

Defined results: a null text counts as empty and has no tokens; special tokens that occur in a text are one token each,
as the vocabulary file lists them; repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import slices, word_hashes

#: The endings that byte-level BPE splits off behind an apostrophe: fixed values of the file format.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Classes of characters: letters, numbers, white space, all others.
LETTER, NUMBER, SPACE, OTHER = range(4)
#: Symbols of words kept between batches, and symbols merged at once.
KEPT = 1_000_000
AT_ONCE = 500_000
#: Symbols from which a word is merged rank by rank.
LONG = 200


def byte_symbols() -> dict[str, int]:
    """The printable character of each byte in a byte-level vocabulary, to the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Bpe:
    """A vocabulary file of byte-level BPE (no normaliser, merges by rank)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_symbols()
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        pieces = [b""] * size
        for text, i in vocab.items():
            pieces[i] = bytes(to_byte[c] for c in text)
        for text, i in self.specials.items():
            pieces[i] = text.encode()
        self.first = np.zeros(256, np.int64)
        for c, b in to_byte.items():
            self.first[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.clear()

    def clear(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or how many merges there are, by binary search over the sorted keys."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.merged))

    def merge_long(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As merge, for long words: rounds by rank over all words, on a list linked by positions."""
        n, none = len(symbols), len(self.merged)
        symbols = symbols.copy()
        ends = np.cumsum(lengths)
        behind, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        behind[ends - 1], before[ends - lengths] = n, -1
        ranks = np.full(n, none)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look(at: np.ndarray) -> None:
            pair = at[behind[at] < n]
            ranks[at] = none
            ranks[pair] = self.rank(symbols[pair], symbols[behind[pair]])
            pair = pair[ranks[pair] < none]
            pair = pair[np.argsort(ranks[pair], kind="stable")]
            found = ranks[pair]
            for places in np.split(pair, np.flatnonzero(np.diff(found)) + 1) if len(pair) else ():
                r = int(ranks[places[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(places)

        look(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[ranks[at] == r]
            if not len(at):
                continue
            # Overlapping places (aaa) merge left to right: of a run of neighbouring places each second one.
            run = np.flatnonzero(np.concatenate([[True], behind[at[:-1]] != at[1:]]))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            gone = behind[at]
            symbols[at], symbols[gone], ranks[gone] = self.merged[r], -1, none
            behind[at] = behind[gone]
            there = behind[at] < n
            before[behind[at[there]]] = at[there]
            look(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
        left = symbols >= 0
        return symbols[left], np.add.reduceat(left, ends - lengths, dtype=np.int64) if n else np.zeros(0, np.int64)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words that lie one after the other; the symbols and lengths that remain."""
        n = len(lengths)
        if lengths.max(initial=0) >= LONG:
            long = lengths >= LONG
            deep = np.repeat(long, lengths)
            a, b = self.merge(symbols[~deep], lengths[~long]), self.merge_long(symbols[deep], lengths[long])
            sizes = np.empty(n, np.int64)
            sizes[~long], sizes[long] = a[1], b[1]
            out, deep = np.empty(int(sizes.sum()), np.int64), np.repeat(long, sizes)
            out[~deep], out[deep] = a[0], b[0]
            return out, sizes
        done_symbols, done_words = [], []
        words = np.arange(n)
        while len(symbols):
            owner = np.repeat(np.arange(len(lengths)), lengths)
            none = len(self.merged)
            rank = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), none)
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(np.append(rank, none), starts)  # a word's last pair is the break: it counts as none
            live = lowest < none
            keep = live[owner]
            if not live.all():
                done_symbols.append(symbols[~keep])
                done_words.append(np.repeat(words[~live], lengths[~live]))
            hit = np.flatnonzero((rank < none) & (rank == lowest[owner[:-1]]))
            if not len(hit):
                break
            # Overlapping places (aaa) merge left to right: of a run of neighbouring places each second one.
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            symbols = symbols.copy()
            symbols[hit] = self.merged[rank[hit]]
            keep[hit + 1] = False
            lengths = lengths - np.bincount(owner[hit], minlength=len(lengths))
            symbols, lengths, words = symbols[keep], lengths[live], words[live]
        if not done_symbols:
            return symbols, np.zeros(n, np.int64)
        owner = np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(owner, minlength=n)

    def learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Add new distinct words, given as spans of bytes, to the table."""
        flat, bounds = [self.flat], [self.bounds]
        cuts = np.flatnonzero(np.diff((np.cumsum(lengths) - lengths) // AT_ONCE)) + 1
        for some, sizes in zip(np.split(starts, cuts), np.split(lengths, cuts), strict=True):
            ids, sizes = self.merge(self.first[gather(data, some, sizes)], sizes)
            flat.append(ids)
            bounds.append(bounds[-1][-1] + np.cumsum(sizes))
        self.flat, self.bounds = np.concatenate(flat), np.concatenate(bounds)

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The table's row of each word."""
        keys, first, back = np.unique(word_hashes(data, starts, starts + lengths, lower=False), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            if len(self.flat) > KEPT:
                self.clear()
                new[:] = True
            rows = len(self.rows) + np.arange(int(new.sum()))
            self.learn(data, starts[first[new]], lengths[first[new]])
            known = np.concatenate([self.known, keys[new]])
            order = np.argsort(known)
            self.known, self.rows = known[order], np.concatenate([self.rows, rows])[order]
        return self.rows[np.searchsorted(self.known, keys)][back]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        parts, owner = texts, np.arange(len(texts))
        special = np.full(len(texts), -1)
        if self.special is not None and any(self.special.search(t) for t in texts):
            cut = [[(p, self.specials.get(p, -1)) for p in self.special.split(t) if p] for t in texts]
            owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
            parts, special = [p for c in cut for p, _ in c], np.array([i for c in cut for _, i in c], np.int64)
        starts, ends, first = split(parts)
        data = np.frombuffer("".join(parts).encode(), np.uint8)
        rows = self.words(data, starts, ends - starts)
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        total = np.concatenate([[0], np.cumsum(sizes)])[first]
        ids = gather(self.flat, self.bounds[rows], sizes)
        if (special < 0).all() and parts is texts:
            return [ids[a:b] for a, b in zip(total[:-1], total[1:], strict=True)]
        pieces = [ids[a:b] if i < 0 else np.array([i]) for a, b, i in zip(total[:-1], total[1:], special.tolist(), strict=True)]
        groups: list[list[np.ndarray]] = [[] for _ in texts]
        for i, x in zip(owner.tolist(), pieces, strict=True):
            groups[i].append(x)
        return [np.concatenate(g) if g else np.zeros(0, np.int64) for g in groups]

    def decode(self, ids: np.ndarray) -> str:
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for low in range(0, 0x110000, 0x1000):
        if not 0xD800 <= low < 0xE000:
            text = "".join(map(chr, range(low, low + 0x1000)))
            for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
                out[[ord(c) for c in regex.findall(pattern, text)]] = kind
    return out


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of byte-level BPE: byte starts and ends over the joined texts, and each text's first one (n + 1 values).

    A run of letters, numbers or other characters takes the blank before it along; of longer white space all but its
    last character is a pre-token of its own; a run of others that starts with an apostrophe and one of ENDINGS loses
    that part, unless a blank stands before it.
    """
    text = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(text)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kind = classes()[text]
    fresh = np.zeros(n + 1, bool)
    fresh[edges] = True
    begins = fresh[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    follows = np.zeros(n, bool)  # white space with something else of its text behind it
    follows[:-1] = space[:-1] & ~space[1:] & ~fresh[1:n]
    token = begins.copy()
    token |= follows
    blank = follows & (text == 32)
    token[1:] &= ~blank[:-1]
    for at in np.flatnonzero(begins & (text == 39)).tolist():
        if at and blank[at - 1]:
            continue
        for ending in ENDINGS:
            stop = at + 1 + len(ending)
            if stop <= n and not fresh[at + 1 : stop].any() and text[at + 1 : stop].tobytes() == ending.encode("utf-32-le"):
                token[at + 1] = False
                if stop < n:  # what is left of the letters is a pre-token, as is anything else that starts there
                    token[stop] = True
                break
    width = 1 + (text >= 0x80).astype(np.int64) + (text >= 0x800) + (text >= 0x10000)
    place = np.concatenate([[0], np.cumsum(width)])
    starts = np.flatnonzero(token)
    return place[starts], place[np.append(starts[1:], n)], np.searchsorted(starts, edges)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces values[start : start + length] one after the other."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


@lru_cache(maxsize=1)
def load(path: str) -> Bpe:
    return Bpe(path)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Encode each whole text and decode it again: id, n_tokens, ids_sha256, decoded_sha256 (and the ids, if asked)."""
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        try:
            for whole in batches:
                for batch in slices(whole, 1):
                    found = model.encode([t or "" for t in batch.column(1).to_pylist()])
                    columns = {
                        id_col: batch.column(0),
                        "n_tokens": pa.array([len(x) for x in found], pa.int64()),
                        "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found], pa.string()),
                        "decoded_sha256": pa.array([hashlib.sha256(model.decode(x).encode()).hexdigest() for x in found], pa.string()),
                    }
                    if ids:
                        columns["ids"] = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(columns)
        finally:
            model.clear()

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return source.mapInArrow(run, schema)
