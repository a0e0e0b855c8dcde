"""Token counts of a unigram tokenizer by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch (white-space words, with the vocabulary's word mark before them) are walked in the
depth-first order of their trie. The forward step of a node, the best score of the prefix and the fewest tokens that reach it,
is computed once for all words that share the prefix; a word's count is stored at its terminal. Documents add up the
counts of their words. Counts of words are kept between batches up to a fixed number.

The vocabulary file is a parameter. It is a list of pieces by rank without probabilities, so the unigram model uses
Zipf's rule, log p = -log(rank + 1). A character that is no piece costs its UTF-8 bytes, each a token.

Defined results: null, empty and blank texts have 0 words and tokens; equal scores take fewer tokens; repeated rows are
counted each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import slices, text_buffers, word_hashes, word_spans

#: The mark of a word's beginning in the vocabulary: a fixed value of the file format.
MARK = "▁"
#: Words whose counts are kept between batches.
KEPT = 1_000_000
#: Score of a byte of a character that is no piece.
BYTE = -20.0


class Unigram:
    def __init__(self, pieces: list[str]):
        self.score = {}
        for rank, p in enumerate(pieces):
            self.score.setdefault(p, -math.log(rank + 1))
        self.longest = max(map(len, self.score), default=1)
        self.clear()

    def clear(self) -> None:
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each word on its best path; ``words`` are distinct and sorted."""
        score, longest = self.score, self.longest
        best, tokens, out = [0.0], [0], []
        above = ""
        for word in words:
            word = MARK + word
            same = 0
            for a, b in zip(above, word):
                if a != b:
                    break
                same += 1
            del best[same + 1 :], tokens[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                size = len(word[end - 1].encode("utf-8", "replace"))
                value, fewest = best[end - 1] + BYTE * size, tokens[end - 1] + size
                for start in range(max(0, end - longest), end):
                    s = score.get(word[start:end])
                    if s is not None:
                        s += best[start]
                        n = tokens[start] + 1
                        if s > value or (s == value and n < fewest):
                            value, fewest = s, n
                best.append(value)
                tokens.append(fewest)
            out.append(tokens[-1])
            above = word
        return out

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token counts of words given as spans of bytes."""
        keys, first, back = np.unique(word_hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            if len(self.known) > KEPT:
                self.clear()
                new[:] = True
            text = data.tobytes()
            words = [text[a:b].decode("utf-8", "replace") for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            order = sorted(range(len(words)), key=words.__getitem__)
            counts = np.empty(len(words), np.int64)
            counts[order] = self.count([words[i] for i in order])
            known = np.concatenate([self.known, keys[new]])
            place = np.argsort(known)
            self.known, self.counts = known[place], np.concatenate([self.counts, counts])[place]
        return self.counts[np.searchsorted(self.known, keys)][back]


@lru_cache(maxsize=1)
def load(path: str) -> Unigram:
    """Pieces of a sentencepiece file, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Unigram([model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))])


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_tokens of every whole text."""
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for whole in batches:
            for batch in slices(whole, 1):
                data, offsets = text_buffers(batch.column(1))
                starts, ends, first = word_spans(data, offsets)
                total = np.concatenate([[0], np.cumsum(model.of_words(data, starts, ends))]) if len(starts) else np.zeros(1, np.int64)
                yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "n_words": pa.array(np.diff(first).astype(np.int64)), "n_tokens": pa.array(np.diff(total[first]).astype(np.int64))})

    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, n_words long, n_tokens long")
