"""Toxicity from a weighted finite-state grammar over clauses.

A word transducer maps the words of a clause to classes: insults and violent verbs with weights, words of intention,
targets, negations, words of reported speech, others. Its insult lexicon is a weighted trie of word beginnings, learnt
from labels on a bounded sample; the short lists of function words are fixed. Four small transducers rewrite the class
string: negation marks what lies in its scope; a violent verb behind a word of intention is a threat; reported speech
marks what follows it in the clause; a target raises what is aimed at it. They are composed once into one deterministic
machine, which reads each clause that has a match. Its final arcs carry the factors of ``FACTORS``: what a match weighs in
the lexicon counts more if it is aimed or a threat, and next to nothing if it is negated or reported. The score is a
curve, nowhere falling (isotonic regression on the sample), over the clause that weighs most and the sums of all.

Word beginnings are counted on the executors; the driver gets those that tell labels apart, how often each follows a word
of intention (such entries are violent verbs, as those of ``VIOLENT``), and one row of features for each document of the
sample. The model is bounded by ``EACH`` documents of each label, ``ENTRIES`` entries, and ``LONGEST`` letters of a
beginning, beyond which only the whole word counts; texts are scored whole.

Defined results: a null or empty text has no match and gets the score of such a text; without labels of both kinds every
score is the share of label 1 (0 without any); repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpointed, slices
from ._learn import fold, logistic, sample, shares

#: Documents of each label in the training sample, at most.
EACH = 2000
#: predicted is 1 from this score on.
TOXIC = 0.7
#: Lexicon entries at most, the least documents that must have one, its least weight (log odds), and letters of a beginning.
ENTRIES, SUPPORT, LEAST, LONGEST = 4000, 3, 1.5, 24
#: Characters of a text whose word beginnings are held at once.
PIECE = 1 << 20

# Function words of the languages at hand.
TARGETS = set("you your yours he him she her they them people all everyone du dich dir ihr euch sie alle tu te toi vous ils elles tous ti usted ustedes ellos ellas todos".split())
NEGATIONS = set("not no never none nobody isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemals ne pas jamais aucun aucune nunca jamás tampoco".split())
REPORTS = set("said says say told wrote writes quoted claimed sagte sagt schrieb dit disait écrit dijo dice escribió".split())
INTENTIONS = set("will gonna going shall must should i'll we'll they'll werde werden wird voy vamos vais vas va irai irons allons".split())
VIOLENT = {"kill": 3.0, "murder": 3.0, "hurt": 1.5, "destroy": 1.0, "beat": 0.8, "shoot": 1.5, "töten": 3.0, "umbringen": 3.0, "tuer": 2.5, "matar": 2.5}
#: Words that a negation and a word of intention reach.
SCOPE = 3

PARTS = 4  # of the sample, each weighed by a lexicon learnt on the others

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]")
#: Classes of words, and the uses of a match that the machine gives out.
INSULT, VERB, TARGET, NEGATION, REPORT, INTENTION, PLAIN = SYMBOLS = range(7)
#: What a match's weight is multiplied with, by use.
FACTORS = {"asserted": 1.0, "aimed": 1.5, "negated": 0.1, "reported": 0.2, "threat": 2.0, "violent": 1.0}
WORDS = {w: s for words, s in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (INTENTIONS, INTENTION)) for w in words}


class Transducer:
    """Deterministic: (state, symbol) to (state, symbol); a missing arc keeps the state and the symbol."""

    def __init__(self, arcs: dict[tuple[int, object], tuple[int, object]]):
        self.arcs = arcs

    def step(self, state: int, symbol: object) -> tuple[int, object]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(machines: list[Transducer], symbols: list[object]) -> dict[tuple[tuple[int, ...], object], tuple[tuple[int, ...], object]]:
    """All transitions of the machines run one into the other, from the start states on."""
    table, todo = {}, [(0,) * len(machines)]
    while todo:
        states = todo.pop()
        for s in symbols:
            if (states, s) in table:
                continue
            out, moved = s, []
            for m, at in zip(machines, states, strict=True):
                at, out = m.step(at, out)
                moved.append(at)
            table[states, s] = (tuple(moved), out)
            todo.append(tuple(moved))
    return table


def grammar() -> dict:
    """Negation, then threat, then reported speech, then target. A symbol that an earlier machine has marked passes on."""
    negation: dict = {}
    for left in range(SCOPE + 1):
        negation[left, NEGATION] = (SCOPE, PLAIN)
        for s in SYMBOLS:
            if s != NEGATION:
                negation[left, s] = (max(left - 1, 0), "negated" if left and s in (INSULT, VERB) else s)
    threat: dict = {}
    for left in range(SCOPE + 1):
        threat[left, INTENTION] = (SCOPE, PLAIN)
        threat[left, VERB] = (max(left - 1, 0), "threat" if left else VERB)
        for s in (INSULT, TARGET, REPORT, PLAIN, "negated"):
            threat[left, s] = (max(left - 1, 0), s)
    reported: dict = {(0, REPORT): (1, PLAIN), (1, REPORT): (1, PLAIN)}
    for s in (INSULT, VERB, "threat"):
        reported[1, s] = (1, "reported")
    # State 1: a target stands before in the clause.
    aimed: dict = {(0, TARGET): (1, PLAIN), (1, TARGET): (1, PLAIN)}
    for state in (0, 1):
        aimed[state, INSULT] = (state, "aimed" if state else "asserted")
        aimed[state, VERB] = (state, "violent")
    return compose([Transducer(negation), Transducer(threat), Transducer(reported), Transducer(aimed)], list(SYMBOLS))


def beginnings(text: str) -> set[str]:
    """Word beginnings of 3 to LONGEST characters in the text, and whole words, which '$' ends."""
    words = {w + "$" for w in _WORD.findall(text.lower())}
    return {w[:n] for w in words for n in range(3, min(len(w), LONGEST) + 1)} | {w for w in words if len(w) > LONGEST}


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of about PIECE characters that end where a word does."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        while stop < len(text) and (text[stop - 1].isalpha() or text[stop - 1] == "'"):
            stop += 1
        yield text[at:stop]
        at = stop


def pruned(telling: dict[str, float]) -> dict[str, float]:
    """The lexicon: a beginning is left out if one above it in the trie is already as telling."""
    kept: dict[str, float] = {}
    for k in sorted(telling, key=len):
        if not any(k[:n] in kept and kept[k[:n]] >= telling[k] - 0.5 for n in range(3, len(k))):
            kept[k] = telling[k]
    return dict(sorted(kept.items(), key=lambda kv: (-kv[1], kv[0]))[:ENTRIES])


def learn_lexicons(rows: DataFrame, sizes: dict[tuple[int, int], int]) -> list[dict[str, float]]:
    """Word beginnings that tell toxic documents, with log odds of documents as weights: one lexicon learnt without each
    part of the sample, and one from all. ``rows``: _y, _part, _text; ``sizes``: documents by (_y, _part).

    Candidates are the nodes of the trie of the toxic documents' words. A node stands for its whole unary path, as its
    longest beginning.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen: Counter, long: int | None) -> pa.RecordBatch:
            found = {"k": pa.array([k for k, _ in seen], pa.string()), "c": pa.array([c for _, c in seen], pa.int32())}
            return pa.RecordBatch.from_pydict(found | {"long": pa.array([long] * len(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

        for whole in batches:
            for batch in slices(whole, 2):
                seen: Counter[tuple[str, int]] = Counter()
                for y, part, text, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if len(text) <= PIECE:
                        seen.update((k, y * PARTS + part) for k in beginnings(text))
                    else:  # piece by piece; a beginning in several pieces of a document counts once below
                        for piece in pieces(text):
                            yield out(Counter((k, y * PARTS + part) for k in beginnings(piece)), place)
                yield out(seen, None)

    counted = rows.withColumn("_place", F.monotonically_increasing_id()).mapInArrow(count, "k string, c int, long long, n long")
    counted = counted.groupBy("k", "c", "long").agg(F.sum("n").alias("n")).withColumn("n", F.when(F.col("long").isNull(), F.col("n")).otherwise(F.lit(1)))
    by_cell = [F.coalesce(F.sum(F.when(F.col("c") == c, F.col("n"))), F.lit(0)).alias(f"n{c}") for c in range(2 * PARTS)]
    table = counted.groupBy("k").agg(*by_cell)
    toxic, clean = (sum(F.col(f"n{y * PARTS + p}") for p in range(PARTS)) for y in (1, 0))
    fits = []  # documents inside, outside; all documents inside, outside; for each lexicon
    for held in [*range(PARTS), None]:
        n = [sum(v for (y, p), v in sizes.items() if y == of and p != held) for of in (1, 0)]
        inside, outside = (c if held is None else c - F.col(f"n{y * PARTS + held}") for y, c in ((1, toxic), (0, clean)))
        weight = F.log((inside + 0.5) / (n[0] + 1.0)) - F.log((outside + 0.5) / (n[1] + 1.0))
        fits.append((inside, weight, max(SUPPORT, n[0] // 200)))
    columns = [c for i, (inside, weight, _) in enumerate(fits) for c in (inside.alias(f"i{i}"), weight.alias(f"w{i}"))]
    table = checkpointed(table.select("k", *columns).filter(F.greatest(*[F.col(f"i{i}") for i in range(len(fits))]) >= min(f[2] for f in fits)))
    longer = table.filter(F.length("k") > 3).groupBy(F.expr("left(k, length(k) - 1)").alias("k")).agg(*[F.max(f"i{i}").alias(f"l{i}") for i in range(len(fits))])
    tells = [(F.col(f"w{i}") >= LEAST) & (F.col(f"i{i}") >= f[2]) & (F.coalesce(f"l{i}", F.lit(0)) < 0.97 * F.col(f"i{i}")) for i, f in enumerate(fits)]
    found = table.join(longer, "k", "left").select("k", *[F.when(t, F.col(f"w{i}")).alias(f"w{i}") for i, t in enumerate(tells)])
    found = found.filter(F.coalesce(*[F.col(f"w{i}") for i in range(len(fits))]).isNotNull())
    # A document has few telling words, and each is held by one toxic document in 200 at least.
    out = [(r.k, r[1:]) for r in found.collect()]
    return [pruned({k: w[i] for k, w in out if w[i] is not None}) for i in range(len(fits))]


@dataclass
class Grammar:
    lexicon: dict[str, float]
    verbs: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.eye(FEATURES)[0])
    curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))
    prior: float | None = None

    def __post_init__(self) -> None:
        self.table = grammar()

    def __getstate__(self) -> dict:
        return {"lexicon": self.lexicon, "verbs": self.verbs, "weights": self.weights, "curve": self.curve, "prior": self.prior}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.table = grammar()

    def machine(self) -> ahocorasick.Automaton:
        """The word transducer's lexicon as an automaton; built where it is used."""
        if "automaton" not in self.__dict__:
            entries: dict[str, list[tuple[str, float]]] = {}
            for k, w in self.lexicon.items():  # a verb's weight is negative
                entries.setdefault(k.rstrip("$"), []).append((k, -w if k in self.verbs else w))
            for k, w in VIOLENT.items():  # a violent verb stays one, whatever the lexicon says of it
                entries[k] = [e for e in entries.get(k, []) if e[0] != k + "$"] + [(k + "$", -w)]
            a = ahocorasick.Automaton()
            for k, found in entries.items():
                a.add_word(k, found)
            a.make_automaton()
            self.automaton = a
        return self.automaton

    def matches(self, text: str) -> dict[int, tuple[float, str]]:
        """Start of each matched word in the lowered text, to its weight (a violent verb's is negative, and goes first) and
        entry."""
        found: dict[int, tuple[float, str]] = {}
        for end, entries in self.machine().iter(text):
            for key, w in entries:
                whole = key.endswith("$")
                start = end + 1 - len(key) + whole
                if (start and text[start - 1].isalpha()) or (whole and end + 1 < len(text) and text[end + 1].isalpha()):
                    continue
                before = found.get(start, (0.0, ""))[0]
                if (before >= 0 and (w < 0 or w > before)) or w < before < 0:
                    found[start] = (w, key)
        return found

    def clauses(self, text: str) -> Iterator[list[tuple[str, float, str, bool]]]:
        """(use, weight, entry, whether a word of intention stands before it) of the matches of each clause that has one."""
        text = text.lower()
        found = self.matches(text)
        done = -1
        for start in sorted(found):
            if start < done:
                continue
            low = max(text.rfind(c, max(done, 0), start) for c in ".!?;:\n") + 1  # the clause before ends at done
            stop = _CLAUSE.search(text, start)
            done = stop.start() if stop else len(text)
            state, meant, out = (0,) * 4, 0, []
            for m in _WORD.finditer(text, low, done):
                w, key = found.get(m.start(), (0.0, ""))
                symbol = WORDS.get(m[0])  # function words are none of the lexicon's, whatever the sample says
                if symbol is None:
                    symbol = (INSULT if w > 0 else VERB) if w else PLAIN
                else:
                    w = 0.0
                state, use = self.table[state, symbol]
                if w:
                    out.append((use, abs(w), key, meant > 0))
                meant = SCOPE if symbol == INTENTION else max(meant - 1, 0)
            yield out

    def features(self, text: str) -> np.ndarray:
        """What weighs most in one clause, logarithms of the sums over distinct entries and over all clauses, and of the
        latter for each PAGE characters. An entry counts once in a clause, at its most."""
        best = total = 0.0
        document: dict[str, float] = {}
        for clause in self.clauses(text):
            held: dict[str, float] = {}
            for use, w, key, _ in clause:
                held[key] = max(held.get(key, 0.0), FACTORS[use] * w)
            weight = sum(held.values())
            best, total = max(best, weight), total + weight
            for key, w in held.items():
                document[key] = max(document.get(key, 0.0), w)
        return np.array([best, math.log1p(sum(document.values())), math.log1p(total), math.log1p(total / (1 + len(text) / PAGE))])

    def score(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        x = np.array([self.features(t) for t in texts]).reshape(-1, FEATURES) @ self.weights
        # Between the steps' middles the curve is straight, and it rises a little everywhere.
        return (1 - SLOPE) * np.interp(x, *self.curve) + SLOPE * x / (1 + x)


#: Features; what of the score rises evenly instead of in steps; characters that count as one page.
FEATURES, SLOPE, PAGE = 4, 0.01, 300


def learn_verbs(rows: DataFrame, lexicon: dict[str, float]) -> frozenset[str]:
    """Entries that mostly follow a word of intention in toxic documents: what a threat says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Grammar(lexicon)
        for whole in batches:
            for batch in slices(whole, 2):
                seen: Counter[tuple[str, bool]] = Counter((key, meant) for text in batch.column(2).to_pylist() for clause in model.clauses(text) for _, _, key, meant in clause)
                yield pa.RecordBatch.from_pydict({"k": pa.array([k for k, _ in seen], pa.string()), "meant": pa.array([m for _, m in seen], pa.bool_()), "n": pa.array(list(seen.values()), pa.int64())})

    counts = rows.filter("_y = 1").mapInArrow(run, "k string, meant boolean, n long").groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("meant"), F.col("n"))).alias("m"))
    # At most one row for each entry of the lexicon.
    return frozenset(r.k for r in counts.filter(f"m >= {SUPPORT} and 2 * m > n").collect() if r.k in lexicon)


def rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights of which none is negative, without the intercept: features that would fall are left out. If all
    would, the first counts."""
    used = list(range(x.shape[1]))
    while used:
        w = logistic(x[:, used], y, weight, l2=1e-3)
        if all(w[:-1] >= 0):
            break
        used.pop(int(np.argmin(w[:-1])))
    out = np.zeros(x.shape[1])
    out[used or [0]] = w[:-1] if used else 1.0
    return out if out.any() else np.eye(x.shape[1])[0]


def steps(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: the middles of the steps and their shares of label 1, which never fall."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted x, weighted y
    at = 0
    while at < len(order):  # equal places are one
        stop = at + int(np.searchsorted(x[order[at:]], x[order[at]], "right"))
        some = order[at:stop]
        blocks.append([weight[some].sum(), (weight[some] * x[some]).sum(), (weight[some] * y[some]).sum()])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][0] >= blocks[-1][2] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        at = stop
    total = np.array(blocks).T
    return total[1] / total[0], total[2] / total[0]


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", each: int = EACH) -> Grammar:
    """Lexicon and curve from the bounded sample; each part of it is weighed by a lexicon learnt on the others."""
    share = shares(labels, label, id_col, usable)
    if not all(share):
        return Grammar({}, prior=float(share[1] > 0))
    rows = sample(docs, labels, label, id_col, text_col, usable, each)
    rows = checkpointed(rows.select("_y", F.pmod(F.xxhash64("_text", "_id"), F.lit(PARTS)).cast("int").alias("_part"), "_text"))
    sizes = {(r._y, r._part): r["count"] for r in rows.groupBy("_y", "_part").count().collect()}
    if not {y for y, _ in sizes} >= {0, 1}:
        return Grammar({}, prior=share[1] / sum(share))
    lexicons = learn_lexicons(rows, sizes)
    verbs = learn_verbs(rows, lexicons[PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Grammar(x, verbs) for x in lexicons[:PARTS]]
        for whole in batches:
            for batch in slices(whole, 2):
                x = [held[part].features(text).tolist() for part, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"y": batch.column(0), "x": pa.array(x, pa.list_(pa.float64()))})

    found = sorted((r.y, r.x) for r in rows.mapInArrow(run, "y int, x array<double>").collect())
    y = np.array([f[0] for f in found], float)
    real = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    out = Grammar(lexicons[PARTS], verbs)
    x, real = np.array([f[1] for f in found]), real * len(y) / real.sum()
    out.weights = rising(x, y, real)
    out.curve = steps(x @ out.weights, y, real)
    return out


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = EACH) -> DataFrame:
    """id, held_out, score, predicted; labels of rows with crc32(id) mod 3 = 1 are not used."""
    model = train(docs, labels, fold("_id", 3) != 1, "toxic", id_col, text_col, each)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most ENTRIES short words
    source = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                score = shared.value.score([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "score": pa.array(score), "predicted": pa.array((score >= TOXIC).astype(np.int32))})

    out = source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, score double, predicted int")
    return out.select(id_col, (fold(id_col, 3) == 1).alias("held_out"), "score", "predicted")
