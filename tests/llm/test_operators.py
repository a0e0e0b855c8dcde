"""Small tables with nulls, empty and long texts, ties, repeated rows, no rows, and extra columns with clashing names."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from cuewright.llm import components, exact_dedup, jaccard_join, mixing, neighbours, passages, quality, sharding, token_counts, toxicity
from cuewright.llm.bpe import Bpe, bpe_round_trip

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _norm string, n long, cid long, word string, seed long"
random.seed(3)
VOCABULARY = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, every, seed):
    words = text.split()
    for i in range(seed % every, len(words), every):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


LONG = prose(30_000, 99)
BASE = prose(300, 1)
ROWS = [
    (1, BASE, "a"), (2, BASE.replace(" ", "\n", 3), "a"), (3, edited(BASE, 60, 1), "a"), (4, edited(BASE, 60, 2), "b"), (5, None, None), (6, "", "b"), (7, " \t ", "b"),
    (8, LONG, "a"), (9, LONG + " end", "c"), (10, "one two", "c"), (11, "one  two", "c"), (12, "A B C D", None), (12, "A B C D", None), (13, "a b c d", "é"),
    (14, prose(120, 5), "a"), (15, prose(80, 6) + " " + prose(70, 7), "a"), (16, prose(90, 8) + " " + prose(70, 7), "b"), (17, "x" * 5000, "b"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "clash", 1, 2, "w", 3) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("hot", [256, 2])
def test_exact_dedup(docs, none, hot):
    got = exact_dedup.exact_dedup(docs, hot_rows=hot).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(norm(t), []).append(i)
    for r in got:
        ids = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256 and r.doc_id in g)
        assert (r.keep_id, r.group_size) == (min(ids), len(ids))
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.deduplicated(docs, hot_rows=hot)
    assert kept.columns == docs.columns and {r["_norm"] for r in kept.collect()} == {"clash"} and sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in groups.values())


def test_sharding_fits_the_limit(docs, none):
    for limit in (500, 4000, 10**9):
        got = sharding.shard(docs, limit=limit).collect()
        assert len(got) == len(ROWS)
        total = {}
        for r in got:
            total[r.shard] = total.get(r.shard, 0) + r.size_bytes
        alone = {r.shard for r in got if r.size_bytes > limit}
        assert all(n <= limit or s in alone for s, n in total.items())
        assert all(total[r.shard] == r.shard_bytes for r in got)
    assert sharding.shard(none).count() == 0


def brute_groups(rows, words, similar):
    sets = {}
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(grams)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and any(a and b and 100 * len(a & b) >= similar * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (sorted(map(len, sets[i])), find(i)) for i in sets}


@pytest.mark.parametrize(("words", "similar"), [(4, 85), (5, 80)])
def test_jaccard_groups(spark, docs, none, words, similar):
    more = [(100 + k, edited(prose(200, 40 + k % 3), 30 + k % 40, k), "a") for k in range(60)] + [(300 + k, edited(BASE, 15, k), "a") for k in range(20)]
    rows = ROWS + more
    want = brute_groups(rows, words, similar)
    got = jaccard_join.jaccard_groups(frame(spark, rows), words=words, similar=similar).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in want[r.doc_id][0] and r.component_id == want[r.doc_id][1]
    assert jaccard_join.jaccard_groups(none).count() == 0
    kept = jaccard_join.one_of_each_group(docs, words=words, similar=similar)
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({c for _, c in brute_groups(ROWS, words, similar).values()})


def test_divide_skip_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(100):
        query = np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64))
        sets = [np.unique(np.concatenate([query[rng.random(len(query)) < 0.9], rng.integers(0, 60, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(8)]
        want = [100 * len(np.intersect1d(query, s)) >= 80 * len(np.union1d(query, s)) for s in sets]
        assert jaccard_join.divide_skip(query, sets, 80) == want


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (5, 5), (100, 1)] + [(i, i + 1) for i in range(200, 260)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got[3] == got[100] == 1 and got[10] == 8 and {got[i] for i in range(200, 261)} == {200} and 5 not in got


def test_mixing(spark, docs, none):
    r = random.Random(5)
    rows = [(i, prose(r.randint(0, 60) if i % 50 else 900, i), f"s{i % 4}") for i in range(800)] + [(900, None, None), (901, "q " * 9, None)]
    got = mixing.mix_sources(frame(spark, rows), block=100).collect()
    again = mixing.mix_sources(frame(spark, rows), block=100).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    taken, target = {}, {}
    for x in got:
        assert x.taken in (0, x.size, 2 * x.size, 3 * x.size)
        taken[x.source] = taken.get(x.source, 0) + x.taken
        target[x.source] = x.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 450  # at most two documents land, the nearest way
    assert mixing.mix_sources(none).count() == 0
    assert len(mixing.mix_sources(docs).collect()) == len(ROWS)
    copies = {x.doc_id: x.copies for x in mixing.mix_sources(frame(spark, rows)).collect()}
    mixed = mixing.mixed(frame(spark, rows))
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: c for i, c in copies.items() if c}
    assert mixed.columns == docs.columns and {r["_id"] for r in mixed.collect()} == {7}


def targets(sizes: list[tuple[str | None, int]], weights=mixing.WEIGHTS, most=mixing.MOST):
    """Targets of sources given in order as (name, size): shares by weight, capped, the excess shared again by weight."""
    total = float(sum(s for _, s in sizes))
    weigh = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        scale = sum(weigh[i] for i in open_)
        over = {i for i in open_ if left * weigh[i] / scale > most * sizes[i][1]}
        if not over:
            for i in open_:
                out[i] = left * weigh[i] / scale
            break
        for i in sorted(over):
            out[i] = float(most * sizes[i][1])
            left -= out[i]
        open_ -= over
    return out


def test_targets_reshare_the_excess(spark):
    r = random.Random(1)
    rows = [(i, prose(r.choice([1, 5, 80]), i), r.choice(["a", "é", "Z", "😀", "", None, "b", "B", "zz"])) for i in range(300)] + [(301, prose(2, 1), "tiny"), (302, "", "none")]
    got = mixing.mix_sources(frame(spark, rows)).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    order = sorted(size, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    want = dict(zip(order, targets([(s, size[s]) for s in order]), strict=True))
    assert len(got) == len(rows)
    for x in got:
        assert x.source_size == size[x.source] and x.target == pytest.approx(want[x.source])
    assert targets([("a", 100), ("b", 10), ("c", 100)]) == pytest.approx([45.0, 30.0, 135.0])


def labelled(spark, kinds):
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = kinds[bad](i)
        rows.append((i, text, "a"))
        labels.append((i, int(not bad), int(bad)))
    rows += [(1000, None, None), (1001, "", "a"), (1002, LONG, "a")]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: q for i, q, _ in labels}


def test_quality(spark, none):
    kinds = {False: lambda i: "\n".join(prose(12, i * 10 + k).capitalize() + "." for k in range(6)), True: lambda i: "\n".join([prose(10, i)] + [" ".join(w + "###" for w in prose(12, i * 10 + k).split()) for k in range(5)])}
    docs, labels, want = labelled(spark, kinds)
    got = quality.quality(docs, labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 80 and np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.97
    assert {r.score for r in quality.quality(docs, labels.filter("false")).collect()} == {0.5}
    assert quality.quality(none, labels).count() == 0


def test_toxicity(spark, none):
    def toxic(i):
        w = prose(40, i).split()
        w[i % 40] = ["zorgug", "zorgam", "blighter", "blighter"][i % 4]
        return " ".join(w)

    docs, labels, want = labelled(spark, {False: lambda i: prose(40, i), True: toxic})
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 80 and np.mean([r.predicted == 1 - want[r.doc_id] for r in held]) > 0.95
    assert toxicity.toxicity(none, labels).count() == 0 and {r.score for r in toxicity.toxicity(docs, labels.filter("false")).collect()} == {0.0}


def test_grammar_tells_uses_apart():
    g = toxicity.Grammar({"idiot": 5.0})
    use = lambda t: Counter(u for c in g.clauses(t) for u, *_ in c).most_common(1)[0][0]
    assert [use(t) for t in ("idiot here", "you idiot", "not an idiot", "he said idiot", "i will kill you", "i kill you")] == ["asserted", "aimed", "negated", "reported", "threat", "violent"]
    assert [use(t) for t in ("i will never kill you", "he wrote that i will kill you", "i will one two three kill you")] == ["negated", "reported", "violent"]
    assert g.features("idiotic")[0] > 0
    both = toxicity.Grammar({"idiot": 5.0, "idiot$": 6.0, "kill$": 4.0})
    assert both.features("idiotic")[0] == 5.0 and both.features("idiot")[0] == 6.0 and [u for c in both.clauses("i will kill") for u, *_ in c] == ["threat"]
    assert both.features("idiot idiot idiotic")[0] == 11.0 and both.features("idiot. idiot")[0] == 6.0  # an entry counts once in a clause
    assert not toxicity.Grammar({"idiot$": 5.0}).features("idiotic nonidiot").any()


def test_composed_machine_is_the_four_in_sequence():
    """Every string of up to five symbols, by the rules as the module states them, against the composed machine."""
    T = toxicity
    table, scope = T.grammar(), T.SCOPE

    def by_rules(symbols):
        out, negated, meant, reported, target = [], 0, 0, False, False
        for s in symbols:
            x = s
            if s == T.NEGATION:
                x = T.PLAIN
            elif negated and s in (T.INSULT, T.VERB):
                x = "negated"
            negated = scope if s == T.NEGATION else max(negated - 1, 0)
            intends = x == T.INTENTION
            x = T.PLAIN if intends else "threat" if x == T.VERB and meant else x
            meant = scope if intends else max(meant - 1, 0)
            says = x == T.REPORT
            x = T.PLAIN if says else "reported" if reported and x in (T.INSULT, T.VERB, "threat") else x
            reported |= says
            aims = x == T.TARGET
            x = T.PLAIN if aims else {T.INSULT: "aimed" if target else "asserted", T.VERB: "violent"}.get(x, x)
            target |= aims
            out.append(x)
        return out

    for n in range(1, 6):
        for symbols in itertools.product(T.SYMBOLS, repeat=n):
            state, got = (0,) * 4, []
            for s in symbols:
                state, x = table[state, s]
                got.append(x)
            assert got == by_rules(symbols), symbols
    assert {x for _, x in table.values()} - {T.PLAIN} == set(T.FACTORS)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_scores_follow_the_grammar(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, toxicity.fold("_id", 3) != 1)
    strongest = sorted((w, k.rstrip("$")) for k, w in model.lexicon.items() if k.endswith("$"))[-3:]
    assert {"trash", "idiot"} & {k.rstrip("$") for k in model.lexicon}
    for _, x in strongest:
        plain, aimed, directed, denied, said, quoted, empty, threat = model.score([x, f"you {x}", f"you are a {x}", f"not {x}", f"he said {x}", f"he said you are a {x}", "", "I will kill you"])
        assert aimed >= plain > max(denied, said, quoted) and directed >= plain and min(denied, said) >= empty and threat > empty
        assert model.score([f"you are not a {x}"])[0] < plain
    got = toxicity.toxicity(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    found = {r.toxic: r.p for r in got}
    assert found[0] < 0.01 and found[1] > (0.9 if sf == "sf0.1" else 0.7)  # sf0.01 has 40 toxic documents to learn from


def test_threat_verbs_are_learnt(spark):
    text = lambda i, y: prose(30, i) + (f". I will {['smackle', 'smackled'][i // 2 % 2]} you" if y else "")
    rows = [(i, i % 2, text(i, i % 2)) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert any(k.startswith("smackle") for k in model.verbs)
    assert [u for c in model.clauses("they shall smackle him") for u, *_ in c] == ["threat"] and [u for c in model.clauses("they smackle him") for u, *_ in c] == ["violent"]
    threat, plain, empty = model.score(["we will smackle you", "we smackle it", ""])
    assert threat >= plain > empty


def test_long_texts_are_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 50)
    long = " ".join(f"w{i}" for i in range(100)) + " blighter"
    assert "".join(toxicity.pieces(long)) == long and all(len(p) < 60 for p in toxicity.pieces(long))
    assert set().union(*map(toxicity.beginnings, toxicity.pieces(long))) == toxicity.beginnings(long)
    rows = spark.createDataFrame([(y, i % 4, f"{long} blighter again blighter" if y else long.replace("blighter", "") ) for i in range(40) for y in (0, 1)], "_y int, _part int, _text string")
    assert toxicity.learn_lexicons(rows, {(y, p): 10 for y in (0, 1) for p in range(4)})[4].keys() >= {"blighter$"} or "bli" in str(toxicity.learn_lexicons(rows, {(y, p): 10 for y in (0, 1) for p in range(4)})[4])


def test_grammar_reads_long_clauses():
    g = toxicity.Grammar({"idiot": 5.0})
    use = lambda t: Counter(u for c in g.clauses(t) for u, *_ in c).most_common(1)[0][0]
    far = " word" * 1000
    assert [use(t) for t in (f"you{far} idiot", f"he said{far} idiot", f"you.{far} idiot", f"you idiot.{far} idiot. {far} idiot")] == ["aimed", "reported", "asserted", "asserted"]


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[::10] = x[0]
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))] + [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [1.0, 2.0]), (9004, [None] + [1.0] * 15)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest_neighbours(t, F.col("vec_id") % 50 == 0).collect()
    hit = total = 0
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q in range(0, 3000, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        s = unit @ unit[q]
        s[q] = -9
        if q == 0:
            assert [r.vec_id for r in mine] == [10, 20, 30, 40, 50] and len({r.score for r in mine}) == 1
        best = set(np.lexsort((np.arange(3000), -s.round(12)))[:5].tolist())
        hit += len(best & {r.vec_id for r in mine})
        total += 5
        assert all(abs(r.score - s[r.vec_id]) < 1e-12 for r in mine)
    assert hit / total >= 0.9
    few = spark.createDataFrame(rows[1:4], "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(few, F.lit(True)).count() == 6
    assert neighbours.nearest_neighbours(t.filter("false"), F.lit(True)).count() == 0


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), Bpe(path)
    r = random.Random(1)
    texts = [t or "" for _, t, _ in ROWS] + ["<|endoftext|>a<|endoftext|>", "it's 'll  \n x", "日本 😀é ²½", "aaaa" * 50]
    texts += ["".join(r.choice("ab '\n\tse12!é日😀\x1c\x85|<") for _ in range(r.randrange(50))) for _ in range(500)]
    for t, x in zip(texts, own.encode(texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert x.tolist() == want and own.decode(x) == library.decode(want, skip_special_tokens=False)
    got = {r.doc_id: r for r in bpe_round_trip(docs, path).collect()}
    assert got[1].decoded_sha256 == hashlib.sha256(BASE.encode()).hexdigest() and got[5].n_tokens == 0
    assert bpe_round_trip(none, path).count() == 0


def test_token_counts(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.load(path)

    def brute(word):
        word, best = "▁" + word, [(0.0, 0)]
        for i in range(1, len(word) + 1):
            size = len(word[i - 1].encode())
            found = [(best[i - 1][0] - 20.0 * size, -best[i - 1][1] - size)]
            found += [(best[j][0] + model.score[word[j:i]], -best[j][1] - 1) for j in range(i) if word[j:i] in model.score]
            best.append((max(found)[0], -max(found)[1]))
        return best[-1][1]

    got = {r.doc_id: r for r in token_counts.token_counts(docs, path).collect()}
    for i, t, _ in ROWS:
        w = (t or "").split()
        assert got[i].n_words == len(w)
        if len(w) < 500 and i != 17:
            assert got[i].n_tokens == sum(map(brute, w))
    assert token_counts.token_counts(none, path).count() == 0


def test_passages(spark, docs, none):
    got = passages.repeated_passages(docs).collect()
    ids = {r.doc_id for r in got}
    assert {1, 2, 3, 4, 8, 9, 15, 16} <= ids and not ids & {5, 6, 7, 10, 11, 12, 13, 14, 17}
    assert any(r.doc_id == 16 and r.partner_id == 15 and 85 <= r.start_word <= 110 and r.end_word == 160 for r in got)
    many = frame(spark, [(i, prose(30, 1000 + i) + " " + prose(60, 77) + " " + prose(30, 2000 + i), "a") for i in range(40)])
    rows = passages.repeated_passages(many).collect()
    assert {r.doc_id for r in rows} == set(range(40)) and len(rows) < 120
    assert passages.repeated_passages(none).count() == 0


def test_chains_follow_the_order():
    assert passages.chains([0, 10, 20, 5], [0, 10, 20, 40])[0] == [0, 1, 2]
    assert passages.agreeing((1, 2, 3, 4), (1, 9, 3, 4)) == 3


def test_a_second_passage_behind_a_long_one_is_chained():
    """Against all predecessors tried one by one; the first chain's end outweighs all in reach of the second passage."""
    random_places = random.Random(4)
    for first, gap, second in ((200, 100, 80), (400, 100, 60), (1000, 150, 300)):
        at = [x for x in range(first + gap + second) if (x < first or x >= first + gap) and random_places.random() < 0.12]
        shift = [x + (x >= first) * 20 for x in at]
        value = [8.0] * len(at)
        for i in range(len(at)):
            for j in range(i):
                x, y = at[i] - at[j], shift[i] - shift[j]
                if max(x, y) <= passages.FURTHEST:
                    new = min(8, x, y)
                    value[i] = max(value[i], value[j] + new - passages.GAP * (x + y - 2 * new))
        got = passages.chains(at, shift, 8)
        assert sum(len(c) for c in got) == len(at) and len(got[0]) > 1
        behind = [c for c in got if at[c[0]] >= first]
        assert max(map(len, behind)) >= 2 and at[max(behind, key=len)[0]] <= first + gap + 64
        assert value[got[0][-1]] == max(value)


def test_smaller_quoting_documents_hide_no_pair(spark):
    """What is found without the quoting documents is found with them."""
    pairs, quotes = [], []
    for k in range(40):
        words = prose(60, 5000 + k).split()
        pairs += [(1000 + 2 * k + d, " ".join([prose(30, 6000 + 2 * k + d), *words, prose(30, 7000 + 2 * k + d)]), "a") for d in (0, 1)]
        quotes += [(2 * k + d, " ".join([prose(40, 8000 + 2 * k + d), *words[30 * d : 30 * d + 30], prose(40, 9000 + 2 * k + d)]), "a") for d in (0, 1)]
    alone = {r.doc_id for r in passages.repeated_passages(frame(spark, pairs)).collect()}
    assert len(alone) > 70 and alone <= {r.doc_id for r in passages.repeated_passages(frame(spark, pairs + quotes)).collect()}


def test_lightly_edited_passages_share_seeds(spark):
    """Pairs that share 100 words of which each tenth is edited in one document: no exact run is longer than nine words."""
    rows = []
    for k in range(60):
        words = prose(100, 3000 + k)
        rows += [(2 * k + d, " ".join([prose(30, 40_000 + 2 * k + d), edited(words, 10, k) if d else words, prose(30, 50_000 + 2 * k + d)]), "a") for d in (0, 1)]
    rows += [(900 + k, prose(41, 60_000 + k), "a") for k in range(30)]  # of most no seed is shared
    got = {(r.doc_id, r.partner_id) for r in passages.repeated_passages(frame(spark, rows)).collect()}
    assert sum((2 * k, 2 * k + 1) in got or (2 * k + 1, 2 * k) in got for k in range(60)) >= 20


def test_short_verbatim_passages_stay():
    """Chains of a passage of LEAST verbatim words whose first seed is late and whose last is early, cut behind the last."""
    n, late = passages.LEAST, passages.UNSEEN
    words = np.arange(n, dtype="<u4")
    early = n - passages.SEED - late
    for known in (False, True):
        rows = [(30 + k, 50 + k, *[passages.pack(words[k:e], words[k - late : k] if known else None)] * 2) for k, e in ((late, late + 6), (late + 6, early), (early, early + 1))]
        first = 0 if known else late
        assert passages._passages(rows) == [(30 + first, 30 + early + passages.SEED, 50 + first, 50 + early + passages.SEED, early + passages.SEED - first)]
    # What ends behind the last seed is known to be short.
    short = [(k, k, passages.pack(words[k : k + 6], words[max(0, k - late) : k] if not k else None), passages.pack(np.append(words[k : k + 6], 99) if k < 12 else np.append(words[k : k + 6], [7, 7]), words[:0] if not k else None)) for k in (0, 6, 12)]
    short[-1] = (12, 12, passages.pack(words[12:30], None), passages.pack(np.append(words[12:20], [99] * 10), None))
    assert passages._passages(short) == []


def test_line_features_see_empty_documents():
    x, size, per_doc = quality.lines(pa.array(["", "A b.\n\nC d.", None]))
    assert per_doc.tolist() == [1, 2, 1] and len(x) == len(size) == 4


def test_one_identifier_with_two_texts_ties_its_groups(spark):
    a, b = prose(120, 700), prose(120, 701)
    rows = [(5, a, "a"), (7, a, "a"), (7, b, "a"), (9, b, "a"), (11, prose(50, 702), "a"), (None, a, "a"), (None, prose(60, 703), "a")]
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_join.jaccard_groups(frame(spark, rows)).collect())
    assert got == [(0, 0), (0, 5), (5, 5), (7, 5), (7, 5), (9, 5), (11, 11)]


def test_randomly_edited_passages(spark):
    """Shares of pairs found whose passage has words replaced at random: what the README states, less what chance may take."""
    r, rows, cases = random.Random(4), [], {}
    many = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    words = lambda n: [r.choice(many) for _ in range(n)]
    for n, share in ((60, 0.0), (100, 0.05), (100, 0.1), (200, 0.15)):
        for _ in range(60):
            p = words(n)
            q = [r.choice(many) if r.random() < share else x for x in p]
            rows += [(len(rows), " ".join(words(80) + p + words(80)), "a"), (len(rows) + 1, " ".join(words(60) + q + words(90)), "a")]
            cases[len(rows) - 2] = (n, share)
    got = {frozenset((x.doc_id, x.partner_id)) for x in passages.repeated_passages(frame(spark, rows)).collect()}
    found = {c: np.mean([frozenset((a, a + 1)) in got for a, x in cases.items() if x == c]) for c in set(cases.values())}
    assert found[60, 0.0] == 1.0 and found[100, 0.05] >= 0.9 and found[100, 0.1] >= 0.75 and found[200, 0.15] >= 0.9
