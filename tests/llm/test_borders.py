"""Operators at their borders: enumeration of the line field, long words and texts, clashing names, directories without bits
left, two levels of partitions, and the SQL of this subpackage's queries."""

import base64
import itertools
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from cuewright.llm import bpe, exact_dedup, jaccard_join, mixing, neighbours, quality, queries, sharding
from tests.llm.test_operators import brute_groups, frame, prose

SF = "/root/testdata/sf0.001"


def test_marginals_by_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    for stretch in (1, 3, 512):
        monkeypatch.setattr(quality, "STRETCH", stretch)
        field = quality.Field(np.zeros(quality.FEATURES + 1), rng.normal(size=(2, 2)), np.zeros(4))
        sizes = [1, 7, 2, 5]
        score = rng.normal(size=sum(sizes))
        good, pairs = field.marginals(score, np.array(sizes), pairs=True)
        want, tied, at = [], np.zeros((2, 2)), 0
        for n in sizes:
            g, at = score[at : at + n], at + n
            weights = {y: np.exp(sum(g[i] * y[i] for i in range(n)) + sum(field.step[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=n)}
            z = sum(weights.values())
            want += [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)]
            for y, w in weights.items():
                for a, b in itertools.pairwise(y):
                    tied[a, b] += w / z
        assert np.allclose(good, want) and np.allclose(pairs, tied)


def test_lines_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["", "A b.\n\nC d.", None, "x y z " * 5000, "l1 w\n" * 3000 + "é 日本!", "\n", "one"])
    whole = quality.lines(texts)
    for piece in (50, 1000):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert all(np.array_equal(a, b) for a, b in zip(whole, quality.lines(texts), strict=True))
    assert whole[2].tolist() == [1, 2, 1, 1, 3001, 1, 1]


def test_a_million_lines():
    field = quality.Field(np.ones(quality.FEATURES + 1), np.eye(2), np.ones(4))
    assert 0 <= field.score(*quality.lines(pa.array(["a b\n" * 1_000_000])))[0] <= 1


def test_long_words(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    long = "".join(c for c in base64.b64encode(np.random.default_rng(1).bytes(900_000)).decode() if c.isalpha())
    texts = [long, "a" * 1001, "日本語" * 500, prose(200, 1)]
    assert len(long) > 900_000
    for size in (200, 4):
        monkeypatch.setattr(bpe, "LONG", size)
        own.clear()
        for t, x in zip(texts, own.encode(texts), strict=True):
            assert x.tolist() == library.encode(t, add_special_tokens=False).ids


def test_stages_take_any_column_names(spark):
    rows = [(1, "a b c", "s"), (2, "a  b c", "s"), (None, "a b c", "s"), (3, None, None), (None, prose(30, 1), "t"), (None, prose(30, 1), "t"), (4, prose(50, 2), "t")]
    docs = frame(spark, rows).withColumn("meta.url", F.lit("u")).withColumn("a`b", F.lit(1)).withColumn("_doc", F.lit(2))
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert sorted(str(r.doc_id) for r in exact_dedup.deduplicated(docs, hot_rows=1).collect()) == ["1", "3", "4", "None"]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and {r["meta.url"] for r in mixed.collect()} == {"u"}
    taken = sum(r.copies for r in mixing.mix_sources(docs).collect())
    assert mixed.count() == taken


def test_sharding_without_bits_left(spark):
    rows = [(i % 5, prose(20, i), "a") for i in range(200)] + [(7, "x" * 3000, "a"), (None, "y", "a")]
    for bits, limit in ((2, 500), (60, 500), (60, 2000)):
        got = sorted(map(str, sharding.shard(frame(spark, rows), limit=limit, bits=bits).collect()))
        assert got == sorted(map(str, sharding.shard(frame(spark, rows), limit=limit, bits=bits).collect()))
        found = sharding.shard(frame(spark, rows), limit=limit, bits=bits).collect()
        total = {}
        for r in found:
            total[r.shard] = total.get(r.shard, 0) + r.size_bytes
        assert len(found) == len(rows) and all(total[r.shard] == r.shard_bytes and (r.shard_bytes <= limit or r.size_bytes > limit) for r in found)


@pytest.mark.parametrize(("sf", "large"), [("0.01", neighbours.LARGE), ("0.01", 60), ("0.1", neighbours.LARGE), ("0.1", 150)])
def test_recall(spark, sf, large):
    t = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").withColumn("class", F.lit(1)).withColumn("v", F.lit(2))
    t = t.unionByName(t.filter("vec_id < 3"))
    data = t.dropDuplicates(["vec_id"]).toPandas()
    x = np.vstack(data.embedding.values).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, got = data.vec_id.to_numpy(), {}
    for r in neighbours.nearest_neighbours(t, F.col("vec_id") % 50 == 0, large=large).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    hit = 0
    for i in np.flatnonzero(ids % 50 == 0):
        near = x @ x[i]
        near[i] = -9
        assert sorted(k for k, _ in got[ids[i]]) == [1, 2, 3, 4, 5]
        hit += len({v for _, v in got[ids[i]]} & set(ids[np.lexsort((ids, -near.round(12)))[:5]].tolist()))
    assert hit >= 0.9 * 5 * (ids % 50 == 0).sum()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF).select(*names).collect()  # values as they are: pandas would turn numbers beside nulls into floats
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize(("words", "similar"), [(5, 80), (4, 85), (2, 50)])
def test_jaccard_shared_boilerplate(spark, words, similar):
    """Texts that are mostly one shared passage: some link by it, most do not, sizes lie at the borders of their classes."""
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(160)]
    rows = []
    for i in range(260):
        own = [f"w{rng.randrange(40)}" if i % 3 else f"u{i}x{k}" for k in range(rng.choice((4, 10, 16, 20, 26, 40, 160)))]
        rows.append((i, " ".join(own + shared[: rng.choice((160, 160, 128, 125, 100, 80))]), "a"))
    got = {r.doc_id: ([r.n_shingles], r.component_id) for r in jaccard_join.jaccard_groups(frame(spark, rows), words=words, similar=similar).collect()}
    assert got == brute_groups(rows, words, similar)
    assert 1 < len({root for _, root in got.values()}) < len(rows)
