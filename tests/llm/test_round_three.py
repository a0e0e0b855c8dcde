"""Hard negatives, the tolerant as-of join and token files against brute force, on small tables with odd rows."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cuewright.llm import asof, hard_negatives, token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# Hard negatives


def brute_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    fine = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in fine:
        if is_anchor(i):
            anchors[i] = max(anchors.get(i, (lab, v)), (lab, v))
    out = set()
    for a, (lab, v) in anchors.items():
        scored = {(sum(x * y for x, y in zip(v, w, strict=False)), i, m == lab) for i, m, w in fine if i != a}
        near = sorted({(-s, i) for s, i, same in scored if same})[:positives]
        for p, i in near:
            some = sorted({(-s, j) for s, j, same in scored if not same and low * -p <= 100 * s <= high * -p})[:negatives]
            out |= {(a, i, rank, j, -p, -s) for rank, (s, j) in enumerate(some, 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in rows], "vec_id long, label int, embedding array<float>, _id string, rank int")


def mined(frame, every=10, **options):
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % every == 0, **options).collect()
    assert len(set(got)) == len(got)
    return {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got}


def test_hard_negatives_by_brute_force(spark):
    r = random.Random(4)
    rows = [(i, r.randrange(3), [r.choice([-0.5, 0.0, 0.25, 0.5]) + i % 7 / 256 for _ in range(6)]) for i in range(300)]  # many ties
    rows += [(1000, None, [1.0] * 6), (1001, 1, None), (1010, 1, [0.5, None, 0.5]), (1020, 1, [float("nan")] * 6), (1030, 2, [float("inf")] * 6), (None, 1, [0.5] * 6)]
    rows += [(1040, 1, []), (1050, 2, [0.5, 0.25]), (1060, 0, [0.5] * 9), (7, rows[7][1], rows[7][2]), (20, 1, [0.5] * 6), (13, 2, [0.25] * 6)]
    want = brute_negatives([(i, lab, [np.float32(x) if x is not None else None for x in v] if v is not None else None) for i, lab, v in rows], lambda i: i % 10 == 0)
    assert len(want) > 500
    assert mined(vectors(spark, rows)) == want
    assert mined(vectors(spark, rows).repartition(7), group_numbers=60) == want  # several groups of anchors, several tasks


def test_hard_negatives_beyond_float64(spark):
    rows = [(i, i % 2, [float(np.float32(2.0**18 * (i + 1) + i)), float(np.float32(3.0 * 2**17 - i)), 1.0 / (i + 1)]) for i in range(24)]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert want and max(abs(s) for *_, s, _ in want) > 2**53
    assert mined(vectors(spark, rows)) == want
    with pytest.raises(Exception, match="OverflowError"):
        mined(vectors(spark, [(0, 0, [1e30]), (1, 0, [1e30]), (2, 1, [1e30])]))


def test_hard_negatives_at_the_borders(spark):
    assert mined(vectors(spark, [])) == set()
    assert mined(vectors(spark, [(1, 1, [1.0]), (2, 1, [1.0])])) == set()  # no anchor
    assert mined(vectors(spark, [(0, 1, [1.0]), (2, 2, [0.5])])) == set()  # no positive
    few = [(0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.0]), (2, 2, [0.25, 0.0]), (3, 2, [-1.0, 0.0]), (4, 1, [-1.0, 0.0])]
    assert mined(vectors(spark, few)) == brute_negatives(few, lambda i: i % 10 == 0) == {(0, 1, 1, 2, 256 * 128, 256 * 64)}


# Tolerant as-of join


def brute_asof(left, right, tolerance):
    out = []
    low = lambda row: tuple((x is not None, x or 0) for x in row)  # noqa: E731  null loses
    for k, t, name in left:
        there = [(u, *rest) for kk, u, *rest in right if None not in (k, t, kk, u) and kk == k and t - tolerance <= u <= t]
        best = max(there, key=low, default=None)
        out.append((k, t, name, *(best[1:] if best else (None, None, None)), t - best[0] if best else None, sum(u[0] == best[0] for u in there) if best else 0))
    return out


@pytest.mark.parametrize(("chunk", "partitions"), [(64, 4), (3, 40)])
def test_asof_by_brute_force(spark, monkeypatch, chunk, partitions):
    monkeypatch.setattr(asof, "CHUNK", chunk)
    r = random.Random(chunk)
    key = lambda: r.choice([1] * 6 + [2, 3, 4, 5, None])  # noqa: E731  one key has most rows
    time = lambda: r.choice([None, 500, 500, *[r.randrange(1000)] * 8])  # noqa: E731  and one instant many
    left = [(key(), time(), f"n{i % 150}") for i in range(400)]
    right = [(key(), time(), r.choice([None, 1, 2]), r.choice([None, 5, 6, 7]), r.randrange(3)) for _ in range(300)]
    frame = spark.createDataFrame([(k, t, n, "a", "b") for k, t, n in left], "k int, t long, `_row` string, `_best` string, `a.b` string")
    other = spark.createDataFrame([(*x, "z") for x in right], "k int, u long, cents long, id long, more int, t string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for tolerance in (0, 30, 10_000):
            got = asof.asof_join(frame, other, "k", "t", "u", tolerance, ("cents", "id"), ("more",))
            assert got.columns == ["k", "t", "_row", "_best", "a.b", "cents", "id", "more", "lag", "n_tied"]
            got = [(*x[:3], *x[5:]) for x in got.collect()]
            assert sorted(map(str, got)) == sorted(map(str, brute_asof(left, right, tolerance)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_asof_at_the_borders(spark):
    left = spark.createDataFrame([(1, 5), (None, 5), (1, None), (1, 5)], "k int, t long")
    right = spark.createDataFrame([(1, 5, 9), (1, 5, None), (1, 6, 1)], "k int, u long, p int")
    got = sorted(map(tuple, asof.asof_join(left, right, "k", "t", "u", 10, ("p",)).collect()), key=str)
    assert got == sorted([(1, 5, 9, 0, 2), (1, 5, 9, 0, 2), (None, 5, None, None, 0), (1, None, None, None, 0)], key=str)
    assert {tuple(r)[2:] for r in asof.asof_join(left, right.limit(0), "k", "t", "u", 10, ("p",)).collect()} == {(None, None, 0)}
    assert asof.asof_join(left.limit(0), right, "k", "t", "u", 10, ("p",)).count() == 0


def test_orders_of_clicks_with_odd_rows(spark):
    clicks = spark.createDataFrame([(1, "2024-03-01 10:00:00", 5), (1, "2024-03-01 10:00:00", 5), (2, None, 5), (3, "2024-03-01 10:00:00", None), (None, "2024-03-01 10:00:00", 5)], "click_id long, ts string, client_id long")
    sales = spark.createDataFrame([(7, 5, "2024-02-20 09:00:00", 1.005, 2), (8, 5, "2024-02-20 09:00:00", float("nan"), None), (None, 5, "2024-02-20 09:00:00", float("inf"), 1), (9, None, "2024-02-20 09:00:00", 3.0, 1)], "sale_id long, client_id long, sold_at string, total double, priority int")
    got = asof.clicks_with_orders(spark, clicks.withColumn("ts", F.col("ts").cast("timestamp_ntz")), sales.withColumn("sold_at", F.col("sold_at").cast("timestamp_ntz"))).collect()
    assert sorted(str(r.click_id) for r in got) == ["1", "2", "3", "None"]
    floor = lambda i, us: us - us % (6 * 3600 * 10**6) if zlib.crc32(str(i if i is not None else "").encode()) % 2 else us
    sold = 1708419600 * 10**6
    orders = [(floor(i, sold), c, j) for i, c in ((7, 100), (8, None), (None, None)) for j in ([i, -1 - i] if i is not None and zlib.crc32(str(i).encode()) % 3 else [i])]
    for r in got:
        if r.click_id in (2, 3):
            assert (r.n_tied, r.sale_id, r.lag_us, r.total_cents) == (0, None, None, None)
        else:
            best = max(orders, key=lambda o: [(x is not None, x or 0) for x in o])
            assert (r.ts_us - r.lag_us, r.total_cents, r.sale_id, r.n_tied) == (*best, sum(o[0] == best[0] for o in orders))


# Token files


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("aA'sSdlmtrev \t\n\x0b\x1c\x85\xa0̀가 İẞ9½😀<|endoftext|>", max_size=80), max_size=6))
def test_words_encode_as_whole_texts(texts):
    whole = Tokenizer.from_file(WORD_BPE)
    model = test_words_encode_as_whole_texts.__dict__.setdefault("model", token_files.Encoder(WORD_BPE))
    texts = [*texts, "a<|endoftext|>b <|startoftext|>", "I'll it's 'S"]
    ids, first = model.encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_every_latin_character_and_other_files():
    whole, model = Tokenizer.from_file(WORD_BPE), token_files.Encoder(WORD_BPE)
    texts = [f"a{chr(c)}B 1{chr(c)}{chr(c)}'s {chr(c)}x" for c in range(0x600)] + ["\x01 \x1c\x1d a\x1fb", "Ⱥ İ ȾX Σας ς ¼½²x ªº µß÷×"]
    ids, first = model.encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, first = token_files.Encoder(path).encode([b"two  words", b"", b"x"])
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(["two  words", "", "x"], add_special_tokens=False)]


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files.Encoder, "KEPT", 5)
    model = token_files.Encoder(WORD_BPE)
    for t in ("hello world again", "other words", "hello world again"):
        ids, _ = model.encode([t.encode()])
        assert ids.tolist() == Tokenizer.from_file(WORD_BPE).encode(t, add_special_tokens=False).ids and len(model.words.known) <= 3


ROWS = [(5, "five words are in here"), (3, None), (4, ""), (4, "the same id again"), (4, "the same id again"), (None, "no id at all"), (-2, "x" * 70_000), (10**12, " ".join(f"w{i}" for i in range(60_000))), (6, " \t\n"), (7, "after the long one")]


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE", 50_000)
    docs = spark.createDataFrame([(t, i, "clash") for i, t in ROWS], "text string, doc_id long, ids string")
    path = f"file://{tmp_path}/out"
    token_files.write_token_files(docs, WORD_BPE, path)
    got = token_files.read_token_files(spark, path).collect()
    whole = Tokenizer.from_file(WORD_BPE)
    want = sorted((i is None, i or 0, [*whole.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in ROWS)
    ordered = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id is None, r.doc_id or 0) for r in ordered] == [w[:2] for w in want]
    assert sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    some = token_files.read_token_files(spark, path, [4, 7, 99]).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in got if r.doc_id in (4, 7))
    assert token_files.read_token_files(spark, path, [99]).count() == 0
    with pytest.raises(Exception, match="written already"):
        token_files.write_token_files(docs, WORD_BPE, path)
    digests = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in token_files.token_file_digests(docs, WORD_BPE).collect()}
    assert digests == {(r.doc_id, r.start): (r.n_tokens, zlib.crc32(r.ids)) for r in got}
    assert token_files.token_file_digests(docs.limit(0), WORD_BPE).count() == 0
    with pytest.raises(TypeError):
        token_files.write_token_files(docs.withColumn("doc_id", F.lit("a")), WORD_BPE, f"{path}2")


class Sink(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


def test_file_format(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME", 16)
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 4)
    r = random.Random(1)
    docs = [(i if i % 7 else None, np.array([r.randrange(2**32) for _ in range(r.choice([0, 1, 3, 16, 50]))], "<u4").tobytes()) for i in range(50)]
    out = Sink()
    writer = token_files.FileWriter(out)
    for d in docs:
        writer.add(*d)
    writer.close()
    data = out.data
    plain = b"".join(ids for _, ids in docs)
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == plain  # any decoder reads it
    reader = token_files.FileReader(io.BytesIO(data))
    assert [(i, ids) for i, _, ids in reader.documents()] == docs
    one = token_files.FileReader(io.BytesIO(data))
    [(i, place, ids)] = one.documents({24})
    assert (i, ids) == docs[24] and place == sum(len(x) for _, x in docs[:24]) // 4
    assert one.frames_read <= len(ids) // 64 + 2 < reader.frames_read  # only the frames it lies in
    damaged = bytearray(data)
    damaged[len(data) // 3] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FileReader(io.BytesIO(bytes(damaged))).documents())
    with pytest.raises(ValueError, match="seek table"):
        token_files.FileReader(io.BytesIO(data[:-1] + b"\0"))
    empty = Sink()
    token_files.FileWriter(empty).close()
    assert list(token_files.FileReader(io.BytesIO(empty.data)).documents()) == []
