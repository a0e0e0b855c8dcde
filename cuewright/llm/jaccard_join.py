"""N-gram Jaccard join by T-occurrence search (DivideSkip), and the groups that its links form.

A document's set holds the hashes of its distinct word n-grams. Documents with one set are one class; classes are the
nodes of the join. Two sets of sizes a and b link when 100 * common >= P * union, that is, when at least
T = ceil(P * (a + b) / (100 + P)) n-grams are common.

DivideSkip parts a query's inverted lists into short ones, which are merged, and T - 1 long ones, which are only probed.
Here the parting is global: n-grams are ordered by their frequency over all documents (a fixed number of counters, so
approximate; any order is exact), and only a set's rarest n-grams, as many as must meet for any link, are posted to the
distributed lists. Documents that share a posted n-gram are candidates; their whole sets are then merged and probed.

Lists can be long where many documents are near copies. All pairs of a list are never made: first each member is tried
with its neighbours in size order and with the list's most central member, and verified links are contracted to
components. Then only members of different components meet, in classes of like sizes, and the smaller one only where the
n-gram stands early enough in its order. That loses no link that joins two components, so the groups are exact, whatever
the lists' lengths; many sets that share an early n-gram but do not link are still all compared.

Identity of n-grams and of sets is by 64-bit hashes.

Defined results: null, empty and blank texts have the empty set, link with nothing and are their own component; a text
with fewer words than n has one shingle, its whole sequence; rows that repeat an identifier with several texts tie their
sets together, as one document; rows without identifier are each their own document, and a component of such rows alone
has no name (null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import checkpointed, mix, slices, text_buffers, windows, word_hashes, word_spans
from .components import components

#: Words of a shingle, and the similarity in hundredths.
WORDS, SIMILAR = 5, 80
#: Bits of the frequency counters.
COUNTER_BITS = 22
#: Members of a list that are put in one size order, about; lists that seem longer are dealt in parts, so many at most.
ORDERED, MOST_HOT = 2000, 100_000
#: Of so many classes one tells long lists.
SAMPLED = 64
#: Bits of the filter that picks candidates' texts from the scan, at most (16 MB).
FILTER_BITS = 27


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    data, offsets = text_buffers(texts)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    every = windows(hashes, words)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(every[a : b - words + 1]))
        elif b > a:  # shorter texts: the whole sequence, apart from n-grams by its length
            out.append(mix(windows(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """64 bits that stand for a set, as a signed number."""
    return int((mix(s).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.uint64).view(np.int64)) if len(s) else 0


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def required(a: int, b: int, similar: int) -> int:
    """Common n-grams that a link between sets of these sizes needs."""
    return -(-similar * (a + b) // (100 + similar))


def divide_skip(query: np.ndarray, sets: list[np.ndarray], similar: int) -> list[bool]:
    """Which sets link with the query.

    The sets' numbers are posted to one list per query n-gram. The T - 1 longest lists are left out of the merge, so a
    set that is in none of the short ones cannot reach T; sets found there are probed in the long lists.
    """
    sizes = [len(s) for s in sets]
    needs = [required(len(query), n, similar) for n in sizes]
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(query, flat), max(len(query) - 1, 0))
    hit = np.flatnonzero(query[at] == flat) if len(query) else np.zeros(0, np.int64)
    token, owner = at[hit], np.repeat(np.arange(len(sets)), sizes)[hit]
    order = np.lexsort((owner, token))
    lists = [x.tolist() for x in np.split(owner[order], np.flatnonzero(np.diff(token[order])) + 1)] if len(hit) else []
    lists.sort(key=len)
    least = min(needs, default=1)
    long = max(0, min(len(lists), least - 1))
    short, long_lists = lists[: len(lists) - long], lists[len(lists) - long :]
    out = [False] * len(sets)
    for s, found in groupby(heapq.merge(*short)):
        count = sum(1 for _ in found)
        left = len(long_lists)
        for x in long_lists:
            if count >= needs[s] or count + left < needs[s]:
                break
            i = bisect_left(x, s)
            count += i < len(x) and x[i] == s
            left -= 1
        out[s] = count >= needs[s]
    return out


def _frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """Counts of n-grams by the first bits of their hashes, over all documents: 2 ** COUNTER_BITS numbers.

    Tasks send their counters in blocks of 16-bit numbers (a full one is sent more than once); blocks are added up where
    they meet, one array for each, however many tasks there are.
    """
    size = 1 << COUNTER_BITS
    block = min(size, 1 << 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                data, offsets = text_buffers(batch.column(0))
                starts, ends, first = word_spans(data, offsets)
                every = windows(word_hashes(data, starts, ends), words)
                inside = np.repeat(first[1:], np.diff(first))[: len(every)] - np.arange(len(every)) >= words
                total += np.bincount(bucket(every[inside]), minlength=size)
        while total.any():
            part = np.minimum(total, 65535)
            total -= part
            rows = part.astype("<u2").reshape(-1, block)
            there = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_pydict({"b": pa.array(there.astype(np.int32)), "n": pa.array([rows[i].tobytes() for i in there], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, n in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[b] = sums.get(b, 0) + np.frombuffer(n.as_buffer(), "<u2").astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict({"b": pa.array(list(sums), pa.int32()), "n": pa.array([np.minimum(x, 2**32 - 1).astype("<u4").tobytes() for x in sums.values()], pa.binary())})

    parts = docs.select("_text").mapInArrow(run, "b int, n binary").repartition("b")
    out = np.zeros(size, np.uint32)
    for r in parts.mapInArrow(add, "b int, n binary").collect():  # 16 MB at any input size
        out[r.b * block : (r.b + 1) * block] = np.frombuffer(r.n, "<u4")
    return out


def _prefix(s: np.ndarray, counts: np.ndarray, similar: int) -> np.ndarray:
    """The rarest n-grams of a set, as many as must meet for any link, rarest first."""
    keep = len(s) - -(-similar * len(s) // 100) + 1 if len(s) else 0
    return s[np.argsort(counts[bucket(s)], kind="stable")[:keep]].view(np.int64)


def _rows(docs: DataFrame, counts: Broadcast, words: int, similar: int) -> DataFrame:
    """_id, _h (its hash), n, cid (class), and of each SAMPLED-th class the prefix."""
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                sets = shingle_sets(batch.column(2), words)
                ids = [set_id(s) for s in sets]
                some = [_prefix(s, counts.value, similar) if i % SAMPLED == 0 else None for i, s in zip(ids, sets, strict=True)]
                columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), pa.array(some, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_h", "n", "cid", "prefix"])

    return docs.select("_id", F.xxhash64("_id").alias("_h"), "_text").mapInArrow(run, f"_id {kind}, _h long, n long, cid long, prefix array<long>")


def _postings(docs: DataFrame, counts: Broadcast, reps: DataFrame, words: int, similar: int) -> DataFrame:
    """tok, cid, np (n and the token's position, in 32 bits each) of representatives; where the filter lets a copy
    through, its postings repeat its class's."""
    filtered, bits = _filter(reps)
    shared = docs.sparkSession.sparkContext.broadcast(filtered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole.filter(pa.array(_passes(whole.column(0), shared.value, bits))), 1, 2 << 20):
                found = [(s, _prefix(s, counts.value, similar)) for s in shingle_sets(batch.column(1), words) if len(s)]
                if found:
                    sizes = [len(p) for _, p in found]
                    place = np.concatenate([np.arange(k) for k in sizes]) + (np.repeat([len(s) for s, _ in found], sizes) << 32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p for _, p in found])), pa.array(np.repeat([set_id(s) for s, _ in found], sizes)), pa.array(place)], ["tok", "cid", "np"])

    return docs.select(F.xxhash64("_id").alias("_h"), "_text").mapInArrow(run, "tok long, cid long, np long")


def _passes(keys: pa.Array, filtered: np.ndarray, bits: int) -> np.ndarray:
    key = keys.to_numpy().view(np.uint64) >> np.uint64(64 - bits)
    return ((filtered[(key >> np.uint64(6)).astype(np.int64)] >> (key & np.uint64(63))) & np.uint64(1)).astype(bool)


def _filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A bit filter of the column ``_h``, of bounded size; at worst it lets all through."""
    bits = min(FILTER_BITS, max(12, int(keys.count() * 16).bit_length()))
    words = keys.select(F.expr(f"shiftrightunsigned(_h, {64 - bits})").alias("k")).groupBy(F.shiftright("k", 6).cast("int").alias("w"))
    rows = words.agg(F.expr("bit_or(shiftleft(1L, int(k & 63)))").alias("m")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy().view(np.uint64)
    return out, bits


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cid, set of the classes whose representative's _h is in ``wanted``; only their texts are hashed and moved."""
    filtered, bits = _filter(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(filtered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole.filter(pa.array(_passes(whole.column(0), shared.value, bits))), 1):
                sets = shingle_sets(batch.column(1), words)
                yield pa.RecordBatch.from_pydict({"cid": pa.array(map(set_id, sets), pa.int64()), "set": pa.array([s.tobytes() for s in sets], pa.binary())})

    return docs.select(F.xxhash64("_id").alias("_h"), "_text").mapInArrow(run, "cid long, set binary").dropDuplicates(["cid"])


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, words: int, similar: int) -> DataFrame:
    """The pairs (u, v) that link."""
    wanted = reps.join(pairs.select(F.col("u").alias("cid")).union(pairs.select("v")).distinct(), "cid", "left_semi").select("cid", "_h")
    sets = checkpointed(_sets(docs, wanted, words).join(wanted.select("cid"), "cid", "left_semi"))
    whole = pairs.join(sets.select(F.col("cid").alias("v"), F.col("set").alias("_b")), "v")
    whole = whole.join(sets.select(F.col("cid").alias("u"), F.col("set").alias("_a")), "u").select("u", "v", "_a", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(u)) + 1
            keep = np.zeros(len(u), bool)
            for a, b in zip([0, *cuts], [*cuts, len(u)], strict=True):
                if b > a:
                    query = np.frombuffer(batch.column(2)[int(a)].as_buffer(), np.uint64)
                    keep[a:b] = divide_skip(query, [np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64) for i in range(int(a), int(b))], similar)
            yield pa.RecordBatch.from_pydict({"u": pa.array(u[keep]), "v": pa.array(v[keep])})

    return whole.mapInArrow(run, "u long, v long")


def _pairs(a: F.Column, b: F.Column) -> list[F.Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links)."""
    docs = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    counts = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, words))  # 16 MB at any input size
    rows = checkpointed(_rows(docs, counts, words, similar))
    reps = rows.filter("n > 0").groupBy("cid").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_h")).alias("first")).select("cid", "first._id", "first._h")
    reps = checkpointed(reps)

    # Tokens of long lists, told by each SAMPLED-th class, are dealt in parts and count as shared; the sample steers
    # only that. Of all other lists those stay that hold two classes.
    sampled = rows.filter("prefix IS NOT NULL").select("cid", F.explode("prefix").alias("hot")).distinct().groupBy("hot").agg(F.count("*").alias("c"))
    hot = sampled.filter(F.col("c") * SAMPLED >= ORDERED).orderBy(F.desc("c"), "hot").limit(MOST_HOT).select("hot", F.ceil(F.col("c") * SAMPLED / ORDERED).cast("int").alias("parts"))
    posted = _postings(docs, counts, reps, words, similar).join(F.broadcast(hot), F.col("tok") == F.col("hot"), "left")
    posted = posted.select("tok", "cid", "np", F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("cid"), F.col("parts")) + 1).otherwise(0).cast("int").alias("salt"))
    order = Window.partitionBy("tok", "salt").orderBy("np", "cid")
    before, behind = F.lag("cid").over(order), F.lead("cid").over(order)
    met = posted.select("tok", "cid", "np", F.col("salt"), before.alias("cid0"), F.lag("np").over(order).alias("np0"), behind.alias("cid1"))
    met = met.filter((F.col("cid0") != F.col("cid")) | (F.col("cid1") != F.col("cid")) | (F.col("salt") > 0))
    number = lambda c: F.shiftright(c, 32)
    place = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    met = checkpointed(met.select("tok", "cid", number("np").alias("n"), place("np").alias("pos"), "cid0", number("np0").alias("n0"), place("np0").alias("pos0")))
    lists = met.select("tok", "cid", "n", "pos")

    def fits(a: str, b: str) -> F.Column:
        """Lengths allow a link, and so do the n-grams from the common one on, if it is the pair's first common one."""
        na, nb, pa_, pb = (F.col(f"{x}.{y}") for y in ("n", "pos") for x in (a, b))
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * similar) & (F.least(na - pa_, nb - pb) * (100 + similar) >= similar * (na + nb))

    member = F.struct("pos", "n", "cid")
    hub = lists.groupBy("tok").agg(F.min(member).alias("b"))
    star = lists.select("tok", member.alias("a")).join(hub, "tok").filter((F.col("a.cid") != F.col("b.cid")) & fits("a", "b"))
    before = F.struct(F.col("pos0").alias("pos"), F.col("n0").alias("n"), F.col("cid0").alias("cid"))
    chain = met.filter("cid0 <> cid").select("tok", member.alias("a"), before.alias("b")).filter(fits("a", "b"))
    tried = checkpointed(star.union(chain).select(*_pairs(F.col("a.cid"), F.col("b.cid"))).distinct())
    # Sets that one identifier holds belong together like linked ones.
    named = rows.filter("n > 0 AND _id IS NOT NULL")
    least = named.groupBy("_id").agg(F.min("cid").alias("u"), F.max("cid").alias("v")).filter("u < v").select("_id", "u")
    same = named.select("_id", F.col("cid").alias("v")).join(least, "_id").filter("u <> v").select("u", "v").distinct()
    links = checkpointed(_verified(tried, docs, reps, words, similar).unionByName(same))
    found = components(links)

    # What is left: members of one list that lie in different components.
    apart = lists.join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = apart.groupBy("tok").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("tok")
    apart = checkpointed(apart.join(mixed, "tok", "left_semi").select("tok", "cid", "n", "pos", "root"))
    # Of a linked pair the smaller set has its first common n-gram so early that it could link with a set of its own size,
    # and the sizes lie in one class or in classes next to each other (a little wider than the similarity, for rounding).
    width = max(math.log(100 / similar), 1e-3) * (1 + 1e-9)
    apart = apart.withColumn("size", F.floor(F.log("n") / width).cast("int"))
    early = apart.filter((F.col("n") - F.col("pos")) * (100 + similar) >= 2 * similar * F.col("n")).withColumn("size", F.explode(F.array("size", F.col("size") + 1)))
    a, b = early.alias("a"), apart.alias("b")
    met = a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.n") <= F.col("b.n")) & (F.col("a.root") != F.col("b.root")) & fits("a", "b"))
    left = met.select(*_pairs(F.col("a.cid"), F.col("b.cid"))).distinct().join(tried, ["u", "v"], "left_anti")
    left = checkpointed(left)
    more = checkpointed(_verified(left, docs, reps, words, similar))
    if not more.isEmpty():
        names = found.withColumnRenamed("node", "u").withColumnRenamed("root", "ru")
        joined = more.join(names, "u", "left").join(names.select(F.col("u").alias("v"), F.col("ru").alias("rv")), "v", "left")
        above = components(joined.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")))
        every = found.union(above.select("node", F.col("node").alias("root"))).distinct()
        above = above.select(F.col("node").alias("root"), F.col("root").alias("up"))
        found = checkpointed(every.join(above, "root", "left").groupBy("node").agg(F.min(F.coalesce("up", "root")).alias("root")))

    named = reps.join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("_id").alias("component_id"))
    groups = named.join(least, "root").select("cid", "component_id")
    out = rows.filter("n > 0").select("_id", "n", "cid").join(groups, "cid").select("_id", "n", "component_id")
    alone = rows.filter("n = 0").select("_id", "n", F.col("_id").alias("component_id"))
    return out.unionByName(alone).select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """The whole rows of each group's smallest identifier; rows that repeat an identifier stay or go together, and rows
    without one stay."""
    groups = jaccard_groups(docs, id_col, text_col, words, similar)
    stay = groups.filter(F.col(id_col) == F.col("component_id")).select(id_col)
    gone = groups.filter(F.col(id_col) != F.col("component_id")).select(id_col).join(stay, id_col, "left_anti").distinct()
    return docs.join(gone, id_col, "left_anti")
