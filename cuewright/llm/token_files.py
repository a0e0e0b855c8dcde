"""Token ids in binary files of independent zstandard frames, with a seek table and a checksum for each frame.

A file holds the ids of documents one after the other as little-endian unsigned 32-bit integers, cut into frames of
``FRAME`` ids that are compressed each by itself. A block of documents is followed by a skippable frame that lists them
(identifier, number of ids), and the file ends with the seek table of the public seekable zstandard format: compressed
and plain size of each frame and the low 32 bits of the XXH64 of its plain bytes. So any zstandard decoder gives the plain
array of ids, and a reader that looks for a document decompresses only the frames it lies in, and checks each.

``TokenFiles`` is a data source: ``df.write.format("token_files").mode("append").save(path)`` takes rows (doc_id long, ids
binary) in the order of their partitions, ``spark.read.format("token_files").load(path)`` gives (doc_id, start, n_tokens,
ids) with start counted over all files; its option doc_ids ("3,5") names the documents to read, and then only the files and
frames they lie in are. Files get names of their own for each try of a task; a manifest that lists them is written when
all tasks have ended, and only listed files are read, so lost or repeated tasks leave nothing that counts. A path is
written once: a second write raises an error.

``encoded`` makes the ids. White space ends every pre-token of the vocabulary file's tokenizer and no normaliser joins
anything across it, so each distinct word between ASCII white space is encoded once and looked up after that; the ids are
those that the library gives for the whole text.

Defined results: a null or empty text has the end id only; rows without a doc_id come last; rows that repeat a doc_id are
documents each, ordered by a hash of the text and then as the table is read; an empty table gives files without frames
and no rows; other columns are ignored. A frame whose checksum or size is wrong raises an error, as does a doc_id that is
no whole number.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ._common import checkpoint_folder, partitions, slices
from .bpe import byte_symbols, gather

#: Ids in a frame; ids and documents in a block; ids in a file, about; bytes of text in a range, about.
FRAME, BLOCK_IDS, BLOCK_DOCS, FILE, RANGE = 1 << 16, 1 << 22, 1 << 14, 1 << 26, 1 << 26
# Fixed values of the seekable zstandard format: the marks of a skippable frame (the listing's and the seek table's) and
# of the table's end, and the flag that each entry has a checksum.
LISTING, TABLE, END, CHECKED = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "_manifest.parquet"
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
FIELDS = pa.schema([("file", pa.string()), ("place", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()), ("least", pa.int64()), ("most", pa.int64())])


def check(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """One file; documents are added in order."""

    def __init__(self, out, level: int = 3):
        self.out, self.zstd = out, zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []  # plain bytes that are in no frame yet
        self.size = 0
        self.listed: list[tuple[int | None, int]] = []
        self.block = self.docs = self.tokens = 0
        self.least: int | None = None
        self.most: int | None = None

    def add(self, doc_id: int | None, ids: bytes) -> None:
        view = memoryview(ids)
        while len(view):
            part = view[: 4 * FRAME - self.size]
            self.held.append(bytes(part))
            self.size += len(part)
            view = view[len(part) :]
            if self.size == 4 * FRAME:
                self.frame()
        n = len(ids) // 4
        self.listed.append((doc_id, n))
        self.block, self.docs, self.tokens = self.block + n, self.docs + 1, self.tokens + n
        if doc_id is not None:
            self.least = doc_id if self.least is None else min(self.least, doc_id)
            self.most = doc_id if self.most is None else max(self.most, doc_id)
        if self.block >= BLOCK_IDS or len(self.listed) >= BLOCK_DOCS:
            self.end_block()

    def frame(self) -> None:
        if self.size:
            plain = b"".join(self.held)
            packed = self.zstd.compress(plain)
            self.out.write(packed)
            self.entries.append((len(packed), len(plain), check(plain)))
            self.held, self.size = [], 0

    def end_block(self) -> None:
        self.frame()
        if self.listed:
            there = np.array([i is not None for i, _ in self.listed], np.uint8)
            ids = np.array([i or 0 for i, _ in self.listed], "<i8")
            plain = there.tobytes() + ids.tobytes() + np.array([n for _, n in self.listed], "<i8").tobytes()
            packed = self.zstd.compress(struct.pack("<I", check(plain)) + plain)
            self.out.write(struct.pack("<II", LISTING, len(packed)) + packed)
            self.entries.append((8 + len(packed), 0, check(b"")))
            self.listed, self.block = [], 0

    def close(self) -> None:
        self.end_block()
        rows = b"".join(struct.pack("<III", *e) for e in self.entries)
        foot = struct.pack("<IBI", len(self.entries), CHECKED, END)
        self.out.write(struct.pack("<II", TABLE, len(rows) + len(foot)) + rows + foot)
        self.out.close()


class FileReader:
    """One file: its seek table, and documents read front to back or by identifier."""

    def __init__(self, source):
        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        self.frames_read = 0
        size = source.seek(0, io.SEEK_END) or source.tell()
        n, flag, end = struct.unpack("<IBI", self._at(size - 9, 9))
        if end != END or flag != CHECKED:
            raise ValueError("no seek table with checksums at the end of the file")
        mark, length = struct.unpack("<II", self._at(size - 17 - 12 * n, 8))
        if (mark, length) != (TABLE, 12 * n + 9):
            raise ValueError("the seek table has a wrong length")
        self.table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.plain = np.concatenate([[0], np.cumsum(self.table[:, 1])])
        if self.places[-1] != size - 17 - 12 * n:
            raise ValueError("the frames do not end where the seek table begins")

    def _at(self, place: int, length: int) -> bytes:
        self.source.seek(place)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        packed, size, want = self.table[k]
        plain = self.zstd.decompress(self._at(int(self.places[k]), int(packed)), max_output_size=int(size))
        if len(plain) != size or check(plain) != want:
            raise ValueError(f"frame {k} is damaged")
        self.frames_read += 1
        return plain

    def listing(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the documents of a block: whether they have an identifier, the identifiers, and numbers of ids."""
        mark, length = struct.unpack("<II", self._at(int(self.places[k]), 8))
        if mark != LISTING or length + 8 != self.table[k, 0]:
            raise ValueError(f"frame {k} is no listing")
        plain = self.zstd.decompress(self._at(int(self.places[k]) + 8, length))
        if check(plain[4:]) != struct.unpack("<I", plain[:4])[0]:
            raise ValueError(f"frame {k} is damaged")
        n = (len(plain) - 4) // 17
        return np.frombuffer(plain, np.uint8, n, 4) > 0, np.frombuffer(plain, "<i8", n, 4 + n), np.frombuffer(plain, "<i8", n, 4 + 9 * n)

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """Identifier, first id's place in the file, and ids; of ``wanted`` only, if given. A block at a time is held."""
        begin = 0
        for k in np.flatnonzero(self.table[:, 1] == 0):
            there, ids, sizes = self.listing(int(k))
            ends = begin + np.cumsum(sizes)
            chosen = np.arange(len(ids)) if wanted is None else np.flatnonzero(there & np.isin(ids, np.fromiter(wanted, np.int64, len(wanted))))
            kept: dict[int, bytes] = {}
            for i in chosen.tolist():
                low, high = 4 * int(ends[i] - sizes[i]), 4 * int(ends[i])
                first = int(np.searchsorted(self.plain, low, "right")) - 1
                stop = int(np.searchsorted(self.plain, high, "left")) if high > low else first
                frames = [f for f in range(first, stop) if self.table[f, 1]]
                kept = {f: kept[f] if f in kept else self.frame(f) for f in frames} or kept
                data = b"".join(kept[f] for f in frames)
                offset = low - int(self.plain[frames[0]]) if frames else 0
                yield (int(ids[i]) if there[i] else None), low // 4, data[offset : offset + high - low]
            begin = int(ends[-1]) if len(ends) else begin


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple] = field(default_factory=list)


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path
        fs, at = pa.fs.FileSystem.from_uri(path)
        if fs.get_file_info(f"{at}/{MANIFEST}").type != pa.fs.FileType.NotFound:
            raise ValueError(f"{path} has been written already")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = pa.fs.FileSystem.from_uri(self.path)
        fs.create_dir(at, recursive=True)
        part, out, done = TaskContext.get().partitionId(), None, Written()

        def end() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.files.append((name, part << 32 | len(done.files), out.docs, out.tokens, out.least, out.most))
            out = None

        for batch in iterator:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    name = f"part-{part:06d}-{len(done.files):04d}-{uuid.uuid4().hex}.tok.zst"
                    out = FileWriter(fs.open_output_stream(f"{at}/{name}", compression=None))
                out.add(doc_id, ids.as_buffer().to_pybytes() if ids.is_valid else b"")
                if out.tokens >= FILE:
                    end()
        end()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        files = sorted((f for m in messages if m is not None for f in m.files), key=lambda f: f[1])
        fs, at = pa.fs.FileSystem.from_uri(self.path)
        fs.create_dir(at, recursive=True)
        table = pa.Table.from_pydict({n: [f[i] for f in files] for i, n in enumerate(FIELDS.names)}, schema=FIELDS)
        pq.write_table(table, f"{at}/{MANIFEST}", filesystem=fs)

    def abort(self, messages: list[Written | None]) -> None:
        fs, at = pa.fs.FileSystem.from_uri(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                fs.delete_file(f"{at}/{f[0]}")


@dataclass
class Part(InputPartition):
    file: str
    start: int


class TokenReader(DataSourceReader):
    def __init__(self, path: str, wanted: set[int] | None):
        self.path, self.wanted = path, wanted

    def partitions(self) -> Sequence[Part]:
        fs, at = pa.fs.FileSystem.from_uri(self.path)
        start, out = 0, []
        for f in pq.read_table(f"{at}/{MANIFEST}", filesystem=fs).to_pylist():
            if self.wanted is None or (f["least"] is not None and any(f["least"] <= i <= f["most"] for i in self.wanted)):
                out.append(Part(f["file"], start))
            start += f["tokens"]
        return out or [Part("", 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, at = pa.fs.FileSystem.from_uri(self.path)
        with fs.open_input_file(f"{at}/{partition.file}") as source:
            rows, size = [], 0
            for doc_id, start, ids in FileReader(source).documents(self.wanted):
                rows.append((doc_id, partition.start + start, len(ids) // 4, ids))
                size += len(ids) + 32
                if size >= 1 << 22:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(("doc_id", "start", "n_tokens", "ids"), types, strict=True))})


class TokenFiles(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TokenReader:
        ids = self.options.get("doc_ids")
        return TokenReader(self.options["path"], None if ids is None else {int(i) for i in ids.split(",") if i.strip()})

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        if [f.dataType.simpleString() for f in schema.fields] != ["bigint", "binary"]:
            raise TypeError("rows are (doc_id long, ids binary)")
        return TokenWriter(self.options["path"])


# Fixed values of the tokenizer file format: how a file says that it puts characters together, makes white space one blank
# and lowers, then takes contractions, runs of letters, single numbers and runs of others, byte by byte.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPLIT = {"type": "Split", "pattern": {"Regex": CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
SPLITTER = {"type": "Sequence", "pretokenizers": [SPLIT, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Characters below U+0180 (Latin) that stand for themselves in NFC, lower to one of their kind, and are no white space; and of
#: the lowered ones the letters and the numbers.
LATIN = re.compile("[\x00-\x08\x0e-\x1f!-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]*")
LETTERS, NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(f"\n|{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^\n{LETTERS}{NUMBERS}]+")


class Encoder:
    """A tokenizer file, and the ids of the words met so far: at most ``KEPT`` bytes of words.

    Where the file splits as ``SPLITTER`` says, words of Latin letters are parted here and the library merges each distinct
    part once; other words go through the library whole. Any other file encodes whole texts.
    """

    KEPT = 1 << 25

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        model, added = spec["model"], spec.get("added_tokens") or []
        plain = model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        self.by_words = plain and spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == SPLITTER and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if self.by_words:
            self.specials = [t["content"] for t in added]
            self.merges = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "truncation": None, "padding": None}))
            self.last = np.zeros(max(model["vocab"].values()) + 1, bool)
            self.last[[i for t, i in model["vocab"].items() if t.endswith("</w>")]] = True
            self.symbols = {b: c for c, b in byte_symbols().items() if b != 32}  # a blank parts the words
        self.clear()

    def clear(self) -> None:
        self.words, self.parts = Table(), Table()
        self.parts.learn(["\n"], np.zeros(0, np.uint32), [0])

    def learn_parts(self, parts: list[str]) -> None:
        lines = [" ".join(parts[i : i + 512]).encode().decode("latin-1").translate(self.symbols) for i in range(0, len(parts), 512)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.merges.encode_batch_fast(lines, add_special_tokens=False)), np.uint32)
        self.parts.learn(parts, ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))

    def learn_words(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        latin = [LATIN.fullmatch(t) is not None for t in texts]
        if any(x in t for t in ["\n".join(texts)] for x in self.specials):
            latin = [x and not any(s in t for s in self.specials) for x, t in zip(latin, texts, strict=True)]
        parts = PARTS.findall("\n".join([*compress(texts, latin), ""]).lower())
        rows = self.parts.rows(parts, self.learn_parts)
        ids, first = self.parts.gather(rows)
        ends = np.flatnonzero(rows == 0)  # the row of a line's end
        self.words.learn(list(compress(words, latin)), ids, np.diff(first[ends], prepend=0))
        odd = [not x for x in latin]
        found = [e.ids for e in self.whole.encode_batch_fast(list(compress(texts, odd)), add_special_tokens=False)]
        self.words.learn(list(compress(words, odd)), np.fromiter(chain.from_iterable(found), np.uint32), [len(x) for x in found])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and each text's first one (n + 1 values)."""
        if not self.by_words:
            found = [e.ids for e in self.whole.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        if self.words.bytes > self.KEPT:
            self.clear()
        words = [t.split() for t in texts]  # of bytes: at the six ASCII white-space characters
        ids, first = self.words.gather(self.words.rows(list(chain.from_iterable(words)), self.learn_words))
        return ids, first[np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)]


class Table:
    """Pieces of text, each with a row of ids."""

    def __init__(self):
        self.known: dict = {}
        self.bytes = 0
        self.flat, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, pieces: list, ids: np.ndarray, sizes: Sequence[int]) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.bytes += sum(map(len, pieces))
        self.flat = np.concatenate([self.flat, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.asarray(sizes, np.int64))])

    def rows(self, pieces: list, learn: Callable[[list], None]) -> np.ndarray:
        """The row of each piece; ``learn`` gets those that are new, once each."""
        rows = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(rows < 0).tolist()
        if new:
            learn(list({pieces[i]: None for i in new}))
            rows[new] = [self.known[pieces[i]] for i in new]
        return rows

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows one after the other, and where each row begins (n + 1 values)."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        return gather(self.flat, self.bounds[rows], sizes), np.concatenate([[0], np.cumsum(sizes)])


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers), in the order of the rows; ``end_id`` ends each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Encoder(path)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        for whole in batches:
            for batch in slices(whole, 1):
                ids, first = model.encode([t.encode() if t else b"" for t in batch.column(1).to_pylist()])
                data = ids.astype("<u4").tobytes()
                out = [data[4 * a : 4 * b] + end for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "ids": pa.array(out, pa.binary())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1) -> None:
    """Encode documents and write them in ascending order of their identifiers."""
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("identifiers are whole numbers")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    # Ties of the identifier are told apart by the text, and equal rows by where they are read: no range is one key.
    dealt = rows.select("_id", "_text", F.xxhash64("_text").alias("_tie"), F.monotonically_increasing_id().alias("_at"))
    order = [F.col("_id").asc_nulls_last(), "_tie", "_at"]
    dealt = dealt.repartitionByRange(max(partitions(docs), size // RANGE), *order).sortWithinPartitions(*order)
    docs.sparkSession.dataSource.register(TokenFiles)
    encoded(dealt, tokenizer, "_id", "_text", end_id).write.format("token_files").mode("append").save(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids of the documents in the files, or of ``doc_ids`` only."""
    spark.dataSource.register(TokenFiles)
    reader = spark.read.format("token_files")
    return (reader if doc_ids is None else reader.option("doc_ids", ",".join(map(str, doc_ids)))).load(path)


def token_file_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, as the files in the shared folder give them."""
    spark = docs.sparkSession
    path = f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
