"""What the operators share: table access, checkpoints, and numpy word hashing over Arrow buffers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: One run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: An odd multiplier of the polynomial word hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text whose words are hashed at once; it bounds the temporary arrays of a task.
BLOCK = 1 << 18


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared folder. Where none is set, a session on one machine (tests) gets one; others raise an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "cuewright-checkpoints"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder of the session."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """Cut the lineage through a compressed table in the shared folder; with the table's place, for ``dropped``."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove what ``stored`` has written and nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as Spark reads it whole, whatever dots and ticks are in it."""
    return "`" + name.replace("`", "``") + "`"


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64 (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the index of its first word (n + 1 values)."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z; temporary arrays follow BLOCK and the longest word, not the text."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
        part = data[low : ends[stop - 1]].astype(np.uint64)
        if lower:
            part += np.uint64(32) * ((part >= 65) & (part <= 90))
        powers = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * powers[0][: len(part)], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = mix((sums[e] - sums[s]) * powers[1][s] + (e - s).astype(np.uint64))
        at = stop
    return out


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, BLOCK + 4096)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (_BASE, _INVERSE)]
    return _POWERS


def slices(batch: pa.RecordBatch, text: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each; a document is never split."""
    _, offsets = text_buffers(batch.column(text))
    at = 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Order-dependent hashes of each k consecutive words."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + hashes[i : i + max(n, 0)]
    return mix(out)
