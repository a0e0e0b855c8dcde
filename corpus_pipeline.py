"""The corpus pipeline: quality, exact dedup, near dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. All but the last return
the columns of documents: the quality classifier drops what it rejects, exact dedup keeps the first of equal texts, near
dedup one document of each group of similar texts, mixing repeats or drops documents so that sources reach their targets.
The last encodes every document that is left and decodes it again. Null and empty texts are empty documents to every
stage; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cuewright.llm._common import dropped, stored, table
from cuewright.llm._learn import fold
from cuewright.llm.bpe import bpe_round_trip
from cuewright.llm.exact_dedup import deduplicated
from cuewright.llm.jaccard_join import one_of_each_group
from cuewright.llm.mixing import mixed
from cuewright.llm.quality import good_only, train

#: SQL cannot express the first stage (a trained model), so the rows are tested against brute force instead.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field predicts good; labels of rows with crc32(doc_id) mod 5 = 0 are not learnt from."""
    return good_only(docs, train(docs, table(spark, sf_dir, "labels"), fold("_id", 5) != 0))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the row with the smallest doc_id; null counts as empty, empty texts are equal, rows
    without doc_id come last."""
    return deduplicated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles and a similarity of 0.8 the row with the smallest doc_id; texts without
    words link with nothing, rows that repeat a doc_id stay or go together, rows without one stay."""
    return one_of_each_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows 0 to 3 times, so that sources (null is one) reach their targets; texts without words go."""
    return mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document left: doc_id, n_tokens and the hashes of ids and decoded text; null has no tokens."""
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder and read again by the next, after
    which the stage before is removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, place = stored(stage(spark, docs, sf_dir))
        if before is not None:
            dropped(spark, before)
        before = place
    return STAGES[-1][1](spark, docs, sf_dir)
