"""Streams with keyed state: cut into files, stopped and started again, they give what the batch operators give."""

import random

import pytest
from pyspark.sql import functions as F

from cuewright.operators.dedupe import merged_detections
from cuewright.streaming.groups import grouped_detections, latest_groups, sliding_first, stateful
from cuewright.streaming.streams import completed

SCHEMA = "stem long, seq long, start_ms long, end_ms long, text string, confidence double, x double, y double"


def rows(n, seed):
    r = random.Random(seed)
    out, now = [], 0
    for i in range(n):
        now += r.choice([0, 50, 100, 300, 900])
        text = r.choice(["", "stop", "Stop sign", "exit", "the exit", "EXIT now", "bar", None] + [f"word{k} here" for k in range(6)])
        out.append((r.randrange(3), i, now, now + r.choice([200, 500, 900]), text, r.random(), r.choice([0.0, 100.0, 600.0]), float(r.randrange(50))))
    return out


def write(spark, part, folder, number):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/part{number:03d}")


def plain(frame):
    return sorted((r.stem, r.group_id, r.start_ms, r.end_ms, r.text, round(r.confidence, 12), r.n) for r in frame.collect())


@pytest.fixture(scope="module")
def detected():
    return rows(400, 7)


def test_groups_cut_and_restarted(spark, tmp_path, detected):
    folder, place = f"{tmp_path}/in", f"{tmp_path}/run"
    want = plain(merged_detections(spark.createDataFrame(detected, SCHEMA).withColumn("text", F.coalesce("text", F.lit("")))))
    assert len(want) < 370 and max(w[-1] for w in want) > 2

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
        with stateful(spark):
            return completed(spark, grouped_detections(stream), "append", place)

    for k in range(4):
        write(spark, detected[k * 60 : (k + 1) * 60], folder, k)
    first = plain(latest_groups(run()))
    assert first == plain(merged_detections(spark.createDataFrame(detected[:240], SCHEMA).withColumn("text", F.coalesce("text", F.lit("")))))
    for k in range(4, 7):  # the query is gone; it goes on from its checkpoint
        write(spark, detected[k * 60 : (k + 1) * 60], folder, k)
    done = run()
    assert plain(latest_groups(done)) == want
    again = latest_groups(done.unionByName(done.limit(50)))  # rows that a restart repeats
    assert plain(again) == want
    last = done.groupBy("stem", "group_id").agg(F.max("n").alias("n"), F.max(F.when(F.col("closed"), F.col("n"))).alias("m"))
    assert last.filter("m < n").isEmpty()  # what is closed never changes again


def test_group_state_is_bounded(spark, tmp_path):
    folder, place = f"{tmp_path}/in", f"{tmp_path}/run"
    many = [(1, i, i * 100, i * 100 + 50, f"unlike{i:04d}", 0.5, 0.0, 0.0) for i in range(300)]
    late = [(2, 1000, 10**7, 10**7 + 50, "much later", 0.5, 0.0, 0.0)]
    later = [(2, 1001, 10**7 + 10, 10**7 + 60, "much later", 0.5, 0.0, 0.0)]
    for k, part in enumerate((many[:150], many[150:], late, later)):
        write(spark, part, folder, k)
        with stateful(spark):
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
            done = completed(spark, grouped_detections(stream), "append", place)
            state = spark.read.format("statestore").option("stateVarName", "open").load(f"{place}/state")
            held = {r.stem: r.n for r in state.select(F.col("key.stem").alias("stem"), F.lit(1).alias("one")).groupBy("stem").agg(F.sum("one").alias("n")).collect()}
        assert all(n <= 20 for n in held.values())
    assert 1 not in held  # the timer has closed what the watermark left behind
    table = latest_groups(done)
    assert table.filter("stem = 1").count() == 300 and table.filter("stem = 1 and not closed").count() == 0
    assert [(r.n, r.start_ms) for r in table.filter("stem = 2").collect()] == [(2, 10**7)]


def test_sliding_first(spark, tmp_path, detected):
    folder = f"{tmp_path}/in"
    marks = [(stem, text or "", seq, start * 20) for stem, seq, start, _, text, *_ in detected]
    last, want = {}, []
    for stem, key, seq, at in sorted(marks, key=lambda m: (m[3], m[2])):
        if (stem, key) not in last or at - last[stem, key] > 20_000:
            last[stem, key] = at
            want.append((stem, key, seq, at))
    for k in range(4):
        spark.createDataFrame(marks[k * 100 : (k + 1) * 100], "stem long, key string, seq long, at_ms long").coalesce(1).write.parquet(f"{folder}/part{k}")
    stream = spark.readStream.schema("stem long, key string, seq long, at_ms long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    with stateful(spark):
        got = completed(spark, sliding_first(stream), "append", f"{tmp_path}/run")
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) < 400
