"""Dictionaries: precedence merges, name mining, ranking, hint merges, and terminology in translated texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_text, word_pattern
from ..plans.registry import query, table
from ..sources.staging import CUES, cues


def precedence_union(*groups: DataFrame, key: str = "term") -> DataFrame:
    """SET3: entries of all groups, for each key the first of the first group that has it; ``reviewed`` = false goes."""
    tagged = [g.withColumn("_prio", F.lit(i)) for i, g in enumerate(groups)]
    every = tagged[0]
    for g in tagged[1:]:
        every = every.unionByName(g)
    every = every.filter(~F.col("reviewed").eqNullSafe(False) & (normalize_text(key) != ""))
    first = Window.partitionBy(F.lower(normalize_text(key))).orderBy("_prio", "ordinal")
    return every.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def _entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.col("p_type").alias("term"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey") % 3 != 0).alias("reviewed"))
    return part.filter("ordinal % 2 = 0"), part.filter("ordinal % 2 = 1").withColumn("term", F.lower("term"))


@query(
    "set3_term_precedence",
    """WITH p AS (SELECT p_partkey AS ordinal, p_type AS term, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 3 <> 0 END AS reviewed FROM part),
g AS (SELECT ordinal, term, reviewed, 0 AS prio FROM p WHERE ordinal % 2 = 0 UNION ALL SELECT ordinal, lower(term), reviewed, 1 FROM p WHERE ordinal % 2 = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(term)) ORDER BY prio, ordinal) AS n FROM g WHERE reviewed IS DISTINCT FROM false AND trim(term) <> '')
SELECT ordinal, term, prio::INTEGER AS prio FROM n WHERE n = 1""",
)
def set3_term_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return precedence_union(*_entries(spark, sf_dir)).select("ordinal", "term", F.col("_prio").alias("prio"))


@query(
    "set4_learn_new",
    """WITH p AS (SELECT p_partkey AS ordinal, p_name || p_brand AS term FROM part), have AS (SELECT DISTINCT lower(term) AS k FROM p WHERE ordinal % 7 = 0),
n AS (SELECT ordinal, term, row_number() OVER (PARTITION BY lower(term) ORDER BY ordinal) AS n FROM p WHERE lower(term) NOT IN (SELECT k FROM have)) SELECT ordinal, term FROM n WHERE n = 1""",
)
def set4_learn_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET4/SET5: new terms whose key the dictionary lacks, each once."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.concat("p_name", "p_brand").alias("term"), F.lower(F.concat("p_name", "p_brand")).alias("key"))
    new = part.join(part.filter("ordinal % 7 = 0").select("key").distinct(), "key", "left_anti")
    return new.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("ordinal"))).filter("_n = 1").select("ordinal", "term")


def name_candidates(frame: DataFrame, least: int = 2, most: int = 80) -> DataFrame:
    """AGG8: capitalised words and runs of two to four, once per row, by how many rows have them.

    Ranked by rows, words, then the name; grams are made by expressions and counted after a per-row distinct.
    """
    tokens = F.regexp_extract_all("text", F.lit(r"\b[A-Z][A-Za-z']+"), F.lit(0))
    grams = F.flatten(F.transform(F.array(*map(F.lit, (1, 2, 3, 4))), lambda n: F.when(
        F.size("tokens") >= n,
        F.transform(F.sequence(F.lit(0), F.size("tokens") - n), lambda i: F.array_join(F.slice("tokens", i + 1, n), " ")),
    ).otherwise(F.array().cast("array<string>"))))
    seen = frame.withColumn("tokens", tokens).select("stem", "seq", "text", F.explode(F.array_distinct(grams)).alias("name")).filter(F.expr("contains(text, name)"))
    counts = seen.groupBy(F.lower("name").alias("key")).agg(F.count_distinct("stem", "seq").alias("rows"), F.min("name").alias("name")).filter(F.col("rows") >= least)
    words = F.size(F.split("name", " "))
    return counts.select("name", "rows", words.alias("words")).orderBy(F.desc("rows"), F.desc("words"), F.lower("name")).limit(most)


@query(
    "agg8_name_candidates",
    rf"""WITH {CUES}, t AS (SELECT stem, seq, text, regexp_extract_all(text, '\b[A-Z][A-Za-z'']+') AS tokens FROM cues),
g AS (SELECT DISTINCT stem, seq, text, array_to_string(tokens[i:i + n - 1], ' ') AS name FROM t, range(1, 5) a(n), range(1, 2000) b(i) WHERE i + n - 1 <= len(tokens)),
c AS (SELECT lower(name) AS key, count(DISTINCT (stem, seq)) AS rows, min(name) AS name FROM g WHERE contains(text, name) GROUP BY 1 HAVING count(DISTINCT (stem, seq)) >= 2)
SELECT name, rows, len(string_split(name, ' '))::INTEGER AS words FROM c ORDER BY rows DESC, words DESC, lower(name) LIMIT 80""",
)
def agg8_name_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_candidates(cues(spark, sf_dir))


def merged_hints(hints: DataFrame) -> DataFrame:
    """AGG9: support adds up (99 at most), the first guidance that is there stays, confidence rises to high."""
    filled = F.min(F.when(F.col("guidance").isNotNull(), F.struct("ordinal", "guidance")))
    return hints.groupBy("key").agg(F.least(F.lit(99).cast("long"), F.sum("support")).alias("support"), filled["guidance"].alias("guidance"), F.bool_or("high").alias("high"))


@query(
    "agg9_hint_merge",
    """SELECT p_brand AS key, least(99, sum(p_size))::BIGINT AS support, arg_min(p_type, p_partkey) FILTER (WHERE p_partkey % 3 <> 0) AS guidance, bool_or(p_size > 45) AS high FROM part GROUP BY p_brand""",
)
def agg9_hint_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return merged_hints(part.select(F.col("p_brand").alias("key"), F.col("p_partkey").alias("ordinal"), F.col("p_size").cast("long").alias("support"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("guidance"), (F.col("p_size") > 45).alias("high")))


def top_guidance(items: DataFrame, k: int, *partition: str) -> DataFrame:
    """TOP1: by confidence, support and key length, all falling; ties keep their order."""
    order = Window.partitionBy(*partition).orderBy(F.desc("confidence"), F.desc("support"), F.desc(F.length("key")), "ordinal")
    return items.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


@query(
    "top1_guidance",
    """WITH i AS (SELECT p_brand AS brand, p_partkey AS ordinal, p_size % 3 AS confidence, p_size AS support, p_type AS key FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY confidence DESC, support DESC, length(key) DESC, ordinal) AS place FROM i) SELECT brand, ordinal, place::INTEGER AS place FROM n WHERE place <= 20""",
)
def top1_guidance(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("ordinal"), (F.col("p_size") % 3).alias("confidence"), F.col("p_size").alias("support"), F.col("p_type").alias("key"))
    return top_guidance(part, 20, "brand").select("brand", "ordinal", "place")


@query("top2_first_hints", "SELECT p_partkey AS ordinal, p_name AS key FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 24")
def top2_first_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 24 hints that match, in dictionary order."""
    hit = F.lower("p_name").contains("ring")
    return table(spark, sf_dir, "part").filter(hit).select(F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("key")).orderBy("ordinal").limit(24)


def canonical(c: Column | str, entries: Column | str) -> Column:
    """STR23: known variants become the preferred form, longest variant first, then by text, whole words only."""
    ordered = F.array_sort(F.col(entries) if isinstance(entries, str) else entries, lambda a, b: F.when(F.length(a["alias"]) > F.length(b["alias"]), -1).when(F.length(a["alias"]) < F.length(b["alias"]), 1).when(a["alias"] < b["alias"], -1).when(a["alias"] > b["alias"], 1).otherwise(0))
    start = F.col(c) if isinstance(c, str) else c
    return F.aggregate(ordered, start, lambda acc, e: F.regexp_replace(acc, word_pattern(e["alias"]), F.regexp_replace(e["preferred"], r"([\\$])", r"\\$1")))


def enforced(c: Column, fallback: Column, required: Column) -> Column:
    """STR24: the text, or the fallback if the text lacks a required term that the fallback has."""
    needs = F.filter(required, lambda t: fallback.contains(t))
    return F.when(F.forall(needs, lambda t: c.contains(t)), c).otherwise(fallback)


@query(
    "str23_canonical",
    rf"""WITH {CUES} SELECT stem, seq, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(^|[^0-9A-Za-z])[Oo]f\s+[Tt]he($|[^0-9A-Za-z])', '\1OFTHE\2', 'g'), '(^|[^0-9A-Za-z])[Oo]f\s+[Tt]he($|[^0-9A-Za-z])', '\1OFTHE\2', 'g'), '(^|[^0-9A-Za-z])[Tt]he($|[^0-9A-Za-z])', '\1THE\2', 'g'), '(^|[^0-9A-Za-z])[Tt]he($|[^0-9A-Za-z])', '\1THE\2', 'g')) AS changed FROM cues""",
)
def str23_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array(F.struct(F.lit("the").alias("alias"), F.lit("THE").alias("preferred")), F.struct(F.lit("of the").alias("alias"), F.lit("OFTHE").alias("preferred")))
    return cues(spark, sf_dir).select("stem", "seq", F.md5(canonical("text", entries).cast("binary")).alias("changed"))


@query(
    "str24_enforced",
    f"""WITH {CUES}, w AS (SELECT stem, seq, text, coalesce(lag(text) OVER (PARTITION BY stem ORDER BY seq), '') AS b FROM cues)
SELECT stem, seq, CASE WHEN (contains(b, 'the') AND NOT contains(text, 'the')) OR (contains(b, 'in') AND NOT contains(text, 'in')) THEN b ELSE text END AS kept FROM w""",
)
def str24_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.coalesce(F.lag("text").over(Window.partitionBy("stem").orderBy("seq")), F.lit(""))
    frame = cues(spark, sf_dir).withColumn("b", before)
    return frame.select("stem", "seq", enforced(F.col("text"), F.col("b"), F.array(F.lit("the"), F.lit("in"))).alias("kept"))
