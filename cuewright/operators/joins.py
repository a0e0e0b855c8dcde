"""Interval, pair, dictionary and override joins.

The equality key is always the stem. Interval joins add time buckets to it: both sides are spread over the buckets that
they touch and a pair is kept in the later one of its first buckets only, so no pair is made twice and none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import compare_key, folded, longest_piece, normalize_text, pieces, text_key, word_pattern
from ..functions.values import digest, overlap
from ..plans.registry import query, table
from ..sources.staging import CUES, LINES, cues, lines
from .dedupe import text_ratio


def interval_join(left: DataFrame, right: DataFrame, reach: int = 0, bucket: int = 1000, key: str = "stem") -> DataFrame:
    """Pairs of one key whose intervals, widened by ``reach``, meet. Columns of the right side get the prefix r_."""
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    first = lambda s: F.floor((s - reach) / bucket)
    last = lambda e: F.floor((e + reach) / bucket)
    a = left.withColumn("_b", F.explode(F.sequence(first(F.col("start_cs")), last(F.col("end_cs"))))).withColumn("_first", first(F.col("start_cs")))
    b = r.withColumn("_rb", F.explode(F.sequence(F.floor(F.col("r_start_cs") / bucket), F.floor(F.col("r_end_cs") / bucket)))).withColumn("_rfirst", F.floor(F.col("r_start_cs") / bucket))
    met = a.join(
        b,
        (F.col(key) == F.col(f"r_{key}"))
        & (F.col("_b") == F.col("_rb"))
        & (F.col("_b") == F.greatest("_first", "_rfirst"))
        & (F.col("start_cs") - reach <= F.col("r_end_cs"))
        & (F.col("r_start_cs") <= F.col("end_cs") + reach),
    )
    return met.drop("_b", "_first", "_rb", "_rfirst")


@query(
    "join1_interval_pairs",
    f"""WITH {CUES} SELECT a.stem, a.seq, b.seq AS r_seq, greatest(0, least(a.end_cs, b.end_cs) - greatest(a.start_cs, b.start_cs))::BIGINT AS overlap_cs
FROM cues a JOIN cues b ON a.stem = b.stem AND a.seq < b.seq AND a.start_cs <= b.end_cs AND b.start_cs <= a.end_cs""",
)
def join1_interval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cues(spark, sf_dir)
    met = interval_join(c, c).filter("seq < r_seq")
    return met.select("stem", "seq", "r_seq", overlap(F.col("start_cs"), F.col("end_cs"), F.col("r_start_cs"), F.col("r_end_cs")).alias("overlap_cs"))


def attach_labels(left: DataFrame, right: DataFrame, label: str, least: int = 8, near: int = 125, similar: float = 0.82) -> DataFrame:
    """JOIN2: labels of the right side that overlap by ``least``, or lie within ``near`` and read alike.

    Only pairs that the overlap does not settle and whose lengths allow the similarity hand their keys to the comparison.
    """
    met = interval_join(left, right, reach=near).withColumns({"_a": compare_key("text"), "_b": compare_key("r_text")})
    common = overlap(F.col("start_cs"), F.col("end_cs"), F.col("r_start_cs"), F.col("r_end_cs"))
    short, both = F.least(F.length("_a"), F.length("_b")), F.length("_a") + F.length("_b")
    asked = (common < least) & (short * 2 >= both * similar)
    hit = met.withColumn("_alike", text_ratio(F.when(asked, F.col("_a")), F.when(asked, F.col("_b")))).filter((common >= least) | (F.col("_alike") >= similar))
    found = hit.groupBy("stem", "seq").agg(F.sort_array(F.collect_set(f"r_{label}")).alias("labels"))
    return left.join(found, ["stem", "seq"], "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


@query(
    "join2_attach_labels",
    rf"""WITH {CUES}, k AS (SELECT *, md5(stem || '-' || seq // 6) AS slot, seq % 6 AS z FROM cues),
l AS (SELECT * FROM k WHERE speaker = 'user'), r AS (SELECT * FROM k WHERE speaker <> 'user'),
h AS (SELECT DISTINCT l.stem, l.seq, r.speaker FROM l JOIN r ON l.stem = r.stem AND l.start_cs - 125 <= r.end_cs AND r.start_cs <= l.end_cs + 125
  AND (greatest(0, least(l.end_cs, r.end_cs) - greatest(l.start_cs, r.start_cs)) >= 8 OR (l.slot = r.slot AND 2 * (32 + 16 * least(l.z, r.z)) >= 0.82 * (64 + 16 * (l.z + r.z)))))
SELECT l.stem, l.seq, coalesce(string_agg(h.speaker, ',' ORDER BY h.speaker), '') AS labels FROM l LEFT JOIN h USING (stem, seq) GROUP BY l.stem, l.seq""",
)
def join2_attach_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of one slot of six cues begin alike and differ in their ends, so that SQL can tell the similarity."""
    shown = F.expr("concat(md5(concat(stem, '-', seq div 6)), repeat('z', int(seq % 6) * 16))")
    c = cues(spark, sf_dir).withColumn("text", shown)
    return attach_labels(c.filter("speaker = 'user'"), c.filter("speaker <> 'user'"), "speaker").select("stem", "seq", F.array_join("labels", ",").alias("labels"))


def unblocked(left: DataFrame, right: DataFrame, keep: Column | None = None, least: int = 12) -> DataFrame:
    """JOIN3: left cues that no right cue overlaps by ``least``, that ``keep`` lets pass, and that no left cue taken before
    them overlaps by ``least``: the list that blocks grows, so a stem's cues are folded in order."""
    blocked = interval_join(left, right).filter(overlap(F.col("start_cs"), F.col("end_cs"), F.col("r_start_cs"), F.col("r_end_cs")) >= least).select("stem", "seq").distinct()
    free = left.join(blocked, ["stem", "seq"], "left_anti")
    if keep is not None:
        free = free.filter(keep)
    item = F.struct(*[F.col(c).cast("long").alias(c) for c in ("seq", "start_cs", "end_cs")])
    stems = free.groupBy("stem").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def take(taken: Column, x: Column) -> Column:
        meets = F.exists(taken, lambda t: overlap(t["start_cs"], t["end_cs"], x["start_cs"], x["end_cs"]) >= least)
        return F.when(meets, taken).otherwise(F.array_append(taken, x))

    none = F.array().cast("array<struct<seq:bigint,start_cs:bigint,end_cs:bigint>>")
    kept = stems.select("stem", F.inline(F.aggregate("items", none, take))).select("stem", "seq")
    return left.join(kept, ["stem", "seq"], "left_semi")


@query(
    "join3_overlap_anti",
    f"""WITH RECURSIVE {CUES}, sdh AS (SELECT stem, seq * 2 + k AS seq, start_cs + 50 * k AS s, end_cs + 50 * k AS e FROM cues, range(0, 2) r(k) WHERE speaker <> 'user'),
free AS (SELECT * FROM sdh a WHERE seq * 7 % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM cues b WHERE b.stem = a.stem AND b.speaker = 'user' AND least(a.e, b.end_cs) - greatest(a.s, b.start_cs) >= 12)),
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY seq) AS i FROM free),
f(stem, i, kept) AS (SELECT stem, i, [{{'seq': seq, 's': s, 'e': e}}] FROM n WHERE i = 1
  UNION ALL SELECT n.stem, n.i, CASE WHEN len(list_filter(f.kept, lambda a: least(a.e, n.e) - greatest(a.s, n.s) >= 12)) > 0 THEN f.kept ELSE list_append(f.kept, {{'seq': n.seq, 's': n.s, 'e': n.e}}) END
  FROM f JOIN n ON n.stem = f.stem AND n.i = f.i + 1),
u AS (SELECT f.stem, unnest(f.kept) AS k FROM f JOIN (SELECT stem, max(i) AS m FROM n GROUP BY stem) l ON l.stem = f.stem AND l.m = f.i)
SELECT stem, k.seq AS seq, k.s AS start_cs, k.e AS end_cs FROM u""",
)
def join3_overlap_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cue of the second track stands there twice, half a second apart, so that it can block itself."""
    c = cues(spark, sf_dir)
    k = F.col("k")
    twice = c.filter("speaker <> 'user'").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).select("stem", (F.col("seq") * 2 + k).alias("seq"), (F.col("start_cs") + k * 50).alias("start_cs"), (F.col("end_cs") + k * 50).alias("end_cs"))
    return unblocked(twice, c.filter("speaker = 'user'"), F.col("seq") * 7 % 3 != 0)


def pair_last(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """JOIN5 (inner) and JOIN6 (full): rows of equal keys pair from the last one on."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("seq")))
    a = left.withColumn("_n", rank).select(*keys, "_n", F.col("seq").alias("left_seq"))
    b = right.withColumn("_n", rank).select(*keys, "_n", F.col("seq").alias("right_seq"))
    return a.join(b, [*keys, "_n"], how).drop("_n")


def _slots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = cues(spark, sf_dir).withColumn("slot", F.floor(F.col("seq") / 4).cast("long"))
    return c.filter("speaker = 'user'"), c.filter("speaker <> 'user'")


_SLOTS = f"""{CUES}, s AS (SELECT *, (seq // 4)::BIGINT AS slot FROM cues),
l AS (SELECT stem, slot, seq, row_number() OVER (PARTITION BY stem, slot ORDER BY seq DESC) AS n FROM s WHERE speaker = 'user'),
r AS (SELECT stem, slot, seq, row_number() OVER (PARTITION BY stem, slot ORDER BY seq DESC) AS n FROM s WHERE speaker <> 'user')"""


@query("join5_pair_last", f"WITH {_SLOTS} SELECT stem, slot, l.seq AS left_seq, r.seq AS right_seq FROM l JOIN r USING (stem, slot, n)")
def join5_pair_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_last(*_slots(spark, sf_dir), ["stem", "slot"])


@query("join6_pair_full", f"WITH {_SLOTS} SELECT stem, slot, l.seq AS left_seq, r.seq AS right_seq FROM l FULL JOIN r USING (stem, slot, n)")
def join6_pair_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_last(*_slots(spark, sf_dir), ["stem", "slot"], "full")


def term_join(texts: DataFrame, terms: DataFrame, column: str = "text") -> DataFrame:
    """JOIN7: texts with each term that stands in them as a whole word or phrase, case ignored.

    Texts meet only terms whose longest piece they hold, an equality join, so nothing is broadcast by assumption; then the
    words must stand there, and only then a pattern is made and decides.
    """
    t = terms.withColumn("_fold", folded(normalize_text("term"))).withColumns({"_key": longest_piece("_fold"), "_pattern": word_pattern("term")})
    shown = texts.withColumn("_folded", folded(F.regexp_replace(normalize_text(column), r"(?U)\s+", " ")))
    met = shown.withColumn("_key", F.explode(F.array_distinct(pieces("_folded")))).join(t, "_key")
    whole = F.when(F.contains("_folded", F.col("_fold")), F.expr(f"rlike({column}, _pattern)")).otherwise(False)
    return met.filter(whole).drop("_key", "_pattern", "_fold", "_folded")


def terms_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two words of each benchmark text as dictionary entries."""
    two = F.regexp_extract("text", "^([A-Za-z]+ [A-Za-z]+)", 1)
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ordinal"), two.alias("term")).filter("term <> ''").dropDuplicates(["term"])


TERMS = "terms AS (SELECT min(item_id) AS any_id, term FROM (SELECT item_id, regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1) AS term FROM benchmark) WHERE term <> '' GROUP BY term)"


@query(
    "join7_term_match",
    rf"""WITH {LINES}, {TERMS}, x AS (SELECT stem, seq, text FROM lines)
SELECT stem, seq, term FROM x JOIN terms ON regexp_matches(regexp_replace(lower(text), '\s+', ' ', 'g'), '(^|[^0-9a-z])' || lower(term) || '([^0-9a-z]|$)')""",
)
def join7_term_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_join(lines(spark, sf_dir), terms_of(spark, sf_dir)).select("stem", "seq", "term")


@query(
    "join10_first_occurrence",
    rf"""WITH {LINES}, {TERMS}, x AS (SELECT stem, seq, term FROM lines JOIN terms ON regexp_matches(regexp_replace(lower(text), '\s+', ' ', 'g'), '(^|[^0-9a-z])' || lower(term) || '([^0-9a-z]|$)'))
SELECT term, min(stem) AS stem, arg_min(seq, {{'a': stem, 'b': seq}}) AS seq, count(*) AS hits FROM x GROUP BY term""",
)
def join10_first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each term's earliest place, with how often it occurs."""
    met = term_join(lines(spark, sf_dir), terms_of(spark, sf_dir))
    place = F.min(F.struct("stem", "seq"))
    return met.groupBy("term").agg(place.alias("p"), F.count("*").alias("hits")).select("term", "p.stem", "p.seq", "hits")


@query(
    "join8_terms_limit",
    rf"""WITH {LINES}, {TERMS}, x AS (SELECT DISTINCT stem, term FROM lines JOIN terms ON regexp_matches(regexp_replace(lower(text), '\s+', ' ', 'g'), '(^|[^0-9a-z])' || lower(term) || '([^0-9a-z]|$)')),
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY term) AS r FROM x)
SELECT stem, string_agg(term, ';' ORDER BY term) AS terms FROM n WHERE r <= 32 GROUP BY stem""",
)
def join8_terms_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 32 dictionary entries for each stem, in dictionary order."""
    met = term_join(lines(spark, sf_dir), terms_of(spark, sf_dir)).select("stem", "term").distinct()
    first = met.withColumn("_n", F.row_number().over(Window.partitionBy("stem").orderBy("term"))).filter("_n <= 32")
    return first.groupBy("stem").agg(F.array_join(F.sort_array(F.collect_list("term")), ";").alias("terms"))


def time_matches(start: Column, end: Column, low: Column, high: Column, tolerance: int = 35) -> Column:
    """A rule without bounds matches; two bounds need to meet, one bound to be near or inside."""
    return (
        F.when(low.isNull() & high.isNull(), True)
        .when(low.isNotNull() & high.isNotNull(), (end >= low - tolerance) & (start <= high + tolerance))
        .when(low.isNotNull(), (F.abs(start - low) <= tolerance) | ((start <= low) & (low <= end)))
        .otherwise((F.abs(end - high) <= tolerance) | ((start <= high) & (high <= end)))
    )


def override_join(segments: DataFrame, rules: DataFrame) -> DataFrame:
    """JOIN11: the first rule of the stem that changes something and matches by index, time and text.

    ``rules``: stem, rule, index, low_cs, high_cs, contains, zh (all but the first two may be null).
    """
    effective = rules.filter(F.col("zh").isNotNull()).select("stem", "rule", "index", "low_cs", "high_cs", F.lower(normalize_text("contains")).alias("contains"), F.col("zh").alias("new_zh"))
    place = segments.withColumn("_index", F.row_number().over(Window.partitionBy("stem").orderBy("seq")))
    met = place.join(
        effective,
        (place["stem"] == effective["stem"])
        & (F.col("index").isNull() | (F.col("index") == F.col("_index")))
        & time_matches(F.col("start_cs"), F.col("end_cs"), F.col("low_cs"), F.col("high_cs"))
        & ((F.col("contains") == "") | F.lower(normalize_text("text")).contains(F.col("contains"))),
    ).select(place["stem"], "seq", "rule", "new_zh")
    first = met.groupBy("stem", "seq").agg(F.min(F.struct("rule", "new_zh")).alias("r"))
    return segments.join(first, ["stem", "seq"], "left").select(*segments.columns, F.col("r.rule").alias("rule"), F.col("r.new_zh").alias("zh"))


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rules of all shapes for each stem."""
    stems = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stem")).distinct()
    return stems.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(24).cast("long")))).select(
        "stem",
        F.col("k").cast("int").alias("rule"),
        F.when(F.col("k") % 5 == 1, F.col("k") % 7 + 1).cast("int").alias("index"),
        F.when(F.col("k") % 3 == 0, F.col("k") * 200 + F.col("stem")).alias("low_cs"),
        F.when(F.col("k") % 4 == 0, F.col("k") * 200 + F.col("stem") + 150).alias("high_cs"),
        F.when(F.col("k") % 2 == 1, F.lit("the")).alias("contains"),
        F.when(F.col("k") % 6 != 5, F.concat(F.lit("r"), F.col("k").cast("string"))).alias("zh"),
    )


@query(
    "join11_override",
    rf"""WITH {CUES}, rules AS (SELECT s AS stem, k::INTEGER AS rule, CASE WHEN k % 5 = 1 THEN k % 7 + 1 END AS idx, CASE WHEN k % 3 = 0 THEN k * 200 + s END AS low, CASE WHEN k % 4 = 0 THEN k * 200 + s + 150 END AS high,
  CASE WHEN k % 2 = 1 THEN 'the' ELSE '' END AS has, CASE WHEN k % 6 <> 5 THEN 'r' || k END AS zh FROM (SELECT DISTINCT conv_id AS s FROM conversations), range(0, 25) r(k)),
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY seq) AS i FROM cues),
m AS (SELECT n.stem, n.seq, min(rule) AS rule FROM n JOIN rules r ON r.stem = n.stem AND zh IS NOT NULL AND (idx IS NULL OR idx = i) AND (has = '' OR contains(lower(text), has)) AND
  CASE WHEN low IS NULL AND high IS NULL THEN true WHEN low IS NOT NULL AND high IS NOT NULL THEN end_cs >= low - 35 AND start_cs <= high + 35
  WHEN low IS NOT NULL THEN abs(start_cs - low) <= 35 OR (start_cs <= low AND low <= end_cs) ELSE abs(end_cs - high) <= 35 OR (start_cs <= high AND high <= end_cs) END GROUP BY n.stem, n.seq)
SELECT c.stem, c.seq, m.rule, CASE WHEN m.rule IS NOT NULL THEN 'r' || m.rule END AS zh FROM cues c LEFT JOIN m USING (stem, seq)""",
)
def join11_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return override_join(cues(spark, sf_dir), _rules(spark, sf_dir)).select("stem", "seq", "rule", "zh")


def credit_windows(items: DataFrame) -> DataFrame:
    """Windows around credits: 1 s about watermarks, 20 s about legal blocks. Bare substrings, as they are."""
    low = F.lower(normalize_text("text"))
    mark = low.rlike(r"subtitle|caption|sync|rip|encoded|www\.|\.com")
    legal = low.rlike(r"copyright|unauthorized|all rights reserved|protected under|licensed under|soundtrack")
    wide = F.when(legal, 2000).when(mark, 100)
    return items.withColumn("_w", wide).filter("_w IS NOT NULL").select("stem", "seq", (F.col("start_cs") - F.col("_w")).alias("start_cs"), (F.col("end_cs") + F.col("_w")).alias("end_cs"))


@query(
    "join13_credit_windows",
    rf"""WITH {CUES}, w AS (SELECT stem, start_cs, end_cs, CASE WHEN regexp_matches(lower(text), 'copyright|unauthorized|all rights reserved|protected under|licensed under|soundtrack') THEN 2000
  WHEN regexp_matches(lower(text), 'subtitle|caption|sync|rip|encoded|www\.|\.com') THEN 100 END AS wide FROM cues)
SELECT stem, seq FROM cues c WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.stem = c.stem AND wide IS NOT NULL AND c.end_cs >= w.start_cs - wide AND c.start_cs <= w.end_cs + wide)""",
)
def join13_credit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cues(spark, sf_dir)
    hit = interval_join(c, credit_windows(c)).select("stem", "seq").distinct()
    return c.join(hit, ["stem", "seq"], "left_anti").select("stem", "seq")


def nearest_speaker(words: DataFrame, turns: DataFrame) -> DataFrame:
    """JOIN16: each word's turn with the largest overlap, else with the smallest gap, however large; ties to the smaller
    number.

    Turns that meet a word come from the interval join. All others of a word's stem lie wholly before or behind it, so
    two running extremes over the stem in time order give the nearest on either side.
    """
    common = overlap(F.col("start_cs"), F.col("end_cs"), F.col("r_start_cs"), F.col("r_end_cs"))
    met = interval_join(words, turns).groupBy("stem", "seq").agg(F.max_by(F.struct("r_seq", "r_speaker"), F.struct(common, -F.col("r_seq"))).alias("t"))
    apart = words.join(met, ["stem", "seq"], "left_anti").select("stem", "seq", "start_cs", "end_cs", F.lit(None).cast("struct<seq:bigint,speaker:string>").alias("turn"))
    turn = F.struct(F.col("seq").cast("long").alias("seq"), F.col("speaker").alias("speaker"))
    both = apart.unionByName(turns.select("stem", F.lit(None).cast("long").alias("seq"), "start_cs", "end_cs", turn.alias("turn")))
    is_turn = F.col("turn").isNotNull()
    upto = lambda at: Window.partitionBy("stem").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    behind_end = F.when(is_turn, F.col("end_cs")).otherwise(F.col("start_cs"))
    before_start = F.when(is_turn, F.col("start_cs")).otherwise(F.col("end_cs"))
    seen = both.withColumns({
        "_last": F.max(F.when(is_turn, F.struct("end_cs", (-F.col("turn.seq")).alias("o"), "turn"))).over(upto(behind_end)),
        "_next": F.max(F.when(is_turn, F.struct((-F.col("start_cs")).alias("start_cs"), (-F.col("turn.seq")).alias("o"), "turn"))).over(upto(-before_start)),
    }).filter(~is_turn)
    gaps = (F.col("start_cs") - F.col("_last.end_cs"), -F.col("_next.start_cs") - F.col("end_cs"))
    first = F.col("_next").isNull() | (gaps[0] < gaps[1]) | ((gaps[0] == gaps[1]) & (F.col("_last.turn.seq") < F.col("_next.turn.seq")))
    near = seen.select("stem", "seq", F.when(F.col("_last").isNotNull() & first, F.col("_last.turn")).otherwise(F.col("_next.turn")).alias("t"))
    best = met.select("stem", "seq", F.struct(F.col("t.r_seq").cast("long").alias("seq"), F.col("t.r_speaker").alias("speaker")).alias("t")).unionByName(near)
    return words.join(best, ["stem", "seq"], "left").select(*words.columns, F.col("t.seq").alias("turn"), F.col("t.speaker").alias("turn_speaker"))


@query(
    "join16_nearest_speaker",
    f"""WITH {CUES}, w AS (SELECT * FROM cues WHERE speaker = 'user'), t AS (SELECT stem, seq, start_cs * 9 AS start_cs, start_cs * 8 + end_cs AS end_cs FROM cues WHERE speaker <> 'user'),
m AS (SELECT w.stem, w.seq, t.seq AS turn, row_number() OVER (PARTITION BY w.stem, w.seq ORDER BY greatest(0, least(w.end_cs, t.end_cs) - greatest(w.start_cs, t.start_cs)) DESC,
  greatest(0, t.start_cs - w.end_cs, w.start_cs - t.end_cs), t.seq) AS n FROM w JOIN t ON t.stem = w.stem)
SELECT w.stem, w.seq, m.turn FROM w LEFT JOIN m ON m.stem = w.stem AND m.seq = w.seq AND m.n = 1""",
)
def join16_nearest_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns are drawn apart, so that many words lie far from any."""
    c = cues(spark, sf_dir)
    turns = c.filter("speaker <> 'user'").withColumn("end_cs", F.col("start_cs") * 8 + F.col("end_cs")).withColumn("start_cs", F.col("start_cs") * 9)
    return nearest_speaker(c.filter("speaker = 'user'"), turns).select("stem", "seq", "turn")


#: Class numbers of the audio tags, by group.
CLASSES = {"singing": [27, 32, 33, 34], "singer_core": [32, 33, 34], "speech": [1, 2, 3], "conversation": [4, 5], "vocal_music": [254]}
NONE = -999.0


def window_stats(segments: DataFrame, tags: DataFrame, window_cs: int = 400) -> DataFrame:
    """JOIN17 and AGG3: peak and overlap-weighted mean of class groups over the windows that a segment touches.

    The join is an equality on generated window numbers, so its size is the number of windows touched.
    """
    spread = segments.withColumn("win", F.explode(F.sequence(F.floor(F.col("start_cs") / window_cs), F.floor(F.col("end_cs") / window_cs))))
    scores = tags.select("win", *[F.array_max(F.transform(F.array(*map(F.lit, ids)), lambda i: F.get("scores", i))).cast("double").alias(g) for g, ids in CLASSES.items()])
    met = spread.join(scores, "win").withColumn("w", overlap(F.col("start_cs"), F.col("end_cs"), F.col("win") * window_cs, (F.col("win") + 1) * window_cs)).filter("w > 0")
    stats = met.groupBy("stem", "seq").agg(F.sum("w").alias("covered"), *[F.max(g).alias(f"{g}_peak") for g in CLASSES], *[(F.sum(F.col(g) * F.col("w")) / F.sum("w")).alias(f"{g}_mean") for g in CLASSES])
    out = segments.join(stats, ["stem", "seq"], "left")
    return out.select("stem", "seq", F.coalesce("covered", F.lit(0).cast("long")).alias("covered"), *[F.coalesce(f"{g}_{k}", F.lit(NONE)).alias(f"{g}_{k}") for g in CLASSES for k in ("peak", "mean")])


_GROUPS = ", ".join(f"list_max([{', '.join(f'embedding[{i % 64 + 1}]' for i in ids)}])::DOUBLE AS {g}" for g, ids in CLASSES.items())


@query(
    "join17_agg3_window_stats",
    f"""WITH {CUES}, tags AS (SELECT vec_id AS win, {_GROUPS} FROM embeddings),
m AS (SELECT c.stem, c.seq, t.*, least(c.end_cs, (win + 1) * 400) - greatest(c.start_cs, win * 400) AS w FROM cues c JOIN tags t ON c.start_cs < (win + 1) * 400 AND win * 400 < c.end_cs),
s AS (SELECT stem, seq, sum(w)::BIGINT AS covered, {", ".join(f"max({g}) AS {g}_peak, sum({g} * w) / sum(w) AS {g}_mean" for g in CLASSES)} FROM m GROUP BY stem, seq)
SELECT c.stem, c.seq, coalesce(covered, 0)::BIGINT AS covered, {", ".join(f"round(coalesce({g}_{k}, -999), 4) AS {g}_{k}" for g in CLASSES for k in ("peak", "mean"))} FROM cues c LEFT JOIN s USING (stem, seq)""",
)
def join17_agg3_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of 64 numbers, four times each, stand for the scores of a window's classes."""
    tags = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("win"), F.flatten(F.array_repeat("embedding", 4)).alias("scores"))
    found = window_stats(cues(spark, sf_dir), tags)
    return found.select("stem", "seq", "covered", *[F.round(f"{g}_{k}", 4).alias(f"{g}_{k}") for g in CLASSES for k in ("peak", "mean")])


def cached(targets: DataFrame, cache: DataFrame, **fields: Column) -> DataFrame:
    """JOIN20: targets with the cached result of their digest (null: still to do)."""
    return targets.withColumn("key", digest(**fields)).join(cache.select("key", "result"), "key", "left")


@query(
    "join20_cache_lookup",
    """WITH k AS (SELECT doc_id, lang, source, sha256('{"kind":"' || lang || '","model":"m","text":"' || source || '"}') AS key FROM documents),
c AS (SELECT key, min(doc_id) AS result FROM k WHERE doc_id % 3 = 0 GROUP BY key)
SELECT doc_id, k.key, c.result FROM k LEFT JOIN c ON c.key = k.key""",
)
def join20_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    fields = {"kind": F.col("lang"), "model": F.lit("m"), "text": F.col("source")}
    cache = docs.filter("doc_id % 3 = 0").groupBy(digest(**fields).alias("key")).agg(F.min("doc_id").alias("result"))
    return cached(docs, cache, **fields).select("doc_id", "key", "result")


def checked_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """JOIN23: request and response by id; ids answered twice count as missing, unknown ids are reported."""
    counted = responses.withColumn("_n", F.count("*").over(Window.partitionBy("batch", "id")))
    once = counted.groupBy("batch", "id").agg(F.first("answer").alias("answer"), F.first("_n").alias("_n"))
    met = requests.select("batch", "id", F.lit(True).alias("_asked")).join(once, ["batch", "id"], "full")
    status = F.when(F.col("_asked").isNull(), "unexpected").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").otherwise("ok")
    return met.select("batch", "id", status.alias("status"), F.when(status == "ok", F.col("answer")).alias("answer"))


@query(
    "join23_checked_responses",
    """WITH req AS (SELECT conv_id AS batch, turn AS id FROM conversations),
res AS (SELECT conv_id AS batch, CASE WHEN (conv_id + turn) % 9 = 0 THEN turn + 100 WHEN (conv_id + turn) % 7 = 0 THEN greatest(0, turn - 1) ELSE turn END AS id, 'a' || turn AS answer FROM conversations),
c AS (SELECT batch, id, count(*) AS n, min(answer) AS answer FROM res GROUP BY batch, id)
SELECT batch, id, CASE WHEN req.batch IS NULL THEN 'unexpected' WHEN c.n IS NULL THEN 'missing' WHEN c.n > 1 THEN 'duplicate' ELSE 'ok' END AS status,
  CASE WHEN req.batch IS NOT NULL AND c.n = 1 THEN answer END AS answer FROM req FULL JOIN c USING (batch, id)""",
)
def join23_checked_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("batch"), F.col("turn").alias("id"))
    s = F.col("batch") + F.col("id")
    answers = c.select("batch", F.when(s % 9 == 0, F.col("id") + 100).when(s % 7 == 0, F.greatest(F.lit(0), F.col("id") - 1)).otherwise(F.col("id")).alias("id"), F.concat(F.lit("a"), F.col("id")).alias("answer"))
    return checked_responses(c, answers)


@query(
    "flt5_low_value_anti",
    rf"""WITH {LINES}, k AS (SELECT stem, seq, regexp_replace(lower(text), '[^a-z0-9一-鿿]+', '', 'g') AS key FROM lines),
low AS (SELECT key FROM k GROUP BY key HAVING count(DISTINCT stem) >= 5)
SELECT stem, seq, key FROM k WHERE key NOT IN (SELECT key FROM low)""",
)
def flt5_low_value_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key is in no dictionary of low-value texts (here: keys of five stems or more)."""
    keyed = lines(spark, sf_dir).select("stem", "seq", text_key("text").alias("key"))
    low = keyed.groupBy("key").agg(F.count_distinct("stem").alias("n")).filter("n >= 5").select("key")
    return keyed.join(low, "key", "left_anti").select("stem", "seq", "key")
