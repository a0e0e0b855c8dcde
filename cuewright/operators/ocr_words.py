"""Recognised text repaired: glyphs that look alike, and words that lost the blank between them.

Distinct unknown words are broken by dynamic programming over their pieces. The pieces meet the dictionary in an equality
join, so a dictionary of any size stays distributed, and each distinct word is broken once, however often it occurs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, text
from ..plans.registry import query, table
from ..sources.staging import LINES, lines

# Words that recognisers run together with the next, and common words that a dictionary file may lack.
LEADS = ["after", "battle", "danger", "deadly", "dear", "new", "never", "of", "off", "or", "other", "outpost", "over", "smaller", "snow", "for", "their", "together", "your"]
COMMON = ["for", "heard", "the"]
# Repairs of glyphs in order, as pattern and replacement. In the second a capital I behind a letter is an l,
# also before others of its kind.
REPAIRS = [
    ("[♪*]", ""),
    (r"(?<=[A-Za-z])I(?=I*[a-z])", "l"),
    (r"(?U)\b[lL](?=(?:'m|'ll|'d|'ve|'re)\b)", "I"),
    (r"(?U)\bl\b", "I"),
    (r"(?U)\bI(?=(?:ies|ooks|ike|et|ive|egacy|eave|and)\b)", "l"),
    ("AII", "All"),
    (r"(?U)\.(</i>)?(\s+)(<i>)?(?=[a-z])", "$1$2$3"),
    (r"(?U)(?<=[a-z,])\s+In\b", " in"),
    (r"(?U)(?<=-\s)[A-Z][A-Z0-9 .'\-]{1,30}:\s*", ""),
]
#: Letters of a word that may be two, and of a piece.
LEAST, PIECE = 5, 2


def repaired(c: Column | str) -> Column:
    """STR20, first part: glyphs."""
    out = text(c)
    for pattern, by in REPAIRS:
        out = F.regexp_replace(out, pattern, by)
    return out


def dictionary_words(entries: DataFrame, column: str = "word") -> DataFrame:
    """The words of a dictionary's lines (flags behind a slash go, comments too), with their regular endings: word."""
    plain = F.lower(F.trim(F.split(text(column), "/", 2)[0]))
    words = entries.filter(~text(column).startswith("#") & (F.trim(text(column)) != "")).select(plain.alias("w")).filter("w <> ''").distinct()
    stem = F.expr("left(w, length(w) - 1)")
    ends = lambda e: F.col("w").endswith(e)
    regular = F.array(*[F.concat("w", F.lit(e)) for e in ("s", "ed", "ing", "er")])
    more = F.when(ends("e"), F.array(F.concat("w", F.lit("d")), F.concat(stem, F.lit("ing")))).when(ends("y"), F.array(F.concat(stem, F.lit("ies")))).otherwise(F.array())
    formed = F.when(F.length("w") < 3, F.array("w")).otherwise(F.concat(F.array("w"), regular, more))
    common = entries.sparkSession.createDataFrame([(w,) for w in COMMON], "word string")
    return words.select(F.explode(formed).alias("word")).union(common).distinct()


def word_breaks(words: DataFrame, dictionary: DataFrame, leads: Sequence[str] | None = LEADS, most: int = 2) -> DataFrame:
    """word, cuts: where each unknown word (lower case, no repeats) parts into ``most`` dictionary words or less of two
    letters or more, all but the last of them ``leads`` (None: any). Fewest pieces count, then the earliest cuts.

    A word's pieces are all its parts by position; those that the dictionary has are steps from one place to another, and
    a fold over them, in order of their starts, keeps the best way to each place. No piece is longer than the dictionary's
    longest word, so a very long word has few pieces, or cannot be parted at all.
    """
    longest = dictionary.agg(F.max(F.length("word"))).first()[0] or 0
    size = F.length("word")
    unknown = words.filter((size >= LEAST) & (size <= most * longest)).join(dictionary, "word", "left_anti")
    part = lambda s, e: F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"), F.substring(F.col("word"), s + 1, e - s).alias("p"))
    if most == 2:  # each piece touches an end of the word
        cuts = F.sequence(F.lit(PIECE), size - PIECE)
        parts = F.concat(F.transform(cuts, lambda c: part(F.lit(0), c)), F.transform(cuts, lambda c: part(c, size)))
    else:
        ends = lambda s: F.sequence(s + PIECE, F.least(s + longest, size))
        parts = F.flatten(F.transform(F.sequence(F.lit(0), size - PIECE), lambda s: F.transform(ends(s), lambda e: part(s, e))))
    parts = F.filter(parts, lambda x: F.length(x["p"]) <= longest)
    if leads is not None:
        parts = F.filter(parts, lambda x: x["p"].isin(list(leads)) | (x["e"] == size))
    pieces = unknown.select("word", F.explode(parts).alias("x")).select("word", "x.s", "x.e", F.col("x.p").alias("piece"))
    found = pieces.join(dictionary.withColumnRenamed("word", "piece"), "piece", "left_semi")
    steps = found.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("steps"))
    way = "struct<n:int,cuts:array<int>>"
    none = F.lit(None).cast(way)
    first = F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.when(i == 0, F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("cuts")).cast(way)).otherwise(none))

    def step(held: Column, x: Column) -> Column:
        here = F.get(held, x["s"])
        new = F.struct((here["n"] + 1).alias("n"), F.concat(here["cuts"], F.array(x["e"])).alias("cuts")).cast(way)
        return F.transform(held, lambda old, i: F.when((i == x["e"]) & here.isNotNull() & (here["n"] < most) & (old.isNull() | (new < old)), new).otherwise(old))

    best = F.get(F.aggregate("steps", first, step), F.length("word"))
    return steps.withColumn("best", best).filter("best IS NOT NULL").select("word", F.slice("best.cuts", 1, F.col("best.n") - 1).alias("cuts"))


def parted(token: Column, cuts: Column) -> Column:
    """A word with blanks at the cuts; all capitals stay so, else a piece is capitalised where its first letter was."""
    bounds = F.concat(F.array(F.lit(0)), cuts, F.array(F.length(token)))

    def piece(i: Column) -> Column:
        raw = F.substring(token, bounds[i] + 1, bounds[i + 1] - bounds[i])
        first = F.substring(raw, F.lit(1), F.lit(1))
        upper = (first == F.upper(first)) & (first != F.lower(first))
        rest = F.lower(F.substring(raw, F.lit(2), F.length(raw)))
        return F.when(token == F.upper(token), raw).when(upper, F.concat(first, rest)).otherwise(F.lower(raw))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.size(cuts)), piece), " ")


def split_joined(frame: DataFrame, dictionary: DataFrame, keys: Sequence[str], column: str = "text", leads: Sequence[str] | None = LEADS, most: int = 2) -> DataFrame:
    """STR20, second part: the frame with joined words in ``column`` parted. Only keys and words are shuffled; a text is
    rewritten where it stands, by the breaks of its own words. ``keys`` tell rows apart."""
    runs = lambda pattern: F.regexp_extract_all(text(column), F.lit(pattern), F.lit(0))
    # All pieces but the last are leads, and no unknown word is one piece: words that begin otherwise cannot be parted.
    opened = "" if leads is None else f"(?<![A-Za-z])(?=(?i:{'|'.join(map(re.escape, leads)) or '(?!)'}))"
    own = frame.select(*keys, F.explode(F.array_distinct(F.transform(runs(f"{opened}[A-Za-z]{{{LEAST},}}"), F.lower))).alias("word"))
    breaks = word_breaks(own.select("word").distinct(), dictionary, leads, most)
    of_row = own.join(breaks, "word").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("word", "cuts"))).alias("_breaks"))
    token = lambda t: let(F.try_element_at(F.col("_breaks"), F.lower(t)), lambda cuts: F.when(cuts.isNotNull(), parted(t, cuts)).otherwise(t))
    # What no word that may be parted begins in stays one piece.
    word = f"{opened}[A-Za-z]{{{LEAST},}}"
    again = F.array_join(F.transform(runs(f"(?s){word}|(?:(?!{word}).)+"), token), "")
    return frame.join(of_row, list(keys), "left").withColumn(column, F.when(F.col("_breaks").isNull(), F.col(column)).otherwise(again)).drop("_breaks")


_JOINED = ["the", "of", "and", "in", "to"]


@query(
    "str20_split_joined",
    rf"""WITH {LINES}, w AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS w FROM benchmark),
dict AS (SELECT w AS word FROM w UNION SELECT unnest([w || 's', w || 'ed', w || 'ing', w || 'er']) FROM w WHERE length(w) >= 3 UNION SELECT unnest([w || 'd', left(w, -1) || 'ing']) FROM w WHERE length(w) >= 3 AND w LIKE '%e' UNION SELECT left(w, -1) || 'ies' FROM w WHERE length(w) >= 3 AND w LIKE '%y' UNION SELECT unnest({COMMON})),
x AS (SELECT stem, seq, regexp_replace(text, '\b([Tt]he|of|and|in|to) ([A-Za-z])', '\1\2', 'g') AS t FROM lines),
tok AS (SELECT stem, seq, unnest(regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]+')) AS tok, generate_subscripts(regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]+'), 1) AS n FROM x),
u AS (SELECT DISTINCT lower(tok) AS word FROM tok WHERE regexp_full_match(tok, '[A-Za-z]{{5,}}') AND lower(tok) NOT IN (SELECT word FROM dict)),
c AS (SELECT u.word, unnest(range(2, length(u.word) - 1)) AS pos FROM u),
b AS (SELECT word, min(pos) AS pos FROM c WHERE left(word, pos) IN ({', '.join(repr(x) for x in _JOINED)}) AND left(word, pos) IN (SELECT word FROM dict) AND substr(word, pos + 1) IN (SELECT word FROM dict) GROUP BY word),
done AS (SELECT stem, seq, n, CASE WHEN pos IS NULL OR NOT regexp_full_match(tok, '[A-Za-z]{{5,}}') THEN tok WHEN tok = upper(tok) THEN left(tok, pos) || ' ' || substr(tok, pos + 1)
  ELSE CASE WHEN regexp_matches(tok, '^[A-Z]') THEN upper(left(tok, 1)) || lower(substr(tok, 2, pos - 1)) ELSE lower(left(tok, pos)) END || ' ' || CASE WHEN regexp_matches(substr(tok, pos + 1, 1), '[A-Z]') THEN upper(substr(tok, pos + 1, 1)) || lower(substr(tok, pos + 2)) ELSE lower(substr(tok, pos + 1)) END END AS tok
  FROM tok LEFT JOIN b ON b.word = lower(tok.tok))
SELECT x.stem, x.seq, md5(coalesce(string_agg(tok, '' ORDER BY n), '')) AS text FROM x LEFT JOIN done USING (stem, seq) GROUP BY x.stem, x.seq""",
)
def str20_split_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in which short words have run into the next, against a dictionary made of the benchmark's words."""
    entries = table(spark, sf_dir, "benchmark").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    joined = lines(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"\b([Tt]he|of|and|in|to) ([A-Za-z])", "$1$2"))
    done = split_joined(joined, dictionary_words(entries), ["stem", "seq"], leads=_JOINED)
    return done.select("stem", "seq", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text"))
