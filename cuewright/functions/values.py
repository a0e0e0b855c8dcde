"""Boxes, display units, JSON salvage and digests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, normalize_text, text, tokens


def clamp(c: Column, low: float, high: float) -> Column:
    """MTH1."""
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """JOIN1: length of the common part of two intervals."""
    return F.greatest(F.lit(0).cast("long"), F.least(e1, e2) - F.greatest(s1, s2))


def center(box: Column | str) -> Column:
    """MTH2: centre of [x1, y1, x2, y2], null if it has fewer numbers."""
    b = col(box)
    return F.when(F.size(b) >= 4, F.struct(((b[0] + b[2]) / 2.0).alias("x"), ((b[1] + b[3]) / 2.0).alias("y")))


def jumped(a: Column | str, b: Column | str, limit: float = 420.0) -> Column:
    """Centres further apart than ``limit``; unknown boxes have not jumped."""
    p, q = center(a), center(b)
    return F.coalesce(F.hypot(p["x"] - q["x"], p["y"] - q["y"]) > limit, F.lit(False))


def box_of_points(points: Column | str) -> Column:
    """ARR1: the box around an array of (x, y) arrays."""
    p = col(points)
    x, y = F.transform(p, lambda v: v[0]), F.transform(p, lambda v: v[1])
    return F.when(F.size(p) > 0, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))


def placed(box: Column | str, width: Column, height: Column, play_x: int = 1920, play_y: int = 1080, margin: int = 36) -> Column:
    """MTH3: centre of a box scaled to the play area, kept inside a margin and moved below the box."""
    c, b = center(box), col(box)
    x = F.bround(c["x"] * play_x / width).cast("int")
    y = F.bround((c["y"] + F.abs(b[3] - b[1]) / 2 + 8) * play_y / height).cast("int")
    return F.struct(F.least(F.greatest(x, F.lit(margin)), F.lit(play_x - margin)).alias("x"), F.least(F.greatest(y, F.lit(margin)), F.lit(play_y - margin)).alias("y"))


def clean_units(units: Column | str) -> Column:
    """ARR5: display units with both sides filled."""
    made = F.transform(col(units), lambda u: F.struct(normalize_text(u["en"]).alias("en"), normalize_text(u["zh"]).alias("zh")))
    return F.filter(made, lambda u: (u["en"] != "") & (u["zh"] != ""))


def units_cover(units: Column | str, source: Column | str) -> Column:
    """ARR4: the units' tokens are the source's tokens, in order."""
    return F.flatten(F.transform(col(units), lambda u: tokens(u["en"]))) == tokens(source)


def salvage_json(c: Column | str) -> Column:
    """JSN1: thoughts and code fences away, then the outermost braces; empty if there are none."""
    x = F.regexp_replace(text(c), r"(?is)<think>.*?</think>", "")
    x = F.regexp_replace(x, r"```(?:json)?", "")
    return F.regexp_extract(x, r"(?s)\{.*\}", 0)


def salvage_json_any(c: Column | str) -> Column:
    """JSN2: as JSN1, or the outermost brackets."""
    x = F.regexp_replace(F.regexp_replace(text(c), r"(?is)<think>.*?</think>", ""), r"```(?:json)?", "")
    return F.regexp_extract(x, r"(?s)\{.*\}|\[.*\]", 0)


def digest(**fields: Column) -> Column:
    """HSH1/HSH2: sha256 of the canonical JSON (names sorted, no blanks) of string fields."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)
