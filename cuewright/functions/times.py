"""Times of subtitle formats, in seconds and centiseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, text

SRT_TIME = r"(\d+):(\d{2}):(\d{2})[,.](\d{1,3})"
ASS_TIME = r"^(\d+):(\d{2}):(\d{2})\.(\d{2})$"


def srt_millis(c: Column | str) -> Column:
    """DT5: H:MM:SS,mmm (comma or dot) to milliseconds; the fraction is filled up with zeros and cut to three."""
    part = lambda i: F.regexp_extract(text(c), SRT_TIME, i)
    total = (part(1).try_cast("long") * 3600 + part(2).try_cast("long") * 60 + part(3).try_cast("long")) * 1000
    return total + F.rpad(part(4), 3, "0").try_cast("long")


def srt_seconds(c: Column | str) -> Column:
    return srt_millis(c) / F.lit(1000.0)


def ass_centis(c: Column | str) -> Column:
    """DT2: H:MM:SS.cc to centiseconds, null for anything else."""
    part = lambda i: F.regexp_extract(F.trim(text(c)), ASS_TIME, i).try_cast("long")
    return (part(1) * 3600 + part(2) * 60 + part(3)) * 100 + part(4)


def centis_to_ass(c: Column | str) -> Column:
    """Whole centiseconds to H:MM:SS.cc; negative times count as 0."""
    v = F.greatest(col(c).cast("long"), F.lit(0))
    s = F.floor(v / 100).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60), F.lit("."), two(v % 100))


def seconds_to_ass(c: Column | str) -> Column:
    """DT1: seconds to H:MM:SS.cc; centiseconds are cut off, never rounded."""
    v = F.greatest(col(c).cast("double"), F.lit(0.0))
    whole = F.floor(v)
    return centis_to_ass(whole.cast("long") * 100 + ((v - whole) * 100).cast("long"))


def report_time(centis: Column | str) -> Column:
    """DT4: centiseconds to HH:MM:SS.ss."""
    v = col(centis).cast("long")
    s = F.floor(v / 100).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60), F.lit("."), two(v % 100))
