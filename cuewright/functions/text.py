"""Text normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of subtitle text. (?U) gives \s, \w and \b their Unicode meaning.
MOJIBAKE_NOTE = r"""(?U)[jJ](?:(?<![0-9A-Za-z][jJ])(?:[“”"']|n(?=\s))|[“”"'](?=\s|$))"""  # its letter first, so most places are passed over
TAG = r"<[^>]+>"
OVERRIDE = r"\{\\[^}]*\}"
SPEAKER = r"(?U)^(?:[A-Z][A-Z0-9 .'\-♪♫*?]{1,40})(?:\s*\((?:on phone|o\.s\.|v\.o\.|over phone)\))?\s*:\s*"
SPEAKER_ONLY = r"(?U)^(?:[A-Z][A-Z0-9 .'\-♪♫*?]{1,40})(?:\s*\((?:on phone|o\.s\.|v\.o\.|over phone)\))?\s*:?\s*$"
LABEL = r"[\[(]([^()\[\]\n]{1,90})[\])]"
WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?:'[A-Za-zÀ-ÖØ-öø-ÿ]+)?"
TOKEN = r"[A-Za-z0-9]+(?:['’][A-Za-z0-9]+)?"
HAN = r"[一-鿿]"
#: ASCII but letters and digits; 0 stands for "nothing" in a translation.
_ASCII_MARKS = "".join(c for c in map(chr, range(1, 128)) if not c.isalnum())
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` reads it."""
    return F.transform(F.array(value), f)[0]


def where(value: Column, sign: Callable[[Column], Column], f: Callable[[Column], Column]) -> Column:
    """``f`` of texts that have the sign, a cheap test without which ``f`` would change nothing."""
    return let(value, lambda x: F.when(sign(x), f(x)).otherwise(x))


def has(*marks: str) -> Callable[[Column], Column]:
    return lambda x: reduce(Column.__or__, [F.contains(x, F.lit(m)) for m in marks])


def strip(c: Column | str) -> Column:
    blank = lambda x: F.concat(F.substring(x, 1, 1), F.substring(x, -1, 1)).rlike(r"(?U)\s")
    return where(col(c), blank, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one blank; none at the ends."""
    odd = lambda x: x.rlike("[^ -~]") | F.contains(x, F.lit("  "))
    return F.trim(where(text(c), odd, lambda x: F.regexp_replace(x, r"(?U)[\s&&[^ ]]\s*| \s+", " ")))  # a single blank is no match


def unescape(c: Column | str) -> Column:
    """The common HTML entities; the ampersand last, so nothing is unescaped twice."""
    return where(text(c), has("&"), lambda t: reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), t))


def music_symbols(c: Column | str) -> Column:
    return where(text(c), has("j", "J"), lambda x: F.regexp_replace(x, MOJIBAKE_NOTE, "♪"))


def normalize_inline(c: Column | str) -> Column:
    """STR1: entities, note marks, then white space."""
    return squeeze(music_symbols(unescape(c)))


def normalize_markup_inline(c: Column | str) -> Column:
    r"""STR2: as STR1 without entities, with \N as a line break."""
    return squeeze(F.replace(music_symbols(c), F.lit("\\N"), F.lit("\n")))


def normalize_lines(c: Column | str) -> Column:
    """STR3: lines are trimmed and joined by a blank; blanks inside a line stay."""
    lines = F.split(where(F.replace(text(c), F.lit("\\N"), F.lit("\n")), has("\r"), lambda x: F.regexp_replace(x, r"\r\n?", "\n")), "\n")
    return F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), " ")


def normalize_text(c: Column | str) -> Column:
    return squeeze(F.replace(text(c), F.lit("\\N"), F.lit(" ")))


def text_key(c: Column | str) -> Column:
    r"""STR5: lower-case ASCII letters, digits and Han only. White space goes with the rest, so only \N is replaced before;
    ASCII marks go without a pattern, which would match at each blank."""
    low = F.lower(F.replace(text(c), F.lit("\\N"), F.lit(" ")))
    return F.regexp_replace(F.translate(low, _ASCII_MARKS, ""), "[^a-z0-9一-鿿]+", "")


def text_key_ascii(c: Column | str) -> Column:
    """STR6."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "")


def strip_tags(c: Column | str) -> Column:
    """STR8: entities, override blocks and tags."""
    return music_symbols(F.regexp_replace(F.regexp_replace(unescape(c), OVERRIDE, ""), TAG, ""))


def compare_key(c: Column | str) -> Column:
    """STR7: letters and digits in lower case, runs of anything else one blank."""
    return F.trim(F.regexp_replace(F.lower(strip_tags(c)), r"[^\p{L}\p{N}]+", " "))


def repeated_phrase(c: Column | str) -> Column:
    """AGG7: two equal clauses of two words or more."""
    parts = F.filter(F.transform(F.split(text(c), "[.!?;]+"), compare_key), lambda x: x.contains(" "))
    return F.size(parts) > F.size(F.array_distinct(parts))


def strip_speaker(c: Column | str) -> Column:
    """STR10: leading speaker tags, again and again; the pattern ends in its own white space, so a repeat suffices."""
    body = SPEAKER.removeprefix("(?U)^")
    return normalize_inline(F.regexp_replace(normalize_inline(c), f"(?U)^(?:{body})+", ""))


def speaker_only(c: Column | str) -> Column:
    """FLT3."""
    return normalize_inline(c).rlike(SPEAKER_ONLY)


def has_note(c: Column | str) -> Column:
    """STR41."""
    return text(c).contains("♪") | text(c).contains("♫")


def labels(c: Column | str) -> Column:
    """STR12, first part: bracketed labels in order."""
    return F.transform(F.regexp_extract_all(normalize_inline(strip_tags(c)), F.lit(LABEL), F.lit(1)), strip)


def without_labels(c: Column | str) -> Column:
    """STR12, second part: what is spoken; remnants without a letter, digit or note are empty."""
    body = normalize_inline(F.regexp_replace(normalize_inline(strip_tags(c)), LABEL, " "))
    body = F.regexp_replace(body, r"(?U)^\s*:\s*", "")
    body = F.regexp_replace(body, r"(?U)^\s*[-–—]\s*[-–—]\s*", "- ")
    return F.when(body.rlike(r"[\p{L}\p{N}]") | has_note(body), body).otherwise("")


def ocr_label(c: Column | str) -> Column:
    """STR14."""
    return F.translate(text(c), "l1", "II")


def label_is_chant(c: Column | str) -> Column:
    return ocr_label(c).rlike(r"(?iu)\b(chant(?:ing)?|incantation|spell(?:casting)?|whispering continues)\b")


def label_is_music(c: Column | str) -> Column:
    return ocr_label(c).rlike(r"(?iu)\b(song|singing|sings|lyrics?|chorus)\b")


def has_han(c: Column | str) -> Column:
    return text(c).rlike(HAN)


def has_latin(c: Column | str) -> Column:
    return text(c).rlike("[A-Za-z]")


def words(c: Column | str) -> Column:
    """Latin words in lower case without apostrophes."""
    return F.transform(F.regexp_extract_all(text(c), F.lit(WORD), F.lit(0)), lambda w: F.replace(F.lower(w), F.lit("'"), F.lit("")))


def tokens(c: Column | str) -> Column:
    """STR31."""
    return F.transform(F.regexp_extract_all(text(c), F.lit(TOKEN), F.lit(0)), lambda w: F.lower(F.replace(w, F.lit("’"), F.lit("'"))))


def reading_units(c: Column | str) -> Column:
    """AGG12: Han characters and Latin words."""
    x = normalize_text(c)
    return F.regexp_count(x, F.lit(HAN)) + F.regexp_count(x, F.lit("[A-Za-z0-9]+"))


def visible_ass(c: Column | str) -> Column:
    """STR28: without override blocks, line marks as blanks."""
    return squeeze(F.regexp_replace(F.regexp_replace(text(c), r"\{[^}]*\}", ""), r"\\[Nnh]", " "))


def ass_text(c: Column | str) -> Column:
    r"""STR30: trimmed lines joined by \N, braces as parentheses."""
    lines = F.split(F.regexp_replace(F.replace(music_symbols(c), F.lit("\\N"), F.lit("\n")), r"\r\n?", "\n"), "\n")
    return F.translate(F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), "\\N"), "{}", "()")


def bilingual_text(zh: Column | str, en: Column | str, size: int = 42) -> Column:
    """Chinese above English, the latter with a size tag; empty sides are left out."""
    return F.concat_ws("\\N", F.when(text(zh) != "", ass_text(zh)), F.when(text(en) != "", F.concat(F.lit(f"{{\\fs{size}}}"), ass_text(en))))


def mark_wrapped(c: Column | str, mark: str, on: Column) -> Column:
    """STR15: the text between two marks where ``on`` holds; old marks go first."""
    core = strip(F.regexp_replace(text(c), f"^[{mark}\\s]+|[{mark}\\s]+$", ""))
    return F.when(on & (core != ""), F.concat(F.lit(f"{mark} "), core, F.lit(f" {mark}"))).otherwise(core)


def to_simplified(c: Column | str, traditional: str, simplified: str) -> Column:
    """STR19: a character table given as two strings."""
    return F.translate(text(c), traditional, simplified)


def cache_text(c: Column | str) -> Column:
    """STR34: white space squeezed, none between Han characters."""
    return where(squeeze(c), lambda x: x.rlike(f"{HAN}\\s+{HAN}"), lambda x: F.regexp_replace(x, f"(?<={HAN})\\s+(?={HAN})", ""))


def preview(c: Column | str, limit: int) -> Column:
    """STR35."""
    x = squeeze(c)
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, max(limit - 3, 0)), F.lit("..."))).otherwise(x)


def word_pattern(term: Column | str) -> Column:
    """STR56: a pattern for a whole word or phrase; blanks match any white space."""
    quoted = F.regexp_replace(normalize_text(term), r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    return F.concat(F.lit("(?iuU)(?<![0-9A-Za-z])"), F.regexp_replace(quoted, " ", r"\\s+"), F.lit("(?![0-9A-Za-z])"))


def folded(c: Column | str) -> Column:
    """A text in which letters that differ in case only are the same."""
    return F.lower(F.upper(col(c)))


def pieces(c: Column | str) -> Column:
    """What texts and terms meet by, of folded text: runs of ASCII letters and digits, and all other characters one by one. A
    whole word or phrase in a text has its pieces there, since only ASCII letters and digits end it. One class of characters
    is much faster than a union of ranges; folded text has no capitals."""
    return F.regexp_extract_all(col(c), F.lit(r"\p{Alnum}+|\S"), F.lit(0))


def longest_piece(c: Column | str) -> Column:
    """The piece that terms are looked up by; of equal lengths the last in order."""
    return F.array_max(F.transform(pieces(c), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]


# Endings of signs, and words of caption credits.
SIGN_ENDINGS = ["大道", "大街", "公路", "路口", "中心", "广场"]
CREDIT = r"(?i)captioned by|captioning sponsored|sponsored by|media access group|access\.wgbh\.org|wgbh\b|closed caption|subtitled by|encoded by|sync by|ripper|\bwww\.|\.com\b|viewers like you|contributions to your"
SPONSOR = r"^\s*and\s+[A-Z][A-Za-z0-9 &.'+-]{1,30}\.?\s*$"


def noise_fragment(c: Column | str, low_value: Column | None = None) -> Column:
    """FLT6: too little text to be worth a translation. ``low_value``: an array of texts known to be so."""
    bare = F.regexp_replace(text(c), "[^0-9A-Za-z一-鿿]", "")
    n, han, latin, digits = F.length(bare), F.regexp_count(bare, F.lit(HAN)), F.regexp_count(bare, F.lit("[A-Za-z]")), F.regexp_count(bare, F.lit("[0-9]"))
    vowels = F.regexp_count(bare, F.lit("[AEIOUaeiou]"))
    sign = (han == 1) | ((han <= 3) & reduce(Column.__or__, [bare.endswith(e) for e in SIGN_ENDINGS]))
    if low_value is not None:
        sign = sign | F.array_contains(low_value, bare)
    letters = (n <= 2) | ((latin >= 4) & (vowels == 0)) | ((latin <= 4) & (vowels <= 1))
    return (n <= 1) | ((latin == 0) & (digits == 0) & sign) | ((han == 0) & (latin > 0) & letters) | ((han == 0) & (latin == 0) & (n <= 3))


def credit_text(c: Column | str) -> Column:
    """FLT7: caption credits and a sponsor's line; an empty text counts as one."""
    x = normalize_text(c)
    return (x == "") | x.rlike(CREDIT) | x.rlike(SPONSOR)
