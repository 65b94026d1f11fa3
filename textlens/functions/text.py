"""Text expressions. All are built-in Spark functions; none needs a Python worker."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlens.functions.constants import NA_STRINGS

# The code points Python's str methods and \s take for whitespace. Java's \s is ASCII
# only, and trim() strips nothing but spaces unless told otherwise.
WHITESPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
WHITESPACE_CHARS = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))
WHITESPACE = "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in WHITESPACE_RANGES) + "]"
# The same characters for long texts, as two tests of a character. Java asks the ranges of a class one within the other:
# about ten calls for each letter.
QUICK_WHITESPACE = r"(?U)[\s\x1c-\x1f]"
# Letters that survive cleaning: a-z, and the two other characters whose lower case starts with one.
LETTER = r"[a-zA-Z\x{212a}\x{130}]"
# Line ends as Python's splitlines sees them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
# Java would also read "5.0f" or "0x1p3" as a double.
NUMBER = r"(?i)\A\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.trim(_col(c), F.lit(WHITESPACE_CHARS))


def normalize_whitespace(c: Column | str) -> Column:
    """Turn every run of whitespace into one space and strip the ends."""
    return F.trim(F.regexp_replace(_col(c), f"{QUICK_WHITESPACE}+", " "))


def clean_text(c: Column | str) -> Column:
    """Lower-case, keep letters a-z, one space between words; null becomes empty."""
    lowered = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.trim(F.regexp_replace(lowered, "[^a-z]+", " "))


def has_letters(c: Column | str) -> Column:
    """True where clean_text would not be empty; stops at the first letter."""
    return F.coalesce(_col(c).rlike(LETTER), F.lit(False))


def blank_placeholders(c: Column | str, placeholders: Iterable[str]) -> Column:
    """Strip the value; null and placeholder phrases (in any case) become empty."""
    phrases = sorted({p.lower().strip() for p in placeholders})
    longest = 4 * max(len(p) for p in phrases)
    value = strip(F.coalesce(_col(c), F.lit("")))
    # The cheap length test spares long texts the lower-casing.
    is_placeholder = (F.octet_length(value) <= longest) & F.lower(value).isin(*phrases)
    return F.when(is_placeholder, F.lit("")).otherwise(value)


def na_to_null(c: Column | str) -> Column:
    """Null for the strings that mean "missing" in a CSV file."""
    return F.when(~_col(c).isin(*NA_STRINGS), _col(c))


def to_number(c: Column | str) -> Column:
    """Double, or null where the text is not a plain decimal number."""
    return F.when(_col(c).cast("string").rlike(NUMBER), F.trim(_col(c).cast("string")).try_cast("double"))


def excerpt(c: Column | str, limit: int = 220) -> Column:
    """Whitespace-normalised text, cut to ``limit`` characters with a closing "..."."""
    compact = normalize_whitespace(F.coalesce(_col(c), F.lit("")))
    return F.when(F.length(compact) <= limit, compact).otherwise(
        F.concat(F.substring(compact, 1, limit - 3), F.lit("..."))
    )


def word_tokens(clean: Column | str, stop_words: Iterable[str] = ()) -> Column:
    """Words of two or more letters of a cleaned text, in order, without stop words."""
    words = F.split(_col(clean), " ")
    stops = sorted(set(stop_words))
    if not stops:
        return F.filter(words, lambda w: F.length(w) >= 2)
    return F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(*stops))
