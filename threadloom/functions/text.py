"""Scalar text functions as Column expressions, with the Unicode rules made explicit.

White space, word characters and case are Unicode's throughout (``(?U)``); a
null argument gives null unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the style measures.
PUNCTUATION = ".,;:!?—-()[]\"'"
FUNCTION_WORDS = ("the", "a", "to", "and", "i", "it", "that", "is", "of", "you", "for", "in", "but", "so", "just", "not", "have", "do")

# Fixed value: the tokens of a question's shape.
SHAPE_TOKEN = r"([A-Za-z0-9.+#-]+)"

SPACE = r"[\s\x1c-\x1f\x85 ]"
_PUNCT_CLASS = r"[.,;:!?—\-()\[\]\"']"


def trim_u(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(F.length(trim_u(c)) == 0, F.lit(True))


def source_key(c: Column) -> Column:
    """A source name without case and outer blanks."""
    return F.lower(trim_u(c))


def collapse_space(c: Column) -> Column:
    return trim_u(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def words(c: Column) -> Column:
    """Lower-cased words between white space, outer punctuation stripped, empty ones dropped."""
    raw = F.transform(F.split(F.lower(c), rf"(?U){SPACE}+"), lambda w: F.regexp_replace(w, rf"^{_PUNCT_CLASS}+|{_PUNCT_CLASS}+$", ""))
    return F.filter(raw, lambda w: w != "")


def n_punctuation(c: Column) -> Column:
    return F.regexp_count(c, F.lit(_PUNCT_CLASS))


def n_symbols(c: Column) -> Column:
    """Characters of the category So, which holds the emoji."""
    return F.regexp_count(c, F.lit(r"\p{So}"))


def n_upper(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{IsUppercase}"))


def strip_fences(c: Column) -> Column:
    """Without blocks between triple backticks."""
    return trim_u(F.regexp_replace(c, r"(?s)```.*?```", ""))


def strip_tags(c: Column) -> Column:
    """Without reminder blocks and without command blocks, each closed by the tag that opened it."""
    c = F.regexp_replace(c, r"(?s)<system-reminder>.*?</system-reminder>", "")
    # The names of the command blocks.
    names = "|".join(("command-name", "command-message", "local-command-stdout", "local-command-caveat"))
    return F.regexp_replace(c, rf"(?s)<({names})>.*?</\1>", "")


def prose_chars(c: Column) -> Column:
    return F.length(strip_fences(c))


def looks_pasted(raw: Column, prose: Column, limit: int = 8000) -> Column:
    """More than ``limit`` characters of prose, or more than half of the raw text removed; both strict."""
    return (F.length(prose) > limit) | (F.length(raw) - F.length(prose) > F.length(raw) / 2)


def strip_quoted(c: Column) -> Column:
    """A mail body up to the first attribution line or signature separator, without quoted lines."""
    c = F.regexp_replace(c, r"(?ms)^On [^\n]*wrote:\s*$.*", "")
    c = F.regexp_replace(c, r"(?ms)^--\s*$.*", "")
    return trim_u(F.array_join(F.filter(F.split(c, "\n"), lambda x: ~F.ltrim(x).startswith(">")), "\n"))


def thread_bucket(c: Column) -> Column:
    """0 to 99 from the first four bytes of the thread id's SHA-256."""
    return F.pmod(F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def short_hash(n: int, *parts: Column) -> Column:
    """First ``n`` hexadecimal digits of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, n)


def question_shape(c: Column) -> Column:
    """A question without words that are capitalised or hold a digit (the first is kept), in small letters."""
    toks = F.regexp_extract_all(c, F.lit(SHAPE_TOKEN), 1)
    kept = F.filter(toks, lambda t, i: (i == 0) | ~t.rlike(r"^[A-Z]|[0-9]"))
    return F.lower(F.array_join(kept, " "))


def dedupe_key(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""), 1, 90)


def letter_tokens(c: Column) -> Column:
    """Distinct words of the letters a to z and blanks."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z ]", ""), " +"), lambda t: t != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Common part of two arrays of distinct elements; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def truncate_id(c: Column, keep: int = 4) -> Column:
    return F.when(F.length(c) <= keep, F.repeat(F.lit("*"), F.length(c))).otherwise(F.concat(F.substring(c, 1, keep), F.lit("…("), F.length(c).cast("string"), F.lit(" chars)")))


def apple_time(c: Column) -> Column:
    """Seconds or nanoseconds since 2001 (told apart by size) to a timestamp; null and 0 are 2001-01-01."""
    v = F.coalesce(c.cast("bigint"), F.lit(0))
    return F.timestamp_micros(F.lit(978307200000000) + F.when(F.abs(v) > 1_000_000_000_000, F.floor(v / 1000)).otherwise(v * 1_000_000).cast("bigint"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson interval; (0, 1) for n = 0, an error for impossible counts."""
    p = k / F.nullif(n, F.lit(0))
    d = 1 + z * z / n
    mid = (p + z * z / (2 * n)) / d
    half = z / d * F.sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))
    bad = F.raise_error(F.lit("counts must satisfy 0 <= k <= n"))
    lo = F.when((k < 0) | (n < 0) | (k > n), bad.cast("double")).when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), mid - half))
    return lo, F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), mid + half))
