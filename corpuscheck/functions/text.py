"""Column expressions for the text rules (counts, words, n-grams, hashes).

Everything here is a built-in Spark expression, so it runs inside whole-stage
codegen on the executors; nothing calls back into Python per row.

Semantics kept from the original service:

* words are fields separated by runs of Unicode White_Space characters;
* paragraphs are the pieces of a split on the literal two-character string
  ``"\\n\\n"`` that are not blank after trimming White_Space;
* "characters" are UTF-8 bytes;
* significant words: stray bytes become one U+FFFD each, lower-case per code point, every punctuation code point
  (general category P) becomes one space, split into words, stop words out;
* n-grams are ``n`` consecutive words joined by one space; fewer than ``n``
  words give none.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the original service's) ----------------------
# English stop words dropped from significant words.
DEFAULT_STOP_WORDS: tuple[str, ...] = (
    "a", "an", "the", "and", "or", "but",
    "is", "are", "was", "were", "be", "been",
    "in", "on", "at", "to", "for", "with",
    "by", "of", "about", "from",
    "this", "that", "these", "those",
    "it", "its", "it's", "they", "them", "their",
)
# Default n-gram size and Jaccard threshold of the plagiarism check.
DEFAULT_NGRAM_SIZE = 3
DEFAULT_THRESHOLD = 0.3
# ---------------------------------------------------------------------------

# Up to this size an n-gram is put together from its words, without a slice of the list.
MAX_NAMED_WORDS = 8

# The 25 Unicode White_Space code points, as a Java regex character class.
# Java's \s is ASCII-only, so the class is spelled out.
WS_CHARS = (r"\t\n\x0B\f\r \x85\xA0\u1680\u2000-\u200A"
            r"\u2028\u2029\u202F\u205F\u3000")
WS_RUN = f"[{WS_CHARS}]+"
NON_WS_RUN = f"[^{WS_CHARS}]+"
NON_WS_CHAR = f"[^{WS_CHARS}]"
# Narrower class used by the whitespace-collapse helper (RE2-style \s).
ASCII_SPACE_RUN = r"[\t\n\f\r ]+"
# What separates significant words: blanks, and punctuation, which counts as a blank.
BREAK_RUN = rf"[{WS_CHARS}\p{{P}}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def character_count(c: Column | str) -> Column:
    """UTF-8 byte length (works on string and binary columns)."""
    return F.octet_length(_col(c)).cast("int")


def word_count(c: Column | str) -> Column:
    """Number of White_Space-separated fields.

    (``regexp_count`` gives the same number but materialises every match as
    a string; counting the non-empty pieces of a split is ~4x cheaper.)"""
    return F.size(tokens(c)).cast("int")


def paragraph_count(c: Column | str) -> Column:
    """Pieces of a split on ``\\n\\n`` holding at least one non-blank char."""
    pieces = F.split(_col(c), "\n\n", -1)
    return F.size(F.filter(pieces, lambda p: F.regexp_like(p, F.lit(NON_WS_CHAR)))).cast("int")


def tokens(c: Column | str) -> Column:
    """Words in order, case and punctuation kept."""
    return F.filter(F.split(_col(c), WS_RUN, -1), lambda w: w != "")


# UTF-8 sequences, with a byte for each character (Unicode, table 3-7).
_CONT = r"[\x80-\xBF]"
_TWO = rf"[\xC2-\xDF]{_CONT}"
_THREE = rf"(?:\xE0[\xA0-\xBF]|[\xE1-\xEC\xEE\xEF]{_CONT}|\xED[\x80-\x9F]){_CONT}"
_FOUR = rf"(?:\xF0[\x90-\xBF]|[\xF1-\xF3]{_CONT}|\xF4[\x80-\x8F]){_CONT}{_CONT}"
# A byte of no sequence: a lead that none starts with, or a byte that follows no such lead closely enough.
_STRAY = (rf"(?!{_TWO}|{_THREE}|{_FOUR})[\xC0-\xFF]"
          rf"|(?<!(?={_TWO}|{_THREE}|{_FOUR})[\xC2-\xF4])(?<!(?={_THREE}|{_FOUR})[\xE0-\xF4]{_CONT})"
          rf"(?<!(?={_FOUR})[\xF0-\xF4]{_CONT}{_CONT}){_CONT}")


def decoded(c: Column | str) -> Column:
    """Text of UTF-8 bytes (string or binary) with one U+FFFD for *each* stray byte.

    The JVM gives one for a whole broken sequence, so it is not asked to: bytes
    are looked at as Latin-1 characters, stray ones replaced by the three bytes
    of U+FFFD. Valid texts, thus nearly all, are only checked.
    """
    as_text = _col(c).cast("string")
    latin = F.decode(_col(c).cast("binary"), "ISO-8859-1")
    mended = F.regexp_replace(latin, _STRAY, "\xef\xbf\xbd")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(F.encode(mended, "ISO-8859-1"), "UTF-8"))


def lower_per_codepoint(c: Column | str) -> Column:
    """Lower-case one code point at a time.

    The JVM lower-cases final capital sigma to final sigma and dotted capital
    I to ``i`` + combining dot; a per-code-point mapping gives plain sigma and
    plain ``i``. Mapping those two first gives the per-code-point answer.
    """
    # two byte searches, where ``translate`` would look at every character
    return F.lower(F.replace(F.replace(_col(c), F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))


def significant_words(c: Column | str,
                      stop_words: Iterable[str] = DEFAULT_STOP_WORDS) -> Column:
    """Lower-cased words with punctuation as blanks, stop words out."""
    stops = list(dict.fromkeys(stop_words))
    words = F.split(lower_per_codepoint(decoded(c)), BREAK_RUN, -1)
    if stops:
        return F.filter(words, lambda w: (w != "") & ~w.isin(stops))
    return F.filter(words, lambda w: w != "")


def ngrams(words: Column | str, n: int = DEFAULT_NGRAM_SIZE) -> Column:
    """``n`` consecutive words joined by a space; empty if fewer than ``n``.

    ``words`` should be a column that is already computed (a named column),
    so the word list is not re-derived inside the lambda for every n-gram.
    """
    check_ngram_size(n)
    w = _col(words)
    if n <= MAX_NAMED_WORDS:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - n),
                            lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
    else:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)),
                            lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>"))


def whitespace_collapsed(c: Column | str) -> Column:
    """Runs of ASCII blanks become one space; ends are not trimmed."""
    return F.regexp_replace(_col(c), ASCII_SPACE_RUN, " ")


def normalized_text(words: Column | str) -> Column:
    """Significant words joined by one space."""
    return F.array_join(_col(words), " ")


def sha256_hex(c: Column | str) -> Column:
    """Lower-case hex SHA-256 of a binary column or of a string's UTF-8 bytes."""
    return F.sha2(_col(c), 256)


def unique_word_count(words: Column | str) -> Column:
    """Number of distinct significant words."""
    return F.size(F.array_distinct(_col(words))).cast("int")


def check_ngram_size(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"n-gram size must be a positive integer, got {n!r}")


def check_threshold(t: float) -> None:
    if not (0.0 < float(t) <= 1.0):
        raise ValueError(f"similarity threshold must be in (0, 1], got {t!r}")


def counted(rows: DataFrame, items: str, *keep: str) -> DataFrame:
    """``rows`` with ``counted``: an array of ``(item, value)``, the distinct
    entries of the array column ``items`` and how often each occurs.

    The sorted array is cut where neighbours differ; each step is a named
    column, so that no lambda derives it again.
    """
    ordered = rows.select(*keep, F.sort_array(items).alias("_s"))
    starts = ordered.withColumn("_at", F.expr(
        "IF(size(_s) > 0, filter(sequence(1, size(_s)), i -> i = 1 OR _s[i - 1] <> get(_s, i - 2)), CAST(array() AS array<int>))"))
    return starts.select(*keep, F.expr(
        "transform(_at, (a, j) -> named_struct('item', _s[a - 1], "
        "'value', coalesce(get(_at, j + 1), size(_s) + 1) - a))").alias("counted"))
