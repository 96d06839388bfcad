"""Per-document statistics and word-frequency aggregates.

Counts are per-row expressions, word frequencies too: a document's sorted word
list is cut into runs of equal words inside its row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.functions import text as T


def doc_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              bytes_col: str | None = None) -> DataFrame:
    """``(id, paragraph_count, word_count, character_count)``, all int.

    ``bytes_col`` (raw byte count from the content) overrides the UTF-8
    length of the decoded text when given.
    """
    chars = F.col(bytes_col).cast("int") if bytes_col else T.character_count(text_col)
    return docs.select(
        F.col(id_col),
        T.paragraph_count(text_col).alias("paragraph_count"),
        T.word_count(text_col).alias("word_count"),
        chars.alias("character_count"),
    )


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Long form of the word list: ``(id, pos, word)``, ``pos`` from 0."""
    return docs.select(F.col(id_col), F.posexplode(T.tokens(text_col)).alias("pos", "word"))


def significant_word_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          stop_words: Iterable[str] = T.DEFAULT_STOP_WORDS) -> DataFrame:
    """``(id, pos, word)`` of significant words, repeats kept."""
    return docs.select(F.col(id_col),
                       F.posexplode(T.significant_words(text_col, stop_words)).alias("pos", "word"))


def unique_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 stop_words: Iterable[str] = T.DEFAULT_STOP_WORDS) -> DataFrame:
    """``(id, unique_words)``: number of distinct significant words."""
    w = docs.select(F.col(id_col), T.significant_words(text_col, stop_words).alias("w"))
    return w.select(F.col(id_col), T.unique_word_count("w").alias("unique_words"))


def word_frequencies(docs: DataFrame, k: int | None = None, id_col: str = "doc_id",
                     text_col: str = "text",
                     stop_words: Iterable[str] = T.DEFAULT_STOP_WORDS) -> DataFrame:
    """Word-cloud data: significant words per document as rows ``(id, rank,
    text, value)``, by count descending then word ascending; all of them, or
    the top ``k``."""
    if k is not None and k < 1:
        raise ValueError("k must be positive")
    words = docs.select(F.col(id_col), T.significant_words(text_col, stop_words).alias("w"))
    counted = T.counted(words, "w", id_col)
    ranked = F.array_sort(F.transform("counted", lambda c: F.struct((-c["value"]).alias("less"), c["item"].alias("text"))))
    if k is not None:
        ranked = F.slice(ranked, 1, k)
    # an outer explode: the filter that Spark infers for an inner one would
    # repeat the counting inside its own lambda
    rows = counted.select(F.col(id_col), F.posexplode_outer(ranked).alias("pos", "r")).filter(F.col("pos").isNotNull())
    return rows.select(id_col, (F.col("pos") + 1).alias("rank"), "r.text", (-F.col("r.less")).alias("value"))
