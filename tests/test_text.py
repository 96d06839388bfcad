"""Text rules against the original service's unit tables and edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuscheck.functions import text as T

COUNTS = [
    ("", 0, 0, 0),
    ("Salt", 1, 1, 4),
    ("Nine grey herons stood by the weir.", 1, 7, 35),
    ("Rain at dawn.\n\nWind by noon.\n\nFog at night, then frost.", 3, 11, 55),
    ("North.\n\n\n\nSouth.", 2, 2, 16),
    ("\n\n \t\n\n", 0, 0, 6),
    ("a\n\n\nb", 2, 2, 5),
    ("a\r\n\r\nb", 1, 2, 6),
]


def _one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize("text,paragraphs,words,chars", COUNTS)
def test_counts(spark, text, paragraphs, words, chars):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(T.paragraph_count("t").alias("p"), T.word_count("t").alias("w"),
                  T.character_count("t").alias("c")).first()
    assert (r.p, r.w, r.c) == (paragraphs, words, chars)


def test_ngrams_of_raw_words(spark):
    rows = [("",), ("Red kite",), ("Red kite over Leeds",), ("Red kite over Leeds again",)]
    df = spark.createDataFrame(rows, "t string").withColumn("w", T.tokens("t"))
    got = [(r.n2, r.n3) for r in df.select(T.ngrams("w", 2).alias("n2"), T.ngrams("w", 3).alias("n3")).collect()]
    assert got[0] == ([], [])
    assert got[1] == (["Red kite"], [])
    assert got[2][0] == ["Red kite", "kite over", "over Leeds"]
    assert got[3][1] == ["Red kite over", "kite over Leeds", "over Leeds again"]


def test_whitespace_collapse_keeps_one_space_at_ends(spark):
    assert _one(spark, "\t\tone \r\n two\f three  ", T.whitespace_collapsed) == " one two three "


@pytest.mark.parametrize("text,expected", [
    ("THIS Was Oak", "this oak"),
    ("This; the (old) oak!", "this old oak"),
    ("  this\n\tand \t that  oak ", "this oak"),
])
def test_normalise_with_edited_stop_list(spark, text, expected):
    stops = [w for w in T.DEFAULT_STOP_WORDS if w != "this"]
    got = _one(spark, text, lambda c: T.normalized_text(T.significant_words(c, stops)))
    assert got == expected


def test_counted_runs_of_equal_items(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c", "b"]), (2, []), (3, ["x"])], "id long, w array<string>")
    got = {r.id: [tuple(c) for c in r.counted] for r in T.counted(df, "w", "id").collect()}
    assert got == {1: [("a", 1), ("b", 3), ("c", 1)], 2: [], 3: [("x", 1)]}


def test_symbols_are_not_punctuation_and_its_leaves_s(spark):
    got = _one(spark, "a$b c+d e|f x^y it's", T.significant_words)
    assert got == ["a$b", "c+d", "e|f", "x^y", "s"]


def test_unicode_whitespace_and_case(spark):
    # no-break space splits words, zero-width space does not
    assert _one(spark, "x\u00a0y z\u200bw", T.tokens) == ["x", "y", "z\u200bw"]
    # final capital sigma lowers to plain sigma, dotted capital I to plain i
    assert _one(spark, "\u039f\u0394\u039f\u03a3 \u0130", T.significant_words) == ["\u03bf\u03b4\u03bf\u03c3", "i"]


def test_unique_words(spark):
    got = _one(spark, "Apple apple, APPLE! pear", lambda c: T.unique_word_count(T.significant_words(c)))
    assert got == 2


def test_parameter_checks():
    with pytest.raises(ValueError):
        T.check_threshold(0.0)
    with pytest.raises(ValueError):
        T.check_threshold(1.5)
    with pytest.raises(ValueError):
        T.check_ngram_size(0)
    T.check_threshold(1.0)


def test_cyrillic_case_and_quote_punctuation(spark):
    # guillemets (Pi/Pf) and the em dash (Pd) are punctuation; no stop words apply
    text = "«Привет» — МИР! привет-мир"
    assert _one(spark, text, T.significant_words) == ["привет", "мир", "привет", "мир"]
    assert _one(spark, text, T.word_count) == 4


def test_words_are_cut_in_one_pass(spark):
    """Punctuation and blanks are one separator: the words are those of the two-step form."""
    texts = ["", " ", "...", "It's A-b.c d—e «f» ΣΑΣ İx", "a\x85b\x0bc,,  d!", "　x_y z#$%q"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    two = F.split(F.regexp_replace(F.lower(F.translate("text", "İΣ", "iσ")), r"\p{P}", " "), T.WS_RUN, -1)
    stops = list(T.DEFAULT_STOP_WORDS)
    for got, want in df.select(T.significant_words("text"), F.filter(two, lambda w: (w != "") & ~w.isin(stops))).collect():
        assert got == want
    plan = df.select(T.significant_words("text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan
    for n in (1, 2, 3, 9):
        for w, g in df.select(T.tokens("text").alias("w")).select("w", T.ngrams("w", n)).collect():
            assert g == [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
