"""N-gram sets and the exact Jaccard similarity join.

Two documents are *similar* when their normalised texts are equal (equal
SHA-256 of the normalised text; two texts that normalise to "" match) **or**
the Jaccard index of their distinct word n-gram sets is ``>= threshold``.

Plan (no cross join, no all-pairs enumeration of a group):

1. ``gram_sets`` turns each text into ``(id, norm_hash, n, n_grams, tokens,
   norm)`` once and writes it; everything below reads that copy. ``tokens`` are
   64-bit codes of the distinct grams. Neither these nor the gram strings are
   stored, since ``norm`` gives them back to the steps that need them.
2. Documents of equal normalised text are one *class*, named by its smallest
   id (``class_members``). Only that representative takes part below.
3. Representatives go through a prefix-filtered equi-join (AllPairs/PPJoin,
   public papers): tokens are ordered globally by document frequency. Of two
   sets with Jaccard >= t, the larger one's first ``n - ceil(t n) + 1`` tokens
   (its probe prefix) and the smaller one's first ``n - ceil(2t/(1+t) n) + 1``
   (its index prefix) share one, and at their first common token at least
   ``ceil(t/(1+t) (na + nb))`` tokens of either set are still to come. The
   positions and sizes travel with the prefix rows, and the join keeps only
   rows that allow this, and of a run of common tokens only the first: near
   copies share hundreds, and a pair would be shuffled for each partition of
   them. So a line that many otherwise different documents hold, which sorts
   last by frequency, is outside their index prefixes unless it is about half
   of such a document. A document whose own grams collide keeps
   its whole set and is exempt from the position tests, so no true pair is lost.
4. Candidates are verified by groups (``operators/overlap.py``): a text travels
   once for each group of neighbours it belongs to, not once for each of its
   pairs, and the n-grams themselves, not their codes, decide.
5. The answer is stored as classes and links between representatives
   (``class_members``, ``class_links``): as many rows as there are documents,
   plus a row for each similar pair of *different* texts. Whether a file has an
   earlier similar one follows from these (``similar_flags``); pairs and lists of
   ids are expanded on request (``expand_links``, ``earlier_similar``).

``cross_similar`` (probes against a corpus: incremental batches, stream,
benchmark checks) ranks only the probe side and joins its prefix tokens with
the corpus's postings, one row for each token of a representative. Stored as
a table bucketed by token (``operators/postings.py``), they are neither exploded
nor shuffled again by any batch.

The self-join counts document frequencies in the same exchange that deals the
tokens by hash; probes join theirs from the postings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscheck.functions import text as T
from corpuscheck.operators.overlap import grouped_jaccard, row_jaccard
from corpuscheck.operators.postings import Postings, default_buckets, stored_postings, write_bucketed
from corpuscheck.session import materialize, scratch_path

EPS = 1e-9
#: Token rows that a partition of the self-join sorts at most (about 60 bytes each in memory).
PARTITION_TOKENS = 3_000_000
#: Common prefix tokens of a candidate pair, if it must share so many.
COMMON = 4


# --------------------------------------------------------------------------
# per-document preparation
# --------------------------------------------------------------------------

GRAM_COLS = ("id", "norm_hash", "n", "n_grams", "tokens", "norm")


def gram_sets(docs: DataFrame, n: int = T.DEFAULT_NGRAM_SIZE,
              stop_words: Iterable[str] = T.DEFAULT_STOP_WORDS,
              id_col: str = "file_id", text_col: str = "text",
              keep: Iterable[str] = (), persist: bool = True) -> DataFrame:
    """``(id, norm_hash, n, n_grams, tokens, norm, *keep)`` per document.

    ``norm`` is the normalised text, ``n_grams`` the number of its distinct
    n-grams and ``tokens`` their distinct 64-bit hashes. With ``persist`` the
    frame is written under the checkpoint folder, since the similarity join
    reads it several times, but for ``tokens``: they are twice the size of the
    text, and whoever reads them (most readers don't) derives them from ``norm``.
    """
    T.check_ngram_size(n)
    keep = list(keep)
    words = docs.select(F.col(id_col).alias("id"), *keep,
                        T.significant_words(text_col, stop_words).alias("words"))
    gs = words.select("id", *keep, T.normalized_text("words").alias("norm"),
                      F.array_distinct(T.ngrams("words", n)).alias("grams"))
    gs = gs.select("id", *keep, T.sha256_hex("norm").alias("norm_hash"), F.lit(n).alias("n"), F.size("grams").alias("n_grams"),
                   _codes("grams").alias("tokens"), "norm")
    if not persist:
        return gs
    columns = gs.columns
    gs = materialize(gs.drop("tokens"), "gram_sets")
    # a text without words would split to one empty piece
    words = gs.withColumn("words", F.when(F.col("norm") != "", F.split("norm", " ")))
    return words.withColumn("tokens", _codes(T.ngrams("words", n))).select(*columns)


def _codes(grams):
    return F.array_distinct(F.transform(grams, lambda g: F.xxhash64(g)))


def ngram_frequency(docs: DataFrame, n: int = T.DEFAULT_NGRAM_SIZE,
                    stop_words: Iterable[str] = T.DEFAULT_STOP_WORDS,
                    id_col: str = "file_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ngram, freq)``: n-grams of the normalised text, counted
    inside each document's row."""
    words = docs.select(F.col(id_col), T.significant_words(text_col, stop_words).alias("words"))
    grams = words.select(F.col(id_col), T.ngrams("words", n).alias("grams"))
    # an outer explode: see ``stats.word_frequencies``
    counted = (T.counted(grams, "grams", id_col).select(id_col, F.explode_outer("counted").alias("c"))
               .filter(F.col("c").isNotNull()))
    return counted.select(id_col, F.col("c.item").alias("ngram"), F.col("c.value").alias("freq"))


# --------------------------------------------------------------------------
# building blocks
# --------------------------------------------------------------------------

def pair_jaccard(pairs: DataFrame, gs: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Jaccard of given pairs over their n-gram *sets*; empty union -> 0.0.

    Only the normalised texts are shuffled; grams are derived where both are."""
    texts = gs.select("id", "n", "norm")
    l = texts.select(F.col("id").alias(left), F.col("n").alias("_na"), F.col("norm").alias("_ta"))
    r = texts.select(F.col("id").alias(right), F.col("n").alias("_nb"), F.col("norm").alias("_tb"))
    return row_jaccard(pairs.join(l, left).join(r, right))


def _tokens(gs: DataFrame, *keep: str) -> DataFrame:
    """``(id, n_grams, n_tok, *keep, h)``: one row per distinct gram hash."""
    # an outer explode: of an inner one Spark infers a filter on ``tokens``, and pushes their derivation into its lambdas
    return (gs.filter(F.col("n_grams") > 0)
            .select("id", "n_grams", F.size("tokens").alias("n_tok"), *keep, F.explode_outer("tokens").alias("h")))


def _prefix_length(t: float):
    n = F.col("n_grams")
    return n - F.ceil(n * F.lit(t) - F.lit(EPS)) + 1


def _shared_tokens(tok: DataFrame) -> DataFrame:
    """Rows of ``tok`` whose hash more than one document holds, with ``df``, the number of these.

    One exchange of the narrow rows serves the count and the rows; a window
    that outgrows memory is spilled by Spark."""
    return tok.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("df > 1")


def _prefix_tokens(tok: DataFrame, dfs: DataFrame, t: float) -> DataFrame:
    """Each set's probe prefix in the global (df, hash) order, with positions:
    ``(id, n_grams, h, pos, whole)``.

    Tokens held by one document only sort first and can never meet another
    set, so they are dropped by the join with ``dfs`` (df > 1) before the
    window; with ``m`` surviving tokens out of ``n_tok``, the survivor ranked
    ``r`` sits at global position ``n_tok - m + r``. The window partitions by
    document (bounded by one document's size).

    The prefix is exact for the gram strings as long as a document's grams
    hash to distinct values; a document where two grams share a hash
    (``n_tok < n_grams``) keeps all its tokens (``whole``).
    """
    return _shared_prefix(tok.join(dfs, "h"), t, 0).drop("ahead")


def _shared_prefix(ranked: DataFrame, t: float, more: int = COMMON - 1, by: tuple[str, ...] = ("id",)) -> DataFrame:
    """``_prefix_tokens`` of rows that carry their ``df``, with ``prev``, the set's token before, and ``ahead``, 4 bits of
    each of the ``COMMON - 1`` tokens after; prefixes are ``more`` tokens longer.

    Where an id repeats, its sets are ranked together; a token of another one is no ``prev``."""
    ordered = Window.partitionBy(*by).orderBy("df", "h")
    span = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (ranked.withColumn("_r", F.row_number().over(ordered))
              .withColumn("_m", F.count(F.lit(1)).over(span))
              .withColumn("pos", F.col("n_tok") - F.col("_m") + F.col("_r"))
              .withColumn("whole", F.col("n_tok") < F.col("n_grams"))
              .withColumn("_p", F.lag(F.struct("h", "n_grams", "n_tok")).over(ordered))
              .withColumn("prev", F.expr("IF(_p.n_grams = n_grams AND _p.n_tok = n_tok AND _p.h <> h, _p.h, NULL)"))
              .withColumn("ahead", sum(F.coalesce(F.shiftleft(F.lead("h", k).over(ordered).bitwiseAND(15).cast("int"), 4 * k - 4), F.lit(0))
                                       for k in range(1, COMMON))))
    return (placed.filter(F.col("whole") | (F.col("pos") <= _prefix_length(t) + more))
            .select(*by, "n_grams", "h", "pos", "whole", "prev", "ahead"))


def _least_overlap(na: str, nb: str, t: float):
    """Grams that two sets of these sizes must share: ``ceil(t/(1+t) (na+nb))``."""
    return F.ceil((F.col(na) + F.col(nb)) * F.lit(t / (1 + t)) - F.lit(EPS))


def _size_bound(na: str, nb: str, t: float):
    return F.least(F.col(na), F.col(nb)) >= F.greatest(F.col(na), F.col(nb)) * F.lit(t) - F.lit(EPS)


# --------------------------------------------------------------------------
# classes of equal normalised text
# --------------------------------------------------------------------------

def class_members(gs: DataFrame) -> DataFrame:
    """``(id, rep, norm_hash, n_grams)``: every document and its class, the smallest id of equal normalised text."""
    members = gs.select("id", "norm_hash", "n_grams")
    first = members.groupBy("norm_hash").agg(F.min("id").alias("rep"))
    return members.join(first, "norm_hash").select("id", "rep", "norm_hash", "n_grams")


def representatives(gs: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``gs`` whose ids name their class (the others are the smaller list to join with).

    That list is written first: where Spark sees that it is small, ``gs`` is not shuffled."""
    return gs.join(materialize(members.filter("id <> rep").select("id"), "class-copies"), "id", "left_anti")


def similar_flags(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, is_plagiarism)``: is there an earlier similar document?

    Of a class all but the first have one; the first has one if its class is
    the later end of a link. No pair is expanded."""
    later = links.select(F.col("b").alias("rep")).distinct().withColumn("_later", F.lit(True))
    return members.join(later, "rep", "left").select("id", ((F.col("id") != F.col("rep")) | F.col("_later").isNotNull()).alias("is_plagiarism"))


def expand_links(members: DataFrame, links: DataFrame) -> DataFrame:
    """All unordered similar pairs ``(a, b, exact, jaccard)``, ``a < b``, of stored classes and links."""
    return _same_class(members).withColumn("exact", F.lit(True)).select("a", "b", "exact", "jaccard").unionByName(
        _expand(links, members, members).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(False).alias("exact"), "jaccard"))


def earlier_similar(members: DataFrame, links: DataFrame, ids: DataFrame | None = None,
                    order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Edges ``(file_id, similar_file_id)`` to the earlier similar files of the requested ``ids`` (all without).

    ``order`` names the columns of ``members`` that tell which file was first.
    """
    asked = members if ids is None else members.join(ids.select(F.col("file_id").alias("id")).distinct(), "id", "left_semi")
    both = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionAll(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    here = F.struct(*[F.col(c) for c in order])
    asked = asked.select(F.col("id").alias("file_id"), "rep", here.alias("_at"))
    other = members.select(F.col("rep").alias("other"), F.col("id").alias("similar_file_id"), here.alias("_before"))
    classes = asked.join(both, "rep").select("file_id", "_at", "other").unionAll(asked.select("file_id", "_at", F.col("rep").alias("other")))
    return classes.join(other, "other").filter("_before < _at").select("file_id", "similar_file_id")


def _same_class(members: DataFrame) -> DataFrame:
    m1 = members.select(F.col("id").alias("a"), "norm_hash", F.col("n_grams").alias("_n"))
    m2 = members.select(F.col("id").alias("b"), "norm_hash")
    return (m1.join(m2, "norm_hash").filter(F.col("a") < F.col("b"))
            .select("a", "b", _exact_flag_jaccard("_n").alias("jaccard")))


def _expand(rep_pairs: DataFrame, members_a: DataFrame, members_b: DataFrame) -> DataFrame:
    x = members_a.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    y = members_b.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    return rep_pairs.join(x, "a").join(y, "b").select("x", "y", "jaccard")


def _exact_flag_jaccard(n_col: str):
    # equal normalised text: the n-gram sets are equal too (1.0), or both
    # empty (union 0 -> 0.0); either way the pair matches by hash
    return F.when(F.col(n_col) > 0, F.lit(1.0)).otherwise(F.lit(0.0))


# --------------------------------------------------------------------------
# operators
# --------------------------------------------------------------------------

def exact_duplicates(gs: DataFrame) -> DataFrame:
    """Unordered pairs ``(a < b)`` with equal normalised-text hash, expanded from the classes."""
    return _same_class(gs)


def candidate_pairs(gs: DataFrame, threshold: float, members: DataFrame | None = None,
                    persist: bool = True) -> DataFrame:
    """Distinct ``(a, b)``, ``a < b``, among representatives whose prefixes meet often
    enough under the size and position bounds: a superset of the Jaccard matches."""
    t = float(threshold)
    tok = _tokens(representatives(gs, class_members(gs) if members is None else members))
    spread = _spread(gs)
    # both sizes travel as one number, whose second part most documents lack
    packed = tok.select("id", F.expr("n_grams + shiftleft(CAST(n_grams - n_tok AS BIGINT), 32)").alias("_sizes"), "h")
    ranked = _shared_tokens(packed.repartition(spread, "h")).repartition(spread, "id").select(
        "id", F.expr("CAST(_sizes & 4294967295 AS INT)").alias("n_grams"), "h", "df",
        F.expr("CAST((_sizes & 4294967295) - shiftright(_sizes, 32) AS INT)").alias("n_tok"))
    pre = _shared_prefix(ranked, t)
    if persist:
        # both sides of the self-join read the prefix rows: dealt by token and written once, neither is shuffled again
        pre = write_bucketed(pre, scratch_path(gs.sparkSession, "prefix_tokens"), ("h",), spread)
    return _meetings(pre, t)


def cross_candidates(probes_gs: DataFrame, corpus_gs: DataFrame, threshold: float) -> DataFrame:
    """Distinct ``(a, b)``, ``a`` of the corpus and ``b`` a probe, whose prefixes meet as those of ``candidate_pairs`` do.

    Both sides are ranked together, and a probe that is in the corpus is dealt once (``sides`` 3; 1 is a probe, 2 of the
    corpus). Tokens that no probe shares with another set of the corpus sort first, like those of one document in the
    self-join, and go no further than the first exchange."""
    t = float(threshold)
    key = ["id", "norm_hash"]
    both = materialize(probes_gs.select(*key).join(corpus_gs.select(*key), key, "left_semi").distinct(), "probes-stored").withColumn("_in", F.lit(1))
    side = lambda gs, k: _tokens(gs, "_in").select(
        "id", F.expr(f"n_grams + shiftleft(CAST(n_grams - n_tok AS BIGINT), 32) + shiftleft({k}, 61)").alias("_sizes"), "h")
    rows = side(corpus_gs.join(both, key, "left"), "IF(_in = 1, 3L, 2L)").unionAll(
        side(probes_gs.join(both, key, "left_anti").withColumn("_in", F.lit(0)), "1L"))
    spread = _spread(corpus_gs)
    held, sides = Window.partitionBy("h"), "CAST(shiftright(_sizes, 61) AS INT)"
    shared = (rows.repartition(spread, "h").withColumn("df", F.count(F.lit(1)).over(held))
              .withColumn("_either", F.expr(f"bit_or({sides})").over(held)).filter("df > 1 AND _either = 3").drop("_either"))
    ranked = shared.repartition(spread, "id").select(
        "id", F.expr(sides).alias("sides"), F.expr("CAST(_sizes & 4294967295 AS INT)").alias("n_grams"), "h", "df",
        F.expr("CAST((_sizes & 4294967295) - (shiftright(_sizes, 32) & 536870911) AS INT)").alias("n_tok"))
    pre = _shared_prefix(ranked, t, by=("id", "sides"))
    met = _meetings(write_bucketed(pre, scratch_path(probes_gs.sparkSession, "prefix_tokens"), ("h",), spread), t)
    # where rows share an id, they may be similar too
    again = lambda gs, other: gs.filter("n_grams > 0").groupBy("id").count().filter("count > 1").join(other.select("id"), "id", "left_semi")
    again = again(corpus_gs, probes_gs).unionAll(again(probes_gs, corpus_gs)).select(F.col("id").alias("a"), F.col("id").alias("b"))
    return met.unionAll(again).distinct()


def _spread(*sets: DataFrame) -> int:
    """Partitions of token rows: as many rows in each as its sorts hold in memory, whatever the corpus."""
    total = sum(gs.agg(F.sum(F.col("n_grams").cast("bigint"))).first()[0] or 0 for gs in sets)
    return max(default_buckets(sets[0].sparkSession), -(-total // PARTITION_TOKENS))


def _meetings(pre: DataFrame, t: float) -> DataFrame:
    """``(a, b)``, ``a < b``, whose prefixes share ``COMMON`` tokens under the bounds, or as many as the pair must share.

    Where the rows tell their ``sides``, ``a`` is of the corpus and ``b`` a probe.

    The first ``COMMON`` common tokens of a pair lie in prefixes that are longer by ``COMMON - 1``, the first of them in
    those that are not. Of a run of common tokens only the first makes a row, which tells by ``ahead`` how many follow:
    bits that agree by chance count too, so no pair is lost."""
    n = F.col("n_grams")
    cross = "sides" in pre.columns
    sides = lambda name: [F.col("sides").alias(name)] if cross else []
    index_length = n - F.ceil(n * F.lit(2 * t / (1 + t)) - F.lit(EPS)) + COMMON
    small = (pre.filter(F.col("whole") | (F.col("pos") <= index_length))
             .select(F.col("id").alias("a"), F.col("n_grams").alias("na"), "h", F.col("pos").alias("pa"), F.col("whole").alias("wa"),
                     F.col("prev").alias("va"), F.col("ahead").alias("xa"), *sides("sa")))
    large = pre.select(F.col("id").alias("b"), F.col("n_grams").alias("nb"), "h", F.col("pos").alias("pb"), F.col("whole").alias("wb"),
                       F.col("prev").alias("vb"), F.col("ahead").alias("xb"), *sides("sb"))
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    if cross:
        # either may be the probe of the other, or both
        ordered = (ordered | F.expr("na = nb AND a = b AND sa < sb")) & F.expr("(sa | sb) = 3")
        pairs = [F.explode(F.expr("filter(array(IF(sa >= 2 AND sb IN (1, 3), named_struct('a', a, 'b', b), NULL), "
                                  "IF(sb >= 2 AND sa IN (1, 3), named_struct('a', b, 'b', a), NULL)), p -> p IS NOT NULL)")).alias("p")]
    # so many tokens from here on may lie in the longer prefixes
    room = COMMON + 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - _least_overlap("na", "nb", t)
    # sets that share the token before too have met there, with more room: of a run of common tokens only the first counts
    first = F.coalesce(F.col("va") != F.col("vb"), F.lit(True))
    # the lowest four bits that differ end the run
    apart = F.col("xa").bitwiseXOR(F.col("xb"))
    run = F.lit(COMMON)
    for k in range(COMMON - 1, 0, -1):
        run = F.when(apart.bitwiseAND((1 << 4 * k) - 1) != 0, F.lit(k)).otherwise(run)
    exempt = F.col("wa") | F.col("wb")
    met = (small.join(large, "h")
           .filter(first & ordered & _size_bound("na", "nb", t) & (exempt | (room > 0)))
           .select(*(pairs if not cross else ["a", "b", "sa", "sb"]),
                   F.when(exempt, F.lit(COMMON)).otherwise(F.least(run, room).cast("int")).alias("common"),
                   (exempt | (room >= COMMON)).alias("early"),
                   F.least(_least_overlap("na", "nb", t), F.lit(COMMON)).cast("int").alias("least")))
    keys = [c for c in met.columns if c not in ("common", "early", "least")]
    met = (met.groupBy(*keys).agg(F.sum("common").alias("common"), F.max("early").alias("early"), F.min("least").alias("least"))
           .filter("early AND common >= least"))
    return met.select(*pairs).select("p.*") if cross else met.select("a", "b")


def class_links(gs: DataFrame, threshold: float = T.DEFAULT_THRESHOLD, members: DataFrame | None = None) -> DataFrame:
    """``(a, b, jaccard)``, ``a < b`` (``a`` is the earlier): similar representatives of different texts."""
    T.check_threshold(threshold)
    cand = materialize(candidate_pairs(gs, threshold, members), "candidates")
    return grouped_jaccard(cand, gs, gs, float(threshold))


def similar_classes(gs: DataFrame, threshold: float = T.DEFAULT_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The stored form of all similar pairs: ``(class_members, class_links)``, both written."""
    members = materialize(class_members(gs), "class-members")
    return members, materialize(class_links(gs, threshold, members), "class-links")


def similar_pairs(gs: DataFrame, threshold: float = T.DEFAULT_THRESHOLD) -> DataFrame:
    """All unordered similar pairs ``(a, b, exact, jaccard)`` with ``a < b``."""
    return expand_links(*similar_classes(gs, threshold))


def token_postings(gs: DataFrame) -> DataFrame:
    """``(h, id, n_grams)``: one row for each distinct token of each document."""
    return _tokens(gs).select("h", "id", "n_grams")


def corpus_postings(gs: DataFrame, members: DataFrame) -> Postings:
    """Stored postings of the representatives in ``gs``."""
    return stored_postings(token_postings(representatives(gs, members)), gs.count())


def cross_links(probes_gs: DataFrame, corpus_gs: DataFrame, postings: Postings,
                threshold: float = T.DEFAULT_THRESHOLD) -> DataFrame:
    """``(a, b, jaccard)``: similar pairs of different texts, ``a`` of the corpus and ``b`` a probe.

    One-sided prefix filter: only the probes are ranked; their prefix tokens
    meet the corpus documents' *full* token lists. If J(r, s) >= t, r's
    prefix holds a token of s under any global order, so the corpus is never
    ranked, windowed or collapsed per batch. Document frequencies are counted
    for the probes' tokens only. Both joins are on the postings' own key, so
    only the probes' tokens are shuffled (or broadcast, by Spark's byte
    thresholds on the written lists).
    """
    T.check_threshold(threshold)
    t = float(threshold)
    p_tok = materialize(_tokens(probes_gs), "probe_tokens")
    keys = postings.slotted(p_tok.select("h").distinct())
    dfs = postings.meet(keys, "left_semi").groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    # tokens that the corpus lacks rank first, and are left out like those of one document in the self-join
    pre = postings.slotted(_prefix_tokens(p_tok, dfs, t)).select(
        F.col("id").alias("b"), F.col("n_grams").alias("nb"), "h", "slot", "pos", "whole")
    pre = materialize(pre, "probe_prefix")
    room = F.col("whole") | (1 + F.col("nb") - F.col("pos") >= _least_overlap("na", "nb", t))
    met = postings.meet(pre).withColumnsRenamed({"id": "a", "n_grams": "na"})
    cand = met.filter(_size_bound("na", "nb", t) & room)
    cand = materialize(cand.select("a", "b").distinct(), "candidates")
    return grouped_jaccard(cand, corpus_gs, probes_gs, t)


def cross_similar(probes_gs: DataFrame, corpus_gs: DataFrame,
                  threshold: float = T.DEFAULT_THRESHOLD,
                  exclude_self: bool = True, postings: Postings | None = None,
                  corpus_members: DataFrame | None = None) -> DataFrame:
    """Similar ``(probe, doc, exact, jaccard)`` pairs between a probe set (a
    batch) and a corpus.

    Copies on either side are joined by their representatives and expanded
    afterwards. ``postings`` are the stored tokens of the corpus's
    representatives; without, the prefixes of both sides are joined, since
    tokens that are met only once are not worth storing. ``exclude_self`` skips
    a probe meeting its own id.
    """
    T.check_threshold(threshold)
    p_members = class_members(probes_gs)
    c_members = class_members(corpus_gs) if corpus_members is None else corpus_members
    probes = representatives(probes_gs, p_members)
    if postings is None:
        cand = materialize(cross_candidates(probes, representatives(corpus_gs, c_members), threshold), "candidates")
        near = grouped_jaccard(cand, corpus_gs, probes_gs, float(threshold))
    else:
        near = cross_links(probes, corpus_gs, postings, threshold)
    near = (_expand(near, c_members, p_members)
            .select(F.col("y").alias("probe"), F.col("x").alias("doc"), F.lit(False).alias("exact"), "jaccard"))
    pm = probes_gs.select(F.col("id").alias("probe"), "norm_hash", F.col("n_grams").alias("_n"))
    exact = (c_members.select(F.col("id").alias("doc"), "norm_hash").join(pm, "norm_hash")
             .select("probe", "doc", F.lit(True).alias("exact"), _exact_flag_jaccard("_n").alias("jaccard")))
    out = exact.unionByName(near)
    if exclude_self:
        out = out.filter(F.col("probe") != F.col("doc"))
    return out


def prior_edges(pairs: DataFrame) -> DataFrame:
    """Directed edges later -> earlier: ``(file_id, similar_file_id)``.

    Only files analysed before a file are compared with it, so each similar
    pair yields one edge from the larger (later) id to the smaller."""
    return pairs.select(F.col("b").alias("file_id"), F.col("a").alias("similar_file_id"))
