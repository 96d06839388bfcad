"""Similarity join: verdicts on pairs of short texts, Jaccard values, edge cases,
and equality with a brute-force all-pairs check on random small corpora."""

from __future__ import annotations

import hashlib
import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpuscheck.functions import text as T
from corpuscheck.operators import similarity as S


# ---------------------------------------------------------------- brute force
def _sig(text, stops=T.DEFAULT_STOP_WORDS):
    low = text.replace("İ", "i").replace("Σ", "σ").lower()
    chars = [" " if unicodedata.category(c).startswith("P") else c for c in low]
    return [w for w in "".join(chars).split() if w not in set(stops)]


def _grams(words, n):
    return {" ".join(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else set()


def _brute_pairs(docs, n, t):
    prep = {}
    for i, text in docs:
        w = _sig(text)
        prep[i] = (hashlib.sha256(" ".join(w).encode()).hexdigest(), _grams(w, n))
    out = set()
    for (a, (ha, ga)), (b, (hb, gb)) in itertools.combinations(sorted(prep.items()), 2):
        if ha == hb:
            out.add((a, b))
            continue
        u = len(ga | gb)
        if u and len(ga & gb) / u >= t:
            out.add((a, b))
    return out


def _spark_pairs(spark, docs, n, t):
    df = spark.createDataFrame(docs, "file_id long, text string")
    gs = S.gram_sets(df, n, persist=False)
    return {(r.a, r.b) for r in S.similar_pairs(gs, t).collect()}


# ---------------------------------------------------------------- fixtures
PROBE = "Grey herons nest along the lower weir each spring."
VERDICTS = [
    (PROBE, PROBE, True),
    (PROBE, "Grey herons nest along the old canal.", True),
    (PROBE, "Grey herons nest along the lower weir each spring, when floods have gone down.", True),
    (PROBE, "Trams run every ten minutes from the market hall.", False),
    (PROBE, "GREY herons (nest) along the LOWER weir: each spring?", True),
    ("Oak, ash, elm; lime!", "oak ASH elm lime", True),
    ("Oak ash elm lime", "lime elm ash oak", False),
]


@pytest.mark.parametrize("probe,other,similar", VERDICTS)
def test_verdict_table_at_t02_n2(spark, probe, other, similar):
    pairs = _spark_pairs(spark, [(1, other), (2, probe)], 2, 0.2)
    assert (pairs == {(1, 2)}) is similar


def test_check_against_corpus_flags_only_the_close_one(spark):
    corpus = spark.createDataFrame([
        (1, "Trams run every ten minutes from the market hall."),
        (2, "Grey herons nest along the lower weir each autumn."),
    ], "file_id long, text string")
    probes = spark.createDataFrame([(9, PROBE)], "probe_id long, text string")
    got = S.cross_similar(S.gram_sets(probes, 2, id_col="probe_id", persist=False),
                          S.gram_sets(corpus, 2, persist=False), 0.2).collect()
    assert [(r.probe, r.doc) for r in got] == [(9, 2)]


def test_pair_jaccard_values(spark):
    docs = spark.createDataFrame([
        (1, "alpha beta gamma delta"), (2, "alpha beta gamma delta"),
        (3, "one two three four"),
        (4, "k1 k2 k3 k4 k5 k6"), (5, "k1 k2 x1 x2"),
        (6, "a"), (7, "the"),
    ], "file_id long, text string")
    gs = S.gram_sets(docs, 1, persist=False)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (4, 5), (6, 7)], "a long, b long")
    got = {(r.a, r.b): r.jaccard for r in S.pair_jaccard(pairs, gs).collect()}
    assert got[(1, 2)] == 1.0
    assert got[(1, 3)] == 0.0
    assert got[(4, 5)] == pytest.approx(2 / 8)
    assert got[(6, 7)] == 0.0  # "the" normalises to nothing: empty union


def test_edge_cases(spark):
    docs = [
        (1, "The, the!"), (2, "and or but"),            # both normalise to "" -> hash match
        (3, "alpha beta"), (4, "ALPHA beta."),          # < n words: hash only
        (5, "alpha beta gamma"),                        # < n shared grams with 3/4
        (6, "g1 g2 g3 g4 g5 g6 g7 g8 g9 g10 g11 g12"),  # 10 trigrams
        (7, "g1 g2 g3 g4 g5 h1 h2 h3 h4 h5 h6 h7"),     # shares 3 of 17 -> 0.176
        (8, "g1 g2 g3 g4 g5 h1 h2 h3 h4 h5"),           # shares 3 of 15 -> 0.2
        (9, "g1 g2 g3 g4 g5 i1 i2 i3 i4"),              # shares 3 of 14 -> 0.214
        (10, "g1 g2 g3 g4 g5 j1 j2 j3 j4 j5 j6"),       # 3 of 16 = 0.1875
    ]
    got = _spark_pairs(spark, docs, 3, 0.2)
    assert got == _brute_pairs(docs, 3, 0.2)
    assert (1, 2) in got and (3, 4) in got
    assert (6, 8) in got and (6, 7) not in got


def test_threshold_equality_is_similar(spark):
    # 6 and 7 trigrams sharing 3: Jaccard is exactly 3 / 10
    a = "w1 w2 w3 w4 w5 a1 a2 a3"
    b = "w1 w2 w3 w4 w5 b1 b2 b3 b4"
    ga, gb = _grams(_sig(a), 3), _grams(_sig(b), 3)
    assert (len(ga & gb), len(ga | gb)) == (3, 10)
    assert _spark_pairs(spark, [(1, a), (2, b)], 3, 0.3) == {(1, 2)}
    assert _spark_pairs(spark, [(1, a), (2, b)], 3, 0.30001) == set()


def test_prefix_keeps_whole_set_when_own_grams_collide(spark):
    # t = 1.0 keeps one token per document normally; a document with fewer
    # distinct hashes than grams must keep all of its tokens.
    tok = spark.createDataFrame(
        [(1, 4, 3, 11), (1, 4, 3, 12), (1, 4, 3, 13),
         (2, 3, 3, 11), (2, 3, 3, 12), (2, 3, 3, 13)],
        "id long, n_grams int, n_tok int, h long")
    dfs = spark.createDataFrame([(11, 2), (12, 2), (13, 2)], "h long, df long")
    got = sorted((r.id, r.h, r.pos, r.whole) for r in S._prefix_tokens(tok, dfs, 1.0).collect())
    assert got == [(1, 11, 1, True), (1, 12, 2, True), (1, 13, 3, True), (2, 11, 1, False)]


@pytest.mark.parametrize("seed,n,t", [(1, 1, 0.5), (2, 2, 0.3), (3, 3, 0.3), (4, 2, 0.6), (5, 3, 0.2)])
def test_equals_brute_force_on_random_corpora(spark, seed, n, t):
    rnd = random.Random(seed)
    vocab = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "the", "and"]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 14))) for _ in range(12)]
    docs = []
    for i in range(40):
        src = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 3)):      # small edits
            if src and rnd.random() < 0.5:
                src.pop(rnd.randrange(len(src)))
            else:
                src.insert(rnd.randint(0, len(src)), rnd.choice(vocab))
        text = " ".join(w.upper() if rnd.random() < 0.1 else w for w in src)
        docs.append((i, text + rnd.choice(["", ".", "!", " ,"])))
    assert _spark_pairs(spark, docs, n, t) == _brute_pairs(docs, n, t)


def test_prior_edges_point_to_earlier_ids(spark):
    docs = [(5, "alpha beta gamma delta"), (2, "alpha beta gamma delta"), (9, "alpha beta gamma delta")]
    df = spark.createDataFrame(docs, "file_id long, text string")
    edges = S.prior_edges(S.similar_pairs(S.gram_sets(df, 3, persist=False), 0.3))
    assert {(r.file_id, r.similar_file_id) for r in edges.collect()} == {(5, 2), (9, 2), (9, 5)}


def test_ngram_frequency_counts_repeats(spark):
    df = spark.createDataFrame([(1, "a1 b1 a1 b1 a1")], "file_id long, text string")
    got = {(r.ngram, r.freq) for r in S.ngram_frequency(df, 2).collect()}
    assert got == {("a1 b1", 2), ("b1 a1", 2)}


def test_plan_has_no_cartesian_product(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta gamma delta")], "file_id long, text string")
    plan = S.similar_pairs(S.gram_sets(df, 2, persist=False), 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert F is not None


def test_hot_gram_and_copy_group_stay_out_of_the_join(spark):
    # Every document carries the same boilerplate line (its grams are in all
    # documents) plus a long unique body; 100 further documents are
    # normalised copies of one text. Candidate pairs must stay far below
    # all pairs, and the copy group must not reach the prefix join at all.
    rnd = random.Random(7)
    boiler = "licensed under the same terms as the original work of authorship"
    docs = []
    for i in range(300):
        body = " ".join(f"w{rnd.randrange(10**9)}" for _ in range(40))
        docs.append((i, f"{boiler} {body}"))
    copy_text = "a shared passage copied many times over by many people here"
    docs += [(1000 + i, copy_text.upper() if i % 2 else copy_text) for i in range(100)]
    df = spark.createDataFrame(docs, "file_id long, text string")
    gs = S.gram_sets(df, 3, persist=False)
    cand = S.candidate_pairs(gs, 0.3, persist=False).count()
    assert cand < 300  # all pairs would be ~80k
    pairs = S.similar_pairs(gs, 0.3)
    exact = pairs.filter(F.col("exact")).count()
    assert exact == 100 * 99 // 2
    assert pairs.filter(~F.col("exact")).count() == 0


def _brute_cross(probes, corpus, n, t, exclude_self):
    def prep(text):
        w = _sig(text)
        return hashlib.sha256(" ".join(w).encode()).hexdigest(), _grams(w, n)
    out = set()
    for a, ta in probes:
        ha, ga = prep(ta)
        for b, tb in corpus:
            if exclude_self and a == b:
                continue
            hb, gb = prep(tb)
            u = len(ga | gb)
            if ha == hb or (u and len(ga & gb) / u >= t):
                out.add((a, b))
    return out


@pytest.mark.parametrize("seed,n,t", [(11, 2, 0.3), (12, 3, 0.2), (13, 1, 0.5)])
def test_cross_similar_equals_brute_force(spark, seed, n, t):
    rnd = random.Random(seed)
    vocab = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "the"]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 12))) for _ in range(8)]
    corpus = []
    for i in range(30):
        src = rnd.choice(base).split()
        if src and rnd.random() < 0.5:
            src.pop(rnd.randrange(len(src)))
        corpus.append((i, " ".join(src)))
    probes = corpus[20:] + [(100 + i, rnd.choice(base)) for i in range(6)]   # overlap + new
    p_df = spark.createDataFrame(probes, "probe_id long, text string")
    c_df = spark.createDataFrame(corpus, "file_id long, text string")
    got = {(r.probe, r.doc) for r in S.cross_similar(
        S.gram_sets(p_df, n, id_col="probe_id", persist=False),
        S.gram_sets(c_df, n, persist=False), t, exclude_self=True).collect()}
    assert got == _brute_cross(probes, corpus, n, t, True)


def test_boilerplate_makes_few_candidates(spark):
    """600 documents of 20 trigrams, 8 of them from one licence line: no pair
    reaches 0.3, and prefixes with positions keep almost all from meeting."""
    rnd = random.Random(1)
    line = "use and copy freely under these same plain terms only forever"
    docs = [(i, f"{line} " + " ".join(f"w{rnd.randrange(10**9)}" for _ in range(12))) for i in range(600)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 3, persist=False)
    sizes = gs.agg(F.min("n_grams"), F.max("n_grams")).first()
    assert sizes[0] >= 15
    assert S.candidate_pairs(gs, 0.3, persist=False).count() < 1000
    assert S.similar_pairs(gs, 0.3).count() == 0
    probes = gs.filter("id < 50").withColumn("id", F.col("id") + 10_000)
    seen = []
    original = S.materialize

    def spy(df, name):
        out = original(df, name)
        if name == "candidates":
            seen.append(out.count())
        return out

    S.materialize = spy
    try:
        got = S.cross_similar(probes, gs.filter("id >= 50"), 0.3).count()
    finally:
        S.materialize = original
    assert got == 0 and seen[0] < 1000


def _without_broadcast(spark, run):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        return run()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_near_copies_meet_once_for_each_run_of_common_tokens(spark):
    """30 copies that differ in one word share about 90 of 100 trigrams; a pair met at most of them before."""
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(100)]
    docs = [(i, " ".join(words[:i + 20] + [f"copy{i}"] + words[i + 21:])) for i in range(30)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 3, persist=False)
    pre = S._shared_prefix(S._shared_tokens(S._tokens(gs)), 0.3).cache()
    pairs = {(r.a, r.b) for r in S.candidate_pairs(gs, 0.3).collect()}
    assert pairs == {(a, b) for a in range(30) for b in range(a + 1, 30)}
    met = [(r.a, r.b) for r in S._meetings(pre, 0.3).collect()]
    assert set(met) == pairs and len(met) < 10 * len(pairs)
    pre.unpersist()


def test_prefix_join_shuffles_neither_side(spark):
    docs = [(i, f"grey herons nest along the lower weir {i % 7} each spring {i}") for i in range(60)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 3, persist=False)
    plan = _without_broadcast(spark, lambda: S.candidate_pairs(gs, 0.3)._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plan and "hashpartitioning(h#" not in plan


def test_repeated_ids_keep_their_links(spark):
    """Rows that share an id are ranked together; a token of the other row hides no meeting."""
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(25)]
    docs = [(rnd.randrange(12), " ".join(rnd.choice(words) for _ in range(rnd.randrange(2, 30)))) for _ in range(40)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 1, persist=False)
    # every meeting, also those within a run
    pre = S._shared_prefix(S._shared_tokens(S._tokens(gs)), 0.3).cache()
    every = {(r.a, r.b) for r in S._meetings(pre.withColumn("prev", F.lit(None).cast("long")), 0.3).collect()}
    assert {(r.a, r.b) for r in S._meetings(pre, 0.3).collect()} == every
    pre.unpersist()


def test_written_gram_sets_leave_out_the_tokens(spark):
    docs = [(1, "One two three four five"), (2, "of the"), (3, ""), (4, None), (5, "a b b b b b b"), (6, "x-ray x.ray X ray x ray x ray")]
    docs = spark.createDataFrame(docs, "file_id long, text string")
    for n in (1, 3, 9):
        kept, lazy = S.gram_sets(docs, n), S.gram_sets(docs, n, persist=False)
        assert kept.columns == lazy.columns
        assert "tokens" not in spark.read.parquet(*kept.inputFiles()).columns
        rows = lambda gs: sorted((r.id, r.norm_hash, r.n_grams, sorted(r.tokens), r.norm) for r in gs.collect())
        assert [tuple(map(str, r)) for r in rows(kept)] == [tuple(map(str, r)) for r in rows(lazy)]


def test_partitions_of_the_self_join_follow_the_tokens(spark, monkeypatch):
    docs = [(i, f"grey herons nest along the lower weir {i % 7} each spring {i}") for i in range(60)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 3)
    want = {(r.a, r.b) for r in S.candidate_pairs(gs, 0.3).collect()}
    monkeypatch.setattr(S, "PARTITION_TOKENS", 20)
    seen, original = [], S.write_bucketed

    def spy(df, path, key, buckets):
        seen.append(buckets)
        return original(df, path, key, buckets)

    monkeypatch.setattr(S, "write_bucketed", spy)
    assert {(r.a, r.b) for r in S.candidate_pairs(gs, 0.3).collect()} == want and want
    assert seen == [-(-gs.agg(F.sum("n_grams")).first()[0] // 20)] and seen[0] > 20


def test_texts_without_a_pair_are_not_shuffled(spark):
    """The verification's text side is a broadcast semi join before any exchange of the texts."""
    docs = [(i, f"w{i} x{i} y{i} z{i} q{i}" if i > 3 else f"grey herons nest along lower weir {i}") for i in range(60)]
    gs = S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 3)
    out = S.class_links(gs, 0.3)
    assert out.count() == 6
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


def _random_sets(spark, texts=300, words=300, of=25):
    """(gram sets, their words) of random texts, of which every tenth is near to the one before, and some tiny ones."""
    rnd = random.Random(9)
    sets = []
    for i in range(texts):
        new = {f"w{rnd.randrange(words)}" for _ in range(of)}
        sets.append(set(sorted(sets[-1])[:of // 2]) | set(sorted(new)[:of // 3]) if i % 10 == 9 else new)
    sets += [{"one"}, {"one", "two"}, {"one", "two", "three"}, {"one", "two", "four"}]
    docs = [(i, " ".join(sorted(x))) for i, x in enumerate(sets)]
    return S.gram_sets(spark.createDataFrame(docs, "file_id long, text string"), 1), sets


def test_few_common_tokens_make_no_candidate(spark):
    """Sets that share a token or two in their prefixes are no candidates; similar ones of any size stay."""
    gs, sets = _random_sets(spark)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if len(sets[a] & sets[b]) >= 0.2 * len(sets[a] | sets[b])}
    some = sum(len(sets[a] & sets[b]) > 0 for a in range(len(sets)) for b in range(a))
    got = {(r.a, r.b) for r in S.candidate_pairs(gs, 0.2).collect()}
    assert want <= got and len(want) > 30 and len(got) - len(want) < some / 10
    assert {(r.a, r.b) for r in S.class_links(gs, 0.2).collect()} == want


def test_written_steps_leave_no_shuffle_files(spark):
    import time

    from corpuscheck.operators.postings import write_bucketed
    from corpuscheck.session import materialize, scratch_path

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if "shuffle_" in f}
    before, setting = held(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(5000).selectExpr("id % 50 AS k", "id")
    grouped = materialize(rows.repartition(3, "k").groupBy("k").count(), "grouped")
    dealt = write_bucketed(rows, scratch_path(spark, "dealt"), ("k",), 3)
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before
    assert grouped.count() == 50 and dealt.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_cross_similar_without_postings_deals_prefixes(spark, monkeypatch):
    """Ten probes of 304 sets: the corpus's tokens are not stored for them."""
    from corpuscheck.operators import postings as P

    gs, sets = _random_sets(spark)
    dealt, original = [], P.write_bucketed

    def spy(*args):
        out = original(*args)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(P, "write_bucketed", spy)
    monkeypatch.setattr(S, "write_bucketed", spy)
    asked = [9, 19, 29, 39, 49, 100, 200, 301, 302, 303]
    got = {(r.probe, r.doc) for r in S.cross_similar(gs.filter(F.col("id").isin(asked)), gs, 0.2).collect()}
    assert got == {(a, b) for a in asked for b in range(len(sets)) if a != b and len(sets[a] & sets[b]) >= 0.2 * len(sets[a] | sets[b])}
    assert len(got) > 10 and sum(dealt) < 0.7 * gs.agg(F.sum("n_grams")).first()[0]
