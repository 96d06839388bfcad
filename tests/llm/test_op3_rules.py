import math
import random
from collections import Counter

import numpy as np

from corpuscheck.llm import op3_rules as R

from .texts import SCHEMA, WORD, corpus, frame, prose


def _brute(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_counts_equal_brute_force(spark):
    docs = corpus() + [(900, "a b\na b\r\na b\n\na b"), (901, "x\nx\nx y z x y z")]
    got = sorted(tuple(r[1:6]) for r in R.judge(frame(spark, docs), R.Forest()).collect())
    assert got == sorted(_brute(t) for _, t in docs)


def test_base_rule_without_labels(spark):
    docs = corpus()
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = R.fit(frame(spark, docs), labels)
    for r in R.judge(frame(spark, docs), model).collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert R.judge(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_forest_separates_and_keeps_rows(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(300):
        t = prose(rng, rng.randrange(60, 300))
        bad = i % 10 == 0
        docs.append((i, " ".join(w + rng.choice(("###", "%%%")) for w in t.split()) if bad else t))
        labels.append((i, 0 if bad else 1))
    docs += [(2000, None), (2001, "")]
    df = frame(spark, docs)
    model = R.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {r.doc_id: r.kept for r in R.judge(df, model).collect()}
    good = [kept[i] for i, q in labels if q]
    bad = [kept[i] for i, q in labels if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
    rows = R.keep_documents(df, model)
    assert rows.columns == df.columns
    assert sorted(r.doc_id for r in rows.collect()) == sorted(i for i, k in kept.items() if k)
    assert {tuple(r) for r in rows.collect()} <= {tuple(r) for r in df.collect()}


def _expected(n):
    return 0 if n < 2 else 1 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _walk(rng, values, level, limit, asked):
    """Path length of every asked value in one tree, by the definition: split at random until a row is alone."""
    if len(values) < 2 or level == limit or min(values) == max(values):
        return {v: level + _expected(len(values)) for v in asked}
    c = rng.uniform(min(values), max(values))
    left = _walk(rng, [v for v in values if v < c], level + 1, limit, [v for v in asked if v < c])
    return left | _walk(rng, [v for v in values if v >= c], level + 1, limit, [v for v in asked if v >= c])


def test_path_lengths_equal_the_definition():
    draw = np.random.default_rng(5)
    values = np.concatenate([np.zeros(20), draw.normal(3, 1, 25).round(1), [40.0, 41, 41]])
    asked = sorted({*values.tolist(), -1.0, 2.55, 17, 99})
    want = dict.fromkeys(asked, 0.0)
    trees = []
    for seed in range(30):
        trees.append(R._tree(np.sort(values), np.random.default_rng(seed), 9))
        for v, n in _walk(np.random.default_rng(seed), values.tolist(), 0, 9, asked).items():
            want[v] += n / 30
    forest = R.Forest(*([x] for x in R._mean_paths(trees)), thresholds=np.array([0.5]), rows=len(values))
    score = forest.scores(np.array(asked)[:, None])[:, 0]
    assert np.allclose(score, [2 ** (-want[v] / _expected(len(values))) for v in asked])
    # the lone values are isolated sooner than the common one
    assert score[asked.index(40.0)] > score[asked.index(0.0)]
    assert np.allclose(forest.anomaly(np.array(asked)[:, None]), score - 0.5)


def test_trees_do_not_see_labels():
    draw = np.random.default_rng(6)
    x = np.column_stack([draw.normal(0, 1, 400), np.where(np.arange(400) < 30, draw.uniform(5, 9, 400), 0)])
    good = np.arange(400) >= 30
    a = R.grow_forest(x, good.astype(int), np.zeros(400, bool))
    b = R.grow_forest(x, draw.permutation(good).astype(int), np.zeros(400, bool))
    for one, other in zip(a.cuts + a.paths, b.cuts + b.paths, strict=True):
        assert np.array_equal(one, other)
    assert (a.thresholds != b.thresholds).any()
    assert (a.anomaly(x[~good]) > 0).all() and (a.anomaly(x[good]) > 0).mean() <= R.MAX_GOOD_REJECTS


def test_bad_rows_in_the_majority():
    draw = np.random.default_rng(7)
    x = np.column_stack([draw.normal(0, 1, 400), np.where(np.arange(400) < 250, draw.uniform(5, 9, 400), 0)])
    good = np.arange(400) >= 250
    model = R.grow_forest(x, good.astype(int), np.zeros(400, bool))
    assert (model.anomaly(x[~good]) > 0).mean() > 0.95 and (model.anomaly(x[good]) > 0).mean() <= 0.01


def _labelled(spark, n, bad_every):
    rng = random.Random(11)
    docs = []
    for i in range(n):
        t = prose(rng, 60)
        docs.append((i, " ".join(w + "%%" for w in t.split()) if i % bad_every == 0 else t))
    labels = spark.createDataFrame([(i, 0 if i % bad_every == 0 else 1) for i in range(n)], "doc_id long, quality int")
    return frame(spark, docs), labels


def test_every_labelled_row_counts(spark, monkeypatch):
    """More labelled rows than the sample once held: each is in the counts that the thresholds come from."""
    df, labels = _labelled(spark, 8400, 5)
    seen = []
    calibrate = R._calibrate
    monkeypatch.setattr(R, "_calibrate", lambda f, good, bad, share: (seen.append((f, good, bad)), calibrate(f, good, bad, share))[1])
    model = R.fit(df, labels)
    (forest, good, bad), = seen
    rows = R._labelled_features(df, labels).toPandas()
    x, is_good = np.stack(rows["x"]), rows["good"].to_numpy(bool)
    assert len(rows) > 8192 and len(model.cuts) == len(R.FEATURES) == x.shape[1] and model.rows == R.TREE_ROWS
    for k in range(x.shape[1]):
        assert (good[k].sum(), bad[k].sum()) == (is_good.sum(), (~is_good).sum())
    score = model.scores(x)
    top = np.quantile(score[is_good], 1 - R.MAX_GOOD_REJECTS / x.shape[1], axis=0, method="higher")
    for k in range(x.shape[1]):
        over = score[~is_good, k][score[~is_good, k] > top[k]]
        top[k] += 0.1 * (np.median(over) - top[k]) if len(over) else 0
    assert np.allclose(model.thresholds, top)
    assert (model.anomaly(x[~is_good]) > 0).all() and (model.anomaly(x[is_good]) > 0).mean() <= R.MAX_GOOD_REJECTS


def test_fit_does_not_depend_on_partitions(spark):
    df, labels = _labelled(spark, 300, 12)
    a, b = R.fit(df.repartition(1), labels), R.fit(df.repartition(5), labels.repartition(3))
    assert all(np.array_equal(p, q) for p, q in zip(a.cuts + a.paths, b.cuts + b.paths, strict=True))
    assert np.array_equal(a.thresholds, b.thresholds)
