"""Quality rules: isolation forest over rule statistics.

``rule_statistics`` computes the exact rule counts of each text in one pass.
``fit`` grows isolation trees over all labelled rows: a tree looks at one
statistic and splits its own random draw of the rows, whose labels it doesn't see,
at random values. All labelled rows then calibrate the path-length threshold of
each statistic, so that at most ``max_good_rejects`` of the good rows would be
rejected in all; scores are steps between the split points, so Spark counts the
rows of every step and the thresholds follow from the counts. A row is anomalous
if its mean path is too short in any statistic. ``judge`` evaluates counts and trees row by row, with
no shuffle; ``keep_documents`` filters whole document rows the same way.

Defined results: NULL and empty texts have zero words and fail the base rule;
repeated rows are judged alike; without labelled rows only the base rule
decides; other columns are ignored (``judge``) or passed on untouched
(``keep_documents``). A document of any length is handled as one chunk.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscheck.llm.tables import narrow, per_span
from corpuscheck.llm.words import U64, Chunk, chunks, hash_spans, mix, roll, split_words, windows
from corpuscheck.session import materialize

#: Trees for each statistic, and rows of a tree.
TREES, TREE_ROWS = 64, 32
#: Largest share of bad rows among those that trees are grown on: anomalies must be rare.
MAX_BAD_SHARE = 0.1
#: Share of good training rows that the thresholds may reject.
MAX_GOOD_REJECTS = 0.002
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Good rows that trees need at least.
MIN_GOOD = 16

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"'(),-./:;=?@[\\]^_`{}~"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False


def _repeats(keys: np.ndarray) -> np.ndarray:
    """For each key: does it occur twice or more?"""
    order = np.argsort(keys)
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.zeros(len(s), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _later_copies(keys: np.ndarray) -> np.ndarray:
    """For each key: does an equal one stand before it?"""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    out = np.zeros(len(s), bool)
    out[order[1:]] = s[1:] == s[:-1]
    return out


def statistics(chunk: Chunk) -> dict[str, np.ndarray]:
    """Rule counts, and the helper counts of the features, of every document."""
    data, bounds = chunk.data, chunk.bounds
    starts, ends, first = split_words(data, bounds)
    h = hash_spans(data, starts, ends)
    n_words = np.diff(first)
    point = _POINT[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)

    breaks = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.concatenate([bounds, breaks]))
    line_start, line_end = lines[:-1], lines[1:].copy()
    line_end -= data[line_end - 1] == 10 if len(line_end) else 0
    word_at = np.searchsorted(starts, lines)
    with_word = np.diff(word_at) > 0
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_doc = np.searchsorted(bounds, line_start, "right") - 1
    line_key = mix(hash_spans(data, line_start, line_end) + line_doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    copy = _later_copies(line_key)

    at, d = windows(first, 3)
    twice = _repeats(mix(roll(h, 3)[at] + d.astype(U64) * U64(0x9E3779B97F4A7C15)))
    covered = np.zeros(len(h), bool)
    for i in range(3):
        covered[at[twice] + i] = True

    return {
        "n_words": n_words,
        "word_chars": per_span(point & in_word, bounds),
        "n_symbols": per_span(_SYMBOL[data], bounds),
        "n_dup_lines": np.bincount(line_doc[copy], minlength=len(chunk)).astype(np.int64),
        "n_repeat_words": per_span(covered, first),
        "n_lines": np.bincount(line_doc, minlength=len(chunk)).astype(np.int64),
        "n_upper": per_span(_UPPER[data], bounds),
        "n_marks": per_span(_MARK[data], bounds),
        "n_digits": per_span(_DIGIT[data], bounds),
    }


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


FEATURES = ("chars a word", "symbols a word", "repeated lines", "repeated words", "upper case", "marks a word", "digits")


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Length-free rule statistics, one row for each document."""
    words = np.maximum(s["n_words"], 1)
    chars = np.maximum(s["word_chars"], 1)
    return np.stack([
        s["word_chars"] / words,
        s["n_symbols"] / words,
        s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
        s["n_repeat_words"] / words,
        s["n_upper"] / chars,
        s["n_marks"] / words,
        s["n_digits"] / chars,
    ], axis=1)


@dataclass
class Forest:
    """Isolation trees, summed up: each statistic's mean path length as steps, and its threshold.

    ``cuts[k]`` are all split points of the trees over statistic ``k`` and
    ``paths[k]`` the mean path length left of, between and right of them.
    """

    cuts: list[np.ndarray] = field(default_factory=list)
    paths: list[np.ndarray] = field(default_factory=list)
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rows: int = 0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length) of each row and statistic: near 1 is anomalous."""
        path = np.empty((len(x), len(self.cuts)))
        for k, (cuts, paths) in enumerate(zip(self.cuts, self.paths)):
            path[:, k] = paths[np.searchsorted(cuts, x[:, k], "right")]
        return 2.0 ** (-path / max(_expected(self.rows), 1e-9))

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """How far a row's scores are over their thresholds, for the statistic where that is most; not anomalous up to 0."""
        return (self.scores(x) - self.thresholds).max(axis=1) if self.cuts else np.zeros(len(x))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _tree(values: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(split points in ascending order, path lengths of the intervals between them) of a tree over sorted values."""
    cuts, paths = [], []
    todo = [(0, len(values), 0, None)]
    while todo:
        i, j, level, cut = todo.pop()
        if cut is not None:
            cuts.append(cut)
        if j - i < 2 or level >= limit or values[i] == values[j - 1]:
            paths.append(level + _expected(j - i))
            continue
        c = float(rng.uniform(values[i], values[j - 1]))
        m = i + int(np.searchsorted(values[i:j], c))
        # the left side is finished before the right one, which its split point precedes
        todo += [(m, j, level + 1, c), (i, m, level + 1, None)]
    return np.array(cuts), np.array(paths)


def _mean_paths(trees: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several trees over one statistic as one: all split points, and the mean path length of each interval."""
    cuts = np.unique(np.concatenate([c for c, _ in trees]))
    # any value of an interval will do: its left end belongs to it
    ends = np.concatenate([[-np.inf], cuts])
    return cuts, np.mean([p[np.searchsorted(c, ends, "right")] for c, p in trees], axis=0)


def _forest(draws: list[list[np.ndarray]], rng: np.random.Generator) -> Forest:
    """Trees over the values drawn for each statistic and tree, without thresholds."""
    size = len(draws[0][0])
    limit = int(np.ceil(np.log2(max(size, 1)))) + 4
    forest = Forest(rows=size)
    for values in draws:
        cuts, paths = _mean_paths([_tree(np.sort(v), rng, limit) for v in values])
        forest.cuts.append(cuts)
        forest.paths.append(paths)
    return forest


def _steps(forest: Forest, x: np.ndarray) -> np.ndarray:
    """The interval between split points that each row's statistics fall into."""
    return np.stack([np.searchsorted(cuts, x[:, k], "right") for k, cuts in enumerate(forest.cuts)], axis=1)


def _ranked(score: np.ndarray, n: np.ndarray, rank: int) -> float:
    """The value of a rank (from 0) among scores that occur ``n`` times each, in ascending order of score."""
    return float(score[np.searchsorted(np.cumsum(n), rank, "right")])


def _calibrate(forest: Forest, good: list[np.ndarray], bad: list[np.ndarray], max_good_rejects: float) -> np.ndarray:
    """Thresholds from the number of good and bad rows in every step of each statistic."""
    top = np.zeros(len(forest.cuts))
    share = 1 - max_good_rejects / len(forest.cuts)
    for k, paths in enumerate(forest.paths):
        score = 2.0 ** (-paths / max(_expected(forest.rows), 1e-9))
        order = np.argsort(score, kind="stable")
        score, g, b = score[order], good[k][order], bad[k][order]
        # the largest score that good rows may have, and a tenth of the way on to the typical bad row over it
        top[k] = _ranked(score, g, int(np.ceil((g.sum() - 1) * share)))
        b = np.where(score > top[k], b, 0)
        if m := int(b.sum()):
            median = (_ranked(score, b, (m - 1) // 2) + _ranked(score, b, m // 2)) / 2
            top[k] += 0.1 * (median - top[k])
    return top


def grow_forest(x: np.ndarray, quality: np.ndarray, failed: np.ndarray, seed: int = 7,
                max_good_rejects: float = MAX_GOOD_REJECTS) -> Forest:
    """Trees over the rows that pass the base rule (``fit`` for rows at hand).

    A tree looks at one statistic of a random draw of rows, without their
    labels, and splits it at random values, ``TREES`` trees for each statistic.
    Where more than ``MAX_BAD_SHARE`` of the rows are bad, they are thinned to
    that first. Else the labels only calibrate the statistics' thresholds, each
    of which may reject an equal part of the good rows that may go in all.
    """
    x, good = x[~failed], quality[~failed] == 1
    if good.sum() < MIN_GOOD:
        return Forest()
    rng = np.random.default_rng(seed)
    bad = rng.permutation(np.flatnonzero(~good))
    pool = np.sort(np.append(np.flatnonzero(good), bad[:_bad_rows(int(good.sum()))]))
    size = min(TREE_ROWS, len(pool))
    forest = _forest([[rng.choice(x[pool, k], size, replace=False) for _ in range(TREES)] for k in range(x.shape[1])], rng)
    at = _steps(forest, x)
    count = lambda rows: [np.bincount(at[rows, k], minlength=len(p)) for k, p in enumerate(forest.paths)]
    forest.thresholds = _calibrate(forest, count(good), count(~good), max_good_rejects)
    return forest


def _bad_rows(good: int) -> int:
    """How many bad rows may be among those that trees are grown on."""
    return max(1, int(good * MAX_BAD_SHARE / (1 - MAX_BAD_SHARE)))


_STATS = "doc_id long, failed boolean, x array<double>"
_DRAWN = "tree int, h long, value double"
_COUNTED = "k int, step int, good boolean, n long"


def _labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, x, good)`` of every labelled row that passes the base rule."""

    def run(bs):
        for c in chunks(bs):
            s = statistics(c)
            x = features(s)
            yield pa.RecordBatch.from_arrays(
                [c.rows.column("doc_id").combine_chunks(), pa.array(base_failed(s)),
                 pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))],
                names=["doc_id", "failed", "x"])

    ids = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality")))
    # the texts stay where they are: only their statistics meet the labels
    rows = narrow(docs).mapInArrow(run, _STATS).filter("doc_id IS NOT NULL AND NOT failed").join(ids, "doc_id")
    return rows.select("doc_id", "x", (F.col("quality") == 1).alias("good"))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)


def _draw(rows: DataFrame, seed: int, n_stats: int) -> DataFrame:
    """``(tree, h, value)``: the ``TREE_ROWS`` rows with the smallest hashes for each tree, one statistic of each.

    Rows are hashed by id, statistics and tree, so the draw doesn't depend on partitioning."""

    def run(bs):
        best_h = np.zeros((n_stats * TREES, 0), U64)
        best_v = np.zeros((n_stats * TREES, 0))
        salt = mix(np.arange(1, n_stats * TREES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        for whole in bs:
            for at in range(0, len(whole), 2048):
                b = whole.slice(at, 2048)
                x = _matrix(b)
                key = mix(b.column("doc_id").to_numpy().astype(U64))
                for k in range(x.shape[1]):
                    key = mix(key ^ np.ascontiguousarray(x[:, k]).view(U64))
                best_h = np.concatenate([best_h, mix(key[None, :] ^ salt[:, None]) >> U64(1)], axis=1)
                best_v = np.concatenate([best_v, np.repeat(x.T, TREES, axis=0)], axis=1)
                if best_h.shape[1] > TREE_ROWS:
                    least = np.argpartition(best_h, TREE_ROWS - 1, axis=1)[:, :TREE_ROWS]
                    best_h, best_v = np.take_along_axis(best_h, least, 1), np.take_along_axis(best_v, least, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(n_stats * TREES, dtype=np.int32), best_h.shape[1])),
             pa.array(best_h.ravel().astype(np.int64)), pa.array(best_v.ravel())], names=["tree", "h", "value"])

    first = Window.partitionBy("tree").orderBy("h", "value")
    return rows.mapInArrow(run, _DRAWN).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= TREE_ROWS).drop("r")


def _count_steps(rows: DataFrame, forest: Forest) -> DataFrame:
    """``(k, step, good, n)``: how many rows of either label fall into each step of each statistic."""

    def run(bs):
        counts = [np.zeros((2, len(p)), np.int64) for p in forest.paths]
        for b in bs:
            at, good = _steps(forest, _matrix(b)), b.column("good").to_numpy(zero_copy_only=False).astype(bool)
            for k, c in enumerate(counts):
                for label in (0, 1):
                    c[label] += np.bincount(at[good == label, k], minlength=c.shape[1])
        for k, c in enumerate(counts):
            label, step = np.nonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(step), k, np.int32)), pa.array(step.astype(np.int32)), pa.array(label == 1), pa.array(c[label, step])],
                names=["k", "step", "good", "n"])

    return rows.mapInArrow(run, _COUNTED).groupBy("k", "step", "good").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7, max_good_rejects: float = MAX_GOOD_REJECTS) -> Forest:
    """Forest and thresholds from all labelled documents (``grow_forest`` on Spark).

    The driver gets the trees' draws and the counts of the steps, whatever the number of rows."""
    rows = materialize(_labelled_features(docs, labels), "op3-labelled")
    n = {r.good: r.n for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if n.get(True, 0) < MIN_GOOD:
        return Forest()
    pool = rows
    spare = _bad_rows(n[True])
    if n.get(False, 0) > spare:
        # bad rows with small hashes stay, close to so many as may be
        share = int(spare / n[False] * (1 << 31))
        pool = rows.filter(F.col("good") | (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "x"), F.lit(1 << 31)) < share))
    n_stats = len(FEATURES)
    drawn = _draw(pool, seed, n_stats).toPandas().sort_values(["tree", "h", "value"])
    values = [g.to_numpy() for _, g in drawn.groupby("tree")["value"]]
    forest = _forest([values[k * TREES:(k + 1) * TREES] for k in range(n_stats)], np.random.default_rng(seed))
    counts = np.zeros((2, n_stats, max(len(p) for p in forest.paths)), np.int64)
    steps = _count_steps(rows, forest).toPandas()
    counts[steps["good"].to_numpy(int), steps["k"].to_numpy(), steps["step"].to_numpy()] = steps["n"].to_numpy()
    bad, good = ([c[k, :len(p)] for k, p in enumerate(forest.paths)] for c in counts)
    forest.thresholds = _calibrate(forest, good, bad, max_good_rejects)
    return forest


def verdicts(chunk: Chunk, forest: Forest) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(counts, base_failed, anomaly score, kept) of every document of a chunk."""
    s = statistics(chunk)
    failed = base_failed(s)
    score = forest.anomaly(features(s))
    return s, failed, score, ~failed & (score <= 0)


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """Rule counts, anomaly score and verdict of every document."""

    def run(bs):
        for c in chunks(bs):
            s, failed, score, kept = verdicts(c, forest)
            yield pa.RecordBatch.from_arrays(
                [c.rows.column("doc_id").combine_chunks(), *(pa.array(s[k]) for k in COUNTS),
                 pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return narrow(docs).mapInArrow(run, schema)


def keep_documents(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""

    def run(bs):
        for b in bs:
            # one chunk for each slice, so that verdicts line up with the rows
            at = 0
            for c in chunks(iter([b]), text):
                kept = verdicts(c, forest)[3]
                yield b.slice(at, len(c)).filter(pa.array(kept))
                at += len(c)

    return docs.mapInArrow(run, docs.schema)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document of ``documents``; all of ``labels`` are learned from."""
    from corpuscheck.llm.tables import read

    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return judge(docs, fit(docs, labels))
