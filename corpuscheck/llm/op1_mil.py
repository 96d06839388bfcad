"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is
encoded (byte classes, word statistics, signed hashed words, then one learned
layer); gated attention weights, learned from document labels alone, give the
weighted passage representation that is scored. Training uses a bounded
labelled sample on the driver (its size is ``SAMPLE_ROWS``) with all passages
of each text in it; the mini-batches are cut by passages as well as documents,
so a very long text is a step of its own. Scoring encodes every passage of
every whole text, with no shuffle.

Defined results: NULL and empty texts are a bag of one all-zero passage;
repeated rows and ids get equal scores; without labelled rows every score is
0.5; other columns of the table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm.tables import fold, labelled_sample, narrow, per_span
from corpuscheck.llm.words import U64, Chunk, chunks, hash_spans, split_words

SAMPLE_ROWS = 4096
PASSAGE_WORDS = 64
HASH_DIMS = 8
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE = 30, 64, 0.01
#: Passages of a training step that holds more than one document.
STEP_PASSAGES = 4096
THRESHOLD = 0.3
FOLDS = 5

_CLASSES = np.zeros((256, 8), bool)
_CLASSES[ord("A"):ord("Z") + 1, 0] = True
_CLASSES[ord("a"):ord("z") + 1, 1] = True
_CLASSES[ord("0"):ord("9") + 1, 2] = True
for _k, _set in enumerate(("#*$%&<>", "|", "!?", ".,;:'\"()-")):
    _CLASSES[[ord(c) for c in _set], 3 + _k] = True
_CLASSES[0x80:, 7] = True

N_FEATURES = 8 + 4 + HASH_DIMS


def encode(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(passage features, first passage of each document); every document has a passage."""
    starts, ends, first = split_words(chunk.data, chunk.bounds)
    h = hash_spans(chunk.data, starts, ends, lower=True)
    counts = np.maximum(1, -(-np.diff(first) // PASSAGE_WORDS))
    bag = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(chunk)), counts)
    word = np.minimum(first[doc] + (np.arange(bag[-1]) - bag[doc]) * PASSAGE_WORDS, first[doc + 1])
    words = np.append(word, first[-1])
    byte = np.append(np.where(word < first[doc + 1], np.append(starts, len(chunk.data))[word], chunk.bounds[doc + 1]),
                     len(chunk.data))
    # bytes before a document's first word belong to no passage; they are blanks
    x = np.zeros((len(doc), N_FEATURES), np.float32)
    n = np.maximum(np.diff(words), 1)
    size = np.maximum(np.diff(byte), 1)
    for k in range(_CLASSES.shape[1]):
        x[:, k] = per_span(_CLASSES[:, k][chunk.data], byte) / size
    x[:, 8] = per_span(ends - starts, words) / n / 8
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    x[:, 9] = per_span(same, words) / n
    x[:, 10] = per_span(chunk.data == 10, byte) / n
    x[:, 11] = np.diff(words) / PASSAGE_WORDS
    for k in range(HASH_DIMS):
        sign = ((h >> U64(k)) & U64(1)).astype(np.int8) * 2 - 1
        x[:, 12 + k] = per_span(sign, words) / np.sqrt(n) / 4
    return x, bag


class GatedAttention:
    """h = relu(W x); a = softmax(w . (tanh(V h) * sigmoid(U h))); score = sigmoid(c . sum(a h))."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        g = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
        self.mean, self.scale = mean, scale
        self.p = {"W": g(len(mean), HIDDEN), "b": np.zeros(HIDDEN), "V": g(HIDDEN, ATTENTION), "U": g(HIDDEN, ATTENTION),
                  "w": g(ATTENTION, 1)[:, 0], "c": g(HIDDEN, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, x: np.ndarray, bag: np.ndarray):
        p = self.p
        z = (x - self.mean) / self.scale
        h = np.maximum(z @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        at, n = bag[:-1], np.diff(bag)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        m = np.add.reduceat(a[:, None] * h, at, axis=0)
        return z, h, t, s, a, m, m @ p["c"] + p["d"][0]

    def score(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, bag)[-1], -30, 30)))

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, np.diff(bag)
        z, h, t, s, a, m, logit = self.forward(x, bag)
        dl = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        dm = np.repeat(dl, n)[:, None] * p["c"]
        da = (dm * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, bag[:-1]), n))
        dt, ds = de[:, None] * p["w"] * s, de[:, None] * p["w"] * t
        dv, du = dt * (1 - t * t), ds * s * (1 - s)
        dh = (a[:, None] * dm + dv @ p["V"].T + du @ p["U"].T) * (h > 0)
        return {"W": z.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (t * s).T @ de,
                "c": m.T @ dl, "d": np.array([dl.sum()])}


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, seed: int = 3) -> GatedAttention:
    """Adam over mini-batches of bags, with a little weight decay."""
    model = GatedAttention(x.mean(0), x.std(0) + 0.02, seed)
    rng, step = np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for epoch in range(EPOCHS):
        for docs in steps(rng.permutation(len(y)), np.diff(bag)):
            rows = np.concatenate([np.arange(bag[d], bag[d + 1]) for d in docs])
            cut = np.concatenate([[0], np.cumsum(bag[docs + 1] - bag[docs])])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, g in model.gradients(x[rows], cut, y[docs]).items():
                g = g + 1e-4 * model.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] = model.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def steps(order: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Documents of one training step after another: ``BATCH`` of them, fewer if they have many passages."""
    i = 0
    while i < len(order):
        passages = np.cumsum(size[order[i:i + BATCH]])
        n = max(1, int(np.searchsorted(passages, STEP_PASSAGES, "right")))
        yield order[i:i + n]
        i += n


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, where=None, seed: int = 3) -> GatedAttention | None:
    """Model from at most ``rows`` labelled documents (``where`` filters the labels)."""

    def run(bs):
        for c in chunks(bs):
            x, bag = encode(c)
            ids, q = c.column("doc_id"), c.column("quality")
            for i in range(len(c)):
                yield pa.RecordBatch.from_pydict({"doc_id": [ids[i]], "quality": [q[i]], "x": [x[bag[i]:bag[i + 1]].tobytes()]})

    got = (labelled_sample(docs, labels, rows, where).mapInArrow(run, "doc_id long, quality int, x binary")
           .toPandas().sort_values(["doc_id", "x"]))
    y = got["quality"].to_numpy(float)
    if len(y) < 8 or y.min() == y.max():
        return None
    bags = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in got["x"]]
    return train(np.concatenate(bags).astype(float), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y, seed)


def score(docs: DataFrame, model: GatedAttention | None) -> DataFrame:
    """``(doc_id, score, n_passages, top_attention)`` of every document."""

    def run(bs):
        for c in chunks(bs):
            x, bag = encode(c)
            if model is None:
                s, top = np.full(len(c), 0.5), np.zeros(len(c))
            else:
                # a block of documents at a time bounds the float matrices
                s, top = np.empty(len(c)), np.empty(len(c))
                i = 0
                while i < len(c):
                    j = max(i + 1, int(np.searchsorted(bag, bag[i] + 20_000, "right")) - 1)
                    out = model.forward(x[bag[i]:bag[j]], bag[i:j + 1] - bag[i])
                    s[i:j] = 1 / (1 + np.exp(-np.clip(out[-1], -30, 30)))
                    top[i:j] = np.maximum.reduceat(out[4], bag[i:j] - bag[i])
                    i = j
            yield pa.RecordBatch.from_arrays([c.rows.column("doc_id").combine_chunks(), pa.array(s), pa.array(np.diff(bag)), pa.array(top)],
                                             names=["doc_id", "score", "n_passages", "top_attention"])

    return narrow(docs).mapInArrow(run, "doc_id long, score double, n_passages long, top_attention double")


def op1_attention_mil(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from the rows that aren't held out."""
    from corpuscheck.llm.tables import read

    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(docs, labels, where=fold(F.col("doc_id"), FOLDS) != 0)
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "top_attention")
