import math
import random
import zlib

import numpy as np
import pyarrow as pa

from corpuscheck.llm import op1_mil as M
from corpuscheck.llm.words import chunks

from .texts import SCHEMA, corpus, frame, prose


def _labelled(n=160):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = prose(rng, rng.randrange(20, 400))
        docs.append((i, " ".join(w + "###" for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1))
    return docs, labels


def test_passages_cover_the_whole_text():
    docs = corpus()
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "text": pa.array([t for _, t in docs], pa.string())})
    (c,) = chunks(iter([batch]))
    x, bag = M.encode(c)
    n = [len((t or "").split()) if t is not None else 0 for _, t in docs]
    assert len(x) == bag[-1] and np.isfinite(x).all()
    got = [x[bag[i]:bag[i + 1], 11].sum() * M.PASSAGE_WORDS for i in range(len(docs))]
    from .texts import WORD

    assert np.allclose(got, [len(WORD.findall(t or "")) for _, t in docs])
    assert max(n) > 4 * M.PASSAGE_WORDS and (np.diff(bag) >= 1).all()


def test_gradients_match_differences():
    rng = np.random.default_rng(4)
    x, bag, y = rng.standard_normal((12, M.N_FEATURES)), np.array([0, 3, 4, 9, 12]), np.array([1.0, 0, 1, 0])
    model = M.GatedAttention(np.zeros(M.N_FEATURES), np.ones(M.N_FEATURES))

    def loss():
        z = model.forward(x, bag)[-1]
        return np.mean(np.log1p(np.exp(z)) - y * z)

    for name, g in model.gradients(x, bag, y).items():
        flat = model.p[name].reshape(-1)
        k = int(np.argmax(np.abs(g)))
        old = flat[k]
        flat[k] = old + 1e-6
        up = loss()
        flat[k] = old - 1e-6
        down = loss()
        flat[k] = old
        assert abs((up - down) / 2e-6 - g.reshape(-1)[k]) < 1e-5


def test_forward_pass_equals_the_definition():
    rng = np.random.default_rng(9)
    x, bag = rng.standard_normal((9, M.N_FEATURES)), np.array([0, 1, 6, 9])
    model = M.GatedAttention(rng.standard_normal(M.N_FEATURES), rng.uniform(0.5, 2, M.N_FEATURES))
    p = model.p
    for i in range(3):
        hidden, weight = [], []
        for passage in x[bag[i]:bag[i + 1]]:
            h = [max(0.0, sum((passage[f] - model.mean[f]) / model.scale[f] * p["W"][f, k] for f in range(len(passage))) + p["b"][k])
                 for k in range(M.HIDDEN)]
            gate = 0.0
            for k in range(M.ATTENTION):
                t = math.tanh(sum(h[j] * p["V"][j, k] for j in range(M.HIDDEN)))
                s = 1 / (1 + math.exp(-sum(h[j] * p["U"][j, k] for j in range(M.HIDDEN))))
                gate += p["w"][k] * t * s
            hidden.append(h)
            weight.append(math.exp(gate))
        z = sum(w / sum(weight) * h[k] * p["c"][k] for w, h in zip(weight, hidden) for k in range(M.HIDDEN)) + p["d"][0]
        assert abs(model.score(x, bag)[i] - 1 / (1 + math.exp(-z))) < 1e-9


def test_training_takes_every_passage_of_every_sampled_text(spark, monkeypatch):
    docs, labels = _labelled(30)
    docs.append((100, " ".join(f"long{i}" for i in range(M.PASSAGE_WORDS * 500))))
    labels.append((100, 1))
    seen = {}
    monkeypatch.setattr(M, "train", lambda x, bag, y, seed: seen.update(x=x, bag=bag, y=y))
    M.fit(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert sorted(np.diff(seen["bag"])) == sorted(-(-len(t.split()) // M.PASSAGE_WORDS) for _, t in docs)
    # every document is in one step of an epoch, the long one with few others
    sizes = np.diff(seen["bag"])
    monkeypatch.setattr(M, "STEP_PASSAGES", 300)
    parts = list(M.steps(np.random.default_rng(1).permutation(len(sizes)), sizes))
    assert sorted(np.concatenate(parts).tolist()) == list(range(len(sizes)))
    assert all(len(p) == 1 or sizes[p].sum() <= 300 for p in parts)


def test_held_out_accuracy_and_edges(spark, tmp_path):
    docs, labels = _labelled()
    docs += [(1000 + k, t) for k, (_, t) in enumerate(corpus(n=10))] + [(None, "a b"), (5, docs[5][1])]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = M.op1_attention_mil(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 if r.doc_id is not None else True)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 20 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert len({r.score for r in got if r.doc_id == 5}) == 1


def test_without_labels_or_rows(spark, tmp_path):
    docs = frame(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in M.score(docs, M.fit(docs, labels)).collect()] == [0.5, 0.5]
    assert M.score(spark.createDataFrame([], SCHEMA), None).count() == 0
