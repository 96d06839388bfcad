import hashlib
import random

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuscheck.llm import op13_pieces as O
from corpuscheck.llm.words import chunks

from .texts import SCHEMA, corpus, frame

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=O.model_path())
VOCABULARY = O.Vocabulary(O.model_path())


def _whole(text):
    """What the library gives for a text, with begin and end."""
    return [LIBRARY.bos_id(), *LIBRARY.encode(text or ""), LIBRARY.eos_id()]


def _digest(text):
    ids = _whole(text)
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


EDGES = ["", " ", "  a", "a  b", "a" + " " * 40 + "b", " " * 100, "\n\n\t", "▁x", "x ▁ y", "<s> </s> <unk> <0x0A>", "\x00a",
         "日本語テキスト", "a" * 25, "́é", "a\xa0b", "\r\n", "�", "abc" * 2000, "😀😀", "end ", " \n x"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("aeinstEhr ▁\n.,é日", max_size=80),
                 st.lists(st.sampled_from(sorted(VOCABULARY.id_of)[::7]), max_size=8).map("".join)))
def test_equals_the_library(text):
    assert VOCABULARY.encode(text) == LIBRARY.encode(text)


def test_edge_texts_equal_the_library():
    for text in EDGES:
        assert VOCABULARY.encode(text) == LIBRARY.encode(text), text


def test_backtracking_alone_equals_merging():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("aeinstrhé▁") for _ in range(rng.randrange(1, 30)))
        tokens = VOCABULARY.backtrack(VOCABULARY.longest(text).tolist())
        assert [VOCABULARY.text(t) for t in tokens] == VOCABULARY.merge(text)


def test_longest_first_is_not_always_right():
    """Some texts need a step back, or the method would be plain longest match."""
    rng, back = random.Random(5), 0
    for _ in range(500):
        text = "▁" + "".join(rng.choice("aeinstrh") for _ in range(12))
        longest = VOCABULARY.longest(text)
        at, greedy = 0, []
        while at < len(text):
            greedy.append(int(longest[at]))
            at += VOCABULARY.width[greedy[-1]] if greedy[-1] >= 0 else 1
        back += greedy != VOCABULARY.backtrack(longest.tolist())
    assert back > 50


def test_remembered_parts_change_nothing():
    """Generations that turn over in every chunk give the same ids."""
    memory = O.PartIds(VOCABULARY, limit=20)
    docs = [t for _, t in corpus(seed=8, n=40) if t is not None] + EDGES
    for _ in range(2):
        table = pa.table({"doc_id": pa.array(range(len(docs)), pa.int64()), "text": pa.array(docs, pa.string())})
        for c in chunks(iter(table.to_batches(max_chunksize=7)), max_bytes=3000):
            ids, first = O.token_ids(c, memory)
            for i in range(len(c)):
                assert ids[first[i]:first[i + 1]].tolist() == LIBRARY.encode(c.text(i).decode())
    assert len(memory.young[0]) < 5000


def test_documents_and_edge_cases(spark):
    """NULL id and text, empty, very long, repeated rows, extra columns with clashing names."""
    docs = corpus() + list(zip(range(1000, 1000 + len(EDGES)), EDGES)) + [(2000, "no blanks " + "xyzé" * 20_000)]
    got = sorted(map(tuple, O.digests(frame(spark, docs)).collect()), key=str)
    assert got == sorted(((i, *_digest(t)) for i, t in docs), key=str)


def test_round_trip(spark):
    docs = corpus(seed=6)
    coded = O.encode_documents(frame(spark, docs))
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    got = sorted(map(tuple, O.decode_documents(coded).collect()), key=str)
    assert got == sorted(((i, t or "") for i, t in docs), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert O.digests(empty).collect() == [] and O.decode_documents(O.encode_documents(empty)).collect() == []


def test_query_over_given_tables(spark):
    from corpuscheck.llm.tables import read

    got = {r.doc_id: tuple(r)[1:] for r in O.op13_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: _digest(r.text) for r in read(spark, "/root/testdata/sf0.001", "documents").collect()}
