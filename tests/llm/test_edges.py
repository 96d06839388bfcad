"""Every query and the pipeline on one small set of tables with NULLs, empty and very long texts, repeated rows and ties:
extra columns whose names operators use inside change nothing, and empty tables give empty results."""

import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from corpuscheck.llm.queries import QUERIES

from .texts import corpus, prose, words

CLASHES = ("bucket chunk kind payload fp line line_no lid h1 h2 key keys tok tokens n k a b u v g m id ids node component component_id rep place links kept "
           "gone_id gone_lines sequence_id offset piece start length score predicted held held_out host path rule verdict action ts record_id digest source_id "
           "signature word ord cost audit turns seq chars part first last before after back hash stays contaminated n_items quality_").split()


def _tables(spark, path, extra):
    rng = random.Random(31)
    docs = corpus(seed=9, n=24) + [(700, "\n".join(prose(rng, 300) for _ in range(200))), (701, " ".join(words(rng, 9000))), (701, " ".join(words(rng, 40)))]
    labels = [(i, 0 if k % 5 == 0 else 1, 0) for k, (i, _) in enumerate(docs) if i is not None] + [(None, 1, 0), (3, None, None), (3, 1, 0)]
    item = " ".join(words(rng, 30))
    docs += [(702, docs[0][1] + " " + item if docs[0][1] else item), (703, item)]
    link = '<link rel="canonical" href="http://h1.com/de/x">'
    pages = [(i, f"http://h{i % 7}.com/{('de', 'fr', 'x')[i % 3]}/{i % 4}", link if i % 6 == 0 else f"<p>{i % 3}</p>") for i in range(40)]
    pages += [(100, None, None), (101, "none", ""), (102, "http://long.org/" + "p/" * 5000, "<p>" + "long " * 60_000), (5, "http://h5.com/x/1", "<p>2</p>"), (None, "http://q.com/", "x")]
    talk = [(c, t, ("user", "assistant")[t % 2], f"{'same' if c % 3 else c} {t}.") for c in range(95, 140) for t in range(c % 5 + 1)]
    talk += [(None, 1, "user", "x."), (110, None, None, None), (111, 3, "user", "long " * 60_000), (112, 0, "user", "a."), (112, 0, "user", "a."), (112, 0, "", "")]
    tables = {"documents": (docs, "doc_id long, text string"), "labels": (labels, "doc_id long, quality int, toxic int"),
              "benchmark": ([(0, item), (1, None), (2, ""), (0, item), (None, "one two three four five six")], "item_id long, text string"),
              "pages": (pages, "page_id long, url string, html string"),
              "conversations": (talk, "conv_id long, turn long, role string, text string")}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        for c in CLASHES if extra else ():
            if c not in df.columns:
                df = df.withColumn(c, F.lit(f"<{c}>"))
        df.coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return tables


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    plain, extra = (str(tmp_path_factory.mktemp(n)) for n in ("plain", "extra"))
    _tables(spark, extra, True)
    return plain, extra, _tables(spark, plain, False)


def _rows(df, but=()):
    cols = [c for c in df.columns if c not in but]
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_extra_columns_change_nothing(spark, both, name):
    plain, extra, tables = both
    # packing may number and fill its sequences in any way
    free = ("sequence_id", "offset") if name.startswith("op8") else ()
    got = _rows(QUERIES[name](spark, extra), free)
    assert got == _rows(QUERIES[name](spark, plain), free) and got
    docs = tables["documents"][0]
    if name.split("_")[0] in ("op1", "op2", "op3", "op4", "op7", "op13"):
        assert len(got) == len(docs), "a row for each row, repeated and NULL ids too"


def test_pipeline_passes_columns_on(spark, both):
    _, extra, _ = both
    docs = spark.read.parquet(f"{extra}/documents.parquet")
    for name, stage in P.STAGES:
        out = P.materialize(stage(spark, docs, extra), f"edges-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.filter(" OR ".join(f"{c} <> '<{c}>' OR {c} IS NULL" for c in CLASHES)).count() == 0
            assert 0 < out.count() <= docs.count()
            before = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
            if name != "line_dedup":
                assert {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()} <= before
        docs = out
    assert docs.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in (("documents", "doc_id long, text string"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string"),
                          ("pages", "page_id long, url string, html string"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
