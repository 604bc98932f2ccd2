import random

import pytest

from conftest_llm import DOCUMENT, brute_components, brute_hits, words


@pytest.fixture()
def folder(spark, tmp_path):
    """A small corpus with copies, near copies, benchmark passages, junk and odd rows; good labels."""
    rnd = random.Random(21)
    texts = [" ".join(words(rnd, rnd.randrange(80, 160), ("en", "fr")[k % 2])) for k in range(80)]
    items = [" ".join(words(rnd, 30)) for _ in range(5)]
    texts += [texts[k] for k in range(5)] + [texts[k] + " more words" for k in range(5, 10)]
    texts += [texts[20 + k] + " " + items[k] for k in range(5)]
    junk = [" ".join(w.upper() + "!!###" for w in words(rnd, 100)) for _ in range(60)]
    rows = [(k, t, ("en", "fr")[k % 2], f"s{k % 3}", len(t)) for k, t in enumerate(texts + junk)]
    rows += [(1000, None, "en", None, None), (1001, "", None, "s1", 0), (1002, "12 34", "en", "s1", 5)]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k < len(texts)), 0) for k in range(len(texts + junk))], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, list(enumerate(items)), len(texts)


def test_stages_against_brute_force(spark, folder):
    import corpus_pipeline

    sf, rows, items, n_good = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = apply(spark, docs, sf)
        assert docs.columns == DOCUMENT.names
        after = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = spark.createDataFrame(after, DOCUMENT)
        kept = {r.doc_id for r in after}
        assert all(r in before for r in after)
        if name == "language ID":
            assert kept == {r.doc_id for r in before} - {1000, 1001, 1002}
        elif name == "quality classifier":
            assert kept == set(range(n_good))
        elif name == "MinHash near-dedup":
            texts = [r.text for r in before]
            assert kept == {before[d].doc_id for d, _, _, first in brute_components(texts) if first}
        else:
            assert kept == {r.doc_id for r in before if not brute_hits(r.text, items)[1]}
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in pieces} == kept
    by = {}
    for r in pieces:
        by[r.doc_id] = by.get(r.doc_id, 0) + r.length
    assert all(by[r.doc_id] == r.doc_tokens for r in pieces)


def test_empty_tables(spark, folder, tmp_path):
    import corpus_pipeline

    sf, *_ = folder
    docs = spark.createDataFrame([], DOCUMENT)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, sf).collect() == []


def test_stages_pass_on_any_columns(spark, folder, documents):
    import corpus_pipeline

    sf, *_ = folder
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, documents, sf)
        assert out.columns == documents.columns, name
        assert out.filter("doc_id is null").count() <= 1


def test_registered(spark):
    import __spark_entry__ as entry
    from tidemark.llm import queries

    names = set(queries.QUERIES)
    assert {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
    assert names <= set(entry.queries()) and set(queries.ORACLES) <= names
    assert "pipeline" not in entry.oracle_sql()


def test_the_rest_does_without(monkeypatch):
    """Without the subpackage, the pipeline or a library of theirs the entry point has the other queries."""
    import sys

    import __spark_entry__ as entry

    rest = {n for n in entry.queries() if not n.startswith(("op", "pipeline", "language_id"))}
    for gone in ("tidemark.llm", "corpus_pipeline", "zstandard"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n.startswith(("tidemark.llm", "corpus_pipeline", "zstandard"))]:
                m.delitem(sys.modules, name)
            m.setattr(sys, "meta_path", [_Gone(gone), *sys.meta_path])
            import tidemark
            m.delattr(tidemark, "llm", raising=False)
            assert rest <= set(entry.queries()) and not any(n.startswith("op1_") for n in entry.queries())


class _Gone:
    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
