import hashlib
import random

import numpy as np

from conftest_llm import brute_hits, words
from tidemark.llm import decontam
from tidemark.llm.words import U64


def _check(docs, items, spark):
    got = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    for doc_id, text in docs:
        n, hit, found = brute_hits(text, items)
        r = by[doc_id]
        names = ",".join(sorted(map(str, found)))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), hashlib.sha256(names.encode()).hexdigest(), hit > 0)
        assert sum(s.end - s.start for s in r.spans or []) == hit


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(1)
    common = words(rnd, 25)
    items = [(k, " ".join(rnd.choices(common, k=rnd.choice([3, 9, 10, 11, 30])))) for k in range(25)] + [(100, ""), (101, "!!"), (5, "the the the the the the the the the the the")]
    docs = []
    for k in range(60):
        text = rnd.choices(common, k=rnd.randrange(0, 80))
        for _ in range(rnd.randrange(0, 3)):
            q = rnd.choice(items)[1].split()
            cut = rnd.randrange(0, max(1, len(q)))
            text[rnd.randrange(len(text) + 1):0] = q[cut:cut + rnd.randrange(1, 25)]
        docs.append((k, ", ".join(text).title()))
    docs += [(900, None), (901, ""), (902, "The THE the " * 9), (903, items[0][1])]
    _check(docs, items, spark)
    monkeypatch.setattr(decontam, "QUERY_WORDS", 40)  # several blocks of items, long ones cut
    _check(docs, items, spark)


def test_odd_rows(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "One"), (1, "no id here"), (None, "a a a"), (2, None)], "item_id long, text string")
    got = decontam.contamination(documents, items).collect()
    assert len(got) == documents.count()
    assert sorted((r.doc_id, r.n_items) for r in got if r.contaminated and r.doc_id is not None) == [(3, 1)] * 3
    assert [r.n_hit for r in got if r.doc_id is None] == [3]
    assert decontam.contamination(no_documents, items).collect() == []
    assert not any(r.contaminated for r in decontam.contamination(documents, items.limit(0)).collect())


def test_proximity_matches_against_brute_force():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 6, 400).astype(U64)
    items = [(k, rng.integers(0, 6, 4).astype(U64)) for k in range(6)]
    phrases = decontam.Phrases(items, 4)
    order = np.argsort(text, kind="stable").astype(np.int32)
    terms, counts = np.unique(text[order], return_counts=True)
    for slop in (0, 1, 2):
        which, start = phrases.find(terms, counts, order, slop)
        got = set(zip(which.tolist(), start.tolist()))
        for k, row in enumerate(phrases.table):
            q = phrases.terms[row]
            freq = [counts[np.searchsorted(terms, t)] for t in q]
            rarest = int(np.argsort(freq, kind="stable")[0])
            for s in range(len(text) - 3):
                near = all(any(0 <= s + i + d < len(text) and text[s + i + d] == q[i] for d in (range(-slop, slop + 1) if i != rarest else (0,))) for i in range(4))
                assert ((k, s) in got) == near
