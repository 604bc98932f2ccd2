import collections
import random
import re

from conftest_llm import words
from tidemark.llm import compress_quality, quality_rules


def corpus(n=240):
    rnd = random.Random(9)
    texts, good = [], []
    for k in range(n):
        w = words(rnd, rnd.randrange(60, 160))
        if k % 3 == 0:
            w = [x.upper() + "!!" for x in w] if k % 2 else [x + rnd.choice(["###", "$$$", "%%%"]) for x in w]
        texts.append(" ".join(w).capitalize())
        good.append(int(k % 3 != 0))
    return texts, good


def test_counts_against_brute_force(spark, documents, labels, odd_texts):
    got = quality_rules.quality_rules(documents, labels([])).collect()
    assert len(got) == documents.count()
    by = {r.doc_id: r for r in got}
    for k, text in enumerate(odd_texts):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        times = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {i + j for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for j in range(3)}
        r = by[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert (r.base_failed, r.kept, r.probability) == (failed, not failed, None)


def test_both_classifiers_learn_and_generalise(spark, labels):
    texts, good = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = labels([(k, good[k]) for k in range(160)] + [(1, 0), (1, 1), (2, None), (None, 1)])
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, known).collect()}
    assert sum(kept[k] == bool(good[k]) for k in range(160, 240)) >= 76
    scored = {r.doc_id: r for r in compress_quality.quality(docs, known).collect()}
    assert sum(scored[k].predicted == good[k] for k in range(160, 240)) >= 72
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored.values())


def test_held_out_labels_are_not_learnt_from(spark, labels):
    import zlib
    texts, good = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(k, good[k]) for k in range(240)]
    other = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in rows]
    first, second = ({r.doc_id: (r.held_out, r.score) for r in compress_quality.quality(docs, labels(x)).collect()} for x in (rows, other))
    assert first == second
    assert all(first[k][0] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in first)


def test_odd_rows(documents, no_documents, labels):
    for known in (labels([]), labels([(3, 1)])):
        got = compress_quality.quality(documents, known).collect()
        assert len(got) == documents.count() and all(r.score == 0.5 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [None]
    assert compress_quality.quality(no_documents, labels([(1, 1), (2, 0)])).collect() == []
    assert quality_rules.quality_rules(no_documents, labels([(1, 1), (2, 0)])).collect() == []
    out = compress_quality.scored(documents, (b"", b"", None), name="__s")
    assert out.columns == [*documents.columns, "__s"] and out.count() == documents.count()


def test_margins_against_loops_over_words_and_characters():
    """A margin is the mean weight of a text's n-grams of each kind; characters, not bytes, make n-grams."""
    import re

    import numpy as np
    import pyarrow as pa
    from tidemark.llm import quality_rules as Q
    from tidemark.llm.words import Scanner, chunks, hash_of, ngrams

    texts = ["été déjà vu", "plain words only here", "", "a", "漢字 かな 漢字", "x\U0001F600y\U0001F600z", "ab", "été déjà vu été", "日本"]
    scan = Scanner("spaced", lower=True)
    weights = np.random.default_rng(1).normal(size=Q.KINDS * Q.BUCKETS)

    def number(c):
        raw = c.encode()
        out = raw[0]
        for b in raw[1:]:
            out = out << 6 | b & 0x3F
        return out

    def gram(piece):
        out = 0
        for c in piece:
            out = (out + number(c)) * 0x9E3779B1 & 0xFFFFFFFF
        return out >> (32 - Q.BITS)

    def expected(text):
        words = hash_of([w.lower().encode() if w.isascii() else w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)], scan)
        kinds = [[int(h) >> (64 - Q.BITS) for h in words], [int(h) >> (64 - Q.BITS) for h in ngrams(words, 2)]]
        kinds += [[gram(text[k:k + n]) for k in range(len(text) - n + 1)] for n in (3, 4)]
        return Q.SCALE * sum(np.mean([weights[k * Q.BUCKETS + b] for b in own]) for k, own in enumerate(kinds) if own)

    for row, end, data, bounds in chunks(pa.array(texts)):
        got = Q.margins(data, bounds, scan(data, bounds), weights)
        assert np.allclose(got, [expected(t) for t in texts[row:end]])
