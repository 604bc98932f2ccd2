import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from conftest_llm import words
from tidemark.llm import ctw


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 10, 1000.5, 1e7])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def _texts():
    rnd = random.Random(8)
    return [" ".join(words(rnd, rnd.randrange(0, 60))) for _ in range(60)] + [None, "", "Never Seen\nqzx"]


def _stream(text):
    return b" " * ctw.DEPTH + b"".join(w.encode() + b" " for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))) + b"\n"


def _brute(texts, learnt):
    """Recursive context trees over dictionaries: log2 of the probability of each text."""
    counts = {}
    streams = [_stream(t) for t in texts]
    total = Counter(b for k in learnt for b in streams[k][ctw.DEPTH:])
    decisions = ctw.Decisions(np.array([total[b] for b in range(256)], float))
    path = {b: list(zip(*(x.tolist() for x in decisions.of(np.array([b]))[1:]))) for b in range(256)}
    for k in learnt:
        for at in range(ctw.DEPTH, len(streams[k])):
            for d in range(ctw.DEPTH + 1):
                for node, bit in path[streams[k][at]]:
                    counts.setdefault((node, streams[k][at - d:at]), [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    children = {}
    for node, context in counts:
        if context:
            children.setdefault((node, context[1:]), []).append((node, context))
    log_w, weight = {}, {}
    for key in sorted(counts, key=lambda x: -len(x[1])):
        own = kt(*counts[key])
        if key in children:
            both = own, sum(log_w[c] for c in children[key])
            log_w[key] = max(both) + math.log(sum(math.exp(x - max(both)) for x in both)) - math.log(2)
            weight[key] = math.exp(own - math.log(2) - log_w[key])
        else:
            log_w[key], weight[key] = own, 1.0
    out = []
    for s in streams:
        bits = 0.0
        for at in range(ctw.DEPTH, len(s)):
            for node, bit in path[s[at]]:
                p, rest = 0.0, 1.0
                chain = [(node, s[at - d:at]) for d in range(ctw.DEPTH + 1) if (node, s[at - d:at]) in counts]
                for k, key in enumerate(chain):
                    one = (counts[key][1] + 0.5) / (sum(counts[key]) + 1)
                    share = 1.0 if k == len(chain) - 1 else weight[key]
                    p, rest = p + rest * share * one, rest * (1 - share)
                p = p if chain else 0.5
                bits += math.log2(p if bit else 1 - p)
        out.append(bits)
    return out


def test_scores_against_brute_force(spark, monkeypatch):
    texts = _texts()
    docs = spark.createDataFrame([(k, t, "x", 0.1) for k, t in enumerate(texts)], "doc_id long, text string, hash string, score double")
    learnt = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 7 != 2]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]
    c = Counter(w for k in learnt for w in split(texts[k]))
    n, v = sum(c.values()), len(c)
    bits = _brute(texts, learnt)
    for most_words in (ctw.MOST_WORDS, 10):  # all words looked up, and most of them joined
        monkeypatch.setattr(ctw, "MOST_WORDS", most_words)
        got = {r.doc_id: r for r in ctw.language_model(docs).collect()}
        assert len(got) == len(texts)
        for k, text in enumerate(texts):
            r, w = got[k], split(text)
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k not in learnt, len(w), sum(x in c for x in w), n)
            assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
            assert math.isclose(r.score, bits[k] * math.log10(2), rel_tol=1e-6)


def test_scores_do_not_depend_on_what_is_looked_up(spark, monkeypatch):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learnt = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 7 != 2]
    bits = _brute(texts, learnt)
    for most in (0, 300):  # all codes joined, and all but the most frequent
        monkeypatch.setattr(ctw, "MOST_GRAMS", most)
        got = {r.doc_id: r.score for r in ctw.language_model(docs).collect()}
        assert all(math.isclose(got[k], bits[k] * math.log10(2), rel_tol=1e-6) for k in range(len(texts)))


def test_probabilities_sum_to_one_also_when_pruned():
    rng = np.random.default_rng(0)
    text = b" " * ctw.DEPTH + bytes(rng.choice(list(b"abcd \n"), 3000).tolist())
    depth, context, byte, n = [], [], [], []
    for d in range(ctw.DEPTH + 1):
        seen = Counter((int.from_bytes(text[k - d:k][::-1], "little"), text[k]) for k in range(ctw.DEPTH, len(text)))
        of = Counter(c for c, b in seen.elements())
        for (c, b), many in seen.items():
            if of[c] >= 4:
                depth.append(d), context.append(c), byte.append(b), n.append(many)
    model = ctw.fit(np.array(depth), np.array(context, np.uint64), np.array(byte), np.array(n))
    for history in (b"abcda", b"     ", b"zzzzz", b"a\n bz"):
        code = int.from_bytes(history[::-1], "little") << 8
        assert math.isclose((2 ** model.log2(np.array([code | b for b in range(256)], np.uint64))).sum(), 1, rel_tol=1e-9)


def test_odd_rows(documents, no_documents):
    got = ctw.language_model(documents).collect()
    assert len(got) == documents.count() and all(r.score < 0 and r.n_tokens >= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [None]
    assert ctw.language_model(no_documents).collect() == []
