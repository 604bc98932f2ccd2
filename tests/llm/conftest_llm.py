"""Data and brute-force versions that several tests share."""

import re

from pyspark.sql import types as T

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it".split(), "fr": "le ou eau eux ai oi é è tre ment que qu an on".split()}


def words(rnd, n, lang="en"):
    return ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n)]


def brute_components(texts):
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), root(d), root(d) == d) for d in range(len(texts))]


def brute_hits(text, items, window=10, slop=0):
    """(n_words, n_hit, sorted item ids) of a text."""
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    w = split(text)
    hit, found = set(), set()
    for item, asked in items:
        q = split(asked)
        size = min(window, len(q))
        for k in range(len(q) - size + 1 if size else 0):
            for at in range(len(w) - size + 1):
                if w[at:at + size] == q[k:k + size]:
                    hit |= set(range(at, at + size))
                    found.add(item)
    return len(w), len(hit), sorted(found)
