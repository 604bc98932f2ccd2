import hashlib
import random
import re
import zlib

import pytest

from tidemark.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:15]
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    convs = {c: [t[3:] for t in sorted(own)] for c, own in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        lender = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(lender, [])[:h] + own[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    if not convs:
        return []
    members = {}
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ended = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children), len(leaves), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **conf):
    for name in ("key", "n", "up", "depth", "words"):
        rows = [(*r, "clash") for r in rows]
    table = spark.createDataFrame(rows, SCHEMA + ", key string, n string, up string, depth string, words string")
    return sorted(map(tuple, T.trie(table).collect()), key=str)


def _rows(rnd, n_convs, longest, texts):
    rows = []
    for c in range(n_convs):
        for t in range(rnd.randrange(longest)):
            rows.append((c * rnd.choice([1, 1, 1, 2]), t, rnd.choice(["user", "user", None]), rnd.choice(texts)))
    return rows


def test_against_brute_force(spark):
    rnd = random.Random(11)
    rows = _rows(rnd, 60, 12, ["a", "a b", "", None, "c d\te"])
    rows += [(200 + k, t, "user", f"same {t}") for k in range(25) for t in range(9)]  # one large group, some of it grafted
    rows += [(300, None, "x", "null turn"), (300, None, "x", "null turn"), (300, 5, "x", "later"), (None, 1, "x", "no id"), (400, 1, None, None), (-7, 0, "u", "negative"), (-7, 1, "u", "negative"), (-7, 2, "u", "b"), (-7, 3, "u", "b")]
    rnd.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_long_conversations_over_many_tasks(spark):
    """Turns of one conversation lie in several tasks; the paths are deeper than a few doublings."""
    rows = [(c, t, "user", f"w {t} {t % 3 if c < 4 else c if t == 30 else 0}") for c in (0, 1, 2, 3, 20, 21, 22) for t in range(45)]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_conversation_and_none(spark):
    assert got(spark, [(5, 0, "u", "a")]) == brute([(5, 0, "u", "a")])
    assert got(spark, [(20, 0, "u", "a"), (20, 1, "u", "b c")]) == brute([(20, 0, "u", "a"), (20, 1, "u", "b c")])
    assert T.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert T.trie(spark.createDataFrame([(None, 1, "u", "a")], SCHEMA)).collect() == []


@pytest.mark.parametrize("piece", [1, 20])
def test_digests_of_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    batches = [T.pa.record_batch([T.pa.array([b"a"] * 3 + [b"b"] * 2, T.pa.binary()), T.pa.array([1, 5, 20, 3, 4])], names=["key", "conv_id"])]
    monkeypatch.setattr(T, "TaskContext", type("C", (), {"get": staticmethod(lambda: type("X", (), {"partitionId": lambda self: 3})())}))
    pieces = list(T._join_ids(iter(batches)))
    out = {r["key"]: r["ends_sha256"] for b in T._digest_ids(iter(pieces)) for r in b.to_pylist()}
    assert out == {b"a": hashlib.sha256(b"1,5,20").hexdigest(), b"b": hashlib.sha256(b"3,4").hexdigest()}
