import hashlib
import random
import re

from tidemark.llm import credentials as C

WORDS = ["plain", "é漢", "user=bob", "user_name: 'al.ice'", "https://a.example/x?y=1", "host = db1.example.org", "password=hunter22", "PassWd : \"S3cret/+=\"", "secret: token: abcdefg",
         "pwd=abc", "pass = opensesame", "auth:Zm9vYmFy", "AKIA" + "B2" * 9, "AKIAshort", "0123456789abcdef" * 2, "deadbeef" * 4, "Ab0" * 12 + "==", "api-key=x", "apikey='0123456789abcdef01234567'", "x" * 150]


def brute(text, breaks=True):
    """All spans of a text by one scan a kind and a comparison of all pairs."""
    text = text or ""
    found = []
    for n, (kind, pattern, group, least, role) in enumerate(C.KINDS):
        pattern = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}.get(kind, pattern)
        for m in re.finditer(pattern, text, re.A):
            if len(m[group]) >= least:
                found.append((m.start(), n, m.end(), role, len(re.findall(C.SCOPE, text[:m.start()]))))
    shown = []
    for s in found:
        if s[1] >= C.STRONG:
            apart = lambda o: o[0] >= s[2] or o[2] <= s[0]  # noqa: B023, E731
            if any(o[1] < C.STRONG and not apart(o) for o in found):
                continue
            near = [o for o in found if apart(o) and o[4] == s[4] and o[0] <= s[2] + C.REACH and o[2] >= s[0] - C.REACH]
            if not any((s[3] == "secret") != (o[3] == "secret") for o in near):
                continue
        shown.append(s)
    name = lambda x: ",".join(f"{C.KINDS[n][0]}:{a}:{b}" for a, n, b, *_ in sorted(x))
    strong = [s for s in found if s[1] < C.STRONG]
    return (*(sum(s[1] == n for s in strong) for n in range(C.STRONG)), hashlib.sha256(name(strong).encode()).hexdigest(), name(shown))


def test_against_brute_force(spark):
    rnd = random.Random(13)
    texts = ["".join(rnd.choice(WORDS) + rnd.choice([" ", " ", "\n", ", ", "\n\n", "\n \t\r\n"]) for _ in range(rnd.randrange(30))) for _ in range(300)]
    texts += [None, "", " ", "\n\n\n\nuser=bob\n\n\npass=opensesame", "user=bob\npass=opensesame", "pass=opensesame", "user=bob", "user=bob " + "x " * 99 + "pass=opensesame", "user=bob " + "x " * 101 + "pass=opensesame"]
    texts += ["".join(rnd.choice(WORDS) + rnd.choice(" \n") for _ in range(4000)), "password=abcdef " * 700 + "user=bob\n" * 700, "0a" * 20_000]
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts)] + [(1, texts[1], "clash", 7), (None, "token=abcdefgh", "clash", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row int")
    got = C.secrets(docs)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((k, *brute(t)) for k, t, *_ in rows), key=key)


def test_weak_parts_count_only_together(spark):
    texts = ["see https://a.example/ for more", "https://a.example/ user=bob", "https://a.example/ pass=opensesame", "https://a.example/\n\npass=opensesame", "password=hunter22 https://a.example/"]
    got = C.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.spans for r in got] == ["", "", "endpoint:0:18,part:19:34", "", "assign:0:17,endpoint:18:36"]


def test_no_documents(spark):
    assert C.secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_plan_has_no_python(spark):
    plan = C.secrets(spark.createDataFrame([(1, "user=a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
