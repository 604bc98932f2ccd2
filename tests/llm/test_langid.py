import math
import random

from conftest_llm import words
from tidemark.llm import langid

ROW = "id long, text string, declared string, suffix string, host string"


def test_text_overrules_a_wrong_declaration_and_evidence_fills_gaps(spark):
    rnd = random.Random(2)
    rows = [(k, " ".join(words(rnd, 60, ("en", "fr")[k % 2])), ("en-GB", "FR")[k % 2], ("com", "fr")[k % 2], ("a.x.com", "b.y.fr")[k % 2]) for k in range(200)]
    rows += [(1000, " ".join(words(rnd, 60, "fr")), "en", "com", "a.x.com"), (1001, "an on", None, "fr", "b.y.fr"), (1002, "an on", None, "com", "a.x.com"), (1003, "12 + 34", "en", "com", "a.x.com"), (1004, None, None, None, None)]
    got = {r.id: r for r in langid.identify(spark.createDataFrame(rows, ROW)).collect()}
    assert all(got[k].language == ("en", "fr")[k % 2] and got[k].accepted for k in range(200))
    assert got[1000].language == "fr" and got[1000].accepted
    assert (got[1001].language, got[1002].language) == ("fr", "en")
    assert not got[1003].accepted and not got[1004].accepted and got[1004].text_language == "und"


def test_text_evidence_is_the_sum_over_its_grams(spark):
    import pyarrow as pa
    from tidemark.llm.words import chunks

    texts = ["The été", "", "a", "B1c d"]
    out = []
    for row, end, data, bounds in chunks(pa.array(texts)):
        grams, first = langid._grams(data, bounds)
        out += [grams[a:b].tolist() for a, b in zip(first[:-1], first[1:])]

    def expected(text):
        raw = [0, *(langid._LETTER[b] for b in text.encode()), 0]
        code = lambda a, b, c: (((((int(a) * 0x9E3779B1 + int(b)) & 0xFFFFFFFF) * 0x85EBCA6B + int(c)) & 0xFFFFFFFF) * 0xC2B2AE35 & 0xFFFFFFFF) >> (32 - langid.BITS)
        return [code(raw[k - 1], raw[k], raw[k + 1]) for k in range(1, len(raw) - 1) if raw[k]]

    assert out == [expected(t) for t in texts]


def _posterior(rows, names):
    """Language and posterior of every row from counted evidence, by loops over rows."""
    import numpy as np
    import pyarrow as pa
    from tidemark.llm.words import chunks

    grams = []
    for _, text, *_ in rows:
        own = [langid._grams(data, bounds)[0].tolist() for _, _, data, bounds in chunks(pa.array([text], pa.string()))]
        grams.append(own[0] if own else [])
    declared = [None if r[2] is None else r[2].lower().split("-")[0] for r in rows]
    model = {}
    for x in names[:-1]:
        counts = [langid.ADD] * langid.BUCKETS
        for own, d in zip(grams, declared):
            for g in own if d == x else []:
                counts[g] += 1
        model[x] = [math.log(c / sum(counts)) for c in counts] if any(d == x and g for d, g in zip(declared, grams)) else [-2 * math.log(langid.BUCKETS)] * langid.BUCKETS
    model["und"] = [-math.log(langid.BUCKETS)] * langid.BUCKETS
    texts = [[sum(model[x][g] for g in own) for x in names] for own in grams]
    looks = [names[int(np.argmax(t))] if own else "und" for t, own in zip(texts, grams)]
    lettered = [k for k, own in enumerate(grams) if own]

    def shares(values):
        seen = {values[k] for k in lettered if values[k] is not None}
        of = {v: [sum(values[k] == v and looks[k] == x for k in lettered) for x in names] for v in seen}
        sums = [sum(looks[k] == x and values[k] is not None for k in lettered) for x in names]
        return {v: [math.log((n + 1) / (sums[i] + max(1, len(seen)))) for i, n in enumerate(of[v])] for v in seen}

    says = [d if d is None or d in names[:-1] else "other" for d in declared]
    by_says, by_suffix = shares(says), shares([r[3] for r in rows])
    tally = lambda keep: [sum(looks[k] == x and keep(rows[k][4]) for k in lettered) for x in names]
    start = [1.0] * (len(names) - 1) + [langid.UND_ROWS]
    everything = tally(lambda h: True)
    whole = [(n + s) / (sum(everything) + sum(start)) for n, s in zip(everything, start)]
    site = lambda h: ".".join(h.split(".")[-2:])
    out = []
    for k, (i, _, _, suffix, host) in enumerate(rows):
        prior = whole
        if host is not None and any(rows[j][4] == host for j in lettered):
            s, h = tally(lambda x: x is not None and site(x) == site(host)), tally(lambda x: x == host)
            wide = [(n + langid.PRIOR_ROWS * w) / (sum(s) + langid.PRIOR_ROWS) for n, w in zip(s, whole)]
            prior = [(n + langid.PRIOR_ROWS * w) / (sum(h) + langid.PRIOR_ROWS) for n, w in zip(h, wide)]
        none = [0.0] * len(names)
        total = [langid.TEMPER * t + a + b + math.log(p) for t, a, b, p in zip(texts[k], by_says.get(says[k], none), by_suffix.get(suffix, none), prior)]
        top = max(total)
        out.append((i, names[total.index(top)], 1 / sum(math.exp(t - top) for t in total)))
    return out


def test_posterior_against_counted_evidence(spark):
    rnd = random.Random(6)
    rows = []
    for k in range(120):
        lang = rnd.choice(["en", "fr"])
        text = rnd.choice([" ".join(words(rnd, rnd.randrange(1, 12), lang)), "a b", "12", "", None, "été"])
        rows.append((k, text, rnd.choice([lang, "fr-CA", "en", "it", None]), rnd.choice(["com", "fr", None]), rnd.choice(["a.x.com", "b.x.com", "www.y.fr", "single", None, None])))
    rows += [(200, "12", None, None, "quiet.host.org"), (201, None, None, None, None)]
    names = (*langid.LANGUAGES, "und")
    got = {r.id: r for r in langid.identify(spark.createDataFrame(rows, ROW)).collect()}
    for i, language, posterior in _posterior(rows, names):
        assert abs(got[i].posterior - posterior) < 2e-6 and got[i].language == language, (i, rows[i], got[i], posterior)


def test_rows_without_host_have_the_prior_of_all_rows(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(words(rnd, 60, "en")), None, None, "a.com") for k in range(20)] + [(50 + k, " ".join(words(rnd, 60, "fr")), None, None, None) for k in range(20)]
    rows = [(i, t, ("en", "fr")[i >= 50], s, h) for i, t, _, s, h in rows] + [(100, "12 34", None, None, None), (101, "12 34", None, None, "unseen.net")]
    got = {r.id: r for r in langid.identify(spark.createDataFrame(rows, ROW)).collect()}
    assert got[100].posterior == got[101].posterior < 0.5


def test_odd_rows(spark, documents, no_documents):
    got = langid.identify(langid.of_documents(documents)).collect()
    assert len(got) == documents.count()
    by = {r.id: r for r in got}
    assert not by[0].accepted and not by[1].accepted and not by[7].accepted or by[7].n_letters > 0
    assert sum(r.id == 3 for r in got) == 3 and all(0 <= r.posterior <= 1 and not math.isnan(r.posterior) for r in got)
    assert langid.identify(langid.of_documents(no_documents)).collect() == []


def test_pages(spark):
    pages = spark.createDataFrame([(1, "https://Blog.a.fr/x", "<html class=a lang='fr-CA'><script>the the</script><p>le <b>mot</b></p><!-- of -->"), (2, None, None), (3, "no url", "<p>x")], "page_id long, url string, html string")
    got = {r.id: r for r in langid.of_pages(pages).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].text.split()) == ("fr-CA", "fr", "blog.a.fr", ["le", "mot"])
    assert got[2].host is None and got[3].declared is None


def test_empty_and_repeated_pages(spark):
    schema = "page_id long, url string, html string"
    assert langid.identify(langid.of_pages(spark.createDataFrame([], schema))).collect() == []
    rows = [(1, "https://a.fr/", "<html lang=fr><p>le mot et la suite")] * 3 + [(2, None, None)]
    got = sorted((r.id, r.language, r.posterior) for r in langid.identify(langid.of_pages(spark.createDataFrame(rows, schema))).collect())
    assert len(got) == 4 and got[0] == got[1] == got[2]
