import random

import numpy as np

from conftest_llm import brute_components
from tidemark.llm import minhash, scratch
from tidemark.llm.components import components


def _rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(30):
        base = rnd.choices(vocabulary, k=rnd.randrange(1, 120))
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(0, 12)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append("\n".join(copy).upper())
    rnd.shuffle(texts)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert _rows(got) == sorted(brute_components(texts), key=str)


def test_a_star_whose_centre_is_unlike_the_rest(spark):
    """All share the centre's buckets; links among the others must not be lost, nor invented."""
    rnd = random.Random(5)
    base = [f"b{k}" for k in range(300)]
    texts = [" ".join(base[:150] + [f"c{k}" for k in range(150)])]
    for k in range(40):
        copy = list(base)
        for _ in range(rnd.randrange(4, 10)):
            copy[rnd.randrange(300)] = f"x{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert _rows(got) == sorted(brute_components(texts), key=str)


def test_rows_that_repeat_an_id_have_links_of_their_own(spark):
    rnd = random.Random(9)
    a, c, alone = (" ".join(f"{x}{rnd.randrange(50)}" for _ in range(40)) for x in "acz")
    rows = [(1, a), (1, c), (2, a + " more"), (3, c + " more"), (4, alone), (4, a)]
    expected = sorted([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 1, False)], key=str)
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3))
        assert sorted(((r.doc_id, r.component_id, r.kept) for r in got.collect()), key=str) == expected


def test_small_sets_always_share_a_key():
    rng = np.random.default_rng(4)
    for _ in range(4000):
        union = int(rng.integers(3, minhash.SMALL + 1))
        both = -(-75 * union // 100)
        values = rng.integers(0, 2 ** 64, union, dtype=np.uint64)
        cut = int(rng.integers(both, union + 1))
        left, right = np.unique(values[:cut]), np.unique(np.concatenate([values[:both], values[cut:]]))
        assert set(minhash.small_keys(left).tolist()) & set(minhash.small_keys(right).tolist())


def test_many_short_texts_against_brute_force(spark):
    rnd = random.Random(8)
    texts = []
    for _ in range(60):
        base = [f"w{rnd.randrange(12)}" for _ in range(rnd.randrange(5, 14))]
        for _ in range(4):
            copy = list(base)
            copy[rnd.choice([0, -1])] = f"w{rnd.randrange(12)}"
            texts.append(" ".join(copy))
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert _rows(got) == sorted(brute_components(texts), key=str)


def test_odd_rows(documents, no_documents):
    got = minhash.near_duplicates(documents).collect()
    assert len(got) == documents.count()
    by = {r.doc_id: r for r in got}
    assert [(by[k].n_shingles, by[k].component_id, by[k].kept) for k in (0, 1, 2, 3)] == [(0, 0, True), (0, 1, True), (0, 2, True), (1, 3, True)]
    assert by[4].n_shingles == 1 and sum(r.doc_id == 3 for r in got) == 3
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert minhash.near_duplicates(no_documents).collect() == []


def test_sketch_estimates_similarity_also_of_small_sets():
    rng = np.random.default_rng(2)
    for size in (4, 40, 4000):
        agree = []
        for _ in range(40):
            common = rng.integers(0, 2 ** 64, size * 3 // 4, dtype=np.uint64)
            left, right = (np.unique(np.concatenate([common, rng.integers(0, 2 ** 64, max(1, size // 8), dtype=np.uint64)])) for _ in range(2))
            union = len(np.union1d(left, right))
            agree.append((minhash.sketch(left) == minhash.sketch(right)).mean() - len(np.intersect1d(left, right)) / union)
        assert abs(np.mean(agree)) < 0.05


def test_components_of_a_path_a_star_and_nothing(spark):
    links = [(k, k + 1) for k in range(20, 35)] + [(1, k) for k in range(2, 15)] + [(9, 9), (None, 3), (20, 21)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 20 for k in range(20, 36)}, **{k: 1 for k in range(1, 15)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sets_are_deduplicated_only_where_ids_repeat(spark, monkeypatch):
    """op4's disk: full sets with ids of their own are not shuffled to find copies; a repeated id still gives each set once."""
    plans, rows = [], []
    stage = minhash.stage

    def staged(df, name, **more):
        out = stage(df, name, **more)
        if name == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            rows.append(sorted(r["rep"] for r in out.select("rep").collect()))
        return out

    monkeypatch.setattr(minhash, "stage", staged)
    words = [f"w{i}" for i in range(200)]
    near = [" ".join(words), " ".join(words[:195] + ["other"])]
    far = " ".join(f"x{i}" for i in range(50))
    once = minhash.near_duplicates(spark.createDataFrame([(1, near[0]), (2, near[1]), (3, far)], "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in once.collect()) == [(1, 1), (2, 1), (3, 3)]
    again = [(1, near[0]), (1, near[0]), (2, near[1]), (2, near[0]), (3, far)]
    repeated = minhash.near_duplicates(spark.createDataFrame(again, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in repeated.collect()) == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 3)]
    assert "first(shingles" not in plans[0] and "first(shingles" in plans[1]
    assert all(len(found) == 2 == len(set(found)) for found in rows)


def _near_texts(seed, groups=12):
    rnd = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rnd.randrange(500)}" for _ in range(120)]
        for k in range(4):
            copy = list(base)
            copy[rnd.randrange(120)] = f"x{k}"
            texts += [" ".join(copy)] * (1 + k % 2)
    return texts


def test_sketches_and_sets_are_not_shuffled_to_find_their_class(spark, monkeypatch):
    """op4's disk: by size alone Spark broadcast small tables of classes, and shuffled whole sketches and sets beside larger ones."""
    plans = {}
    stage = minhash.stage

    def staged(df, name, **more):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name, **more)

    monkeypatch.setattr(minhash, "stage", staged)
    texts = _near_texts(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = _rows(minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == sorted(brute_components(texts), key=str)
    assert plans["buckets"].count("Exchange hashpartitioning") == 1  # of the keys
    assert plans["sets"].count("Exchange hashpartitioning") == 0


def test_tables_of_ids_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scratch, "BROADCAST_IDS", 0)
    texts = _near_texts(4)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert _rows(got) == sorted(brute_components(texts), key=str)


def test_a_set_of_an_own_id_and_of_a_repeated_one_is_staged_once(spark, monkeypatch):
    found = []
    stage = minhash.stage

    def staged(df, name, **more):
        out = stage(df, name, **more)
        if name == "sets":
            found.extend(r["rep"] for r in out.select("rep").collect())
        return out

    monkeypatch.setattr(minhash, "stage", staged)
    a, b = ([f"{x}{i}" for i in range(100)] for x in "ab")
    rows = [(1, a), (2, a), (2, b), (3, [*a, "more"]), (4, [*b, "more"]), (5, [f"c{i}" for i in range(60)]), (2, [])]
    rows = [(k, " ".join(words)) for k, words in rows]
    for order in (rows, rows[::-1]):
        found.clear()
        got = minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").coalesce(1))
        expected = [(1, 1), (2, 1), (2, 2), (2, 2), (3, 1), (4, 2), (5, 5)]
        assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == expected
        assert len(found) == 4 == len(set(found))
