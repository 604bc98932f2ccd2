import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, simple8b
from tidemark.llm.tokens import Encoder


def _ids(encode, texts):
    return [ids[bounds[k]:bounds[k + 1]].tolist() for row, end, ids, bounds in encode(pa.array(texts, pa.string())) for k in range(end - row)]


def test_cached_ids_are_the_librarys(tokenizer, odd_texts):
    encode = Encoder(tokenizer)
    library = Tokenizer.from_file(tokenizer)
    assert encode.fast
    rnd = random.Random(5)
    signs = [chr(c) for c in range(256)] + list("ΣσςİıǅŁłēë́̈ 　 ​'''stredvml") + ["'s", "'re", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "</w>"]
    texts = [t for t in odd_texts] + ["".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 60))) for _ in range(2000)]
    texts += ["hello <|endoftext|> world <|startoftext|>", "<|endoftext|>", "<|endof"]
    expected = [library.encode(t, add_special_tokens=False).ids if t else [] for t in texts]
    assert any(49407 in ids for ids in expected)
    assert _ids(encode, texts) == expected
    assert _ids(encode, texts[::-1]) == expected[::-1]  # from the cache
    encode.fast = False
    assert _ids(encode, texts[:50]) == expected[:50]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 300), st.integers(0, 50_000), st.integers(0, 2 ** 64 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    assert simple8b.decode(simple8b.encode(np.array(ids, np.uint64))).tolist() == ids


def test_small_ids_share_words_and_ranges_read_alone(tmp_path):
    assert len(simple8b.encode(np.zeros(600, np.uint64))) == 10
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (0, 1, 70_000, 5, 200_000, 3)]
    path = tmp_path / "x.ids"
    with open(path, "wb") as out:
        writer = simple8b.Writer(out)
        for k, ids in enumerate(docs):
            writer.add(None if k == 3 else k, ids)
        writer.close()
    with simple8b.files.opened(str(path)) as source:
        reader = simple8b.Reader(source)
        for k in (5, 2, 0, 4, 1, 3):
            d = reader.docs[k]
            assert (d["null"] != 0) == (k == 3) and reader.ids(int(d["start"]), int(d["n"])).tolist() == docs[k].tolist()
        assert reader.ids(69_000, 5000).tolist() == np.concatenate(docs)[69_000:74_000].tolist()
    path.write_bytes(path.read_bytes()[:-1])
    with simple8b.files.opened(str(path)) as source, pytest.raises(ValueError):
        simple8b.Reader(source)


def _library(tokenizer, text):
    return Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids + [1]


def test_token_files_round_trip(documents, no_documents, tokenizer, odd_texts):
    got = simple8b.read_token_files(simple8b.write_token_files(documents, tokenizer)).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, expected = 0, []
    for doc_id, text in rows:
        ids = _library(tokenizer, text)
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    assert simple8b.read_token_files(simple8b.write_token_files(no_documents, tokenizer)).collect() == []


def test_pieces_cover_every_id_once(documents, no_documents, tokenizer):
    got = packing.pack(documents, tokenizer, window=256, with_ids=True).collect()
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    sequences, rows = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
        rows.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 256
    for doc_id, own in rows.items():
        ids = _library(tokenizer, texts[doc_id])
        if doc_id != 3:  # the repeated row is three documents
            assert [x for r in sorted(own, key=lambda r: r.start) for x in r.ids] == ids
        assert all(r.ids == ids[r.start:r.start + r.length] and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *r.ids)) for r in own)
    assert sum(r.length for r in rows[3]) == 3 * len(_library(tokenizer, "One"))
    assert packing.pack(no_documents, tokenizer).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=120), st.sampled_from([64, 100, 256]))
def test_plans_are_whole(lengths, window):
    plan = packing.plan(np.array(lengths, np.int64), window)
    pieces = sorted(p for own in plan for p in own)
    assert all(0 < sum(n for *_, n in own) <= window for own in plan)
    for d, n in enumerate(lengths):
        at = 0
        for _, start, size in [p for p in pieces if p[0] == d]:
            assert start == at
            at += size
        assert at == n


def test_little_padding_also_of_equal_lengths():
    rng = np.random.default_rng(1)
    for lengths in ([1100] * 3000, rng.integers(1, 4000, 3000), (rng.lognormal(6.3, 1.2, 3000) + 1).astype(int)):
        assert len(packing.plan(np.array(lengths))) * 2048 <= 1.01 * sum(lengths)


def test_nnls_solves_and_stays_positive():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, true = rng.random((12, 30)), np.maximum(0, rng.normal(size=30))
        x = packing.nnls(a, a @ true)
        assert (x >= 0).all() and np.abs(a @ x - a @ true).max() < 1e-6
        b = rng.normal(size=12)
        x = packing.nnls(a, b)
        slope = a.T @ (a @ x - b)  # optimal: no descent direction, none at all where x > 0
        assert (slope > -1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6
