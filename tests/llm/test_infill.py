import hashlib
import random
import re

import pytest

from conftest_llm import words
from tidemark.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc, text):
    """The transformation on strings."""
    text = text or ""
    u = UNIT.findall(text)
    h = [int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(u), "plain", None, None, text
    return len(u), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


@pytest.fixture(params=[7, 100, infill.FRAME])
def frame(request, monkeypatch):
    monkeypatch.setattr(infill, "FRAME", request.param)


def _cases(odd_texts):
    rnd = random.Random(12)
    texts = odd_texts + ["x <P> y", "<S>", "a<M>", "<", "<P", "P>a", " a ", "a ", "\n", "é 漢 \U0001F600 ß", "y" * 200_000, " " * 200_000, "a <S <P <M " * 50]
    return texts + ["".join(rnd.choice(["é", " ", "\n", "<P", ">", "word", "漢", "<", "\x0b", "\xa0"]) for _ in range(rnd.randrange(300))) for _ in range(300)]


def test_rearranged_and_back(frame, odd_texts):
    """Every form, by frames of a few bytes up to whole texts, without Spark."""
    import pyarrow as pa

    texts = _cases(odd_texts)
    ids = list(range(1, len(texts))) + [None]
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    documents = list(infill._rearrange(42)(infill._store(iter([batch]))))
    for text, doc, row, joined, digest in zip(texts, ids, documents, infill._join(iter(documents)), infill._digest(iter(documents))):
        n, form, prefix, middle, output = brute(doc, text)
        assert [row.column(c)[0].as_py() for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")] == [doc, n, form, prefix, middle]
        assert joined.column("text")[0].as_py() == output
        assert digest.column("output_sha256")[0].as_py() == hashlib.sha256(output.encode()).hexdigest()
        assert digest.column("restored_sha256")[0].as_py() == hashlib.sha256((text or "").encode()).hexdigest()
    assert len({r.column("form")[0].as_py() for r in documents}) == 3


def test_whole_frames_are_taken_over(monkeypatch):
    """Only the frames that hold a cut are decompressed."""
    import numpy as np
    import pyarrow as pa

    text = " ".join(words(random.Random(1), 100_000))
    batch = pa.record_batch([pa.array([1], pa.int64()), pa.array([text])], names=["doc_id", "text"])
    row = next(iter(infill._store(iter([batch])))).to_pylist()[0]
    source = infill.Frames(row["frames"], row["bytes"], row["units"], row["chars"])
    opened = set()
    frame = infill.Frames.frame
    monkeypatch.setattr(infill.Frames, "frame", lambda self, k: (opened.add(k), frame(self, k))[1])
    n, form, *_, frames, sizes = infill.rearranged(source, False, [30_000, 70_000, 0, 0], infill.Scanner("spaced", lower=False))
    assert (n, form) == (100_000, "spm") and len(source.frames) > 5 and len(opened) <= 3
    assert len(set(frames) & set(source.frames)) >= len(source.frames) - 3
    assert np.all(np.diff(sizes) > 0) and sizes[-1] == len(text) + 9


def test_table(spark, documents, odd_texts):
    got = infill.digests(infill.infill(infill.frame_store(documents)))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    expected = []
    for r in documents.select("doc_id", "text").collect():
        *row, output = brute(r.doc_id, r.text)
        expected.append((r.doc_id, *row, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


def test_no_documents(spark, no_documents):
    store = infill.frame_store(no_documents)
    assert infill.digests(infill.infill(store)).collect() == [] and infill.texts(infill.infill(store)).collect() == []
