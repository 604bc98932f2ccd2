import re

import numpy as np
import pyarrow as pa

from tidemark.llm.words import Scanner, chunks, hash_of, ngrams

PATTERNS = {"spaced": rb"[^\x20\x09-\x0D]+", "alnum": rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def test_words_are_those_of_the_pattern(odd_texts):
    column = pa.array(odd_texts, pa.string())
    for kind, pattern in PATTERNS.items():
        scan = Scanner(kind, lower=True)
        seen = 0
        for row, end, data, bounds in chunks(column, 50):
            found = scan(data, bounds)
            raw = data.tobytes().lower()
            for d in range(end - row):
                text = (odd_texts[row + d] or "").encode().lower()
                expected = re.findall(pattern, text)
                own = slice(found.first[d], found.first[d + 1])
                assert [raw[a:b] for a, b in zip(found.starts[own], found.ends[own])] == expected
                assert (found.hashes[own] == hash_of(expected, scan)).all()
                seen += 1
        assert seen == len(odd_texts)


def test_hashes_tell_words_apart():
    scan = Scanner("spaced", lower=True)
    many = [f"w{k}".encode() for k in range(50000)]
    assert len(np.unique(hash_of(many, scan))) == len(many)
    assert (hash_of([b"ABC"], scan) == hash_of([b"abc"], scan)).all()
    assert len(ngrams(hash_of(many[:3], scan), 5)) == 0


def test_slices_and_large_strings():
    column = pa.array(["aa", None, "bb cc", ""], pa.large_string()).slice(1)
    assert [(row, end, data.tobytes(), list(bounds)) for row, end, data, bounds in chunks(column)] == [(0, 3, b"bb cc", [0, 0, 5, 5])]
