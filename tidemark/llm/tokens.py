"""Token ids of whole texts with the tokenizers library, with a cache of pieces.

A tokenizer that lower-cases, drops white space and marks word ends (byte-pair merges with an end
of word suffix) never merges across its pieces (letters, single digits, other characters), and each
piece ends in a token with that suffix.  So numpy cuts a run of texts into pieces and tells them
apart by 64-bit hashes; pieces that the task has seen before are looked up in sorted arrays, and all
new ones go through the library as one text, whose ids are cut at the suffix.  Words with an apostrophe or with characters outside
ASCII and the accented Latin-1 letters, texts that spell out one of the vocabulary's added tokens and
texts of other tokenizers go through it as they are.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.scratch import give_back
from tidemark.llm.words import Scanner, chunks, mix, word_bytes

#: Fixed value: the pattern by which the tokenizer file cuts pieces.
_FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MOST_PIECES = 2_000_000  # cached, at some 30 bytes each; then the cache starts anew
_RUN, _PART = 8 << 20, 1 << 19  # bytes of text whose pieces are looked up, and cut, together

# Of the bytes beyond ASCII only those of U+00C0-U+00FF but the two signs among them are plain;
# in plain words 0x80-0x9E then end an upper-case letter, whose lower-case form is 0x20 further on.
_ODD = np.zeros(256, bool)
_ODD[[0x27, *range(0x1C, 0x20), 0x97, 0xB7, 0xC2, *range(0xC4, 0x100)]] = True
_SPACE, _LETTER, _DIGIT, _SIGN, _STRANGE = range(5)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[~word_bytes("spaced")] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[0x80:0x9F] += 0x20


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        self.added = [x["content"].encode() for x in held.get("added_tokens") or []]
        literal = not any(x["normalized"] for x in held.get("added_tokens") or [])
        suffix = held["model"].get("end_of_word_suffix")
        pattern = re.search(r'"Regex": "(\'s.*?)"\}', json.dumps(held["pre_tokenizer"]))
        self.fast = literal and bool(suffix) and held["model"].get("dropout") is None and pattern is not None and json.loads(f'"{pattern[1]}"') == _FILE_PATTERN and [x["type"] for x in held["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.scan = Scanner("spaced", lower=False)
        self._clear()
        if self.fast:
            self.parts = Tokenizer(self.whole.model)  # the same model in memory, without added tokens
            self.parts.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = held["model"]["vocab"]
            self.ends = np.zeros(1 + max(vocabulary.values()), bool)
            self.ends[[k for word, k in vocabulary.items() if word.endswith(suffix)]] = True
        del held
        give_back()

    def whole_text(self, text: str) -> list[int]:
        """Ids by the library alone."""
        return self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def forget(self) -> None:
        """Empty the cache and give its memory back; a task does so at its end, as its worker goes on to other work."""
        self._clear()
        give_back()

    def _clear(self) -> None:
        """An empty cache: sorted hashes of pieces, and where in ``ids`` the ids of each start and how many they are."""
        self.keys, self.starts, self.counts, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _learn(self, place: np.ndarray, keys: np.ndarray, pieces: list[bytes], odd: np.ndarray) -> None:
        """Add pieces to the cache, all plain ones encoded as one text."""
        counts, parts = np.zeros(len(pieces), np.int32), []
        plain = np.flatnonzero(~odd)
        if len(plain):
            ids = np.array(self.parts.encode_batch_fast([b" ".join([pieces[k] for k in plain.tolist()]).decode()], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(plain):
                raise ValueError("a piece without exactly one end of word")
            counts[plain] = np.diff(stops, prepend=0)
            parts.append(ids)
        strange = np.flatnonzero(odd)
        for k in strange.tolist():
            ids = self.whole_text(pieces[k].decode())
            counts[k] = len(ids)
            parts.append(np.array(ids, np.uint32))
        order = np.concatenate([plain, strange])  # in which their ids were added
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = len(self.ids) + np.cumsum(counts[order], dtype=np.int64) - counts[order]
        self.ids = np.concatenate([self.ids, *parts])
        self.keys, self.starts, self.counts = np.insert(self.keys, place, keys), np.insert(self.starts, place, starts), np.insert(self.counts, place, counts)

    def __call__(self, column: pa.Array, run: int = _RUN) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, bounds) of runs of texts of about ``run`` bytes; a null text has no ids.

        A text that spells out a token added to the vocabulary (such as its end of text) goes
        through the library whole, which cuts the text there.
        """
        for row, end, data, bounds in chunks(column, run):
            raw = data.tobytes()
            whole = self._spelt(raw, bounds) if self.fast else np.ones(end - row, bool)
            lengths = np.diff(bounds)
            if not whole.any():
                yield row, end, *self._by_pieces(data, bounds)
                continue
            own = {k: self.whole_text(raw[bounds[k]:bounds[k + 1]].decode()) for k in np.flatnonzero(whole).tolist()}
            if not whole.all():
                ids, ends = self._by_pieces(data[np.repeat(~whole, lengths)], np.concatenate([[0], np.cumsum(np.where(whole, 0, lengths))]))
            else:
                ids, ends = np.zeros(0, np.uint32), np.zeros(end - row + 1, np.int64)
            counts, parts, at = np.diff(ends), [], 0
            for k, found in own.items():
                counts[k] = len(found)
                parts += [ids[ends[at]:ends[k]], np.array(found, np.uint32)]
                at = k
            yield row, end, np.concatenate([*parts, ids[ends[at]:]]), np.concatenate([[0], np.cumsum(counts)])

    def _spelt(self, raw: bytes, bounds: np.ndarray) -> np.ndarray:
        """Which texts of a run hold an added token."""
        hit = np.zeros(len(bounds) - 1, bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                k = int(np.searchsorted(bounds, at, "right")) - 1
                hit[k] |= at + len(token) <= bounds[k + 1]
                at = raw.find(token, at + 1)
        return hit

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hash, oddness, start and length of each piece in the folded bytes, those bytes, and each text's first piece."""
        kind = _KIND[data]
        begins = kind == _DIGIT
        begins[1:] |= kind[1:] != kind[:-1]
        begins[1:] |= begins[:-1] & (kind[:-1] == _DIGIT)
        begins[bounds[:-1][bounds[:-1] < len(data)]] = True
        if len(data):
            begins[0] = True
        flagged = np.flatnonzero(_ODD[data])
        if len(flagged):
            starts, ends = self.scan.bounds(data, bounds)
            odd = np.unique(np.searchsorted(starts, flagged, "right") - 1)
            for start, end in zip(starts[odd].tolist(), ends[odd].tolist()):
                begins[start:end] = False
                begins[start] = True
                kind[start:end] = _STRANGE
        begins &= kind != _SPACE
        starts = np.flatnonzero(begins)
        solid = np.flatnonzero(kind != _SPACE)
        letters = data[solid]
        strange = kind[starts] == _STRANGE
        at = np.searchsorted(solid, starts)
        lengths = np.diff(at, append=len(solid))
        odd = kind[solid] == _STRANGE
        folded = np.where(odd, letters, _LOWER[letters]) if strange.any() else _LOWER[letters]
        hashes = self.scan.hash_runs(folded, lengths)
        hashes[strange] = mix(hashes[strange])
        return hashes, strange, at, lengths, folded, np.searchsorted(starts, bounds)

    def _by_pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, row, n, pieces, size = [], 0, len(bounds) - 1, 0, 0
        firsts = [np.zeros(1, np.int64)]
        while row < n:  # in parts that fit a core's cache
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _PART, "right")) - 1)
            hashes, strange, at, lengths, folded, first = self._pieces(data[bounds[row]:bounds[end]], bounds[row:end + 1] - bounds[row])
            parts.append((hashes, strange, at + size, lengths, folded))
            firsts.append(first[1:] + pieces)
            row, pieces, size = end, pieces + len(hashes), size + len(folded)
        first = np.concatenate(firsts)
        if not pieces:
            return np.zeros(0, np.uint32), first
        hashes, strange, at, lengths, folded = (np.concatenate(x) for x in zip(*parts))
        distinct, lead, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > _MOST_PIECES:
            self._clear()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        if not known.all():
            new = lead[~known]
            raw = folded.tobytes()
            pieces = [raw[a:b] for a, b in zip(at[new].tolist(), (at + lengths)[new].tolist())]
            self._learn(place[~known], distinct[~known], pieces, strange[new])
            place = np.searchsorted(self.keys, distinct)
        many = self.counts[place][which]
        ends = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        ids = self.ids[np.repeat(self.starts[place][which] - ends[:-1], many) + np.arange(ends[-1])]
        return ids, ends[first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
