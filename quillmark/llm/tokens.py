"""Token ids of whole texts by the public tokenizers, kept per distinct unit.

The vocabularies used here split a text into units before any merge, and no merge joins two units. For the two splitting
rules in use (byte-level, and lower-cased words) the units of plain text are found over a whole block of bytes at once:
runs of letters, of digits and of ASCII marks, between single spaces and line feeds. The tokenizers library's model gives
the ids of each distinct unit once a worker; a text's ids are its units' ids in a row.

What the units cannot be told apart in by bytes goes through the library as it is: a piece between two spaces that holds
an apostrophe, a control character or a character beyond Latin-1 letters is one unit; a text with other white space than
single spaces and line feeds, with white space at an end, or with the string of an added token is encoded whole, and so
are all texts under any other splitting rule. The ids are those of a plain call of the library without special tokens
added; ``special_as_text`` takes the strings of added tokens in a text as ordinary text instead.

Units are known by 64-bit hashes; of four million units two share one with a probability of 5e-7.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .textnum import U64, run_hashes

#: Units and ids that a worker keeps; beyond either it starts anew. About 100 MB.
MOST_UNITS, MOST_IDS = 1 << 21, 1 << 24
#: Bytes whose units are found at once; a longer text is cut at single spaces.
SEGMENT = 1 << 18
_LETTER, _DIGIT, _MARK, _BLANK, _LINE, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = _DIGIT, _LETTER, _LETTER
_CLASS[39], _CLASS[32], _CLASS[10] = _OTHER, _BLANK, _LINE
#: Second bytes of Latin-1 letters after 0xC3, and which of them are capitals.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x80:0x9F] = True
_CAPITAL[0x97] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: White space and separators, other than single spaces and line feeds, that make a text go through the library whole.
_ODD_BYTES = np.zeros(256, bool)
_ODD_BYTES[[9, 11, 12, 13, *range(0x1C, 0x20)]] = True
_ODD_LEADS = np.zeros(256, bool)
_ODD_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
#: The byte-level alphabet: a printable Latin-1 byte stands for itself, the others for the characters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_encoders: dict[tuple[str, bool], "Encoder"] = {}


class Units:
    """Ids by the hash of a unit: an open-addressed table over one array of ids."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.bits = 14
        self.keys, self.place = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, np.int32)
        self.hashes, self.start = np.zeros(1 << 13, U64), np.zeros((1 << 13) + 1, np.int64)
        self.ids, self.n = np.zeros(1 << 15, np.uint32), 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each unit, -1 where it is not known."""
        mask = (1 << self.bits) - 1
        slot = (h >> U64(64 - self.bits)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.place[slot], -1)
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            slot[left] = at = (slot[left] + 1) & mask
            key = self.keys[at]
            hit = key == h[left]
            out[left[hit]] = self.place[at[hit]]
            left = left[~hit & (key != 0)]
        return out

    def _insert(self, h: np.ndarray, number: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        slot = (h >> U64(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[free]
            own = free & (self.keys[slot] == h)  # of several that took one slot the last holds it
            self.place[slot[own]] = number[own]
            h, number, slot = h[~own], number[~own], (slot[~own] + 1) & mask

    def add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        """Distinct unknown units and their ids."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum()))
        end, used = self.n + len(h), int(self.start[self.n])
        if end > len(self.hashes):
            size = max(end, 2 * len(self.hashes))
            self.hashes, self.start = np.resize(self.hashes, size), np.resize(self.start, size + 1)
        if used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, max(used + len(flat), 2 * len(self.ids)))
        self.ids[used : used + len(flat)] = flat
        self.hashes[self.n : end] = h
        self.start[self.n + 1 : end + 1] = used + np.cumsum(counts)
        number = np.arange(self.n, end, dtype=np.int32)
        self.n = end
        if 2 * end > 1 << self.bits:
            while 2 * end > 1 << self.bits:
                self.bits += 1
            self.keys, self.place = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, np.int32)
            h, number = self.hashes[:end], np.arange(end, dtype=np.int32)
        self._insert(h, number)


class Encoder:
    def __init__(self, path: str, special_as_text: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.tokenize = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.added = [] if special_as_text else [t["content"].encode() for t in made["added_tokens"]]
        self.words = _rule(made)
        self.units = Units()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _slow(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that go through the library whole."""
        n = len(offsets) - 1
        if self.words is None:
            return np.ones(n, bool)
        slow = np.zeros(n, bool)
        if not len(body):
            return slow
        row = lambda at: np.searchsorted(offsets, at, "right") - 1
        blank = (body == 32) | (body == 10)
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        slow[full] = blank[offsets[full]] | blank[offsets[full + 1] - 1]
        two = np.flatnonzero(blank[1:] & blank[:-1])
        slow[row(two)] |= row(two) == row(two + 1)
        slow[row(np.flatnonzero(_ODD_BYTES[body]))] = True
        leads = np.unique(row(np.flatnonzero(_ODD_LEADS[body])))
        for r in leads[~slow[leads]].tolist():
            slow[r] = _ODD_SPACE.search(body[offsets[r] : offsets[r + 1]].tobytes().decode()) is not None
        if self.added:
            data = body.tobytes()
            for token in self.added:
                at = data.find(token)
                while at >= 0:
                    if row(at) == row(at + len(token) - 1):
                        slow[row(at)] = True
                    at = data.find(token, at + 1)
        return slow

    def encode(self, body: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts, each followed by ``end``, and the texts' bounds among the ids."""
        n = len(offsets) - 1
        counts, parts = np.zeros(n, np.int64), []
        slow = self._slow(body, offsets)
        stops = np.append(np.flatnonzero(slow), n)
        first = 0
        while first < n:
            if slow[first]:
                ids = self.whole([body[offsets[first] : offsets[first + 1]].tobytes().decode()])[0]
                parts.append(np.array(ids, np.uint32))
                counts[first] = len(ids)
                first += 1
                continue
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, "right")) - 1)
            last = min(last, int(stops[np.searchsorted(stops, first)]))
            a, b = int(offsets[first]), int(offsets[last])
            while b - a > 2 * SEGMENT:  # a single long text: its parts begin at single spaces
                spaces = np.flatnonzero(body[a + SEGMENT : b] == 32)
                if not len(spaces):
                    break
                cut = a + SEGMENT + int(spaces[0])
                ids, many = self._run(body[a:cut], np.array([0, cut - a]))
                parts.append(ids)
                counts[first] += many[0]
                a = cut
            ids, many = self._run(body[a:b], np.maximum(offsets[first : last + 1] - a, 0))
            parts.append(ids)
            counts[first:last] += many
            first = last
        bounds = np.concatenate([[0], np.cumsum(counts + 1)])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return np.insert(ids, np.cumsum(counts), end).astype(np.uint32), bounds

    def _run(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, and how many each has."""
        n = len(offsets) - 1
        if not len(body):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        if self.units.n > MOST_UNITS or self.units.start[self.units.n] > MOST_IDS:
            self.units.clear()
        kind = _CLASS[body]
        lead = np.flatnonzero(body == 0xC3)
        latin = lead[_LATIN[body[lead + 1]]]
        kind[latin] = kind[latin + 1] = _LETTER
        blank = kind == _BLANK
        begins = np.zeros(len(body), bool)  # of a piece: the start of a text, or after a space
        begins[offsets[:-1][offsets[:-1] < len(body)]] = True
        begins[1:] |= blank[:-1]
        begins &= ~blank
        starts = begins.copy()
        starts[1:] |= kind[1:] != kind[:-1]
        starts &= ~blank
        if self.words:
            starts |= kind == _DIGIT
            starts &= kind != _LINE
            body = np.where(kind == _LETTER, _LOWER[body], body)
            capital = latin[_CAPITAL[body[latin + 1]]] + 1
            body[capital] += 32
        odd = np.flatnonzero(kind == _OTHER)
        gap = blank | (kind == _LINE) if self.words else blank
        if len(odd):
            heads = np.flatnonzero(begins)
            stop = np.append(heads[1:], len(body))
            stop -= blank[stop - 1]
            which = np.unique(np.searchsorted(heads, odd, "right") - 1)
            inside = np.zeros(len(body) + 1, np.int8)
            inside[heads[which]] += 1
            inside[stop[which]] -= 1
            inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
            starts &= ~inside
            starts[heads[which]] = True
            gap &= ~inside
        s = np.flatnonzero(starts)
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        e = np.append(s[1:], len(body))
        e -= gap[e - 1]
        own = s if self.words else s - ((s > 0) & blank[s - 1])
        h = run_hashes(body, own, e) | U64(1)  # zero marks a free place
        number = self.units.find(h)
        lost = np.flatnonzero(number < 0)
        if len(lost):
            new, at = np.unique(h[lost], return_index=True)
            at = lost[at]
            odd_unit = np.zeros(len(at), bool)
            if len(odd):
                odd_unit = inside[s[at]]
            data = body.tobytes()
            self.units.add(new, [self._learn(data[a:b], o) for a, b, o in zip(own[at].tolist(), e[at].tolist(), odd_unit.tolist(), strict=True)])
            number[lost] = self.units.find(h[lost])
        begin, count = self.units.start[number], self.units.start[number + 1]
        count -= begin
        ends = np.cumsum(count)
        ids = self.units.ids[np.repeat(begin - ends + count, count) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[np.searchsorted(s, offsets)]
        return ids, np.diff(bounds)

    def _learn(self, unit: bytes, odd: bool) -> list[int]:
        if odd:
            return self.whole([unit.decode()])[0]
        text = unit.decode("latin-1")
        if not unit.isalnum():
            text = text.translate(_ALPHABET)
        return [t.id for t in self.tokenize(text)]


def _rule(made: dict) -> bool | None:
    """Whether the splitting rule is that of lower-cased words (True) or of bytes (False); None for any other."""
    before = made["pre_tokenizer"] or {}
    if any(made["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")) or made["model"]["type"] != "BPE":
        return None
    if made["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
        return False
    steps = before.get("pretokenizers", [])
    normal = [s["type"] for s in (made["normalizer"] or {}).get("normalizers", [])]
    if normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"].get("Regex") == _WORDS:
        return True if steps[0]["invert"] and not (steps[1]["use_regex"] or steps[1]["add_prefix_space"]) else None
    return None


#: Fixed value: the splitting rule of the word vocabulary.
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One per worker process, so that its units outlive a task."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(path, special_as_text)
    return _encoders[key]
