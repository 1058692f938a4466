"""Byte-pair merges of many words at once, in numpy.

Words of about the same length form a matrix. In each round every word merges its pair of least
rank, the leftmost of equal ones, which is the order that defines byte-pair encoding; so a round
takes one symbol from every word that goes on, and is a handful of array operations for thousands of words.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa

_NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary uses for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Pairs:
    """From a pair of symbols to its rank: hash tables of one probe, colliding pairs in the next one.

    A pair that is none has the number of pairs for its rank.
    """

    SLOTS = 1 << 19

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, -1)
        self.tables, left, seed = [], np.arange(len(keys), dtype=np.int32), 0x9E3779B97F4A7C15
        while len(left):
            at = self._slot(keys[left], seed)
            table = np.full(self.SLOTS, len(keys), np.int32)
            table[at] = left
            self.tables.append((seed, table))
            left = left[table[at] != left]
            seed = (seed * 0xD6E8FEB86659FD93 | 1) % 2**64

    def _slot(self, keys: np.ndarray, seed: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(seed)) >> np.uint64(64 - 19)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        seed, table = self.tables[0]
        found = table[self._slot(keys, seed)]
        at = np.flatnonzero(self.keys[found] != keys)
        found[at] = len(self.keys) - 1
        for seed, table in self.tables[1:]:
            if not len(at):
                break
            more = table[self._slot(keys[at], seed)]
            hit = self.keys[more] == keys[at]
            found[at[hit]] = more[hit]
            at = at[~hit]
        return found


class Merges:
    """Ids of words by the merges of a byte-level vocabulary, given as the text of its file.

    Only vocabularies without dropout, prefixes and whole-word shortcuts are taken; an end-of-word suffix is.
    ``block`` bounds the symbols that are worked on together; words longer than ``LONGEST`` go to the
    tokenizer's own ``model``.
    """

    BITS = 10
    LONGEST = 1 << BITS

    def __init__(self, file: str, model, block: int = 1 << 17):
        told = json.loads(file)["model"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback") if told.get(k)]
        if told.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"not a plain byte-pair vocabulary: {odd or told.get('type')}")
        vocab, letters, end = told["vocab"], byte_letters(), told.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in told["merges"]]
        self.model, self.letters, self.block, self.size = model, letters, block, max(vocab.values()) + 1
        # the symbol ``size`` is padding
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[letters[b] + end] for b in range(256)], np.int32)
        ranks = {vocab[a] * (self.size + 1) + vocab[b]: vocab[a + b] for a, b in pairs}
        self.rank = _Pairs(np.fromiter(ranks, np.int64, len(ranks)))
        self.made = np.fromiter(ranks.values(), np.int32, len(ranks))
        if len(ranks) >> (30 - self.BITS) or len(ranks) < len(pairs):
            raise ValueError("too many merges, or one of them twice")

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that lie in ``data`` between ``offsets``, one after the other, and their numbers."""
        sizes = np.diff(offsets)
        parts = [self._alone(data, offsets, i) for i in np.flatnonzero(sizes > self.LONGEST).tolist()]
        places, low = np.argsort(sizes, kind="stable"), 0
        ordered = sizes[places]
        end = int(np.searchsorted(ordered, self.LONGEST, "right"))
        low = int(np.searchsorted(ordered, 0, "right"))
        while low < end:
            longest = int(ordered[low] + ordered[low] // 2)
            high = min(end, int(np.searchsorted(ordered, longest, "right")))
            most = max(1, self.block // (longest + 1))
            for i in range(low, high, most):
                parts += self._merge(data, offsets, places[i : min(high, i + most)])
            low = high
        n = np.zeros(len(sizes), np.int64)
        for of, lengths, _ in parts:
            n[of] = lengths
        starts, ids = np.cumsum(n) - n, np.empty(n.sum(), np.uint32)
        for of, lengths, values in parts:
            ids[_spans(starts[of], lengths)] = values
        return ids, n

    def _alone(self, data: np.ndarray, offsets: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spelled = data[offsets[i] : offsets[i + 1]].tobytes().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(spelled)], np.uint32)
        return np.array([i]), np.array([len(ids)]), ids

    def _merge(self, data: np.ndarray, offsets: np.ndarray, of: np.ndarray) -> list:
        # one column for each word, with padding below it; its pairs are ordered by rank, then by place
        sizes, found = offsets[of + 1] - offsets[of], []
        length, column = int(sizes.max()), np.arange(len(of))
        letters = data[np.minimum(offsets[of] + np.arange(length)[:, None], len(data) - 1)]
        symbols = self.inner[letters]
        symbols[sizes - 1, column] = self.final[letters[sizes - 1, column]]
        symbols[np.arange(length)[:, None] >= sizes] = self.size  # in no pair
        order = np.empty((length - 1, len(of)), np.int32)
        for k in range(length - 1):
            order[k] = self._order(symbols[k], symbols[k + 1], k)
        while True:
            width = len(symbols)
            least = order.min(0) if width > 1 else np.full(len(of), _NONE)
            done = least >= _NONE - self.LONGEST
            if done.any():
                left = sizes[done] - length + width
                found.append((of[done], left, symbols[:, done].T[np.arange(width) < left[:, None]]))
                go = np.flatnonzero(~done)
                if not len(go):
                    return found
                symbols, order, of, sizes, least = symbols[:, go], order[:, go], of[go], sizes[go], least[go]
            at = least & (self.LONGEST - 1)
            column = np.arange(len(of))
            stay = np.arange(width - 1)[:, None] < at
            symbols[at, column] = self.made[least >> self.BITS]
            stay_s = stay.copy()
            stay_s[at, column] = True
            symbols = np.where(stay_s, symbols[:-1], symbols[1:])
            if width == 2:
                order = order[:0]
                continue
            order = np.where(stay[:-1], order[:-1], order[1:] - 1)
            r = np.flatnonzero(at > 0)  # the pair that the new symbol ends
            c = at[r]
            order[c - 1, r] = self._order(symbols[c - 1, r], symbols[c, r], c - 1)
            r = np.flatnonzero(at < width - 2)  # and the one that it begins
            c = at[r]
            order[c, r] = self._order(symbols[c, r], symbols[c + 1, r], c)

    def _order(self, left: np.ndarray, right: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        rank = self.rank(left.astype(np.int64) * (self.size + 1) + right)
        return np.where(rank < len(self.made), (rank << self.BITS) + place, _NONE)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as each length says."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


_LETTER, _DIGIT, _SIGN = 1, 2, 3


def _kinds() -> np.ndarray:
    """Kinds of bytes; 0 for those that need more thought: white space, quotes of contractions, special strings."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = _SIGN
    for first, last, kind in ("AZ1", "az1", "092"):
        kinds[ord(first) : ord(last) + 1] = int(kind)
    kinds[[ord("'"), ord("<")]] = 0
    return kinds


class Words:
    """Ids of distinct words between blanks, all at once, with ``other`` for those of unusual characters.

    Plain words, of ASCII and the letters from À to ÿ, are cut where letters, digits and signs meet.
    With ``blank`` a word's first piece begins with the blank before it; with ``lower`` words are
    lower-cased, and with ``digits`` every digit is a piece of its own. Nothing is kept between calls.
    """

    def __init__(self, merges: Merges, other: Callable[[str], bytes], blank: bool, lower: bool, digits: bool):
        self.merges, self.other, self.blank, self.lower, self.digits = merges, other, blank, lower, digits
        self.kinds = _kinds()

    def __call__(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start of each word in them, number of ids of each word)"""
        offsets, data = _buffers(words)
        kinds, sizes = self.kinds[data], np.diff(offsets)
        accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kinds[accented] = kinds[accented + 1] = _LETTER
        odd_before = np.r_[0, np.cumsum(kinds == 0)]
        odd = (odd_before[offsets[1:]] > odd_before[offsets[:-1]]) | (sizes == 0)
        keep = np.repeat(~odd, sizes)
        ids, n = self._plain(data[keep], kinds[keep], sizes[~odd])
        rest = [self.other(w) for w in words.filter(pa.array(odd)).to_pylist()]
        count = np.empty(len(sizes), np.int64)
        count[~odd] = n
        count[odd] = [len(x) // 4 for x in rest]
        starts = np.empty(len(sizes), np.int64)
        starts[~odd] = np.cumsum(n) - n
        starts[odd] = len(ids) + np.cumsum(count[odd]) - count[odd]
        return np.concatenate([ids, np.frombuffer(b"".join(rest), np.uint32)]), starts, count

    def _plain(self, data: np.ndarray, kinds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sizes):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        first = np.cumsum(sizes) - sizes
        if self.lower:
            upper = (data >= ord("A")) & (data <= ord("Z"))
            upper[1:] |= (data[:-1] == 0xC3) & (data[1:] <= 0x9E)
            data = data + np.where(upper, np.uint8(32), np.uint8(0))
        new = np.append(True, kinds[1:] != kinds[:-1])
        if self.digits:
            new |= kinds == _DIGIT
        new[first] = not self.blank
        if self.blank:
            data, new = np.insert(data, first, 32), np.insert(new, first, True)
            first = first + np.arange(len(first))
        starts = np.flatnonzero(new)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        at, text = _buffers(pieces.dictionary)
        ids, n = self.merges(text, at)
        codes = pieces.indices.to_numpy()
        each = n[codes]
        return ids[_spans((np.cumsum(n) - n)[codes], each)], np.add.reduceat(each, np.searchsorted(starts, first))


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow array of texts without nulls."""
    _, bounds, data = words.buffers()
    offsets = np.frombuffer(bounds, np.int32, len(words) + 1, 4 * words.offset).astype(np.int64) if len(words) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]
