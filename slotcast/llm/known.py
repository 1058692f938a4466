"""A bounded table of values that were computed before, and ids of texts put together from it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class Known(dict):
    """Values of texts met before, within about ``limit`` bytes.

    Beyond half of the limit the entries become the older generation, and the older generation
    before it is dropped; what is still in use moves over. A long text is not kept at all.
    """

    ENTRY = 200  # bytes of an entry besides its text and value

    def __init__(self, value_of: Callable[[str], bytes], limit: int, longest: int = 1_000):
        self.value_of, self.limit, self.longest = value_of, limit, longest
        self.old: dict[str, bytes] = {}
        self.size = 0

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.value_of(key)
            if len(key) > self.longest:
                return value
        self.size += self.ENTRY + 2 * len(key) + len(value)
        if self.size > self.limit // 2:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[key] = value
        return value


def joined_ids(
    split: pa.ListArray,
    ids_of: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    end: bytes,
    first: list[bytes] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that Arrow has split into words, each text followed by ``end``, and the number of each.

    Arrow numbers the distinct words; ``ids_of`` gives their ids, and start and number of each word's. ``first`` are the ids of the texts'
    first words, where these differ from the same words further on.
    """
    bounds = split.offsets.to_numpy().astype(np.int64)
    numbered = split.values.dictionary_encode()
    flat, starts, sizes = ids_of(numbered.dictionary)
    codes = numbered.indices.to_numpy().astype(np.int64)
    more = [*(first or []), end]
    if first is not None:
        codes[bounds[:-1]] = len(sizes) + np.arange(len(first))
    codes = np.insert(codes, bounds[1:], len(sizes) + len(more) - 1)
    extra = np.fromiter(map(len, more), np.int64, len(more)) // 4
    starts = np.r_[starts, len(flat) + np.cumsum(extra) - extra]
    sizes = np.r_[sizes, extra]
    flat = np.concatenate([flat, np.frombuffer(b"".join(more), np.uint32)])
    n = sizes[codes]
    before = np.cumsum(n) - n
    ids = flat[np.repeat(starts[codes] - before, n) + np.arange(n.sum())]
    return ids, np.add.reduceat(n, bounds[:-1] + np.arange(len(split)))


def text_runs(texts: list[str], most: int = 2_000_000) -> list[tuple[int, int]]:
    """Runs of texts of up to ``most`` characters; a longer text is a run by itself."""
    runs, first, held = [], 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > most:
            runs.append((first, i))
            first, held = i, 0
        held += len(text)
    return [*runs, (first, len(texts))] if texts else []
