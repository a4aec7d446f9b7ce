"""Words and their hashes, on whole texts as bytes.  These run inside tasks, one text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C55  # odd, so that its powers can be inverted modulo 2**64
BLOCK = 1 << 18
SLICE = 1 << 21  # bytes of a batch that a task works on at a time


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column as bytes, NULL as None."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of about ``most`` bytes, of one row at least: what is made of a part is gone before the next."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def by_spaces() -> np.ndarray:
    """Which bytes are in a word: all but space and \\t to \\r."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def by_letters() -> np.ndarray:
    """Which bytes are in a word: digits, a to z and everything beyond ASCII (texts come lower-cased)."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeds(n: int, seed: int = 0) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of the words of a text, computed over blocks that end between words."""

    def __init__(self, in_word: np.ndarray):
        self.in_word = in_word
        self._grow(BLOCK + 1)

    def _grow(self, n: int) -> None:
        self.up, self.down = powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)

    def _blocks(self, data: bytes) -> Iterator[np.ndarray]:
        a, at = np.frombuffer(data, np.uint8), 0
        while at < len(a):
            end = min(at + BLOCK, len(a))
            while end < len(a) and self.in_word[a[end - 1]] and self.in_word[a[end]]:
                gaps = np.flatnonzero(~self.in_word[a[end : end + BLOCK]])  # a word crosses the border: go on to its end
                end += int(gaps[0]) if len(gaps) else min(BLOCK, len(a) - end)
            yield a[at:end]
            at = end

    def __call__(self, data: bytes) -> np.ndarray:
        parts = [self._block(a) for a in self._blocks(data)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def _block(self, a: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(a) + 2, np.int8)
        inside[1:-1] = self.in_word[a]
        step = np.diff(inside)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(a) >= len(self.up):
            self._grow(len(a) + 1)
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self.up[: len(a)], out=total[1:])
        return mixed((total[last] - total[first]) * self.down[first] + (last - first).astype(np.uint64))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words; a shorter text, but not an empty one, is one run."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i, c in enumerate(seeds(n)):
        total += words[i : i + len(total)] * c
    return mixed(total)
