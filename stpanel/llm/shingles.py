"""Sets of hashed word shingles, computed in numpy for many texts at once.

Words are lower-cased (A-Z) runs without ASCII white space. A word's hash is a
polynomial in random numbers that stand for its bytes; a shingle's hash mixes the
hashes of its words in order. All hashes have 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache

import numpy as np

PIECE = 1 << 20  # bytes hashed together; longer texts are cut between words
_SPACE = re.compile(rb"[\x09-\x0d\x20]")
_BASE = 0x9E3779B97F4A7C15
_MIX = [np.uint64(k) for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


@cache
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte value, and which bytes are white space."""
    numbers = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return numbers, blank


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""
    if len(_tables.get("up", ())) < n:
        n = max(n, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _tables[name] = np.multiply.accumulate(row)
    return _tables["up"], _tables["down"]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a buffer, and where they start."""
    data = np.frombuffer(raw, np.uint8)
    numbers, blank = _bytes()
    space = blank[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    start, end = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * up[: len(data)], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= _MIX[0]
    h ^= h >> np.uint64(29)
    return h, start


def words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the number of words of each text."""
    counts = np.zeros(len(texts), np.int64)
    hashes: list[np.ndarray] = []
    buffer: list[bytes] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        if buffer:
            h, start = _word_hashes(b" ".join(buffer))
            begins = np.cumsum([0, *(len(b) + 1 for b in buffer)])[:-1]
            which = np.searchsorted(begins, start, side="right") - 1
            np.add.at(counts, np.asarray(owners)[which], 1)
            hashes.append(h)
            buffer.clear()
            owners.clear()

    for i, text in enumerate(texts):
        raw, at = (text or "").encode("utf-8", "replace").lower(), 0
        while at < len(raw):
            found = _SPACE.search(raw, at + PIECE) if len(raw) - at > PIECE else None
            end = found.start() if found else len(raw)
            if size + end - at > PIECE:
                flush()
                size = 0
            buffer.append(raw[at:end])
            owners.append(i)
            size += end - at + 1
            at = end
    flush()
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def _mixed(parts: Sequence[np.ndarray], count: int) -> np.ndarray:
    h = np.full(count, len(parts), np.uint64)
    for part in parts:
        h = (h ^ part) * _MIX[1]
        h ^= h >> np.uint64(31)
    h *= _MIX[2]
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: Sequence[str | None], k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer than ``k`` words has one shingle, all its words; a text
    without words has none.
    """
    flat, counts = words(texts)
    ends = np.cumsum(counts)
    m = max(0, len(flat) - k + 1)
    full = _mixed([flat[i : i + m] for i in range(k)], m)
    out = []
    for end, n in zip(ends, counts, strict=True):
        start = end - n
        if n >= k:
            h = np.sort(full[start : end - k + 1])
            out.append(h[np.r_[True, h[1:] != h[:-1]]])
        elif n:
            out.append(_mixed([flat[i : i + 1] for i in range(start, end)], 1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
