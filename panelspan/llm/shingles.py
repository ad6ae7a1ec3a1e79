"""Shingle sets of whole texts, computed in Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# The space characters, and odd multipliers that mix word hashes.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
STEP = np.uint64(0x9E3779B97F4A7C15)
FIRST, SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

PIECE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * FIRST
    x = (x ^ (x >> np.uint64(27))) * SECOND
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256, dtype=np.uint64)
    upper = (codes >= 65) & (codes <= 90)
    values = mixed((np.where(upper, codes + np.uint64(32), codes) + np.uint64(1)) * STEP)
    space = np.zeros(256, dtype=bool)
    space[list(SPACES)] = True
    return values, space


VALUES, SPACE = _tables()


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, STEP, dtype=np.uint64)) if n else np.zeros(0, np.uint64)


POWERS = _powers(256)


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word; A-Z count as a-z, words end at spaces alone."""
    found, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in SPACES:
            end += 1
        found.append(piece_hashes(np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def piece_hashes(data: np.ndarray) -> np.ndarray:
    inside = np.flatnonzero(~SPACE[data])
    if not len(inside):
        return np.zeros(0, np.uint64)
    opens = np.ones(len(inside), dtype=bool)
    opens[1:] = np.diff(inside) > 1
    starts = np.flatnonzero(opens)
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    longest = int(lengths.max())
    powers = POWERS if longest <= len(POWERS) else _powers(longest)
    sums = np.add.reduceat(VALUES[data[inside]] * powers[place], starts)
    return mixed(sums + lengths.astype(np.uint64) * SECOND)


def many_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of many texts; short ones are done together."""
    joined, ends = b" ".join(texts), np.cumsum([len(t) + 1 for t in texts])
    if len(joined) > 2 * PIECE:
        return [word_hashes(t) for t in texts]
    data = np.frombuffer(joined, np.uint8)
    opens = ~SPACE[data]
    opens[1:] &= SPACE[data[:-1]]
    counts = np.searchsorted(np.flatnonzero(opens), ends)
    return np.split(piece_hashes(data), counts[:-1]) if texts else []


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of consecutive words, sorted; all words are one if too few."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = total * STEP + words[i : n - width + 1 + i]
    return np.unique(mixed(total))


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """The set of each text in turn; a missing text has an empty one."""
    batch: list[bytes] = []
    held = 0
    for text in texts:
        batch.append(text or b"")
        held += len(batch[-1])
        if held >= PIECE:
            for words in many_word_hashes(batch):
                yield shingle_set(words, size)
            batch, held = [], 0
    for words in many_word_hashes(batch):
        yield shingle_set(words, size)
