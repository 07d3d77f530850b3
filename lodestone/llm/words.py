"""Words of whole texts as arrays: byte positions and position-independent 64-bit hashes.

A word is ``[^\\x20\\x09-\\x0D]+``. Texts are handled in slices of bounded size that end at white
space, so the memory needed depends on the longest word, not on the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20_241).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def to_bytes(text: str | None) -> bytes:
    """UTF-8 bytes of a text; a null text has none."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash per word, the same wherever the word stands."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    ends = np.cumsum(length)
    at = np.arange(ends[-1]) - np.repeat(ends - length, length)
    power = np.cumprod(np.full(int(length.max()), _BASE))
    values = _BYTE[data[at + np.repeat(start, length)]] * power[at]
    return mix64(np.add.reduceat(values, ends - length) + length.astype(np.uint64))


def slices(data: bytes, size: int = SLICE) -> Iterator[tuple[int, np.ndarray]]:
    """Offsets and arrays of slices of about ``size`` bytes; no word is cut."""
    whole = np.frombuffer(data, np.uint8)
    at = 0
    while at < len(whole):
        end = min(len(whole), at + size)
        while end < len(whole):
            gap = np.flatnonzero(_SPACE[whole[end:end + size]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(whole), end + size)
        yield at, whole[at:end]
        at = end


def hashed_words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    parts = []
    for _, piece in slices(to_bytes(text)):
        parts.append(word_hashes(piece, *word_bounds(piece)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, in order; empty if there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(np.cumprod(np.full(width, _BASE))):
        total += words[k:k + n] * factor
    return mix64(total)


def hashed_batch(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts end to end, and the number of words of each text.

    Short texts are joined before they are hashed, which saves calls.
    """
    counts = np.zeros(len(texts), np.int64)
    hashes: list[np.ndarray] = []
    held: list[bytes] = []
    first = size = 0

    def flush(upto: int) -> None:
        nonlocal held, first, size
        if held:
            data = np.frombuffer(b" ".join(held), np.uint8)
            start, end = word_bounds(data)
            hashes.append(word_hashes(data, start, end))
            limits = np.cumsum([len(x) + 1 for x in held])
            counts[first:upto] = np.diff(np.searchsorted(start, limits), prepend=0)
        held, first, size = [], upto, 0

    for i, text in enumerate(texts):
        raw = to_bytes(text)
        if len(raw) > SLICE:
            flush(i)
            for _, piece in slices(raw):
                found = word_hashes(piece, *word_bounds(piece))
                hashes.append(found)
                counts[i] += len(found)
            first = i + 1
            continue
        held.append(raw)
        size += len(raw)
        if size > SLICE:
            flush(i + 1)
    flush(len(texts))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts
