"""Merging sorted runs of byte strings with a loser tree that knows common prefixes.

Every entry carries the length of the prefix it shares with the last string put out. Of two
entries, the one that shares more is smaller, and no byte is looked at; only entries that share
equally much are compared, from that length on. A known prefix is never compared again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np

_STEP = 32


def compare(a: bytes, b: bytes, known: int) -> tuple[int, bool]:
    """Length of the common prefix, at least ``known``, and whether a <= b."""
    end = min(len(a), len(b))
    while known < end:
        x, y = a[known:known + _STEP], b[known:known + _STEP]
        if x == y:
            known += len(x)
            continue
        size = min(len(x), len(y))
        differ = int.from_bytes(x[:size]) ^ int.from_bytes(y[:size])
        known += size - (differ.bit_length() + 7) // 8
        break
    if known >= end:
        return end, len(a) <= len(b)
    return known, a[known] < b[known]


def front_coded(strings: list[bytes]) -> bytes:
    """A sorted run as common prefix lengths, tail lengths and tails."""
    shared, tails, before = [], [], b""
    for s in strings:
        n, _ = compare(before, s, 0)
        shared.append(n)
        tails.append(s[n:])
        before = s
    head = struct.pack("<I", len(strings))
    return (head + np.array(shared, "<u4").tobytes()
            + np.array([len(t) for t in tails], "<u4").tobytes() + b"".join(tails))


def decoded(run: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a front-coded run, each with its common prefix with the one before."""
    n = struct.unpack_from("<I", run)[0]
    shared = np.frombuffer(run, "<u4", n, 4).tolist()
    sizes = np.frombuffer(run, "<u4", n, 4 + 4 * n).tolist()
    at, before = 4 + 8 * n, b""
    for keep, size in zip(shared, sizes):
        before = before[:keep] + run[at:at + size]
        at += size
        yield before, keep


def merged(runs: list[Iterable[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """All strings in order: the number of the run, the string, and the prefix it shares with the
    string before it."""
    streams = [iter(r) for r in runs]
    count = len(streams)
    if not count:
        return
    size = 1
    while size < count:
        size *= 2
    # A leaf holds its run's next string; shared -1 marks a run that has ended.
    head: list[bytes] = [b""] * size
    shared = [-1] * size
    for k, stream in enumerate(streams):
        first = next(stream, None)
        if first is not None:
            head[k], shared[k] = first[0], 0
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two leaves; the loser's prefix is then that with the winner."""
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        if shared[a] < 0:
            return a, b
        both, first = compare(head[a], head[b], shared[a])
        win, lose = (a, b) if first else (b, a)
        shared[lose] = both
        return win, lose

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, loser[node] = play(build(2 * node), build(2 * node + 1))
        return win

    winner = build(1) if size > 1 else 0
    while shared[winner] >= 0:
        yield winner, head[winner], shared[winner]
        following = next(streams[winner], None)
        if following is None:
            shared[winner] = -1
        else:
            head[winner], shared[winner] = following
        node = (winner + size) // 2
        while node:
            # Both prefixes are with the string just put out: the last winner here.
            winner, loser[node] = play(winner, loser[node])
            node //= 2
