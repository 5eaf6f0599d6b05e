"""Suffixes of byte strings, named by their leading bytes; numpy only.

A window is the first ``depth`` bytes of a suffix. Consecutive windows that share their
least ``ANCHOR``-byte string (leftmost on ties) travel as one run, keyed by that string,
the anchor. Equal windows have equal anchors, whatever surrounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of an anchor; windows of 50 bytes hold 35 of them.
ANCHOR = 16
#: Bytes that are worked on together; longer texts are cut into pieces that overlap by one byte less than a window.
PIECE = 1 << 21

#: Bits of a place in a chunk: a chunk is less than two pieces and a window. The same for all, as they order the anchors.
POSITION_BITS = 23

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Base of a polynomial hash and its inverse modulo 2^64, and a random value for each byte.
_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of them at least."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            column = np.full(1 << (n - 1).bit_length(), base)
            column[0] = 1
            _powers[i] = np.cumprod(column)
    return _powers


class Prefixes:
    """A 64-bit hash of any substring of ``data`` in constant time.

    Strings are told apart under the hash of their anchor only, so that equal hashes of
    different strings stay unlikely at any number of documents.
    """

    def __init__(self, data: np.ndarray):
        power = _power(len(data) + 1)[0][: len(data)]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * _power(len(self.sums))[1][start]
        x = (x ^ (x >> np.uint64(31))) * _M2
        return x ^ (x >> np.uint64(29))


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    return np.ascontiguousarray(view).view(np.uint64).ravel()


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - ANCHOR + 1
    v = _eight(data)
    x = v[:n] * _M1
    x = ((x ^ (x >> np.uint64(32))) + v[8 : 8 + n]) * _M2
    x ^= x >> np.uint64(29)
    return x * _M1


@dataclass
class Runs:
    """Runs of windows of several texts: windows ``first`` to ``last`` share the anchor at ``at``."""

    data: np.ndarray
    anchor: np.ndarray  # hash of the anchor
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray  # the number of the run's text
    shift: np.ndarray  # from a place in ``data`` to one in the text
    depth: int

    def names(self, rows: np.ndarray) -> np.ndarray:
        """A hash of all bytes that the windows of the given runs cover."""
        return self.prefixes()(self.first[rows], self.last[rows] + self.depth)

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of the runs have windows that hold half a window's bytes right, and left, of the anchor; those bytes' hashes.

        Every window is of one of the two kinds: right where it starts ``reach`` bytes before
        the anchor at most, else left.
        """
        reach, at = self.reach, self.at[rows]
        right, left = self.last[rows] >= at - reach, self.first[rows] < at - reach
        names = self.prefixes()
        begin = np.maximum(at - reach - 1, 0)
        end = np.minimum(at + self.depth - reach, len(self.data))
        return right, left, names(at, end), ~names(begin, at + ANCHOR)

    @property
    def reach(self) -> int:
        return (self.depth - ANCHOR) // 2

    def windows(self, rows: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of one half of each given run, and the number of the run."""
        edge = self.at[rows] - self.reach
        low = np.where(right, np.maximum(self.first[rows], edge), self.first[rows])
        high = np.where(right, self.last[rows], np.minimum(self.last[rows], edge - 1))
        n = np.maximum(high - low + 1, 0)
        ends = np.cumsum(n)
        start = np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n) + np.repeat(low, n)
        return start, np.repeat(rows, n)

    def window_names(self, start: np.ndarray) -> np.ndarray:
        return self.prefixes()(start, start + self.depth)

    def prefixes(self) -> Prefixes:
        if not hasattr(self, "_prefixes"):
            self._prefixes = Prefixes(self.data)
        return self._prefixes


def runs(texts: list[bytes], depth: int) -> Iterator[Runs]:
    """The runs of ``texts``, about ``PIECE`` bytes at a time; a text shorter than a window has none."""
    held: list[tuple[int, int, bytes]] = []  # text, offset in it, bytes
    size = 0
    for number, text in enumerate(texts):
        for offset in range(0, max(0, len(text) - depth + 1), PIECE):
            part = text if len(text) <= PIECE else text[offset : offset + PIECE + depth - 1]
            held.append((number, offset, part))
            size += len(part)
            if size >= PIECE:
                yield _runs(held, depth)
                held, size = [], 0
    if held:
        yield _runs(held, depth)


def _runs(held: list[tuple[int, int, bytes]], depth: int) -> Runs:
    data = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
    lengths = np.array([len(part) for _, _, part in held])
    begins = np.cumsum(lengths) - lengths
    hashes = anchor_hashes(data)
    bits = np.uint64(POSITION_BITS)
    # high bits of the hash, then the position: the least is the leftmost of the least hashes
    ranked = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, span = depth - ANCHOR + 1, 1
    while span * 2 <= width:
        ranked = np.minimum(ranked[:-span], ranked[span:])
        span *= 2
    if width > span:
        ranked = np.minimum(ranked[: len(ranked) - (width - span)], ranked[width - span :])
    at = (ranked & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    # a piece's last windows would reach into the next piece
    new = np.concatenate(([True], at[1:] != at[:-1]))
    new[begins] = True
    after = begins + lengths - depth + 1
    new[after[after < len(new)]] = True
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    piece = np.searchsorted(begins, first, "right") - 1
    whole = first < after[piece]
    first, last, piece = first[whole], last[whole], piece[whole]
    text, offset = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
    return Runs(data, hashes[at[first]], at[first], first, last, text[piece], (offset - begins)[piece], depth)
