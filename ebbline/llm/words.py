"""Words of many texts at once, as numpy arrays over the bytes of an Arrow batch.

A word is a run of bytes other than blank and the controls 9 to 13, which in UTF-8
is a run of characters other than those. Words are named by 64-bit hashes: a
random number for each byte value, times powers of an odd number, summed modulo
2**64 and mixed. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes that are hashed together; the tables of a task are as long.
PIECE = 1 << 16
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


# Made once in each task; a plain dictionary, as that travels with the functions that use it.
_MADE: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "tables" not in _MADE:
        _MADE["tables"] = _make_tables()
    return _MADE["tables"]


def _make_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    letters = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    up, down = np.full(PIECE, BASE, np.uint64), np.full(PIECE, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return letters, np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the ends of its texts in them."""
    text = text.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    if len(text) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(text), np.int64)
    return np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of each text's words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = ends[(ends > 0) & (ends < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    upto = np.searchsorted(start, ends)
    return start, stop, np.diff(upto, prepend=0)


def hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, worked out over pieces of bounded length."""
    letters, up, down = _tables()
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        upto = max(at + 1, int(np.searchsorted(stop, low + PIECE - 1, "right")))
        part = data[low : stop[upto - 1]]
        if len(part) >= PIECE:  # one word longer than a piece
            value = np.uint64(0)
            for k in range(0, len(part), PIECE):
                some = part[k : k + PIECE]
                value = value * np.uint64(BASE) + (letters[some] * up[: len(some)]).sum(dtype=np.uint64)
            out[at] = value
        else:
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(letters[part] * up[: len(part)], out=total[1:])
            begin, end = start[at:upto] - low, stop[at:upto] - low
            out[at:upto] = (total[end] - total[begin]) * down[begin]
        at = upto
    return mix(out)
