"""Counting quotient filters without loss: sorted sets of numbered keys with their counts, in few bytes.

A key of `bits` bits is first permuted among all numbers of that many bits, so that keys
spread evenly. Its upper bits, the quotient, are told by the place of its run, one bit a
key and one a run; its lower bits, the remainder, are kept in full. As the permutation
can be undone and nothing of the key is dropped, two keys never share a counter. Filters
list their keys in the order of the permuted numbers, so they are merged like sorted runs.
"""

from __future__ import annotations

import numpy as np

# Odd numbers; only their being odd matters for the way back.
FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
# Counts from here on are written apart.
APART = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys of `bits` bits among the numbers of as many bits, each to another."""
    shift = np.uint64((bits + 1) // 2)
    for factor in FACTORS:
        keys = (keys * np.uint64(factor)) & _mask(bits)
        keys = keys ^ (keys >> shift)
    return keys


def restored(keys: np.ndarray, bits: int) -> np.ndarray:
    """The way back from `permuted`."""
    shift = np.uint64((bits + 1) // 2)
    for factor in reversed(FACTORS):
        keys = keys ^ (keys >> shift)
        keys = (keys * np.uint64(pow(factor, -1, 1 << 64))) & _mask(bits)
    return keys


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    return np.unique(keys, return_counts=True)


def packed(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of distinct sorted keys of `bits` bits and their counts."""
    many = len(keys)
    upper = min(max(many.bit_length() - 1, 0), bits)
    lower = bits - upper
    quotient = (keys >> np.uint64(lower)).astype(np.int64) if lower < 64 else np.zeros(many, np.int64)
    marks = np.zeros(many + (1 << upper), np.uint8)
    marks[quotient + np.arange(many)] = 1  # after as many zeros as there are lesser quotients
    wide = (lower + 7) // 8
    remainder = (keys & _mask(lower)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
    large = counts >= APART
    head = np.array([many, upper, int(large.sum())], "<u8")
    small = np.where(large, APART, counts).astype(np.uint8)
    return b"".join(a.tobytes() for a in (head, np.packbits(marks), np.ascontiguousarray(remainder.T), small, counts[large].astype("<u8")))


def unpacked(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a filter in order, and their counts."""
    many, upper, large = np.frombuffer(data, "<u8", 3).tolist()
    lower = bits - upper
    wide, at = (lower + 7) // 8, 24
    size = many + (1 << upper)
    marks = np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size)
    at += (size + 7) // 8
    places = np.flatnonzero(marks)
    quotient = (places - np.arange(many)).astype(np.uint64)
    remainder = np.zeros((many, 8), np.uint8)
    remainder[:, :wide] = np.frombuffer(data, np.uint8, many * wide, at).reshape(wide, many).T
    at += many * wide
    keys = remainder.view("<u8").reshape(-1).astype(np.uint64)
    if lower < 64:
        keys |= quotient << np.uint64(lower)
    counts = np.frombuffer(data, np.uint8, many, at).astype(np.uint64)
    counts[counts == APART] = np.frombuffer(data, "<u8", large, at + many)
    return keys, counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all filters in order, each with the sum of its counts."""
    keys, counts = (np.concatenate([f[k] for f in filters]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")  # runs that are sorted already are only merged
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
