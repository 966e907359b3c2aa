"""Counting quotient filters that lose nothing: sorted, compact tables from wide integers to counts.

A key of ``q + r`` bits (here a packed n-gram of word ids) goes through a permutation of all such integers;
its upper ``q`` bits are the quotient, its lower ``r`` bits the remainder, which is kept whole, so the key
can be had back. Within a filter entries are sorted by (quotient, remainder). Quotients are not stored: one
bit per quotient says whether it is occupied, one bit per entry whether it ends the run of its quotient.
Counts take a byte, and eight more where they pass 254. The upper ``s`` bits of the quotient are the
number of a shard: keys are spread evenly over shards whatever they count, and filters of one shard merge
as sorted lists do.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from corpusflow.llm.common import mix64

_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_LONG = 255


class Shape(NamedTuple):
    """``word``: bits of a word id; ``size``: words of a key; ``shard``: bits of the shard; ``inner``: of the quotient below it."""

    word: int
    size: int
    shard: int
    inner: int

    @property
    def quotient(self) -> int:
        return self.shard + self.inner

    @property
    def remainder(self) -> int:
        return self.word * self.size - self.quotient

    @property
    def width(self) -> int:
        """Bytes of a stored remainder."""
        return -(-self.remainder // 8)


def shape(word: int, size: int, shard: int, entries: int) -> Shape:
    """A shape whose filters hold about ``entries`` keys, with remainders of 64 bits at most."""
    bits = word * size
    # The remainder holds one word id at least, so that ids can be shifted through it.
    shard = min(shard, bits - word)
    wanted = max(max(entries, 1).bit_length() - 1, bits - shard - 64)
    return Shape(word, size, shard, min(wanted, bits - word - shard))


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _shift(values: np.ndarray, bits: int) -> np.ndarray:
    """Shifted right (left where negative); by 64 and more nothing is left."""
    if abs(bits) >= 64:
        return np.zeros_like(values)
    return values >> np.uint64(bits) if bits >= 0 else values << np.uint64(-bits)


def pack(ids: list[np.ndarray], s: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(upper, lower) bits of the ids written one after the other."""
    upper = np.zeros(len(ids[0]), dtype=np.uint64)
    lower = np.zeros(len(ids[0]), dtype=np.uint64)
    for one in ids:
        upper = (_shift(upper, -s.word) | _shift(lower, s.remainder - s.word)) & _mask(s.quotient)
        lower = (_shift(lower, -s.word) | one.astype(np.uint64)) & _mask(s.remainder)
    return upper, lower


def unpack(upper: np.ndarray, lower: np.ndarray, s: Shape) -> list[np.ndarray]:
    out = []
    for _ in range(s.size):
        out.append((lower & _mask(s.word)).astype(np.int64))
        lower = _shift(lower, s.word) | _shift(upper & _mask(s.word), s.word - s.remainder)
        lower &= _mask(s.remainder)
        upper = _shift(upper, s.word)
    return out[::-1]


def permute(upper: np.ndarray, lower: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Halves changed in turn by what the other half mixes to: every step can be undone."""
    for i, key in enumerate(_KEYS):
        if i % 2:
            lower = lower ^ (mix64(upper + np.uint64(key)) & _mask(s.remainder))
        else:
            upper = upper ^ (mix64(lower + np.uint64(key)) & _mask(s.quotient))
    return upper, lower


def restore(upper: np.ndarray, lower: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray]:
    for i, key in reversed(list(enumerate(_KEYS))):
        if i % 2:
            lower = lower ^ (mix64(upper + np.uint64(key)) & _mask(s.remainder))
        else:
            upper = upper ^ (mix64(lower + np.uint64(key)) & _mask(s.quotient))
    return upper, lower


def counted(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray, s: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct entries and the sums of their counts; a sort that profits from runs already sorted."""
    if s.quotient + s.remainder <= 64:
        keys = _shift(upper, -s.remainder) | lower
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, dtype=bool)
    else:
        order = np.lexsort((lower, upper))
        a, b = upper[order], lower[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new)
    first = order[starts]
    sums = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return upper[first], lower[first], sums


def encode(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray, s: Shape) -> list[tuple[int, bytes]]:
    """(shard, filter) of sorted distinct entries."""
    shard = _shift(upper, s.inner).astype(np.int64)
    starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    out = []
    for low, high in zip(starts, np.append(starts[1:], len(shard))):
        inner = (upper[low:high] & _mask(s.inner)).astype(np.int64)
        occupied = np.zeros(1 << s.inner, dtype=bool)
        occupied[inner] = True
        ends = np.append(inner[1:] != inner[:-1], True)
        n = counts[low:high]
        small = np.minimum(n, _LONG).astype(np.uint8)
        raw = lower[low:high].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : s.width]
        out.append((int(shard[low]), b"".join([
            int(high - low).to_bytes(8, "little"), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
            np.ascontiguousarray(raw).tobytes(), small.tobytes(), n[small == _LONG].astype("<u8").tobytes(),
        ])))
    return out


def decode(shard: int, data: bytes, s: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a filter in order."""
    raw = np.frombuffer(data, dtype=np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    sizes = [-(-(1 << s.inner) // 8), -(-n // 8), n * s.width, n]
    edges = 8 + np.cumsum([0, *sizes])
    bits, ends, lower, small = (raw[a:b] for a, b in zip(edges[:-1], edges[1:]))
    occupied = np.flatnonzero(np.unpackbits(bits, count=1 << s.inner))
    run = np.cumsum(np.unpackbits(ends, count=n).astype(np.int64)) - np.unpackbits(ends, count=n)
    upper = occupied[run].astype(np.uint64) | _shift(np.full(n, shard, dtype=np.uint64), -s.inner)
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, : s.width] = lower.reshape(n, s.width)
    counts = small.astype(np.int64)
    counts[small == _LONG] = raw[edges[-1]:].view("<u8") if len(raw) > edges[-1] else 0
    return upper, wide.reshape(-1).view("<u8").astype(np.uint64), counts


def merged(shard: int, filters: list[bytes], s: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of several filters of one shard as one sorted list, counts added."""
    parts = [decode(shard, data, s) for data in filters]
    upper, lower, counts = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return counted(upper, lower, counts, s)
