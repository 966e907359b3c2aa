"""Hashes of word n-grams, computed on whole Arrow batches.

Spark splits the texts into words. Each batch hashes its distinct words once, and numpy rolls the
n-gram hashes over all its lists together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# All arithmetic is modulo this prime, 2^61 - 1, in limbs of 31 bits, so that every sum fits 64 bits.
BITS = 61
PRIME = (1 << BITS) - 1
LIMB = 31
# N-gram hashes are polynomials over word hashes, which have 60 bits.
BASE = 1_152_921_504_606_846_883

_P, _LIMB, _LOW = np.uint64(PRIME), np.uint64(LIMB), np.uint64((1 << LIMB) - 1)
_REST, _REST_MASK, _BITS = np.uint64(BITS - LIMB), np.uint64((1 << (BITS - LIMB)) - 1), np.uint64(BITS)


def reduced(total: np.ndarray, spare: np.ndarray) -> None:
    """``total`` modulo the prime, in place: bits above the 61st count as much as those at the bottom."""
    np.right_shift(total, _BITS, out=spare)
    total &= _P
    total += spare
    # Below zero is far above the prime.
    np.subtract(total, _P, out=spare)
    np.minimum(total, spare, out=total)


def times_plus(
    high: np.ndarray, low: np.ndarray, factor: int, plus: int | np.ndarray, out: np.ndarray, spare: np.ndarray, mid: np.ndarray
) -> None:
    """``out = (high * 2^31 + low) * factor + plus`` modulo the prime; the others are room to work in."""
    factor_high, factor_low = np.uint64(factor >> LIMB), np.uint64(factor & ((1 << LIMB) - 1))
    # 2^62 is 2; of the middle product what passes 2^30 passes 2^61 at its place.
    np.multiply(low, factor_high, out=mid)
    np.multiply(high, factor_low, out=spare)
    mid += spare
    np.multiply(high, factor_high << np.uint64(1), out=out)
    np.right_shift(mid, _REST, out=spare)
    out += spare
    mid &= _REST_MASK
    mid <<= _LIMB
    out += mid
    np.multiply(low, factor_low, out=spare)
    out += spare
    out += np.uint64(plus) if isinstance(plus, int) else plus
    reduced(out, spare)


# Lists are handled in blocks of about this many words, whatever the size of the Arrow batch.
BLOCK_WORDS = 1 << 19


def blocks(lists: pa.Array, words: int = BLOCK_WORDS) -> Iterator[pa.Array]:
    """The lists in consecutive slices of at most ``words`` words, or one list where it is longer."""
    offsets, start = lists.offsets.to_numpy(), 0
    while start < len(lists):
        stop = int(np.searchsorted(offsets, offsets[start] + words, side="right")) - 1
        stop = min(max(stop, start + 1), len(lists))
        yield lists.slice(start, stop - start)
        start = stop


def word_hashes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """60 bits of md5 per word of all lists, and where each list begins and ends in them."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    distinct = encoded.dictionary.to_numpy(zero_copy_only=False)
    digests = b"".join([hashlib.md5(word.encode()).digest() for word in distinct])
    table = np.frombuffer(digests, dtype=">u8")[::2].astype(np.uint64) >> np.uint64(4)
    return table[encoded.indices.to_numpy(zero_copy_only=False)], offsets - offsets[0]


def ngrams(flat: np.ndarray, offsets: np.ndarray, n: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of each list, and how many each list has.

    A list shorter than n has one hash, of all its words, if ``short``; otherwise none.
    """
    lengths = np.diff(offsets)
    full = lengths >= n
    counts = np.where(full, lengths - n + 1, np.minimum(lengths, 1) if short else 0)
    begin = np.cumsum(counts) - counts
    # Where in ``flat`` each n-gram starts.
    first = np.arange(counts.sum()) + np.repeat(offsets[:-1] - begin, counts)
    padded = np.concatenate((flat, np.zeros(n, dtype=np.uint64)))
    # Horner's rule at every position at once, whether a list has an n-gram there or not.
    total, (out, spare, mid) = flat.copy(), (np.empty_like(flat) for _ in range(3))
    few = {}
    for j in range(n):
        if j:
            times_plus(total >> _LIMB, total & _LOW, BASE, padded[j: j + len(flat)], out, spare, mid)
            total, out = out, total
        if short and j + 1 < n:
            few[j + 1] = total[offsets[:-1][lengths == j + 1]]
    found = total[first]
    for width, values in few.items():
        found[begin[lengths == width]] = values
    return found, counts


def ngram_hashes(sizes: Sequence[int]):
    """A column function from words to the hashes of all their n-grams of the given sizes."""

    def of_block(lists: pa.Array) -> pa.Array:
        flat, offsets = word_hashes(lists)
        values, owners = [], []
        for n in sizes:
            found, counts = ngrams(flat, offsets, n, short=False)
            values.append((found + np.uint64(n)).astype(np.int64))
            owners.append(np.repeat(np.arange(len(lists)), counts))
        value, owner = np.concatenate(values), np.concatenate(owners)
        if len(sizes) > 1:
            by_owner = np.argsort(owner, kind="stable")
            value, owner = value[by_owner], owner[by_owner]
        ends = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(value))

    def hashes(lists: pa.Array) -> pa.Array:
        parts = [of_block(block) for block in blocks(lists)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return F.arrow_udf(hashes, "array<bigint>")
