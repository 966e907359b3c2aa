"""Helpers of this subpackage: hashed words of Arrow strings, Arrow building, slim tables, links."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import scratch_path

# Bytes of text handled at a time, so that they stay in the cache; only word-level arrays outlive a chunk.
CHUNK = 1 << 16
# Bytes of an Arrow batch between Spark and Python. Both sides hold whole batches, and texts may be long.
BATCH_BYTES = 8 << 20
# Words handled at a time in shingle arithmetic.
BLOCK_WORDS = 1 << 16


def _white(b: np.ndarray) -> np.ndarray:
    return (b == 0x20) | ((b - np.uint8(9)) < 5)


def _plain(b: np.ndarray) -> np.ndarray:
    letter = ((b | np.uint8(0x20)) - np.uint8(97)) < 26
    return ~(letter | ((b - np.uint8(48)) < 10) | (b >= 128))


#: Separators by name: ASCII white space, or everything in ASCII but letters and digits.
SEPARATORS = {"white": _white, "plain": _plain}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once per process."""
    if not _TABLES or len(_TABLES[0]) < n:
        _TABLES[:] = [_powers(_BASE, max(n, 2 * CHUNK)), _powers(_INVERSE, max(n, 2 * CHUNK))]
    return _TABLES[0], _TABLES[1]


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (or binaries) on end and where each begins; a null counts as empty."""
    binary = pa.types.is_binary(texts.type)
    texts = texts.cast(pa.large_binary()).fill_null(b"") if binary else texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]] if len(texts) else data[:0], offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)


def _chunks(data: np.ndarray, edges: np.ndarray, separators) -> Iterator[tuple[int, int]]:
    """Pieces of about CHUNK bytes that end at a separator or where a text begins."""
    low, size = 0, len(data)
    while low < size:
        high = min(low + CHUNK, size)
        while high < size:
            stop = int(edges[np.searchsorted(edges, high)])
            ahead = min(stop, high + 4096)
            found = np.flatnonzero(separators(data[high:ahead]))
            if len(found) or ahead == stop:
                high = high + int(found[0]) if len(found) else stop
                break
            high = ahead
        yield low, high
        low = high


def hash_words(
    texts: pa.Array, separators: str = "white", breaks: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first bytes, edges, cuts): 64-bit hashes of the words of all texts, A-Z as a-z.

    ``edges[i]:edges[i + 1]`` are the words of text ``i``. ``cuts`` are the positions of the byte
    ``breaks`` (a line end, say) in the bytes of all texts.
    """
    data, offsets = flat_bytes(texts)
    separated = SEPARATORS[separators]
    hashes, firsts, cuts = [], [], []
    edges = np.unique(offsets)
    for low, high in _chunks(data, edges, separated):
        piece = data[low:high]
        if breaks is not None:
            cuts.append(np.flatnonzero(piece == breaks) + low)
        inside = ~separated(piece)
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = edges[np.searchsorted(edges, low): np.searchsorted(edges, high)] - low
        begin[heads] = inside[heads]
        first = np.flatnonzero(begin)
        if not len(first):
            continue
        # Sum of byte times base^place; dividing by base^start makes it the word's alone.
        powers, inverses = _tables(len(piece))
        lower = piece + ((piece - np.uint8(65)) < 26) * np.uint8(32) + np.uint8(1)
        lower *= inside
        values = lower.astype(np.uint64)
        values *= powers[: len(piece)]
        total = np.add.reduceat(values, first)
        total *= inverses[first]
        hashes.append(mix64(total))
        firsts.append(first + low)
    joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    first = joined(firsts, np.int64)
    return joined(hashes, np.uint64), first, np.searchsorted(first, offsets), joined(cuts, np.int64)


def row_blocks(texts: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of consecutive rows with about ``size`` bytes, one row at least."""
    offsets, low = flat_bytes(texts)[1], 0
    while low < len(texts):
        high = max(int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1, low + 1)
        yield low, texts.slice(low, high - low)
        low = high


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams at every position of one sequence; a shorter one counts as one."""
    n = min(n, len(words))
    if n == 0:
        return words
    total = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        total *= np.uint64(_BASE)
        total += words[j: len(words) - n + 1 + j]
    return mix64(total + np.uint64(n))


def digests(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bytes per set of hashes (``starts``: where each of the sets, none of them empty, begins)."""
    sizes = np.diff(np.append(starts, len(values))).astype(np.uint64)
    halves = [
        mix64(np.add.reduceat(mix64(values ^ np.uint64(key)), starts) + sizes)
        for key in (0x243F6A8885A308D3, 0x13198A2E03707344)
    ]
    return np.stack(halves, axis=1)


def binary16(pairs: np.ndarray, at: np.ndarray, rows: int) -> pa.Array:
    """A binary column with the 16 bytes of ``pairs`` in the rows ``at`` and null elsewhere."""
    sizes = np.zeros(rows, dtype=np.int64)
    sizes[at] = 16
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    valid = pa.array(sizes > 0).buffers()[1]
    data = pa.py_buffer(np.ascontiguousarray(pairs, dtype=">u8").tobytes())
    return pa.Array.from_buffers(pa.binary(), rows, [valid, pa.py_buffer(offsets.tobytes()), data])


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A list column from flat values and the size of each list."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def text_key(text: Column) -> Column:
    """128 bits of a text as 16 bytes: the identity of a text, whatever its row is called."""
    return F.unhex(F.md5(text))


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside exchange Arrow batches of at most BATCH_BYTES, or less where the session says so."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    digits = before.rstrip("b")
    if digits.isdigit() and int(digits) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Jobs of the session exchange Arrow batches of at most ``size`` bytes from now on, or less where it says so.

    For results that the caller evaluates: their batches are cut as the session says then.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = spark.conf.get(key).rstrip("b")
    if digits.isdigit() and int(digits) > size:
        spark.conf.set(key, str(size))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with short_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
