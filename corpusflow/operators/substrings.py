"""Which of many strings a text holds, by grams of bytes, on whole Arrow batches.

UTF-8 strings hold each other exactly if their bytes do. A string of eight bytes or more is looked for by one of its
grams of eight bytes, a shorter one by a gram of four, two or one: each gram of that size is a number, and the
numbers at all places of a text are made at once. A short list goes to the tasks whole: places with a string's gram are
compared with the string, eight bytes at a time. Of a long list only a bitmap of all its grams does; texts
answer with the grams that they hold, and Spark joins those with the list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a gram, the longest that fits a string first.
SIZES = (8, 4, 2, 1)
#: Bytes of text looked at together, and places compared together.
PIECE, PLACES = 1 << 18, 1 << 18
#: Bits of the filter for a short list, and of the bitmap for a long one (16 MB).
FILTER_BITS, MAP_BITS = 20, 27
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end and where each begins; a null has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def codes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, with zeros behind the end."""
    one = np.zeros(len(data) + 8, dtype=np.uint64)
    one[: len(data)] = data
    two = one[:-1] << np.uint64(8) | one[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    return (four[:-4] << np.uint64(32) | four[4:])[: len(data)]


def pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of about PIECE bytes, one text at least."""
    offsets, low = flat(texts)[1], 0
    while low < len(texts):
        high = max(int(np.searchsorted(offsets, offsets[low] + PIECE, side="right")) - 1, low + 1)
        yield low, texts.slice(low, high - low)
        low = high


def size_of(lengths: np.ndarray) -> np.ndarray:
    """The size of gram by which a string of so many bytes is looked for; 0 for an empty one."""
    out = np.zeros(len(lengths), dtype=np.int64)
    for size in reversed(SIZES):
        out[lengths >= size] = size
    return out


def _own_grams(code: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, place) of all grams of one size that lie within a string."""
    lengths = np.diff(offsets)
    counts = np.maximum(lengths - size + 1, 0)
    first = np.cumsum(counts) - counts
    place = np.arange(counts.sum()) + np.repeat(offsets[:-1] - first, counts)
    return np.repeat(np.arange(len(lengths)), counts), place


class Table(NamedTuple):
    """Strings of one size of gram by one of their grams."""

    size: int
    grams: np.ndarray  # distinct, sorted
    starts: np.ndarray  # where the strings of each gram begin, and the end
    strings: np.ndarray
    shift: np.ndarray  # place of the gram in its string
    filter: np.ndarray


class Listed(NamedTuple):
    code: np.ndarray  # at each byte of all strings on end
    offsets: np.ndarray
    numbers: np.ndarray
    tables: list[Table]


def listed(strings: Sequence[tuple[int, str]]) -> Listed:
    """A list of (number, string), the strings distinct and not empty, made ready for ``found``.

    Each string is looked for by the gram that the fewest strings of the list have.
    """
    data, offsets = flat(pa.array([s for _, s in strings], pa.string()))
    code, sizes = codes(data), size_of(np.diff(offsets))
    tables = []
    for size in SIZES:
        owner, place = _own_grams(code, offsets, size)
        chosen = sizes[owner] == size
        owner, place = owner[chosen], place[chosen]
        if not len(owner):
            continue
        gram = code[place] >> np.uint64(64 - 8 * size)
        _, at, often = np.unique(gram, return_inverse=True, return_counts=True)
        order = np.lexsort((place, often[at], owner))
        order = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        order = order[np.argsort(gram[order], kind="stable")]
        own, gram, shift = owner[order], gram[order], place[order] - offsets[owner[order]]
        starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        passing = np.zeros(1 << FILTER_BITS, dtype=bool)
        passing[(gram * _SPREAD) >> np.uint64(64 - FILTER_BITS)] = True
        tables.append(Table(size, gram[starts], np.append(starts, len(gram)), own, shift, passing))
    return Listed(code, offsets, np.array([n for n, _ in strings], dtype=np.int64), tables)


def _same(code: np.ndarray, at: np.ndarray, other: np.ndarray, where: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which pairs of places (``at`` in one, ``where`` in the other) begin with the same ``lengths`` bytes."""
    good, done = np.arange(len(at)), 0
    while len(good):
        rest = lengths[good] - done
        open_ = rest > 0
        if not open_.any():
            break
        differ = code[at[good[open_]] + done] ^ other[where[good[open_]] + done]
        differ >>= (np.uint64(64) - np.uint64(8) * np.minimum(rest[open_], 8).astype(np.uint64))
        keep = np.ones(len(good), dtype=bool)
        keep[open_] = differ == 0
        good, done = good[keep], done + 8
    return good


def found(texts: pa.Array, known: Listed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, strings) of places at which a text holds a string, part by part."""
    lengths = np.diff(known.offsets)
    for first, part in pieces(texts):
        data, offsets = flat(part)
        code = codes(data)
        for table in known.tables:
            gram = code >> np.uint64(64 - 8 * table.size)
            place = np.flatnonzero(table.filter[(gram * _SPREAD) >> np.uint64(64 - FILTER_BITS)])
            at = np.searchsorted(table.grams, gram[place])
            hit = table.grams[np.minimum(at, len(table.grams) - 1)] == gram[place]
            place, at = place[hit], at[hit]
            counts = np.diff(table.starts)[at]
            ends, low = np.cumsum(counts), 0
            while low < len(place):
                # A place stands for all strings with its gram; so many places that their strings fit.
                high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PLACES, side="right")), low + 1)
                n = counts[low:high]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                entry = np.repeat(table.starts[at[low:high]], n) + inside
                string, begin = table.strings[entry], np.repeat(place[low:high], n) - table.shift[entry]
                row = np.searchsorted(offsets, np.repeat(place[low:high], n), side="right") - 1
                whole = (begin >= offsets[row]) & (begin + lengths[string] <= offsets[row + 1])
                row, string, begin = row[whole], string[whole], begin[whole]
                good = _same(code, begin, known.code, known.offsets[string], lengths[string])
                if len(good):
                    yield row[good] + first, string[good]
                low = high


def first_found(spark, strings: Sequence[tuple[int, str]]):
    """A column function from texts to the smallest number of a string that they hold, or null."""
    shared = spark.sparkContext.broadcast(listed(strings))

    def scan(texts: pa.Array) -> pa.Array:
        known, none = shared.value, np.iinfo(np.int64).max
        least = np.full(len(texts), none)
        for rows, held in found(texts, known):
            np.minimum.at(least, rows, known.numbers[held])
        return pa.array(least, mask=least == none)

    # Not deterministic, so that the optimizer does not run it once per use of its result.
    return F.arrow_udf(scan, T.LongType()).asNondeterministic()


_GRAM = T.ArrayType(T.StructType([T.StructField("q", T.IntegerType()), T.StructField("g", T.LongType()), T.StructField("bit", T.LongType())]))


def _positions(gram: np.ndarray, size: int) -> np.ndarray:
    return ((gram ^ np.uint64(size)) * _SPREAD) >> np.uint64(64 - MAP_BITS)


def _gram_lists(rows: int, parts: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.Array:
    """One list of distinct grams per row from (row, gram, size)."""
    owner = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
    gram = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint64)])
    size = np.concatenate([np.full(len(p[0]), p[2]) for p in parts] or [np.zeros(0, np.int64)])
    order = np.lexsort((gram, size, owner))
    owner, gram, size = owner[order], gram[order], size[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1]) | (size[1:] != size[:-1])
    owner, gram, size = owner[new], gram[new], size[new]
    bit = np.zeros(len(gram), dtype=np.int64)
    for q in SIZES:
        of_size = size == q
        bit[of_size] = _positions(gram[of_size], q).astype(np.int64)
    fields = pa.StructArray.from_arrays([pa.array(size.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(bit)], ["q", "g", "bit"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), fields)


def own_grams():
    """A column function from strings to the distinct grams (q, g, bit) by any of which they can be looked for."""

    def of(strings: pa.Array) -> pa.Array:
        data, offsets = flat(strings)
        code, sizes, parts = codes(data), size_of(np.diff(offsets)), []
        for size in SIZES:
            owner, place = _own_grams(code, offsets, size)
            chosen = sizes[owner] == size
            parts.append((owner[chosen], code[place[chosen]] >> np.uint64(64 - 8 * size), size))
        return _gram_lists(len(strings), parts)

    return F.arrow_udf(of, _GRAM)


def grams_bitmap(grams: DataFrame, bit: str = "bit") -> np.ndarray:
    """One bit for each gram that the list has, of 2 ** MAP_BITS: the driver holds 16 MB whatever the list."""
    # Places are counted from 1, so that pieces are.
    place = F.col(bit) + 1
    packed = grams.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    for row in packed.toLocalIterator():
        low = (row["piece"] - 1) * 4096
        out[low: low + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def gram_counts(texts: DataFrame, text: str, bitmap: np.ndarray, sizes: Sequence[int]) -> DataFrame:
    """(q, g, n): how many places of all texts hold each gram that the bitmap knows; counted by piece first."""
    shared, schema = texts.sparkSession.sparkContext.broadcast(bitmap), "q int, g bigint, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                data, offsets = flat(part)
                code = codes(data)
                for size in sizes:
                    owner, place, gram = _known(code, offsets, shared.value, size)
                    found, often = np.unique(gram[place], return_counts=True)
                    q = np.full(len(found), size, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q), pa.array(found.view(np.int64)), pa.array(often.astype(np.int64))], names=["q", "g", "n"]
                    )

    counted = texts.select(text).mapInArrow(run, schema)
    return counted.groupBy("q", "g").agg(F.sum("n").alias("n"))


def _known(code: np.ndarray, offsets: np.ndarray, bitmap: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place) of all grams of one size that the bitmap knows and a text holds, and the grams of all places."""
    gram = code >> np.uint64(64 - 8 * size)
    bit = _positions(gram, size)
    known = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
    place = np.flatnonzero(known)
    owner = np.searchsorted(offsets, place, side="right") - 1
    inside = place + size <= offsets[owner + 1]
    return owner[inside], place[inside], gram


def held_grams(spark, bitmap: np.ndarray, sizes: Sequence[int]):
    """A column function from texts to those of their distinct grams that the bitmap knows."""
    shared = spark.sparkContext.broadcast(bitmap)

    def of(texts: pa.Array) -> pa.Array:
        out = []
        for _, part in pieces(texts):
            data, offsets = flat(part)
            code, parts = codes(data), []
            for size in sizes:
                owner, place, gram = _known(code, offsets, shared.value, size)
                parts.append((owner, gram[place], size))
            out.append(_gram_lists(len(part), parts))
        return pa.concat_arrays(out) if out else _gram_lists(0, [])

    return F.arrow_udf(of, _GRAM).asNondeterministic()
