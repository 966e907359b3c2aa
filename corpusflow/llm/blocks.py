"""Texts in blocks, each with a word list of its own.

A model over words or n-grams can outgrow any broadcast. Here texts are dealt into blocks of some
megabytes, each block names what it holds once (its distinct words, say), those short lists meet the model
in an ordinary join, and the answers travel to the block's texts. Memory is bounded by a block, whatever
the size of the model, and a word of a third of all places is one row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusflow.llm.common import flat_bytes, row_blocks, written

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20

#: Bytes of text that a task splits at a time.
PIECE_BYTES = 1 << 21

WHITE = b" \t\n\x0b\x0c\r"


def blocked(docs: DataFrame, text: str, size: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with (block, place), written down: from here on a row's block is fixed."""
    kinds = StructType([*docs.schema.fields, StructField("block", LongType()), StructField("place", LongType())])
    at = docs.columns.index(text)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, rows = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            bytes_of = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            before = done + np.cumsum(bytes_of) - bytes_of
            places = rows + np.arange(batch.num_rows)
            done, rows = done + int(bytes_of.sum()), rows + batch.num_rows
            columns = [*batch.columns, pa.array(first + before // size), pa.array(places)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kinds.fields])

    return written(docs.mapInArrow(number, kinds), "blocks")


def classes(spaces: bytes, stops: bytes = b"") -> np.ndarray:
    """For each byte: 0 in a word, 1 between words, 2 between pieces."""
    out = np.zeros(256, dtype=np.uint8)
    out[list(spaces)] = 1
    out[list(stops)] = 2
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65)) < 26) * np.uint8(32)


def split_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, edges, joined): words with A-Z as a-z; ``edges[i]:edges[i + 1]`` are those of text ``i``;
    ``joined[w]`` says that word ``w`` follows its predecessor in the same piece of the same text."""
    data, offsets = flat_bytes(texts)
    data = lowered(data)
    kind = kinds[data]
    inside = kind == 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begin[heads] = inside[heads]
    first = np.flatnonzero(begin)
    # A word ends where the next one begins, less what lies between.
    letters = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    ends = np.append(letters[first], letters[-1]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[inside].tobytes())]
    )
    edges = np.searchsorted(first, offsets)
    stops = np.searchsorted(np.flatnonzero(kind == 2), first)
    joined = np.zeros(len(first), dtype=bool)
    joined[1:] = stops[1:] == stops[:-1]
    joined[edges[:-1][edges[:-1] < len(first)]] = False
    return words, edges, joined


def runs(batches: Iterator[pa.RecordBatch], keys: int, text: int | None = None) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(values of the first ``keys`` columns, rows) of neighbouring rows that agree in them; a run may come in parts,
    and where column ``text`` is given, in parts of about PIECE_BYTES of it, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for part in parts:
            new[1:] |= part[1:] != part[:-1]
        starts = np.flatnonzero(new)
        for low, high in zip(starts, np.append(starts[1:], batch.num_rows)):
            run, key = batch.slice(low, high - low), tuple(int(part[low]) for part in parts)
            if text is None:
                yield key, run
                continue
            for first, piece in row_blocks(run.column(text), PIECE_BYTES):
                yield key, run.slice(first, len(piece))


def summed(columns: list[pa.Array], counts: np.ndarray) -> tuple[list[pa.Array], np.ndarray]:
    """Distinct rows of string columns and the sums of their counts."""
    codes, names = np.zeros(len(counts), dtype=np.int64), []
    for column in columns:
        column = column.dictionary_encode()
        codes = codes * len(column.dictionary) + column.indices.to_numpy()
        names.append(column.dictionary)
    found, at = np.unique(codes, return_inverse=True)
    sums = np.bincount(at, weights=counts, minlength=len(found)).astype(np.int64)
    out = []
    for name in reversed(names):
        out.append(name.take(pa.array(found % len(name))))
        found = found // len(name)
    return out[::-1], sums


def counted(parts: Iterator[tuple[int, list[pa.Array], np.ndarray]], most: int = 1 << 20) -> Iterator[tuple[int, list[pa.Array], np.ndarray]]:
    """(block, columns, counts) of neighbouring parts of a block put together, up to ``most`` rows at a time."""
    now, held, size = None, [], 0

    def together() -> tuple[int, list[pa.Array], np.ndarray]:
        columns = [pa.concat_arrays(c) for c in zip(*(h[0] for h in held))]
        return now, *summed(columns, np.concatenate([h[1] for h in held]))

    for block, columns, counts in parts:
        if held and (block != now or size > most):
            yield together()
            held, size = [], 0
        now = block
        held.append((columns, counts))
        size += len(counts)
        if len(held) == 8 and size <= most:
            held = [together()[1:]]
            size = len(held[0][1])
    if held:
        yield together()


def beside(blocks: DataFrame, notes: DataFrame) -> DataFrame:
    """Rows of ``notes`` (kind 0 and up), then the texts of their block (the last kind), in one stream per partition.

    Both have (block, kind, place, ...) first and the same columns. Blocks are dealt out in turn.
    """
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.col("block").bitwiseAND((1 << 32) - 1)
    most = blocks.agg(F.max(number)).first()[0] or 0
    turn = F.pmod(F.shiftright("block", 32) * (most + 1) + number, F.lit(parts)).cast("int")
    return notes.unionByName(blocks).repartitionById(parts, turn).sortWithinPartitions("block", "kind", "place")


def padded(df: DataFrame, **missing: str) -> DataFrame:
    """``df`` with null columns of the given types."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in missing.items()})
