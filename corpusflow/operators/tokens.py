"""Token ids, token counts, and cutting token streams into files and samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from corpusflow.functions.numbers import ColumnOrName, as_column, div
from corpusflow.operators.index import global_index, prefix_sums, range_buckets, shuffle_seeded
from corpusflow.operators.sizing import fits
from corpusflow.session import checkpointed

# Runs of letters, single digits, runs of anything else but white space.
PIECES = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
VOCAB_ROWS = 1_000_000
VOCAB_BYTES = 64 * 1024 * 1024
# Bytes of texts whose distinct tokens are looked up together in a larger vocabulary.
BLOCK_BYTES = 32 * 1024 * 1024
PACK_ROWS_PER_BUCKET = 2_048


def pieces(text: ColumnOrName) -> Column:
    """Text as an array of token strings; null text has none."""
    found = F.regexp_extract_all(as_column(text), F.lit(PIECES), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def token_length(text: ColumnOrName) -> Column:
    return F.size(pieces(text)).cast("long")


def build_vocab(df: DataFrame, text: str, size: int | None = None, **options) -> DataFrame:
    """(token, n, id): ids count up from the most frequent token, ties by token."""
    counts = df.select(F.explode(pieces(text)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # The counts are read several times below; the texts only here.
    counts = checkpointed(counts.withColumn("_rare", -F.col("n")))
    ranked = global_index(counts, ["_rare", "token"], out="id", **options).drop("_rare")
    return ranked if size is None else ranked.where(F.col("id") < size)


def _lookup(spark, tokens: list[str], ids: list[int], unknown: int):
    shared = spark.sparkContext.broadcast((tokens, np.asarray(ids + [unknown], dtype=np.int64)))

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, numbers = shared.value
        # One table for all batches of a task. Tokens it lacks have place -1, the last number.
        places = pd.Index(known, dtype=object)
        for lists in batches:
            flat = lists.flatten().dictionary_encode()
            distinct = places.get_indexer(flat.dictionary.to_pylist()) if len(places) else np.full(len(flat.dictionary), -1)
            found = numbers[distinct][flat.indices.to_numpy()]
            offsets = pc.subtract(lists.offsets, lists.offsets[0])
            yield pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64()))

    return F.arrow_udf(encode, "array<bigint>")


def _number_blocks(kept: Sequence[str], out: str):
    """A function over partitions in which the tokens of a block stand before its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, listed, known, numbers = None, [], None, None
        for batch in batches:
            blocks, names = batch.column("_block").to_numpy(), batch.column("_token")
            named = pc.is_valid(names).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (named[1:] != named[:-1])) + 1
            for low, high in zip([0, *edges], [*edges, len(blocks)]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if blocks[low] != block:
                    block, listed, known = blocks[low], [], None
                if named[low]:
                    listed.append((part.column("_token"), part.column("_number")))
                    continue
                if known is None:
                    known = pa.concat_arrays([t for t, _ in listed]) if listed else names.slice(0, 0)
                    numbers = np.concatenate([n.to_numpy() for _, n in listed] or [np.zeros(0, np.int64)])
                    listed = []
                lists = part.column("_pieces")
                flat = lists.flatten().dictionary_encode()
                places = pc.index_in(flat.dictionary, value_set=known)
                if places.null_count:
                    raise RuntimeError("the texts changed between two readings: write them down before")
                found = numbers[places.to_numpy()][flat.indices.to_numpy()]
                offsets = pc.subtract(lists.offsets, lists.offsets[0])
                encoded = pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), encoded], names=[*kept, out])

    return run


def _encode_joined(df: DataFrame, text: str, vocab: DataFrame, doc_id: str, out: str, unknown: int) -> DataFrame:
    """Texts dealt into blocks; the distinct tokens of each block meet the vocabulary and come back as its list."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(doc_id, text), F.lit(size // BLOCK_BYTES + 1)))
    named = dealt.select("_block", F.explode(pieces(text)).alias("_token")).distinct()
    # A token is there once per block, however frequent it is.
    number = F.coalesce("_number", F.lit(unknown).cast("long")).alias("_number")
    listed = named.join(vocab, "_token", "left").select("_block", "_token", number)
    both = dealt.unionByName(listed, allowMissingColumns=True).repartition("_block")
    placed = both.sortWithinPartitions("_block", F.col("_token").isNull())
    kept = [c for c in df.columns if c != out]
    fields = [StructField(df.schema[c].name, df.schema[c].dataType) for c in kept]
    schema = StructType([*fields, StructField(out, ArrayType(LongType()))])
    return placed.select("_block", "_token", "_number", *kept, pieces(text).alias("_pieces")).mapInArrow(
        _number_blocks(kept, out), schema
    )


def encode(
    df: DataFrame,
    text: str,
    vocab: DataFrame,
    doc_id: str,
    out: str = "tokens",
    unknown: int = -1,
    max_rows: int = VOCAB_ROWS,
    max_bytes: int = VOCAB_BYTES,
) -> DataFrame:
    """Text to token ids by a vocabulary (token, id); tokens it lacks become ``unknown``.

    A vocabulary within the bounds goes to the tasks, and documents are neither exploded nor
    shuffled. A larger one is joined with the distinct tokens of blocks of texts, and texts move once, as they
    are. They are read three times then, so write them down before if they are dear to make or come out
    differently each time. Either way the tokens of a row come from its text alone, whatever ``doc_id`` it has;
    null text has none.
    """
    vocab = vocab.select(F.col("token").alias("_token"), F.col("id").cast("long").alias("_number"))
    if fits(vocab, max_rows, max_bytes):
        rows = vocab.collect()
        lookup = _lookup(df.sparkSession, [r["_token"] for r in rows], [r["_number"] for r in rows], unknown)
        return df.withColumn(out, lookup(pieces(text)))
    return _encode_joined(df, text, vocab, doc_id, out, unknown)


def append_eod(tokens: ColumnOrName, eod: int) -> Column:
    return F.concat(as_column(tokens), F.array(F.lit(eod).cast("long")))


def count_tokens(df: DataFrame, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows and tokens in all, or by flag or source."""
    counted = df.select(*by, tokens.cast("long").alias("_tokens"))
    total = F.coalesce(F.sum("_tokens"), F.lit(0)).cast("long").alias("tokens")
    return counted.groupBy(*by).agg(F.count("*").alias("docs"), total)


def throughput(df: DataFrame, tokens: ColumnOrName, seconds: float | Column) -> DataFrame:
    """All tokens per second; 0 where no time has passed."""
    seconds = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return df.agg(F.coalesce(F.sum(as_column(tokens)), F.lit(0)).cast("long").alias("tokens")).withColumn(
        "tokens_per_second",
        F.when(seconds > 0, F.col("tokens") / seconds).otherwise(F.lit(0.0)),
    )


def files_by_max_tokens(
    df: DataFrame, tokens: str, max_tokens: int, order: Sequence[str], out: str = "file", **options
) -> DataFrame:
    """Number of the output file of each document: a new file per ``max_tokens`` tokens before it."""
    before = prefix_sums(df, order, weight=tokens, out="_before", **options)
    return before.withColumn(out, div("_before", max_tokens)).drop("_before")


def skip_and_cap_tokens(
    df: DataFrame,
    tokens: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    skip: int = 0,
    cap: int | None = None,
    **options,
) -> DataFrame:
    """Whole documents of each dataset from ``skip`` tokens on, up to ``cap`` tokens (None: all)."""
    before = prefix_sums(df, order, weight=tokens, partition=by, out="_before", **options)
    inside = F.col("_before") >= F.lit(skip)
    if cap is not None:
        inside = inside & (F.col("_before") < F.lit(skip + cap))
    return before.where(inside).drop("_before")


def pack_sequences(
    df: DataFrame,
    tokens: str,
    length: int,
    order: Sequence[str],
    plus_one: bool = True,
    **options,
) -> DataFrame:
    """(seq, tokens): all documents joined in order and cut into samples.

    A sample covers ``length`` tokens, and with ``plus_one`` also the first of the next sample, as
    the target of its last token. A last sample that is not full is dropped.

    Tokens are moved once: rows are dealt out by ranges of the order, sizes alone say where each range begins,
    and the samples that lie within a range are put together where its rows are. Only the few pieces of
    samples that cross a border of ranges travel on. Sizes and tokens are read in passes of their own, so write tokens down before
    if they are dear to make.
    """
    extra = 1 if plus_one else 0
    sized = df.withColumn("_size", F.greatest(F.size(tokens), F.lit(0)).cast("long")).where(F.col("_size") > 0)
    rows = options.get("rows") or df.count()
    bucket = range_buckets(df, order, rows, options.get("rows_per_bucket", PACK_ROWS_PER_BUCKET))
    bucketed = sized.select((F.lit(0) if bucket is None else bucket).alias("_bucket"), "_size", F.col(tokens).alias("_tokens"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    totals = bucketed.groupBy("_bucket").agg(F.sum("_size").alias("_total"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = F.broadcast(totals.select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("_bucket").orderBy(*[f"_o{i}" for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    placed = bucketed.withColumn("_upto", F.sum("_size").over(inside))
    if bucket is None:
        placed = placed.withColumn("_offset", F.lit(0).cast("long"))
    else:
        placed = placed.join(offsets, F.col("_bucket") == F.col("_b"))
    placed = placed.select("_bucket", "_tokens", "_size", (F.col("_offset") + F.col("_upto") - F.col("_size")).alias("_start"))
    start, end = F.col("_start"), F.col("_start") + F.col("_size")
    first = div(F.greatest(start - extra, F.lit(0)), length)
    last = div(end - 1, length)

    def cut(seq: Column) -> Column:
        low = F.greatest(seq * length, start)
        high = F.least(seq * length + F.lit(length + extra), end)
        # In the first sample of a document that starts on a boundary this may be empty.
        size = F.greatest(high - low, F.lit(0))
        piece = F.slice(F.col("_tokens"), (low - start + 1).cast("int"), size.cast("int"))
        return F.struct(seq.alias("seq"), low.alias("at"), piece.alias("piece"))

    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]))
    pieces_of = placed.select("_bucket", F.explode(F.transform(F.sequence(first, last), cut)).alias("_p")).select("_bucket", "_p.*")
    # Rows of a range are together already.
    within = pieces_of.groupBy("_bucket", "seq").agg(F.min("at").alias("at"), joined.alias("piece"))
    full = F.size("piece") == F.lit(length + extra)
    whole = within.where(full).select("seq", F.col("piece").alias("tokens"))
    across = within.where(~full).groupBy("seq").agg(joined.alias("tokens")).where(F.size("tokens") == F.lit(length + extra))
    return whole.unionByName(across)
