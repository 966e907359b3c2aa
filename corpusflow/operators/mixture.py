"""Shard sizes, source weights and mixtures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.numbers import ColumnOrName, as_column, div, round_half_even, seeded_digest
from corpusflow.functions.text import fill_template
from corpusflow.operators.index import global_index, prefix_sums
from corpusflow.operators.rows import expand_shards
from corpusflow.operators.selection import kth_keys
from corpusflow.operators.sizing import fits, lookup
from corpusflow.session import checkpointed

# Weights set by hand, for the large and for the small mixture.
OVERRIDES_LARGE = {"ir_python": 1.0, "ir_cpp": 1.0, "ir_rust": 1.0, "ir_low_resource": 3.0}
OVERRIDES_SMALL = {
    "wikipedia": 0.0, "lhq_data": 1.0, "arxiv": 0.0,
    "ir_python": 1.0, "ir_cpp": 1.0, "ir_rust": 1.0, "ir_low_resource": 3.0,
}

# Fixed value: file of tokens within a shard folder.
DOCUMENT_FILE = "gpt2-preprocessed_content_document"

BYTES_PER_TOKEN = 2
MANIFEST_ROWS = 100_000


def shard_size(
    df: DataFrame,
    tokens: Column,
    by: Sequence[str] = ("source", "shard"),
    bytes_per_token: int = BYTES_PER_TOKEN,
    unit: float = 1e9,
) -> DataFrame:
    """Bytes per shard and tokens in ``unit`` (billions), rounded to two digits.

    Two bytes hold a token of a vocabulary up to 65,536; say 4 for a larger one.
    """
    sizes = df.groupBy(*by).agg(
        (F.coalesce(F.sum(tokens.cast("long")), F.lit(0)) * F.lit(bytes_per_token)).cast("long").alias("bytes")
    )
    billions = F.col("bytes") / F.lit(float(bytes_per_token) * unit)
    return sizes.withColumn("weight", round_half_even(billions))


def listed_shard_sizes(
    files: DataFrame,
    sources: DataFrame,
    n_shards: ColumnOrName = "n_shards",
    layout: str = "{source}/{source}_{shard}",
    suffix: str = ".bin",
    bytes_per_token: int = BYTES_PER_TOKEN,
    unit: float = 1e9,
) -> DataFrame:
    """(source, shard, bytes, weight) from a listing (path, bytes), without reading a file.

    Shards 0 to ``n_shards - 1`` of each source lie in folders named by ``layout``; the first file there by name that
    ends with ``suffix`` counts. A shard without one has 0 bytes. Weights are tokens in ``unit``, rounded to two digits.
    """
    folder = r"((?:[^/]+/){" + str(layout.count("/")) + r"}[^/]+)/[^/]+$"
    there = files.where(F.endswith(F.col("path"), F.lit(suffix))).groupBy(
        F.regexp_extract("path", folder, 1).alias("_folder")
    ).agg(F.min_by("bytes", "path").alias("_bytes"))
    expected = expand_shards(sources, n_shards).select("source", "shard")
    named = expected.withColumn("_folder", fill_template(layout, source="source", shard=F.col("shard").cast("string")))
    size = F.coalesce("_bytes", F.lit(0)).cast("long")
    weight = round_half_even(size / F.lit(float(bytes_per_token) * unit))
    return named.join(there, "_folder", "left").select("source", "shard", size.alias("bytes"), weight.alias("weight"))


def source_stats(
    shards: DataFrame,
    expected: DataFrame | None = None,
    used: DataFrame | None = None,
    bytes_per_token: int = BYTES_PER_TOKEN,
    unit: float = 1e9,
) -> DataFrame:
    """Per source: shards, size, tokens, mean and deviation of shard sizes, first shard's size.

    ``expected`` (source, expected_tokens) adds the difference to the actual total, ``used``
    (source, used_tokens) replaces the tokens used where it is given.
    """
    gb = F.col("bytes") / F.lit(unit)
    tokens = F.col("bytes") / F.lit(bytes_per_token * unit)
    stats = shards.groupBy("source").agg(
        F.count("*").alias("n_shards"),
        F.sum(gb).alias("total_size"),
        F.sum(tokens).alias("total_tokens"),
        F.avg(tokens).alias("avg_tokens_per_shard"),
        F.stddev_pop(gb).alias("std_shard_size"),
        F.avg(gb).alias("avg_shard_size"),
        F.min_by(gb, "shard").alias("first_shard_size"),
    )
    if used is not None:
        stats = lookup(stats, used, ["source"], "left")
        stats = stats.withColumn("used_tokens", F.coalesce("used_tokens", "total_tokens"))
    else:
        stats = stats.withColumn("used_tokens", F.col("total_tokens"))
    if expected is not None:
        stats = lookup(stats, expected, ["source"], "left").withColumn(
            "difference", F.abs(F.col("expected_tokens") - F.col("total_tokens"))
        )
    return stats


def apply_overrides(
    weights: DataFrame, overrides: Mapping[str, float] | DataFrame, key: str = "source", out: str = "override"
) -> DataFrame:
    """Add the override of each source, null where there is none.

    A mapping becomes a literal, looked up in place; a table (key, override) is joined.
    """
    if isinstance(overrides, DataFrame):
        return lookup(weights, overrides, [key], "left")
    if not overrides:
        return weights.withColumn(out, F.lit(None).cast("double"))
    entries = [F.lit(x) for name, value in overrides.items() for x in (name, float(value))]
    return weights.withColumn(out, F.try_element_at(F.create_map(*entries), F.col(key)))


def weights_override_first_shard(
    shards: DataFrame, overrides: Mapping[str, float] | DataFrame, first: int = 0
) -> DataFrame:
    """One entry per shard with its size as weight; an overridden source has its first shard only."""
    marked = apply_overrides(shards, overrides)
    return (
        marked.where(F.col("override").isNull() | (F.col("shard") == first))
        .withColumn("weight", F.coalesce("override", "weight"))
        .drop("override")
    )


def weights_override_scaled(
    shards: DataFrame, overrides: Mapping[str, float] | DataFrame
) -> DataFrame:
    """Overridden sources share their override over the shards by size; an override of 0 drops them.

    The total is that of the rounded shard sizes. A source whose sizes round to nothing has null
    weights.
    """
    marked = apply_overrides(shards, overrides).where(F.col("override").isNull() | (F.col("override") != 0))
    total = F.sum("weight").over(Window.partitionBy("source"))
    ratio = F.try_divide(F.col("override"), total)
    scaled = round_half_even(F.col("weight") * ratio)
    return marked.withColumn(
        "weight", F.when(F.col("override").isNull(), F.col("weight")).otherwise(scaled)
    ).drop("override")


def normalize_weights(weights: DataFrame, weight: str = "weight", out: str = "share") -> DataFrame:
    """Weights as shares of their sum."""
    total = weights.agg(F.sum(weight)).scalar()
    return weights.withColumn(out, F.try_divide(F.col(weight).cast("double"), total))


def quotas(weights: DataFrame, n: int, key: str = "source", weight: str = "weight") -> DataFrame:
    """(key, quota) with sum ``n`` by largest remainder, ties by name; a null or negative weight counts 0."""
    least = F.greatest(F.coalesce(F.col(weight), F.lit(0)), F.lit(0)).alias(weight)
    shared = normalize_weights(weights.select(key, least), weight, "_share")
    exact = shared.withColumn("_exact", F.col("_share") * F.lit(n)).withColumn(
        "_floor", F.floor("_exact").cast("long")
    )
    ranked = global_index(
        exact.withColumn("_rest", -(F.col("_exact") - F.col("_floor"))), ["_rest", key], out="_rank"
    )
    left = exact.agg(F.lit(n) - F.sum("_floor")).scalar()
    one_more = F.when(F.col("_rank") < left, 1).otherwise(0)
    return ranked.select(key, (F.col("_floor") + one_more).alias("quota"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    n: int,
    seed: int,
    ids: Sequence[str],
    key: str = "source",
    weight: str = "weight",
    out: str = "copy",
    **options,
) -> DataFrame:
    """``n`` rows in proportion to the weights of their sources, drawn in a seeded order.

    A source with a quota above its size is repeated whole and then once more in part; ``copy``
    counts the repeats. Sources without a positive weight, or without documents, give nothing and
    leave their share to the others; if none is left, the call raises.

    The digest at which the draw of each source ends is selected by counting, so that only drawn rows are ranked
    and moved.
    """
    sizes = checkpointed(docs.groupBy(key).agg(F.count("*").alias("_size")))
    usable = checkpointed(weights.where(F.col(weight) > 0).join(sizes, key, "left_semi"))
    if n > 0 and usable.isEmpty():
        raise ValueError("no source has both documents and a positive weight")
    sizes = checkpointed(sizes.join(quotas(usable, n, key, weight), key).where(F.col("quota") > 0))
    digest = seeded_digest(seed, *ids)
    # Sources that are not drawn whole end at the digest of their last row.
    part = sizes.where(F.col("quota") < F.col("_size")).select(key, F.col("quota").alias("_last"))
    keys = checkpointed(lookup(docs.select(key, digest.alias("_end")), part.select(key), [key]))
    ends = kth_keys(keys, part, [key], key="_end", k="_last").select(key, "_end")
    limits = checkpointed(sizes.join(ends, key, "left"))
    drawn = lookup(docs, limits, [key]).withColumn("_digest", digest)
    drawn = drawn.where(F.col("_end").isNull() | (F.col("_digest") <= F.col("_end"))).drop("_end")
    ranked = prefix_sums(drawn, ["_digest", *ids], partition=[key], out="_rank", **options)
    whole = div("quota", "_size")
    copies = whole + F.when(F.col("_rank") < F.col("quota") % F.col("_size"), 1).otherwise(0)
    return (
        ranked.withColumn("_copies", copies.cast("long"))
        .where(F.col("_copies") > 0)
        .withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .select(*docs.columns, out, (F.col(out) * F.col("_size") + F.col("_rank")).alias("place"))
    )


def interleave(
    mixed: DataFrame,
    shares: DataFrame,
    key: str = "source",
    place: str = "place",
    share: str = "share",
    out: str = "position",
    **options,
) -> DataFrame:
    """Blend order in which every prefix follows the shares.

    Row ``k`` of a source stands at ``(k + 0.5) / share``; equal places are ordered by source. Rows of
    a source without a positive share come after all others.
    """
    known = lookup(mixed, checkpointed(shares.select(key, F.col(share).alias("_share"))), [key], "left")
    at = F.try_divide(F.col(place) + F.lit(0.5), F.col("_share"))
    placed = known.withColumn("_at", F.when(F.col("_share") > 0, at).otherwise(F.lit(float("inf"))))
    return global_index(placed, ["_at", key, place], out=out, **options).drop("_at", "_share")


def epochs(
    weights: DataFrame, sizes: DataFrame, budget: float, key: str = "source", share: str = "share", tokens: str = "tokens"
) -> DataFrame:
    """How often each source is seen: its share of the token budget over its tokens."""
    return weights.join(sizes, key).withColumn(
        "epochs", F.try_divide(F.col(share) * F.lit(float(budget)), F.col(tokens))
    )


def manifest_path(
    base: str,
    source: ColumnOrName,
    shard: ColumnOrName,
    other_bases: Mapping[str, str] | None = None,
    file: str = DOCUMENT_FILE,
) -> Column:
    """``{base}/{source}/{source}_{shard}/{file}``, with another base for some sources."""
    source, shard = as_column(source), as_column(shard)
    root = F.lit(base)
    for name, other in (other_bases or {}).items():
        root = F.when(source == name, F.lit(other)).otherwise(root)
    folder = F.concat_ws("_", source, shard.cast("string"))
    return F.concat_ws("/", root, source, folder, F.lit(file))


def format_weight(weight: ColumnOrName) -> Column:
    """Two decimals; ties are settled before the text is made."""
    return F.format_string("%.2f", round_half_even(weight))


def manifest_lines(weights: DataFrame, order: Sequence[str], **options) -> DataFrame:
    """(line, text): two list items per entry, weight and path, as YAML."""
    placed = global_index(weights, order, out="_ord", **options)
    items = F.array(
        F.struct((F.col("_ord") * 2).alias("line"), F.concat(F.lit("- "), format_weight("weight")).alias("text")),
        F.struct((F.col("_ord") * 2 + 1).alias("line"), F.concat(F.lit("- "), F.col("path")).alias("text")),
    )
    return placed.select(F.explode(items).alias("_i")).select("_i.*")


def render_manifest(weights: DataFrame, order: Sequence[str], max_rows: int = MANIFEST_ROWS) -> DataFrame:
    """One row ``w path w path …``. Raises for more entries than one line should hold."""
    if not fits(weights.select("path", "weight"), max_rows):
        raise ValueError(f"more than {max_rows} entries; write manifest_lines instead")
    entry = F.concat_ws(" ", format_weight("weight"), F.col("path"))
    rows = F.array_sort(F.collect_list(F.struct(*order, entry.alias("_text"))))
    return weights.agg(F.array_join(F.transform(rows, lambda r: r["_text"]), " ").alias("manifest"))

