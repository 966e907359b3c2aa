"""Generated solutions and chats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.numbers import div, pass_at_k
from corpusflow.functions.text import STOP_STRINGS, clean_all, let, render_messages, starts_with_prompt
from corpusflow.operators.index import global_index

TURNS_PER_BLOCK = 1_000


def align_by_position(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], **options
) -> DataFrame:
    """Row ``i`` of ``left`` with row ``i`` of ``right``, which may have rows to spare.

    Raises where ``right`` is the shorter one.
    """
    n_left, n_right = left.count(), right.count()
    if n_left > n_right:
        raise IndexError(f"{n_left} rows have only {n_right} partners")
    a = global_index(left, left_order, out="position", rows=n_left, **options)
    b = global_index(right, right_order, out="position", rows=n_right, **options)
    return a.join(b, "position")


def clean_solutions(
    problems: DataFrame,
    generations: str = "completion",
    prompt: str = "prompt",
    stops: Sequence[str] = STOP_STRINGS,
    out: str = "solutions",
) -> DataFrame:
    """Cleaned generations of each problem, and how many did not start with the prompt."""
    strange = let(
        F.col(prompt),
        lambda p: F.size(F.filter(F.col(generations), lambda g: ~starts_with_prompt(g, p))),
    )
    return problems.withColumn(out, clean_all(generations, prompt, stops)).withColumn(
        "mismatches", strange.cast("long")
    )


def nest(
    rows: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    out: str = "items",
    block_size: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """(keys, items): the values of each key in order of ``position``, one row per key.

    Values are gathered by blocks of positions first, so that a long key is sorted in pieces, and the
    blocks of a key then join in order. Positions are whole numbers; null ones come last.
    """
    block = div(F.col(position).cast("long"), block_size)
    # The flag puts null positions behind all others.
    listed = F.array_sort(
        F.collect_list(F.struct(F.col(position).isNull().alias("_last"), F.col(position).alias("_p"), value.alias("_v")))
    )
    gathered = (
        rows.withColumn("_block", block)
        .groupBy(*keys, "_block")
        .agg(F.transform(listed, lambda r: r["_v"]).alias("_items"))
    )
    blocks = F.array_sort(
        F.collect_list(F.struct(F.col("_block").isNull().alias("_last"), F.col("_block"), F.col("_items")))
    )
    return gathered.groupBy(*keys).agg(F.flatten(F.transform(blocks, lambda b: b["_items"])).alias(out))


def render_chat(
    turns: DataFrame,
    keys: Sequence[str],
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    preamble: str | None = None,
    block_size: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """(keys, prompt): the chat of each key as one string.

    It opens with the start mark, and its first turn holds the preamble, whatever that turn's number.
    """
    said = F.struct(F.col(role).alias("role"), F.col(text).alias("text"))
    nested = nest(turns, keys, turn, said, "_messages", block_size)
    return nested.select(*keys, render_messages("_messages", preamble).alias("prompt"))


def pass_rates(
    results: DataFrame, problem: Sequence[str], passed: Column, ks: Sequence[int] = (1,), by: Sequence[str] = ()
) -> DataFrame:
    """Mean pass@k over problems (per language), from one row per tried sample."""
    per_problem = results.groupBy(*by, *problem).agg(
        F.count("*").alias("_n"), F.sum(passed.cast("long")).alias("_c")
    )
    means = [F.avg(pass_at_k("_n", "_c", k)).alias(f"pass_at_{k}") for k in ks]
    return per_problem.groupBy(*by).agg(F.count("*").alias("problems"), *means)
