"""Arithmetic on columns: rounding, tiers, budgets, stable hashes of ids."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: ColumnOrName, b: ColumnOrName | int) -> Column:
    """Whole-number quotient of two long columns, exact for any size."""
    b = F.lit(b) if isinstance(b, int) else as_column(b)
    return F.call_function("div", as_column(a), b)


def round_half_even(x: ColumnOrName, digits: int = 2) -> Column:
    """Round by multiply, ``rint``, divide, which sends binary ties to the even digit."""
    scale = float(10**digits)
    return F.rint(as_column(x) * F.lit(scale)) / F.lit(scale)


def tier_by_threshold(
    x: ColumnOrName, tiers: Sequence[tuple[float, int]], default: int
) -> Column:
    """Value of the first tier ``(threshold, value)`` with ``x > threshold``, else ``default``."""
    x = as_column(x)
    if not tiers:
        return F.lit(default)
    (threshold, value), rest = tiers[0], tiers[1:]
    chain = F.when(x > F.lit(threshold), F.lit(value))
    for threshold, value in rest:
        chain = chain.when(x > F.lit(threshold), F.lit(value))
    return chain.otherwise(F.lit(default))


# Micro batch size by parameter count in millions, large to small.
MICRO_BATCH_TIERS = [(2000, 4), (1000, 8), (210, 16), (50, 32)]
MICRO_BATCH_DEFAULT = 64
# The variant for several nodes has no tier above 50.
MICRO_BATCH_TIERS_NODES = [(2000, 4), (1000, 8), (210, 16)]
MICRO_BATCH_DEFAULT_NODES = 32


def save_interval(iterations: ColumnOrName) -> Column:
    """About five checkpoints per run, on multiples of 1000, at least 1000."""
    thousands = F.rint(div(iterations, 5) / F.lit(1000.0))
    return (F.greatest(thousands, F.lit(1.0)) * F.lit(1000)).cast("long")


def warmup_steps(iterations: ColumnOrName) -> Column:
    """A tenth of the iterations, at most 1000."""
    return F.least(F.lit(1000), div(iterations, 10)).cast("long")


def tokens_per_step(replicas, accumulation, micro_batch, sequence_length) -> Column:
    """Tokens that one optimizer step consumes."""
    factors = (replicas, accumulation, micro_batch, sequence_length)
    product = F.lit(1).cast("long")
    for factor in factors:
        product = product * (
            F.lit(factor) if isinstance(factor, int) else as_column(factor)
        ).cast("long")
    return product


def hex_to_long(digest: Column, first: int = 1, digits: int = 15) -> Column:
    """``digits`` (at most 15) hex digits of a digest as a non-negative long."""
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")


def seeded_digest(seed: int | str, *ids: ColumnOrName) -> Column:
    """md5 of ``seed:id[:id…]``: a random order that no re-partitioning or retry changes."""
    parts = [F.lit(str(seed))] + [as_column(i).cast("string") for i in ids]
    return F.md5(F.concat_ws(":", *parts))


def unit_interval(digest: Column) -> Column:
    """The first 32 bits of a digest as a double in [0, 1)."""
    return hex_to_long(digest, 1, 8) / F.lit(float(2**32))


def digest_below(digest: Column, rate: float) -> Column:
    """``unit_interval(digest) < rate``, by comparing hex digits as text."""
    if rate >= 1:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(f"{max(0, math.ceil(rate * 2**32)):08x}")


def pass_at_k(n: ColumnOrName, c: ColumnOrName, k: int) -> Column:
    """Unbiased pass@k for ``c`` passes in ``n`` samples: 1 - prod((n-c-i)/(n-i), i < k).

    With fewer than ``k`` failures every draw of ``k`` holds a pass (1.0); with fewer than ``k``
    samples the estimator is undefined (null).
    """
    n, c = as_column(n), as_column(c)
    failing = F.lit(1.0)
    for i in range(k):
        failing = failing * (n - c - F.lit(i)) / F.greatest(n - F.lit(i), F.lit(1))
    return F.when(n < k, F.lit(None).cast("double")).when(n - c < k, F.lit(1.0)).otherwise(
        F.lit(1.0) - failing
    )
