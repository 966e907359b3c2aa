"""Columns derived for a grid of training runs, and data stages by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.numbers import (
    MICRO_BATCH_DEFAULT,
    MICRO_BATCH_TIERS,
    ColumnOrName,
    as_column,
    save_interval,
    tier_by_threshold,
    tokens_per_step,
    warmup_steps,
)
from corpusflow.operators.index import edges_at_or_below, last_values, sorted_keys
from corpusflow.session import checkpointed

# Starts up to this number are searched in place.
STAGES_IN_PLACE = 10_000


def derive_run_columns(
    grid: DataFrame,
    param_count: str = "param_count",
    compute: str = "compute",
    iterations: str = "training_iters",
    index: str = "index",
    tiers: Sequence[tuple[float, int]] = MICRO_BATCH_TIERS,
    default: int = MICRO_BATCH_DEFAULT,
) -> DataFrame:
    """Micro batch, identifier, run name and save interval of each row of the grid.

    Numbers enter the names as their Spark text; give string columns to fix another form.
    """
    named = grid.withColumn(
        "micro_batch", tier_by_threshold(F.col(param_count).cast("double"), tiers, default)
    ).withColumn(
        "identifier", F.concat(F.col(param_count).cast("string"), F.lit("M_"), F.col(compute).cast("string"))
    )
    name = F.format_string("run_%s_bs%d_idx_%d", F.col("identifier"), F.col("micro_batch"), F.col(index))
    return named.withColumn("run_name", name).withColumn("save_interval", save_interval(iterations))


def token_budget(
    grid: DataFrame,
    replicas: ColumnOrName | int,
    accumulation: ColumnOrName | int,
    micro_batch: ColumnOrName | int,
    sequence_length: ColumnOrName | int,
    steps: ColumnOrName,
) -> DataFrame:
    """Tokens of one step and of all steps."""
    per_step = tokens_per_step(replicas, accumulation, micro_batch, sequence_length)
    return grid.withColumn("step_tokens", per_step).withColumn(
        "total_tokens", F.col("step_tokens") * as_column(steps).cast("long")
    )


def derive_grid(
    grid: DataFrame, training_tokens: str = "training_tokens", batch_tokens: str = "batch_size_tokens"
) -> DataFrame:
    """Iterations (tokens over batch tokens) and warm-up steps."""
    iterations = F.floor(F.col(training_tokens) / F.col(batch_tokens)).cast("long")
    return grid.withColumn("training_iters", iterations).withColumn(
        "lr_warmup_iters", warmup_steps("training_iters")
    )


def decay_start(steps: ColumnOrName, percent: float) -> Column:
    """First step of the decay phase that takes the last ``percent`` of the steps."""
    steps = as_column(steps)
    return (steps - F.floor(steps * F.lit(percent / 100))).cast("long")


def stage_of_step(
    steps: DataFrame, stages: DataFrame, step: str = "step", start: str = "start_training_step", in_place: int = STAGES_IN_PLACE,
    **options,
) -> DataFrame:
    """Each step with the stage that started last at or before it; null before the first stage.

    Of stages that start together the last in the order of their other columns counts; a stage without a start never
    does. The starts of a few stages are searched in place, and the stage found is joined by its number. With more
    than ``in_place`` of them, stages and steps are put in one order, cut into ranges, and the last stage before each
    step is carried along, over the borders of ranges too.
    """
    others = [c for c in stages.columns if c != start]
    both = F.struct(F.col(start), *[F.col(c) for c in others])
    stages = stages.where(F.col(start).isNotNull()).groupBy(start).agg(F.max(both).alias("_stage")).select("_stage")
    stages = checkpointed(stages)
    names = [*[c for c in steps.columns], start, *others]
    if stages.count() <= in_place:
        starts = sorted_keys(stages.select(F.col("_stage")[start].alias(step)), [step])
        rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("_stage")[start]))
        numbered = F.broadcast(stages.withColumn("_number", rank))
        placed = steps.withColumn("_number", edges_at_or_below(steps, [step], starts) if starts else F.lit(0))
        return placed.join(numbered, "_number", "left").select(*steps.columns, *_fields(names, steps))
    # Steps of one number may be many: a hash tells them apart, so that ranges can be cut through them.
    own = F.struct(*[F.col(c) for c in steps.columns])
    kind = stages.schema["_stage"].dataType
    ordered = steps.select(
        F.col(step).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*steps.columns).alias("_tie"),
        own.alias("_row"), F.lit(None).cast(kind).alias("_stage"),
    ).unionByName(stages.select(
        F.col("_stage")[start].alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"),
        F.lit(None).cast(steps.select(own.alias("r")).schema["r"].dataType).alias("_row"), "_stage",
    ))
    found = last_values(ordered, ["_at", "_kind", "_tie"], "_stage", out="_last", **options).where(F.col("_kind") == 1)
    rows = found.select("_row.*", F.col("_last").alias("_stage"))
    return rows.select(*steps.columns, *_fields(names, steps))


def _fields(names: Sequence[str], steps: DataFrame) -> list[Column]:
    return [F.col("_stage")[name].alias(name) for name in names[len(steps.columns):]]
