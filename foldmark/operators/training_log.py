"""Selections over the table of per-epoch validation metrics (run, epoch, val_auc)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmark.operators.ordering import pack_group

EPOCHS_PER_CHUNK = 1 << 20


def best_checkpoint(
    log: DataFrame, run: Sequence[str] = ("run",), epoch: str = "epoch", metric: str = "val_auc"
) -> DataFrame:
    """The epoch with the best metric per run, the earliest on ties."""
    best = F.max(F.when(F.col(metric).isNotNull(), F.struct(F.col(metric), (-F.col(epoch)).alias("_back"))))
    return (
        log.groupBy(*run)
        .agg(best.alias("_best"))
        .select(*run, (-F.col("_best._back")).alias("best_epoch"), F.col(f"_best.{metric}").alias(f"best_{metric}"))
    )


def early_stop(
    log: DataFrame,
    patience: int,
    run: Sequence[str] = ("run",),
    epoch: str = "epoch",
    metric: str = "val_auc",
    epochs_per_chunk: int = EPOCHS_PER_CHUNK,
) -> DataFrame:
    """First epoch that lies ``patience`` epochs past the best so far, and that best.

    ``epoch`` counts 0, 1, 2, ... within a run. The running best is a prefix
    maximum of (metric, earliest epoch): kept per chunk of epochs and carried from
    chunk to chunk, so one very long run is not one task. A run that is never
    stopped has a null stop epoch and its overall best.
    """
    packed, outer = pack_group(log, run)
    keys = ["_chunk", *outer]
    rows = packed.select(
        *outer,
        F.col(epoch),
        F.floor(F.col(epoch) / epochs_per_chunk).alias("_chunk"),
        F.when(
            F.col(metric).isNotNull(), F.struct(F.col(metric), (-F.col(epoch)).alias("_back"))
        ).alias("_point"),
    )
    earlier = Window.partitionBy(*outer).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys)
        .agg(F.max("_point").alias("_top"))
        .select(*keys, F.max("_top").over(earlier).alias("_carried"))
    )
    inside = Window.partitionBy(*keys).orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("_running", F.max("_point").over(inside))
    best = running.join(carried, keys).withColumn("_best", F.greatest("_running", "_carried"))
    # Until a metric exists, waiting counts from the start of the run.
    waited = F.col(epoch) - F.coalesce(-F.col("_best._back"), F.lit(-1))
    stopped = waited >= patience
    # Earliest stop wins; the struct's second field is the best known at that epoch.
    return (
        best.groupBy(*outer)
        .agg(
            F.min(F.when(stopped, F.struct(F.col(epoch).alias("stop"), F.col("_best").alias("best")))).alias("_stop"),
            F.max("_best").alias("_overall"),
        )
        .select(
            *[F.col(f"{outer[0]}.{r}").alias(r) for r in run],
            F.col("_stop.stop").alias("stop_epoch"),
            F.coalesce(-F.col("_stop.best._back"), -F.col("_overall._back")).alias("best_epoch"),
            F.coalesce(F.col(f"_stop.best.{metric}"), F.col(f"_overall.{metric}")).alias(f"best_{metric}"),
        )
    )
