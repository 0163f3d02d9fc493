"""Averages over repeated scorings and folds, and per-row stacks of what the passes produced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.contracts import fail_if, to_long
from foldmark.schemas import ID


def mean_over_passes(df: DataFrame, key: str | Sequence[str] = ID, fold: str = "fold", score: str = "p") -> DataFrame:
    """(id, fold, mean score). Averages combine on the map side, so a hot id shuffles one row per task."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys, fold).agg(F.avg(score).alias(score))


def mean_over_folds(df: DataFrame, key: str = ID, score: str = "p") -> DataFrame:
    """Mean of one score per (id, fold); nulls are skipped."""
    return df.groupBy(key).agg(F.avg(score).alias(score))


def mean_of_passes_and_folds(df: DataFrame, key: str = ID, fold: str = "fold", score: str = "p") -> DataFrame:
    """Mean of fold means, so folds weigh the same whatever their pass counts."""
    return mean_over_folds(mean_over_passes(df, key, fold, score), key, score)


def mean_of_fold_columns(wide: DataFrame, columns: Sequence[str], key: str = ID) -> DataFrame:
    """Row mean over wide fold columns, nulls skipped; row-local, so nothing is shuffled."""
    scores = [F.col(f"`{c}`") for c in columns]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in scores[1:]), F.coalesce(scores[0], F.lit(0.0)))
    present = sum((s.isNotNull().cast("int") for s in scores[1:]), scores[0].isNotNull().cast("int"))
    return wide.select(key, F.try_divide(total, present).alias("target"))


def fold_columns_to_rows(wide: DataFrame, columns: Sequence[str], key: str = ID) -> DataFrame:
    """(id, fold, p) from columns named ``0..`` or ``fold-0..``."""
    long = to_long(wide, key, columns, name="fold")
    return long.withColumn("fold", F.regexp_extract("fold", r"(\d+)$", 1).cast("int"))


def stack_features(
    df: DataFrame, n_passes: int, key: str = ID, tta_index: str = "tta_index", features: str = "features"
) -> DataFrame:
    """``array<array<float>>`` per id in pass order.

    One slot per pass instead of a collected list: the state of a group has a
    fixed size and combines on the map side whatever the number of rows. A pass
    outside 0 to n_passes - 1 and a pass given twice are errors; a missing one is null.
    """
    of = [F.col(tta_index) == i for i in range(n_passes)]
    inside = F.coalesce(F.col(tta_index).between(0, n_passes - 1), F.lit(False))
    slots = [F.max(F.when(c, F.col(features))).alias(f"_{i}") for i, c in enumerate(of)]
    most = F.greatest(*[F.count(F.when(c, 1)) for c in of], F.lit(0))
    checks = [F.count(F.when(~inside, 1)).alias("_outside"), most.alias("_most")]
    stack = F.array(*[f"_{i}" for i in range(n_passes)])
    stack = fail_if(F.col("_most") > 1, "a pass occurs twice for id", key, stack)
    stack = fail_if(F.col("_outside") > 0, f"a pass beyond the {n_passes} for id", key, stack)
    return df.groupBy(key).agg(*slots, *checks).select(key, stack.alias(features))
