"""Fold models: fitting all of them, scoring with all of them, out-of-fold scores."""

from __future__ import annotations

from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.passes import mean_over_folds
from foldmark.operators.splits import check_split_count, in_folds, validation_folds
from foldmark.plans.boosting import (
    VECTOR,
    BoostParams,
    FittedModel,
    fit_fold,
    positive_probability,
    without_small_tasks,
)
from foldmark.schemas import ID
from foldmark.session import ensure_checkpoint_dir


def fit_folds(
    table: DataFrame,
    n_splits: int = 4,
    params: BoostParams = BoostParams(),
    estimator: str = "boosted_trees",
    parallelism: int = 4,
) -> dict[int, FittedModel]:
    """One model per split. ``table`` has ``fold``, ``target`` and the feature vector.

    The narrow table is cached once for all fits. The fits are independent jobs,
    submitted from ``parallelism`` driver threads so that none leaves executors idle.
    """
    check_split_count(n_splits)
    ensure_checkpoint_dir(table.sparkSession)
    narrow = table.select(VECTOR, "target", "fold").persist(StorageLevel.MEMORY_AND_DISK)

    @inheritable_thread_target(table.sparkSession)
    def fit(i: int) -> FittedModel:
        marked = rows.withColumn("is_val", in_folds(validation_folds(i, n_splits)))
        return fit_fold(marked, params, estimator, is_cached=True)

    try:
        rows = without_small_tasks(narrow)
        with ThreadPool(min(parallelism, n_splits)) as pool:
            return dict(enumerate(pool.map(fit, range(n_splits))))
    finally:
        narrow.unpersist()


def score_with_all(df: DataFrame, models: Mapping[int, Model], key: str = ID) -> DataFrame:
    """(id, fold, p) with every fold model, in one scan of the rows."""
    scored = df
    for i, model in models.items():
        scored = positive_probability(scored, model, f"_p{i}")
    cells = F.array(*[F.struct(F.lit(i).alias("fold"), F.col(f"_p{i}").alias("p")) for i in models])
    return scored.select(key, F.inline(cells))


def out_of_fold(table: DataFrame, models: Mapping[int, Model], n_splits: int, key: str = ID) -> DataFrame:
    """Each row scored by the model that did not see it.

    One filtered branch per model: on a table partitioned by fold the branches
    together read every partition once.
    """
    parts = None
    for i, model in models.items():
        rows = table.where(in_folds(validation_folds(i, n_splits)))
        part = positive_probability(rows, model).select(key, F.lit(i).alias("val_index"), "target", "p")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def cross_validate(
    train: DataFrame, test: DataFrame, n_splits: int = 4, params: BoostParams = BoostParams(), key: str = ID
) -> DataFrame:
    """(id, target): the mean of all fold models' scores of the test rows."""
    fitted = fit_folds(train, n_splits, params)
    scores = score_with_all(test, {i: f.model for i, f in fitted.items()}, key)
    return mean_over_folds(scores, key).withColumnRenamed("p", "target")
