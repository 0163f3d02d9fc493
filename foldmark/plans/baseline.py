"""The whole path in one call: split, train, score, fill the submission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from foldmark.functions.encode import SHORT_FEATURES, encode_features
from foldmark.operators.splits import in_folds
from foldmark.plans.boosting import BoostParams, fit_fold, positive_probability, with_vector
from foldmark.schemas import ID
from foldmark.sinks.tables import fill_submission


def run_baseline(
    train: DataFrame,
    test: DataFrame,
    template: DataFrame,
    val_folds: Sequence[int] = (0, 1),
    features: Sequence[str] = SHORT_FEATURES,
    params: BoostParams = BoostParams(),
) -> tuple[DataFrame, float | None]:
    """Submission table and validation AUC of one model trained outside ``val_folds``."""
    table = with_vector(encode_features(train), features).withColumn("is_val", in_folds(val_folds))
    fitted = fit_fold(table, params)
    scores = positive_probability(with_vector(encode_features(test), features), fitted.model).select(ID, "p")
    return fill_submission(template, scores.withColumnRenamed("p", "target")), fitted.auc
