"""Train one fold's tree model and save it under its fold, fold count and AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from foldmark.functions.encode import SHORT_FEATURES
from foldmark.operators.contracts import join_all
from foldmark.operators.splits import in_folds, validation_folds
from foldmark.plans.boosting import BoostParams, FittedModel, fit_fold, with_vector
from foldmark.plans.views import coefficient_features
from foldmark.schemas import ID, SampleSet
from foldmark.sinks.models import save_model

# Tree limits of the two tree models.
META_TREES = 8192
COEFFICIENT_TREES = 256


def _fit_and_save(
    table: DataFrame, fold_index: int, n_fold: int, root: str, params: BoostParams
) -> tuple[str, FittedModel]:
    marked = table.withColumn("is_val", in_folds(validation_folds(fold_index, n_fold)))
    fitted = fit_fold(marked, params)
    return save_model(PipelineModel([fitted.model]), root, fold_index, n_fold, fitted.auc), fitted


def train_fold_on_meta(
    source: SampleSet,
    fold_index: int,
    n_fold: int,
    root: str,
    features: Sequence[str] = SHORT_FEATURES,
    params: BoostParams = BoostParams(max_trees=META_TREES),
) -> tuple[str, FittedModel]:
    """Trees on the encoded columns of a sample set; returns where the model was saved, and the model."""
    return _fit_and_save(with_vector(source.df, features), fold_index, n_fold, root, params)


def train_fold_on_coefficients(
    source: SampleSet,
    images: DataFrame,
    fold_index: int,
    n_fold: int,
    root: str,
    k: int = 8,
    features: Sequence[str] = SHORT_FEATURES,
    params: BoostParams = BoostParams(max_trees=COEFFICIENT_TREES),
) -> tuple[str, FittedModel]:
    """Trees on image coefficients and encoded columns. Pixels become features before the join by id."""
    keys = [ID] if isinstance(source.roots, str) else ["dataset", ID]
    computed = coefficient_features(images, k).select(*keys, "features")
    table = with_vector(join_all(source.df, computed, keys, "no image for sample"), features, ("features",))
    return _fit_and_save(table, fold_index, n_fold, root, params)
