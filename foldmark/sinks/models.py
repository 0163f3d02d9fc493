"""Saved fold models; the name carries fold, fold count and validation AUC."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def model_name(fold_index: int, n_fold: int, auc: float | None) -> str:
    return f"fold_{fold_index}_{n_fold}_val_auc_{auc}"


def save_model(model: PipelineModel, root: str, fold_index: int, n_fold: int, auc: float | None) -> str:
    path = f"{root}/{model_name(fold_index, n_fold, auc)}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
