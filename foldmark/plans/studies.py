"""File to file: measure predictions, combine them, write the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark import schemas
from foldmark.operators import ensemble
from foldmark.operators.contracts import align_models, align_predictions, to_wide
from foldmark.operators.metrics import describe, roc_auc, roc_curve
from foldmark.operators.passes import mean_of_fold_columns
from foldmark.operators.prepare import prepare_training_table
from foldmark.schemas import ID
from foldmark.session import cut_lineage
from foldmark.sinks.tables import write_csv, write_prepared, write_scored
from foldmark.sources.tables import (
    file_stem,
    read_fold_predictions,
    read_predictions,
    read_raw_tables,
    read_submission,
    read_table,
)


def _labels(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.PREDICTION)


def measure(spark: SparkSession, labels: str, predictions: str) -> float | None:
    """AUC of one prediction file; every labelled id must be predicted."""
    joined = align_predictions(
        _labels(spark, labels), read_predictions(spark, {"p": predictions}), columns=("p",), unique=True
    )
    return roc_auc(joined, "p", "target").head()["auc"]


def validate_ensemble(
    spark: SparkSession,
    labels: str,
    predictions: Sequence[str] | Mapping[str, str],
    rule: str,
    out: str,
    base: str | None = None,
    cutoffs: tuple[float, float] = ensemble.VALIDATION_CUTOFFS,
    exponent: float = 2.0,
) -> str:
    """Combine prediction files by a rule, measure, and write the scores under their AUC.

    The rule ``consensus`` takes ``base``, a prediction file that has no vote, and the cutoffs; ``power`` the exponent.
    """
    truth = _labels(spark, labels)
    long = read_predictions(spark, predictions)
    models = list(predictions) if isinstance(predictions, Mapping) else [file_stem(p) for p in predictions]
    aligned = align_models(truth, long, models)
    if rule == "consensus":
        if base is None:
            raise ValueError("the consensus rule needs a base prediction file")
        best = align_predictions(truth.select(ID), read_predictions(spark, {"base": base}), unique=True)
        scores = ensemble.consensus_ensemble(aligned, best, *cutoffs, models=models)
    elif rule == "power":
        scores = ensemble.power_mean_ensemble(aligned, exponent=exponent)
    else:
        scores = ensemble.apply_rule(rule, aligned.select(ID, "model", "p"))
    scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        labelled = truth.join(scores.select(ID, F.col("target").alias("p")), ID)
        return write_scored(scores, roc_auc(labelled, "p", "target"), out)
    finally:
        scores.unpersist()


def average_submissions(spark: SparkSession, paths: Sequence[str] | Mapping[str, str], out: str) -> None:
    write_csv(ensemble.mean_ensemble(read_predictions(spark, paths)), out)


def average_folds(spark: SparkSession, path: str, out: str, n_folds: int = 4) -> None:
    wide = read_fold_predictions(spark, path, n_folds)
    write_csv(mean_of_fold_columns(wide, [c for c in wide.columns if c != ID]), out)


def blend_submissions(spark: SparkSession, first: str, second: str, weight: float, out: str) -> None:
    write_csv(ensemble.blend_two(read_submission(spark, first), read_submission(spark, second), weight), out)


def consensus_submission(
    spark: SparkSession,
    base: str,
    paths: Sequence[str] | Mapping[str, str],
    out: str,
    cutoffs: tuple[float, float] = ensemble.SUBMISSION_CUTOFFS,
) -> None:
    best = read_predictions(spark, {"base": base})
    models = list(paths) if isinstance(paths, Mapping) else [file_stem(p) for p in paths]
    votes = read_predictions(spark, paths)
    write_csv(ensemble.consensus_ensemble(votes, best, *cutoffs, models=models), out)


def prepare_files(
    spark: SparkSession,
    tables: Mapping[str, str],
    out: str,
    denied: str | None = None,
    drop: Sequence[str] = schemas.DROPPED_COLUMNS,
    seed: int = 47,
) -> None:
    """Raw label files, by the name of their data set, to the prepared table: as CSV under ``out``, by fold under ``{out}_by_fold``.

    ``denied`` is a file whose first column lists the ids to leave out.
    """
    listed = None
    if denied is not None:
        ids = spark.read.option("header", True).csv(denied)
        listed = ids.select(F.col(ids.columns[0]).alias(ID)).distinct()
    prepared = prepare_training_table(read_raw_tables(spark, tables), listed, drop, seed)
    write_prepared(prepared.select(*schemas.PREPARED.fieldNames()), f"{out}_by_fold")
    by_fold = spark.read.parquet(f"{out}_by_fold").select(*schemas.PREPARED.fieldNames())
    write_csv(by_fold, out)


def survey_predictions(
    spark: SparkSession,
    predictions: Sequence[str] | Mapping[str, str],
    out: str,
    factors: Mapping[str, float] | None = None,
    column: str | None = None,
    n_largest: int = 30,
    n_lowest: int = 128,
) -> None:
    """Look at several models' scores side by side, each scaled by its factor: three tables under ``out``.

    ``describe`` has each model's count, mean, deviation and quartiles, ``largest`` the rows with the ``n_largest`` scores of
    model ``column`` (the last one, if none is named), ``lowest_ranks`` the ``n_lowest`` ids by mean rank.
    """
    models = list(predictions) if isinstance(predictions, Mapping) else [file_stem(p) for p in predictions]
    column = models[-1] if column is None else column
    if column not in models:
        raise ValueError(f"no model {column!r} among {', '.join(models)}")
    long = cut_lineage(ensemble.scale_scores(read_predictions(spark, predictions), factors or {m: 1.0 for m in models}))
    write_csv(describe(long, "p", ("model",)), f"{out}/describe")
    wide = to_wide(long, ID, models)
    top = ensemble.largest(wide.withColumnRenamed(column, "_picked"), "_picked", n_largest)
    write_csv(top.withColumnRenamed("_picked", column), f"{out}/largest")
    write_csv(ensemble.lowest_mean_ranks(long, n_lowest), f"{out}/lowest_ranks")


def write_roc_curve(spark: SparkSession, labels: str, predictions: str, out: str, drop_collinear: bool = True) -> None:
    """Points (fpr, tpr, threshold) of one prediction file."""
    truth = _labels(spark, labels)
    joined = align_predictions(truth, read_predictions(spark, {"p": predictions}), columns=("p",), unique=True)
    write_csv(roc_curve(joined, "p", "target", drop_collinear=drop_collinear), out)
