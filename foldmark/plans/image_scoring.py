"""Scores of images under views: by one model, by all fold models, or each image by the fold model that did not see it.

An image is decoded once and each of its views made once, whatever the number of models; the models of a worker share the
batch of views. Passes are averaged where they were made, so that one row an image leaves the worker and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.splits import in_folds, validation_folds_of
from foldmark.plans.views import Picture, Stage, list_column, pictures, pixel_columns
from foldmark.schemas import ID

# () -> ((images, meta rows or None) -> (scores, features or None)); the outer call loads the model.
ImagePredict = Callable[[np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray | None]]
MakeImagePredict = Callable[[], ImagePredict]


class Scorer:
    """Fold models over batches of views: scores as (image, model, pass), features of the passes as (image, pass, feature)."""

    def __init__(self, make_predicts: Sequence[MakeImagePredict], stages: Sequence[Stage], n_passes: int, seed: int):
        self.predicts = [make() for make in make_predicts]
        self.stages, self.n_passes, self.seed = stages, n_passes, seed

    def __call__(
        self, held: Sequence[Picture], meta: np.ndarray | None, own: np.ndarray | None
    ) -> tuple[np.ndarray, list[np.ndarray | None]]:
        scores = np.empty((len(held), len(self.predicts) if own is None else 1, self.n_passes))
        stack = [None] * self.n_passes
        # Which rows each model scores, and where its scores go.
        if own is None:
            routes = [(m, slice(None), m) for m in range(len(self.predicts))]
        else:
            if not np.isin(own, np.arange(len(self.predicts))).all():
                raise ValueError(f"an image of no fold model: {sorted(set(own.tolist()) - set(range(len(self.predicts))))}")
            routes = [(int(m), np.flatnonzero(own == m), 0) for m in np.unique(own)]
        for i in range(self.n_passes):
            views = np.stack([p.view(i, self.stages, self.seed) for p in held])
            for m, rows, place in routes:
                found, features = self.predicts[m](views[rows], None if meta is None else meta[rows])
                scores[rows, place, i] = np.asarray(found, dtype=np.float64).reshape(-1)
                if features is not None and (own is not None or m == 0):
                    if stack[i] is None:
                        stack[i] = np.zeros((len(held), *features.shape[1:]), np.float32)
                    stack[i][rows] = features
        return scores, stack


def _slices(
    batches: Iterator[pa.RecordBatch], scorer: Scorer, meta: str | None, own: str | None, batch_size: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray | None]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, batch_size):
            part = batch.slice(start, batch_size)
            extra = np.stack([np.asarray(m, dtype=np.float32) for m in part.column(meta).to_pylist()]) if meta else None
            index = np.array([-1 if i is None else i for i in part.column(own).to_pylist()], "i8") if own else None
            yield part, *scorer(list(pictures(part)), extra, index)


def _columns(images: DataFrame, *more: str | None) -> list[str]:
    return [*pixel_columns(images), *[c for c in more if c]]


def score_image_views(
    images: DataFrame,
    stages: Sequence[Stage],
    make_predict: MakeImagePredict,
    n_passes: int = 5,
    seed: int = 47,
    meta: str | None = None,
    batch_size: int = 16,
) -> DataFrame:
    """(dataset, id, tta_index, p, features), a row per view; views are made and scored in one task and never leave it.

    ``meta`` names an array column of row features to hand to the predictor.
    """
    stages = list(stages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer([make_predict], stages, n_passes, seed)
        for part, scores, stack in _slices(batches, scorer, meta, None, batch_size):
            for i in range(n_passes):
                features = pa.nulls(part.num_rows, pa.list_(pa.float32()))
                if stack[i] is not None:
                    features = list_column(list(stack[i].reshape(part.num_rows, -1)), pa.float32())
                index = pa.array(np.full(part.num_rows, i, "i4"))
                columns = [part.column("dataset"), part.column(ID), index, pa.array(scores[:, 0, i]), features]
                yield pa.RecordBatch.from_arrays(columns, names=["dataset", ID, "tta_index", "p", "features"])

    schema = f"dataset string, {ID} string, tta_index int, p double, features array<float>"
    return images.select(*_columns(images, meta)).mapInArrow(run, schema)


def image_scores(
    images: DataFrame,
    stages: Sequence[Stage],
    make_predicts: Sequence[MakeImagePredict],
    n_passes: int = 5,
    seed: int = 47,
    meta: str | None = None,
    own: str | None = None,
    batch_size: int = 16,
) -> DataFrame:
    """(dataset, id, scores, stack): a row per image, in one scan of the images and one crossing into Python.

    ``scores`` has the mean over passes for each model; with ``own``, a column that holds each row's model, just that one's.
    ``stack`` has the features of every pass, of the own model or of the first one.
    """
    stages, make_predicts = list(stages), list(make_predicts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(make_predicts, stages, n_passes, seed)
        for part, scores, stack in _slices(batches, scorer, meta, own, batch_size):
            n = part.num_rows
            features = pa.nulls(n, pa.list_(pa.list_(pa.float32())))
            if all(s is not None for s in stack):
                cube = np.stack([s.reshape(n, -1) for s in stack], axis=1)
                inner = list_column(list(cube.reshape(n * n_passes, -1)), pa.float32())
                features = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * n_passes), inner)
            means = list_column(list(scores.mean(axis=2)), pa.float64())
            columns = [part.column("dataset"), part.column(ID), means, features]
            if own:
                columns.append(part.column(own).cast(pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=["dataset", ID, "scores", "stack", *([own] if own else [])])

    schema = f"dataset string, {ID} string, scores array<double>, stack array<array<float>>" + (f", {own} int" if own else "")
    return images.select(*_columns(images, meta, own)).mapInArrow(run, schema)


def score_all_folds(images: DataFrame, stages: Sequence[Stage], make_predicts: Sequence[MakeImagePredict], **options) -> DataFrame:
    """(dataset, id, fold, p): the mean over passes by every fold model."""
    scored = image_scores(images, stages, make_predicts, **options)
    return scored.select("dataset", ID, F.posexplode("scores").alias("fold", "p"))


def score_own_fold(
    images: DataFrame, stages: Sequence[Stage], make_predicts: Sequence[MakeImagePredict], own: str = "val_index", **options
) -> DataFrame:
    """(dataset, id, val_index, p, stack): the mean over passes by the one model that did not see the image, and its features."""
    scored = image_scores(images, stages, make_predicts, own=own, **options)
    return scored.select("dataset", ID, own, F.get("scores", F.lit(0)).alias("p"), "stack")


def mean_of_folds(images: DataFrame, stages: Sequence[Stage], make_predicts: Sequence[MakeImagePredict], **options) -> DataFrame:
    """(dataset, id, p): the mean over passes, then over fold models."""
    scored = image_scores(images, stages, make_predicts, **options)
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    return scored.select("dataset", ID, (total / F.size("scores")).alias("p"))


#: (training rows, validation rows, split) -> a predictor; trains as it likes, with Spark or beside it.
Fit = Callable[[DataFrame, DataFrame, int], MakeImagePredict]


def fit_predictors(train: DataFrame, fit: Fit, n_splits: int = 4, parallelism: int = 4) -> list[MakeImagePredict]:
    """The predictors of all splits of a table with ``fold``, each fitted on the rows it will not be asked about."""

    @inheritable_thread_target(train.sparkSession)
    def one(i: int) -> MakeImagePredict:
        held_out = in_folds(validation_folds_of(i, n_splits))
        return fit(train.where(~held_out), train.where(held_out), i)

    with ThreadPool(min(parallelism, n_splits)) as pool:
        return pool.map(one, range(n_splits))


def cross_validate_images(
    train: DataFrame,
    images: DataFrame,
    fit: Fit,
    stages: Sequence[Stage],
    n_splits: int = 4,
    parallelism: int = 4,
    **options,
) -> DataFrame:
    """(dataset, id, target): a user's predictor fitted per split, and its scores of the images, averaged over passes and splits.

    Any number of splits from 2 to the number of stored folds; passes and splits meet in the task that holds the image.
    """
    predictors = fit_predictors(train, fit, n_splits, parallelism)
    return mean_of_folds(images, stages, predictors, **options).withColumnRenamed("p", "target")
