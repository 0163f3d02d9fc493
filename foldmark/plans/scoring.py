"""Batch scoring with a user's predictor, loaded once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.operators.contracts import align_predictions
from foldmark.operators.passes import mean_over_passes
from foldmark.schemas import ID

# () -> (batch of feature rows -> (scores, features or None)); the outer call loads the model.
MakePredict = Callable[[], Callable[[np.ndarray], tuple[np.ndarray, np.ndarray | None]]]

SCORED = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("features", T.ArrayType(T.FloatType()))]
)


def batch_scorer(make_predict: MakePredict, width: int, batch_size: int = 1024) -> Callable[[Column], Column]:
    """Column function: feature array -> struct(score, features)."""

    def make_fn():
        predict = make_predict()

        def run(batch: np.ndarray) -> dict[str, np.ndarray]:
            scores, features = predict(batch)
            if features is None:
                features = np.empty((len(batch), 0), dtype=np.float32)
            return {"score": np.asarray(scores, dtype=np.float64).reshape(-1), "features": features}

        return run

    return predict_batch_udf(make_fn, return_type=SCORED, batch_size=batch_size, input_tensor_shapes=[[width]])


def all_models_scorer(
    make_predicts: Sequence[MakePredict], width: int, batch_size: int = 1024
) -> Callable[[Column], Column]:
    """Column function: feature array -> one score per model; all models share one scan and one Arrow transfer."""

    def make_fn():
        predicts = [make() for make in make_predicts]

        def run(batch: np.ndarray) -> np.ndarray:
            return np.stack([np.asarray(p(batch)[0], dtype=np.float64).reshape(-1) for p in predicts], axis=1)

        return run

    return predict_batch_udf(
        make_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[width]]
    )


def score_with_models(
    df: DataFrame, make_predicts: Sequence[MakePredict], width: int, key: str = ID, features: str = "features"
) -> DataFrame:
    """(id, fold, p) with every fold model."""
    scorer = all_models_scorer(make_predicts, width)
    return df.select(key, F.posexplode(scorer(F.col(features))).alias("fold", "p"))


def score_own_fold(
    df: DataFrame,
    make_predicts: Sequence[MakePredict],
    width: int,
    key: str = ID,
    features: str = "features",
    index: str = "val_index",
    batch_size: int = 1024,
) -> DataFrame:
    """(id, val_index, p): each row by the one model that did not see it.

    Workers hold all fold models, a handful; a batch is split by model, so every
    row is scored once and the table is read once.
    """

    def make_fn():
        predicts = [make() for make in make_predicts]

        def run(batch: np.ndarray, indexes: np.ndarray) -> np.ndarray:
            scores = np.full(len(batch), np.nan)
            for i in np.unique(indexes):
                mine = indexes == i
                scores[mine] = np.asarray(predicts[int(i)](batch[mine])[0], dtype=np.float64).reshape(-1)
            return scores

        return run

    scorer = predict_batch_udf(
        make_fn, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[width], None]
    )
    return df.select(key, index, scorer(F.col(features), F.col(index)).alias("p"))


def score_views(
    df: DataFrame,
    n_passes: int,
    view: Callable[[Column, Column, Column], Column],
    scorer: Callable[[Column], Column],
    key: str = ID,
    features: str = "features",
) -> DataFrame:
    """(id, tta_index, p, features) of every row under ``n_passes`` views of its feature array.

    ``view(features, id, tta_index)`` must be a function of its arguments alone.
    """
    passes = df.withColumn("tta_index", F.explode(F.sequence(F.lit(0), F.lit(n_passes - 1))))
    viewed = passes.select(key, "tta_index", view(F.col(features), F.col(key), F.col("tta_index")).alias("_view"))
    scored = viewed.select(key, "tta_index", scorer(F.col("_view")).alias("_scored"))
    return scored.select(key, "tta_index", F.col("_scored.score").alias("p"), "_scored.features")


def views_in_row(
    df: DataFrame, n_passes: int, view: Callable[[Column, Column, Column], Column], key: str = ID, features: str = "features"
) -> Column:
    """All views of a row's feature array as ``array<array>`` in the order of passes: nothing is exploded or shuffled."""
    passes = F.sequence(F.lit(0), F.lit(n_passes - 1))
    return F.transform(passes, lambda i: view(F.col(features), F.col(key), i))


def score_views_in_row(
    df: DataFrame,
    n_passes: int,
    view: Callable[[Column, Column, Column], Column],
    make_predict: MakePredict,
    key: str = ID,
    features: str = "features",
    batch_size: int = 256,
) -> DataFrame:
    """(id, p, features): the mean score over views, and ``array<array<float>>`` of what the passes produced, or null.

    The passes of a row are made, scored and averaged in one task; ``score_views`` with ``mean_score`` is for passes
    that come as rows.
    """
    rows = df.select(key, views_in_row(df, n_passes, view, key, features).alias("_views"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = make_predict()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                values = pc.list_flatten(pc.list_flatten(part.column("_views"))).to_numpy(zero_copy_only=False)
                scores, found = predict(values.reshape(part.num_rows * n_passes, -1))
                means = np.asarray(scores, dtype=np.float64).reshape(-1, n_passes).mean(axis=1)
                stack = pa.nulls(part.num_rows, pa.list_(pa.list_(pa.float32())))
                if found is not None:
                    flat = np.asarray(found, dtype=np.float32).reshape(part.num_rows * n_passes, -1)
                    inner = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype="i4") * flat.shape[1]), pa.array(flat.reshape(-1)))
                    stack = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype="i4") * n_passes), inner)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(means), stack], names=[key, "p", "features"])

    schema = T.StructType(
        [df.schema[key], T.StructField("p", T.DoubleType()), T.StructField("features", T.ArrayType(T.ArrayType(T.FloatType())))]
    )
    return rows.mapInArrow(run, schema)


def mean_score(views: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """Mean over passes of one model; the passes of an id leave one task, so they combine before the shuffle.

    Names repeat between data sets: without a given key it is (dataset, image_name), as far as the table has them.
    """
    if key is None:
        key = [c for c in ("dataset", ID) if c in views.columns]
    return mean_over_passes(views.withColumn("fold", F.lit(0)), key).drop("fold")


def with_template_ids(template: DataFrame, scores: DataFrame, key: str = ID, strict: bool = True) -> DataFrame:
    """Scores for exactly the template's ids."""
    return align_predictions(template.select(key), scores, key, [c for c in scores.columns if c != key], strict)
