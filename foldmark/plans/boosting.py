"""Boosted trees per fold, with the tree count chosen by validation AUC."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.functions.encode import SHORT_FEATURES, quoted
from foldmark.operators.contracts import join_all
from foldmark.operators.metrics import auc_of, roc_auc
from foldmark.operators.ordering import order_histogram
from foldmark.session import cut_lineage, ensure_checkpoint_dir

VECTOR = "features_vector"


@dataclass(frozen=True)
class BoostParams:
    """Tree limit, patience in trees, and shape of the trees.

    ``auc_every`` is the number of trees between two looks at the validation AUC.
    A look costs one score per validation row; with many rows take fewer.
    """

    max_trees: int = 256
    patience: int = 64
    auc_every: int = 1
    max_depth: int = 5
    step_size: float = 0.1
    first_trees: int = 128
    seed: int = 47


@dataclass(frozen=True)
class FittedModel:
    model: Model
    n_trees: int
    auc: float | None


def boosted_trees(params: BoostParams, n_trees: int) -> Estimator:
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol="target",
        maxIter=n_trees,
        maxDepth=params.max_depth,
        stepSize=params.step_size,
        seed=params.seed,
    )


EstimatorFactory = Callable[[BoostParams, int], Estimator]
ESTIMATORS: dict[str, EstimatorFactory] = {"boosted_trees": boosted_trees}


def register_estimator(name: str, factory: EstimatorFactory) -> None:
    if name in ESTIMATORS:
        raise ValueError(f"estimator {name!r} is already registered")
    ESTIMATORS[name] = factory


def with_vector(df: DataFrame, columns: Sequence[str] = SHORT_FEATURES, arrays: Sequence[str] = ()) -> DataFrame:
    """Add the model input: numeric columns followed by feature arrays."""
    parts = [F.array(*[quoted(c).cast("double") for c in columns])] if columns else []
    parts += [quoted(a).cast("array<double>") for a in arrays]
    return df.withColumn(VECTOR, array_to_vector(F.concat(*parts)))


def join_features(
    left: DataFrame, right: DataFrame, keys: Sequence[str], first: str, second: str, out: str
) -> DataFrame:
    """Two feature arrays of the same id as one; a left row without a partner is an error."""
    other = right.select(*keys, F.col(second).alias("_second"))
    joined = join_all(left, other, keys, f"no {second} for id")
    return joined.withColumn(out, F.concat(F.col(first), F.col("_second"))).drop("_second")


def positive_probability(df: DataFrame, model: Model, out: str = "p") -> DataFrame:
    """Append the probability of class 1 only."""
    quiet = model.copy()
    quiet.setProbabilityCol("_probability")
    quiet.setRawPredictionCol("")
    quiet.setPredictionCol("")
    scored = quiet.transform(df)
    return scored.withColumn(out, vector_to_array("_probability")[1]).drop("_probability")


# Fixed value: how a tree's debug string shows the prediction of a leaf, leaves from left to right.
_LEAF_VALUE = re.compile(r"Predict: (\S+)")


def _leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """Weighted prediction of every leaf, by tree and leaf number."""
    return [
        [weight * float(value) for value in _LEAF_VALUE.findall(tree.toDebugString)]
        for tree, weight in zip(model.trees, model.treeWeights)
    ]


#: Cells of the (row, tree) matrix that a worker holds at a time; some ten arrays have as many.
LEAF_CELLS = 1 << 18
STAGED = "epoch int, margin double, pos long, neg long"


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(vector, pos, neg): rows of one feature vector score alike under any number of trees, so one of them speaks for all."""
    positive = F.coalesce(F.col("target") == 1, F.lit(False))
    counts = [F.count(F.when(c, 1)).alias(name) for name, c in (("pos", positive), ("neg", ~positive))]
    return rows.groupBy(VECTOR).agg(*counts)


def staged_margins(model: GBTClassificationModel, vectors: DataFrame, every: int = 1) -> DataFrame:
    """(epoch, margin, pos, neg): the rows' margins after every, 2 * every, ... trees; equal margins of a batch as one row.

    The model gives a row's leaf in every tree. A batch's leaves are a matrix of rows and trees: their values, summed along
    the trees, are the margins of all stages at once.
    """
    values = _leaf_values(model)
    table = np.zeros((len(values), max(map(len, values))))
    for tree, leaves in enumerate(values):
        table[tree, : len(leaves)] = leaves
    quiet = model.copy()
    quiet.setLeafCol("_leaves").setProbabilityCol("").setRawPredictionCol("").setPredictionCol("")
    small = "array<smallint>" if table.shape[1] <= 1 << 15 else "array<int>"
    leaves = quiet.transform(vectors).select(vector_to_array("_leaves").cast(small).alias("leaves"), "pos", "neg")

    def margins(leaves: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> pa.RecordBatch:
        steps = table[np.arange(len(table)), leaves]
        stages = np.cumsum(steps, axis=1)[:, every - 1 :: every]
        order = np.argsort(stages, axis=0, kind="stable")
        ranked = np.take_along_axis(stages, order, axis=0)
        new = np.ones(ranked.shape, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        starts = np.flatnonzero(new.T)  # stage by stage
        counts = [np.add.reduceat(n[order].T.reshape(-1), starts) for n in (pos, neg)]
        epoch = (starts // len(leaves)).astype("i4")
        return pa.RecordBatch.from_arrays(
            [pa.array(epoch), pa.array(ranked.T.reshape(-1)[starts]), *map(pa.array, counts)], names=["epoch", "margin", "pos", "neg"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, LEAF_CELLS // len(table))
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                flat = pc.list_flatten(part.column("leaves")).to_numpy(zero_copy_only=False)
                yield margins(flat.reshape(part.num_rows, -1), *(part.column(c).to_numpy() for c in ("pos", "neg")))

    return leaves.mapInArrow(run, STAGED)


def staged_auc(model: GBTClassificationModel, validation: DataFrame, every: int = 1) -> DataFrame:
    """(run, epoch, val_auc): AUC of the first every, 2 * every, ... trees, all from one scan of the rows.

    ``validation`` has rows with ``target``, or distinct vectors with their counts.
    """
    vectors = validation if "pos" in validation.columns else distinct_vectors(validation.select(VECTOR, "target"))
    staged = staged_margins(model, vectors, every)
    hist = staged.groupBy("epoch", (F.col("margin") + F.lit(0.0)).alias("margin")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    scored = auc_of(order_histogram(hist, "margin", ("epoch",)))
    return scored.select(F.lit("boost").alias("run"), "epoch", F.col("auc").alias("val_auc"))


def model_of_trees(model: GBTClassificationModel, places: Sequence[int]) -> GBTClassificationModel:
    """A model of some of another's trees, in the given order, with its parameters."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(places))
    weights = gateway.new_array(gateway.jvm.double, len(places))
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i, place in enumerate(places):
        trees[i], weights[i] = all_trees[place], all_weights[place]
    chosen = ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    return model._copyValues(GBTClassificationModel(chosen))


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first n trees: boosting is sequential, so it is the fit with n trees."""
    return model_of_trees(model, range(n))


def without_small_tasks(cached: DataFrame, rows_per_task: int = 10_000) -> DataFrame:
    """Fill the cache and merge small partitions: a fit is dozens of jobs over all of them. No shuffle."""
    return cached.coalesce(max(1, -(-cached.count() // rows_per_task)))


def fit_fold(
    table: DataFrame,
    params: BoostParams = BoostParams(),
    estimator: str = "boosted_trees",
    is_cached: bool = False,
) -> FittedModel:
    """Fit on the rows with ``is_val`` false; choose the tree count on the others.

    Boosting is sequential, so the first n trees of a longer fit are the fit with
    n trees. The limit doubles from ``first_trees`` until ``patience`` trees bring
    no better validation AUC or ``max_trees`` is reached, with one fit each; the last one is cut to the best count.
    The validation rows go in once, as distinct vectors with their counts.
    """
    ensure_checkpoint_dir(table.sparkSession)
    narrow = table.select(VECTOR, F.col("target").cast("double").alias("target"), "is_val")
    if not is_cached:
        narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = narrow if is_cached else without_small_tasks(narrow)
        train = rows.where(~F.col("is_val")).drop("is_val")
        validation = rows.where(F.col("is_val")).drop("is_val")
        return _fit_best(train, validation, params, ESTIMATORS[estimator])
    finally:
        if not is_cached:
            narrow.unpersist()


def _fit_best(
    train: DataFrame, validation: DataFrame, params: BoostParams, factory: EstimatorFactory
) -> FittedModel:
    if params.auc_every > params.max_trees:
        raise ValueError("auc_every exceeds max_trees: no stage would be measured")
    limit = min(max(params.first_trees, params.auc_every), params.max_trees)
    patience = max(1, params.patience // params.auc_every)
    vectors = None
    while True:
        model = factory(params, limit).fit(train)
        if not isinstance(model, GBTClassificationModel):
            auc = roc_auc(positive_probability(validation, model), "p", "target").head()
            return FittedModel(model, 1, auc["auc"])
        vectors = cut_lineage(distinct_vectors(validation)) if vectors is None else vectors
        stages = staged_auc(model, vectors, params.auc_every).orderBy("epoch").collect()
        stopped, best, auc = stop_point([r["val_auc"] for r in stages], patience)
        if best is None:
            return FittedModel(model, limit, None)
        if stopped or limit >= params.max_trees:
            break
        limit = min(2 * limit, params.max_trees)
    n_trees = (best + 1) * params.auc_every
    return FittedModel(first_trees(model, n_trees) if n_trees < limit else model, n_trees, auc)


def stop_point(values: Sequence[float | None], patience: int) -> tuple[bool, int | None, float | None]:
    """Whether ``patience`` values in a row brought nothing better, and the best until then.

    The values of one fit, at most one per tree; for tables of runs there is
    ``operators.training_log.early_stop``.
    """
    best = None
    for i, value in enumerate(values):
        if value is not None and (best is None or value > values[best]):
            best = i
        elif i - (-1 if best is None else best) >= patience:
            return True, best, None if best is None else values[best]
    return False, best, None if best is None else values[best]
