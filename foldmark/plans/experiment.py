"""Score with all fold models of a saved experiment: trees on features, or a user's predictors on images under views."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions.encode import SHORT_FEATURES
from foldmark.operators.contracts import join_all
from foldmark.operators.splits import check_split_count, validation_folds_of
from foldmark.plans import image_scoring
from foldmark.plans.boosting import with_vector
from foldmark.plans.crossval import out_of_fold, score_with_all
from foldmark.plans.scoring import with_template_ids
from foldmark.plans.views import Stage
from foldmark.schemas import ID
from foldmark.sinks.models import load_model
from foldmark.sinks.tables import fold_predictions, write_csv, write_features, write_index
from foldmark.sources.experiments import build_index, checkpoints, list_model_files, list_saved_models, read_index, read_model_files


def index_experiment(spark: SparkSession, root: str, model_type: str, image_size: int = 0) -> str:
    """List the saved fold models under a root in ``{root}/index.json``."""
    path = f"{root}/index.json"
    write_index(build_index(list_saved_models(spark, root), model_type, image_size), path)
    return path


def load_fold_models(spark: SparkSession, root: str) -> tuple[str, int, dict[int, Model]]:
    """Model type, fold count and models by fold, as the index lists them."""
    rows = checkpoints(read_index(spark, f"{root}/index.json")).collect()
    counts = {r["n_fold"] for r in rows}
    if len(counts) != 1:
        raise ValueError(f"the index lists models of {sorted(counts) or 'no'} folds")
    models = {r["fold_index"]: load_model(f"{root}/{r['file']}").stages[-1] for r in rows}
    if len(models) != len(rows):
        raise ValueError("the index lists a fold twice")
    return rows[0]["model_type"], counts.pop(), models


def score_test(
    spark: SparkSession,
    root: str,
    test: DataFrame,
    template: DataFrame,
    out: str,
    features: Sequence[str] = SHORT_FEATURES,
) -> str:
    """Write (id, fold-0, ...) for the template's ids to ``{out}/cv_test_{model type}``."""
    model_type, _, models = load_fold_models(spark, root)
    long = score_with_all(with_vector(test, features), models)
    wide = with_template_ids(template, fold_predictions(long, sorted(models)))
    path = f"{out}/cv_test_{model_type}"
    write_csv(wide, path)
    return path


def score_validation(
    spark: SparkSession, root: str, train: DataFrame, out: str, features: Sequence[str] = SHORT_FEATURES
) -> str:
    """Write the out-of-fold scores (id, target) to ``{out}/cv_val_{model type}``."""
    model_type, n_fold, models = load_fold_models(spark, root)
    check_split_count(n_fold)
    scored = out_of_fold(with_vector(train, features), models, n_fold)
    path = f"{out}/cv_val_{model_type}"
    write_csv(scored.select(ID, scored["p"].alias("target")), path)
    return path


#: Model type and a model file's content -> a predictor of images; called once in every worker.
LoadPredictor = Callable[[str, bytes], image_scoring.ImagePredict]


def index_model_files(spark: SparkSession, root: str, model_type: str, image_size: int, glob: str = "fold_*") -> str:
    """List the model files under a root in ``{root}/index.json``."""
    path = f"{root}/index.json"
    write_index(build_index(list_model_files(spark, root, glob), model_type, image_size), path)
    return path


def load_fold_predictors(spark: SparkSession, root: str, load: LoadPredictor) -> tuple[str, int, list[image_scoring.MakeImagePredict]]:
    """Model type, fold count and predictors in the order of folds, as the index lists them."""
    rows = sorted(checkpoints(read_index(spark, f"{root}/index.json")).collect(), key=lambda r: r["fold_index"])
    counts = {r["n_fold"] for r in rows}
    if len(counts) != 1:
        raise ValueError(f"the index lists models of {sorted(counts) or 'no'} folds")
    if [r["fold_index"] for r in rows] != list(range(len(rows))):
        raise ValueError(f"the index lists the folds {[r['fold_index'] for r in rows]}")
    model_type, content = rows[0]["model_type"], read_model_files(spark, root, [r["file"] for r in rows])

    def maker(data: bytes) -> image_scoring.MakeImagePredict:
        return lambda: load(model_type, data)

    return model_type, counts.pop(), [maker(content[r["file"]]) for r in rows]


def score_test_images(
    spark: SparkSession,
    root: str,
    images: DataFrame,
    template: DataFrame,
    out: str,
    load: LoadPredictor,
    stages: Sequence[Stage],
    **options,
) -> str:
    """Write (id, fold-0, ...), means over passes, for the template's ids to ``{out}/cv_test_{model type}``."""
    model_type, _, predictors = load_fold_predictors(spark, root, load)
    long = image_scoring.score_all_folds(images, stages, predictors, **options)
    wide = with_template_ids(template, fold_predictions(long, range(len(predictors))))
    path = f"{out}/cv_test_{model_type}"
    write_csv(wide, path)
    return path


def score_validation_images(
    spark: SparkSession,
    root: str,
    samples: DataFrame,
    images: DataFrame,
    out: str,
    load: LoadPredictor,
    stages: Sequence[Stage],
    keys: Sequence[str] = ("dataset", ID),
    features: bool = False,
    **options,
) -> str:
    """Write the out-of-fold scores (id, target) to ``{out}/cv_val_{model type}``; every sample must have its image.

    ``samples`` have ``fold``; only names and folds meet the images. With ``features``, the features of all passes go to
    ``{out}/embedding_val_{model type}``, by model and fold, from the same scoring.
    """
    model_type, n_fold, predictors = load_fold_predictors(spark, root, load)
    if n_fold != len(predictors):
        raise ValueError(f"the index lists {len(predictors)} models of {n_fold} folds")
    # A fold that no split validates on would have no model; every stored fold has one here.
    own = F.coalesce(*[F.when(F.col("fold").isin(*validation_folds_of(i, n_fold)), F.lit(i)) for i in range(n_fold)])
    rows = join_all(samples.select(*keys, own.alias("val_index")), images, keys, "no image for sample")
    scored = image_scoring.score_own_fold(rows.withColumn("dataset", F.col("dataset").cast("string")), stages, predictors, **options)
    if features:
        kept = scored.select(F.lit(model_type).alias("model"), F.col("val_index").alias("fold"), "dataset", ID, "p", F.col("stack").alias("features"))
        exported = f"{out}/embedding_val_{model_type}"
        write_features(kept, exported, ("model", "fold"))
        scored = spark.read.parquet(exported)
    path = f"{out}/cv_val_{model_type}"
    write_csv(scored.select(ID, F.col("p").alias("target")), path)
    return path
