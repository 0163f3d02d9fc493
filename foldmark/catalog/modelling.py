"""Queries that fit tree models. Fits are not SQL; the driver checks their rows, the tests their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.arrays import image_id, images, vectors
from foldmark.catalog.fixtures import TEST_SAMPLES, fixture
from foldmark.catalog.preparing import folded
from foldmark.catalog.registry import query
from foldmark.functions.encode import FULL_FEATURES, SHORT_FEATURES, encode_features
from foldmark.operators.contracts import join_all
from foldmark.operators.splits import in_folds, stratified_folds, validation_folds
from foldmark.plans import crossval
from foldmark.plans.baseline import run_baseline
from foldmark.plans.boosting import BoostParams, fit_fold, positive_probability, with_vector
from foldmark.plans.views import coefficient_features
from foldmark.schemas import ID

# Single fits search for the tree count at the limits of a training; a first limit below the patience makes them double it.
PARAMS = BoostParams(max_trees=256, patience=64, max_depth=3, first_trees=48, step_size=0.3)
# Fits of several folds: the workload of a check, with the search still in it.
FOLD_PARAMS = BoostParams(max_trees=8, patience=4, max_depth=3, first_trees=4, step_size=0.3)


def table(spark: SparkSession, sf: str) -> DataFrame:
    return with_vector(encode_features(folded(spark, sf)), FULL_FEATURES)


def unlabelled_table(spark: SparkSession, sf: str) -> DataFrame:
    return with_vector(encode_features(fixture(spark, sf, TEST_SAMPLES)), FULL_FEATURES)


def _first_fold(df: DataFrame) -> DataFrame:
    return df.withColumn("is_val", in_folds(validation_folds(0, 4)))


def _validation_scores(df: DataFrame) -> DataFrame:
    marked = _first_fold(df)
    fitted = fit_fold(marked, PARAMS)
    scored = positive_probability(marked.where("is_val"), fitted.model)
    return scored.select(ID, "target", "p", F.lit(fitted.n_trees).alias("n_trees"))


@query("gbt_meta")
def gbt_meta(spark, sf):
    return _validation_scores(with_vector(encode_features(folded(spark, sf)), SHORT_FEATURES))


@query("gbt_embedding")
def gbt_embedding(spark, sf):
    rows = vectors(spark, sf).select(
        image_id(), "embedding", F.when(F.col("label") == 0, 1).otherwise(0).alias("target")
    )
    return _validation_scores(with_vector(stratified_folds(rows), (), ("embedding",)))


@query("gbt_coefficients")
def gbt_coefficients(spark, sf):
    """Coefficient features computed from the pixels first; only they meet the sample table.

    The given tables have images for some samples; the others are left out in so many words.
    """
    features = coefficient_features(images(spark, sf)).select(ID, "features")
    samples = encode_features(folded(spark, sf)).join(features.select(ID), ID, "left_semi")
    rows = join_all(samples, features, (ID,), "no image for sample")
    return _validation_scores(with_vector(rows, SHORT_FEATURES, ("features",)))


@query("gbt_oof")
def gbt_oof(spark, sf):
    rows = table(spark, sf)
    fitted = crossval.fit_folds(rows, 4, FOLD_PARAMS)
    return crossval.out_of_fold(rows, {i: f.model for i, f in fitted.items()}, 4)


@query("cv_mean")
def cv_mean(spark, sf):
    return crossval.cross_validate(table(spark, sf), unlabelled_table(spark, sf), 4, FOLD_PARAMS)


@query("baseline_submission")
def baseline_submission(spark, sf):
    tests = fixture(spark, sf, TEST_SAMPLES)
    template = tests.select(ID, F.lit(0.0).alias("target"))
    return run_baseline(folded(spark, sf), tests, template, params=FOLD_PARAMS)[0]
