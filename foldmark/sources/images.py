"""Decoded images keyed by sample id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions.encode import lookup
from foldmark.operators.contracts import join_all
from foldmark.schemas import ID

_STEM = r"([^/]+)\.[^./]+$"


def image_path(
    roots: str | Mapping[str, str], name: Column, dataset: Column | None = None, suffix: str = ".jpg"
) -> Column:
    """``{root}/{name}.jpg`` with one root, or the root of the row's dataset (null if it has none)."""
    root = F.lit(roots) if isinstance(roots, str) else lookup(dataset, roots, None)
    return F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), name, F.lit(suffix))


def _by_dataset(roots: str | Mapping[str, str], load) -> DataFrame:
    if isinstance(roots, str):
        return load(roots).withColumn("dataset", F.lit(None).cast("string"))
    merged = None
    for dataset, root in roots.items():
        part = load(root).withColumn("dataset", F.lit(dataset))
        merged = part if merged is None else merged.unionByName(part)
    return merged


def read_images(spark: SparkSession, roots: str | Mapping[str, str], glob: str = "*.jpg") -> DataFrame:
    """(image_name, dataset, height, width, n_channels, data); pixels are BGR bytes, row by row."""

    def load(root: str) -> DataFrame:
        found = spark.read.format("image").option("pathGlobFilter", glob).load(root)
        return found.select(
            F.regexp_extract("image.origin", _STEM, 1).alias(ID),
            F.col("image.height").alias("height"),
            F.col("image.width").alias("width"),
            F.col("image.nChannels").alias("n_channels"),
            F.col("image.data").alias("data"),
        )

    return _by_dataset(roots, load)


def list_images(spark: SparkSession, roots: str | Mapping[str, str], glob: str = "*.jpg") -> DataFrame:
    """(image_name, dataset) of the files, without reading them."""

    def load(root: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
        return found.select(F.regexp_extract("path", _STEM, 1).alias(ID))

    return _by_dataset(roots, load)


def _keys(roots: str | Mapping[str, str]) -> list[str]:
    return [ID] if isinstance(roots, str) else ["dataset", ID]


def missing_images(
    samples: DataFrame, spark: SparkSession, roots: str | Mapping[str, str], glob: str = "*.jpg"
) -> DataFrame:
    """Samples without an image file, found from names alone."""
    keys = _keys(roots)
    return samples.join(list_images(spark, roots, glob).select(*keys), keys, "left_anti")


def join_samples(samples: DataFrame, images: DataFrame, keys=("dataset", ID)) -> DataFrame:
    """Samples with their image columns; a sample without an image is an error (``missing_images`` lists them).

    Join what was computed from the pixels rather than the pixels, where the job
    allows it: then only narrow rows are shuffled.
    """
    shared = [c for c in images.columns if c in samples.columns and c not in keys]
    return join_all(samples, images.drop(*shared), keys, "no image for sample")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_features`` wrote, with the folders' names as columns: a filter on them reads only its folders."""
    return spark.read.parquet(path)
