"""Prepared tables as encoded sample sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from foldmark.functions.encode import encode_features
from foldmark.operators.prepare import sanity_rows
from foldmark.operators.splits import distinct_folds, head_rows
from foldmark.schemas import SampleSet
from foldmark.sources.tables import read_prepared, read_test


def load_sample_sets(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    train_roots: str | Mapping[str, str] = "",
    test_root: str = "",
    sanity_check: bool = False,
) -> tuple[SampleSet, SampleSet]:
    """Encoded training and test sets.

    A sanity check keeps the flagged training rows, two per fold and class, and as
    many test rows.
    """
    train = encode_features(read_prepared(spark, train_path))
    test = encode_features(read_test(spark, test_path))
    if sanity_check:
        train = sanity_rows(train)
        test = head_rows(test, train.count())
    return SampleSet(train, train_roots, tuple(distinct_folds(train))), SampleSet(test, test_root)
