"""Fold assignment and the train/validation splits derived from it.

A split is a column or a predicate on one table, never a copy per fold; on a
table partitioned by ``fold`` the predicates prune partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.operators.ordering import hashed_row_numbers
from foldmark.schemas import ID, N_STORED_FOLDS, SampleSet


def stratified_folds(
    df: DataFrame,
    class_column: str = "target",
    key: str = ID,
    n_folds: int = N_STORED_FOLDS,
    seed: int = 47,
    tiebreak: Sequence[str] = (),
    digits: int = 3,
) -> DataFrame:
    """Add ``fold``: round robin over the class-sorted, seeded order, in 16**digits buckets a class.

    Sizes differ by at most one, per class and in total.
    """
    numbered = hashed_row_numbers(df, key, seed, "_place", (class_column,), tiebreak=tiebreak, digits=digits)
    return numbered.select(*df.columns, ((F.col("_place") - 1) % n_folds).cast("int").alias("fold"))


def complement_folds(folds: Iterable[int], n_folds: int = N_STORED_FOLDS) -> list[int]:
    return sorted(set(range(n_folds)) - set(folds))


def in_folds(folds: Iterable[int]) -> Column:
    return F.col("fold").isin(*sorted(set(folds)))


def train_validate_split(source: SampleSet, val_folds: Sequence[int] = (0, 1)) -> tuple[SampleSet, SampleSet]:
    train = tuple(complement_folds(val_folds))
    return (
        source.with_rows(source.df.where(in_folds(train)), train),
        source.with_rows(source.df.where(in_folds(val_folds)), tuple(val_folds)),
    )


def check_split_count(n_splits: int) -> None:
    if n_splits not in (4, 8):
        raise ValueError("the number of splits must be 4 or 8")


def with_val_index(df: DataFrame, n_splits: int) -> DataFrame:
    """Add ``val_index``, the split that validates on the row: consecutive folds share one."""
    check_split_count(n_splits)
    return df.withColumn("val_index", F.floor(F.col("fold") / (N_STORED_FOLDS // n_splits)).cast("int"))


def validation_folds(index: int, n_splits: int) -> list[int]:
    check_split_count(n_splits)
    if not 0 <= index < n_splits:
        raise ValueError(f"split index must be in 0..{n_splits - 1}")
    width = N_STORED_FOLDS // n_splits
    return list(range(index * width, (index + 1) * width))


def validation_folds_of(index: int, n_splits: int) -> list[int]:
    """Stored folds that split ``index`` of any number of splits validates on: consecutive ones, as even as can be."""
    if not 2 <= n_splits <= N_STORED_FOLDS or not 0 <= index < n_splits:
        raise ValueError(f"split {index} of {n_splits}: there must be 2 to {N_STORED_FOLDS} splits")
    return [f for f in range(N_STORED_FOLDS) if f * n_splits // N_STORED_FOLDS == index]


def pick_split(source: SampleSet, index: int, n_splits: int) -> tuple[SampleSet, SampleSet]:
    return train_validate_split(source, validation_folds(index, n_splits))


def kfold_splits(source: SampleSet, n_splits: int = 4) -> Iterator[tuple[SampleSet, SampleSet]]:
    check_split_count(n_splits)
    return (pick_split(source, i, n_splits) for i in range(n_splits))


def holdout_split(
    df: DataFrame, key: str = ID, fraction: float = 0.2, seed: int = 42, digits: int = 3
) -> DataFrame:
    """Add boolean ``is_test`` for exactly ceil(fraction * rows) rows, the same rows in every run, in 16**digits buckets.

    The product is rounded before the ceiling so that 0.2 * 5 is 1, not a hair above.
    """
    numbered = hashed_row_numbers(df, key, seed, "_place", total="_rows", digits=digits)
    size = F.ceil(F.round(F.col("_rows") * F.lit(fraction), 9))
    return numbered.select(*df.columns, (F.col("_place") <= size).alias("is_test"))


def head_rows(df: DataFrame, n: int, key: str = ID, split: Sequence[str] = ()) -> DataFrame:
    """The first n rows by id, in place of file order; with ``split``, of each split (n per split leave a task at most)."""
    if not split:
        return df.orderBy(key).limit(n)
    place = F.row_number().over(Window.partitionBy(*split).orderBy(key))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def distinct_folds(df: DataFrame) -> list[int]:
    """Fold numbers present, at most ``N_STORED_FOLDS`` of them."""
    return sorted(r[0] for r in df.select("fold").distinct().collect())


def fold_summary(df: DataFrame, class_column: str = "target") -> DataFrame:
    return df.groupBy("fold", class_column).agg(F.count("*").alias("n"))
