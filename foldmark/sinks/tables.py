"""Writers of prepared tables, predictions, submissions and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.contracts import align_predictions, to_wide
from foldmark.schemas import ID


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, one per task, each with the header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_prepared(df: DataFrame, path: str) -> None:
    """Parquet partitioned by fold, so that a split reads only its folds."""
    df.write.mode("overwrite").partitionBy("fold").parquet(path)


def fill_submission(template: DataFrame, result: DataFrame, key: str = ID, score: str = "target") -> DataFrame:
    """Template ids with the new scores; ids without one keep the template's value, an id scored twice is an error."""
    fresh = result.select(key, F.col(score).cast("double").alias("_fresh"))
    joined = align_predictions(template, fresh, key, ("_fresh",), strict=False, unique=True)
    return joined.select(key, F.coalesce("_fresh", F.col("target").cast("double")).alias("target"))


def fold_predictions(long: DataFrame, folds: Sequence[int], key: str = ID) -> DataFrame:
    """(id, fold, p) as one column ``fold-i`` per fold."""
    return to_wide(long, key, folds, name="fold", prefix="fold-")


def write_scored(scores: DataFrame, metric: DataFrame, path: str, name: str = "cv_auc") -> str:
    """Scores to ``{path}/{name}_{auc}`` and the one-row metric table beside them; returns the scores' folder."""
    row = metric.head()
    target = f"{path}/{name}_{row['auc']}"
    write_csv(scores, target)
    measured = metric.sparkSession.createDataFrame([row], metric.schema)
    measured.write.mode("overwrite").parquet(f"{path}/{name}_metric")
    return target


def write_features(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Features of scored rows, an array of passes each, in folders by ``partitions``, say (model, fold).

    Rows of one folder leave every task that has some; a table scored in many small tasks wants fewer of them first.
    """
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


#: Index rows in a file, so that a reader of whole files holds no more at a time.
INDEX_ROWS = 1000


def write_index(index: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """One JSON object per line, one line per experiment: every task writes its own, and nothing is gathered.

    ``partitions`` are columns that name the experiment and become folders, for readers of a few of many.
    """
    line = F.to_json(F.struct(*[c for c in index.columns if c not in partitions])).alias("value")
    rows = index.select(*[F.col(c).cast("string").alias(c) for c in partitions], line)
    rows.write.mode("overwrite").option("maxRecordsPerFile", INDEX_ROWS).partitionBy(*partitions).text(path)
