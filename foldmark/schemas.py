"""Explicit schemas of the tables the toolkit reads and writes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ID = "image_name"
SITE = "anatom_site_general_challenge"
N_STORED_FOLDS = 8

_string, _int, _double = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# The columns of the raw label files, and those that the prepared table leaves out.
RAW_COLUMNS = {
    ID: _string,
    "patient_id": _string,
    "sex": _string,
    "age_approx": _double,
    SITE: _string,
    "target": _int,
    "diagnosis": _string,
    "benign_malignant": _string,
    "tfrecord": _int,
    "width": _int,
    "height": _int,
}
DROPPED_COLUMNS = ("diagnosis", "benign_malignant", "tfrecord", "width", "height")

PREPARED = _schema(
    **{ID: _string, "patient_id": _string, "sex": _string, "age_approx": _double, SITE: _string},
    target=_int,
    dataset=_string,
    fold=_int,
    sanity_check=_int,
)
TEST = _schema(**{ID: _string, "sex": _string, "age_approx": _double, SITE: _string})
PREDICTION = _schema(**{ID: _string, "target": _double})


def raw_schema(*columns: str) -> T.StructType:
    """Schema of one raw label table, which carries a subset of the raw columns, in file order."""
    return _schema(**{c: RAW_COLUMNS[c] for c in columns})


def wide_schema(*fold_columns: str) -> T.StructType:
    return _schema(**{ID: _string, **{c: _double for c in fold_columns}})


EXPERIMENT_INDEX = T.StructType(
    [
        T.StructField("model_type", _string),
        T.StructField("image_size", _int),
        T.StructField(
            "checkpoints",
            T.ArrayType(_schema(fold_index=_int, n_fold=_int, file=_string)),
        ),
    ]
)


@dataclass(frozen=True)
class SampleSet:
    """A sample table, where its images live, and the folds it holds.

    ``roots`` is one path for every row or one path per value of ``dataset``.
    """

    df: DataFrame
    roots: str | Mapping[str, str] = ""
    folds: tuple[int, ...] = field(default_factory=tuple)

    def with_rows(self, df: DataFrame, folds: tuple[int, ...]) -> "SampleSet":
        return SampleSet(df, self.roots, folds)

    def count(self) -> int:
        return self.df.count()
