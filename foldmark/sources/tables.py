"""CSV tables of samples, predictions and submissions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark import schemas
from foldmark.functions.encode import quoted
from foldmark.functions.scores import clean_score
from foldmark.schemas import ID


def read_text_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every column a string. Files of one call must share the header."""
    first = paths if isinstance(paths, str) else list(paths)[0]
    header = spark.read.option("header", True).csv(first).schema
    return spark.read.schema(header).options(header=True, enforceSchema=False).csv(
        paths if isinstance(paths, str) else list(paths)
    )


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and type the columns by name. Empty fields and NaN are null; ``1.0`` is a valid integer."""
    return _cast(df, schema, [])


def _cast(df: DataFrame, schema: T.StructType, others: Sequence[Column]) -> DataFrame:
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    columns = []
    for field in schema:
        value = quoted(field.name)
        if isinstance(field.dataType, T.IntegerType):
            value = clean_score(value).cast("int")
        elif isinstance(field.dataType, T.DoubleType):
            value = clean_score(value)
        columns.append(value.alias(field.name))
    return df.select(*columns, *others)


def read_table(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Columns are found by header name, not by position; unread columns are pruned."""
    return cast_columns(read_text_table(spark, paths), schema)


def read_raw_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Raw label tables by dataset name; each file carries its own subset of the raw columns, and others as strings."""
    tables = {}
    for name, path in paths.items():
        text = read_text_table(spark, path)
        known = [c for c in text.columns if c in schemas.RAW_COLUMNS]
        others = [quoted(c) for c in text.columns if c not in known]
        tables[name] = _cast(text, schemas.raw_schema(*known), others)
    return tables


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.PREPARED)


def read_test(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.TEST)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.PREDICTION)


def file_stem(path: str) -> str:
    return PurePosixPath(path).stem


def read_predictions(spark: SparkSession, paths: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Prediction files as one long table (id, model, p).

    The model is the file stem, or the key of a mapping; two files of the same
    stem are an error, not one model. The id is the first column, the score the
    second, whatever their names.
    """
    named = dict(paths) if isinstance(paths, Mapping) else {}
    if not named:
        for path in paths:
            if file_stem(path) in named:
                raise ValueError(f"two prediction files are named {file_stem(path)!r}; give explicit model names")
            named[file_stem(path)] = path
    if not named:
        raise ValueError("no prediction file given")
    long = None
    for model, path in named.items():
        text = read_text_table(spark, path)
        if len(text.columns) < 2:
            raise ValueError(f"{path} needs an id and a score column")
        part = text.select(
            quoted(text.columns[0]).alias(ID),
            F.lit(model).alias("model"),
            clean_score(quoted(text.columns[1])).alias("p"),
        )
        long = part if long is None else long.unionByName(part)
    return long


def read_prediction_folder(spark: SparkSession, pattern: str) -> DataFrame:
    """All prediction files under a glob in one scan; the model is the file stem."""
    text = read_text_table(spark, pattern)
    return text.select(
        quoted(text.columns[0]).alias(ID),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("model"),
        clean_score(quoted(text.columns[1])).alias("p"),
    )


def read_fold_predictions(spark: SparkSession, path: str, n_folds: int = 4) -> DataFrame:
    """Wide fold predictions with columns ``fold-0..`` or ``0..``."""
    text = read_text_table(spark, path)
    for pattern in ("fold-{}", "{}"):
        columns = [pattern.format(i) for i in range(n_folds)]
        if all(c in text.columns for c in columns):
            return cast_columns(text, schemas.wide_schema(*columns))
    raise ValueError(f"{path} has neither columns fold-0.. nor 0.. for {n_folds} folds")
