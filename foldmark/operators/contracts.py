"""Keyed alignment of predictions and labels, with the checks that replace row position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.schemas import ID


def fail_if(condition: Column, message: str, key: str, value: Column) -> Column:
    """The value, or a query failure naming the first offending key."""
    return F.when(
        condition, F.raise_error(F.concat(F.lit(f"{message}: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    ).otherwise(value)


def join_all(left: DataFrame, right: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """Every left row with its right columns; a left row without a partner is an error that names its last key."""
    joined = left.join(right.withColumn("_met", F.lit(True)), list(keys), "left")
    met = fail_if(F.col("_met").isNull(), message, keys[-1], F.lit(True))
    return joined.where(met).drop("_met")


def duplicate_ids(df: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def keep_preferred(df: DataFrame, keys: Sequence[str], priority: Sequence[Column]) -> DataFrame:
    """One row per key, the first by priority. The map side drops all but one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*priority)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def missing_predictions(labels: DataFrame, predictions: DataFrame, key: str = ID) -> DataFrame:
    """Label rows whose id has no prediction."""
    return labels.join(predictions.select(key), key, "left_anti")


def align_predictions(
    labels: DataFrame,
    predictions: DataFrame,
    key: str = ID,
    columns: Sequence[str] = ("p",),
    strict: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Label rows with their predictions; predictions of other ids are dropped.

    ``strict`` fails on a label without a prediction row, ``unique`` on an id
    predicted twice (otherwise a repeated id multiplies). Both checks run inside
    the join's own shuffle: no extra pass over the data.
    """
    right = predictions.select(key, *columns)
    if unique:
        right = (
            right.groupBy(key)
            .agg(F.count("*").alias("_n"), *[F.max(c).alias(c) for c in columns])
            .select(
                key,
                *columns,
                fail_if(F.col("_n") > 1, "more than one prediction for id", key, F.lit(True)).alias("_present"),
            )
        )
    else:
        right = right.withColumn("_present", F.lit(True))
    joined = labels.join(right, key, "left")
    if not strict:
        # A filter that always holds keeps the uniqueness check from being pruned with its column.
        return (joined.where(F.coalesce("_present", F.lit(True))) if unique else joined).drop("_present")
    checked = fail_if(F.col("_present").isNull(), "no prediction for id", key, F.lit(True))
    return joined.where(checked).drop("_present")


def align_models(labels: DataFrame, long: DataFrame, models: Sequence[str], key: str = ID) -> DataFrame:
    """Label rows x models as (id, labels..., model, p); every model must predict every labelled id, once.

    A model that is not in the list is an error; leave it out of the long table to leave it out here.
    """

    def of(model: str) -> Column:
        return F.col("model") == model

    stranger = F.max(F.when(~F.coalesce(F.col("model").isin(list(models)), F.lit(False)), F.coalesce("model", F.lit("null"))))

    cells = long.groupBy(key).agg(
        *[F.struct(F.count(F.when(of(m), 1)).alias("n"), F.max(F.when(of(m), F.col("p"))).alias("p")).alias(f"_{i}")
          for i, m in enumerate(models)],
        stranger.alias("_stranger"),
    )
    joined = labels.join(cells, key, "left")
    entries = []
    for i, model in enumerate(models):
        n = F.coalesce(F.col(f"_{i}.n"), F.lit(0))
        value = fail_if(n == 0, f"no prediction by {model} for id", key, F.col(f"_{i}.p"))
        value = fail_if(n > 1, f"more than one prediction by {model} for id", key, value)
        value = fail_if(F.col("_stranger").isNotNull(), "prediction by a model not asked for, for id", key, value)
        entries.append(F.struct(F.lit(model).alias("model"), value.alias("p")))
    return joined.select(*labels.columns, F.inline(F.array(*entries)))


def collect_models(tables: Mapping[str, DataFrame], key: str = ID, score: str = "target") -> DataFrame:
    """Prediction tables of several models as one long table (id, model, p): a union, not N joins."""
    parts = [
        df.select(key, F.lit(name).alias("model"), F.col(score).cast("double").alias("p"))
        for name, df in tables.items()
    ]
    if not parts:
        raise ValueError("no prediction table given")
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long


def to_long(wide: DataFrame, key: str, columns: Sequence[str], name: str = "model", score: str = "p") -> DataFrame:
    """Wide score columns as rows. An exploded array keeps the partitioning by key, which ``unpivot`` does not."""
    cells = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(score)) for c in columns]
    )
    return wide.select(key, F.inline(cells))


def to_wide(
    long: DataFrame, key: str, names: Sequence[str], name: str = "model", score: str = "p", prefix: str = ""
) -> DataFrame:
    """One column per known name: a full outer alignment, absent cells null.

    A name that is not known and a cell given twice are errors.
    """
    known = F.coalesce(F.col(name).isin(list(names)), F.lit(False))
    cells = [F.struct(F.count(F.when(F.col(name) == n, 1)).alias("n"), F.max(F.when(F.col(name) == n, F.col(score))).alias("p")) for n in names]
    grouped = long.groupBy(key).agg(F.count(F.when(~known, 1)).alias("_strangers"), *[c.alias(f"_{i}") for i, c in enumerate(cells)])
    columns = []
    for i, n in enumerate(names):
        value = fail_if(F.col(f"_{i}.n") > 1, f"more than one cell of {n} for id", key, F.col(f"_{i}.p"))
        columns.append(fail_if(F.col("_strangers") > 0, f"a {name} not asked for, for id", key, value).alias(f"{prefix}{n}"))
    return grouped.select(key, *columns)


def relabel_by_position(values: DataFrame, ids: DataFrame, key: str = ID) -> DataFrame:
    """Give the i-th row of one table the id of the i-th row of another.

    Only for inputs that carry no key: use a key join wherever there is one. Both tables must come straight from
    files. Position is the order of the files' paths, then of the rows in a file; tables of different
    length are an error.
    """
    left, n_left = _numbered(values.drop(key))
    right, n_right = _numbered(ids.select(key))
    if n_left != n_right:
        raise ValueError(f"{n_left} rows of values against {n_right} ids")
    return left.join(right, "_position").drop("_position")


def _numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows with their position, and how many there are.

    A task reads a block of a file in order, so a row's place in its block is a difference of row numbers; blocks are
    ordered by a table with one row each.
    """
    block = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    rows = df.select("*", *block, F.monotonically_increasing_id().alias("_row"))
    blocks = rows.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    total = blocks.agg(F.sum("_n")).first()[0] or 0
    joined = rows.join(placed, ["_file", "_start"])
    position = F.col("_before") + F.col("_row") - F.col("_first")
    return joined.select(*df.columns, position.alias("_position")), total
