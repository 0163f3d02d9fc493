"""From raw label tables to the prepared training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldmark.operators.splits import stratified_folds
from foldmark.schemas import DROPPED_COLUMNS, ID, SITE
from foldmark.session import cut_lineage

# Site variants and the site they stand for.
CANONICAL_SITES = {
    "posterior torso": "torso",
    "lateral torso": "torso",
    "anterior torso": "torso",
}


def union_sources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Union by column name, each row tagged with its ``dataset``; missing columns are null, repeats are kept."""
    if not tables:
        raise ValueError("no table to union")
    merged = None
    for name, df in tables.items():
        tagged = df.withColumn("dataset", F.lit(name))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def drop_columns(df: DataFrame, columns: Sequence[str] = DROPPED_COLUMNS) -> DataFrame:
    """Drop named columns, all of which must exist."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    return df.drop(*columns)


def drop_denied(df: DataFrame, denied: DataFrame | Sequence[str], key: str = ID) -> DataFrame:
    """Leave out the rows whose id is listed. The size of the list decides the join, not a hint."""
    if not isinstance(denied, DataFrame):
        ids = [(i,) for i in denied]
        denied = df.sparkSession.createDataFrame(ids, f"`{key}` string")
    return df.join(denied.select(key), key, "left_anti")


def canonical_sites(df: DataFrame, mapping: Mapping[str, str] = CANONICAL_SITES, column: str = SITE) -> DataFrame:
    return df.replace(dict(mapping), subset=[column])


def only_dataset(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("dataset").isin(*names))


def flag_sanity_rows(
    df: DataFrame, per_group: int = 2, class_column: str = "target", order: Sequence[str] = (ID, "dataset")
) -> DataFrame:
    """Add ``sanity_check`` = 1 for the first rows of every (fold, class).

    The numbering is filtered at once, so each map task passes on ``per_group``
    rows per group; what joins back is one bound per (fold, class): eight times the
    number of labels, so it is broadcast, and the rows are not shuffled by their class.
    The table is read twice.
    """
    window = Window.partitionBy("fold", class_column).orderBy(*order)
    place = F.struct(*[F.col(c) for c in order])
    bounds = (
        df.select("fold", class_column, *order)
        .withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") <= per_group)
        .groupBy("fold", class_column)
        .agg(F.max(place).alias("_last"))
    )
    flagged = df.join(F.broadcast(bounds), ["fold", class_column], "left")
    flag = F.coalesce((place <= F.col("_last")).cast("int"), F.lit(0))
    return flagged.select(*df.columns, flag.alias("sanity_check"))


def sanity_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("sanity_check") == 1)


def prepare_training_table(
    tables: Mapping[str, DataFrame],
    denied: DataFrame | Sequence[str] | None = None,
    drop: Sequence[str] = DROPPED_COLUMNS,
    seed: int = 47,
) -> DataFrame:
    """Union, clean, assign folds and flag the sanity rows. Without ``denied`` no row is left out.

    The table with its folds is written to the checkpoint folder once, as the flags read it again.
    """
    merged = drop_columns(union_sources(tables), drop)
    if denied is not None:
        merged = drop_denied(merged, denied)
    folded = stratified_folds(canonical_sites(merged), seed=seed, tiebreak=("dataset",))
    return flag_sanity_rows(cut_lineage(folded))
