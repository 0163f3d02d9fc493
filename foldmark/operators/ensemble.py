"""Rules that combine the scores of several models.

Input is the long table (id, model, p); every rule but the rank rule is one
``groupBy(id)`` over combinable aggregates.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmark.functions.encode import lookup
from foldmark.functions.scores import blend
from foldmark.operators.contracts import align_predictions
from foldmark.operators.ordering import ROWS_PER_BUCKET, with_ranks
from foldmark.schemas import ID
from foldmark.session import cut_lineage

# The cutoff pairs in use, above/below.
VALIDATION_CUTOFFS = (0.66, 0.33)
SUBMISSION_CUTOFFS = (0.7, 0.01)


def mean_ensemble(long: DataFrame, key: str = ID) -> DataFrame:
    return long.groupBy(key).agg(F.avg("p").alias("target"))


def power_mean_ensemble(long: DataFrame, key: str = ID, exponent: float = 2.0) -> DataFrame:
    """Mean of powers, left without the root: its order, and so its AUC, is the same."""
    return long.groupBy(key).agg(F.avg(F.pow("p", F.lit(exponent))).alias("target"))


def mean_ranks(long: DataFrame, key: str = ID, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mean over models of the average rank within each model; a null score has no rank."""
    ranked = with_ranks(long, "p", key, ("model",), rows_per_bucket)
    return ranked.groupBy(key).agg(F.avg("avg_rank").alias("mean_rank"))


def rank_ensemble(long: DataFrame, key: str = ID, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Minimum rank of the mean rank. The mean ranks are written, as they are read twice."""
    means = cut_lineage(mean_ranks(long, key, rows_per_bucket))
    ranked = with_ranks(means, "mean_rank", key, (), rows_per_bucket)
    return ranked.select(key, F.col("min_rank").alias("target"))


def consensus_ensemble(
    long: DataFrame,
    base: str | DataFrame,
    above: float = VALIDATION_CUTOFFS[0],
    below: float = VALIDATION_CUTOFFS[1],
    key: str = ID,
    base_votes: bool = True,
    models: Sequence[str] | None = None,
) -> DataFrame:
    """Largest score where all models exceed ``above``, smallest where all stay under ``below``, else the base.

    ``base`` names a model of the long table (read in the same aggregate) or is a
    table (id, p), one row per id, joined by id. A model without a score for the id, in
    a null or by no row at all, rules out a consensus. ``models`` are those asked; if not given, all
    that occur in the long table (one pass over it). With ``base_votes=False`` a base model from
    the long table is not asked.
    """
    named = isinstance(base, str)
    asked = [m for m in (model_names(long) if models is None else models) if not named or base_votes or m != base]
    votes = F.when(F.col("model").isin(asked), F.col("p"))
    summary = [F.max(votes).alias("_max"), F.min(votes).alias("_min"), _all_voted(asked).alias("_full")]
    if named:
        summary.append(F.max(F.when(F.col("model") == base, F.col("p"))).alias("_base"))
    grouped = long.groupBy(key).agg(*summary)
    if not named:
        best = base.select(key, F.col("p").alias("_base"))
        grouped = align_predictions(grouped, best, key, ("_base",), strict=False, unique=True)
    full = F.col("_full")
    target = (
        F.when(full & (F.col("_min") > above), F.col("_max"))
        .when(full & (F.col("_max") < below), F.col("_min"))
        .otherwise(F.col("_base"))
    )
    return grouped.select(key, target.alias("target"))


def blend_two(first: DataFrame, second: DataFrame, weight: float, key: str = ID, score: str = "target") -> DataFrame:
    """(1 - weight) * first + weight * second, matched by id; an id without a partner, or with two, is an error."""
    a = first.select(key, F.col(score).alias("_a"))
    b = second.select(key, F.col(score).alias("_b"))
    return align_predictions(a, b, key, ("_b",), unique=True).select(key, blend(F.col("_a"), F.col("_b"), weight).alias(score))


def scale_scores(long: DataFrame, factors: float | Mapping[str, float]) -> DataFrame:
    """Scores times one constant, or times a constant per model (1 where none is given)."""
    factor = F.lit(factors) if isinstance(factors, (int, float)) else lookup(F.col("model"), factors, 1.0)
    return long.withColumn("p", F.col("p") * factor)


def row_statistics(long: DataFrame, key: str = ID) -> DataFrame:
    """Max, min, mean and exact median over the models of a row."""
    return long.groupBy(key).agg(
        F.max("p").alias("max"), F.min("p").alias("min"), F.avg("p").alias("mean"), F.median("p").alias("median")
    )


def _all_voted(models: Sequence[str]) -> Column:
    """Whether each of the models has a score for the id; repeats by one don't stand in for another."""
    scores = [F.count(F.when(F.col("model") == m, F.col("p"))) > 0 for m in models]
    return functools.reduce(operator.and_, scores, F.lit(True))


def unanimous(
    long: DataFrame, above: float, below: float, key: str = ID, models: Sequence[str] | None = None
) -> DataFrame:
    """Whether every model exceeds / stays under a cutoff; a missing vote, null or no row, is no vote for either.

    ``models`` are those asked; if not given, all that occur in the long table.
    """
    asked = model_names(long) if models is None else models
    votes, full = F.when(F.col("model").isin(list(asked)), F.col("p")), _all_voted(asked)
    return long.groupBy(key).agg(
        F.coalesce(full & (F.min(votes) > above), F.lit(False)).alias("all_above"),
        F.coalesce(full & (F.max(votes) < below), F.lit(False)).alias("all_below"),
    )


def lowest_mean_ranks(long: DataFrame, n: int, key: str = ID) -> DataFrame:
    return mean_ranks(long, key).orderBy("mean_rank", key).limit(n)


def largest(df: DataFrame, column: str, n: int, key: str = ID) -> DataFrame:
    """The n largest values, nulls last, ties by id."""
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(key)).limit(n)


Rule = Callable[[DataFrame, str], DataFrame]
RULES: dict[str, Rule] = {
    "mean": mean_ensemble,
    "power": power_mean_ensemble,
    "rank": rank_ensemble,
}


def register_rule(name: str, rule: Rule) -> None:
    """Add an ensemble rule: (long table, key) -> (key, target)."""
    if name in RULES:
        raise ValueError(f"rule {name!r} is already registered")
    RULES[name] = rule


def consensus_rule(base: str, above: float, below: float) -> Rule:
    """A registrable consensus rule around one base model."""
    return lambda long, key=ID: consensus_ensemble(long, base, above, below, key)


def apply_rule(name: str, long: DataFrame, key: str = ID) -> DataFrame:
    if name not in RULES:
        raise ValueError(f"unknown ensemble rule {name!r}; known: {', '.join(sorted(RULES))}")
    return RULES[name](long, key)


def model_names(long: DataFrame) -> Sequence[str]:
    """Distinct model names, a driver-side list as short as the ensemble is wide."""
    return [r[0] for r in long.select("model").distinct().orderBy("model").collect()]
