"""Column expressions over scores, logits and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(logit: Column) -> Column:
    """Logistic function; the exponent is never positive, so it cannot overflow."""
    small = F.exp(-F.abs(logit))
    return F.when(logit >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def smooth_label(target: Column, alpha: float) -> Column:
    return target.cast("double") * F.lit(1.0 - alpha) + F.lit(alpha / 2)


def weighted_bce(logit: Column, target: Column, pos_weight: float = 1.0, smoothing: float = 0.0) -> Column:
    """Binary cross-entropy on a logit, with label smoothing and a positive-class weight."""
    y = smooth_label(target, smoothing)
    weight = 1 + F.lit(pos_weight - 1.0) * y
    return (1 - y) * logit + weight * (F.log1p(F.exp(-F.abs(logit))) + F.greatest(-logit, F.lit(0.0)))


def is_correct(score: Column, target: Column) -> Column:
    """1.0 where the score rounds to the label; one half rounds to the even side, 0."""
    return (F.bround(score) == target).cast("double")


def blend(first: Column, second: Column, weight: float) -> Column:
    return F.lit(1.0 - weight) * first + F.lit(weight) * second


def clean_score(score: Column) -> Column:
    """NaN stands for a missing score at the file boundary; inside the toolkit it is null.

    Adding zero makes negative zero positive, so that bucketing agrees with equality.
    """
    return F.nanvl(score.cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
