"""Exact metrics of scores against 0/1 labels, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.functions.scores import is_correct, weighted_bce
from foldmark.operators.ordering import (
    _BUCKET,
    ROWS_PER_BUCKET,
    ScoreOrder,
    order_histogram,
    order_scores,
    pack_group,
    prefix_sums,
    score_histogram,
    with_bucket,
)


def roc_auc(
    df: DataFrame,
    score: str,
    target: str,
    group: Sequence[str] = (),
    no_positive: float | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Area under the ROC curve with ties counted half, one row per group.

    Null when a class is missing, or ``no_positive`` when there is no positive row.
    """
    return auc_of(order_scores(df, score, group, target, rows_per_bucket), no_positive)


def auc_of(order: ScoreOrder, no_positive: float | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """(group, auc, n_pos, n_neg and the sums) of a written histogram.

    Won pairs are counted inside each bucket; pairs across buckets need only the
    buckets' totals, so no offset goes back to the histogram's rows.
    """
    packed, outer = pack_group(with_bucket(order.hist, order.score, order.cuts), order.group)
    keys = [_BUCKET, *outer]
    below = Window.partitionBy(*keys).orderBy(order.score).rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / F.lit(2.0)
    counted = packed.select(*keys, "pos", "neg", (F.col("pos").cast("double") * beaten).alias("wins"), *sums)
    parts = counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "wins", *sums)])
    lower = Window.partitionBy(*outer).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("pos").cast("double") * F.coalesce(F.sum("neg").over(lower), F.lit(0))
    total = (
        parts.withColumn("wins", F.col("wins") + across)
        .groupBy(*outer)
        .agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "wins", *sums)])
    )
    pairs = F.col("pos").cast("double") * F.col("neg").cast("double")
    auc = F.try_divide(F.col("wins"), F.nullif(pairs, F.lit(0.0)))
    if no_positive is not None:
        auc = F.when(F.coalesce("pos", F.lit(0)) == 0, F.lit(no_positive)).otherwise(auc)
    return total.select(
        *[F.col(f"{outer[0]}.`{g}`").alias(g) for g in order.group],
        auc.alias("auc"),
        F.col("pos").cast("bigint").alias("n_pos"),
        F.col("neg").cast("bigint").alias("n_neg"),
        *sums,
    )


def _next_counts(order: ScoreOrder) -> DataFrame:
    """Add the (pos, neg) counts of the next lower score, across bucket borders as well."""
    hist, score, group, pair = order.hist, order.score, order.group, F.struct("pos", "neg")
    packed, outer = pack_group(with_bucket(hist, score, order.cuts), group)
    keys = [_BUCKET, *outer]
    tops = packed.groupBy(*keys).agg(F.max_by(pair, F.col(score)).alias("_top"))
    borders = tops.select(*keys, F.lag("_top").over(Window.partitionBy(*outer).orderBy(_BUCKET)).alias("_border"))
    local = packed.withColumn("_inside", F.lag(pair).over(Window.partitionBy(*keys).orderBy(score)))
    return local.join(borders, keys).select(*hist.columns, F.coalesce("_inside", "_border").alias("_next"))


def roc_curve(
    df: DataFrame,
    score: str,
    target: str,
    group: Sequence[str] = (),
    drop_collinear: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Points (fpr, tpr, threshold), one per distinct score plus the (0, 0) start.

    The start's threshold is the largest score plus one. ``drop_collinear`` leaves
    out points at which the curve does not bend, as plots need no more.
    """
    order = order_scores(df, score, group, target, rows_per_bucket)
    hist = _next_counts(order) if drop_collinear else order.hist
    sums = prefix_sums(hist, score, order.cuts, group, ("pos", "neg"))
    # Counts at or above the threshold: the group's total less everything below.
    tp, fp = F.col("pos_total") - F.col("pos_before"), F.col("neg_total") - F.col("neg_before")
    is_first = (tp == F.col("pos")) & (fp == F.col("neg"))
    if drop_collinear:
        following = F.col("_next")
        bends = (following["pos"] != F.col("pos")) | (following["neg"] != F.col("neg"))
        sums = sums.where(following.isNull() | is_first | bends)

    def point(fpr: Column, tpr: Column, threshold: Column) -> Column:
        return F.struct(fpr.alias("fpr"), tpr.alias("tpr"), threshold.alias("threshold"))

    here = point(
        F.try_divide(fp, F.nullif(F.col("neg_total"), F.lit(0))).cast("double"),
        F.try_divide(tp, F.nullif(F.col("pos_total"), F.lit(0))).cast("double"),
        F.col(score),
    )
    start = point(F.lit(0.0), F.lit(0.0), F.col(score) + 1)
    return sums.select(*group, F.inline(F.when(is_first, F.array(start, here)).otherwise(F.array(here))))


def accuracy(df: DataFrame, score: str, target: str, group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(is_correct(F.col(score), F.col(target))).alias("accuracy"))


def mean_loss(
    df: DataFrame,
    logit: str,
    target: str,
    group: Sequence[str] = (),
    pos_weight: float = 1.0,
    smoothing: float = 0.0,
) -> DataFrame:
    loss = weighted_bce(F.col(logit), F.col(target), pos_weight, smoothing)
    return df.groupBy(*group).agg(F.avg(loss).alias("loss"))


def epoch_metrics(
    df: DataFrame,
    logit: str,
    score: str,
    target: str,
    group: Sequence[str] = ("run", "fold", "epoch"),
    pos_weight: float = 1.0,
    smoothing: float = 0.0,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Validation loss, accuracy and AUC per group; an epoch without positives has AUC 0.5.

    One scan: the histogram of scores carries the sums of losses and of right rows.
    """
    loss = weighted_bce(F.col(logit), F.col(target), pos_weight, smoothing)
    right = is_correct(F.col(score), F.col(target))
    sums = {"_loss": loss, "_losses": loss.isNotNull().cast("int"), "_right": right, "_judged": right.isNotNull().cast("int")}
    order = order_scores(df, score, group, target, rows_per_bucket, sums, keep_null=True)
    found = auc_of(order, 0.5, list(sums))

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.col(total), F.nullif(F.col(n), F.lit(0)))

    return found.select(
        *group, mean("_loss", "_losses").alias("val_loss"), mean("_right", "_judged").alias("val_acc"), F.col("auc").alias("val_auc")
    )


def describe(
    df: DataFrame, value: str, group: Sequence[str] = ("model",), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """count, mean, std, min, quartiles, max per group, nulls left out; quartiles exact and interpolated.

    ``percentile`` would hold a whole group's distinct values in one task; the quartiles are read off the cumulative
    histogram instead, and so is all else, from one scan: the group's mean stands beside every value when the squares
    are summed, so that they keep their digits.
    """
    hist = score_histogram(df, value, group, keep_null=True).withColumn("_sum", F.coalesce(F.col(value) * F.col("n"), F.lit(0.0)))
    order = order_histogram(hist, value, group, rows_per_bucket)
    sums = prefix_sums(order.hist, value, order.cuts, group, ("n", "_sum"))
    mean = F.try_divide(F.col("_sum_total"), F.nullif(F.col("n_total"), F.lit(0)))
    squares = F.sum(F.col("n") * (F.col(value) - mean) * (F.col(value) - mean))
    picks = [
        F.sum("n").alias("count"),
        F.max(mean).alias("mean"),
        F.sqrt(F.try_divide(squares, F.nullif(F.max("n_total") - 1, F.lit(0)))).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    outputs = []
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        place = F.lit(q) * (F.col("n_total") - 1)
        low = F.floor(place)
        high = F.least(low + 1, F.col("n_total") - 1)
        for side, index in (("low", low), ("high", high)):
            holds = (F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}_{side}"))
        picks.append(F.max(place - low).alias(f"_{name}_part"))
        lower, upper = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        between = lower + (upper - lower) * F.col(f"_{name}_part")
        outputs.append(F.when(lower == upper, lower).otherwise(between).alias(name))  # two infinities too
    return sums.groupBy(*group).agg(*picks).select(*group, "count", "mean", "std", "min", *outputs, "max")
