"""Global order without a single-task sort.

``Window.orderBy(x)`` with no partition, or with one hot group, moves its rows to
one task. Everything here that needs an order over many rows goes through
buckets that follow that order:

* What needs one row per distinct score starts from a histogram: a partial
  aggregate collapses ties on the map side, so a value that holds a third of the
  rows is one row per task. What needs every row sets frequent values apart.
* Cut points between buckets are literals on the driver. A row's bucket is then
  a pure function of its value, and a retried task cannot disagree with the
  first attempt.
* Sums or ranks inside a bucket, plus the bucket's offset, are the global ones.
  Offsets join back on the keys the bucket window is partitioned by, so that join
  costs no shuffle of its own.

There is one path at every size. The histogram is written to the checkpoint folder, so the input is scanned and shuffled
once for it; its count, its cut points and its frequent values are read from the written table. ROWS_PER_BUCKET sets how
many buckets there are, one for a small table, and nothing else.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldmark.functions.scores import clean_score
from foldmark.session import cut_and_measure

ROWS_PER_BUCKET = 1 << 20
MAX_BUCKETS = 16384
SAMPLES_PER_BUCKET = 256
HOT_PAIRS = 4096
#: Slots at least that the rows of a frequent value spread over.
SPREAD = 64

_BUCKET = "_bucket"
_GROUP = "_group"
_SLOT = "_slot"


@dataclass(frozen=True)
class OrderPlan:
    """Row count of a table and the cut points of its order; no cuts means plain windows will do."""

    rows: int
    cuts: tuple[float, ...] = ()


def _sample_values(df: DataFrame, value: Column, rows: int, buckets: int) -> DataFrame:
    """About SAMPLES_PER_BUCKET values per bucket, for cut points.

    Cut points steer balance and never the result, so a sample is enough for them,
    as it is for Spark's own range partitioning. Unsampled, every task would send
    its whole quantile digest to one reducer.
    """
    fraction = SAMPLES_PER_BUCKET * buckets / rows
    values = df.select(value.alias("_value")).where(F.col("_value").isNotNull())
    return values.sample(fraction, seed=47) if fraction < 1 else values


def _quantiles(values: DataFrame, buckets: int) -> list[float]:
    fractions = [i / buckets for i in range(1, buckets)]
    cuts = values.select(F.percentile_approx("_value", fractions, 10 * buckets)).head()[0] or ()
    return sorted({c for c in cuts if math.isfinite(c)})


def plan_order(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> OrderPlan:
    """Count the rows and, if they exceed one bucket, cut the column at its quantiles.

    Both passes read this one column and shuffle next to nothing. Rows between two
    cuts number about ``rows_per_bucket``, ties aside.
    """
    value = clean_score(F.col(column))
    rows = df.select(F.count(value)).head()[0]
    buckets = min(MAX_BUCKETS, math.ceil(rows / rows_per_bucket))
    if buckets < 2:
        return OrderPlan(rows)
    return OrderPlan(rows, tuple(_quantiles(_sample_values(df, value, rows, buckets), buckets)))


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float]) -> DataFrame:
    """Bucket number that never decreases as the column grows; without cuts all rows are in one. A null goes with zero."""
    if not cuts:
        return df.withColumn(_BUCKET, F.lit(0))
    filled = df.withColumn("_filled", F.coalesce(column, F.lit(0.0)))
    bucketed = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_filled", outputCol=_BUCKET).transform(filled)
    # An integer: partitioning by a double is by a normalised copy, which later operators do not recognise.
    return bucketed.withColumn(_BUCKET, F.col(_BUCKET).cast("int")).drop("_filled")


def pack_group(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the group columns as one struct, and name it (or nothing, without a group).

    A struct is never null itself and equals another with null in the same places,
    so a plain equi-join on it keeps null groups. A null-safe join of the bare
    columns would hash derived expressions instead, which no window's partitioning
    matches, and shuffle again.
    """
    return (df.withColumn(_GROUP, F.struct(*group)), [_GROUP]) if group else (df, [])


def score_histogram(
    df: DataFrame,
    score: str,
    group: Sequence[str] = (),
    target: str | None = None,
    sums: Mapping[str, Column] | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """One row per (group, score): ``n`` rows, with a target ``pos`` and ``neg``, and sums of other columns.

    Null scores are left out; with ``keep_null`` they make a row with a null score that counts nothing but adds to the other sums,
    so that a group without scores stays.
    """
    value, named = clean_score(F.col(score)), [F.col(g) for g in group]
    extra = {f"_s{i}": c for i, c in enumerate((sums or {}).values())}
    kept = named + ([F.col(target).alias("_target")] if target else []) + [c.alias(k) for k, c in extra.items()]
    rows = df.select(value.alias(score), *kept)
    rows = rows if keep_null else rows.where(F.col(score).isNotNull())
    counts = [F.count(score).alias("n")]
    if target:
        scored, positive = F.col(score).isNotNull(), F.coalesce(F.col("_target") == 1, F.lit(False))
        counts += [
            F.count(F.when(scored & positive, 1)).alias("pos"),
            F.count(F.when(scored & ~positive, 1)).alias("neg"),
        ]
    counts += [F.sum(k).alias(name) for k, name in zip(extra, sums or {}, strict=True)]
    return rows.groupBy(*group, score).agg(*counts)


@dataclass(frozen=True)
class ScoreOrder:
    """A written score histogram and the cut points of its order."""

    hist: DataFrame
    score: str
    group: tuple[str, ...]
    cuts: tuple[float, ...] = ()


def order_histogram(
    hist: DataFrame, score: str, group: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> ScoreOrder:
    """The histogram, written, with cuts between about ``rows_per_bucket`` of its rows."""
    hist, found = cut_and_measure(hist, values=F.count(F.lit(1)))
    values = found["values"]
    buckets = min(MAX_BUCKETS, math.ceil(values / rows_per_bucket))
    cuts = _quantiles(_sample_values(hist, F.col(score), values, buckets), buckets) if buckets > 1 else ()
    return ScoreOrder(hist, score, tuple(group), tuple(cuts))


def order_scores(
    df: DataFrame,
    score: str,
    group: Sequence[str] = (),
    target: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    sums: Mapping[str, Column] | None = None,
    keep_null: bool = False,
) -> ScoreOrder:
    """The histogram of the scores in order, from one scan of the table."""
    return order_histogram(score_histogram(df, score, group, target, sums, keep_null), score, group, rows_per_bucket)


def prefix_sums(
    hist: DataFrame,
    score: str,
    cuts: Sequence[float] = (),
    group: Sequence[str] = (),
    sums: Sequence[str] = ("n",),
) -> DataFrame:
    """Add ``<c>_before`` (sum over smaller scores, null first) and ``<c>_total`` (sum over the group)."""
    packed, outer = pack_group(with_bucket(hist, score, cuts), group)
    keys = [_BUCKET, *outer]
    totals = packed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    across = Window.partitionBy(*outer).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(c).over(across), F.lit(0)).alias(f"_{c}_offset") for c in sums],
        *[F.sum(c).over(Window.partitionBy(*outer)).alias(f"{c}_total") for c in sums],
    )
    inside = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    local = packed.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_before") for c in sums]
    )
    return local.join(offsets, keys).select(
        *hist.columns,
        *[(F.col(f"{c}_before") + F.col(f"_{c}_offset")).alias(f"{c}_before") for c in sums],
        *[f"{c}_total" for c in sums],
    )


def with_ranks(
    df: DataFrame, score: str, key: str, group: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``avg_rank`` and ``min_rank`` of the score in its group; a null score keeps null ranks.

    The table is read twice, for its histogram and for its rows, and its rows are shuffled once:
    give it as files where computing it is dear. Ranks inside buckets plus the buckets' offsets, which the histogram
    has, are the global ones. A value that many rows have gets a slot of its own, in which every row has
    the same rank: the slot's offset says it. So do the two infinities. Such (slot, group) pairs of at least
    1/HOT_PAIRS of the rows number HOT_PAIRS at most and are broadcast; their rows,
    and those without a score, spread by a hash of the key instead of meeting in one task.
    """
    cleaned = df.withColumn(score, clean_score(F.col(score)))
    hist, found = cut_and_measure(
        score_histogram(cleaned, score, group), values=F.count(F.lit(1)), rows=F.coalesce(F.sum("n"), F.lit(0)), most=F.max("n")
    )
    rows = found["rows"]
    buckets = min(MAX_BUCKETS, max(1, math.ceil(rows / rows_per_bucket)))
    # Values that half a bucket's rows have in one group: two per bucket at most, and often none.
    frequent = hist.where(F.col("n") * 2 * buckets >= rows).select(score).distinct()
    hot = {r[0] for r in frequent.collect() if math.isfinite(r[0])} if (found["most"] or 0) * 2 * buckets >= rows > 0 else set()
    cuts = sorted(hot.union(_weighted_quantiles(hist, score, found["values"], buckets) if buckets > 1 else ()))
    starts = F.from_json(F.lit(json.dumps([None, *[c if c in hot else None for c in cuts]])), "array<double>")

    between = F.col(_BUCKET) * 2 + F.when(F.col(score) == F.get(starts, F.col(_BUCKET)), 2).otherwise(3)
    last = 2 * (len(cuts) + 1) + 2
    slot = F.when(F.col(score) == -math.inf, 0).when(F.col(score) == math.inf, last).otherwise(between)

    def slotted(table: DataFrame) -> tuple[DataFrame, list[str]]:
        return pack_group(with_bucket(table, score, cuts).withColumn(_SLOT, slot), group)

    counted, outer = slotted(hist)
    keys = [_SLOT, *outer]
    lower = Window.partitionBy(*outer).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy(*keys)
        .agg(F.sum("n").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    )
    settled = F.broadcast(
        offsets.where((F.col(_SLOT) % 2 == 0) & (F.col("_n") * HOT_PAIRS > rows)).select(
            *keys, F.col("_offset").alias("_hot_offset"), F.col("_n").alias("_hot_n")
        )
    )
    every, _ = slotted(cleaned)
    marked = every.join(settled, keys, "left")
    apart = F.col("_hot_n").isNotNull() | F.col(score).isNull()
    salt = -1 - F.pmod(F.xxhash64(F.col(key)), F.lit(max(buckets, SPREAD))).cast("int")
    placed = marked.withColumn(_SLOT, F.when(apart, salt).otherwise(F.col(_SLOT)))
    local = placed.withColumns(_window_ranks(score, keys))
    joined = local.join(offsets.drop("_n"), keys, "left")
    is_hot = F.col("_hot_n").isNotNull()
    first = F.when(is_hot, F.col("_hot_offset") + 1).otherwise(F.col("_offset") + F.col("_first"))
    final = F.when(is_hot, F.col("_hot_offset") + F.col("_hot_n")).otherwise(F.col("_offset") + F.col("_last"))
    known = F.col(score).isNotNull()
    return joined.select(
        *df.columns,
        F.when(known, (first + final) / 2.0).cast("double").alias("avg_rank"),
        F.when(known, first).cast("bigint").alias("min_rank"),
    )


def _weighted_quantiles(hist: DataFrame, score: str, values: int, buckets: int) -> list[float]:
    """Cut points between which about as many rows lie, from a sample of a histogram's values with their counts."""
    sample = _sample_values(hist, F.struct(score, "n"), values, buckets).select("_value.*")
    fractions = [i / buckets for i in range(1, buckets)]
    cuts = sample.where(F.col(score).isNotNull()).select(F.percentile(score, fractions, F.col("n"))).head()[0] or ()
    return sorted({c for c in cuts if math.isfinite(c)})


def _window_ranks(score: str, partition: Sequence[str]) -> dict[str, Column]:
    """First and last place of a score among its ties, nulls after all others; one window for both."""
    ordered = Window.partitionBy(*partition).orderBy(F.col(score).asc_nulls_last())
    ties_included = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return {"_first": F.rank().over(ordered), "_last": F.count("*").over(ties_included)}


def row_numbers(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    out: str,
    tiebreak: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    plan: OrderPlan | None = None,
) -> DataFrame:
    """``row_number() over (partition by group order by column, tiebreak)`` that splits hot groups.

    The column is numeric and not null. Rows that tie on it share a bucket, so it
    should be nearly unique, as an event number is.
    """
    plan = plan or plan_order(df, column, rows_per_bucket)
    if not plan.cuts:
        window = Window.partitionBy(*group).orderBy(column, *tiebreak)
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    bucketed = with_bucket(df.withColumn("_order", F.col(column).cast("double")), "_order", plan.cuts)
    packed, outer = pack_group(bucketed, group)
    keys = [_BUCKET, *outer]
    across = Window.partitionBy(*outer).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        packed.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys).orderBy(column, *tiebreak)
    local = packed.withColumn("_local", F.row_number().over(inside).cast("bigint"))
    return local.join(offsets, keys).select(*df.columns, (F.col("_local") + F.col("_offset")).alias(out))


def seeded_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))


def hashed_row_numbers(
    df: DataFrame,
    key: str,
    seed: int,
    out: str,
    classes: Sequence[str] = (),
    total: str | None = None,
    tiebreak: Sequence[str] = (),
    digits: int = 3,
) -> DataFrame:
    """Number the rows by (classes, seeded hash of key): a reproducible shuffle, class by class.

    Hex digits of md5 are uniform, so the first ``digits`` of them cut every
    class into 16**digits even buckets: 4096, or 65536 with four digits, which pay
    from some billion rows on. The offset table has one row per (class, bucket);
    ``classes`` must be of low cardinality, as labels are.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn(
        _BUCKET, F.substring("_hash", 1, digits)
    )
    packed, outer = pack_group(hashed, classes)
    keys = [_BUCKET, *outer]
    counts = packed.groupBy(*keys).agg(F.count("*").alias("_n"))
    across = Window.orderBy(*outer, _BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    inside = Window.partitionBy(*keys).orderBy("_hash", key, *tiebreak)
    local = packed.withColumn("_local", F.row_number().over(inside).cast("bigint"))
    extra = [F.col("_rows").cast("bigint").alias(total)] if total else []
    return local.join(offsets, keys).select(*df.columns, (F.col("_local") + F.col("_offset")).alias(out), *extra)
