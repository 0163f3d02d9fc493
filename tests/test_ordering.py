"""Scaled path against plain windows: same rows whatever the buckets, the skew or the partitioning."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldmark.operators import metrics, ordering
from foldmark.operators.ordering import (
    hashed_row_numbers,
    order_scores,
    plan_order,
    prefix_sums,
    row_numbers,
    with_ranks,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """One score holds a third of the rows, one group most of them; null scores, NaN and a null group."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        group = rng.choice(["a", "a", "a", "a", "b", None])
        score = rng.choice([0.5, rng.random(), round(rng.random(), 1)])
        if i % 50 == 0:
            score = None if i % 100 else float("nan")
        rows.append((i, group, score, int(rng.random() < 0.3)))
    return spark.createDataFrame(rows, "id long, g string, p double, y int").repartition(5).cache()


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _plain_ranks(df):
    p = F.nanvl("p", F.lit(None).cast("double"))
    ordered = Window.partitionBy("g", p.isNull()).orderBy("p")
    tied = Window.partitionBy("g", "p")
    has = p.isNotNull()
    return df.select(
        "id",
        F.when(has, F.rank().over(ordered) + (F.count("*").over(tied) - 1) / 2).alias("avg_rank"),
        F.when(has, F.rank().over(ordered)).cast("bigint").alias("min_rank"),
    )


@pytest.mark.parametrize("rows_per_bucket", [50, 400, 1 << 20])
@pytest.mark.parametrize("hot_pairs", [2, 4096])
@pytest.mark.parametrize("samples", [2, 256])
def test_ranks_equal_plain_window(spark, skewed, rows_per_bucket, hot_pairs, samples, monkeypatch):
    monkeypatch.setattr(ordering, "HOT_PAIRS", hot_pairs)
    monkeypatch.setattr(ordering, "SAMPLES_PER_BUCKET", samples)
    got = with_ranks(skewed, "p", "id", ("g",), rows_per_bucket)
    assert got.columns == [*skewed.columns, "avg_rank", "min_rank"]
    assert _sorted(got.select("id", "avg_rank", "min_rank")) == _sorted(_plain_ranks(skewed))


def test_ranks_without_groups_and_with_extremes(spark):
    values = [float("-inf"), float("inf"), -0.0, 0.0, 1e300, -1e300, None] * 40 + [float(i) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, p double")
    small, large = (with_ranks(df, "p", "id", (), n) for n in (1 << 20, 20))
    assert _sorted(small) == _sorted(large)


def test_hot_rows_spread_over_partitions(spark, skewed):
    ranked = with_ranks(skewed, "p", "id", ("g",), 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # The maxima keep the ranks, and so the shuffle, in the plan.
        per_task = ranked.groupBy(F.spark_partition_id(), (F.col("p") == 0.5).alias("hot")).agg(
            F.count("*").alias("n"), F.max("min_rank")
        )
        hot = [r.n for r in per_task.collect() if r.hot]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) >= 8 and sum(hot) > 800
    assert max(hot) < 0.35 * sum(hot)


def test_prefix_sums_add_up(spark, skewed):
    order = order_scores(skewed, "p", (), "y", 50)
    sums = prefix_sums(order.hist, "p", order.cuts, (), ("n", "pos")).orderBy("p").collect()
    n = pos = 0
    for row in sums:
        assert (row["n_before"], row["pos_before"]) == (n, pos)
        n, pos = n + row["n"], pos + row["pos"]
    assert {r["n_total"] for r in sums} == {n}


def test_bucket_window_joins_offsets_without_another_shuffle(spark, skewed):
    order = order_scores(skewed, "p", ("g",), None, 50)
    table = prefix_sums(order.hist, "p", order.cuts, ("g",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows to buckets, totals to buckets, totals to groups, offsets back to buckets.
    assert plan.count("Exchange hashpartitioning") <= 4


def test_row_numbers_split_hot_groups(spark, skewed):
    window = Window.partitionBy("g").orderBy("id")
    expected = skewed.select("id", F.row_number().over(window).cast("bigint").alias("k"))
    got = row_numbers(skewed, ("g",), "id", "k", rows_per_bucket=100)
    assert got.columns == [*skewed.columns, "k"]
    assert _sorted(got.select("id", "k")) == _sorted(expected)


def test_plan_has_cuts_only_for_large_tables(spark, skewed):
    assert plan_order(skewed, "id").cuts == ()
    plan = plan_order(skewed, "id", 500)
    assert plan.rows == 3000 and len(plan.cuts) == 5 and list(plan.cuts) == sorted(plan.cuts)


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_hashed_numbers_equal_one_window(spark, skewed, digits):
    key = F.md5(F.concat(F.col("id").cast("string"), F.lit(":7")))
    expected = skewed.select(
        "id",
        F.row_number().over(Window.orderBy("g", key)).cast("bigint").alias("k"),
        F.lit(3000).cast("bigint").alias("n"),
    )
    for parts in (1, 9):
        got = hashed_row_numbers(
            skewed.repartition(parts), "id", 7, "k", ("g",), total="n", digits=digits
        ).select("id", "k", "n")
        assert _sorted(got) == _sorted(expected)


def test_empty_table(spark, skewed):
    none = skewed.where("false")
    assert with_ranks(none, "p", "id", ("g",)).count() == 0
    assert hashed_row_numbers(none, "id", 1, "k").count() == 0


def test_infinite_scores_share_slots_of_their_own(spark):
    """A third of the rows at one infinity: ranks as by a plain window, and no task holds them all."""
    rows = [(i, float("inf") if i % 3 == 0 else float("-inf") if i % 7 == 0 else float(i % 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, p double")
    small, large = ({r.id: (r.avg_rank, r.min_rank) for r in with_ranks(df, "p", "id", rows_per_bucket=n).collect()} for n in (1 << 20, 60))
    assert small == large
    ranked = with_ranks(df, "p", "id", rows_per_bucket=60).where("p = double('infinity')")
    per_task = [r["n"] for r in ranked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 200


def test_quartiles_between_equal_infinities(spark):
    df = spark.createDataFrame([("a", float("inf"))] * 5 + [("a", 1.0)], "model string, p double")
    row = metrics.describe(df, "p").head()
    assert row["p50"] == row["p75"] == float("inf")
