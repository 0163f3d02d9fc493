import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from foldmark.functions.scores import sigmoid, weighted_bce
from foldmark.operators import metrics


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    if not pos or not neg:
        return None
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = [
        (i, i % 3 if i % 7 else None, rng.choice([0.4, round(rng.random(), 2), rng.random()]), int(rng.random() < 0.4))
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, "id long, g int, p double, y int").cache()


@pytest.mark.parametrize("rows_per_bucket", [40, 1 << 20])
def test_auc_equals_pair_count_and_evaluator(spark, scored, rows_per_bucket):
    rows = scored.collect()
    expected = brute_auc([r.p for r in rows], [r.y for r in rows])
    got = metrics.roc_auc(scored, "p", "y", rows_per_bucket=rows_per_bucket).head()
    assert got["auc"] == pytest.approx(expected, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert got["auc"] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [40, 1 << 20])
def test_auc_by_group_keeps_the_null_group(spark, scored, rows_per_bucket):
    got = {r.g: r for r in metrics.roc_auc(scored, "p", "y", ("g",), rows_per_bucket=rows_per_bucket).collect()}
    rows = scored.collect()
    assert set(got) == {0, 1, 2, None}
    for g, r in got.items():
        part = [x for x in rows if x.g == g]
        assert r.auc == pytest.approx(brute_auc([x.p for x in part], [x.y for x in part]), abs=1e-12)
        assert r.n_pos + r.n_neg == len(part)


def test_auc_is_unchanged_by_monotone_maps_and_partitioning(spark, scored):
    base = metrics.roc_auc(scored, "p", "y").head()["auc"]
    for other in (F.exp("p"), F.col("p") * 3 - 9, F.pow("p", F.lit(2))):
        mapped = scored.repartition(11).withColumn("p", other)
        assert metrics.roc_auc(mapped, "p", "y", rows_per_bucket=100).head()["auc"] == pytest.approx(base, abs=1e-12)


def test_auc_edge_cases(spark):
    def auc(rows, **kw):
        return metrics.roc_auc(spark.createDataFrame(rows, "p double, y int"), "p", "y", **kw).head()["auc"]

    assert auc([(0.5, 1), (0.5, 0), (0.5, 0)]) == 0.5
    assert auc([(0.9, 1), (0.1, 0)]) == 1.0
    assert auc([(0.1, 1), (0.9, 0)]) == 0.0
    assert auc([(0.1, 0), (0.9, 0)]) is None
    assert auc([(0.1, 0), (0.9, 0)], no_positive=0.5) == 0.5
    assert auc([(0.1, 1)], no_positive=0.5) is None
    assert auc([(0.9, 1), (None, 1), (0.1, 0)]) == 1.0


def _roc(points):
    return sorted((round(r.threshold, 9), round(r.fpr, 9), round(r.tpr, 9)) for r in points.collect())


def test_roc_curve_scaled_path_and_area(spark, scored):
    for drop in (True, False):
        small = metrics.roc_curve(scored, "p", "y", drop_collinear=drop)
        large = metrics.roc_curve(scored, "p", "y", drop_collinear=drop, rows_per_bucket=40)
        assert _roc(small) == _roc(large)
        points = sorted((r.fpr, r.tpr) for r in small.collect())
        assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert area == pytest.approx(metrics.roc_auc(scored, "p", "y").head()["auc"], abs=1e-9)


def test_roc_drops_only_straight_points(spark):
    rows = [(0.9, 1), (0.8, 1), (0.7, 1), (0.6, 0), (0.5, 1), (0.4, 0)]
    df = spark.createDataFrame(rows, "p double, y int")
    got = _roc(metrics.roc_curve(df, "p", "y"))
    assert [g[0] for g in got] == [0.4, 0.5, 0.6, 0.7, 0.9, 1.9]


@pytest.mark.parametrize("rows_per_bucket", [40, 1 << 20])
def test_describe_is_exact(spark, scored, rows_per_bucket):
    got = metrics.describe(scored, "p", (), rows_per_bucket).head()
    p = np.array([r.p for r in scored.collect()])
    assert got["count"] == len(p)
    expected = dict(
        mean=p.mean(), std=p.std(ddof=1), min=p.min(), p25=np.quantile(p, 0.25),
        p50=np.quantile(p, 0.5), p75=np.quantile(p, 0.75), max=p.max(),
    )
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-9), name


def test_describe_skips_nulls_and_keeps_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", None)], "model string, p double")
    got = {r.model: r for r in metrics.describe(df, "p").collect()}
    assert got["a"]["count"] == 2 and got["a"]["p50"] == 1.5
    assert got["b"]["count"] == 0 and got["b"]["p50"] is None


def test_accuracy_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.51, 1), (0.49, 0)], "p double, y int")
    assert metrics.accuracy(df, "p", "y").head()["accuracy"] == 0.75


def test_loss_equals_definition_and_stays_finite(spark):
    rows = [(x, y) for x in (-700.0, -3.0, 0.0, 2.5, 700.0) for y in (0, 1)]
    df = spark.createDataFrame(rows, "x double, y int")
    got = df.select("x", "y", weighted_bce(F.col("x"), F.col("y"), 3.0, 0.1).alias("l"), sigmoid(F.col("x")).alias("s"))
    for r in got.collect():
        y = r.y * 0.9 + 0.05
        log_p = -np.logaddexp(0, -r.x)
        log_q = -np.logaddexp(0, r.x)
        assert r.l == pytest.approx(-(3.0 * y * log_p + (1 - y) * log_q), rel=1e-9)
        assert 0 <= r.s <= 1 and math.isfinite(r.s)


def test_epoch_metrics_without_positives(spark):
    df = spark.createDataFrame(
        [("r", 0, 0, 1.0, 0.7, 0), ("r", 0, 0, -1.0, 0.3, 0), ("r", 0, 1, 1.0, 0.7, 1), ("r", 0, 1, -1.0, 0.3, 0)],
        "run string, fold int, epoch int, logit double, p double, target int",
    )
    got = {r.epoch: r for r in metrics.epoch_metrics(df, "logit", "p", "target").collect()}
    assert got[0]["val_auc"] == 0.5 and got[1]["val_auc"] == 1.0
    assert got[0]["val_acc"] == 0.5 and got[1]["val_acc"] == 1.0


def test_one_scan_of_the_input(spark, tmp_path):
    """Every measure reads its input once, at any size: what comes after reads the written histogram."""
    path = str(tmp_path / "scores")
    rows = [(i % 3, float(i % 50) / 7, float(i % 50) / 50, i % 2) for i in range(900)]
    spark.createDataFrame(rows, "model int, logit double, p double, y int").write.parquet(path)
    for n in (1 << 20, 30):
        for measure in (
            lambda df: metrics.roc_auc(df, "p", "y", ("model",), rows_per_bucket=n),
            lambda df: metrics.roc_curve(df, "p", "y", ("model",), rows_per_bucket=n),
            lambda df: metrics.describe(df, "p", rows_per_bucket=n),
            lambda df: metrics.epoch_metrics(df, "logit", "p", "y", ("model",), rows_per_bucket=n),
        ):
            seen = spark.sparkContext.accumulator(0)

            def counted(batches, seen=seen):
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            df = spark.read.parquet(path)
            assert measure(df.mapInArrow(counted, df.schema)).count() > 0
            assert seen.value == 900


def test_measures_of_groups_without_scores(spark):
    rows = [("a", 0.0, 0.25, 1), ("a", 1.0, 0.75, 0), ("b", 2.0, None, 1), (None, 1.0, 0.5, 1)]
    df = spark.createDataFrame(rows, "model string, logit double, p double, y int")
    found = {r.model: r for r in metrics.describe(df, "p").collect()}
    assert found["b"]["count"] == 0 and found["b"]["mean"] is None and found["b"]["p50"] is None
    assert found["a"]["mean"] == 0.5 and found["a"]["p50"] == 0.5 and found[None]["std"] is None
    epochs = {r.model: r for r in metrics.epoch_metrics(df, "logit", "p", "y", ("model",)).collect()}
    assert epochs["b"].val_auc == 0.5 and epochs["b"].val_acc is None and epochs["b"].val_loss is not None
    assert epochs["a"].val_auc == 0.0 and epochs["a"].val_acc == 0.0 and epochs[None].val_acc == 0.0


def test_spread_of_values_far_from_zero(spark):
    df = spark.createDataFrame([("a", 1e9 + i) for i in range(5)], "model string, p double")
    assert metrics.describe(df, "p").head()["std"] == pytest.approx(2.5**0.5, rel=1e-12)
