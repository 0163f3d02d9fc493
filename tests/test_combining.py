import random
from statistics import mean, median

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldmark.plans import scoring
from foldmark.operators import contracts, ensemble, passes
from foldmark.operators.training_log import best_checkpoint, early_stop
from foldmark.plans.boosting import stop_point


def table(spark, rows, schema="image_name string, target double"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def long(spark):
    rows = [
        ("a", "m0", 0.9), ("a", "m1", 0.8), ("a", "m2", 0.7),
        ("b", "m0", 0.1), ("b", "m1", 0.2), ("b", "m2", 0.3),
        ("c", "m0", 0.5), ("c", "m1", 0.9), ("c", "m2", 0.1),
        ("d", "m0", 0.9), ("d", "m1", None), ("d", "m2", 0.8),
    ]
    return spark.createDataFrame(rows, "image_name string, model string, p double").cache()


def _targets(df):
    return {r.image_name: r.target for r in df.collect()}


def test_mean_and_power_skip_nulls(long):
    assert _targets(ensemble.mean_ensemble(long))["d"] == pytest.approx(0.85)
    assert _targets(ensemble.power_mean_ensemble(long))["a"] == pytest.approx((0.81 + 0.64 + 0.49) / 3)


def test_consensus(long):
    got = _targets(ensemble.consensus_ensemble(long, "m0"))
    assert got == {"a": 0.9, "b": 0.1, "c": 0.5, "d": 0.9}
    unasked = _targets(ensemble.consensus_ensemble(long.where("image_name != 'd'"), "m0", base_votes=False))
    assert unasked == {"a": 0.8, "b": 0.2, "c": 0.5}


def test_consensus_with_base_table_and_missing_vote(spark, long):
    base = spark.createDataFrame([("a", 0.0), ("d", 0.25)], "image_name string, p double")
    got = _targets(ensemble.consensus_ensemble(long, base))
    assert got["a"] == 0.9 and got["d"] == 0.25 and got["c"] is None


def test_an_absent_row_is_no_vote(spark):
    rows = [("x", "a", 0.9), ("x", "b", 0.8), ("y", "a", 0.9), ("z", "a", 0.9), ("z", "a", 0.8), ("z", "b", None)]
    long = spark.createDataFrame(rows, "image_name string, model string, p double")
    base = spark.createDataFrame([(i, 0.5) for i in "xyz"], "image_name string, p double")
    for models in (None, ("a", "b")):
        assert _targets(ensemble.consensus_ensemble(long, base, models=models)) == {"x": 0.9, "y": 0.5, "z": 0.5}
        got = {r.image_name: r.all_above for r in ensemble.unanimous(long, 0.66, 0.33, models=models).collect()}
        assert got == {"x": True, "y": False, "z": False}
    with pytest.raises(PySparkException, match="more than one prediction for id: x"):
        ensemble.consensus_ensemble(long, base.union(base.where("image_name = 'x'"))).collect()


def test_nothing_is_lost_without_a_word(spark, long):
    with pytest.raises(PySparkException, match="a model not asked for"):
        contracts.to_wide(long, "image_name", ("m0", "m1")).collect()
    with pytest.raises(PySparkException, match="more than one cell of m0 for id"):
        contracts.to_wide(long.union(long).where("model = 'm0'"), "image_name", ("m0",)).collect()
    labels = long.select("image_name").distinct()
    with pytest.raises(PySparkException, match="by a model not asked for"):
        contracts.align_models(labels, long, ("m0",)).collect()
    first, second = table(spark, [("a", 0.2), ("b", 0.4)]), table(spark, [("a", 1.0)])
    with pytest.raises(PySparkException, match="no prediction for id: b"):
        ensemble.blend_two(first, second, 0.25).collect()
    passes_of = spark.createDataFrame([("a", 0, [1.0]), ("a", 3, [2.0])], "image_name string, tta_index int, features array<float>")
    with pytest.raises(PySparkException, match="a pass beyond the 3"):
        passes.stack_features(passes_of, 3).collect()
    with pytest.raises(PySparkException, match="a pass occurs twice"):
        passes.stack_features(passes_of.withColumn("tta_index", F.lit(1)), 3).collect()


def test_equal_names_of_two_data_sets_stay_apart(spark):
    rows = [("one", "a", 0, 0.2), ("one", "a", 1, 0.4), ("two", "a", 0, 0.9)]
    views = spark.createDataFrame(rows, "dataset string, image_name string, tta_index int, p double")
    got = {(r.dataset, r.image_name): r.p for r in scoring.mean_score(views).collect()}
    assert got == {("one", "a"): pytest.approx(0.3), ("two", "a"): 0.9}


def test_unanimous_needs_every_vote(long):
    got = {r.image_name: (r.all_above, r.all_below) for r in ensemble.unanimous(long, 0.66, 0.33).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (False, False), "d": (False, False)}


def test_rank_ensemble_small_equals_scaled(spark):
    rng = random.Random(1)
    rows = [(f"i{i}", m, rng.choice([0.5, round(rng.random(), 2), rng.random()])) for i in range(700) for m in "abc"]
    long = spark.createDataFrame(rows, "image_name string, model string, p double")
    small, large = (_targets(ensemble.rank_ensemble(long, rows_per_bucket=n)) for n in (1 << 20, 60))
    assert small == large

    def ranks(values):
        return {k: sum(o < v for o in values.values()) + (sum(o == v for o in values.values()) + 1) / 2 for k, v in values.items()}

    per_model = [ranks({i: p for i, m, p in rows if m == model}) for model in "abc"]
    means = {i: round(mean(r[i] for r in per_model), 9) for i in per_model[0]}
    assert small == {i: 1 + sum(o < v for o in means.values()) for i, v in means.items()}


def test_row_statistics(long):
    got = {r.image_name: r for r in ensemble.row_statistics(long).collect()}
    assert got["c"]["median"] == median([0.5, 0.9, 0.1]) and got["d"]["median"] == pytest.approx(0.85)


def test_blend_scale_largest(spark, long):
    first, second = table(spark, [("a", 0.2), ("b", 0.4)]), table(spark, [("b", 0.0), ("a", 1.0)])
    assert _targets(ensemble.blend_two(first, second, 0.25)) == {"a": pytest.approx(0.4), "b": pytest.approx(0.3)}
    scaled = ensemble.scale_scores(long, 0.95 / 0.85).where("image_name = 'a' and model = 'm0'").head()
    assert scaled.p == pytest.approx(0.9 * 0.95 / 0.85)
    top = ensemble.largest(long, "p", 3, "image_name").collect()
    assert [(r.image_name, r.p) for r in top] == [("a", 0.9), ("c", 0.9), ("d", 0.9)]


def test_rule_registry(long):
    name = "consensus-m0"
    ensemble.register_rule(name, ensemble.consensus_rule("m0", 0.66, 0.33))
    try:
        assert _targets(ensemble.apply_rule(name, long))["b"] == 0.1
        with pytest.raises(ValueError):
            ensemble.register_rule(name, ensemble.mean_ensemble)
    finally:
        del ensemble.RULES[name]
    with pytest.raises(ValueError):
        ensemble.apply_rule("no such rule", long)


def test_alignment_contract(spark):
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "image_name string, target int")
    full = spark.createDataFrame([("b", 0.2), ("a", 0.1), ("x", 0.9)], "image_name string, p double")
    got = {r.image_name: r.p for r in contracts.align_predictions(labels, full, unique=True).collect()}
    assert got == {"a": 0.1, "b": 0.2}

    short = full.where("image_name = 'a'")
    with pytest.raises(PySparkException, match="no prediction for id: b"):
        contracts.align_predictions(labels, short).collect()
    assert contracts.align_predictions(labels, short, strict=False).count() == 2
    assert [r.image_name for r in contracts.missing_predictions(labels, short).collect()] == ["b"]

    twice = full.union(spark.createDataFrame([("a", 0.7)], "image_name string, p double"))
    assert contracts.align_predictions(labels, twice).count() == 3
    for strict in (True, False):
        with pytest.raises(PySparkException, match="more than one prediction for id: a"):
            contracts.align_predictions(labels, twice, unique=True, strict=strict).collect()


def test_null_prediction_is_not_a_missing_one(spark):
    labels = spark.createDataFrame([("a", 1)], "image_name string, target int")
    null = spark.createDataFrame([("a", None)], "image_name string, p double")
    assert contracts.align_predictions(labels, null).head().p is None


def test_outer_alignment_and_positional_relabel(spark, tmp_path):
    one, two = table(spark, [("a", 0.1), ("b", 0.2)]), table(spark, [("b", 0.3), ("c", 0.4)])
    wide = contracts.to_wide(contracts.collect_models({"m": one, "n": two}), "image_name", ("m", "n"))
    assert {r.image_name: (r.m, r.n) for r in wide.collect()} == {"a": (0.1, None), "b": (0.2, 0.3), "c": (None, 0.4)}
    renamed = wide.toDF("image_name", "ext-b3", "ext-b4")
    assert renamed.columns[1:] == ["ext-b3", "ext-b4"]

    sizes = {"values": (3, 40, 7), "ids": (30, 2, 18)}  # files of unlike size, read largest first
    for name, counts in sizes.items():
        (tmp_path / name).mkdir()
        at = 0
        for part, n in enumerate(counts):
            lines = ["p" if name == "values" else "image_name", *[str(float(i)) if name == "values" else f"i{i}" for i in range(at, at + n)]]
            (tmp_path / name / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
            at += n
    values, ids = (spark.read.option("header", True).csv(str(tmp_path / name)) for name in sizes)
    got = contracts.relabel_by_position(values, ids)
    assert {r.image_name: float(r.p) for r in got.collect()} == {f"i{i}": float(i) for i in range(50)}
    (tmp_path / "values" / "part-9.csv").write_text("p\n9\n")
    with pytest.raises(ValueError, match="51 rows of values against 50 ids"):
        contracts.relabel_by_position(spark.read.option("header", True).csv(str(tmp_path / "values")), ids)


def test_to_long_keeps_the_partitioning(spark):
    rows = spark.range(50).select((F.col("id") % 7).alias("id"), F.rand(1).alias("m0"), F.rand(2).alias("m1"))
    wide = rows.groupBy("id").agg(
        F.max("m0").alias("m0"), F.max("m1").alias("m1")
    )
    plan = ensemble.mean_ensemble(contracts.to_long(wide, "id", ("m0", "m1")), "id")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_mean_of_means(spark):
    rows = [("a", 0, 0.0), ("a", 0, 1.0), ("a", 1, 1.0), ("b", 0, None), ("b", 1, 0.5)]
    df = spark.createDataFrame(rows, "image_name string, fold int, p double")
    got = {r.image_name: r.p for r in passes.mean_of_passes_and_folds(df).collect()}
    assert got == {"a": 0.75, "b": 0.5}
    wide = spark.createDataFrame([("a", 0.5, None, 1.0), ("b", None, None, None)], "image_name string, `fold-0` double, `fold-1` double, `2` double")
    assert _targets(passes.mean_of_fold_columns(wide, ["fold-0", "fold-1", "2"])) == {"a": 0.75, "b": None}
    rows = passes.fold_columns_to_rows(wide, ["fold-0", "fold-1", "2"]).where("image_name = 'a'").collect()
    assert sorted((r.fold, r.p) for r in rows if r.p is not None) == [(0, 0.5), (2, 1.0)]


def test_stack_is_in_pass_order(spark):
    rows = [("a", i, [float(i), -float(i)]) for i in (2, 0, 1)]
    df = spark.createDataFrame(rows, "image_name string, tta_index int, features array<float>").repartition(3)
    assert passes.stack_features(df, 3).head().features == [[0.0, -0.0], [1.0, -1.0], [2.0, -2.0]]


def brute_stop(values, patience):
    best = best_epoch = None
    for epoch, v in enumerate(values):
        if v is not None and (best is None or v > best):
            best, best_epoch = v, epoch
        elif epoch - (best_epoch if best_epoch is not None else -1) >= patience:
            return epoch, best_epoch, best
    return None, best_epoch, best


@pytest.mark.parametrize("chunk", [3, 7, 1 << 20])
def test_early_stop(spark, chunk):
    rng = random.Random(9)
    runs = {f"r{k}": [rng.choice([round(rng.random(), 1), rng.random()]) for _ in range(k)] for k in range(1, 40)}
    runs["rising"] = [i / 50 for i in range(50)]
    runs["flat"] = [0.5] * 30
    runs[None] = [0.9, 0.1, 0.1, 0.1, 0.1, 0.1]
    runs["late"] = [None, None, 0.4, 0.3]
    rows = [(run, i, v) for run, values in runs.items() for i, v in enumerate(values)]
    log = spark.createDataFrame(rows, "run string, epoch long, val_auc double").repartition(4)
    got = {r.run: (r.stop_epoch, r.best_epoch, r.best_val_auc) for r in early_stop(log, 4, epochs_per_chunk=chunk).collect()}
    assert got == {run: brute_stop(values, 4) for run, values in runs.items()}
    for values in runs.values():
        stop, best, value = brute_stop(values, 4)
        assert stop_point(values, 4) == (stop is not None, best, value)


def test_best_checkpoint_takes_the_earliest_tie(spark):
    rows = [("a", 0, 0.5), ("a", 1, 0.9), ("a", 2, 0.9), ("b", 0, None)]
    log = spark.createDataFrame(rows, "run string, epoch int, val_auc double")
    got = {r.run: (r.best_epoch, r.best_val_auc) for r in best_checkpoint(log).collect()}
    assert got == {"a": (1, 0.9), "b": (None, None)}
