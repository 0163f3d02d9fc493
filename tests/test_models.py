import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from foldmark.operators.metrics import roc_auc
from foldmark.operators.splits import in_folds, stratified_folds
from foldmark.plans import boosting, crossval
from foldmark.plans.baseline import run_baseline
from foldmark.plans.boosting import BoostParams, fit_fold, positive_probability, staged_auc, with_vector
from foldmark.schemas import ID, SITE
from foldmark.sinks.models import load_model, save_model
from foldmark.sinks.tables import write_csv
from foldmark.sources.experiments import build_index, checkpoints, find_checkpoint, list_saved_models
from foldmark.sources.tables import read_submission

PARAMS = BoostParams(max_trees=6, patience=2, max_depth=2, first_trees=3, step_size=0.3)


@pytest.fixture(scope="module")
def samples(spark):
    """Older male rows with a torso lesion are mostly positive."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        sex, age, site = rng.choice(["male", "female"]), float(rng.randrange(20, 90)), rng.choice(["torso", "head/neck"])
        risk = 0.15 + 0.5 * (age > 55) + 0.2 * (sex == "male")
        rows.append((f"i{i:03d}", sex, age, site, int(rng.random() < risk)))
    df = spark.createDataFrame(rows, f"{ID} string, sex string, age_approx double, {SITE} string, target int")
    return stratified_folds(df).cache()


@pytest.fixture(scope="module")
def table(samples):
    from foldmark.functions.encode import encode_features

    return with_vector(encode_features(samples)).cache()


@pytest.fixture(scope="module")
def fitted(table):
    return crossval.fit_folds(table, 4, PARAMS)


def test_fold_models_learn_the_planted_signal(fitted):
    assert sorted(fitted) == [0, 1, 2, 3]
    for f in fitted.values():
        assert f.auc > 0.7 and 1 <= f.n_trees <= PARAMS.max_trees


def test_fit_is_reproducible(table, fitted):
    again = fit_fold(table.withColumn("is_val", in_folds([0, 1])), PARAMS)
    assert again.n_trees == fitted[0].n_trees and again.auc == pytest.approx(fitted[0].auc, abs=1e-9)


def test_reported_auc_is_the_model_s_auc(table, fitted):
    scored = positive_probability(table.where(in_folds([2, 3])), fitted[1].model)
    assert roc_auc(scored, "p", "target").head()["auc"] == pytest.approx(fitted[1].auc, abs=1e-9)


def test_staged_auc_equals_shorter_fits(table):
    train, validation = table.where(~in_folds([0])), table.where(in_folds([0]))
    model = boosting.boosted_trees(PARAMS, 4).fit(train)
    staged = {r.epoch: r.val_auc for r in staged_auc(model, validation).collect()}
    assert sorted(staged) == [0, 1, 2, 3]
    for n in (1, 3):
        shorter = positive_probability(validation, boosting.boosted_trees(PARAMS, n).fit(train))
        assert staged[n - 1] == pytest.approx(roc_auc(shorter, "p", "target").head()["auc"], abs=1e-9)
    every = {r.epoch: r.val_auc for r in staged_auc(model, validation, 2).collect()}
    assert every == {0: pytest.approx(staged[1]), 1: pytest.approx(staged[3])}


def test_first_trees_are_the_shorter_fit(spark, table, tmp_path):
    train = table.where(~in_folds([0]))
    model = boosting.boosted_trees(PARAMS, 5).fit(train)
    cut, fit = boosting.first_trees(model, 3), boosting.boosted_trees(PARAMS, 3).fit(train)
    assert cut.getNumTrees == 3 and cut.treeWeights == fit.treeWeights and cut.getFeaturesCol() == boosting.VECTOR
    cut.write().overwrite().save(f"{tmp_path}/cut")
    loaded = type(cut).load(f"{tmp_path}/cut")
    p, q, r = (
        [x[0] for x in positive_probability(table, m).orderBy(ID).select("p").collect()] for m in (cut, fit, loaded)
    )
    assert p == q == r
    twice = boosting.model_of_trees(model, [0, 0, 2])
    assert twice.getNumTrees == 3 and twice.treeWeights == [model.treeWeights[i] for i in (0, 0, 2)]


def test_search_fits_once_per_doubling(table, monkeypatch):
    fits = []

    def counted(params, n_trees):
        fits.append(n_trees)
        return boosting.boosted_trees(params, n_trees)

    monkeypatch.setitem(boosting.ESTIMATORS, "counted", counted)
    params = boosting.BoostParams(max_trees=16, patience=16, max_depth=2, first_trees=4, step_size=0.3)
    fitted = fit_fold(table.withColumn("is_val", in_folds([0, 1])), params, "counted")
    assert fits == [4, 8, 16] and fitted.model.getNumTrees == fitted.n_trees <= 16


def test_staged_margins_gather_equal_rows(spark, table, monkeypatch):
    model = boosting.boosted_trees(PARAMS, 4).fit(table)
    vectors = boosting.distinct_vectors(table)
    assert vectors.agg(F.sum("pos") + F.sum("neg")).head()[0] == table.count()
    whole = staged_auc(model, table).orderBy("epoch").collect()
    monkeypatch.setattr(boosting, "LEAF_CELLS", 12)
    small = staged_auc(model, vectors.repartition(3)).orderBy("epoch").collect()
    assert [r.val_auc for r in whole] == pytest.approx([r.val_auc for r in small], abs=1e-12)
    counts = boosting.staged_margins(model, vectors).groupBy("epoch").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    assert {(r.p, r.n) for r in counts.collect()} == {(table.where("target = 1").count(), table.where("target = 0").count())}


def test_out_of_fold_uses_the_blind_model(table, fitted, tmp_path):
    models = {i: f.model for i, f in fitted.items()}
    scored = crossval.out_of_fold(table, models, 4)
    assert scored.count() == table.count() == scored.select(ID).distinct().count()
    assert roc_auc(scored, "p", "target").head()["auc"] > 0.7
    write_csv(scored.select(ID, F.col("p").alias("target")), f"{tmp_path}/cv_val")
    assert read_submission(table.sparkSession, f"{tmp_path}/cv_val").count() == table.count()
    everywhere = crossval.score_with_all(table, models)
    assert everywhere.count() == 4 * table.count()
    same = scored.join(everywhere.withColumnRenamed("p", "q"), ID).where("val_index = fold")
    assert same.count() == table.count() and same.where("abs(p - q) > 1e-12").count() == 0


def test_cross_validate_averages_the_folds(table, fitted):
    test = table.where("fold = 0")
    got = {r[ID]: r.target for r in crossval.cross_validate(table, test, 4, PARAMS).collect()}
    scores = crossval.score_with_all(test, {i: f.model for i, f in fitted.items()})
    expected = {r[ID]: r.m for r in scores.groupBy(ID).agg(F.avg("p").alias("m")).collect()}
    assert got == pytest.approx(expected)
    with pytest.raises(ValueError):
        crossval.fit_folds(table, 5, PARAMS)


def test_saved_models_are_found_again(spark, table, fitted, tmp_path):
    from pyspark.ml import PipelineModel

    for i, f in fitted.items():
        save_model(PipelineModel([f.model]), str(tmp_path), i, 4, f.auc)
    rows = checkpoints(build_index(list_saved_models(spark, str(tmp_path)), "boosted_trees", 0))
    assert rows.count() == 4
    name = find_checkpoint(rows, 2, 4)
    assert name == f"fold_2_4_val_auc_{fitted[2].auc}"
    loaded = load_model(f"{tmp_path}/{name}").stages[0]
    left = positive_probability(table, loaded).agg(F.sum("p")).head()[0]
    assert left == pytest.approx(positive_probability(table, fitted[2].model).agg(F.sum("p")).head()[0])


def test_other_estimators_can_be_registered(table):
    def logistic(params, n_trees):
        return LogisticRegression(featuresCol=boosting.VECTOR, labelCol="target", maxIter=20)

    boosting.register_estimator("logistic", logistic)
    try:
        fitted = fit_fold(table.withColumn("is_val", in_folds([0, 1])), PARAMS, "logistic")
        assert fitted.auc > 0.7
        with pytest.raises(ValueError):
            boosting.register_estimator("logistic", logistic)
    finally:
        del boosting.ESTIMATORS["logistic"]


def test_validation_without_positives_keeps_the_full_model(table):
    marked = table.withColumn("is_val", F.col("target") == 0).where("target = 0 or fold < 4")
    mixed = marked.withColumn("is_val", F.col("is_val") & (F.col("fold") > 5))
    fitted = fit_fold(mixed, PARAMS)
    assert fitted.auc is None and fitted.n_trees == PARAMS.first_trees


def test_baseline_pipeline(spark, samples):
    test = samples.drop("target", "fold").limit(50)
    template = test.select(ID, F.lit(0.0).alias("target")).union(spark.createDataFrame([("extra", 0.125)]))
    submission, auc = run_baseline(samples, test, template, params=PARAMS)
    got = {r[ID]: r.target for r in submission.collect()}
    assert len(got) == 51 and got["extra"] == 0.125 and auc > 0.65
    assert all(0 < v < 1 for k, v in got.items() if k != "extra")
