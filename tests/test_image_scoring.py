import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldmark.operators.splits import validation_folds, validation_folds_of
from foldmark.plans import experiment, image_scoring, views
from foldmark.schemas import ID
from foldmark.sources.images import read_features, read_images
from tests.images import png

SIZE = 16
STAGES = views.scoring_stages(SIZE)


@pytest.fixture(scope="module")
def pictures(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(0)
    for i in range(9):
        (root / f"img{i}.png").write_bytes(png(rng.integers(0, 256, (20 + i, 24, 3), dtype=np.uint8)))
    return read_images(spark, {"d": str(root)}, "*.png")


def model(weight):
    def make():
        def predict(batch, meta):
            m = batch.astype(np.float64).mean(axis=(1, 2, 3))
            return weight * m + (0 if meta is None else meta[:, 0]), np.stack([m, np.full(len(batch), weight)], axis=1)

        return predict

    return make


MODELS = [model(w) for w in (1.0, 2.0, 5.0)]


@pytest.fixture(scope="module")
def view_means(pictures):
    found = {}
    for r in views.image_views(pictures, STAGES, 4).collect():
        found[r[ID], r.tta_index] = np.array(r.pixels, dtype=np.float64).mean()
    return {f"img{i}": [found[f"img{i}", t] for t in range(4)] for i in range(9)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_folds(pictures, view_means):
    scored = image_scoring.score_all_folds(pictures, STAGES, MODELS, n_passes=4, batch_size=4)
    got = {(r[ID], r.fold): r.p for r in scored.collect()}
    assert len(got) == 27
    for (name, fold), p in got.items():
        assert p == pytest.approx((1, 2, 5)[fold] * np.mean(view_means[name]), abs=1e-6)
    text = plan(scored)
    assert text.count("MapInArrow") == 1 and text.count("Scan") == 1 and "Exchange" not in text


def test_own_fold_and_features(pictures, view_means):
    rows = pictures.withColumn("val_index", (F.substring(ID, 4, 1).cast("int") % 3))
    scored = image_scoring.score_own_fold(rows, STAGES, MODELS, n_passes=4, batch_size=5)
    assert plan(scored).count("MapInArrow") == 1 and "Exchange" not in plan(scored)
    found = scored.collect()
    assert len(found) == 9
    for r in found:
        weight = (1.0, 2.0, 5.0)[int(r[ID][3]) % 3]
        assert r.val_index == int(r[ID][3]) % 3 and r.p == pytest.approx(weight * np.mean(view_means[r[ID]]), abs=1e-6)
        np.testing.assert_allclose(np.array(r.stack), [[m, weight] for m in view_means[r[ID]]], atol=1e-5)
    for index in (F.lit(3), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="no fold model"):
            image_scoring.score_own_fold(pictures.withColumn("val_index", index), STAGES, MODELS, n_passes=1).collect()


def test_meta_features_and_models_without_features(pictures, view_means):
    def bare():
        return lambda batch, meta: (meta[:, 0], None)

    rows = pictures.withColumn("meta", F.array(F.substring(ID, 4, 1).cast("float")))
    found = image_scoring.image_scores(rows, STAGES, [bare, model(1.0)], n_passes=2, meta="meta").collect()
    for r in found:
        assert r.scores[0] == float(r[ID][3]) and r.stack is None
        assert r.scores[1] == pytest.approx(np.mean(view_means[r[ID]][:2]) + float(r[ID][3]), abs=1e-6)


def test_any_number_of_splits():
    for n in (4, 8):
        assert all(validation_folds_of(i, n) == validation_folds(i, n) for i in range(n))
    for n in range(2, 9):
        parts = [validation_folds_of(i, n) for i in range(n)]
        assert sum(parts, []) == list(range(8)) and max(map(len, parts)) - min(map(len, parts)) <= 1
    for i, n in ((0, 1), (0, 9), (4, 4), (-1, 4)):
        with pytest.raises(ValueError):
            validation_folds_of(i, n)


def test_cross_validation_of_a_users_predictor(spark, pictures, view_means):
    train = spark.createDataFrame([(i % 8, float(i)) for i in range(40)], "fold int, x double")
    seen = []

    def fit(rows, held_out, split):
        seen.append((split, rows.count(), held_out.count()))
        return model(rows.agg(F.avg("x")).head()[0])

    scored = image_scoring.cross_validate_images(train, pictures, fit, STAGES, 5, n_passes=4)
    assert "Exchange" not in plan(scored)
    weights = [np.mean([i for i in range(40) if i % 8 not in validation_folds_of(s, 5)]) for s in range(5)]
    for r in scored.collect():
        assert r.target == pytest.approx(np.mean(weights) * np.mean(view_means[r[ID]]), abs=1e-6)
    assert sorted(s for s, _, _ in seen) == list(range(5)) and all(a + b == 40 for _, a, b in seen)


def load(model_type, data):
    assert model_type == "net"
    return model(json.loads(data)["weight"])()


@pytest.fixture
def saved(spark, tmp_path):
    for i, w in enumerate((1.0, 2.0, 3.0, 4.0)):
        (tmp_path / f"fold_{i}_4_epoch={i}.json").write_text(json.dumps({"weight": w}))
    (tmp_path / "notes.txt").write_text("no model")
    experiment.index_model_files(spark, str(tmp_path), "net", SIZE)
    return str(tmp_path)


def read(spark, path):
    return {r[ID]: r for r in spark.read.option("header", True).option("inferSchema", True).csv(path).collect()}


def test_files_from_index_to_scores(spark, pictures, view_means, saved, tmp_path):
    template = spark.createDataFrame([(f"img{i}", 0.0) for i in range(7)], f"{ID} string, target double")
    path = experiment.score_test_images(spark, saved, pictures, template, str(tmp_path / "out"), load, STAGES, n_passes=4)
    assert path.endswith("cv_test_net")
    rows = read(spark, path)
    assert set(rows) == {f"img{i}" for i in range(7)}
    for name, r in rows.items():
        for k in range(4):
            assert r[f"fold-{k}"] == pytest.approx((k + 1) * np.mean(view_means[name]), abs=1e-6)

    samples = pictures.select("dataset", ID, (F.substring(ID, 4, 1).cast("int") % 8).alias("fold"))
    path = experiment.score_validation_images(
        spark, saved, samples, pictures, str(tmp_path / "out"), load, STAGES, features=True, n_passes=4
    )
    rows = read(spark, path)
    assert path.endswith("cv_val_net") and len(rows) == 9
    for name, r in rows.items():
        weight = int(name[3]) % 8 // 2 + 1
        assert r.target == pytest.approx(weight * np.mean(view_means[name]), abs=1e-6)
    features = read_features(spark, str(tmp_path / "out" / "embedding_val_net"))
    assert features.where("fold = 0").count() == sum(int(n[3]) % 8 // 2 == 0 for n in rows)
    assert "PartitionFilters: [isnotnull(fold" in plan(features.where("fold = 0"))
    for r in features.collect():
        np.testing.assert_allclose(np.array(r.features)[:, 0], view_means[r[ID]], atol=1e-5)


def test_missing_parts_are_errors(spark, pictures, saved, tmp_path):
    samples = spark.createDataFrame([("d", "img0", 0), ("d", "lost", 1)], f"dataset string, {ID} string, fold int")
    with pytest.raises(Exception, match="no image for sample: lost"):
        experiment.score_validation_images(spark, saved, samples, pictures, str(tmp_path / "out"), load, STAGES)
    (tmp_path / "fold_2_4_epoch=2.json").unlink()
    with pytest.raises(ValueError, match="no model file fold_2_4"):
        experiment.load_fold_predictors(spark, saved, load)
    from foldmark.sources.experiments import read_model_files

    with pytest.raises(ValueError, match="bytes"):
        read_model_files(spark, saved, ["fold_0_4_epoch=0.json"], limit_bytes=3)
