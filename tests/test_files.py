import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldmark import schemas
from foldmark.operators import ensemble, metrics
from foldmark.operators.passes import mean_over_folds
from foldmark.schemas import ID, SITE
from foldmark.sinks import tables as sinks
from foldmark.sources import experiments, images
from foldmark.sources import tables as sources
from tests.images import png


def put(path, text):
    path.write_text(text)
    return str(path)


def test_raw_tables_are_read_by_name(spark, tmp_path):
    a = put(tmp_path / "a.csv", f"target,{ID},sex,age_approx,{SITE},diagnosis,extra\n1,x,male,45.0,torso,nevus,9\n0,y,,,,,\n")
    b = put(tmp_path / "b.csv", f"{ID},tfrecord,width,height,target\nz,1.0,600,450,0\n")
    tables = sources.read_raw_tables(spark, {"a": a, "b": b})
    assert tables["a"].columns == ["target", ID, "sex", "age_approx", SITE, "diagnosis", "extra"]
    x, y = tables["a"].orderBy(ID).collect()
    assert (x.extra, y.extra) == ("9", None)
    assert (x.target, x.age_approx, x.sex) == (1, 45.0, "male")
    assert (y.target, y.age_approx, y.sex, y[SITE]) == (0, None, None, None)
    assert tables["b"].head().tfrecord == 1


def test_prepared_round_trip(spark, tmp_path):
    rows = [("a", None, "male", 30.0, "torso", 1, "d", 0, 1), ("b", "p", None, None, None, 0, "d", 1, 0)]
    df = spark.createDataFrame(rows, schemas.PREPARED)
    sinks.write_csv(df, f"{tmp_path}/train.csv")
    assert sorted(map(repr, sources.read_prepared(spark, f"{tmp_path}/train.csv").collect())) == sorted(map(repr, rows_of(df)))
    sinks.write_prepared(df, f"{tmp_path}/prepared")
    back = spark.read.parquet(f"{tmp_path}/prepared").select(*df.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows_of(df)))
    test = put(tmp_path / "test.csv", f"{ID},sex,age_approx,{SITE}\nt,male,NaN,torso\n")
    assert sources.read_test(spark, test).head().age_approx is None


def rows_of(df):
    return df.collect()


def test_missing_column_is_an_error(spark, tmp_path):
    path = put(tmp_path / "t.csv", f"{ID},sex\na,male\n")
    with pytest.raises(ValueError, match="age_approx"):
        sources.read_test(spark, path)


def test_predictions_by_file(spark, tmp_path):
    (tmp_path / "other").mkdir()
    one = put(tmp_path / "one.csv", f"{ID},target\na,0.1\nb,\n")
    two = put(tmp_path / "two.csv", f"{ID},0\nb,0.4\na,0.3\n")
    same = put(tmp_path / "other" / "one.csv", f"{ID},target\na,0.5\n")
    got = sorted(map(tuple, sources.read_predictions(spark, [one, two]).collect()), key=repr)
    assert got == [("a", "one", 0.1), ("a", "two", 0.3), ("b", "one", None), ("b", "two", 0.4)]
    with pytest.raises(ValueError, match="one"):
        sources.read_predictions(spark, [one, same])
    named = sources.read_predictions(spark, {"x": one, "y": same})
    assert ensemble.model_names(named) == ["x", "y"]


def test_prediction_folder_in_one_scan(spark, tmp_path):
    for name in ("m.0", "m1"):
        put(tmp_path / f"{name}.csv", f"{ID},target\na,0.1\nb,0.2\n")
    got = sources.read_prediction_folder(spark, f"{tmp_path}/*.csv")
    assert sorted({r.model for r in got.collect()}) == ["m.0", "m1"] and got.count() == 4
    put(tmp_path / "odd.csv", f"other,target\na,0.1\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_prediction_folder(spark, f"{tmp_path}/*.csv").collect()


@pytest.mark.parametrize("prefix", ["fold-", ""])
def test_fold_predictions(spark, tmp_path, prefix):
    header = ",".join(f"{prefix}{i}" for i in range(4))
    path = put(tmp_path / "w.csv", f"{ID},{header}\na,0.1,0.2,0.3,0.4\n")
    assert sources.read_fold_predictions(spark, path).columns == [ID, *[f"{prefix}{i}" for i in range(4)]]
    with pytest.raises(ValueError):
        sources.read_fold_predictions(spark, path, 5)


def test_fold_prediction_sink(spark, tmp_path):
    long = spark.createDataFrame([("a", 0, 0.25), ("a", 1, 0.75), ("b", 1, 0.5)], f"{ID} string, fold int, p double")
    sinks.write_csv(sinks.fold_predictions(long, [0, 1]), f"{tmp_path}/cv_test")
    wide = sources.read_fold_predictions(spark, f"{tmp_path}/cv_test", 2)
    assert {r[ID]: (r["fold-0"], r["fold-1"]) for r in wide.collect()} == {"a": (0.25, 0.75), "b": (None, 0.5)}


def test_submission(spark, tmp_path):
    path = put(tmp_path / "s.csv", f"{ID},target\na,0\nb,0\nc,0.5\n")
    result = spark.createDataFrame([("b", 0.25), ("a", 0.125), ("zz", 1.0)], schemas.PREDICTION)
    filled = sinks.fill_submission(sources.read_submission(spark, path), result)
    sinks.write_csv(filled, f"{tmp_path}/out")
    back = {r[ID]: r.target for r in sources.read_submission(spark, f"{tmp_path}/out").collect()}
    assert back == {"a": 0.125, "b": 0.25, "c": 0.5}


def test_an_id_scored_twice_is_no_submission(spark):
    template = spark.createDataFrame([("a", 0.0)], schemas.PREDICTION)
    twice = spark.createDataFrame([("a", 0.1), ("a", 0.2)], schemas.PREDICTION)
    with pytest.raises(PySparkException, match="more than one prediction for id: a"):
        sinks.fill_submission(template, twice).collect()


def test_index_of_several_experiments(spark, tmp_path):
    files = spark.createDataFrame([("e1", "fold_0_4_a"), ("e1", "fold_1_4_b"), ("e2", "fold_0_5_c")], "name string, file string")
    index = experiments.build_index(files, "m", 256, ("name",))
    sinks.write_index(index, f"{tmp_path}/index")
    back = experiments.read_index(spark, f"{tmp_path}/index", ("name",))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, index.collect())) and back.count() == 2


def test_scored_sink_names_the_auc(spark, tmp_path):
    scores = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 0)], f"{ID} string, p double, target int")
    path = sinks.write_scored(scores.select(ID, "p"), metrics.roc_auc(scores, "p", "target"), str(tmp_path))
    assert path.endswith("cv_auc_1.0") and spark.read.option("header", True).csv(path).count() == 2
    assert spark.read.parquet(f"{tmp_path}/cv_auc_metric").head().auc == 1.0


def test_feature_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", [[1.0, 2.0], [3.0, 4.0]])], f"{ID} string, features array<array<float>>")
    sinks.write_features(df, f"{tmp_path}/f")
    assert spark.read.parquet(f"{tmp_path}/f").head().features == [[1.0, 2.0], [3.0, 4.0]]


def test_experiment_index(spark, tmp_path):
    for name in ("fold_1_4_b.ckpt", "fold_0_4_a.ckpt", "best.ckpt", "notes.txt", "fold_2_4.pickle"):
        put(tmp_path / name, "x" * 5)
    files = experiments.list_model_files(spark, str(tmp_path))
    assert files.count() == 5 and {r.length for r in files.collect()} == {5}
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert experiments.list_model_files(spark, str(tmp_path), "*.ckpt").count() == 3
    index = experiments.build_index(files, "m", 384)
    sinks.write_index(index, f"{tmp_path}/out")
    rows = experiments.checkpoints(experiments.read_index(spark, f"{tmp_path}/out"))
    assert [(r.fold_index, r.n_fold, r.file) for r in rows.collect()] == [
        (0, 4, "fold_0_4_a.ckpt"), (1, 4, "fold_1_4_b.ckpt"), (2, 4, "fold_2_4.pickle"),
    ]
    assert experiments.find_checkpoint(rows, 1, 4) == "fold_1_4_b.ckpt"
    with pytest.raises(ValueError):
        experiments.find_checkpoint(rows, 3, 4)


def test_older_index_with_fold_count_less_one(spark, tmp_path):
    index = {"model_type": "m", "checkpoints": [{"fold_index": 0, "n_fold": 3, "file": "f.ckpt"}], "image_size": 256}
    path = put(tmp_path / "index.json", json.dumps(index, indent=4))
    rows = experiments.checkpoints(experiments.read_index(spark, path), stored_minus_one=True)
    assert experiments.find_checkpoint(rows, 0, 4) == "f.ckpt" and rows.head().image_size == 256


@pytest.fixture(scope="module")
def picture_roots(tmp_path_factory):
    roots = {}
    for d, dataset in enumerate(("one", "two")):
        root = tmp_path_factory.mktemp(dataset)
        for i in range(2):
            rgb = np.full((4, 6, 3), (10 * d + i, 50, 200), dtype=np.uint8)
            (root / f"img{i}.png").write_bytes(png(rgb))
        roots[dataset] = str(root)
    return roots


def test_images(spark, picture_roots):
    df = images.read_images(spark, picture_roots, "*.png")
    rows = {(r.dataset, r[ID]): r for r in df.collect()}
    assert len(rows) == 4
    one = rows["two", "img1"]
    assert (one.height, one.width, one.n_channels) == (4, 6, 3)
    assert list(one.data[:3]) == [200, 50, 11]
    single = images.read_images(spark, picture_roots["one"], "*.png")
    assert single.count() == 2 and single.head().dataset is None

    samples = spark.createDataFrame([("one", "img0"), ("two", "img1"), ("two", "img9")], f"dataset string, {ID} string")
    assert images.join_samples(samples.where(f"{ID} != 'img9'"), df).count() == 2
    with pytest.raises(PySparkException, match="no image for sample: img9"):
        images.join_samples(samples, df).collect()
    gone = images.missing_images(samples, spark, picture_roots, "*.png").collect()
    assert [(r.dataset, r[ID]) for r in gone] == [("two", "img9")]


def test_image_paths(spark):
    df = spark.createDataFrame([("one", "a"), ("two", "b"), ("none", "c")], f"dataset string, {ID} string")
    path = images.image_path({"one": "/r1/", "two": "/r2/x"}, F.col(ID), F.col("dataset"))
    assert [r[0] for r in df.orderBy(ID).select(path).collect()] == ["/r1/a.jpg", "/r2/x/b.jpg", None]
    assert df.orderBy(ID).select(images.image_path("/t", F.col(ID))).head()[0] == "/t/a.jpg"


def test_whole_validation_study(spark, tmp_path):
    """Label file and prediction files in, ensemble scores and AUC out."""
    ids = [f"i{i}" for i in range(40)]
    put(tmp_path / "train.csv", "\n".join([f"{ID},target"] + [f"{k},{i % 2}" for i, k in enumerate(ids)]))
    for m in range(3):
        rows = [f"{k},{((i % 2) * 0.5 + ((i * (m + 3)) % 7) / 10):.3f}" for i, k in enumerate(reversed(ids))]
        put(tmp_path / f"model{m}.csv", "\n".join([f"{ID},target"] + rows))
    labels = sources.read_table(spark, f"{tmp_path}/train.csv", schemas.PREDICTION)
    long = sources.read_predictions(spark, [f"{tmp_path}/model{m}.csv" for m in range(3)])
    for rule in ("mean", "power", "rank"):
        scores = ensemble.apply_rule(rule, long).withColumnRenamed("target", "p")
        joined = labels.join(scores, ID)
        auc = metrics.roc_auc(joined, "p", "target").head()
        assert auc["n_pos"] + auc["n_neg"] == 40 and 0 <= auc["auc"] <= 1
    assert mean_over_folds(long).count() == 40


def test_images_written_and_read_again(spark, tmp_path):
    from foldmark.sinks.files import write_images

    rng = np.random.default_rng(3)
    shapes = {"grey": (5, 7, 1), "colour": (6, 4, 3), "clear": (3, 3, 4)}
    stored = {n: rng.integers(0, 256, s, dtype=np.uint8) for n, s in shapes.items()}
    rows = [("d" if n != "grey" else "e", n, *p.shape, bytearray(p.tobytes())) for n, p in stored.items()]
    df = spark.createDataFrame(rows, f"dataset string, {ID} string, height int, width int, n_channels int, data binary")
    roots = {"d": f"{tmp_path}/one", "e": f"file://{tmp_path}/two/"}
    write_images(df, roots)
    write_images(df, roots)  # again: the same files
    assert sorted(p.name for p in tmp_path.rglob("*")) == ["clear.png", "colour.png", "grey.png", "one", "two"]
    back = {r[ID]: r for r in images.read_images(spark, {"d": f"{tmp_path}/one", "e": f"{tmp_path}/two"}, "*.png").collect()}
    for name, pixels in stored.items():
        found = np.frombuffer(back[name].data, np.uint8).reshape(back[name].height, back[name].width, back[name].n_channels)
        np.testing.assert_array_equal(found, pixels)
    with pytest.raises(Exception, match="no root for the dataset of image"):
        write_images(df, {"d": f"{tmp_path}/one"})


def test_png_of_the_sink_is_the_png_of_the_tests():
    from foldmark.functions.png import encode_png

    rgb = np.random.default_rng(1).integers(0, 256, (9, 5, 3), dtype=np.uint8)
    assert encode_png(rgb) == png(rgb)


def test_files_are_whole_or_absent(spark, tmp_path):
    from foldmark.sinks.files import write_files

    df = spark.createDataFrame([(f"{tmp_path}/deep/er/f{i}", bytearray(b"x" * i)) for i in range(20)], "path string, content binary")
    write_files(df.repartition(4))
    assert {p.name: p.stat().st_size for p in (tmp_path / "deep" / "er").iterdir()} == {f"f{i}": i for i in range(20)}


INDEX = {"model_type": "m", "image_size": 1, "checkpoints": [{"fold_index": 0, "n_fold": 4, "file": "f}\n{g"}, {"fold_index": 1, "n_fold": 4, "file": "h"}]}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("rows", [1, 3])
@pytest.mark.parametrize("shape", ["array", "lines"])
def test_index_of_any_shape(spark, tmp_path, indent, rows, shape):
    index = [{**INDEX, "image_size": i} for i in range(rows)]
    text = json.dumps(index, indent=indent) if shape == "array" else "\n".join(json.dumps(r, indent=indent) for r in index) + "\n"
    found = experiments.read_index(spark, put(tmp_path / "index.json", text)).collect()
    assert sorted(r.image_size for r in found) == list(range(rows))
    assert [c.file for c in found[0].checkpoints] == ["f}\n{g", "h"]
    with pytest.raises(Exception):
        experiments.read_index(spark, put(tmp_path / "broken.json", "{not json")).collect()


def test_index_in_folders_by_experiment(spark, tmp_path):
    files = spark.createDataFrame([(f"e{i}", f"fold_{k}_4.ckpt") for i in range(30) for k in range(4)], "name string, file string")
    index = experiments.build_index(files, "m", 256, ("name",))
    sinks.write_index(index, f"{tmp_path}/index", ("name",))
    assert (tmp_path / "index" / "name=e7").is_dir()
    back = experiments.read_index(spark, f"{tmp_path}/index", ("name",))
    assert back.count() == 30 and experiments.checkpoints(back.where("name = 'e7'")).count() == 4
    assert "PartitionFilters: [isnotnull(name" in back.where("name = 'e7'")._jdf.queryExecution().executedPlan().toString()
    sinks.write_index(index, f"{tmp_path}/lines")
    assert sorted(map(repr, experiments.read_index(spark, f"{tmp_path}/lines", ("name",)).collect())) == sorted(map(repr, back.collect()))


def test_png_files_are_encoded_by_stretches():
    """What a worker holds of a batch's files doesn't grow with the batch."""
    from foldmark.sinks.files import encoded_batches

    data = np.random.default_rng(5).integers(0, 256, (256, 256, 3), dtype=np.uint8).tobytes()
    n = 160
    batch = pa.RecordBatch.from_pydict(
        {"path": [f"/{i}.png" for i in range(n)], "height": [256] * n, "width": [256] * n, "n_channels": [3] * n, "data": [data] * n}
    )
    tracemalloc.start()
    paths = []
    for part in encoded_batches(iter([batch])):
        paths += part.column("path").to_pylist()
        assert part.nbytes < 12 << 20
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert paths == [f"/{i}.png" for i in range(n)]
    assert peak < 24 << 20
