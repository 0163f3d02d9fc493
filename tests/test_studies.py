import random

import pytest
from pyspark.errors import PySparkException

from foldmark import __main__ as cli
from foldmark.operators.prepare import flag_sanity_rows
from foldmark.operators.splits import stratified_folds
from foldmark.plans import experiment, studies
from foldmark.plans.boosting import BoostParams
from foldmark.plans.training import train_fold_on_coefficients, train_fold_on_meta
from foldmark.schemas import ID, SITE
from foldmark.sinks.tables import write_csv
from foldmark.sources.samples import load_sample_sets
from foldmark.sources.tables import read_predictions, read_submission
from tests.test_metrics import brute_auc

PARAMS = BoostParams(max_trees=3, patience=2, max_depth=2, first_trees=3)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    rng = random.Random(2)
    ids = [f"i{i:02d}" for i in range(60)]
    labels = {k: int(rng.random() < 0.4) for k in ids}
    scores = {m: {k: round(0.4 * labels[k] + 0.6 * rng.random(), 3) for k in ids} for m in ("a", "b", "base")}
    (root / "train.csv").write_text(f"{ID},sex,target\n" + "".join(f"{k},male,{labels[k]}\n" for k in ids))
    for m, values in scores.items():
        shuffled = rng.sample(ids, len(ids))
        (root / f"{m}.csv").write_text(f"{ID},target\n" + "".join(f"{k},{values[k]}\n" for k in shuffled))
    (root / "wide.csv").write_text(f"{ID},fold-0,fold-1,fold-2,fold-3\nx,0.1,0.2,,0.6\n")
    return root, labels, scores


def _read(spark, path):
    return {r[ID]: r.target for r in read_submission(spark, path).collect()}


def test_measure(spark, files, capsys):
    root, labels, scores = files
    expected = brute_auc([scores["a"][k] for k in labels], list(labels.values()))
    assert studies.measure(spark, f"{root}/train.csv", f"{root}/a.csv") == pytest.approx(expected)
    cli.main(["measure", f"{root}/train.csv", f"{root}/a.csv"])
    assert capsys.readouterr().out.startswith("auc: 0.")


@pytest.mark.parametrize("rule", ["mean", "power", "rank", "consensus"])
def test_validate(spark, files, tmp_path, capsys, rule):
    root, labels, scores = files
    base = ["--base", f"{root}/base.csv"] if rule == "consensus" else []
    cli.main(["validate", rule, f"{root}/train.csv", f"{root}/a.csv", f"{root}/b.csv", "--out", str(tmp_path), *base])
    path = capsys.readouterr().out.strip()
    auc = float(path.rsplit("_", 1)[1])
    got = {r[ID]: r.p for r in read_predictions(spark, {"x": path}).collect()}
    assert got.keys() == labels.keys()
    assert auc == pytest.approx(brute_auc([got[k] for k in labels], list(labels.values())))
    a, b = scores["a"], scores["b"]
    if rule == "mean":
        assert got == pytest.approx({k: (a[k] + b[k]) / 2 for k in labels})
    if rule == "consensus":
        for k in labels:
            pair = (a[k], b[k])
            want = max(pair) if min(pair) > 0.66 else min(pair) if max(pair) < 0.33 else scores["base"][k]
            assert got[k] == want
    with pytest.raises(ValueError):
        studies.validate_ensemble(spark, f"{root}/train.csv", [f"{root}/a.csv"], "consensus", str(tmp_path))


def test_a_model_that_misses_an_id_is_named(spark, files, tmp_path):
    root, _, _ = files
    lines = (root / "b.csv").read_text().splitlines()
    (tmp_path / "b.csv").write_text("\n".join(lines[:-1]))
    with pytest.raises(PySparkException, match="no prediction by b for id"):
        studies.validate_ensemble(spark, f"{root}/train.csv", [f"{root}/a.csv", f"{tmp_path}/b.csv"], "mean", str(tmp_path))
    (tmp_path / "b.csv").write_text("\n".join([*lines, lines[-1]]))
    with pytest.raises(PySparkException, match="more than one prediction by b"):
        studies.validate_ensemble(spark, f"{root}/train.csv", [f"{root}/a.csv", f"{tmp_path}/b.csv"], "rank", str(tmp_path))


def test_submission_commands(spark, files, tmp_path):
    root, labels, scores = files
    a, b, base = (scores[m] for m in ("a", "b", "base"))
    paths = [f"{root}/a.csv", f"{root}/b.csv"]
    cli.main(["average", *paths, "--out", f"{tmp_path}/mean"])
    assert _read(spark, f"{tmp_path}/mean") == pytest.approx({k: (a[k] + b[k]) / 2 for k in labels})
    cli.main(["blend", *paths, "0.3", "--out", f"{tmp_path}/blend"])
    assert _read(spark, f"{tmp_path}/blend") == pytest.approx({k: 0.7 * a[k] + 0.3 * b[k] for k in labels})
    cli.main(["average-folds", f"{root}/wide.csv", "--out", f"{tmp_path}/folds"])
    assert _read(spark, f"{tmp_path}/folds") == {"x": pytest.approx(0.3)}
    cli.main(["consensus", f"{root}/base.csv", *paths, "--out", f"{tmp_path}/consensus"])
    got = _read(spark, f"{tmp_path}/consensus")
    assert all(got[k] == (max(a[k], b[k]) if min(a[k], b[k]) > 0.7 else base[k]) for k in labels if min(a[k], b[k]) >= 0.01)


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("prepared")
    rng = random.Random(4)
    rows = [
        (f"i{i:03d}", "p", rng.choice(["male", "female"]), float(rng.randrange(20, 80)), "torso", i % 3 // 2, "d")
        for i in range(200)
    ]
    raw = spark.createDataFrame(rows, f"{ID} string, patient_id string, sex string, age_approx double, {SITE} string, target int, dataset string")
    write_csv(flag_sanity_rows(stratified_folds(raw)), f"{root}/train")
    write_csv(raw.select(ID, "sex", "age_approx", SITE), f"{root}/test")
    return root


def test_load(spark, prepared):
    train, test = load_sample_sets(spark, f"{prepared}/train", f"{prepared}/test", {"d": "/images"}, "/test")
    assert train.count() == test.count() == 200 and train.folds == tuple(range(8)) and train.roots == {"d": "/images"}
    train, test = load_sample_sets(spark, f"{prepared}/train", f"{prepared}/test", sanity_check=True)
    assert train.count() == test.count() == 32


def test_experiment_from_training_to_files(spark, prepared, tmp_path):
    train, test = load_sample_sets(spark, f"{prepared}/train", f"{prepared}/test")
    root = f"{tmp_path}/experiment"
    for i in range(4):
        path, fitted = train_fold_on_meta(train, i, 4, root, params=PARAMS)
        assert path.endswith(f"fold_{i}_4_val_auc_{fitted.auc}")
    experiment.index_experiment(spark, root, "trees")
    template = test.df.select(ID).limit(150)
    wide = experiment.score_test(spark, root, test.df, template, str(tmp_path))
    assert wide.endswith("cv_test_trees")
    studies.average_folds(spark, wide, f"{tmp_path}/submission")
    assert len(_read(spark, f"{tmp_path}/submission")) == 150
    val = experiment.score_validation(spark, root, train.df, str(tmp_path))
    assert len(_read(spark, val)) == 200
    assert 0 <= studies.measure(spark, f"{prepared}/train", val) <= 1
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "index.json").write_text('{"model_type": "m", "image_size": 1, "checkpoints": []}')
    with pytest.raises(ValueError):
        experiment.load_fold_models(spark, f"{tmp_path}/empty")


def test_training_on_coefficients(spark, prepared, tmp_path):
    train, _ = load_sample_sets(spark, f"{prepared}/train", f"{prepared}/test", {"d": "/images"})
    pixels = bytearray(range(192))
    images = train.df.select("dataset", ID).selectExpr(
        "dataset", ID, "8 as height", "8 as width", "3 as n_channels", f"unhex('{pixels.hex()}') as data"
    )
    path, fitted = train_fold_on_coefficients(train, images, 0, 4, str(tmp_path), params=PARAMS)
    assert fitted.model.numFeatures == 3 + 3 * 8 and path.startswith(str(tmp_path))



def test_command_line_from_raw_files_to_scores(spark, tmp_path, capsys):
    rng = random.Random(6)
    lines = {"a": [], "b": []}
    for i in range(160):
        target = int(rng.random() < 0.4)
        age = 40 + 25 * target + rng.randrange(10)
        lines["a" if i % 2 else "b"].append(f"id{i:03d},p{i % 9},{rng.choice(['male', 'female'])},{age},torso,{target},x,y,1,2,3")
    header = f"{ID},patient_id,sex,age_approx,{SITE},target,diagnosis,benign_malignant,tfrecord,width,height"
    for name, rows in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *rows]) + "\n")
    (tmp_path / "denied.csv").write_text(f"{ID}\nid000\nid001\n")
    train, root = f"{tmp_path}/train", f"{tmp_path}/experiment"
    cli.main(["prepare", f"a={tmp_path}/a.csv", f"b={tmp_path}/b.csv", "--denied", f"{tmp_path}/denied.csv", "--out", train])
    prepared = spark.read.option("header", True).csv(train)
    assert prepared.count() == 158 and prepared.where(f"{ID} in ('id000', 'id001')").count() == 0
    assert {r.dataset for r in prepared.select("dataset").distinct().collect()} == {"a", "b"}
    assert spark.read.parquet(f"{train}_by_fold").where("fold = 3").count() > 0
    test = f"{tmp_path}/test.csv"
    (tmp_path / "test.csv").write_text(f"{ID},sex,age_approx,{SITE}\n" + "".join(f"t{i},male,{30 + i},torso\n" for i in range(40)))
    (tmp_path / "template.csv").write_text(f"{ID},target\n" + "".join(f"t{i},0\n" for i in range(40)))
    limits = ["--trees", "4", "--patience", "2"]
    cli.main(["train-meta", train, test, root, "--fold", "1", *limits])
    assert "fold_1_4_val_auc_" in capsys.readouterr().out
    cli.main(["train-meta", train, test, root, *limits])
    cli.main(["index", root, "trees"])
    cli.main(["score-test", root, train, test, "--template", f"{tmp_path}/template.csv", "--out", str(tmp_path)])
    cli.main(["score-validation", root, train, test, "--out", str(tmp_path)])
    wide = spark.read.option("header", True).csv(f"{tmp_path}/cv_test_trees")
    assert wide.count() == 40 and wide.columns == [ID, "fold-0", "fold-1", "fold-2", "fold-3"]
    assert studies.measure(spark, train, f"{tmp_path}/cv_val_trees") > 0.9
    with pytest.raises(SystemExit):
        cli.main(["prepare", "nameless.csv"])


def test_survey_and_curve_from_files(spark, tmp_path):
    rng = random.Random(8)
    scores = {m: {f"i{k:02d}": round(rng.random(), 3) for k in range(60)} for m in ("one", "two", "three")}
    for m, rows in scores.items():
        (tmp_path / f"{m}.csv").write_text(f"{ID},target\n" + "".join(f"{k},{v}\n" for k, v in rows.items()))
    (tmp_path / "labels.csv").write_text(f"{ID},target\n" + "".join(f"{k},{int(v > 0.5)}\n" for k, v in scores["one"].items()))
    files, out = [f"{m}={tmp_path}/{m}.csv" for m in scores], f"{tmp_path}/survey"
    cli.main(["survey", *files, "--factor", "one=0.5", "two=2", "--column", "two", "--largest", "5", "--lowest", "7", "--out", out])
    read = spark.read.option("header", True).option("inferSchema", True)
    described = {r.model: r for r in read.csv(f"{out}/describe").collect()}
    assert described["one"]["mean"] == pytest.approx(sum(scores["one"].values()) / 120) and described["three"]["count"] == 60
    largest = read.csv(f"{out}/largest")
    assert sorted(largest.columns) == sorted([ID, *scores]) and largest.count() == 5
    top = sorted(scores["two"].items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert {r[ID]: r.two for r in largest.collect()} == pytest.approx({k: 2 * v for k, v in top})
    assert read.csv(f"{out}/lowest_ranks").count() == 7
    with pytest.raises(ValueError, match="no model"):
        studies.survey_predictions(spark, {"one": f"{tmp_path}/one.csv"}, out, column="four")
    cli.main(["roc", f"{tmp_path}/labels.csv", f"{tmp_path}/one.csv", "--out", f"{tmp_path}/curve"])
    points = [(r.fpr, r.tpr) for r in read.csv(f"{tmp_path}/curve").collect()]
    assert (0.0, 0.0) in points and (0.0, 1.0) in points and (1.0, 1.0) in points
    cli.main(["roc", f"{tmp_path}/labels.csv", f"{tmp_path}/one.csv", "--all-points", "--out", f"{tmp_path}/all"])
    assert read.csv(f"{tmp_path}/all").count() > len(points)
