"""Round trips: given tables through the sinks into a fresh folder below the checkpoint folder, and back through the sources."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from foldmark.catalog.fixtures import MODEL_FILES, PREDS, SAMPLES, TEST_SAMPLES, TRUTH, VECTORS, fixture, with_tables
from foldmark.catalog.registry import query, r6
from foldmark.functions.encode import SHORT_FEATURES, encode_features, model_input
from foldmark.operators.contracts import relabel_by_position, to_long, to_wide
from foldmark.operators.metrics import roc_auc
from foldmark.operators.passes import fold_columns_to_rows
from foldmark.plans.boosting import BoostParams, with_vector
from foldmark.plans.crossval import fit_folds, out_of_fold
from foldmark.schemas import ID, SITE
from foldmark.session import new_folder
from foldmark.sinks.files import write_files
from foldmark.sinks.models import load_model, save_model
from foldmark.sinks.tables import fill_submission, fold_predictions, write_csv, write_features, write_index, write_prepared, write_scored
from foldmark.sources import tables as sources
from foldmark.sources.experiments import build_index, checkpoints, list_model_files, list_saved_models, read_index

COLUMNS = (ID, "patient_id", "sex", "age_approx", SITE, "target", "dataset")


def _folded_samples(spark, sf):
    rows = fixture(spark, sf, SAMPLES).select(*COLUMNS[:5], F.col("target").cast("int").alias("target"), "dataset")
    fold = F.pmod(F.length(ID) + F.substring(ID, -3, 3).cast("int"), F.lit(4))
    return rows.withColumn("fold", fold.cast("int")).withColumn("sanity_check", F.lit(0))


_PREPARED = f"""
SELECT {', '.join(COLUMNS[:5])}, target::INTEGER AS target, dataset,
       ((length({ID}) + right({ID}, 3)::INTEGER) % 4)::INTEGER AS fold, 0 AS sanity_check FROM samples
"""


@query("prepared_csv", with_tables(_PREPARED, samples=SAMPLES))
def prepared_csv(spark, sf):
    write_csv(_folded_samples(spark, sf), folder := new_folder(spark))
    return sources.read_prepared(spark, folder)


@query("prepared_parquet", with_tables(f"SELECT * FROM ({_PREPARED}) WHERE fold <> 2", samples=SAMPLES))
def prepared_parquet(spark, sf):
    write_prepared(_folded_samples(spark, sf), folder := new_folder(spark))
    return spark.read.parquet(folder).where("fold <> 2").select(*COLUMNS, F.col("fold").cast("int").alias("fold"), "sanity_check")


@query("raw_columns_kept", with_tables(f"SELECT {ID}, sex, target::INTEGER AS target, dataset AS camera FROM samples", samples=SAMPLES))
def raw_columns_kept(spark, sf):
    raw = fixture(spark, sf, SAMPLES).select(ID, "sex", "target", F.col("dataset").alias("camera"))
    write_csv(raw, folder := new_folder(spark))
    return sources.read_raw_tables(spark, {"raw": folder})["raw"]


@query("test_csv", with_tables(f"SELECT {ID}, sex, age_approx, {SITE} FROM tests", tests=TEST_SAMPLES))
def test_csv(spark, sf):
    write_csv(fixture(spark, sf, TEST_SAMPLES), folder := new_folder(spark))
    return sources.read_test(spark, folder)


@query(
    "prediction_files",
    with_tables(
        f"""
        SELECT id::VARCHAR AS {ID}, 'a' AS model, round(m0, 6) AS p FROM preds
        UNION ALL SELECT id::VARCHAR, 'b', round(m2, 6) FROM preds
        """,
        preds=PREDS,
    ),
)
def prediction_files(spark, sf):
    folders, rows = {}, fixture(spark, sf, PREDS)
    for model, column in (("a", "m0"), ("b", "m2")):
        folders[model] = new_folder(spark)
        write_csv(rows.select(F.col("id").alias(ID), F.col(column).alias("target")), folders[model])
    return sources.read_predictions(spark, folders).withColumn("p", r6(F.col("p")))


@query(
    "fold_prediction_files",
    with_tables(
        f"""
        SELECT id::VARCHAR AS {ID}, 0 AS fold, round(m0, 6) AS p FROM preds
        UNION ALL SELECT id::VARCHAR, 1, round(m1, 6) FROM preds
        """,
        preds=PREDS,
    ),
)
def fold_prediction_files(spark, sf):
    rows = fixture(spark, sf, PREDS).select(F.col("id").cast("string").alias(ID), "m0", "m1")
    long = fold_columns_to_rows(rows.withColumnsRenamed({"m0": "0", "m1": "1"}), ["0", "1"])
    write_csv(fold_predictions(long, [0, 1]), folder := new_folder(spark))
    back = fold_columns_to_rows(sources.read_fold_predictions(spark, folder, 2), ["fold-0", "fold-1"])
    return back.withColumn("p", r6(F.col("p")))


@query(
    "relabel_files",
    with_tables("SELECT id::VARCHAR AS id, round(m0, 6) AS p FROM preds", preds=PREDS),
)
def relabel_files(spark, sf):
    """Ids and scores in files of unlike size, joined by position."""
    rows = fixture(spark, sf, PREDS)

    def ordered(parts: int):
        return rows.select("id", "m0").repartitionByRange(parts, "id").sortWithinPartitions("id")

    write_csv(ordered(3).select("id"), ids := new_folder(spark))
    write_csv(ordered(5).select(F.col("m0").alias("p")), values := new_folder(spark))
    read = spark.read.option("header", True)
    relabelled = relabel_by_position(read.csv(values), read.csv(ids), "id")
    return relabelled.select("id", r6(F.col("p")).alias("p"))


@query(
    "index_round_trip",
    with_tables(
        r"""
        SELECT run::VARCHAR AS run, file, regexp_extract(file, '^fold_(\d+)_(\d+).*', 1)::INTEGER AS fold_index,
               regexp_extract(file, '^fold_(\d+)_(\d+).*', 2)::INTEGER AS n_fold
        FROM files WHERE regexp_matches(file, '^fold_(\d+)_(\d+).*')
        """,
        files=MODEL_FILES,
    ),
)
def index_round_trip(spark, sf):
    files = fixture(spark, sf, MODEL_FILES).withColumn("run", F.col("run").cast("string"))
    write_index(build_index(files, "boosted_trees", 384, ("run",)), folder := new_folder(spark))
    return checkpoints(read_index(spark, folder, ("run",))).select("run", "file", "fold_index", "n_fold")


@query("feature_files", "SELECT vec_id, (embedding[1])::DOUBLE AS first, len(embedding)::INTEGER AS width FROM embeddings")
def feature_files(spark, sf):
    write_features(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding"), folder := new_folder(spark))
    back = spark.read.parquet(folder)
    return back.select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("first"), F.size("embedding").alias("width"))


@query(
    "submission_template",
    with_tables(
        """
        SELECT 'ID_' || truth.id AS image_name, coalesce(CASE WHEN truth.target = 1 THEN round(m0, 6) END, 0.125) AS target
        FROM truth LEFT JOIN preds ON preds.id = truth.id
        """,
        truth=TRUTH,
        preds=PREDS,
    ),
)
def submission_template(spark, sf):
    """A template read from a file gives the output's rows; rows without a result keep the template's value."""
    truth = fixture(spark, sf, TRUTH)
    name = F.concat(F.lit("ID_"), F.col("id").cast("string")).alias(ID)
    write_csv(truth.select(name, F.lit(0.125).alias("target")), folder := new_folder(spark))
    result = fixture(spark, sf, PREDS).join(truth.where("target = 1"), "id").select(name, F.col("m0").alias("target"))
    filled = fill_submission(sources.read_submission(spark, folder), result)
    return filled.withColumn("target", r6(F.col("target")))


@query(
    "scored_files",
    with_tables(
        """
        SELECT CAST(id AS VARCHAR) AS id, round(p, 6) AS target, round(auc, 6) AS auc
        FROM scored, (SELECT (sum(r) FILTER (target = 1) - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) AS auc
                      FROM (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM scored) AS ranked,
                           (SELECT count(*) FILTER (target = 1) AS n_pos, count(*) FILTER (target = 0) AS n_neg FROM scored) AS counts
                      GROUP BY n_pos, n_neg) AS measured
        """,
        truth=TRUTH,
        preds=PREDS,
        scored="SELECT truth.id, m0 AS p, target FROM {truth} truth JOIN {preds} preds ON preds.id = truth.id",
    ),
)
def scored_files(spark, sf):
    """Scores in a folder named by their AUC, with the metric's table beside them."""
    rows = fixture(spark, sf, TRUTH).join(fixture(spark, sf, PREDS).select("id", "m0"), "id")
    path = write_scored(rows.select("id", F.col("m0").alias("target")), roc_auc(rows, "m0", "target"), folder := new_folder(spark))
    metric = spark.read.parquet(f"{folder}/cv_auc_metric").head()
    if not path.endswith(f"_{metric['auc']}"):
        raise ValueError(f"{path} is not named by the AUC {metric['auc']}")
    scores = spark.read.option("header", True).csv(path)
    return scores.select("id", r6(F.col("target").cast("double")).alias("target"), F.round(F.lit(metric["auc"]), 6).alias("auc"))


@query(
    "model_file_list",
    with_tables("SELECT run || '-' || file AS file, length(file)::BIGINT AS length FROM files WHERE file LIKE 'fold_%'", files=MODEL_FILES),
)
def model_file_list(spark, sf):
    """Names and sizes of the model files in a folder, from its listing."""
    root = new_folder(spark)
    named = F.concat(F.col("run").cast("string"), F.lit("-"), F.col("file"))
    files = fixture(spark, sf, MODEL_FILES)
    write_files(files.select(F.concat(F.lit(f"{root}/"), named).alias("path"), F.col("file").cast("binary").alias("content")))
    return list_model_files(spark, root, "*-fold_*")


@query(
    "saved_model_files",
    "SELECT (vec_id % 8 // 2)::INTEGER AS fold_index, 4 AS n_fold, count(*) AS n FROM embeddings GROUP BY ALL",
)
def saved_model_files(spark, sf):
    """Fold models saved under fold, fold count and AUC, found again by their names; each scores the rows of its own folds."""
    rows = fixture(spark, sf, VECTORS).select(
        "vec_id", "embedding", (F.col("vec_id") % 8).cast("int").alias("fold"), F.when(F.col("label") < 5, 1).otherwise(0).alias("target")
    )
    table, root = with_vector(rows, (), ("embedding",)), new_folder(spark)
    fitted = fit_folds(table, 4, BoostParams(max_trees=2, patience=2, max_depth=2, first_trees=2))
    for i, f in fitted.items():
        save_model(PipelineModel([f.model]), root, i, 4, f.auc)
    index = checkpoints(build_index(list_saved_models(spark, root), "boosted_trees", 0)).collect()
    models = {r["fold_index"]: load_model(f"{root}/{r['file']}").stages[-1] for r in index}
    scored = out_of_fold(table, models, 4, "vec_id").where("p between 0 and 1")
    return scored.groupBy(F.col("val_index").alias("fold_index"), F.lit(4).alias("n_fold")).agg(F.count("*").alias("n"))


@query(
    "renamed_predictions",
    with_tables(
        """
        SELECT id, 'first' AS model, round(m0, 6) AS p FROM preds UNION ALL SELECT id, 'second', round(m1, 6) FROM preds
        UNION ALL SELECT id, 'third', round(m2, 6) FROM preds
        """,
        preds=PREDS,
    ),
)
def renamed_predictions(spark, sf):
    """Prediction columns renamed by their place, then as rows."""
    names = ("first", "second", "third")
    renamed = fixture(spark, sf, PREDS).select("id", "m0", "m1", "m2").toDF("id", *names)
    return to_long(renamed, "id", names).withColumn("p", r6(F.col("p")))


@query(
    "side_by_side",
    with_tables("SELECT id, round(m0, 6) AS m0, round(m1, 6) AS m1, round(m2, 6) AS m2 FROM preds", preds=PREDS),
)
def side_by_side(spark, sf):
    """Prediction tables set side by side by their key."""
    rows = fixture(spark, sf, PREDS)
    long = to_long(rows, "id", ("m0", "m1", "m2"))
    return to_wide(long, "id", ("m0", "m1", "m2")).select("id", *[r6(F.col(c)).alias(c) for c in ("m0", "m1", "m2")])


_INPUT = """
SELECT image_name, {0} AS target, pos::INTEGER AS pos, round([
  CASE sex WHEN 'male' THEN 1.0 WHEN 'female' THEN 0.0 ELSE 0.5 END::DOUBLE, coalesce(age_approx / 100, 0)::DOUBLE,
  CASE anatom_site_general_challenge WHEN 'head/neck' THEN 1 WHEN 'upper extremity' THEN 2 WHEN 'lower extremity' THEN 3
       WHEN 'torso' THEN 4 WHEN 'palms/soles' THEN 5 WHEN 'oral/genital' THEN 6 ELSE 0 END::DOUBLE][pos + 1], 6) AS value
FROM {1}, range(3) f(pos)
"""


@query(
    "model_inputs",
    with_tables(_INPUT.format("target", "samples") + " UNION ALL " + _INPUT.format("NULL", "tests"), samples=SAMPLES, tests=TEST_SAMPLES),
)
def model_inputs(spark, sf):
    """Features with the target where rows are labelled, and without one where they are not."""
    labelled = model_input(encode_features(fixture(spark, sf, SAMPLES)), SHORT_FEATURES)
    unlabelled = model_input(encode_features(fixture(spark, sf, TEST_SAMPLES)), SHORT_FEATURES, labelled=False)
    both = labelled.unionByName(unlabelled, allowMissingColumns=True)
    cells = both.select(ID, "target", F.posexplode("features").alias("pos", "value"))
    return cells.withColumn("value", r6(F.col("value")))
