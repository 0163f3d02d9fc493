"""The experiment index: which model files belong to which fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.schemas import EXPERIMENT_INDEX

#: Models that a scoring job hands to every worker, all folds together.
MODEL_LIMIT_BYTES = 2 << 30

# Fixed value: the prefix of a fold model's file name, fold index then fold count.
FOLD_FILE = r"^fold_(\d+)_(\d+).*"


def list_model_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(file, length) of the files in a folder; their content is never read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length")


def read_model_files(spark: SparkSession, root: str, files: Sequence[str], limit_bytes: int = MODEL_LIMIT_BYTES) -> dict[str, bytes]:
    """The content of model files by name, through Spark, so that any store it reads will do.

    Their total size is checked before any of them is read; a missing file is an error.
    """
    found = spark.read.format("binaryFile").load(root).withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
    found = found.where(F.col("file").isin(*files))
    total = found.agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]
    if total > limit_bytes:
        raise ValueError(f"the models hold {total} bytes, more than the {limit_bytes} every worker may hold; load them by path")
    content = {r["file"]: bytes(r["content"]) for r in found.select("file", "content").collect()}
    missing = sorted(set(files) - set(content))
    if missing:
        raise ValueError(f"no model file {missing[0]} under {root}")
    return content


def list_saved_models(spark: SparkSession, root: str) -> DataFrame:
    """(file, length) of the Spark model folders under a root, found by their metadata files."""
    found = spark.read.format("binaryFile").load(f"{root}/*/metadata")
    name = F.regexp_extract("path", r"([^/]+)/metadata/[^/]+$", 1)
    return found.select(name.alias("file"), "length").groupBy("file").agg(F.sum("length").alias("length"))


def parse_fold_files(files: DataFrame, file: str = "file") -> DataFrame:
    """Add ``fold_index`` and ``n_fold`` from the file name; other files are skipped."""
    parsed = files.where(F.col(file).rlike(FOLD_FILE))
    return parsed.withColumns(
        {
            "fold_index": F.regexp_extract(file, FOLD_FILE, 1).cast("int"),
            "n_fold": F.regexp_extract(file, FOLD_FILE, 2).cast("int"),
        }
    )


def build_index(files: DataFrame, model_type: str, image_size: int, experiment: Sequence[str] = ()) -> DataFrame:
    """One index row per experiment; its list has one entry per model file, a handful per fold."""
    entries = F.collect_list(F.struct("fold_index", "n_fold", "file"))
    return (
        parse_fold_files(files)
        .groupBy(*experiment)
        .agg(F.array_sort(entries).alias("checkpoints"))
        .select(
            *experiment, F.lit(model_type).alias("model_type"), F.lit(image_size).alias("image_size"), "checkpoints"
        )
    )


#: Between two JSON objects of a file: lines of their own. Inside an array or an object a comma comes first.
_BETWEEN = r"(?<=\})[ \t]*\r?\n\s*(?=\{)"


def read_index(spark: SparkSession, path: str, experiment: Sequence[str] = ()) -> DataFrame:
    """Index rows of files that hold one JSON object, an array of them, or one per line, on as many lines as they like.

    ``experiment`` are the columns that name the experiment; those that are folders of the path come from the folders.
    """
    text = spark.read.text(path, wholetext=True)
    folders = [c for c in experiment if c in text.columns]
    named = [T.StructField(c, T.StringType()) for c in experiment if c not in folders]
    schema = T.ArrayType(T.StructType([*named, *EXPERIMENT_INDEX.fields]))
    parts = text.select(*[F.col(c).cast("string").alias(c) for c in folders], F.explode(F.split("value", _BETWEEN)).alias("part"))
    rows = parts.select(*folders, F.inline(F.from_json("part", schema, {"mode": "FAILFAST"})))
    return rows.select(*experiment, *EXPERIMENT_INDEX.fieldNames())


def checkpoints(index: DataFrame, stored_minus_one: bool = False) -> DataFrame:
    """One row per checkpoint. ``stored_minus_one`` reads indexes whose n_fold is the fold count less one."""
    kept = [c for c in index.columns if c != "checkpoints"]
    rows = index.select(*kept, F.inline("checkpoints"))
    return rows.withColumn("n_fold", F.col("n_fold") + 1) if stored_minus_one else rows


def matching_checkpoints(rows: DataFrame, fold_index: int, n_fold: int) -> DataFrame:
    return rows.where((F.col("fold_index") == fold_index) & (F.col("n_fold") == n_fold))


def find_checkpoint(rows: DataFrame, fold_index: int, n_fold: int) -> str:
    """File of one fold's model; not finding it is an error."""
    match = matching_checkpoints(rows, fold_index, n_fold).select("file").head(1)
    if not match:
        raise ValueError(f"no checkpoint for fold {fold_index} of {n_fold}")
    return match[0][0]
