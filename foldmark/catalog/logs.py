"""Queries over the metric log and the experiment index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.fixtures import METRIC_LOG, MODEL_FILES, fixture, with_tables
from foldmark.catalog.registry import query, r6
from foldmark.operators.ordering import row_numbers
from foldmark.operators.training_log import best_checkpoint, early_stop
from foldmark.sources.experiments import build_index, checkpoints, matching_checkpoints, parse_fold_files


def metric_log(spark: SparkSession, sf: str) -> DataFrame:
    numbered = row_numbers(fixture(spark, sf, METRIC_LOG), ("run",), "event_id", "_place")
    return numbered.select("run", "val_auc", (F.col("_place") - 1).alias("epoch"))


def _log_sql(body: str, **more: str) -> str:
    return with_tables(
        body,
        events_log=METRIC_LOG,
        metric_log="""
        SELECT run, val_auc, row_number() OVER (PARTITION BY run ORDER BY event_id) - 1 AS epoch FROM events_log
        """,
        **more,
    )


@query(
    "best_checkpoint",
    _log_sql(
        """
        SELECT run, epoch AS best_epoch, round(val_auc, 6) AS best_val_auc
        FROM metric_log QUALIFY row_number() OVER (PARTITION BY run ORDER BY val_auc DESC, epoch) = 1
        """
    ),
)
def best(spark, sf):
    result = best_checkpoint(metric_log(spark, sf))
    return result.withColumn("best_val_auc", r6(F.col("best_val_auc")))


@query(
    "early_stop",
    _log_sql(
        """
        SELECT stops.run, stop_epoch, waits.best_epoch, round(chosen.val_auc, 6) AS best_val_auc
        FROM stops
        JOIN waits ON waits.run = stops.run AND waits.epoch = coalesce(stop_epoch, last_epoch)
        JOIN metric_log chosen ON chosen.run = stops.run AND chosen.epoch = waits.best_epoch
        """,
        marked="""
        SELECT *, max(val_auc) OVER (PARTITION BY run ORDER BY epoch
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM metric_log
        """,
        waits="""
        SELECT *, max(CASE WHEN before IS NULL OR val_auc > before THEN epoch END)
                  OVER (PARTITION BY run ORDER BY epoch) AS best_epoch
        FROM marked
        """,
        stops="""
        SELECT run, min(CASE WHEN epoch - best_epoch >= 5 THEN epoch END) AS stop_epoch, max(epoch) AS last_epoch
        FROM waits GROUP BY run
        """,
    ),
)
def stop(spark, sf):
    result = early_stop(metric_log(spark, sf), patience=5)
    return result.withColumn("best_val_auc", r6(F.col("best_val_auc")))


_PARSED = r"""
SELECT run, regexp_extract(file, '^fold_(\d+)_(\d+).*', 1)::INTEGER AS fold_index,
       regexp_extract(file, '^fold_(\d+)_(\d+).*', 2)::INTEGER AS n_fold, file
FROM files WHERE regexp_matches(file, '^fold_(\d+)_(\d+).*')
"""


@query("fold_files", with_tables(_PARSED, files=MODEL_FILES))
def fold_files(spark, sf):
    return parse_fold_files(fixture(spark, sf, MODEL_FILES)).select("run", "fold_index", "n_fold", "file")


@query(
    "experiment_index",
    with_tables(
        """
        SELECT run, 'boosted_trees' AS model_type, 384 AS image_size, count(*) AS n_checkpoints,
               string_agg(fold_index || '/' || n_fold || '=' || file, ',' ORDER BY fold_index, n_fold, file) AS listed
        FROM parsed GROUP BY run
        """,
        files=MODEL_FILES,
        parsed=_PARSED,
    ),
)
def experiment_index(spark, sf):
    index = build_index(fixture(spark, sf, MODEL_FILES), "boosted_trees", 384, ("run",))
    listed = F.transform(
        "checkpoints", lambda c: F.concat_ws("=", F.concat_ws("/", c["fold_index"], c["n_fold"]), c["file"])
    )
    return index.select(
        "run",
        "model_type",
        "image_size",
        F.size("checkpoints").cast("bigint").alias("n_checkpoints"),
        F.array_join(listed, ",").alias("listed"),
    )


@query(
    "checkpoint_lookup",
    with_tables("SELECT run, file FROM parsed WHERE fold_index = 1 AND n_fold = 4", files=MODEL_FILES, parsed=_PARSED),
)
def checkpoint_lookup(spark, sf):
    index = build_index(fixture(spark, sf, MODEL_FILES), "boosted_trees", 384, ("run",))
    return matching_checkpoints(checkpoints(index), 1, 4).select("run", "file")
