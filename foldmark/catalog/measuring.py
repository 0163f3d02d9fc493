"""Queries over predictions and labels: alignment and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.fixtures import LINE_SCORES, PREDS, TRUTH, fixture, with_tables
from foldmark.catalog.registry import query, r6
from foldmark.functions.scores import sigmoid, smooth_label
from foldmark.operators import metrics
from foldmark.operators.contracts import align_predictions, missing_predictions, to_long

MODELS = ("m0", "m1", "m2")
LONG_SQL = "SELECT id, model, p FROM preds UNPIVOT (p FOR model IN (m0, m1, m2))"


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, TRUTH)


def preds(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, PREDS)


def preds_long(spark: SparkSession, sf: str) -> DataFrame:
    return to_long(preds(spark, sf), "id", MODELS)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(id, target, m0, m1, m2) of the predicted ids."""
    return preds(spark, sf).join(truth(spark, sf), "id")


def scored_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = scored(spark, sf)
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in MODELS])
    return wide.select("id", "target", F.inline(cells))


def line_scores(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, LINE_SCORES)


def _scored_sql(body: str, **more: str) -> str:
    return with_tables(
        body,
        truth=TRUTH,
        preds=PREDS,
        scored="SELECT preds.id, target, m0, m1, m2 FROM preds JOIN truth ON truth.id = preds.id",
        scored_long="SELECT id, target, model, p FROM scored UNPIVOT (p FOR model IN (m0, m1, m2))",
        **more,
    )


def _auc_sql(source: str, score: str, group: str | None, missing: str = "NULL") -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
    SELECT {g}round(CASE WHEN n_pos = 0 THEN {missing} ELSE wins / nullif(n_pos::DOUBLE * n_neg, 0) END, 6) AS auc,
           n_pos, n_neg
    FROM (SELECT {g}sum(pos::DOUBLE * (below + neg / 2.0)) AS wins, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg
          FROM (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY {score}
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                FROM (SELECT {g}{score}, sum(target) AS pos, sum(1 - target) AS neg
                      FROM {source} GROUP BY {g}{score}))
          {"GROUP BY " + group if group else ""})
    """


@query("align_predictions", _scored_sql("SELECT id, target, m0, m1, m2 FROM scored"))
def align(spark, sf):
    predicted = preds(spark, sf)
    labels = truth(spark, sf).join(predicted.select("id"), "id", "left_semi")
    return align_predictions(labels, predicted, "id", MODELS, strict=True, unique=True)


@query("missing_predictions", _scored_sql("SELECT id, target FROM truth WHERE id NOT IN (SELECT id FROM preds)"))
def missing(spark, sf):
    return missing_predictions(truth(spark, sf), preds(spark, sf), "id")


@query("auc_exact", _scored_sql(_auc_sql("scored_long", "p", "model")))
def auc_exact(spark, sf):
    result = metrics.roc_auc(scored_long(spark, sf), "p", "target", ("model",))
    return result.withColumn("auc", r6(F.col("auc")))


@query("auc_large", with_tables(_auc_sql("lines", "l_extendedprice", None), lines=LINE_SCORES))
def auc_large(spark, sf):
    result = metrics.roc_auc(line_scores(spark, sf), "l_extendedprice", "target")
    return result.withColumn("auc", r6(F.col("auc")))


# Buckets far smaller than a task's share, so that small tables run through dozens of them.
@query("auc_bucketed", with_tables(_auc_sql("lines", "l_extendedprice", None), lines=LINE_SCORES))
def auc_bucketed(spark, sf):
    result = metrics.roc_auc(line_scores(spark, sf), "l_extendedprice", "target", rows_per_bucket=1000)
    return result.withColumn("auc", r6(F.col("auc")))


@query("auc_tied", with_tables(_auc_sql("lines", "l_discount", None), lines=LINE_SCORES))
def auc_tied(spark, sf):
    result = metrics.roc_auc(line_scores(spark, sf), "l_discount", "target")
    return result.withColumn("auc", r6(F.col("auc")))


@query("auc_by_group", with_tables(_auc_sql("lines", "l_extendedprice", "l_linestatus"), lines=LINE_SCORES))
def auc_by_group(spark, sf):
    result = metrics.roc_auc(line_scores(spark, sf), "l_extendedprice", "target", ("l_linestatus",))
    return result.withColumn("auc", r6(F.col("auc")))


@query(
    "auc_one_class",
    with_tables(
        _auc_sql("flags", "l_extendedprice", "l_returnflag", missing="0.5"),
        flags="""
        SELECT l_returnflag, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target FROM {lineitem}
        """,
    ),
)
def auc_one_class(spark, sf):
    flags = fixture(
        spark,
        sf,
        "SELECT l_returnflag, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target FROM {lineitem}",
    )
    result = metrics.roc_auc(flags, "l_extendedprice", "target", ("l_returnflag",), no_positive=0.5)
    return result.withColumn("auc", r6(F.col("auc")))


def _roc_sql(bends: bool) -> str:
    kept = "WHERE tp = pos AND fp = neg OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg" if bends else ""
    return _scored_sql(
        f"""
        SELECT model, round(fp::DOUBLE / n_neg, 6) AS fpr, round(tp::DOUBLE / n_pos, 6) AS tpr,
               round(p, 6) AS threshold FROM points {kept}
        UNION ALL SELECT model, 0.0, 0.0, round(max(p) + 1, 6) FROM hist GROUP BY model
        """,
        hist="SELECT model, p, sum(target) AS pos, sum(1 - target) AS neg FROM scored_long GROUP BY model, p",
        points="""
        SELECT *, sum(pos) OVER above AS tp, sum(neg) OVER above AS fp,
               lead(pos) OVER above AS next_pos, lead(neg) OVER above AS next_neg,
               sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg
        FROM hist WINDOW above AS (PARTITION BY model ORDER BY p DESC)
        """,
    )


def _roc(spark, sf, drop_collinear, **size):
    points = metrics.roc_curve(scored_long(spark, sf), "p", "target", ("model",), drop_collinear=drop_collinear, **size)
    return points.select("model", *[r6(F.col(c)).alias(c) for c in ("fpr", "tpr", "threshold")])


@query("roc_curve", _roc_sql(bends=True))
def roc_bends(spark, sf):
    return _roc(spark, sf, True)


@query("roc_bucketed", _roc_sql(bends=True))
def roc_bucketed(spark, sf):
    return _roc(spark, sf, True, rows_per_bucket=100)


@query("roc_curve_full", _roc_sql(bends=False))
def roc_full(spark, sf):
    return _roc(spark, sf, False)


@query(
    "accuracy",
    _scored_sql(
        "SELECT model, round(avg((round_even(p, 0) = target)::INTEGER), 6) AS accuracy FROM scored_long GROUP BY model"
    ),
)
def accuracy(spark, sf):
    result = metrics.accuracy(scored_long(spark, sf), "p", "target", ("model",))
    return result.withColumn("accuracy", r6(F.col("accuracy")))


# A logit for every score, the label smoothed by 0.05 and positives weighted by 2.
_LOGIT = "(p * 8 - 4)"
_SMOOTH = "(target * 0.95 + 0.025)"
_LOSS = f"(1 - {_SMOOTH}) * {_LOGIT} + (1 + {_SMOOTH}) * (ln(1 + exp(-abs({_LOGIT}))) + greatest(-{_LOGIT}, 0))"


def _with_logit(df: DataFrame) -> DataFrame:
    return df.withColumn("logit", F.col("p") * 8 - 4)


@query("bce_loss", _scored_sql(f"SELECT model, round(avg({_LOSS}), 6) AS loss FROM scored_long GROUP BY model"))
def bce_loss(spark, sf):
    rows = _with_logit(scored_long(spark, sf))
    result = metrics.mean_loss(rows, "logit", "target", ("model",), pos_weight=2.0, smoothing=0.05)
    return result.withColumn("loss", r6(F.col("loss")))


@query(
    "sigmoid",
    _scored_sql(
        f"""
        SELECT id, model, round(1 / (1 + exp(-{_LOGIT})), 6) AS probability, round({_SMOOTH}::DOUBLE, 6) AS smoothed
        FROM scored_long
        """
    ),
)
def sigmoid_query(spark, sf):
    rows = _with_logit(scored_long(spark, sf))
    return rows.select(
        "id",
        "model",
        r6(sigmoid(F.col("logit"))).alias("probability"),
        r6(smooth_label(F.col("target"), 0.05)).alias("smoothed"),
    )


@query(
    "epoch_metrics",
    _scored_sql(
        f"""
        SELECT steps.model AS run, steps.fold, round(avg({_LOSS}), 6) AS val_loss,
               round(avg((round_even(p, 0) = target)::INTEGER), 6) AS val_acc, round(any_value(auc), 6) AS val_auc
        FROM steps JOIN aucs ON aucs.model = steps.model AND aucs.fold = steps.fold
        GROUP BY steps.model, steps.fold
        """,
        steps="SELECT *, id % 4 AS fold FROM scored_long",
        hist="SELECT model, fold, p, sum(target) AS pos, sum(1 - target) AS neg FROM steps GROUP BY model, fold, p",
        ranked="SELECT *, sum(neg) OVER (PARTITION BY model, fold ORDER BY p) - neg AS below FROM hist",
        aucs="""
        SELECT model, fold, sum(pos::DOUBLE * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
        FROM ranked GROUP BY model, fold
        """,
    ),
)
def epoch_metrics(spark, sf):
    rows = _with_logit(scored_long(spark, sf)).withColumn("fold", F.col("id") % 4).withColumnRenamed("model", "run")
    result = metrics.epoch_metrics(
        rows, "logit", "p", "target", ("run", "fold"), pos_weight=2.0, smoothing=0.05
    )
    return result.select("run", "fold", *[r6(F.col(c)).alias(c) for c in ("val_loss", "val_acc", "val_auc")])


DESCRIBE = with_tables(
    """
    SELECT model, count(p) AS count, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std,
           round(min(p), 6) AS min, round(quantile_cont(p, 0.25), 6) AS p25, round(quantile_cont(p, 0.5), 6) AS p50,
           round(quantile_cont(p, 0.75), 6) AS p75, round(max(p), 6) AS max
    FROM long GROUP BY model
    """,
    preds=PREDS,
    long=LONG_SQL,
)


def _described(result):
    numbers = ("mean", "std", "min", "p25", "p50", "p75", "max")
    return result.select("model", "count", *[r6(F.col(c)).alias(c) for c in numbers])


@query("describe_predictions", DESCRIBE)
def describe(spark, sf):
    return _described(metrics.describe(preds_long(spark, sf), "p"))


@query("describe_bucketed", DESCRIBE)
def describe_bucketed(spark, sf):
    return _described(metrics.describe(preds_long(spark, sf), "p", rows_per_bucket=100))
