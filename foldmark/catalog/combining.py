"""Queries that combine scores: ensembles, ranks, folds, passes, submissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldmark.catalog.fixtures import PREDS, TRUTH, TTA, fixture, with_tables
from foldmark.catalog.measuring import LONG_SQL, preds, preds_long, truth
from foldmark.catalog.registry import query, r6
from foldmark.operators import ensemble, passes
from foldmark.operators.contracts import to_wide
from foldmark.operators.ordering import row_numbers, with_ranks
from foldmark.sinks.tables import fill_submission, fold_predictions

MODELS = ("m0", "m1", "m2")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _long_sql(body: str) -> str:
    return with_tables(body, preds=PREDS, long=LONG_SQL)


def _rounded(df, *columns):
    return df.select("id", *[r6(F.col(c)).alias(c) for c in columns])


@query("ens_mean", _long_sql("SELECT id, round((m0 + m1 + m2) / 3, 6) AS target FROM preds"))
def ens_mean(spark, sf):
    return _rounded(ensemble.apply_rule("mean", preds_long(spark, sf), "id"), "target")


@query("ens_power", _long_sql("SELECT id, round((m0 * m0 + m1 * m1 + m2 * m2) / 3, 6) AS target FROM preds"))
def ens_power(spark, sf):
    return _rounded(ensemble.apply_rule("power", preds_long(spark, sf), "id"), "target")


@query("ens_blend", _long_sql("SELECT id, round(0.7 * m0 + 0.3 * m1, 6) AS target FROM preds"))
def ens_blend(spark, sf):
    wide = preds(spark, sf)
    first, second = wide.select("id", F.col("m0").alias("target")), wide.select("id", F.col("m1").alias("target"))
    return _rounded(ensemble.blend_two(first, second, 0.3, "id"), "target")


@query(
    "ens_scale",
    _long_sql(
        "SELECT id, model, round(p * CASE model WHEN 'm0' THEN 0.95 / 0.85 WHEN 'm1' THEN 2.0 ELSE 1.0 END, 6) AS p "
        "FROM long"
    ),
)
def ens_scale(spark, sf):
    scaled = ensemble.scale_scores(preds_long(spark, sf), {"m0": 0.95 / 0.85, "m1": 2.0})
    return scaled.select("id", "model", r6(F.col("p")).alias("p"))


_RANKED = """
SELECT id, model, p, rank() OVER (PARTITION BY model ORDER BY p)
       + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0 AS avg_rank,
       rank() OVER (PARTITION BY model ORDER BY p) AS min_rank
FROM long
"""


AVG_RANK = _long_sql(f"SELECT id, model, avg_rank::DOUBLE AS avg_rank, min_rank::BIGINT AS min_rank FROM ({_RANKED})")


@query("avg_rank", AVG_RANK)
def avg_rank(spark, sf):
    ranked = with_ranks(preds_long(spark, sf), "p", "id", ("model",))
    return ranked.select("id", "model", "avg_rank", "min_rank")


# Buckets far smaller than a task's share, so that small tables run through dozens of them.
@query("rank_bucketed", AVG_RANK)
def rank_bucketed(spark, sf):
    ranked = with_ranks(preds_long(spark, sf), "p", "id", ("model",), rows_per_bucket=100)
    return ranked.select("id", "model", "avg_rank", "min_rank")


# Models that scored only some ids: a null score has no rank, the others are ranked without it.
@query(
    "avg_rank_nulls",
    with_tables(
        """
        SELECT id, p, CASE WHEN p IS NOT NULL THEN
                 (rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0)::DOUBLE END AS avg_rank
        FROM holes
        """,
        preds=PREDS,
        holes="SELECT id, CASE WHEN m0 > 0.2 THEN m2 END AS p FROM preds",
    ),
)
def avg_rank_nulls(spark, sf):
    holes = preds(spark, sf).select("id", F.when(F.col("m0") > 0.2, F.col("m2")).alias("p"))
    return with_ranks(holes, "p", "id").select("id", "p", "avg_rank")


ENS_RANK = _long_sql(
    f"""
    SELECT id, rank() OVER (ORDER BY mean_rank)::BIGINT AS target
    FROM (SELECT id, round(avg(avg_rank), 6) AS mean_rank FROM ({_RANKED}) GROUP BY id)
    """
)


@query("ens_rank", ENS_RANK)
def ens_rank(spark, sf):
    return ensemble.apply_rule("rank", preds_long(spark, sf), "id")


@query("ens_rank_bucketed", ENS_RANK)
def ens_rank_bucketed(spark, sf):
    return ensemble.rank_ensemble(preds_long(spark, sf), "id", rows_per_bucket=100)


@query(
    "lowest_mean_rank",
    _long_sql(
        f"""
        SELECT id, round(avg(avg_rank), 6) AS mean_rank FROM ({_RANKED})
        GROUP BY id ORDER BY avg(avg_rank), id LIMIT 64
        """
    ),
)
def lowest_mean_rank(spark, sf):
    return _rounded(ensemble.lowest_mean_ranks(preds_long(spark, sf), 64, "id"), "mean_rank")


@query(
    "ens_consensus",
    _long_sql(
        """
        SELECT id, round(CASE WHEN least(m0, m1, m2) > 0.66 THEN greatest(m0, m1, m2)
                              WHEN greatest(m0, m1, m2) < 0.33 THEN least(m0, m1, m2) ELSE m0 END, 6) AS target
        FROM preds
        """
    ),
)
def ens_consensus(spark, sf):
    return _rounded(ensemble.consensus_ensemble(preds_long(spark, sf), "m0", key="id", models=MODELS), "target")


# The base comes from another table and has no vote.
@query(
    "ens_consensus_base_table",
    _long_sql(
        """
        SELECT id, round(CASE WHEN least(m1, m2) > 0.7 THEN greatest(m1, m2)
                              WHEN greatest(m1, m2) < 0.01 THEN least(m1, m2) ELSE m0 END, 6) AS target
        FROM preds
        """
    ),
)
def ens_consensus_base_table(spark, sf):
    above, below = ensemble.SUBMISSION_CUTOFFS
    votes = preds_long(spark, sf).where(F.col("model") != "m0")
    base = preds(spark, sf).select("id", F.col("m0").alias("p"))
    return _rounded(ensemble.consensus_ensemble(votes, base, above, below, "id"), "target")


@query(
    "unanimous",
    _long_sql(
        """
        SELECT id, (least(m0, m1, m2) > 0.66)::INTEGER AS all_above, (greatest(m0, m1, m2) < 0.33)::INTEGER AS all_below
        FROM preds
        """
    ),
)
def unanimous(spark, sf):
    votes = ensemble.unanimous(preds_long(spark, sf), 0.66, 0.33, "id", models=MODELS)
    return votes.select("id", *[F.col(c).cast("int").alias(c) for c in ("all_above", "all_below")])


# One model has no row for part of the ids.
ABSENT = "SELECT id, m0, CASE WHEN m1 BETWEEN 0.2 AND 0.8 THEN m1 END AS m1, m2 FROM preds"


def votes_with_gaps(spark, sf):
    held = (F.col("model") != "m1") | F.col("p").between(0.2, 0.8)
    return preds_long(spark, sf).where(held)


@query(
    "ens_consensus_absent",
    _long_sql(
        f"""
        SELECT id, round(CASE WHEN m0 > 0.66 AND m1 > 0.66 AND m2 > 0.66 THEN greatest(m0, m1, m2)
                              WHEN m0 < 0.33 AND m1 < 0.33 AND m2 < 0.33 THEN least(m0, m1, m2) ELSE m0 END, 6) AS target
        FROM ({ABSENT}) WHERE m0 IS NOT NULL OR m1 IS NOT NULL OR m2 IS NOT NULL
        """
    ),
)
def ens_consensus_absent(spark, sf):
    votes = votes_with_gaps(spark, sf).where(F.col("p").isNotNull())
    return _rounded(ensemble.consensus_ensemble(votes, "m0", key="id"), "target")


@query(
    "unanimous_absent",
    _long_sql(
        f"""
        SELECT id, coalesce(m0 > 0.66 AND m1 > 0.66 AND m2 > 0.66, false)::INTEGER AS all_above,
               coalesce(m0 < 0.33 AND m1 < 0.33 AND m2 < 0.33, false)::INTEGER AS all_below
        FROM ({ABSENT}) WHERE m0 IS NOT NULL OR m1 IS NOT NULL OR m2 IS NOT NULL
        """
    ),
)
def unanimous_absent(spark, sf):
    votes = votes_with_gaps(spark, sf).where(F.col("p").isNotNull())
    voted = ensemble.unanimous(votes, 0.66, 0.33, "id", models=("m0", "m1", "m2"))
    return voted.select("id", *[F.col(c).cast("int").alias(c) for c in ("all_above", "all_below")])


@query(
    "row_median",
    _long_sql(
        """
        SELECT id, round(max(p), 6) AS max, round(min(p), 6) AS min, round(avg(p), 6) AS mean,
               round(median(p), 6) AS median FROM long GROUP BY id
        """
    ),
)
def row_median(spark, sf):
    return _rounded(ensemble.row_statistics(preds_long(spark, sf), "id"), "max", "min", "mean", "median")


@query("top_n", _long_sql("SELECT id, round(m1, 6) AS m1 FROM preds ORDER BY preds.m1 DESC NULLS LAST, id LIMIT 30"))
def top_n(spark, sf):
    return _rounded(ensemble.largest(preds(spark, sf).select("id", "m1"), "m1", 30, "id"), "m1")


@query(
    "submission_fill",
    with_tables(
        "SELECT truth.id, round(coalesce(m0, 0.5), 6) AS target FROM truth LEFT JOIN preds ON preds.id = truth.id",
        truth=TRUTH,
        preds=PREDS,
    ),
)
def submission_fill(spark, sf):
    template = truth(spark, sf).select("id", F.lit(0.5).alias("target"))
    filled = fill_submission(template, preds(spark, sf).select("id", F.col("m0").alias("target")), "id")
    return _rounded(filled, "target")


# Prediction tables of different id sets side by side: a full outer alignment.
@query(
    "outer_align",
    with_tables(
        """
        SELECT coalesce(a.id, b.id) AS id, round(a.p, 6) AS first, round(b.p, 6) AS second
        FROM (SELECT id, m0 AS p FROM preds WHERE m0 > 0.3) a
        FULL JOIN (SELECT id, m2 AS p FROM preds WHERE m2 > 0.3) b ON a.id = b.id
        """,
        preds=PREDS,
    ),
)
def outer_align(spark, sf):
    long = preds_long(spark, sf).where((F.col("p") > 0.3) & F.col("model").isin("m0", "m2"))
    wide = to_wide(long, "id", ("m0", "m2"))
    return wide.select("id", r6(F.col("m0")).alias("first"), r6(F.col("m2")).alias("second"))


def _tta_sql(body: str) -> str:
    return with_tables(
        body, tta=TTA, fold_means="SELECT id, fold, avg(p) AS p FROM tta GROUP BY id, fold"
    )


@query("tta_mean", _tta_sql("SELECT id, fold, round(p, 6) AS p FROM fold_means"))
def tta_mean(spark, sf):
    means = passes.mean_over_passes(fixture(spark, sf, TTA), "id")
    return means.select("id", "fold", r6(F.col("p")).alias("p"))


@query("fold_mean", _tta_sql("SELECT id, round(avg(p), 6) AS p FROM fold_means GROUP BY id"))
def fold_mean(spark, sf):
    return _rounded(passes.mean_of_passes_and_folds(fixture(spark, sf, TTA), "id"), "p")


@query(
    "fold_pivot",
    _tta_sql(
        "SELECT id, "
        + ", ".join(f"round(max(CASE WHEN fold = '{e}' THEN p END), 6) AS \"fold-{e}\"" for e in EVENT_TYPES)
        + " FROM fold_means GROUP BY id"
    ),
)
def fold_pivot(spark, sf):
    means = passes.mean_over_passes(fixture(spark, sf, TTA), "id")
    wide = fold_predictions(means, EVENT_TYPES, "id")
    return wide.select("id", *[r6(F.col(f"`fold-{e}`")).alias(f"fold-{e}") for e in EVENT_TYPES])


@query("fold_column_mean", _tta_sql("SELECT id, round(avg(p), 6) AS target FROM fold_means GROUP BY id"))
def fold_column_mean(spark, sf):
    wide = fold_predictions(passes.mean_over_passes(fixture(spark, sf, TTA), "id"), EVENT_TYPES, "id")
    return _rounded(passes.mean_of_fold_columns(wide, [f"fold-{e}" for e in EVENT_TYPES], "id"), "target")


@query(
    "pass_numbers",
    _tta_sql(
        """
        SELECT id, fold, event_id, row_number() OVER (PARTITION BY id, fold ORDER BY event_id) - 1 AS tta_index
        FROM tta
        """
    ),
)
def pass_numbers(spark, sf):
    numbered = row_numbers(fixture(spark, sf, TTA), ("id", "fold"), "event_id", "_place")
    return numbered.select("id", "fold", "event_id", (F.col("_place") - 1).alias("tta_index"))
