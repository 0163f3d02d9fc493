"""Queries over pixel and coefficient arrays: every embedding is an 8x8 image, a block, a feature vector."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.fixtures import SAMPLES, VECTORS, fixture, with_tables
from foldmark.catalog.registry import query, r6
from foldmark.functions import arrays
from foldmark.functions.encode import SHORT_FEATURES, encode_features, feature_array
from foldmark.operators.passes import stack_features
from foldmark.plans import scoring, views
from foldmark.plans.boosting import join_features
from foldmark.plans.views import CHANNEL_MEAN, CHANNEL_STD
from foldmark.schemas import ID
from foldmark.session import spread

SIDE = 8
SEED = 47
N_PASSES = 5
ZIGZAG_SQL = "[" + ", ".join(map(str, arrays.zigzag_order())) + "]"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, VECTORS)


def _cells(df: DataFrame, column: str) -> DataFrame:
    """Array elements as rows (vec_id, pos, value)."""
    exploded = df.select("vec_id", F.posexplode(column).alias("pos", "value"))
    return exploded.withColumn("value", F.col("value").cast("double") + F.lit(0.0))


def _cells_sql(value: str, length: int = SIDE * SIDE) -> str:
    return f"""
    SELECT vec_id, pos::INTEGER AS pos, ({value})::DOUBLE + 0.0 AS value
    FROM embeddings, range({length}) t(pos)
    """


@query("zigzag", _cells_sql(f"embedding[{ZIGZAG_SQL}[pos + 1] + 1]", 8))
def zigzag(spark, sf):
    return _cells(vectors(spark, sf).withColumn("z", arrays.zigzag_block(F.col("embedding"), 8)), "z")


# The embedding as four blocks of a component two blocks wide; every second block row and column is kept.
@query(
    "zigzag_thinned",
    f"""
    SELECT vec_id, pos::INTEGER AS pos,
           CASE WHEN pos < 6 THEN embedding[{ZIGZAG_SQL}[pos + 1] + 1]
                ELSE embedding[{ZIGZAG_SQL}[pos - 5] + 1] END::DOUBLE + 0.0 AS value
    FROM embeddings, range(12) t(pos)
    """,
)
def zigzag_thinned(spark, sf):
    e = F.col("embedding")
    # Luma one block; chroma 2x2 blocks of which the first survives the step of 2 * 2 / 2 = 2.
    chroma = F.array(e, F.reverse(e), F.reverse(e), F.reverse(e))
    empty = F.slice(F.array(e), 1, 0)
    flat = arrays.zigzag_image(F.array(e), chroma, empty, 6, F.lit(2), F.lit(2), F.lit(2))
    return _cells(vectors(spark, sf).withColumn("z", flat), "z")


@query(
    "flips",
    f"""
    SELECT vec_id, pos::INTEGER AS pos,
           embedding[(pos // {SIDE}) * {SIDE} + {SIDE - 1} - pos % {SIDE} + 1]::DOUBLE + 0.0 AS horizontal,
           embedding[({SIDE - 1} - pos // {SIDE}) * {SIDE} + pos % {SIDE} + 1]::DOUBLE + 0.0 AS vertical
    FROM embeddings, range({SIDE * SIDE}) t(pos)
    """,
)
def flips(spark, sf):
    e = F.col("embedding")
    both = F.arrays_zip(
        arrays.flip(e, SIDE, SIDE, horizontal=True).alias("h"), arrays.flip(e, SIDE, SIDE, vertical=True).alias("v")
    )
    rows = vectors(spark, sf).select("vec_id", F.posexplode(both).alias("pos", "cell"))
    return rows.select(
        "vec_id",
        "pos",
        (F.col("cell.h").cast("double") + F.lit(0.0)).alias("horizontal"),
        (F.col("cell.v").cast("double") + F.lit(0.0)).alias("vertical"),
    )


@query(
    "circle_mask",
    _cells_sql(
        f"CASE WHEN power(pos // {SIDE} - 4, 2) + power(pos % {SIDE} - 4, 2) <= power(1 + vec_id % 5, 2) "
        "THEN embedding[pos + 1] ELSE 0 END"
    ),
)
def circle_mask(spark, sf):
    radius = (F.lit(1) + F.col("vec_id") % 5).cast("int")
    return _cells(
        vectors(spark, sf).withColumn("m", arrays.circle_mask(F.col("embedding"), SIDE, SIDE, radius)), "m"
    )


_MEAN_SQL, _STD_SQL = (f"{list(values)}" for values in (CHANNEL_MEAN, CHANNEL_STD))


@query(
    "normalize",
    _cells_sql(
        f"round((abs(embedding[pos + 1]::DOUBLE) * 255 / 255.0 - {_MEAN_SQL}[pos % 3 + 1]) "
        f"/ {_STD_SQL}[pos % 3 + 1], 6)"
    ),
)
def normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: F.abs(x.cast("double")) * 255)
    cells = _cells(
        vectors(spark, sf).withColumn("n", arrays.normalize_channels(scaled, CHANNEL_MEAN, CHANNEL_STD)), "n"
    )
    return cells.withColumn("value", r6(F.col("value")))


def _coin_sql(stage: str) -> str:
    return f"md5(vec_id || ':' || tta_index || ':{stage}:{SEED}')[1:1] < '8'"


def flipped(features: Column, key: Column, tta_index: Column) -> Column:
    """View of an 8x8 image: each flip for half of the passes."""
    coins = {side: arrays.hash_coin(key, side, tta_index, SEED) for side in ("horizontal", "vertical")}
    return arrays.flip(features, SIDE, SIDE, **coins)


_FLIPPED_SQL = f"""
SELECT vec_id, tta_index, pos,
       embedding[(CASE WHEN {_coin_sql("vertical")} THEN {SIDE - 1} - pos // {SIDE} ELSE pos // {SIDE} END) * {SIDE}
                 + (CASE WHEN {_coin_sql("horizontal")} THEN {SIDE - 1} - pos % {SIDE} ELSE pos % {SIDE} END) + 1]::DOUBLE
       AS value
FROM embeddings, range({N_PASSES}) passes(tta_index), range({SIDE * SIDE}) cells(pos)
"""


_STACK_SQL = with_tables(
    "SELECT vec_id, tta_index::INTEGER AS tta_index, pos::INTEGER AS pos, value + 0.0 AS value FROM flipped",
    flipped=_FLIPPED_SQL,
)


@query("feature_stack", _STACK_SQL)
def feature_stack(spark, sf):
    """The passes stay in their row."""
    rows = vectors(spark, sf)
    return _stack_cells(rows.select("vec_id", scoring.views_in_row(rows, N_PASSES, flipped, "vec_id", "embedding").alias("features")))


def _stack_cells(stacked: DataFrame) -> DataFrame:
    per_pass = stacked.select("vec_id", F.posexplode("features").alias("tta_index", "row"))
    cells = per_pass.select("vec_id", "tta_index", F.posexplode("row").alias("pos", "value"))
    return cells.withColumn("value", F.col("value").cast("double") + F.lit(0.0))


@query("feature_stack_rows", _STACK_SQL)
def feature_stack_rows(spark, sf):
    """The passes come as rows, as from files."""
    passes = vectors(spark, sf).withColumn("tta_index", F.explode(F.sequence(F.lit(0), F.lit(N_PASSES - 1))))
    viewed = passes.select(
        "vec_id", "tta_index", flipped(F.col("embedding"), F.col("vec_id"), F.col("tta_index")).alias("features")
    )
    return _stack_cells(stack_features(viewed, N_PASSES, "vec_id"))


WEIGHTS = [(i * 37 % 64 - 31.5) / 64 for i in range(64)]
_WEIGHT_SQL = "((pos * 37 % 64 - 31.5) / 64)::DOUBLE"


def linear_predictor(scale: float):
    """A predictor with fixed weights: a logistic score, and the first two inputs as features."""

    def make():
        weights = np.array(WEIGHTS) * scale

        def predict(batch):
            logits = batch.astype(np.float64) @ weights
            return 1 / (1 + np.exp(-logits)), batch[:, :2]

        return predict

    return make


@query(
    "batch_score",
    f"""
    SELECT vec_id, round(1 / (1 + exp(-sum(embedding[pos + 1]::DOUBLE * {_WEIGHT_SQL}))), 6) AS score,
           any_value(embedding[1])::DOUBLE AS f0, any_value(embedding[2])::DOUBLE AS f1
    FROM embeddings, range(64) t(pos) GROUP BY vec_id
    """,
)
def batch_score(spark, sf):
    scorer = scoring.batch_scorer(linear_predictor(1.0), 64)
    scored = vectors(spark, sf).select("vec_id", scorer(F.col("embedding")).alias("s"))
    return scored.select(
        "vec_id",
        r6(F.col("s.score")).alias("score"),
        F.col("s.features")[0].cast("double").alias("f0"),
        F.col("s.features")[1].cast("double").alias("f1"),
    )


@query(
    "score_all_folds",
    f"""
    SELECT vec_id, fold::INTEGER AS fold,
           round(1 / (1 + exp(-(fold + 1) * sum(embedding[pos + 1]::DOUBLE * {_WEIGHT_SQL}))), 6) AS p
    FROM embeddings, range(4) folds(fold), range(64) t(pos) GROUP BY vec_id, fold
    """,
)
def score_all_folds(spark, sf):
    models = [linear_predictor(float(k + 1)) for k in range(4)]
    scored = scoring.score_with_models(vectors(spark, sf), models, 64, "vec_id", "embedding")
    return scored.select("vec_id", "fold", r6(F.col("p")).alias("p"))


# Every vector by the model of its fold, here its label modulo four.
@query(
    "score_own_fold",
    f"""
    SELECT vec_id, label % 4 AS val_index,
           round(1 / (1 + exp(-(label % 4 + 1) * sum(embedding[pos + 1]::DOUBLE * {_WEIGHT_SQL}))), 6) AS p
    FROM embeddings, range(64) t(pos) GROUP BY vec_id, label
    """,
)
def score_own_fold(spark, sf):
    models = [linear_predictor(float(k + 1)) for k in range(4)]
    rows = vectors(spark, sf).withColumn("val_index", F.col("label") % 4)
    scored = scoring.score_own_fold(rows, models, 64, "vec_id", "embedding")
    return scored.select("vec_id", "val_index", r6(F.col("p")).alias("p"))


_TTA_SQL = with_tables(
    f"""
    SELECT vec_id, round(avg(p), 6) AS p
    FROM (SELECT vec_id, tta_index, 1 / (1 + exp(-sum(value * {_WEIGHT_SQL}))) AS p
          FROM flipped GROUP BY vec_id, tta_index)
    GROUP BY vec_id
    """,
    flipped=_FLIPPED_SQL,
)


@query("tta_score", _TTA_SQL)
def tta_score(spark, sf):
    """Views made, scored and averaged within the row."""
    means = scoring.score_views_in_row(vectors(spark, sf), N_PASSES, flipped, linear_predictor(1.0), "vec_id", "embedding")
    return means.select("vec_id", r6(F.col("p")).alias("p"))


@query("tta_score_rows", _TTA_SQL)
def tta_score_rows(spark, sf):
    """A row per view, averaged by id."""
    scorer = scoring.batch_scorer(linear_predictor(1.0), 64)
    scored = scoring.score_views(vectors(spark, sf), N_PASSES, flipped, scorer, "vec_id", "embedding")
    means = scoring.mean_score(scored, "vec_id")
    return means.select("vec_id", r6(F.col("p")).alias("p"))


@query(
    "feature_concat",
    with_tables(
        f"""
        SELECT image_name, pos::INTEGER AS pos,
               round(CASE WHEN pos < 64 THEN embedding[pos + 1]
                          ELSE [sex, age, site][pos - 63] END::DOUBLE, 6) + 0.0 AS value
        FROM (SELECT s.image_name, embedding,
                     CASE sex WHEN 'male' THEN 1.0 WHEN 'female' THEN 0.0 ELSE 0.5 END::DOUBLE AS sex,
                     coalesce(age_approx / 100, 0)::DOUBLE AS age,
                     CASE anatom_site_general_challenge WHEN 'head/neck' THEN 1 WHEN 'upper extremity' THEN 2
                          WHEN 'lower extremity' THEN 3 WHEN 'torso' THEN 4 WHEN 'palms/soles' THEN 5
                          WHEN 'oral/genital' THEN 6 ELSE 0 END::DOUBLE AS site
              FROM samples s
              JOIN embeddings e ON 'IMG_' || lpad(CAST(e.vec_id AS VARCHAR), 12, '0') = s.image_name) joined,
             range(67) t(pos)
        """,
        samples=SAMPLES,
    ),
)
def feature_concat(spark, sf):
    meta = encode_features(fixture(spark, sf, SAMPLES)).select(ID, feature_array(SHORT_FEATURES).alias("meta"))
    # Vectors without a sample are left out in so many words; the join itself loses none.
    images = vectors(spark, sf).select(image_id(), F.col("embedding")).join(meta.select(ID), ID, "left_semi")
    joined = join_features(images, meta, (ID,), "embedding", "meta", "features")
    cells = joined.select(ID, F.posexplode("features").alias("pos", "value"))
    return cells.withColumn("value", r6(F.col("value")))


def image_id() -> Column:
    return F.concat(F.lit("IMG_"), F.lpad(F.col("vec_id").cast("string"), 12, "0")).alias(ID)


def images(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding as an 8x8 colour image: red as stored, green reversed, blue turned by eight."""

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), views.OUT_ROWS):
                part = batch[start : start + views.OUT_ROWS]
                values = np.stack(part["embedding"]).astype(np.float64)
                red = np.clip(np.floor((values + 0.5) * 255), 0, 255).astype(np.uint8)
                pixels = np.stack([np.roll(red, -8, axis=1), red[:, ::-1], red], axis=2)
                yield pd.DataFrame(
                    {
                        "dataset": "vectors",
                        ID: part[ID],
                        "height": SIDE,
                        "width": SIDE,
                        "n_channels": 3,
                        "data": [p.tobytes() for p in pixels],
                    }
                )

    schema = f"dataset string, {ID} string, height int, width int, n_channels int, data binary"
    return spread(vectors(spark, sf).select(image_id(), "embedding"), ID).mapInPandas(run, schema)


PIXEL_SQL = """
SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') AS image_name, pos, red[pos + 1] AS r, red[64 - pos] AS g,
       red[(pos + 8) % 64 + 1] AS b
FROM (SELECT vec_id, [least(greatest(floor((x::DOUBLE + 0.5) * 255), 0), 255) FOR x IN embedding] AS red
      FROM embeddings), range(64) t(pos)
"""

_COEFFICIENT_SQL = f"""
SELECT image_name, component, k,
       sum((CASE component WHEN 0 THEN y - 128 WHEN 1 THEN (b - y) / 1.772 ELSE (r - y) / 1.402 END)
           * cos((2 * (pos // 8) + 1) * u * pi() / 16) * cos((2 * (pos % 8) + 1) * v * pi() / 16)
           * (CASE WHEN u = 0 THEN sqrt(0.125) ELSE 0.5 END) * (CASE WHEN v = 0 THEN sqrt(0.125) ELSE 0.5 END)) AS c
FROM (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS y FROM pixels) p,
     (SELECT k, {ZIGZAG_SQL}[k + 1] // 8 AS u, {ZIGZAG_SQL}[k + 1] % 8 AS v FROM range(8) t(k)) z,
     range(3) parts(component)
GROUP BY image_name, component, k
"""


@query(
    "image_dct",
    with_tables(
        "SELECT image_name, (component * 8 + k)::INTEGER AS pos, round(c, 4) + 0.0 AS value FROM coefficients",
        pixels=PIXEL_SQL,
        coefficients=_COEFFICIENT_SQL,
    ),
)
def image_dct(spark, sf):
    """Transform in the worker, zig-zag selection as column expressions."""
    grid = [F.col(c) for c in ("luma_rows", "chroma_rows", "chroma_columns")]
    flat = arrays.zigzag_image(F.col("y"), F.col("cb"), F.col("cr"), 8, *grid)
    rows = views.image_coefficients(images(spark, sf)).select(ID, F.posexplode(flat).alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 4) + F.lit(0.0))


@query(
    "image_features",
    with_tables(
        "SELECT image_name, (component * 8 + k)::INTEGER AS pos, round(c, 4) + 0.0 AS value FROM coefficients",
        pixels=PIXEL_SQL,
        coefficients=_COEFFICIENT_SQL,
    ),
)
def image_features(spark, sf):
    """The same features with the selection inside the worker."""
    features = views.coefficient_features(images(spark, sf))
    rows = features.select(ID, F.posexplode("features").alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 4) + F.lit(0.0))
