"""Queries over images under random views: every embedding is an 8x8 colour image, its views drawn again in SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.catalog.arrays import N_PASSES, PIXEL_SQL, SEED, SIDE, images, vectors
from foldmark.catalog.fixtures import SAMPLES, fixture, load, with_tables
from foldmark.catalog.registry import query, r6
from foldmark.functions.arrays import DRAW_DIGITS
from foldmark.operators.passes import fold_columns_to_rows
from foldmark.plans import experiment, image_scoring, views
from foldmark.plans.views import CHANNEL_MEAN, CHANNEL_STD, LUMA, OVERLAY_NUMBERS, RADIUS_LESS, RADIUS_MORE, TRANSPARENT, TRIES
from foldmark.schemas import ID
from foldmark.session import new_folder
from foldmark.sinks.files import write_files, write_images
from foldmark.sinks.tables import write_features
from foldmark.sources.images import image_path, join_samples, list_images, missing_images, read_features, read_images
from foldmark.sources.tables import read_fold_predictions, read_submission

MOST = 5


def _draw(stage: int, number: str | int) -> str:
    """A view's random number, beside ``view_name`` and ``tta_index``."""
    text = f"view_name || ':' || tta_index || ':{SEED}:{stage}:' || ({number})"
    return f"(('0x' || substr(md5({text}), 1, {DRAW_DIGITS}))::BIGINT / {16**DRAW_DIGITS}::DOUBLE)"


def _between(low: str, high: str, draw: str) -> str:
    return f"({low}::DOUBLE + ({high}::DOUBLE - {low}::DOUBLE) * {draw})"


def _whole(low: str, high: str, draw: str) -> str:
    return f"({low} + floor({draw} * ({high} - {low} + 1))::INTEGER)"


_HALF = SIDE // 2
_PLACE = "least(greatest((f{0}::DOUBLE + 0.5::DOUBLE) * {1} / 8::DOUBLE - 0.5::DOUBLE, 0::DOUBLE), ({1} - 1)::DOUBLE) AS p{0}"


def _band(band: str) -> str:
    def at(y: str, x: str) -> str:
        return f"{band}[(box_top + {y}) * {SIDE} + box_left + {x} + 1]::DOUBLE"

    left, right = (f"({at('r0', c)} * (1 - wr) + {at('r1', c)} * wr)" for c in ("c0", "c1"))
    return f"round_even({left} * (1 - wc) + {right} * wc, 0) AS {band[0]}"


# Crop (stage 0), mirrored left to right (1) and top to bottom (2): the colours of each of the view's pixels.
_CROPPED = f"""
WITH bands AS (
  SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') AS image_name, label,
         [least(greatest(floor((x::DOUBLE + 0.5) * 255), 0), 255) FOR x IN embedding] AS rr
  FROM embeddings),
passes AS (
  SELECT image_name, 'vectors/' || image_name AS view_name, tta_index, rr, list_reverse(rr) AS gg,
         list_concat(rr[{SIDE + 1}:], rr[:{SIDE}]) AS bb
  FROM bands, range({N_PASSES}) p(tta_index)),
tried AS (
  SELECT *, list_transform(range({TRIES}), lambda a: {{
      'area': {SIDE * SIDE} * {_between("0.8", "1.0", _draw(0, "2 * a"))},
      'aspect': exp({_between("ln(0.75::DOUBLE)", "ln((4 / 3)::DOUBLE)", _draw(0, "2 * a + 1"))})}}) AS tries
  FROM passes),
sized AS (
  SELECT * EXCLUDE (tries), list_filter(
    list_transform(tries, lambda t: {{'h': round_even(sqrt(t.area / t.aspect), 0)::INTEGER, 'w': round_even(sqrt(t.area * t.aspect), 0)::INTEGER}}),
    lambda t: t.h BETWEEN 1 AND {SIDE} AND t.w BETWEEN 1 AND {SIDE})[1] AS found
  FROM tried),
boxed AS (SELECT *, coalesce(found.h, {SIDE}) AS h, coalesce(found.w, {SIDE}) AS w FROM sized),
turned AS (
  SELECT image_name, view_name, tta_index, rr, gg, bb, h, w,
         {_whole("0", f"{SIDE} - h", _draw(0, 2 * TRIES))} AS box_top, {_whole("0", f"{SIDE} - w", _draw(0, 2 * TRIES + 1))} AS box_left,
         {_draw(1, 0)} < 0.5 AS mirrored, {_draw(2, 0)} < 0.5 AS upside
  FROM boxed),
sources AS (
  SELECT *, CASE WHEN upside THEN {SIDE - 1} - pos // {SIDE} ELSE pos // {SIDE} END AS fr,
         CASE WHEN mirrored THEN {SIDE - 1} - pos % {SIDE} ELSE pos % {SIDE} END AS fc
  FROM turned, range({SIDE * SIDE}) cells(pos)),
places AS (SELECT *, {_PLACE.format("r", "h")}, {_PLACE.format("c", "w")} FROM sources),
corners AS (
  SELECT *, floor(pr)::INTEGER AS r0, least(floor(pr)::INTEGER + 1, h - 1) AS r1, pr - floor(pr) AS wr,
         floor(pc)::INTEGER AS c0, least(floor(pc)::INTEGER + 1, w - 1) AS c1, pc - floor(pc) AS wc
  FROM places)
SELECT image_name, view_name, tta_index, pos, {_band("rr")}, {_band("gg")}, {_band("bb")} FROM corners
"""


def _painted(library: str, stage: int) -> str:
    """The colours that overlays give to pixels; ``library`` has (number, height, width, row, col, r, g, b) from 0 on."""
    n = OVERLAY_NUMBERS
    return f"""
WITH library AS ({library}),
mirrored AS (
  SELECT number, m, height, width, CASE WHEN m IN (0, 2) THEN height - 1 - row ELSE row END AS row,
         CASE WHEN m IN (1, 2) THEN width - 1 - col ELSE col END AS col, r, g, b
  FROM library, range(3) f(m)
  WHERE {LUMA[0]}::DOUBLE * r + {LUMA[1]}::DOUBLE * g + {LUMA[2]}::DOUBLE * b > {TRANSPARENT}),
pieces AS (
  SELECT number, m, t, CASE WHEN t = 2 THEN height ELSE width END AS height, CASE WHEN t = 2 THEN width ELSE height END AS width,
         CASE t WHEN 1 THEN width - 1 - col WHEN 2 THEN height - 1 - row ELSE col END AS row,
         CASE t WHEN 1 THEN row WHEN 2 THEN width - 1 - col ELSE height - 1 - row END AS col, r, g, b
  FROM mirrored, range(1, 4) q(t)),
shown AS (SELECT DISTINCT image_name, view_name, tta_index FROM cropped),
amounts AS (SELECT *, {_whole("0", str(MOST), _draw(stage, 0))} AS amount FROM shown),
slots AS (SELECT *, unnest(range(amount)) AS slot FROM amounts),
chosen AS (
  SELECT *, {_whole("0", "(SELECT max(number) FROM library)", _draw(stage, f"{n} * slot + 1"))} AS number,
         {_whole("0", "2", _draw(stage, f"{n} * slot + 2"))} AS m, {_whole("1", "3", _draw(stage, f"{n} * slot + 3"))} AS t
  FROM slots),
laid AS (
  SELECT image_name, tta_index, slot, r, g, b,
         ({_whole("0", f"{SIDE} - height", _draw(stage, f"{n} * slot + 4"))} + row) * {SIDE}
         + {_whole("0", f"{SIDE} - width", _draw(stage, f"{n} * slot + 5"))} + col AS pos
  FROM chosen JOIN pieces USING (number, m, t))
SELECT image_name, tta_index, pos, arg_max(r, slot) AS r, arg_max(g, slot) AS g, arg_max(b, slot) AS b
FROM laid GROUP BY image_name, tta_index, pos
"""


def _finished(source: str, stage: int, p: float) -> str:
    """The last two stages, mask and channel scale, over (view_name, tta_index, pos, r, g, b)."""
    down, right = f"(pos // {SIDE} - {_HALF})", f"(pos % {SIDE} - {_HALF})"
    bands = ", ".join(
        f"(({band} * inside / 255::DOUBLE - {CHANNEL_MEAN[i]}::DOUBLE) / {CHANNEL_STD[i]}::DOUBLE)::FLOAT::DOUBLE AS {band}" for i, band in enumerate("rgb")
    )
    radius = _whole(f"({_HALF - RADIUS_LESS})", f"({_HALF + RADIUS_MORE})", _draw(stage, 1))
    return f"""
SELECT image_name, tta_index, pos, {bands} FROM (
  SELECT *, CASE WHEN {_draw(stage, 0)} < {p} AND {down} * {down} + {right} * {right} > radius * radius THEN 0 ELSE 1 END AS inside
  FROM (SELECT *, {radius} AS radius FROM {source}) AS drawn) AS masked
"""


_WITH_OVERLAYS = """
SELECT c.image_name, view_name, c.tta_index, c.pos, coalesce(p.r, c.r) AS r, coalesce(p.g, c.g) AS g, coalesce(p.b, c.b) AS b
FROM cropped c LEFT JOIN painted p ON p.image_name = c.image_name AND p.tta_index = c.tta_index AND p.pos = c.pos
"""

_VIEW_CELLS = """
SELECT image_name, tta_index::INTEGER AS tta_index, (pos * 3 + band)::INTEGER AS pos,
       round(CASE band WHEN 0 THEN r WHEN 1 THEN g ELSE b END, 5) + 0.0 AS value
FROM finished, range(3) bands(band)
"""


def view_cells(seen: DataFrame) -> DataFrame:
    cells = seen.select(ID, "tta_index", F.posexplode("pixels").alias("pos", "value"))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 5) + F.lit(0.0))


def overlay_pieces() -> list[np.ndarray]:
    """Two small overlays: a bright stroke on black, and a grey corner."""
    stroke = np.zeros((3, 5, 3), dtype=np.uint8)
    stroke[1] = 200
    corner = np.zeros((2, 2, 3), dtype=np.uint8)
    corner[0, 0] = 90
    return [stroke, corner]


_PIECES_SQL = """
SELECT 0 AS number, 3 AS height, 5 AS width, cell // 5 AS row, cell % 5 AS col, v AS r, v AS g, v AS b
FROM (SELECT cell, CASE WHEN cell // 5 = 1 THEN 200 ELSE 0 END AS v FROM range(15) c(cell)) AS stroke
UNION ALL SELECT 1, 2, 2, cell // 2, cell % 2, v, v, v
FROM (SELECT cell, CASE WHEN cell = 0 THEN 90 ELSE 0 END AS v FROM range(4) c(cell)) AS corner
"""


@query(
    "image_views",
    with_tables(_VIEW_CELLS, cropped=_CROPPED, painted=_painted(_PIECES_SQL, 3), laid_over=_WITH_OVERLAYS, finished=_finished("laid_over", 4, 0.2)),
)
def image_views(spark, sf):
    return view_cells(views.image_views(images(spark, sf), views.training_stages(SIDE, overlay_pieces()), N_PASSES, SEED))


# Every supplier's overlay is two by three pixels; the library's order is that of the hashed ids.
_LIBRARY_SQL = f"""
SELECT number, 2 AS height, 3 AS width, cell // 3 AS row, cell % 3 AS col, (key * 37 + 3 * cell * 11 + 22) % 256 AS r,
       (key * 37 + 3 * cell * 11 + 11) % 256 AS g, (key * 37 + 3 * cell * 11) % 256 AS b
FROM (SELECT s_suppkey AS key, row_number() OVER (ORDER BY md5('OVERLAY_' || s_suppkey || ':{SEED}'), 'OVERLAY_' || s_suppkey) - 1 AS number
      FROM supplier) AS numbered, range(6) c(cell)
"""


def overlay_library(spark: SparkSession, sf: str) -> DataFrame:
    """One small overlay per supplier, its bytes from the supplier's key."""
    byte = lambda i: F.lpad(F.hex((F.col("s_suppkey") * 37 + i * 11) % 256), 2, "0")
    return load(spark, sf, "supplier").select(
        F.concat(F.lit("OVERLAY_"), F.col("s_suppkey").cast("string")).alias(ID),
        F.lit(2).alias("height"),
        F.lit(3).alias("width"),
        F.lit(3).alias("n_channels"),
        F.unhex(F.concat(*[byte(i) for i in range(18)])).alias("data"),
    )


@query(
    "image_overlays",
    with_tables(_VIEW_CELLS, cropped=_CROPPED, painted=_painted(_LIBRARY_SQL, 3), laid_over=_WITH_OVERLAYS, finished=_finished("laid_over", 4, 0.2)),
)
def image_overlays(spark, sf):
    """A library that is joined to the views, as one too large for every worker is."""
    stages = views.training_stages(SIDE, most=MOST)
    placed, stages = views.place_overlays(images(spark, sf), overlay_library(spark, sf), stages, N_PASSES, SEED, limit_bytes=0)
    return view_cells(views.image_views(placed, stages, N_PASSES, SEED))


def mean_predictor(scale: float):
    """A predictor with one fixed weight: a logistic score of the mean pixel, and the first three values as features."""

    def make():
        def predict(batch, meta):
            flat = batch.reshape(len(batch), -1).astype(np.float64)
            return 1 / (1 + np.exp(-scale * flat.mean(axis=1))), flat[:, :3]

        return predict

    return make


#: The chain for scoring has its mask in the fourth place.
_SCORING = {"cropped": _CROPPED, "finished": _finished("cropped", 3, 0.5)}
_PASS_MEANS = "SELECT image_name, tta_index, avg((r + g + b) / 3) AS m FROM finished GROUP BY image_name, tta_index"


@query(
    "image_tta_score",
    with_tables("SELECT image_name, round(avg(1 / (1 + exp(-m))), 6) AS p FROM pass_means GROUP BY image_name", **_SCORING, pass_means=_PASS_MEANS),
)
def image_tta_score(spark, sf):
    """Views made, scored and averaged in one pass over the pixels."""
    scored = image_scoring.mean_of_folds(images(spark, sf), views.scoring_stages(SIDE), [mean_predictor(1.0)], n_passes=N_PASSES, seed=SEED)
    return scored.select(ID, r6(F.col("p")).alias("p"))


MODELS = 4


def fold_models():
    return [mean_predictor(float(k + 1)) for k in range(MODELS)]


@query(
    "image_score_all_folds",
    with_tables(
        f"""
        SELECT image_name, fold::INTEGER AS fold, round(avg(1 / (1 + exp(-(fold + 1) * m))), 6) AS p
        FROM pass_means, range({MODELS}) f(fold) GROUP BY image_name, fold
        """,
        **_SCORING,
        pass_means=_PASS_MEANS,
    ),
)
def image_score_all_folds(spark, sf):
    """Every image by every fold model: one scan, one decoding, views made once."""
    scored = image_scoring.score_all_folds(images(spark, sf), views.scoring_stages(SIDE), fold_models(), n_passes=N_PASSES, seed=SEED)
    return scored.select(ID, "fold", r6(F.col("p")).alias("p"))


def with_own_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Images with the split that validates on them, here their label modulo the number of models."""
    name = F.concat(F.lit("IMG_"), F.lpad(F.col("vec_id").cast("string"), 12, "0"))
    own = vectors(spark, sf).select(name.alias(ID), (F.col("label") % MODELS).cast("int").alias("val_index"))
    return images(spark, sf).join(own, ID)


_OWN = f"SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') AS image_name, (label % {MODELS})::INTEGER AS val_index FROM embeddings"


@query(
    "image_score_own_fold",
    with_tables(
        """
        SELECT image_name, val_index, round(avg(1 / (1 + exp(-(val_index + 1) * m))), 6) AS p
        FROM pass_means JOIN own USING (image_name) GROUP BY image_name, val_index
        """,
        **_SCORING,
        pass_means=_PASS_MEANS,
        own=_OWN,
    ),
)
def image_score_own_fold(spark, sf):
    """Every image by the one model that did not see it."""
    scored = image_scoring.score_own_fold(with_own_fold(spark, sf), views.scoring_stages(SIDE), fold_models(), n_passes=N_PASSES, seed=SEED)
    return scored.select(ID, "val_index", r6(F.col("p")).alias("p"))


@query(
    "feature_export",
    with_tables(
        """
        SELECT 'mean' AS model, val_index AS fold, image_name, tta_index::INTEGER AS tta_index, band::INTEGER AS pos,
               round(CASE band WHEN 0 THEN r WHEN 1 THEN g ELSE b END, 5) + 0.0 AS value
        FROM finished JOIN own USING (image_name), range(3) bands(band) WHERE pos = 0
        """,
        **_SCORING,
        own=_OWN,
    ),
)
def feature_export(spark, sf):
    """The features of all passes of an out-of-fold run: written by model and fold, and read again."""
    scored = image_scoring.score_own_fold(with_own_fold(spark, sf), views.scoring_stages(SIDE), fold_models(), n_passes=N_PASSES, seed=SEED)
    rows = scored.select(F.lit("mean").alias("model"), F.col("val_index").alias("fold"), "dataset", ID, F.col("stack").alias("features"))
    path = new_folder(spark)
    write_features(rows, path, ("model", "fold"))
    passes = read_features(spark, path).select("model", "fold", ID, F.posexplode("features").alias("tta_index", "row"))
    cells = passes.select("model", "fold", ID, "tta_index", F.posexplode("row").alias("pos", "value"))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 5) + F.lit(0.0))


N_SPLITS = 3
_LABELLED = f"""
SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') AS image_name, label % 2 AS target, vec_id % 8 AS fold, (vec_id % 8) * {N_SPLITS} // 8 AS split,
       list_sum([least(greatest(floor((x::DOUBLE + 0.5) * 255), 0), 255) FOR x IN embedding]) / 64 AS brightness
FROM embeddings
"""


def labelled_brightness(spark: SparkSession, sf: str) -> DataFrame:
    """(id, target, fold, brightness) of every image."""
    red = F.transform("embedding", lambda x: F.greatest(F.least(F.floor((x.cast("double") + 0.5) * 255), F.lit(255)), F.lit(0)))
    total = F.aggregate(red, F.lit(0).cast("long"), lambda a, x: a + x)
    name = F.concat(F.lit("IMG_"), F.lpad(F.col("vec_id").cast("string"), 12, "0")).alias(ID)
    return vectors(spark, sf).select(
        name, (F.col("label") % 2).alias("target"), (F.col("vec_id") % 8).cast("int").alias("fold"), (total / 64).alias("brightness")
    )


def fit_brightness(train: DataFrame, validation: DataFrame, split: int):
    """A user's training job: the middle between both classes' mean brightness."""
    by_class = train.groupBy("target").agg(F.avg("brightness").alias("m")).agg(F.avg("m"), F.max_by("m", "target") - F.min_by("m", "target"))
    middle, step = by_class.head()
    sign = 1.0 if step >= 0 else -1.0

    def make():
        def predict(batch, meta):
            seen = batch.reshape(len(batch), -1).astype(np.float64).mean(axis=1)
            return 1 / (1 + np.exp(-sign * (seen - middle) / 16)), None

        return predict

    return make


@query(
    "cv_passes_mean",
    with_tables(
        f"""
        SELECT image_name, round(avg(1 / (1 + exp(-sign * (m - middle) / 16))), 6) AS target
        FROM (SELECT image_name, tta_index, avg((r + g + b) / 3) AS m FROM cropped GROUP BY image_name, tta_index) AS seen,
             (SELECT split, avg(m) AS middle, CASE WHEN arg_max(m, target) >= arg_min(m, target) THEN 1 ELSE -1 END AS sign
              FROM (SELECT s.split, target, avg(brightness) AS m FROM labelled l, range({N_SPLITS}) s(split) WHERE l.split <> s.split GROUP BY ALL) AS means
              GROUP BY split) AS models
        GROUP BY image_name
        """,
        cropped=_CROPPED,
        labelled=_LABELLED,
    ),
)
def cv_passes_mean(spark, sf):
    """Cross-validation of a user's predictor in three splits: the mean over passes and splits."""
    stages = views.scoring_stages(SIDE)[:3]
    scored = image_scoring.cross_validate_images(
        labelled_brightness(spark, sf), images(spark, sf), fit_brightness, stages, N_SPLITS, n_passes=N_PASSES, seed=SEED
    )
    return scored.select(ID, r6(F.col("target")).alias("target"))


# Without randomness the whole path is arithmetic: normalise, mean over pixels and channels, logistic.
@query(
    "image_plain_score",
    with_tables(
        """
        SELECT image_name, round(1 / (1 + exp(-avg(((r / 255 - 0.485) / 0.229 + (g / 255 - 0.456) / 0.224
                                                   + (b / 255 - 0.406) / 0.225) / 3))), 4) AS p
        FROM pixels GROUP BY image_name
        """,
        pixels=PIXEL_SQL,
    ),
)
def image_plain_score(spark, sf):
    scored = image_scoring.score_image_views(images(spark, sf), views.identity_stages(SIDE), mean_predictor(1.0), 1)
    return scored.select(ID, F.round("p", 4).alias("p"))


def by_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Images in two data sets, by their label."""
    name = F.concat(F.lit("IMG_"), F.lpad(F.col("vec_id").cast("string"), 12, "0"))
    sets = vectors(spark, sf).select(name.alias(ID), F.when(F.col("label") % 2 == 0, "even").otherwise("odd").alias("dataset"))
    return images(spark, sf).drop("dataset").join(sets, ID)


_PARITY = "SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') AS image_name, CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset FROM embeddings"


@query(
    "image_files",
    with_tables(
        f"""
        SELECT image_name, dataset, {SIDE} AS height, {SIDE} AS width, sum(r * (pos + 1))::BIGINT AS red, sum(g * (pos + 1))::BIGINT AS green,
               sum(b * (pos + 1))::BIGINT AS blue
        FROM pixels JOIN sets USING (image_name) GROUP BY ALL
        """,
        pixels=PIXEL_SQL,
        sets=_PARITY,
    ),
)
def image_files(spark, sf):
    """Images written as files under the root of their data set, read back and joined to their samples."""
    folder = new_folder(spark)
    roots = {s: f"{folder}/{s}" for s in ("even", "odd")}
    written = by_parity(spark, sf)
    write_images(written, roots)
    joined = join_samples(written.select("dataset", ID), read_images(spark, roots, "*.png"))

    def weighted(channel: int):
        """Pixels are BGR bytes, row by row; the sum of each one's value by its place tells their order too."""
        values = F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), lambda i: F.conv(F.hex(F.substring("data", i * 3 + channel + 1, F.lit(1))), 16, 10).cast("long") * (i + 1))
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    return joined.select(ID, "dataset", "height", "width", weighted(2).alias("red"), weighted(1).alias("green"), weighted(0).alias("blue"))


@query("image_roots", with_tables("SELECT image_name, dataset, dataset || '/' || image_name || '.png' AS path FROM sets", sets=_PARITY))
def image_roots(spark, sf):
    """Where each sample's image should be, beside where it was found."""
    folder = new_folder(spark)
    roots = {"even": f"{folder}/even", "odd": f"{folder}/odd/"}
    samples = by_parity(spark, sf)
    write_images(samples, roots)
    named = samples.select("dataset", ID, image_path(roots, F.col(ID), F.col("dataset"), ".png").alias("named"))
    listed = list_images(spark, roots, "*.png")
    return named.join(listed, ["dataset", ID]).select(ID, "dataset", F.regexp_extract("named", r"([^/]+/[^/]+)$", 1).alias("path"))


@query(
    "missing_image_report",
    with_tables(
        """
        SELECT image_name FROM samples
        WHERE image_name NOT IN (SELECT 'IMG_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') FROM embeddings)
        """,
        samples=SAMPLES,
    ),
)
def missing_image_report(spark, sf):
    """Samples without an image file, by names alone."""
    root = new_folder(spark)
    write_images(images(spark, sf), root)
    return missing_images(fixture(spark, sf, SAMPLES).select(ID), spark, root, "*.png")


def load_weight(model_type: str, content: bytes):
    """A predictor from a model file that holds one number."""
    return mean_predictor(float(content))()


def saved_experiment(spark: SparkSession) -> str:
    """Four model files and their index in a folder."""
    root = new_folder(spark)
    path = F.concat(F.lit(f"{root}/fold_"), "id", F.lit(f"_{MODELS}_epoch="), "id", F.lit(".txt"))
    write_files(spark.range(MODELS).select(path.alias("path"), (F.col("id") + 1).cast("string").cast("binary").alias("content")))
    experiment.index_model_files(spark, root, "mean", SIDE)
    return root


@query(
    "cv_test_files",
    with_tables(
        f"""
        SELECT image_name, fold::INTEGER AS fold, round(avg(1 / (1 + exp(-(fold + 1) * m))), 6) AS p
        FROM pass_means, range({MODELS}) f(fold) GROUP BY image_name, fold
        """,
        **_SCORING,
        pass_means=_PASS_MEANS,
    ),
)
def cv_test_files(spark, sf):
    """From an index of model files and images to the wide file of all folds' scores."""
    root, rows = saved_experiment(spark), images(spark, sf)
    template = rows.select(ID, F.lit(0.0).alias("target"))
    path = experiment.score_test_images(
        spark, root, rows, template, f"{root}/out", load_weight, views.scoring_stages(SIDE), n_passes=N_PASSES, seed=SEED
    )
    long = fold_columns_to_rows(read_fold_predictions(spark, path, MODELS), [f"fold-{i}" for i in range(MODELS)])
    return long.select(ID, "fold", r6(F.col("p")).alias("p"))


@query(
    "cv_val_files",
    with_tables(
        """
        SELECT image_name, round(avg(1 / (1 + exp(-(fold // 2 + 1) * m))), 6) AS target
        FROM pass_means JOIN labelled USING (image_name) GROUP BY image_name
        """,
        **_SCORING,
        pass_means=_PASS_MEANS,
        labelled=_LABELLED,
    ),
)
def cv_val_files(spark, sf):
    """From an index of model files, samples with folds and images to the file of out-of-fold scores."""
    root, rows = saved_experiment(spark), images(spark, sf)
    samples = labelled_brightness(spark, sf).select(F.lit("vectors").alias("dataset"), ID, "fold")
    path = experiment.score_validation_images(
        spark, root, samples, rows, f"{root}/out", load_weight, views.scoring_stages(SIDE), n_passes=N_PASSES, seed=SEED
    )
    return read_submission(spark, path).select(ID, r6(F.col("target")).alias("target"))
