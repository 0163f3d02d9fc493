import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldmark.functions import arrays
from foldmark.plans import image_scoring, scoring, views
from foldmark.schemas import ID
from foldmark.sources.images import read_images
from tests.images import png

SIZE = 24


@pytest.fixture(scope="module")
def pictures(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(0)
    stored = {}
    for i in range(5):
        stored[f"img{i}"] = rng.integers(0, 256, (20 + 4 * i, 32, 3), dtype=np.uint8)
        (root / f"img{i}.png").write_bytes(png(stored[f"img{i}"]))
    return stored, read_images(spark, {"d": str(root)}, "*.png")


def overlays():
    stroke = np.zeros((3, 7, 3), dtype=np.uint8)
    stroke[1] = 220
    return [stroke]


def _collect(df):
    return {(r[ID], r.tta_index): np.array(r.pixels).reshape(r.height, r.width, 3) for r in df.collect()}


def test_views_repeat_under_repartitioning(spark, pictures):
    stages = views.training_stages(SIZE, overlays())
    one = _collect(views.image_views(pictures[1], stages, 3))
    two = _collect(views.image_views(pictures[1].repartition(3), stages, 3))
    assert set(one) == {(f"img{i}", k) for i in range(5) for k in range(3)}
    for key in one:
        assert one[key].shape == (SIZE, SIZE, 3)
        np.testing.assert_array_equal(one[key], two[key])
    assert not np.array_equal(one["img0", 0], one["img0", 1])
    other = _collect(views.image_views(pictures[1], stages, 1, seed=1))
    assert not np.array_equal(one["img0", 0], other["img0", 0])


def test_plain_view_is_the_normalised_image(spark, pictures):
    stored, df = pictures
    got = _collect(views.image_views(df.where(f"{ID} = 'img1'"), [views.Normalize()], 1))
    expected = (stored["img1"] / 255 - views.CHANNEL_MEAN) / views.CHANNEL_STD
    np.testing.assert_allclose(got["img1", 0], expected, atol=1e-5)


def test_scoring_in_place_equals_scoring_the_views(spark, pictures):
    def make():
        def predict(batch, meta):
            assert meta.shape == (len(batch), 2)
            return batch.mean(axis=(1, 2, 3)) + meta[:, 0], batch[:, 0, 0]

        return predict

    df = pictures[1].withColumn("meta", F.array(F.length(ID).cast("float"), F.lit(0.0).cast("float")))
    stages = views.scoring_stages(SIZE)
    scored = image_scoring.score_image_views(df, stages, make, 4, meta="meta", batch_size=2)
    pixels = _collect(views.image_views(df, stages, 4))
    rows = scored.collect()
    assert len(rows) == 20
    for r in rows:
        view = pixels[r[ID], r.tta_index]
        assert r.p == pytest.approx(view.mean() + 4, abs=1e-4)
        np.testing.assert_allclose(r.features, view[0, 0], atol=1e-5)
    means = {r[ID]: r.p for r in scoring.mean_score(scored).collect()}
    assert means["img2"] == pytest.approx(np.mean([r.p for r in rows if r[ID] == "img2"]))


def rng(seed=4):
    return views.Draws("img", 0, seed)


def test_crop_stays_inside_and_keeps_flat_images():
    flat = np.full((30, 40, 3), 77, dtype=np.uint8)
    assert (views.RandomResizedCrop(16)(flat, rng()) == 77).all()
    ramp = np.repeat(np.arange(40, dtype=np.uint8)[None, :, None], 30, axis=0).repeat(3, axis=2)
    out = views.RandomResizedCrop(16)(ramp, rng())
    assert out.shape == (16, 16, 3) and (np.diff(out[:, :, 0].astype(int), axis=1) >= 0).all()
    np.testing.assert_array_equal(views.resize(ramp, 30, 40), ramp)


def test_flips():
    image = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    np.testing.assert_array_equal(views.FlipHorizontal(1.0)(image, rng()), image[:, ::-1])
    np.testing.assert_array_equal(views.FlipVertical(1.0)(image, rng()), image[::-1])
    np.testing.assert_array_equal(views.FlipVertical(0.0)(image, rng()), image)


def test_circular_mask_keeps_the_circle():
    image = np.full((64, 64, 3), 9, dtype=np.uint8)
    out = views.CircularMask(1.0)(image, rng(1))
    assert out[32, 32, 0] == 9 and set(np.unique(out)) <= {0, 9}
    kept = int(out[32, :, 0].astype(bool).sum())
    assert 2 * 29 <= kept <= 64
    assert (views.CircularMask(0.0)(image, rng()) == 9).all()


def test_overlay_and_lines_touch_only_their_pixels():
    image = np.full((40, 40, 3), 60, dtype=np.uint8)
    out = views.Overlay(overlays(), most=1)(image, rng(0))
    for seed in range(20):
        out = views.Overlay(overlays(), most=1)(image, rng(seed))
        changed = (out != image).all(axis=2).sum()
        assert changed in (0, 7) and set(np.unique(out)) <= {60, 220}
    np.testing.assert_array_equal(views.Overlay([])(image, rng()), image)
    with pytest.raises(ValueError):
        for seed in range(20):
            views.Overlay([np.full((50, 50, 3), 255, dtype=np.uint8)])(image, rng(seed))
    drawn = [views.Lines()(image, rng(seed)) for seed in range(10)]
    assert any((d == 0).any() for d in drawn) and all(set(np.unique(d)) <= {0, 60} for d in drawn)


def library(spark, n=4):
    stroke = overlays()[0]
    return spark.createDataFrame(
        [(f"o{i}", 3, 7, 3, bytearray((stroke // (i + 1)).tobytes())) for i in range(n)],
        f"{ID} string, height int, width int, n_channels int, data binary",
    )


def test_draws_are_the_same_as_a_column(spark):
    rows = [(f"d/img{i}", t) for i in range(5) for t in range(3)]
    df = spark.createDataFrame(rows, "name string, tta_index int")
    for stage, number in ((0, 0), (3, 21)):
        got = df.select("*", arrays.keyed_uniform("name", "tta_index", 47, stage, number).alias("u")).collect()
        assert all(r.u == views.Draws(r.name, r.tta_index, 47, stage).uniform(number) for r in got)
    many = np.array([views.Draws(f"d/img{i}", 0, 47).uniform(0) for i in range(4000)])
    assert 0 <= many.min() and many.max() < 1 and abs(many.mean() - 0.5) < 0.02
    whole = [views.Draws(f"d/img{i}", 0, 47).whole(0, 2, 5) for i in range(4000)]
    assert set(whole) == {2, 3, 4, 5} and min(np.bincount(whole)[2:]) > 850


def test_overlays_by_join_equal_overlays_in_every_worker(spark, pictures):
    stored, df = pictures
    chain = [views.FlipHorizontal(), views.Overlays(2), views.CircularMask(0.3)]
    near, with_pieces = views.place_overlays(df, library(spark), chain, 3)
    far, joined = views.place_overlays(df.repartition(3), library(spark), chain, 3, limit_bytes=10)
    assert "overlays" in far.columns and "overlays" not in near.columns
    one, two = (_collect(views.image_views(i, s, 3)) for i, s in ((near, with_pieces), (far, joined)))
    assert len(one) == 15 and set(one) == set(two)
    for key in one:
        np.testing.assert_array_equal(one[key], two[key])
    only = _collect(views.image_views(df, [views.Overlay(views.collect_overlays(library(spark)), 2)], 3))
    touched = sum(not np.array_equal(v, stored[k[0]]) for k, v in only.items())
    assert 0 < touched < 15
    unnamed, stages = views.place_overlays(df.withColumn("dataset", F.lit(None).cast("string")), library(spark), chain, 3, limit_bytes=10)
    assert unnamed.where("overlays is not null").count() > 0 and len(_collect(views.image_views(unnamed, stages, 3))) == 15
    with pytest.raises(ValueError, match="no overlay"):
        views.place_overlays(df, library(spark).limit(0), chain, 3)
    with pytest.raises(ValueError, match="one Overlays stage"):
        views.place_overlays(df, library(spark), [views.Normalize()], 3)
    with pytest.raises(Exception, match="place_overlays"):
        views.image_views(df, chain, 1).collect()


def test_one_overlay_spreads_over_all_tasks(spark):
    names = spark.range(2000).select(F.lit("d").alias("dataset"), F.concat(F.lit("img"), "id").alias(ID))
    images = names.selectExpr("*", "1 height", "1 width", "1 n_channels", "unhex('00') data")
    far, _ = views.place_overlays(images, library(spark, 1), [views.Overlays(5)], 5, limit_bytes=1)
    pieces = far.selectExpr("dataset", ID, "explode(overlays) o").count()
    assert 20000 < pieces < 30000
    salts = 4 * spark.sparkContext.defaultParallelism
    salt = F.pmod(F.xxhash64(F.concat(F.lit("d/img"), "id"), F.col("t"), F.col("s")), F.lit(salts))
    slots = spark.range(2000).select("id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("t")).select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("s"))
    sizes = [r["count"] for r in slots.groupBy(salt.alias("salt")).count().collect()]
    assert len(sizes) == salts and max(sizes) < 2 * sum(sizes) / salts


def test_batches_stay_batches(spark, pictures):
    """A batch of images leaves the worker as one batch of features, and a batch of views is bounded by its bytes."""
    stored, df = pictures
    one = views.coefficient_features(df.coalesce(1), 8).withColumn("part", F.spark_partition_id())
    assert one.count() == 5 and one.select("part").distinct().count() == 1
    planes = [views.to_ycbcr(im)[0] for im in stored.values()]
    together = views.plane_coefficients(planes)
    for plane, found in zip(planes, together):
        np.testing.assert_allclose(found, views.block_coefficients(plane), atol=1e-9)
    kept = arrays.zigzag_order()[:8]
    np.testing.assert_allclose(views.plane_coefficients(planes, kept)[1], together[1][:, :, kept], atol=1e-9)


def _mean():
    return lambda batch, meta: (batch.mean(axis=(1, 2, 3)), None)


def brute_dct(block):
    x = np.arange(8)
    out = np.zeros((8, 8))
    for u in range(8):
        for v in range(8):
            a = np.sqrt(1 / 8) if u == 0 else 0.5
            b = np.sqrt(1 / 8) if v == 0 else 0.5
            out[u, v] = a * b * np.sum(
                block * np.outer(np.cos((2 * x + 1) * u * np.pi / 16), np.cos((2 * x + 1) * v * np.pi / 16))
            )
    return out.reshape(-1)


def test_block_coefficients():
    plane = np.random.default_rng(2).normal(size=(13, 17))
    got = views.block_coefficients(plane)
    assert got.shape == (2, 3, 64)
    np.testing.assert_allclose(got[0, 1], brute_dct(plane[:8, 8:16]), atol=1e-9)
    padded = np.pad(plane, ((0, 3), (0, 7)), mode="edge")
    np.testing.assert_allclose(got[1, 2], brute_dct(padded[8:, 16:]), atol=1e-9)


@pytest.mark.parametrize("half_chroma", [False, True])
def test_features_by_columns_equal_features_in_the_worker(spark, pictures, half_chroma):
    grid = [F.col(c) for c in ("luma_rows", "chroma_rows", "chroma_columns")]
    flat = arrays.zigzag_image(F.col("y"), F.col("cb"), F.col("cr"), 8, *grid)
    one = views.image_coefficients(pictures[1], half_chroma).select(ID, flat.alias("f"))
    two = views.coefficient_features(pictures[1], 8, half_chroma)
    left = {r[ID]: r.f for r in one.collect()}
    for r in two.collect():
        np.testing.assert_allclose(r.features, left[r[ID]], atol=1e-9)
        rows, columns = -(-(20 + 4 * int(r[ID][3:])) // 8), 4
        assert len(r.features) >= rows * columns * 8


def test_zigzag_order_walks_the_diagonals():
    order = arrays.zigzag_order()
    assert sorted(order) == list(range(64))
    # The first steps of the walk.
    assert order[:10] == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24]
    cells = [divmod(i, 8) for i in order]
    assert all(max(abs(a[0] - b[0]), abs(a[1] - b[1])) == 1 for a, b in zip(cells, cells[1:]))


def test_array_flip_with_channels(spark):
    image = np.arange(2 * 3 * 3).reshape(2, 3, 3)
    df = spark.createDataFrame([(image.reshape(-1).tolist(),)], "x array<long>")
    got = df.select(
        arrays.flip(F.col("x"), 2, 3, 3, horizontal=True).alias("h"),
        arrays.flip(F.col("x"), 2, 3, 3, vertical=F.lit(True)).alias("v"),
        arrays.normalize_channels(F.col("x"), (0.1, 0.2, 0.3), (1.0, 2.0, 4.0)).alias("n"),
    ).head()
    assert got.h == image[:, ::-1].reshape(-1).tolist() and got.v == image[::-1].reshape(-1).tolist()
    np.testing.assert_allclose(got.n, ((image / 255 - [0.1, 0.2, 0.3]) / [1, 2, 4]).reshape(-1))


def test_model_is_loaded_once_per_task_not_per_row(spark):
    def make():
        loads = [1]

        def predict(batch):
            return np.full(len(batch), float(len(loads))), batch[:, :1]

        return predict

    df = spark.range(300).select(F.col("id"), F.array(*[F.col("id").cast("float")] * 4).alias("f"))
    scored = df.select("id", scoring.batch_scorer(make, 4, 64)("f").alias("s")).collect()
    assert {r.s.score for r in scored} == {1.0} and all(r.s.features == [float(r.id)] for r in scored)


def test_passes_stay_in_their_row(spark):
    def make():
        return lambda batch: (batch.sum(axis=1), batch[:, :2])

    df = spark.range(40).select("id", F.array(*[(F.col("id") + i).cast("float") for i in range(3)]).alias("f")).repartition(3)
    scored = scoring.score_views_in_row(df, 4, lambda f, key, i: F.transform(f, lambda x: x * (i + 1)), make, "id", "f")
    text = df.select(scoring.views_in_row(df, 4, lambda f, key, i: f, "id", "f"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Generate" not in text  # the repartition of the input
    for r in scored.collect():
        assert r.p == pytest.approx(np.mean([(3 * r.id + 3) * (i + 1) for i in range(4)]))
        np.testing.assert_allclose(r.features, [[r.id * (i + 1), (r.id + 1) * (i + 1)] for i in range(4)])


def test_scores_for_template_ids(spark):
    template = spark.createDataFrame([("a", 0.0), ("b", 0.0)], f"{ID} string, target double")
    scores = spark.createDataFrame([("b", 0.2), ("a", 0.1), ("c", 0.3)], f"{ID} string, p double")
    assert sorted(map(tuple, scoring.with_template_ids(template, scores).collect())) == [("a", 0.1), ("b", 0.2)]
    with pytest.raises(Exception, match="no prediction for id"):
        scoring.with_template_ids(template, scores.where("p > 0.15")).collect()


def small_images(n):
    """A batch of n 8x8 images, as Spark hands them to a worker."""
    data = np.random.default_rng(3).integers(0, 256, (n, 192), dtype=np.uint8)
    columns = {"dataset": ["d"] * n, ID: [f"img{i}" for i in range(n)], "height": [8] * n, "width": [8] * n, "n_channels": [3] * n}
    return pa.RecordBatch.from_pydict(columns | {"data": [d.tobytes() for d in data]})


def peak_and_rows(batches):
    """Most bytes of Python and numpy while batches are made one by one, and their rows."""
    tracemalloc.start()
    rows = sum(batch.num_rows for batch in batches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak, rows


def test_views_of_small_images_are_held_by_stretches():
    few, many = (peak_and_rows(views.viewed_batches(iter([small_images(n)]), views.identity_stages(8), 2, 47)) for n in (1500, 6000))
    assert (few[1], many[1]) == (3000, 12000)
    assert many[0] < 1.2 * few[0] and many[0] < 8 << 20


def test_coefficients_of_small_images_are_held_by_stretches():
    def made(n):
        for held, parts in views.component_slices(small_images(n), False, None):
            assert len(parts) == 3 * len(held)
            yield pa.RecordBatch.from_pydict({ID: [name for _, name in held]})

    few, many = peak_and_rows(made(2500)), peak_and_rows(made(10_000))
    assert (few[1], many[1]) == (2500, 10_000)
    assert many[0] < 1.2 * few[0] and many[0] < 16 << 20


def test_stretches_make_the_views_of_single_images():
    batch = small_images(1100)
    views_of = lambda parts: pa.Table.from_batches([v for p in parts for v in views.viewed_batches(iter([p]), views.scoring_stages(8), 2, 47)])
    whole, single = views_of([batch]), views_of([batch.slice(i, 1) for i in range(1100)])
    assert whole.num_rows == 2200 and whole.to_pylist() == single.to_pylist()
