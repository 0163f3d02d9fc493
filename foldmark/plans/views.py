"""Random views of images and coefficient features, computed inside the tasks that hold the pixels.

An image crosses into Python once; its views are made there. Every random number of a view is a hash of the image, the pass,
the seed, the stage's place in the chain and the number's place in the stage: retries and re-partitioning repeat it, a column
(``keyed_uniform``) draws the same, and so does SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldmark.functions.arrays import BLOCK, DRAW_DIGITS, keyed_uniform, zigzag_order
from foldmark.operators.ordering import hashed_row_numbers, pack_group
from foldmark.schemas import ID

# Channel statistics (RGB) of the pretrained networks' training images.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

# What the circle's radius may differ from half the height by, and the brightness up to which an overlay is transparent.
RADIUS_LESS, RADIUS_MORE = 3, 15
TRANSPARENT = 10
LUMA = (0.299, 0.587, 0.114)

#: A larger library of overlays is joined to the images instead of given to every worker.
OVERLAY_LIMIT_BYTES = 64 << 20
#: Bytes of pixels that a worker holds at a time, and rows: small pictures weigh by their objects.
OUT_BYTES = 8 << 20
OUT_ROWS = 1024
#: The crop's numbers: two for each try, then its corner.
TRIES = 10


@dataclass(frozen=True)
class Draws:
    """The random numbers of one stage of one view, by their place."""

    name: str
    tta_index: int
    seed: int
    stage: int = 0

    def uniform(self, number: int, low: float = 0.0, high: float = 1.0) -> float:
        """From low to below high."""
        digest = hashlib.md5(f"{self.name}:{self.tta_index}:{self.seed}:{self.stage}:{number}".encode()).hexdigest()
        return low + (high - low) * (int(digest[:DRAW_DIGITS], 16) / 16**DRAW_DIGITS)

    def whole(self, number: int, low: int, high: int) -> int:
        """From low to high."""
        return low + int(self.uniform(number) * (high - low + 1))


Stage = Callable[[np.ndarray, Draws], np.ndarray]


def decode(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Stored BGR(A) or grey bytes as an RGB array."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, 2::-1].copy()


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""

    def axis(old: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = np.clip((np.arange(new) + 0.5) * old / new - 0.5, 0, old - 1)
        low = np.floor(place).astype(int)
        return low, np.minimum(low + 1, old - 1), place - low

    top, bottom, wr = axis(image.shape[0], height)
    left, right, wc = axis(image.shape[1], width)
    wr, wc = wr[:, None, None], wc[None, :, None]
    rows = image[top].astype(np.float64) * (1 - wr) + image[bottom] * wr
    out = rows[:, left] * (1 - wc) + rows[:, right] * wc
    return np.rint(out).astype(np.uint8)


@dataclass(frozen=True)
class RandomResizedCrop:
    """A crop of random area and aspect, resized to a square."""

    size: int
    scale: tuple[float, float] = (0.8, 1.0)
    ratio: tuple[float, float] = (3 / 4, 4 / 3)

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        height, width = image.shape[:2]
        for i in range(TRIES):
            area = height * width * draws.uniform(2 * i, *self.scale)
            aspect = np.exp(draws.uniform(2 * i + 1, *np.log(self.ratio)))
            h, w = round(float(np.sqrt(area / aspect))), round(float(np.sqrt(area * aspect)))
            if 0 < h <= height and 0 < w <= width:
                break
        else:
            h = w = min(height, width)
        top, left = draws.whole(2 * TRIES, 0, height - h), draws.whole(2 * TRIES + 1, 0, width - w)
        return resize(image[top : top + h, left : left + w], self.size, self.size)


@dataclass(frozen=True)
class Resize:
    """The whole image at the network's size."""

    size: int

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        return resize(image, self.size, self.size)


@dataclass(frozen=True)
class FlipHorizontal:
    p: float = 0.5

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        return image[:, ::-1] if draws.uniform(0) < self.p else image


@dataclass(frozen=True)
class FlipVertical:
    p: float = 0.5

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        return image[::-1] if draws.uniform(0) < self.p else image


@dataclass(frozen=True)
class CircularMask:
    """With probability p, black outside a circle a little smaller or larger than the image."""

    p: float = 0.5

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        if draws.uniform(0) >= self.p:
            return image
        height, width = image.shape[:2]
        radius = draws.whole(1, height // 2 - RADIUS_LESS, height // 2 + RADIUS_MORE)
        rows, columns = np.ogrid[:height, :width]
        inside = (rows - height // 2) ** 2 + (columns - width // 2) ** 2 <= radius**2
        return image * inside[:, :, None].astype(image.dtype)


#: A view's first number is how many overlays it gets; each has five: which, mirrored, turned, top, left.
OVERLAY_NUMBERS = 5


def lay_over(image: np.ndarray, piece: np.ndarray, draws: Draws, slot: int) -> None:
    """Draw a view's overlay number ``slot`` into the image, mirrored, turned and placed at random; its dark pixels are transparent."""
    _, mirrored, turned, top, left = range(OVERLAY_NUMBERS * slot + 1, OVERLAY_NUMBERS * (slot + 1) + 1)
    piece = (piece[::-1], piece[:, ::-1], piece[::-1, ::-1])[draws.whole(mirrored, 0, 2)]
    piece = np.rot90(piece, draws.whole(turned, 1, 3))
    height, width = piece.shape[:2]
    if height > image.shape[0] or width > image.shape[1]:
        raise ValueError("an overlay is larger than the image")
    top = draws.whole(top, 0, image.shape[0] - height)
    left = draws.whole(left, 0, image.shape[1] - width)
    shown = piece @ np.array(LUMA) > TRANSPARENT
    image[top : top + height, left : left + width][shown] = piece[shown]


@dataclass(frozen=True)
class Overlays:
    """Up to ``most`` overlays of a library that ``place_overlays`` will provide."""

    most: int = 5

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        raise ValueError("the stage has no overlays yet: call place_overlays")


@dataclass(frozen=True)
class Overlay:
    """Up to ``most`` overlays of a library that every worker holds."""

    overlays: Sequence[np.ndarray] = field(repr=False)
    most: int = 5

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        out = image.copy()
        for slot in range(draws.whole(0, 0, self.most) if len(self.overlays) else 0):
            which = draws.whole(OVERLAY_NUMBERS * slot + 1, 0, len(self.overlays) - 1)
            lay_over(out, self.overlays[which], draws, slot)
        return out


@dataclass(frozen=True)
class AttachedOverlay:
    """The overlays that a join brought to the view, in the order of their slots."""

    pieces: Sequence[np.ndarray] = field(default=(), repr=False)

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        out = image.copy()
        for slot, piece in enumerate(self.pieces):
            lay_over(out, piece, draws, slot)
        return out


@dataclass(frozen=True)
class Lines:
    """Up to ``most`` straight black lines from the upper half to anywhere; five numbers each."""

    most: int = 4
    widths: tuple[int, int] = (1, 2)

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        out = image.copy()
        height, width = out.shape[:2]
        for line in range(draws.whole(0, 0, self.most)):
            place = [draws.uniform(5 * line + k) for k in range(1, 5)]
            start = np.array([place[0] * height / 2, place[1] * width])
            end = np.array([place[2] * height, place[3] * width])
            n = int(np.ceil(np.abs(end - start).max())) + 1
            points = np.rint(np.linspace(start, end, n)).astype(int)
            for shift in range(draws.whole(5 * line + 5, *self.widths)):
                rows = np.clip(points[:, 0], 0, height - 1)
                columns = np.clip(points[:, 1] + shift, 0, width - 1)
                out[rows, columns] = 0
        return out


@dataclass(frozen=True)
class Normalize:
    mean: tuple[float, ...] = CHANNEL_MEAN
    std: tuple[float, ...] = CHANNEL_STD

    def __call__(self, image: np.ndarray, draws: Draws) -> np.ndarray:
        return ((image / 255.0 - np.array(self.mean)) / np.array(self.std)).astype(np.float32)


def scoring_stages(size: int) -> list[Stage]:
    return [RandomResizedCrop(size), FlipHorizontal(), FlipVertical(), CircularMask(0.5), Normalize()]


def training_stages(size: int, overlays: Sequence[np.ndarray] | None = None, most: int = 5) -> list[Stage]:
    """Without overlays at hand the chain asks ``place_overlays`` for them."""
    overlay = Overlays(most) if overlays is None else Overlay(overlays, most)
    return [RandomResizedCrop(size), FlipHorizontal(), FlipVertical(), overlay, CircularMask(0.2), Normalize()]


def identity_stages(size: int) -> list[Stage]:
    """No randomness: the plain image at the network's size."""
    return [Resize(size), Normalize()]


def view_name(dataset: str | None, name: str) -> str:
    return f"{dataset or ''}/{name}"


def view_name_column() -> Column:
    return F.concat(F.coalesce("dataset", F.lit("")), F.lit("/"), F.col(ID))


def numbered_overlays(overlays: DataFrame, seed: int) -> DataFrame:
    """The library with ``number`` from 0 on, in the hashed order of its ids: ids must differ."""
    rows = hashed_row_numbers(overlays.select(ID, "height", "width", "n_channels", "data"), ID, seed, "number")
    return rows.withColumn("number", F.col("number") - 1)


def collect_overlays(overlays: DataFrame, seed: int = 47) -> list[np.ndarray]:
    """The overlay images on the driver, by number; for a library of a checked size."""
    rows = numbered_overlays(overlays, seed).orderBy("number").collect()
    return [decode(r["data"], r["height"], r["width"], r["n_channels"]) for r in rows]


def attach_overlays(
    images: DataFrame, overlays: DataFrame, size: int, stage: int, most: int, n_passes: int, seed: int
) -> DataFrame:
    """Images with the overlays of their views in a column ``overlays``.

    Views draw their overlays as columns, from names alone. They meet the library on the overlay's number and a salt, so
    that a library of a few large overlays still spreads over all tasks; then the pieces of an image, at most
    ``n_passes * most``, join its pixels.
    """
    salts = max(1, -(-4 * images.sparkSession.sparkContext.defaultParallelism // size))

    def draw(number: Column | int) -> Column:
        return keyed_uniform("_view", "tta_index", seed, stage, number)

    views = images.select(
        "dataset", ID, view_name_column().alias("_view"), F.explode(F.sequence(F.lit(0), F.lit(n_passes - 1))).alias("tta_index")
    )
    amount = F.floor(draw(0) * (most + 1)).cast("int")
    slots = views.select("*", F.explode(F.when(amount > 0, F.sequence(F.lit(0), amount - 1))).alias("slot"))
    number = F.floor(draw(F.col("slot") * OVERLAY_NUMBERS + 1) * size).cast("long")
    salt = F.pmod(F.xxhash64("_view", "tta_index", "slot"), F.lit(salts)).cast("int")
    chosen = slots.withColumns({"number": number, "_salt": salt})
    library = numbered_overlays(overlays, seed).drop(ID)
    library = library.withColumns({"number": F.col("number").cast("long"), "_salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))})
    piece = F.struct("tta_index", "slot", "height", "width", "n_channels", "data")
    found = chosen.join(library, ["number", "_salt"]).groupBy("dataset", ID).agg(F.collect_list(piece).alias("overlays"))
    attached, _ = pack_group(found, ("dataset", ID))
    packed, keys = pack_group(images, ("dataset", ID))
    # A number of its own: small pixels would else be merged into few tasks, and views are heavy work.
    cores = images.sparkSession.sparkContext.defaultParallelism
    packed = packed.repartition(max(cores, int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
    return packed.join(attached.select(*keys, "overlays"), keys, "left").drop(*keys)


def place_overlays(
    images: DataFrame,
    overlays: DataFrame,
    stages: Sequence[Stage],
    n_passes: int = 5,
    seed: int = 47,
    limit_bytes: int = OVERLAY_LIMIT_BYTES,
) -> tuple[DataFrame, list[Stage]]:
    """Images and stages with the library at hand for the chain's ``Overlays`` stage; the views are the same either way.

    A library within ``limit_bytes`` goes to every worker, a larger one is joined view by view.
    """
    places = [i for i, s in enumerate(stages) if isinstance(s, Overlays)]
    if len(places) != 1:
        raise ValueError("the chain must have one Overlays stage")
    stage, stages = places[0], list(stages)
    size, total = overlays.agg(F.count("*"), F.coalesce(F.sum(F.length("data")), F.lit(0))).head()
    most = stages[stage].most
    if size == 0:
        raise ValueError("no overlay given")
    if total <= limit_bytes:
        stages[stage] = Overlay(collect_overlays(overlays, seed), most)
        return images, stages
    stages[stage] = AttachedOverlay()
    return attach_overlays(images, overlays, size, stage, most, n_passes, seed), stages


@dataclass(frozen=True)
class Picture:
    """A decoded row of an image table."""

    dataset: str | None
    name: str
    image: np.ndarray
    overlays: Sequence[dict] = ()

    def view(self, tta_index: int, stages: Sequence[Stage], seed: int) -> np.ndarray:
        image, name = self.image, view_name(self.dataset, self.name)
        for i, stage in enumerate(stages):
            if isinstance(stage, AttachedOverlay):
                stage = AttachedOverlay(self._pieces(tta_index))
            image = stage(image, Draws(name, tta_index, seed, i))
        return image

    def _pieces(self, tta_index: int) -> tuple[np.ndarray, ...]:
        mine = sorted((o for o in self.overlays if o["tta_index"] == tta_index), key=lambda o: o["slot"])
        return tuple(decode(o["data"], o["height"], o["width"], o["n_channels"]) for o in mine)


def pixel_columns(images: DataFrame) -> list[str]:
    attached = ["overlays"] if "overlays" in images.columns else []
    return ["dataset", ID, "height", "width", "n_channels", "data", *attached]


def pictures(batch: pa.RecordBatch) -> Iterator[Picture]:
    """The rows of a batch, decoded one at a time."""
    for start in range(0, batch.num_rows, OUT_ROWS):
        yield from _decoded(batch.slice(start, OUT_ROWS))


def _decoded(batch: pa.RecordBatch) -> Iterator[Picture]:
    columns = [batch.column(c).to_pylist() for c in ("dataset", ID, "height", "width", "n_channels")]
    data = batch.column("data")
    overlays = batch.column("overlays") if "overlays" in batch.schema.names else None
    for i, (dataset, name, *shape) in enumerate(zip(*columns, strict=True)):
        pieces = overlays[i].as_py() or () if overlays is not None else ()
        yield Picture(dataset, name, decode(data[i].as_buffer(), *shape), pieces)


def list_column(rows: Sequence[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Flat arrays, one per row, as an Arrow list column."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype("i4")
    flat = np.concatenate(rows) if len(rows) else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False)))


def packed_views(held: Sequence[tuple[str | None, str, int, np.ndarray]]) -> pa.RecordBatch:
    """(dataset, name, pass, view) as a batch of views."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _, _, _ in held], pa.string()),
            pa.array([n for _, n, _, _ in held], pa.string()),
            pa.array([i for _, _, i, _ in held], pa.int32()),
            pa.array([v.shape[0] for _, _, _, v in held], pa.int32()),
            pa.array([v.shape[1] for _, _, _, v in held], pa.int32()),
            list_column([v.astype(np.float32, copy=False).reshape(-1) for _, _, _, v in held], pa.float32()),
        ],
        names=["dataset", ID, "tta_index", "height", "width", "pixels"],
    )


def viewed_batches(batches: Iterator[pa.RecordBatch], stages: Sequence[Stage], n_passes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The views of a task's images, by about OUT_BYTES of pixels or OUT_ROWS views."""
    for batch in batches:
        held, size = [], 0
        for picture in pictures(batch):
            for i in range(n_passes):
                view = picture.view(i, stages, seed)
                held.append((picture.dataset, picture.name, i, view))
                size += 4 * view.size
                if size >= OUT_BYTES or len(held) >= OUT_ROWS:
                    yield packed_views(held)
                    held, size = [], 0
        if held:
            yield packed_views(held)


def image_views(images: DataFrame, stages: Sequence[Stage], n_passes: int = 5, seed: int = 47) -> DataFrame:
    """One row per (image, pass) with the view's pixels, row by row, channels interleaved."""
    stages = list(stages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return viewed_batches(batches, stages, n_passes, seed)

    schema = f"dataset string, {ID} string, tta_index int, height int, width int, pixels array<float>"
    return images.select(*pixel_columns(images)).mapInArrow(run, schema)


def block_transform() -> np.ndarray:
    """The cosine transform of a block as one matrix on its 64 pixels."""
    u, x = np.mgrid[:BLOCK, :BLOCK]
    basis = np.cos((2 * x + 1) * u * np.pi / (2 * BLOCK)) * np.sqrt(2 / BLOCK)
    basis[0] /= np.sqrt(2)
    return np.kron(basis, basis)


def to_ycbcr(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Luma and chroma planes, shifted to be centred on zero."""
    r, g, b = (image[:, :, i].astype(np.float64) for i in range(3))
    y = LUMA[0] * r + LUMA[1] * g + LUMA[2] * b
    return y - 128, (b - y) / 1.772, (r - y) / 1.402


def to_blocks(plane: np.ndarray) -> np.ndarray:
    """(block rows, block columns, 64) pixels; ragged edges repeat the last pixel."""
    height, width = plane.shape
    padded = np.pad(plane, ((0, -height % BLOCK), (0, -width % BLOCK)), mode="edge")
    rows, columns = padded.shape[0] // BLOCK, padded.shape[1] // BLOCK
    return padded.reshape(rows, BLOCK, columns, BLOCK).swapaxes(1, 2).reshape(rows, columns, BLOCK * BLOCK)


def plane_coefficients(planes: Sequence[np.ndarray], kept: Sequence[int] | None = None) -> list[np.ndarray]:
    """(block rows, block columns, kept) coefficients of each plane, by one matrix product for all blocks of all planes."""
    transform = block_transform() if kept is None else block_transform()[list(kept)]
    blocks = [to_blocks(p) for p in planes]
    flat = np.concatenate([b.reshape(-1, BLOCK * BLOCK) for b in blocks]) @ transform.T
    ends = np.cumsum([b.shape[0] * b.shape[1] for b in blocks])[:-1]
    return [f.reshape(*b.shape[:2], len(transform)) for f, b in zip(np.split(flat, ends), blocks, strict=True)]


def block_coefficients(plane: np.ndarray) -> np.ndarray:
    """(block rows, block columns, 64) coefficients of one plane."""
    return plane_coefficients([plane])[0]


def halve(plane: np.ndarray) -> np.ndarray:
    """Mean of 2x2 pixels."""
    padded = np.pad(plane, ((0, plane.shape[0] % 2), (0, plane.shape[1] % 2)), mode="edge")
    return padded.reshape(padded.shape[0] // 2, 2, padded.shape[1] // 2, 2).mean(axis=(1, 3))


def _planes(image: np.ndarray, half_chroma: bool) -> list[np.ndarray]:
    y, cb, cr = to_ycbcr(image)
    return [y, halve(cb), halve(cr)] if half_chroma else [y, cb, cr]


#: A picture's data set and name.
Named = tuple[str | None, str]


def component_slices(
    batch: pa.RecordBatch, half_chroma: bool, kept: Sequence[int] | None
) -> Iterator[tuple[list[Named], list[np.ndarray]]]:
    """Pictures' names and their three components' coefficients on end, by stretches of about OUT_BYTES of planes or OUT_ROWS pictures."""
    held, planes, size = [], [], 0
    for picture in pictures(batch):
        held.append((picture.dataset, picture.name))
        planes += _planes(picture.image, half_chroma)
        size += sum(p.nbytes for p in planes[-3:])
        if size >= OUT_BYTES or len(held) >= OUT_ROWS:
            yield held, plane_coefficients(planes, kept)
            held, planes, size = [], [], 0
    if held:
        yield held, plane_coefficients(planes, kept)


def image_coefficients(images: DataFrame, half_chroma: bool = False) -> DataFrame:
    """All 64 coefficients of every block, per component, with the block grid's shape."""

    def blocks_column(parts: Sequence[np.ndarray]) -> pa.ListArray:
        n = [p.shape[0] * p.shape[1] for p in parts]
        inner = pa.ListArray.from_arrays(
            pa.array(np.arange(sum(n) + 1, dtype="i4") * BLOCK * BLOCK), pa.array(np.concatenate([p.reshape(-1) for p in parts]))
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype("i4")), inner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, parts in component_slices(batch, half_chroma, None):
                y, cb, cr = parts[::3], parts[1::3], parts[2::3]
                sizes = [[p.shape[i] for p in c] for c in (y, cb) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in held], pa.string()),
                        pa.array([n for _, n in held], pa.string()),
                        *[pa.array(s, pa.int32()) for s in sizes],
                        *[blocks_column(c) for c in (y, cb, cr)],
                    ],
                    names=["dataset", ID, "luma_rows", "luma_columns", "chroma_rows", "chroma_columns", "y", "cb", "cr"],
                )

    schema = (
        f"dataset string, {ID} string, luma_rows int, luma_columns int, chroma_rows int, chroma_columns int, "
        "y array<array<double>>, cb array<array<double>>, cr array<array<double>>"
    )
    return images.select("dataset", ID, "height", "width", "n_channels", "data").mapInArrow(run, schema)


def coefficient_features(images: DataFrame, k: int = 8, half_chroma: bool = False) -> DataFrame:
    """(dataset, id, features): the first k coefficients per block, luma then thinned chroma.

    Only the rows of the transform that are kept take part in the product, so 64 - k of 64 numbers are never made.
    """
    kept = zigzag_order()[:k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, parts in component_slices(batch, half_chroma, kept):
                features = []
                for y, cb, cr in zip(parts[::3], parts[1::3], parts[2::3], strict=True):
                    step = max(1, 2 * cb.shape[0] // y.shape[0])
                    features.append(np.concatenate([p.reshape(-1) for p in (y, cb[::step, ::step], cr[::step, ::step])]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in held], pa.string()),
                        pa.array([n for _, n in held], pa.string()),
                        list_column(features, pa.float64()),
                    ],
                    names=["dataset", ID, "features"],
                )

    schema = f"dataset string, {ID} string, features array<double>"
    return images.select("dataset", ID, "height", "width", "n_channels", "data").mapInArrow(run, schema)
