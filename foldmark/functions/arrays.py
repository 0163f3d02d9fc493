"""Array expressions over flat pixel rows and coefficient blocks.

Index lists are constants, so a selection compiles to direct element reads
rather than a per-element lambda.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 8
#: Hexadecimal digits of a hash that make a random number; all of them fit a double.
DRAW_DIGITS = 13


def zigzag_order(side: int = BLOCK) -> list[int]:
    """Row-major positions of a square block along its anti-diagonals, direction alternating."""
    cells = [(r, c) for r in range(side) for c in range(side)]
    cells.sort(key=lambda rc: (sum(rc), rc[0] if sum(rc) % 2 else rc[1]))
    return [r * side + c for r, c in cells]


def pick(values: Column, positions: Sequence[int]) -> Column:
    """Elements at constant positions; a position past the end gives null."""
    return F.array(*[F.get(values, F.lit(p)) for p in positions])


def zigzag_block(block: Column, k: int) -> Column:
    return pick(block, zigzag_order()[:k])


def zigzag_component(blocks: Column, k: int, columns: Column | None = None, step: Column | None = None) -> Column:
    """First k coefficients of every block, flattened.

    With ``columns`` (blocks per block-row) and ``step``, only every step-th
    block-row and block-column is kept.
    """
    if step is not None and columns is not None:
        blocks = F.filter(
            blocks,
            lambda _, i: ((F.floor(i / columns) % step) == 0) & (((i % columns) % step) == 0),
        )
    return F.flatten(F.transform(blocks, lambda block: zigzag_block(block, k)))


def zigzag_image(
    y: Column, cb: Column, cr: Column, k: int, luma_rows: Column, chroma_rows: Column, chroma_columns: Column
) -> Column:
    """Feature vector of an image: luma, then both chroma components thinned to a common grid."""
    step = F.floor(F.lit(2) * chroma_rows / luma_rows)
    return F.concat(
        zigzag_component(y, k),
        zigzag_component(cb, k, chroma_columns, step),
        zigzag_component(cr, k, chroma_columns, step),
    )


def flip(
    pixels: Column,
    height: int,
    width: int,
    channels: int = 1,
    horizontal: Column | bool = False,
    vertical: Column | bool = False,
) -> Column:
    """Mirror an image held row by row, channels interleaved. A flip may depend on the table's row.

    Works on whole pixel rows: slices of the array, reordered and reversed.
    """

    def mirrored(line: Column) -> Column:
        if channels == 1:
            return F.reverse(line)
        backwards = F.sequence(F.lit(width - 1), F.lit(0))
        return F.flatten(F.transform(backwards, lambda c: F.slice(line, c * channels + 1, F.lit(channels))))

    def pixel_row(r: Column) -> Column:
        line = F.slice(pixels, r * (width * channels) + 1, F.lit(width * channels))
        return _choose(horizontal, mirrored(line), line)

    down, up = F.sequence(F.lit(0), F.lit(height - 1)), F.sequence(F.lit(height - 1), F.lit(0))
    return F.flatten(F.transform(_choose(vertical, up, down), pixel_row))


def _choose(condition: Column | bool, yes: Column, no: Column) -> Column:
    if isinstance(condition, bool):
        return yes if condition else no
    return F.when(condition, yes).otherwise(no)


def hash_coin(key: Column, stage: str, tta_index: Column, seed: int) -> Column:
    """True for half of the (key, pass) pairs, the same pairs in every run."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), tta_index.cast("string"), F.lit(stage), F.lit(str(seed))))
    return F.substring(digest, 1, 1) < F.lit("8")


def keyed_uniform(
    name: Column | str, tta_index: Column | str, seed: int, stage: int, number: Column | int
) -> Column:
    """A number from 0 to below 1 for each (name, pass, seed, stage, number): the same wherever and however often it is drawn."""
    number = number if isinstance(number, Column) else F.lit(number)
    parts = [F.col(c) if isinstance(c, str) else c for c in (name, tta_index)]
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed)), F.lit(str(stage)), number.cast("string"))
    digits = F.substring(F.md5(text), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DRAW_DIGITS))


def circle_mask(pixels: Column, height: int, width: int, radius: Column, channels: int = 1) -> Column:
    """Zero the pixels outside a circle around the centre."""

    def masked(x: Column, i: Column) -> Column:
        cell = F.floor(i / channels)
        down, right = F.floor(cell / width) - height // 2, cell % width - width // 2
        return F.when(down * down + right * right <= radius * radius, x).otherwise(F.lit(0).cast("float"))

    return F.transform(pixels, masked)


def normalize_channels(pixels: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """Scale interleaved 0..255 channels to [0, 1], then standardise each channel."""
    channels = len(mean)
    means, stds = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std))
    return F.transform(
        pixels,
        lambda x, i: (x / F.lit(255.0) - F.get(means, i % channels)) / F.get(stds, i % channels),
    )
