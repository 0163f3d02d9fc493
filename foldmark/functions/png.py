"""PNG files from pixel arrays, with nothing but zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# The signature of the format, and colour types by channel count (grey, RGB, RGBA).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLOUR_TYPES = {1: 0, 3: 2, 4: 6}


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(pixels: np.ndarray, level: int = 6) -> bytes:
    """(height, width, channels) bytes, RGB order, as a file with unfiltered rows."""
    height, width, channels = pixels.shape
    header = struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPES[channels], 0, 0, 0)
    rows = np.zeros((height, 1 + width * channels), np.uint8)  # each row starts with its filter, none
    rows[:, 1:] = pixels.reshape(height, -1)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")
