"""What the oracles of several operators share: checksums and words in DuckDB's SQL."""

from __future__ import annotations

#: The reversed polynomial of CRC32 and its starting value.
POLYNOMIAL, START = 0xEDB88320, 0xFFFFFFFF

#: A table expression of one row, ``entries``, that ``crc32`` reads.
CRC_TABLE = f"""crc_table AS (
  SELECT list(v ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, {POLYNOMIAL}) ELSE a >> 1 END) AS v
    FROM range(256) AS byte(i)) AS bytes)"""

#: ASCII words: runs of letters, digits and anything beyond ASCII.
ASCII_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def crc32(text: str) -> str:
    """The unsigned checksum of a text's UTF-8 bytes, beside ``crc_table``."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda k: {byte})"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend({START}::BIGINT, {bytes_}), {step}), {START})"


def lower_ascii(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
