"""Geohash tiles as native columns.

A position is kept as one BIGINT *cell*: 30 longitude and 30 latitude bits,
interleaved, longitude first. The first ``n`` geohash characters are the top
``5n`` bits, so tiles of any length are shifts of the cell and join, group and
compare as integers. Text is made only where a geohash string is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash alphabet, and the digits conv() writes in base 32.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CELL_CHARS = 12
_AXIS_BITS = 30
_AXIS_CELLS = 1 << _AXIS_BITS
_EVEN_BITS = 0x5555555555555555


def _axis_index(value: Column, low: float, span: float) -> Column:
    """Index of the axis cell holding ``value``; a cell owns its lower edge."""
    step = F.lit(span / _AXIS_CELLS)
    guess = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(_AXIS_CELLS)))
    # The division may round across an edge; the edges themselves are exact.
    too_high = (guess * step + F.lit(low) > value).cast("bigint")
    too_low = ((guess + 1) * step + F.lit(low) <= value).cast("bigint")
    return F.greatest(F.lit(0), F.least(F.lit(_AXIS_CELLS - 1), guess - too_high + too_low))


def _spread(index: Column) -> Column:
    """Move bit i of a 30-bit index to bit 2i, five bits at a time.

    A lookup names its input once per group of five bits; shifting and masking
    would name it 32 times over and bloat the plan.
    """
    spread = [sum((i >> b & 1) << 2 * b for b in range(5)) for i in range(32)]
    table = F.expr(f"array({', '.join(f'{v}L' for v in spread)})")
    total = None
    for low in range(0, _AXIS_BITS, 5):
        five = F.shiftright(index, low).bitwiseAND(F.lit(31)).cast("int")
        part = F.shiftleft(F.get(table, five), 2 * low)
        total = part if total is None else total.bitwiseOR(part)
    return total


def _gather(bits: Column) -> Column:
    """Inverse of ``_spread``; odd bits are ignored."""
    digits = F.conv(bits.bitwiseAND(F.lit(_EVEN_BITS)).cast("string"), 10, 4)
    return F.conv(digits, 2, 10).cast("bigint")


def cell(lat: Column, lon: Column) -> Column:
    """60-bit cell of a position (the 12-character tile as a number)."""
    return F.shiftleft(_spread(_axis_index(lon, -180.0, 360.0)), 1).bitwiseOR(
        _spread(_axis_index(lat, -90.0, 180.0))
    )


def cell_tile(cell_col: Column, chars: int) -> Column:
    """The ``chars``-character tile of a cell, as a number."""
    return F.shiftright(cell_col, 5 * (CELL_CHARS - chars))


def tile_text(tile_col: Column, chars: int) -> Column:
    """Geohash text of a numeric tile of ``chars`` characters."""
    digits = F.lpad(F.conv(tile_col.cast("string"), 10, 32), chars, "0")
    return F.translate(digits, BASE32_DIGITS, GEOHASH_ALPHABET)


def text_tile(geohash: Column) -> Column:
    """Numeric tile of a geohash text."""
    return F.conv(F.translate(geohash, GEOHASH_ALPHABET, BASE32_DIGITS), 32, 10).cast("bigint")


def tile_id(lat: Column, lon: Column, chars: int) -> Column:
    """Numeric tile of a position; the form joins and groupings use."""
    return cell_tile(cell(lat, lon), chars)


def tile(lat: Column, lon: Column, chars: int) -> Column:
    """Geohash text of a position."""
    return tile_text(tile_id(lat, lon, chars), chars)


def common_chars(a: Column, b: Column) -> Column:
    """Number of leading geohash characters two cells share."""
    differing_bits = F.length(F.bin(a.bitwiseXOR(b)))
    return F.when(a == b, CELL_CHARS).otherwise(CELL_CHARS - F.ceil(differing_bits / 5)).cast("int")


def prefix_text(cell_col: Column, chars: Column) -> Column:
    """The first ``chars`` geohash characters of a cell."""
    return F.left(tile_text(cell_col, CELL_CHARS), chars)


def cell_center(cell_col: Column, chars: Column) -> Column:
    """Centre ``struct<lat,lon>`` of the tile made of a cell's first ``chars`` characters."""
    bits = chars * 5
    lat_free = F.lit(_AXIS_BITS) - F.floor(bits / 2).cast("int")
    lon_free = F.lit(_AXIS_BITS) - F.ceil(bits / 2).cast("int")
    one = F.lit(1).cast("bigint")

    def middle(index: Column, free: Column, low: float, span: float) -> Column:
        width = F.call_function("shiftleft", one, free)
        start = index - F.pmod(index, width)
        return (start + width / F.lit(2.0)) * F.lit(span / _AXIS_CELLS) + F.lit(low)

    return F.struct(
        middle(_gather(cell_col), lat_free, -90.0, 180.0).alias("lat"),
        middle(_gather(F.shiftright(cell_col, 1)), lon_free, -180.0, 360.0).alias("lon"),
    )


def tile_center(geohash: Column) -> Column:
    """Centre ``struct<lat,lon>`` of a geohash text of any length up to 12."""
    padded = F.rpad(geohash, CELL_CHARS, "0")
    return cell_center(text_tile(padded), F.length(geohash))
