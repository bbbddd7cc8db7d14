"""Scale, size and tile arithmetic as columns; operations keep the order that whole sizes depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterloom import config


def px_to_mm(px: Column, mm_per_px: Column) -> Column:
    return mm_per_px * px


def mm_per_pixel(band_long_px: Column) -> Column:
    return F.lit(config.RULER_MM) / band_long_px


def ppi_class(short_mm: Column, long_mm: Column) -> Column:
    """400 for pages up to A4, 600 beyond; null if a side is unknown."""
    a4 = (short_mm <= config.A4_SHORT_MM) & (long_mm <= config.A4_LONG_MM)
    return F.when(short_mm.isNull() | long_mm.isNull(), None).when(a4, 400).otherwise(600)


def scale_factor(ppi: Column, width_mm: Column, correction: Column, upscale: int = 2) -> Column:
    """What brings an upscaled image's ruler to its target size: target pixels over actual, then the correction."""
    target = ppi * (config.TARGET_RULER_MM / config.MM_PER_INCH)
    actual = (width_mm * ppi / config.MM_PER_INCH) * upscale
    return target / actual * correction


def target_size(size: Column, factor: Column) -> Column:
    """Whole pixels, cut towards zero."""
    return (size * factor).cast("int")


def padded(size: Column, tile: int = config.TILE) -> Column:
    return F.greatest(size, F.lit(tile))


def tile_count(size: Column, tile: int = config.TILE, overlap: int = config.OVERLAP) -> Column:
    return F.ceil((padded(size, tile) - overlap) / (tile - overlap)).cast("int")


def tile_start(index: Column, size: Column, tile: int = config.TILE, overlap: int = config.OVERLAP) -> Column:
    """The last tile is moved back to end with the image."""
    return F.least(index * (tile - overlap), padded(size, tile) - tile).cast("int")


def linear_weight(x: Column, width: Column | float) -> Column:
    """A triangle over 0..width that peaks at a half in the middle."""
    width = width if isinstance(width, Column) else F.lit(float(width))
    return F.least(x / width, (width - x) / width)


def edge_weight(pos: Column, first: Column, last: Column, tile: int, overlap: int) -> Column:
    """Weight of a tile's pixel along one axis: triangles over the overlaps with neighbours, 1 elsewhere."""
    head = F.when(~first & (pos < overlap), linear_weight(pos.cast("double"), overlap)).otherwise(1.0)
    tail = F.when(~last & (pos >= tile - overlap), linear_weight((tile - 1 - pos).cast("double"), overlap)).otherwise(1.0)
    return head * tail
