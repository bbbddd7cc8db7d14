"""Pixel arithmetic as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterloom import config


def quantise(v: Column) -> Column:
    """0..1 to 0..255, clipped and cut to whole numbers."""
    return F.greatest(F.lit(0.0), F.least(F.lit(255.0), v * 255.0)).cast("int")


def gray(b: Column, g: Column, r: Column) -> Column:
    return F.floor(r * F.lit(0.299) + g * F.lit(0.587) + b * F.lit(0.114) + F.lit(0.5)).cast("int")


def hsv(b: Column, g: Column, r: Column) -> tuple[Column, Column, Column]:
    """Hue in half degrees (0-179), saturation and value in 0-255, rounded half up."""
    top, low = F.greatest(b, g, r), F.least(b, g, r)
    span = (top - low).cast("double")
    angle = (
        F.when(span == 0, 0.0)
        .when(top == r, 60.0 * (g - b) / span)
        .when(top == g, 120.0 + 60.0 * (b - r) / span)
        .otherwise(240.0 + 60.0 * (r - g) / span)
    )
    hue = F.pmod(F.floor(F.pmod(angle, F.lit(360.0)) / 2.0 + 0.5), F.lit(180)).cast("int")
    saturation = F.when(top == 0, 0).otherwise(F.floor(255.0 * span / top + 0.5).cast("int"))
    return hue, saturation, top


def in_range(channels: tuple[Column, Column, Column], low: tuple, high: tuple) -> Column:
    """All channels within inclusive bounds."""
    tests = [c.between(a, b) for c, a, b in zip(channels, low, high, strict=True)]
    return tests[0] & tests[1] & tests[2]


def threshold(g: Column, level: int = config.GRAY_THRESHOLD) -> Column:
    return F.when(g > level, 255).otherwise(0)


def bounds(mean: Column, spread: int, top: int) -> tuple[Column, Column]:
    """Bounds around a mean, clamped to 0..top and cut to whole numbers."""
    return F.greatest(F.lit(0.0), mean - spread).cast("int"), F.least(F.lit(float(top)), mean + spread).cast("int")


def distance(a: list[Column], b: list[Column]) -> Column:
    """Euclidean distance over channels."""
    total = sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), F.lit(0.0))
    return F.sqrt(total)
