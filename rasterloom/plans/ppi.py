"""Scan resolution by folder, from the ruler on its last image and the pages before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import geometry as geo
from rasterloom.functions import kernels
from rasterloom.operators import relational as rel
from rasterloom.operators.images import measured


def average_sides(sides: DataFrame) -> DataFrame:
    """(folder, avg_long, avg_short) of the measured pages; unmeasured ones do not count."""
    return sides.groupBy("folder").agg(F.avg("long_px").alias("avg_long"), F.avg("short_px").alias("avg_short"))


def ppi_by_folder(files: DataFrame, sides: DataFrame, ruler_sides: DataFrame | None = None, drop_last: int = 2) -> DataFrame:
    """(folder, band_long, avg_long, avg_short, ppi) of files (folder, name) and measured sides (name, long_px, short_px).

    The last file of a folder shows the ruler; all but the last ``drop_last`` are pages. Folders without a measured ruler
    or page are left out. Only names are ranked, not images.
    """
    ruler_sides = sides if ruler_sides is None else ruler_sides
    ruler = rel.last_rows(files.select("folder", "name"), "folder", ["name"]).join(ruler_sides, "name")
    ruler = ruler.select("folder", F.col("long_px").alias("band_long")).where("band_long > 0")
    pages = rel.without_last(files.select("folder", "name"), "folder", ["name"], drop_last)
    dims = average_sides(pages.join(sides, "name").where("long_px is not null"))
    k = geo.mm_per_pixel(F.col("band_long"))
    ppi = geo.ppi_class(geo.px_to_mm(F.col("avg_short"), k), geo.px_to_mm(F.col("avg_long"), k))
    return dims.join(ruler, "folder").select("folder", "band_long", "avg_long", "avg_short", ppi.alias("ppi"))


def _sides(rects: DataFrame) -> DataFrame:
    w, h = F.col("rect.w"), F.col("rect.h")
    return rects.where("rect is not null").select(
        F.col("path").alias("name"), F.greatest(w, h).alias("long_px"), F.least(w, h).alias("short_px")
    )


def estimate(files: DataFrame, images: DataFrame) -> DataFrame:
    """Resolutions of files (path, parent), valid ones only, and their decoded images."""
    named = files.select(F.col("parent").alias("folder"), F.col("path").alias("name"))
    last = rel.last_rows(named, "folder", ["name"]).select(F.col("name").alias("path"))
    rulers = _sides(measured(images.join(last, "path", "left_semi"), kernels.measure_ruler))
    pages = _sides(measured(images.join(last, "path", "left_anti"), kernels.measure_page))
    return ppi_by_folder(named, pages, rulers)


def from_rects(files: DataFrame, rects: DataFrame) -> DataFrame:
    """Resolutions of files (path, parent), valid ones only, whose ``rects`` (path, ruler, page) were measured before."""
    named = files.select(F.col("parent").alias("folder"), F.col("path").alias("name"))
    rulers = _sides(rects.select("path", F.col("ruler").alias("rect")))
    pages = _sides(rects.select("path", F.col("page").alias("rect")))
    return ppi_by_folder(named, pages, rulers)
