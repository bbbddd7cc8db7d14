"""The image pipeline: what is missing, its resolution, upscaling, downscaling, outputs and failures."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import config, schema
from rasterloom.functions import geometry as geo
from rasterloom.functions import kernels
from rasterloom.operators import relational as rel
from rasterloom.operators import tiles
from rasterloom.operators.images import pixels_of
from rasterloom.plans import ppi as resolution
from rasterloom.sources import files as sources

#: Folders that a resumed run names to the scan; more are found again below the root.
MAX_ROOTS = 10_000
STEPS = ("super_resolution", "validate_super_resolution", "downscale", "validate_downscale", "run", "CRASH")


def first_failure(passed: dict[str, Column]) -> Column:
    """The first step that did not pass; null if all did."""
    out = F.lit(None).cast("string")
    for step, ok in reversed(passed.items()):
        out = F.when(~F.coalesce(ok, F.lit(False)), step).otherwise(out)
    return out


@dataclass(frozen=True)
class Result:
    """Images by path, relative_path and ppi: upscaled, and finished; failures are rows of the failure log.

    All are read from ``scratch``, a table in the shared folder, which may go once they were used.
    """

    upscaled: DataFrame
    images: DataFrame
    failures: DataFrame
    totals: DataFrame
    scratch: str


def calibrations(spark: SparkSession) -> DataFrame:
    rows = [(c.ppi, c.width_pixel, c.width_mm, c.height_pixel, c.height_mm, c.correction_factor) for c in config.CALIBRATIONS]
    return spark.createDataFrame(rows, schema.CALIBRATION)


def relative(path: Column, root: str) -> Column:
    """The path below ``root``, the same for inputs and outputs, so that equal names in other folders do not meet."""
    top = "/" + root.split("://")[-1].removeprefix("file:").strip("/") + "/"
    return F.element_at(F.split(path, top.replace(".", r"\.")), -1)


#: What is known of an image, which rides along in the place of its path, so that pixels are not joined with it again.
_KEY = "path string, relative_path string, ppi int, target_height int, target_width int"


def decoded(spark: SparkSession, roots: list[str], folder: str) -> DataFrame:
    """(path, height, width, channels, data, ruler, page): the images below ``roots``, measured, as a table in ``folder``.

    Files are decoded here and nowhere else; measurements are read from the table without the pixels.
    """
    images = sources.images(spark, roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rects: dict[str, list] = {"ruler": [], "page": []}
            for row in batch.to_pylist():
                for name, kernel in (("ruler", kernels.measure_ruler), ("page", kernels.measure_page)):
                    try:
                        rect = kernel(pixels_of(row)) if row["data"] is not None else None
                    except Exception:  # noqa: BLE001
                        rect = None
                    rects[name].append(rect and rect._asdict())
            kind = pa.struct([(n, pa.float64()) for n in kernels.Rect._fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(r, kind) for r in rects.values())], [*batch.schema.names, *rects])

    measured = images.mapInArrow(run, f"{schema.IMAGE}, ruler {schema.RECT}, page {schema.RECT}")
    measured.write.parquet(folder)
    return spark.read.parquet(folder)


def run(spark: SparkSession, root: str, done: DataFrame | None = None, upscaler: tiles.Upscaler = tiles.nearest, settings: config.Settings | None = None) -> Result:
    """Processes the images below ``root`` whose relative_path is not in ``done``.

    A folder's resolution comes from all its valid images, also those that are done; folders that are done as a whole are
    not read. An image that is not valid, in a folder without a resolution, or at one without a calibration, and one whose
    upscaling or downscaling fails, becomes a failure and stops nothing else. Names do not tell images: every file that
    decodes is one, and every other but a document by its suffix is an invalid one.
    """
    settings = settings or config.Settings()
    found = sources.files(spark, root).withColumn("relative_path", relative(F.col("path"), root))
    found = found.where(F.col("relative_path").contains("/") & (F.lower("name") != "thumbs.db"))
    roots = [root]
    if done is not None:
        found = found.join(rel.pending(found, done, ["relative_path"]).select("parent").distinct(), "parent", "left_semi")
        folders = [r.parent for r in found.select("parent").distinct().limit(MAX_ROOTS + 1).collect()]
        roots = folders if len(folders) <= MAX_ROOTS else roots
    scratch = f"{sources.shared_folder(spark)}/decoded-{uuid.uuid4().hex}"
    table = decoded(spark, roots, scratch)
    checked = sources.validated(found, table).where(F.col("valid") | ~sources.suffix(F.col("name")).isin(*config.DOCUMENT_SUFFIXES))
    checked = sources.explained(spark, root, checked)
    valid = checked.where("valid")
    ppis = resolution.from_rects(valid, table).select("folder", "ppi")
    todo = checked if done is None else rel.pending(checked, done, ["relative_path"])
    todo = todo.join(ppis, todo["parent"] == ppis["folder"], "left").join(F.broadcast(calibrations(spark)), "ppi", "left")
    error = F.when(~F.col("valid"), F.concat(F.lit("Input image invalid: "), "error"))
    error = error.when(F.col("ppi").isNull(), F.lit("Errore downscale: no resolution"))
    error = error.when(F.col("width_mm").isNull(), F.concat(F.lit("Errore downscale: ppi "), F.col("ppi")))
    step = F.when(~F.col("valid"), "super_resolution").otherwise("downscale")
    todo = todo.withColumn("failure", error).withColumn("step", step).withColumn("now", F.current_timestamp())
    failures = rel.failure_rows(todo.where("failure is not null"), F.col("step"), F.col("failure"), F.col("path"), "now")
    factor = geo.scale_factor(F.col("ppi"), F.col("width_mm"), F.col("correction_factor"), settings.scale)
    ready = todo.where("failure is null").select("path", "relative_path", "ppi", factor.alias("factor"))
    rows = table.select(*(c.split()[0] for c in schema.IMAGE.split(", "))).join(ready, "path")
    size = lambda side: F.greatest(F.lit(1), geo.target_size(F.col(side) * settings.scale, F.col("factor")))
    rows = rows.withColumns({"target_height": size("height"), "target_width": size("width")})
    rows = rows.withColumn("path", F.to_json(F.struct(*(c.split()[0] for c in _KEY.split(", ")))))
    big = tiles.superresolved(rows, upscaler, settings.scale, settings.tile, settings.overlap)
    big = big.withColumn("key", F.from_json("path", _KEY)).withColumns({"target_height": F.col("key.target_height"), "target_width": F.col("key.target_width")})
    totals = rel.failure_totals(todo, "parent", F.col("failure").isNotNull())
    return Result(_named(big), _named(tiles.resized(big)), failures, totals, scratch)


def _named(images: DataFrame) -> DataFrame:
    key = F.from_json("path", _KEY)
    names = [key[c].alias(c) for c in ("path", "relative_path", "ppi")]
    return images.select(*names, "height", "width", "channels", "data", "error")
