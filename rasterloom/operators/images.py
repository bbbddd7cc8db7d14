"""Arrow wrappers around the image kernels; a failure becomes a value of the error column, never an exception."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom import config
from rasterloom.functions import kernels
from rasterloom.schema import IMAGE, RECT

_RECT = pa.struct([(n, pa.float64()) for n in kernels.Rect._fields])


def pixels_of(row: dict) -> np.ndarray:
    """The (height, width, 3) array of an image row; gray images get three equal channels, alpha is dropped."""
    data = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["channels"])
    return np.repeat(data, 3, 2) if row["channels"] == 1 else data[..., :3]


#: Results of equal images that a task remembers.
KEPT = 4096


def _once(measure: Callable[[dict], tuple]) -> Callable[[dict], tuple]:
    """``measure`` of an image row without its path, done once for equal images, as copies and blank pages are."""
    known: dict[tuple, tuple] = {}

    def run(row: dict) -> tuple:
        if row["data"] is None:
            return measure(row)
        key = (row["height"], row["width"], row["channels"], hashlib.blake2b(row["data"], digest_size=32).digest())
        found = known.get(key)
        if found is None:
            found = measure(row)
            if len(known) >= KEPT:
                known.clear()
            known[key] = found
        return found

    return run


def measured(images: DataFrame, kernel: Callable[[np.ndarray], kernels.Rect | None], name: str = "rect") -> DataFrame:
    """(path, ``name``, error) for each row of ``images`` (path, height, width, channels, data).

    The rectangle is null where nothing was found or the image is not valid; the error says which.
    """

    def measure(row: dict) -> tuple:
        if row["data"] is None:
            return None, "[OPEN FAIL]"
        try:
            found = kernel(pixels_of(row))
        except Exception as error:  # noqa: BLE001
            return None, f"[UNEXPECTED] {error}"
        return found and found._asdict(), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _once(measure)
        for batch in batches:
            rects, errors = _columns(once, batch, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(rects, _RECT), pa.array(errors, pa.string())], ["path", name, "error"]
            )

    rows = images.select("path", "height", "width", "channels", "data")
    return rows.mapInArrow(run, f"path string, {name} {RECT}, error string")


def _columns(measure: Callable[[dict], tuple], batch: pa.RecordBatch, width: int) -> list[list]:
    """The ``width`` values that ``measure`` has for each row, by column."""
    rows = [measure(row) for row in batch.to_pylist()]
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(width)]


def detected(images: DataFrame, template: np.ndarray, names: Sequence[str] = ("adaptive", "region", "multiscale", "by_gray")) -> DataFrame:
    """(path, adaptive, region, multiscale, by_gray, error): four ruler detectors side by side, null where one finds nothing.

    Where ``names`` has only some of them, the others do not run and have no column. A detector that fails leaves the others be; error says which failed and why, or that the image did not decode.
    """
    detectors = {
        "adaptive": kernels.detect_adaptive,
        "region": lambda image: kernels.detect_in_region(image, template),
        "multiscale": lambda image: kernels.detect_multiscale(image, template),
        "by_gray": lambda image: kernels.detect_by_gray(image, template),
    }
    detectors = {name: detectors[name] for name in names}

    def measure(row: dict) -> tuple:
        if row["data"] is None:
            return *[None] * len(detectors), "[OPEN FAIL]"
        found, failed = [], []
        for name, kernel in detectors.items():
            rect = None
            try:
                rect = kernel(pixels_of(row))
            except Exception as error:  # noqa: BLE001
                failed.append(f"[UNEXPECTED] {name}: {error}")
            found.append(rect and rect._asdict())
        return *found, "; ".join(failed) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _once(measure)
        for batch in batches:
            *found, errors = _columns(once, batch, len(detectors) + 1)
            columns = [pa.array(v, _RECT) for v in found]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *columns, pa.array(errors, pa.string())], ["path", *detectors, "error"])

    schema = "path string, " + ", ".join(f"{n} {RECT}" for n in detectors) + ", error string"
    return images.select("path", "height", "width", "channels", "data").mapInArrow(run, schema)


def matched_scales(images: DataFrame, template: np.ndarray, scales: tuple = config.TEMPLATE_SCALES, least: int = 10) -> DataFrame:
    """(path, scale, score, x, y, width, height): the best place of the gray template at each of its scales.

    Scales at which the template is smaller than ``least`` or larger than the image are left out.
    """
    scaled = []
    for scale in scales:
        size = (int(template.shape[0] * scale), int(template.shape[1] * scale))
        if min(size) >= least:
            scaled.append((scale, kernels.resize(template[..., None], size, "area")[..., 0]))
    names = ["path", "scale", "score", "x", "y", "width", "height"]
    types = [pa.string(), pa.float64(), pa.float64(), *[pa.int32()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["data"] is None:
                    continue
                plain = kernels.gray(pixels_of(row))
                for scale, small in scaled:
                    if small.shape[0] <= plain.shape[0] and small.shape[1] <= plain.shape[1]:
                        rows.append((row["path"], scale, *kernels.match(plain, small), small.shape[1], small.shape[0]))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    columns = images.select("path", "height", "width", "channels", "data")
    return columns.mapInArrow(run, "path string, scale double, score double, x int, y int, width int, height int")


def best_match(scores: DataFrame, key: str = "path", least: float = config.MIN_MATCH) -> DataFrame:
    """Of :func:`matched_scales` rows, each image's best, the first scale of equals; none below ``least``."""
    best = F.max_by(F.struct("scale", "score", "x", "y", "width", "height"), F.struct("score", -F.col("scale")))
    return scores.groupBy(key).agg(best.alias("r")).select(key, "r.*").where(F.col("score") >= least)


def gray_template(images: DataFrame) -> np.ndarray:
    """The first decodable image of a scan as a gray template; FileNotFoundError where there is none."""
    row = images.where("data is not null").orderBy("path").first()
    if row is None:
        raise FileNotFoundError("no template that decodes")
    return kernels.gray(pixels_of(row.asDict()))


def to_bgr(gray: np.ndarray) -> np.ndarray:
    """A gray array as three equal channels."""
    return np.repeat(gray[..., None], 3, 2)


def outlines(images: DataFrame, level: int = config.GRAY_THRESHOLD) -> DataFrame:
    """(path, perimeter, area, rect) of the largest component brighter than ``level``; nulls where there is none."""

    def measure(row: dict) -> tuple:
        found = []
        if row["data"] is not None:
            found = [kernels.contour(r) for r in kernels.regions(kernels.gray(pixels_of(row)) > level)]
        if not found:
            return None, None, None
        points = max(found, key=kernels.area)
        return kernels.perimeter(points), kernels.area(points), kernels.min_area_rect(points)._asdict()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _once(measure)
        for batch in batches:
            rows = _columns(once, batch, 3)
            columns = [pa.array(rows[0], pa.float64()), pa.array(rows[1], pa.float64()), pa.array(rows[2], _RECT)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *columns], ["path", "perimeter", "area", "rect"])

    return images.select("path", "height", "width", "channels", "data").mapInArrow(run, f"path string, perimeter double, area double, rect {RECT}")


def overlays(images: DataFrame, kernel: Callable[[np.ndarray], kernels.Rect | None]) -> DataFrame:
    """Images with the rectangle drawn that ``kernel`` finds in each; those without one stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["data"] is not None:
                    plain = pixels_of(row)
                    rect = kernel(plain)
                    row |= {"channels": 3, "data": (plain if rect is None else kernels.outlined(plain, rect)).tobytes()}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return images.select("path", "height", "width", "channels", "data").mapInArrow(run, IMAGE)


def component_areas(masks: DataFrame, key: str, width: int) -> DataFrame:
    """(key, component, area) of the 8-connected components of row-major boolean masks; component is its first pixel."""
    kind = dict(masks.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, firsts, areas = [], [], []
            for row in batch.to_pylist():
                for region in kernels.regions(np.array(row["mask"], bool).reshape(-1, width), external=False):
                    keys.append(row[key])
                    firsts.append(int(region.runs[0, 0] * width + region.runs[0, 1]))
                    areas.append(int((region.runs[:, 2] - region.runs[:, 1] + 1).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(key).type), pa.array(firsts, pa.int32()), pa.array(areas, pa.int64())],
                [key, "component", "area"],
            )

    return masks.select(key, F.col("mask")).mapInArrow(run, f"{key} {kind}, component int, area long")
