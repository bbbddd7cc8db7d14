"""Tiling, pluggable upscaling and blending; a row is a tile or a strip, never a whole upscaled float image."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom import config
from rasterloom.functions import geometry as geo
from rasterloom.functions import kernels
from rasterloom.operators.images import pixels_of
from rasterloom.schema import TILE


class Upscaler(Protocol):
    """Upscales a float tile (height, width, 3) in 0..1 by a whole factor; must be picklable."""

    def __call__(self, tile: np.ndarray, scale: int) -> np.ndarray: ...


def nearest(tile: np.ndarray, scale: int) -> np.ndarray:
    return tile.repeat(scale, 0).repeat(scale, 1)


def bicubic(tile: np.ndarray, scale: int) -> np.ndarray:
    out = tile
    for axis in (0, 1):
        w = kernels.weights(out.shape[axis], out.shape[axis] * scale, "bicubic")
        out = np.moveaxis(np.tensordot(w, out, (1, axis)), 0, axis)
    return out


class OnnxUpscaler:
    """A model file run by onnxruntime, on the GPU where there is one and opens; the session opens once for each Python worker.

    ``decrypt``, which must be picklable, turns the bytes of a file that is not plain into those of the model.
    """

    _sessions: dict = {}

    def __init__(self, path: str, decrypt: Callable[[bytes], bytes] | None = None) -> None:
        self.path, self.decrypt = path, decrypt

    def __call__(self, tile: np.ndarray, scale: int) -> np.ndarray:
        session = self._sessions.get(self.path)
        if session is None:
            import onnxruntime

            with open(self.path, "rb") as file:
                model = file.read()
            model = self.decrypt(model) if self.decrypt else model
            plain = ["CPUExecutionProvider"]
            gpu = ["CUDAExecutionProvider"] if "CUDAExecutionProvider" in onnxruntime.get_available_providers() else []
            try:
                session = onnxruntime.InferenceSession(model, providers=gpu + plain)
            except Exception:
                if not gpu:
                    raise
                session = onnxruntime.InferenceSession(model, providers=plain)
            self._sessions[self.path] = session
        fed = tile.transpose(2, 0, 1)[None].astype(np.float32)
        return session.run(None, {session.get_inputs()[0].name: fed})[0][0].transpose(1, 2, 0)


def tile_grid(sizes: DataFrame, height: str, width: str, tile: int = config.TILE, overlap: int = config.OVERLAP) -> DataFrame:
    """Adds tile_h, tile_w, start_h, start_w: a row for each tile, row by row."""
    h, w = F.col(height), F.col(width)
    rows = sizes.withColumn("tile_h", F.explode(F.sequence(F.lit(0), geo.tile_count(h, tile, overlap) - 1)))
    rows = rows.withColumn("tile_w", F.explode(F.sequence(F.lit(0), geo.tile_count(w, tile, overlap) - 1)))
    rows = rows.withColumn("start_h", geo.tile_start(F.col("tile_h"), h, tile, overlap))
    return rows.withColumn("start_w", geo.tile_start(F.col("tile_w"), w, tile, overlap))


def split(images: DataFrame, tile: int = config.TILE, overlap: int = config.OVERLAP) -> DataFrame:
    """``TILE`` rows of images (path, height, width, channels, data); small images are padded by zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["data"] is None:
                    continue
                image = kernels.pad(pixels_of(row), tile)
                for th, sh in enumerate(kernels.starts(row["height"], tile, overlap)):
                    cut = [
                        {"path": row["path"], "height": row["height"], "width": row["width"], "tile_h": th, "tile_w": tw,
                         "start_h": sh, "start_w": sw, "data": image[sh : sh + tile, sw : sw + tile].tobytes(), "error": None}
                        for tw, sw in enumerate(kernels.starts(row["width"], tile, overlap))
                    ]
                    yield pa.RecordBatch.from_pylist(cut, _TILE)

    return images.select("path", "height", "width", "channels", "data").mapInArrow(run, TILE)


_TILE = pa.schema(
    [("path", pa.string()), *[(n, pa.int32()) for n in ("height", "width", "tile_h", "tile_w", "start_h", "start_w")], ("data", pa.binary()), ("error", pa.string())]
)


def upscaled(tiles: DataFrame, upscaler: Upscaler, scale: int, tile: int = config.TILE) -> DataFrame:
    """``TILE`` rows with upscaled pixels; starts stay those of the input. A tile that fails has no pixels but an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, errors = [], []
            for data in batch.column("data").to_pylist():
                values = np.frombuffer(data, np.uint8).reshape(tile, tile, 3).astype(np.float32) / np.float32(255)
                try:
                    big = np.asarray(upscaler(values, scale), np.float32)
                    if big.shape != (tile * scale, tile * scale, 3):
                        raise ValueError(f"an upscaled tile of shape {big.shape}")
                    out.append(big.tobytes())
                    errors.append(None)
                except Exception as error:  # noqa: BLE001
                    out.append(None)
                    errors.append(str(error) or type(error).__name__)
            columns = [batch.column(n) for n in _TILE.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary()), pa.array(errors, pa.string())], schema=_TILE)

    return tiles.mapInArrow(run, TILE)


def blended(tiles: DataFrame, scale: int, tile: int = config.TILE, overlap: int = config.OVERLAP) -> DataFrame:
    """(path, height, width, channels, strip, data, error): strips of the upscaled images, cropped and quantised.

    A strip is as high as the stride between tiles; a tile goes to the strips that it touches, so that a task holds the
    tiles of a strip, not those of an image. A strip with a tile that failed has no pixels. Values are cut to whole
    numbers, as everywhere; the 1e-7 before keeps those that are whole from falling to the number below in the division.
    """
    stride, big, shared = (tile - overlap) * scale, tile * scale, overlap * scale
    low, high = F.floor(F.col("start_h") / (tile - overlap)), F.floor((F.col("start_h") + tile - 1) / (tile - overlap))
    dealt = tiles.withColumn("strip", F.explode(F.sequence(low, high))).where(F.col("strip") * (tile - overlap) < F.col("height"))

    def blend(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        first = rows[0]
        height, width, strip = first["height"], first["width"], first["strip"]
        counts = [len(kernels.starts(n, tile, overlap)) for n in (height, width)]
        top, bottom = strip * stride, min((strip + 1) * stride, height * scale)
        error = next((r["error"] for r in rows if r["error"]), None)
        made = {"path": first["path"], "height": bottom - top, "width": width * scale, "channels": 3, "strip": strip, "data": None, "error": error}
        if error:
            return pa.Table.from_pylist([made], _STRIP)
        values, total = np.zeros((bottom - top, max(width, tile) * scale, 3)), np.zeros((bottom - top, max(width, tile) * scale, 1))
        for row in sorted(rows, key=lambda r: (r["tile_h"], r["tile_w"])):
            y, x = row["start_h"] * scale, row["start_w"] * scale
            wy = kernels.axis_weight(big, shared, row["tile_h"] == 0, row["tile_h"] == counts[0] - 1)
            wx = kernels.axis_weight(big, shared, row["tile_w"] == 0, row["tile_w"] == counts[1] - 1)
            a, b = max(top, y), min(bottom, y + big)
            if a >= b:
                continue
            part = np.frombuffer(row["data"], np.float32).reshape(big, big, 3)[a - y : b - y]
            w = (wy[a - y : b - y, None] * wx[None, :])[..., None]
            values[a - top : b - top, x : x + big] += part * w
            total[a - top : b - top, x : x + big] += w
        out = kernels.quantise((values / total)[:, : width * scale] + 1e-7)
        return pa.Table.from_pylist([made | {"data": out.tobytes()}], _STRIP)

    return dealt.groupBy("path", "strip").applyInArrow(blend, "path string, height int, width int, channels int, strip long, data binary, error string")


_IMAGE = [("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32())]
_STRIP = pa.schema([*_IMAGE, ("strip", pa.int64()), ("data", pa.binary()), ("error", pa.string())])


def assembled(strips: DataFrame) -> DataFrame:
    """Images of their uint8 strips: (path, height, width, channels, data, error); an image with a failed strip has no pixels."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("strip")
        error = next((e for e in table.column("error").to_pylist() if e), None)
        data = None if error else b"".join(table.column("data").to_pylist())
        row = {"path": table["path"][0].as_py(), "height": sum(table["height"].to_pylist()), "width": table["width"][0].as_py(), "channels": 3, "data": data, "error": error}
        return pa.Table.from_pylist([row], pa.schema([*_IMAGE, ("data", pa.binary()), ("error", pa.string())]))

    return strips.groupBy("path").applyInArrow(join, "path string, height int, width int, channels int, data binary, error string")


def superresolved(images: DataFrame, upscaler: Upscaler, scale: int = 2, tile: int = config.TILE, overlap: int = config.OVERLAP) -> DataFrame:
    """Images upscaled tile by tile; each side grows by exactly ``scale``."""
    config.Settings(scale, tile, overlap)
    return assembled(blended(upscaled(split(images, tile, overlap), upscaler, scale, tile), scale, tile, overlap))


def resized(images: DataFrame, kind: str = "lanczos") -> DataFrame:
    """Images brought to the columns target_height and target_width: (path, height, width, channels, data, error).

    An image without pixels stays one; one that fails has none but an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = (row["target_height"], row["target_width"])
                made = {"path": row["path"], "height": size[0], "width": size[1], "channels": 3, "data": None, "error": row["error"]}
                if row["data"] is not None:
                    try:
                        made["data"] = kernels.resize(pixels_of(row), size, kind).tobytes()
                    except Exception as error:  # noqa: BLE001
                        made["error"] = str(error) or type(error).__name__
                yield pa.RecordBatch.from_pylist([made], pa.schema([*_IMAGE, ("data", pa.binary()), ("error", pa.string())]))

    error = F.col("error") if "error" in images.columns else F.lit(None).cast("string").alias("error")
    columns = ("path", "height", "width", "channels", "data", "target_height", "target_width")
    return images.select(*columns, error).mapInArrow(run, "path string, height int, width int, channels int, data binary, error string")
