"""Fixed values of the scan calibration and of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

MM_PER_INCH = 25.4
RULER_MM = 200.0
TARGET_RULER_MM = 200.0
A4_SHORT_MM, A4_LONG_MM = 210.0, 297.0
MIN_FILE_BYTES = 10_000
GRAY_THRESHOLD = 50
MIN_PERIMETER, MIN_AREA, MIN_ASPECT = 200.0, 1000.0, 3.0
ROI_MIN_PERIMETER, ROI_MIN_AREA = 100.0, 300.0
MIN_MATCH = 0.6
TEMPLATE_SCALES = (0.5, 0.75, 1.0, 1.25, 1.5)
#: Hue, saturation and value bounds of the ruler's gray, inclusive.
GRAY_LOW, GRAY_HIGH = (0, 0, 40), (180, 50, 100)
LOW_SATURATION_LOW, LOW_SATURATION_HIGH = (0, 0, 30), (180, 40, 255)
HSV_SPREAD = (20, 30, 40)
HSV_TOP = (180, 255, 255)
SEGMENT_DISTANCE = 30.0
TILE, OVERLAP = 128, 32
EARLY_STOP_S = 60.0
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".tiff")
#: Files among the scans that are no raster images unless they decode as one.
DOCUMENT_SUFFIXES = (".pdf", ".svg")


@dataclass(frozen=True)
class Calibration:
    """What a ruler band measures at a resolution, and the correction of its scale."""

    ppi: int
    width_pixel: float
    width_mm: float
    height_pixel: float
    height_mm: float
    correction_factor: float


CALIBRATIONS = (
    Calibration(400, 2095.8, 133.1, 627.0, 39.8, 400 / 393),
    Calibration(600, 2970.0, 125.7, 881.8, 37.3, 600 / 586),
)


@dataclass(frozen=True)
class Settings:
    """A run's settings; the upscaling factor is 2, 3 or 4."""

    scale: int = 2
    tile: int = TILE
    overlap: int = OVERLAP

    def __post_init__(self) -> None:
        if self.scale not in (2, 3, 4):
            raise ValueError("scale must be 2, 3 or 4")
        if not 0 < self.overlap < self.tile or self.overlap * self.scale < 2:
            raise ValueError("overlap must be positive, below the tile, and two output pixels at least")

    def outputs(self, root: str) -> tuple[str, str]:
        """The folders of upscaled and of finished images below ``root``."""
        return f"{root.rstrip('/')}/sr_x{self.scale}", f"{root.rstrip('/')}/downscaled_x{self.scale}"
