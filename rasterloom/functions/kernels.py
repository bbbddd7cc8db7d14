"""Image kernels in numpy: colour, masks, components, rectangles, matching, resizing, tiles. No Spark in here.

Images are uint8 arrays (height, width, 3) in the order blue, green, red unless said otherwise; masks are boolean.
"""

from __future__ import annotations

import functools
import struct
import zlib
from typing import NamedTuple

import numpy as np

from rasterloom import config


class Rect(NamedTuple):
    """A rotated rectangle; w and h are measured between pixel centres, angle is in degrees."""

    cx: float
    cy: float
    w: float
    h: float
    angle: float


class Region(NamedTuple):
    """A component as runs (row, first column, last column), in row order."""

    runs: np.ndarray

    def mask(self) -> tuple[np.ndarray, int, int]:
        """The component's pixels in its bounding box, with the box's top and left."""
        top, left = int(self.runs[0, 0]), int(self.runs[:, 1].min())
        shape = (int(self.runs[-1, 0]) - top + 1, int(self.runs[:, 2].max()) - left + 1)
        return _painted(self.runs - (top, left, left), 1, shape, np.int8).astype(bool), top, left


def gray(image: np.ndarray) -> np.ndarray:
    b, g, r = (image[..., c].astype(np.float64) for c in range(3))
    return np.floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5).astype(np.uint8)


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue in half degrees (0-179), saturation and value."""
    b, g, r = (image[..., c].astype(np.float64) for c in range(3))
    top = np.maximum(np.maximum(b, g), r)
    span = top - np.minimum(np.minimum(b, g), r)
    safe = np.where(span == 0, 1, span)
    angle = np.where(top == r, 60 * (g - b) / safe, np.where(top == g, 120 + 60 * (b - r) / safe, 240 + 60 * (r - g) / safe))
    angle = np.where(span == 0, 0, np.where(angle < 0, angle + 360, angle))
    saturation = np.where(top == 0, 0, np.floor(255 * span / np.where(top == 0, 1, top) + 0.5))
    return np.stack([np.floor(angle / 2 + 0.5) % 180, saturation, top], -1).astype(np.uint8)


def in_range(channels: np.ndarray, low: tuple, high: tuple) -> np.ndarray:
    return ((channels >= np.array(low)) & (channels <= np.array(high))).all(-1)


def regions(mask: np.ndarray, external: bool = True) -> list[Region]:
    """8-connected components, by their first pixel; with ``external`` only those not inside a hole of another."""
    runs = _runs(mask)
    parent = _joined(runs, mask.shape[0], 1)
    labels = np.array([_root(parent, i) for i in range(len(runs))], np.int64)
    if external and labels.any():  # a single component, whose label is 0, is inside no other
        labels = np.where(np.isin(labels, _outer(mask, runs, labels)), labels, -1)
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    return [Region(runs[part]) for part in np.split(order, cuts) if part.size and labels[part[0]] >= 0]


def _runs(mask: np.ndarray) -> np.ndarray:
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    y, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return np.stack([y, first, last - 1], 1) if y.size else np.empty((0, 3), np.int64)


def _painted(runs: np.ndarray, values: np.ndarray | int, shape: tuple[int, int], kind: type) -> np.ndarray:
    """An array with each run at its value, and zero elsewhere; runs of a row do not touch."""
    out = np.zeros((shape[0], shape[1] + 1), kind)
    out[runs[:, 0], runs[:, 1]] = values
    out[runs[:, 0], runs[:, 2] + 1] = -values
    return out.cumsum(1, dtype=kind)[:, :-1]


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _joined(runs: np.ndarray, height: int, reach: int) -> list[int]:
    """Union of runs that touch a run of the next row; ``reach`` 1 also joins diagonally."""
    parent = list(range(len(runs)))
    at = (np.searchsorted(runs[:, 0], np.arange(height + 1)) if len(runs) else np.zeros(height + 1, int)).tolist()
    rows = runs.tolist()
    for y in range(1, height):
        i, j, ends = at[y - 1], at[y], (at[y], at[y + 1])
        while i < ends[0] and j < ends[1]:
            if rows[i][1] <= rows[j][2] + reach and rows[j][1] <= rows[i][2] + reach:
                a, b = _root(parent, i), _root(parent, j)
                parent[max(a, b)] = min(a, b)
            if rows[i][2] < rows[j][2]:
                i += 1
            else:
                j += 1
    return parent


def _outer(mask: np.ndarray, runs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels of components that touch the background around everything."""
    ground = np.pad(~mask, 1, constant_values=True)
    back = _runs(ground)
    parent = _joined(back, ground.shape[0], 0)
    outside = np.array([_root(parent, i) == 0 for i in range(len(back))])
    around = _painted(back[outside], 1, ground.shape, np.int8).astype(bool)
    touch = np.zeros(ground.shape, bool)
    touch[1:-1, 1:-1] = around[:-2, 1:-1] | around[2:, 1:-1] | around[1:-1, :-2] | around[1:-1, 2:]
    label = _painted(runs, labels, mask.shape, np.int64)
    return np.unique(label[mask & touch[1:-1, 1:-1]])


_STEPS = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))


def contour(region: Region) -> np.ndarray:
    """The outer border's pixel centres (x, y) in order, by following it with the ground to the left."""
    mask, top, left = region.mask()
    mask = np.pad(mask, 1)
    width, filled = mask.shape[1], mask.tobytes()
    steps = [y * width + x for y, x in _STEPS]
    turns = [[((facing + 6 + turn) % 8, steps[(facing + 6 + turn) % 8]) for turn in range(8)] for facing in range(8)]
    start = filled.index(1)
    points, at, facing, first = [start], start, 6, None
    while True:
        for way, step in turns[facing]:
            if filled[at + step]:
                break
        else:
            break
        if at == start and first == way:
            points.pop()
            break
        first = way if first is None else first
        at, facing = at + step, way
        points.append(at)
    y, x = np.divmod(np.array(points), width)
    return np.stack([x - 1 + left, y - 1 + top], 1).astype(float)


def perimeter(points: np.ndarray) -> float:
    """Length of the closed polygon."""
    return float(np.sqrt(((np.roll(points, -1, 0) - points) ** 2).sum(1)).sum())


def area(points: np.ndarray) -> float:
    x, y = points[:, 0], points[:, 1]
    return float(abs((x * np.roll(y, -1) - y * np.roll(x, -1)).sum()) / 2)


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, by monotone chains."""
    ordered = points[np.lexsort((points[:, 1], points[:, 0]))]
    new = (ordered[1:] != ordered[:-1]).any(1)
    ordered = ordered[np.append(True, new)]
    if len(ordered) < 3:
        return ordered
    ends = ordered[1:, 0] != ordered[:-1, 0]  # of the points at an x, only the first and the last can be corners
    ordered = ordered[np.append(True, ends) | np.append(ends, True)].tolist()

    def half(rows: list) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    return np.array(half(ordered)[:-1] + half(ordered[::-1])[:-1])


def min_area_rect(points: np.ndarray) -> Rect:
    """The smallest rectangle around the points: one of its sides lies on a side of the hull."""
    corners = hull(points)
    sides = np.roll(corners, -1, 0) - corners
    sides = sides[(sides != 0).any(1)]
    if not len(sides):
        return Rect(float(corners[0, 0]), float(corners[0, 1]), 0.0, 0.0, 0.0)
    u = sides / np.sqrt((sides**2).sum(1, keepdims=True))
    along, across = corners @ u.T, corners @ np.stack([-u[:, 1], u[:, 0]])
    w, h = np.ptp(along, 0), np.ptp(across, 0)
    k = int((w * h).argmin())
    mid_a, mid_b = (along[:, k].max() + along[:, k].min()) / 2, (across[:, k].max() + across[:, k].min()) / 2
    centre = mid_a * u[k] + mid_b * np.array([-u[k, 1], u[k, 0]])
    return Rect(float(centre[0]), float(centre[1]), float(w[k]), float(h[k]), float(np.degrees(np.arctan2(u[k, 1], u[k, 0])) % 180))


def corners(rect: Rect) -> np.ndarray:
    """The rectangle's four corners (x, y), in order."""
    turn = np.radians(rect.angle)
    u, v = np.array([np.cos(turn), np.sin(turn)]), np.array([-np.sin(turn), np.cos(turn)])
    signs = ((-1, -1), (1, -1), (1, 1), (-1, 1))
    return np.array([np.array([rect.cx, rect.cy]) + a * rect.w / 2 * u + b * rect.h / 2 * v for a, b in signs])


def outlined(image: np.ndarray, rect: Rect, colour: tuple[int, int, int] = (0, 255, 0)) -> np.ndarray:
    """A copy of the image with the rectangle's sides drawn; what lies beyond the image is left out."""
    out, points = image.copy(), corners(rect)
    for a, b in zip(points, np.roll(points, -1, 0), strict=True):
        steps = int(np.abs(b - a).max()) + 2
        x, y = np.rint(np.linspace(a, b, steps)).astype(int).T
        inside = (x >= 0) & (y >= 0) & (x < image.shape[1]) & (y < image.shape[0])
        out[y[inside], x[inside]] = colour
    return out


def ruler_rect(mask: np.ndarray, min_perimeter=config.MIN_PERIMETER, min_area=config.MIN_AREA) -> Rect | None:
    """The largest external component that is long enough, the first of equals."""
    best = None
    for region in regions(mask):
        outline = contour(region)
        if perimeter(outline) < min_perimeter:
            continue
        rect = min_area_rect(outline)
        short, size = min(rect.w, rect.h), rect.w * rect.h
        if size < min_area or short == 0 or max(rect.w, rect.h) / short < config.MIN_ASPECT:
            continue
        if best is None or size > best.w * best.h:
            best = rect
    return best


def largest_rect(mask: np.ndarray) -> Rect | None:
    """The rectangle around the component with the largest contour area, the first of equals."""
    outlines = [contour(r) for r in regions(mask)]
    return min_area_rect(max(outlines, key=area)) if outlines else None


def measure_ruler(image: np.ndarray) -> Rect | None:
    return ruler_rect(in_range(hsv(image), config.GRAY_LOW, config.GRAY_HIGH))


def measure_page(image: np.ndarray, level: int = config.GRAY_THRESHOLD) -> Rect | None:
    return largest_rect(gray(image) > level)


def match(image: np.ndarray, template: np.ndarray) -> tuple[float, int, int]:
    """Best zero-mean normalised correlation and its place (x, y), of gray arrays; flat places score 0."""
    return Scene(image).match(template)


def ncc(image: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Zero-mean normalised cross-correlation at every offset."""
    return Scene(image).ncc(template)


#: Spectra of templates are remembered up to so many numbers each.
_SMALL_SPECTRUM = 1 << 15


def _smooth(size: int) -> int:
    """The least number from ``size`` on without a prime factor beyond 5, for which transforms are fast."""
    while True:
        rest = size
        for p in (2, 3, 5):
            while rest % p == 0:
                rest //= p
        if rest == 1:
            return size
        size += 1


class Scene:
    """A gray array that templates are looked for in, through transforms and running sums (Lewis, 1995).

    The transform and the sums of the array serve all templates. Offsets where a template fits do not wrap around, so
    the transform is hardly larger than the array.
    """

    def __init__(self, image: np.ndarray) -> None:
        p = image.astype(np.float64)
        self.size = p.shape
        self.shape = tuple(map(_smooth, p.shape))
        self.spectrum = np.fft.rfft2(p, self.shape)
        self.sums = [np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (p, p * p)]

    def ncc(self, template: np.ndarray) -> np.ndarray:
        """Zero-mean normalised cross-correlation at every offset."""
        h, w = template.shape
        small = self.spectrum.size <= _SMALL_SPECTRUM
        arguments = (template.tobytes(), template.dtype.str, template.shape, self.shape)
        other, norm = _kept_spectrum(*arguments) if small else _spectrum(*arguments)
        product = np.fft.irfft2(self.spectrum * other, self.shape)
        top = product[: self.size[0] - h + 1, : self.size[1] - w + 1]
        sum_p, sum_pp = (s[h:, w:] - s[:-h, w:] - s[h:, :-w] + s[:-h, :-w] for s in self.sums)
        spread = sum_pp - sum_p**2 / (h * w)
        norm = np.sqrt(np.maximum(spread, 0) * norm)
        return np.where(norm > 1e-6, top / np.where(norm > 1e-6, norm, 1), 0.0)

    def match(self, template: np.ndarray) -> tuple[float, int, int]:
        """The best correlation and its place (x, y)."""
        scores = self.ncc(template)
        y, x = np.unravel_index(int(scores.argmax()), scores.shape)
        return float(scores[y, x]), int(x), int(y)


def _spectrum(data: bytes, kind: str, size: tuple[int, int], shape: tuple[int, int]) -> tuple[np.ndarray, float]:
    """The conjugate transform of a template less its mean, and the sum of its squares."""
    t = np.frombuffer(data, kind).reshape(size).astype(np.float64)
    t = t - t.mean()
    return np.fft.rfft2(t, shape).conj(), float((t * t).sum())


_kept_spectrum = functools.lru_cache(64)(_spectrum)


def detect_adaptive(image: np.ndarray) -> Rect | None:
    """The ruler by bounds around the image's mean hue, saturation and value."""
    channels = hsv(image)
    mean = channels.reshape(-1, 3).mean(0)
    low = [int(max(0, m - s)) for m, s in zip(mean, config.HSV_SPREAD, strict=True)]
    high = [int(min(top, m + s)) for m, s, top in zip(mean, config.HSV_SPREAD, config.HSV_TOP, strict=True)]
    return ruler_rect(in_range(channels, tuple(low), tuple(high)))


def _region_of(image: np.ndarray, template: np.ndarray) -> tuple[np.ndarray, int, int] | None:
    if any(a < b for a, b in zip(image.shape, template.shape)):
        return None
    score, x, y = match(gray(image), template)
    if score < config.MIN_MATCH:
        return None
    return image[y : y + template.shape[0], x : x + template.shape[1]], x, y


def detect_in_region(image: np.ndarray, template: np.ndarray) -> Rect | None:
    """The ruler inside the template's best place, in coordinates of the image."""
    found = _region_of(image, template)
    if found is None:
        return None
    region, x, y = found
    mask = in_range(hsv(region), config.GRAY_LOW, config.GRAY_HIGH)
    rect = ruler_rect(mask, config.ROI_MIN_PERIMETER, config.ROI_MIN_AREA)
    return rect and rect._replace(cx=rect.cx + x, cy=rect.cy + y)


def detect_multiscale(image: np.ndarray, template: np.ndarray, scales=config.TEMPLATE_SCALES) -> Rect | None:
    """The place where the template, at the best of several scales, matches; the first scale of equals."""
    plain, best = gray(image), None
    scene = Scene(plain)
    for scale in scales:
        size = (int(template.shape[0] * scale), int(template.shape[1] * scale))
        if min(size) < 10 or size[0] > plain.shape[0] or size[1] > plain.shape[1]:
            continue
        score, x, y = scene.match(_scaled(template.tobytes(), template.dtype.str, template.shape, size))
        if best is None or score > best[0]:
            best = (score, Rect(x + size[1] / 2, y + size[0] / 2, float(size[1]), float(size[0]), 0.0))
    return best[1] if best and best[0] >= config.MIN_MATCH else None


@functools.lru_cache(64)
def _scaled(data: bytes, kind: str, shape: tuple[int, int], size: tuple[int, int]) -> np.ndarray:
    """A gray template at another size."""
    return resize(np.frombuffer(data, kind).reshape(shape)[..., None], size, "area")[..., 0]


def detect_by_gray(image: np.ndarray, template: np.ndarray) -> Rect | None:
    """What has the gray of the template's best place, taken over its pixels of low saturation."""
    found = _region_of(image, template)
    if found is None:
        return None
    inside = in_range(hsv(found[0]), config.LOW_SATURATION_LOW, config.LOW_SATURATION_HIGH)
    if not inside.any():
        return None
    target = found[0][inside].mean(0).astype(np.uint8).astype(np.float64)
    away = np.sqrt(((image.astype(np.float64) - target) ** 2).sum(-1))
    return largest_rect(away < config.SEGMENT_DISTANCE)


def _lanczos(x: np.ndarray, support: float = 3.0) -> np.ndarray:
    return np.where(np.abs(x) < support, np.sinc(x) * np.sinc(x / support), 0.0)


def weights(size: int, target: int, kind: str) -> np.ndarray:
    """(target, size) resampling weights along one axis: "lanczos", "area", "bicubic" or "nearest"."""
    ratio = size / target
    centre = (np.arange(target) + 0.5) * ratio
    pixel = np.arange(size) + 0.5
    if kind == "nearest":
        out = np.zeros((target, size))
        out[np.arange(target), np.minimum(centre.astype(int), size - 1)] = 1
        return out
    if kind == "area":
        low, high = np.arange(target)[:, None] * ratio, (np.arange(target)[:, None] + 1) * ratio
        out = np.clip(np.minimum(high, pixel + 0.5) - np.maximum(low, pixel - 0.5), 0, None)
    else:
        x = (pixel[None, :] - centre[:, None]) / max(ratio, 1.0)
        if kind == "lanczos":
            out = _lanczos(x)
        else:
            a, t = -0.5, np.abs(x)
            out = np.where(t < 1, (a + 2) * t**3 - (a + 3) * t**2 + 1, np.where(t < 2, a * t**3 - 5 * a * t**2 + 8 * a * t - 4 * a, 0))
    return out / out.sum(1, keepdims=True)


def resize(image: np.ndarray, size: tuple[int, int], kind: str = "lanczos") -> np.ndarray:
    """Separable resampling of (height, width, channels) to ``size`` (height, width), rounded and clipped."""
    if min(size) < 1:
        raise ValueError("a target side is below one pixel")
    out = image.astype(np.float64)
    for axis in (0, 1):
        if out.shape[axis] != size[axis]:
            out = np.moveaxis(np.tensordot(weights(out.shape[axis], size[axis], kind), out, (1, axis)), 0, axis)
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def pad(image: np.ndarray, tile: int) -> np.ndarray:
    """Zeros to the right and below, up to one tile."""
    if image.ndim != 3:
        raise ValueError("an image has height, width and channels")
    return np.pad(image, ((0, max(0, tile - image.shape[0])), (0, max(0, tile - image.shape[1])), (0, 0)))


def starts(size: int, tile: int, overlap: int) -> list[int]:
    """Where tiles start along an axis; the last one ends with the axis."""
    size = max(size, tile)
    count = -(-(size - overlap) // (tile - overlap))
    return [min(i * (tile - overlap), size - tile) for i in range(count)]


def axis_weight(length: int, overlap: int, first: bool, last: bool) -> np.ndarray:
    """A tile's blending weight along one axis: triangles over the overlaps it shares, 1 elsewhere."""
    out = np.ones(length)
    x = np.arange(overlap)
    ramp = np.minimum(x / overlap, (overlap - x) / overlap)
    if not first:
        out[:overlap] *= ramp
    if not last:
        out[-overlap:] *= ramp[::-1]
    return out


def quantise(values: np.ndarray) -> np.ndarray:
    return np.clip(values * 255.0, 0, 255).astype(np.uint8)


def encode_png(image: np.ndarray, ppi: int | None = None) -> bytes:
    """A PNG file of (height, width, 3) in the order red, green, blue."""
    rows = np.ascontiguousarray(image, np.uint8)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    out = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", rows.shape[1], rows.shape[0], 8, 2, 0, 0, 0))
    if ppi:
        metre = round(ppi / 0.0254)
        out += chunk(b"pHYs", struct.pack(">IIB", metre, metre, 1))
    raw = b"".join(b"\0" + row.tobytes() for row in rows)
    return out + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")
