"""Image kernels on drawn images, and their properties."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rasterloom import config
from rasterloom.functions import kernels


def drawn(height, width, rect, value, ground=0, angle=0.0):
    """A gray rectangle (cx, cy, w, h), turned by an angle, on a plain ground."""
    cx, cy, w, h = rect
    y, x = np.mgrid[0:height, 0:width]
    a = np.radians(angle)
    u, v = (x - cx) * np.cos(a) + (y - cy) * np.sin(a), -(x - cx) * np.sin(a) + (y - cy) * np.cos(a)
    out = np.full((height, width, 3), ground, np.uint8)
    out[(np.abs(u) <= w / 2) & (np.abs(v) <= h / 2)] = value
    return out


@pytest.mark.parametrize("angle", [0, 13, 45, 90])
def test_ruler_and_page_sides(angle):
    rect = kernels.measure_ruler(drawn(400, 400, (200, 190, 240, 50), 70, 200, angle))
    assert max(rect.w, rect.h) == pytest.approx(240, abs=2) and min(rect.w, rect.h) == pytest.approx(50, abs=2)
    assert (rect.cx, rect.cy) == pytest.approx((200, 190), abs=1)
    page = kernels.measure_page(drawn(400, 400, (200, 190, 200, 140), 220, 10, angle))
    assert max(page.w, page.h) == pytest.approx(200, abs=2) and min(page.w, page.h) == pytest.approx(140, abs=2)


def test_nothing_to_measure():
    black = np.zeros((50, 60, 3), np.uint8)
    assert kernels.measure_page(black) is None and kernels.measure_ruler(black) is None
    assert kernels.measure_ruler(drawn(200, 200, (100, 100, 60, 60), 70, 200)) is None  # not long enough for its width


def test_inner_components_are_not_external():
    mask = np.zeros((30, 30), bool)
    mask[5:25, 5:25] = True
    mask[8:22, 8:22] = False
    mask[12:15, 12:15] = True
    assert len(kernels.regions(mask, external=False)) == 2 and len(kernels.regions(mask)) == 1
    outline = kernels.contour(kernels.regions(mask)[0])
    assert kernels.perimeter(outline) == 76 and kernels.area(outline) == 19 * 19


def brute_components(mask):
    left, count = set(zip(*np.nonzero(mask))), 0
    while left:
        queue = [left.pop()]
        count += 1
        while queue:
            y, x = queue.pop()
            near = {(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)} & left
            left -= near
            queue.extend(near)
    return count


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 14), st.integers(1, 14))
def test_components_and_contours(seed, height, width):
    mask = np.random.default_rng(seed).random((height, width)) < 0.45
    found = kernels.regions(mask, external=False)
    assert len(found) == brute_components(mask)
    total = np.zeros_like(mask)
    for region in found:
        part, top, left = region.mask()
        total[top : top + part.shape[0], left : left + part.shape[1]] |= part
        outline = kernels.contour(region)
        steps = np.abs(np.roll(outline, -1, 0) - outline).max(1)
        assert (steps <= 1).all()
        rect = kernels.min_area_rect(outline)
        y, x = np.nonzero(part)
        assert rect.w * rect.h <= (np.ptp(x) + 1e-9) * (np.ptp(y) + 1e-9) + 1e-6
        assert outline[:, 0].min() == x.min() + left and outline[:, 1].max() == y.max() + top
    assert (total == mask).all()


def test_colours():
    image = np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [128, 128, 128], [0, 0, 0], [0, 255, 255]]], np.uint8)
    assert kernels.hsv(image)[0].tolist() == [[120, 255, 255], [60, 255, 255], [0, 255, 255], [0, 0, 128], [0, 0, 0], [30, 255, 255]]
    assert kernels.gray(image)[0].tolist() == [29, 150, 76, 128, 0, 226]


def test_correlation_is_the_definition():
    rng = np.random.default_rng(0)
    image, template = rng.integers(0, 256, (20, 17)), rng.integers(0, 256, (5, 4))
    found = kernels.ncc(image, template)
    for y in range(16):
        for x in range(14):
            assert found[y, x] == pytest.approx(np.corrcoef(image[y : y + 5, x : x + 4].ravel(), template.ravel())[0, 1], abs=1e-8)
    assert kernels.match(image, image[3:8, 6:10])[1:] == (6, 3)


def scene():
    """A textured page with the ruler's template pasted in."""
    rng = np.random.default_rng(1)
    template = np.full((70, 260), 230, np.uint8)
    template[10:60, 10:250] = 70
    template[20:30, 20:240:8] = 85
    image = rng.integers(150, 250, (300, 420, 3)).astype(np.uint8)
    image[100:170, 90:350] = template[..., None]
    return image, template


def test_detectors():
    image, template = scene()
    inside = kernels.detect_in_region(image, template)
    assert (inside.cx, inside.cy) == pytest.approx((90 + 129.5, 100 + 34.5), abs=2) and max(inside.w, inside.h) == pytest.approx(239, abs=2)
    found = kernels.detect_multiscale(image, template)
    assert (found.cx, found.cy, found.w, found.h) == (220, 135, 260, 70)
    half = kernels.resize(image, (150, 210), "area")
    assert kernels.detect_multiscale(half, template).w == 130
    even = np.clip(template, 70, 90)
    plain = image.copy()
    plain[100:170, 90:350] = even[..., None]
    by_gray = kernels.detect_by_gray(plain, even)
    assert (by_gray.cx, by_gray.cy) == pytest.approx((90 + 129.5, 100 + 34.5), abs=1) and max(by_gray.w, by_gray.h) == 259
    noise = np.random.default_rng(2).integers(0, 256, (300, 420, 3)).astype(np.uint8)
    for kernel in (kernels.detect_in_region, kernels.detect_multiscale, kernels.detect_by_gray):
        assert kernel(noise, template) is None and kernel(image[:20, :20], template) is None
    adaptive = kernels.detect_adaptive(drawn(300, 400, (200, 150, 300, 60), 120, 20))
    assert adaptive is None or adaptive.w > 0


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 900), st.integers(2, 4))
def test_tiles_cover_and_weights_are_positive(size, scale):
    tile, overlap = config.TILE, config.OVERLAP
    at = kernels.starts(size, tile, overlap)
    assert len(at) == max(1, -(-(max(size, tile) - overlap) // (tile - overlap))) and at[-1] == max(size, tile) - tile
    total = np.zeros(max(size, tile) * scale)
    for i, s in enumerate(at):
        total[s * scale : (s + tile) * scale] += kernels.axis_weight(tile * scale, overlap * scale, i == 0, i == len(at) - 1)
    assert total.min() > 0


def test_resize():
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (40, 30, 3)).astype(np.uint8)
    for kind in ("lanczos", "area", "bicubic", "nearest"):
        assert (kernels.resize(image, (40, 30), kind) == image).all()
        assert (kernels.resize(np.full_like(image, 93), (17, 51), kind) == 93).all()
        assert kernels.weights(50, 20, kind).sum(1) == pytest.approx(np.ones(20))
    assert kernels.resize(image, (20, 15), "area")[0, 0, 0] == np.floor(image[:2, :2, 0].mean() + 0.5)
    with pytest.raises(ValueError):
        kernels.resize(image, (0, 5))


def test_settings():
    with pytest.raises(ValueError):
        config.Settings(scale=5)
    with pytest.raises(ValueError):
        config.Settings(tile=4, overlap=4)
    with pytest.raises(ValueError):
        kernels.pad(np.zeros((3, 3), np.uint8), 4)


def test_a_single_component_needs_no_search_for_holes(monkeypatch):
    monkeypatch.setattr(kernels, "_outer", lambda *_: pytest.fail("the ground was searched"))
    image = drawn(90, 80, (40, 45, 30, 60), 200)
    assert kernels.measure_page(image) == kernels.Rect(40.0, 45.0, 30.0, 60.0, 0.0)


@pytest.fixture
def transforms(monkeypatch):
    """The shapes of the transforms made from now on."""
    found, plain = [], np.fft.rfft2
    monkeypatch.setattr(np.fft, "rfft2", lambda a, s: (found.append(tuple(s)), plain(a, s))[1])
    return found


def test_scales_share_the_transform_of_the_image(transforms):
    image, template = scene()
    first = kernels.detect_multiscale(image, template)
    transforms.clear()
    assert kernels.detect_multiscale(image, template) == first and len(transforms) <= 1 + 5
    small = kernels.resize(image, (75, 105)), kernels.resize(template[..., None], (17, 65), "area")[..., 0]
    kernels.detect_multiscale(*small)
    transforms.clear()
    kernels.detect_multiscale(*small)
    assert len(transforms) == 1


def test_the_transform_of_a_template_is_kept(transforms):
    image = np.random.default_rng(2).integers(0, 256, (60, 140, 3)).astype(np.uint8)
    template = kernels.gray(image)[20:40, 30:110].copy()
    kernels.detect_in_region(image, template)
    transforms.clear()
    kernels.detect_in_region(image, template)
    assert len(transforms) == 1


def test_transforms_are_hardly_larger_than_the_image(transforms):
    image, template = scene()
    kernels.detect_by_gray(image, template)
    assert transforms and all(a <= 1.2 * b for s in transforms for a, b in zip(s, image.shape))
