"""The job over a folder tree: outputs, validation, log, resume, attempts, configurations, command line."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom import __main__ as command
from rasterloom import config
from rasterloom.functions import kernels
from rasterloom.operators import images as image_operators
from rasterloom.operators import relational as rel
from rasterloom.operators import tiles
from rasterloom.plans import job, pipeline, tuning
from rasterloom.sources import files as sources
from rasterloom.sources import logs
from test_image_plans import noisy, save
from test_kernels import drawn, scene


@pytest.fixture
def scans(tmp_path):
    root = str(tmp_path / "scans")
    page, ruler = drawn(260, 300, (150, 130, 150, 110), 220, 10), drawn(260, 300, (150, 130, 200, 50), 70, 200)
    for k in range(3):
        save(f"{root}/a/p{k}.png", noisy(page))
    save(f"{root}/a/z_ruler.png", noisy(ruler))
    whole = open(f"{root}/a/p0.png", "rb").read()
    with open(f"{root}/a/cut.png", "wb") as file:
        file.write(whole[: len(whole) // 2])
    with open(f"{root}/a/head.png", "wb") as file:
        file.write(whole[:18] + b"\xff" + whole[19:])
    with open(f"{root}/a/junk.png", "wb") as file:
        file.write(b"junk" * 5000)
    return root


def test_job_writes_validates_and_resumes(spark, scans, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    totals = job.process(spark, scans, out, log).collect()
    assert [(r.n, r.errors, r.success) for r in totals] == [(7, 3, 4)]
    big, final = config.Settings().outputs(out)
    assert big.endswith("sr_x2") and final.endswith("downscaled_x2")
    for folder in (big, final):
        assert sorted(os.listdir(f"{folder}/a")) == ["p0.png", "p1.png", "p2.png", "z_ruler.png"]
    sizes = {r.path.rsplit("/", 1)[-1]: (r.height, r.width) for r in sources.images(spark, big).collect()}
    assert sizes["p0.png"] == (520, 600)
    rows = {r.filename: (r.step, r.error) for r in logs.read_failures(spark, log).collect()}
    assert rows == {
        "cut.png": ("super_resolution", "Input image invalid: [LOAD FAIL]"),
        "head.png": ("super_resolution", "Input image invalid: [VERIFY FAIL]"),
        "junk.png": ("super_resolution", "Input image invalid: [OPEN FAIL]"),
    }
    os.remove(f"{final}/a/p1.png")
    again = job.process(spark, scans, out, log).collect()
    assert [(r.n, r.errors, r.success) for r in again] == [(4, 3, 1)] and os.path.exists(f"{final}/a/p1.png")


def test_failing_upscaler_is_a_failure_of_its_step(spark, scans, tmp_path):
    def failing(tile, scale):
        raise RuntimeError("out of memory")

    for upscaler, error in ((failing, "out of memory"), (lambda tile, scale: tile, "an upscaled tile of shape (128, 128, 3)")):
        log = str(tmp_path / error[:3])
        totals = job.process(spark, scans, str(tmp_path / "out"), log, upscaler).collect()
        assert [(r.n, r.errors, r.success) for r in totals] == [(7, 7, 0)]
        steps = {(r.step, r.error) for r in logs.read_failures(spark, log).collect() if r.filename.startswith("p")}
        assert steps == {("super_resolution", f"Errore super_resolution: {error}")}


def test_outputs_are_validated(spark, tmp_path, scans, monkeypatch):
    """Outputs below the least size fail their validation, the first one's step being named."""
    monkeypatch.setattr(config, "MIN_FILE_BYTES", 10_000)
    encode = kernels.encode_png
    flat = np.zeros((4, 4, 3), np.uint8)
    save(str(tmp_path / "sr/a/x.png"), flat)
    rows = spark.createDataFrame([("in/a/x.png", 100, None, "in/a/x.png", "a/x.png")], "path string, bytes long, error string, input string, relative_path string")
    found = job._states(spark, {"super_resolution": rows}, {"super_resolution": str(tmp_path / "sr")}).collect()
    assert [(r.input, r.failed_step, r.error) for r in found] == [("in/a/x.png", "validate_super_resolution", "file too small")]
    assert encode(flat).startswith(b"\x89PNG")


def test_one_image_scan(spark, scans):
    """Files are decoded once: all that follows reads the table of decoded images."""
    result = pipeline.run(spark, scans)
    for frame in (result.images, result.upscaled, result.failures, result.totals):
        assert "image" not in {word.lower() for line in frame._jdf.queryExecution().executedPlan().toString().split("\n") for word in line.split() if "FileScan" in line}


def test_attempts():
    asked = []

    def run(first):
        asked.append(first)
        if len(asked) < 3:
            raise OSError("busy")
        return "done"

    assert job.attempts(run, 5, 0) == "done" and asked == [True, False, False]
    with pytest.raises(OSError):
        job.attempts(lambda first: (_ for _ in ()).throw(OSError("busy")), 2, 0)


def test_benchmark_and_command(spark, scans, tmp_path, monkeypatch):
    monkeypatch.setattr(tuning, "GRID", {"device": ["CPU"], "processes": [1, 2], "threads": [1]})
    out = str(tmp_path / "cli")
    monkeypatch.setattr(SparkSessionStub, "found", spark)
    monkeypatch.setattr(command, "SparkSession", SparkSessionStub)
    assert command.main([scans, out, "--pause", "0", "--attempts", "1"]) == 0
    assert logs.read_benchmarks(spark, f"{out}/benchmark_log").count() == 2
    assert logs.read_best(spark, f"{out}/best_configuration").count() == 1
    assert sorted(os.listdir(f"{out}/downscaled_x2/a")) == ["p0.png", "p1.png", "p2.png", "z_ruler.png"]
    assert command.main([f"{scans}/none", out, "--pause", "0", "--attempts", "2"]) == 1
    crash = logs.read_failures(spark, f"{out}/processing_log").where("filename = 'CRASH'").first()
    assert crash.step == "CRASH" and crash.error.startswith(f"Unexpected error with {scans}/none") and crash.full_path is None
    assert command.main([f"{scans}/a", f"{out}/big", "--upscale-only", "--scale", "3"]) == 0
    assert sorted(os.listdir(f"{out}/big")) == ["p0_x3.png", "p1_x3.png", "p2_x3.png", "z_ruler_x3.png"]


def test_progress_is_reported(spark):
    seen = []
    with job.progress(spark, lambda done, tasks: seen.append((done, tasks)), 0.05):
        spark.sparkContext.parallelize(range(4), 4).map(lambda _: time.sleep(0.3)).count()
    assert any(tasks == 4 for _, tasks in seen) and all(done <= tasks for done, tasks in seen)


def test_overlays(spark):
    image = drawn(100, 120, (60, 50, 60, 40), 220, 10)
    df = spark.createDataFrame([("a", 100, 120, 3, bytearray(image.tobytes())), ("b", None, None, None, None)], "path string, height int, width int, channels int, data binary")
    found = {r.path: r for r in image_operators.overlays(df, kernels.measure_page).collect()}
    got = np.frombuffer(found["a"].data, np.uint8).reshape(100, 120, 3)
    rect = kernels.measure_page(image)
    changed = np.argwhere((got != image).any(-1))[:, ::-1]
    assert found["b"].data is None and len(changed) > 100
    assert (got[tuple(np.rint(kernels.corners(rect)).astype(int)[:, ::-1].T)] == (0, 255, 0)).all()
    assert np.abs(changed - [rect.cx, rect.cy]).max() <= max(rect.w, rect.h) / 2 + 1


class SparkSessionStub:
    found = None

    class builder:
        @staticmethod
        def appName(name):
            return SparkSessionStub.builder

        @staticmethod
        def getOrCreate():
            return SparkSessionStub.found


def test_template_search_over_scales(spark, tmp_path):
    image, template = scene()
    rows = [("a", *image.shape, bytearray(image.tobytes())), ("b", 12, 12, 3, bytearray(12 * 12 * 3)), ("c", None, None, None, None)]
    df = spark.createDataFrame(rows, "path string, height int, width int, channels int, data binary")
    scores = image_operators.matched_scales(df, kernels.gray(template) if template.ndim == 3 else template)
    best = {r.path: r for r in image_operators.best_match(scores).collect()}
    want = kernels.detect_multiscale(image, kernels.gray(template) if template.ndim == 3 else template)
    assert set(best) == {"a"} and (best["a"].width, best["a"].height) == (want.w, want.h)
    save(str(tmp_path / "t/ruler.png"), image)
    assert (image_operators.gray_template(sources.images(spark, str(tmp_path / "t"))) == kernels.gray(image)).all()
    with pytest.raises(FileNotFoundError):
        image_operators.gray_template(df.where("path = 'c'"))
    assert (kernels.gray(image_operators.to_bgr(np.arange(6, dtype=np.uint8).reshape(2, 3))) == np.arange(6).reshape(2, 3)).all()


def test_small_operators(spark):
    df = spark.createDataFrame([("a", 2, True), ("a", 1, True), ("b", 3, None), (None, 4, False)], "g string, n long, ok boolean")
    assert {(r.g, r.n, r.passed) for r in rel.all_passed(df, "g", df.ok).collect()} == {("a", 2, True), ("b", 1, False), (None, 1, False)}
    assert [r.n for r in rel.first_rows(df, 2, "n").collect()] == [1, 2]
    lists = {(r.g, r.part): list(r["items"]) for r in rel.listed(df, "g", "n", 1).collect()}
    assert lists == {("a", 0): [1], ("a", 1): [2], ("b", 0): [3], (None, 0): [4]}
    names = spark.createDataFrame([("x", f"f{i:03}") for i in range(300)], "g string, name string")
    placed = rel.positions(names, "g", ["name"])
    assert all(r.name == f"f{r.pos:03}" and r.group_size == 300 for r in placed.collect())
    assert len(rel._cuts(names, "name")) > 30
    scaled = spark.createDataFrame([("a.png",), ("b",)], "name string").select(sources.scaled_name(F.col("name"), 2).alias("n"))
    assert [r.n for r in scaled.collect()] == ["a_x2.png", "b_x2"]


def test_log_is_rewritten_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("2024-01-02 00:00:00", "b"), ("2024-01-01 00:00:00", "CRASH"), ("2024-01-01 00:00:00", "a")]
    from rasterloom import schema

    df = spark.createDataFrame([(t, f, "run", "false", "x", None) for t, f in rows], schema.FAILURE_LOG).repartition(3)
    logs.append_failures(df, path, True)
    logs.rewrite_sorted(spark, path, True)
    assert [r.filename for r in spark.read.csv(path, header=True).coalesce(1).collect()] == ["a", "b", "CRASH"]


def field(number, value):
    """One field of a protocol buffer: a whole number, or bytes."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def doubling_model():
    """A model file that repeats each pixel twice along both axes."""
    value = lambda name: field(1, name) + field(2, field(1, field(1, 1) + field(2, b"".join(field(1, field(2, c)) for c in (b"n", b"c", b"h", b"w")))))
    scales = field(1, 4) + field(2, 1) + field(8, b"scales") + field(9, np.array([1, 1, 2, 2], "<f4").tobytes())
    text = lambda name, s: field(5, field(1, name) + field(4, s) + field(20, 3))
    node = field(1, b"x") + field(1, b"") + field(1, b"scales") + field(2, b"y") + field(4, b"Resize")
    node += text(b"mode", b"nearest") + text(b"coordinate_transformation_mode", b"asymmetric") + text(b"nearest_mode", b"floor")
    graph = field(1, node) + field(2, b"g") + field(5, scales) + field(11, value(b"x")) + field(12, value(b"y"))
    return field(1, 8) + field(8, field(1, b"") + field(2, 13)) + field(7, graph)


def test_model_file_runs(spark, tmp_path):
    path = str(tmp_path / "double.onnx")
    with open(path, "wb") as file:
        file.write(doubling_model())
    image = np.random.default_rng(1).integers(0, 256, (150, 140, 3)).astype(np.uint8)
    df = spark.createDataFrame([("a", 150, 140, 3, bytearray(image.tobytes()))], "path string, height int, width int, channels int, data binary")
    turned = str(tmp_path / "turned")
    with open(turned, "wb") as file:
        file.write(doubling_model()[::-1])
    backwards = tiles.superresolved(df, tiles.OnnxUpscaler(turned, lambda data: data[::-1])).first()
    row = tiles.superresolved(df, tiles.OnnxUpscaler(path)).first()
    assert backwards.data == row.data
    assert row.error is None and (np.frombuffer(row.data, np.uint8).reshape(300, 280, 3) == image.repeat(2, 0).repeat(2, 1)).all()


def test_plain_model_file(spark, tmp_path):
    """An upscaler from a model file: a missing one fails its tiles, and the images with them, with the reason."""
    image = np.zeros((20, 30, 3), np.uint8)
    df = spark.createDataFrame([("a", 20, 30, 3, bytearray(image.tobytes()))], "path string, height int, width int, channels int, data binary")
    row = tiles.superresolved(df, tiles.OnnxUpscaler(str(tmp_path / "none.onnx"))).first()
    assert row.data is None and "none.onnx" in row.error
