"""Scans, measurements, the whole pipeline, logs, tuning and streams on generated files."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom import config, schema
from rasterloom.functions import geometry as geo
from rasterloom.functions import kernels
from rasterloom.operators import relational as rel
from rasterloom.operators import tiles
from rasterloom.operators.images import detected, measured
from rasterloom.plans import pipeline, ppi, tuning
from rasterloom.sources import files as sources
from rasterloom.sources import logs
from rasterloom.streaming import resume
from test_kernels import drawn, scene


def noisy(image):
    """Noise keeps files above the least size and leaves every measured range as it is."""
    return np.clip(image.astype(int) + np.random.default_rng(0).integers(0, 4, image.shape[:2])[..., None], 0, 255).astype(np.uint8)


def save(path, image):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(kernels.encode_png(image[..., ::-1], 400))


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """Two folders of the same leaf name, one small and one large page; junk among them."""
    root = str(tmp_path_factory.mktemp("scans"))
    page, ruler = drawn(260, 300, (150, 130, 150, 110), 220, 10), drawn(260, 300, (150, 130, 200, 50), 70, 200)
    large = drawn(260, 300, (150, 130, 280, 240), 220, 10)
    for folder, image in (("one/scans", page), ("two/scans", large)):
        for k in range(4):
            save(f"{root}/{folder}/p{k}.png", noisy(image))
        save(f"{root}/{folder}/z_ruler.png", noisy(ruler))
    with open(f"{root}/one/scans/broken.png", "wb") as file:
        file.write(b"\x89PNG" + b"x" * 20_000)
    for name, size in (("small.png", 100), ("Thumbs.db", 20_000), ("notes.pdf", 20_000)):
        with open(f"{root}/one/scans/{name}", "wb") as file:
            file.write(b"y" * size)
    save(f"{root}/two/few/a.png", noisy(page))
    save(f"{root}/two/few/b.png", noisy(ruler))
    return root


def test_scan(spark, tree):
    found = sources.files(spark, tree)
    assert found.count() == 16 and sources.image_files(found).count() == 14
    assert {r.folder.split("/")[-2:][0] for r in sources.folders(found, tree).collect()} == {"one", "two"}
    checked = sources.validated(sources.image_files(found), sources.images(spark, tree))
    bad = {r["name"]: r.error for r in checked.where("not valid").collect()}
    assert bad == {"broken.png": "[OPEN FAIL]", "small.png": "file too small"}
    assert "content" not in found.columns


def test_decoded_pixels(spark, tmp_path):
    image = np.random.default_rng(1).integers(0, 256, (9, 7, 3)).astype(np.uint8)
    save(str(tmp_path / "a.png"), image)
    row = sources.images(spark, str(tmp_path)).first()
    assert (row.height, row.width, row.channels) == (9, 7, 3) and bytes(row.data) == image.tobytes()


def test_resolution_by_folder(spark, tree):
    checked = sources.validated(sources.image_files(sources.files(spark, tree)), sources.images(spark, tree)).where("valid")
    found = ppi.estimate(checked, sources.images(spark, tree).join(checked.select("path"), "path", "left_semi")).collect()
    got = {r.folder.split("/")[-2]: r for r in found}
    assert len(found) == 2 and got["one"].ppi == 400 and got["two"].ppi == 600
    assert got["one"].band_long == pytest.approx(200, abs=2) and got["one"].avg_long == pytest.approx(150, abs=2)


def test_pipeline(spark, tree, tmp_path):
    result = pipeline.run(spark, tree)
    images = {r.relative_path: r for r in result.images.select("relative_path", "height", "width", "ppi").collect()}
    assert set(images) == {f"{f}/scans/{n}.png" for f in ("one", "two") for n in ("p0", "p1", "p2", "p3", "z_ruler")}
    assert (images["one/scans/p0.png"].height, images["one/scans/p0.png"].width) == (int(520 * 0.7646969983731071), int(600 * 0.7646969983731071))
    assert (images["two/scans/p0.png"].height, images["two/scans/p0.png"].width) == (int(520 * 0.8145511415934249), int(600 * 0.8145511415934249))
    failures = {r.filename: r for r in result.failures.collect()}
    assert failures["broken.png"].error == "Input image invalid: [OPEN FAIL]" and failures["a.png"].error.startswith("Errore downscale")
    assert set(failures) == {"broken.png", "small.png", "a.png", "b.png"} and {r.status for r in failures.values()} == {"false"}
    totals = {r.parent.rsplit("/", 2)[-2] + "/" + r.parent.rsplit("/", 1)[-1]: (r.n, r.errors, r.success) for r in result.totals.collect()}
    assert totals == {"one/scans": (7, 2, 5), "two/scans": (5, 0, 5), "two/few": (2, 2, 0)}
    out = str(tmp_path / "out")
    written = sources.write_png(result.images, out, F.col("relative_path"), F.col("ppi")).collect()
    assert len(written) == 10 and os.path.exists(f"{out}/two/scans/p3.png")
    again = sources.images(spark, out)
    assert again.where("data is null").count() == 0
    done = sources.files(spark, out).select(pipeline.relative(F.col("path"), out).alias("relative_path"))
    rest = pipeline.run(spark, tree, done)
    assert rest.images.count() == 0 and rest.failures.count() == 4


def test_pipeline_takes_every_suffix(spark, tmp_path):
    """Scans named .tif, in upper case or without a suffix are processed, and broken ones are failures."""
    page, ruler = drawn(260, 300, (150, 130, 150, 110), 220, 10), drawn(260, 300, (150, 130, 200, 50), 70, 200)
    root = str(tmp_path)
    for name, image in (("a.tif", page), ("b.TIF", page), ("c.bmp", page), ("d", page), ("z_ruler.tif", ruler)):
        save(f"{root}/scans/{name}", noisy(image))
    for name in ("broken.tif", "broken", "notes.pdf", "file.svg", "Thumbs.db"):
        with open(f"{root}/scans/{name}", "wb") as file:
            file.write(b"y" * 20_000)
    result = pipeline.run(spark, root)
    assert {r.relative_path for r in result.images.select("relative_path").collect()} == {f"scans/{n}" for n in ("a.tif", "b.TIF", "c.bmp", "d", "z_ruler.tif")}
    assert {r.filename for r in result.failures.collect()} == {"broken.tif", "broken"}
    assert [(r.n, r.errors, r.success) for r in result.totals.collect()] == [(7, 2, 5)]


def test_real_tiff_decodes(spark, tmp_path):
    """An uncompressed TIFF of 40 x 30 pixels, written by hand, as the scans are."""
    import struct

    pixels = np.random.default_rng(3).integers(0, 256, (30, 40, 3)).astype(np.uint8)
    tags = [(256, 3, 1, 40), (257, 3, 1, 30), (258, 3, 3, 134), (259, 3, 1, 1), (262, 3, 1, 2), (273, 4, 1, 140), (277, 3, 1, 3), (278, 3, 1, 30), (279, 4, 1, 3600), (284, 3, 1, 1)]
    head = struct.pack("<2sHIH", b"II", 42, 8, len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", 0)
    (tmp_path / "a.tif").write_bytes(head + struct.pack("<3H", 8, 8, 8) + pixels.tobytes())
    row = sources.images(spark, str(tmp_path)).first()
    assert (row.height, row.width) == (30, 40) and bytes(row.data) == pixels[..., ::-1].tobytes()


def test_superresolution_sizes_and_identity(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for h, w in ((129, 300), (100, 50), (128, 128), (230, 131)):
        image = rng.integers(0, 256, (h, w, 3)).astype(np.uint8)
        rows.append((f"{h}x{w}", h, w, 3, bytearray(image.tobytes())))
        want[f"{h}x{w}"] = image
    df = spark.createDataFrame(rows, schema.IMAGE)
    for scale in (2, 3):
        for r in tiles.superresolved(df, tiles.nearest, scale).collect():
            image = want[r.path]
            assert (r.height, r.width) == (image.shape[0] * scale, image.shape[1] * scale)
            got = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3)
            assert (got == image.repeat(scale, 0).repeat(scale, 1)).all()
    smooth = tiles.superresolved(df, tiles.bicubic, 2).first()
    assert smooth.height % 2 == 0 and len(smooth.data) == smooth.height * smooth.width * 3


def test_tile_grid_of_the_fixtures(spark):
    df = spark.createDataFrame([(5237, 3612), (3267, 4599)], "h int, w int")
    counts = {r.h: r["count"] for r in tiles.tile_grid(df, "h", "w").groupBy("h").count().collect()}
    assert counts == {5237: 2090, 3267: 1632}


def test_fixed_scale_factors(spark):
    df = pipeline.calibrations(spark).select("ppi", geo.scale_factor(F.col("ppi"), F.col("width_mm"), F.col("correction_factor")).alias("f"))
    found = {r.ppi: r.f for r in df.collect()}
    assert found[400] == pytest.approx(0.7646969983731071, abs=1e-15) and found[600] == pytest.approx(0.8145511415934249, abs=1e-15)
    sizes = [(400, 7224, 10474), (600, 9198, 6534)]
    got = [(int(w * found[p]), int(h * found[p])) for p, w, h in sizes]
    assert got == [(5524, 8009), (7492, 5322)]


def test_detectors_in_spark(spark):
    image, template = scene()
    rows = [("a", 300, 420, 3, bytearray(image.tobytes())), ("b", None, None, None, None), ("c", 5, 5, 3, bytearray(10))]
    found = {r.path: r for r in detected(spark.createDataFrame(rows, schema.IMAGE), template).collect()}
    assert found["a"].multiscale.w == 260 and found["b"].multiscale is None and found["c"].by_gray is None
    errors = {r.path: r.error for r in measured(spark.createDataFrame(rows, schema.IMAGE), kernels.measure_page).collect()}
    assert errors["a"] is None and errors["b"] == "[OPEN FAIL]" and errors["c"].startswith("[UNEXPECTED]")


def test_small_folders_and_chunks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3), (None, 9)], "g string, n long")
    assert rel.without_last(df, "g", ["n"]).collect() == [("b", 1)]
    assert {tuple(r) for r in rel.last_rows(df, "g", ["n"]).collect()} == {("a", 2), ("b", 3), (None, 9)}
    five = spark.createDataFrame([("x", i) for i in range(5)], "g string, n long")
    sizes = {p: rel.chunks(five, "g", ["n"], p, "floor").agg(F.countDistinct("chunk")).first()[0] for p in (1, 2, 4, 8)}
    assert sizes == {1: 1, 2: 3, 4: 5, 8: 5}
    assert rel.chunks(five, "g", ["n"], 4).agg(F.countDistinct("chunk")).first()[0] == 3


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "b", "run", "false", "x", "in/b"), ("2024-01-01 00:00:00", "CRASH", "CRASH", "false", "y", None)], schema.FAILURE_LOG)
    logs.append_failures(rows, path, first=True)
    logs.append_failures(rows, path)
    found = logs.read_failures(spark, path)
    assert found.count() == 4 and [r.filename for r in logs.sorted_log(found, crash_last=True).collect()] == ["b", "b", "CRASH", "CRASH"]
    old = tmp_path / "old.csv"
    old.write_text("timestamp,filename,step,status,error\n2024-01-01 00:00:00,a,run,false,x\n")
    assert logs.read_failures(spark, str(old)).first().full_path is None


def benchmark_rows(spark, rows):
    df = spark.createDataFrame([(*r[:3], r[3] * 5.0, r[3]) for r in rows], "device string, processes int, threads int, total_time double, avg_time double")
    return df.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def test_tuning(spark, tmp_path):
    log = benchmark_rows(spark, [("CPU", 1, 1, 108.5527), ("GPU", 4, 4, 22.5453), ("GPU", 1, 1, 24.1725)])
    logs.append_benchmark(log, str(tmp_path / "bench"))
    with open(tmp_path / "bench" / "odd.csv", "w") as file:
        file.write("timestamp,device,processes,threads,total_time,avg_time\n2024-01-01 00:00:00,GPU,8,8,1.00,oops\n")
    read = logs.read_benchmarks(spark, str(tmp_path / "bench"))
    assert read.count() == 4 and read.where("avg_time is null").count() == 1
    chosen = tuning.best(read.withColumn("at", F.col("threads")), "at")
    assert tuple(chosen.first())[:3] == ("GPU", 4, 4)
    logs.write_best(chosen, str(tmp_path / "best"))
    assert tuple(logs.read_best(spark, str(tmp_path / "best")).first()) == ("GPU", 4, 4)
    assert {r.device for r in tuning.pending(spark, read).collect()} == {"GPU"} and tuning.pending(spark, read).count() == 13
    asked = []

    def measure(device, processes, threads):
        asked.append((device, processes, threads))
        return 500.0, 100.0 if processes == 2 else 10.0

    fresh = tuning.tune(spark, log.limit(0), measure, ["CPU"])
    assert asked == [("CPU", 1, t) for t in (1, 2, 4, 8)] + [("CPU", 2, 1)] and fresh.count() == 5
    assert tuning.best(log.limit(0).withColumn("at", F.lit(1)), "at").count() == 0


def test_exif(spark, tmp_path):
    (tmp_path / "dump.json").write_text("File Name : a.tif\nDate : 2024 : 01\nEmpty :\nX Resolution   : 400\n")
    found = {r.key: r.value for r in sources.exif(spark, str(tmp_path / "dump.json")).collect()}
    assert found == {"File Name": "a.tif", "Date": "2024 : 01", "Empty": "", "X Resolution": "400"}


def test_stream_resumes(spark, tmp_path):
    root, checkpoint, seen = tmp_path / "in", str(tmp_path / "check"), []
    root.mkdir()
    for name in ("a.png", "b.png"):
        (root / name).write_bytes(b"12345")
    process = lambda batch, number: seen.extend(r["name"] for r in batch.select("name").collect())
    resume.resume(spark, str(root), checkpoint, process)
    (root / "c.png").write_bytes(b"1")
    resume.resume(spark, str(root), checkpoint, process)
    resume.resume(spark, str(root), checkpoint, process)
    assert sorted(seen[:2]) == ["a.png", "b.png"] and seen[2:] == ["c.png"]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "g string, n long, v double")
    assert rel.positions(none, "g", ["n"]).count() == 0 and rel.early_stopped(none, "g", "n", "v", 1.0).count() == 0
    assert ppi.ppi_by_folder(none.selectExpr("g folder", "g name"), none.selectExpr("g name", "v long_px", "v short_px")).count() == 0
    assert config.Settings().scale == 2
