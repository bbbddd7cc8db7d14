"""Queries over the driver's tables, each with its DuckDB SQL.

Where an operator works on images, rows of ``embeddings`` stand in for them: 64 components make an 8 x 8 gray image, the
label is its folder and vec_id its place in the folder. Where it works on sizes, ``part`` stands in. This checks the
relational logic; images proper are covered by tests on generated files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom import config, schema
from rasterloom.functions import geometry as geo
from rasterloom.functions import pixels as px
from rasterloom.operators import relational as rel
from rasterloom.operators import tiles
from rasterloom.plans.pipeline import calibrations
from rasterloom.plans.ppi import ppi_by_folder

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

IMAGES_SQL = """
im AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(trunc(greatest(0.0::DOUBLE, least(255.0::DOUBLE,
  (CAST(v AS DOUBLE) + 0.6::DOUBLE) / 1.2::DOUBLE * 255.0::DOUBLE))) AS INTEGER)) AS gs FROM embeddings),
px AS (SELECT vec_id, label, i, i // 8 AS y, i % 8 AS x, gs[i + 1] AS b, gs[(i + 21) % 64 + 1] AS g,
  gs[(i + 42) % 64 + 1] AS r FROM im, (SELECT CAST(range AS INTEGER) AS i FROM range(64)))
"""
HSV_SQL = (
    "px3 AS (SELECT *, greatest(b, g, r) AS top, CAST(greatest(b, g, r) - least(b, g, r) AS DOUBLE) AS span FROM px), "
    "px4 AS (SELECT *, CASE WHEN span = 0 THEN 0.0::DOUBLE WHEN top = r THEN 60.0::DOUBLE * (g - b) / span "
    "WHEN top = g THEN 120.0::DOUBLE + 60.0::DOUBLE * (b - r) / span ELSE 240.0::DOUBLE + 60.0::DOUBLE * (r - g) / span END AS a FROM px3), "
    "hsv AS (SELECT vec_id, label, i, y, x, CAST(floor((CASE WHEN a < 0 THEN a + 360.0::DOUBLE ELSE a END) / 2.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) % 180 AS h, "
    "CASE WHEN top = 0 THEN 0 ELSE CAST(floor(255.0::DOUBLE * span / top + 0.5::DOUBLE) AS INTEGER) END AS s, top AS v FROM px4)"
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, gs: the 64 gray values of each stand-in image.

    The explode of one element keeps the optimizer from copying the expression into each use of a pixel.
    """
    value = lambda v: px.quantise((v.cast("double") + 0.6) / 1.2)
    return _t(spark, sf_dir, "embeddings").select("vec_id", "label", F.explode(F.array(F.transform("embedding", value))).alias("gs"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, i, y, x and the channels b, g, r of each pixel."""

    def pixel(i):
        channel = lambda k: F.element_at("gs", (i + k) % 64 + 1)
        y = F.floor(i / 8).cast("int").alias("y")
        return F.struct(i.alias("i"), y, (i % 8).alias("x"), channel(0).alias("b"), channel(21).alias("g"), channel(42).alias("r"))

    every = F.transform(F.sequence(F.lit(0), F.lit(63)), pixel)
    return images(spark, sf_dir).select("vec_id", "label", F.inline(every))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, w, h: the bounding box of what is brighter than 150."""
    rows = pixels(spark, sf_dir).where("b > 150").groupBy("vec_id", "label")
    return rows.agg((F.max("x") - F.min("x") + 1).alias("w"), (F.max("y") - F.min("y") + 1).alias("h"))


BOX_SQL = "box AS (SELECT vec_id, label, max(x) - min(x) + 1 AS w, max(y) - min(y) + 1 AS h FROM px WHERE b > 150 GROUP BY vec_id, label)"


def _bgr():
    return F.col("b"), F.col("g"), F.col("r")


@query(f"""WITH {IMAGES_SQL}, {BOX_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS rn FROM im),
ruler AS (SELECT r.label, greatest(b.w, b.h) AS band_long FROM ranked r JOIN box b USING (vec_id) WHERE rn = 1),
dims AS (SELECT r.label, avg(greatest(b.w, b.h)) AS avg_long, avg(least(b.w, b.h)) AS avg_short FROM ranked r JOIN box b USING (vec_id) WHERE rn > 2 GROUP BY r.label)
SELECT d.label AS folder, round(u.band_long, 6) AS band_long, round(d.avg_long, 6) AS avg_long, round(d.avg_short, 6) AS avg_short,
CASE WHEN (200.0::DOUBLE / u.band_long) * d.avg_short <= 210 AND (200.0::DOUBLE / u.band_long) * d.avg_long <= 297 THEN 400 ELSE 600 END AS ppi
FROM dims d JOIN ruler u USING (label)""")
def ppi_by_folder_query(spark, sf_dir):
    files = images(spark, sf_dir).select(F.col("label").alias("folder"), F.col("vec_id").alias("name"))
    sides = boxes(spark, sf_dir).select(F.col("vec_id").alias("name"), F.greatest("w", "h").alias("long_px"), F.least("w", "h").alias("short_px"))
    found = ppi_by_folder(files, sides)
    return found.select("folder", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("band_long", "avg_long", "avg_short")], "ppi")


for _d in (QUERIES, ORACLE_SQL):
    _d["ppi_by_folder"] = _d.pop("ppi_by_folder_query")


@query("SELECT p_partkey, CASE WHEN p_size * 7.0::DOUBLE <= 210 AND p_retailprice / 4.0::DOUBLE <= 297 THEN 400 ELSE 600 END AS ppi FROM part")
def ppi_class(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return part.select("p_partkey", geo.ppi_class(F.col("p_size") * 7.0, F.col("p_retailprice") / 4.0).alias("ppi"))


@query(f"WITH {IMAGES_SQL}, {BOX_SQL} SELECT vec_id, w, h FROM box")
def bbox_measure(spark, sf_dir):
    return boxes(spark, sf_dir).select("vec_id", "w", "h")


@query(f"WITH {IMAGES_SQL} SELECT vec_id, i, b AS q FROM px")
def quantise(spark, sf_dir):
    return pixels(spark, sf_dir).select("vec_id", "i", F.col("b").alias("q"))


@query(f"WITH {IMAGES_SQL} SELECT vec_id, i, CASE WHEN b > 50 THEN 255 ELSE 0 END AS mask FROM px")
def threshold(spark, sf_dir):
    return pixels(spark, sf_dir).select("vec_id", "i", px.threshold(F.col("b")).alias("mask"))


@query(f"WITH {IMAGES_SQL} SELECT vec_id, i, CAST(floor(r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS gray FROM px")
def bgr_to_gray(spark, sf_dir):
    return pixels(spark, sf_dir).select("vec_id", "i", px.gray(*_bgr()).alias("gray"))


def _hsv_rows(spark, sf_dir) -> DataFrame:
    h, s, v = px.hsv(*_bgr())
    return pixels(spark, sf_dir).select("vec_id", "label", "i", "y", "x", h.alias("h"), s.alias("s"), v.alias("v"))


@query(f"WITH {IMAGES_SQL}, {HSV_SQL} SELECT vec_id, i, h, s, v FROM hsv")
def bgr_to_hsv(spark, sf_dir):
    return _hsv_rows(spark, sf_dir).select("vec_id", "i", "h", "s", "v")


@query(f"WITH {IMAGES_SQL}, {HSV_SQL} SELECT vec_id, count(*) FILTER (WHERE h BETWEEN 0 AND 180 AND s BETWEEN 0 AND 50 AND v BETWEEN 40 AND 100) AS n_in FROM hsv GROUP BY vec_id")
def in_range(spark, sf_dir):
    inside = px.in_range((F.col("h"), F.col("s"), F.col("v")), config.GRAY_LOW, config.GRAY_HIGH)
    return _hsv_rows(spark, sf_dir).groupBy("vec_id").agg(F.count_if(inside).alias("n_in"))


@query(f"""WITH {IMAGES_SQL}, {HSV_SQL}, m AS (SELECT vec_id, avg(h) AS h, avg(s) AS s, avg(v) AS v FROM hsv GROUP BY vec_id)
SELECT vec_id, CAST(trunc(greatest(0, h - 20)) AS INTEGER) AS h_low, CAST(trunc(least(180, h + 20)) AS INTEGER) AS h_high,
CAST(trunc(greatest(0, s - 30)) AS INTEGER) AS s_low, CAST(trunc(least(255, s + 30)) AS INTEGER) AS s_high,
CAST(trunc(greatest(0, v - 40)) AS INTEGER) AS v_low, CAST(trunc(least(255, v + 40)) AS INTEGER) AS v_high FROM m""")
def hsv_bounds(spark, sf_dir):
    means = _hsv_rows(spark, sf_dir).groupBy("vec_id").agg(*[F.avg(c).alias(c) for c in "hsv"])
    columns = []
    for c, spread, top in zip("hsv", config.HSV_SPREAD, config.HSV_TOP, strict=True):
        low, high = px.bounds(F.col(c), spread, top)
        columns += [low.alias(f"{c}_low"), high.alias(f"{c}_high")]
    return means.select("vec_id", *columns)


MASK_SQL = f"WITH {IMAGES_SQL}, {HSV_SQL}, low AS (SELECT p.vec_id, avg(p.b) AS mb, avg(p.g) AS mg, avg(p.r) AS mr FROM px p JOIN hsv h USING (vec_id, i) WHERE h.s <= 40 AND h.v BETWEEN 30 AND 255 GROUP BY p.vec_id)"


def _masked(spark, sf_dir) -> DataFrame:
    h, s, v = px.hsv(*_bgr())
    rows = pixels(spark, sf_dir).where(px.in_range((h, s, v), config.LOW_SATURATION_LOW, config.LOW_SATURATION_HIGH))
    return rows.groupBy("vec_id").agg(*[F.floor(F.avg(c)).cast("int").alias(f"m{c}") for c in "bgr"])


@query(f"{MASK_SQL} SELECT vec_id, CAST(trunc(mb) AS INTEGER) AS mb, CAST(trunc(mg) AS INTEGER) AS mg, CAST(trunc(mr) AS INTEGER) AS mr FROM low")
def masked_mean(spark, sf_dir):
    return _masked(spark, sf_dir)


@query(f"""{MASK_SQL} SELECT p.vec_id, p.i, round(sqrt((b - trunc(mb)) * (b - trunc(mb)) + (g - trunc(mg)) * (g - trunc(mg)) + (r - trunc(mr)) * (r - trunc(mr))), 6) AS distance,
sqrt((b - trunc(mb)) * (b - trunc(mb)) + (g - trunc(mg)) * (g - trunc(mg)) + (r - trunc(mr)) * (r - trunc(mr))) < 30 AS gray FROM px p JOIN low USING (vec_id)""")
def l2_segment(spark, sf_dir):
    rows = pixels(spark, sf_dir).join(_masked(spark, sf_dir), "vec_id")
    d = px.distance(list(_bgr()), [F.col("mb"), F.col("mg"), F.col("mr")])
    return rows.select("vec_id", "i", F.round(d, 6).alias("distance"), (d < config.SEGMENT_DISTANCE).alias("gray"))


#: A fixed 3 x 3 template.
TEMPLATE = ((0, 0, 10), (0, 1, 60), (0, 2, 10), (1, 0, 60), (1, 1, 250), (1, 2, 60), (2, 0, 10), (2, 1, 60), (2, 2, 10))
TEMPLATE_SQL = "tp(ty, tx, t) AS (VALUES " + ", ".join(f"({y}, {x}, {t})" for y, x, t in TEMPLATE) + ")"
NCC_SQL = f"""WITH {IMAGES_SQL}, {TEMPLATE_SQL}, sc AS (SELECT vec_id, y - ty AS oy, x - tx AS ox, count(*) AS n, sum(CAST(b AS DOUBLE)) AS sp, sum(CAST(b * b AS DOUBLE)) AS spp,
sum(CAST(b * t AS DOUBLE)) AS spt FROM px, tp WHERE y - ty BETWEEN 0 AND 5 AND x - tx BETWEEN 0 AND 5 GROUP BY vec_id, oy, ox),
tt AS (SELECT sum(CAST(t AS DOUBLE)) AS st, sum(CAST(t * t AS DOUBLE)) AS stt FROM tp),
score AS (SELECT vec_id, oy, ox, CASE WHEN n * spp - sp * sp = 0 THEN 0.0::DOUBLE ELSE (n * spt - sp * st) / sqrt((n * spp - sp * sp) * (n * stt - st * st)) END AS score FROM sc, tt)"""


def _ncc(spark, sf_dir) -> DataFrame:
    """Zero-mean normalised cross-correlation of the template at each offset; the template is exploded per pixel."""
    cells = F.explode(F.array(*[F.struct(F.lit(y).alias("ty"), F.lit(x).alias("tx"), F.lit(t).alias("t")) for y, x, t in TEMPLATE])).alias("c")
    rows = pixels(spark, sf_dir).select("vec_id", (F.col("b")).cast("double").alias("p"), "y", "x", cells)
    rows = rows.select("vec_id", (F.col("y") - F.col("c.ty")).alias("oy"), (F.col("x") - F.col("c.tx")).alias("ox"), "p", F.col("c.t").cast("double").alias("t"))
    rows = rows.where("oy between 0 and 5 and ox between 0 and 5").groupBy("vec_id", "oy", "ox")
    sums = rows.agg(F.count("*").alias("n"), F.sum("p").alias("sp"), F.sum(F.col("p") * F.col("p")).alias("spp"), F.sum(F.col("p") * F.col("t")).alias("spt"))
    st, stt = float(sum(t for *_, t in TEMPLATE)), float(sum(t * t for *_, t in TEMPLATE))
    spread = F.col("n") * F.col("spp") - F.col("sp") * F.col("sp")
    score = (F.col("n") * F.col("spt") - F.col("sp") * st) / F.sqrt(spread * (F.col("n") * stt - st * st))
    return sums.select("vec_id", "oy", "ox", F.when(spread == 0, 0.0).otherwise(score).alias("score"))


@query(f"{NCC_SQL} SELECT vec_id, oy, ox, round(score, 6) AS score FROM score")
def ncc_match(spark, sf_dir):
    return _ncc(spark, sf_dir).select("vec_id", "oy", "ox", F.round("score", 6).alias("score"))


#: Sizes of the template at its scales; a pixel falls with its distance from the centre, and from left to right.
SCALES = (2, 3, 4, 5)
SCALES_SQL = f"""tp AS (SELECT s, ty, tx, 250 - 30 * (abs(2 * ty - s + 1) + abs(2 * tx - s + 1)) - 9 * tx AS t FROM (VALUES {", ".join(f"({n})" for n in SCALES)}) z(s),
(SELECT CAST(range AS INTEGER) AS ty FROM range(5)) a, (SELECT CAST(range AS INTEGER) AS tx FROM range(5)) b WHERE ty < s AND tx < s)"""


@query(f"""WITH {IMAGES_SQL}, {SCALES_SQL}, sc AS (SELECT vec_id, s, y - ty AS oy, x - tx AS ox, count(*) AS n, sum(CAST(b AS DOUBLE)) AS sp, sum(CAST(b * b AS DOUBLE)) AS spp,
sum(CAST(b * t AS DOUBLE)) AS spt FROM px, tp WHERE y - ty BETWEEN 0 AND 8 - s AND x - tx BETWEEN 0 AND 8 - s GROUP BY vec_id, s, oy, ox),
tt AS (SELECT s, sum(CAST(t AS DOUBLE)) AS st, sum(CAST(t * t AS DOUBLE)) AS stt FROM tp GROUP BY s),
score AS (SELECT vec_id, s, oy, ox, round(CASE WHEN n * spp - sp * sp = 0 THEN 0.0::DOUBLE ELSE (n * spt - sp * st) / sqrt((n * spp - sp * sp) * (n * stt - st * st)) END, 6) AS score FROM sc JOIN tt USING (s)),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id, s ORDER BY score DESC, oy * 8 + ox) AS rn FROM score),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, s) AS first FROM best WHERE rn = 1)
SELECT vec_id, s AS scale, oy, ox, score FROM r WHERE first = 1 AND score >= 0.6""")
def best_scale(spark, sf_dir):
    """The template's best place at each of its scales, and of these the best scale, the first of equals."""
    cells = [(s, y, x, 250 - 30 * (abs(2 * y - s + 1) + abs(2 * x - s + 1)) - 9 * x) for s in SCALES for y in range(s) for x in range(s)]
    each = F.explode(F.array(*[F.struct(*(F.lit(v).alias(n) for n, v in zip(("s", "ty", "tx", "t"), c, strict=True))) for c in cells])).alias("c")
    rows = pixels(spark, sf_dir).select("vec_id", F.col("b").cast("double").alias("p"), "y", "x", each)
    rows = rows.select("vec_id", "p", (F.col("y") - F.col("c.ty")).alias("oy"), (F.col("x") - F.col("c.tx")).alias("ox"), F.col("c.s").alias("scale"), F.col("c.t").cast("double").alias("t"))
    rows = rows.where((F.least("oy", "ox") >= 0) & (F.greatest("oy", "ox") <= 8 - F.col("scale"))).groupBy("vec_id", "scale", "oy", "ox")
    p, t = F.col("p"), F.col("t")
    n, sp, spp, spt, st, stt = F.count("*").cast("double"), F.sum("p"), F.sum(p * p), F.sum(p * t), F.sum("t"), F.sum(t * t)
    score = F.when(n * spp - sp * sp == 0, 0.0).otherwise((n * spt - sp * st) / F.sqrt((n * spp - sp * sp) * (n * stt - st * st)))
    scores = rows.agg(F.round(score, 6).alias("score")).withColumn("ordinal", F.col("oy") * 8 + F.col("ox"))
    best = F.max_by(F.struct("scale", "oy", "ox", "score"), F.struct("score", -F.col("scale"), -F.col("ordinal")))
    found = scores.groupBy("vec_id").agg(best.alias("r")).select("vec_id", "r.*")
    return found.where(F.col("score") >= config.MIN_MATCH)


@query(f"""WITH RECURSIVE {IMAGES_SQL}, fg AS (SELECT vec_id, i, y, x FROM px WHERE b > 150),
reach AS (SELECT vec_id, i, i AS root FROM fg UNION SELECT n.vec_id, n.i, r.root FROM reach r JOIN fg o ON o.vec_id = r.vec_id AND o.i = r.i
JOIN fg n ON n.vec_id = o.vec_id AND abs(n.y - o.y) <= 1 AND abs(n.x - o.x) <= 1)
SELECT vec_id, component, count(*) AS area FROM (SELECT vec_id, i, min(root) AS component FROM reach GROUP BY vec_id, i) GROUP BY vec_id, component""")
def components(spark, sf_dir):
    from rasterloom.operators.images import component_areas

    return component_areas(images(spark, sf_dir).select("vec_id", F.transform("gs", lambda g: g > 150).alias("mask")), "vec_id", 8)


PARTS_SQL = "p AS (SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS w, p_retailprice / 100.0::DOUBLE AS h FROM part)"
CONTOUR_SQL = "2 * (w * 4 + h * 4) >= 200 AND w * 4 * (h * 4) >= 1000 AND greatest(w * 4, h * 4) / least(w * 4, h * 4) >= 3"


def _contours(spark, sf_dir) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    return part.select("p_partkey", "p_brand", (F.col("p_size") * 4.0).alias("w"), (F.col("p_retailprice") / 100.0 * 4).alias("h"))


@query(f"WITH {PARTS_SQL} SELECT p_partkey, {CONTOUR_SQL} AS ok FROM p")
def contour_filter(spark, sf_dir):
    w, h = F.col("w"), F.col("h")
    return _contours(spark, sf_dir).select("p_partkey", rel.contour_ok(2 * (w + h), w, h).alias("ok"))


@query(f"""WITH {PARTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY round(w * h * 16, 6) DESC, p_partkey) AS rn FROM p WHERE {CONTOUR_SQL})
SELECT p_brand, p_partkey, round(w * h * 16, 6) AS area FROM r WHERE rn = 1""")
def argmax_first(spark, sf_dir):
    w, h = F.col("w"), F.col("h")
    rows = _contours(spark, sf_dir).where(rel.contour_ok(2 * (w + h), w, h)).withColumn("area", F.round(w * h, 6))
    return rel.first_largest(rows, "p_brand", F.col("area"), "p_partkey", "p_partkey", "area")


SIZES_SQL = "s AS (SELECT p_partkey, 128 + 11 * p_size AS height, 128 + 7 * p_size AS width FROM part)"


def _sizes(spark, sf_dir) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    return part.select("p_partkey", (F.lit(128) + 11 * F.col("p_size")).alias("height"), (F.lit(128) + 7 * F.col("p_size")).alias("width"))


@query(f"WITH {SIZES_SQL} SELECT p_partkey, CAST(ceil((height - 32) / 96.0::DOUBLE) AS INTEGER) AS tiles_h, CAST(ceil((width - 32) / 96.0::DOUBLE) AS INTEGER) AS tiles_w FROM s")
def tile_counts(spark, sf_dir):
    return _sizes(spark, sf_dir).select("p_partkey", geo.tile_count(F.col("height")).alias("tiles_h"), geo.tile_count(F.col("width")).alias("tiles_w"))


@query(f"""WITH {SIZES_SQL}, n AS (SELECT *, CAST(ceil((height - 32) / 96.0::DOUBLE) AS INTEGER) AS nh, CAST(ceil((width - 32) / 96.0::DOUBLE) AS INTEGER) AS nw FROM s)
SELECT p_partkey, th AS tile_h, tw AS tile_w, least(th * 96, height - 128) AS start_h, least(tw * 96, width - 128) AS start_w
FROM n, (SELECT CAST(range AS INTEGER) AS th FROM range(64)) a, (SELECT CAST(range AS INTEGER) AS tw FROM range(64)) b WHERE th < nh AND tw < nw""")
def tile_grid(spark, sf_dir):
    from rasterloom.operators.tiles import tile_grid as tiles

    return tiles(_sizes(spark, sf_dir), "height", "width").select("p_partkey", "tile_h", "tile_w", "start_h", "start_w")


@query("SELECT p_partkey, greatest(p_size * 5, 128) AS pad_h, greatest(p_size * 3, 128) AS pad_w FROM part")
def pad_shape(spark, sf_dir):
    size = F.col("p_size")
    return _t(spark, sf_dir, "part").select("p_partkey", geo.padded(size * 5).alias("pad_h"), geo.padded(size * 3).alias("pad_w"))


@query("SELECT CAST(range AS INTEGER) AS x, least(range / 64.0::DOUBLE, (64 - range) / 64.0::DOUBLE) AS weight FROM range(65)")
def linear_weight(spark, sf_dir):
    return spark.range(65).select(F.col("id").cast("int").alias("x"), geo.linear_weight(F.col("id").cast("double"), 64.0).alias("weight"))


BLEND_SQL = """tl AS (SELECT CAST(range AS INTEGER) AS k FROM range(3)), ps AS (SELECT CAST(range AS INTEGER) AS q FROM range(4)),
wt AS (SELECT k, q, (CASE WHEN k > 0 AND q < 2 THEN least(q / 2.0::DOUBLE, (2 - q) / 2.0::DOUBLE) ELSE 1.0::DOUBLE END)
 * (CASE WHEN k < 2 AND q >= 2 THEN least((3 - q) / 2.0::DOUBLE, (q - 1) / 2.0::DOUBLE) ELSE 1.0::DOUBLE END) AS w FROM tl, ps)"""


def _weights(spark) -> DataFrame:
    rows = rel.grid(spark.range(1), k=[0, 1, 2], q=[0, 1, 2, 3])
    return rows.withColumn("w", geo.edge_weight(F.col("q"), F.col("k") == 0, F.col("k") == 2, 4, 2))


@query(f"WITH {BLEND_SQL} SELECT k, q, w FROM wt")
def blend_weights(spark, sf_dir):
    return _weights(spark)


@query(f"""WITH {IMAGES_SQL}, {BLEND_SQL} SELECT p.vec_id, p.y, p.x, round(sum(p.b * a.w * c.w) / sum(a.w * c.w), 6) AS v
FROM px p JOIN wt a ON p.y = a.k * 2 + a.q JOIN wt c ON p.x = c.k * 2 + c.q GROUP BY p.vec_id, p.y, p.x""")
def blend_overlap_add(spark, sf_dir):
    w = _weights(spark)
    rows = w.select((F.col("k") * 2 + F.col("q")).alias("y"), F.col("w").alias("wy"))
    columns = w.select((F.col("k") * 2 + F.col("q")).alias("x"), F.col("w").alias("wx"))
    joined = pixels(spark, sf_dir).join(F.broadcast(rows), "y").join(F.broadcast(columns), "x")  # 12 rows each
    weight = F.col("wy") * F.col("wx")
    blended = F.sum(F.col("b") * weight) / F.sum(weight)
    return joined.groupBy("vec_id", "y", "x").agg(F.round(blended, 6).alias("v"))


@query("SELECT p_partkey, round((200.0::DOUBLE / (p_size + 100)) * p_retailprice, 6) AS mm FROM part")
def px_to_mm(spark, sf_dir):
    mm = geo.px_to_mm(F.col("p_retailprice"), geo.mm_per_pixel(F.col("p_size") + 100))
    return _t(spark, sf_dir, "part").select("p_partkey", F.round(mm, 6).alias("mm"))


CALIBRATION_SQL = "cal(ppi, width_mm, cf) AS (VALUES (400, 133.1::DOUBLE, 400.0::DOUBLE / 393), (600, 125.7::DOUBLE, 600.0::DOUBLE / 586))"
FACTOR_SQL = "ppi * (200.0::DOUBLE / 25.4::DOUBLE) / ((width_mm * ppi / 25.4::DOUBLE) * 2) * cf"


@query(f"WITH {CALIBRATION_SQL} SELECT ppi, round({FACTOR_SQL}, 9) AS factor FROM cal")
def scale_factor(spark, sf_dir):
    factor = geo.scale_factor(F.col("ppi"), F.col("width_mm"), F.col("correction_factor"))
    return calibrations(spark).select("ppi", F.round(factor, 9).alias("factor"))


PPI_SQL = "pp AS (SELECT p_partkey, p_size, CASE WHEN p_size % 3 = 0 THEN 400 WHEN p_size % 3 = 1 THEN 600 ELSE 300 END AS ppi FROM part)"


def _with_ppi(spark, sf_dir) -> DataFrame:
    rest = F.col("p_size") % 3
    return _t(spark, sf_dir, "part").select("p_partkey", "p_size", F.when(rest == 0, 400).when(rest == 1, 600).otherwise(300).alias("ppi"))


@query(f"""WITH {CALIBRATION_SQL}, {PPI_SQL} SELECT p_partkey, CAST(trunc((3000 + 17 * p_size) * 2 * ({FACTOR_SQL})) AS INTEGER) AS width,
CAST(trunc((5000 + 13 * p_size) * 2 * ({FACTOR_SQL})) AS INTEGER) AS height FROM pp JOIN cal USING (ppi)""")
def target_size(spark, sf_dir):
    rows = _with_ppi(spark, sf_dir).join(F.broadcast(calibrations(spark)), "ppi")  # two rows
    factor = geo.scale_factor(F.col("ppi"), F.col("width_mm"), F.col("correction_factor"))
    return rows.select(
        "p_partkey",
        geo.target_size((3000 + 17 * F.col("p_size")) * 2, factor).alias("width"),
        geo.target_size((5000 + 13 * F.col("p_size")) * 2, factor).alias("height"),
    )


@query(f"WITH {CALIBRATION_SQL}, {PPI_SQL} SELECT p_partkey, ppi, width_mm, CASE WHEN width_mm IS NULL THEN 'Errore downscale: ppi ' || ppi END AS error FROM pp LEFT JOIN cal USING (ppi)")
def ppi_broadcast_join(spark, sf_dir):
    rows = _with_ppi(spark, sf_dir).join(F.broadcast(calibrations(spark)), "ppi", "left")
    error = F.when(F.col("width_mm").isNull(), F.concat(F.lit("Errore downscale: ppi "), F.col("ppi")))
    return rows.select("p_partkey", "ppi", "width_mm", error.alias("error"))


PATH_SQL = "u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages)"


def _paths(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("path"))


@query(f"WITH {PATH_SQL} SELECT page_id, regexp_extract(path, '([^/]*)$', 1) AS name, regexp_extract(path, '([^/]*)/[^/]*$', 1) AS parent_name, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent FROM u")
def path_parts(spark, sf_dir):
    from rasterloom.sources.files import with_path_parts

    return with_path_parts(_paths(spark, sf_dir)).select("page_id", "name", "parent_name", "parent")


@query(f"WITH {PATH_SQL} SELECT page_id, 'out/sr_2x/' || regexp_extract(path, '([^/]*)/[^/]*$', 1) || '/' || regexp_extract(path, '([^/]*)$', 1) AS out_path FROM u")
def output_path(spark, sf_dir):
    from rasterloom.sources.files import with_path_parts

    rows = with_path_parts(_paths(spark, sf_dir))
    return rows.select("page_id", F.concat_ws("/", F.lit("out/sr_2x"), "parent_name", "name").alias("out_path"))


@query("""SELECT page_id, TRY_CAST(nullif(regexp_extract('scan_' || (CASE WHEN page_id % 3 = 0 THEN '400' WHEN page_id % 3 = 1 THEN '600' ELSE 'x' END) || '.tif', '_([0-9]+)\\.', 1), '') AS INTEGER) AS ppi FROM pages""")
def ppi_from_name(spark, sf_dir):
    from rasterloom.sources.files import ppi_from_name as named

    rest = F.col("page_id") % 3
    name = F.concat(F.lit("scan_"), F.when(rest == 0, "400").when(rest == 1, "600").otherwise("x"), F.lit(".tif"))
    return _t(spark, sf_dir, "pages").select("page_id", named(name).alias("ppi"))


@query("SELECT doc_id, n_chars >= 10000 AS valid, CASE WHEN n_chars < 10000 THEN 'file too small' END AS error FROM documents")
def validity_check(spark, sf_dir):
    error = rel.validity(F.col("n_chars"))
    return _t(spark, sf_dir, "documents").select("doc_id", error.isNull().alias("valid"), error.alias("error"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti_join(spark, sf_dir):
    return rel.pending(_t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels"), ["doc_id"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') THEN 'done'
WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'needs_downscale' ELSE 'needs_sr' END AS stage FROM orders""")
def stage_status(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey")
    return rel.stage_status(orders, lines, lines.where("l_linestatus = 'F'"), "o_orderkey")


GRID_SQL = "grid AS (SELECT d.v AS device, p.v AS processes, t.v AS threads FROM (VALUES ('CPU'), ('GPU')) d(v), (VALUES (1), (2), (4), (8)) p(v), (VALUES (1), (2), (4), (8)) t(v))"
EVENT_LOG_SQL = """ev AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'CPU' ELSE 'GPU' END AS device, CAST(pow(2, user_id % 4) AS INTEGER) AS processes,
CAST(pow(2, (user_id // 4) % 3) AS INTEGER) AS threads, value AS avg_time FROM events)"""


def _grid(spark) -> DataFrame:
    from rasterloom.plans.tuning import GRID

    return rel.grid(spark.range(1), **GRID)


def _event_log(spark, sf_dir) -> DataFrame:
    user = F.col("user_id")
    return _t(spark, sf_dir, "events").select(
        "event_id",
        F.when(user % 2 == 0, "CPU").otherwise("GPU").alias("device"),
        F.pow(F.lit(2), user % 4).cast("int").alias("processes"),
        F.pow(F.lit(2), F.floor(user / 4) % 3).cast("int").alias("threads"),
        F.col("value").alias("avg_time"),
    )


@query(f"WITH {GRID_SQL} SELECT device, processes, threads FROM grid")
def grid_cross(spark, sf_dir):
    return _grid(spark)


@query(f"WITH {GRID_SQL}, {EVENT_LOG_SQL} SELECT * FROM grid EXCEPT SELECT device, processes, threads FROM ev")
def grid_anti_join(spark, sf_dir):
    return rel.pending(_grid(spark), _event_log(spark, sf_dir), ["device", "processes", "threads"])


@query("""WITH a AS (SELECT p_partkey AS l, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part), b AS (SELECT c_custkey AS r, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer)
SELECT coalesce(a.pos, b.pos) AS pos, a.l AS "left", b.r AS "right" FROM a FULL OUTER JOIN b ON a.pos = b.pos""")
def zip_align(spark, sf_dir):
    return rel.zip_aligned(_t(spark, sf_dir, "part"), _t(spark, sf_dir, "customer"), "p_partkey", "c_custkey")


@query("""WITH c AS (SELECT source AS folder, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 100 AS part, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT folder, CAST(part AS INTEGER) AS part, n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS images FROM c GROUP BY folder, part, n""")
def folder_to_images(spark, sf_dir):
    """The images of each folder, in order, in lists of a hundred; folders without any have no row."""
    lists = rel.listed(_t(spark, sf_dir, "documents").withColumnRenamed("source", "folder"), "folder", "doc_id", 100)
    return lists.select("folder", "part", "n", F.array_join(F.col("items").cast("array<string>"), ",").alias("images"))


@query("SELECT source AS folder, count(*) AS n, bool_and(n_chars >= 1000) AS passed FROM documents GROUP BY source")
def all_passed(spark, sf_dir):
    return rel.all_passed(_t(spark, sf_dir, "documents").withColumnRenamed("source", "folder"), "folder", F.col("n_chars") >= 1000)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def first_rows(spark, sf_dir):
    return rel.first_rows(_t(spark, sf_dir, "orders"), 100, "o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT p_brand AS folder, round(avg(greatest(p_size * 30.0::DOUBLE, p_retailprice)), 6) AS avg_long, round(avg(least(p_size * 30.0::DOUBLE, p_retailprice)), 6) AS avg_short FROM part GROUP BY p_brand")
def avg_long_short(spark, sf_dir):
    from rasterloom.plans.ppi import average_sides

    a, b = F.col("p_size") * 30.0, F.col("p_retailprice")
    rows = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("folder"), F.greatest(a, b).alias("long_px"), F.least(a, b).alias("short_px"))
    return average_sides(rows).select("folder", F.round("avg_long", 6).alias("avg_long"), F.round("avg_short", 6).alias("avg_short"))


@query("SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) - count(*) FILTER (WHERE event_type = 'error') AS success FROM events GROUP BY user_id")
def folder_errors(spark, sf_dir):
    return rel.failure_totals(_t(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error")


@query("SELECT count(DISTINCT user_id) AS folders, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type <> 'error') AS success FROM events")
def success_error_totals(spark, sf_dir):
    rows = folder_errors(spark, sf_dir)
    return rows.agg(F.count("*").alias("folders"), F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.sum("success").alias("success"))


@query(f"WITH {EVENT_LOG_SQL} SELECT device, processes, threads, avg_time FROM ev ORDER BY avg_time, event_id LIMIT 1")
def best_config(spark, sf_dir):
    from rasterloom.plans.tuning import best

    return best(_event_log(spark, sf_dir), "event_id")


@query(f"WITH {EVENT_LOG_SQL} SELECT coalesce(bool_or(device = 'CPU' AND avg_time > 60), false) AS cpu_exceeded FROM ev")
def cpu_exceeded(spark, sf_dir):
    found = F.bool_or((F.col("device") == "CPU") & (F.col("avg_time") > config.EARLY_STOP_S))
    return _event_log(spark, sf_dir).agg(F.coalesce(found, F.lit(False)).alias("cpu_exceeded"))


@query("SELECT c_nationkey, c_custkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name DESC, c_custkey DESC) AS rn FROM customer) WHERE rn = 1")
def last_per_group(spark, sf_dir):
    return rel.last_rows(_t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name"), "c_nationkey", ["c_name", "c_custkey"])


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn > 2")
def drop_last_two(spark, sf_dir):
    return rel.without_last(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"])


CHUNK_SQL = "c AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM documents)"


@query(f"WITH {CHUNK_SQL} SELECT source, doc_id, CAST(pos // CAST(ceil(n / 4.0::DOUBLE) AS BIGINT) AS INTEGER) AS chunk FROM c")
def chunk_ceil(spark, sf_dir):
    return rel.chunks(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], 4).select("source", "doc_id", "chunk")


@query(f"WITH {CHUNK_SQL} SELECT source, doc_id, CAST(pos // greatest(1, n // 8) AS INTEGER) AS chunk FROM c")
def chunk_floor(spark, sf_dir):
    rows = rel.chunks(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], 8, "floor")
    return rows.select("source", "doc_id", "chunk")


@query("""SELECT e.event_id, e.event_type FROM events e LEFT JOIN (SELECT event_type, min(event_id) AS stop FROM events WHERE value > 400 GROUP BY event_type) s USING (event_type)
WHERE stop IS NULL OR e.event_id <= stop""")
def early_stop(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rel.early_stopped(rows, "event_type", "event_id", "value", 400.0).select("event_id", "event_type")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def topk_size(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(5)


LOG_SQL = "log AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CASE WHEN event_type = 'error' THEN 'CRASH' ELSE event_type END AS filename FROM events)"


def _log(spark, sf_dir) -> DataFrame:
    name = F.when(F.col("event_type") == "error", "CRASH").otherwise(F.col("event_type"))
    return _t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), name.alias("filename"))


@query(f"WITH {LOG_SQL} SELECT event_id, timestamp, filename, row_number() OVER (ORDER BY timestamp, filename, event_id) AS rn FROM log")
def log_sort(spark, sf_dir):
    from rasterloom.sources.logs import numbered

    return numbered(_log(spark, sf_dir), "timestamp", "filename", "event_id")


@query(f"WITH {LOG_SQL} SELECT event_id, timestamp, filename, row_number() OVER (ORDER BY filename = 'CRASH', timestamp, filename, event_id) AS rn FROM log")
def log_sort_crash_last(spark, sf_dir):
    from rasterloom.sources.logs import numbered

    return numbered(_log(spark, sf_dir).withColumn("crash", F.col("filename") == "CRASH"), "crash", "timestamp", "filename", "event_id").drop("crash")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def ts_format(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("SELECT o_orderkey, printf('%.2f', o_totalprice) AS total_time, printf('%.4f', o_totalprice) AS avg_time FROM orders")
def time_format(spark, sf_dir):
    price = F.col("o_totalprice").cast("double")
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.format_string("%.2f", price).alias("total_time"), F.format_string("%.4f", price).alias("avg_time"))


STEP_SQL = "CASE WHEN user_id % 4 = 0 THEN 'CRASH' WHEN user_id % 4 = 1 THEN 'super_resolution' WHEN user_id % 4 = 2 THEN 'downscale' ELSE 'run' END"


def _step():
    rest = F.col("user_id") % 4
    return F.when(rest == 0, "CRASH").when(rest == 1, "super_resolution").when(rest == 2, "downscale").otherwise("run")


@query(f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CASE WHEN user_id % 4 = 0 THEN 'CRASH' ELSE 'img_' || event_id || '.png' END AS filename, {STEP_SQL} AS step,
'false' AS status, 'Errore ' || {STEP_SQL} || ': ' || value AS error, CASE WHEN user_id % 4 <> 0 THEN 'in/' || user_id || '/img_' || event_id || '.png' END AS full_path
FROM (SELECT *, CAST(CAST(value AS INTEGER) AS VARCHAR) AS v FROM (SELECT * REPLACE (CAST(trunc(value) AS INTEGER) AS value) FROM events)) WHERE event_type = 'error'""")
def failure_rows(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").where("event_type = 'error'")
    path = F.concat(F.lit("in/"), "user_id", F.lit("/img_"), "event_id", F.lit(".png"))
    error = F.concat(F.lit("Errore "), _step(), F.lit(": "), F.col("value").cast("int"))
    return rel.failure_rows(rows, _step(), error, path, "ts")


@query("""SELECT event_id, CASE WHEN value < 5 THEN 'super_resolution' WHEN value < 10 THEN 'validate_super_resolution' WHEN value < 15 THEN 'downscale'
WHEN value < 20 THEN 'validate_downscale' END AS failed_step, value >= 20 AS success FROM events""")
def stage_machine(spark, sf_dir):
    from rasterloom.plans.pipeline import first_failure

    v = F.col("value")
    failed = first_failure({"super_resolution": v >= 5, "validate_super_resolution": v >= 10, "downscale": v >= 15, "validate_downscale": v >= 20})
    return _t(spark, sf_dir, "events").select("event_id", failed.alias("failed_step"), failed.isNull().alias("success"))


def _files(spark, sf_dir) -> DataFrame:
    """The stand-in images as decoded image rows with three equal channels."""
    data = F.unhex(F.array_join(F.transform("gs", lambda g: F.repeat(F.lpad(F.hex(g), 2, "0"), 3)), ""))
    eight = F.lit(8)
    rows = images(spark, sf_dir)
    return rows.select(F.col("vec_id").cast("string").alias("path"), eight.alias("height"), eight.alias("width"), F.lit(3).alias("channels"), data.alias("data"))


def _first_channel(rows: DataFrame) -> DataFrame:
    """vec_id, y, x, v of image rows."""
    rows = rows.select(F.col("path").cast("long").alias("vec_id"), "height", "width", F.hex("data").alias("bytes"))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1)))
    value = F.conv(F.substring("bytes", F.col("i") * 6 + 1, F.lit(2)), 16, 10).cast("int")
    return rows.select("vec_id", F.floor(F.col("i") / F.col("width")).cast("int").alias("y"), (F.col("i") % F.col("width")).alias("x"), value.alias("v"))


@query(f"WITH {IMAGES_SQL} SELECT vec_id, y, x, gs[(y // 2) * 8 + x // 2 + 1] AS v FROM im, (SELECT CAST(range AS INTEGER) AS y FROM range(16)) a, (SELECT CAST(range AS INTEGER) AS x FROM range(16)) b")
def sr_nearest(spark, sf_dir):
    """Tiles of 4 with an overlap of 2, upscaled twice and blended, are the upscaled image again."""
    return _first_channel(tiles.superresolved(_files(spark, sf_dir), tiles.nearest, 2, 4, 2))


@query(f"WITH {IMAGES_SQL} SELECT vec_id, y // 2 AS y, x // 2 AS x, CAST(floor(sum(b) / 4.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS v FROM px GROUP BY vec_id, y // 2, x // 2")
def area_resize(spark, sf_dir):
    rows = _files(spark, sf_dir).withColumns({"target_height": F.lit(4), "target_width": F.lit(4)})
    return _first_channel(tiles.resized(rows, "area"))


def _lanczos_sql(name: str, target: int) -> str:
    """Weights (i, j, w) of eight pixels for each of ``target``."""
    x = f"((j + 0.5::DOUBLE) - (i + 0.5::DOUBLE) * 8 / {target}) / (8.0::DOUBLE / {target})"
    return f"""{name} AS (SELECT i, j, l / sum(l) OVER (PARTITION BY i) AS w FROM (SELECT i, j, CASE WHEN abs(d) >= 3 THEN 0.0::DOUBLE WHEN d = 0 THEN 1.0::DOUBLE
ELSE sin(pi() * d) / (pi() * d) * sin(pi() * d / 3) / (pi() * d / 3) END AS l FROM (SELECT i, j, {x} AS d FROM (SELECT CAST(range AS INTEGER) AS i FROM range({target})) a, (SELECT CAST(range AS INTEGER) AS j FROM range(8)) b)))"""


@query(f"""WITH {IMAGES_SQL}, {_lanczos_sql("wy", 6)}, {_lanczos_sql("wx", 5)}
SELECT vec_id, wy.i AS y, wx.i AS x, CAST(greatest(0, least(255, floor(sum(b * wy.w * wx.w) + 0.5::DOUBLE))) AS INTEGER) AS v FROM px JOIN wy ON wy.j = px.y JOIN wx ON wx.j = px.x GROUP BY vec_id, wy.i, wx.i""")
def lanczos_resize(spark, sf_dir):
    rows = _files(spark, sf_dir).withColumns({"target_height": F.lit(6), "target_width": F.lit(5)})
    return _first_channel(tiles.resized(rows))


def _drawn(spark, sf_dir, draw) -> DataFrame:
    """An image row for each part, made by ``draw`` (p_partkey, p_size), a gray array.

    Parts are few bytes and come in few files, their images are many: they are dealt out before they are drawn.
    """
    import numpy as np
    import pyarrow as pa

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["path", "height", "width", "channels", "data"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _DRAWN_ROWS):
                rows = []
                for part in batch.slice(at, _DRAWN_ROWS).to_pylist():
                    image = draw(part["p_partkey"], part["p_size"]).astype(np.uint8)
                    rows.append((str(part["p_partkey"]), *image.shape, 3, np.repeat(image, 3).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    parts = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return parts.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(run, schema.IMAGE)


#: Images drawn at a time, some tens of kilobytes each.
_DRAWN_ROWS = 64


def _rectangle(key: int, size: int):
    import numpy as np

    image = np.zeros((size + 30, size + 40))
    image[5 : 5 + size + 4, 7 : 7 + size % 7 + 9] = 200
    return image


def _diamond_or_rectangle(key: int, size: int):
    import numpy as np

    if size % 2 == 0:
        return _rectangle(key, size)
    y, x = np.indices((2 * size + 5, 2 * size + 5)) - (size + 2)
    return np.where(abs(y) + abs(x) <= size, 200, 0)


@query("SELECT p_partkey, 2.0::DOUBLE * (p_size + 3 + p_size % 7 + 8) AS perimeter, (p_size + 3) * (p_size % 7 + 8) * 1.0::DOUBLE AS area FROM part")
def perimeter_area(spark, sf_dir):
    """Of the contour of a drawn rectangle, through its border's pixel centres."""
    from rasterloom.operators.images import outlines

    found = outlines(_drawn(spark, sf_dir, _rectangle))
    return found.select(F.col("path").cast("long").alias("p_partkey"), "perimeter", "area")


@query("""SELECT p_partkey, round(CASE WHEN p_size % 2 = 0 THEN greatest(p_size + 3, p_size % 7 + 8) ELSE p_size * sqrt(2.0::DOUBLE) END, 6) AS long_px,
round(CASE WHEN p_size % 2 = 0 THEN least(p_size + 3, p_size % 7 + 8) ELSE p_size * sqrt(2.0::DOUBLE) END, 6) AS short_px FROM part""")
def contour_min_rect(spark, sf_dir):
    """The smallest rectangle around a drawn rectangle, or around a diamond, whose sides are not the axes'."""
    from rasterloom.functions import kernels
    from rasterloom.operators.images import measured

    rects = measured(_drawn(spark, sf_dir, _diamond_or_rectangle), lambda image: kernels.measure_page(image, 150))
    sides = [F.round(f(F.col("rect.w"), F.col("rect.h")), 6).alias(n) for f, n in ((F.greatest, "long_px"), (F.least, "short_px"))]
    return rects.select(F.col("path").cast("long").alias("p_partkey"), *sides)


def _ruler_template():
    """A gray bar of 70 x 14 in a black field of 80 x 20."""
    import numpy as np

    out = np.zeros((20, 80), np.uint8)
    out[3:17, 5:75] = 70
    return out


def _detected(spark, sf_dir, detector: str, draw) -> DataFrame:
    from rasterloom.operators.images import detected

    found = detected(_drawn(spark, sf_dir, draw), _ruler_template(), [detector])
    rect = F.col(detector)
    columns = {"cx": rect["cx"], "cy": rect["cy"], "long_px": F.greatest(rect["w"], rect["h"]), "short_px": F.least(rect["w"], rect["h"])}
    return found.select(F.col("path").cast("long").alias("p_partkey"), *(F.round(c, 6).alias(n) for n, c in columns.items()))


def _with_ruler(key: int, size: int):
    import numpy as np

    image = np.zeros((60, 140))
    y, x = key * 5 % 37, key * 7 % 55
    image[y : y + 20, x : x + 80] = _ruler_template()
    return image


def _flat(key: int, size: int):
    import numpy as np

    return np.full((30 + size % 20, 4 * (30 + size % 20)), 90)


@query("SELECT p_partkey, (4 * (30 + p_size % 20) - 1) / 2.0::DOUBLE AS cx, (29 + p_size % 20) / 2.0::DOUBLE AS cy, 4.0::DOUBLE * (30 + p_size % 20) - 1 AS long_px, 29.0::DOUBLE + p_size % 20 AS short_px FROM part")
def detector_hsv(spark, sf_dir):
    return _detected(spark, sf_dir, "adaptive", _flat)


BAR_SQL = "SELECT p_partkey, p_partkey * 7 % 55 + 39.5::DOUBLE AS cx, p_partkey * 5 % 37 + 9.5::DOUBLE AS cy, 69.0::DOUBLE AS long_px, 13.0::DOUBLE AS short_px FROM part"


@query(BAR_SQL)
def detector_roi(spark, sf_dir):
    return _detected(spark, sf_dir, "region", _with_ruler)


@query("SELECT p_partkey, p_partkey * 7 % 55 + 40.0::DOUBLE AS cx, p_partkey * 5 % 37 + 10.0::DOUBLE AS cy, 80.0::DOUBLE AS long_px, 20.0::DOUBLE AS short_px FROM part")
def detector_multiscale(spark, sf_dir):
    return _detected(spark, sf_dir, "multiscale", _with_ruler)


@query(BAR_SQL)
def gray_detector(spark, sf_dir):
    return _detected(spark, sf_dir, "by_gray", _with_ruler)


def _scans(spark, sf_dir) -> str:
    """A folder tree of PNG files, one for each stand-in image, in its label's folder."""
    from rasterloom.sources import files

    folder = f"{files.shared_folder(spark)}/scans-{uuid.uuid4().hex}"
    named = images(spark, sf_dir).select(F.col("vec_id").cast("string").alias("path"), F.concat_ws("/", "label", F.concat("vec_id", F.lit(".png"))).alias("to"))
    rows = _files(spark, sf_dir).join(named, "path")
    failed = files.write_png(rows, folder, F.col("to")).where("error is not null").count()
    if failed:
        raise OSError(f"{failed} files were not written")
    return folder


def _number(name: str):
    return F.regexp_extract(name, "^([0-9]+)", 1).cast("long")


@query(f"WITH {IMAGES_SQL} SELECT vec_id, y, x, b AS v FROM px")
def image_scan(spark, sf_dir):
    """The pixels of image files, written and decoded again."""
    from rasterloom.sources import files

    rows = files.with_path_parts(files.images(spark, _scans(spark, sf_dir)))
    return _first_channel(rows.withColumn("path", _number("name")))


@query("SELECT vec_id, CAST(label AS VARCHAR) AS folder, '.png' AS suffix, true AS some FROM embeddings")
def binary_scan(spark, sf_dir):
    from rasterloom.sources import files

    rows = files.image_files(files.files(spark, _scans(spark, sf_dir)))
    return rows.select(_number("name").alias("vec_id"), F.col("parent_name").alias("folder"), files.suffix(F.col("name")).alias("suffix"), (F.col("length") > 0).alias("some"))


@query("SELECT 'Part ' || p_partkey AS key, p_name || ' : ' || p_brand AS value FROM part UNION ALL SELECT 'Empty ' || p_partkey, '' FROM part")
def exif_parse(spark, sf_dir):
    """Lines of "Key : Value", of which values hold the separator or are empty."""
    from rasterloom.sources import files

    folder = f"{files.shared_folder(spark)}/exif-{uuid.uuid4().hex}"
    part = _t(spark, sf_dir, "part")
    lines = part.select(F.concat(F.lit("Part "), "p_partkey", F.lit("   : "), "p_name", F.lit(" : "), "p_brand").alias("value"))
    lines.union(part.select(F.concat(F.lit("Empty "), "p_partkey", F.lit(" : ")))).write.text(folder)
    return files.exif(spark, folder).select("key", "value")


@query("SELECT CASE WHEN n_nationkey < 15 THEN 1 ELSE 2 END AS run, n_nationkey || '.txt' AS name FROM nation")
def stream_resume(spark, sf_dir):
    """Three runs over a folder, the second after more files came, the third without any: each file is seen once."""
    from rasterloom.sources import files
    from rasterloom.streaming import resume

    folder = f"{files.shared_folder(spark)}/incoming-{uuid.uuid4().hex}"
    nation = _t(spark, sf_dir, "nation")
    for run, condition in ((1, "n_nationkey < 15"), (2, "n_nationkey >= 15"), (3, "false")):
        come = nation.where(condition)
        come.select(F.col("n_name").alias("value"), F.concat("n_nationkey", F.lit(".txt")).alias("name")).write.partitionBy("name").mode("append").text(f"{folder}/in")

        def keep(batch, number, run=run):
            seen = batch.select(F.lit(run).alias("run"), F.regexp_extract("parent_name", "name=(.*)", 1).alias("name"))
            seen.write.mode("overwrite").parquet(f"{folder}/seen/batch={run}-{number}")

        resume.resume(spark, f"{folder}/in", f"{folder}/checkpoint", keep, "*.txt")
    return spark.read.parquet(f"{folder}/seen").select("run", "name")


@query(f"WITH {LOG_SQL} SELECT event_id || '.png' AS filename, filename AS step, timestamp FROM log WHERE filename = 'CRASH'")
def log_stream(spark, sf_dir):
    """Log rows that arrive as files and are appended to the log by a stream that ends when all are drained."""
    from rasterloom.sources import files
    from rasterloom.streaming import resume

    folder = f"{files.shared_folder(spark)}/log-{uuid.uuid4().hex}"
    rows = _log(spark, sf_dir).where("filename = 'CRASH'")
    rows = rows.select("timestamp", F.concat("event_id", F.lit(".png")).alias("filename"), F.col("filename").alias("step"), F.lit("false").alias("status"), F.lit("x").alias("error"), F.lit(None).cast("string").alias("full_path"))
    rows.write.csv(f"{folder}/in", header=True)
    resume.drained(resume.failure_stream(spark, f"{folder}/in", schema.FAILURE_LOG), f"{folder}/log", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/log").select("filename", "step", "timestamp")
