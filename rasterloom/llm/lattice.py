"""Embedding near-dedup by lattice hashing.

A table projects unit vectors onto random orthonormal directions, eight to a block, scales them and finds the nearest
point of the E8 lattice in each block; the points together name a cell. A vector owns its cell and visits those
neighbouring cells, one lattice root away in one block, that are nearest to it; two vectors are candidates if one visits
or shares the cell that the other owns in some table. Tables and cells are the same whatever the number of vectors
(``LAYOUT``), so that whether two vectors link never depends on how many others there are. Cells without an owner and
another vector are dropped before vectors are sent anywhere, and cells beyond ``CHUNK`` are dealt out as pairs of chunks.
Inside, cosines are verified in double precision, and every link is counted in just one of the cells where its ends meet,
so that a task gives one row of counts for each vector and a spanning forest of links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import checkpointed, hot_join, table
from rasterloom.llm.components import connected_components

COSINE = 0.95
CHUNK = 1024
SEED = 11
#: Rows of a large cell that are compared at a time, the size up to which cells are compared side by side, and pairs at a time.
_ROWS, _SMALL, _PAIRS = 256, 48, 1 << 15
#: Vectors that a task sends to their cells, about, and cells that are dealt out at a time: a few tables, but one at least.
_VECTORS, _CELLS = 1 << 14, 1 << 23


class Layout(NamedTuple):
    """Tables, blocks of eight dimensions, visited cells, and the cell size: a pair at cosine 0.95 is some 0.32 apart."""

    tables: int
    blocks: int
    probes: int
    scale: float


#: A pair of 64 dimensions at cosine 0.951 meets with a probability of 0.9998; a vector meets some 10^-5 of all by chance.
LAYOUT = Layout(20, 3, 5, 0.75)


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a in (-1.0, 1.0):
            for b in (-1.0, 1.0):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    for signs in range(256):
        v = np.array([0.5 if signs >> k & 1 else -0.5 for k in range(8)])
        if bin(signs).count("1") % 2 == 0:
            out.append(v)
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of integers with an even sum: an odd sum is mended where rounding was worst."""
    near = np.rint(x)
    off = x - near
    odd = (near.sum(1) % 2) != 0
    worst = np.abs(off).argmax(1)
    rows = np.flatnonzero(odd)
    step = np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
    near[rows, worst[rows]] += step
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by halves (Conway and Sloane, 1982)."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def projections(dimension: int, tables: int, blocks: int, seed: int = SEED) -> np.ndarray:
    """(tables, dimension, 8 * blocks) with orthonormal columns; columns beyond the dimension are zero."""
    rng = np.random.default_rng([seed, dimension])
    out = np.zeros((tables, dimension, 8 * blocks))
    for t in range(tables):
        q, _ = np.linalg.qr(rng.standard_normal((dimension, min(8 * blocks, dimension))))
        out[t, :, : q.shape[1]] = q
    return out


def cells(unit: np.ndarray, plan: Layout) -> np.ndarray:
    """(vector, tables, 1 + probes) int64 keys of the cell that each unit vector owns and of those that it visits."""
    around, out = roots(), []
    mix = np.random.default_rng([SEED, unit.shape[1]]).integers(1, 1 << 62, (plan.blocks, 8), dtype=np.int64) | 1
    spread = np.sqrt(unit.shape[1] / min(8, unit.shape[1])) / plan.scale
    with np.errstate(over="ignore"):
        moves = np.concatenate([(np.rint(around * 2).astype(np.int64) * m).sum(1) for m in mix])
        for t, p in enumerate(projections(unit.shape[1], plan.tables, plan.blocks)):
            key, gains = np.zeros(len(unit), np.int64), []
            for b in range(plan.blocks):
                x = unit @ p[:, 8 * b : 8 * b + 8] * spread
                own = nearest_e8(x)
                key += (np.rint(own * 2).astype(np.int64) * mix[b]).sum(1)
                gains.append((x - own) @ around.T)
            gain = np.concatenate(gains, 1)
            chosen = np.argpartition(-gain, plan.probes, axis=1)[:, : plan.probes]
            keys = np.concatenate((key[:, None], key[:, None] + moves[chosen]), axis=1)
            out.append((keys ^ np.int64(t)) * np.int64(0x9E3779B97F4A7C15 - (1 << 64)))
    return np.stack(out, axis=1)


def _units(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length 1; scaled first, so that no square over- or underflows."""
    v = raw.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class _Part(NamedTuple):
    """Rows of cells, or of pairs of chunks of cells, in order of their groups, as they come to a task."""

    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    side: np.ndarray
    owner: np.ndarray
    vid: np.ndarray
    copies: np.ndarray
    keys: np.ndarray
    raw: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, plan: Layout) -> _Part:
        plain = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "low", "high", "side", "owner", "vid", "n")]
        keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).reshape(-1, plan.tables, 1 + plan.probes)
        raw = np.empty(batch.num_rows, object)
        raw[:] = batch.column("raw").to_pylist()
        return cls(*plain, keys, raw)

    def at(self, rows) -> _Part:
        return _Part(*(c[rows] for c in self))

    def with_more(self, other: _Part) -> _Part:
        return _Part(*(np.concatenate(c) for c in zip(self, other, strict=True)))

    def starts(self) -> np.ndarray:
        """The first row of each group."""
        same = (self.cell[1:] == self.cell[:-1]) & (self.low[1:] == self.low[:-1]) & (self.high[1:] == self.high[:-1])
        return np.concatenate(([0], np.flatnonzero(~same) + 1))


def _candidates(part: _Part, units: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (i, j), i < j, of one group, one of them an owner, whose cosine is ``cosine`` or more."""
    starts = part.starts()
    sizes = np.diff(np.append(starts, len(part.cell)))

    def close(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kept = (part.owner[i] | part.owner[j]) & ((part.low[i] == part.high[i]) | (part.side[i] != part.side[j]))
        i, j = i[kept], j[kept]
        kept = np.einsum("ij,ij->i", units[i], units[j]) >= cosine
        return i[kept], j[kept]

    small = sizes <= _SMALL
    owner = np.repeat(small, sizes)
    ends = np.repeat(starts + sizes, sizes)
    first = np.flatnonzero(owner)
    later = ends[first] - first - 1
    cut = np.searchsorted(np.cumsum(later), np.arange(_PAIRS, int(later.sum()) + _PAIRS, _PAIRS), "left") + 1
    for rows, more in zip(np.split(first, cut), np.split(later, cut), strict=True):
        if rows.size:
            i = np.repeat(rows, more)
            yield close(i, i + 1 + np.arange(i.size) - np.repeat(np.cumsum(more) - more, more))
    for a, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        rows = np.arange(a, a + size)
        for mine in np.split(rows, range(_ROWS, size, _ROWS)):
            others = rows[mine[0] - a :]
            i, j = np.nonzero(units[mine] @ units[others].T >= cosine - 1e-9)
            i, j = mine[i], others[j]
            for at in range(0, len(i), _PAIRS):
                x, y = i[at : at + _PAIRS], j[at : at + _PAIRS]
                yield close(x[x < y], y[x < y])


def _counted(part: _Part, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a link counts in this cell: the first table where its ends meet, and there the smaller of two such cells."""
    a, b = part.keys[i], part.keys[j]
    mine = (b == a[:, :, :1]).any(2)
    yours = (a == b[:, :, :1]).any(2)
    table = (mine | yours).argmax(1)
    rows = np.arange(len(i))
    most = np.iinfo(np.int64).max
    cell = np.minimum(np.where(mine[rows, table], a[rows, table, 0], most), np.where(yours[rows, table], b[rows, table, 0], most))
    return cell == part.cell[i]


def _verified(part: _Part, dtype: str, cosine: float) -> pa.RecordBatch:
    """(vid, links, root) of the rows that have links in their group; root is the first row linked with, in any steps."""
    found: list[tuple] = []
    lengths = np.fromiter(map(len, part.raw), np.int64, len(part.raw))
    for length in np.unique(lengths):
        mine = part.at(lengths == length)
        units = _units(np.frombuffer(b"".join(mine.raw), dtype).reshape(len(mine.raw), -1))
        counts, label = np.zeros(len(units), np.float64), np.arange(len(units))
        for i, j in _candidates(mine, units, cosine):
            left = _counted(mine, i, j)
            i, j = i[left], j[left]
            counts += np.bincount(i, mine.copies[j], len(units)) + np.bincount(j, mine.copies[i], len(units))
            while len(i):  # the smaller label wins until no link joins two labels
                low = np.minimum(label[i], label[j])
                before = label.copy()
                np.minimum.at(label, label[i], low)
                np.minimum.at(label, label[j], low)
                label = label[label]
                if (before == label).all():
                    break
        hit = np.flatnonzero(counts)
        found.append((mine.vid[hit], counts[hit].astype(np.int64), mine.vid[label[hit]]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["vid", "links", "root"])


def linked(vectors: DataFrame, dtype: str, cosine: float = COSINE, chunk: int = CHUNK, plan: Layout = LAYOUT) -> tuple[DataFrame, DataFrame]:
    """Of distinct ``vectors`` (vid long, n long copies, embedding): (vid, links), copies counted, and edges (u, v).

    Spark takes exploded cells for as small as their vectors, so no join here is left to its choice of a broadcast. Many
    vectors are keyed by more tasks, and their cells counted in several passes of a few tables, or one; none is left out.
    """
    total, width = vectors.count(), 1 + plan.probes
    if total > _VECTORS * vectors.rdd.getNumPartitions():
        vectors = vectors.repartition(-(-total // _VECTORS), "vid")
    tables = max(1, min(plan.tables, _CELLS // max(1, total * width)))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                raw = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(dtype)
                own = cells(_units(raw), plan)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.arange(0, k.size + 1, k.size // len(raw)), pa.int32()), pa.array(k.ravel()))
                    for k in (own, own[:, :, 0])
                ]
                packed = pa.array([v.tobytes() for v in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("vid"), part.column("n"), packed, *lists], ["vid", "n", "raw", "keys", "own"])

    schema = "vid long, n long, raw binary, keys array<long>, own array<long>"
    keyed = checkpointed(vectors.select("vid", "n", "embedding").mapInArrow(key, schema))
    mark = lambda owner: lambda c: F.struct(c.alias("cell"), F.lit(owner).alias("owner"))

    def dealt(first: int) -> DataFrame:
        own, keys = F.slice("own", first + 1, tables), F.slice("keys", first * width + 1, tables * width)
        marked = F.concat(F.transform(F.array_distinct(own), mark(True)), F.transform(F.array_except(keys, own), mark(False)))
        entries = keyed.select("vid", F.inline(marked))
        shared = entries.groupBy("cell").agg(F.count("*").alias("size"), F.count_if("owner").alias("owners"))
        shared = shared.where("size > 1 and owners > 0")
        shared = shared.select("cell", F.ceil(F.col("size") / chunk).cast("int").alias("chunks"))
        side = F.pmod(F.xxhash64("vid"), F.col("chunks").cast("long")).cast("int").alias("side")
        other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
        rows = entries.join(shared.hint("merge"), "cell").select("vid", "cell", "owner", side, other)
        return rows.select("vid", "cell", "owner", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))

    rows = reduce(DataFrame.union, [checkpointed(dealt(first)) for first in range(0, plan.tables, tables)])
    rows = rows.join(keyed.drop("own").hint("merge"), "vid")
    rows = rows.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Part | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = _Part.of(batch, plan)
            part = part if held is None else held.with_more(part)
            last = int(part.starts()[-1])
            held = part.at(slice(last, None))
            if last:
                yield _verified(part.at(slice(0, last)), dtype, cosine)
        if held is not None:
            yield _verified(held, dtype, cosine)

    results = checkpointed(rows.mapInArrow(verify, "vid long, links long, root long"))
    return results.groupBy("vid").agg(F.sum("links").alias("links")), results.select(F.col("vid").alias("u"), F.col("root").alias("v"))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Rows link if the cosine of their vectors, in double precision, is at least ``cosine``; n_links counts the other rows
    linked directly, component_id is the smallest vec_id that links reach, kept marks it. Equal vectors are compared
    once. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, vectors of
    different lengths never with each other. Repeated rows count each; rows without an id take part; other columns are
    ignored; an empty table gives none.
    """
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    kind = "float" if single else "double"
    v = F.col(embedding).cast(f"array<{kind}>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("embedding"))
    infinite = F.lit(float("inf")).cast(kind)
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    links = F.coalesce(~odd & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", F.when(links, F.col("embedding")).alias("embedding"))
    classes = rows.where("embedding is not null").groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = checkpointed(classes.withColumn("vid", F.monotonically_increasing_id()))
    counts, edges = linked(classes, "<f4" if single else "<f8", cosine)
    found = classes.join(counts, "vid", "left").join(connected_components(edges).withColumnRenamed("node", "vid"), "vid", "left")
    found = found.select(
        "embedding",
        "least",
        "n",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vid").alias("component"),
    )
    ids = found.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    found = checkpointed(hot_join(found, ids, "component", "classes", classes.count()).select("embedding", "n", "n_links", "component_id"))
    able = hot_join(rows.where("embedding is not null"), found, "embedding", "n", rows.count())
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = able.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id").union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: All pairs, which the query is held against on small tables.
ORACLE_SQL = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
n AS (SELECT r, vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.r AS x, b.r AS y, b.vec_id FROM n a JOIN n b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= {COSINE}),
reach AS (SELECT r AS x, r AS y, vec_id FROM v UNION SELECT reach.x, link.y, link.vec_id FROM reach JOIN link ON link.x = reach.y),
c AS (SELECT x, min(vec_id) AS component_id FROM reach GROUP BY x), k AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN c ON c.x = v.r LEFT JOIN k ON k.x = v.r"""


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
