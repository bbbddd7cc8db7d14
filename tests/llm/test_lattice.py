"""E8 decoding and embedding near-dedup against brute force."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rasterloom.llm import common, lattice


def test_roots_and_decoding():
    roots = lattice.roots()
    assert len(roots) == 240 and np.allclose((roots**2).sum(1), 2)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 8)) * 2
    near = lattice.nearest_e8(x)
    assert ((near * 2) % 1 == 0).all() and (near.sum(1) % 2 == 0).all()
    away = ((x - near) ** 2).sum(1)
    others = ((x[:, None, :] - near[:, None, :] - roots) ** 2).sum(2)
    assert (away[:, None] <= others + 1e-9).all() and away.max() <= 1 + 1e-9


def brute(rows, cosine=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [np.array(v, float) / np.abs(v).max() if o else None for (_, v), o in zip(rows, ok)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, queue = {i}, [i]
        while queue:
            for j in near[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links(spark, kind):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 64))
    rows = []
    for i, v in enumerate(base):
        rows.append((i, v))
        side = rng.standard_normal(64)
        side -= side @ v / (v @ v) * v
        side *= np.linalg.norm(v) / np.linalg.norm(side)
        for k, c in enumerate((0.999, 0.97, 0.955, 0.94)):
            rows.append((1000 + 10 * i + k, c * v + np.sqrt(1 - c * c) * side))
    crowd = rng.standard_normal(64)
    rows += [(5000 + i, crowd + 0.05 * rng.standard_normal(64)) for i in range(60)]
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in rows]
    rows += [(9000, None), (9001, []), (9002, [0.0] * 64), (9003, [float("nan")] * 64), (9004, [1.0] * 63 + [None]), (9005, [float("inf")] * 64)]
    rows += [(9006, rows[0][1]), (9006, rows[0][1]), (None, rows[5][1]), (9007, [2 * x for x in rows[0][1]]), (9008, [1.0, 2.0]), (9009, [1.0, 2.01]), (9010, [5.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, n int, vid int")
    found = lattice.near_duplicates(df).collect()
    assert Counter(map(tuple, found)) == Counter(brute(rows))


def test_cells_beyond_a_chunk(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(64)
    rows = [(i, (centre + 0.1 * rng.standard_normal(64)).astype(np.float32).astype(float).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vid long, embedding array<float>").selectExpr("vid", "1L as n", "embedding")
    counts, _ = lattice.linked(df, "<f4", chunk=16)
    want = {i: n for i, n, *_ in brute(rows) if n}
    assert {r.vid: r.links for r in counts.collect()} == want


def test_links_do_not_depend_on_the_number_of_vectors(spark):
    """The same links are found among 3000 close pairs, at the edge of the cosine, alone and beside 11,000 other vectors."""
    rng = np.random.default_rng(6)
    a, side, rest = (rng.standard_normal((n, 64)) for n in (3000, 3000, 11_000))
    a, side = a / np.linalg.norm(a, axis=1)[:, None], side - (side * a).sum(1)[:, None] * a / (a * a).sum(1)[:, None]
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side / np.linalg.norm(side, axis=1)[:, None]
    every = np.concatenate((a, b, rest)).astype(np.float32)

    def linked(count):
        df = spark.createDataFrame(pa.table({"vid": np.arange(count), "n": np.ones(count, np.int64), "embedding": list(every[:count])}))
        return {r.vid for r in lattice.linked(df, "<f4")[0].collect()}

    alone = linked(6000)
    assert linked(len(every)) == alone and len(alone) >= 5990


def test_tasks_of_many_vectors(spark, monkeypatch):
    """Many vectors are keyed by more tasks, their cells dealt out a table at a time and never broadcast; all links are found."""
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    near = [centre + 0.1 * rng.standard_normal(64) for _ in range(60)]
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate([*near, *rng.standard_normal((340, 64))])]
    plans, tasks = [], []

    def checkpointed(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = common.checkpointed(df)
        tasks.append(out.rdd.getNumPartitions() if "keys" in out.columns else 0)
        return out

    monkeypatch.setattr(lattice, "checkpointed", checkpointed)
    monkeypatch.setattr(lattice, "_VECTORS", 16, raising=False)
    monkeypatch.setattr(lattice, "_CELLS", 5000, raising=False)
    df = spark.createDataFrame(rows, "vid long, embedding array<float>").selectExpr("vid", "1L as n", "embedding")
    found = {r.vid: r.links for r in lattice.linked(df, "<f4")[0].collect()}
    assert found == {i: n for i, n, *_ in brute(rows) if n}
    assert max(tasks) == 25 and len(plans) == 1 + 10 + 1 and not any("BroadcastHashJoin" in p for p in plans)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.near_duplicates(df).count() == 0
