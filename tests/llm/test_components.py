"""Connected components against a search."""

import random

from rasterloom.llm.components import connected_components


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, 6), (6, 7)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    rng.shuffle(edges)
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want, done = {}, set()
    for x in sorted(near):
        if x in done:
            continue
        queue = [x]
        done.add(x)
        while queue:
            y = queue.pop()
            want[y] = x
            for z in near[y] - done:
                done.add(z)
                queue.append(z)
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    found = connected_components(df).collect()
    assert len(found) == len(want) and {r.node: r.component for r in found} == want
    assert connected_components(df.limit(0)).count() == 0
