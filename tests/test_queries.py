"""Every query with SQL agrees with DuckDB on the smallest tables."""

import pytest

from compare import mismatch
from rasterloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert mismatch(spark, SF, QUERIES[name], ORACLE_SQL[name]) is None


def test_drawn_images_are_dealt_out(spark):
    """Parts come in one file of one row group, whose images no single task draws."""
    from rasterloom import queries

    assert queries._drawn(spark, SF, queries._rectangle).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_equal_images_are_measured_once():
    from rasterloom.operators import images

    seen = []
    once = images._once(lambda row: (seen.append(row["path"]), row["height"]))
    rows = [{"path": p, "height": h, "width": 2, "channels": 1, "data": d} for p, h, d in (("a", 1, b"xy"), ("b", 1, b"xy"), ("c", 1, b"xz"), ("d", 2, b"xy"))]
    assert [once(r)[1] for r in rows] == [1, 1, 1, 2] and seen == ["a", "c", "d"]
    assert [once(r | {"data": None})[1] for r in rows[:2]] == [1, 1] and seen == ["a", "c", "d", "a", "b"]


def test_only_the_named_detectors_run(spark):
    from rasterloom import queries
    from rasterloom.operators import images

    found = images.detected(queries._drawn(spark, SF, queries._flat), queries._ruler_template(), ["adaptive"])
    assert found.columns == ["path", "adaptive", "error"] and found.where("error is null").count() == found.count()
