"""Membership, ordered groups, chunks, grids, extremes and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom import config

SALTS = 64


def pending(inputs: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without an output."""
    return inputs.join(outputs.select(*keys), keys, "left_anti")


def stage_status(inputs: DataFrame, upscaled: DataFrame, final: DataFrame, key: str) -> DataFrame:
    """Adds ``stage``: done, needs_downscale or needs_sr, by which outputs exist."""
    marked = inputs.join(upscaled.select(key).distinct().withColumn("__up", F.lit(True)), key, "left")
    marked = marked.join(final.select(key).distinct().withColumn("__final", F.lit(True)), key, "left")
    stage = F.when(F.col("__final"), "done").when(F.col("__up"), "needs_downscale").otherwise("needs_sr")
    return marked.withColumn("stage", stage).drop("__up", "__final")


def last_rows(df: DataFrame, group: str, order: list[str], n: int = 1) -> DataFrame:
    """The last ``n`` rows of each group.

    A hot group is cut by salt first, so that the ranking that needs a group together sees ``n`` rows of a salt at most.
    """
    if n < 1:
        return df.limit(0)
    falling = [F.col(c).desc() for c in order]
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    df = df.withColumn("__salt", salt)
    df = df.withColumn("__rn", F.row_number().over(Window.partitionBy(group, "__salt").orderBy(*falling))).where(F.col("__rn") <= n)
    df = df.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy(*falling))).where(F.col("__rn") <= n)
    return df.drop("__rn", "__salt")


def without_last(df: DataFrame, group: str, order: list[str], n: int = 2) -> DataFrame:
    """All but the last ``n`` rows of each group; groups of ``n`` or fewer vanish. ``order`` must tell rows apart."""
    last = last_rows(df, group, order, n).select(group, *order)
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(last[c]) for c in (group, *order)])
    return df.join(last, same, "left_anti")


def _cuts(df: DataFrame, column: str) -> list:
    """Up to ``SALTS`` values that cut the column into ranges of like size, from a sample by hash of bounded size."""
    by_hash = df.where(F.col(column).isNotNull()).select(column).orderBy(F.xxhash64(column), column)
    found = sorted({r[0] for r in by_hash.limit(SALTS * 16).collect()})
    return found[:: max(1, len(found) // SALTS)]


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``pos``, from 0 in each group, and ``group_size``.

    The first key, of any type, is cut into ranges whose counts are summed up, so no group is ranked in one task but for
    the rows that share a key. The cuts come from a small job that runs while the plan is built.
    """
    cuts = F.array(*map(F.lit, _cuts(df, order[0])))
    some = F.size(F.filter(cuts, lambda c: c < F.col(order[0]))) if df.schema[order[0]].dataType.simpleString() != "boolean" else F.lit(0)
    df = df.withColumn("__b", F.when(F.col(order[0]).isNull(), -1).otherwise(some))
    counts = df.groupBy(group, "__b").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("__g"),
        F.col("__b").alias("__k"),
        F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__base"),
        F.sum("__c").over(Window.partitionBy(group)).alias("group_size"),
    )
    rank = F.row_number().over(Window.partitionBy(group, "__b").orderBy(*order)) - 1
    df = df.withColumn("__r", rank)
    joined = df.join(counts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__b") == F.col("__k")))
    return joined.withColumn("pos", F.col("__base") + F.col("__r")).drop("__b", "__g", "__k", "__base", "__r")


def chunks(df: DataFrame, group: str, order: list[str], parts: int, rounding: str = "ceil") -> DataFrame:
    """Adds ``chunk``: runs of ceil(n / parts) rows of a group, or of max(1, floor(n / parts)), the last one shorter."""
    df = positions(df, group, order)
    size = F.ceil(F.col("group_size") / parts) if rounding == "ceil" else F.greatest(F.lit(1), F.floor(F.col("group_size") / parts))
    return df.withColumn("chunk", F.floor(F.col("pos") / size).cast("int")).drop("pos", "group_size")


def grid(df: DataFrame, **axes: list) -> DataFrame:
    """All combinations of the axes' literal values; bounded by the arguments, not by data."""
    rows = df.sparkSession.range(1).select(F.lit(1).alias("__one"))
    for name, values in axes.items():
        rows = rows.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return rows.drop("__one")


def zip_aligned(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows of both sides by position: pos, left, right; the longer side's rest meets nulls."""
    one = F.lit(0).alias("g")
    a = positions(left.select(one, F.col(left_order).alias("left")), "g", ["left"]).select("pos", "left")
    b = positions(right.select(one, F.col(right_order).alias("right")), "g", ["right"]).select("pos", "right")
    return a.join(b, "pos", "full_outer").select("pos", "left", "right")


def early_stopped(df: DataFrame, group: str, order: str, value: str, limit: float) -> DataFrame:
    """Rows of a group up to and with the first whose value exceeds the limit; one aggregation finds where."""
    first = df.where(F.col(value) > limit).groupBy(F.col(group).alias("__g")).agg(F.min(order).alias("__stop"))
    joined = df.join(first, F.col(group).eqNullSafe(F.col("__g")), "left")
    return joined.where(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).drop("__g", "__stop")


def first_largest(df: DataFrame, group: str, value: Column, ordinal: str, *columns: str) -> DataFrame:
    """The row of each group with the largest value, the first of equals."""
    picked = F.max_by(F.struct(*columns), F.struct(value, -F.col(ordinal)))
    return df.groupBy(group).agg(picked.alias("r")).select(group, "r.*")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of a stated order, the same again for the same input."""
    return df.orderBy(*order).limit(n)


def all_passed(df: DataFrame, group: str, passed: Column) -> DataFrame:
    """Per group: n, and whether every row passed; a null counts as not passed."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(passed, F.lit(False))).alias("passed"))


def listed(df: DataFrame, group: str, item: str, most: int = 1000) -> DataFrame:
    """(group, part, n, items): the items of each group in order, in lists of ``most``, so that no list grows with a group."""
    placed = positions(df.select(group, item), group, [item]).withColumn("part", F.floor(F.col("pos") / most).cast("int"))
    lists = placed.groupBy(group, "part").agg(F.first("group_size").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    return lists.select(group, "part", "n", "items")


def failure_totals(df: DataFrame, group: str, failed: Column) -> DataFrame:
    """Per group: n, errors, success."""
    out = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(failed).alias("errors"))
    return out.withColumn("success", F.col("n") - F.col("errors"))


def failure_rows(df: DataFrame, step: Column, error: Column, full_path: Column, ts: str) -> DataFrame:
    """Log rows of failures; a crash has CRASH for its file and step."""
    crash = step == "CRASH"
    return df.select(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(crash, "CRASH").otherwise(F.element_at(F.split(full_path, "/"), -1)).alias("filename"),
        step.alias("step"),
        F.lit(False).cast("string").alias("status"),
        error.alias("error"),
        F.when(~crash, full_path).alias("full_path"),
    )


def validity(size: Column) -> Column:
    """Reason why a file of this size is not valid before any decoding; null if it may be."""
    return F.when(size.isNull(), "file does not exist").when(size < config.MIN_FILE_BYTES, "file too small")


def contour_ok(perimeter: Column, w: Column, h: Column, min_perimeter=config.MIN_PERIMETER, min_area=config.MIN_AREA) -> Column:
    """Large and long enough to be the ruler; equality passes."""
    aspect = F.greatest(w, h) / F.least(w, h)
    return (perimeter >= min_perimeter) & (w * h >= min_area) & (aspect >= config.MIN_ASPECT)
