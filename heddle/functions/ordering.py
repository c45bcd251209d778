"""Ranks, running sums, quantiles and exact random samples over large groups.

A plain window puts a whole group into one task.  When a group can hold a large
part of the table, these helpers split it: the rows are sorted into slices, each
slice is summed, and only the slice totals are accumulated per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.runtime import cut, join_keys, quoted


def hash_key(seed: int | str, *cols: str | Column) -> Column:
    """Reproducible pseudo-random text key of a row."""
    parts = [c.cast("string") if isinstance(c, Column) else quoted(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_unit(seed: int | str, *cols: str | Column) -> Column:
    """Reproducible pseudo-random number in (0, 1) from the first 12 hex digits."""
    digits = F.substring(hash_key(seed, *cols), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**12)


def hash_normal(seed: int | str, *cols: str | Column) -> Column:
    """Reproducible standard normal number (Box-Muller on two hash uniforms)."""
    u = hash_unit(f"{seed}a", *cols)
    v = hash_unit(f"{seed}b", *cols)
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * 3.141592653589793 * v)


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str | Column],
) -> DataFrame:
    """Inclusive running sums per key in the given order, without one-task groups.

    ``order`` must decide the order within a key completely.
    """
    keys, order = list(keys), list(order)
    bounds = [quoted(c) for c in [*keys, *order]]
    sliced = cut(
        df.repartitionByRange(*bounds).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    exprs = {n: (quoted(c) if isinstance(c, str) else c) for n, c in sums.items()}
    totals = sliced.groupBy(*[quoted(k) for k in keys], "_slice").agg(
        *[F.sum(c).alias(f"_o_{n}") for n, c in exprs.items()]
    )
    across = (
        Window.partitionBy(*[quoted(k) for k in keys])
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[quoted(k) for k in keys],
        "_slice",
        *[F.coalesce(F.sum(f"_o_{n}").over(across), F.lit(0)).alias(f"_o_{n}") for n in exprs],
    )
    within = (
        Window.partitionBy(*[quoted(k) for k in keys], "_slice")
        .orderBy(*[quoted(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = sliced.withColumns({n: F.sum(c).over(within) for n, c in exprs.items()})
    joined = join_keys(summed, offsets, [*keys, "_slice"])
    return joined.withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in exprs}).drop(
        "_slice", *[f"_o_{n}" for n in exprs]
    )


def running_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """Number the rows of each key from 1 in the given order."""
    return prefix_sums(df, keys, order, {name: F.lit(1).cast("long")})


def suffix_min(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Least ``value`` from each row on, per key in the given order, without one-task groups."""
    keys, order = list(keys), list(order)
    cols = [quoted(k) for k in keys]
    sliced = cut(
        df.repartitionByRange(*cols, *[quoted(c) for c in order]).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    lows = sliced.groupBy(*cols, "_slice").agg(F.min(quoted(value)).alias("_low"))
    after = Window.partitionBy(*cols).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    later = lows.select(*cols, "_slice", F.min("_low").over(after).alias("_later"))
    within = Window.partitionBy(*cols, "_slice").orderBy(*[quoted(c) for c in order]).rowsBetween(0, Window.unboundedFollowing)
    lowest = sliced.withColumn(name, F.min(quoted(value)).over(within))
    return join_keys(lowest, later, [*keys, "_slice"]).withColumn(name, F.least(name, "_later")).drop("_slice", "_later")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per key.

    Equal values are counted before anything is sorted, so repeated values cost
    one row each.
    """
    keys = list(keys)
    cols = [quoted(k) for k in keys]
    n = F.count(F.lit(1)) if weight is None else F.sum(quoted(weight))
    counts = (
        df.filter(quoted(value).isNotNull())
        .groupBy(*cols, quoted(value).cast("double").alias("_v"))
        .agg(n.alias("_n"))
    )
    running = prefix_sums(counts, keys, ["_v"], {"_upto": "_n"})
    sizes = running.groupBy(*cols).agg(F.max("_upto").alias("_size"))
    if keys:
        ranked = join_keys(running, sizes, keys)
    else:
        ranked = running.withColumn("_size", sizes.select("_size").scalar())
    aggs = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("_size") - 1)
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}_{name}"))
    picked = ranked.groupBy(*cols, "_size").agg(*aggs)
    out = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return picked.select(*cols, *out)


def sample_exact(
    df: DataFrame,
    id_col: str,
    n: int | Column,
    seed: int = 42,
    keys: Sequence[str] = (),
    hex_digits: int = 3,
) -> DataFrame:
    """Exactly ``n`` rows (of each key), first in hash order.

    Rows are counted per hash prefix; whole prefixes below the cut pass without a
    shuffle of their own, and only the prefix at the cut is ranked, so no task ever
    sees a whole group.
    """
    keys = list(keys)
    wanted = F.lit(n) if isinstance(n, int) else n
    marked = df.withColumn("_h", hash_key(seed, id_col)).withColumn(
        "_b", F.substring("_h", 1, hex_digits)
    )
    cols = [quoted(k) for k in keys]
    counts = marked.groupBy(*cols, "_b").agg(F.count(F.lit(1)).alias("_in"))
    before = Window.partitionBy(*cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    placed = join_keys(marked, starts, [*keys, "_b"])
    below = F.col("_before") + F.col("_in") <= wanted
    inside = Window.partitionBy(*cols, "_b").orderBy("_h", quoted(id_col))
    edge = placed.filter(~below & (F.col("_before") < wanted)).withColumn("_rn", F.row_number().over(inside))
    edge = edge.filter(F.col("_rn") + F.col("_before") <= wanted).drop("_rn")
    return placed.filter(below).unionByName(edge).drop("_h", "_b", "_before", "_in")
