"""Random and ordered subsets with exact sizes, and ordering helpers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.ordering import hash_key, prefix_sums, sample_exact
from heddle.functions.runtime import drop_missing, quoted


def by_sample(
    obs: DataFrame, n_cell_max: int, sample_key: str, seed: int = 42, min_cells_per_sample: int = 100
) -> DataFrame:
    """Whole samples in random order until the limit is passed.

    Small samples are skipped.  A sample is taken while the cells before it do not
    exceed the limit, so the result may overshoot by one sample.
    """
    counts = (
        drop_missing(obs, [sample_key])
        .groupBy(quoted(sample_key))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_cells_per_sample)
        .withColumn("_h", hash_key(seed, sample_key))
    )
    running = prefix_sums(counts, [], ["_h"], {"_upto": "_n"})
    kept = running.filter(F.col("_upto") - F.col("_n") <= n_cell_max).select(quoted(sample_key))
    return obs.join(kept, sample_key, "left_semi")


def within_sample(
    obs: DataFrame,
    n_cell_max: int | None,
    sample_key: str,
    n_cells_per_sample: int | None = None,
    seed: int = 42,
    id_col: str = "cell_id",
) -> DataFrame:
    """The same number of random cells from each sample, in random sample order.

    Samples with fewer cells are skipped; samples are added until the limit is
    reached.
    """
    counts = drop_missing(obs, [sample_key]).groupBy(quoted(sample_key)).agg(F.count(F.lit(1)).alias("_n"))
    if n_cell_max is None or n_cells_per_sample is None:
        sizes = counts.agg(F.count(F.lit(1)).alias("samples"), F.sum("_n").alias("cells")).first()
        n_cell_max = (sizes["cells"] or 0) if n_cell_max is None else n_cell_max
        if n_cells_per_sample is None:
            n_cells_per_sample = int(n_cell_max / max(sizes["samples"], 1))
    eligible = counts.filter(F.col("_n") >= n_cells_per_sample).withColumn("_h", hash_key(seed, sample_key))
    ranked = prefix_sums(eligible, [], ["_h"], {"_at": F.lit(1).cast("long")})
    kept = ranked.filter((F.col("_at") - 1) * n_cells_per_sample < n_cell_max).select(quoted(sample_key))
    pool = obs.join(kept, sample_key, "left_semi")
    return sample_exact(pool, id_col, n_cells_per_sample, seed, [sample_key])


SUBSET_STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    "by_sample": by_sample,
    "within_sample": within_sample,
}


def bootstrap_ids(obs: DataFrame, id_col: str, n: int, boots: int, seed: int = 42) -> DataFrame:
    """Row ids of several subsamples without replacement, keyed by ``boot_id``."""
    keyed = obs.select(quoted(id_col)).withColumn(
        "boot_id", F.explode(F.array(*[F.lit(b) for b in range(boots)]))
    )
    marked = keyed.withColumn("_boot_row", F.concat_ws(":", F.col("boot_id"), quoted(id_col)))
    return sample_exact(marked, "_boot_row", n, seed, ["boot_id"]).drop("_boot_row")


def sample_fraction(obs: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """An exact share of the rows."""
    size = int(obs.count() * fraction)
    return sample_exact(obs, id_col, size, seed)


def balance_rest(obs: DataFrame, id_col: str, group: str, value: str, seed: int = 42) -> DataFrame:
    """The rows of one group and equally many random other rows, labelled ``rest``."""
    inside = quoted(group).eqNullSafe(F.lit(value))
    size = obs.filter(inside).count()
    rest = sample_exact(obs.filter(~inside), id_col, size, seed)
    return obs.filter(inside).withColumn("side", F.lit(value)).unionByName(rest.withColumn("side", F.lit("rest")))


def top_rows(df: DataFrame, score: str, n: int, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(quoted(score).desc_nulls_last(), *[quoted(t) for t in tie]).limit(n)


def sort_by(df: DataFrame, columns: Sequence[str], ascending: Sequence[bool]) -> DataFrame:
    order: list[Column] = [quoted(c).asc() if a else quoted(c).desc() for c, a in zip(columns, ascending)]
    return df.orderBy(*order)


def best_per_group(df: DataFrame, group: str, score: str, pick: str) -> DataFrame:
    """The row value with the best score; ties go to the smallest value."""
    best = F.min_by(quoted(pick), F.struct((-quoted(score).cast("double")).alias("s"), quoted(pick).alias("p")))
    return df.groupBy(quoted(group)).agg(best.alias(pick), F.max(quoted(score)).alias(score))
