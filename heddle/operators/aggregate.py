"""Group counts, pseudobulks, summaries, crosstabs and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.ordering import exact_quantiles
from heddle.functions.runtime import cut, drop_missing, join_keys, quoted
from heddle.functions.scalar import as_text, log1p_base
from heddle.operators.joins import first_per_key
from heddle.operators.obs import in_range


def value_counts(df: DataFrame, *columns: str, dropna: bool = True) -> DataFrame:
    source = drop_missing(df, list(columns)) if dropna else df
    return source.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("count"))


def qc_metrics(obs: DataFrame, x: DataFrame, var: DataFrame, patterns: Mapping[str, str], name: str = "feature_name") -> DataFrame:
    """Counts and detected features per cell plus the share of each pattern group.

    Cells without entries get zeros; the share of an empty cell is zero.
    """
    flags = var.select(
        "gene_id", *[F.coalesce(quoted(name).rlike(p), F.lit(False)).alias(f"_is_{k}") for k, p in patterns.items()]
    )
    total = F.sum("value")
    per_cell = x.join(flags, "gene_id").groupBy("cell_id").agg(
        total.alias("n_counts"),
        F.count_if(F.col("value") != 0).alias("n_genes"),
        *[
            F.sum(F.when(F.col(f"_is_{k}"), F.col("value")).otherwise(0.0)).alias(f"_sum_{k}")
            for k in patterns
        ],
    )
    out = obs.join(per_cell, "cell_id", "left").na.fill(
        0, ["n_counts", "n_genes", *[f"_sum_{k}" for k in patterns]]
    )
    shares = {
        f"percent_{k}": F.when(F.col("n_counts") > 0, 100.0 * F.col(f"_sum_{k}") / F.col("n_counts")).otherwise(0.0)
        for k in patterns
    }
    return out.withColumns(shares).drop(*[f"_sum_{k}" for k in patterns])


def dataset_summary(
    obs: DataFrame, var: DataFrame, sample: str, donor: str, categories: Sequence[str] = ()
) -> DataFrame:
    """One row of dataset statistics; ``obs`` carries ``n_counts`` and ``n_genes``."""
    slim = cut(obs.select(*dict.fromkeys([sample, donor, "n_counts", "n_genes", *categories])), "summary")
    counted = {"sample": value_counts(slim, sample), "donor": value_counts(slim, donor)}
    measures = [
        df.select(F.lit(f"cells_per_{tag}").alias("measure"), F.col("count").cast("double").alias("v"))
        for tag, df in counted.items()
    ] + [
        slim.select(F.lit(f"{c}_per_cell").alias("measure"), quoted(f"n_{c}").cast("double").alias("v"))
        for c in ("counts", "genes")
    ]
    stacked = reduce(DataFrame.unionByName, measures)
    medians = exact_quantiles(stacked, ["measure"], "v", {"median": 0.5})
    names = ["cells_per_sample", "cells_per_donor", "counts_per_cell", "genes_per_cell"]
    pick = lambda m: F.max(F.when(F.col("measure") == m, F.col("median")))
    singles = [
        slim.agg(F.count(F.lit(1)).alias("n_cells")),
        var.agg(F.count(F.lit(1)).alias("n_genes")),
        *[
            df.agg(F.count(F.lit(1)).alias(f"n_{tag}s"), F.avg("count").alias(f"mean_cells_per_{tag}"))
            for tag, df in counted.items()
        ],
        medians.agg(*[pick(m).alias(f"median_{m}") for m in names]),
    ]
    for c in categories:
        distinct = slim.select(as_text(slim, c).alias(c)).distinct()
        singles.append(distinct.agg(F.array_join(F.array_sort(F.collect_list(c)), ",").alias(c)))
    fields = {c: one.select(quoted(c)).scalar() for one in singles[1:] for c in one.columns}
    return singles[0].withColumns(fields)


def total_summary(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.sum(quoted(c)).alias(c) for c in columns])


def group_sizes(obs: DataFrame, groups: Sequence[str], min_cells: int = 2) -> DataFrame:
    cols = [quoted(g) for g in groups]
    sizes = drop_missing(obs, list(groups)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_cells"))
    return sizes.filter(F.col("n_cells") >= min_cells)


def pseudobulk(
    obs: DataFrame, x: DataFrame, groups: Sequence[str], how: str = "sum", min_cells: int = 2
) -> DataFrame:
    """Sum or mean of the matrix per group and feature; small groups are left out.

    The mean divides by all cells of the group, so absent entries count as zero.
    """
    groups = list(groups)
    sizes = group_sizes(obs, groups, min_cells)
    cells = obs.select("cell_id", *[quoted(g) for g in groups])
    sums = x.join(cells, "cell_id").groupBy(*[quoted(g) for g in groups], "gene_id").agg(
        F.sum("value").alias("value")
    )
    out = sums.join(sizes, groups)
    if how == "mean":
        out = out.withColumn("value", F.col("value") / F.col("n_cells"))
    elif how != "sum":
        raise ValueError(f"unknown aggregation {how}")
    return out.select(*[quoted(g) for g in groups], "gene_id", "value")


def group_metadata(obs: DataFrame, group: str, order: str = "cell_id", min_cells: int = 2) -> DataFrame:
    """First row of every group that is large enough."""
    kept = group_sizes(obs, [group], min_cells).select(quoted(group))
    return first_per_key(drop_missing(obs, [group]), [group], [order]).join(kept, group, "left_semi")


def pair_group(obs: DataFrame, group: str, sample: str, name: str = "pseudo_group") -> DataFrame:
    return obs.withColumn(name, F.concat_ws("_", as_text(obs, group), as_text(obs, sample)))


def detected_features(x: DataFrame, var: DataFrame, min_cells: int = 1, min_counts: float = 0) -> DataFrame:
    """Mask of features that occur in enough cells."""
    stats = x.groupBy("gene_id").agg(
        F.count_if(F.col("value") > 0).alias("n_cells"), F.sum("value").alias("total")
    )
    return (
        var.select("gene_id")
        .join(stats, "gene_id", "left")
        .select(
            "gene_id",
            F.coalesce("n_cells", F.lit(0)).alias("n_cells"),
            (
                (F.coalesce("n_cells", F.lit(0)) >= min_cells)
                & (F.coalesce("total", F.lit(0.0)) >= min_counts)
            ).alias("nonzero_genes"),
        )
    )


def large_batches(obs: DataFrame, batch: str, min_cells: int = 2) -> DataFrame:
    """Mask of rows whose batch has enough rows."""
    sizes = obs.groupBy(quoted(batch)).agg((F.count(F.lit(1)) >= min_cells).alias("batch_kept"))
    return join_keys(obs, sizes, [batch])


def unique_rows(df: DataFrame) -> DataFrame:
    """Distinct rows by their text form, so maps and arrays can be compared too."""
    marked = df.withColumn("_text", F.to_json(F.struct(*[quoted(c) for c in df.columns])))
    return first_per_key(marked, ["_text"], ["_text"]).drop("_text")


def crosstab(df: DataFrame, row: str, column: str, normalize: bool = False) -> DataFrame:
    """Wide count table, optionally as shares of the row total."""
    counts = drop_missing(df, [row, column]).groupBy(quoted(row)).pivot(column).count().na.fill(0)
    if not normalize:
        return counts
    values = [c for c in counts.columns if c != row]
    total = reduce(lambda a, b: a + b, [quoted(c) for c in values])
    return counts.select(quoted(row), *[(quoted(c) / total).alias(c) for c in values])


def pivot_mean(df: DataFrame, ids: Sequence[str], variable: str, value: str) -> DataFrame:
    """Long to wide with the mean; all-missing columns are dropped."""
    present = df.filter(quoted(value).isNotNull()).select(quoted(variable)).distinct()
    names = sorted(r[0] for r in present.collect())
    return df.groupBy(*[quoted(i) for i in ids]).pivot(variable, names).agg(F.avg(quoted(value)))


def fraction_removed(df: DataFrame, group: str, status: str = "qc_status") -> DataFrame:
    """Counts per status and the failed share, rounded to two digits."""
    flags = ["passed", "failed", "ambiguous"]
    counts = df.groupBy(quoted(group)).agg(*[F.count_if(quoted(status) == s).alias(s) for s in flags])
    return counts.withColumn(
        "fraction_removed", F.round(F.col("failed") / (F.col("passed") + F.col("failed") + F.col("ambiguous")), 2)
    )


def composition(df: DataFrame, category: str, covariate: str) -> DataFrame:
    """Counts per (category, covariate) with the category total and the share."""
    counts = value_counts(df, category, covariate)
    totals = counts.groupBy(quoted(category)).agg(F.sum("count").alias("total"))
    return counts.join(totals, category).withColumn("proportion", F.col("count") / F.col("total"))


def threshold_summary(
    df: DataFrame, bounds: Mapping[str, Mapping[str, tuple[float | None, float | None]]]
) -> DataFrame:
    """Passed and removed rows for several threshold sets in one pass over the data."""
    names = list(bounds)
    passed = {
        n: reduce(lambda a, b: a & b, [in_range(k, lo, hi) for k, (lo, hi) in bounds[n].items()], F.lit(True))
        for n in names
    }
    wide = df.agg(
        F.count(F.lit(1)).alias("n_total"), *[F.count_if(c).alias(f"_p_{n}") for n, c in passed.items()]
    )
    metrics = list(dict.fromkeys(k for n in names for k in bounds[n]))
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(n).alias("threshold_type"),
                    F.col(f"_p_{n}").alias("n_passed"),
                    *[
                        F.lit(bounds[n].get(k, (None, None))[j]).cast("double").alias(f"{k}_{side}")
                        for k in metrics
                        for j, side in enumerate(("min", "max"))
                    ],
                )
                for n in names
            ]
        )
    )
    out = wide.select("n_total", rows.alias("r")).select("r.*", "n_total")
    out = out.withColumn("n_removed", F.col("n_total") - F.col("n_passed"))
    share = lambda c: F.when(F.col("n_total") > 0, F.col(c) / F.col("n_total")).otherwise(0.0)
    return out.withColumns({"passed_frac": share("n_passed"), "removed_frac": share("n_removed")})


def dotplot(obs: DataFrame, x: DataFrame, group: str, markers: DataFrame, scale: bool = True) -> DataFrame:
    """Mean value and share of expressing cells per (group, marker feature).

    Every group is paired with every marker it lacks through the marker list of
    the group, so absent entries count as zero.
    """
    sizes = drop_missing(obs, [group]).groupBy(quoted(group)).agg(F.count(F.lit(1)).alias("n"))
    genes = markers.select("gene_id").distinct()
    stats = (
        x.join(genes, "gene_id", "left_semi")
        .join(obs.select("cell_id", quoted(group)), "cell_id")
        .groupBy(quoted(group), "gene_id")
        .agg(F.sum("value").alias("_s"), F.count_if(F.col("value") > 0).alias("_k"))
    )
    listed = sizes.withColumn("_g", genes.agg(F.collect_list("gene_id")).scalar())
    full = listed.withColumn("gene_id", F.explode("_g")).drop("_g")
    out = full.join(stats, [group, "gene_id"], "left").select(
        quoted(group),
        "gene_id",
        (F.coalesce("_s", F.lit(0.0)) / F.col("n")).alias("mean_value"),
        (F.coalesce("_k", F.lit(0)) / F.col("n")).alias("fraction"),
    )
    if scale:
        ends = out.groupBy("gene_id").agg(F.min("mean_value").alias("_lo"), F.max("mean_value").alias("_hi"))
        span = F.col("_hi") - F.col("_lo")
        out = out.join(ends, "gene_id").withColumn(
            "scaled", F.when(span > 0, (F.col("mean_value") - F.col("_lo")) / span).otherwise(0.0)
        ).drop("_lo", "_hi")
    return out


def id_overlap(df: DataFrame, id_col: str, sample: str, max_overlap: int = 5, min_size: int = 50) -> DataFrame:
    """Number of ids per exact set of samples they occur in.

    Ids that occur in more than ``max_overlap`` samples belong to no reported set
    and are dropped before sets are built, so every set is small.
    """
    pairs = df.select(quoted(id_col).alias("_id"), quoted(sample).cast("string").alias("_s")).distinct()
    wide = pairs.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= max_overlap)
    sets = pairs.join(wide, "_id").groupBy("_id").agg(
        F.array_join(F.array_sort(F.collect_list("_s")), ",").alias("samples"),
        F.count(F.lit(1)).alias("n_samples"),
    )
    return sets.groupBy("samples", "n_samples").agg(F.count(F.lit(1)).alias("n_ids")).filter(
        F.col("n_ids") >= min_size
    )


def distribution(df: DataFrame, group: str, value: str) -> DataFrame:
    """Size, mean and exact quartiles of a number per group."""
    quartiles = exact_quantiles(df, [group], value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    basic = df.filter(quoted(value).isNotNull()).groupBy(quoted(group)).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(quoted(value)).alias("min"),
        F.max(quoted(value)).alias("max"),
    )
    return join_keys(basic, quartiles, [group])


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin from 0; the largest value falls into the last bin."""
    width = (high - low) / bins
    raw = F.when(width > 0, F.floor((value - low) / width)).otherwise(F.lit(0))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram_2d(
    df: DataFrame, x: str, y: str, bins: int = 100, log_x: float = 1, log_y: float = 1, hue: str | None = None
) -> DataFrame:
    """Counts on a grid of two metrics, on linear or log axes from 0 to the maximum."""
    axis = lambda c, base: log1p_base(quoted(c), base) if base > 1 else quoted(c).cast("double")
    points = df.select(
        axis(x, log_x).alias("_x"), axis(y, log_y).alias("_y"), *([quoted(hue)] if hue else [])
    ).na.drop(subset=["_x", "_y"])
    top_x, top_y = points.agg(F.max("_x")).scalar(), points.agg(F.max("_y")).scalar()
    binned = points.select(
        bin_index(F.col("_x"), F.lit(0.0), top_x, bins).alias("bin_x"),
        bin_index(F.col("_y"), F.lit(0.0), top_y, bins).alias("bin_y"),
        *([quoted(hue)] if hue else []),
    )
    return binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n"))


def distance_histogram(distances: DataFrame, bins: int = 50, value: str = "dist", weight: str | None = None) -> DataFrame:
    """Histogram of a distance matrix with the share of nonzero entries; ``weight`` counts the entries of a row."""
    n = F.lit(1) if weight is None else quoted(weight)
    top = distances.agg(F.max(quoted(value))).scalar()
    entries = F.sum(F.when(quoted(value).isNotNull(), n))
    share = distances.agg((F.sum(F.when(quoted(value) > 0, n).when(quoted(value).isNotNull(), 0)) / entries).alias("_s")).scalar()
    return (
        distances.select(bin_index(quoted(value), F.lit(0.0), top, bins).alias("bin"), n.cast("long").alias("_n"))
        .groupBy("bin")
        .agg(F.sum("_n").alias("n"))
        .withColumn("nonzero_share", share)
    )


def benchmark_rollup(records: Sequence[DataFrame], params: DataFrame, category: str, value: str) -> DataFrame:
    """Stacked run records joined with their parameters; categories carry their best value."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)
    shared = [c for c in params.columns if c in stacked.columns]
    joined = stacked.join(params, shared)
    best = joined.groupBy(quoted(category)).agg(F.min(quoted(value)).alias("best"))
    return joined.join(best, category)


def compare_implementations(
    df: DataFrame, ids: Sequence[str], implementation: str, value: str, base: str, other: str
) -> DataFrame:
    """Wide value per implementation, the ratio, and its maximum per metric."""
    side = lambda name: F.max(F.when(quoted(implementation) == name, quoted(value))).alias(name)
    wide = df.groupBy(*[quoted(i) for i in ids]).agg(side(base), side(other))
    wide = wide.withColumn("ratio", quoted(base) / quoted(other))
    top = wide.groupBy(quoted(ids[0])).agg(F.max("ratio").alias("max_ratio"))
    return wide.join(top, ids[0])


def result_slices(df: DataFrame, sets: Sequence[Sequence[str]], value: str) -> DataFrame:
    """The same rows summarised for several groupings at once."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[quoted(c) for c in s] for s in sets], *[quoted(c) for c in names]).agg(
        F.grouping_id().alias("slice"), F.count(F.lit(1)).alias("n"), F.avg(quoted(value)).alias("mean")
    )


def group_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct present groups plus ``all``."""
    groups = df.select(quoted(column).cast("string").alias("group")).na.drop().distinct()
    return groups.union(df.sparkSession.createDataFrame([("all",)], "group string"))
