"""Normalisation, feature selection, scaling, principal components, set scores.

A matrix is a long table ``(cell_id, gene_id, value)`` without zeros.  Means,
variances and ranks count the absent zeros through the number of cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.ordering import exact_quantiles, prefix_sums, running_index, sample_exact
from heddle.functions.runtime import cut, join_keys, quoted
from heddle.operators.aggregate import detected_features, large_batches
from heddle.operators.components import TOLERANCE, components
from heddle.operators.obs import match_features

#: Up to this length of array rows, components come from a feature x feature matrix.
GRAM_FEATURES = 4_096


def cell_totals(x: DataFrame) -> DataFrame:
    return x.groupBy("cell_id").agg(F.sum("value").alias("total"))


def normalize_total(x: DataFrame, target_sum: float | None = None) -> DataFrame:
    """Scale every cell to the same total: the given one or the median total."""
    totals = cell_totals(x)
    if target_sum is None:
        totals = cut(totals, "totals")  # for the median and for the scaling
        median = exact_quantiles(totals.filter("total > 0"), [], "total", {"target": 0.5})
        target = median.select("target").scalar()
    else:
        target = F.lit(float(target_sum))
    scaled = F.when(F.col("total") > 0, F.col("value") * target / F.col("total")).otherwise(F.col("value"))
    return x.join(totals, "cell_id").select("cell_id", "gene_id", scaled.alias("value"))


def log1p(x: DataFrame) -> DataFrame:
    return x.withColumn("value", F.log1p("value"))


def feature_moments(x: DataFrame, n_cells: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and sample variance per feature over all cells, zeros included."""
    sums = x.groupBy(*[quoted(k) for k in keys], "gene_id").agg(
        F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_ss")
    )
    return sums.select(
        *[quoted(k) for k in keys],
        "gene_id",
        (F.col("_s") / n_cells).alias("mean"),
        ((F.col("_ss") - F.col("_s") * F.col("_s") / n_cells) / (n_cells - 1)).alias("var"),
    )


def count_rows(df: DataFrame) -> Column:
    """Row count as a scalar that is evaluated inside the query."""
    return df.agg(F.count(F.lit(1))).scalar()


def feature_index(features: DataFrame) -> DataFrame:
    """Dense position from 0 of every feature, in id order."""
    indexed = running_index(features.select("gene_id").distinct(), [], ["gene_id"], "_at")
    return indexed.select("gene_id", (F.col("_at") - 1).cast("int").alias("idx"))


def densify(lists: DataFrame, keys: Sequence[str], width: int, adjust: Callable | None = None) -> DataFrame:
    """Dense array ``v`` from the position and value lists ``_i`` and ``_v`` of each row.

    Rows are expanded in blocks of bounded size; ``adjust`` may change a block.
    """
    step = max(1, 4_000_000 // max(width, 1))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), step):
                pdf = batch.iloc[start : start + step]
                dense = np.zeros((len(pdf), width))
                for r, (i, v) in enumerate(zip(pdf["_i"], pdf["_v"])):
                    if i is not None:
                        dense[r, np.asarray(i, dtype=int)] = v
                yield pdf[list(keys)].assign(v=list(dense if adjust is None else adjust(dense)))

    types = ", ".join(f"`{k}` {lists.schema[k].dataType.simpleString()}" for k in keys)
    return lists.select(*[quoted(k) for k in keys], "_i", "_v").mapInPandas(fill, f"{types}, v array<double>")


def to_vectors(
    x: DataFrame, obs: DataFrame, index: DataFrame, n_features: int, adjust: Callable | None = None
) -> DataFrame:
    """One dense array per cell over the indexed features; empty cells are all zero.

    Only the few values of a cell pass through Python; its row gets its full width where it is read.
    """
    rows = (
        x.join(index, "gene_id")
        .groupBy("cell_id")
        .agg(F.collect_list("idx").alias("_i"), F.collect_list("value").alias("_v"))
    )
    if adjust is not None:
        return densify(obs.select("cell_id").join(rows, "cell_id", "left"), ["cell_id"], n_features, adjust)

    @F.udf(VectorUDT())
    def packed(idx, values):
        return Vectors.sparse(n_features, dict(zip(idx, values, strict=True)))

    # Few bytes become long rows: cells are dealt to all shuffle partitions, however small these are.
    cells = obs.select("cell_id").repartition(int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell_id")
    filled = cells.join(rows.select("cell_id", packed("_i", "_v").alias("_v")), "cell_id", "left")
    dense = F.when(F.col("_v").isNotNull(), vector_to_array("_v")).otherwise(F.array_repeat(F.lit(0.0), n_features))
    return filled.select("cell_id", dense.cast("array<double>").alias("v"))


def from_vectors(vectors: DataFrame, index: DataFrame, vector: str = "v") -> DataFrame:
    """Long form of dense rows; zeros are left out."""
    # The outer form makes each row once: the inner one also makes it to see that it is not empty.
    long = vectors.select("cell_id", F.posexplode_outer(quoted(vector)).alias("idx", "value")).filter("value != 0")
    return long.join(index, "idx").select("cell_id", "gene_id", "value")


def scale(
    x: DataFrame, obs: DataFrame, features: DataFrame, max_value: float | None = 10.0
) -> DataFrame:
    """Z-scores of the selected features over all cells, clipped; dense by nature.

    The long result is built from one array per cell next to one array of the features'
    ids, means and deviations, so no pair is shuffled or joined.
    """
    index = cut(feature_index(features), "features")
    n = index.count()
    vectors = to_vectors(x, obs, index, n)
    moments = feature_moments(x, count_rows(obs))
    stats = index.join(moments, "gene_id", "left").select(
        "idx", F.coalesce("mean", F.lit(0.0)).alias("m"), F.sqrt("var").alias("sd")
    )
    listed = stats.join(index, "idx").agg(F.sort_array(F.collect_list(F.struct("idx", "gene_id", "m", "sd")))).scalar()
    long = vectors.select("cell_id", F.explode(F.arrays_zip(F.col("v").alias("v"), listed.alias("f"))).alias("_e"))
    mean, spread = F.col("_e")["f"]["m"], F.col("_e")["f"]["sd"]
    z = (F.col("_e")["v"] - mean) / F.when(spread > 0, spread).otherwise(1.0)
    if max_value is not None:
        z = F.least(F.greatest(z, F.lit(-float(max_value))), F.lit(float(max_value)))
    return long.select("cell_id", z.alias("value"), F.col("_e")["f"]["gene_id"].alias("gene_id"))


def highly_variable(
    x: DataFrame,
    obs: DataFrame,
    var: DataFrame,
    n_top: int | None = None,
    batch: str | None = None,
    n_bins: int = 20,
    min_mean: float = 0.0125,
    max_mean: float = 3.0,
    min_disp: float = 0.5,
    groups: Sequence[str] = (),
    enabled: bool = True,
) -> DataFrame:
    """Highly variable features by normalised dispersion of log-normalised values.

    With ``batch`` the statistics are taken per batch and averaged over batches; a
    feature without entries in a batch counts there as zero.  ``groups``
    adds further keys (used for unions over groups); all keys run in one job.
    """
    groups = list(groups)
    if not enabled:
        return var.select("gene_id", F.lit(True).alias("highly_variable"))
    kept = obs
    if batch is not None:
        pair = obs.withColumn("_pair", F.struct(*[quoted(g) for g in [*groups, batch]]))
        kept = large_batches(pair, "_pair").filter("batch_kept").drop("_pair", "batch_kept")
    keys = [*groups, *([batch] if batch else [])]
    cells = kept.select("cell_id", *[quoted(k) for k in keys])
    linear = x.withColumn("value", F.expm1("value")).join(cells, "cell_id")
    if keys:
        sizes = cells.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        sums = linear.groupBy(*[quoted(k) for k in keys], "gene_id").agg(
            F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_ss")
        )
        stats = sums.join(sizes, keys)
        n = F.col("_n")
    else:
        stats = linear.groupBy("gene_id").agg(
            F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_ss")
        )
        n = count_rows(cells)
    mean = F.col("_s") / n
    variance = (F.col("_ss") - F.col("_s") * F.col("_s") / n) / (n - 1)
    stats = stats.select(
        *[quoted(k) for k in keys],
        "gene_id",
        F.log1p(mean).alias("means"),
        F.log(F.when(variance > 0, variance / mean)).alias("dispersions"),
    )
    stats = normalized_dispersion(cut(stats, "dispersion"), keys, n_bins)
    if n_top is None:
        hit = (
            F.col("means").between(min_mean, max_mean)
            & (F.col("dispersions_norm") >= min_disp)
        )
        stats = stats.withColumn("highly_variable", F.coalesce(hit, F.lit(False)))
    else:
        stats = mark_top(stats, keys, [("dispersions_norm", True)], n_top)
    if batch is not None:
        n_batches = kept.groupBy(*[quoted(g) for g in groups]).agg(F.countDistinct(quoted(batch)).alias("_b"))
        stats = join_keys(stats, n_batches, groups) if groups else stats.withColumn("_b", n_batches.scalar())
        combined = stats.groupBy(*[quoted(g) for g in groups], "gene_id").agg(
            *[
                (F.coalesce(F.sum(c), F.lit(0.0)) / F.max("_b")).alias(c)
                for c in ("means", "dispersions", "dispersions_norm")
            ],
            F.count_if("highly_variable").alias("highly_variable_nbatches"),
        )
        if n_top is None:
            hit = F.col("means").between(min_mean, max_mean) & (F.col("dispersions_norm") >= min_disp)
            stats = combined.withColumn("highly_variable", F.coalesce(hit, F.lit(False)))
        else:
            order = [("highly_variable_nbatches", True), ("dispersions_norm", True)]
            stats = mark_top(combined, groups, order, n_top)
    return stats


def normalized_dispersion(stats: DataFrame, keys: Sequence[str], n_bins: int) -> DataFrame:
    """Z-score of the dispersion among features of similar mean.

    Means are cut into equal-width bins whose upper edge belongs to the bin; a
    bin with one feature scores 1.
    """
    cols = [quoted(k) for k in keys]
    ends = stats.groupBy(*cols).agg(F.min("means").alias("_lo"), F.max("means").alias("_hi"))
    placed = join_keys(stats, ends, keys) if keys else stats.withColumns(
        {c: ends.select(c).scalar() for c in ("_lo", "_hi")}
    )
    step = F.ceil((F.col("means") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * n_bins)
    bin_no = F.when(F.col("_hi") > F.col("_lo"), F.greatest(step, F.lit(1))).otherwise(1)
    placed = placed.withColumn("_bin", F.least(bin_no, F.lit(n_bins)).cast("int")).drop("_lo", "_hi")
    bins = placed.groupBy(*cols, "_bin").agg(
        F.avg("dispersions").alias("_m"), F.stddev_samp("dispersions").alias("_sd")
    )
    out = join_keys(placed, bins, [*keys, "_bin"])
    z = (F.col("dispersions") - F.col("_m")) / F.col("_sd")
    alone = F.when(F.col("dispersions").isNotNull(), F.lit(1.0))
    return out.withColumn(
        "dispersions_norm", F.when(F.col("_sd").isNull(), alone).when(F.col("_sd") > 0, z)
    ).drop("_bin", "_m", "_sd")


def mark_top(stats: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], n: int) -> DataFrame:
    """Flag the first ``n`` features (per key) by the given order, then by id."""
    by = [quoted(c).desc_nulls_last() if desc else quoted(c) for c, desc in order]
    ranked = stats.filter(quoted(order[-1][0]).isNotNull())
    if keys:
        w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*by, "gene_id")
        top = ranked.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).select(*keys, "gene_id")
    else:
        top = ranked.orderBy(*by, "gene_id").limit(n).select("gene_id")
    flagged = join_keys(stats, top.withColumn("_hit", F.lit(True)), [*keys, "gene_id"], "left")
    return flagged.withColumn("highly_variable", F.coalesce("_hit", F.lit(False))).drop("_hit")


def extra_features(
    x: DataFrame,
    obs: DataFrame,
    var: DataFrame,
    union_over: Sequence[str] = (),
    extra: Sequence[str] = (),
    remove: Sequence[str] = (),
    min_cells: int = 10,
    overwrite: Mapping[str, object] | None = None,
    **args,
) -> DataFrame:
    """Union of highly variable features per group, minus and plus named features.

    The result column name lists the overridden parameters.
    """
    args = {**args, **(overwrite or {})}
    column = "extra_hvgs" + "".join(f"--{k}={(overwrite or {})[k]}" for k in sorted(overwrite or {}))
    if remove:
        gone = match_features(var, remove).select("gene_id")
        x = x.join(gone, "gene_id", "left_anti")
    if union_over:
        sizes = obs.groupBy(*[quoted(g) for g in union_over]).agg(F.count(F.lit(1)).alias("_n"))
        big = sizes.filter(F.col("_n") >= min_cells).drop("_n")
        obs = join_keys(obs, big, list(union_over), "left_semi")
    stats = highly_variable(x, obs, var, groups=union_over, **args)
    picked = stats.groupBy("gene_id").agg(F.bool_or("highly_variable").alias("_hit"))
    out = var.select("gene_id").join(picked, "gene_id", "left")
    flag = F.coalesce("_hit", F.lit(False))
    if extra:
        added = match_features(var, extra).select("gene_id", F.lit(True).alias("_extra"))
        out = out.join(added, "gene_id", "left")
        flag = flag | F.coalesce("_extra", F.lit(False))
    return out.select("gene_id", flag.alias(column))


def pca(df: DataFrame, n_comps: int, vector: str = "v", id_col: str = "cell_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Centred scores, loadings and explained variance of array rows.

    Only the feature × feature covariance reaches the driver.  Signs are fixed so
    that the largest loading of a component is positive.
    """
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType.simpleString()
    first = df.select(F.size(quoted(vector)).alias("p")).first()
    if first is None or first["p"] == 0:
        return (
            spark.createDataFrame([], f"{id_col} {id_type}, v array<double>"),
            spark.createDataFrame([], "idx int, v array<double>"),
            spark.createDataFrame([], "pc int, variance double, variance_ratio double"),
        )
    if first["p"] > GRAM_FEATURES:
        long = df.select(quoted(id_col).alias("cell_id"), F.posexplode(quoted(vector)).alias("idx", "value"))
        features = spark.range(first["p"]).select(F.col("id").cast("int").alias("idx"))
        scores, loadings, variance = components(cut(long.filter("value != 0"), "entries"), long.select("cell_id").distinct(), features, n_comps)
        return scores.withColumnRenamed("cell_id", id_col), loadings, variance
    rows = df.select(quoted(id_col), array_to_vector(quoted(vector)).alias("_vec"))
    k = min(n_comps, first["p"])
    model = PCA(k=k, inputCol="_vec", outputCol="_out").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    signs[signs == 0] = 1.0
    loadings = loadings * signs
    moments = rows.agg(Summarizer.metrics("mean", "variance").summary(F.col("_vec")).alias("s")).first()["s"]
    center = moments["mean"].toArray() @ loadings
    scores = model.transform(rows).select(
        quoted(id_col),
        F.zip_with(
            F.zip_with(vector_to_array("_out"), F.array(*[F.lit(float(s)) for s in signs]), lambda a, s: a * s),
            F.array(*[F.lit(float(c)) for c in center]),
            lambda a, c: a - c,
        ).alias("v"),
    )
    ratio = model.explainedVariance.toArray()
    total = float(moments["variance"].toArray().sum())
    loading_rows = [(i, [float(a) for a in loadings[i]]) for i in range(loadings.shape[0])]
    variance_rows = [(i, float(r * total), float(r)) for i, r in enumerate(ratio)]
    return (
        scores,
        spark.createDataFrame(loading_rows, "idx int, v array<double>"),
        spark.createDataFrame(variance_rows, "pc int, variance double, variance_ratio double"),
    )


def matrix_pca(
    x: DataFrame, obs: DataFrame, features: DataFrame, n_comps: int = 50, scaled: bool = False, max_value: float = 10.0,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components of the selected features; loadings carry the feature id.

    Nothing is made dense: scaled and clipped, an absent entry is a constant of its feature.
    """
    index = cut(feature_index(features), "features")
    entries = x.join(index, "gene_id").join(obs.select("cell_id"), "cell_id", "left_semi")
    value = F.col("value")
    if scaled:
        stats = feature_moments(x, count_rows(obs)).select("gene_id", "mean", F.sqrt("var").alias("sd"))
        entries = entries.join(stats, "gene_id")
        z = lambda v: (v - F.col("mean")) / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
        clipped = lambda v: F.least(F.greatest(v, F.lit(-float(max_value))), F.lit(float(max_value)))
        value = clipped(z(value)) - clipped(z(F.lit(0.0)))  # absent entries are the constant
    entries = cut(entries.select("cell_id", "idx", value.cast("double").alias("value")), "entries")
    scores, loadings, variance = components(entries, obs.select("cell_id"), index, n_comps, tolerance)
    return scores, loadings.join(index, "idx").drop("idx"), variance


def assemble(parts: Sequence, defaults: Mapping[str, object] | None = None):
    """One bundle from the outputs of several steps.

    Later parts add or replace slots; feature columns are merged by feature with
    defaults for features a step did not see; metadata rows of later parts win.
    """
    out = parts[0]
    for part in parts[1:]:
        for name, df in part.slots.items():
            if name == "var" and "var" in out:
                new = [c for c in df.columns if c != "gene_id"]
                base = out["var"].drop(*[c for c in new if c in out["var"].columns])
                merged = base.join(df, "gene_id", "left")
                fill = {c: v for c, v in (defaults or {}).items() if c in new}
                df = merged.withColumns({c: F.coalesce(quoted(c), F.lit(v)) for c, v in fill.items()})
            elif name == "uns" and "uns" in out:
                old = out["uns"].join(df, ["module", "key"], "left_anti")
                df = old.unionByName(df)
            out = out.with_slot(name, df)
    return out


def mean_bins(means: DataFrame, n_bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Expression bin of each feature by the rank of its mean (per key).

    Equal means share the lowest rank and therefore the bin.
    """
    cols = [quoted(k) for k in keys]
    counts = means.groupBy(*cols, "mean").agg(F.count(F.lit(1)).alias("_k"))
    ranked = cut(prefix_sums(counts, keys, ["mean"], {"_upto": "_k"}), "ranks")
    sizes = ranked.groupBy(*cols).agg(F.max("_upto").alias("_total"))
    ranked = join_keys(ranked, sizes, keys) if keys else ranked.withColumn("_total", sizes.scalar())
    per_bin = F.greatest(F.round(F.col("_total") / (n_bins - 1)), F.lit(1.0))
    ranked = ranked.withColumn("bin", F.floor((F.col("_upto") - F.col("_k") + 1) / per_bin).cast("int"))
    return join_keys(means, ranked.select(*cols, "mean", "bin").hint("merge"), [*keys, "mean"])


def score_sets(
    x: DataFrame,
    obs: DataFrame,
    var: DataFrame,
    sets: DataFrame,
    batch: str | None = None,
    n_bins: int = 25,
    ctrl_size: int = 50,
    seed: int = 0,
) -> DataFrame:
    """Score of feature sets per cell: mean of the set minus mean of its controls.

    Controls are features outside the set from the same expression bins, in hash
    order.  ``sets`` has ``set_id, gene_id``; all sets (and batches) share one job
    because a set enters the product as a table of feature weights.
    """
    keys = [batch] if batch else []
    cells = obs.select("cell_id", *[quoted(k) for k in keys])
    sums = (x.join(cells, "cell_id") if keys else x).groupBy(*[quoted(k) for k in keys], "gene_id").agg(
        F.sum("value").alias("_s")
    )
    genes = var.select("gene_id").distinct()
    if keys:
        sizes = cells.groupBy(quoted(batch)).agg(F.count(F.lit(1)).alias("_n"))
        listed = sizes.agg(F.collect_list(F.struct(quoted(batch), "_n")).alias("_b")).scalar()
        grid = genes.withColumn("_e", F.explode(listed)).select("gene_id", F.col("_e")[batch].alias(batch), F.col("_e")["_n"].alias("_n"))
    else:
        grid = genes.withColumn("_n", count_rows(cells))
    # Tables as long as the features are joined by sorting: broadcast, each would lie in the driver.
    means = join_keys(grid, sums.hint("merge"), [*keys, "gene_id"], "left").select(
        *[quoted(k) for k in keys], "gene_id", (F.coalesce("_s", F.lit(0.0)) / F.col("_n")).alias("mean")
    )
    binned = cut(mean_bins(means, n_bins, keys), "bins")
    sets = cut(sets.select("set_id", "gene_id").distinct().join(genes.hint("merge"), "gene_id", "left_semi"), "sets")
    members = join_keys(sets.hint("merge"), binned.hint("merge"), ["gene_id"])
    wanted = members.select(*keys, "set_id", "bin").distinct()
    pool = join_keys(binned, wanted, [*keys, "bin"]).join(sets.hint("merge"), ["set_id", "gene_id"], "left_anti")
    controls = sample_exact(pool, "gene_id", ctrl_size, seed, [*keys, "set_id", "bin"], hex_digits=2)
    tagged = members.select(*keys, "set_id", "gene_id", F.lit(1).alias("_side")).unionByName(
        controls.select(*keys, "set_id", "gene_id", F.lit(-1).alias("_side"))
    )
    side_sizes = tagged.groupBy(*keys, "set_id", "_side").agg(F.count(F.lit(1)).alias("_k"))
    weights = join_keys(tagged, side_sizes, [*keys, "set_id", "_side"]).select(
        *keys, "set_id", "gene_id", (F.col("_side") / F.col("_k")).alias("_w")
    )
    entries = x.join(cells, "cell_id") if keys else x
    parts = join_keys(entries, weights.hint("merge"), [*keys, "gene_id"]).groupBy("cell_id", "set_id").agg(
        F.sum(F.col("value") * F.col("_w")).alias("score")
    )
    names = sets.select("set_id").distinct().agg(F.collect_list("set_id")).scalar()
    full = obs.select("cell_id").withColumn("set_id", F.explode(names))
    return full.join(parts, ["cell_id", "set_id"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def random_sets(var: DataFrame, sets: DataFrame, n_perm: int, seed: int = 0) -> DataFrame:
    """Random feature sets of the same sizes, ``set_id`` with the permutation number."""
    sizes = sets.groupBy("set_id").agg(F.countDistinct("gene_id").alias("_size"))
    plan = sizes.withColumn("perm_id", F.explode(F.array(*[F.lit(i) for i in range(n_perm)])))
    plan = plan.select(F.concat_ws("--", "set_id", F.col("perm_id").cast("string")).alias("set_id"), "_size")
    plans = plan.agg(F.collect_list(F.struct("set_id", "_size"))).scalar()
    pool = var.select("gene_id").distinct().withColumn("_p", F.explode(plans)).select(
        "gene_id", F.col("_p")["set_id"].alias("set_id"), F.col("_p")["_size"].alias("_size")
    )
    marked = pool.withColumn("_key", F.concat_ws(":", "set_id", F.col("gene_id").cast("string")))
    return sample_exact(marked, "_key", F.col("_size"), seed, ["set_id"]).select("set_id", "gene_id")


def integration_features(x: DataFrame, var: DataFrame, mask: Column | str, min_cells: int = 50) -> DataFrame:
    """Masked features that occur in enough cells."""
    found = detected_features(x, var, min_cells)
    flagged = var.select("gene_id", F.expr(mask).alias("_m") if isinstance(mask, str) else mask.alias("_m"))
    return flagged.join(found, "gene_id").select(
        "gene_id", (F.coalesce("_m", F.lit(False)) & F.col("nonzero_genes")).alias("integration_features")
    )


def matrix_differences(a: DataFrame, b: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Number of entries that differ between two matrices (absent entries are zero)."""
    left = a.select("cell_id", "gene_id", F.col("value").alias("_d"))
    right = b.select("cell_id", "gene_id", (-F.col("value")).alias("_d"))
    diff = left.unionByName(right).groupBy("cell_id", "gene_id").agg(F.sum("_d").alias("_d"))
    return diff.agg(F.count_if(F.abs("_d") > tolerance).alias("n_different"))


def stack_sets(named: Mapping[str, DataFrame]) -> DataFrame:
    """Named feature tables as one ``(set_id, gene_id)`` table."""
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(n).alias("set_id"), "gene_id") for n, df in named.items()],
    )
