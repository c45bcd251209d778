"""Scores that compare labels, batches, embeddings and graphs.

Score functions return one row per key with a ``score`` column, so several
resolutions, permutations or feature sets are scored in one job.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.ordering import exact_quantiles, hash_key, hash_normal, running_index
from heddle.functions.runtime import cut, drop_missing, join_keys, quoted
from heddle.operators import neighbors as nb
from heddle.operators.graph import cluster, connected_components, connectivities
from heddle.operators.paths import graph_neighbors
from heddle.operators.sample import bootstrap_ids


def contingency(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of label pairs with both margins; rows with a missing label are dropped."""
    keys = list(keys)
    kept = drop_missing(df, [a, b])
    cells = kept.groupBy(*[quoted(k) for k in keys], quoted(a).alias("_a"), quoted(b).alias("_b")).agg(
        F.count(F.lit(1)).alias("n_ij")
    )
    rows = cells.groupBy(*keys, "_a").agg(F.sum("n_ij").alias("n_i"))
    cols = cells.groupBy(*keys, "_b").agg(F.sum("n_ij").alias("n_j"))
    return cells.join(rows, [*keys, "_a"]).join(cols, [*keys, "_b"])


def _per_key(parts: list[DataFrame], keys: Sequence[str]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, list(keys)) if keys else out.withColumns({c: p.select(c).scalar() for c in p.columns})
    return out


def nmi(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Normalised mutual information of two labelings."""
    keys = list(keys)
    table = contingency(df, a, b, keys)
    total = table.groupBy(*keys).agg(F.sum("n_ij").alias("n"))
    full = table.join(total, keys) if keys else table.withColumn("n", total.scalar())
    mutual = full.groupBy(*keys).agg(
        F.sum(F.col("n_ij") / F.col("n") * F.log(F.col("n") * F.col("n_ij") / (F.col("n_i") * F.col("n_j")))).alias("_mi"),
        F.sum(-F.col("n_ij") / F.col("n") * F.log(F.col("n_i") / F.col("n"))).alias("_ha"),
        F.sum(-F.col("n_ij") / F.col("n") * F.log(F.col("n_j") / F.col("n"))).alias("_hb"),
    )
    both = F.col("_ha") + F.col("_hb")
    return mutual.select(*keys, F.when(both > 1e-15, 2 * F.col("_mi") / both).otherwise(1.0).alias("score"))


def ari(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index of two labelings."""
    keys = list(keys)
    cells = drop_missing(df, [a, b]).groupBy(*[quoted(k) for k in keys], quoted(a).alias("_a"), quoted(b).alias("_b")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    pairs = lambda c: F.sum(c * (c - 1) / 2)
    rows = cells.groupBy(*keys, "_a").agg(F.sum("n").alias("m")).groupBy(*keys).agg(pairs(F.col("m")).alias("_ra"))
    cols = cells.groupBy(*keys, "_b").agg(F.sum("n").alias("m")).groupBy(*keys).agg(pairs(F.col("m")).alias("_rb"))
    inner = cells.groupBy(*keys).agg(pairs(F.col("n")).alias("_in"), F.sum("n").alias("_n"))
    full = _per_key([inner, rows, cols], keys)
    expected = F.col("_ra") * F.col("_rb") / F.greatest(F.col("_n") * (F.col("_n") - 1) / 2, F.lit(1.0))
    top = (F.col("_ra") + F.col("_rb")) / 2 - expected
    return full.select(*keys, F.when(top != 0, (F.col("_in") - expected) / top).otherwise(1.0).alias("score"))


def best_resolution(clusters: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """NMI of every resolution with a flag on the best one (ties: the lowest)."""
    scored = cut(nmi(clusters.join(labels, "cell_id"), "cluster", label, ["resolution"]), "nmi")
    best = scored.agg(F.max_by("resolution", F.struct("score", -F.col("resolution")))).scalar()
    return scored.withColumn("best", F.col("resolution") == best)


def optimal_clusters(edges: DataFrame, labels: DataFrame, label: str, resolutions: Sequence[float] | None = None) -> DataFrame:
    """Clusters of the resolution (0.2 ... 2.0) with the best NMI to the labels."""
    steps = list(resolutions) if resolutions is not None else [round(0.2 * i, 1) for i in range(1, 11)]
    found = cut(cluster(edges, steps).withColumnRenamed("node", "cell_id"), "clusters")
    best = best_resolution(found, labels, label).filter("best").select("resolution", F.col("score").alias("nmi"))
    return found.join(best, "resolution")


def kmeans_labels(emb: DataFrame, k: int, seed: int = 42, vector: str = "v") -> DataFrame:
    """k-means cluster of each row."""
    rows = emb.withColumn("features", array_to_vector(quoted(vector)))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("features")


def label_distance_sums(emb: DataFrame, label: str, within: str | None = None, only: DataFrame | None = None) -> DataFrame:
    """For each distinct (row, label): total distance to the rows of each label.

    Equal rows of one label are one weighted row.  ``only`` limits the left side to
    some labels.
    """
    key = quoted(within).cast("string") if within else F.lit("")
    rows = cut(
        emb.select(F.col("cell_id"), "v", quoted(label).cast("string").alias("label"), key.alias("key"))
        .na.drop(subset=["label", "key"])
        .groupBy("key", "label", "v")
        .agg(F.min("cell_id").alias("cell_id"), F.count(F.lit(1)).alias("w")),
        "labelled",
    )
    left = rows if only is None else rows.join(only.select(quoted(label).cast("string").alias("label")).distinct(), "label", "left_semi")
    id_type = emb.schema["cell_id"].dataType.simpleString()

    def sums(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if len(p) == 0 or len(q) == 0:
            return pd.DataFrame({c: [] for c in ("key", "cell_id", "label", "w", "other", "total")})
        dist = nb.block_distances(np.stack(p["v"]), np.stack(q["v"]))
        codes, names = pd.factorize(q["label"])
        onehot = np.zeros((len(q), len(names)))
        onehot[np.arange(len(q)), codes] = q["w"]
        total = dist @ onehot
        n = len(names)
        return pd.DataFrame(
            {
                "key": np.repeat(p["key"].to_numpy(), n), "cell_id": np.repeat(p["cell_id"].to_numpy(), n),
                "label": np.repeat(p["label"].to_numpy(), n), "w": np.repeat(p["w"].to_numpy(), n),
                "other": np.tile(np.asarray(names), len(p)), "total": total.ravel(),
            }
        )

    parts = nb.pairwise_blocks(
        left, rows, sums, f"key string, cell_id {id_type}, label string, w long, other string, total double", key="key"
    )
    merged = parts.groupBy("key", "cell_id", "label", "w", "other").agg(F.sum("total").alias("total"))
    sizes = rows.groupBy("key", F.col("label").alias("other")).agg(F.sum("w").alias("n_other"))
    return merged.join(sizes, ["key", "other"])


def silhouette(emb: DataFrame, label: str, within: str | None = None, squared: bool = False) -> DataFrame:
    """Silhouette of each distinct row: ``key, label, cell_id, w, s`` (weight ``w``).

    Rows of a one-row cluster score 0; so do rows without another cluster.  Mean
    Euclidean distances need all pairs; ``squared`` uses squared distances, which
    follow from cluster sums in one linear pass (for tables too large for pairs).
    """
    sums = squared_distance_sums(emb, label, within) if squared else label_distance_sums(emb, label, within)
    own = F.col("other") == F.col("label")
    per_row = sums.groupBy("key", "cell_id", "label", "w").agg(
        F.max(F.when(own & (F.col("n_other") > 1), F.col("total") / (F.col("n_other") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("total") / F.col("n_other"))).alias("_b"),
    )
    top = F.greatest("_a", "_b")
    s = F.when(F.col("_a").isNull() | F.col("_b").isNull() | (top == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / top)
    return per_row.select("key", "label", "cell_id", "w", s.alias("s"))


def squared_distance_sums(emb: DataFrame, label: str, within: str | None = None) -> DataFrame:
    """Total squared distance of each row to each cluster, from counts, sums and square sums."""
    key = quoted(within).cast("string") if within else F.lit("")
    rows = drop_missing(
        emb.select("cell_id", "v", quoted(label).cast("string").alias("label"), key.alias("key")), ["label", "key"]
    ).withColumn("_q", F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    stats = rows.groupBy("key", F.col("label").alias("other")).agg(
        F.count(F.lit(1)).alias("n_other"), F.sum("_q").alias("_qs"), Summarizer.sum(array_to_vector("v")).alias("_sum")
    ).withColumn("_sum", vector_to_array("_sum"))
    if within is None:
        # One key: the few cluster rows are attached as a list instead of a join.
        listed = stats.agg(F.collect_list(F.struct("other", "n_other", "_qs", "_sum"))).scalar()
        joined = rows.withColumn("_c", F.explode(listed)).select(*rows.columns, "_c.*")
    else:
        joined = rows.join(stats, "key")
    dot = F.aggregate(F.zip_with("v", "_sum", lambda a, b: a * b), F.lit(0.0), lambda a, e: a + e)
    total = F.greatest(F.col("n_other") * F.col("_q") - 2 * dot + F.col("_qs"), F.lit(0.0))
    return joined.select("key", "cell_id", "label", F.lit(1).alias("w"), "other", total.alias("total"), "n_other")


def asw_label(emb: DataFrame, label: str, squared: bool = False) -> DataFrame:
    mean = F.sum(F.col("s") * F.col("w")) / F.sum("w")
    return silhouette(emb, label, squared=squared).agg(((mean + 1) / 2).alias("score"))


def asw_batch(emb: DataFrame, batch: str, label: str, squared: bool = False) -> DataFrame:
    """Mean over labels of the mean of 1 - |silhouette by batch|.

    Labels with one batch, or with as many batches as rows, are left out.
    """
    groups = emb.groupBy(quoted(label).cast("string").alias("key")).agg(
        F.countDistinct(quoted(batch)).alias("_nb"), F.count(F.lit(1)).alias("_n")
    )
    usable = groups.filter((F.col("_nb") > 1) & (F.col("_nb") < F.col("_n"))).select("key")
    per_label = silhouette(emb, batch, within=label, squared=squared).join(usable, "key", "left_semi").groupBy("key").agg(
        (F.sum((1 - F.abs("s")) * F.col("w")) / F.sum("w")).alias("_m")
    )
    return per_label.agg(F.avg("_m").alias("score"))


def isolated_labels(df: DataFrame, label: str, batch: str) -> DataFrame:
    """Labels found in the fewest batches."""
    spread = drop_missing(df, [label]).groupBy(quoted(label)).agg(F.countDistinct(quoted(batch)).alias("n_batches"))
    least = spread.agg(F.min("n_batches")).scalar()
    return spread.filter(F.col("n_batches") == least)


def isolated_label_asw(emb: DataFrame, label: str, batch: str, scale: bool = True) -> DataFrame:
    """Mean silhouette of each isolated label against all other rows, averaged."""
    isolated = isolated_labels(emb, label, batch)
    sums = label_distance_sums(emb, label, only=isolated)
    own = F.col("other") == F.col("label")
    per_row = sums.groupBy("cell_id", "label", "w").agg(
        F.max(F.when(own & (F.col("n_other") > 1), F.col("total") / (F.col("n_other") - 1))).alias("_a"),
        (F.sum(F.when(~own, F.col("total"))) / F.sum(F.when(~own, F.col("n_other")))).alias("_b"),
    )
    top = F.greatest("_a", "_b")
    s = F.when(F.col("_a").isNull() | F.col("_b").isNull() | (top == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / top)
    per_label = per_row.withColumn("s", s).groupBy("label").agg((F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("_m"))
    value = (F.col("_m") + 1) / 2 if scale else F.col("_m")
    return per_label.agg(F.avg(value).alias("score"))


def isolated_label_f1(df: DataFrame, label: str, batch: str, cluster_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Best F1 of any cluster against each isolated label, averaged."""
    isolated = isolated_labels(df, label, batch).select(quoted(label).alias("_a"))
    table = contingency(df, label, cluster_col, keys).join(isolated, "_a", "left_semi")
    best = table.groupBy("_a").agg(F.max(2 * F.col("n_ij") / (F.col("n_i") + F.col("n_j"))).alias("_f"))
    return best.agg(F.avg("_f").alias("score"))


def graph_connectivity(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Mean over labels of the share of the largest component of the label's subgraph."""
    tags = labels.select("cell_id", quoted(label).alias("_l")).na.drop()
    inside = (
        edges.select("src", "dst")
        .join(tags.withColumnsRenamed({"cell_id": "src", "_l": "_s"}), "src")
        .join(tags.withColumnsRenamed({"cell_id": "dst", "_l": "_d"}), "dst")
        .filter(F.col("_s") == F.col("_d"))
        .select("src", "dst")
    )
    found = connected_components(inside, tags.select(F.col("cell_id").alias("node")))
    sizes = found.join(tags.withColumnRenamed("cell_id", "node"), "node").groupBy("_l", "component").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return sizes.groupBy("_l").agg((F.max("_n") / F.sum("_n")).alias("_share")).agg(F.avg("_share").alias("score"))


def simpson_udf(perplexity: float):
    """Inverse Simpson index of neighbour labels under a Gaussian kernel of fixed perplexity."""
    target = math.log(perplexity)

    @F.pandas_udf("double")
    def simpson(distances: pd.Series, codes: pd.Series) -> pd.Series:
        if len(distances) == 0:
            return pd.Series([], dtype=float)
        width = max(len(d) for d in distances)
        d = np.full((len(distances), width), np.inf)
        c = np.full((len(distances), width), -1, dtype=np.int64)
        for i, (row, code) in enumerate(zip(distances, codes)):
            d[i, : len(row)] = row
            c[i, : len(code)] = code
        present = np.isfinite(d)
        # The kernel weights do not change when the nearest distance is taken off.
        safe = np.where(present, d - d.min(axis=1, keepdims=True), 0.0)
        beta, lo, hi = np.ones(len(d)), np.full(len(d), -np.inf), np.full(len(d), np.inf)
        for _ in range(60):
            p = np.where(present, np.exp(-safe * beta[:, None]), 0.0)
            total = np.maximum(p.sum(axis=1), 1e-300)
            entropy = np.log(total) + beta * (safe * p).sum(axis=1) / total
            high = entropy > target
            lo, hi = np.where(high, beta, lo), np.where(high, hi, beta)
            up = np.where(np.isinf(hi), beta * 2, (beta + hi) / 2)
            down = np.where(np.isinf(lo), beta / 2, (beta + lo) / 2)
            beta = np.where(high, up, down)
        p = np.where(present, np.exp(-safe * beta[:, None]), 0.0)
        p = p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
        same = np.zeros(len(d))
        for j in range(width):
            same += p[:, j] * (p * (c == c[:, j : j + 1])).sum(axis=1)
        return pd.Series(1.0 / np.maximum(same, 1e-300))

    return simpson


def lisi(edges: DataFrame, labels: DataFrame, label: str, k: int, perplexity: float | None = None) -> DataFrame:
    """Local inverse Simpson index of the labels around each row."""
    tags = labels.select(F.col("cell_id").alias("dst"), F.xxhash64(quoted(label).cast("string")).alias("_c"))
    lists = edges.join(tags, "dst").groupBy("src").agg(F.array_sort(F.collect_list(F.struct("dist", "dst", "_c"))).alias("e"))
    simpson = simpson_udf(perplexity if perplexity is not None else max(k // 3, 2))
    return lists.select(F.col("src").alias("cell_id"), simpson(F.col("e")["dist"], F.col("e")["_c"]).alias("lisi"))


#: Rows that the neighbourhood indices of the graph reach along its edges.
REACH = 90


def _median_lisi(edges: DataFrame, labels: DataFrame, label: str, k: int, reach: int | None) -> tuple[DataFrame, Column]:
    if reach is not None:
        edges, k = graph_neighbors(edges, reach), reach
    values = exact_quantiles(lisi(edges, labels, label, k), [], "lisi", {"m": 0.5})
    return values, labels.agg(F.countDistinct(quoted(label)))


def clisi(edges: DataFrame, labels: DataFrame, label: str, k: int, reach: int | None = REACH) -> DataFrame:
    """1 when every neighbourhood has one label.

    A neighbourhood is the ``reach`` nearest rows along the graph; without ``reach``, the
    direct neighbours.
    """
    values, n = _median_lisi(edges, labels, label, k, reach)
    size = n.scalar()
    return values.select(((size - F.col("m")) / (size - 1)).alias("score"))


def ilisi(edges: DataFrame, labels: DataFrame, batch: str, k: int, reach: int | None = REACH) -> DataFrame:
    """1 when every neighbourhood, as in ``clisi``, has all batches in equal shares."""
    values, n = _median_lisi(edges, labels, batch, k, reach)
    size = n.scalar()
    return values.select(((F.col("m") - 1) / (size - 1)).alias("score"))


def _gamma_tail(a: float, x: float) -> float:
    """Upper tail of the regularised incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > 1e-16 * abs(total):
            n += 1
            term *= x / n
            total += term
        return 1.0 - front * total
    b, c, d = x + 1 - a, 1e300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / c
        c = c if abs(c) > 1e-300 else 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_critical(dof: int, alpha: float) -> float:
    """Largest statistic whose upper tail probability under chi-square is at least ``alpha``."""
    low, high = 0.0, 1.0
    while _gamma_tail(dof / 2.0, high / 2.0) >= alpha:
        high *= 2
    while high - low > 1e-13 * high:
        middle = (low + high) / 2
        low, high = (middle, high) if _gamma_tail(dof / 2.0, middle / 2.0) >= alpha else (low, middle)
    return low


def critical_values(stats: DataFrame, alpha: float) -> DataFrame:
    """One critical value per number of degrees of freedom in ``stats``: ``dof, critical``."""

    @F.pandas_udf("double")
    def critical(dof: pd.Series) -> pd.Series:
        return pd.Series([chi2_critical(int(d), alpha) for d in dof], dtype=float)

    return cut(stats.groupBy("dof").agg(F.lit(1).alias("_")).select("dof", critical("dof").alias("critical")), "critical")


def kbet_statistic(edges: DataFrame, df: DataFrame, batch: str, within: str | None = None) -> DataFrame:
    """Chi-square of the batch mix around each row (the row included): ``cell_id, key, stat, dof``.

    Batches absent from a neighbourhood are accounted for without listing them.
    """
    key = quoted(within).cast("string") if within else F.lit("")
    rows = df.select("cell_id", quoted(batch).alias("_b"), key.alias("key")).na.drop(subset=["_b", "key"])
    shares = rows.groupBy("key", "_b").agg(F.count(F.lit(1)).alias("_nb"))
    totals = shares.groupBy("key").agg(F.sum("_nb").alias("_n"), F.count(F.lit(1)).alias("_batches"))
    shares = shares.join(totals, "key").select("key", "_b", (F.col("_nb") / F.col("_n")).alias("_f"), "_batches")
    around = edges.select("src", "dst").unionByName(rows.select(F.col("cell_id").alias("src"), F.col("cell_id").alias("dst")))
    counts = around.join(rows.withColumnRenamed("cell_id", "dst"), "dst").groupBy("src", "key", "_b").agg(
        F.count(F.lit(1)).alias("_o")
    )
    # sum over batches of (o - K f)^2 / (K f) equals sum over present ones of o^2/(K f), minus K.
    parts = counts.join(shares, ["key", "_b"]).groupBy(F.col("src").alias("cell_id"), "key").agg(
        F.sum(F.col("_o") * F.col("_o") / F.col("_f")).alias("_q"), F.sum("_o").alias("_k"), F.max("_batches").alias("_batches")
    )
    return parts.select("cell_id", "key", (F.col("_q") / F.col("_k") - F.col("_k")).alias("stat"), (F.col("_batches") - 1).alias("dof"))


def kbet(edges: DataFrame, df: DataFrame, batch: str, within: str | None = None, alpha: float = 0.05) -> DataFrame:
    """Share of neighbourhoods whose batch mix is accepted, averaged over keys with two batches."""
    stats = kbet_statistic(edges, df, batch, within).filter("dof > 0")
    stats = cut(stats, "kbet")
    accepted = (F.col("stat") <= F.col("critical")).cast("double")
    per_key = stats.join(critical_values(stats, alpha), "dof").groupBy("key").agg(F.avg(accepted).alias("_r"))
    return per_key.agg(F.avg("_r").alias("score"))


def kbet_per_label(emb: DataFrame, batch: str, label: str, k: int = 50, alpha: float = 0.05) -> DataFrame:
    edges = nb.knn(drop_missing(emb, [label]), k - 1, same=label)
    return kbet(edges, emb, batch, within=label, alpha=alpha)


def component_parts(emb: DataFrame, units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, sum and square sum of every component per unit (covariate value or sample)."""
    joined = emb.select("cell_id", "v").join(units, "cell_id")
    return joined.select(*keys, F.posexplode("v").alias("pc", "x")).groupBy(*keys, "pc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss")
    )


def explained_by_groups(parts: DataFrame, group: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of component variance explained by a category: ``keys..., score``.

    Per component the between-group share of the squares, weighted by its variance.
    """
    keys = list(keys)
    by_group = parts.groupBy(*keys, "pc", quoted(group)).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    per_pc = by_group.groupBy(*keys, "pc").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("g")
    )
    mean2 = F.col("s") * F.col("s") / F.col("n")
    between, total = F.col("g") - mean2, F.col("ss") - mean2
    # variance weight times R2 is the between part itself, up to the common n - 1
    return per_pc.groupBy(*keys).agg((F.sum(between) / F.sum(total)).alias("score"))


def explained_by_number(emb: DataFrame, covariates: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """As ``explained_by_groups`` for a numeric covariate: squared correlation per component."""
    keys = list(keys)
    joined = emb.select("cell_id", "v").join(covariates, "cell_id").na.drop(subset=[value])
    per_pc = joined.select(*keys, quoted(value).cast("double").alias("_z"), F.posexplode("v").alias("pc", "x")).groupBy(*keys, "pc").agg(
        F.covar_pop("x", "_z").alias("c"), F.var_pop("x").alias("vx"), F.var_pop("_z").alias("vz")
    )
    part = F.when(F.col("vz") > 0, F.col("c") * F.col("c") / F.col("vz")).otherwise(0.0)
    return per_pc.groupBy(*keys).agg((F.sum(part) / F.sum("vx")).alias("score"))


def pcr(emb: DataFrame, obs: DataFrame, covariate: str) -> DataFrame:
    """Principal component regression on a category or a number."""
    kind = obs.schema[covariate].dataType.typeName()
    cov = obs.select("cell_id", quoted(covariate).alias("_cov")).na.drop()
    if kind in ("string", "boolean"):
        return explained_by_groups(component_parts(emb, cov, ["_cov"]), "_cov")
    return explained_by_number(emb, cov, "_cov")


def pcr_comparison(before: DataFrame, after: DataFrame, obs: DataFrame, covariate: str) -> DataFrame:
    """Relative drop of explained variance by a correction, at least 0."""
    a = pcr(before, obs, covariate).withColumnRenamed("score", "before")
    b = pcr(after, obs, covariate).withColumnRenamed("score", "after")
    full = a.withColumn("after", b.scalar())
    return full.select(F.greatest((F.col("before") - F.col("after")) / F.col("before"), F.lit(0.0)).alias("score"))


def pcr_random(emb: DataFrame, seed: int = 0) -> DataFrame:
    cov = emb.select("cell_id", hash_normal(seed, "cell_id").alias("z"))
    return explained_by_number(emb, cov, "z")


def pcr_sets(emb: DataFrame, scores: DataFrame) -> DataFrame:
    """Principal component regression of feature-set scores, at least 0, per set."""
    out = explained_by_number(emb, scores, "score", ["set_id"])
    return out.withColumn("score", F.greatest("score", F.lit(0.0)))


def two_covariate_share(emb: DataFrame, covariates: DataFrame, first: str, second: str, key: str) -> DataFrame:
    """Explained component variance by two numbers together, per key."""
    rows = emb.select("cell_id", "v").join(covariates, "cell_id").select(
        quoted(key), quoted(first).alias("_a"), quoted(second).alias("_b"), F.posexplode("v").alias("pc", "x")
    )
    stats = rows.groupBy(quoted(key), "pc").agg(
        F.covar_pop("x", "_a").alias("xa"), F.covar_pop("x", "_b").alias("xb"), F.covar_pop("_a", "_b").alias("ab"),
        F.var_pop("_a").alias("aa"), F.var_pop("_b").alias("bb"), F.var_pop("x").alias("xx"),
    )
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    both = (
        F.col("xa") * F.col("xa") * F.col("bb") + F.col("xb") * F.col("xb") * F.col("aa") - 2 * F.col("xa") * F.col("xb") * F.col("ab")
    ) / det
    one = F.when(F.col("aa") > 0, F.col("xa") * F.col("xa") / F.col("aa")).when(
        F.col("bb") > 0, F.col("xb") * F.col("xb") / F.col("bb")
    ).otherwise(0.0)
    part = F.when(det > 1e-12 * F.col("aa") * F.col("bb"), both).otherwise(one)
    return stats.groupBy(quoted(key)).agg((F.sum(part) / F.sum("xx")).alias("score"))


def cell_cycle_conservation(
    before: DataFrame, after: DataFrame, obs: DataFrame, batch: str, scores: DataFrame, first: str = "S", second: str = "G2M"
) -> DataFrame:
    """Mean over batches of how well the two cycle scores stay explained."""
    wide = scores.groupBy("cell_id").agg(
        *[F.max(F.when(F.col("set_id") == s, F.col("score"))).alias(s) for s in (first, second)]
    )
    cov = cut(wide.join(obs.select("cell_id", quoted(batch)), "cell_id"), "cycle")
    a = two_covariate_share(before, cov, first, second, batch).withColumnRenamed("score", "before")
    b = two_covariate_share(after, cov, first, second, batch).withColumnRenamed("score", "after")
    kept = 1 - F.abs(F.col("after") - F.col("before")) / F.col("before")
    return a.join(b, batch).agg(F.avg(F.greatest(kept, F.lit(0.0))).alias("score"))


def morans_i(edges: DataFrame, values: DataFrame, nodes: DataFrame, keys: Sequence[str] = (), floor: bool = True) -> DataFrame:
    """Moran's I of values on a weighted graph, per key.

    ``values`` (``cell_id, keys..., x``) may leave out zeros: the centred sums are
    expanded, so only stored values are joined to the edges.  Constant values give
    NULL.
    """
    keys = list(keys)
    n = nodes.agg(F.count(F.lit(1))).scalar()
    w_total = edges.agg(F.sum("weight")).scalar()
    ends = edges.select(F.col("src").alias("cell_id"), "weight").unionByName(edges.select(F.col("dst").alias("cell_id"), "weight"))
    degree = ends.groupBy("cell_id").agg(F.sum("weight").alias("_deg"))
    values = values.select("cell_id", *[quoted(k) for k in keys], quoted("x").cast("double").alias("x"))
    single = values.join(degree, "cell_id", "left").groupBy(*keys).agg(
        F.sum("x").alias("_s"), F.sum(F.col("x") * F.col("x")).alias("_ss"),
        F.sum(F.col("x") * F.coalesce("_deg", F.lit(0.0))).alias("_sd"),
        F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.count(F.lit(1)).alias("_k"),
    )
    left = values.withColumnsRenamed({"cell_id": "src", "x": "_xi"})
    right = values.withColumnsRenamed({"cell_id": "dst", "x": "_xj"})
    cross = edges.join(left, "src").join(right, ["dst", *keys]).groupBy(*keys).agg(
        F.sum(F.col("weight") * F.col("_xi") * F.col("_xj")).alias("_c")
    )
    both = join_keys(single, cross, keys, "left") if keys else single.withColumn("_c", cross.scalar())
    mean = F.col("_s") / n
    top = F.coalesce("_c", F.lit(0.0)) - mean * F.col("_sd") + mean * mean * w_total
    bottom = F.col("_ss") - n * mean * mean
    constant = (F.col("_lo") == F.col("_hi")) & ((F.col("_k") == n) | (F.col("_lo") == 0))
    value = F.when(~constant & (bottom > 0), n / w_total * top / bottom)
    score = F.when(value > 0, value).when(value.isNotNull(), 0.0) if floor else value
    return both.select(*keys, score.alias("score"))


def category_mappings(obs: DataFrame, column: str, n_mappings: int = 10, seed: int = 0) -> DataFrame:
    """Random assignments of ranks to categories: ``perm_id, category, x``.

    All assignments are listed when there are no more than ``n_mappings``.
    """
    distinct = obs.select(quoted(column).alias("category")).na.drop().distinct()
    few = [r[0] for r in distinct.orderBy("category").limit(8).collect()]
    if len(few) < 8 and math.factorial(len(few)) <= n_mappings:
        rows = [
            (i, c, float(r)) for i, p in enumerate(itertools.permutations(range(1, len(few) + 1))) for c, r in zip(few, p)
        ]
        return obs.sparkSession.createDataFrame(rows, "perm_id int, category string, x double")
    perms = F.explode(F.array(*[F.lit(i) for i in range(n_mappings)])).alias("perm_id")
    keyed = distinct.select("category", perms).withColumn("_h", hash_key(seed, "perm_id", "category"))
    return running_index(keyed, ["perm_id"], ["_h", "category"], "x").select(
        "perm_id", "category", F.col("x").cast("double").alias("x")
    )


def morans_i_categorical(edges: DataFrame, obs: DataFrame, column: str, mappings: DataFrame | None = None, n_mappings: int = 10) -> DataFrame:
    """Mean Moran's I over random rank assignments of the categories."""
    maps = mappings if mappings is not None else category_mappings(obs, column, n_mappings)
    tagged = obs.select("cell_id", quoted(column).alias("category")).na.drop()
    values = tagged.join(maps, "category").select("cell_id", "perm_id", "x")
    scores = morans_i(edges, values, obs, ["perm_id"])
    return scores.agg(F.avg("score").alias("score"))


def morans_i_covariate(edges: DataFrame, obs: DataFrame, column: str) -> DataFrame:
    if obs.schema[column].dataType.typeName() in ("string", "boolean"):
        return morans_i_categorical(edges, obs.withColumn(column, quoted(column).cast("string")), column)
    return morans_i(edges, obs.select("cell_id", quoted(column).alias("x")), obs)


def bootstrap_graphs(emb: DataFrame, n_bootstraps: int = 5, share: float = 0.9, n_neighbors: int = 15, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Neighbour graphs of several subsamples in one job: tagged rows and weighted edges."""
    size = int(emb.count() * share)
    ids = bootstrap_ids(emb, "cell_id", size, n_bootstraps, seed)
    rows = cut(
        emb.join(ids, "cell_id").withColumn("origin", F.col("cell_id")).withColumn(
            "cell_id", F.concat_ws(":", F.col("boot_id"), F.col("cell_id"))
        ),
        "boots",
    )
    edges = connectivities(nb.knn(rows, n_neighbors - 1, same="boot_id"), n_neighbors)
    return rows, cut(edges, "boots")


def morans_i_random(emb: DataFrame, n_bootstraps: int = 5, share: float = 0.9, seed: int = 0) -> DataFrame:
    """Moran's I of normal noise, one row per bootstrap (a negative baseline)."""
    rows, edges = bootstrap_graphs(emb, n_bootstraps, share)
    return per_boot(rows, edges, rows.select("cell_id", "boot_id", hash_normal(seed, "cell_id").alias("x")))


def per_boot(rows: DataFrame, edges: DataFrame, values: DataFrame) -> DataFrame:
    """Moran's I per bootstrap: every graph has its own size and weight."""
    tagged = edges.withColumn("boot_id", F.substring_index("src", ":", 1).cast("int"))
    stats = rows.groupBy("boot_id").agg(F.count(F.lit(1)).alias("n")).join(
        tagged.groupBy("boot_id").agg(F.sum("weight").alias("w")), "boot_id"
    ).join(values.groupBy("boot_id").agg(F.avg("x").alias("m"), F.var_pop("x").alias("s2")), "boot_id")
    z = cut(values.join(stats.select("boot_id", "m"), "boot_id").select("cell_id", "boot_id", (F.col("x") - F.col("m")).alias("z")), "boots")
    cross = (
        tagged.join(z.select(F.col("cell_id").alias("src"), F.col("z").alias("a")), "src")
        .join(z.select(F.col("cell_id").alias("dst"), F.col("z").alias("b")), "dst")
        .groupBy("boot_id").agg(F.sum(F.col("weight") * F.col("a") * F.col("b")).alias("c"))
    )
    return stats.join(cross, "boot_id").select(
        "boot_id", F.greatest(F.col("c") / (F.col("w") * F.col("s2")), F.lit(0.0)).alias("score")
    )


def morans_i_sets(edges: DataFrame, x: DataFrame, obs: DataFrame, sets: DataFrame) -> DataFrame:
    """Mean Moran's I of the features of each set; constant features are ignored."""
    genes = sets.select("gene_id").distinct()
    values = x.join(genes, "gene_id", "left_semi").select("cell_id", "gene_id", F.col("value").alias("x"))
    per_gene = morans_i(edges, values, obs, ["gene_id"])
    return sets.select("set_id", "gene_id").distinct().join(per_gene, "gene_id").groupBy("set_id").agg(F.avg("score").alias("score"))


def metric_records(scores: DataFrame, dataset: str, file_id: str, metric: str, metric_type: str, batch: str, label: str, output_type: str) -> DataFrame:
    """Result rows of one metric; list scores become one row each.

    ``scores`` has ``score`` (a number or a list) and optionally ``metric_name``
    (a text or a list of the same length).
    """
    if "metric_name" not in scores.columns:
        scores = scores.withColumn("metric_name", F.lit(metric))
    if scores.schema["score"].dataType.typeName() == "array":
        zipped = F.explode(F.arrays_zip("metric_name", "score")).alias("z")
        scores = scores.select(zipped).select(F.col("z")["metric_name"].alias("metric_name"), F.col("z")["score"].alias("score"))
    tags = {
        "dataset": dataset, "file_id": file_id, "metric": metric, "metric_type": metric_type,
        "batch": batch, "label": label, "output_type": output_type,
    }
    return scores.select(
        *[F.lit(v).alias(k) for k, v in tags.items()], "metric_name", F.col("score").cast("double").alias("score")
    )


def rank_integrations(
    records: DataFrame, ids: Sequence[str], metric: str = "metric", score: str = "score", weight_batch: float = 0.4, n_top: int = 50
) -> DataFrame:
    """Ranking by the weighted mean of min-max scaled metrics.

    Means per id and metric, scaled per metric (only when there are several ids),
    averaged per metric type without missing values, combined and sorted.
    """
    ids = list(ids)
    means = records.groupBy(*[quoted(i) for i in ids], quoted(metric).alias("_metric"), "metric_type").agg(
        F.avg(quoted(score)).alias("_m")
    ).filter(F.col("_m").isNotNull())
    ends = means.groupBy("_metric").agg(F.min("_m").alias("_lo"), F.max("_m").alias("_hi"))
    several = means.select(*[quoted(i) for i in ids]).distinct().agg(F.count(F.lit(1)) > 1).scalar()
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(several, F.when(span > 0, (F.col("_m") - F.col("_lo")) / span)).otherwise(F.col("_m"))
    typed = means.join(ends, "_metric").withColumn("_z", scaled)
    side = lambda t: F.avg(F.when(F.col("metric_type") == t, F.col("_z")))
    table = typed.groupBy(*[quoted(i) for i in ids]).agg(
        side("batch_correction").alias("batch_correction"), side("bio_conservation").alias("bio_conservation")
    )
    overall = weight_batch * F.col("batch_correction") + (1 - weight_batch) * F.col("bio_conservation")
    return table.withColumn("overall", overall).orderBy(F.col("overall").desc_nulls_last(), *[quoted(i) for i in ids]).limit(n_top)
