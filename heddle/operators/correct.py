"""Batch correction of matrices, embeddings and graphs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions.runtime import cut, drop_missing, join_keys, quoted
from heddle.operators import matrix as mx
from heddle.operators.graph import connectivities
from heddle.operators.neighbors import knn, pairwise_blocks

SHIFT_ROWS = 8192
MAX_GROUPS = 10_000


def _bounded(df: DataFrame, limit: int, what: str) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows


# ------------------------------------------------------------------ empirical Bayes


def combat_model(
    x: DataFrame, obs: DataFrame, features: DataFrame, batch: str, covariates: Sequence[str] = (), tolerance: float = 1e-4
) -> tuple[DataFrame, DataFrame]:
    """Location and scale per feature and batch, shrunk over features.

    Everything follows from counts, sums and square sums per (feature, group), where
    a group is a batch with its covariate values.  The correction of a value is
    linear, so the model is a slope and an intercept: ``gene_id, combo, slope,
    intercept``; the second table maps cells to ``combo``.
    """
    names = [batch, *covariates]
    keyed = drop_missing(obs, names).select("cell_id", *[quoted(c).cast("string").alias(c) for c in names])
    sizes = keyed.groupBy(*[quoted(c) for c in names]).agg(F.count(F.lit(1)).alias("_n")).orderBy(*[quoted(c) for c in names])
    combos = _bounded(sizes, MAX_GROUPS, "batch and covariate groups")
    spark = obs.sparkSession
    lookup = spark.createDataFrame(
        [(*[r[c] for c in names], i) for i, r in enumerate(combos)],
        ", ".join(f"`{c}` string" for c in names) + ", combo int",
    )
    cells = keyed.join(lookup, names).select("cell_id", "combo")
    n_c = np.array([r["_n"] for r in combos], dtype=float)
    batches = sorted({r[batch] for r in combos})
    batch_of = np.array([batches.index(r[batch]) for r in combos])
    n_b = np.bincount(batch_of, weights=n_c, minlength=len(batches))
    total = n_c.sum()
    design = [np.eye(len(batches))[batch_of]]
    for c in covariates:
        levels = sorted({r[c] for r in combos})
        column = np.array([levels.index(r[c]) for r in combos])
        design.append(np.eye(len(levels))[column][:, 1:])
    design = np.hstack(design)
    solve = np.linalg.pinv(design.T @ (design * n_c[:, None]))
    n_batches = len(batches)

    sums = x.join(features.select("gene_id").distinct(), "gene_id", "left_semi").join(cells, "cell_id").groupBy("gene_id", "combo").agg(
        F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")
    )
    packed = sums.groupBy("gene_id").agg(
        F.collect_list("combo").alias("c"), F.collect_list("s").alias("s"), F.collect_list("q").alias("q")
    )
    gene_type = x.schema["gene_id"].dataType.simpleString()

    def standardize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            s, q = np.zeros((len(pdf), len(n_c))), np.zeros((len(pdf), len(n_c)))
            for i, (c, a, b) in enumerate(zip(pdf["c"], pdf["s"], pdf["q"])):
                s[i, np.asarray(c, int)] = a
                q[i, np.asarray(c, int)] = b
            beta = (s @ design) @ solve
            fit = beta @ design.T
            grand = beta[:, :n_batches] @ (n_b / total)
            stand = grand[:, None] + beta[:, n_batches:] @ design[:, n_batches:].T
            pooled = np.maximum((q - 2 * fit * s + n_c * fit * fit).sum(axis=1) / total, 0.0)
            sigma = np.sqrt(pooled)
            safe = np.where(sigma > 1e-10, sigma, 1.0)[:, None]
            z1 = (s - n_c * stand) / safe
            z2 = (q - 2 * stand * s + n_c * stand * stand) / safe**2
            onto = np.eye(n_batches)[batch_of]
            z1, z2 = z1 @ onto, z2 @ onto
            gamma = z1 / n_b
            delta = (z2 - z1 * z1 / n_b) / np.maximum(n_b - 1, 1)
            ok = sigma > 1e-10
            yield pd.DataFrame(
                {"gene_id": pdf["gene_id"], "ok": ok, "sigma": sigma, "stand": list(stand), "gamma": list(gamma),
                 "delta": list(np.maximum(delta, 0.0)), "z1": list(z1), "z2": list(z2)}
            )

    standardized = cut(
        packed.mapInPandas(
            standardize,
            f"gene_id {gene_type}, ok boolean, sigma double, stand array<double>, gamma array<double>, delta array<double>, "
            "z1 array<double>, z2 array<double>",
        ),
        "combat",
    )
    used = standardized.filter("ok").select(F.posexplode(F.arrays_zip("gamma", "delta")).alias("b", "e"))
    priors = used.groupBy("b").agg(
        F.avg("e.gamma").alias("gm"), F.var_samp("e.gamma").alias("gv"), F.avg("e.delta").alias("dm"), F.var_samp("e.delta").alias("dv")
    ).orderBy("b").toPandas()
    g_bar, t2 = priors["gm"].to_numpy(), np.nan_to_num(priors["gv"].to_numpy(float))
    dm, dv = priors["dm"].to_numpy(), np.maximum(np.nan_to_num(priors["dv"].to_numpy(float)), 1e-12)
    a_prior, b_prior = (2 * dv + dm**2) / dv, (dm * dv + dm**3) / dv

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf) == 0:
                continue
            gamma_hat, z1, z2 = (np.stack(pdf[c]) for c in ("gamma", "z1", "z2"))
            g, d = gamma_hat.copy(), np.stack(pdf["delta"])
            moving = np.arange(len(g))  # genes whose solution still moves
            while len(moving):
                z1_, z2_, hat, g_, d_ = z1[moving], z2[moving], gamma_hat[moving], g[moving], d[moving]
                g_new = (t2 * n_b * hat + d_ * g_bar) / np.maximum(t2 * n_b + d_, 1e-300)
                ss = z2_ - 2 * g_new * z1_ + n_b * g_new**2
                d_new = (0.5 * ss + b_prior) / (n_b / 2 + a_prior - 1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    change = np.maximum(np.abs(g_new - g_) / np.maximum(np.abs(g_), 1e-12), np.abs(d_new - d_) / np.maximum(d_, 1e-12))
                g[moving], d[moving] = g_new, d_new
                moving = moving[np.nan_to_num(change).max(axis=1) >= tolerance]
            ok = pdf["ok"].to_numpy()[:, None]
            slope = np.where(ok, 1 / np.sqrt(np.maximum(d, 1e-12)), 1.0)[:, batch_of]
            stand, sigma = np.stack(pdf["stand"]), pdf["sigma"].to_numpy()[:, None]
            intercept = np.where(ok, stand * (1 - slope) - sigma * g[:, batch_of] * slope, 0.0)
            yield pd.DataFrame({"gene_id": pdf["gene_id"], "slope": list(slope), "intercept": list(intercept)})

    shrunk = standardized.mapInPandas(shrink, f"gene_id {gene_type}, slope array<double>, intercept array<double>")
    model = shrunk.select("gene_id", F.posexplode(F.arrays_zip("slope", "intercept")).alias("combo", "e")).select(
        "gene_id", "combo", F.col("e.slope").alias("slope"), F.col("e.intercept").alias("intercept")
    )
    return cut(model, "combat"), cells


def combat(x: DataFrame, obs: DataFrame, features: DataFrame, batch: str, covariates: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Corrected dense rows over the selected features, and the feature positions.

    Zeros are corrected too, so the result is dense by nature.
    """
    model, cells = combat_model(x, obs, features, batch, covariates)
    index = cut(mx.feature_index(model.select("gene_id")), "features")
    n = index.count()
    lines = model.join(index, "gene_id").groupBy("combo").agg(
        F.sort_array(F.collect_list(F.struct("idx", "slope", "intercept"))).alias("m")
    )
    vectors = mx.to_vectors(x, cells, index, n).join(cells, "cell_id").join(lines, "combo")
    corrected = F.zip_with("v", "m", lambda v, m: v * m["slope"] + m["intercept"])
    return vectors.select("cell_id", corrected.alias("v")), index


# ------------------------------------------------------------------ soft clustering with diversity


def harmony(
    emb: DataFrame, obs: DataFrame, batches: Sequence[str], theta: float = 2.0, sigma: float = 0.1, ridge: float = 1.0,
    n_clusters: int | None = None, max_rounds: int = 10, inner_rounds: int = 4, tolerance: float = 1e-4, seed: int = 0,
) -> DataFrame:
    """Embedding corrected by soft clusters that are pushed to mix the batches.

    Rows stay where they are: every step is one pass that adds up cluster-sized
    statistics, and only those reach the driver.
    """
    levels = {b: [r[0] for r in _bounded(obs.select(quoted(b).cast("string").alias("b")).na.drop().distinct().orderBy("b"), MAX_GROUPS, "batches")] for b in batches}
    offsets = np.cumsum([0, *[len(v) for v in levels.values()]])
    n_levels = int(offsets[-1])
    coded = drop_missing(obs, list(batches)).select(
        "cell_id", F.array(*[
            F.array_position(F.array(*[F.lit(v) for v in levels[b]]), quoted(b).cast("string")).cast("int") - 1 + int(offsets[i])
            for i, b in enumerate(batches)
        ]).alias("codes"),
    )
    rows = cut(emb.select("cell_id", F.col("v").alias("z"), F.col("v").alias("v")).join(coded, "cell_id"), "harmony")
    n = rows.count()
    if n == 0:
        return emb.select("cell_id", "v")
    d = len(rows.first()["z"])
    k = n_clusters or max(2, min(round(n / 30), 100))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    unit = rows.select(array_to_vector(F.transform("v", lambda e: e / F.greatest(norm, F.lit(1e-12)))).alias("features"))
    centers = np.stack(KMeans(k=k, seed=seed, maxIter=25).fit(unit).clusterCenters())
    centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    k = len(centers)
    share = np.array([r["n"] for r in rows.select(F.explode("codes").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy("c").collect()]) / n
    id_type = emb.schema["cell_id"].dataType.simpleString()
    # All rows are updated together, so the diversity weight moves only part of the way
    # to its new value; this share makes the update settle instead of swinging.
    penalty, damping = np.zeros((k, n_levels)), 1.0 / (1.0 + theta)

    def responsibilities(v: np.ndarray, codes: np.ndarray, centers, penalty) -> np.ndarray:
        u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        score = -2.0 * (1.0 - u @ centers.T) / sigma
        for j in range(codes.shape[1]):
            score = score + penalty[:, codes[:, j]].T
        score -= score.max(axis=1, keepdims=True)
        r = np.exp(score)
        return r / r.sum(axis=1, keepdims=True)

    def one_hot(codes: np.ndarray) -> np.ndarray:
        phi = np.zeros((len(codes), n_levels))
        for j in range(codes.shape[1]):
            phi[np.arange(len(codes)), codes[:, j]] = 1.0
        return phi

    def gather(frame: DataFrame, fn, width: int) -> np.ndarray:
        parts = frame.mapInPandas(fn, "part array<double>")
        out = parts.agg(Summarizer.sum(array_to_vector("part")).alias("s")).first()["s"]
        return out.toArray() if out is not None else np.zeros(width)

    previous = np.inf
    for _ in range(max_rounds):
        for _ in range(inner_rounds):

            def moments(frames: Iterator[pd.DataFrame], centers=centers, penalty=penalty) -> Iterator[pd.DataFrame]:
                total = np.zeros(k * (d + n_levels) + 1)
                for pdf in frames:
                    v, codes = np.stack(pdf["v"]), np.stack(pdf["codes"])
                    r = responsibilities(v, codes, centers, penalty)
                    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                    distance = 2.0 * (1.0 - u @ centers.T)
                    loss = (r * distance).sum() + sigma * (r * np.log(np.maximum(r, 1e-300))).sum()
                    total += np.concatenate([(r.T @ u).ravel(), (r.T @ one_hot(codes)).ravel(), [loss]])
                yield pd.DataFrame({"part": [total]})

            stats = gather(rows, moments, k * (d + n_levels) + 1)
            centers = stats[: k * d].reshape(k, d)
            centers = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
            observed = stats[k * d : -1].reshape(k, n_levels)
            mass = observed[:, offsets[0] : offsets[1]].sum(axis=1)
            expected = mass[:, None] * share[None, :]
            target = theta * (np.log(expected + 1.0) - np.log(observed + 1.0))
            penalty = (1.0 - damping) * penalty + damping * target
        p = n_levels + 1
        shape = p * p + p * d

        def regress(frames: Iterator[pd.DataFrame], centers=centers, penalty=penalty) -> Iterator[pd.DataFrame]:
            total = np.zeros((k, shape))
            for pdf in frames:
                v, z, codes = np.stack(pdf["v"]), np.stack(pdf["z"]), np.stack(pdf["codes"])
                r = responsibilities(v, codes, centers, penalty)
                phi = np.hstack([np.ones((len(pdf), 1)), one_hot(codes)])
                for c in range(k):
                    weighted = phi * r[:, c : c + 1]
                    total[c] += np.concatenate([(weighted.T @ phi).ravel(), (weighted.T @ z).ravel()])
            yield pd.DataFrame({"part": [total.ravel()]})

        stats2 = gather(rows, regress, k * shape).reshape(k, shape)
        penalty_matrix = ridge * np.eye(p)
        penalty_matrix[0, 0] = 1e-9
        shifts = np.zeros((k, n_levels, d))
        for c in range(k):
            w = np.linalg.solve(stats2[c, : p * p].reshape(p, p) + penalty_matrix, stats2[c, p * p :].reshape(p, d))
            shifts[c] = w[1:]

        def apply(frames: Iterator[pd.DataFrame], centers=centers, penalty=penalty, shifts=shifts) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                v, z, codes = np.stack(pdf["v"]), np.stack(pdf["z"]), np.stack(pdf["codes"])
                r = responsibilities(v, codes, centers, penalty)
                out = z.copy()
                for j in range(codes.shape[1]):
                    for level in np.unique(codes[:, j]):
                        at = codes[:, j] == level
                        out[at] -= r[at] @ shifts[:, level, :]
                yield pdf.assign(v=list(out))

        rows = cut(rows.mapInPandas(apply, f"cell_id {id_type}, z array<double>, v array<double>, codes array<int>"), "harmony")
        loss = stats[-1]
        if np.isfinite(previous) and abs(previous - loss) < tolerance * abs(previous):
            break
        previous = loss
    return rows.select("cell_id", "v")


# ------------------------------------------------------------------ neighbour based


def bbknn(emb: DataFrame, batch: str, neighbors_within_batch: int = 3) -> tuple[DataFrame, DataFrame]:
    """Neighbours from every batch and their fuzzy union.

    Batches that are not larger than the number of neighbours are dropped first.
    """
    sizes = emb.groupBy(quoted(batch)).agg(F.count(F.lit(1)).alias("_n"))
    large = cut(sizes.filter(F.col("_n") > neighbors_within_batch).select(quoted(batch)), "batches")
    kept = join_keys(emb, large, [batch], "left_semi")
    edges = cut(knn(kept, neighbors_within_batch, each=batch), "bbknn")
    n = neighbors_within_batch * max(large.count(), 1)
    return edges, connectivities(edges, max(n, 2))


def mutual_neighbors(emb: DataFrame, batch: str, k: int = 20) -> DataFrame:
    """Pairs of rows of different batches that are among each other's nearest: ``src, dst, a, b``."""
    found = cut(knn(emb, k, each=batch), "mutual")
    tags = emb.select(F.col("cell_id").alias("src"), quoted(batch).cast("string").alias("a"))
    across = found.join(tags, "src").filter(F.col("a") != F.col("target_key")).select("src", "dst", "a", F.col("target_key").alias("b"))
    back = across.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return across.join(back, ["src", "dst"], "left_semi")


def match_shares(pairs: DataFrame, emb: DataFrame, batch: str) -> DataFrame:
    """For each pair of batches the larger share of matched rows."""
    sizes = emb.groupBy(quoted(batch).cast("string").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    matched = pairs.select("a", "b", "src").distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("m")).join(sizes, "a")
    shares = matched.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), (F.col("m") / F.col("n")).alias("share"))
    return shares.groupBy("left", "right").agg(F.max("share").alias("share"))


def smoothed_shifts(rows: DataFrame, anchored: DataFrame, sigma: float) -> DataFrame:
    """Per row (``src``) the Gaussian mean ``_move`` of the shifts of all anchors.

    A block pair emits the weight sum and the weighted shift sum of each row, relative
    to its nearest anchor in the block, so far rows do not underflow; the blocks are put
    on the scale of the nearest anchor of all when they are added up.
    """
    id_type = rows.schema["cell_id"].dataType.simpleString()

    def block(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if len(p) == 0 or len(q) == 0:
            return pd.DataFrame({"src": [], "least": [], "w": [], "s": []})
        a, b, shift = np.stack(p["v"]), np.stack(q["v"]), np.stack(q["shift"])
        b2, least, weight, moved = (b * b).sum(1), np.empty(len(a)), np.empty(len(a)), np.empty((len(a), shift.shape[1]))
        step = max(1, (1 << 21) // len(b))
        for at in range(0, len(a), step):
            part = slice(at, at + step)
            squares = np.maximum((a[part] * a[part]).sum(1)[:, None] + b2 - 2 * a[part] @ b.T, 0)
            least[part] = squares.min(axis=1)
            w = np.exp(-0.5 * sigma * (squares - least[part, None]))
            weight[part], moved[part] = w.sum(axis=1), w @ shift
        return pd.DataFrame({"src": p["cell_id"], "least": least, "w": weight, "s": list(moved)})

    schema = f"src {id_type}, least double, w double, s array<double>"
    parts = cut(pairwise_blocks(rows, anchored, block, schema, block_rows=SHIFT_ROWS, spread=True), "shifts")
    nearest = parts.groupBy("src").agg(F.min("least").alias("_least"))
    scale = F.exp(-0.5 * sigma * (F.col("least") - F.col("_least")))
    scaled = parts.join(nearest, "src").withColumn("_scale", scale)
    sums = scaled.groupBy("src").agg(
        F.sum(F.col("_scale") * F.col("w")).alias("_w"),
        vector_to_array(Summarizer.sum(array_to_vector(F.transform("s", lambda x: x * F.col("_scale"))))).alias("_s"),
    )
    return sums.select("src", F.transform("_s", lambda x: x / F.col("_w")).alias("_move"))


def panorama(
    emb: DataFrame, batch: str, k: int = 20, sigma: float = 15.0, min_share: float = 0.1
) -> DataFrame:
    """Batches stitched together along mutual neighbours.

    Pairs of batches are joined by falling match share; the rows of the joining side
    move by the Gaussian mean of the shifts of all its matched rows, summed block by
    block.
    """
    size = F.greatest(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)), F.lit(1e-12))
    rows = cut(emb.select("cell_id", quoted(batch).cast("string").alias("batch"), F.transform("v", lambda e: e / size).alias("v")), "panorama")
    pairs = cut(mutual_neighbors(rows, "batch", k), "pairs")
    shares = _bounded(
        match_shares(pairs, rows, "batch").filter(F.col("share") >= min_share).orderBy(F.desc("share"), "left", "right"), MAX_GROUPS, "batch pairs"
    )
    group_of = {r["batch"]: r["batch"] for r in _bounded(rows.select("batch").distinct(), MAX_GROUPS, "batches")}
    for r in shares:
        target, moving = group_of[r["left"]], group_of[r["right"]]
        if target == moving:
            continue
        inside = lambda c, g: F.col(c).isin([b for b, x in group_of.items() if x == g])
        used = pairs.filter(inside("a", moving) & inside("b", target))
        here = rows.select(F.col("cell_id").alias("src"), F.col("v").alias("_s"))
        there = rows.select(F.col("cell_id").alias("dst"), F.col("v").alias("_d"))
        shifts = used.join(here, "src").join(there, "dst").select(
            "src", "_s", F.zip_with("_d", "_s", lambda x, y: x - y).alias("_shift")
        ).groupBy("src").agg(F.first("_s").alias("v"), Summarizer.mean(array_to_vector("_shift")).alias("_m"))
        anchored = cut(shifts.select(F.col("src").alias("cell_id"), "v", vector_to_array("_m").alias("shift")), "anchors")
        movers = rows.filter(inside("batch", moving))
        moved = smoothed_shifts(movers.select("cell_id", "v"), anchored, sigma)
        joined = rows.join(moved.withColumnRenamed("src", "cell_id"), "cell_id", "left")
        rows = cut(
            joined.select("cell_id", "batch", F.when(F.col("_move").isNull(), F.col("v")).otherwise(
                F.zip_with("v", "_move", lambda x, y: x + y)).alias("v")),
            "panorama",
        )
        group_of = {b: (target if g == moving else g) for b, g in group_of.items()}
    return rows.select("cell_id", "v")

