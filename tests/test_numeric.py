"""Numeric operators against brute force in NumPy, planted structure, empty input."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heddle.operators import correct as co, graph as gr, labels as lb, markers as mk, matrix as mx, metrics as mt
from heddle.operators import neighbors as nb, qc, samples as sa
from heddle.operators import aggregate as ag


def embed(spark, v, **columns):
    rows = [(int(i), [float(a) for a in r], *[c[i] for c in columns.values()]) for i, r in enumerate(v)]
    types = ", ".join(f"{k} {'string' if isinstance(c[0], str) else 'double'}" for k, c in columns.items())
    return spark.createDataFrame(rows, "cell_id long, v array<double>" + (", " + types if types else ""))


def brute_knn(v, k, allowed=None, ids=None):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    out = {}
    for i in range(len(v)):
        others = [j for j in range(len(v)) if j != i and (allowed is None or allowed(i, j))]
        out[i] = sorted(others, key=lambda j: (round(d[i, j], 9), j))[:k]
    return out


def as_lists(df):
    pdf = df.toPandas().sort_values(["src", "rank"])
    return {s: list(p["dst"]) for s, p in pdf.groupby("src")}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centers = np.array([[0, 0, 0, 0], [8, 0, 0, 0], [0, 8, 0, 0]])
    label = np.repeat([0, 1, 2], 40)
    v = centers[label] + rng.normal(size=(120, 4))
    batch = [str(b) for b in rng.integers(0, 2, 120)]
    return v, [f"l{a}" for a in label], batch


@pytest.mark.parametrize("direct_rows", [0, 1024])
def test_knn_is_exact_with_copies(spark, direct_rows):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(160, 5))
    v[100:150] = v[3]  # a third of the rows are copies of one row
    emb = embed(spark, v)
    assert as_lists(nb.knn(emb, 6, direct_rows=direct_rows)) == brute_knn(v, 6)


def test_knn_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(nb, "PIECE_ROWS", 16)
    v = np.random.default_rng(3).normal(size=(150, 3))
    assert as_lists(nb.knn(embed(spark, v), 4, direct_rows=0)) == brute_knn(v, 4)


@pytest.mark.parametrize("cells", [64, 1 << 16])
def test_knn_in_many_dimensions_by_blocks(spark, monkeypatch, cells):
    monkeypatch.setattr(nb, "VISIT_CELLS", cells)
    monkeypatch.setattr(nb, "PIECE_ROWS", 16)
    monkeypatch.setattr(nb, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(17)
    v = rng.normal(size=(300, 12))
    v[200:220] = v[4]
    label = [f"l{a}" for a in rng.integers(0, 2, 300)]
    emb = embed(spark, v, label=label)
    assert as_lists(nb.knn(emb, 5, same="label", direct_rows=0)) == brute_knn(v, 5, lambda i, j: label[i] == label[j])
    assert as_lists(nb.knn(emb, 5, direct_rows=0)) == brute_knn(v, 5)


def test_visits_leave_in_bounded_parts():
    """One batch of rows in many dimensions visits most regions; no part sent on holds them all."""
    rng = np.random.default_rng(18)
    pivots = pd.DataFrame({"_key": "", "cell": [f"p{i}" for i in range(256)], "v": list(rng.normal(size=(256, 32)))})
    stats = pd.DataFrame({"_key": "", "cell": pivots["cell"], "n": 40.0, "radius": 9.0})
    regions = nb.Regions(pivots).with_sizes(stats)
    rows = pd.DataFrame({"qid": range(2000), "_key": "", "v": list(rng.normal(size=(2000, 32))), "bound": 9.0})
    sizes = [len(part) for part in nb._visits(regions, 15, True)(iter([rows]))]
    assert sum(sizes) > 400_000 and max(sizes) <= 1 << 16


@pytest.mark.parametrize("direct_rows", [0, 1024])
def test_knn_same_and_each(spark, blobs, direct_rows):
    v, label, batch = blobs
    emb = embed(spark, v, label=label, batch=batch)
    same = nb.knn(emb, 5, same="label", direct_rows=direct_rows)
    assert as_lists(same) == brute_knn(v, 5, lambda i, j: label[i] == label[j])
    each = nb.knn(emb, 3, each="batch", direct_rows=direct_rows)
    for b in ("0", "1"):
        got = as_lists(each.filter(F.col("target_key") == b))
        assert got == brute_knn(v, 3, lambda i, j: batch[j] == b)


def test_knn_more_neighbours_than_rows(spark):
    v = np.random.default_rng(4).normal(size=(5, 2))
    assert as_lists(nb.knn(embed(spark, v), 20)) == brute_knn(v, 20)


def test_connectivities_reach_the_target(spark, blobs):
    v, _, _ = blobs
    k = 10
    edges = gr.neighbors(embed(spark, v), k).toPandas()
    directed = {}
    for s, p in edges.groupby("src"):
        d = np.sort(p["dist"].to_numpy())
        rho = d[d > 0].min()
        lo, hi = 0.0, 1e3
        for _ in range(200):
            mid = (lo + hi) / 2
            if np.exp(-np.maximum(d - rho, 0) / mid).sum() > math.log2(k):
                hi = mid
            else:
                lo = mid
        for t, x in zip(p["dst"], p["dist"]):
            directed[s, t] = math.exp(-max(x - rho, 0) / mid)
    got = {(r["src"], r["dst"]): r["weight"] for r in gr.connectivities(gr.neighbors(embed(spark, v), k), k).collect()}
    for (s, t), w in got.items():
        a, b = directed.get((s, t), 0), directed.get((t, s), 0)
        assert abs(w - (a + b - a * b)) < 1e-4
        assert abs(got[t, s] - w) < 1e-12


def test_components_match_union_find(spark):
    rng = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(30)]
    edges = chain + [(int(a), int(b)) for a, b in rng.integers(40, 80, (20, 2))]
    parent = list(range(80))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = gr.connected_components(spark.createDataFrame(edges, "src int, dst int"), spark.range(80).select(F.col("id").cast("int").alias("node")))
    assert {r["node"]: r["component"] for r in got.collect()} == {i: find(i) for i in range(80)}


@pytest.mark.parametrize("algorithm", ["leiden", "louvain"])
def test_clusters_find_planted_groups(spark, blobs, algorithm):
    v, label, _ = blobs
    emb = embed(spark, v, label=label)
    weights = gr.connectivities(gr.neighbors(emb, 15), 15)
    found = gr.add_clusters(emb, weights, [0.3], algorithm)
    name = gr.cluster_column(algorithm, 0.3)
    assert abs(mt.ari(found, name, "label").first()[0] - 1) < 1e-9
    assert gr.add_clusters(found, weights, [0.3], algorithm) is found


def test_subclusters_keep_small_parents(spark, blobs):
    v, label, _ = blobs
    parent = ["a" if x == "l0" else "b" if x == "l1" else "x_7" for x in label]
    small = embed(spark, np.vstack([v, v[:5] + 0.1]), parent=parent + ["p_3"] * 5)
    got = gr.subcluster(small, "parent", 0.2).toPandas()
    assert set(got[got["parent"] == "p_3"]["label"]) == {"p_3_3"}
    assert all(r["label"].startswith(r["parent"] + "_") for _, r in got.iterrows())


def test_best_resolution_is_found(spark, blobs):
    v, label, _ = blobs
    emb = embed(spark, v, label=label)
    weights = gr.connectivities(gr.neighbors(emb, 15), 15)
    found = mt.optimal_clusters(weights, emb, "label", [0.3, 3.0]).toPandas()
    assert set(found["resolution"]) == {0.3} and abs(found["nmi"].iloc[0] - 1) < 1e-9


def test_mds_recovers_distances(spark):
    p = np.random.default_rng(6).normal(size=(12, 2)) * [3, 1]
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    rows = [(i, j, float(d[i, j])) for i in range(12) for j in range(12)]
    got = gr.mds(spark.createDataFrame(rows, "src int, dst int, dist double")).toPandas().sort_values("src")
    q = np.stack(got["v"])
    assert np.allclose(np.sqrt(((q[:, None] - q[None]) ** 2).sum(-1)), d, atol=1e-6)


def test_layout_pulls_groups_apart(spark, blobs):
    v, label, _ = blobs
    emb = embed(spark, v, label=label)
    weights = gr.connectivities(gr.neighbors(emb, 10), 10)
    got = gr.umap_layout(weights, emb.select(F.col("cell_id").alias("node")), n_epochs=12).toPandas().sort_values("node")
    xy, lab = got[["x", "y"]].to_numpy(), np.array(label)
    inside = np.mean([np.linalg.norm(xy[lab == g] - xy[lab == g].mean(0), axis=1).mean() for g in set(label)])
    assert np.isfinite(xy).all() and inside < np.linalg.norm(xy - xy.mean(0), axis=1).mean()


# ---------------------------------------------------------------- matrix


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(7)
    dense = rng.poisson(0.8, size=(60, 12)).astype(float)
    dense[5] = 0  # an empty row
    dense[:, 11] = 0  # an absent feature
    batch = [str(b) for b in rng.integers(0, 3, 60)]
    dense[np.array(batch) == "1"] *= 2
    entries = [(int(i), int(g), float(dense[i, g])) for i, g in zip(*np.nonzero(dense))]
    x = spark.createDataFrame(entries, "cell_id long, gene_id long, value double")
    obs = spark.createDataFrame([(i, b, "u" if i % 4 else "w") for i, b in enumerate(batch)], "cell_id long, batch string, cov string")
    var = spark.createDataFrame([(g, f"g{g}") for g in range(12)], "gene_id long, feature_name string")
    return dense, x, obs, var, np.array(batch)


def test_scale_counts_zeros(spark, counts):
    dense, x, obs, var, _ = counts
    got = mx.scale(x, obs, var, 2.0).toPandas().pivot(index="cell_id", columns="gene_id", values="value").to_numpy()
    sd = dense.std(axis=0, ddof=1)
    want = np.clip((dense - dense.mean(0)) / np.where(sd > 0, sd, 1), -2, 2)
    assert np.allclose(got, want)


def test_pca_matches_numpy(spark, counts):
    dense, x, obs, var, _ = counts
    scores, loadings, variance = mx.matrix_pca(x, obs, var, 4)
    c = dense - dense.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    got = np.stack(scores.toPandas().sort_values("cell_id")["v"])
    load = np.stack(loadings.toPandas().sort_values("gene_id")["v"])
    assert np.allclose(np.abs(got), np.abs(c @ vt[:4].T), atol=1e-8)
    assert np.allclose(got, c @ load, atol=1e-8)
    assert (load[np.abs(load).argmax(0), range(4)] > 0).all()
    assert np.allclose(variance.toPandas().sort_values("pc")["variance"], s[:4] ** 2 / 59)


def test_set_scores_of_empty_cells_are_zero(spark, counts):
    _, x, obs, var, _ = counts
    sets = spark.createDataFrame([("s", 0), ("s", 1), ("gone", 99)], "set_id string, gene_id long")
    got = mx.score_sets(x, obs, var, sets, n_bins=4).toPandas()
    assert len(got) == 60 and float(got[got["cell_id"] == 5]["score"].iloc[0]) == 0.0


def test_pseudobulk_drops_single_rows(spark, counts):
    dense, x, obs, _, batch = counts
    one = obs.withColumn("batch", F.when(F.col("cell_id") == 0, "single").otherwise(F.col("batch")))
    got = ag.pseudobulk(one, x, ["batch"], "mean").toPandas()
    assert "single" not in set(got["batch"])
    rows = (batch == "2") & (np.arange(60) != 0)
    want = dense[rows].mean(0)
    have = got[got["batch"] == "2"].set_index("gene_id")["value"].reindex(range(12)).fillna(0)
    assert np.allclose(have, want)


def brute_combat(y, batch, design_cov):
    """Parametric empirical Bayes, gene by gene."""
    levels = sorted(set(batch))
    onehot = np.array([[b == l for l in levels] for b in batch], float)
    design = np.hstack([onehot, design_cov])
    n = len(y)
    nb_ = onehot.sum(0)
    beta = np.linalg.pinv(design.T @ design) @ design.T @ y
    grand = (nb_ / n) @ beta[: len(levels)]
    pooled = ((y - design @ beta) ** 2).mean(0)
    stand = grand + design_cov @ beta[len(levels):]
    s = (y - stand) / np.sqrt(pooled)
    out = y.copy()
    g_all = np.array([s[np.array(batch) == l].mean(0) for l in levels])
    d_all = np.array([s[np.array(batch) == l].var(0, ddof=1) for l in levels])
    for i, l in enumerate(levels):
        at = np.array(batch) == l
        gb, t2 = g_all[i].mean(), g_all[i].var(ddof=1)
        m, v = d_all[i].mean(), d_all[i].var(ddof=1)
        a, b = (2 * v + m * m) / v, (m * v + m**3) / v
        for j in range(y.shape[1]):
            g, d = g_all[i, j], d_all[i, j]
            for _ in range(1000):
                g2 = (t2 * nb_[i] * g_all[i, j] + d * gb) / (t2 * nb_[i] + d)
                d2 = (0.5 * ((s[at, j] - g2) ** 2).sum() + b) / (nb_[i] / 2 + a - 1)
                done = abs(g2 - g) < 1e-10 and abs(d2 - d) < 1e-10
                g, d = g2, d2
                if done:
                    break
            base = stand[at, j] if design_cov.shape[1] else stand[j] if np.ndim(stand) == 1 else stand[at, j]
            out[at, j] = (s[at, j] - g) / np.sqrt(d) * np.sqrt(pooled[j]) + base
    return out


@pytest.mark.parametrize("covariates", [[], ["cov"]])
def test_combat_matches_brute_force(spark, counts, covariates):
    dense, x, obs, var, batch = counts
    cov = np.array([[i % 4 == 0] for i in range(60)], float) if covariates else np.zeros((60, 0))
    want = brute_combat(dense[:, :11], list(batch), cov)
    vectors, _ = co.combat(x, obs, var.filter("gene_id < 11"), "batch", covariates)
    got = np.stack(vectors.toPandas().sort_values("cell_id")["v"])
    assert np.allclose(got, want, atol=5e-3)


# ---------------------------------------------------------------- corrections


def test_harmony_removes_a_shift(spark, blobs):
    v, label, batch = blobs
    shifted = v + np.where(np.array(batch) == "1", 3.0, 0.0)[:, None] * np.array([0, 0, 1, 0]) + 10
    emb = embed(spark, shifted, label=label, batch=batch)
    out = co.harmony(emb, emb, ["batch"], n_clusters=5, max_rounds=5)
    before = mt.pcr(emb, emb, "batch").first()[0]
    after = mt.pcr(out, emb, "batch").first()[0]
    assert after < 0.3 * before


def test_scale_joins_nothing_to_its_dense_rows(spark):
    x = spark.createDataFrame([(0, 0, 2.0), (1, 0, 4.0), (1, 1, 1.0)], "cell_id long, gene_id long, value double")
    cells = spark.createDataFrame([(0,), (1,), (2,)], "cell_id long")
    features = spark.createDataFrame([(0,), (1,), (5,)], "gene_id long")
    out = mx.scale(x, cells, features)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate") < plan.index("Join")  # from the top down
    got = {(r["cell_id"], r["gene_id"]): r["value"] for r in out.collect()}
    dense = np.array([[2.0, 0, 0], [4, 1, 0], [0, 0, 0]])
    sd = dense.std(axis=0, ddof=1)
    want = (dense - dense.mean(axis=0)) / np.where(sd > 0, sd, 1)
    assert len(got) == 9 and all(abs(got[i, g] - want[i, j]) < 1e-12 for i in range(3) for j, g in enumerate((0, 1, 5)))


def test_set_scores_broadcast_nothing_by_feature(spark):
    x = spark.createDataFrame([(i, g, float(1 + (i * g) % 3)) for i in range(6) for g in range(12) if (i + g) % 2], "cell_id long, gene_id long, value double")
    var = spark.createDataFrame([(g,) for g in range(12)], "gene_id long")
    sets = spark.createDataFrame([("a", g) for g in range(4)] + [("b", g) for g in range(3, 8)], "set_id string, gene_id long")
    out = mx.score_sets(x, x.select("cell_id").distinct(), var, sets)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    joins = [line for line in plan if "gene_id" in line and ("HashJoin" in line or "MergeJoin" in line)]
    assert joins and not any("Broadcast" in line for line in joins)
    assert out.count() == 12


def compositions_of_few_events(spark):
    rng = np.random.default_rng(20)
    rows = [(int(u), f"t{t}") for u in range(70) for t in rng.integers(0, 3, 4)]
    return spark.createDataFrame(rows, "s long, t string")


def test_nearest_compositions_keep_ties_and_leave_few_rows(spark, monkeypatch):
    monkeypatch.setattr(sa, "BLOCK_ROWS", 32)
    events = compositions_of_few_events(spark)
    want = sa.composition_distances(events, "s", "t").withColumn("dist", F.round("dist", 9))
    few = sa.composition_distances(events, "s", "t", nearest=5)
    got = few.withColumn("dist", F.round("dist", 9))
    assert few.count() <= 70 * 3 * 5  # five from each block, not all 4900 pairs
    as_rows = lambda d: sorted(tuple(r) for r in sa.neighbors_from_distances(d, 6).select("src", "dst", "dist").collect())
    assert as_rows(got) == as_rows(want)


def test_counted_distances_give_the_histogram_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(sa, "BLOCK_ROWS", 32)
    events = compositions_of_few_events(spark)
    want = ag.distance_histogram(sa.composition_distances(events, "s", "t").withColumn("dist", F.round("dist", 9)), 20)
    few = sa.composition_distances(events, "s", "t", bins=20)
    assert few.count() <= 9 * 21
    assert sorted(map(tuple, ag.distance_histogram(few, 20, weight="n").collect())) == sorted(map(tuple, want.collect()))


def test_rounding_of_distances_is_that_of_spark(spark):
    x = np.array([0.0, 1.5e-9, 2.5e-9, 0.1234567895, 0.1234567885, 1.4142135623730951, 0.3, 0.0000000005])
    want = [r[0] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double").orderBy("i").select(F.round("v", 9)).collect()]
    assert sa.rounded_like_spark(x, 9).tolist() == want


def test_smoothed_shifts_send_few_blocks(spark, monkeypatch):
    rng = np.random.default_rng(19)
    v, anchors, shift = rng.normal(size=(3000, 2)), rng.normal(size=(2500, 2)), rng.normal(size=(2500, 2))
    made, kept = [], co.cut
    monkeypatch.setattr(co, "cut", lambda df, tag="stage": made.append(kept(df, tag)) or made[-1])
    rows = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(anchors, shift))]
    got = co.smoothed_shifts(embed(spark, v), spark.createDataFrame(rows, "cell_id long, v array<double>, shift array<double>"), 15.0)
    got = np.stack([r["_move"] for r in got.orderBy("src").collect()])
    squares = ((v[:, None] - anchors) ** 2).sum(-1)
    w = np.exp(-7.5 * (squares - squares.min(axis=1, keepdims=True)))
    assert np.allclose(got, w @ shift / w.sum(axis=1, keepdims=True))
    assert made[0].count() == len(v)  # one part per row and block of anchors


def test_panorama_reduces_a_shift(spark, blobs):
    v, label, batch = blobs
    shifted = v + np.where(np.array(batch) == "1", 1.5, 0.0)[:, None] * np.array([0, 0, 0, 1]) + 5
    emb = embed(spark, shifted, batch=batch)
    norm = emb.withColumn("v", F.transform("v", lambda a: a / F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))))
    out = co.panorama(emb, "batch")
    assert mt.pcr(out, emb, "batch").first()[0] < 0.7 * mt.pcr(norm, emb, "batch").first()[0]


def test_bbknn_drops_small_batches(spark, blobs):
    v, _, batch = blobs
    emb = embed(spark, np.vstack([v, [[0, 0, 0, 0]]]), batch=batch + ["tiny"])
    edges, weights = co.bbknn(emb, "batch")
    counts = edges.groupBy("src").count().select("count").distinct().collect()
    assert [r[0] for r in counts] == [6]
    assert edges.filter("src = 120 OR dst = 120").count() == 0 and weights.count() > 0


# ---------------------------------------------------------------- metrics


def brute_silhouette(v, label):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    label = np.array(label)
    out = []
    for i in range(len(v)):
        own = (label == label[i]) & (np.arange(len(v)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, label == g].mean() for g in set(label) if g != label[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouette_with_copies_matches_brute_force(spark, blobs):
    v, label, _ = blobs
    v = np.vstack([v, np.repeat(v[:1], 30, axis=0)])
    label = label + ["l0"] * 29 + ["solo"]
    got = mt.asw_label(embed(spark, v, label=label), "label").first()[0]
    assert abs(got - (brute_silhouette(v, label).mean() + 1) / 2) < 1e-9


def test_squared_silhouette_matches_brute_force(spark, blobs):
    v, label, _ = blobs
    d = ((v[:, None] - v[None]) ** 2).sum(-1)
    lab, s = np.array(label), []
    for i in range(len(v)):
        a = d[i, lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        b = min(d[i, lab == g].mean() for g in set(label) if g != lab[i])
        s.append((b - a) / max(a, b))
    got = mt.asw_label(embed(spark, v, label=label), "label", squared=True).first()[0]
    assert abs(got - (np.mean(s) + 1) / 2) < 1e-9


def test_knn_far_from_the_origin(spark):
    v = np.random.default_rng(12).normal(size=(150, 3)) + 1e4
    emb = embed(spark, v)
    assert as_lists(nb.knn(emb, 4, direct_rows=0)) == as_lists(nb.knn(emb, 4))


def test_silhouette_over_many_blocks(spark, blobs, monkeypatch):
    v, label, batch = blobs
    emb = embed(spark, v, label=label, batch=batch)
    whole = mt.asw_batch(emb, "batch", "label").first()[0]
    original = nb.pairwise_blocks
    monkeypatch.setattr(mt.nb, "pairwise_blocks", lambda *a, **k: original(*a, **{**k, "block_rows": 7}))
    assert abs(mt.asw_batch(emb, "batch", "label").first()[0] - whole) < 1e-9


def test_lisi_limits(spark):
    edges = [(i, j, 1.0) for i in range(6) for j in range(6) if i != j]
    df = spark.createDataFrame(edges, "src int, dst int, dist double")
    one = spark.createDataFrame([(i, "a") for i in range(6)], "cell_id int, b string")
    got = [r["lisi"] for r in mt.lisi(df, one, "b", 5, 3).collect()]
    assert np.allclose(got, 1.0)
    two = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(6)], "cell_id int, b string")
    got = [r["lisi"] for r in mt.lisi(df, two, "b", 5, 3).collect()]
    assert np.allclose(got, 1 / (0.4**2 + 0.6**2))


def test_chi2_and_t_tails():
    assert abs(mt._gamma_tail(1.0, 3.841 / 2) - math.exp(-3.841 / 2)) < 1e-12
    assert abs(mt._gamma_tail(0.5, 3.841458820694124 / 2) - 0.05) < 1e-9
    assert abs(mk._beta_tail(5, 0.5, 10 / (10 + 2.2281388519649385**2)) - 0.05) < 1e-9


def test_hypergeometric_tail_by_enumeration():
    total, marked, drawn, hits = 9, 4, 5, 3
    hit = [sum(i < marked for i in c) >= hits for c in itertools.combinations(range(total), drawn)]
    assert abs(math.exp(qc._hypergeometric_log_tail(total, marked, drawn, hits)) - np.mean(hit)) < 1e-12


def test_morans_i_constant_is_missing(spark, blobs):
    v, label, _ = blobs
    emb = embed(spark, v)
    edges = gr.connectivities(gr.neighbors(emb, 8), 8)
    flat = emb.select("cell_id", F.lit(2.0).alias("x"))
    assert mt.morans_i(edges, flat, emb).first()[0] is None
    x = v[:, 0]
    e = edges.toPandas()
    z = x - x.mean()
    want = len(x) / e["weight"].sum() * (e["weight"] * z[e["src"]] * z[e["dst"]]).sum() / (z * z).sum()
    got = mt.morans_i(edges, emb.select("cell_id", F.col("v")[0].alias("x")), emb).first()[0]
    assert abs(got - max(want, 0)) < 1e-9


def test_cell_cycle_of_unchanged_data_is_one(spark, blobs):
    v, _, batch = blobs
    emb = embed(spark, v, batch=batch)
    scores = emb.select("cell_id", F.explode(F.array(F.lit("S"), F.lit("G2M"))).alias("set_id"), (F.col("v")[0] + F.rand(3)).alias("score"))
    assert abs(mt.cell_cycle_conservation(emb, emb, emb, "batch", scores).first()[0] - 1) < 1e-9


def test_ranking_with_one_row_is_not_scaled(spark):
    rows = [("a", "m1", "batch_correction", 0.2), ("a", "m2", "bio_conservation", 0.7), ("a", "m3", "bio_conservation", None)]
    df = spark.createDataFrame(rows, "id string, metric string, metric_type string, score double")
    r = mt.rank_integrations(df, ["id"]).first()
    assert abs(r["overall"] - (0.4 * 0.2 + 0.6 * 0.7)) < 1e-12


# ---------------------------------------------------------------- markers, quality, samples, labels


def test_wilcoxon_and_t_match_brute_force(spark, counts):
    dense, x, obs, var, batch = counts
    ranks = pd.DataFrame(dense).rank(axis=0).to_numpy()
    n = len(dense)
    w = mk.rank_features(obs, x, var, "batch").toPandas().set_index(["cluster", "gene_id"])
    t = mk.rank_features(obs, x, var, "batch", "t-test").toPandas().set_index(["cluster", "gene_id"])
    for b in "012":
        at = batch == b
        n1, n2 = at.sum(), (~at).sum()
        for g in range(12):
            z = (ranks[at, g].sum() - n1 * (n + 1) / 2) / math.sqrt(n1 * n2 * (n + 1) / 12)
            assert abs(w.loc[(b, g), "score"] - z) < 1e-9
            assert abs(w.loc[(b, g), "pval"] - math.erfc(abs(z) / math.sqrt(2))) < 1e-12
            a, c = dense[at, g], dense[~at, g]
            se = a.var(ddof=1) / n1 + c.var(ddof=1) / n2
            if se > 0:
                assert abs(t.loc[(b, g), "score"] - (a.mean() - c.mean()) / math.sqrt(se)) < 1e-9
            assert abs(w.loc[(b, g), "pct_within"] - (a > 0).mean()) < 1e-12


def test_auto_thresholds_find_the_main_part(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(10, 1, 900), rng.normal(30, 1, 100)])
    df = spark.createDataFrame([(float(a),) for a in x], "m double")
    r = qc.auto_thresholds(df, ["m"], log_metrics=(), max_components=3).first()
    width = math.sqrt(2 * math.log(20))
    assert abs(r["low"] - (10 - width)) < 0.5 and abs(r["high"] - (10 + width)) < 0.5 and r["n_components"] >= 2
    assert qc.auto_thresholds(df.limit(0), ["m"], max_components=2).count() == 0


def test_threshold_inheritance():
    both = qc.merge_thresholds(["a"], {"a": (1.0, 9.0)}, {"a_max": 5.0})
    assert both == {"a": (1.0, 5.0)}
    assert qc.merge_thresholds(["a"], init_missing=True) == {"a": (None, None)}


def test_doublets_of_mixed_types_score_higher(spark):
    rng = np.random.default_rng(9)
    kinds = rng.integers(0, 2, 160)
    rate = np.where(np.arange(20)[None, :] // 10 == kinds[:, None], 6.0, 0.2)
    dense = rng.poisson(rate).astype(float)
    dense[:10] = rng.poisson(np.full((10, 20), 6.0))  # mixtures of both kinds
    x = spark.createDataFrame([(int(i), int(g), float(dense[i, g])) for i, g in zip(*np.nonzero(dense))], "cell_id long, gene_id long, value double")
    obs = spark.createDataFrame([(i, "b") for i in range(160)] + [(900 + i, "tiny") for i in range(3)], "cell_id long, batch string")
    var = spark.createDataFrame([(g,) for g in range(20)], "gene_id long")
    got = qc.doublet_scores(x, obs, var, "batch", n_top=20, n_comps=5).toPandas().sort_values("cell_id")
    s = got["doublet_score"].to_numpy()
    assert len(got) == 163 and (s[160:] == 0).all()
    assert s[:10].mean() > 2 * s[10:160].mean()


def test_doublets_of_a_batch_do_not_depend_on_the_others(spark):
    rng = np.random.default_rng(19)
    dense = rng.poisson(rng.gamma(1.0, 1.5, size=(2, 30)).repeat(110, axis=0)).astype(float)
    dense[110:] *= 5  # the other batch has other totals and other variable features
    x = spark.createDataFrame([(int(i), int(g), float(dense[i, g])) for i, g in zip(*np.nonzero(dense))], "cell_id long, gene_id long, value double")
    obs = spark.createDataFrame([(i, "p" if i < 110 else None) for i in range(220)], "cell_id long, batch string")
    var = spark.createDataFrame([(g,) for g in range(30)], "gene_id long")
    both = qc.doublet_scores(x, obs, var, "batch", n_top=12, n_comps=4).toPandas().set_index("cell_id")["doublet_score"]
    alone = qc.doublet_scores(x.filter("cell_id < 110"), obs.filter("cell_id < 110"), var, "batch", n_top=12, n_comps=4)
    alone = alone.toPandas().set_index("cell_id")["doublet_score"]
    assert len(both) == 220 and (both > 0).all() and np.allclose(both[alone.index], alone)


def test_transport_is_zero_for_equal_and_grows(spark):
    rows = []
    for s, shares in {"a": [4, 0], "b": [4, 0], "c": [0, 4]}.items():
        for t, n in enumerate(shares):
            for _ in range(n):
                rows.append((len(rows), s, f"t{t}", [float(t), 0.0]))
    emb = spark.createDataFrame(rows, "cell_id long, s string, t string, v array<double>")
    d = {(r["src"], r["dst"]): r["dist"] for r in sa.transport_distances(emb, "s", "t").collect()}
    assert d["a", "b"] < 0.01 and abs(d["a", "c"] - 1) < 0.01


def test_density_distance_orders_samples(spark):
    rng = np.random.default_rng(10)
    v = np.vstack([rng.normal(0, 1, (60, 2)), rng.normal(0, 1, (60, 2)), rng.normal(6, 1, (60, 2))])
    emb = embed(spark, v, s=["a"] * 60 + ["b"] * 60 + ["c"] * 60)
    d = {(r["src"], r["dst"]): r["dist"] for r in sa.density_distances(emb, "s", n_components=1, rounds=3).collect()}
    assert abs(d["a", "a"]) < 1e-9 and d["a", "b"] < 1 < d["a", "c"] and abs(d["a", "c"] - d["c", "a"]) < 1e-9


def test_mixture_fit_matches_moments(spark):
    rng = np.random.default_rng(11)
    v = rng.normal(2, 3, (200, 2))
    r = sa.fit_sample_mixtures(embed(spark, v, s=["a"] * 200), "s", 1, 2, ridge=0.0).first()
    assert np.allclose(r["mu"], v.mean(0)) and np.allclose(np.array(r["cov"]).reshape(2, 2), np.cov(v.T, ddof=0))


def test_labels_are_aligned_over_datasets(spark, blobs):
    v, label, batch = blobs
    emb = embed(spark, v, dataset=batch, label=[f"{x}_{b}" for x, b in zip(label, batch)])
    _, relation, _ = lb.align_labels(emb, "dataset", "label")
    names = {r["reannotation"] for r in relation.collect()}
    assert "l0_0 = l0_1" in names or "l1_0 = l1_1" in names or "l2_0 = l2_1" in names
    assert all("=" not in n or len({p[:2] for p in n.split(" = ")}) == 1 for n in names)


def test_prediction_recovers_planted_labels(spark, blobs):
    v, label, batch = blobs
    emb = embed(spark, v, label=label, batch=batch)
    predict = lb.train_label_model(emb.filter("batch = '0'"), "label")
    clusters = emb.select("cell_id", F.col("label").alias("cluster"))
    got = lb.predict_labels(emb, predict, clusters).join(emb, "cell_id").toPandas()
    assert (got["majority_voting"] == got["label"]).all() and got["conf_score"].between(0.3, 1).all()


def test_consensus_rules(spark):
    rows = [(1, "a", "a", "b"), (2, "a", "b", "c"), (3, None, None, "a"), (4, "b", "b", "b")]
    df = spark.createDataFrame(rows, "id int, v_1 string, v_2 string, v_3 string")
    got = {r["id"]: tuple(r)[4:] for r in lb.majority_consensus(df, ["v_.*"]).collect()}
    assert got[1] == ("a", 2 / 3, False) and got[2] == (None, 0.0, True) and got[3] == (None, 2 / 3, False) and got[4] == ("b", 1.0, False)


def test_batch_pcr_without_permutations(spark, blobs):
    v, label, batch = blobs
    emb = embed(spark, v, label=label, batch=batch)
    rows = qc.batch_pcr(emb, emb, "batch", "batch").toPandas()
    assert len(rows) == 2 and rows["pcr"].nunique() == 1
    seven = qc.batch_pcr(emb.withColumn("s", (F.col("cell_id") % 10).cast("string")), emb.withColumn("s", (F.col("cell_id") % 10).cast("string")), "label", "s", 7)
    assert seven.count() == 8


def test_mixtures_run_until_the_likelihood_stands_still(spark):
    from heddle.operators import samples as sa

    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 2)), rng.normal(size=(60, 2)) + 2.2])  # overlapping: convergence is slow
    emb = spark.createDataFrame([(k, 0, v.tolist()) for k, v in enumerate(x)], "cell_id long, s int, v array<double>")
    default = sa.fit_sample_mixtures(emb, "s", 2).first()

    def likelihood(m):
        return sa._total(sa._log_density(x, *sa._unpack(m, 2))).mean()

    mu, cov, w = np.asarray(default["mu"]).reshape(-1, 2), np.asarray(default["cov"]).reshape(-1, 2, 2), np.asarray(default["w"])
    r = sa._log_density(x, w, mu, cov)
    r = np.exp(r - sa._total(r)[:, None])
    n = r.sum(0)
    mu = r.T @ x / n[:, None]
    cov = np.stack([(r[:, c, None] * (x - mu[c])).T @ (x - mu[c]) / n[c] + 1e-4 * np.eye(2) for c in range(2)])
    again = sa._total(sa._log_density(x, n / n.sum(), mu, cov)).mean()
    assert abs(again - likelihood(default)) < 1e-3


def test_stress_majorisation_matches_its_numpy_twin(spark):
    rng = np.random.default_rng(23)
    d = np.sqrt(((rng.normal(size=(14, 5))[:, None] - rng.normal(size=(14, 5))[None]) ** 2).sum(-1))
    d = (d + d.T) / 2
    np.fill_diagonal(d, 0)
    z = rng.normal(size=(14, 2))
    z[1] = z[0]  # two samples on one point
    pairs = spark.createDataFrame([(i, j, float(d[i, j])) for i in range(14) for j in range(14)], "src long, dst long, dist double")
    start = spark.createDataFrame([(i, [float(a) for a in z[i]]) for i in range(14)], "src long, v array<double>")
    placed, stress = gr.stress_majorisation(pairs, start, max_rounds=2)
    for expected in stress:
        gap = np.sqrt(((z[:, None] - z[None]) ** 2).sum(-1))
        assert np.isclose(expected, ((d - gap) ** 2).sum() / 2)
        last, pull = z, np.divide(d, gap, out=np.zeros_like(d), where=gap > 0)
        z = (pull[:, :, None] * (z[:, None] - z[None])).sum(1) / 14
    assert all(b <= a for a, b in zip(stress, stress[1:])) and len(stress) == 3
    got = {r["src"]: r["v"] for r in placed.collect()}
    assert np.allclose([got[i] for i in range(14)], last)
    with pytest.raises(ValueError, match="ordered pairs"):
        gr.stress_majorisation(pairs.filter("src <> 3 AND dst <> 3"), start)
    none, history = gr.stress_majorisation(pairs.limit(0), start.limit(0))
    assert none.count() == 0 and history == []


def test_transport_is_certified_against_the_line():
    """On a line the optimum is the area between the two distribution functions."""
    from heddle.operators.transport import certified_transport

    rng = np.random.default_rng(29)
    place = np.sort(rng.random(9))
    cost = np.abs(place[:, None] - place[None]) / np.ptp(place)
    a, b = rng.dirichlet(np.full(9, 0.3), 60), rng.dirichlet(np.full(9, 0.3), 60)
    a[0], b[0], a[1], b[1], b[2] = np.eye(9)[0], np.eye(9)[8], a[3], a[3], np.eye(9)[4]
    exact = (np.abs(np.cumsum(a - b, axis=1))[:, :-1] * np.diff(place)).sum(1) / np.ptp(place)
    for tolerance in (1e-2, 1e-4):
        price, gap = certified_transport(a, b, cost, tolerance)
        assert (gap <= tolerance).all() and (price >= exact - 1e-9).all() and (price - exact <= gap + 1e-9).all()
    assert np.isclose(price[0], 1) and len(certified_transport(a[:0], b[:0], cost, 1e-3)[0]) == 0
