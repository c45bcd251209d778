"""Components of any width, paths along graphs and neighbour descent against plain versions."""

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.operators import components, descent, graph as gr, matrix as mx, neighbors, paths, qc, samples


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    m = (rng.random((150, 60)) < 0.25) * rng.normal(2, 1, (150, 60))
    m[:, :5] += np.outer(rng.normal(size=150), rng.normal(size=5)) * (m[:, :5] != 0)
    m[7], m[:, 11] = 0, 0  # a row and a feature without entries
    x = spark.createDataFrame([(i, j, float(m[i, j])) for i, j in np.argwhere(m).tolist()], "cell_id long, gene_id long, value double")
    obs = spark.createDataFrame([(i,) for i in range(150)], "cell_id long")
    var = spark.createDataFrame([(j,) for j in range(60)], "gene_id long")
    return m, x.repartition(3), obs, var


@pytest.mark.parametrize("scaled", [False, True])
def test_components_are_those_of_the_dense_matrix(table, monkeypatch, scaled):
    monkeypatch.setattr(components, "ENTRIES", 400)
    monkeypatch.setattr(components, "BLOCKS", 3)  # with restarts
    m, x, obs, var = table
    scores, loadings, variance = mx.matrix_pca(x, obs, var, 4, scaled=scaled, max_value=2.0, tolerance=1e-5)
    z = m.copy()
    if scaled:
        sd = z.std(0, ddof=1)
        sd[sd == 0] = 1
        z = np.clip((z - z.mean(0)) / sd, -2, 2)
    z = z - z.mean(0)
    values, vectors = np.linalg.eigh(z.T @ z)
    values, vectors = values[::-1], vectors[:, ::-1][:, :4]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(4)])
    got = np.array([r.v for r in loadings.orderBy("gene_id").collect()])
    assert np.abs(got - vectors).max() < 1e-3
    assert np.abs(np.array([r.v for r in scores.orderBy("cell_id").collect()]) - z @ got).max() < 1e-9
    rows = variance.orderBy("pc").collect()
    assert np.allclose([r.variance for r in rows], values[:4] / 149, rtol=1e-6)
    assert np.allclose([r.variance_ratio for r in rows], values[:4] / values.sum(), rtol=1e-6)


def test_components_without_directions(spark, table):
    _, x, obs, var = table
    scores, loadings, variance = mx.matrix_pca(x.limit(0), obs, var, 4)
    assert scores.count() == 150 and loadings.count() == 60 and variance.count() == 0
    one = spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0)], "cell_id long, gene_id long, value double")
    scores, loadings, variance = mx.matrix_pca(one, obs.filter("cell_id < 2"), var.filter("gene_id < 2"), 10)
    assert variance.count() == 1 and abs(variance.first().variance_ratio - 1) < 1e-9


def dijkstra(graph, start, reach):
    best, heap = {}, [(0.0, start)]
    while heap:
        d, at = heapq.heappop(heap)
        if at not in best:
            best[at] = d
            for to, w in graph.get(at, {}).items():
                heapq.heappush(heap, (d + w, to))
    best.pop(start)
    return sorted((round(d, 9), v) for v, d in best.items())[:reach]


def test_paths_are_those_of_a_heap(spark):
    rng = random.Random(1)
    edges = [(a, b, rng.uniform(0.1, 3)) for a in range(60) for b in rng.sample(range(60), 2) if a != b] + [(100, 101, 1.0), (5, 5, 0.1)]
    graph = {}
    for a, b, w in edges:
        if a != b:
            for s, t in ((a, b), (b, a)):
                graph.setdefault(s, {})[t] = min(w, graph.get(s, {}).get(t, 9e9))
    found = {}
    for r in paths.graph_neighbors(spark.createDataFrame(edges, "src long, dst long, dist double"), 12).collect():
        found.setdefault(r.src, []).append((round(r.dist, 9), r.dst))
    assert {s: sorted(v) for s, v in found.items()} == {s: dijkstra(graph, s, 12) for s in graph}


def test_descent_finds_most_neighbours(spark):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(12, 16)) * 4
    v = middle[rng.integers(0, 12, 700)] + rng.normal(size=(700, 16))
    v[650:] = v[:50]  # equal rows
    emb = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)], "cell_id long, v array<double>").repartition(4)
    found = descent.knn_descent(emb, 10)
    row = descent.recall(found, neighbors.knn(emb, 10), F.col("src") % 5 == 0).first()
    assert row.n_queries == 140 and row.recall >= 0.9
    got = found.collect()
    assert len(got) == 7000 and all(abs(r.dist - np.linalg.norm(v[r.src] - v[r.dst])) < 1e-9 and r.src != r.dst for r in got)
    assert descent.knn_descent(emb.limit(1), 3).count() == 0


def test_layouts_of_vectors_write_no_pairs(spark, monkeypatch):
    """Classical scaling and stress majorisation of vectors are those of their written distances, block by block."""
    rng = np.random.default_rng(31)
    v = rng.dirichlet(np.ones(4), 60)
    v[7] = v[3]  # two samples on one point
    rows = spark.createDataFrame([(i, [float(a) for a in v[i]]) for i in range(60)], "cell_id long, v array<double>")
    written = samples.distance_matrix(rows)
    start, start_of = gr.mds(written), lambda d: {r.src: r.v for r in d.collect()}
    placed, stress = gr.stress_majorisation(written, start, max_rounds=2)
    sizes, kept = [], gr.cut

    def counted(df, tag="stage"):
        out = kept(df, tag)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(gr, "cut", counted)
    pairs = neighbors.EuclideanPairs(rows)
    own = gr.mds(pairs)
    a, b = start_of(start), start_of(own)
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-7) for i in a)
    for block_rows in (17, 1000):
        moved, falls = gr.stress_majorisation(pairs, start, max_rounds=2, block_rows=block_rows)
        a, b = start_of(placed), start_of(moved)
        assert np.allclose(stress, falls) and a.keys() == b.keys() and all(np.allclose(a[i], b[i]) for i in a)
    assert max(sizes) <= 60
    with pytest.raises(ValueError, match="coordinates"):
        gr.stress_majorisation(pairs, start.filter("src <> 3"))
    none, history = gr.stress_majorisation(neighbors.EuclideanPairs(rows.limit(0)), gr.mds(neighbors.EuclideanPairs(rows.limit(0))))
    assert none.count() == 0 and history == []


def test_dense_rows_are_widened_by_spark(table):
    """Rows get their width after Python and are dealt to all partitions; they and their way back are the matrix."""
    m, x, obs, var = table
    index = mx.feature_index(var)
    dense = mx.to_vectors(x, obs, index, 60)
    plan = dense._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "REPARTITION_BY_NUM" in plan
    rows = {r.cell_id: r.v for r in dense.collect()}
    assert rows.keys() == set(range(150)) and all(np.array_equal(rows[i], m[i]) for i in rows)
    back = sorted((r.cell_id, r.gene_id, r.value) for r in mx.from_vectors(dense, index).collect())
    assert back == [(i, j, m[i, j]) for i, j in np.argwhere(m).tolist()]


def test_rows_find_their_pivots_in_slices(spark, monkeypatch):
    """However many pivots there are, a task holds a bounded number of distances to them."""
    v = np.random.default_rng(37).normal(size=(300, 4))
    emb = spark.createDataFrame([(i, [float(a) for a in v[i]]) for i in range(300)], "cell_id long, v array<double>")
    whole = neighbors.pivot_distances

    def bounded(vectors, pivots):
        assert len(vectors) * len(pivots) <= 64
        return whole(vectors, pivots)

    monkeypatch.setattr(neighbors, "ASSIGN_CELLS", 64, raising=False)
    monkeypatch.setattr(neighbors, "pivot_distances", bounded)
    got = {(r.src, r["rank"]): r.dst for r in neighbors.knn(emb, 3, direct_rows=0).collect()}
    dist = np.linalg.norm(v[:, None] - v[None], axis=2)
    np.fill_diagonal(dist, np.inf)
    want = np.argsort(dist, axis=1)[:, :3]
    assert got == {(i, k + 1): want[i, k] for i in range(300) for k in range(3)}


def test_doublet_scores_keep_lists_instead_of_pairs(spark, monkeypatch):
    """Neighbours are counted from the list of each row, with the scores that the written pairs give."""
    rng = np.random.default_rng(41)
    m = rng.poisson(np.where(np.arange(16) < 8, 6, 1) * np.ones((90, 1)))
    m[45:] = m[45:, ::-1]
    x = spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in np.argwhere(m)], "cell_id long, gene_id long, value double")
    # batches of two sizes have two numbers of neighbours; the third is too small
    obs = spark.createDataFrame([(i, "a" if i < 50 else "b" if i < 84 else "c") for i in range(90)], "cell_id long, batch string")
    var = spark.createDataFrame([(j,) for j in range(16)], "gene_id long")

    def pairs(*args, **kwargs):
        raise AssertionError("pairs of rows are made")

    def from_pairs(emb, k, same):
        near = F.array_sort(F.collect_list(F.struct("rank", "dst")))
        return neighbors.knn(emb, k, same=same).groupBy("src").agg(near.alias("near"))

    monkeypatch.setattr(qc, "knn", pairs)
    scores = lambda: {r.cell_id: tuple(r)[1:] for r in qc.doublet_scores(x, obs, var, "batch", min_cells=10, n_top=10, n_comps=3).collect()}
    got = scores()
    monkeypatch.setattr(qc, "nearest_lists", from_pairs)
    assert got == scores() and len({s for s, _ in got.values()}) > 2 and got[89] == (0.0, False)


def test_layout_is_the_same_by_joins_and_by_shared_coordinates(spark):
    """Both ways draw the same pairs; repeated and missing rows keep a place each."""
    rng = np.random.default_rng(43)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 40, (160, 2)) if a != b}
    edges = spark.createDataFrame(
        [(a, b, 0.2 + 0.8 * ((a * b) % 7) / 7) for a, b in sorted(pairs | {(b, a) for a, b in pairs})] + [(0, 99, 1.0), (1, 2, None)],
        "src long, dst long, weight double",
    )
    nodes = spark.createDataFrame([(i,) for i in range(40)] + [(3,), (None,)], "node long")
    found = [
        sorted((str(r.node), r.x, r.y) for r in gr.umap_layout(edges, nodes, n_epochs=3, shared_nodes=m).collect()) for m in (0, 100)
    ]
    assert len(found[0]) == 42 and [r[0] for r in found[0]] == [r[0] for r in found[1]]
    assert np.allclose([r[1:] for r in found[0]], [r[1:] for r in found[1]], atol=1e-9)


def test_drawn_numbers_are_those_of_spark(spark):
    rows = [(0, 5), (7, -1), (2**40, -(2**50))]
    got = spark.createDataFrame(rows, "a long, b long").select(gr._drawn_unit_column(3, F.col("a"), F.col("b")).alias("u")).collect()
    a, b = np.array(rows).T
    assert [r.u for r in got] == gr._drawn_unit(3, a, b).tolist()


def test_layout_query_runs_all_epochs(spark, sf, monkeypatch):
    """The registered layout leaves the number of epochs to the operator."""
    import __spark_entry__ as entry

    asked = {}

    def layout(edges, nodes, **args):
        asked.update(args)
        return nodes.select("node", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    monkeypatch.setattr(gr, "umap_layout", layout)
    entry.queries()["g10_umap_layout"](spark, sf)
    assert "n_epochs" not in asked


def test_prepared_graph_reaches_the_result(spark, sf, monkeypatch):
    """The query of the prepared table depends on the graph that the corrected matrix is given."""
    import __spark_entry__ as entry
    from heddle.plans import evaluate
    from heddle.sources.table import AnnotatedTable

    kinds, before = [], spark.createDataFrame([(1, [0.5]), (2, [1.5])], "cell_id long, v array<double>")
    edges = spark.createDataFrame([(1, 2, 3.0), (1, 3, 4.0)], "src long, dst long, dist double")

    def prepare(corrected, unintegrated, output_type, *args):
        kinds.append(output_type)
        return AnnotatedTable({"obsp/distances": edges, "obsp/connectivities": edges.withColumnRenamed("dist", "weight")}), before

    monkeypatch.setattr(evaluate, "prepare", prepare)
    got = {r.cell_id: tuple(r)[1:] for r in entry.queries()["x24_prepare_full"](spark, sf).collect()}
    assert kinds == ["full"] and got == {1: ([0.5], 2, 7.0, 7.0), 2: ([1.5], None, None, None)}


def test_mixtures_send_a_model_to_slices_of_a_sample(spark, monkeypatch):
    """A round joins the model of a sample to its slices, not to its rows, and fits what single rows fit."""
    rng = np.random.default_rng(47)
    v = np.concatenate([rng.normal(0, 1, (90, 3)), rng.normal(4, 1, (60, 3))])
    rows = [(i, "a" if i % 3 else "b", [float(a) for a in v[i]]) for i in range(150)]
    emb = spark.createDataFrame(rows + [(150, None, [0.0, 0.0, 0.0])], "cell_id long, sample string, v array<double>").coalesce(1)
    joined, whole = [], samples.join_keys

    def counted(left, right, keys, *args):
        joined.append(left.count())
        return whole(left, right, keys, *args)

    monkeypatch.setattr(samples, "join_keys", counted)
    fits = []
    for most in (1, 40):
        monkeypatch.setattr(samples, "SLICE_ROWS", most, raising=False)
        joined.clear()
        fits.append({r["sample"]: np.concatenate([r["w"], r["mu"], r["cov"]]) for r in samples.fit_sample_mixtures(emb, "sample", 2).collect()})
        assert len(joined) > 2 and set(joined) == {150 if most == 1 else 5}
    assert set(fits[0]) == {"a", "b"} and all(np.allclose(fits[0][k], fits[1][k]) for k in fits[0])


def test_pairs_of_kept_samples_alone_are_made(spark, monkeypatch):
    """Samples are dropped before their pairs are made, with the rows that dropping pairs leaves."""
    events = spark.createDataFrame([(u, "abc"[(u * k) % 3]) for u in range(9) for k in range(4)] + [(None, "a"), (3, None)], "u long, t string")
    kept = events.filter("u % 3 = 0")
    rows = lambda d: sorted((r.src, r.dst, round(r.dist, 9)) for r in d.collect())
    want = rows(samples.keep_samples(samples.composition_distances(events, "u", "t"), kept, "u"))
    made, whole = [], samples.pairwise_blocks

    def counted(left, *args, **kwargs):
        made.append(left.count())
        return whole(left, *args, **kwargs)

    monkeypatch.setattr(samples, "pairwise_blocks", counted)
    got = samples.keep_samples(samples.composition_distances(events, "u", "t", written=False), kept, "u")
    assert rows(got) == want and len(want) == 9 and made == [3]


def test_vote_query_runs_all_rounds(spark, sf, monkeypatch):
    """The registered votes leave the number of rounds to the operator."""
    import __spark_entry__ as entry

    asked = {}

    def votes(x, obs, var, batch, **args):
        asked.update(args)
        return obs.select("cell_id", F.lit(0.0).alias("doublet_score"), F.lit(False).alias("predicted_doublet"))

    monkeypatch.setattr(qc, "doublet_votes", votes)
    entry.queries()["q7_doublet_votes"](spark, sf)
    assert "n_rounds" not in asked
