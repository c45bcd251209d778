"""Communities refined on every level, against quantities computed in NumPy."""

import numpy as np
import pytest

from heddle.operators import communities as cm, graph as gr

SCHEMA = "src long, dst long, weight double"


def planted(seed, sizes, inside, across):
    rng = np.random.default_rng(seed)
    kind = np.repeat(np.arange(len(sizes)), sizes)
    n = len(kind)
    p = np.where(kind[:, None] == kind[None], inside, across)
    w = np.triu((rng.random((n, n)) < p) * rng.uniform(0.5, 1.0, (n, n)), 1)
    return w + w.T, kind


def frame(spark, w):
    return spark.createDataFrame([(int(i), int(j), float(w[i, j])) for i, j in zip(*np.nonzero(w))], SCHEMA)


def modularity(w, comm, gamma):
    k, m2 = w.sum(1), w.sum()
    same = comm[:, None] == comm[None]
    return (w[same].sum() - gamma * np.outer(k, k)[same].sum() / m2) / m2


def best_move(w, comm, gamma):
    before, most = modularity(w, comm, gamma), 0.0
    for i in np.nonzero(w.sum(1))[0]:
        for to in [*np.unique(comm), -1]:
            other = comm.copy()
            other[i] = to
            most = max(most, modularity(w, other, gamma) - before)
    return most


def is_connected(w, members):
    seen, todo = {members[0]}, [members[0]]
    while todo:
        i = todo.pop()
        for j in members:
            if j not in seen and w[i, j] > 0:
                seen.add(j)
                todo.append(j)
    return len(seen) == len(members)


def test_communities_are_connected_and_settled(spark):
    w, kind = planted(2, [14, 12, 10, 8], 0.55, 0.06)
    found = cm.leiden(frame(spark, w), [0.5, 1.0]).toPandas()
    for gamma, rows in found.groupby("resolution"):
        rows = rows.sort_values("node")
        assert list(rows["node"]) == list(np.nonzero(w.sum(1))[0])
        comm = rows["cluster"].astype(int).to_numpy()
        assert best_move(w, comm, gamma) < 1e-9
        assert all(is_connected(w, list(np.nonzero(comm == c)[0])) for c in np.unique(comm))
        sizes = np.bincount(comm)
        assert (np.diff(sizes) <= 0).all()
        assert modularity(w, comm, gamma) >= modularity(w, kind, gamma) - 1e-9


def test_runs_are_clustered_apart_and_empty_graphs_work(spark):
    from pyspark.sql import functions as F

    w, _ = planted(4, [8, 8], 0.8, 0.03)
    v, _ = planted(5, [9, 6, 5], 0.8, 0.03)
    both = frame(spark, w).withColumn("sample", F.lit("a")).unionByName(frame(spark, v).withColumn("sample", F.lit("b")))
    got = cm.leiden(both, [1.0], run=["sample"]).toPandas()
    for name, matrix in (("a", w), ("b", v)):
        mine = got[got["sample"] == name].sort_values("node")["cluster"].to_numpy()
        assert best_move(matrix, mine.astype(int), 1.0) < 1e-9
        assert len(mine) == (matrix.sum(1) > 0).sum() and len(set(mine)) > 1
    assert cm.leiden(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("gamma", [0.4, 1.0])
def test_gains_of_single_moves(spark, gamma):
    w, _ = planted(7, [7, 6], 0.6, 0.2)
    comm = np.random.default_rng(1).integers(0, 3, len(w))
    base = cm.resolved(frame(spark, w), [gamma])
    state = cm.start_state(base).drop("comm").join(
        spark.createDataFrame([(i, f"c{c}") for i, c in enumerate(comm)], "node long, comm string"), "node"
    )
    before, m2 = modularity(w, comm, gamma), w.sum()
    got = cm.move_gains(base, state, ["resolution"]).toPandas()
    assert len(got) > len(w)
    for r in got.itertuples():
        other = comm.copy()
        other[r.node] = -1 if r.to is None or r.to != r.to else int(r.to[1:])
        assert abs(2 * r.rise / m2 - (modularity(w, other, gamma) - before)) < 1e-9


def two_run_graph(spark):
    """Planted groups in runs ``a`` and ``b``, ids that sort otherwise as text, an edge to a node without edges of its own."""
    rng, edges = np.random.default_rng(3), []
    for run, n, groups in (("a", 60, 4), ("b", 33, 3)):
        own = rng.integers(0, groups, n)
        for i in range(n):
            for j in range(i):
                if rng.random() < (0.5 if own[i] == own[j] else 0.06):
                    w = float(rng.random() + 0.1)
                    edges += [(run, f"n{i}", f"n{j}", w), (run, f"n{j}", f"n{i}", w)]
        edges.append((run, "n1", "outside", 0.3))
    edges.append((None, "n1", "n2", 1.0))
    return spark.createDataFrame(edges, "part string, src string, dst string, weight double")


def test_runs_clustered_in_tasks_equal_the_joins(spark, monkeypatch):
    edges = two_run_graph(spark)
    rows = lambda: sorted(map(tuple, gr.cluster(edges, [0.5, 1.5], "louvain", run=["part"]).collect()))
    joins, by_joins = gr._cluster_by_joins, []
    monkeypatch.setattr(gr, "_cluster_by_joins", lambda *a: by_joins.append(1) or joins(*a))
    in_tasks = rows()
    assert not by_joins and len(in_tasks) == 2 * (60 + 33)
    monkeypatch.setattr(gr, "TASK_EDGES", 10)  # every run is too large for a task
    assert rows() == in_tasks and by_joins
    monkeypatch.setattr(gr, "TASK_EDGES", 3 << 19)
    monkeypatch.setattr(gr, "COINS", 2)  # the coins do not reach
    assert rows() == in_tasks and len(by_joins) == 2
