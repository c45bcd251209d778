"""Relations of labels across datasets."""

import numpy as np
import pytest

from heddle.operators import relations as rl

CENTRES = {"CD4": (0, 0), "CD8": (3, 0), "B": (20, 0), "Mono": (0, 20), "NK": (40, 40)}
KINDS = {  # what each dataset calls the kinds it holds
    "d1": {"CD4": "T", "CD8": "T", "B": "B", "NK": "NK"},
    "d2": {"CD4": "T4", "CD8": "T8", "B": "B cell"},
    "d3": {"CD4": "T", "CD8": "T", "B": "B", "Mono": "Mono"},
}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    rows, truth = [], {}
    for dataset, kinds in KINDS.items():
        for kind, label in kinds.items():
            for _ in range(40):
                i = len(rows)
                v = rng.normal(CENTRES[kind], 0.3)
                rows.append((i, dataset, label, [float(x) for x in v]))
                truth[i] = (dataset, kind, label)
    rows += [(-1, None, "T", [0.0, 0.0]), (-2, "d1", None, [0.0, 0.0]), (-3, "d1", "T", None)]
    emb = spark.createDataFrame(rows, "cell_id long, dataset string, label string, v array<double>")
    return emb, truth


def test_one_to_many_labels_are_found(planted):
    emb, truth = planted
    rows, groups, steps = (f.toPandas() for f in rl.harmonise_labels(emb, "dataset", "label", ["d1", "d2", "d3"]))
    expected = {
        "CD4": "T ∋ T4 ∈ T", "CD8": "T ∋ T8 ∈ T", "B": "B = B cell = B", "NK": "NK", "Mono": "Mono",
    }
    assert len(rows) == len(truth)
    got = rows.set_index("cell_id")["reannotation"]
    assert all(got[i] == expected[kind] for i, (_, kind, _) in truth.items())
    assert set(rows["reannotation_index"]) == set(range(5))
    # the two kinds of T cells are one group of related labels, the others one each
    per = groups.groupby("reannotation")["group"].first()
    assert per["T ∋ T4 ∈ T"] == per["T ∋ T8 ∈ T"] and per.nunique() == 4
    b = groups[groups["reannotation"] == "B = B cell = B"].sort_values("step")
    assert list(b["dataset"]) == ["d1", "d2", "d3"] and list(b["symbol"].fillna("")) == ["", "=", "="]
    assert sorted(steps[steps["step"] == 1]["symbol"]) == ["=", "∋", "∋"]
    assert sorted(steps[steps["step"] == 2]["symbol"]) == ["=", "∈", "∈"]


def test_larger_datasets_come_first_and_empty_tables_work(spark, planted):
    emb, _ = planted
    _, groups, _ = rl.harmonise_labels(emb.filter("dataset <> 'd2'"), "dataset", "label")
    first = groups.filter("step = 0").select("dataset").distinct().collect()
    assert [r[0] for r in first] == ["d1"]
    none = rl.harmonise_labels(emb.filter("false"), "dataset", "label")
    assert [f.count() for f in none] == [0, 0, 0]


def cover_one_by_one(edges):
    left = set(edges)
    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        if sum(e[0] == a for e in left) > 1 and sum(e[1] == b for e in left) > 1:
            left.remove((a, b, w))
    return left


@pytest.mark.parametrize("seed", range(3))
def test_the_cover_is_that_of_one_edge_at_a_time(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(f"a{i}", f"b{j}", float(rng.integers(1, 6))) for i in range(9) for j in range(8) if rng.random() < 0.35]
    got = rl.star_cover(spark.createDataFrame(edges, "a string, b string, weight double")).toPandas()
    assert {(r.a, r.b, r.weight) for r in got.itertuples()} == cover_one_by_one(edges)
    assert not ((got["_na"] > 1) & (got["_nb"] > 1)).any()
    assert set(got["a"]) == {e[0] for e in edges} and set(got["b"]) == {e[1] for e in edges}


@pytest.mark.parametrize("block", [2, 256])
def test_relations_match_a_twin(spark, monkeypatch, block):
    monkeypatch.setattr(rl, "BLOCK", block)
    rng = np.random.default_rng(5)
    sides = []
    for prefix, n in (("p", 5), ("q", 4)):
        label = rng.integers(0, n, 200)
        centres = rng.normal(size=(n, 3)) * 2
        sides.append(([f"{prefix}{x}" for x in label], centres[label] + rng.normal(size=(200, 3))))
    frames = [
        spark.createDataFrame([(x, [float(y) for y in v]) for x, v in zip(labels, vs)], "label string, v array<double>")
        for labels, vs in sides
    ]
    got = rl.relate(*frames).toPandas()

    def shares(at, to):
        names = sorted(set(to[0]))
        means = np.array([to[1][np.array(to[0]) == n].mean(0) for n in names])
        near = [names[i] for i in ((at[1][:, None] - means[None]) ** 2).sum(-1).argmin(1)]
        return {(x, n): np.mean([near[i] == n for i in range(200) if at[0][i] == x]) for x in set(at[0]) for n in names}

    forward, backward = shares(*sides), shares(*sides[::-1])
    edges = [
        (a, b, f + backward[b, a]) for (a, b), f in forward.items()
        if f > 0 and backward[b, a] > 0 and max(f, backward[b, a]) >= 0.4 and min(f, backward[b, a]) > 0.05
    ]
    kept = cover_one_by_one(edges)
    assert {(r.a, r.b) for r in got.itertuples()} == {(a, b) for a, b, _ in kept}
    for r in got.itertuples():
        assert np.isclose(r.forward, forward[r.a, r.b]) and np.isclose(r.backward, backward[r.b, r.a])
        many_a, many_b = (got["a"] == r.a).sum() > 1, (got["b"] == r.b).sum() > 1
        assert r.symbol == ("∋" if many_a else "∈" if many_b else "=")
