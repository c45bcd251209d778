"""Neighbour graphs, connected components, clustering and layouts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from heddle.functions.ordering import hash_normal, hash_unit, running_index
from heddle.functions.runtime import cut, quoted
from heddle.operators.neighbors import EuclideanPairs, block_distances, each_pair_once, knn
from heddle.sources.table import AnnotatedTable

#: Rows and bytes of a block whose pairs pull at each other in a task, and pairs at a time.
PULL_ROWS = 16384
PULL_BYTES = 64 << 20
PULL_CELLS = 1 << 17
#: Most edges of a run that one task clusters, and the rounds whose coins a node brings along.
TASK_EDGES = 3 << 19
COINS = 62
#: Most rows whose coordinates the driver keeps and every task of a layout is given.
SHARED_NODES = 1 << 22


def neighbors(emb: DataFrame, n_neighbors: int = 15, same: str | None = None) -> DataFrame:
    """Neighbour graph where the row itself counts as one of the neighbours."""
    return knn(emb, n_neighbors - 1, same=same)


def kernel_widths(n_neighbors: int):
    """Membership strengths of sorted neighbour distances, solved for a batch of rows at once.

    The second argument is the mean distance of the whole graph, the same on all rows.
    """
    target = np.log2(n_neighbors)

    @F.pandas_udf("array<double>")
    def strengths(distances: pd.Series, means: pd.Series) -> pd.Series:
        if len(distances) == 0:
            return pd.Series([], dtype=object)
        width = max(len(d) for d in distances)
        d = np.full((len(distances), max(width, 1)), np.inf)
        for i, row in enumerate(distances):
            d[i, : len(row)] = row
        positive = np.where(d > 0, d, np.inf)
        rho = positive.min(axis=1)
        rho[~np.isfinite(rho)] = 0.0
        gap = np.maximum(d - rho[:, None], 0.0)
        lo, hi, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        for _ in range(64):
            total = np.exp(-gap / mid[:, None]).sum(axis=1)
            high = total > target
            hi = np.where(high, mid, hi)
            lo = np.where(high, lo, mid)
            mid = np.where(np.isinf(hi), mid * 2, (lo + hi) / 2)
        present = np.isfinite(d)
        mean_all = means.to_numpy()
        mean_row = np.where(present, d, 0).sum(axis=1) / np.maximum(present.sum(axis=1), 1)
        floor = 1e-3 * np.where(rho > 0, mean_row, mean_all)
        mid = np.maximum(mid, np.maximum(floor, 1e-12))
        w = np.exp(-gap / mid[:, None])
        return pd.Series([w[i, : len(row)].tolist() for i, row in enumerate(distances)])

    return strengths


def connectivities(edges: DataFrame, n_neighbors: int = 15) -> DataFrame:
    """Fuzzy union of directed membership strengths: symmetric ``src, dst, weight``."""
    lists = edges.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("dist", "dst"))).alias("e"))
    strengths = kernel_widths(n_neighbors)
    mean = F.coalesce(edges.agg(F.avg("dist")).scalar(), F.lit(0.0))
    directed = lists.select(
        "src", F.explode(F.arrays_zip(F.col("e")["dst"].alias("dst"), strengths(F.col("e")["dist"], mean).alias("w"))).alias("z")
    ).select("src", F.col("z")["dst"].alias("dst"), F.col("z")["w"].alias("w"))
    both = directed.unionByName(directed.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("src", "dst").agg(
        (F.sum("w") - F.when(F.count(F.lit(1)) > 1, F.max("w") * F.min("w")).otherwise(0.0)).alias("weight")
    )


def neighbor_counts(edges: DataFrame) -> DataFrame:
    """How many rows have how many neighbours; a valid graph has one line."""
    per_row = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n_neighbors"))
    return per_row.groupBy("n_neighbors").agg(F.count(F.lit(1)).alias("n_cells"))


def check_graph(table: AnnotatedTable, required: Sequence[str] = ("obsp/distances", "obsp/connectivities")) -> None:
    missing = [s for s in required if s not in table]
    if missing:
        raise ValueError(f"missing graph slots: {missing}")
    if len(neighbor_counts(table["obsp/distances"]).take(2)) != 1:
        raise ValueError("rows have different numbers of neighbours")


def select_neighbors(table: AnnotatedTable, output_type: str = "knn", key: str | None = None) -> AnnotatedTable:
    """Put the graph of a key (by default of the output type) into the standard slots."""
    prefix = key if key is not None else f"neighbors_{output_type}"
    out = table
    for kind in ("distances", "connectivities"):
        for name in (f"obsp/{prefix}_{kind}", f"obsp/{kind}"):
            if name in table:
                out = out.with_slot(f"obsp/{kind}", table[name])
                break
        else:
            raise KeyError(f"no {kind} for {prefix}")
    return out


def connected_components(edges: DataFrame, nodes: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Smallest node id reachable from each node (per run key).

    Every round takes the smallest label of the neighbours and then follows the
    label of the label, so long chains shrink quickly.  It ends when no label moves.
    """
    run = list(run)
    edges = edges.select(*run, "src", "dst")
    both = cut(edges.unionByName(edges.select(*run, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    labels = cut(nodes.select(*run, "node", F.col("node").alias("component")), "labels")
    while True:
        near = labels.withColumnsRenamed({"node": "dst", "component": "_c"})
        least = both.join(near, [*run, "dst"]).groupBy(*run, "src").agg(F.min("_c").alias("_c"))
        pulled = labels.join(least.withColumnRenamed("src", "node"), [*run, "node"], "left").select(
            *run, "node", F.col("component").alias("_old"), F.least("component", F.coalesce("_c", "component")).alias("_new")
        )
        jump = labels.select(*run, F.col("node").alias("_new"), F.col("component").alias("_far"))
        seen = Observation()
        stepped = pulled.join(jump, [*run, "_new"], "left").select(
            *run, "node", F.least("_new", "_far").alias("component"), (F.least("_new", "_far") != F.col("_old")).alias("_moved")
        )
        labels = cut(stepped.observe(seen, F.bool_or("_moved").alias("moved")).drop("_moved"), "labels")
        if not seen.get["moved"]:
            return labels


def _is_head_after(step: Column, run: Sequence[str], comm: str) -> Column:
    return F.pmod(F.xxhash64(step, *[quoted(k) for k in run], quoted(comm)), F.lit(2)) == 1


def _is_head(step: str, run: Sequence[str], comm: str) -> Column:
    """Coin of a community in this round: heads stay and receive, tails may move."""
    return _is_head_after(F.lit(step), run, comm)


def merge_round(edges: DataFrame, totals: DataFrame, run: Sequence[str], step: int) -> tuple[DataFrame, bool]:
    """Where each community goes in one round of greedy merging.

    ``edges``: symmetric weights between communities; ``totals``: ``comm, k, gamma,
    m2``.  A tail joins the head with the largest modularity gain when that gain is
    at least half of its best one.  Heads do not move, so no chains arise.
    """
    src = totals.select(*run, F.col("comm").alias("src"), F.col("k").alias("_ks"), "gamma", "m2")
    dst = totals.select(*run, F.col("comm").alias("dst"), F.col("k").alias("_kd"))
    gain = F.col("w") - F.col("gamma") * F.col("_ks") * F.col("_kd") / F.col("m2")
    options = edges.join(src, [*run, "src"]).join(dst, [*run, "dst"]).withColumn("_gain", gain)
    options = options.filter("_gain > 1e-9")
    best = options.groupBy(*run, F.col("src").alias("comm")).agg(
        F.max("_gain").alias("_top"),
        F.min(F.when(_is_head(f"m{step}", run, "dst"), F.struct((-F.col("_gain")).alias("g"), F.col("dst").alias("c")))).alias("_go"),
    )
    goes = ~_is_head(f"m{step}", run, "comm") & (-F.col("_go")["g"] >= 0.5 * F.col("_top"))
    seen = Observation()
    placed = totals.join(best, [*run, "comm"], "left").select(
        *run, "comm", "k", "gamma", "m2",
        F.when(F.coalesce(goes, F.lit(False)), F.col("_go")["c"]).otherwise(F.col("comm")).alias("to"),
        F.col("_top").isNotNull().alias("_open"),
    ).observe(seen, F.bool_or("_open").alias("open"))
    written = cut(placed, "merge").drop("_open")
    return written, bool(seen.get["open"])


def refine_rounds(edges: DataFrame, state: DataFrame, run: Sequence[str], tolerance: float) -> DataFrame:
    """Single rows move from tail to head communities while modularity rises.

    The best state seen is returned, so a round can never make the result worse.  Two
    rounds without a gain end the search.
    """
    best_state, best_quality, stalled = state, -np.inf, 0
    for step in count():
        totals = state.groupBy(*run, F.col("comm").alias("_to")).agg(F.sum("k").alias("_tot"))
        near = edges.join(state.select(*run, F.col("node").alias("dst"), F.col("comm").alias("_to")), [*run, "dst"])
        own_row = state.select(*run, "node", F.col("comm").alias("_to"), F.lit(0.0).alias("w"))
        links = near.select(*run, F.col("src").alias("node"), "_to", "w").unionByName(own_row).groupBy(
            *run, "node", "_to"
        ).agg(F.sum("w").alias("_in"))
        stays = F.col("_to") == F.col("comm")
        own = F.when(stays, F.col("k")).otherwise(0.0)
        gain = F.col("_in") - F.col("gamma") * F.col("k") * (F.col("_tot") - own) / F.col("m2")
        share = F.col("_in") / F.col("m2") - F.col("gamma") * F.col("k") * F.col("_tot") / (F.col("m2") * F.col("m2"))
        options = links.join(state, [*run, "node"]).join(totals, [*run, "_to"]).withColumn("_gain", gain)
        allowed = _is_head(f"r{step}", run, "_to") & ~_is_head(f"r{step}", run, "comm")
        best = options.groupBy(*run, "node").agg(
            *[F.max(c).alias(c) for c in ("k", "gamma", "m2")], F.max("comm").alias("_was"),
            F.max(F.when(stays, F.col("_gain"))).alias("_stay"),
            F.max(F.when(stays, share)).alias("_part"),
            F.min(F.when(allowed, F.struct((-F.col("_gain")).alias("g"), F.col("_to").alias("c")))).alias("_go"),
        )
        moved = F.coalesce(-F.col("_go")["g"] > F.col("_stay") + 1e-9, F.lit(False))
        # The parts add up to the modularity of the state before this round.
        seen = Observation()
        written = cut(
            best.observe(seen, F.sum("_part").alias("q")).select(
                *run, "node", "k", "gamma", "m2", F.when(moved, F.col("_go")["c"]).otherwise(F.col("_was")).alias("comm")
            ),
            "moves",
        )
        quality = seen.get["q"]
        if quality is None:
            return state
        stalled = stalled + 1 if quality < best_quality + tolerance else 0
        if quality > best_quality:
            best_state, best_quality = state, quality
        if stalled == 2:
            break
        state = written
    return best_state


def _settled(qualities: Sequence[float], tolerance: float) -> int | None:
    """The round before which the best state stood, None while the search of ``refine_rounds`` goes on."""
    best, at, stalled = -np.inf, 0, 0
    for step, quality in enumerate(qualities):
        stalled = stalled + 1 if quality < best + tolerance else 0
        if quality > best:
            best, at = quality, step
        if stalled == 2:
            return at
    return None


def _first_of(group: np.ndarray, gain: np.ndarray, to: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest gain of each of ``n`` groups and where it leads, ties to the smaller place; -inf without any."""
    best, place = np.full(n, -np.inf), np.zeros(n, dtype=np.int64)
    order = np.lexsort((to, -gain, group))
    first = order[np.flatnonzero(np.diff(group[order], prepend=-1))]
    best[group[first]], place[group[first]] = gain[first], to[first]
    return best, place


class RunGraph:
    """The graph of one run by places in the order of its nodes, for the rounds of ``cluster``."""

    def __init__(self, edges: pa.Table, nodes: pa.Table, n_coins: int):
        self.nodes, self.n_coins = nodes.sort_by("node"), n_coins
        ids = self.nodes["node"].combine_chunks()
        src, dst = (pc.fill_null(pc.index_in(edges[c], value_set=ids), -1).to_numpy().astype(np.int64) for c in ("src", "dst"))
        known = (src >= 0) & (dst >= 0)
        self.src, self.dst, self.w = src[known], dst[known], edges["w"].to_numpy()[known]
        self.k, self.merge_coins, self.move_coins = (self.nodes[c].to_numpy() for c in ("k", "_m", "_r"))
        self.gamma, self.m2 = self.nodes["gamma"][0].as_py(), self.nodes["m2"][0].as_py()

    def heads(self, coins: np.ndarray, step: int) -> np.ndarray:
        return (coins >> (self.n_coins - 1 - step)) & 1 == 1

    def merged(self) -> np.ndarray | None:
        """Communities after the rounds of ``merge_round``; None if they need more coins."""
        n, src, dst, w, k = len(self.k), self.src, self.dst, self.w, self.k
        comm = np.arange(n)
        for step in range(self.n_coins):
            gain = w - self.gamma * k[src] * k[dst] / self.m2
            gains = gain > 1e-9
            if not gains.any():
                return comm
            a, b, gain, head = src[gains], dst[gains], gain[gains], self.heads(self.merge_coins, step)
            top, _ = _first_of(a, gain, b, n)
            go, place = _first_of(a[head[b]], gain[head[b]], b[head[b]], n)
            to = np.where(~head & np.isfinite(go) & (go >= 0.5 * top), place, np.arange(n))
            comm, k = to[comm], np.bincount(to, weights=k, minlength=n)
            src, dst = to[src], to[dst]
            apart = src != dst
            pairs, at = np.unique(src[apart] * n + dst[apart], return_inverse=True)
            src, dst, w = pairs // n, pairs % n, np.bincount(at, weights=w[apart], minlength=len(pairs))
        return None

    def moved(self, comm: np.ndarray, step: int) -> tuple[np.ndarray, float]:
        """Communities after a round of ``refine_rounds``, and the modularity before it."""
        n, own = len(self.k), np.arange(len(self.k))
        total = np.bincount(comm, weights=self.k, minlength=n)
        links, at = np.unique(np.concatenate([self.src * n + comm[self.dst], own * n + comm]), return_inverse=True)
        inside = np.bincount(at, weights=np.concatenate([self.w, np.zeros(n)]))
        node, to = links // n, links % n
        k, stays = self.k[node], to == comm[node]
        gain = inside - self.gamma * k * (total[to] - np.where(stays, k, 0.0)) / self.m2
        part = inside[stays] / self.m2 - self.gamma * self.k * total[comm] / (self.m2 * self.m2)
        head = self.heads(self.move_coins, step)
        allowed = head[to] & ~head[comm[node]]
        go, place = _first_of(node[allowed], gain[allowed], to[allowed], n)
        return np.where(go > gain[stays] + 1e-9, place, comm), float(part.sum())


def cluster_runs(edges: DataFrame, nodes: DataFrame, run: Sequence[str], tolerance: float) -> DataFrame | None:
    """Merges and moves of ``cluster`` with every run in a task of its own: ``run..., node, comm``.

    The rounds, coins and the common end of all runs are those of ``merge_round`` and
    ``refine_rounds``: a first pass gives the modularity of every run before every round,
    whose sums name the best round, and a second pass gives the communities there.  None if
    the coins do not reach.
    """
    run, n_coins = list(run), COINS

    def coins(step: str) -> Column:
        flip = lambda a, s: a * 2 + _is_head_after(F.concat(F.lit(step), s.cast("string")), run, "node").cast("long")
        return F.aggregate(F.sequence(F.lit(0), F.lit(n_coins - 1)), F.lit(0).cast("long"), flip)

    ids = cut(nodes.select(*run, "node", "k", "gamma", "m2", coins("m").alias("_m"), coins("r").alias("_r")), "coins")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # kept, however few bytes the runs have
    dealt = [d.repartition(parts, *run).groupBy(*run) for d in (edges.select(*run, "src", "dst", "w"), ids)]
    both = dealt[0].cogroup(dealt[1])

    def trace(rounds: int):
        def call(own: pa.Table, members: pa.Table) -> pa.Table:
            lines = []
            if own.num_rows and members.num_rows:
                graph, line = RunGraph(own, members, n_coins), []
                comm = graph.merged()
                for step in range(rounds if comm is not None else 0):
                    comm, quality = graph.moved(comm, step)
                    line.append(quality)
                lines.append(line)
            return pa.table({"q": pa.array(lines, pa.list_(pa.float64()))})

        return call

    best = None
    for rounds in (n_coins // 2, n_coins):
        lines = cut(both.applyInArrow(trace(rounds), "q array<double>"), "trace")
        sums = lines.select(F.posexplode("q").alias("at", "q")).groupBy("at").agg(F.sum("q").alias("q")).orderBy("at").collect()
        if lines.filter(F.size("q") == 0).limit(1).count():
            return None
        best = _settled([r["q"] for r in sums], tolerance)
        if best is not None:
            break
    if best is None:
        return None
    names = [*run, "node"]
    schema = ids.select(*names, F.col("node").alias("comm")).schema

    def state(own: pa.Table, members: pa.Table) -> pa.Table:
        found = members.select(names).append_column("comm", members["node"])
        if not (own.num_rows and members.num_rows):
            return found.slice(0, 0)
        graph = RunGraph(own, members, n_coins)
        comm = graph.merged()
        for step in range(best):
            comm, _ = graph.moved(comm, step)
        return graph.nodes.select(names).append_column("comm", graph.nodes["node"].take(pa.array(comm)))

    return cut(both.applyInArrow(state, schema), "moves")


def _cluster_by_joins(base: DataFrame, nodes: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Merges and moves of ``cluster`` as joins over all runs, however large one is."""
    found = nodes.withColumn("comm", F.col("node"))
    level, totals = base, nodes.withColumnRenamed("node", "comm")
    for step in count():
        placed, is_open = merge_round(level, totals, keys, step)
        if not is_open:
            break
        found = found.join(placed.select(*keys, "comm", "to"), [*keys, "comm"]).drop("comm").withColumnRenamed("to", "comm")
        totals = placed.groupBy(*keys, F.col("to").alias("comm")).agg(
            F.sum("k").alias("k"), F.max("gamma").alias("gamma"), F.max("m2").alias("m2")
        )
        src = placed.select(*keys, F.col("comm").alias("src"), F.col("to").alias("_s"))
        dst = placed.select(*keys, F.col("comm").alias("dst"), F.col("to").alias("_d"))
        level = cut(
            level.join(src, [*keys, "src"]).join(dst, [*keys, "dst"]).filter(F.col("_s") != F.col("_d"))
            .groupBy(*keys, F.col("_s").alias("src"), F.col("_d").alias("dst")).agg(F.sum("w").alias("w")),
            "graph",
        )
    return refine_rounds(base, cut(found, "merged"), keys, tolerance).select(*keys, "node", "comm")


def cluster(
    edges: DataFrame,
    resolutions: Sequence[float] = (1.0,),
    algorithm: str = "leiden",
    run: Sequence[str] = (),
    tolerance: float = 1e-3,
) -> DataFrame:
    """Modularity clusters for all resolutions (and runs) in one job.

    Communities merge until no merge raises modularity, then single rows move while
    that helps.  Runs of at most ``TASK_EDGES`` edges take these rounds in a task each, with
    the same result.  ``leiden`` also splits communities that are not connected.  Returns
    ``run..., resolution, node, cluster`` with clusters numbered from 0 by
    decreasing size.
    """
    if algorithm not in ("leiden", "louvain"):
        raise ValueError(f"unknown algorithm {algorithm}")
    keys = [*run, "resolution"]
    grid = F.explode(F.array(*[F.lit(float(r)) for r in resolutions]))
    base = edges.withColumn("resolution", grid).select(*keys, "src", "dst", F.col("weight").alias("w"))
    base = cut(base.filter(F.col("src") != F.col("dst")), "graph")
    degrees = base.groupBy(*keys, F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    nodes = cut(
        degrees.join(degrees.groupBy(*keys).agg(F.sum("k").alias("m2")), keys).withColumn("gamma", F.col("resolution")), "nodes"
    )
    weight = F.col("w")
    odd = F.bool_or(weight.isNull() | F.isnan(weight)) | (F.sum("w") <= 0)
    runs = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.coalesce(odd, F.lit(True)).alias("odd"))
    shape = runs.agg(F.max("n").alias("n"), F.bool_or("odd").alias("odd")).first()
    found = None
    if shape["n"] is not None and shape["n"] <= TASK_EDGES and not shape["odd"]:
        found = cluster_runs(base, nodes, keys, tolerance)
    if found is None:
        found = _cluster_by_joins(base, nodes, keys, tolerance)
    if algorithm == "leiden":
        inside = base.join(found.select(*keys, F.col("node").alias("src"), F.col("comm").alias("_s")), [*keys, "src"]).join(
            found.select(*keys, F.col("node").alias("dst"), F.col("comm").alias("_d")), [*keys, "dst"]
        ).filter(F.col("_s") == F.col("_d"))
        found = connected_components(inside, found.select(*keys, "node"), keys).withColumnRenamed("component", "comm")
    sizes = found.groupBy(*keys, "comm").agg(F.count(F.lit(1)).alias("_n")).withColumn("_neg", -F.col("_n"))
    numbered = running_index(sizes, keys, ["_neg", "comm"], "_at")
    return found.join(numbered.select(*keys, "comm", "_at"), [*keys, "comm"]).select(
        *keys, "node", (F.col("_at") - 1).cast("string").alias("cluster")
    )


def cluster_column(algorithm: str, resolution: float, level: int = 1) -> str:
    return f"{algorithm}_{float(resolution)}_{level}"


def add_clusters(
    obs: DataFrame, edges: DataFrame, resolutions: Sequence[float], algorithm: str = "leiden", overwrite: bool = False
) -> DataFrame:
    """Join one cluster column per resolution; existing columns are kept unless overwritten."""
    todo = [r for r in resolutions if overwrite or cluster_column(algorithm, r) not in obs.columns]
    if not todo:
        return obs
    found = cluster(edges, todo, algorithm)
    wide = found.groupBy(F.col("node").alias("cell_id")).agg(
        *[
            F.max(F.when(F.col("resolution") == float(r), F.col("cluster"))).alias(cluster_column(algorithm, r))
            for r in todo
        ]
    )
    names = [cluster_column(algorithm, r) for r in todo]
    return obs.select(*[quoted(c) for c in obs.columns if c not in names]).join(wide, "cell_id", "left")


def subcluster(
    emb: DataFrame, parent: str, resolution: float, algorithm: str = "leiden", n_neighbors: int = 15
) -> DataFrame:
    """Second-level labels ``parent_child``: neighbours and clusters inside each parent.

    Parents with fewer than twice the number of neighbours repeat their own label.
    All parents are handled in one job.
    """
    sizes = emb.groupBy(quoted(parent)).agg(F.count(F.lit(1)).alias("_n"))
    big = sizes.filter(F.col("_n") >= 2 * n_neighbors).select(quoted(parent))
    chosen = emb.join(big, parent, "left_semi")
    graph = connectivities(neighbors(chosen, n_neighbors, same=parent), n_neighbors)
    # Neighbours never cross parents, so the graph is already split by parent; the
    # parent enters as the run key to give each its own total weight.
    tagged = graph.join(chosen.select(F.col("cell_id").alias("src"), quoted(parent).alias("_parent")), "src")
    found = cluster(tagged, [resolution], algorithm, run=["_parent"])
    joined = emb.select("cell_id", quoted(parent)).join(
        found.select(F.col("node").alias("cell_id"), "cluster"), "cell_id", "left"
    )
    own = F.substring_index(quoted(parent).cast("string"), "_", -1)
    return joined.withColumn("label", F.concat_ws("_", quoted(parent).cast("string"), F.coalesce("cluster", own)))


def _mixed_longs(*values) -> np.ndarray:
    """``F.xxhash64`` of long columns, as unsigned numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    h = np.array([42], np.uint64)
    for value in values:
        word = np.atleast_1d(np.asarray(value, np.int64)).view(np.uint64)
        h = (h + p5 + np.uint64(8)) ^ (turn(word * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h = h ^ (h >> np.uint64(32))
    return h


def _drawn_unit(*values) -> np.ndarray:
    """Reproducible pseudo-random numbers in (0, 1) of long columns, the same as ``_drawn_unit_column``."""
    return ((_mixed_longs(*values) >> np.uint64(12)).astype(float) + 0.5) / 2.0**52


def _drawn_unit_column(*values: Column | int) -> Column:
    longs = [(v if isinstance(v, Column) else F.lit(v)).cast("long") for v in values]
    return (F.shiftrightunsigned(F.xxhash64(*longs), 12).cast("double") + 0.5) / 2.0**52


def _layout_forces(graph: DataFrame, n: int, top: float, seed: int, a: float, b: float, negatives: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Sum of the forces on every place in an epoch, from all coordinates.

    Tasks hold the coordinates and make the pairs of their edges; sums per place leave them.
    """
    context = graph.sparkSession.sparkContext

    def forces(epoch: int, xy: np.ndarray) -> np.ndarray:
        shared = context.broadcast(xy)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = shared.value
            for batch in batches:
                src, dst, weight = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                drawn = _drawn_unit(seed, epoch, src, dst) <= weight / top
                src, dst = src[drawn], dst[drawn]
                known = dst >= 0
                pulled = _pairs_force(at, src[known], dst[known], lambda d2: -2.0 * a * b * d2 ** (b - 1.0) / (1.0 + a * d2**b))
                sums = [np.bincount(src[known], f, n) for f in pulled.T]
                for s in range(1, negatives + 1):
                    other = np.floor(_drawn_unit(seed, epoch, src, dst, s) * n).astype(np.int64)
                    pushed = _pairs_force(at, src, other, lambda d2: 2.0 * b / ((0.001 + d2) * (1.0 + a * d2**b)))
                    sums = [total + np.bincount(src, f, n) for total, f in zip(sums, pushed.T)]
                moved = np.unique(src)
                yield pa.RecordBatch.from_arrays([pa.array(moved), *[pa.array(t[moved]) for t in sums]], ["_s", "gx", "gy"])

        found = graph.mapInArrow(run, "_s long, gx double, gy double").toArrow()
        shared.destroy()
        place = found["_s"].to_numpy()
        return np.column_stack([np.bincount(place, found[c].to_numpy(), n) for c in ("gx", "gy")])

    return forces


def _pairs_force(xy: np.ndarray, src: np.ndarray, dst: np.ndarray, strength: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Force of one row of a pair on the other, none between rows at one point."""
    gap = xy[src] - xy[dst]
    d2 = (gap * gap).sum(axis=1)
    apart = d2 > 0
    size = np.zeros(len(d2))
    size[apart] = strength(d2[apart])
    return np.clip(size[:, None] * gap, -4.0, 4.0)


def _layout_by_joins(
    graph: DataFrame, coords: DataFrame, n: int, top: float, n_epochs: int, seed: int, a: float, b: float, negatives: int
) -> DataFrame:
    """The epochs as joins of the edges with the coordinates of both ends, however many rows there are."""
    for epoch in range(n_epochs):
        rate = 1.0 - epoch / n_epochs
        drawn = graph.filter(_drawn_unit_column(seed, epoch, F.col("_s"), F.col("_d")) <= F.col("weight") / F.lit(top))
        src = coords.select(F.col("_at").alias("_s"), F.col("x").alias("sx"), F.col("y").alias("sy"))
        dst = coords.select(F.col("_at").alias("_d"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        pulled = drawn.join(src, "_s").join(dst, "_d")
        dx, dy = F.col("sx") - F.col("ox"), F.col("sy") - F.col("oy")
        d2 = dx * dx + dy * dy
        pull = F.when(d2 > 0, -2.0 * a * b * F.pow(d2, b - 1.0) / (1.0 + a * F.pow(d2, b))).otherwise(0.0)
        attraction = pulled.select("_s", _clip(pull * dx).alias("gx"), _clip(pull * dy).alias("gy"))
        draws = drawn.select("_s", "_d", F.explode(F.sequence(F.lit(1), F.lit(negatives))).alias("_n"))
        draws = draws.select("_s", F.floor(_drawn_unit_column(seed, epoch, F.col("_s"), F.col("_d"), F.col("_n")) * n).alias("_d"))
        pushed = draws.join(src, "_s").join(dst, "_d")
        push = F.when(d2 > 0, 2.0 * b / ((0.001 + d2) * (1.0 + a * F.pow(d2, b)))).otherwise(0.0)
        repulsion = pushed.select("_s", _clip(push * dx).alias("gx"), _clip(push * dy).alias("gy"))
        forces = attraction.unionByName(repulsion).groupBy(F.col("_s").alias("_at")).agg(
            F.sum("gx").alias("gx"), F.sum("gy").alias("gy")
        )
        coords = cut(
            coords.join(forces, "_at", "left").select(
                "node", "_at",
                (F.col("x") + rate * F.coalesce("gx", F.lit(0.0))).alias("x"),
                (F.col("y") + rate * F.coalesce("gy", F.lit(0.0))).alias("y"),
            ),
            "layout",
        )
    return coords


def umap_layout(
    edges: DataFrame, nodes: DataFrame, n_epochs: int = 200, seed: int = 0, a: float = 0.583, b: float = 1.334, negatives: int = 5,
    shared_nodes: int = SHARED_NODES,
) -> DataFrame:
    """Two-dimensional layout by attraction along edges and repulsion from random rows.

    Random partners are drawn by place, and no pair beyond the drawn ones is made.  Up to
    ``shared_nodes`` rows, tasks are given all coordinates and an epoch is one pass over the
    edges; beyond, it is equi-joins with the coordinate table.  Both draw the same pairs.
    """
    numbered = running_index(nodes.select("node").distinct(), [], ["node"], "_at").withColumn("_at", F.col("_at") - 1)
    start = numbered.select(
        "node", "_at", (hash_unit(f"{seed}x", "node") * 20 - 10).alias("x"), (hash_unit(f"{seed}y", "node") * 20 - 10).alias("y")
    )
    coords = cut(start, "layout")
    n = coords.count()
    src = coords.select(F.col("node").alias("src"), F.col("_at").alias("_s"))
    dst = coords.select(F.col("node").alias("dst"), F.col("_at").alias("_d"))
    placed = edges.select("src", "dst", "weight").join(src, "src").join(dst, "dst", "left")
    placed = placed.select("_s", F.coalesce("_d", F.lit(-1)).alias("_d"), F.col("weight").cast("double").alias("weight"))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but many pairs are made of them
    graph = cut(placed.filter("weight IS NOT NULL").repartitionByRange(parts, "_s"), "graph")
    top = edges.agg(F.max("weight")).first()[0] if n else None
    if top:
        top = float(top)
        if n > shared_nodes:
            coords = _layout_by_joins(graph, coords, n, top, n_epochs, seed, a, b, negatives)
        else:
            known = coords.select("_at", "x", "y").toArrow()
            place = known["_at"].to_numpy()
            xy = np.empty((n, 2))
            for i, axis in enumerate(("x", "y")):
                xy[place, i] = known[axis].to_numpy()
            forces = _layout_forces(graph, n, top, seed, a, b, negatives)
            for epoch in range(n_epochs):
                xy = xy + (1.0 - epoch / n_epochs) * forces(epoch, xy)
            ends = pa.table({"_at": np.arange(n), "x": xy[:, 0], "y": xy[:, 1]})
            coords = cut(coords.select("node", "_at").join(nodes.sparkSession.createDataFrame(ends), "_at"), "layout")
    same = coords.withColumnRenamed("node", "_node")
    return nodes.select("node").join(same, F.col("node").eqNullSafe(F.col("_node"))).select("node", "x", "y")


def _clip(force: Column) -> Column:
    return F.least(F.greatest(force, F.lit(-4.0)), F.lit(4.0))


def _products(left: DataFrame, right: DataFrame, width: int) -> np.ndarray:
    """Sum over the rows of the outer products of two vectors per ``src``; the second one has ``width`` numbers."""
    sums = left.withColumnRenamed("v", "_a").join(right.withColumnRenamed("v", "_b"), "src").select(
        array_to_vector(F.flatten(F.transform("_a", lambda x: F.transform("_b", lambda y: x * y)))).alias("p")
    ).agg(vector_to_array(Summarizer.sum(F.col("p"))).alias("s"))
    return np.array(sums.first()["s"]).reshape(-1, width)


def _turned(rows: DataFrame, by: np.ndarray) -> DataFrame:
    """Every vector times a small matrix."""
    columns = [F.array(*[F.lit(float(x)) for x in c]) for c in by.T]
    dot = lambda c: F.aggregate(F.zip_with("v", c, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("src", F.array(*[dot(c) for c in columns]).alias("v"))


def _centred_table(distances: DataFrame) -> tuple[DataFrame, Callable[[DataFrame, int], DataFrame]]:
    """Samples ``src`` of a long table of pairs, and the product of its double centred squares with rows ``src, v``."""
    turned = distances.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "dist")
    sym = distances.select("src", "dst", "dist").unionByName(turned).groupBy("src", "dst").agg(F.avg("dist").alias("d"))
    squared = cut(sym.select("src", "dst", (F.col("d") * F.col("d")).alias("s")), "mds")
    means = squared.groupBy("src").agg(F.avg("s").alias("_m"))
    overall = squared.agg(F.avg("s")).scalar()
    centred = cut(
        squared.join(means, "src")
        .join(means.withColumnsRenamed({"src": "dst", "_m": "_n"}), "dst")
        .select("src", "dst", (-0.5 * (F.col("s") - F.col("_m") - F.col("_n") + overall)).alias("b")),
        "mds",
    )

    def times(basis: DataFrame, width: int) -> DataFrame:
        weighted = centred.join(basis.withColumnRenamed("src", "dst"), "dst").select(
            "src", array_to_vector(F.transform("v", lambda x: x * F.col("b"))).alias("p")
        )
        return weighted.groupBy("src").agg(vector_to_array(Summarizer.sum(F.col("p"))).alias("v"))

    return means.select("src"), times


def _centred_vectors(distances: EuclideanPairs) -> tuple[DataFrame, Callable[[DataFrame, int], DataFrame]]:
    """The same for the distances of vectors, whose double centred squares are the products of the centred vectors.

    The matrix is applied through the vectors, so no pair is made.
    """
    rows = distances.rows.select(F.col("cell_id").alias("src"), "v")
    means = rows.select(F.posexplode("v")).groupBy("pos").agg(F.avg("col").alias("m")).collect()
    middle = F.array(*[F.lit(r["m"]) for r in sorted(means)]).cast("array<double>")
    apart = F.zip_with("v", middle, lambda x, m: x - m)
    centred = cut(rows.select("src", apart.alias("v")), "mds")
    return centred.select("src"), lambda basis, width: _turned(centred, _products(centred, basis, width))


def mds(distances: DataFrame | EuclideanPairs, n_dims: int = 2, extra: int = 8, tolerance: float = 1e-10) -> DataFrame:
    """Classical scaling of a sample distance matrix ``src, dst, dist``, or of ``EuclideanPairs``.

    The matrix is symmetrised and double centred: a long table by aggregates, distances of
    vectors by their mean.  Its leading eigenvectors come from subspace iteration: a round
    multiplies the matrix with ``n_dims + extra`` vectors, by a join or through the vectors,
    and only matrices of that width reach the driver.  It ends when the wanted eigenvalues
    stand still.
    """
    samples, times = (_centred_vectors if isinstance(distances, EuclideanPairs) else _centred_table)(distances)
    width = min(samples.count(), n_dims + extra)
    basis = cut(samples.select("src", F.array(*[hash_normal(f"mds{j}", "src") for j in range(width)]).alias("v")), "basis")
    before = None
    while width:
        image = cut(times(basis, width), "image")
        gram = _products(basis, basis, width)
        inner = _products(basis, image, width)
        # orthonormal combinations of the basis, without directions that have died out
        size, axes = np.linalg.eigh(gram)
        alive = size > 1e-12 * size.max()
        whiten = axes[:, alive] / np.sqrt(size[alive])
        values, vectors = np.linalg.eigh(whiten.T @ ((inner + inner.T) / 2) @ whiten)
        order = np.argsort(-values, kind="stable")
        values, mix = values[order], whiten @ vectors[:, order]
        top = values[:n_dims]
        if before is not None and len(before) == len(top) and np.all(np.abs(top - before) <= tolerance * max(np.abs(top).max(), 1e-300)):
            break
        before = top
        largest = np.abs(values).max()
        if largest == 0:  # all distances are zero
            break
        scale = np.maximum(np.abs(values), 1e-9 * largest)
        basis = cut(_turned(image, mix / scale), "basis")  # the image of orthonormal vectors, kept at length one
        width = mix.shape[1]
    if not width:
        return samples.limit(0).withColumn("v", F.array().cast("array<double>"))
    best = [i for i in range(min(n_dims, len(values))) if values[i] > 1e-12]
    found = cut(_turned(basis, mix[:, best] * np.sqrt(values[best])), "mds") if best else samples.select("src", F.array().cast("array<double>").alias("v"))
    signs = []
    for i in range(len(best)):  # the entry of largest size is positive
        top = found.select(F.max_by(F.get("v", i), F.struct(F.abs(F.get("v", i)), "src"))).first()[0]
        signs.append(1.0 if top is None or top >= 0 else -1.0)
    coords = [F.get("v", i) * signs[i] for i in range(len(best))] + [F.lit(0.0)] * (n_dims - len(best))
    return found.select("src", F.array(*coords).alias("v"))



def _majorised_table(distances: DataFrame, coords: DataFrame, axes: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A round over the written pairs: new coordinates, the old ones and the part of the stress per ``src``."""
    turned = distances.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "dist")
    pairs = distances.select("src", "dst", "dist").unionByName(turned).filter("src <> dst").groupBy("src", "dst").agg(F.avg("dist").alias("d"))
    pairs = cut(pairs, "pairs")
    n, n_pairs = coords.count(), pairs.count()
    if n_pairs != n * (n - 1):
        raise ValueError(f"{n} samples have {n_pairs} ordered pairs instead of {n * (n - 1)}")

    def move(coords: DataFrame) -> DataFrame:
        other = coords.select(F.col("src").alias("dst"), *[quoted(a).alias(f"{a}o") for a in axes])
        gaps = [quoted(a) - quoted(f"{a}o") for a in axes]
        met = pairs.join(coords, "src").join(other, "dst").withColumn("_z", F.sqrt(sum((g * g for g in gaps), F.lit(0.0))))
        pull = F.when(F.col("_z") > 0, F.col("d") / F.col("_z")).otherwise(0.0)
        off = (F.col("d") - F.col("_z")) * (F.col("d") - F.col("_z"))
        return met.groupBy("src").agg(
            *[(F.sum(pull * g) / n).alias(a) for a, g in zip(axes, gaps)], *[F.first(a).alias(f"{a}was") for a in axes],
            (F.sum(off) / 2).alias("_stress"),
        )

    return move


def _pulled(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums of ``dist / gap * (x - y)`` for the rows of both blocks, and the squared misfit of all pairs."""
    left, right, off = np.zeros_like(x), np.zeros_like(y), 0.0
    step = max(1, PULL_CELLS // len(b))
    for at in range(0, len(a), step):
        rows = slice(at, at + step)
        d = block_distances(a[rows], b)
        z = np.sqrt(sum(np.subtract.outer(p, q) ** 2 for p, q in zip(x[rows].T, y.T)))
        pull = np.divide(d, z, out=np.zeros_like(d), where=z > 0)
        left[rows] = x[rows] * pull.sum(axis=1)[:, None] - pull @ y
        right += y * pull.sum(axis=0)[:, None] - pull.T @ x[rows]
        d -= z
        off += float(np.vdot(d, d))
    return left, right, off


def _majorised_vectors(
    distances: EuclideanPairs, coords: DataFrame, axes: list[str], block_rows: int | None
) -> Callable[[DataFrame], DataFrame]:
    """The same round with the distances of a block pair made inside a task; only sums per row leave it."""
    rows = distances.rows.select("cell_id", "v")
    n, known = coords.count(), rows.join(coords, F.col("cell_id") == F.col("src")).count()
    if n != known or n != rows.count():
        raise ValueError(f"{n} samples have coordinates, and {known} of them have vectors, of {rows.count()}")
    width = rows.select(F.max(F.size("v"))).first()[0] or 1
    most = block_rows or max(1, min(PULL_ROWS, PULL_BYTES // (8 * width)))
    sums = ", ".join(f"`{a}` double" for a in axes)

    def block(p: pd.DataFrame, q: pd.DataFrame | None) -> pd.DataFrame:
        alone, out = q is None, []
        if not alone and not (len(p) and len(q)):
            return pd.DataFrame({c: [] for c in ["src", *axes, "_stress"]})
        other = p if alone else q
        a, b, x, y = np.stack(p["v"]), np.stack(other["v"]), p[axes].to_numpy(), other[axes].to_numpy()
        left, right, off = _pulled(a, b, x, y)
        for rows, moved in [(p, left)] if alone else [(p, left), (q, right)]:
            out.append(pd.DataFrame(moved, columns=axes).assign(src=rows["cell_id"].to_numpy(), _stress=0.0))
        out[0].loc[0, "_stress"] = off / 2 if alone else off  # a block with itself has every pair twice
        return pd.concat(out)[["src", *axes, "_stress"]]

    def move(coords: DataFrame) -> DataFrame:
        placed = cut(rows.join(coords, F.col("cell_id") == F.col("src")).drop("src"), "placed")
        id_type = rows.schema["cell_id"].dataType.simpleString()
        parts = each_pair_once(placed, block, f"src {id_type}, {sums}, _stress double", most)
        pulled = parts.groupBy("src").agg(*[(F.sum(a) / n).alias(a) for a in axes], F.sum("_stress").alias("_stress"))
        was = coords.select("src", *[quoted(a).alias(f"{a}was") for a in axes])
        return pulled.join(was, "src").select("src", *axes, *[f"{a}was" for a in axes], "_stress")

    return move


def stress_majorisation(
    distances: DataFrame | EuclideanPairs, start: DataFrame, tolerance: float = 1e-4, max_rounds: int | None = None,
    block_rows: int | None = None,
) -> tuple[DataFrame, list[float]]:
    """Layout ``src, v`` whose distances approach ``distances`` (``src, dst, dist``), and the stress of every round.

    Metric scaling by Guttman transforms from the layout ``start`` (``src, v``).  A round is
    one join of the long distance table with the coordinates of both ends and one sum per
    sample, so stress never rises; it ends when a round takes off less than ``tolerance``
    of the stress.  Both directions of a pair are averaged; every pair of samples must be
    there, and a missing one raises.  Pairs that lie on one point do not pull.  For
    ``EuclideanPairs`` a round makes the distances of every pair of blocks anew, inside a task.
    """
    n_dims = start.select(F.max(F.size("v"))).first()[0] or 0
    axes = [f"_x{i}" for i in range(n_dims)]
    coords = start.select("src", *[F.get("v", i).alias(a) for i, a in enumerate(axes)])
    if isinstance(distances, EuclideanPairs):
        move = _majorised_vectors(distances, coords, axes, block_rows)
    else:
        move = _majorised_table(distances, coords, axes)
    history: list[float] = []
    if coords.count() < 2 or not axes:
        return start.select("src", "v"), history
    while True:
        moved = cut(move(coords), "majorised")
        history.append(float(moved.agg(F.sum("_stress")).first()[0]))  # of the coordinates this round began with
        still = len(history) > 1 and history[-2] - history[-1] <= tolerance * history[-2]
        if still or history[-1] == 0 or (max_rounds is not None and len(history) > max_rounds):
            return moved.select("src", F.array(*[quoted(f"{a}was") for a in axes]).alias("v")), history
        coords = moved.select("src", *axes)
