"""Communities refined on every level of aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from heddle.functions.ordering import running_index
from heddle.functions.runtime import cut, quoted
from heddle.operators.graph import connected_components, merge_round, refine_rounds

#: A move or merge gains when it adds more than this weight.
MIN_GAIN = 1e-9


def _inside(edges: DataFrame, state: DataFrame, run: Sequence[str]) -> DataFrame:
    """Edges whose ends lie in one community."""
    src = state.select(*run, F.col("node").alias("src"), F.col("comm").alias("_s"))
    dst = state.select(*run, F.col("node").alias("dst"), F.col("comm").alias("_d"))
    met = edges.join(src, [*run, "src"]).join(dst, [*run, "dst"]).filter("_s = _d")
    return met.select(*run, "src", "dst", "w", F.col("_s").alias("comm"))


def move_gains(edges: DataFrame, state: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """``run..., node, comm, to, rise``: what every single move adds, in units of edge weight.

    A row can go to each community that it has an edge with, or stand alone (``to`` is
    empty).  ``edges``: symmetric ``run..., src, dst, w``; ``state``: ``run..., node, k, gamma,
    m2, comm``.
    """
    run = list(run)
    totals = state.groupBy(*run, F.col("comm").alias("to")).agg(F.sum("k").alias("_tot"))
    near = edges.join(state.select(*run, F.col("node").alias("dst"), F.col("comm").alias("to")), [*run, "dst"])
    own = state.select(*run, "node", F.col("comm").alias("to"), F.lit(0.0).alias("w"))
    links = near.select(*run, F.col("src").alias("node"), "to", "w").unionByName(own)
    options = links.groupBy(*run, "node", "to").agg(F.sum("w").alias("_in")).join(state, [*run, "node"]).join(totals, [*run, "to"])
    stays = F.col("to") == F.col("comm")
    rest = F.col("_tot") - F.when(stays, F.col("k")).otherwise(0.0)
    options = options.withColumn("_gain", F.col("_in") - F.col("gamma") * F.col("k") * rest / F.col("m2"))
    stay = options.filter(stays).select(*run, "node", F.col("_gain").alias("_stay"))
    # the row's own community becomes the empty one: standing alone is worth nothing
    worth = F.when(stays, 0.0).otherwise(F.col("_gain")) - F.col("_stay")
    return options.join(stay, [*run, "node"]).select(*run, "node", "comm", F.when(~stays, F.col("to")).alias("to"), worth.alias("rise"))


def settle(edges: DataFrame, state: DataFrame, run: Sequence[str] = (), tag: str = "alone") -> DataFrame:
    """Single moves until none gains; communities are text.

    A row that leaves all communities founds one named by row, ``tag`` and round, so ``tag``
    must differ between calls that build on one another.

    Two kinds of rounds take turns, and in both modularity rises for each run.  In the first,
    rows move from tails to heads (coins of the communities).  Links between such rows only
    help; their sizes hurt by at most ``gamma * k * other k / m2`` for each other row that
    leaves the same community or enters the same one, so a row goes if it rises by more than
    all of them together could cost it.  In the second a community takes part in one move at
    most, the one of largest rise among those that leave or enter it: their rises add up, and
    it ends when there is none.
    """
    run = list(run)
    sizes = state.select(*run, "node", "k", "gamma", "m2")
    state = cut(state.withColumn("comm", F.col("comm").cast("string")), "settle")
    for step in count():
        rise = move_gains(edges, state, run).filter(F.col("rise") > MIN_GAIN)
        alone = F.concat_ws("#", F.col("node").cast("string"), F.lit(f"{tag}{step}"))
        choice = F.struct((-F.col("rise")).alias("r"), F.col("node").alias("node"), F.coalesce("to", alone).alias("to"), F.col("to").isNull().alias("alone"))
        wants = cut(rise.groupBy(*run, "node", "comm").agg(F.min(choice).alias("_m")), "wants")
        goes = _bulk(wants, sizes, run, f"{tag}{step}") if step % 2 == 0 else _apart(wants, run)
        seen = Observation()
        moved = state.join(goes, [*run, "node"], "left").observe(seen, F.count("_to").alias("n"))
        state = cut(moved.withColumn("comm", F.coalesce("_to", "comm")).drop("_to"), "settle")
        if step % 2 and not seen.get["n"]:
            return state


def _bulk(wants: DataFrame, sizes: DataFrame, run: Sequence[str], coin: str) -> DataFrame:
    """Moves from tails to heads that rise whatever the other ones cost them."""
    head = lambda c: F.pmod(F.xxhash64(F.lit(coin), *[quoted(k) for k in run], c), F.lit(2)) == 1
    to = F.col("_m")["to"]
    able = wants.filter(~head(F.col("comm")) & (F.col("_m")["alone"] | head(to))).join(sizes, [*run, "node"])
    able = able.withColumn("_to", to)
    leaving = able.groupBy(*run, "comm").agg(F.sum("k").alias("_l"))
    entering = able.groupBy(*run, "_to").agg(F.sum("k").alias("_e"))
    cost = F.col("gamma") * F.col("k") * (F.col("_l") + F.col("_e") - 2 * F.col("k")) / F.col("m2")
    met = able.join(leaving, [*run, "comm"]).join(entering, [*run, "_to"])
    return met.filter(-F.col("_m")["r"] > cost).select(*run, "node", "_to")


def _apart(wants: DataFrame, run: Sequence[str]) -> DataFrame:
    """The moves that are the best of both their communities."""
    leave = wants.select(*run, F.col("comm").alias("_c"), "_m")
    enter = wants.select(*run, F.col("_m")["to"].alias("_c"), "_m")
    first = leave.unionByName(enter).groupBy(*run, "_c").agg(F.min("_m").alias("_f"))
    return (
        wants.withColumn("_to", F.col("_m")["to"])
        .join(first.withColumnsRenamed({"_c": "comm", "_f": "_a"}), [*run, "comm"])
        .join(first.withColumnsRenamed({"_c": "_to", "_f": "_b"}), [*run, "_to"])
        .filter("_m = _a AND _m = _b").select(*run, "node", "_to")
    )


def refine_inside(edges: DataFrame, state: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """``run..., node, part``: parts of each community by merges inside it.

    Rows start alone and merge in rounds of random heads and tails, as far as modularity
    rises, along edges of the community only.  So every part is connected.  A row that is
    linked to the rest of its community more weakly than chance stays alone.
    """
    run = list(run)
    inner = _inside(edges, state, run)
    totals = state.groupBy(*run, "comm").agg(F.sum("k").alias("_tot"))
    linked = inner.groupBy(*run, F.col("src").alias("node")).agg(F.sum("w").alias("_in"))
    chance = F.col("gamma") * F.col("k") * (F.col("_tot") - F.col("k")) / F.col("m2")
    strong = state.join(totals, [*run, "comm"]).join(linked, [*run, "node"]).filter(F.col("_in") >= chance).select(*run, "node")
    level = cut(
        inner.join(strong.withColumnRenamed("node", "src"), [*run, "src"], "left_semi")
        .join(strong.withColumnRenamed("node", "dst"), [*run, "dst"], "left_semi")
        .select(*run, "src", "dst", "w"),
        "inner",
    )
    found = state.select(*run, "node", F.col("node").alias("part"))
    sums = state.select(*run, F.col("node").alias("comm"), "k", "gamma", "m2")
    for step in count():
        placed, is_open = merge_round(level, sums, run, step)
        if not is_open:
            return cut(found, "parts")
        to = placed.select(*run, F.col("comm").alias("part"), "to")
        found = cut(found.join(to, [*run, "part"]).select(*run, "node", F.col("to").alias("part")), "parts")
        sums = placed.groupBy(*run, F.col("to").alias("comm")).agg(
            F.sum("k").alias("k"), F.max("gamma").alias("gamma"), F.max("m2").alias("m2")
        )
        level = _aggregated(level, to, run)


def _aggregated(edges: DataFrame, to: DataFrame, run: Sequence[str]) -> DataFrame:
    """Edges between the communities that ``run..., part, to`` puts the ends in."""
    src = to.select(*run, F.col("part").alias("src"), F.col("to").alias("_s"))
    dst = to.select(*run, F.col("part").alias("dst"), F.col("to").alias("_d"))
    met = edges.join(src, [*run, "src"]).join(dst, [*run, "dst"]).filter("_s <> _d")
    return cut(met.groupBy(*run, F.col("_s").alias("src"), F.col("_d").alias("dst")).agg(F.sum("w").alias("w")), "level")


def start_state(edges: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Every row alone: ``run..., node, k, gamma, m2, comm`` of ``run..., resolution, src, dst, w``."""
    run = list(run)
    degrees = edges.groupBy(*run, "resolution", F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    totals = degrees.groupBy(*run, "resolution").agg(F.sum("k").alias("m2"))
    state = degrees.join(totals, [*run, "resolution"])
    return state.select(*run, "resolution", "node", "k", F.col("resolution").alias("gamma"), "m2", F.col("node").alias("comm"))


def resolved(edges: DataFrame, resolutions: Sequence[float], run: Sequence[str] = ()) -> DataFrame:
    """Edges once per resolution, without loops: ``run..., resolution, src, dst, w``."""
    grid = F.explode(F.array(*[F.lit(float(r)) for r in resolutions]))
    base = edges.filter(F.col("src") != F.col("dst")).withColumn("resolution", grid)
    return cut(base.select(*run, "resolution", "src", "dst", F.col("weight").alias("w")), "graph")


def leiden(
    edges: DataFrame, resolutions: Sequence[float] = (1.0,), run: Sequence[str] = (), tolerance: float = 1e-2
) -> DataFrame:
    """Communities of a symmetric graph ``run..., src, dst, weight``, all resolutions and runs in one job.

    On every level rows move between communities while modularity rises by ``tolerance``, each
    community is then divided by merges inside it, and its parts are the rows of the next
    level, which start in the community they come from.  From the second level on moves go on
    until none gains, so a part that is better off alone leaves its community.  It ends on the
    level where nothing merges.  On the finest level single moves then go on until none gains, and communities
    that fell apart are split.  So in the result every community is connected and no single
    move, to another community or out of all, raises modularity.

    Rows without edges are not in the result.  Returns ``run..., resolution, node, cluster``,
    clusters numbered from 0 by decreasing size, equal sizes by their least row.
    """
    keys = [*run, "resolution"]
    base = resolved(edges, resolutions, run)
    nodes = cut(start_state(base, run), "nodes")
    members = nodes.select(*keys, "node", F.col("node").alias("part"))
    level, state = base, nodes.withColumn("comm", F.col("comm").cast("string"))
    for depth in count():
        state = refine_rounds(level, state, keys, tolerance)
        if depth:
            state = settle(level, state, keys, f"level{depth}.")
        parts = refine_inside(level, state, keys)
        below = parts.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys, "part").alias("parts")).first()
        if below["rows"] == below["parts"]:
            break
        to = parts.select(*keys, F.col("node").alias("part"), F.col("part").alias("to"))
        members = cut(members.join(to, [*keys, "part"]).select(*keys, "node", F.col("to").alias("part")), "members")
        joined = state.join(parts, [*keys, "node"]).groupBy(*keys, F.col("part").alias("node"))
        state = cut(joined.agg(F.sum("k").alias("k"), *[F.max(c).alias(c) for c in ("gamma", "m2", "comm")]), "state")
        level = _aggregated(level, to, keys)
    placed = members.join(state.select(*keys, F.col("node").alias("part"), "comm"), [*keys, "part"]).drop("part")
    while True:
        settled = settle(base, nodes.drop("comm").join(placed, [*keys, "node"]), keys)
        whole = connected_components(_inside(base, settled, keys), settled.select(*keys, "node"), keys)
        placed = whole.withColumnRenamed("component", "comm")
        if settled.select(*keys, "comm").distinct().count() == placed.select(*keys, "comm").distinct().count():
            break
    sizes = placed.groupBy(*keys, "comm").agg(F.count(F.lit(1)).alias("_n")).withColumn("_neg", -F.col("_n"))
    numbered = running_index(sizes, keys, ["_neg", "comm"], "_at")
    return placed.join(numbered.select(*keys, "comm", "_at"), [*keys, "comm"]).select(
        *keys, "node", (F.col("_at") - 1).cast("string").alias("cluster")
    )


def cluster_faults(edges: DataFrame, found: DataFrame, run: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """What a partition ``run..., resolution, node, cluster`` still lacks.

    Returns the communities in several parts (``run..., resolution, cluster, n_parts``) and
    the single moves that gain (``run..., resolution, node, comm, to, rise``).
    """
    keys = [*run, "resolution"]
    resolutions = [r[0] for r in found.select("resolution").distinct().collect()]
    base = resolved(edges, resolutions, run)
    named = found.withColumnRenamed("cluster", "comm")
    state = cut(start_state(base, run).drop("comm").join(named, [*keys, "node"]), "state")
    whole = connected_components(_inside(base, state, keys), state.select(*keys, "node"), keys)
    parts = whole.join(named, [*keys, "node"]).groupBy(*keys, F.col("comm").alias("cluster"))
    broken = parts.agg(F.count_distinct("component").alias("n_parts")).filter("n_parts > 1")
    return broken, move_gains(base, state, keys).filter(F.col("rise") > MIN_GAIN)
