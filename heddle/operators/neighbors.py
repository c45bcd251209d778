"""Exact nearest neighbours as an equi-join on regions of space.

Points are assigned to the nearest of a bounded number of pivots.  A query first
searches the regions around it, which bounds the distance of its last neighbour;
the triangle inequality then names the only other regions that can hold a closer
point.  Where those are so many that a row would be sent more often than by a search
of all rows in large blocks, as in many dimensions, the blocks are searched instead.
Regions are cut into pieces of bounded size on both sides, equal vectors
are searched once, and only the best ``k`` candidates of a piece leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.ordering import sample_exact
from heddle.functions.runtime import cut, join_keys, quoted

MAX_PIVOTS = 8192
MAX_PIVOT_BYTES = 256 << 20
MAX_SPLIT_KEYS = 256
DIRECT_ROWS = 1024
PIECE_ROWS = 4096
BLOCK_ROWS = 32768
BLOCK_BYTES = 16 << 20
KEY_BLOCKS = 6
VISIT_CELLS = 1 << 16
ASSIGN_CELLS = 1 << 20


def nearest_in_block(
    queries: np.ndarray, points: np.ndarray, m: int, bound: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the points at least as close as its ``m``-th nearest one, and as ``bound``.

    A fast product form preselects with a safety margin; the distances returned
    are computed directly from the given numbers, so they do not depend on the block.
    """
    rows, cols, dists = [], [], []
    middle = points.mean(axis=0)
    given = points
    points = points - middle
    p2 = (points * points).sum(axis=1)
    step = max(1, (1 << 21) // max(1, len(points)))
    for start in range(0, len(queries), step):
        asked = queries[start : start + step]
        q = asked - middle
        q2 = (q * q).sum(axis=1)
        rough = q @ points.T
        rough *= -2.0
        rough += q2[:, None]
        rough += p2[None, :]
        margin = 1e-9 * (q2 + p2.max()) + 1e-12
        limit = np.full(len(q), np.inf) if bound is None else bound[start : start + step] ** 2 + margin
        if m < len(points):
            many = np.arange(len(q)) if bound is None else np.flatnonzero((rough <= limit[:, None]).sum(axis=1) > 4 * m)
            if len(many):
                last = np.partition(rough[many], m - 1, axis=1)[:, m - 1]
                limit[many] = np.minimum(limit[many], last + margin[many])
        r, c = np.nonzero(rough <= limit[:, None])
        exact = np.empty(len(r))
        for at in range(0, len(r), 1 << 16):
            part = slice(at, at + (1 << 16))
            gap = asked[r[part]] - given[c[part]]
            exact[part] = np.sqrt((gap * gap).sum(axis=1))
        rows.append(r + start)
        cols.append(c)
        dists.append(exact)
    if not rows:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dists)


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots by one matrix product, accurate relative to their spread."""
    middle = pivots.mean(axis=0)
    a, b = vectors - middle, pivots - middle
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


class Regions:
    """Pivots of each key with the size and radius of their regions (bounded, shipped to tasks)."""

    def __init__(self, pivots: pd.DataFrame):
        self.keys = {}
        for key, part in pivots.groupby("_key", sort=True):
            part = part.sort_values("cell")
            self.keys[key] = {
                "cell": part["cell"].to_numpy(),
                "v": np.stack(part["v"].to_numpy()),
                "n": np.zeros(len(part)),
                "radius": np.zeros(len(part)),
            }

    def with_sizes(self, stats: pd.DataFrame) -> Regions:
        for key, part in stats.groupby("_key"):
            region = self.keys[key]
            at = {c: i for i, c in enumerate(region["cell"])}
            for cell, n, radius in zip(part["cell"], part["n"], part["radius"]):
                region["n"][at[cell]] = n
                region["radius"][at[cell]] = radius
        return self

    def near(self, dist: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
        """Regions in pivot order until they hold ``m`` points."""
        order = np.argsort(dist, axis=1, kind="stable")
        sizes = n[order]
        before = np.cumsum(sizes, axis=1) - sizes
        mask = np.zeros(dist.shape, dtype=bool)
        np.put_along_axis(mask, order, (before < m) & (sizes > 0), axis=1)
        return mask

    def possible(self, dist: np.ndarray, region: dict, bound: np.ndarray) -> np.ndarray:
        """Regions that may hold a point within ``bound`` of the query."""
        lower = dist - region["radius"][None, :]
        home = dist.argmin(axis=1)
        between = pivot_distances(region["v"][home], region["v"])
        with np.errstate(divide="ignore", invalid="ignore"):
            side = (dist**2 - (dist[np.arange(len(dist)), home] ** 2)[:, None]) / (2.0 * between)
        side = np.where(between > 1e-6 * max(region["radius"].max(), dist.max()), side, 0.0)
        lower = np.maximum(lower, side)
        # The bounds are rounded; the margin is far above their error.
        reach = bound + 1e-6 * (np.where(np.isfinite(bound), bound, 0.0) + dist.max(axis=1) + region["radius"].max())
        return (lower <= reach[:, None]) & (region["n"][None, :] > 0)


def _planned(regions: Regions, m: int, second: bool, key: str, part: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of one key with the mask of the regions they have to search, in slices of bounded size."""
    region = regions.keys.get(key)
    if region is None:
        return
    step = max(1, VISIT_CELLS // len(region["cell"]))
    for start in range(0, len(part), step):
        rows = part.iloc[start : start + step]
        dist = pivot_distances(np.stack(rows["v"].to_numpy()), region["v"])
        mask = regions.near(dist, region["n"], m)
        if second:
            mask = regions.possible(dist, region, rows["bound"].to_numpy(dtype=float)) & ~mask
        yield rows, mask


def _visits(regions: Regions, m: int, second: bool):
    """Rows ``(qid, _key, v, cell)``: the regions each query has to search."""

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, part in pdf.groupby("_key", sort=False):
                for rows, mask in _planned(regions, m, second, key, part):
                    r, c = np.nonzero(mask)
                    yield pd.DataFrame(
                        {
                            "qid": rows["qid"].to_numpy()[r],
                            "_key": key,
                            "v": rows["v"].to_numpy()[r],
                            "cell": regions.keys[key]["cell"][c],
                        }
                    )

    return plan


def _visit_counts(regions: Regions, m: int):
    """Rows ``(_key, asked, visits)``: how many regions the second round would search."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, part in pdf.groupby("_key", sort=False):
                visits = sum(int(mask.sum()) for _, mask in _planned(regions, m, True, key, part))
                yield pd.DataFrame({"_key": [key], "asked": [len(part)], "visits": [visits]})

    return count


def _search(
    visits: DataFrame, points: DataFrame, m: int, id_type: str, piece_rows: Column | int = PIECE_ROWS, number: str = "double"
) -> DataFrame:
    """Best ``m`` points of every visited region, piece by piece.

    A column ``bound`` of the visits limits the distance; ``number`` is the type in which
    vectors travel.
    """
    n_points = points.groupBy("cell").agg(F.count(F.lit(1)).alias("_np"))
    n_queries = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("_nq"))
    per_piece = F.lit(piece_rows) if isinstance(piece_rows, int) else piece_rows
    pieces = n_points.join(n_queries, "cell").select(
        "cell",
        F.ceil(F.col("_np") / per_piece).cast("int").alias("_pp"),
        F.ceil(F.col("_nq") / per_piece).cast("int").alias("_qp"),
    )
    bounded = "bound" in visits.columns
    left = visits.join(pieces, "cell").select(
        "qid", "_key", F.col("v").cast(f"array<{number}>").alias("v"), "cell", *(["bound"] if bounded else []),
        F.pmod(F.xxhash64("qid"), F.col("_qp")).cast("int").alias("_q"),
        F.explode(F.sequence(F.lit(0), F.col("_pp") - 1)).alias("_p"),
    )
    right = points.join(pieces, "cell").select(
        F.col("rep").alias("prep"), F.col("v").cast(f"array<{number}>").alias("pv"), F.col("cell").alias("pcell"),
        F.pmod(F.xxhash64("rep"), F.col("_pp")).cast("int").alias("_pn"),
        F.explode(F.sequence(F.lit(0), F.col("_qp") - 1)).alias("_qn"),
    )

    def block(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(p) == 0:
            return pd.DataFrame({"qid": [], "_key": [], "rep": [], "dist": []})
        points, reps, parts = np.stack(p["pv"].to_numpy()).astype(float), p["prep"].to_numpy(), []
        for start in range(0, len(q), PIECE_ROWS):
            some = q.iloc[start : start + PIECE_ROWS]
            limit = some["bound"].to_numpy(dtype=float) if bounded else None
            r, c, d = nearest_in_block(np.stack(some["v"].to_numpy()).astype(float), points, m, limit)
            found = pd.DataFrame({"qid": some["qid"].to_numpy()[r], "_key": some["_key"].to_numpy()[r], "rep": reps[c], "dist": d})
            parts.append(found.sort_values(["qid", "dist", "rep"]).groupby("qid", sort=False).head(m))
        return pd.concat(parts)

    grouped = left.groupBy("cell", "_p", "_q").cogroup(right.groupBy("pcell", "_pn", "_qn"))
    return grouped.applyInPandas(block, f"qid {id_type}, _key string, rep {id_type}, dist double")


def _best(found: DataFrame, m: int) -> DataFrame:
    w = Window.partitionBy("qid", "_key").orderBy("dist", "rep")
    return found.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= m).drop("_rn")


def _distinct_vectors(rows: DataFrame, m: int) -> DataFrame:
    """One row per distinct vector (and key) with its ``m`` smallest ids."""
    few = rows
    if m > 1000:
        # Beyond the size Spark limits before the shuffle, thin out hashed parts first.
        part = F.pmod(F.xxhash64("cell_id"), F.lit(256))
        w = Window.partitionBy("_key", "v", part).orderBy("cell_id")
        few = few.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= m).drop("_rn")
    w = Window.partitionBy("_key", "v").orderBy("cell_id")
    few = few.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= m)
    return few.groupBy("_key", "v").agg(
        F.min("cell_id").alias("rep"), F.sort_array(F.collect_list("cell_id")).alias("ids")
    )


def _search_regions(
    wanted: DataFrame, reps: DataFrame, per_key: DataFrame, most: int, m: int, id_type: str, block_rows: int, number: str
) -> DataFrame:
    """Two rounds over pivot regions: the surroundings, then whatever can still matter.

    Keys whose rows would be sent more often by the second round than to all blocks of
    their key are searched by blocks, within the distance that the first round found.
    """
    share = F.least(F.greatest(F.ceil(F.sqrt("n") / 4), F.lit(1)), F.lit(most)).cast("int")
    pool = join_keys(reps.select("rep", "v", "_key"), per_key.select("_key", share.alias("_want")), ["_key"])
    pivots = sample_exact(pool, "rep", F.col("_want"), 0, ["_key"]).select("_key", "rep", "v").toPandas()
    pivots = pivots.sort_values(["_key", "rep"]).reset_index(drop=True)
    pivots["cell"] = [f"p{i}" for i in range(len(pivots))]
    regions = Regions(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, part in pdf.groupby("_key", sort=False):
                region = regions.keys[key]
                step = max(1, ASSIGN_CELLS // len(region["cell"]))  # rows times pivots, bounded however many pivots there are
                for start in range(0, len(part), step):
                    rows = part.iloc[start : start + step]
                    dist = pivot_distances(np.stack(rows["v"].to_numpy()), region["v"])
                    home = dist.argmin(axis=1)
                    yield rows.assign(cell=region["cell"][home], radius=dist[np.arange(len(rows)), home])

    assigned = f"rep {id_type}, v array<double>, _key string, cell string, radius double"
    points = cut(reps.select("rep", "v", "_key").mapInPandas(assign, assigned), "regions")
    stats = points.groupBy("_key", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"))
    regions = regions.with_sizes(stats.toPandas())
    visit_type = f"qid {id_type}, _key string, v array<double>, cell string"
    asked = wanted.select("qid", "_key", "v")
    first = cut(asked.mapInPandas(_visits(regions, m, False), visit_type), "visits")
    near = cut(_best(_search(first, points, m, id_type, number=number), m), "near")
    bounds = near.groupBy("qid", "_key").agg(
        F.when(F.count(F.lit(1)) >= m, F.max("dist")).otherwise(float("inf")).alias("bound")
    )
    bounded = cut(asked.join(bounds, ["qid", "_key"]), "bounds")
    planned = bounded.mapInPandas(_visit_counts(regions, m), "_key string, asked long, visits long")
    wide = []
    for row in planned.groupBy("_key").agg(F.sum("asked").alias("asked"), F.sum("visits").alias("visits")).collect():
        n = regions.keys[row["_key"]]["n"].sum()
        rows = _block_rows(n, block_rows)
        if row["visits"] > row["asked"] * math.ceil(n / rows) + n * math.ceil(row["asked"] / rows):
            wide.append(row["_key"])
    if not wide:
        second = cut(bounded.mapInPandas(_visits(regions, m, True), visit_type), "visits")
        return near.unionByName(_search(second, points, m, id_type, number=number))
    apart = F.col("_key").isin(wide)
    second = cut(bounded.filter(~apart).mapInPandas(_visits(regions, m, True), visit_type), "visits")
    found = near.filter(~apart).unionByName(_search(second, points, m, id_type, number=number))
    whole = F.concat(F.lit("b"), "_key")
    rows = F.greatest(F.lit(min(PIECE_ROWS, block_rows)), F.least(F.lit(block_rows), F.ceil(F.col("_np") / KEY_BLOCKS)))
    blocks = _search(
        bounded.filter(apart).withColumn("cell", whole), points.filter(apart).withColumn("cell", whole), m, id_type, rows, number
    )
    return found.unionByName(blocks)


def _block_rows(n: float, most: int) -> int:
    """Rows of a block: a few blocks in every key, of bounded size."""
    return int(max(min(PIECE_ROWS, most), min(most, math.ceil(n / KEY_BLOCKS))))


def knn(
    emb: DataFrame,
    k: int,
    same: str | None = None,
    each: str | None = None,
    targets: DataFrame | None = None,
    vector: str = "v",
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """The ``k`` nearest other rows of each row: ``src, dst, dist, rank``.

    ``same`` limits neighbours to rows with an equal value of that column, ``each``
    asks for ``k`` neighbours from every value of it (column ``target_key``).
    ``targets`` searches another table.  Ties go to the smaller id.
    """
    lists = nearest_lists(emb, k, same, each, targets, vector, direct_rows)
    names = ["target_key"] if each else []
    ranked = lists.select("src", *names, F.posexplode("near").alias("_at", "_e"))
    return ranked.select(
        "src", *names, F.col("_e")["dst"].alias("dst"), F.col("_e")["dist"].alias("dist"), (F.col("_at") + 1).alias("rank")
    )


def nearest_lists(
    emb: DataFrame,
    k: int,
    same: str | None = None,
    each: str | None = None,
    targets: DataFrame | None = None,
    vector: str = "v",
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """The neighbours of ``knn`` as one row ``src, near`` per row, nearest first.

    ``near`` holds structs of ``dist`` and ``dst``; with ``each`` there is one row per value (``target_key``).
    """
    m = k + 1
    id_type = emb.schema["cell_id"].dataType.simpleString()
    source = emb if targets is None else targets
    column = same or each
    key_of = quoted(column).cast("string") if column else F.lit("")
    vec = quoted(vector).cast("array<double>").alias("v")
    rows = source.select("cell_id", vec, key_of.alias("_key")).filter(F.col("_key").isNotNull())
    reps = cut(_distinct_vectors(rows, m), "vectors")

    per_key = reps.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    asked = emb.select("cell_id", vec, (quoted(same).cast("string") if same else F.lit("")).alias("_key"))
    asked = asked.filter(F.col("_key").isNotNull())
    # Equal query vectors are searched once.
    if targets is None and not each:
        questions = reps.select(F.col("rep").alias("qid"), "_key", "v")
    else:
        questions = asked.groupBy("_key", "v").agg(F.min("cell_id").alias("qid")).select("qid", "_key", "v")
        questions = cut(questions, "questions")
    wanted = questions
    if each:
        names = [r[0] for r in per_key.select("_key").limit(MAX_PIVOTS + 1).collect()]
        if len(names) > MAX_PIVOTS:
            raise ValueError("too many target groups for neighbours from each group")
        wanted = questions.drop("_key").withColumn("_key", F.explode(F.array(*[F.lit(n) for n in names])))

    # The largest groups are split into regions around pivots; a small group is one
    # region that its key alone decides.
    large = per_key.filter(F.col("n") > direct_rows).orderBy(F.desc("n"), "_key").limit(MAX_SPLIT_KEYS).collect()
    split = F.col("_key").isin([r["_key"] for r in large]) if large else F.lit(False)
    whole = reps.filter(~split).select("rep", "v", F.concat(F.lit("k"), "_key").alias("cell"))
    direct = wanted.filter(~split).withColumn("cell", F.concat(F.lit("k"), "_key"))
    found = _search(direct, whole, m, id_type)
    if large:
        exact = F.forall("v", lambda e: e == e.cast("float").cast("double"))
        shape = [t.agg(F.max(F.size("v")).alias("width"), F.every(exact).alias("short")).first() for t in (reps, wanted)]
        width = max(1, *[s["width"] or 1 for s in shape])
        number = "float" if all(s["short"] for s in shape) else "double"  # half the size where nothing is lost
        block_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
        most = max(1, min(MAX_PIVOTS, MAX_PIVOT_BYTES // (8 * width)) // len(large))
        found = found.unionByName(
            _search_regions(wanted.filter(split), reps.filter(split), per_key, most, m, id_type, block_rows, number)
        )
    found = _best(found, m)

    # From distinct vectors back to rows: at most m ids per vector can matter.
    ids = reps.select(F.col("_key"), "rep", F.explode("ids").alias("dst"))
    wide = join_keys(found, ids, ["_key", "rep"])
    w = Window.partitionBy("qid", "_key").orderBy("dist", "dst")
    lists = (
        wide.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= m)
        .groupBy("qid", "_key")
        .agg(F.array_sort(F.collect_list(F.struct("dist", "dst"))).alias("near"))
    )
    if each:
        lists = lists.withColumnRenamed("_key", "target_key")
        by_vector = questions.drop("_key").join(lists, "qid")
        members = asked.drop("_key").join(by_vector.select("v", "target_key", "near"), "v")
    else:
        by_vector = join_keys(questions, lists, ["qid", "_key"])
        members = join_keys(asked, by_vector.select("v", "_key", "near"), ["v", "_key"])
    kept = F.col("near") if targets is not None else F.filter("near", lambda e: e["dst"] != F.col("cell_id"))
    return members.select(F.col("cell_id").alias("src"), *(["target_key"] if each else []), F.slice(kept, 1, k).alias("near"))


def pairwise_blocks(
    left: DataFrame, right: DataFrame, reduce_block, schema: str, key: str | None = None, block_rows: int = 2048, spread: bool = False
) -> DataFrame:
    """Apply a reducer to every pair of row blocks (of a key); only its result leaves a task.

    For quantities defined over all pairs (mean distances, distance matrices).  Rows
    are dealt to blocks by hash, so neither a frequent key nor a frequent value ends
    in one task.  The reducer gets two pandas frames.  With ``spread`` the block pairs keep
    to all shuffle partitions, however few bytes their rows have, for reducers that work long.
    """
    key_of = quoted(key).cast("string") if key else F.lit("")
    a, b = left.withColumn("_key", key_of), right.withColumn("_key", key_of)
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int")
    if key is None:
        counts = {"_na": a.agg(blocks).scalar(), "_nb": b.agg(blocks).scalar()}
        sized_a, sized_b = a.withColumns(counts), b.withColumns(counts)
    else:
        sizes = a.groupBy("_key").agg(blocks.alias("_na")).join(b.groupBy("_key").agg(blocks.alias("_nb")), "_key")
        sized_a, sized_b = join_keys(a, sizes, ["_key"]), join_keys(b, sizes, ["_key"])
    names_a = [F.col(c).alias(c) for c in left.columns]
    deal_a = sized_a.select(
        *names_a, F.col("_key").alias("_ka"), F.pmod(F.xxhash64("cell_id"), F.col("_na")).cast("int").alias("_ia"),
        F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_ja"),
    )
    deal_b = sized_b.select(
        *[F.col(c).alias(f"r_{c}") for c in right.columns], F.col("_key").alias("_kb"),
        F.pmod(F.xxhash64("cell_id"), F.col("_nb")).cast("int").alias("_jb"),
        F.explode(F.sequence(F.lit(0), F.col("_na") - 1)).alias("_ib"),
    )
    deal_a = deal_a.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], "_ka", "_ia", "_ja")
    if spread:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        deal_a, deal_b = deal_a.repartition(parts, "_ka", "_ia", "_ja"), deal_b.repartition(parts, "_kb", "_ib", "_jb")

    def call(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return reduce_block(
            p.rename(columns={f"l_{c}": c for c in left_names}), q.rename(columns={f"r_{c}": c for c in right_names})
        )

    left_names, right_names = list(left.columns), list(right.columns)
    return deal_a.groupBy("_ka", "_ia", "_ja").cogroup(deal_b.groupBy("_kb", "_ib", "_jb")).applyInPandas(call, schema)


def block_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between two blocks of rows, by one matrix product.

    Pairs that are close for their lengths lose digits that way and are done again by
    differences.
    """
    lengths = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)
    squares = lengths - 2 * (a @ b.T)
    close = np.argwhere(squares <= 1e-3 * lengths)
    out = np.sqrt(np.maximum(squares, 0))
    for at in range(0, len(close), 1 << 16):
        i, j = close[at : at + (1 << 16)].T
        gap = a[i] - b[j]
        out[i, j] = np.sqrt((gap * gap).sum(axis=1))
    return out


class EuclideanPairs(NamedTuple):
    """All pairs of the rows ``cell_id, v`` with their Euclidean distances, made in blocks where they are needed.

    Every row has an id of its own.
    """

    rows: DataFrame


def each_pair_once(rows: DataFrame, reduce_block, schema: str, block_rows: int) -> DataFrame:
    """Apply a reducer to every unordered pair of row blocks; only its result leaves a task.

    Rows ``cell_id, ...`` are dealt to blocks by hash and sent once to each pair that holds
    their block.  The reducer gets two pandas frames; for a block with itself it gets the
    frame and None.
    """
    n_blocks = rows.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int")).first()[0]
    own, other = F.col("_own"), F.col("_other")
    dealt = rows.withColumn("_own", F.pmod(F.xxhash64("cell_id"), F.lit(n_blocks)).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    pairs = dealt.withColumns({"_a": F.least(own, other), "_b": F.greatest(own, other)}).drop("_other")
    parts = min(n_blocks * (n_blocks + 1) // 2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = list(rows.columns)

    def call(both: pd.DataFrame) -> pd.DataFrame:
        first = both["_own"] == both["_a"]
        alone = both["_a"].iloc[0] == both["_b"].iloc[0]
        return reduce_block(both.loc[first, names], None if alone else both.loc[~first, names])

    return pairs.repartition(parts, "_a", "_b").groupBy("_a", "_b").applyInPandas(call, schema)
