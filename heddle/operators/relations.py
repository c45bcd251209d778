"""Relations of labels across datasets: equal, containing, contained and novel labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from heddle.functions.ordering import running_index
from heddle.functions.runtime import cut, drop_missing, quoted
from heddle.operators.graph import connected_components
from heddle.operators.samples import mean_vectors

#: Centroids that one row meets at a time.
BLOCK = 256

EQUAL, CONTAINS, CONTAINED = "=", "∋", "∈"


def _distance(v: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(v, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)


def _nearest(centroids: Column) -> Column:
    """The label of the nearest of an array of ``(label, v)``, the least one of a tie, with its squared distance."""
    return F.array_min(
        F.transform(centroids, lambda c: F.struct(_distance(F.col("v"), c["v"]).alias("d"), c["label"].alias("label")))
    )


def nearest_labels(rows: DataFrame, centroids: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """``rows`` (``v`` and more columns) with the nearest label of ``centroids`` (``run..., label, v``) as ``nearest``.

    Centroids are packed into arrays of ``BLOCK``, so one join with a small table meets a
    row with a whole array; only with more than one array per run are rows grouped again.
    With ``run``, a row meets the centroids of its own run only; rows of a run without
    centroids, and all rows if there are none, have no nearest label.
    """
    run = list(run)
    at = running_index(centroids, run, ["label"], "_at").withColumn("_block", F.floor((F.col("_at") - 1) / BLOCK))
    blocks = cut(
        at.groupBy(*run, "_block").agg(F.collect_list(F.struct("label", "v")).alias("_c")), "centroids"
    )
    counts = blocks.groupBy(*run).agg(F.max("_block").alias("_last"))
    most = blocks.agg(F.max("_block")).first()[0]
    if most is None:
        return rows.withColumn("nearest", F.lit(None).cast("string"))
    if most == 0:
        single = blocks.drop("_block")
        met = rows.join(single, run, "left") if run else rows.withColumn("_c", single.scalar())
        return met.withColumn("nearest", _nearest(F.col("_c"))["label"]).drop("_c")
    keyed = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    spread = keyed.join(counts, run, "left") if run else keyed.withColumn("_last", counts.scalar())
    spread = spread.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    best = spread.join(blocks, [*run, "_block"]).select("_row", _nearest(F.col("_c")).alias("_best"))
    least = best.groupBy("_row").agg(F.min("_best")["label"].alias("nearest"))
    return keyed.join(least, "_row", "left").drop("_row")


def assignment_shares(rows: DataFrame, label: str, nearest: str) -> DataFrame:
    """``label, nearest, n, share``: how the rows of a label spread over their nearest labels."""
    counts = drop_missing(rows, [label, nearest]).groupBy(quoted(label).alias("label"), quoted(nearest).alias("nearest"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("label").agg(F.sum("n").alias("_total"))
    return counts.join(totals, "label").select("label", "nearest", "n", (F.col("n") / F.col("_total")).alias("share"))


def star_cover(edges: DataFrame) -> DataFrame:
    """The edges ``a, b, weight`` of a two-sided graph that are left when no end needs another one.

    An edge is redundant while both ends have further edges.  In every round each edge goes
    that is the weakest redundant one at both of its ends (by weight, then ends), which takes
    at most one edge from an end; the result is that of dropping redundant edges one by one
    from the weakest, every end keeps an edge, and every component is a star.
    """
    left = cut(edges.select("a", "b", "weight"), "cover")
    while True:
        n_a = left.groupBy("a").agg(F.count(F.lit(1)).alias("_na"))
        n_b = left.groupBy("b").agg(F.count(F.lit(1)).alias("_nb"))
        sized = cut(left.join(n_a, "a").join(n_b, "b"), "cover")
        spare = sized.filter("_na > 1 AND _nb > 1").select("a", "b", F.struct("weight", "a", "b").alias("_o"))
        weak_a = spare.groupBy("a").agg(F.min("_o").alias("_wa"))
        weak_b = spare.groupBy("b").agg(F.min("_o").alias("_wb"))
        gone = spare.join(weak_a, "a").join(weak_b, "b").filter("_o = _wa AND _o = _wb").select("a", "b")
        seen = Observation()
        kept = sized.drop("_na", "_nb").join(gone.withColumn("_gone", F.lit(True)), ["a", "b"], "left")
        kept = cut(kept.observe(seen, F.bool_or("_gone").alias("gone")).filter("_gone IS NULL").drop("_gone"), "cover")
        if not seen.get["gone"]:
            return sized.select("a", "b", "weight", "_na", "_nb")
        left = kept


def relate(there: DataFrame, here: DataFrame, min_share: float = 0.4, max_novel: float = 0.05) -> DataFrame:
    """Relations ``a, b, forward, backward, symbol`` between the labels of two sets of rows (``label, v``).

    ``forward`` is the share of the rows of ``a`` nearest to the centroid of ``b`` among all
    labels of the other side, ``backward`` the share of the rows of ``b`` nearest to ``a``.
    Two labels can be related when the larger share is at least ``min_share`` and the smaller
    one above ``max_novel``.  Of these pairs a star cover (weighted by the sum of the shares)
    is kept: a pair alone is equal, the centre of several contains them.  A label in no pair
    is novel.
    """
    centre = lambda rows: mean_vectors(rows, "label").select("label", "v")
    forward = assignment_shares(nearest_labels(there, centre(here)), "label", "nearest")
    backward = assignment_shares(nearest_labels(here, centre(there)), "label", "nearest")
    forward = forward.select(F.col("label").alias("a"), F.col("nearest").alias("b"), F.col("share").alias("forward"))
    backward = backward.select(F.col("nearest").alias("a"), F.col("label").alias("b"), F.col("share").alias("backward"))
    pairs = cut(forward.join(backward, ["a", "b"]), "shares")
    likely = pairs.filter(
        (F.greatest("forward", "backward") >= min_share) & (F.least("forward", "backward") > max_novel)
    )
    cover = star_cover(likely.withColumn("weight", F.col("forward") + F.col("backward")))
    symbol = F.when(F.col("_na") > 1, CONTAINS).when(F.col("_nb") > 1, CONTAINED).otherwise(EQUAL)
    return cut(cover.select("a", "b", symbol.alias("symbol")).join(pairs, ["a", "b"]), "relations")


def _into_leaves(rows: DataFrame, pairs: DataFrame, centre: str, leaf: str, centroids: DataFrame) -> DataFrame:
    """Rows of each centre label with the nearest of its leaves as ``nearest``; other rows have none."""
    leaves = pairs.select(F.col(centre).alias("_centre"), F.col(leaf).alias("label")).join(centroids, "label")
    met = nearest_labels(rows.withColumn("_centre", F.col("label")), leaves, ["_centre"])
    return met.drop("_centre")


def harmonise_labels(
    emb: DataFrame, dataset: str, label: str, order: Sequence[str] | None = None, min_share: float = 0.4, max_novel: float = 0.05
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels of many datasets put in relation, one dataset after the other.

    The first dataset's labels are the first groups.  Every further dataset is related to the
    groups so far (``relate``).  Equal labels become one group.  Where a label contains
    several, each of these is a group and the rows of the containing label go to the nearest;
    so a row always lies in a group of the lowest level.  Novel labels are new groups.

    ``order`` names the datasets; without it, larger ones come first.  The driver holds the
    names of the datasets.  A step reads the rows of the datasets so far once.  Rows without
    dataset, label or vector are left out, and ``order`` may leave datasets out.  Returns

    * rows: ``cell_id, dataset, label, reannotation, reannotation_index, group``
    * groups: ``reannotation, reannotation_index, group, dataset, label, symbol, step``,
      one row per dataset that takes part (``symbol`` is empty for the first one)
    * relations of every step: ``step, dataset, a, b, forward, backward, symbol``
    """
    rows = drop_missing(emb, [dataset, label, "v"]).select(
        "cell_id", quoted(dataset).cast("string").alias("dataset"), quoted(label).cast("string").alias("_own"), "v"
    )
    rows = cut(rows, "rows")
    if order is None:
        sizes = rows.groupBy("dataset").count().orderBy(F.desc("count"), "dataset")
        order = [r["dataset"] for r in sizes.collect()]
    key = F.concat_ws(": ", "dataset", "_own")
    spark = emb.sparkSession
    done = rows.filter(F.lit(False)).withColumn("label", key)  # without datasets
    trail_type = "array<struct<dataset:string,label:string,symbol:string,step:int>>"
    trails = spark.createDataFrame([], f"label string, trail {trail_type}, title string")
    links = spark.createDataFrame([], "a string, b string")
    steps = spark.createDataFrame([], "step int, dataset string, a string, b string, forward double, backward double, symbol string")
    for step, name in enumerate(order):
        new = rows.filter(F.col("dataset") == name).withColumn("label", key)
        mark = lambda symbol: F.array(
            F.struct(F.lit(name).alias("dataset"), F.col("_own").alias("label"), symbol.cast("string").alias("symbol"), F.lit(step).alias("step"))
        )
        fresh = new.select("label", "_own").distinct()
        alone = lambda f: f.select("label", mark(F.lit(None)).cast(trail_type).alias("trail"), F.col("_own").alias("title"))
        if step == 0:
            done, trails = cut(new, "done"), cut(alone(fresh), "groups")
            continue
        found = relate(done, new, min_share, max_novel)
        steps = steps.unionByName(found.select(F.lit(step).alias("step"), F.lit(name).alias("dataset"), "a", "b", "forward", "backward", "symbol"))
        links = links.unionByName(found.select("a", "b"))
        # The group of a pair is named by both ends; its rows are those of the leaf and, of the centre, those nearest to it.
        pair = F.concat_ws(" | ", "a", "b")
        old_centres = mean_vectors(done, "label").select("label", "v")
        new_centres = mean_vectors(new, "label").select("label", "v")
        split_old = _into_leaves(done, found.filter(F.col("symbol") == CONTAINS), "a", "b", new_centres)
        split_new = _into_leaves(new, found.filter(F.col("symbol") == CONTAINED), "b", "a", old_centres)
        by_a = found.filter(F.col("symbol") != CONTAINS).select(F.col("a").alias("label"), F.col("b").alias("_to"))
        by_b = found.filter(F.col("symbol") != CONTAINED).select(F.col("b").alias("label"), F.col("a").alias("_to"))
        other = F.coalesce("nearest", "_to")
        old_rows = split_old.join(by_a, "label", "left").withColumn(
            "label", F.when(other.isNotNull(), F.concat_ws(" | ", "label", other)).otherwise(F.col("label"))
        )
        new_rows = split_new.join(by_b, "label", "left").withColumn(
            "label", F.when(other.isNotNull(), F.concat_ws(" | ", other, "label")).otherwise(F.col("label"))
        )
        done = cut(old_rows.drop("nearest", "_to").unionByName(new_rows.drop("nearest", "_to")), "done")
        joined = (
            found.join(trails.withColumnRenamed("label", "a"), "a")
            .join(fresh.withColumnRenamed("label", "b"), "b")
            .select(
                pair.alias("label"), F.concat("trail", mark(F.col("symbol")).cast(trail_type)).alias("trail"),
                F.concat_ws(" ", "title", "symbol", "_own").alias("title"),
            )
        )
        links = links.unionByName(found.select(F.col("a"), pair.alias("b")))
        old_alone = trails.join(found.select(F.col("a").alias("label")), "label", "left_anti")
        new_alone = fresh.join(found.select(F.col("b").alias("label")), "label", "left_anti")
        trails = cut(joined.unionByName(old_alone).unionByName(alone(new_alone)), "groups")
        links, steps = cut(links, "links"), cut(steps, "steps")
    nodes = trails.select(F.col("label").alias("node")).union(links.select("a")).union(links.select("b")).distinct()
    whole = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), nodes)
    numbered = running_index(trails, [], ["title", "label"], "_at").withColumn("reannotation_index", F.col("_at") - 1)
    named = cut(
        numbered.join(whole.withColumnRenamed("node", "label"), "label").select(
            "label", F.col("title").alias("reannotation"), "reannotation_index", F.col("component").alias("group"), "trail"
        ),
        "named",
    )
    labelled = done.join(named.drop("trail"), "label").select(
        "cell_id", "dataset", F.col("_own").alias("label"), "reannotation", "reannotation_index", "group"
    )
    groups = named.select("reannotation", "reannotation_index", "group", F.explode("trail").alias("_t")).select(
        "reannotation", "reannotation_index", "group", "_t.*"
    )
    return labelled, groups, steps
