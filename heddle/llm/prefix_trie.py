"""A prefix trie over conversations, with subtree totals by parallel tree contraction.

Conversations are rebuilt first (``rebuilt``): the opening turns of a shared conversation,
then the own turns.  The turns before and at each place are named by 128 bits, an exclusive
or over hashes of (place, turn), so equal names are one node (``trie``); texts are read once
and never moved.  Each node follows its longest conversation, so a node and its only child
lie on one such path.

Totals over subtrees take no walk along the depth:

1. ``chains`` contracts the unary chains of the trie along their paths, in blocks.
2. Rounds of joins alternate *rake*, in which all leaves give their totals to their
   parents, and *compress*, in which nodes with one child left step out between parent and
   child when their hash beats both neighbours' (``contract``).  A constant share of any
   shape goes per round, so the rounds grow with the logarithm of the nodes.
3. ``expand`` puts the nodes that stepped out back in reverse: the total of such a node is that of
   the node that took its place, plus what lies between.

No group of rows is gathered: hot parents and nodes are partial sums, a parent with very
many children is joined apart, and turns are numbered in range slices.  The digest of the
ids that end at a node is sequential by definition; one task streams the sorted ids of a
node through it in batches.

Defined cases: rows without ``conv_id`` belong to no conversation; a NULL role or text is
empty; turns of one number are ordered by role and a hash of the text, a NULL number is
first, and repeated rows are turns of their own; a conversation that is rebuilt without
turns is a member of the root alone; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from heddle.functions.ordering import running_index
from heddle.functions.runtime import cut, quoted

#: Every ``FAMILY`` consecutive ids open with turns of the first of them, fewer than ``OPENING``.
FAMILY = 5
OPENING = 9
#: Places of one block, in running names and in chains.
BLOCK = 4096
#: Parents with more children than this are joined apart.
WIDE = 100_000
_SUMS = ("leaves", "saved")


def turns(conversations: DataFrame) -> DataFrame:
    """Numbered turns: ``conv, pos`` (from 1), the turn's hashes ``a`` and ``b``, and its ``bytes``."""
    role, text = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(quoted("conv_id").isNotNull()).select(
        quoted("conv_id").cast("long").alias("conv"), quoted("turn").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("b"), text, role).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return running_index(rows, ["conv"], ["turn", "role", "a", "b"], "pos").select("conv", "pos", "a", "b", "bytes")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (``conv, depth, a, b, bytes, size``), and all conversations (``conv, size``)."""
    opening = F.crc32(F.col("conv").cast("string")) % OPENING
    sizes = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    base = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    convs = sizes.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).withColumn("h", opening).join(base, "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.withColumn("taken", taken).withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = cut(convs.select("conv", "base", "h", "taken", "size"), "conversations")
    first = numbered.filter((F.col("pos") < OPENING) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "base")
    heads = convs.join(first, "base").filter("pos <= h").withColumnRenamed("pos", "depth")
    own = numbered.withColumn("h", opening).filter("pos > h").drop("h").join(convs, "conv")
    own = own.withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    names = ["conv", "depth", "a", "b", "bytes", "size"]
    return heads.select(*names).unionByName(own.select(*names)), convs.select("conv", "size")


def prefixes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Per conversation and depth the name of its prefix (``p``, ``q``) and of the one before (``up_p``, ``up_q``)."""
    parts = {c: F.xxhash64("depth", c) for c in ("a", "b")}
    marked = rows.withColumns(parts).withColumn("block", F.expr(f"depth div {BLOCK}"))
    totals = marked.groupBy("conv", "block").agg(*[F.bit_xor(c).alias(f"_{c}") for c in parts])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv", "block", *[F.bit_xor(f"_{c}").over(earlier).alias(f"_{c}") for c in parts]).filter("block > 0")
    upto = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    named = marked.withColumns({f"in_{c}": F.bit_xor(c).over(upto) for c in parts}).join(offsets, ["conv", "block"], "left")
    whole = {c: F.col(f"in_{c}").bitwiseXOR(F.coalesce(f"_{c}", F.lit(0).cast("long"))) for c in parts}
    out = named.select(
        "conv", "size", "depth", "bytes", whole["a"].alias("p"), whole["b"].alias("q"),
        whole["a"].bitwiseXOR(F.col("a")).alias("up_p"), whole["b"].bitwiseXOR(F.col("b")).alias("up_q"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv", "size", zero.alias("depth"), zero.alias("bytes"), zero.alias("p"), zero.alias("q"), none.alias("up_p"), none.alias("up_q"))
    return out.unionByName(root)


def ends(prefix: DataFrame) -> DataFrame:
    """Per prefix at which conversations end: SHA-256 of their ids, ascending and comma-joined."""
    key = ["depth", "p", "q"]
    last = prefix.filter("depth = size").select(*key, "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest = None, None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
            bounds = [0, *new.tolist(), batch.num_rows] if batch.num_rows else [0]
            done = []
            for a, b in zip(bounds, bounds[1:]):
                here, ids = tuple(int(c[a]) for c in columns[:3]), ",".join(map(str, columns[3][a:b].tolist()))
                if here == open_key:
                    digest.update(b"," + ids.encode())
                    continue
                if open_key is not None:
                    done.append((*open_key, digest.hexdigest()))
                open_key, digest = here, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*key, "ends_sha256"])
        if open_key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*open_key, digest.hexdigest())], [*key, "ends_sha256"])

    sorted_ids = last.repartition(*key).sortWithinPartitions(*key, "conv")
    return sorted_ids.mapInArrow(run, "depth long, p long, q long, ends_sha256 string")


def trie(prefix: DataFrame) -> DataFrame:
    """Nodes: key (``path``, ``depth``), ``conv_id``, parent (``up_path``, ``parent_conv_id``), counts and digest.

    ``path`` is the longest member (of equal ones the least), which names a node of a depth.
    """
    key = ["depth", "p", "q"]
    longest = F.max(F.struct("size", (-F.col("conv")).alias("conv")))
    nodes = prefix.groupBy(*key).agg(
        F.min("conv").alias("conv_id"), (-longest["conv"]).alias("path"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("up_p").alias("up_p"), F.max("up_q").alias("up_q"),
    )
    nodes = cut(nodes.join(ends(prefix), key, "left"), "nodes")
    below = nodes.filter("up_p IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_p").alias("p"), F.col("up_q").alias("q"))
    nodes = cut(nodes.join(below.agg(F.count(F.lit(1)).alias("n_children")), key, "left").fillna(0, ["n_children"]), "nodes")
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p").alias("up_p"), F.col("q").alias("up_q"),
        F.col("path").alias("up_path"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_kids"),
    )
    on = ["depth", "up_p", "up_q"]
    wide = parents.filter(F.col("_kids") > WIDE)
    met = [nodes.join(some, on) for some in ([parents] if wide.isEmpty() else [parents.filter(F.col("_kids") <= WIDE), wide])]
    root = nodes.filter("up_p IS NULL").withColumns({"up_path": F.lit(None).cast("long"), "parent_conv_id": F.lit(None).cast("long")})
    out = ["path", "depth", "up_path", "conv_id", "parent_conv_id", "n_convs", "n_children", "bytes", "ends_sha256"]
    for some in met:
        root = root.select(*out).unionByName(some.select(*out))
    return root


def _rank(path: Column, depth: Column) -> Column:
    return F.xxhash64(path, depth)


def chains(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree without nodes whose only child is on their path, and those nodes with their offsets.

    ``tree``: ``path, depth, up_path, up_depth, kids`` and the own value of each sum.  What
    stays also has ``up_<sum>``, the sum over the nodes that stepped out above it.
    """
    block = ["path", "_block"]
    placed = tree.withColumn("_block", F.expr(f"depth div {BLOCK}"))
    up = Window.partitionBy(*block).orderBy(F.desc("depth"))
    stays = (F.col("kids") != 1) | F.col("up_path").isNull() | (F.row_number().over(up) == 1)
    run = placed.withColumn("_stays", stays).withColumn("_run", F.sum(F.col("_stays").cast("int")).over(up))
    within = Window.partitionBy(*block, "_run")
    rising = within.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    last = {f"_end_{s}": F.max(F.when(F.col("_stays"), F.col(s))).over(within) for s in _SUMS}
    run = run.withColumns({
        **{f"_upto_{s}": F.sum(s).over(rising) for s in _SUMS}, **{f"_all_{s}": F.sum(s).over(within) for s in _SUMS}, **last,
        "_end": F.max("depth").over(within), "_top": F.min(F.struct("depth", "up_path", "up_depth")).over(within),
    })
    written = cut(run, "chains")
    kept = written.filter("_stays").select(
        "path", "depth", F.col("_top")["up_path"].alias("up_path"), F.col("_top")["up_depth"].alias("up_depth"), "kids",
        *_SUMS, *[(F.col(f"_all_{s}") - F.col(s)).alias(f"up_{s}") for s in _SUMS],
    )
    gone = written.filter("NOT _stays").select(
        "path", "depth", F.col("path").alias("to_path"), F.col("_end").alias("to_depth"),
        *[(F.col(f"_upto_{s}") - F.col(f"_end_{s}")).alias(f"off_{s}") for s in _SUMS],
    )
    return kept, gone


def contract(state: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """One round: totals of the leaves, nodes that stepped out, what stays, and whether anything does."""
    node, above = ["path", "depth"], ["up_path", "up_depth"]
    leaf = F.col("kids") == 0
    raked = state.filter(leaf).select(*node, *_SUMS)
    given = state.filter("up_path IS NOT NULL").groupBy(*[F.col(u).alias(n) for u, n in zip(above, node)]).agg(
        *[F.sum(F.when(leaf, F.col(s) + F.col(f"up_{s}")).otherwise(0)).alias(f"_{s}") for s in _SUMS],
        F.count(F.when(~leaf, 1)).alias("_left"), F.min(F.when(~leaf, F.struct(*node))).alias("_kid"),
    )
    rank = _rank(F.col("path"), F.col("depth"))
    beats = (rank > _rank(*[F.col(c) for c in above])) & (rank > _rank(F.col("_kid")["path"], F.col("_kid")["depth"]))
    seen = Observation()
    rest = state.filter(~leaf).join(given, node).select(
        *node, *above, F.col("_left").alias("kids"), *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in _SUMS],
        *[f"up_{s}" for s in _SUMS],
        ((F.col("_left") == 1) & F.col("up_path").isNotNull() & F.coalesce(beats, F.lit(False))).alias("out"),
    ).observe(seen, F.count(F.lit(1)).alias("n"))
    rest = cut(rest, "raked")
    if not seen.get["n"]:
        return raked, rest, rest, False
    out = rest.filter("out").select(
        *[F.col(n).alias(u) for n, u in zip(node, above)], *[F.col(u).alias(f"_{u}") for u in above],
        *[F.col(c).alias(f"_{c}") for s in _SUMS for c in (s, f"up_{s}")], F.lit(True).alias("_met"),
    )
    joined = cut(rest.filter("NOT out").drop("out").join(out, above, "left"), "compressed")
    met = F.col("_met").isNotNull()
    new = joined.select(
        *node, *[F.when(met, F.col(f"_{u}")).otherwise(F.col(u)).alias(u) for u in above], "kids", *_SUMS,
        *[(F.col(f"up_{s}") + F.when(met, F.col(f"_{s}") + F.col(f"_up_{s}")).otherwise(0)).alias(f"up_{s}") for s in _SUMS],
    )
    gone = joined.filter(met).select(
        *[F.col(u).alias(n) for u, n in zip(above, node)], *[F.col(n).alias(f"to_{n}") for n in node],
        *[(F.col(f"up_{s}") + F.col(f"_{s}")).alias(f"off_{s}") for s in _SUMS],
    )
    return raked, gone, new, True


def expand(known: DataFrame, gone: DataFrame) -> DataFrame:
    """Totals of nodes that stepped out, from those of the nodes that took their place."""
    there = known.select(F.col("path").alias("to_path"), F.col("depth").alias("to_depth"), *_SUMS)
    return gone.join(there, ["to_path", "to_depth"]).select(
        "path", "depth", *[(F.col(s) + F.col(f"off_{s}")).alias(s) for s in _SUMS]
    )


def subtree_totals(tree: DataFrame) -> DataFrame:
    """Sums over the subtree of each node; ``tree`` as ``chains`` takes it."""
    state, first = chains(tree)
    raked, gone, is_open = [], [first], True
    while is_open:
        leaves, out, state, is_open = contract(state)
        raked.append(leaves)
        if is_open:
            gone.append(out)
    known = raked.pop()
    while gone:
        # nodes that stepped out in a round hang on nodes of later rounds
        back = cut(expand(known, gone.pop()), "expanded")
        known = known.unionByName(back)
        if raked:
            known = known.unionByName(raked.pop())
    return known


def build(conversations: DataFrame) -> DataFrame:
    """The trie's nodes with the totals of their subtrees."""
    rows, convs = rebuilt(cut(turns(conversations), "turns"))
    nodes = cut(trie(cut(prefixes(rows, convs), "prefixes")), "trie")
    tree = nodes.select(
        "path", "depth", "up_path", F.when(F.col("up_path").isNotNull(), F.col("depth") - 1).alias("up_depth"), F.col("n_children").alias("kids"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    return nodes.join(subtree_totals(tree), ["path", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
