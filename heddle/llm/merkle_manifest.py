"""A Merkle manifest of a table: per source a tree over its rows by id, and a tree over the sources.

The place of a row among the rows of its source is not found by sorting them:

1. Ids become bits of 64-bit words, merged per source (``words``).  Only words that hold a
   row are kept, so a sparse source costs no more than its rows.
2. ``directory`` counts the rows before every word in two steps: running sums over
   buckets of 1024 words, and windows within a bucket.
3. The rank of a row is the count before its word plus the set bits below its own
   (``placed``).  Rank ``r`` is slot ``r % 16`` of run ``r // 16``.
4. ``climb`` fills keyed arrays of 16 slots and hashes them, level by level, until every
   source has one node; a second tree of the same kind stands on the sources.
5. ``descend`` hands the siblings of every run from the top down, once per 16 rows.

All steps are joins and partial aggregates on (source, word) or (source, run), so a source
that holds most rows is spread like any other.

Defined cases: rows of one (source, id) are ordered by their leaf; a NULL id is before all
others of its source, a NULL source before all other sources; equal rows have equal leaves
and keep their number; a NULL value is ``-`` in a leaf, an empty one ``0:``; a source with
one row has its leaf as ``subroot``, a table with one source that subroot as ``root``; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.ordering import prefix_sums, running_index
from heddle.functions.runtime import cut, quoted

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node; a power of two.
FAN = 16
_SHIFT = FAN.bit_length() - 1
#: Words of one bucket of the directory.
BUCKET_BITS = 10
#: Word of rows without an id; below those of all 64-bit ids.
_NO_ID = -(1 << 62)
#: Equal rows that one step of their numbering makes at once.
REPEATS = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(parts: Sequence[Column]) -> Column:
    """Hex SHA-256 of length-prefixed values; NULL is ``-``."""
    field = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[field(p.cast("string")) for p in parts]), 256)


def leaves(docs: DataFrame, forged: Column | None = None, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Per row ``src`` (a key that orders like the source), ``doc_id``, ``leaf`` and ``forged``.

    ``forged`` is the leaf of the row with its A-Z lower-cased where the condition holds, NULL elsewhere.
    """
    key, source, *rest = [quoted(c) for c in columns]
    tampered = [*rest[:-1], F.translate(rest[-1].cast("string"), _UPPER, _LOWER)]
    other = F.lit(None).cast("string") if forged is None else F.when(forged, hashed([key, source, *tampered]))
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")).alias("src"),
        key.cast("long").alias("doc_id"), hashed([key, source, *rest]).alias("leaf"), other.alias("forged"),
    )


def _word(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, 6), F.lit(_NO_ID))


def _bit(doc_id: Column) -> Column:
    return doc_id.bitwiseAND(63).cast("int")


def words(rows: DataFrame) -> DataFrame:
    """Bitmaps of the ids per source: ``src, word, bits, held``; ``held`` exceeds the set bits where ids repeat."""
    bit = F.expr("shiftleft(1L, CAST(doc_id & 63 AS INT))")
    return rows.groupBy("src", _word(F.col("doc_id")).alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("held")
    )


def directory(bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with the rows of the source before each word (``base``) and in all (``n``)."""
    marked = bitmaps.withColumn("bucket", F.shiftright("word", BUCKET_BITS))
    buckets = marked.groupBy("src", "bucket").agg(F.sum("held").alias("_in"))
    upto = prefix_sums(buckets, ["src"], ["bucket"], {"_upto": "_in"})
    sizes = bitmaps.groupBy("src").agg(F.sum("held").alias("n"))
    starts = upto.join(sizes, "src").select("src", "bucket", (F.col("_upto") - F.col("_in")).alias("_start"), "n")
    before = Window.partitionBy("src", "bucket").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    within = marked.withColumn("_before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    return within.join(starts, ["src", "bucket"]).select(
        "src", "word", "bits", "held", (F.col("_start") + F.col("_before")).alias("base"), "n"
    )


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``idx``, the rank within the source from 0, and ``n``, the rows of the source."""
    bitmaps = cut(words(rows), "bitmaps")
    single = F.coalesce(F.col("held") == F.bit_count("bits"), F.lit(False))
    known = cut(directory(bitmaps), "directory")
    found = rows.withColumn("word", _word(F.col("doc_id"))).join(known, ["src", "word"])
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, CAST(doc_id & 63 AS INT))"))
    out = found.filter(single).select("src", "n", (F.col("base") + below).alias("idx"), "doc_id", F.col("leaf").alias("digest"), "forged")
    if bitmaps.filter(~single).isEmpty():
        return out
    # ids that repeat, or none: equal rows are counted, and the leaf decides
    keys = ["src", "word"]
    equal = found.filter(~single).groupBy(*keys, "doc_id", "leaf").agg(
        F.max("forged").alias("forged"), F.max("base").alias("base"), F.max("n").alias("n"), F.count(F.lit(1)).alias("_m")
    )
    ranked = prefix_sums(equal, keys, ["doc_id", "leaf"], {"_upto": "_m"})
    first = F.col("base") + F.col("_upto") - F.col("_m")
    blocks = ranked.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_m - 1) div {REPEATS})")))
    each = blocks.withColumn("_i", F.explode(F.expr(f"sequence(_block * {REPEATS}, least(_m, (_block + 1) * {REPEATS}) - 1)")))
    return out.unionByName(each.select("src", "n", (first + F.col("_i")).alias("idx"), "doc_id", F.col("leaf").alias("digest"), "forged"))


def gather(nodes: DataFrame, key: str) -> DataFrame:
    """Runs of ``FAN`` consecutive nodes of a tree: ``key, n, run, slots, digest``.

    Every node goes to its slot by number.  The only node of a tree is no run: its digest stays.
    """
    rest = F.struct(*[quoted(c) for c in nodes.columns if c not in (key, "n", "idx")])
    slot = F.col("idx").bitwiseAND(FAN - 1).cast("int")
    kept = nodes.groupBy(key, "n", F.shiftright("idx", _SHIFT).alias("run")).agg(
        F.map_from_entries(F.collect_list(F.struct(slot, rest))).alias("_kept")
    )
    slots = F.expr("transform(sequence(0, size(_kept) - 1), s -> element_at(_kept, s))")
    digests = F.expr("array_join(transform(slots, s -> s.digest), '')")
    return kept.select(key, "n", "run", slots.alias("slots")).withColumn(
        "digest", F.when(F.col("n") == 1, F.col("slots")[0]["digest"]).otherwise(F.sha2(digests, 256))
    )


def climb(nodes: DataFrame, key: str) -> list[DataFrame]:
    """The runs of every level, from the given nodes up, until no tree has several nodes."""
    levels = [cut(gather(nodes, key), "runs")]
    while True:
        runs = F.shiftright(F.col("n") + (FAN - 1), _SHIFT)
        up = levels[-1].select(key, runs.alias("n"), F.col("run").alias("idx"), "digest").filter("n > 1")
        if up.isEmpty():
            return levels
        levels.append(cut(gather(up, key), "runs"))


def tops(levels: Sequence[DataFrame], key: str) -> DataFrame:
    """The last node of every tree: ``key, digest``."""
    last = [level.filter(F.col("n") <= FAN).select(key, "digest") for level in levels]
    out = last[0]
    for other in last[1:]:
        out = out.unionByName(other)
    return out


def _siblings(slot: Column) -> Column:
    """The digests left and right of a slot of ``slots``, joined."""
    joined = lambda part: F.array_join(F.transform(part, lambda s: s["digest"]), "")
    return F.struct(
        joined(F.slice("slots", 1, slot)).alias("left"), joined(F.slice("slots", slot + 2, F.lit(FAN))).alias("right")
    )


def descend(levels: Sequence[DataFrame], key: str, above: DataFrame) -> DataFrame:
    """The first nodes again, each with ``path``: its siblings level by level to the root.

    ``above`` holds per tree its ``path`` from its last node on, and what else each node shall carry.
    """
    carried = [c for c in above.columns if c not in (key, "path")]
    higher = None
    for level in reversed(levels):
        done = level.filter(F.col("n") <= FAN).join(above, key)
        if higher is not None:
            parent = F.shiftright("run", _SHIFT)
            own = level.filter(F.col("n") > FAN).withColumn("_up", parent)
            upper = higher.select(key, F.col("run").alias("_up"), F.col("slots").alias("_slots"), "path", *carried)
            met = own.join(upper, [key, "_up"]).withColumnsRenamed({"slots": "_own", "_slots": "slots"})
            slot = F.col("run").bitwiseAND(FAN - 1).cast("int")
            met = met.withColumn("path", F.concat(F.array(_siblings(slot)), "path")).drop("slots", "_up")
            done = done.unionByName(met.withColumnRenamed("_own", "slots"))
        higher = done
    spread = higher.select("*", F.posexplode("slots").alias("_at", "_node"))
    longer = F.concat(F.array(_siblings(F.col("_at"))), "path")
    return spread.select(key, "_node.*", F.when(F.col("n") == 1, F.col("path")).otherwise(longer).alias("path"), *carried)


def manifest(docs: DataFrame, forged: Column | None = None, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``forged`` marks rows whose proof is tried with a tampered text.
    """
    rows = cut(leaves(docs, forged, columns), "leaves")
    levels = climb(placed(rows), "src")
    subroots = cut(tops(levels, "src"), "subroots")
    # the tree over the sources
    numbered = running_index(subroots, [], ["src"], "_at")
    size = F.lit(subroots.count()).cast("long").alias("n")
    sources = climb(numbered.select(F.lit(0).alias("tree"), size, (F.col("_at") - 1).alias("idx"), "src", "digest"), "tree")
    start = tops(sources, "tree").select(
        "tree", F.col("digest").alias("root"),
        F.array().cast("array<struct<left:string,right:string>>").alias("path"),
    )
    above = descend(sources, "tree", start).select("src", "path", F.col("digest").alias("subroot"), "root")
    proven = descend(levels, "src", cut(above, "sources"))
    listed = F.expr("array_join(flatten(transform(path, p -> array(p.left, p.right))), '')")
    folded = F.expr("aggregate(path, coalesce(forged, digest), (acc, p) -> sha2(concat(p.left, acc, p.right), 256))")
    return proven.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(listed, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
