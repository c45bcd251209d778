"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies.  The documents
are ordered by size, the expected copies are prefix-summed, one random offset per
source is added, and a document is emitted once for every integer boundary that its
interval crosses.  Because neighbours have similar sizes, the words taken from a source
differ from its target by about the size of one document.  Only DataFrame functions are
used; ranks come from sorted slices, so a source may hold most of the rows.

Defined cases: a NULL text has size 0; NULL is a source of its own and comes last;
sources without words get target 0; repeated rows are sampled one by one; rows that
agree in source, size, id and text are interchangeable; an empty table gives an empty
mix; other columns are carried along by ``emit`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.ordering import prefix_sums, running_index
from heddle.functions.runtime import cut, join_keys, quoted
from heddle.llm.common import WORD

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
SEED = 20


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    text = F.coalesce(quoted(text_col), F.lit(""))
    return docs.select(
        quoted(id_col).alias("doc_id"),
        quoted(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(quoted(text_col)).alias("text_key"),
    )


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = SEED
) -> DataFrame:
    """Per source: its size, its target in words, and its offset in [0, 1).

    Sources in code point order, NULL last, weigh ``weights`` in turn.  A source is
    capped at ``limit`` times its size if its cap per weight is below the level that
    is left for it and the sources with larger caps per weight.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull())
    placed = running_index(per_source, [], ["_last", "source"], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    weighed = placed.withColumn("_weight", weight).withColumn("_cap", F.lit(float(limit)) * F.col("source_size"))
    weighed = weighed.withColumn("_level", F.col("_cap") / F.col("_weight"))
    summed = prefix_sums(weighed, [], ["_level", "_place"], {"_caps": "_cap", "_weights": "_weight"})
    alls = weighed.agg(F.sum("_cap").alias("caps"), F.sum("_weight").alias("weights"), F.sum("source_size").alias("words"))
    words, heavy = alls.select("words").scalar(), alls.select("weights").scalar()
    budget = F.lit(float(share)) * words
    left = (budget - (F.col("_caps") - F.col("_cap"))) / (heavy - (F.col("_weights") - F.col("_weight")))
    capped = cut(summed.withColumn("_capped", F.col("_level") < left), "capped")
    over = capped.filter("_capped").agg(
        F.coalesce(F.sum("_cap"), F.lit(0.0)).alias("caps"), F.coalesce(F.sum("_weight"), F.lit(0.0)).alias("weights")
    )
    level = (budget - over.select("caps").scalar()) / (heavy - over.select("weights").scalar())
    named = F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")), F.when(F.col("_last"), "|").otherwise(""))
    return capped.select(
        "source", "source_size",
        F.when(F.col("_capped"), F.col("_cap")).otherwise(level * F.col("_weight")).alias("target"),
        (F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)).alias("_offset"),
    )


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document: ``size``, its source's ``source_size`` and ``target``, ``copies`` and ``taken`` words."""
    sized = cut(sizes(docs, id_col, text_col, source_col), "sizes")
    ranked = running_index(sized, ["source"], ["size", "doc_id", "text_key"], "_rank")
    joined = join_keys(ranked, targets(sized, weights, share, limit, seed), ["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = F.floor(F.col("_rank") * rate + F.col("_offset"))
    before = F.floor((F.col("_rank") - 1) * rate + F.col("_offset"))
    copies = F.least(upto - before, F.lit(int(limit)).cast("long"))
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emit(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: every row of ``docs`` once per copy."""
    keys = ["doc_id", "source", "text_key"]
    counts = mixed.groupBy(*keys).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    packed = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), quoted(id_col).alias("doc_id"),
        quoted(source_col).cast("string").alias("source"), F.xxhash64(quoted(text_col)).alias("text_key"),
    )
    joined = join_keys(packed, counts.filter("_copies > 0"), keys)
    alone = joined.filter("_rows = 1").select("_row", "_copies")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("text_key"))
    twins = joined.filter("_rows > 1").withColumn("_place", place).select(
        "_row",
        (F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_place") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)).alias("_copies"),
    )
    return (
        alone.unionByName(twins).filter("_copies > 0")
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).select("_row.*")
    )
