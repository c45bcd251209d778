"""Concatenation and set operations on annotated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions.ordering import running_index
from heddle.functions.runtime import quoted
from heddle.operators.obs import force_schema
from heddle.sources.table import AnnotatedTable


def shared_features(matrices: Sequence[DataFrame]) -> DataFrame:
    """Features that occur in every matrix."""
    return reduce(DataFrame.intersect, [m.select("gene_id") for m in matrices])


def tagged_obs(tables: Mapping[str, AnnotatedTable]) -> list[DataFrame]:
    return [
        t["obs"].withColumns({"file_id": F.lit(name), "cell_id": F.concat_ws("--", F.lit(name), F.col("cell_id").cast("string"))})
        for name, t in tables.items()
    ]


def concat_tables(
    tables: Mapping[str, AnnotatedTable], how: str = "inner", columns: Sequence[str] | None = None
) -> AnnotatedTable:
    """Stack datasets.

    ``how`` decides on features and on observation columns: the shared ones or all
    of them (absent values are NULL, absent matrix entries are zero).  Ids are
    prefixed with the dataset name so that they stay unique.
    """
    filled = {n: t for n, t in tables.items() if not t["obs"].isEmpty()}
    if not filled:
        return next(iter(tables.values()))
    if len(filled) == 1:
        return next(iter(filled.values()))
    observations = tagged_obs(filled)
    if columns is not None:
        observations = [force_schema(o, ["cell_id", "file_id", *columns]) for o in observations]
    elif how == "inner":
        shared = [c for c in observations[0].columns if all(c in o.columns for o in observations)]
        observations = [o.select(*[quoted(c) for c in shared]) for o in observations]
    obs = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), observations)
    matrices = [
        t["X"].withColumn("cell_id", F.concat_ws("--", F.lit(name), F.col("cell_id").cast("string")))
        for name, t in filled.items()
    ]
    x = reduce(DataFrame.unionByName, matrices)
    features = [t["var"].select("gene_id") for t in filled.values()]
    if how == "inner":
        kept = reduce(DataFrame.intersect, features)
        x = x.join(kept, "gene_id", "left_semi")
    else:
        kept = reduce(DataFrame.union, features).distinct()
    return AnnotatedTable({"obs": obs, "X": x, "var": kept})


def renumber(obs: DataFrame, dataset: str, order: str = "cell_id") -> DataFrame:
    """New ids ``<dataset>-<n>`` in id order; the old id is kept."""
    old = f"obs_names_before_{dataset}"
    numbered = running_index(obs.withColumn(old, quoted(order)), [], [order], "_at")
    return numbered.withColumn(
        order, F.concat(F.lit(f"{dataset}-"), (F.col("_at") - 1).cast("string"))
    ).drop("_at")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack result tables; columns missing in one of them are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def value_union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()
