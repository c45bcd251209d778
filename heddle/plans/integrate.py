"""Preprocessing chain and named correction methods."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from heddle.functions.runtime import cut
from heddle.operators import correct as co, matrix as mx
from heddle.operators.aggregate import detected_features
from heddle.operators.graph import connectivities, neighbors
from heddle.operators.joins import join_many
from heddle.plans.evaluate import with_neighbors
from heddle.sources.table import AnnotatedTable


def preprocess(table: AnnotatedTable, n_top: int = 2000, n_comps: int = 50, batch: str | None = None, n_neighbors: int = 15) -> AnnotatedTable:
    """Normalise, mark detected and variable features, components and graph.

    An empty table passes through with the same slots.
    """
    norm = cut(mx.log1p(mx.normalize_total(table["X"])), "norm")
    found = detected_features(norm, table["var"])
    stats = mx.highly_variable(norm, table["obs"], table["var"], n_top=n_top, batch=batch)
    var = table["var"].join(found, "gene_id").join(stats.select("gene_id", "highly_variable"), "gene_id", "left")
    var = cut(var.withColumn("highly_variable", F.coalesce("highly_variable", F.lit(False))), "var")
    scores, loadings, variance = mx.matrix_pca(norm, table["obs"], var.filter("highly_variable"), n_comps)
    scores = cut(scores, "pca")
    edges = cut(neighbors(scores, n_neighbors), "knn")
    return AnnotatedTable(
        {
            **table.slots, "raw": table["X"], "layers/normcounts": norm, "X": norm, "var": var, "obsm/X_pca": scores,
            "varm/PCs": loadings, "uns/pca": variance, "obsp/distances": edges, "obsp/connectivities": connectivities(edges, n_neighbors),
        },
        {},
    )


@dataclass(frozen=True)
class Method:
    name: str
    fn: Callable[..., AnnotatedTable]
    output_types: tuple[str, ...]


METHODS: dict[str, Method] = {}


def method(name: str, *output_types: str):
    def add(fn):
        METHODS[name] = Method(name, fn, output_types)
        return fn

    return add


@method("unintegrated", "full", "embed", "knn")
def unintegrated(table: AnnotatedTable, batch: str, n_comps: int = 50, n_neighbors: int = 15, **_) -> AnnotatedTable:
    """Pass through, with components and graph added where they are missing."""
    out = table
    if "obsm/X_emb" not in out:
        if "obsm/X_pca" not in out:
            scores, _, _ = mx.matrix_pca(out["X"], out["obs"], out["var"], n_comps)
            out = out.with_slot("obsm/X_pca", cut(scores, "pca"))
        out = out.with_slot("obsm/X_emb", out["obsm/X_pca"])
    return out if "obsp/connectivities" in out else with_neighbors(out, "embed", n_neighbors)


@method("combat", "full")
def combat(table: AnnotatedTable, batch: str, covariates: Sequence[str] = (), mask: Column | str | None = None, **_) -> AnnotatedTable:
    features = table["var"] if mask is None else table["var"].filter(mask)
    vectors, index = co.combat(table["X"], table["obs"], features, batch, covariates)
    x = mx.from_vectors(vectors, index)
    return table.with_slot("X", cut(x, "corrected"))


@method("harmony", "embed")
def harmony(table: AnnotatedTable, batch: str, extra: Sequence[str] = (), **args) -> AnnotatedTable:
    return table.with_slot("obsm/X_emb", co.harmony(table["obsm/X_pca"], table["obs"], [batch, *extra], **args))


METHODS["harmonypy"] = METHODS["harmony_pytorch"] = METHODS["harmony"]


@method("bbknn", "knn")
def bbknn(table: AnnotatedTable, batch: str, neighbors_within_batch: int = 3, **_) -> AnnotatedTable:
    emb = table["obsm/X_pca"].join(table["obs"].select("cell_id", batch), "cell_id")
    edges, weights = co.bbknn(emb, batch, neighbors_within_batch)
    return table.with_slot("obsp/distances", edges).with_slot("obsp/connectivities", cut(weights, "weights"))


@method("scanorama", "embed")
def scanorama(table: AnnotatedTable, batch: str, **args) -> AnnotatedTable:
    emb = table["obsm/X_pca"].join(table["obs"].select("cell_id", batch), "cell_id")
    return table.with_slot("obsm/X_emb", co.panorama(emb, batch, **args))


REQUIRED = {"full": ("X",), "embed": ("obsm/X_emb",), "knn": ("obsp/distances", "obsp/connectivities")}
REDUNDANT = {"full": ("obsm/X_emb",), "embed": ("X", "layers/normcounts"), "knn": ("X", "layers/normcounts", "obsm/X_emb")}


def check_output(table: AnnotatedTable, output_type: str) -> None:
    if output_type not in REQUIRED:
        raise ValueError(f"unknown output type {output_type}")
    missing = [s for s in REQUIRED[output_type] if s not in table]
    if missing:
        raise ValueError(f"{output_type} output lacks {missing}")


def remove_slots(table: AnnotatedTable, output_type: str) -> AnnotatedTable:
    """Drop slots that the output type does not define."""
    return table.without(*REDUNDANT[output_type])


def run_method(name: str, table: AnnotatedTable, batch: str, output_type: str | None = None, n_neighbors: int = 15, **args) -> AnnotatedTable:
    """Correct, check, drop redundant slots and add the graph of the output type."""
    m = METHODS[name]
    kind = output_type or m.output_types[0]
    if kind not in m.output_types:
        raise ValueError(f"{name} has no {kind} output")
    out = m.fn(table, batch, **args)
    check_output(out, kind)
    out = remove_slots(out, kind) if name != "unintegrated" else out
    return out if kind == "knn" or name == "unintegrated" else with_neighbors(out, kind, n_neighbors)


def attach_clusters(table: AnnotatedTable, clusters: Sequence) -> AnnotatedTable:
    """Join cluster columns of a corrected table to its observations."""
    return table.with_slot("obs", join_many([table["obs"], *clusters], ["cell_id"], "left"))
