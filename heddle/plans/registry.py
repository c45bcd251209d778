"""Named metrics, correction methods, sample methods and subset strategies.

Each registry is a plain dict; adding a function to it makes the name available to
the flows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.operators import matrix as mx, metrics as mt
from heddle.operators.sample import SUBSET_STRATEGIES
from heddle.sources.table import AnnotatedTable

__all__ = ["METRICS", "SUBSET_STRATEGIES", "Metric", "MetricInput", "metric", "run_metric"]


@dataclass
class MetricInput:
    """What a metric may use; unused parts stay lazy.

    ``table`` has ``obs``, ``obsm/X_emb`` and the graph slots; ``before`` is the
    uncorrected embedding; ``clusters`` the clustering with the best resolution.
    """

    table: AnnotatedTable
    batch: str
    label: str
    output_type: str
    n_neighbors: int = 15
    before: DataFrame | None = None
    covariate: str | None = None
    sets: DataFrame | None = None
    cycle_sets: DataFrame | None = None
    cache: dict = field(default_factory=dict)

    @property
    def obs(self) -> DataFrame:
        return self.table["obs"]

    @property
    def emb(self) -> DataFrame:
        if "emb" not in self.cache:
            names = list(dict.fromkeys([self.batch, self.label]))
            self.cache["emb"] = self.table["obsm/X_emb"].select("cell_id", "v").join(
                self.obs.select("cell_id", *names), "cell_id"
            )
        return self.cache["emb"]

    @property
    def distances(self) -> DataFrame:
        return self.table["obsp/distances"]

    @property
    def weights(self) -> DataFrame:
        return self.table["obsp/connectivities"]

    @property
    def best_clusters(self) -> DataFrame:
        if "clusters" not in self.cache:
            if "obs/clusters" in self.table:
                found = self.table["obs/clusters"]
            else:
                labels = self.obs.select("cell_id", self.label)
                found = mt.optimal_clusters(self.weights, labels, self.label)
            self.cache["clusters"] = found.select("cell_id", "cluster").join(
                self.obs.select("cell_id", *dict.fromkeys([self.label, self.batch])), "cell_id"
            )
        return self.cache["clusters"]

    def kmeans(self) -> DataFrame:
        k = self.obs.agg(F.countDistinct(self.label)).first()[0]
        return mt.kmeans_labels(self.emb, max(k, 2))

    def set_scores(self, sets: DataFrame) -> DataFrame:
        return mx.score_sets(self.table["X"], self.obs, self.table["var"], sets)


@dataclass(frozen=True)
class Metric:
    name: str
    fn: Callable[[MetricInput], DataFrame]
    metric_type: str
    output_types: tuple[str, ...]


METRICS: dict[str, Metric] = {}
BATCH, BIO = "batch_correction", "bio_conservation"
ALL, VECTORS = ("full", "embed", "knn"), ("full", "embed")


def metric(name: str, metric_type: str, output_types: tuple[str, ...]):
    def add(fn):
        METRICS[name] = Metric(name, fn, metric_type, output_types)
        return fn

    return add


def alias(name: str, other: str, output_types: tuple[str, ...] | None = None) -> None:
    """A second name of the same quantity."""
    m = METRICS[other]
    METRICS[name] = Metric(name, m.fn, m.metric_type, output_types or m.output_types)


metric("nmi", BIO, ALL)(lambda c: mt.nmi(c.best_clusters, "cluster", c.label))
metric("ari", BIO, ALL)(lambda c: mt.ari(c.best_clusters, "cluster", c.label))
metric("nmi_kmeans_y", BIO, ALL)(lambda c: mt.nmi(c.kmeans(), "cluster", c.label))
metric("ari_kmeans_y", BIO, ALL)(lambda c: mt.ari(c.kmeans(), "cluster", c.label))
metric("asw_label", BIO, VECTORS)(lambda c: mt.asw_label(c.emb, c.label))
metric("asw_batch", BATCH, VECTORS)(lambda c: mt.asw_batch(c.emb, c.batch, c.label))
metric("isolated_label_asw", BIO, VECTORS)(lambda c: mt.isolated_label_asw(c.emb, c.label, c.batch))
metric("isolated_label_f1", BIO, ALL)(lambda c: mt.isolated_label_f1(c.best_clusters, c.label, c.batch, "cluster"))
metric("graph_connectivity", BATCH, ALL)(lambda c: mt.graph_connectivity(c.distances, c.obs, c.label))
metric("clisi", BIO, ALL)(lambda c: mt.clisi(c.distances, c.obs, c.label, c.n_neighbors))
metric("ilisi", BATCH, ALL)(lambda c: mt.ilisi(c.distances, c.obs, c.batch, c.n_neighbors))
metric("kbet_y", BATCH, ALL)(lambda c: mt.kbet(c.distances, c.obs, c.batch))
metric("kbet_pg", BATCH, VECTORS)(lambda c: mt.kbet_per_label(c.emb, c.batch, c.label))
metric("pcr", BIO, VECTORS)(lambda c: mt.pcr(c.emb, c.obs, c.covariate or c.batch))
metric("pcr_comparison", BATCH, VECTORS)(lambda c: mt.pcr_comparison(c.before, c.emb, c.obs, c.batch))
metric("pcr_random", BATCH, VECTORS)(lambda c: mt.pcr_random(c.emb))
metric("pcr_genes", BIO, VECTORS)(lambda c: mt.pcr_sets(c.emb, c.set_scores(c.sets)))
metric("pcr_random_genes", BATCH, VECTORS)(
    lambda c: mt.pcr_sets(c.emb, c.set_scores(mx.random_sets(c.table["var"], c.sets, 5)))
)
metric("cell_cycle", BIO, VECTORS)(
    lambda c: mt.cell_cycle_conservation(
        c.before, c.emb, c.obs, c.batch,
        mx.score_sets(c.table["X"], c.obs, c.table["var"], c.cycle_sets, batch=c.batch),
    )
)
metric("morans_i", BIO, ALL)(lambda c: mt.morans_i_covariate(c.weights, c.obs, c.covariate or c.label))
metric("morans_i_genes", BIO, ALL)(lambda c: mt.morans_i_sets(c.weights, c.table["X"], c.obs, c.sets))
metric("morans_i_random", BATCH, ALL)(lambda c: mt.morans_i_random(c.emb))
metric("morans_i_random_genes", BATCH, ALL)(
    lambda c: mt.morans_i_sets(c.weights, c.table["X"], c.obs, mx.random_sets(c.table["var"], c.sets, 5))
)
for _name, _other in {
    "nmi_leiden_y": "nmi", "ari_leiden_y": "ari", "asw_label_y": "asw_label", "asw_batch_y": "asw_batch",
    "isolated_label_asw_y": "isolated_label_asw", "kbet": "kbet_y", "pcr_y": "pcr_comparison",
}.items():
    alias(_name, _other)
# The second forms weigh the direct neighbours only.
metric("clisi_y", BIO, VECTORS)(lambda c: mt.clisi(c.distances, c.obs, c.label, c.n_neighbors, reach=None))
metric("ilisi_y", BATCH, VECTORS)(lambda c: mt.ilisi(c.distances, c.obs, c.batch, c.n_neighbors, reach=None))
# This name has always computed the label variant of the neighbourhood index.
METRICS["graph_connectivity_y"] = Metric("graph_connectivity_y", METRICS["clisi_y"].fn, BATCH, ALL)


def run_metric(name: str, given: MetricInput, dataset: str = "", file_id: str = "") -> DataFrame:
    """Result record of a metric; NULL when the output type does not allow it."""
    m = METRICS[name]
    if given.output_type in m.output_types:
        scores = m.fn(given)
        if "set_id" in scores.columns:
            scores = scores.select("score", F.concat(F.lit(f"{name}:"), "set_id").alias("metric_name"))
        elif "boot_id" in scores.columns:
            scores = scores.agg(F.avg("score").alias("score"))
    else:
        scores = given.obs.sparkSession.range(1).select(F.lit(None).cast("double").alias("score"))
    return mt.metric_records(
        scores, dataset, file_id, name, m.metric_type, given.batch, given.label, given.output_type
    )
