"""A bundle of slots (observations, features, matrices, embeddings, graphs)."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "slots.json"


@dataclass(frozen=True)
class AnnotatedTable:
    """Slots by name, each a lazy DataFrame; ``paths`` remembers where a slot is stored.

    Slot names follow ``obs``, ``var``, ``X``, ``raw``, ``layers/<k>``, ``obsm/<k>``,
    ``varm/<k>``, ``obsp/<k>`` and ``uns``.
    """

    slots: Mapping[str, DataFrame] = field(default_factory=dict)
    paths: Mapping[str, str] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.slots[name]

    def __contains__(self, name: str) -> bool:
        return name in self.slots

    def with_slot(self, name: str, df: DataFrame) -> AnnotatedTable:
        paths = {k: v for k, v in self.paths.items() if k != name}
        return replace(self, slots={**self.slots, name: df}, paths=paths)

    def without(self, *names: str) -> AnnotatedTable:
        return replace(
            self,
            slots={k: v for k, v in self.slots.items() if k not in names},
            paths={k: v for k, v in self.paths.items() if k not in names},
        )

    def map_layers(self, fn: Callable[[DataFrame], DataFrame], layers: Iterable[str]) -> AnnotatedTable:
        out = self
        for name in layers:
            if name in self:
                out = out.with_slot(name, fn(self[name]))
        return out

    def select_layer(self, layer: str) -> DataFrame:
        """The matrix to work on; ``raw`` is restricted to the current features."""
        if layer in ("X", None):
            return self["X"]
        if layer in ("raw", "raw/X", "counts") and "raw" in self:
            return self["raw"].join(self["var"].select("gene_id"), "gene_id", "left_semi")
        name = layer if layer in self else f"layers/{layer}"
        if name not in self:
            raise KeyError(f"layer {layer} not found in {sorted(self.slots)}")
        return self[name]

    def filter_cells(self, condition) -> AnnotatedTable:
        """Keep observations where ``condition`` holds, in every per-cell slot."""
        obs = self["obs"].filter(condition)
        kept = obs.select("cell_id")
        out = self.with_slot("obs", obs)
        for name, df in self.slots.items():
            if name != "obs" and "cell_id" in df.columns:
                out = out.with_slot(name, df.join(kept, "cell_id", "left_semi"))
            elif {"src", "dst"} <= set(df.columns):
                near = df.join(kept.withColumnRenamed("cell_id", "src"), "src", "left_semi")
                out = out.with_slot(
                    name, near.join(kept.withColumnRenamed("cell_id", "dst"), "dst", "left_semi")
                )
        return out

    def save(self, directory: str) -> AnnotatedTable:
        """Write changed slots only; unchanged ones stay where they are stored.

        The manifest lists the folder of every slot, so stored slots are reused
        without a copy.
        """
        first = next(iter(self.slots.values()))
        paths = {}
        for name, df in self.slots.items():
            paths[name] = self.paths.get(name) or f"{directory}/{name}"
            if name not in self.paths:
                df.write.mode("errorifexists").parquet(paths[name])
        spark = first.sparkSession
        manifest = spark.createDataFrame([(json.dumps(paths),)], "value string")
        manifest.coalesce(1).write.mode("overwrite").text(f"{directory}/{MANIFEST}")
        return replace(self, paths=paths)


def slot_paths(spark: SparkSession, directory: str) -> dict[str, str]:
    return json.loads(spark.read.text(f"{directory}/{MANIFEST}").first()["value"])


def slot_exists(spark: SparkSession, directory: str, slot: str) -> bool:
    """True for a stored slot, or for ``obs/<column>`` of a stored slot."""
    paths = slot_paths(spark, directory)
    if slot in paths:
        return True
    owner, _, column = slot.partition("/")
    return owner in paths and column in spark.read.parquet(paths[owner]).columns


def load(
    spark: SparkSession,
    directory: str,
    slots: Iterable[str] | None = None,
    slot_map: Mapping[str, str] | None = None,
    exclude: Iterable[str] = (),
    fail_on_missing: bool = True,
) -> AnnotatedTable:
    """Open chosen slots lazily; ``slot_map`` maps new slot name to stored name."""
    paths = slot_paths(spark, directory)
    wanted = dict(slot_map or {})
    if slots is not None or not wanted:
        wanted.update({s: s for s in (slots if slots is not None else paths)})
    out, kept = {}, {}
    for new, stored in wanted.items():
        if new in exclude:
            continue
        if stored not in paths:
            if fail_on_missing:
                raise KeyError(f"slot {stored} not found in {directory}")
            warnings.warn(f"slot {stored} not found in {directory}", stacklevel=2)
            continue
        out[new] = spark.read.parquet(paths[stored])
        kept[new] = paths[stored]
    return AnnotatedTable(out, kept)


def split_by_value(df: DataFrame, key: str, values: Iterable) -> dict[str, DataFrame]:
    """One output per requested value; an absent value gives an empty output."""
    text = F.col(key).cast("string")
    out = {}
    for value in values:
        name = str(value).replace(" ", "_").replace("/", "_")
        out[name] = df.filter(safe(text) == name)
    return out


def safe(text):
    return F.regexp_replace(F.coalesce(text, F.lit("nan")), "[ /]", "_")


def write_split(df: DataFrame, key: str, directory: str) -> None:
    """One folder per value of ``key``, so that readers can skip the others."""
    df.withColumn("value", safe(F.col(key).cast("string"))).write.partitionBy("value").mode(
        "errorifexists"
    ).parquet(directory)
