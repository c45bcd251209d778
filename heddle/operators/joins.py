"""Lookups, multi-way joins, collection of parallel results, parameter grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import join_keys, quoted
from heddle.functions.scalar import short_id


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in a stated order.

    An aggregate over structs, so partial results are combined before the shuffle
    and a frequent key never becomes one large group.
    """
    ranks = [F.struct(*[quoted(o) if isinstance(o, str) else o for o in order])]
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[quoted(c) for c in rest])
    best = df.groupBy(*[quoted(k) for k in keys]).agg(F.min_by(row, ranks[0]).alias("_row"))
    return best.select(*[quoted(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(
        *[quoted(c) for c in df.columns]
    )


def map_labels(
    df: DataFrame, mapping: DataFrame, order: Sequence[str], position: str | None = None
) -> DataFrame:
    """Add the labels ``order[1:]`` looked up by ``order[0]``.

    Keys and labels are trimmed; the last mapping row of a key wins, where rows
    follow ``position`` (or the label text when the mapping has no position).
    """
    key, labels = order[0], list(order[1:])
    df = df.withColumn(key, F.trim(quoted(key))) if is_text(df, key) else df
    for label in labels:
        trimmed = mapping.select(
            F.trim(quoted(key).cast("string")).alias("_key"),
            F.trim(quoted(label).cast("string")).alias("_label"),
            (quoted(position) if position else quoted(label)).alias("_at"),
        )
        lookup = trimmed.groupBy("_key").agg(F.max_by("_label", "_at").alias(label))
        joined = df.drop(label).join(lookup, quoted(key).cast("string") == F.col("_key"), "left")
        df = joined.drop("_key")
    return df


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def unmapped_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Number of rows without a label, one row per label."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in labels])
    return counts.unpivot([], list(labels), "label", "n_unmapped")


def annotate(df: DataFrame, annotation: DataFrame, key: str, barcode: str) -> DataFrame:
    """Left join of an annotation by barcode; annotation columns win."""
    extra = [c for c in annotation.columns if c != barcode]
    one = annotation.groupBy(quoted(barcode)).agg(
        F.min(F.struct(*[quoted(c) for c in extra])).alias("_row")
    )
    joined = df.drop(*extra).join(
        one.withColumnRenamed(barcode, "_barcode"), quoted(key) == F.col("_barcode"), "left"
    )
    return joined.select(
        *[quoted(c) for c in df.columns if c not in extra], *[F.col("_row")[c].alias(c) for c in extra]
    )


def explode_ids(df: DataFrame, column: str, sep: str = r" \|\| ") -> DataFrame:
    return df.withColumn(column, F.explode(F.split(quoted(column).cast("string"), sep)))


def join_exploded(
    df: DataFrame, row_id: str, key: str, meta: DataFrame, meta_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join of metadata whose key holds several ids; one row per input row.

    The metadata is reduced to one row per single id before the join, so the join
    cannot multiply rows.
    """
    slim = meta.select(*dict.fromkeys([meta_key, *columns]))
    single = explode_ids(slim, meta_key).na.drop(subset=[meta_key])
    picked = single.groupBy(quoted(meta_key).alias("_id")).agg(
        F.min(F.struct(*[quoted(c) for c in columns])).alias("_row")
    )
    joined = df.join(picked, quoted(key).cast("string") == F.col("_id"), "left")
    return joined.select(*[quoted(c) for c in df.columns], *[F.col("_row")[c].alias(c) for c in columns])


def key_overlap(df: DataFrame, keys: Sequence[str], meta: DataFrame, meta_keys: Sequence[str]) -> DataFrame:
    """Shared ids for each (metadata column, observation column) pair.

    Both sides are reduced to distinct ids first, so a frequent id costs one row.
    """

    def ids(source: DataFrame, names: Sequence[str], label: str) -> DataFrame:
        text = source.select(*[quoted(c).cast("string").alias(c) for c in names])
        return text.unpivot([], list(names), label, "_id").na.drop(subset=["_id"]).distinct()

    obs_ids = ids(df, keys, "obs_column")
    exploded = reduce(
        DataFrame.unionByName,
        [
            explode_ids(meta.select(quoted(m)), m).select(
                F.lit(m).alias("meta_column"), quoted(m).alias("_id")
            )
            for m in meta_keys
        ],
    ).na.drop(subset=["_id"]).distinct()
    shared = exploded.join(obs_ids, "_id").groupBy("meta_column", "obs_column").agg(
        F.count(F.lit(1)).alias("intersection")
    )
    sizes = obs_ids.groupBy("obs_column").agg(F.count(F.lit(1)).alias("n_obs_ids"))
    return shared.join(sizes, "obs_column").withColumn(
        "intersection_fraction", F.col("intersection") / F.col("n_obs_ids")
    )


def best_overlap(overlap: DataFrame) -> DataFrame:
    """The pair with the largest overlap; ties by column names."""
    return overlap.orderBy(F.desc("intersection"), "meta_column", "obs_column").limit(1)


def mismatches(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Ids found on one side only, with the side."""
    a = left.select(quoted(key).cast("string").alias("id")).na.drop().distinct()
    b = right.select(quoted(right_key).cast("string").alias("id")).na.drop().distinct()
    only_a = a.join(b, "id", "left_anti").withColumn("side", F.lit("left"))
    return only_a.unionByName(b.join(a, "id", "left_anti").withColumn("side", F.lit("right")))


def join_many(frames: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join any number of tables on shared keys.

    All joins use the same keys, so the shuffles of the running result are reused.
    """
    return reduce(lambda a, b: a.join(b, list(keys), how), frames)


def join_scores(df: DataFrame, key: str, parts: Sequence[Sequence[DataFrame]]) -> DataFrame:
    """Left join of score tables, each given as parts of one shape."""
    for group in parts:
        scores = reduce(DataFrame.unionByName, group)
        df = df.join(scores, key, "left")
    return df


def index_mismatches(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Ids of any table that are not in the first one, with the table name."""
    names = list(frames)
    first = frames[names[0]].select(quoted(key))
    parts = [
        frames[n].select(quoted(key)).join(first, key, "left_anti").withColumn("file_id", F.lit(n))
        for n in names[1:]
    ]
    return reduce(DataFrame.unionByName, parts)


def same_columns(frames: Mapping[str, DataFrame], key: str) -> list[str]:
    """Columns that every table has with equal values: one join and one aggregate."""
    names = list(frames)
    shared = [
        c for c in frames[names[0]].columns if c != key and all(c in frames[n].columns for n in names)
    ]
    if not shared or len(names) < 2:
        return shared
    sides = [
        frames[n].select(quoted(key), *[quoted(c).alias(f"{i}_{c}") for c in shared])
        for i, n in enumerate(names)
    ]
    joined = join_many(sides, [key])
    tests = [
        F.bool_and(
            reduce(
                lambda a, b: a & b,
                [quoted(f"0_{c}").eqNullSafe(quoted(f"{i}_{c}")) for i in range(1, len(names))],
            )
        ).alias(c)
        for c in shared
    ]
    result = joined.agg(*tests).first()
    return [c for c in shared if result[c] is not False]


def collect_tables(frames: Mapping[str, DataFrame], key: str, sep: str = "--") -> DataFrame:
    """Side-by-side table: equal columns once, differing ones tagged by table name."""
    if not index_mismatches(frames, key).isEmpty() if len(frames) > 1 else False:
        raise ValueError("all tables must have the same index")
    same = same_columns(frames, key)
    parts = []
    for i, (name, df) in enumerate(frames.items()):
        kept = [key, *([c for c in same] if i == 0 else [])]
        own = [c for c in df.columns if c != key and c not in same]
        parts.append(
            df.select(*[quoted(c) for c in kept], *[quoted(c).alias(f"{c}{sep}{name}") for c in own])
        )
    return join_many(parts, [key])


def merge_feature_info(frames: Sequence[DataFrame], columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Feature rows shared by (or found in any of) the datasets, one row per feature."""
    keys = ["feature_id", *columns]
    merged = reduce(lambda a, b: join_keys(a, b.select(*keys), keys, "left_semi"), frames) if how == "inner" else (
        reduce(DataFrame.unionByName, [f.select(*keys) for f in frames])
    )
    return merged.select(*keys).groupBy("feature_id").agg(
        F.min(F.struct(*columns)).alias("_row")
    ).select("feature_id", *[F.col("_row")[c].alias(c) for c in columns])


def fill_feature_info(base: DataFrame, datasets: Sequence[DataFrame], key: str) -> DataFrame:
    """Feature columns filled from several datasets; later datasets overwrite."""
    for d in datasets:
        new = [c for c in d.columns if c != key]
        joined = base.join(d.withColumnsRenamed({c: f"_n_{c}" for c in new}), key, "left")
        cols = {
            c: F.coalesce(quoted(f"_n_{c}"), quoted(c)) if c in base.columns else quoted(f"_n_{c}")
            for c in new
        }
        base = joined.withColumns(cols).drop(*[f"_n_{c}" for c in new])
    return base


def natural_join(left: DataFrame, right: DataFrame, distinct: bool = False) -> DataFrame:
    """Inner join on all shared columns."""
    shared = [c for c in left.columns if c in right.columns]
    joined = left.join(right, shared)
    return joined.distinct() if distinct else joined


def parameter_grid(spark: SparkSession, space: Mapping[str, Sequence]) -> DataFrame:
    """All combinations of parameter lists with a short stable id."""
    df = spark.createDataFrame([tuple([list(v) for v in space.values()])], list(space))
    for name in space:
        df = df.withColumn(name, F.explode(quoted(name)))
    parts = [F.concat(F.lit(f"{n}="), quoted(n).cast("string")) for n in space]
    return df.withColumn("param_id", short_id(*parts))


def expand_grid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All combinations of list-valued columns of each row, with a short stable id."""
    for name in columns:
        df = df.withColumn(name, F.explode(quoted(name)))
    parts = [F.concat(F.lit(f"{n}="), quoted(n).cast("string")) for n in columns]
    return df.withColumn("param_id", short_id(*parts))
