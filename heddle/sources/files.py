"""Delimited files and type repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import quoted
from heddle.operators.joins import first_per_key


def read_tsv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, header: bool = True
) -> DataFrame:
    """Tab-separated text with a header and ``#`` comments.

    Without a schema every column is text, so no extra pass infers types.
    """
    reader = spark.read.option("sep", "\t").option("comment", "#").option("header", header)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_annotation(
    spark: SparkSession, path: str, barcode_column: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Comma-separated annotation with one row per barcode.

    Files have no row order on a cluster, so the first row of a barcode is the
    smallest one by ``order`` (all other columns by default).
    """
    raw = spark.read.option("header", True).csv(path)
    return first_per_key(raw, [barcode_column], order or [c for c in raw.columns if c != barcode_column])


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


def repair_types(df: DataFrame) -> DataFrame:
    """Turn text columns into numbers where every present value is a number.

    One pass counts the present and the convertible values of all columns.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    checks = df.agg(
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(text)],
        *[F.count(quoted(c).try_cast("double")).alias(f"k{i}") for i, c in enumerate(text)],
    ).first()
    numeric = [c for i, c in enumerate(text) if checks[f"n{i}"] == checks[f"k{i}"] > 0]
    return df.withColumns({c: quoted(c).try_cast("double") for c in numeric})
