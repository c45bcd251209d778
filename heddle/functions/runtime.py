"""Lineage cuts that survive the loss of an executor, and key joins."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: there the
    driver and the executors are one process on one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="heddle-"))
    return context.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Tasks unpickle functions of the package; workers that do not find it on their own
    path (a cluster without the wheel, a driver started from another folder) take it
    from here.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if package.is_dir() and getattr(context, "_heddle_shipped", None) != str(package):
        folder = tempfile.mkdtemp(prefix="heddle-package-")  # of the driver; Spark copies it to the executors
        context.addPyFile(shutil.make_archive(os.path.join(folder, package.name), "zip", package.parent, package.name))
        context._heddle_shipped = str(package)


def cut(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is needed more than once (iterations, two-pass
    numbering).  The files fix both the values and the row layout, so a lost
    executor only re-reads, and the reader knows the real size of the data.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_missing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows where all named columns are present."""
    return df.filter(reduce(lambda a, b: a & b, [quoted(n).isNotNull() for n in names], F.lit(True)))


def join_keys(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the left keys are kept."""
    keys = list(keys)
    if not keys:
        raise ValueError("join_keys needs at least one key")
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b,
        [quoted(k).eqNullSafe(quoted(f"__r_{k}")) for k in keys],
    )
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{k}" for k in keys])
