"""Names, patterns and readers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions.runtime import ship

Query = Callable[[SparkSession, str], DataFrame]

#: A word is a run of characters other than the six ASCII blanks.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_of(text: Column) -> Column:
    """Array of words; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of numbers as a long."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: acc + v.cast("long"))


def frequent_rows(counts: DataFrame, n_col: str, limit: int) -> DataFrame:
    """Rows of the largest ``n_col``, at most ``limit``; all rows of one class of sizes or none.

    A histogram with four classes per doubling tells how far down one can go, so nothing
    is sorted.  ``counts`` is read twice and should be a written table.
    """
    graded = counts.withColumn("_grade", F.floor(4 * F.log2(F.col(n_col))).cast("int"))
    spread = {r["_grade"]: r["count"] for r in graded.groupBy("_grade").count().collect()}
    least, held = 1 << 30, 0
    for grade in sorted(spread, reverse=True):
        held += spread[grade]
        if held > limit:
            break
        least = grade
    return graded.filter(F.col("_grade") >= least).drop("_grade")


def id_bounds(docs: DataFrame, id_col: str, most: int = 20_000) -> list:
    """Upper ends of ranges of ids that hold about as many rows as an input partition; each is an id."""
    ranges = min(max(2, docs.rdd.getNumPartitions()), most)
    shares = [i / ranges for i in range(1, ranges)]
    row = docs.agg(F.percentile_approx(id_col, shares, 10 * ranges), F.max(id_col)).first()
    return sorted({*(row[0] or []), row[1]} - {None})


def bucket_of(value: Column, bounds: list, width: int = 128) -> Column:
    """Place of the first bound that is not below ``value``, found in two steps; NULL is at 0."""
    if not bounds:
        return F.lit(0)
    runs = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    array = lambda values: F.array(*[F.lit(v) for v in values])
    run = F.least(F.size(F.filter(array([r[-1] for r in runs]), lambda b: b < value)), F.lit(len(runs) - 1))
    within = F.size(F.filter(F.get(F.array(*[array(r) for r in runs]), run), lambda b: b < value))
    return F.when(value.isNull(), F.lit(0)).otherwise(run * width + within).cast("int")
