"""The test tables seen as an annotated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions.runtime import ship
from heddle.sources.table import AnnotatedTable


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def obs(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("cell_id"),
            F.col("o_orderstatus").alias("batch"),
            F.col("o_orderpriority").alias("label"),
            F.col("n_name").alias("sample"),
            F.col("o_custkey").alias("donor"),
            F.col("r_name").alias("organ"),
            F.col("c_mktsegment").alias("segment"),
            F.col("o_totalprice").alias("price"),
        )
    )


def x(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def var(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("gene_id"),
        F.col("p_name").alias("feature_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("gene_set"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail"),
    )


def emb(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.col("label").cast("string").alias("label"),
        (F.col("vec_id") % 3).cast("string").alias("batch"),
    )


def annotated(spark: SparkSession, sf: str) -> AnnotatedTable:
    return AnnotatedTable(
        {"obs": obs(spark, sf), "X": x(spark, sf), "var": var(spark, sf)}
    )


# The same view as common table expressions for the SQL oracles.
OBS = """obs AS (
  SELECT o_orderkey AS cell_id, o_orderstatus AS batch, o_orderpriority AS label,
         n_name AS sample, o_custkey AS donor, r_name AS organ, c_mktsegment AS segment,
         o_totalprice AS price
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
X = """x AS (
  SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2)"""
VAR = """var AS (
  SELECT p_partkey AS gene_id, p_name AS feature_name, p_brand AS brand, p_type AS gene_set,
         p_size AS size, p_retailprice AS retail FROM part)"""
EMB = """emb AS (
  SELECT vec_id AS cell_id, embedding::DOUBLE[] AS v, CAST(label AS VARCHAR) AS label,
         CAST(vec_id % 3 AS VARCHAR) AS batch FROM embeddings)"""
EMB_DIMS = """dims AS (
  SELECT vec_id AS cell_id, unnest(range(64)) AS dim, unnest(embedding::DOUBLE[]) AS val,
         CAST(label AS VARCHAR) AS label, CAST(vec_id % 3 AS VARCHAR) AS batch FROM embeddings)"""
