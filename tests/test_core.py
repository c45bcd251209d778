"""Ordering helpers, sources and relational operators against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heddle.functions import ordering as od, scalar
from heddle.functions.runtime import cut, join_keys, shared_dir
from heddle.operators import joins, obs as ob, sample as sm, sets
from heddle.sources import files, table as tb
from heddle.sources.table import AnnotatedTable


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; another is missing."""
    rng = np.random.default_rng(0)
    n = 3000
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", None], n))
    return pd.DataFrame({"id": np.arange(n), "k": key, "x": rng.integers(0, 40, n).astype(float)})


def test_prefix_sums_match_pandas(spark, skewed):
    df = spark.createDataFrame(skewed).repartition(7)
    got = od.prefix_sums(df, ["k"], ["x", "id"], {"s": "x", "n": F.lit(1)}).toPandas().sort_values("id")
    want = skewed.sort_values(["x", "id"])
    groups = want["k"].fillna("?")
    want = want.assign(s=want.groupby(groups)["x"].cumsum(), n=want.groupby(groups).cumcount() + 1).sort_values("id")
    assert (got["s"].to_numpy() == want["s"].to_numpy()).all()
    assert (got["n"].to_numpy() == want["n"].to_numpy()).all()


def test_exact_quantiles_match_numpy(spark, skewed):
    got = od.exact_quantiles(spark.createDataFrame(skewed), ["k"], "x", {"a": 0.1, "m": 0.5, "z": 1.0}).toPandas()
    for _, r in got.iterrows():
        x = skewed[skewed["k"].isna() if r["k"] is None else skewed["k"] == r["k"]]["x"]
        assert np.allclose([r["a"], r["m"], r["z"]], np.quantile(x, [0.1, 0.5, 1.0]))


def test_sample_exact_size_and_stability(spark, skewed):
    df = spark.createDataFrame(skewed)
    a = od.sample_exact(df, "id", 50, 1, ["k"]).toPandas()
    b = od.sample_exact(df.repartition(3, "x"), "id", 50, 1, ["k"]).toPandas()
    assert set(a["id"]) == set(b["id"])
    assert (a.groupby(a["k"].fillna("?")).size() == 50).all()
    small = od.sample_exact(df.filter("k = 'a'"), "id", 10_000, 1)
    assert small.count() == (skewed["k"] == "a").sum()


def test_partitioning_does_not_change_running_index(spark, skewed):
    df = spark.createDataFrame(skewed)
    a = od.running_index(df, [], ["id"]).toPandas().sort_values("id")
    b = od.running_index(df.repartition(5, "x"), [], ["id"]).toPandas().sort_values("id")
    assert list(a["position"]) == list(b["position"]) == list(range(1, len(skewed) + 1))


def test_cut_uses_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = cut(spark.range(10).withColumn("a b.c", F.lit("x")))
    assert df.columns == ["id", "a b.c"] and df.count() == 10


def test_join_keys_matches_missing_keys(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    b = spark.createDataFrame([(None, 5), ("x", 6)], "k string, v int")
    assert sorted((r["id"], r["v"]) for r in join_keys(a, b, ["k"]).collect()) == [(1, 5), (2, 6)]


def test_as_text_follows_text_rules(spark):
    df = spark.createDataFrame([(True, None, 1.0)], "a boolean, b string, c double")
    r = df.select(*[scalar.as_text(df, c).alias(c) for c in "abc"]).first()
    assert tuple(r) == ("True", "nan", "1.0")


@pytest.mark.parametrize("n,text", [(0, "0"), (999, "999"), (1234, "1.23K"), (15000, "15K"), (2_500_000, "2.5M"), (7_120_000_000, "7.12B")])
def test_human_format(spark, n, text):
    assert spark.range(1).select(scalar.human_format(F.lit(n))).first()[0] == text


def test_store_and_reuse_slots(spark, tmp_path):
    t = AnnotatedTable({"obs": spark.range(5).withColumnRenamed("id", "cell_id"), "X": spark.createDataFrame([(1, 2, 3.0)], "cell_id long, gene_id int, value double")})
    first = t.save(str(tmp_path / "a"))
    second = first.with_slot("obs", first["obs"].filter("cell_id > 2")).save(str(tmp_path / "b"))
    assert second.paths["X"] == first.paths["X"] and second.paths["obs"] != first.paths["obs"]
    again = tb.load(spark, str(tmp_path / "b"))
    assert again["obs"].count() == 2 and again["X"].count() == 1
    assert tb.slot_exists(spark, str(tmp_path / "b"), "obs/cell_id")
    assert not tb.slot_exists(spark, str(tmp_path / "b"), "obs/other")
    with pytest.raises(KeyError):
        tb.load(spark, str(tmp_path / "b"), slots=["layers/none"])
    with pytest.warns(UserWarning):
        tb.load(spark, str(tmp_path / "b"), slots=["obs", "layers/none"], fail_on_missing=False)


def test_write_split_and_prune(spark, tmp_path):
    df = spark.createDataFrame([("a b", 1), ("c/d", 2), (None, 3)], "k string, v int")
    tb.write_split(df, "k", str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {(r["value"], r["v"]) for r in back.collect()} == {("a_b", 1), ("c_d", 2), ("nan", 3)}
    assert "PartitionFilters: [isnotnull" in back.filter("value = 'a_b'")._jdf.queryExecution().toString()


def test_repair_types(spark):
    df = spark.createDataFrame([("1", "a", None), (None, "2", None), ("2.5", "3", None)], "n string, t string, e string")
    assert dict(files.repair_types(df).dtypes) == {"n": "double", "t": "string", "e": "string"}


def test_filter_modes(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "x int, b boolean")
    assert [r["x"] for r in ob.filter_obs(df, queries=["x < 3"], subset=True).collect()] == [1, 2]
    assert [r["x"] for r in ob.filter_obs(df, queries=["x < 3"], mode="remove", subset=True).collect()] == [3]
    assert [r["x"] for r in ob.filter_obs(df, {"b": [True, "nan"]}, subset=True).collect()] == [3]


def test_missing_bound_never_passes(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(ob.in_range("x", None, 2)).collect()] == [False, False]
    assert [r[0] for r in df.select(ob.in_range("x", 0, 2)).collect()] == [True, False]


def test_last_mapping_row_wins(spark):
    df = spark.createDataFrame([(" a ",), ("b",), ("z",)], "k string")
    mapping = spark.createDataFrame([("a", "one", 1), ("a ", "two", 2), ("b", "three ", 3)], "k string, label string, at int")
    got = {r["k"]: r["label"] for r in joins.map_labels(df, mapping, ["k", "label"], "at").collect()}
    assert got == {"a": "two", "b": "three", "z": None}


def test_collect_rejects_other_index(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "x")], "id int, v string")
    with pytest.raises(ValueError):
        joins.collect_tables({"a": a, "b": b}, "id")


def test_by_sample_overshoots_by_one(spark):
    obs = spark.range(1000).withColumn("s", (F.col("id") % 5).cast("string")).withColumnRenamed("id", "cell_id")
    assert sm.by_sample(obs, 250, "s").count() == 400
    assert sm.by_sample(obs, 250, "s", min_cells_per_sample=500).count() == 0
    within = sm.within_sample(obs, 100, "s", 30)
    assert within.count() == 120 and within.select("s").distinct().count() == 4


def test_concat_single_and_empty(spark):
    t = AnnotatedTable({"obs": spark.createDataFrame([(1,)], "cell_id int"), "X": spark.createDataFrame([(1, 1, 1.0)], "cell_id int, gene_id int, value double"),
                        "var": spark.createDataFrame([(1,)], "gene_id int")})
    none = t.with_slot("obs", t["obs"].limit(0))
    assert sets.concat_tables({"a": t, "b": none})["obs"].columns == ["cell_id"]
    assert sets.concat_tables({"a": none})["obs"].count() == 0


def test_id_tokens(spark):
    df = spark.createDataFrame([("m1:x--a=1--b=z--m2:a_very_long_name_of_a_file",)], "id string")
    keys = ob.id_token_keys(df, "id")
    r = ob.parse_id_tokens(df, "id", keys).first()
    assert keys == ["a", "b"] and (r["a"], r["b"]) == ("1", "z")
    assert r["file_name"] == "x--a_very_long_name_..."
