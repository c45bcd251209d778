"""Sources, filters, projections and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from heddle.catalog import query
from heddle.functions import scalar
from heddle.functions.runtime import shared_dir
from heddle.operators import joins, obs as ob
from heddle.plans import view
from heddle.plans.view import EMB, OBS, VAR, X
from heddle.sources import files, table as tb


def scratch(spark, tag):
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources


@query("s1_load_slots", f"WITH {X} SELECT cell_id, gene_id, value FROM x")
def s1(spark, sf):
    path = scratch(spark, "table")
    view.annotated(spark, sf).save(path)
    return tb.load(spark, path, slots=["X", "obs"], exclude=["obs"])["X"]


@query("s2_load_renamed", f"WITH {X} SELECT cell_id, gene_id, value FROM x WHERE value > 10")
def s2(spark, sf):
    path = scratch(spark, "table")
    tb.AnnotatedTable({"layers/counts": view.x(spark, sf)}).save(path)
    return tb.load(spark, path, slot_map={"X": "layers/counts"})["X"].filter("value > 10")


@query("s4_select_layer", f"""WITH {X}, {VAR}
  SELECT cell_id, gene_id, value FROM x WHERE gene_id IN (SELECT gene_id FROM var WHERE gene_set = 'PROMO')""")
def s4(spark, sf):
    t = view.annotated(spark, sf)
    t = t.with_slot("raw", t["X"]).with_slot("var", t["var"].filter("gene_set = 'PROMO'"))
    return t.select_layer("raw")


@query("s5_save_changed_slots", f"""WITH {OBS}, {X}
  SELECT batch, sum(value) AS total FROM obs JOIN x USING (cell_id) WHERE price > 100000 GROUP BY 1""")
def s5(spark, sf):
    t = view.annotated(spark, sf).save(scratch(spark, "table"))
    path = scratch(spark, "table")
    t.with_slot("obs", t["obs"].filter("price > 100000")).save(path)
    again = tb.load(spark, path, slots=["obs", "X"])
    return again["obs"].join(again["X"], "cell_id").groupBy("batch").agg(F.sum("value").alias("total"))


@query("s6_repair_types", """SELECT doc_id, lang, CAST(quality AS DOUBLE) AS quality_text,
    CASE WHEN doc_id % 2 = 0 THEN lang ELSE '1' END AS mixed
  FROM documents LEFT JOIN labels USING (doc_id)""")
def s6(spark, sf):
    docs = view.table(spark, sf, "documents").select("doc_id", "lang")
    df = docs.join(view.table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "lang", F.col("quality").cast("string").alias("quality_text"),
        F.expr("CASE WHEN doc_id % 2 = 0 THEN lang ELSE '1' END").alias("mixed"),
    )
    return files.repair_types(df)


@query("s7_read_tsv", """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
    CAST(o_custkey AS VARCHAR) AS donor FROM orders WHERE o_orderstatus <> 'P'""")
def s7(spark, sf):
    path = scratch(spark, "tsv")
    o = view.table(spark, sf, "orders")
    mark = F.when(F.col("o_orderstatus") == "P", "# ").otherwise("")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_custkey").cast("string"))
    o.select(F.concat(mark, line).alias("value")).write.text(path)
    return files.read_tsv(spark, path, "id string, status string, donor string", header=False)


@query("s8_read_annotation", """SELECT CAST(o_custkey AS VARCHAR) AS barcode,
    min(CAST(o_orderkey AS VARCHAR)) AS first_order FROM orders GROUP BY 1""")
def s8(spark, sf):
    path = scratch(spark, "csv")
    o = view.table(spark, sf, "orders")
    o.select(F.col("o_custkey").alias("barcode"), F.col("o_orderkey").alias("first_order")).write.option(
        "header", True).csv(path)
    return files.read_annotation(spark, path, "barcode", ["first_order"])


@query("s9_write_tsv", """SELECT o_orderpriority AS label, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1""")
def s9(spark, sf):
    path = scratch(spark, "tsv")
    files.write_tsv(view.obs(spark, sf).groupBy("label").agg(F.count("*").alias("n")), path)
    return files.read_tsv(spark, path)


@query("s11_split_by_value", f"""WITH {OBS}
  SELECT '1-URGENT' AS part, count(*) AS n FROM obs WHERE label = '1-URGENT'
  UNION ALL SELECT '4-NOT_SPECIFIED', count(*) FROM obs WHERE label = '4-NOT SPECIFIED'
  UNION ALL SELECT 'dummy', 0""")
def s11(spark, sf):
    parts = tb.split_by_value(view.obs(spark, sf), "label", ["1-URGENT", "4-NOT SPECIFIED", "dummy"])
    out = [p.agg(F.count("*").alias("n")).select(F.lit(k).alias("part"), "n") for k, p in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---------------------------------------------------------------- filters and projections


@query("p1_remove_by_value", """SELECT doc_id, lang, quality FROM
  (SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id))
  WHERE lang NOT IN ('fr') AND coalesce(CAST(quality AS VARCHAR), 'nan') NOT IN ('nan')
    AND NOT (quality = 0)""")
def p1(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    d = d.withColumn("good", F.col("quality") == 1)
    kept = ob.filter_obs(d, {"lang": ["fr"], "quality": ["nan"], "good": [False]}, subset=True)
    return kept.select("doc_id", "lang", "quality")


@query("p2_filter_by_expression", f"""WITH {OBS}
  SELECT cell_id, price FROM obs WHERE price < 200000 AND batch <> 'P'""")
def p2(spark, sf):
    return ob.filter_obs(view.obs(spark, sf), queries=["price < 200000", "batch <> 'P'"], subset=True).select(
        "cell_id", "price")


@query("p3_filtered_flag", f"""WITH {OBS}, {X}, f AS (
    SELECT cell_id, (organ NOT IN ('ASIA') AND price > 50000) AS filtered FROM obs)
  SELECT filtered, count(DISTINCT f.cell_id) AS n_cells, sum(value) AS total FROM f
  LEFT JOIN x ON x.cell_id = f.cell_id GROUP BY 1""")
def p3(spark, sf):
    t = view.annotated(spark, sf)
    flagged = ob.filter_obs(t["obs"], {"organ": ["ASIA"]}, ["price > 50000"])
    per_cell = t["X"].groupBy("cell_id").agg(F.sum("value").alias("value"))
    return flagged.join(per_cell, "cell_id", "left").groupBy("filtered").agg(
        F.count("*").alias("n_cells"), F.sum("value").alias("total"))


@query("p3_filter_matrix", f"""WITH {OBS}, {X}
  SELECT x.cell_id, gene_id, value FROM x JOIN obs USING (cell_id) WHERE organ <> 'ASIA' AND price > 50000""")
def p3b(spark, sf):
    t = view.annotated(spark, sf)
    return t.filter_cells(ob.keep_mask(t["obs"], {"organ": ["ASIA"]}, ["price > 50000"]))["X"]


@query("p4_rename_by_copy", f"""WITH {OBS} SELECT cell_id, batch, batch AS status,
    CAST(NULL AS VARCHAR) AS missing FROM obs""")
def p4(spark, sf):
    return ob.rename_by_copy(view.obs(spark, sf).select("cell_id", "batch"), {"batch": "status", "nope": "missing"})


@query("p5_merge_columns", """SELECT doc_id, lang || '-' || coalesce(CAST(quality AS VARCHAR), 'nan') AS lang_quality,
    source || '-' || lang AS origin FROM documents LEFT JOIN labels USING (doc_id)""")
def p5(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    plan = spark.createDataFrame(
        [("a", "lang_quality", "lang,quality"), ("a", "origin", "source,lang"), ("b", "other", "lang")],
        "file_id string, column_name string, columns string")
    return ob.merge_columns(d, plan, "a").select("doc_id", "lang_quality", "origin")


@query("p6_composite_id", f"""WITH {OBS} SELECT cell_id, sample || '-' || CAST(donor AS VARCHAR) AS tech_id FROM obs""")
def p6(spark, sf):
    return ob.composite_id(view.obs(spark, sf), "tech_id", "sample + donor").select("cell_id", "tech_id")


SCHEMA = ob.column_union(ob.CELL_COLUMNS, ob.TIER1_COLUMNS, ob.EXTRA_COLUMNS)


@query("p7_force_schema", f"WITH {OBS} SELECT " + ", ".join(
    {"organ": "organ", "donor": "donor", "sample": "sample"}.get(c, f"CAST(NULL AS VARCHAR) AS {c}") for c in SCHEMA)
    + " FROM obs")
def p7(spark, sf):
    return ob.force_schema(view.obs(spark, sf), SCHEMA)


@query("p8_translate_columns", f"""WITH {OBS} SELECT cell_id, organ AS tissue, donor AS donor_id, sample FROM obs""")
def p8(spark, sf):
    schema_map = spark.createDataFrame(
        [("organ", "tissue"), ("donor", "donor_id"), ("sample", None)], "custom string, target string")
    return ob.translate_columns(
        view.obs(spark, sf).select("cell_id", "organ", "donor", "sample"), schema_map, "custom", "target")


@query("p9_constants_and_version", f"""WITH {OBS} SELECT cell_id, 'study1' AS study, donor, donor AS donor_id,
    segment AS ethnicity, segment AS self_reported_ethnicity FROM obs""")
def p9(spark, sf):
    o = view.obs(spark, sf).select("cell_id", "donor", F.col("segment").alias("ethnicity"))
    return ob.upgrade_schema(ob.add_constants(o, {"study": "study1", "skipped": [1]}), "2.0.0")


@query("p10_fallback_column", """SELECT doc_id, source AS cell_type FROM documents WHERE lang = 'fr'""")
def p10(spark, sf):
    d = view.table(spark, sf, "documents").filter("lang = 'fr'")
    return ob.fallback_column(
        d.select("doc_id", "source", F.col("lang").alias("cell_type")), "cell_type", "source"
    ).select("doc_id", "cell_type")


@query("p11_drop_empty_columns", """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)""")
def p11(spark, sf):
    d = view.table(spark, sf, "documents").select("doc_id").join(
        view.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return ob.drop_empty_columns(d.withColumn("empty", F.when(F.lit(False), F.lit("x"))))


@query("p12_range_predicate", f"""WITH {OBS} SELECT cell_id, price BETWEEN 10000 AND 300000 AS ok, FALSE AS no_bound FROM obs""")
def p12(spark, sf):
    return view.obs(spark, sf).select("cell_id", ob.in_range("price", 10000, 300000).alias("ok"),
                                      ob.in_range("price", None, 5).alias("no_bound"))


@query("p13_valid_covariates", f"""WITH {OBS}, c AS (
    SELECT 'batch' AS name, count(DISTINCT batch) AS n FROM obs UNION ALL
    SELECT 'organ', count(DISTINCT organ) FROM obs UNION ALL SELECT 'fixed', 1)
  SELECT name AS covariate, n FROM c WHERE n >= 2""")
def p13(spark, sf):
    o = view.obs(spark, sf).withColumn("fixed", F.lit("a"))
    names = ob.valid_covariates(o, ["batch", "organ", "fixed", "absent"])
    long = o.select(*names).unpivot([], names, "covariate", "v")
    return long.groupBy("covariate").agg(F.countDistinct("v").alias("n"))


@query("p14_columns_by_pattern", """SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, o_custkey FROM orders""")
def p14(spark, sf):
    o = view.table(spark, sf, "orders")
    return o.select(*ob.columns_like(o, prefixes=["o_order"], patterns=["o_c.*y"]))


@query("p15_suffix_columns", f"""WITH {OBS} SELECT cell_id, batch, label FROM obs""")
def p15(spark, sf):
    o = view.obs(spark, sf).select("cell_id", "batch", "label")
    tagged = ob.suffix_columns(o, "m1", ["cell_id"])
    other = ob.suffix_columns(o.select("cell_id", "label"), "m2", ["cell_id"])
    return ob.strip_suffix(tagged.join(other, "cell_id"), "m1")


@query("p16_embedding_outliers", f"""WITH {EMB}, s AS (
    SELECT cell_id, abs(list_max(v)) AS a FROM emb)
  SELECT cell_id FROM s WHERE a < 1.2 * (SELECT avg(a) FROM s)""")
def p16(spark, sf):
    return ob.drop_embedding_outliers(view.emb(spark, sf), "max", 1.2).select("cell_id")


@query("p17_subset_features", f"""WITH {X}, {VAR}, m AS (
    SELECT * FROM x WHERE gene_id IN (SELECT gene_id FROM var WHERE size > 25))
  SELECT cell_id, gene_id, value FROM m
  WHERE gene_id IN (SELECT gene_id FROM m WHERE value > 0 GROUP BY 1 HAVING count(*) >= 30)""")
def p17(spark, sf):
    return ob.subset_features(view.x(spark, sf), view.var(spark, sf), "size > 25", 30)


@query("p18_match_features", f"""WITH {VAR} SELECT gene_id, feature_name FROM var
  WHERE regexp_matches(feature_name, '^red|bolt$|ga.get')""")
def p18(spark, sf):
    return ob.match_features(view.var(spark, sf), ["^red", "bolt$", "ga.get"]).select("gene_id", "feature_name")


@query("p19_clean_categories", """SELECT doc_id, CASE WHEN s IN ('NaN', 'None', '', 'nan', 'unknown') THEN NULL ELSE s END AS s FROM (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN 'unknown' ELSE source END AS s FROM documents)""")
def p19(spark, sf):
    d = view.table(spark, sf, "documents").select("doc_id", F.expr(
        "CASE doc_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN 'unknown' ELSE source END").alias("s"))
    return d.select("doc_id", scalar.clean_categories(F.col("s")).alias("s"))


@query("p20_id_tokens", f"""WITH {OBS} SELECT cell_id, batch, organ,
    CASE WHEN length(f) > 20 THEN substring(f, 1, 20) || '...' ELSE f END AS file_name
  FROM (SELECT *, 'dataset--' || label AS f FROM obs)""")
def p20(spark, sf):
    o = view.obs(spark, sf).select("cell_id", F.concat(
        F.lit("dataset--batch="), "batch", F.lit("--mod:"), "label", F.lit("--organ="), "organ").alias("file_id"))
    keys = ob.id_token_keys(o, "file_id")
    return ob.parse_id_tokens(o, "file_id", keys).drop("file_id")


@query("p21_run_metadata", f"""WITH {OBS}, p AS (SELECT DISTINCT batch, label, organ FROM obs)
  SELECT 'batch' AS key, batch AS value, 'integration' AS module FROM p
  UNION ALL SELECT 'label', label, 'integration' FROM p""")
def p21(spark, sf):
    runs = view.obs(spark, sf).select("batch", "label", F.col("organ").alias("dataset")).distinct()
    return ob.run_metadata(runs, module="integration")


@query("p22_plot_columns", f"""WITH {OBS} SELECT 'fixed' AS hue, count(*) AS n FROM obs
  UNION ALL SELECT 'organ', count(*) FROM obs""")
def p22(spark, sf):
    o = view.obs(spark, sf).withColumns({"fixed": F.lit("a"), "empty": F.when(F.lit(False), F.lit("x"))})
    names = ob.valid_covariates(o, ["organ", "fixed", "empty", "absent"], min_distinct=1)
    return o.select(*names).unpivot([], names, "hue", "v").groupBy("hue").agg(F.count("v").alias("n"))


# ---------------------------------------------------------------- joins


@query("j1_map_labels", f"""WITH {OBS}, m AS (
    SELECT n_name AS k, max_by(r_name, n_nationkey) AS lineage, max_by('R' || n_regionkey, n_nationkey) AS code
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20 GROUP BY 1)
  SELECT cell_id, sample, lineage, code FROM obs LEFT JOIN m ON k = sample""")
def j1(spark, sf):
    n = view.table(spark, sf, "nation").join(
        view.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).filter("n_nationkey < 20")
    mapping = n.select(F.concat(F.lit(" "), "n_name").alias("sample"), F.concat("r_name", F.lit("  ")).alias("lineage"),
                       F.concat(F.lit("R"), "n_regionkey").alias("code"), F.col("n_nationkey").alias("at"))
    return joins.map_labels(view.obs(spark, sf).select("cell_id", "sample"), mapping, ["sample", "lineage", "code"], "at")


@query("j1_unmapped", f"""WITH {OBS}, m AS (SELECT n_name FROM nation WHERE n_nationkey < 20)
  SELECT 'lineage' AS label, count(*) AS n_unmapped FROM obs WHERE sample NOT IN (SELECT n_name FROM m)""")
def j1b(spark, sf):
    mapping = view.table(spark, sf, "nation").filter("n_nationkey < 20").select(
        F.col("n_name").alias("sample"), F.col("n_name").alias("lineage"))
    return joins.unmapped_counts(joins.map_labels(view.obs(spark, sf), mapping, ["sample", "lineage"]), ["lineage"])


@query("j2_map_by_index", """SELECT doc_id, CAST(quality AS VARCHAR) AS relabel FROM documents LEFT JOIN labels USING (doc_id)""")
def j2(spark, sf):
    mapping = view.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("relabel"))
    return joins.map_labels(view.table(spark, sf, "documents").select("doc_id"), mapping, ["doc_id", "relabel"])


@query("j3_annotate", """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def j3(spark, sf):
    ann = view.table(spark, sf, "labels").withColumnRenamed("doc_id", "barcode")
    return joins.annotate(view.table(spark, sf, "documents").select("doc_id", "lang"), ann, "doc_id", "barcode")


@query("j4_join_exploded_ids", """WITH ids AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id, min(s_name) AS group_name FROM customer
    JOIN supplier ON s_suppkey = c_custkey // 20 GROUP BY 1)
  SELECT o_orderkey AS cell_id, o_custkey AS donor, group_name FROM orders
  LEFT JOIN ids ON id = CAST(o_custkey AS VARCHAR)""")
def j4(spark, sf):
    c = view.table(spark, sf, "customer").join(
        view.table(spark, sf, "supplier"), F.expr("s_suppkey = c_custkey div 20"))
    meta = c.groupBy("s_name").agg(F.concat_ws(" || ", F.sort_array(F.collect_list(F.col("c_custkey").cast("string")))).alias("donors"))
    meta = meta.withColumnRenamed("s_name", "group_name")
    return joins.join_exploded(view.obs(spark, sf).select("cell_id", "donor"), "cell_id", "donor", meta, "donors", ["group_name"])


J5_META = """meta AS (SELECT s_name, CAST(s_suppkey * 2 AS VARCHAR) AS half, s_name AS bad FROM supplier)"""


def j5_inputs(spark, sf):
    o = view.obs(spark, sf).select("donor", "sample")
    meta = view.table(spark, sf, "supplier").select(
        F.concat_ws(" || ", (F.col("s_suppkey") * 2).cast("string"), F.lit("none")).alias("half"),
        F.concat(F.lit("NATION_"), "s_nationkey").alias("nation"))
    return o, meta


@query("j5_key_overlap", f"""WITH {OBS}, half AS (
    SELECT DISTINCT CAST(s_suppkey * 2 AS VARCHAR) AS id FROM supplier), nat AS (
    SELECT DISTINCT 'NATION_' || s_nationkey AS id FROM supplier),
  d AS (SELECT DISTINCT CAST(donor AS VARCHAR) AS id FROM obs), s AS (SELECT DISTINCT sample AS id FROM obs), a AS (
  SELECT 'half' AS meta_column, 'donor' AS obs_column, count(*) AS intersection, (SELECT count(*) FROM d) AS n_obs_ids
    FROM half JOIN d USING (id)
  UNION ALL SELECT 'nation', 'sample', count(*), (SELECT count(*) FROM s) FROM nat JOIN s USING (id))
  SELECT *, intersection / n_obs_ids AS intersection_fraction FROM a""")
def j5(spark, sf):
    o, meta = j5_inputs(spark, sf)
    return joins.key_overlap(o, ["donor", "sample"], meta, ["half", "nation"])


@query("j5_best_key", f"""WITH {OBS}, half AS (
    SELECT DISTINCT CAST(s_suppkey * 2 AS VARCHAR) AS id FROM supplier),
  d AS (SELECT DISTINCT CAST(donor AS VARCHAR) AS id FROM obs)
  SELECT 'half' AS meta_column, 'donor' AS obs_column, count(*) AS intersection, (SELECT count(*) FROM d) AS n_obs_ids,
   count(*) / (SELECT count(*) FROM d) AS intersection_fraction FROM half JOIN d USING (id)""")
def j5b(spark, sf):
    o, meta = j5_inputs(spark, sf)
    return joins.best_overlap(joins.key_overlap(o, ["donor", "sample"], meta, ["half", "nation"]))


@query("j5_mismatches", """WITH a AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders),
  b AS (SELECT DISTINCT CAST(s_suppkey * 20 AS VARCHAR) AS id FROM supplier)
  SELECT id, 'left' AS side FROM a WHERE id NOT IN (SELECT id FROM b)
  UNION ALL SELECT id, 'right' FROM b WHERE id NOT IN (SELECT id FROM a)""")
def j5c(spark, sf):
    s = view.table(spark, sf, "supplier").select((F.col("s_suppkey") * 20).alias("k"))
    return joins.mismatches(view.obs(spark, sf), "donor", s, "k")


@query("j6_join_scores", """SELECT o_orderkey AS cell_id, q AS score_a, p AS score_b FROM orders
  LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) a ON a.l_orderkey = o_orderkey
  LEFT JOIN (SELECT l_orderkey, max(l_discount) AS p FROM lineitem GROUP BY 1) b ON b.l_orderkey = o_orderkey""")
def j6(spark, sf):
    li = view.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "cell_id")
    a = li.groupBy("cell_id").agg(F.sum("l_quantity").alias("score_a"))
    b = li.groupBy("cell_id").agg(F.max("l_discount").alias("score_b"))
    parts = [a.filter("cell_id % 2 = 0"), a.filter("cell_id % 2 = 1")]
    return joins.join_scores(view.obs(spark, sf).select("cell_id"), "cell_id", [parts, [b]])


@query("j7_join_many", """WITH a AS (SELECT l_orderkey AS cell_id, count(*) AS n FROM lineitem GROUP BY 1),
  b AS (SELECT l_orderkey AS cell_id, max(l_tax) AS tax FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
  c AS (SELECT o_orderkey AS cell_id, o_orderstatus AS batch FROM orders WHERE o_orderstatus <> 'F')
  SELECT coalesce(a.cell_id, b.cell_id, c.cell_id) AS cell_id, n, tax, batch FROM a
  FULL JOIN b ON a.cell_id = b.cell_id FULL JOIN c ON c.cell_id = coalesce(a.cell_id, b.cell_id)""")
def j7(spark, sf):
    li = view.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "cell_id")
    a = li.groupBy("cell_id").agg(F.count("*").alias("n"))
    b = li.filter("l_returnflag = 'A'").groupBy("cell_id").agg(F.max("l_tax").alias("tax"))
    c = view.obs(spark, sf).filter("batch <> 'F'").select("cell_id", "batch")
    return joins.join_many([a, b, c], ["cell_id"], "full")


def collect_inputs(spark, sf):
    o = view.obs(spark, sf).select("cell_id", "batch", "label")
    return {"a": o, "b": o.withColumn("label", F.col("batch")).withColumn("extra", F.lit(1))}


COLLECTED = f"""WITH {OBS} SELECT cell_id, batch, label AS "label--a", batch AS "label--b", 1 AS "extra--b" FROM obs"""


@query("j8_collect", COLLECTED)
def j8(spark, sf):
    return joins.collect_tables(collect_inputs(spark, sf), "cell_id")


@query("j9_uncollect", f"WITH {OBS} SELECT cell_id, batch, batch AS label, 1 AS extra FROM obs")
def j9(spark, sf):
    return ob.strip_suffix(joins.collect_tables(collect_inputs(spark, sf), "cell_id"), "b")


@query("j10_semi_join", f"""WITH {OBS}, {X} SELECT cell_id, gene_id, value FROM x
  WHERE cell_id IN (SELECT cell_id FROM obs WHERE sample IN (SELECT n_name FROM nation WHERE n_regionkey = 1))""")
def j10(spark, sf):
    names = view.table(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("sample"))
    cells = view.obs(spark, sf).join(names, "sample", "left_semi").select("cell_id")
    return view.x(spark, sf).join(cells, "cell_id", "left_semi")


def feature_frames(spark, sf):
    v = view.var(spark, sf).select(F.col("gene_id").alias("feature_id"), "feature_name", "brand")
    return [v.filter("feature_id % 2 = 0 OR feature_id < 500"), v.filter("feature_id % 3 = 0")]


@query("j11_merge_features_inner", """SELECT p_partkey AS feature_id, p_name AS feature_name, p_brand AS brand FROM part
  WHERE (p_partkey % 2 = 0 OR p_partkey < 500) AND p_partkey % 3 = 0""")
def j11(spark, sf):
    return joins.merge_feature_info(feature_frames(spark, sf), ["feature_name", "brand"], "inner")


@query("j11_merge_features_outer", """SELECT p_partkey AS feature_id, p_name AS feature_name, p_brand AS brand FROM part
  WHERE (p_partkey % 2 = 0 OR p_partkey < 500) OR p_partkey % 3 = 0""")
def j11b(spark, sf):
    return joins.merge_feature_info(feature_frames(spark, sf), ["feature_name", "brand"], "outer")


@query("j12_fill_feature_info", """SELECT p_partkey AS gene_id,
    CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 2 = 0 THEN p_name END AS info,
    CASE WHEN p_partkey % 3 = 0 THEN p_size END AS size FROM part""")
def j12(spark, sf):
    v = view.var(spark, sf)
    first = v.filter("gene_id % 2 = 0").select("gene_id", F.col("feature_name").alias("info"))
    second = v.filter("gene_id % 3 = 0").select("gene_id", F.col("brand").alias("info"), "size")
    return joins.fill_feature_info(v.select("gene_id"), [first, second], "gene_id")


@query("j13_natural_join", """SELECT DISTINCT n_regionkey, r_name, c_mktsegment FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def j13(spark, sf):
    c = view.table(spark, sf, "customer").join(
        view.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", "c_mktsegment")
    r = view.table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.natural_join(c, r, distinct=True)


@query("j14_add_columns", f"""WITH {OBS} SELECT obs.*, n_nationkey FROM obs JOIN nation ON n_name = sample""")
def j14(spark, sf):
    n = view.table(spark, sf, "nation").select(F.col("n_name").alias("sample"), "n_nationkey")
    return joins.natural_join(view.obs(spark, sf), n)


@query("j15_parameter_grid", f"""WITH {OBS}, a AS (SELECT DISTINCT organ, segment FROM obs), b AS (SELECT DISTINCT organ, batch FROM obs)
  SELECT organ, segment, batch, substring(sha256('segment=' || segment || '|batch=' || batch), 1, 10) AS param_id
  FROM a JOIN b USING (organ)""")
def j15(spark, sf):
    lists = view.obs(spark, sf).groupBy("organ").agg(
        F.collect_set("segment").alias("segment"), F.collect_set("batch").alias("batch"))
    return joins.expand_grid(lists, ["segment", "batch"])


# ---------------------------------------------------------------- column expressions


@query("f_text_functions", """SELECT p_partkey AS id, trim('  ' || p_name || ' ') AS trimmed,
    regexp_replace(p_name || '/x', '[ /]', '_', 'g') AS safe, split_part(p_brand, '#', 1) AS first,
    starts_with(p_name, 'red') AS is_red, p_brand || '_' || p_type AS joined FROM part""")
def f_text(spark, sf):
    p = view.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
                    scalar.safe_name(F.concat("p_name", F.lit("/x"))).alias("safe"),
                    scalar.first_token(F.col("p_brand"), "#").alias("first"),
                    F.col("p_name").startswith("red").alias("is_red"),
                    F.concat_ws("_", "p_brand", "p_type").alias("joined"))


@query("f_number_functions", """SELECT o_orderkey AS id, round(ln(1 + o_totalprice), 6) AS l, round(ln(1 + o_totalprice) / ln(10), 6) AS l10,
    round(-log10(o_totalprice / 1e6), 6) AS nl, round(abs(o_totalprice - 1000), 2) AS a,
    'z=' || printf('%.2f', o_totalprice / 1e5) AS text, CASE WHEN o_totalprice / 1e5 > 3 THEN '**' WHEN o_totalprice / 1e5 > 1.5 THEN '*' ELSE '' END AS stars,
    CASE WHEN o_custkey % 2 = 0 AND o_custkey % 3 = 0 THEN 'passed' WHEN o_custkey % 2 = 0 OR o_custkey % 3 = 0
      THEN 'ambiguous' ELSE 'failed' END AS status FROM orders WHERE o_totalprice > 0""")
def f_number(spark, sf):
    o = view.table(spark, sf, "orders").filter("o_totalprice > 0")
    p = F.col("o_totalprice")
    return o.select(F.col("o_orderkey").alias("id"), F.round(F.log1p(p), 6).alias("l"),
                    F.round(scalar.log1p_base(p, 10), 6).alias("l10"), F.round(scalar.neg_log10(p / 1e6), 6).alias("nl"),
                    F.round(F.abs(p - 1000), 2).alias("a"), scalar.significance_stars(p / 1e5).alias("stars"),
                    scalar.rounded_label(p / 1e5, "z=").alias("text"),
                    scalar.two_flag_status(F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0).alias("status"))


@query("f_human_format", """SELECT p_partkey AS id,
    CASE WHEN v < 1000 THEN CAST(v AS VARCHAR) ELSE
      regexp_replace(regexp_replace(printf('%.2f', round(v / pow(10, floor(log10(v)) - 2)) * pow(10, floor(log10(v)) - 2) / 1000), '0+$', ''), '\\.$', '') || 'K' END AS text
  FROM (SELECT p_partkey, (p_partkey % 97) * 1021 + 7 AS v FROM part)""")
def f_human(spark, sf):
    p = view.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    scalar.human_format((F.col("p_partkey") % 97) * 1021 + 7).alias("text"))


@query("f_maps", """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(1 AS DOUBLE) AS a,
    CAST(json_extract(props, '$.k') AS DOUBLE) AS updated FROM events""")
def f_maps(spark, sf):
    e = view.table(spark, sf, "events").withColumn("props", F.replace("props", F.lit('"'), F.lit("'")))
    m = scalar.parse_thresholds(F.col("props"))
    base = F.create_map(F.lit("a"), F.lit(1.0), F.lit("k"), F.lit(-1.0))
    e = e.select("event_id", m.alias("m"), scalar.merge_maps(base, m).alias("u"))
    return scalar.unpack_map(e, "m", ["k"]).select("event_id", "k", F.col("u")["a"].alias("a"), F.col("u")["k"].alias("updated"))


@query("f_organism_guess", """SELECT avg(CASE WHEN p_type = upper(p_type) THEN 1.0 ELSE 0.0 END) AS upper_share,
  CASE WHEN avg(CASE WHEN p_type = upper(p_type) THEN 1.0 ELSE 0.0 END) <= 0.1 THEN 'mouse' ELSE 'human' END AS organism FROM part""")
def f_organism(spark, sf):
    return scalar.organism_guess(view.table(spark, sf, "part"), "p_type")
