"""Corrections, labels and pluggable strategies."""

from __future__ import annotations

from pyspark.sql import functions as F

from heddle.catalog import query
from heddle.catalog.graphs import DIST
from heddle.catalog.matrix import normalized, top_features
from heddle.catalog.relational import scratch
from heddle.catalog.scores import components
from heddle.catalog.tables import r6
from heddle.functions.runtime import cut
from heddle.operators import correct as co, label_models as lm, labels as lb, matrix as mx, metrics as mt, relations as rl, samples as sa
from heddle.operators.neighbors import knn
from heddle.plans import evaluate as ev, integrate as it, registry, view
from heddle.plans.view import EMB, EMB_DIMS, OBS, VAR, X
from heddle.sources import table as tb
from heddle.sources.table import AnnotatedTable


def rounded(df, digits=5):
    return df.select("cell_id", F.transform("v", lambda a: F.round(a, digits)).alias("v"))


def embedded(spark, sf):
    emb = view.emb(spark, sf)
    return AnnotatedTable({"obs": emb.select("cell_id", "label", "batch"), "obsm/X_pca": emb.select("cell_id", "v")})


def coordinates(vectors):
    """All coordinates in long form."""
    return vectors.select("cell_id", F.posexplode("v").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query("b1_unintegrated", f"WITH {EMB_DIMS} SELECT cell_id, CAST(dim AS INTEGER) AS dim, round(val, 6) AS value FROM dims")
def b1(spark, sf):
    return coordinates(it.run_method("unintegrated", embedded(spark, sf), "batch", "embed")["obsm/X_emb"])


@query("b2_combat")
def b2(spark, sf):
    x, feats = top_features(spark, sf, 30)
    vectors, _ = co.combat(x, view.obs(spark, sf), feats, "batch", ["organ"])
    return rounded(vectors)


@query("b3_harmony")
def b3(spark, sf):
    emb = view.emb(spark, sf)
    return rounded(co.harmony(emb, emb, ["batch"], max_rounds=3))


@query("b4_bbknn_neighbors", f"""WITH {DIST} SELECT src, db AS target_key, dst, round(dist, 6) AS dist,
  CAST(row_number() OVER (PARTITION BY src, db ORDER BY dist, dst) AS INTEGER) AS rank FROM pairs QUALIFY rank <= 3""")
def b4(spark, sf):
    edges, _ = co.bbknn(view.emb(spark, sf), "batch")
    return r6(edges, "dist")


@query("b4_bbknn_weights")
def b4b(spark, sf):
    _, weights = co.bbknn(view.emb(spark, sf), "batch")
    return r6(weights, "weight")


@query("b5_mutual_neighbors", f"""WITH {DIST}, e AS (SELECT src, dst, sb, db FROM pairs QUALIFY row_number() OVER (PARTITION BY src, db ORDER BY dist, dst) <= 5),
    f AS (SELECT * FROM e WHERE sb <> db) SELECT src, dst, sb AS a, db AS b FROM f WHERE (dst, src) IN (SELECT (src, dst) FROM f)""")
def b5(spark, sf):
    return co.mutual_neighbors(view.emb(spark, sf), "batch", 5)


@query("b5_panorama")
def b5b(spark, sf):
    return rounded(co.panorama(view.emb(spark, sf), "batch"))


@query("b6_check_and_trim", f"WITH {EMB} SELECT 'obsm/X_emb' AS slot, count(*) AS n FROM emb UNION ALL SELECT 'obs', count(*) FROM emb")
def b6(spark, sf):
    t = embedded(spark, sf)
    t = t.with_slot("obsm/X_emb", t["obsm/X_pca"]).with_slot("X", view.x(spark, sf)).without("obsm/X_pca")
    it.check_output(t, "embed")
    kept = it.remove_slots(t, "embed")
    out = None
    for name, df in kept.slots.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("slot"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("b7_neighbors_by_type", f"""WITH {DIST} SELECT src, dst, round(dist, 6) AS dist FROM pairs QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 9""")
def b7(spark, sf):
    t = embedded(spark, sf)
    out = ev.with_neighbors(t.with_slot("obsm/X_emb", t["obsm/X_pca"]), "embed", 10)
    return r6(out["obsp/distances"].drop("rank"), "dist")


@query("b8_attach_clusters", f"WITH {EMB} SELECT cell_id, label, batch, 'c' || batch AS leiden FROM emb")
def b8(spark, sf):
    t = embedded(spark, sf)
    return it.attach_clusters(t, [t["obs"].select("cell_id", F.concat(F.lit("c"), "batch").alias("leiden"))])["obs"]


# ---------------------------------------------------------------- labels


@query("h1_majority_reference", f"""WITH o AS (SELECT doc_id, source, CASE WHEN quality IS NULL THEN 'nan' ELSE lang || quality END AS ref FROM documents LEFT JOIN labels USING (doc_id)),
    c AS (SELECT source, ref, count(*) AS n FROM o WHERE ref <> 'nan' GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, ref) = 1)
  SELECT doc_id, o.source, o.ref, c.ref AS majority_reference FROM o LEFT JOIN c ON o.source = c.source""")
def h1(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    d = d.select("doc_id", "source", F.when(F.col("quality").isNull(), "nan").otherwise(F.concat("lang", "quality")).alias("ref"))
    return lb.majority_reference(d, "ref", "source")


VOTES = """v AS (SELECT doc_id, CAST(quality AS VARCHAR) AS na_1, CAST(toxic AS VARCHAR) AS na_2, CAST(doc_id % 2 AS VARCHAR) AS na_3,
    CASE WHEN doc_id % 3 = 0 THEN '7' END AS na_4, lang FROM documents LEFT JOIN labels USING (doc_id))"""


def votes(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", F.col("quality").cast("string").alias("na_1"), F.col("toxic").cast("string").alias("na_2"),
                    (F.col("doc_id") % 2).cast("string").alias("na_3"), F.expr("CASE WHEN doc_id % 3 = 0 THEN '7' END").alias("na_4"), "lang")


CONSENSUS = f"""{VOTES}, long AS (SELECT doc_id, unnest([na_1, na_2, na_3, na_4]) AS label FROM v),
  c AS (SELECT doc_id, label, count(*) AS n FROM long GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, label NULLS FIRST) = 1),
  cons AS (SELECT doc_id, CASE WHEN n > 1 THEN label END AS majority_consensus, CASE WHEN n > 1 THEN n / 4 ELSE 0 END AS majority_consensus_agreement FROM c)"""


@query("h2_majority_consensus", f"""WITH {CONSENSUS} SELECT doc_id, majority_consensus, majority_consensus_agreement,
  majority_consensus_agreement <= 0.5 AS majority_consensus_low_agreement FROM cons""")
def h2(spark, sf):
    return lb.majority_consensus(votes(spark, sf), ["na_.*"]).drop("na_1", "na_2", "na_3", "na_4", "lang")


@query("h3_align_labels")
def h3(spark, sf):
    labelled, _, _ = lb.align_labels(view.emb(spark, sf), "batch", "label")
    return labelled


@query("h3_centroid_distances", f"""WITH {EMB_DIMS}, m AS (SELECT batch || ': ' || label AS k, dim, avg(val) AS v FROM dims GROUP BY 1, 2)
  SELECT a.k AS src, b.k AS dst, round(sqrt(sum((a.v - b.v) ** 2)), 6) AS dist FROM m a JOIN m b USING (dim) GROUP BY 1, 2""")
def h3b(spark, sf):
    _, _, distances = lb.align_labels(view.emb(spark, sf), "batch", "label")
    return r6(distances, "dist")


NEAREST = f"""{EMB_DIMS}, m AS (SELECT label, dim, avg(val) AS c FROM dims WHERE batch = '1' GROUP BY 1, 2),
  d AS (SELECT x.cell_id, x.label, m.label AS nearest, sum((x.val - m.c) ** 2) AS d FROM dims x JOIN m USING (dim) WHERE x.batch = '0' GROUP BY 1, 2, 3),
  n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY d, nearest) = 1)"""


@query("h3_assignment_shares", f"""WITH {NEAREST}, c AS (SELECT label, nearest, count(*) AS n FROM n GROUP BY 1, 2)
  SELECT label, nearest, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM c""")
def h3c(spark, sf):
    """Shares in which the labels of one dataset lie nearest to those of another."""
    emb = cut(view.emb(spark, sf), "emb")
    centres = sa.mean_vectors(emb.filter("batch = '1'"), "label").select("label", "v")
    return r6(rl.assignment_shares(rl.nearest_labels(emb.filter("batch = '0'"), centres), "label", "nearest"), "share")


@query("h3_relations")
def h3d(spark, sf):
    """Every row with its group of the lowest level, after all datasets have been put in relation."""
    rows, _, _ = rl.harmonise_labels(view.emb(spark, sf), "batch", "label")
    return rows


@query("h3_relation_rules", """SELECT 'rows' AS rule, count(*) AS n FROM embeddings WHERE label IS NOT NULL
  UNION ALL SELECT 'pairs whose two ends have others', 0 UNION ALL SELECT 'pairs below the limits', 0""")
def h3e(spark, sf):
    """Every row has one group, relations are stars and keep to their limits."""
    rows, _, steps = rl.harmonise_labels(view.emb(spark, sf), "batch", "label")
    ends = steps.select("step", "a", "b", "forward", "backward").join(steps.groupBy("step", "a").agg(F.count(F.lit(1)).alias("na")), ["step", "a"]).join(
        steps.groupBy("step", "b").agg(F.count(F.lit(1)).alias("nb")), ["step", "b"])
    counted = lambda f, rule: f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
    return (
        counted(rows.select("cell_id").distinct(), "rows")
        .unionByName(counted(ends.filter("na > 1 AND nb > 1"), "pairs whose two ends have others"))
        .unionByName(counted(ends.filter("greatest(forward, backward) < 0.4 OR least(forward, backward) <= 0.05"), "pairs below the limits"))
    )


@query("h4_category_differences", """SELECT 'en' AS label, 'renamed' AS "column", 'missing' AS side FROM documents WHERE lang = 'en' GROUP BY lang
  UNION ALL SELECT 'english', 'renamed', 'extra' FROM documents WHERE lang = 'en' GROUP BY lang""")
def h4(spark, sf):
    d = view.table(spark, sf, "documents").select("lang", F.when(F.col("lang") == "en", "english").otherwise(F.col("lang")).alias("renamed"))
    return lb.category_differences(d, ["lang", "renamed"])


@query("h5_predict_labels")
def h5(spark, sf):
    emb = view.emb(spark, sf)
    predict = lb.train_label_model(emb.filter("batch <> '0'"), "label")
    clusters = mt.kmeans_labels(emb, 20).select("cell_id", "cluster")
    return r6(lb.predict_labels(emb, predict, clusters), "conf_score", digits=4)


@query("h5_predict_counts")
def h5_counts(spark, sf):
    """A model fitted on one batch's raw counts, stored as rows and applied to all cells by feature name."""
    o, x, var = view.obs(spark, sf), view.x(spark, sf), view.var(spark, sf)
    model = lm.fit_count_model(x, var, o.filter("batch <> 'P'"), "label")
    out = lm.predict_from_counts(x, var, o, model, "orders", "sample")
    return out.withColumn("orders:conf_score", F.round("`orders:conf_score`", 4))


@query("h6_join_predictions", f"WITH {OBS} SELECT cell_id, label AS m1_label, CASE WHEN batch <> 'P' THEN organ END AS m2_label FROM obs")
def h6(spark, sf):
    o = view.obs(spark, sf)
    return lb.join_predictions(o.select("cell_id"), [o.select("cell_id", F.col("label").alias("m1_label")),
                                                    o.filter("batch <> 'P'").select("cell_id", F.col("organ").alias("m2_label"))])


@query("h7_agreement_statistics", f"""WITH {CONSENSUS}, t AS (SELECT majority_consensus, majority_consensus_agreement, count(*) AS count FROM cons GROUP BY 1, 2)
  SELECT *, CASE WHEN majority_consensus IS NOT NULL THEN CAST(sum(count) OVER w AS BIGINT) END AS total_cells_majority_consensus_label,
    CASE WHEN majority_consensus IS NOT NULL THEN round(count / sum(count) OVER w, 9) END AS frac_cells_in_majority_consensus_label
  FROM t WINDOW w AS (PARTITION BY majority_consensus)""")
def h7(spark, sf):
    out = lb.agreement_statistics(lb.majority_consensus(votes(spark, sf), ["na_.*"]))
    return r6(out, "frac_cells_in_majority_consensus_label", digits=9)


def enrichment_sql(a, b):
    return f"""SELECT '{a}' AS cluster_key, '{b}' AS covariate, round(2 * sum(nij / n * ln(n * nij / (ni * nj))) / (sum(-nij / n * ln(ni / n)) + sum(-nij / n * ln(nj / n))), 6) AS score FROM
      (SELECT *, sum(nij) OVER (PARTITION BY a) AS ni, sum(nij) OVER (PARTITION BY b) AS nj, sum(nij) OVER () AS n FROM
        (SELECT {a} AS a, {b} AS b, count(*) AS nij FROM obs GROUP BY 1, 2))"""


@query("h8_enrichment", f"WITH {OBS} " + " UNION ALL ".join(enrichment_sql(a, b) for a in ("sample", "label") for b in ("organ", "segment")))
def h8(spark, sf):
    return r6(lb.cluster_enrichment(view.obs(spark, sf), ["sample", "label"], ["organ", "segment"]), "score")


@query("h8_cluster_distribution", f"""WITH {OBS} SELECT label, count(*) AS n, min(price) AS min, max(price) AS max, round(quantile_cont(price, 0.25), 4) AS q25,
  round(quantile_cont(price, 0.5), 4) AS median, round(quantile_cont(price, 0.75), 4) AS q75 FROM obs GROUP BY 1""")
def h8b(spark, sf):
    return r6(lb.cluster_distribution(view.obs(spark, sf), "label", "price"), "q25", "median", "q75", digits=4)


@query("h9_alignment_group", f"""WITH {EMB_DIMS}, m AS (SELECT batch || ': ' || label AS k, dim, avg(val) AS v FROM dims WHERE label IN ('2', '5') GROUP BY 1, 2)
  SELECT a.k AS src, b.k AS dst, round(sqrt(sum((a.v - b.v) ** 2)), 6) AS dist FROM m a JOIN m b USING (dim) GROUP BY 1, 2""")
def h9(spark, sf):
    emb = view.emb(spark, sf)
    relation = emb.select(F.col("batch").alias("dataset"), "label").distinct().withColumn(
        "group", F.when(F.col("label").isin("2", "5"), "g1").otherwise("g2"))
    means = sa.mean_vectors(emb.withColumn("cell_id", F.concat_ws(": ", "batch", "label")), "cell_id")
    _, part = lb.alignment_group(relation, sa.distance_matrix(means), "g1")
    return r6(part, "dist")


# ---------------------------------------------------------------- pluggable functions


@query("v1_user_expression", f"WITH {OBS} SELECT cell_id FROM obs WHERE (price > 1000 AND label LIKE '1%') OR donor % 7 = 3")
def v1(spark, sf):
    from heddle.operators.obs import filter_obs

    return filter_obs(view.obs(spark, sf), queries=["(price > 1000 AND label LIKE '1%') OR donor % 7 = 3"], subset=True).select("cell_id")


@query("v2_own_method", f"WITH {EMB_DIMS} SELECT cell_id, CAST(dim AS INTEGER) AS dim, round(val * 2, 6) AS value FROM dims")
def v2(spark, sf):
    @it.method("doubled", "embed")
    def doubled(t, batch, **_):
        return t.with_slot("obsm/X_emb", t["obsm/X_pca"].withColumn("v", F.transform("v", lambda a: a * 2)))

    return coordinates(it.run_method("doubled", embedded(spark, sf), "batch")["obsm/X_emb"])


@query("v3_own_metric", f"WITH {EMB} SELECT 'share_first' AS metric_name, round(avg(CASE WHEN batch = '0' THEN 1.0 ELSE 0.0 END), 6) AS score FROM emb")
def v3(spark, sf):
    own = registry.Metric("share_first", lambda c: c.obs.agg(F.avg((F.col(c.batch) == "0").cast("double")).alias("score")), "bio_conservation", ("embed",))
    registry.METRICS.setdefault("share_first", own)
    given = registry.MetricInput(embedded(spark, sf), "batch", "label", "embed")
    return r6(registry.run_metric("share_first", given).select("metric_name", "score"), "score")


@query("v4_subset_strategy", f"""WITH {OBS}, s AS (SELECT organ, count(*) AS n, md5('42|' || organ) AS h FROM obs GROUP BY 1 HAVING count(*) >= 100),
    r AS (SELECT organ, sum(n) OVER (ORDER BY h) - n AS before FROM s)
  SELECT cell_id, organ FROM obs WHERE organ IN (SELECT organ FROM r WHERE before <= 4000)""")
def v4(spark, sf):
    return registry.SUBSET_STRATEGIES["by_sample"](view.obs(spark, sf).select("cell_id", "organ"), 4000, "organ")


@query("v5_sample_method", """WITH c AS (SELECT o_custkey % 40 AS s, o_orderstatus AS t, count(*) AS n FROM orders GROUP BY 1, 2), y AS (SELECT DISTINCT t FROM c),
    p AS (SELECT z.s, y.t, coalesce(n, 0) / z.n_all AS p FROM (SELECT s, sum(n) AS n_all FROM c GROUP BY 1) z CROSS JOIN y LEFT JOIN c ON c.s = z.s AND c.t = y.t)
  SELECT a.s AS src, b.s AS dst, round(sqrt(sum((a.p - b.p) ** 2)), 6) AS dist FROM p a JOIN p b USING (t) GROUP BY 1, 2""")
def v5(spark, sf):
    o = view.obs(spark, sf).select((F.col("donor") % 40).alias("s"), "batch")
    return r6(sa.SAMPLE_METHODS["composition"](o, "s", "batch"), "dist")


@query("v6_map_layers", f"WITH {X} SELECT cell_id, gene_id, value + 1 AS value FROM x")
def v6(spark, sf):
    t = AnnotatedTable({"layers/counts": view.x(spark, sf), "X": view.x(spark, sf)})
    out = t.map_layers(lambda d: d.withColumn("value", F.col("value") + 1), ["layers/counts", "layers/none"])
    return out["layers/counts"]


@query("s3_slot_exists", "SELECT TRUE AS has_obs, TRUE AS has_column, FALSE AS has_layer, count(*) AS n FROM orders")
def s3(spark, sf):
    path = scratch(spark, "table")
    view.annotated(spark, sf).save(path)
    flags = {"has_obs": "obs", "has_column": "obs/batch", "has_layer": "layers/counts"}
    found = {k: F.lit(tb.slot_exists(spark, path, v)) for k, v in flags.items()}
    return tb.load(spark, path, ["obs"])["obs"].agg(F.count("*").alias("n")).withColumns(found)


@query("s10_empty_input", "SELECT count(*) AS n_all, 0 AS n_norm, 0 AS n_scores, 0 AS n_edges, 0 AS n_hv FROM orders")
def s10(spark, sf):
    """Every step on an empty part of the table gives an empty result of the right shape."""
    o = view.obs(spark, sf)
    none = o.filter("cell_id < 0")
    x = normalized(spark, sf).join(none.select("cell_id"), "cell_id", "left_semi")
    scores, _, _ = mx.matrix_pca(x, none, view.var(spark, sf), 5)
    parts = {"n_norm": x, "n_scores": scores, "n_edges": knn(scores, 5),
             "n_hv": mx.highly_variable(x, none, view.var(spark, sf), n_top=5).filter("highly_variable")}
    counts = {k: d.agg(F.count("*").cast("int")).scalar() for k, d in parts.items()}
    return o.agg(F.count("*").alias("n_all")).withColumns(counts)


@query("preprocess_flow")
def preprocess_flow(spark, sf):
    """Normalise, select, reduce and link a table in one call."""
    emb = components(spark, sf)
    t = AnnotatedTable({"obs": emb.select("cell_id", "batch"), "X": view.x(spark, sf), "var": view.var(spark, sf)})
    out = it.preprocess(t)
    counts = cut(out["obsp/distances"].groupBy("src").agg(F.count("*").alias("n_neighbors")))
    return counts.groupBy("n_neighbors").agg(F.count("*").alias("n_cells"))
