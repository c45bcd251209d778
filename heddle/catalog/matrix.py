"""Normalisation, feature selection, components and set scores."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heddle.catalog import query
from heddle.catalog.tables import r6
from heddle.functions.runtime import cut
from heddle.operators import matrix as mx, window as win
from heddle.plans import view
from heddle.plans.view import OBS, VAR, X

NORM = f"""{X}, tot AS (SELECT cell_id, sum(value) AS t FROM x GROUP BY 1),
  norm AS (SELECT cell_id, gene_id, value * (SELECT median(t) FROM tot WHERE t > 0) / t AS value FROM x JOIN tot USING (cell_id))"""


def normalized(spark, sf):
    return mx.log1p(mx.normalize_total(view.x(spark, sf)))


@query("m1_normalize_total", f"WITH {NORM} SELECT cell_id, gene_id, round(value, 6) AS value FROM norm")
def m1(spark, sf):
    return r6(mx.normalize_total(view.x(spark, sf)), "value")


@query("m1_normalize_fixed", f"WITH {X} SELECT cell_id, gene_id, round(value * 100 / sum(value) OVER (PARTITION BY cell_id), 6) AS value FROM x")
def m1b(spark, sf):
    return r6(mx.normalize_total(view.x(spark, sf), 100), "value")


@query("m2_log1p", f"WITH {NORM} SELECT cell_id, gene_id, round(ln(1 + value), 6) AS value FROM norm")
def m2(spark, sf):
    return r6(normalized(spark, sf), "value")


@query("m3_scale", f"""WITH {X}, {VAR}, g AS (SELECT gene_id FROM var WHERE brand = 'Brand#3' AND size > 40), n AS (SELECT count(*) AS n FROM orders),
    m AS (SELECT gene_id, sum(value) / any_value(n) AS m, sqrt((sum(value * value) - sum(value) ** 2 / any_value(n)) / (any_value(n) - 1)) AS sd
      FROM x JOIN g USING (gene_id), n GROUP BY 1)
  SELECT o_orderkey AS cell_id, m.gene_id, round(greatest(least((coalesce(value, 0) - m) / sd, 10), -10), 6) AS value
  FROM orders CROSS JOIN m LEFT JOIN x ON x.cell_id = o_orderkey AND x.gene_id = m.gene_id""")
def m3(spark, sf):
    feats = view.var(spark, sf).filter("brand = 'Brand#3' AND size > 40")
    return r6(mx.scale(view.x(spark, sf), view.obs(spark, sf), feats), "value")


def dispersion_sql(source, keys):
    """Statements from linear values to normalised dispersions (all features, per key)."""
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    on = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    return f"""sizes AS (SELECT {k}count(*) AS n FROM {source[0]} {'GROUP BY ' + ', '.join(keys) if keys else ''}),
  st AS (SELECT {k}gene_id, sum(v) / any_value(n) AS mean, (sum(v * v) - sum(v) ** 2 / any_value(n)) / (any_value(n) - 1) AS var
    FROM {source[1]} JOIN sizes {on} GROUP BY {k}gene_id),
  lg AS (SELECT {k}gene_id, ln(1 + mean) AS means, CASE WHEN var > 0 THEN ln(var / mean) END AS dispersions FROM st),
  bn AS (SELECT *, least(greatest(ceil((means - min(means) OVER w) / (max(means) OVER w - min(means) OVER w) * 20), 1), 20) AS bin FROM lg WINDOW w AS ({part})),
  nd AS (SELECT *, CASE WHEN stddev_samp(dispersions) OVER w IS NULL THEN CASE WHEN dispersions IS NOT NULL THEN 1.0 END
      ELSE (dispersions - avg(dispersions) OVER w) / stddev_samp(dispersions) OVER w END AS dispersions_norm
    FROM bn WINDOW w AS (PARTITION BY {k}bin))"""


@query("m4_highly_variable", f"""WITH {NORM}, l AS (SELECT gene_id, value AS v FROM norm), {dispersion_sql(('orders', 'l'), [])},
    t AS (SELECT gene_id FROM nd WHERE dispersions_norm IS NOT NULL ORDER BY dispersions_norm DESC, gene_id LIMIT 200)
  SELECT gene_id, round(means, 6) AS means, round(dispersions, 6) AS dispersions, round(dispersions_norm, 6) AS dispersions_norm,
    gene_id IN (SELECT gene_id FROM t) AS highly_variable FROM nd""")
def m4(spark, sf):
    out = mx.highly_variable(normalized(spark, sf), view.obs(spark, sf), view.var(spark, sf), n_top=200)
    return r6(out, "means", "dispersions", "dispersions_norm")


@query("m4_highly_variable_cutoffs", f"""WITH {NORM}, l AS (SELECT gene_id, value AS v FROM norm), {dispersion_sql(('orders', 'l'), [])}
  SELECT gene_id, coalesce(means BETWEEN 0.0125 AND 3 AND dispersions_norm >= 0.5, FALSE) AS highly_variable FROM nd""")
def m4b(spark, sf):
    return mx.highly_variable(normalized(spark, sf), view.obs(spark, sf), view.var(spark, sf)).select("gene_id", "highly_variable")


@query("m4_highly_variable_batches", f"""WITH {OBS}, {NORM}, l AS (SELECT batch, gene_id, value AS v FROM norm JOIN obs USING (cell_id)),
    {dispersion_sql(('obs', 'l'), ['batch'])},
    h AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY dispersions_norm DESC NULLS LAST, gene_id) <= 200 AND dispersions_norm IS NOT NULL AS hv FROM nd),
    c AS (SELECT gene_id, sum(means) / 3 AS means, coalesce(sum(dispersions), 0) / 3 AS dispersions, coalesce(sum(dispersions_norm), 0) / 3 AS dispersions_norm,
      count(*) FILTER (hv) AS highly_variable_nbatches FROM h GROUP BY 1)
  SELECT gene_id, round(means, 6) AS means, round(dispersions, 6) AS dispersions, round(dispersions_norm, 6) AS dispersions_norm,
    highly_variable_nbatches, row_number() OVER (ORDER BY highly_variable_nbatches DESC, dispersions_norm DESC, gene_id) <= 200 AS highly_variable FROM c""")
def m4c(spark, sf):
    out = mx.highly_variable(normalized(spark, sf), view.obs(spark, sf), view.var(spark, sf), n_top=200, batch="batch")
    return r6(out, "means", "dispersions", "dispersions_norm")


@query("m5_extra_features", f"""WITH {OBS}, {VAR}, {NORM}, l AS (SELECT organ, gene_id, value AS v FROM norm JOIN obs USING (cell_id)
      WHERE gene_id NOT IN (SELECT gene_id FROM var WHERE regexp_matches(feature_name, 'ring$'))),
    {dispersion_sql(('obs', 'l'), ['organ'])},
    h AS (SELECT *, row_number() OVER (PARTITION BY organ ORDER BY dispersions_norm DESC NULLS LAST, gene_id) <= 100 AND dispersions_norm IS NOT NULL AS hv FROM nd),
    u AS (SELECT gene_id, bool_or(hv) AS hv FROM h GROUP BY 1)
  SELECT gene_id, coalesce(hv, FALSE) OR regexp_matches(feature_name, '^hot') AS "extra_hvgs--n_top=100" FROM var LEFT JOIN u USING (gene_id)""")
def m5(spark, sf):
    return mx.extra_features(normalized(spark, sf), view.obs(spark, sf), view.var(spark, sf), ["organ"], extra=["^hot"],
                             remove=["ring$"], n_top=50, overwrite={"n_top": 100})


@query("u5_union_of_masks", f"""WITH {OBS}, {NORM}, l AS (SELECT segment, gene_id, value AS v FROM norm JOIN obs USING (cell_id)),
    {dispersion_sql(('obs', 'l'), ['segment'])},
    u AS (SELECT gene_id, bool_or(coalesce(means BETWEEN 0.0125 AND 3 AND dispersions_norm >= 0.5, FALSE)) AS hv FROM nd GROUP BY 1)
  SELECT p_partkey AS gene_id, coalesce(hv, FALSE) AS extra_hvgs FROM part LEFT JOIN u ON gene_id = p_partkey""")
def u5(spark, sf):
    return mx.extra_features(normalized(spark, sf), view.obs(spark, sf), view.var(spark, sf), ["segment"])


def top_features(spark, sf, n=50):
    x = cut(normalized(spark, sf), "norm")
    hv = mx.highly_variable(x, view.obs(spark, sf), view.var(spark, sf), n_top=n)
    return x, hv.filter("highly_variable").select("gene_id")


@query("m6_pca_matrix")
def m6(spark, sf):
    x, feats = top_features(spark, sf, 2000)
    scores, _, _ = mx.matrix_pca(x, view.obs(spark, sf), feats, scaled=True)
    return scores.select("cell_id", F.transform("v", lambda a: F.round(a, 6)).alias("v"))


@query("m6_pca_invariants", f"""WITH {NORM}, l AS (SELECT gene_id, ln(1 + value) AS v FROM norm), lin AS (SELECT gene_id, value AS v FROM norm),
    {dispersion_sql(('orders', 'lin'), [])},
    f AS (SELECT gene_id FROM nd WHERE dispersions_norm IS NOT NULL ORDER BY dispersions_norm DESC, gene_id LIMIT 2000),
    m AS (SELECT gene_id, sum(v) / any_value(n) AS mu, sqrt((sum(v * v) - sum(v) ** 2 / any_value(n)) / (any_value(n) - 1)) AS sd, any_value(n) AS n
      FROM l JOIN f USING (gene_id), (SELECT count(*) AS n FROM orders) GROUP BY 1),
    z AS (SELECT gene_id, n, greatest(least((v - mu) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 10), -10) AS z,
      greatest(least(-mu / CASE WHEN sd > 0 THEN sd ELSE 1 END, 10), -10) AS z0 FROM l JOIN m USING (gene_id)),
    g AS (SELECT (sum(z * z) + (any_value(n) - count(*)) * any_value(z0) ** 2
      - (sum(z) + (any_value(n) - count(*)) * any_value(z0)) ** 2 / any_value(n)) / (any_value(n) - 1) AS variance FROM z GROUP BY gene_id)
  SELECT CAST(50 AS BIGINT) AS n_comps, round(sum(variance), 4) AS total_variance, TRUE AS loadings_orthonormal, TRUE AS scores_uncorrelated, TRUE AS falling FROM g""")
def m6i(spark, sf):
    """What holds for components of any matrix, over all rows and features of the defaults."""
    x, feats = top_features(spark, sf, 2000)
    scores, loadings, variance = (cut(t) for t in mx.matrix_pca(x, view.obs(spark, sf), feats, scaled=True))

    def products(t):  # upper triangle of the vectors' cross products
        pairs = F.expr("flatten(transform(v, (a, i) -> transform(filter(v, (b, j) -> j >= i), (b, j) -> struct(i AS i, i + j AS j, a * b AS p))))")
        return t.select(F.explode(pairs).alias("e")).groupBy("e.i", "e.j").agg(F.sum("e.p").alias("p"))

    ahead = Window.orderBy("pc")
    steps = variance.withColumn("_less", F.col("variance") <= F.lag("variance").over(ahead) + 1e-9)
    facts = variance.agg(
        F.count(F.lit(1)).alias("n_comps"), F.round(F.max(F.col("variance") / F.col("variance_ratio")), 4).alias("total_variance")
    )
    off = F.abs(F.col("p") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    unit = products(loadings).agg((F.max(off) < 1e-8).alias("loadings_orthonormal"))
    spread = variance.select(F.col("pc").alias("i"), "variance")
    n = F.lit(float(scores.count() - 1))
    want = F.when(F.col("i") == F.col("j"), F.col("variance")).otherwise(0.0)
    apart = products(scores).join(spread, "i").agg((F.max(F.abs(F.col("p") / n - want)) < 1e-6).alias("scores_uncorrelated"))
    return facts.crossJoin(unit).crossJoin(apart).crossJoin(steps.agg(F.every(F.coalesce("_less", F.lit(True))).alias("falling")))


@query("m6_pca_variance", f"""WITH d AS (SELECT unnest(range(64)) AS dim, unnest(embedding::DOUBLE[]) AS val FROM embeddings),
    v AS (SELECT dim, var_samp(val) AS v FROM d GROUP BY 1) SELECT round(sum(v), 6) AS total_variance, CAST(1 AS DOUBLE) AS ratio FROM v""")
def m6b(spark, sf):
    _, _, variance = mx.pca(view.emb(spark, sf), 64)
    return variance.agg(F.round(F.sum("variance"), 6).alias("total_variance"), F.round(F.sum("variance_ratio"), 6).alias("ratio"))


@query("m6_pca_loadings")
def m6c(spark, sf):
    _, loadings, _ = mx.pca(view.emb(spark, sf), 8)
    return loadings.select("idx", F.transform("v", lambda a: F.round(a, 6)).alias("v"))


@query("m7_assemble", f"""WITH {NORM}, l AS (SELECT gene_id, value AS v FROM norm WHERE gene_id % 3 <> 0), {dispersion_sql(('orders', 'l'), [])},
    t AS (SELECT gene_id FROM nd WHERE dispersions_norm IS NOT NULL ORDER BY dispersions_norm DESC, gene_id LIMIT 100)
  SELECT p_partkey AS gene_id, p_name AS feature_name, p_partkey IN (SELECT gene_id FROM t) AS highly_variable FROM part""")
def m7(spark, sf):
    from heddle.sources.table import AnnotatedTable

    t = view.annotated(spark, sf)
    x = normalized(spark, sf).filter("gene_id % 3 <> 0")
    hv = mx.highly_variable(x, t["obs"], t["var"], n_top=100).select("gene_id", "highly_variable")
    out = mx.assemble([t, AnnotatedTable({"layers/normcounts": x}), AnnotatedTable({"var": hv})], {"highly_variable": False})
    return out["var"].select("gene_id", "feature_name", "highly_variable")


def score_sql(sets, batch=None, cells="orders", n_perm=None):
    k = "batch, " if batch else ""
    grid = "(SELECT batch, count(*) AS n FROM obs GROUP BY 1)" if batch else "(SELECT count(*) AS n FROM orders)"
    xs = "(SELECT batch, gene_id, sum(value) AS s FROM x JOIN obs USING (cell_id) GROUP BY 1, 2)" if batch else "(SELECT gene_id, sum(value) AS s FROM x GROUP BY 1)"
    part = "PARTITION BY batch" if batch else ""
    both = "batch, gene_id" if batch else "gene_id"
    return f"""{sets},
  mn AS (SELECT {k}gene_id, coalesce(s, 0) / n AS mean FROM var CROSS JOIN {grid} LEFT JOIN {xs} USING ({both})),
  bn AS (SELECT {k}gene_id, floor(rank() OVER ({part} ORDER BY mean) / greatest(round(count(*) OVER ({part}) / 24), 1)) AS bin FROM mn),
  mem AS (SELECT {k}set_id, gene_id, bin FROM sets JOIN bn USING (gene_id)),
  ctl AS (SELECT {k}set_id, gene_id FROM (SELECT DISTINCT {k}set_id, bin FROM mem) JOIN bn USING ({k}bin)
    WHERE (set_id, gene_id) NOT IN (SELECT (set_id, gene_id) FROM sets)
    QUALIFY row_number() OVER (PARTITION BY {k}set_id, bin ORDER BY md5('0|' || gene_id), gene_id) <= 50),
  tag AS (SELECT {k}set_id, gene_id, 1 AS side FROM mem UNION ALL SELECT {k}set_id, gene_id, -1 FROM ctl),
  wt AS (SELECT {k}set_id, gene_id, side / count(*) OVER (PARTITION BY {k}set_id, side) AS w FROM tag),
  sc AS (SELECT cell_id, set_id, sum(value * w) AS score FROM {'(SELECT x.*, batch FROM x JOIN obs USING (cell_id))' if batch else 'x'}
    JOIN wt USING ({both}) GROUP BY 1, 2),
  scores AS (SELECT o_orderkey AS cell_id, a.set_id, coalesce(score, 0) AS score FROM orders CROSS JOIN (SELECT DISTINCT set_id FROM sets) a
    LEFT JOIN sc ON sc.cell_id = o_orderkey AND sc.set_id = a.set_id)"""


TYPE_SETS = "sets AS (SELECT gene_set AS set_id, gene_id FROM var)"
CYCLE_SETS = """sets AS (SELECT 'S' AS set_id, gene_id FROM var WHERE brand = 'Brand#4'
  UNION ALL SELECT 'G2M', gene_id FROM var WHERE brand = 'Brand#5')"""


def cycle_sets(spark, sf):
    v = view.var(spark, sf)
    return mx.stack_sets({"S": v.filter("brand = 'Brand#4'"), "G2M": v.filter("brand = 'Brand#5'")})


@query("m8_score_sets", f"WITH {X}, {VAR}, {score_sql(TYPE_SETS)} SELECT cell_id, set_id, round(score, 6) AS score FROM scores")
def m8(spark, sf):
    sets = view.var(spark, sf).select(F.col("gene_set").alias("set_id"), "gene_id")
    return r6(mx.score_sets(view.x(spark, sf), view.obs(spark, sf), view.var(spark, sf), sets), "score")


RANDOM_SETS = f"""sz AS (SELECT 'S' AS set_id, count(*) AS n FROM var WHERE brand = 'Brand#4' UNION ALL SELECT 'G2M', count(*) FROM var WHERE brand = 'Brand#5'),
  pl AS (SELECT set_id || '--' || p AS set_id, n FROM sz, (SELECT unnest([0, 1, 2]) AS p)),
  sets AS (SELECT set_id, gene_id FROM pl, var QUALIFY row_number() OVER (PARTITION BY set_id ORDER BY md5('0|' || set_id || ':' || gene_id), set_id || ':' || gene_id) <= n)"""


@query("m9_random_set_scores", f"WITH {X}, {VAR}, {score_sql(RANDOM_SETS)} SELECT cell_id, set_id, round(score, 6) AS score FROM scores")
def m9(spark, sf):
    v = view.var(spark, sf)
    sets = mx.random_sets(v, cycle_sets(spark, sf), 3)
    return r6(mx.score_sets(view.x(spark, sf), view.obs(spark, sf), v, sets), "score")


@query("m10_cell_cycle_scores", f"WITH {OBS}, {X}, {VAR}, {score_sql(CYCLE_SETS, batch=True)} SELECT cell_id, set_id, round(score, 6) AS score FROM scores")
def m10(spark, sf):
    out = mx.score_sets(view.x(spark, sf), view.obs(spark, sf), view.var(spark, sf), cycle_sets(spark, sf), batch="batch")
    return r6(out, "score")


@query("m11_quantile_bins", f"""WITH {X}, q AS (SELECT gene_id, quantile_cont(value, [0.2, 0.4, 0.6, 0.8]) AS c FROM x GROUP BY 1)
  SELECT cell_id, gene_id, CAST(len(list_filter(c, lambda y: y <= value)) AS INTEGER) AS bin FROM x JOIN q USING (gene_id)""")
def m11(spark, sf):
    return win.quantile_bins(view.x(spark, sf), ["gene_id"], "value", 5).drop("value")


@query("m12_integration_features", f"""WITH {X}, {VAR}, c AS (SELECT gene_id, count(*) FILTER (value > 0) AS n FROM x GROUP BY 1)
  SELECT gene_id, size > 10 AND coalesce(n, 0) >= 30 AS integration_features FROM var LEFT JOIN c USING (gene_id)""")
def m12(spark, sf):
    return mx.integration_features(view.x(spark, sf), view.var(spark, sf), "size > 10", 30)


@query("m13_dense_and_back", f"WITH {X}, {VAR} SELECT cell_id, gene_id, value FROM x JOIN var USING (gene_id) WHERE brand = 'Brand#9'")
def m13(spark, sf):
    feats = view.var(spark, sf).filter("brand = 'Brand#9'")
    index = cut(mx.feature_index(feats))
    return mx.from_vectors(mx.to_vectors(view.x(spark, sf), view.obs(spark, sf), index, index.count()), index)


@query("m14_matrix_differences", f"WITH {X} SELECT count(*) FILTER (cell_id % 7 = 0 OR gene_id % 11 = 0) AS n_different FROM x")
def m14(spark, sf):
    x = view.x(spark, sf)
    other = x.filter("gene_id % 11 <> 0").withColumn("value", F.expr("CASE WHEN cell_id % 7 = 0 THEN value + 1 ELSE value END"))
    return mx.matrix_differences(x, other)
