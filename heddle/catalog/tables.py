"""Aggregations, windows, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from heddle.catalog import query
from heddle.functions.ordering import running_index
from heddle.functions.runtime import cut, quoted
from heddle.operators import aggregate as ag, sample as sm, sets, window as win
from heddle.operators.joins import first_per_key
from heddle.plans import view
from heddle.plans.view import OBS, VAR, X

QC_PATTERNS = {"mito": "^red", "ribo": "ring$|rod$", "hb": "^hot"}
QC = f"""{OBS}, {X}, {VAR}, q AS (
  SELECT cell_id, sum(value) AS n_counts, count(*) FILTER (value <> 0) AS n_genes,
    sum(CASE WHEN regexp_matches(feature_name, '^red') THEN value ELSE 0 END) AS s_mito,
    sum(CASE WHEN regexp_matches(feature_name, 'ring$|rod$') THEN value ELSE 0 END) AS s_ribo,
    sum(CASE WHEN regexp_matches(feature_name, '^hot') THEN value ELSE 0 END) AS s_hb
  FROM x JOIN var USING (gene_id) GROUP BY 1),
qc AS (SELECT obs.*, coalesce(n_counts, 0) AS n_counts, coalesce(n_genes, 0) AS n_genes,
    coalesce(100 * s_mito / n_counts, 0) AS percent_mito, coalesce(100 * s_ribo / n_counts, 0) AS percent_ribo,
    coalesce(100 * s_hb / n_counts, 0) AS percent_hb FROM obs LEFT JOIN q USING (cell_id))"""


def qc_obs(spark, sf):
    return ag.qc_metrics(view.obs(spark, sf), view.x(spark, sf), view.var(spark, sf), QC_PATTERNS)


def r6(df, *cols, digits=6):
    return df.withColumns({c: F.round(quoted(c), digits) for c in cols})


@query("a1_value_counts", "SELECT lang, quality, count(*) AS count FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2")
def a1(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    return ag.value_counts(d, "lang", "quality", dropna=False)


@query("a2_qc_metrics", f"""WITH {QC} SELECT cell_id, n_counts, n_genes, round(percent_mito, 6) AS percent_mito,
  round(percent_ribo, 6) AS percent_ribo, round(percent_hb, 6) AS percent_hb FROM qc""")
def a2(spark, sf):
    out = qc_obs(spark, sf).select("cell_id", "n_counts", "n_genes", "percent_mito", "percent_ribo", "percent_hb")
    return r6(out, "percent_mito", "percent_ribo", "percent_hb")


@query("a3_dataset_summary", f"""WITH {QC}, s AS (SELECT sample, count(*) AS n FROM obs GROUP BY 1),
    d AS (SELECT donor, count(*) AS n FROM obs GROUP BY 1)
  SELECT (SELECT count(*) FROM obs) AS n_cells, (SELECT count(*) FROM var) AS n_genes,
    (SELECT count(*) FROM s) AS n_samples, (SELECT round(avg(n), 6) FROM s) AS mean_cells_per_sample,
    (SELECT count(*) FROM d) AS n_donors, (SELECT round(avg(n), 6) FROM d) AS mean_cells_per_donor,
    (SELECT median(n) FROM s) AS median_cells_per_sample, (SELECT median(n) FROM d) AS median_cells_per_donor,
    (SELECT median(n_counts) FROM qc) AS median_counts_per_cell, (SELECT median(n_genes) FROM qc) AS median_genes_per_cell,
    (SELECT string_agg(batch, ',' ORDER BY batch) FROM (SELECT DISTINCT batch FROM obs)) AS batch,
    (SELECT string_agg(organ, ',' ORDER BY organ) FROM (SELECT DISTINCT organ FROM obs)) AS organ""")
def a3(spark, sf):
    out = ag.dataset_summary(qc_obs(spark, sf), view.var(spark, sf), "sample", "donor", ["batch", "organ"])
    return r6(out, "mean_cells_per_sample", "mean_cells_per_donor")


@query("a4_total_summary", f"WITH {OBS} SELECT count(*) AS n_cells, count(DISTINCT donor) AS n_donors FROM obs")
def a4(spark, sf):
    o = view.obs(spark, sf)
    parts = [o.filter(F.col("donor") % 3 == i).agg(F.count("*").alias("n_cells"), F.countDistinct("donor").alias("n_donors"))
             for i in range(3)]
    return ag.total_summary(parts, ["n_cells", "n_donors"])


@query("a5_pseudobulk_sum", f"""WITH {OBS}, {X} SELECT sample, gene_id, sum(value) AS value FROM x JOIN obs USING (cell_id)
  WHERE sample IN (SELECT sample FROM obs GROUP BY 1 HAVING count(*) > 1) GROUP BY 1, 2""")
def a5(spark, sf):
    return ag.pseudobulk(view.obs(spark, sf), view.x(spark, sf), ["sample"])


@query("a5_pseudobulk_mean", f"""WITH {OBS}, {X}, n AS (SELECT label, count(*) AS n FROM obs GROUP BY 1 HAVING count(*) > 1)
  SELECT label, gene_id, round(sum(value) / any_value(n), 9) AS value FROM x JOIN obs USING (cell_id) JOIN n USING (label) GROUP BY 1, 2""")
def a5b(spark, sf):
    return r6(ag.pseudobulk(view.obs(spark, sf), view.x(spark, sf), ["label"], "mean"), "value", digits=9)


@query("a6_group_metadata", f"""WITH {OBS} SELECT arg_min(cell_id, cell_id) AS cell_id, arg_min(batch, cell_id) AS batch,
  arg_min(sample, cell_id) AS sample, donor FROM obs GROUP BY donor HAVING count(*) > 1""")
def a6(spark, sf):
    return ag.group_metadata(view.obs(spark, sf).select("cell_id", "batch", "sample", "donor"), "donor")


@query("a7_pseudobulk_pairs", f"""WITH {OBS}, {X}, g AS (SELECT cell_id, label || '_' || sample AS pseudo_group FROM obs)
  SELECT pseudo_group, gene_id, sum(value) AS value FROM x JOIN g USING (cell_id)
  WHERE pseudo_group IN (SELECT pseudo_group FROM g GROUP BY 1 HAVING count(*) > 1) GROUP BY 1, 2""")
def a7(spark, sf):
    return ag.pseudobulk(ag.pair_group(view.obs(spark, sf), "label", "sample"), view.x(spark, sf), ["pseudo_group"])


@query("a8_detected_features", f"""WITH {X}, {VAR}, s AS (SELECT gene_id, count(*) FILTER (value > 0) AS n FROM x GROUP BY 1)
  SELECT gene_id, coalesce(n, 0) AS n_cells, coalesce(n, 0) >= 28 AS nonzero_genes FROM var LEFT JOIN s USING (gene_id)""")
def a8(spark, sf):
    return ag.detected_features(view.x(spark, sf), view.var(spark, sf), 28)


@query("a9_large_batches", """SELECT doc_id, source, count(*) OVER (PARTITION BY source, lang) >= 2 AS batch_kept,
  source || lang AS b FROM documents""")
def a9(spark, sf):
    d = view.table(spark, sf, "documents").select("doc_id", "source", F.concat("source", "lang").alias("b"))
    return ag.large_batches(d, "b")


@query("a10_first_per_key", f"""WITH {OBS} SELECT donor, arg_max(cell_id, price) AS cell_id, max(price) AS price FROM obs GROUP BY 1""")
def a10(spark, sf):
    o = view.obs(spark, sf).select("donor", "cell_id", "price")
    return first_per_key(o, ["donor"], [-F.col("price"), "cell_id"])


@query("a10_unique_rows", "SELECT DISTINCT event_type, props FROM events")
def a10b(spark, sf):
    e = view.table(spark, sf, "events").select("event_type", F.from_json("props", "map<string,int>").alias("m"))
    return ag.unique_rows(e).select("event_type", F.concat(F.lit('{"k": '), F.col("m")["k"], F.lit("}")).alias("props"))


LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("a11_crosstab", f"WITH {OBS} SELECT organ, " + ", ".join(f"count(*) FILTER (label = '{v}') AS \"{v}\"" for v in LABELS) + " FROM obs GROUP BY 1")
def a11(spark, sf):
    return ag.crosstab(view.obs(spark, sf), "organ", "label")


@query("a11_crosstab_share", f"WITH {OBS} SELECT organ, " + ", ".join(
    f"round(count(*) FILTER (label = '{v}') / count(*), 6) AS \"{v}\"" for v in LABELS) + " FROM obs GROUP BY 1")
def a11b(spark, sf):
    return r6(ag.crosstab(view.obs(spark, sf), "organ", "label", normalize=True), *LABELS)


@query("a12_pivot_mean", "SELECT user_id, " + ", ".join(
    f"round(avg(value) FILTER (event_type = '{v}'), 6) AS {v}" for v in ["click", "error", "purchase", "signup", "view"]) + " FROM events GROUP BY 1")
def a12(spark, sf):
    return r6(ag.pivot_mean(view.table(spark, sf, "events"), ["user_id"], "event_type", "value"),
              "click", "error", "purchase", "signup", "view")


@query("a13_fraction_removed", f"""WITH {OBS}, s AS (SELECT sample, CASE WHEN price < 50000 THEN 'failed'
    WHEN price < 100000 THEN 'ambiguous' ELSE 'passed' END AS st FROM obs)
  SELECT sample, count(*) FILTER (st = 'passed') AS passed, count(*) FILTER (st = 'failed') AS failed,
    count(*) FILTER (st = 'ambiguous') AS ambiguous, round(count(*) FILTER (st = 'failed') / count(*), 2) AS fraction_removed
  FROM s GROUP BY 1""")
def a13(spark, sf):
    o = view.obs(spark, sf).withColumn("qc_status", F.expr(
        "CASE WHEN price < 50000 THEN 'failed' WHEN price < 100000 THEN 'ambiguous' ELSE 'passed' END"))
    return ag.fraction_removed(o, "sample")


@query("a14_composition", f"""WITH {OBS}, c AS (SELECT organ, label, count(*) AS count FROM obs GROUP BY 1, 2)
  SELECT organ, label, count, CAST(sum(count) OVER (PARTITION BY organ) AS BIGINT) AS total,
    round(count / sum(count) OVER (PARTITION BY organ), 6) AS proportion FROM c""")
def a14(spark, sf):
    return r6(ag.composition(view.obs(spark, sf), "organ", "label"), "proportion")


BOUNDS = {
    "sctk_autoqc": {"n_counts": (10.0, 400.0), "n_genes": (1.0, 10.0), "percent_mito": (None, None)},
    "user": {"n_counts": (30.0, 300.0), "n_genes": (2.0, 8.0), "percent_mito": (0.0, 60.0)},
    "alternative": {"n_counts": (20.0, 350.0), "n_genes": (2.0, 9.0), "percent_mito": (0.0, 80.0)},
    "updated": {"n_counts": (30.0, 300.0), "n_genes": (2.0, 8.0), "percent_mito": (0.0, 60.0)},
}


def bounds_sql(name):
    b = BOUNDS[name]
    sql = lambda v: "NULL" if v is None else repr(v)
    test = " AND ".join(f"coalesce({k} BETWEEN {sql(lo)} AND {sql(hi)}, FALSE)" for k, (lo, hi) in b.items())
    cols = ", ".join(f"CAST({sql(v)} AS DOUBLE) AS {k}_{s}" for k, p in b.items() for s, v in zip(("min", "max"), p))
    return f"""SELECT '{name}' AS threshold_type, {cols}, count(*) AS n_total, count(*) FILTER ({test}) AS n_passed,
      count(*) FILTER (NOT ({test})) AS n_removed, count(*) FILTER ({test}) / count(*) AS passed_frac,
      count(*) FILTER (NOT ({test})) / count(*) AS removed_frac FROM qc"""


@query("a15_threshold_summary", f"WITH {QC} " + " UNION ALL ".join(bounds_sql(n) for n in BOUNDS))
def a15(spark, sf):
    return ag.threshold_summary(qc_obs(spark, sf), BOUNDS)


@query("a16_dotplot", f"""WITH {OBS}, {X}, {VAR}, g AS (SELECT gene_id FROM var WHERE brand = 'Brand#7'),
    n AS (SELECT label, count(*) AS n FROM obs GROUP BY 1),
    s AS (SELECT label, gene_id, sum(value) AS s, count(*) FILTER (value > 0) AS k FROM x JOIN obs USING (cell_id) GROUP BY 1, 2),
    m AS (SELECT label, gene_id, coalesce(s, 0) / n AS mv, coalesce(k, 0) / n AS f FROM n CROSS JOIN g LEFT JOIN s USING (label, gene_id))
  SELECT label, gene_id, round(mv, 9) AS mean_value, round(f, 9) AS fraction,
    round(coalesce((mv - min(mv) OVER w) / nullif(max(mv) OVER w - min(mv) OVER w, 0), 0), 6) AS scaled
  FROM m WINDOW w AS (PARTITION BY gene_id)""")
def a16(spark, sf):
    markers = view.var(spark, sf).filter("brand = 'Brand#7'").select("gene_id")
    out = ag.dotplot(view.obs(spark, sf), view.x(spark, sf), "label", markers)
    return r6(r6(out, "mean_value", "fraction", digits=9), "scaled")


@query("a17_id_overlap", f"""WITH {OBS}, {X}, p AS (SELECT DISTINCT gene_id AS id, sample FROM x JOIN obs USING (cell_id)),
    s AS (SELECT id, string_agg(sample, ',' ORDER BY sample) AS samples, count(*) AS n_samples FROM p GROUP BY 1 HAVING count(*) <= 12)
  SELECT samples, n_samples, count(*) AS n_ids FROM s GROUP BY 1, 2""")
def a17(spark, sf):
    ids = view.x(spark, sf).join(view.obs(spark, sf), "cell_id").select("gene_id", "sample")
    return ag.id_overlap(ids, "gene_id", "sample", max_overlap=12, min_size=1)


@query("a17_donor_overlap", f"""WITH {OBS}, p AS (SELECT DISTINCT donor AS id, label FROM obs),
    s AS (SELECT id, string_agg(label, ',' ORDER BY label) AS samples, count(*) AS n_samples FROM p GROUP BY 1 HAVING count(*) <= 5)
  SELECT samples, n_samples, count(*) AS n_ids FROM s GROUP BY 1, 2 HAVING count(*) >= 50""")
def a17b(spark, sf):
    return ag.id_overlap(view.obs(spark, sf), "donor", "label")


@query("a18_distribution", """SELECT user_id, count(*) AS n, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75 FROM events GROUP BY 1""")
def a18(spark, sf):
    return r6(ag.distribution(view.table(spark, sf, "events"), "user_id", "value"), "q25", "median", "q75")


@query("a19_histogram_2d", f"""WITH {QC}, p AS (SELECT ln(1 + n_counts) / ln(10) AS a, CAST(n_genes AS DOUBLE) AS b FROM qc),
    m AS (SELECT max(a) AS ma, max(b) AS mb FROM p)
  SELECT CAST(least(floor(a / (ma / 20)), 19) AS INTEGER) AS bin_x, CAST(least(floor(b / (mb / 20)), 19) AS INTEGER) AS bin_y,
    count(*) AS n FROM p, m GROUP BY 1, 2""")
def a19(spark, sf):
    return ag.histogram_2d(qc_obs(spark, sf), "n_counts", "n_genes", bins=20, log_x=10)


@query("a20_distance_histogram", """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
    t AS (SELECT user_id, sum(n) AS t FROM c GROUP BY 1), ty AS (SELECT DISTINCT event_type FROM events),
    p AS (SELECT t.user_id, ty.event_type, coalesce(n, 0) / t AS p FROM t CROSS JOIN ty LEFT JOIN c ON c.user_id = t.user_id AND c.event_type = ty.event_type),
    d AS (SELECT a.user_id AS i, b.user_id AS j, round(sqrt(sum((a.p - b.p) ** 2)), 9) AS dist FROM p a JOIN p b USING (event_type) GROUP BY 1, 2)
  SELECT CAST(CASE WHEN (SELECT max(dist) FROM d) > 0 THEN least(floor(dist / ((SELECT max(dist) FROM d) / 50)), 49) ELSE 0 END AS INTEGER) AS bin,
    count(*) AS n, round((SELECT avg(CASE WHEN dist > 0 THEN 1.0 ELSE 0.0 END) FROM d), 9) AS nonzero_share FROM d GROUP BY 1""")
def a20(spark, sf):
    from heddle.operators import samples

    d = samples.composition_distances(view.table(spark, sf, "events"), "user_id", "event_type", bins=50)
    d = cut(d.withColumn("dist", F.round("dist", 9)), "distances")
    return r6(ag.distance_histogram(d, 50, weight="n"), "nonzero_share", digits=9)


@query("a21_benchmark_rollup", """WITH r AS (SELECT l_returnflag AS method, l_linestatus AS output, l_quantity AS s FROM lineitem),
    p AS (SELECT DISTINCT l_returnflag AS method, l_linestatus AS output, l_returnflag || l_linestatus AS run FROM lineitem),
    j AS (SELECT * FROM r JOIN p USING (method, output))
  SELECT run, method, output, s, min(s) OVER (PARTITION BY run) AS best FROM j""")
def a21(spark, sf):
    li = view.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("method"), F.col("l_linestatus").alias("output"), F.col("l_quantity").alias("s"))
    params = li.select("method", "output", F.concat("method", "output").alias("run")).distinct()
    return ag.benchmark_rollup([li.filter("output = 'O'"), li.filter("output = 'F'")], params, "run", "s")


@query("a22_compare_implementations", """WITH w AS (SELECT l_shipmode AS metric, l_tax, max(l_extendedprice) FILTER (l_linestatus = 'O') AS "O",
    max(l_extendedprice) FILTER (l_linestatus = 'F') AS "F" FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem) GROUP BY 1, 2)
  SELECT metric, l_tax, "O", "F", round("O" / "F", 6) AS ratio, round(max("O" / "F") OVER (PARTITION BY metric), 6) AS max_ratio FROM w""")
def a22(spark, sf):
    li = view.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "metric")
    return r6(ag.compare_implementations(li, ["metric", "l_tax"], "l_linestatus", "l_extendedprice", "O", "F"), "ratio", "max_ratio")


@query("a23_result_slices", f"""WITH {OBS} SELECT organ, batch, label, CAST(grouping(organ, batch, label) AS BIGINT) AS slice,
    count(*) AS n, round(avg(price), 4) AS mean
  FROM obs GROUP BY GROUPING SETS ((organ), (organ, batch), (organ, label), (batch), ())""")
def a23(spark, sf):
    return r6(ag.result_slices(view.obs(spark, sf), [["organ"], ["organ", "batch"], ["organ", "label"], ["batch"], []], "price"),
              "mean", digits=4)


@query("a24_group_list", """SELECT CAST(quality AS VARCHAR) AS "group" FROM labels GROUP BY 1 UNION ALL SELECT 'all'""")
def a24(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    return ag.group_list(d, "quality")


# ---------------------------------------------------------------- windows


@query("w1_group_share", f"""WITH {OBS} SELECT cell_id, label, price, round(sum(price) OVER w, 2) AS total,
  round(price / sum(price) OVER w, 9) AS share FROM obs WINDOW w AS (PARTITION BY label)""")
def w1(spark, sf):
    out = win.add_group_share(view.obs(spark, sf).select("cell_id", "label", "price"), "label", "price")
    return r6(r6(out, "total", digits=2), "share", digits=9)


@query("w2_first_n", f"""WITH {OBS} SELECT sample, cell_id, price FROM obs
  QUALIFY row_number() OVER (PARTITION BY sample ORDER BY price DESC, cell_id) <= 3""")
def w2(spark, sf):
    return win.first_n(view.obs(spark, sf).select("sample", "cell_id", "price"), "sample", [F.desc("price"), F.asc("cell_id")], 3)


@query("w3_first_present", """SELECT doc_id, coalesce(CAST(toxic AS VARCHAR), CAST(quality AS VARCHAR), lang) AS best
  FROM documents LEFT JOIN labels USING (doc_id)""")
def w3(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    d = d.select("doc_id", F.col("toxic").cast("string"), F.col("quality").cast("string"), "lang")
    return win.first_present(d, ["toxic", "quality", "lang"], "best").select("doc_id", "best")


@query("w4_running_sum", f"""WITH {OBS}, s AS (SELECT donor, count(*) AS n, md5('7|' || donor) AS h FROM obs GROUP BY 1)
  SELECT donor, n, CAST(sum(n) OVER (ORDER BY h) AS BIGINT) AS upto FROM s""")
def w4(spark, sf):
    from heddle.functions.ordering import hash_key, prefix_sums

    s = view.obs(spark, sf).groupBy("donor").agg(F.count("*").alias("n")).withColumn("_h", hash_key(7, "donor"))
    return prefix_sums(s, [], ["_h"], {"upto": "n"}).drop("_h")


@query("w5_rank", f"""WITH {X} SELECT cell_id, gene_id, value, row_number() OVER (PARTITION BY cell_id ORDER BY value, gene_id) AS rank FROM x""")
def w5(spark, sf):
    return win.rank_rows(view.x(spark, sf), "cell_id", "value", "gene_id")


@query("w6_scale_minmax", """SELECT p_partkey AS id, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()), 9) AS p_size,
  round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 9) AS p_retailprice FROM part""")
def w6(spark, sf):
    p = view.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size", "p_retailprice")
    return r6(win.scale_minmax(p, ["p_size", "p_retailprice"]), "p_size", "p_retailprice", digits=9)


@query("w6_quantile_bins", f"""WITH {OBS}, q AS (SELECT label, quantile_cont(price, [0.25, 0.5, 0.75]) AS c FROM obs GROUP BY 1)
  SELECT cell_id, label, CAST((price >= c[1])::INT + (price >= c[2])::INT + (price >= c[3])::INT AS INTEGER) AS bin FROM obs JOIN q USING (label)""")
def w6b(spark, sf):
    return win.quantile_bins(view.obs(spark, sf).select("cell_id", "label", "price"), ["label"], "price", 4).drop("price")


@query("w7_running_index", f"""WITH {OBS} SELECT batch || '-' || (row_number() OVER (PARTITION BY batch ORDER BY cell_id) - 1) AS new_id,
  cell_id FROM obs""")
def w7(spark, sf):
    o = running_index(view.obs(spark, sf).select("cell_id", "batch"), ["batch"], ["cell_id"], "at")
    return o.select(F.concat_ws("-", "batch", (F.col("at") - 1).cast("string")).alias("new_id"), "cell_id")


# ---------------------------------------------------------------- samples


@query("l1_by_sample", f"""WITH {OBS}, s AS (SELECT sample, count(*) AS n, md5('42|' || sample) AS h FROM obs GROUP BY 1 HAVING count(*) >= 100),
    r AS (SELECT sample, sum(n) OVER (ORDER BY h) - n AS before FROM s)
  SELECT cell_id, sample FROM obs WHERE sample IN (SELECT sample FROM r WHERE before <= 5000)""")
def l1(spark, sf):
    return sm.by_sample(view.obs(spark, sf).select("cell_id", "sample"), 5000, "sample")


@query("l2_within_sample", f"""WITH {OBS}, s AS (SELECT sample, md5('42|' || sample) AS h FROM obs GROUP BY 1 HAVING count(*) >= 50),
    r AS (SELECT sample, row_number() OVER (ORDER BY h) AS pos FROM s)
  SELECT cell_id, sample FROM obs JOIN (SELECT sample FROM r WHERE (pos - 1) * 50 < 900) USING (sample)
  QUALIFY row_number() OVER (PARTITION BY sample ORDER BY md5('42|' || cell_id), cell_id) <= 50""")
def l2(spark, sf):
    return sm.within_sample(view.obs(spark, sf).select("cell_id", "sample"), 900, "sample", 50)


@query("l2_within_sample_default", f"""WITH {OBS}, p AS (SELECT CAST(floor(5000 / count(DISTINCT sample)) AS BIGINT) AS per FROM obs),
    s AS (SELECT sample, md5('42|' || sample) AS h, count(*) AS n FROM obs GROUP BY 1),
    r AS (SELECT sample, per, row_number() OVER (ORDER BY h) AS pos FROM s, p WHERE n >= per)
  SELECT cell_id, sample FROM obs JOIN (SELECT sample, per FROM r WHERE (pos - 1) * per < 5000) USING (sample)
  QUALIFY row_number() OVER (PARTITION BY sample ORDER BY md5('42|' || cell_id), cell_id) <= per""")
def l2b(spark, sf):
    return sm.within_sample(view.obs(spark, sf).select("cell_id", "sample"), 5000, "sample")


@query("l3_bootstrap", f"""WITH {OBS}, b AS (SELECT cell_id, unnest([0, 1, 2]) AS boot_id FROM obs)
  SELECT cell_id, boot_id FROM b QUALIFY row_number() OVER (PARTITION BY boot_id ORDER BY md5('42|' || boot_id || ':' || cell_id), boot_id || ':' || cell_id) <= 2000""")
def l3(spark, sf):
    return sm.bootstrap_ids(view.obs(spark, sf), "cell_id", 2000, 3)


@query("l3_sample_fraction", f"""WITH {OBS} SELECT cell_id, batch FROM obs
  QUALIFY row_number() OVER (ORDER BY md5('42|' || cell_id), cell_id) <= floor(0.9 * (SELECT count(*) FROM obs))""")
def l3b(spark, sf):
    return sm.sample_fraction(view.obs(spark, sf).select("cell_id", "batch"), "cell_id", 0.9)


@query("l4_balance_rest", f"""WITH {OBS}, r AS (SELECT cell_id, label FROM obs WHERE label <> '2-HIGH'
    QUALIFY row_number() OVER (ORDER BY md5('42|' || cell_id), cell_id) <= (SELECT count(*) FROM obs WHERE label = '2-HIGH'))
  SELECT cell_id, label, '2-HIGH' AS side FROM obs WHERE label = '2-HIGH' UNION ALL SELECT cell_id, label, 'rest' FROM r""")
def l4(spark, sf):
    return sm.balance_rest(view.obs(spark, sf).select("cell_id", "label"), "cell_id", "label", "2-HIGH")


@query("l5_top_rows", f"WITH {OBS} SELECT cell_id, price FROM obs ORDER BY price DESC, cell_id LIMIT 50")
def l5(spark, sf):
    return sm.top_rows(view.obs(spark, sf).select("cell_id", "price"), "price", 50, ["cell_id"])


@query("l6_sort", f"""WITH {OBS}, t AS (SELECT organ, label, count(*) AS n FROM obs GROUP BY 1, 2)
  SELECT organ, label, n FROM t ORDER BY n DESC, organ, label DESC""")
def l6(spark, sf):
    t = view.obs(spark, sf).groupBy("organ", "label").agg(F.count("*").alias("n"))
    return sm.sort_by(t, ["n", "organ", "label"], [False, True, False])


@query("l7_best_per_group", f"""WITH {OBS}, c AS (SELECT donor, label, count(*) AS n FROM obs GROUP BY 1, 2)
  SELECT donor, label, n FROM c QUALIFY row_number() OVER (PARTITION BY donor ORDER BY n DESC, label) = 1""")
def l7(spark, sf):
    c = view.obs(spark, sf).groupBy("donor", "label").agg(F.count("*").alias("n"))
    return sm.best_per_group(c, "donor", "n", "label")


# ---------------------------------------------------------------- set operations


def part_tables(spark, sf):
    t = view.annotated(spark, sf)
    out = {}
    for i, name in enumerate(["d0", "d1"]):
        o = t["obs"].filter(F.col("cell_id") % 2 == i).select("cell_id", "batch", *(["label"] if i == 0 else ["organ"]))
        out[name] = t.with_slot("obs", o).with_slot(
            "X", t["X"].filter((F.col("cell_id") % 2 == i) & (F.col("gene_id") % 5 != i))).with_slot(
            "var", t["var"].filter(F.col("gene_id") % 5 != i))
    out["empty"] = t.with_slot("obs", t["obs"].filter("cell_id < 0"))
    return out


@query("u1_concat_inner", f"""WITH {X} SELECT 'd' || (cell_id % 2) || '--' || cell_id AS cell_id, gene_id, value FROM x
  WHERE gene_id % 5 NOT IN (0, 1)""")
def u1(spark, sf):
    return sets.concat_tables(part_tables(spark, sf), "inner")["X"]


@query("u1_concat_outer", f"""WITH {X} SELECT 'd' || (cell_id % 2) || '--' || cell_id AS cell_id, gene_id, value FROM x
  WHERE gene_id % 5 <> cell_id % 2""")
def u1b(spark, sf):
    return sets.concat_tables(part_tables(spark, sf), "outer")["X"]


@query("u1_concat_obs", f"""WITH {OBS} SELECT 'd' || (cell_id % 2) || '--' || cell_id AS cell_id, batch,
    CASE WHEN cell_id % 2 = 0 THEN label END AS label, CASE WHEN cell_id % 2 = 1 THEN organ END AS organ,
    'd' || (cell_id % 2) AS file_id FROM obs""")
def u1c(spark, sf):
    return sets.concat_tables(part_tables(spark, sf), "outer")["obs"]


@query("u1_renumber", f"""WITH {OBS} SELECT 'merged-' || (row_number() OVER (ORDER BY cell_id) - 1) AS cell_id, batch,
    cell_id AS obs_names_before_merged FROM obs""")
def u1d(spark, sf):
    return sets.renumber(view.obs(spark, sf).select("cell_id", "batch"), "merged")


@query("u2_concat_required_columns", f"""WITH {OBS} SELECT 'd' || (cell_id % 2) || '--' || cell_id AS cell_id, batch,
    CAST(NULL AS VARCHAR) AS disease, 'd' || (cell_id % 2) AS file_id FROM obs""")
def u2(spark, sf):
    return sets.concat_tables(part_tables(spark, sf), "inner", columns=["batch", "disease"])["obs"]


@query("u3_shared_and_missing", """WITH a AS (SELECT DISTINCT l_partkey AS gene_id FROM lineitem WHERE l_returnflag = 'A'),
    b AS (SELECT DISTINCT l_partkey AS gene_id FROM lineitem WHERE l_tax > 0.07)
  SELECT gene_id, 'both' AS side FROM a WHERE gene_id IN (SELECT gene_id FROM b)
  UNION ALL SELECT gene_id, 'first' FROM a WHERE gene_id NOT IN (SELECT gene_id FROM b)""")
def u3(spark, sf):
    li = view.table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "gene_id")
    a, b = li.filter("l_returnflag = 'A'").select("gene_id"), li.filter("l_tax > 0.07").select("gene_id")
    return sets.shared_features([a, b]).withColumn("side", F.lit("both")).unionByName(
        sets.set_difference(a, b).withColumn("side", F.lit("first")))


@query("u4_value_union", """SELECT DISTINCT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT DISTINCT p_brand FROM part""")
def u4(spark, sf):
    return sets.value_union([view.table(spark, sf, "nation").select(F.col("n_name").alias("name")),
                             view.table(spark, sf, "region").select("r_name"), view.table(spark, sf, "part").select("p_brand")])


@query("u6_stack", """SELECT l_orderkey AS id, l_tax AS score, CAST(NULL AS VARCHAR) AS kind FROM lineitem WHERE l_linenumber = 1
  UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def u6(spark, sf):
    a = view.table(spark, sf, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("id"), F.col("l_tax").alias("score"))
    b = view.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"), F.col("o_orderstatus").alias("kind"))
    return sets.stack([a, b])
