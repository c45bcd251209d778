"""Scores of labels, batches, embeddings and graphs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from heddle.catalog import query
from heddle.catalog.graphs import DIST, KNN, graph, weights
from heddle.catalog.matrix import CYCLE_SETS, cycle_sets, score_sql
from heddle.catalog.tables import r6
from heddle.functions.ordering import running_index
from heddle.functions.runtime import cut
from heddle.operators import matrix as mx, metrics as mt
from heddle.plans import evaluate as ev, registry, view
from heddle.plans.view import EMB, OBS, VAR, X
from heddle.sources.table import AnnotatedTable

NMI = """c AS (SELECT {a} AS a, {b} AS b, count(*) AS nij FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT *, sum(nij) OVER (PARTITION BY a) AS ni, sum(nij) OVER (PARTITION BY b) AS nj, sum(nij) OVER () AS n FROM c)"""


@query("x1_nmi", f"""WITH {OBS}, {NMI.format(a='sample', b='organ', t='obs')}
  SELECT round(2 * sum(nij / n * ln(n * nij / (ni * nj))) / (sum(-nij / n * ln(ni / n)) + sum(-nij / n * ln(nj / n))), 6) AS score FROM m""")
def x1(spark, sf):
    return r6(mt.nmi(view.obs(spark, sf), "sample", "organ"), "score")


@query("x1_nmi_missing_labels", f"""WITH d AS (SELECT lang, quality FROM documents LEFT JOIN labels USING (doc_id)), {NMI.format(a='lang', b='quality', t='d')}
  SELECT round(2 * sum(nij / n * ln(n * nij / (ni * nj))) / (sum(-nij / n * ln(ni / n)) + sum(-nij / n * ln(nj / n))), 6) AS score FROM m""")
def x1b(spark, sf):
    d = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id", "left")
    return r6(mt.nmi(d, "lang", "quality"), "score")


@query("x2_ari", f"""WITH {OBS}, c AS (SELECT sample, organ, count(*)::DOUBLE AS n FROM obs GROUP BY 1, 2),
    i AS (SELECT sum(n * (n - 1) / 2) AS i, sum(n) AS n FROM c), a AS (SELECT sum(n * (n - 1) / 2) AS a FROM (SELECT sum(n) AS n FROM c GROUP BY sample)),
    b AS (SELECT sum(n * (n - 1) / 2) AS b FROM (SELECT sum(n) AS n FROM c GROUP BY organ))
  SELECT round((i - a * b / (n * (n - 1) / 2)) / ((a + b) / 2 - a * b / (n * (n - 1) / 2)), 6) AS score FROM i, a, b""")
def x2(spark, sf):
    return r6(mt.ari(view.obs(spark, sf), "sample", "organ"), "score")


@query("x1_nmi_kmeans")
def x1c(spark, sf):
    return r6(mt.nmi(mt.kmeans_labels(view.emb(spark, sf), 10), "cluster", "label"), "score")


@query("x2_ari_kmeans")
def x2b(spark, sf):
    return r6(mt.ari(mt.kmeans_labels(view.emb(spark, sf), 10), "cluster", "label"), "score")


SIL = """sums AS (SELECT src, any_value({own}) AS own, {other} AS other, sum(dist) AS total, count(*) AS n FROM pairs {where} GROUP BY src, {other}),
  ab AS (SELECT src, any_value(own) AS own, max(total / n) FILTER (own = other) AS a, min(total / n) FILTER (own <> other) AS b FROM sums GROUP BY 1),
  sil AS (SELECT src, own, CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


@query("x3_asw_label", f"WITH {DIST}, {SIL.format(own='sl', other='dl', where='')} SELECT round((avg(s) + 1) / 2, 6) AS score FROM sil")
def x3(spark, sf):
    return r6(mt.asw_label(view.emb(spark, sf), "label"), "score")


@query("x4_asw_batch", f"""WITH {DIST}, {SIL.format(own='sb', other='db', where='WHERE sl = dl')},
    ok AS (SELECT label FROM emb GROUP BY 1 HAVING count(DISTINCT batch) > 1 AND count(DISTINCT batch) < count(*)),
    l AS (SELECT label, avg(1 - abs(s)) AS m FROM sil JOIN emb ON cell_id = src WHERE label IN (SELECT label FROM ok) GROUP BY 1)
  SELECT round(avg(m), 6) AS score FROM l""")
def x4(spark, sf):
    return r6(mt.asw_batch(view.emb(spark, sf), "batch", "label"), "score")


@query("x5_isolated_label_asw", f"""WITH {DIST}, k AS (SELECT label FROM emb GROUP BY 1
      QUALIFY count(DISTINCT CAST(cell_id % 29 AS VARCHAR)) = min(count(DISTINCT CAST(cell_id % 29 AS VARCHAR))) OVER ()),
    ab AS (SELECT src, any_value(sl) AS own, avg(dist) FILTER (sl = dl) AS a, avg(dist) FILTER (sl <> dl) AS b FROM pairs
      WHERE sl IN (SELECT label FROM k) GROUP BY 1),
    l AS (SELECT own, avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS m FROM ab GROUP BY 1)
  SELECT round(avg((m + 1) / 2), 6) AS score FROM l""")
def x5(spark, sf):
    emb = view.emb(spark, sf).withColumn("batch", (F.col("cell_id") % 29).cast("string"))
    return r6(mt.isolated_label_asw(emb, "label", "batch"), "score")


@query("x6_isolated_label_f1", f"""WITH {OBS}, k AS (SELECT label FROM obs GROUP BY 1 QUALIFY count(DISTINCT donor) = min(count(DISTINCT donor)) OVER ()),
    c AS (SELECT label, sample, count(*) AS n FROM obs GROUP BY 1, 2),
    f AS (SELECT label, 2 * n / (sum(n) OVER (PARTITION BY label) + sum(n) OVER (PARTITION BY sample)) AS f FROM c)
  SELECT round(avg(m), 6) AS score FROM (SELECT max(f) AS m FROM f WHERE label IN (SELECT label FROM k) GROUP BY label)""")
def x6(spark, sf):
    return r6(mt.isolated_label_f1(view.obs(spark, sf), "label", "donor", "sample"), "score")


@query("x7_graph_connectivity", f"""WITH RECURSIVE {KNN}, u AS (SELECT src, dst FROM knn WHERE sl = dl UNION SELECT dst, src FROM knn WHERE sl = dl),
    r AS (SELECT cell_id AS node, cell_id AS seen FROM emb UNION SELECT r.node, u.dst FROM r JOIN u ON u.src = r.seen),
    c AS (SELECT node, min(seen) AS comp FROM r GROUP BY 1), s AS (SELECT label, comp, count(*) AS n FROM c JOIN emb ON node = cell_id GROUP BY 1, 2)
  SELECT round(avg(g), 6) AS score FROM (SELECT max(n) / sum(n) AS g FROM s GROUP BY label)""")
def x7(spark, sf):
    return r6(mt.graph_connectivity(graph(spark, sf), view.emb(spark, sf), "label"), "score")


@query("x9_clisi")
def x9(spark, sf):
    return r6(mt.clisi(graph(spark, sf), view.emb(spark, sf), "label", 15), "score")


@query("x10_ilisi")
def x10(spark, sf):
    return r6(mt.ilisi(graph(spark, sf), view.emb(spark, sf), "batch", 15), "score")


@query("x9_clisi_direct")
def x9d(spark, sf):
    return r6(mt.clisi(graph(spark, sf), view.emb(spark, sf), "label", 15, reach=None), "score")


@query("x11_kbet_statistic", f"""WITH {KNN}, nb AS (SELECT src, db FROM knn UNION ALL SELECT cell_id, batch FROM emb),
    f AS (SELECT batch, count(*) / (SELECT count(*) FROM emb) AS f FROM emb GROUP BY 1),
    g AS (SELECT cell_id, f.batch, f FROM emb CROSS JOIN f), o AS (SELECT src, db, count(*) AS o FROM nb GROUP BY 1, 2)
  SELECT cell_id, '' AS key, round(sum((coalesce(o, 0) - 15 * f) ** 2 / (15 * f)), 6) AS stat, CAST(2 AS BIGINT) AS dof
  FROM g LEFT JOIN o ON src = cell_id AND db = batch GROUP BY 1""")
def x11(spark, sf):
    return r6(mt.kbet_statistic(graph(spark, sf), view.emb(spark, sf), "batch"), "stat")


@query("x11_kbet", f"""WITH {KNN}, nb AS (SELECT src, db FROM knn UNION ALL SELECT cell_id, batch FROM emb),
    f AS (SELECT batch, count(*) / (SELECT count(*) FROM emb) AS f FROM emb GROUP BY 1),
    g AS (SELECT cell_id, f.batch, f FROM emb CROSS JOIN f), o AS (SELECT src, db, count(*) AS o FROM nb GROUP BY 1, 2),
    s AS (SELECT cell_id, sum((coalesce(o, 0) - 15 * f) ** 2 / (15 * f)) AS stat FROM g LEFT JOIN o ON src = cell_id AND db = batch GROUP BY 1)
  SELECT round(avg(CASE WHEN exp(-stat / 2) >= 0.05 THEN 1.0 ELSE 0.0 END), 6) AS score FROM s""")
def x11b(spark, sf):
    return r6(mt.kbet(graph(spark, sf), view.emb(spark, sf), "batch"), "score")


@query("x11_kbet_per_label", f"""WITH {DIST}, e AS (SELECT src, dst, sl, db FROM pairs WHERE sl = dl QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 19),
    nb AS (SELECT src, db FROM e UNION ALL SELECT cell_id, batch FROM emb), kk AS (SELECT src, count(*) AS k FROM nb GROUP BY 1),
    f AS (SELECT label, batch, count(*) / sum(count(*)) OVER (PARTITION BY label) AS f, count(*) OVER (PARTITION BY label) AS b FROM emb GROUP BY 1, 2),
    o AS (SELECT src, db, count(*) AS o FROM nb GROUP BY 1, 2),
    s AS (SELECT cell_id, emb.label, sum((coalesce(o, 0) - k * f) ** 2 / (k * f)) AS stat, any_value(b) AS b FROM emb JOIN f USING (label)
      JOIN kk ON kk.src = cell_id LEFT JOIN o ON o.src = cell_id AND o.db = f.batch GROUP BY 1, 2)
  SELECT round(avg(m), 6) AS score FROM (SELECT avg(CASE WHEN exp(-stat / 2) >= 0.05 THEN 1.0 ELSE 0.0 END) AS m FROM s WHERE b = 3 GROUP BY label)""")
def x11c(spark, sf):
    return r6(mt.kbet_per_label(view.emb(spark, sf), "batch", "label", k=20), "score")


COMPONENTS = f"""{OBS}, {X}, tt AS (SELECT cell_id, sum(value) AS t, count(*) AS k FROM x GROUP BY 1),
  comp AS (SELECT obs.*, price / 100000 AS c0, coalesce(t, 0) / 50 AS c1, CAST(coalesce(k, 0) AS DOUBLE) AS c2 FROM obs LEFT JOIN tt USING (cell_id)),
  pcs AS (SELECT cell_id, batch, label, sample, organ, segment, donor, 0 AS pc, c0 AS x FROM comp
    UNION ALL SELECT cell_id, batch, label, sample, organ, segment, donor, 1, c1 FROM comp
    UNION ALL SELECT cell_id, batch, label, sample, organ, segment, donor, 2, c2 FROM comp)"""


def components(spark, sf):
    """Three numbers per observation used as its components."""
    t = view.x(spark, sf).groupBy("cell_id").agg(F.sum("value").alias("t"), F.count("*").alias("k"))
    o = view.obs(spark, sf).join(t, "cell_id", "left").na.fill(0, ["t", "k"])
    return o.withColumn("v", F.array(F.col("price") / 100000, F.col("t") / 50, F.col("k").cast("double")))


def groups_sql(group, source="pcs"):
    return f"""(SELECT sum(b) / sum(tot) FROM (SELECT pc, sum(n * (m - g) ** 2) AS b, any_value(tot) AS tot FROM
      (SELECT pc, {group}, count(*) AS n, avg(x) AS m FROM {source} GROUP BY 1, 2) JOIN
      (SELECT pc, avg(x) AS g, var_pop(x) * count(*) AS tot FROM {source} GROUP BY 1) USING (pc) GROUP BY 1))"""


@query("x12_pcr_category", f"WITH {COMPONENTS} SELECT round({groups_sql('sample')}, 6) AS score")
def x12(spark, sf):
    c = components(spark, sf)
    return r6(mt.pcr(c, c, "sample"), "score")


@query("x12_pcr_number", f"""WITH {COMPONENTS} SELECT round(sum(coalesce(covar_pop_x * covar_pop_x / nullif(vz, 0), 0)) / sum(vx), 6) AS score
  FROM (SELECT pc, covar_pop(x, donor) AS covar_pop_x, var_pop(donor) AS vz, var_pop(x) AS vx FROM pcs GROUP BY 1)""")
def x12b(spark, sf):
    c = components(spark, sf)
    return r6(mt.pcr(c, c, "donor"), "score")


@query("x13_pcr_comparison", f"""WITH {COMPONENTS}, aft AS (SELECT pc, organ, CASE WHEN pc = 0 THEN x * 0.5 ELSE x - CASE organ WHEN 'ASIA' THEN 1 ELSE 0 END END AS x FROM pcs),
    s AS (SELECT {groups_sql('organ', 'aft')} AS b, {groups_sql('organ')} AS a)
  SELECT round(greatest((b - a) / b, 0), 6) AS score FROM s""")
def x13(spark, sf):
    c = components(spark, sf)
    shift = F.when(F.col("organ") == "ASIA", 1).otherwise(0)
    before = c.withColumn("v", F.array(F.col("v")[0] * 0.5, F.col("v")[1] - shift, F.col("v")[2] - shift))
    return r6(mt.pcr_comparison(before, c, c, "organ"), "score")


UNIT = "(('0x' || left(md5('{s}|' || o_orderkey), 12))::BIGINT + 0.5) / 281474976710656.0"
NOISE = f"""noise AS (SELECT o_orderkey AS cell_id, sqrt(-2 * ln({UNIT.format(s='0a')})) * cos(2 * 3.141592653589793 * {UNIT.format(s='0b')}) AS z FROM orders)"""


@query("x14_pcr_random", f"""WITH {COMPONENTS}, {NOISE}
  SELECT round(sum(CASE WHEN vz > 0 THEN cv * cv / vz ELSE 0 END) / sum(vx), 6) AS score FROM
    (SELECT pc, covar_pop(x, z) AS cv, var_pop(z) AS vz, var_pop(x) AS vx FROM pcs JOIN noise USING (cell_id) GROUP BY 1)""")
def x14(spark, sf):
    return r6(mt.pcr_random(components(spark, sf)), "score")


@query("x15_pcr_sets", f"""WITH {COMPONENTS}, {VAR}, {score_sql(CYCLE_SETS)}
  SELECT set_id, round(greatest(sum(cv * cv / vz) / sum(vx), 0), 6) AS score FROM
    (SELECT set_id, pc, covar_pop(x, score) AS cv, var_pop(score) AS vz, var_pop(x) AS vx FROM pcs JOIN scores USING (cell_id) GROUP BY 1, 2) GROUP BY 1""")
def x15(spark, sf):
    scores = mx.score_sets(view.x(spark, sf), view.obs(spark, sf), view.var(spark, sf), cycle_sets(spark, sf))
    return r6(mt.pcr_sets(components(spark, sf), scores), "score")


#: Random sets of the sizes of the cycle sets, five draws each.
RANDOM_SETS = CYCLE_SETS.replace("sets AS", "given AS", 1) + """,
  sets AS (SELECT set_id, gene_id FROM (SELECT s.set_id || '--' || p.i AS set_id, s.n, g.gene_id
      FROM (SELECT set_id, count(DISTINCT gene_id) AS n FROM given GROUP BY 1) s CROSS JOIN (SELECT unnest(range(5)) AS i) p CROSS JOIN (SELECT DISTINCT gene_id FROM var) g)
    QUALIFY row_number() OVER (PARTITION BY set_id ORDER BY md5('0|' || set_id || ':' || gene_id), set_id || ':' || gene_id) <= n)"""


@query("x28_pcr_random_sets", f"""WITH {COMPONENTS}, {VAR}, {score_sql(RANDOM_SETS)}
  SELECT set_id, round(greatest(sum(CASE WHEN vz > 0 THEN cv * cv / vz ELSE 0 END) / sum(vx), 0), 6) AS score FROM
    (SELECT set_id, pc, covar_pop(x, score) AS cv, var_pop(score) AS vz, var_pop(x) AS vx FROM pcs JOIN scores USING (cell_id) GROUP BY 1, 2) GROUP BY 1""")
def x28(spark, sf):
    v = view.var(spark, sf)
    scores = mx.score_sets(view.x(spark, sf), view.obs(spark, sf), v, mx.random_sets(v, cycle_sets(spark, sf), 5))
    return r6(mt.pcr_sets(components(spark, sf), scores), "score")


def two_sql(source):
    return f"""(SELECT batch, sum((xa * xa * bb + xb * xb * aa - 2 * xa * xb * ab) / (aa * bb - ab * ab)) / sum(xx) AS s FROM
      (SELECT batch, pc, covar_pop(x, s) AS xa, covar_pop(x, g) AS xb, covar_pop(s, g) AS ab, var_pop(s) AS aa, var_pop(g) AS bb, var_pop(x) AS xx
       FROM {source} JOIN wide USING (cell_id) GROUP BY 1, 2) GROUP BY 1)"""


@query("x16_cell_cycle", f"""WITH {COMPONENTS}, {VAR}, {score_sql(CYCLE_SETS, batch=True)},
    wide AS (SELECT cell_id, max(score) FILTER (set_id = 'S') AS s, max(score) FILTER (set_id = 'G2M') AS g FROM scores GROUP BY 1),
    aft AS (SELECT cell_id, batch, pc, CASE WHEN pc = 0 THEN x * 3 ELSE x END AS x FROM pcs)
  SELECT round(avg(greatest(1 - abs(b.s - a.s) / a.s, 0)), 6) AS score FROM {two_sql('pcs')} a JOIN {two_sql('aft')} b USING (batch)""")
def x16(spark, sf):
    c = components(spark, sf)
    after = c.withColumn("v", F.array(F.col("v")[0] * 3, F.col("v")[1], F.col("v")[2]))
    scores = mx.score_sets(view.x(spark, sf), view.obs(spark, sf), view.var(spark, sf), cycle_sets(spark, sf), batch="batch")
    return r6(mt.cell_cycle_conservation(c, after, c, "batch", scores), "score")


@query("x17_morans_i", f"""WITH {KNN}, n AS (SELECT count(*) AS n, avg(v[1]) AS m, var_pop(v[1]) AS s2 FROM emb),
    c AS (SELECT sum((a.v[1] - m) * (b.v[1] - m)) AS c, count(*) AS w FROM knn JOIN emb a ON src = a.cell_id JOIN emb b ON dst = b.cell_id, n)
  SELECT round(greatest(c / (w * s2), 0), 6) AS score FROM c, n""")
def x17(spark, sf):
    emb = view.emb(spark, sf)
    edges = graph(spark, sf).withColumn("weight", F.lit(1.0))
    return r6(mt.morans_i(edges, emb.select("cell_id", F.col("v")[0].alias("x")), emb), "score")


@query("x18_morans_i_category", f"""WITH {KNN}, p AS (SELECT DISTINCT label, unnest(range(10)) AS perm FROM emb),
    mp AS (SELECT label, perm, row_number() OVER (PARTITION BY perm ORDER BY md5('0|' || perm || '|' || label), label) AS z FROM p),
    vals AS (SELECT cell_id, perm, z FROM emb JOIN mp USING (label)), st AS (SELECT perm, avg(z) AS m, var_pop(z) AS s2 FROM vals GROUP BY 1),
    c AS (SELECT a.perm, sum((a.z - m) * (b.z - m)) AS c, count(*) AS w, any_value(s2) AS s2 FROM knn JOIN vals a ON src = a.cell_id
      JOIN vals b ON dst = b.cell_id AND a.perm = b.perm JOIN st ON st.perm = a.perm GROUP BY 1)
  SELECT round(avg(greatest(c / (w * s2), 0)), 6) AS score FROM c""")
def x18(spark, sf):
    return r6(mt.morans_i_categorical(graph(spark, sf).withColumn("weight", F.lit(1.0)), view.emb(spark, sf), "label"), "score")


@query("x18_morans_i_few_categories", f"""WITH {KNN}, perms AS (SELECT unnest([['1','2','3'],['1','3','2'],['2','1','3'],['2','3','1'],['3','1','2'],['3','2','1']]) AS p),
    np AS (SELECT row_number() OVER () AS perm, p FROM perms), vals AS (SELECT cell_id, perm, CAST(p[CAST(batch AS INT) + 1] AS DOUBLE) AS z FROM emb, np),
    st AS (SELECT perm, avg(z) AS m, var_pop(z) AS s2 FROM vals GROUP BY 1),
    c AS (SELECT a.perm, sum((a.z - m) * (b.z - m)) AS c, count(*) AS w, any_value(s2) AS s2 FROM knn JOIN vals a ON src = a.cell_id
      JOIN vals b ON dst = b.cell_id AND a.perm = b.perm JOIN st ON st.perm = a.perm GROUP BY 1)
  SELECT round(avg(greatest(c / (w * s2), 0)), 6) AS score FROM c""")
def x18b(spark, sf):
    return r6(mt.morans_i_categorical(graph(spark, sf).withColumn("weight", F.lit(1.0)), view.emb(spark, sf), "batch"), "score")


@query("x19_morans_i_random")
def x19(spark, sf):
    return r6(mt.morans_i_random(view.emb(spark, sf)), "score")


RING = f"""{OBS}, ring AS (SELECT cell_id AS src, lead(cell_id) OVER (PARTITION BY donor ORDER BY cell_id) AS dst FROM obs QUALIFY dst IS NOT NULL)"""


def ring(spark, sf):
    """Graph that links each observation to the next one of its donor."""
    placed = cut(running_index(view.obs(spark, sf).select("cell_id", "donor"), ["donor"], ["cell_id"], "pos"))
    following = placed.select("donor", (F.col("pos") - 1).alias("pos"), F.col("cell_id").alias("dst"))
    return placed.join(following, ["donor", "pos"]).select(F.col("cell_id").alias("src"), "dst", F.lit(1.0).alias("weight"))


RING_SCORES = """
    n AS (SELECT count(*) AS n FROM obs), w AS (SELECT count(*) AS w FROM ring),
    xs AS (SELECT * FROM x WHERE gene_id IN (SELECT gene_id FROM g)),
    s AS (SELECT gene_id, sum(value) / any_value(n) AS m, sum(value * value) - sum(value) ** 2 / any_value(n) AS ss FROM xs, n GROUP BY 1),
    deg AS (SELECT cell_id, count(*) AS d FROM (SELECT src AS cell_id FROM ring UNION ALL SELECT dst FROM ring) GROUP BY 1),
    sd AS (SELECT gene_id, sum(value * coalesce(d, 0)) AS sd FROM xs LEFT JOIN deg USING (cell_id) GROUP BY 1),
    cr AS (SELECT a.gene_id, sum(a.value * b.value) AS c FROM ring JOIN xs a ON src = a.cell_id JOIN xs b ON dst = b.cell_id AND a.gene_id = b.gene_id GROUP BY 1),
    mi AS (SELECT gene_id, greatest(n / w * (coalesce(c, 0) - m * sd + m * m * w) / ss, 0) AS i FROM s JOIN sd USING (gene_id) LEFT JOIN cr USING (gene_id), n, w)
  SELECT set_id, round(avg(i), 6) AS score FROM g JOIN mi USING (gene_id) GROUP BY 1"""


@query("x20_morans_i_sets", f"""WITH {RING}, {X}, {VAR}, g AS (SELECT gene_set AS set_id, gene_id FROM var WHERE size > 30),{RING_SCORES}""")
def x20(spark, sf):
    sets = view.var(spark, sf).filter("size > 30").select(F.col("gene_set").alias("set_id"), "gene_id")
    return r6(mt.morans_i_sets(ring(spark, sf), view.x(spark, sf), view.obs(spark, sf), sets), "score")


@query("x27_morans_i_random_sets", f"""WITH {RING}, {X}, {VAR}, {RANDOM_SETS}, g AS (SELECT set_id, gene_id FROM sets),{RING_SCORES}""")
def x27(spark, sf):
    sets = mx.random_sets(view.var(spark, sf), cycle_sets(spark, sf), 5)
    return r6(mt.morans_i_sets(ring(spark, sf), view.x(spark, sf), view.obs(spark, sf), sets), "score")


@query("x21_metric_records", f"""WITH {OBS}, s AS (SELECT organ, avg(price) AS score FROM obs GROUP BY 1)
  SELECT 'd' AS dataset, 'f' AS file_id, 'morans_i' AS metric, 'bio_conservation' AS metric_type, 'batch' AS batch, 'label' AS label, 'embed' AS output_type,
    'M:' || organ AS metric_name, round(score, 4) AS score FROM s""")
def x21(spark, sf):
    s = view.obs(spark, sf).groupBy("organ").agg(F.avg("price").alias("score"))
    lists = s.agg(F.sort_array(F.collect_list(F.struct(F.concat(F.lit("M:"), "organ").alias("n"), "score"))).alias("z"))
    lists = lists.select(F.col("z")["n"].alias("metric_name"), F.col("z")["score"].alias("score"))
    return r6(mt.metric_records(lists, "d", "f", "morans_i", "bio_conservation", "batch", "label", "embed"), "score", digits=4)


@query("x22_merge_metrics", f"""WITH {OBS}, s AS (SELECT batch, segment, 'orders--segment=' || segment || '--mod:' || batch AS file_id, round(avg(price), 4) AS score FROM obs GROUP BY 1, 2)
  SELECT 'asw' AS metric, file_id, score, batch, length(file_id) AS s, segment,
    CASE WHEN length('orders--' || batch) > 20 THEN substring('orders--' || batch, 1, 20) || '...' ELSE 'orders--' || batch END AS file_name FROM s""")
def x22(spark, sf):
    o = view.obs(spark, sf).withColumn("file_id", F.concat(F.lit("orders--segment="), "segment", F.lit("--mod:"), "batch"))
    rec = o.groupBy("file_id", "batch").agg(F.round(F.avg("price"), 4).alias("score")).select(
        F.lit("x").alias("metric"), F.lit("asw").alias("metric_name"), "file_id", "batch", "score")
    runs = o.select("file_id", "batch", F.length("file_id").cast("long").alias("s")).distinct()
    return ev.merge_metrics([rec.filter("batch = 'F'"), rec.filter("batch <> 'F'")], runs)


@query("x23_ranking", f"""WITH {OBS}, m AS (SELECT sample, label AS metric, CASE WHEN label < '3' THEN 'batch_correction' ELSE 'bio_conservation' END AS t, avg(price) AS s
      FROM obs WHERE NOT (sample = 'NATION_3' AND label = '5-LOW') GROUP BY 1, 2),
    z AS (SELECT *, (s - min(s) OVER w) / (max(s) OVER w - min(s) OVER w) AS z FROM m WINDOW w AS (PARTITION BY metric)),
    g AS (SELECT sample, avg(z) FILTER (t = 'batch_correction') AS bc, avg(z) FILTER (t = 'bio_conservation') AS bio FROM z GROUP BY 1)
  SELECT sample, round(bc, 6) AS batch_correction, round(bio, 6) AS bio_conservation, round(0.4 * bc + 0.6 * bio, 6) AS overall FROM g""")
def x23(spark, sf):
    o = view.obs(spark, sf).filter("NOT (sample = 'NATION_3' AND label = '5-LOW')")
    rec = o.select("sample", F.col("label").alias("metric"), F.col("price").alias("score"),
                   F.when(F.col("label") < "3", "batch_correction").otherwise("bio_conservation").alias("metric_type"))
    return r6(mt.rank_integrations(rec, ["sample"]), "batch_correction", "bio_conservation", "overall")


def scored_table(spark, sf):
    emb = view.emb(spark, sf)
    t = AnnotatedTable({"obs": emb.select("cell_id", "label", "batch"), "obsm/X_emb": emb.select("cell_id", "v"),
                        "obs/clusters": emb.select("cell_id", F.col("label").alias("cluster"))})
    return ev.with_neighbors(t, "embed")


@query("x24_prepare_full")
def x24(spark, sf):
    t = view.annotated(spark, sf)
    x = mx.log1p(mx.normalize_total(t["X"]))
    hv = cut(mx.highly_variable(x, t["obs"], t["var"], n_top=2000).select("gene_id", "highly_variable"))
    raw = cut(x, "norm")
    # the matrix of the unintegrated table is the corrected one of a method that changes nothing
    given = AnnotatedTable({"obs": t["obs"], "X": raw, "var": t["var"].join(hv, "gene_id", "left")}, {})
    ready, before = ev.prepare(given, given, "full", "highly_variable")
    near = ready["obsp/distances"].groupBy(F.col("src").alias("cell_id")).agg(F.count("dst").alias("n_neighbors"), F.sum("dist").alias("dist"))
    tied = ready["obsp/connectivities"].groupBy(F.col("src").alias("cell_id")).agg(F.sum("weight").alias("weight"))
    out = before.select("cell_id", F.transform("v", lambda a: F.round(a, 5)).alias("v"))
    return r6(out.join(near, "cell_id", "left").join(tied, "cell_id", "left"), "dist", "weight", digits=4)


@query("x25_attach_metrics", f"""WITH {OBS} SELECT 'metrics' AS module, organ AS key, CAST(count(*) AS VARCHAR) AS value FROM obs GROUP BY 2""")
def x25(spark, sf):
    rec = view.obs(spark, sf).groupBy(F.col("organ").alias("metric")).agg(F.count("*").alias("score"))
    return ev.attach_metrics(view.annotated(spark, sf), rec)["uns"]


@query("x26_bootstrap_metric", f"""WITH {OBS}, b AS (SELECT cell_id, sample, organ, unnest([0, 1, 2, 3, 4]) AS boot_id FROM obs),
    s AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY boot_id ORDER BY md5('42|' || boot_id || ':' || cell_id), boot_id || ':' || cell_id) <= (SELECT CAST(floor(0.9 * count(*)) AS BIGINT) FROM obs)),
    c AS (SELECT boot_id, sample AS a, organ AS b, count(*) AS nij FROM s GROUP BY 1, 2, 3),
    m AS (SELECT *, sum(nij) OVER (PARTITION BY boot_id, a) AS ni, sum(nij) OVER (PARTITION BY boot_id, b) AS nj, sum(nij) OVER (PARTITION BY boot_id) AS n FROM c)
  SELECT boot_id, round(2 * sum(nij / n * ln(n * nij / (ni * nj))) / (sum(-nij / n * ln(ni / n)) + sum(-nij / n * ln(nj / n))), 6) AS score FROM m GROUP BY 1""")
def x26(spark, sf):
    o = view.obs(spark, sf)
    ids = mt.bootstrap_ids(o, "cell_id", math.floor(0.9 * o.count()), 5)
    return r6(mt.nmi(o.join(ids, "cell_id"), "sample", "organ", ["boot_id"]), "score")


@query("x_evaluate_all")
def x_all(spark, sf):
    """Every quick metric of one embedded result through the registry."""
    emb = view.emb(spark, sf)
    given = registry.MetricInput(scored_table(spark, sf), "batch", "label", "embed", before=emb)
    names = ["nmi", "ari", "asw_label", "asw_batch", "graph_connectivity", "graph_connectivity_y", "clisi", "ilisi", "kbet_y",
             "pcr", "pcr_comparison", "isolated_label_f1", "morans_i"]
    out = ev.evaluate(given, names, "embeddings", "labels")
    return r6(out, "score", digits=5)


@query("x_not_allowed_is_null", "SELECT 'asw_label' AS metric, CAST(NULL AS DOUBLE) AS score, count(*) > 0 AS has_rows FROM embeddings")
def x_null(spark, sf):
    emb = view.emb(spark, sf)
    given = registry.MetricInput(AnnotatedTable({"obs": emb}), "batch", "label", "knn")
    some = emb.agg((F.count("*") > 0).alias("has_rows"))
    return registry.run_metric("asw_label", given).select("metric", "score").withColumn("has_rows", some.scalar())


@query("g11_optimal_clusters")
def g11(spark, sf):
    labels = view.emb(spark, sf).select("cell_id", "label")
    return mt.optimal_clusters(weights(spark, sf), labels, "label").select("cell_id", "resolution", "cluster", F.round("nmi", 6).alias("nmi"))
