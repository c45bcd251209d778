"""The registered queries of this subpackage, with SQL where SQL can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions.runtime import ship
from heddle.llm import (
    fingerprints, lm_scoring, merkle_manifest, mixing, ngram_join, packing, pii, prefix_trie, quality_classifier, quality_rules,
    secrets_scan, simhash, token_files,
)
from heddle.llm.common import Query, documents

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Unsigned CRC-32 of a decimal number, by a table made from the polynomial.
_CRC = """k AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, generate_series(1, 8)),
        lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) AS v FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i))),
c AS (SELECT id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS crc FROM (SELECT DISTINCT {id} AS id FROM {table}), k)"""


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_quality_rules", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS txt FROM documents),
w AS (SELECT doc_id, txt, list_filter(regexp_split_to_array(txt, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(txt, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(txt, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        length(regexp_replace(txt, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
        len(list_filter(list_zip(ws[2:], ws), lambda x: x[1] = x[2]))::BIGINT AS n_stutter,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, ((n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
        + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (n_lines >= 6 AND 2 * n_dup_lines > n_lines)::BIGINT
        + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
        + 64 * (2 * n_upper > word_chars)::BIGINT + 128 * (5 * n_stutter > n_words)::BIGINT) AS failure_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stutter, n_upper, failure_bits,
  (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept FROM b
""")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return quality_classifier.classify(documents(spark, sf_dir), labels, held_out)


@query("op3_ngram_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i+4], ' '))) END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS z FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.z),
m AS (SELECT doc_id, min(z) AS component_id FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a)
SELECT m.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM m LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir))


@query("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.digests(token_files.read(spark, folder))


@query("op6_secret_scans")
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("row").alias("doc_id"),
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secrets_scan.listed(F.col("spans")).alias("spans"),
    )


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(documents(spark, sf_dir))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(documents(spark, sf_dir))
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        F.col("row").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(listed(F.sort_array("base")), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


@query("op10_mixing", """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM s),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight, 2.0::DOUBLE * source_size AS cap FROM p),
l AS (SELECT *, cap / weight AS level FROM w),
b AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget, sum(weight) AS heavy FROM l),
c AS (SELECT l.*, sum(cap) OVER o - cap AS caps, sum(weight) OVER o - weight AS weights FROM l
      WINDOW o AS (ORDER BY level, place ROWS UNBOUNDED PRECEDING)),
f AS (SELECT c.*, level < (budget - caps) / (heavy - weights) AS capped FROM c, b),
v AS (SELECT (any_value(budget) - coalesce(sum(cap) FILTER (capped), 0)) / (any_value(heavy) - coalesce(sum(weight) FILTER (capped), 0)) AS level
      FROM f, b),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE v.level * weight END AS target,
        ('0x' || left(md5('20|' || coalesce(source, '') || CASE WHEN source IS NULL THEN '|' ELSE '' END), 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM f, v),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(k * rate + u) - floor((k - 1) * rate + u))::BIGINT AS copies,
  (floor(k * rate + u) - floor((k - 1) * rate + u))::BIGINT * size AS taken FROM r
""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source", "text_key")


@query("op11_prefix_trie", f"""
WITH {_CRC.format(id="conv_id", table="conversations")},
t AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS s
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT t.conv_id, CASE WHEN p.s IS NULL THEN t.s[(crc % 9) + 1:] ELSE list_concat(p.s[1:crc % 9], t.s[(crc % 9) + 1:]) END AS s
      FROM t JOIN c ON c.id = t.conv_id LEFT JOIN t p ON p.conv_id = t.conv_id - t.conv_id % 5),
m AS (SELECT conv_id, s, unnest(generate_series(0, len(s))) AS depth FROM b),
n AS (SELECT s[1:depth] AS pre, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
      FROM m GROUP BY ALL),
k2 AS (SELECT pre[1:depth - 1] AS pre, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(pre[depth].x) END AS own
      FROM n LEFT JOIN k2 USING (pre, depth)),
u AS (SELECT *, unnest(generate_series(0, depth)) AS up FROM v),
sums AS (SELECT pre[1:up] AS pre, up AS depth, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN sums USING (pre, depth) LEFT JOIN n p ON p.depth = v.depth - 1 AND p.pre = v.pre[1:v.depth - 1]
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return prefix_trie.build(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _leaf_sql(text: str) -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _level_sql(name: str, key: str) -> str:
    """Levels of the trees of ``<name>0 (key, i, n, digest)``, and each node's siblings left and right."""
    around = f"OVER (PARTITION BY lvl, {key}, i // 16 ORDER BY i ROWS BETWEEN"
    return f"""{name} AS (SELECT 0 AS lvl, {key}, i, n, digest FROM {name}0
  UNION ALL SELECT lvl + 1, {key}, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY lvl, {key}, i // 16),
{name}s AS (SELECT lvl, {key}, i, coalesce(string_agg(digest, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1)"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE {_CRC.format(id="doc_id", table="documents")},
d AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, crc % 5 = 0 AS forged,
        {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS other
      FROM documents LEFT JOIN c ON c.id = doc_id),
low0 AS (SELECT doc_id, coalesce('s' || source, 'n') AS source, leaf AS digest, leaf, forged, other,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
{_level_sql("low", "source")},
tops AS (SELECT source, digest FROM low WHERE n = 1),
high0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY source) - 1 AS i, count(*) OVER () AS n, digest, source FROM tops),
{_level_sql("high", "tree")},
f AS (SELECT doc_id, source, leaf, 0 AS lvl, i, CASE WHEN forged THEN other ELSE leaf END AS acc, '' AS proof FROM low0
  UNION ALL SELECT doc_id, f.source, leaf, f.lvl + 1, f.i // 16, sha256(l || acc || r), proof || l || r
  FROM f JOIN lows x ON x.lvl = f.lvl AND x.source = f.source AND x.i = f.i),
g AS (SELECT doc_id, f.source, leaf, 0 AS lvl, high0.i, acc, proof
      FROM (SELECT *, max(lvl) OVER (PARTITION BY doc_id) AS top FROM f) f JOIN high0 ON high0.source = f.source WHERE lvl = top
  UNION ALL SELECT doc_id, g.source, leaf, g.lvl + 1, g.i // 16, sha256(l || acc || r), proof || l || r
  FROM g JOIN highs x ON x.lvl = g.lvl AND x.i = g.i)
SELECT doc_id, leaf, tops.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root.digest AS verified
FROM (SELECT *, max(lvl) OVER (PARTITION BY doc_id) AS top FROM g) g JOIN tops USING (source), (SELECT digest FROM high WHERE n = 1) root
WHERE lvl = top
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


@query("op13_simhash")
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.dedup(documents(spark, sf_dir))
