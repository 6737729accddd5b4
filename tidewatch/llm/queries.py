"""The registered queries of this package and their DuckDB oracles.

Each query applies one operator to its whole table and derives the digest columns of its
result. Oracles are given where SQL can express the operator; the others are tested
against brute force, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, lines, neardup, packing, quality, resample, sharding, tokens, topk, toxicity, trie, urls
from .common import crc_fold, load

# fixed values of the query: rules of the url filter
URL_RULES = [
    urls.Rule("com/", "allow"),
    urls.Rule("example.com/en/", "block"),
    urls.Rule("www.example.com/en/", "allow"),
    urls.Rule("net/es/", "block"),
    urls.Rule("net/fr/", "block"),
]
END_ID = 2


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = load(spark, sf_dir, "documents")
    table = tokens.token_table(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=END_ID)
    return table.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.fit(docs, load(spark, sf_dir, "labels"), "quality", crc_fold("key", 3) != 1)
    return quality.score(docs, model).select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark, load(spark, sf_dir, "pages"), URL_RULES)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    profiles = langid.fit(docs, crc_fold("key", 4) != 2)
    return langid.predict(docs, profiles).select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(spark, docs, load(spark, sf_dir, "labels"), "toxic", crc_fold("key", 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "evidence")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, load(spark, sf_dir, "documents"), shingle=2, percent=80)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(spark, load(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(spark, load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark, load(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_ids, op2_quality, op3_packing, op4_top_k, op5_url_filter, op6_language,
        op7_decontamination, op8_toxicity, op9_near_duplicates, op10_shards, op11_line_dedup, op12_prefix_trie,
        op13_importance_resampling,
    )
}

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), i AS (
  SELECT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM b WHERE len(w) > 0) x
), sizes AS (SELECT DISTINCT n FROM i), o AS (
  SELECT x.doc_id, x.p, x.n, i.item_id
  FROM (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n) y) x
  JOIN i ON i.win = x.win AND i.n = x.n
), hits AS (
  SELECT doc_id, count(DISTINCT h) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS h FROM o) z GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM o) z GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 1], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS p FROM d WHERE len(w) > 0) x
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (
  SELECT s.doc_id, s.sh, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f, s.sh) AS p
  FROM s JOIN (SELECT sh, count(*) AS f FROM s GROUP BY sh) c USING (sh) JOIN sizes USING (doc_id)
), prefix AS (SELECT doc_id, sh, n FROM rare WHERE p <= n - (4 * n + 4) // 5 + 1),
cand AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM prefix a JOIN prefix b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), linked AS (
  SELECT a, b FROM (SELECT a, b, na, nb, count(*) AS k FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.sh = x.sh GROUP BY ALL) z
  WHERE 100 * k >= 80 * (na + nb - k)
), edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT edges.b, reach.root FROM reach JOIN edges ON edges.a = reach.doc_id
), comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN sizes USING (doc_id)
"""

LINE_DEDUP_SQL = """
WITH l AS (
  SELECT doc_id, p, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS k
  FROM (SELECT doc_id, unnest(range(1, len(v) + 1)) AS p, unnest(v) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS v FROM documents) a) b
), held AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, held.k IS NOT NULL AND l.doc_id <> keeper AS gone FROM l LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# CRC-32 by the usual byte table, as DuckDB has none; ``v`` is the list of byte values
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t FROM range(256) r(b)
)"""
_CRC = "xor(list_reduce(list_prepend(4294967295, {v}), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295)"

PREFIX_TRIE_SQL = (
    "WITH " + _CRC_TABLE + r""", own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, CAST(""" + _CRC.replace("{v}", "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))") + r""" % 4 AS BIGINT) AS h FROM own, crc_table
), made AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], h.turns[h + 1:]) AS turns FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20
), member AS (
  SELECT conv_id, len(turns) AS length, d, sha256(CAST(turns[1:d] AS VARCHAR) || CAST(d AS VARCHAR)) AS node,
    CASE WHEN d > 0 THEN sha256(CAST(turns[1:d - 1] AS VARCHAR) || CAST(d - 1 AS VARCHAR)) END AS parent,
    CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM made) x
), node AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = d), '')) AS ends_sha256
  FROM member GROUP BY node
), kids AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
within AS (
  SELECT DISTINCT a.node AS top, b.node FROM member a JOIN member b ON a.conv_id = b.conv_id AND b.d >= a.d
), sums AS (
  SELECT top AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM within w JOIN node n ON n.node = w.node LEFT JOIN kids k ON k.node = w.node GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN node p ON p.node = n.parent
"""
)

_HEX_BYTES = "list_transform(range(1, len(hex(encode({x}))), 2), lambda i: CAST(('0x' || substr(hex(encode({x})), i, 2)) AS BIGINT))"
RESAMPLING_SQL = (
    "WITH " + _CRC_TABLE + r""", texts AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS row, text FROM documents UNION ALL SELECT 'b', NULL, 0, text FROM benchmark
), split AS (
  SELECT side, doc_id, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), counted AS (
  SELECT side, row, array_to_string(w[p:p + k - 1], ' ') AS f, count(*) AS n
  FROM (SELECT side, row, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM split, range(1, 4) r(k) WHERE len(w) >= k) x GROUP BY ALL
), hashed AS (SELECT f, CAST(""" + _CRC.replace("{v}", _HEX_BYTES.replace("{x}", "f")) + r""" % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT f FROM counted) x, crc_table),
placed AS (SELECT side, row, bucket, n FROM counted JOIN hashed USING (f)),
per AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t FROM placed GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t::DOUBLE + 1) * ((SELECT sum(s) FROM per)::DOUBLE + 10000) / ((s::DOUBLE + 1) * ((SELECT sum(t) FROM per)::DOUBLE + 10000)))) AS BIGINT) AS g FROM per
), weight AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST(('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM split LEFT JOIN weight USING (row) WHERE side = 'd'
), drawn AS (SELECT doc_id, n_words, n_features, weight, score, n_words >= 20 AS able, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * (SELECT count(*) FROM drawn WHERE able) // 100 THEN place END AS rank FROM drawn
"""
)

ORACLES: dict[str, str] = {
    "op11_line_dedup": LINE_DEDUP_SQL,
    "op12_prefix_trie": PREFIX_TRIE_SQL,
    "op13_importance_resampling": RESAMPLING_SQL,
    "op4_top_k": TOP_K_SQL,
    "op7_decontamination": DECONTAMINATION_SQL,
    "op9_near_duplicates": NEAR_DUPLICATES_SQL,
}
