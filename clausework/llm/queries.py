"""Queries of this subpackage's operators: each applies its operator to its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitslice, bpe, linedup, mixing, nbsvm, ngram_jaccard, pii, prefixtrie, secretscan, simhash, spelling, suffixdedup, warc
from .cluster import prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> tuple[str, str]:
    """The rank file's place and the pattern, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def surrogate_key(spark: SparkSession) -> bytes:
    """The key that the setting names; without one a key of these queries, which is no secret, so that reruns over test tables
    agree. The operator itself has no key of its own."""
    return spark.conf.get("spark.clausework.surrogateKey", "key of the registered query").encode()


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.ngram_jaccard(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"), radius=simhash.RADIUS)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = nbsvm.train_quality(docs, labels.where(~nbsvm.held_out()).select("doc_id", "quality"))
    scored = nbsvm.score_quality(docs.select("doc_id", "text").withColumn("held_out", nbsvm.held_out()), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.substring_dedup(table(spark, sf_dir, "documents"), keep_first=False, digest=True)


def op8_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, folder, index)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), *byte_bpe())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.spans_digest(secretscan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES = (op1_ngram_jaccard, op2_simhash, op3_mix_sources, op4_surrogates, op5_quality, op6_line_dedup, op7_suffix_dedup, op8_bitsliced_topk, op9_warc, op10_byte_bpe, op11_prefix_trie, op12_secret_scan, op13_spelling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": JACCARD_SQL, "op3_mix_sources": MIX_SQL, "op6_line_dedup": LINES_SQL, "op8_bitsliced_topk": TOPK_SQL, "op9_warc": WARC_SQL, "op11_prefix_trie": TRIE_SQL}


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))) AS digest
  FROM documents
), ordered AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE n % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS stop,
         ('0x' || substr(md5('mix start ' || coalesce('=' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start FROM ordered
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(stop) OVER (ORDER BY source_size / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY source_size / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, start, coalesce(least(max(CASE WHEN level * weight <= stop THEN level END) OVER () * weight, stop), stop) AS target FROM levels
), docs AS (
  SELECT d.*, t.source_size, t.target, t.start, d.size * 100 > t.source_size AS is_large,
         length(bin(d.size)) * 8 + (d.size * 8) // (1::BIGINT << length(bin(d.size))) AS class
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, is_large ORDER BY class DESC, digest, size DESC) AS k FROM docs
), large AS (
  SELECT *, (floor(target / source_size * k + start) - floor(target / source_size * (k - 1) + start))::BIGINT AS copies
  FROM ranked WHERE is_large
), done AS (SELECT source, sum(copies * size) AS done FROM large GROUP BY source),
rest AS (SELECT source, sum(size) AS words FROM ranked WHERE NOT is_large GROUP BY source),
small AS (
  SELECT r.*, CASE WHEN s.words > 0 THEN greatest(0.0::DOUBLE, least(2.0::DOUBLE, (r.target - coalesce(d.done, 0)::DOUBLE) / s.words::DOUBLE)) END AS rate
  FROM ranked r JOIN rest s ON r.source IS NOT DISTINCT FROM s.source LEFT JOIN done d ON r.source IS NOT DISTINCT FROM d.source
  WHERE NOT r.is_large
), parts AS (
  SELECT doc_id, source, size, source_size, target, copies FROM large
  UNION ALL
  SELECT doc_id, source, size, source_size, target, coalesce((floor(rate * k + start) - floor(rate * (k - 1) + start))::BIGINT, 0) FROM small
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM parts
"""

JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(w)] ELSE list_distinct([hash(w[i : i + 4]) FOR i IN range(1, len(w) - 3)]) END AS s FROM worded
), sized AS (SELECT doc_id, len(s)::BIGINT AS n_shingles, s, hash(list_sort(s)) AS k FROM shingled),
classes AS (SELECT min(doc_id) AS rep, k, any_value(n_shingles) AS n, any_value(s) AS s FROM sized WHERE n_shingles > 0 GROUP BY k),
terms AS (SELECT rep, n, unnest(s) AS t FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM terms a JOIN terms b ON a.t = b.t AND a.rep < b.rep AND a.n * 100 >= b.n * 75 AND b.n * 100 >= a.n * 75
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (
  SELECT rep, rep FROM classes
  UNION
  SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node WHERE r.root < e.b
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT d.doc_id, d.n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM sized d LEFT JOIN classes c ON d.k = c.k AND d.n_shingles > 0 LEFT JOIN roots r ON r.node = c.rep
"""

LINES_SQL = r"""
WITH numbered AS (SELECT *, row_number() OVER () AS rid FROM documents),
lines AS (
  SELECT rid, doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM numbered WHERE text IS NOT NULL
), cut AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS body FROM lines),
spread AS (SELECT body, count(DISTINCT coalesce(source, '')) AS sites, min(doc_id) AS least FROM cut WHERE body <> '' GROUP BY body HAVING sites >= 10),
marked AS (SELECT c.*, s.body IS NOT NULL AND c.doc_id <> s.least AS gone FROM cut c LEFT JOIN spread s ON c.body = s.body),
kept AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY rid)
SELECT n.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, CASE WHEN n.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM numbered n LEFT JOIN kept k USING (rid)
"""

TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, max(page_id) AS last, count(*) AS n FROM p GROUP BY digest)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(p.digest, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN g.last IS NULL OR page_id IS NOT DISTINCT FROM g.last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.last IS NOT NULL AND page_id IS DISTINCT FROM g.last THEN g.last END AS refers_to
FROM p JOIN g ON p.digest = g.digest
"""

TRIE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), lens AS (SELECT conv_id, count(*) AS len FROM t GROUP BY conv_id),
crc AS (
  SELECT conv_id, len, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT),
    lambda acc, b: list_reduce(range(8), lambda a, j: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), xor(acc, b)), 4294967295::BIGINT), 4294967295) AS crc
  FROM lens
), plan AS (
  SELECT c.conv_id, c.base, CASE WHEN c.base = c.conv_id THEN 0 ELSE crc % 9 END AS h, CASE WHEN c.base = c.conv_id THEN 0 ELSE least(crc % 9, coalesce(b.len, 0)) END AS from_base
  FROM crc c LEFT JOIN lens b ON b.conv_id = c.base
), turns AS (
  SELECT p.conv_id, k - h + from_base AS d, role, text FROM t JOIN plan p ON p.conv_id = t.conv_id AND k > h
  UNION ALL
  SELECT p.conv_id, k, role, text FROM t JOIN plan p ON p.base = t.conv_id AND k <= from_base
), prefixes AS (
  SELECT conv_id, d, list(md5(length(role)::VARCHAR || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS p, strlen(text) AS bytes FROM turns
  UNION ALL
  SELECT conv_id, 0, [], 0 FROM plan
), nodes AS (SELECT p, d, min(conv_id) AS m, count(*) AS n, any_value(bytes) AS bytes FROM prefixes GROUP BY p, d),
members AS (SELECT x.conv_id, x.d, n.m, n.n FROM prefixes x JOIN nodes n ON x.p = n.p AND x.d = n.d),
tree AS (SELECT n.m, n.d, n.n, (n.n - 1) * n.bytes AS own, a.m AS parent FROM nodes n LEFT JOIN members a ON a.conv_id = n.m AND a.d = n.d - 1),
kids AS (SELECT parent AS m, d - 1 AS d, count(*) AS n_children FROM tree WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT a.m, a.d, count(*) FILTER (WHERE k.m IS NULL) AS n_leaves, sum(t.own) AS saved
  FROM tree t LEFT JOIN kids k ON k.m = t.m AND k.d = t.d JOIN members a ON a.conv_id = t.m AND a.d <= t.d GROUP BY a.m, a.d
), ends AS (
  SELECT m, d, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM members x
  WHERE NOT EXISTS (SELECT 1 FROM members y WHERE y.conv_id = x.conv_id AND y.d = x.d + 1) GROUP BY m, d
)
SELECT t.m AS conv_id, t.d::BIGINT AS depth, t.parent AS parent_conv_id, t.n AS n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
       coalesce(e.digest, sha256('')) AS ends_sha256
FROM tree t JOIN sums s ON s.m = t.m AND s.d = t.d LEFT JOIN kids k ON k.m = t.m AND k.d = t.d LEFT JOIN ends e ON e.m = t.m AND e.d = t.d
"""
