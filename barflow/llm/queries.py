"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import byte_bpe, language_id, site_style_tree
from barflow.llm.decontaminate import contaminated
from barflow.llm.exact_dedup import exact_dedup
from barflow.llm.jaccard_join import jaccard_components
from barflow.llm.language_model import lm_scores
from barflow.llm.piece_counts import count_pieces
from barflow.llm.prefix_trie import prefix_trie, turns_in_order, with_openings
from barflow.llm.repeated_runs import find_runs
from barflow.llm.sharding import shard_by_bytes
from barflow.llm.site_quality import site_quality
from barflow.llm.vector_search import top_k

#: The rank file that documents are encoded with.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: The vocabulary that word pieces are counted in.
COUNTED = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(made):
    QUERIES[made.__name__] = made
    return made


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op2_histogram_sort_shards(spark, d):
    return shard_by_bytes(_table(spark, d, "documents"), 40)


ORACLES["op2_histogram_sort_shards"] = """
WITH crc AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS steps
  FROM (SELECT unnest(range(256)) AS n)),
r AS (
  SELECT doc_id, xor(4294967295, list_reduce(
           [4294967295] || list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32,
         strlen(coalesce(text, '')) + 16 AS size,
         ('0x' || substr(sha256(coalesce(text, '')), 1, 15))::BIGINT AS k1,
         ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k2
  FROM documents, crc),
w AS (
  SELECT *, sum(size) OVER () AS total,
         sum(size) OVER (ORDER BY k1) AS g_end, sum(size) OVER (PARTITION BY k1) AS g_bytes,
         sum(size) OVER (ORDER BY k1, k2) AS r_end, sum(size) OVER (PARTITION BY k1, k2) AS r_bytes,
         row_number() OVER (PARTITION BY k1, k2) - 1 AS number
  FROM r),
s AS (
  SELECT w.doc_id, w.size, w.text_crc32, w.k1, w.k2, number, k, w.total,
         40 * (g_end - g_bytes) AS gb, 40 * g_end AS ge, 40 * (r_end - r_bytes + number * size) AS rb,
         40 * (r_end - r_bytes + (number + 1) * size) AS re
  FROM w CROSS JOIN generate_series(1, 39) AS n(k)),
p AS (
  SELECT doc_id, size, text_crc32, k1, k2, number,
         count(*) FILTER (CASE
           WHEN k * total <= gb THEN true
           WHEN k * total >= ge THEN false
           WHEN 100 * least(k * total - gb, ge - k * total) <= total THEN k * total - gb <= ge - k * total
           ELSE k * total - rb <= re - k * total END) AS shard
  FROM s GROUP BY ALL),
q AS (SELECT *, (k2 + number) % 4 AS piece FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY piece, k1, k2, number) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM q"""


@query
def op5_chunk_recipe_dedup(spark, d):
    return exact_dedup(_table(spark, d, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op5_chunk_recipe_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def fold(n: int):
    """The document's fold of ``n``: CRC-32 of its id in decimal."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@query
def op7_backoff_automaton(spark, d):
    return lm_scores(_table(spark, d, "documents"), fold(7) != 2)


@query
def op8_distinct_word_bpe(spark, d):
    decoded = byte_bpe.encode_and_decode(_table(spark, d, "documents"), public_tokenizers.path(RANKS))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_token_combination_join(spark, d):
    return jaccard_components(_table(spark, d, "documents"))


ORACLES["op9_token_combination_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
           range(1, greatest(len(words) - 3, 2)), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
t AS MATERIALIZED (SELECT doc_id, unnest(shingles) AS shingle FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (len(x.shingles) + len(y.shingles) - shared)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM s JOIN reached r ON r.a = s.doc_id GROUP BY s.doc_id, shingles"""


@query
def op3_rank_order_language(spark, d):
    return language_id.identify(_table(spark, d, "documents"), fold(5) == 0)


@query
def op10_longest_match_counts(spark, d):
    return count_pieces(_table(spark, d, "documents"), public_tokenizers.path(COUNTED))


@query
def op6_block_max_wand(spark, d):
    return contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


@query
def op1_site_style_tree(spark, d):
    return site_style_tree.extract(_table(spark, d, "pages"))


@query
def op4_hierarchical_bayes_quality(spark, d):
    labels = _table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return site_quality(_table(spark, d, "documents"), labels, F.col("source"), F.concat_ws("/", "source", "lang"))


@query
def op13_histogram_top_k(spark, d):
    return top_k(_table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, 10)


ORACLES["op13_histogram_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def with_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the rows whose fold of ten is 0 repeat a stretch of their words to the end of the text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    placed = chosen.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("bigint")).withColumn(
        "a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    return placed.select("doc_id", F.expr("""CASE WHEN n > 0 THEN array_join(transform(
        sequence(0, n - 1), i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS int)]), ' ') ELSE text END""").alias("text"))


@query
def op12_branching_tandem_runs(spark, d):
    runs = find_runs(with_runs(_table(spark, d, "documents")))
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>),
        (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return runs.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.*", F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


ORACLES["op12_branching_tandem_runs"] = r"""
WITH crc AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS steps
  FROM (SELECT unnest(range(256)) AS n)),
d AS (
  SELECT row_number() OVER () AS row, doc_id, xor(4294967295, list_reduce(
           [4294967295] || list_transform(regexp_extract_all(hex(doc_id::VARCHAR), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents, crc),
e AS (SELECT *, len(words) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
w AS (
  SELECT row, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n), lambda i:
           words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS words
  FROM f),
u AS MATERIALIZED (SELECT row, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
eq AS (
  SELECT x.row, x.i, y.i - x.i AS q
  FROM u x JOIN u y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS part FROM eq) GROUP BY row, q, part),
runs AS MATERIALIZED (
  SELECT row, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY row, start, length),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed FROM u ANTI JOIN gone USING (row, i) GROUP BY row),
told AS (
  SELECT row, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS told
  FROM runs GROUP BY row),
best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs s WHERE s.row = r.row AND (s.length * r.period > r.length * s.period OR (
      s.length * r.period = r.length * s.period AND (s.start, s.period) < (r.start, r.period)))))
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)"""


def opening_rule():
    """The conversation that lends its first turns to another one, and how many: both from its id."""
    return F.expr("conv_id - conv_id % 100"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6


@query
def op11_time_forward_trie(spark, d):
    return prefix_trie(with_openings(turns_in_order(_table(spark, d, "conversations")), *opening_rule()))


ORACLES["op11_time_forward_trie"] = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS steps
  FROM (SELECT unnest(range(256)) AS n)),
c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST,
           sha256(concat(length(coalesce(role, '')), ':', role, text))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, (xor(4294967295, list_reduce(
           [4294967295] || list_transform(regexp_extract_all(hex(conv_id::VARCHAR), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 6)::BIGINT AS h
  FROM c, crc),
r AS (
  SELECT h.conv_id, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.base),
p AS (
  SELECT conv_id, d AS depth, turns[1:d] AS seq, len(turns) AS length,
         CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT depth, min(conv_id) AS node, count(*) AS n_convs, any_value(size) AS size, max(length) = depth AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256, seq
  FROM p GROUP BY depth, seq),
m AS MATERIALIZED (SELECT p.conv_id, p.depth, n.node FROM p JOIN n ON p.depth = n.depth AND p.seq = n.seq),
t AS (
  SELECT m.depth, m.node, count(*) FILTER (x.depth = m.depth + 1) AS n_children, count(*) FILTER (x.leaf) AS n_leaves,
         sum((x.n_convs - 1) * x.size)::BIGINT AS saved_tokens
  FROM n x JOIN m ON m.conv_id = x.node AND m.depth <= x.depth GROUP BY m.depth, m.node)
SELECT n.node AS conv_id, n.depth, up.node AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM n JOIN t ON t.depth = n.depth AND t.node = n.node
LEFT JOIN m up ON up.conv_id = n.node AND up.depth = n.depth - 1"""
