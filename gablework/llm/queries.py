"""Queries over the test tables, one for each operator of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.llm import additive, bitsliced, cws, lines, manifest, mixing, negatives, packing, pieces, ppm, quality, repair, warc
from gablework.llm.common import Scratch, materialize, read_table
from gablework.llm.tokens import public_path


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored replicas of the pages, the second with decayed bytes; each is hashed from what it holds."""
    records, scratch = warc.records(read_table(spark, sf_dir, "pages")), Scratch(spark)
    ours = scratch.table(warc.stored(records, warc.catalogue(records)), "replica", "zstd")
    theirs = scratch.table(warc.damaged(ours), "replica", "zstd")
    hashes = [materialize(warc.hashed(x), "hashes") for x in (ours, theirs)]
    scratch.drop()
    return warc.audit(*hashes)


def op3_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.search(read_table(spark, sf_dir, "embeddings"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.token_files(read_table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), 2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = lines.line_dedup(read_table(spark, sf_dir, "documents"))
    return reduced.select("doc_id", "n_lines", "n_dropped", "n_near", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op6_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(read_table(spark, sf_dir, "embeddings"))


def op7_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.language_id(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), 1)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(read_table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':0'), 1, 12))::BIGINT::DOUBLE + 0.5e0) / 281474976710656e0 AS u
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
shares(round, total, free, w, n) AS (
  SELECT 0, sum(source_size)::BIGINT, sum(source_size)::BIGINT, sum(weight)::BIGINT, -1::BIGINT FROM src
  UNION ALL
  SELECT round + 1, total,
         total - coalesce((SELECT sum(3 * source_size) FROM src WHERE 3 * source_size < s.free::DOUBLE * weight / s.w::DOUBLE), 0)::BIGINT,
         (SELECT sum(weight) FROM src WHERE NOT 3 * source_size < s.free::DOUBLE * weight / s.w::DOUBLE)::BIGINT,
         (SELECT count(*) FROM src WHERE 3 * source_size < s.free::DOUBLE * weight / s.w::DOUBLE)
  FROM shares s WHERE round < 100 AND w IS NOT NULL AND (round < 1 OR n <> (SELECT count(*) FROM src WHERE 3 * source_size < s.free::DOUBLE * weight / s.w::DOUBLE))),
share AS (SELECT free, w FROM shares WHERE w IS NOT NULL ORDER BY round DESC LIMIT 1),
goal AS (
  SELECT source, source_size, least(source_size * 3e0, free::DOUBLE * weight / w::DOUBLE) AS target FROM src, share),
classed AS (
  SELECT *, 8 + least(16, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END) AS own FROM sized),
sums AS (SELECT source, own, sum(size) AS n FROM classed GROUP BY ALL),
levels AS (
  SELECT source, own, (sum(n) OVER (PARTITION BY source ORDER BY own DESC) - n)::BIGINT AS above, (sum(n * own) OVER (PARTITION BY source ORDER BY own))::BIGINT AS inside FROM sums),
rates AS (
  SELECT g.source, max(g.source_size) AS source_size, max(g.target) AS target, coalesce(arg_max((target - above * 3e0) / inside, own) FILTER (WHERE inside > 0 AND (target - above * 3e0) / inside * own <= 3),
         CASE WHEN max(g.source_size) > 0 THEN 3e0 ELSE 0e0 END) AS rate
  FROM goal g JOIN levels l ON g.source IS NOT DISTINCT FROM l.source GROUP BY g.source),
expect AS (
  SELECT s.*, source_size, target, least(3e0, rate * own) AS expected FROM classed s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
ranked AS (
  SELECT *, floor(expected)::BIGINT AS certain, expected > floor(expected) AS extra,
         least(1 - 1e-9::DOUBLE, greatest(1e-9::DOUBLE, expected - floor(expected))) AS p FROM expect),
placed AS (
  SELECT *, ((u / (1e0 - u)) / (p / (1e0 - p))) / (1e0 + (u / (1e0 - u)) / (p / (1e0 - p))) AS rank,
         target - sum(certain * size) OVER (PARTITION BY source) AS wanted FROM ranked),
running AS (
  SELECT *, coalesce(sum(CASE WHEN extra THEN size END) OVER (PARTITION BY source, extra ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM placed)
SELECT doc_id, size, source_size, target,
       ((certain + CASE WHEN extra AND before + size / 2e0 <= wanted THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM running
"""

OP2_SQL = r"""
WITH body AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
rec AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS payload FROM body),
lone AS (
  SELECT page_id, payload, sha256(payload) AS digest, strlen(payload)::BIGINT AS size, count(*) AS copies FROM rec GROUP BY page_id, payload),
named AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY page_id) > 1 THEN digest ELSE '' END AS name FROM lone),
dealt AS (
  SELECT *, ('0x' || substr(md5(coalesce(page_id::VARCHAR, 'null') || ':' || name), 1, 8))::BIGINT % greatest(1, ((SELECT sum(size * copies) FROM lone) + 8388607) // 8388608) AS archive,
         ('0x' || substr(digest, 9, 8))::BIGINT % 53 AS turn FROM named),
placed AS (
  SELECT *, sum(size * copies) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, name) - size * copies AS "offset" FROM dealt)
SELECT archive::BIGINT AS archive, "offset"::BIGINT AS "offset", page_id, CASE turn WHEN 1 THEN 'missing' ELSE 'altered' END AS status, digest AS expected,
       CASE turn WHEN 0 THEN sha256('WARC/1.!' || substr(payload, 9)) WHEN 2 THEN sha256(left(payload, length(payload) - 2)) END AS found
FROM placed WHERE turn < 3 AND ('0x' || substr(md5(archive::BIGINT::VARCHAR), 1, 8))::BIGINT % 4 = 0
"""

#: Within one edit: the common beginning and end cover all but one character of the longer line. Candidates share their first
#: or second half (of the shorter one).
OP5_SQL = r"""
WITH every AS (
  SELECT doc_id, md5(text) AS t, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
lone AS (
  SELECT line, length(line) AS n, min((doc_id, pos)) AS first FROM every WHERE NOT regexp_full_match(line, '\s*') GROUP BY line),
long AS (SELECT *, n // 2 AS h FROM lone WHERE n >= 24),
met AS (
  SELECT a.line AS a, b.line AS b, a.n AS m, b.n AS n FROM long a JOIN long b ON left(a.line, a.h) = left(b.line, a.h) WHERE b.n IN (a.n, a.n + 1) AND a.line <> b.line
  UNION
  SELECT a.line, b.line, a.n, b.n FROM long a JOIN long b ON right(a.line, a.n - a.h) = right(b.line, a.n - a.h) WHERE b.n IN (a.n, a.n + 1) AND a.line <> b.line),
links AS (
  SELECT a, b FROM met
  WHERE len(list_filter(range(1, m + 1), lambda i: left(a, i) = left(b, i))) + len(list_filter(range(1, m + 1), lambda i: right(a, i) = right(b, i))) >= n - 1),
near AS (
  SELECT DISTINCT CASE WHEN x.first < y.first THEN b ELSE a END AS line FROM links JOIN lone x ON a = x.line JOIN lone y ON b = y.line),
judged AS (
  SELECT e.doc_id, e.pos, e.line, l.line IS NOT NULL AND ((e.doc_id, e.pos) <> l.first OR k.line IS NOT NULL) AS dropped,
         coalesce((e.doc_id, e.pos) = l.first AND k.line IS NOT NULL, false) AS near
  FROM every e LEFT JOIN lone l ON e.line = l.line LEFT JOIN near k ON e.line = k.line)
SELECT doc_id, count(*)::INTEGER AS n_lines, count(*) FILTER (WHERE dropped)::INTEGER AS n_dropped, count(*) FILTER (WHERE near)::INTEGER AS n_near,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS text_md5
FROM judged GROUP BY doc_id
"""

OP6_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM ranked) WHERE rank <= 10
"""
OP12_SQL = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM scored WHERE same),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.k ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score
  FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score WHERE p.k <= 5)
SELECT * FROM ranked WHERE rank <= 5
"""

OP13_SQL = """
WITH RECURSIVE leaves AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(4294967295, crc) % 5 = 0
              THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM leaves),
placed AS (
  SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM hashed),
low(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 16, n),
high(level, pos, n, h) AS (
  SELECT 0, tree, count(*) OVER (), h FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 16, n),
every AS (
  SELECT * FROM low UNION ALL SELECT -1, level, pos, n, h FROM high),
kin AS (
  SELECT tree, level, pos, n,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM every),
inner_fold(id, tree, level, pos, n, h, proof) AS (
  SELECT id, tree, 0, pos, n, coalesce(changed, leaf), '' FROM placed
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(l || h || r), proof || l || r
  FROM inner_fold f JOIN kin k ON k.tree = f.tree AND k.level = f.level AND k.pos = f.pos WHERE f.n > 1),
outer_fold(id, level, pos, n, h, proof) AS (
  SELECT id, 0, tree, (SELECT count(*) FROM high WHERE level = 0), h, proof FROM inner_fold WHERE n = 1
  UNION ALL
  SELECT f.id, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(l || h || r), proof || l || r
  FROM outer_fold f JOIN kin k ON k.tree = -1 AND k.level = f.level AND k.pos = f.pos WHERE f.n > 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = top.h AS verified
FROM placed p JOIN outer_fold f ON f.id = p.id AND f.n = 1 JOIN high s ON s.level = 0 AND s.pos = p.tree JOIN (SELECT h FROM high WHERE n = 1) top ON true
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_merkle_audit": op2_merkle_audit,
        "op3_additive_quantisation": op3_additive_quantisation,
        "op4_token_files": op4_token_files,
        "op5_line_dedup": op5_line_dedup,
        "op6_bit_sliced_top_k": op6_bit_sliced_top_k,
        "op7_weighted_minhash": op7_weighted_minhash,
        "op8_language_id": op8_language_id,
        "op9_packing": op9_packing,
        "op10_mixing": op10_mixing,
        "op11_sentence_pieces": op11_sentence_pieces,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_merkle_audit": OP2_SQL, "op5_line_dedup": OP5_SQL, "op6_bit_sliced_top_k": OP6_SQL, "op10_mixing": OP10_SQL, "op12_hard_negatives": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
