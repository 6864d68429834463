"""Registered queries of the subpackage: one a numbered operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cantora.llm import decontaminate, lines, merkle, packing, passages, pii, quality, repair, separators, sharding, suffixes, warc
from cantora.llm.minhash import near_duplicates
from cantora.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more near another document's."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives in the shared folder and read back."""
    root = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), root)
    return warc.read_archives(spark, root, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS kept FROM p GROUP BY h),
d AS (SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h || '0', 1 + (5 * i) // 4, 2))::INTEGER >> (3 - (5 * i) % 4)) % 32, 1), '' ORDER BY i) AS digest
      FROM k, range(32) r(i) GROUP BY h)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to FROM p JOIN k USING (h) JOIN d USING (h)"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    return pii.report(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in any order of its parts."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
f AS (SELECT doc_id, i, [x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o] AS five FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM f WHERE five[5] IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, length(t) - length(translate(t, '!', '')) AS n_excl,
        [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
        coalesce(n_repeat, 0) AS n_repeat_words FROM d LEFT JOIN r USING (doc_id)),
v AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
j AS (SELECT *, CASE WHEN base_failed THEN 'base' WHEN 100 * n_symbols > 10 * n_words THEN 'symbols' WHEN 100 * n_excl > 50 * n_words THEN 'exclaims'
        WHEN 100 * n_dup > 30 * len(lines) THEN 'lines' WHEN word_chars > 100 * n_words THEN 'long_words' END AS rejected FROM v)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, rejected IS NULL AS kept FROM j"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, scanned from flat token files of all ``documents``."""
    root = scratch_path(spark, "flat")
    return separators.count_tokens(spark, separators.write_flat(table(spark, sf_dir, "documents"), tokenizer_path(), root), root)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes under 400-byte strings that start anywhere else, too."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 % of shared 5-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, root, proof and its check against planted tampering of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


OP11_SQL = f"""
WITH RECURSIVE h AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree,
         sha256({_field_sql('doc_id')} || {_field_sql('source')} || {_field_sql('lang')} || {_field_sql('n_chars')} || {_field_sql('text')}) AS leaf,
         sha256({_field_sql('doc_id')} || {_field_sql('source')} || {_field_sql('lang')} || {_field_sql('(n_chars + 1)')} || {_field_sql('text')}) AS changed,
         list_reduce(flatten([[4294967295]] || [[ascii(substr(doc_id::VARCHAR, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN generate_series(1, length(doc_id::VARCHAR))]),
           lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END) AS crc
  FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM h),
t AS (
  SELECT tree, 0 AS l, pos AS i, leaf AS d, max(pos) OVER (PARTITION BY tree) AS top FROM n
  UNION ALL SELECT tree, l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), max(top) // 2 FROM t WHERE top > 0 GROUP BY tree, l + 1, i // 2),
r AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM t WHERE top = 0),
u AS (
  SELECT 0 AS l, pos AS i, d, max(pos) OVER () AS top FROM r
  UNION ALL SELECT l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), max(top) // 2 FROM u WHERE top > 0 GROUP BY l + 1, i // 2),
w AS (
  SELECT a.tree, a.l, a.i, CASE WHEN b.d IS NULL THEN 'N' WHEN b.i < a.i THEN 'L' || b.d ELSE 'R' || b.d END AS step
  FROM t a LEFT JOIN t b ON a.tree = b.tree AND a.l = b.l AND b.i = xor(a.i, 1) WHERE a.top > 0
  UNION ALL SELECT '.', a.l, a.i, CASE WHEN b.d IS NULL THEN 'N' WHEN b.i < a.i THEN 'L' || b.d ELSE 'R' || b.d END
  FROM u a LEFT JOIN u b ON a.l = b.l AND b.i = xor(a.i, 1) WHERE a.top > 0),
s AS (
  SELECT n.tree, n.pos, w.l AS k, w.step FROM n JOIN w ON n.tree = w.tree AND w.i = n.pos >> w.l
  UNION ALL SELECT n.tree, n.pos, 100 + w.l, w.step FROM n JOIN r ON n.tree = r.tree JOIN w ON w.tree = '.' AND w.i = r.pos >> w.l),
p AS (SELECT tree, pos, list(step ORDER BY k) AS steps FROM s GROUP BY tree, pos),
f AS (
  SELECT n.doc_id, n.leaf, r.d AS subroot, (SELECT d FROM u WHERE top = 0) AS root, coalesce(steps, []) AS steps,
         CASE WHEN crc IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 THEN coalesce(changed, leaf) ELSE leaf END AS start
  FROM n JOIN r ON n.tree = r.tree LEFT JOIN p ON n.tree = p.tree AND n.pos = p.pos),
g AS (
  SELECT *, sha256(array_to_string([substr(x, 2) FOR x IN steps], '')) AS proof_sha256,
         list_reduce([start] || steps, lambda a, x: CASE WHEN x[1] = 'L' THEN sha256(substr(x, 2) || a) ELSE sha256(a || substr(x, 2)) END) AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM g"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its lines that five documents or more hold, but for the last of these."""
    return lines.report(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH s AS (SELECT chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS blanks),
l AS (SELECT doc_id, i, x, translate(trim(x, blanks), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents), s),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT doc_id, i, x, last IS NULL OR last = doc_id AS kept FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE NOT kept)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE kept), '')) AS kept_sha256 FROM j GROUP BY doc_id"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the planted damage."""
    return repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_best_fit_packing, op3_warc, op4_pii, op5_decontamination, op6_quality_rules, op7_token_counts, op8_sharding, op9_suffix_dedup, op10_minhash_near_dedup, op11_merkle_manifest, op12_line_dedup, op13_conversation_repair)}
ORACLES: dict[str, str] = {"op3_warc": OP3_SQL, "op6_quality_rules": OP6_SQL, "op11_merkle_manifest": OP11_SQL, "op12_line_dedup": OP12_SQL}
