"""Registered queries of the training-data operators, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.fingerprints import fingerprint_edits
from demandlake.llm.hyperminhash import near_duplicates
from demandlake.llm.mixing import mix
from demandlake.llm.packing import pack, token_pieces
from demandlake.llm.preferences import mask_text, preference_pairs
from demandlake.llm.quality import quality_rules
from demandlake.llm.scratch import fresh_path, importable, written
from demandlake.llm.sharding import shard_by_size
from demandlake.llm.simhash import simhash_components
from demandlake.llm.spelling import spelling_variants, word_counts
from demandlake.llm.substring_dedup import substring_dedup
from demandlake.llm.suffix_dedup import suffix_dedup
from demandlake.llm.token_files import token_files
from demandlake.llm.whitening import whiten
from demandlake.llm.words import words_of

SHARDS = 40
CAPACITY = 4096
#: The mix of operator 8: weights of the sources in turn, budget as a share of all sizes, most passes over a source.
MIX_WEIGHTS, MIX_SHARE, MIX_MOST = [3, 1, 2], 1.5, 2.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_size(_table(spark, sf_dir, "documents"), SHARDS)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256", "n_spans")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files(docs, vocabulary("byte_bpe_50k.json"), fresh_path(spark, "token-files"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), CAPACITY)
    return pack(pieces, CAPACITY, ["doc_id", "piece", "ids_crc32"])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) make pair k."""
    turns = _table(spark, sf_dir, "conversations")
    paired = turns.select(F.expr("conv_id div 2").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"), "turn", "role", "text")
    masks = {c: mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")}
    return preference_pairs(paired).withColumns(masks)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("text_hash")), "mix-sizes")
    mixed = mix(sized, F.col("size"), [F.col("doc_id"), F.col("text_hash")], MIX_WEIGHTS, MIX_SHARE, MIX_MOST)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=5, percent=85)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(_table(spark, sf_dir, "documents"), min_length=6, drop_every=199)
    return spelling_variants(counts, min_count=5, dominance=5)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=16)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_files": op4_token_files,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_preferences": op7_preferences,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_simhash": op10_simhash,
    "op11_near_duplicates": op11_near_duplicates,
    "op12_spelling": op12_spelling,
    "op13_whitening": op13_whitening,
}

#: Turns by pair and side with their place; the first differing place ends the common prefix.
_OP7_SQL = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, coalesce(role, '') AS role,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT pair_id, count(*) FILTER (side = 0) AS nc, count(*) FILTER (side = 1) AS nr FROM t GROUP BY 1),
d AS (SELECT c.pair_id, min(c.pos) AS pos FROM t c JOIN t r ON c.pair_id = r.pair_id AND c.pos = r.pos AND c.side = 0 AND r.side = 1
      WHERE c.shown <> r.shown GROUP BY 1),
k AS (SELECT n.pair_id, nc, nr, coalesce(d.pos - 1, least(nc, nr)) AS n_common FROM n LEFT JOIN d USING (pair_id)),
m AS (SELECT t.*, k.n_common,
        coalesce(sum(length(shown)) OVER (PARTITION BY t.pair_id, side, pos > n_common ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ofs
      FROM t JOIN k USING (pair_id)),
a AS (SELECT pair_id,
        string_agg(shown, '' ORDER BY pos) FILTER (side = 0 AND pos <= n_common) AS prompt,
        string_agg(shown, '' ORDER BY pos) FILTER (side = 0 AND pos > n_common) AS chosen,
        string_agg(shown, '' ORDER BY pos) FILTER (side = 1 AND pos > n_common) AS rejected,
        string_agg((ofs + 5 + length(role)) || ':' || (ofs + length(shown)), ',' ORDER BY pos) FILTER (side = 0 AND pos > n_common AND role = 'assistant') AS cm,
        string_agg((ofs + 5 + length(role)) || ':' || (ofs + length(shown)), ',' ORDER BY pos) FILTER (side = 1 AND pos > n_common AND role = 'assistant') AS rm
      FROM m GROUP BY 1)
SELECT k.pair_id, CAST(nc AS INTEGER) AS n_chosen, CAST(nr AS INTEGER) AS n_rejected, CAST(n_common AS INTEGER) AS n_common,
       coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
       coalesce(cm, '') AS chosen_mask, coalesce(rm, '') AS rejected_mask
FROM k JOIN a USING (pair_id)
"""

#: Every window's hash is counted; a word (byte) goes if one of the windows that cover it is found again.
_OP2_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS j, ws FROM p),
w AS (SELECT rid, j, ws[j] AS word, CASE WHEN j + 34 <= len(ws) THEN md5(array_to_string(ws[j:j + 34], ' ')) END AS k FROM u),
f AS (SELECT rid, j, word, k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AS again FROM w),
g AS (SELECT rid, j, word, bool_or(again) OVER (PARTITION BY rid ORDER BY j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM f),
h AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY j), false) AS before FROM g),
s AS (SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
             string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM h GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM p LEFT JOIN s USING (rid)
"""

_OP3_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
u AS (SELECT rid, x, unnest(range(1, length(x) // 2 + 1)) AS j FROM p),
w AS (SELECT rid, j, substr(x, 2 * j - 1, 2) AS b, CASE WHEN j + 199 <= length(x) // 2 THEN md5(substr(x, 2 * j - 1, 400)) END AS k FROM u),
f AS (SELECT rid, j, b, k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AS again FROM w),
g AS (SELECT rid, j, b, bool_or(again) OVER (PARTITION BY rid ORDER BY j ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM f),
h AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY j), false) AS before FROM g),
s AS (SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
             string_agg(b, '' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM h GROUP BY rid)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM p LEFT JOIN s USING (rid)
"""

#: Pairs that share a shingle, counted; the least id over all paths of links.
_OP11_SQL = r"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS j FROM p WHERE len(ws) > 0),
s AS (SELECT DISTINCT rid, md5(array_to_string(ws[j:j + 4], ' ')) AS k FROM u),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
c AS (SELECT a.rid AS r1, b.rid AS r2, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.rid <> b.rid GROUP BY 1, 2),
l AS (SELECT r1, r2 FROM c JOIN n x ON x.rid = r1 JOIN n y ON y.rid = r2 WHERE 100 * common >= 85 * (x.n + y.n - common)),
w AS (SELECT rid, rid AS reached FROM p UNION SELECT w.rid, l.r2 FROM w JOIN l ON w.reached = l.r1),
m AS (SELECT w.rid, min(q.doc_id) AS component_id FROM w JOIN p q ON q.rid = w.reached GROUP BY w.rid)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM p JOIN m USING (rid) LEFT JOIN n USING (rid)
"""

ORACLE: dict[str, str] = {"op2_substring_dedup": _OP2_SQL, "op3_suffix_dedup": _OP3_SQL, "op7_preferences": _OP7_SQL, "op11_near_duplicates": _OP11_SQL}
