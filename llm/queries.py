"""The queries of this folder over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import alignment, brown, conversations, html, lines, near, neighbours, packing, pieces, quality, suffixes, token_counts, urls
from llm.common import table


def op1_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op2_repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("key")


def op3_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return brown.score_documents(table(spark, sf_dir, "documents"), held_out)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"),
        quality.passes(quality.STRICT).alias("kept"), "failures",
    )


def op10_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults dealt out by their key: dropped, emptied, cut short, repeated, reroled."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(name("text"), "[.!?]", ""))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(name("role")).alias("role"),
        text.otherwise(name("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def op11_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.repair(damaged(turns), turns)


def op12_line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_lines(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sampled_pieces": op1_sampled_pieces,
    "op2_repeats_removed": op2_repeats_removed,
    "op3_url_verdicts": op3_url_verdicts,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_main_text": op5_main_text,
    "op6_nearest_vectors": op6_nearest_vectors,
    "op7_token_counts": op7_token_counts,
    "op8_class_scores": op8_class_scores,
    "op9_quality_rules": op9_quality_rules,
    "op10_packed_sequences": op10_packed_sequences,
    "op11_repaired_conversations": op11_repaired_conversations,
    "op12_line_repeats": op12_line_repeats,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op4_near_duplicates": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM docs, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * s.n >= 75 * (a.n + b.n - s.n)
), reached AS (
  SELECT doc_id AS doc, doc_id AS root FROM documents
  UNION
  SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.doc
), components AS (
  SELECT doc, min(root) AS component_id FROM reached GROUP BY doc
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components ON doc = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id""",
    "op9_quality_rules": r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT id, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT id, i, list_slice(words, i, i + 7) AS w
  FROM split, unnest(range(1, len(words) - 6)) AS t(i)
), repeated AS (
  SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT id, count(DISTINCT i + o) AS n FROM repeated, range(8) AS r(o) GROUP BY id
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
         length(regexp_replace(text, '[^.!?,;:]+', '', 'g')) AS n_marks
  FROM split LEFT JOIN covered USING (id)
), judged AS (
  SELECT *, n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1,
         100 * n_symbols > 10 * n_words AS r2, 100 * n_dup_lines > 50 * n_lines AS r3,
         100 * n_capitals > 40 * word_chars AS r4, n_marks > n_words AS r5
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       r0 OR r1 AS base_failed, NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5) AS kept,
       CAST(r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT
            AS INT) AS failures
FROM judged""",
    "op12_line_repeats": r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines
  FROM documents
), lines AS (
  SELECT id, doc_id, i, all_lines[i] AS line,
         translate(regexp_replace(all_lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM docs, unnest(range(1, len(all_lines) + 1)) AS t(i)
), shared AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT id) >= 10
), marked AS (
  SELECT lines.*, shared.key IS NOT NULL AS gone FROM lines LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY id, doc_id""",
}
