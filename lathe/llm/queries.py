"""The dealt queries ``opN_<name>`` and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathe.llm import alignment, conversation_repair, exact_dedup, language, line_dedup, mixing, packing, piece_codec, quality, simhash, substring_dedup, toxicity, url_filter
from lathe.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id", "class_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.line_dedup(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(talks), talks)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digest(piece_codec.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")))


QUERIES = {f.__name__: f for f in (op1_cube_mix, op2_pack, op3_simhash, op4_substring_dedup, op5_line_dedup, op6_toxicity, op7_url_filter, op8_language, op9_quality_rules, op10_exact_dedup,
                                  op11_conversation_repair, op12_alignment, op13_pieces)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLE = {
    "op5_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS k FROM lines),
common AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.doc_id, pos, line, common.k IS NOT NULL AND keyed.doc_id < top AS gone
           FROM keyed LEFT JOIN common ON keyed.k = common.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t""",
    "op9_quality_rules": f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, {_WORD})) AS word,
             generate_subscripts(regexp_extract_all(text, {_WORD}), 1) AS pos FROM d),
runs AS (SELECT doc_id, pos, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS run,
                count(*) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS n FROM w),
twice AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, run) AS c FROM runs WHERE n = 8),
rep AS (SELECT doc_id, count(DISTINCT pos + i) AS n_repeat_words FROM twice, range(8) t(i) WHERE c > 1 GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
lines AS (SELECT doc_id, source, line, {_LOWER.format(f"trim(line, {_SPACE})")} AS norm FROM (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d) WHERE trim(line, {_SPACE}) <> ''),
common AS (SELECT coalesce(source, '<null>') AS s, norm FROM lines GROUP BY ALL HAVING count(DISTINCT doc_id) > 50),
lc AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(lines.norm)) AS line_chars,
              sum(CASE WHEN common.norm IS NULL THEN 0 ELSE length(lines.norm) END) AS removed_chars
       FROM lines LEFT JOIN common ON coalesce(source, '<null>') = s AND lines.norm = common.norm GROUP BY doc_id),
j AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_chars, 0) AS line_chars,
             coalesce(removed_chars, 0) AS removed_chars
      FROM d LEFT JOIN wc ON d.doc_id = wc.doc_id LEFT JOIN lc ON d.doc_id = lc.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (line_chars - removed_chars < 0.3 * line_chars) AS kept,
       CAST(line_chars AS BIGINT) AS line_chars, CAST(removed_chars AS BIGINT) AS removed_chars
FROM j""",
}
