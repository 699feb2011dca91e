"""The corpus operators bound to the test tables: name -> function of (spark, folder), and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postmill.llm import (
    backoff_lm, chat_events, decontam_templates, hnsw_shards, html_blocks, line_windows, merkle_manifest, nbsvm, pii_boosting,
    piece_fst, sequence_packing, simhash_mih, turn_trie,
)
from postmill.llm.common import importable, read

Query = Callable[[SparkSession, str], DataFrame]

_CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(read(spark, sf_dir, "pages"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: what is left after line deduplication, and how many lines went."""
    out = line_windows.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "lines_removed", F.length("text").cast("bigint").alias("n_chars_left"), F.md5("text").alias("text_md5"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score(read(spark, sf_dir, "documents"))


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boosting.report(read(spark, sf_dir, "documents"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_fst.encode(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_mih.near_duplicates(read(spark, sf_dir, "documents"))


def _decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_templates.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_CONTROL_TEXT).alias("text"))
    return chat_events.digests(chat_events.messages(chat_events.stored_turns(stored.unionByName(probe))))


def _ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_shards.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.prefix_trie(*turn_trie.rebuilt(read(spark, sf_dir, "conversations")))


def _merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.report(read(spark, sf_dir, "documents"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_packing.report(read(spark, sf_dir, "documents"))


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


LLM_QUERIES: dict[str, Query] = {
    "op1_html_extraction": _html,
    "op2_line_dedup": _lines,
    "op3_quality_classifier": _quality,
    "op4_lm_scoring": _lm,
    "op5_pii": _pii,
    "op6_sentencepiece": _pieces,
    "op7_simhash": _simhash,
    "op8_decontamination": _decontam,
    "op9_chat_formatting": _chat,
    "op10_ann": _ann,
    "op11_prefix_trie": _trie,
    "op12_merkle_manifest": _merkle,
    "op13_packing": _packing,
}
LLM_QUERIES = {name: _ready(query) for name, query in LLM_QUERIES.items()}

LLM_ORACLES: dict[str, str] = {
    "op2_line_dedup": """
WITH lines AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL
), clean AS (
  SELECT doc_id, i, trim(regexp_replace(line, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS line FROM lines
), spoken AS (
  SELECT doc_id, i, line, count(*) OVER (PARTITION BY doc_id) AS n,
         lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2, lead(i, 1) OVER w AS i1, lead(i, 2) OVER w AS i2,
         row_number() OVER w AS r
  FROM clean WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
  SELECT doc_id, i AS first, CASE WHEN n = 1 THEN i WHEN n = 2 THEN i1 ELSE i2 END AS last,
         struct_pack(n := least(n, 3), a := line, b := l1, c := l2) AS w
  FROM spoken WHERE r <= greatest(n - 2, 1)
  UNION ALL
  SELECT doc_id, i, i, struct_pack(n := -1, a := line, b := NULL, c := NULL)
  FROM spoken WHERE length(line) > 100 AND len(string_split(line, ' ')) > 50
), ranked AS (
  SELECT doc_id, first, last, row_number() OVER (PARTITION BY w ORDER BY doc_id, first) AS k FROM windows
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM ranked WHERE k > 1
), rest AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS n
  FROM lines l ANTI JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(r.n, 0) END AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(r.text, '')) END AS n_chars_left,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(r.text, '')) END AS text_md5
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
""",
}
