"""Queries of the operators in this subpackage, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recordlake.llm import bpe, wavelet
from recordlake.llm.conversations import repaired
from recordlake.llm.decontaminate import contaminated
from recordlake.llm.extract import extract
from recordlake.llm.frames import table
from recordlake.llm.jaccard import jaccard_join
from recordlake.llm.lines import MIN_PAGES, RATIO, drop_boilerplate
from recordlake.llm.neighbours import nearest
from recordlake.llm.periodic import run_digests
from recordlake.llm.setsketch import near_duplicates
from recordlake.llm.substrings import remove_repeats
from recordlake.llm.tokencounts import count_tokens
from recordlake.llm.toxicity import scored
from recordlake.session import scratch_path


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return drop_boilerplate(docs).select("doc_id", "source", "text", "n_lines", "n_removed")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                        scratch_path(spark, "token-cache"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op10_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.id_checksums(spark, path)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


#: The lines kept of ``documents``; also the first SQL step for the pipeline's stage.
LINES_SQL = f"""
WITH l AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
counts AS (
  SELECT source, trim(line) AS line, count(DISTINCT doc_id) AS n
  FROM l WHERE trim(line) <> '' GROUP BY 1, 2),
boiler AS (
  SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= {MIN_PAGES} AND c.n > {RATIO} * t.pages),
marked AS (
  SELECT l.doc_id, l.pos, l.line, b.line IS NOT NULL AS gone
  FROM l LEFT JOIN boiler b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_SHINGLES = """SELECT DISTINCT {id}, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
        FROM (SELECT {id}, {words} AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) > 0)"""
CONTAINED_SQL = f"""
WITH items AS ({_SHINGLES.format(id="item_id", words=_WORDS, table="benchmark")}),
docs AS ({_SHINGLES.format(id="doc_id", words=_WORDS, table="documents")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY 1),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM items JOIN docs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shingles, n_shared FROM shared JOIN sizes USING (item_id)
WHERE 100 * n_shared >= 80 * n_shingles
"""

NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_html_extraction": op1_html_extraction, "op2_minhash_near_dedup": op2_minhash_near_dedup,
            "op3_line_dedup": op3_line_dedup, "op4_bpe_codec": op4_bpe_codec, "op5_substring_dedup": op5_substring_dedup,
            "op6_benchmark_decontamination": op6_benchmark_decontamination,
            "op7_token_counts": op7_token_counts,
            "op8_toxicity": op8_toxicity, "op9_nearest_neighbours": op9_nearest_neighbours, "op10_wavelet_ids": op10_wavelet_ids,
            "op11_periodic_runs": op11_periodic_runs, "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
            "op13_conversation_repair": op13_conversation_repair}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": LINES_SQL, "op6_benchmark_decontamination": CONTAINED_SQL, "op9_nearest_neighbours": NEAREST_SQL}
