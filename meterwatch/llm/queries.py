"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterwatch.llm import bpe, decontam, langid, lm, phrases, pii, quality, secrets, sharding, simhash, toxicity, trie, warc
from meterwatch.llm.common import table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def pieces() -> list[bytes]:
    return bpe.read_ranks(public_tokenizers.path(TOKENIZER))


def _on(*names: str) -> Callable:
    """Turn an operator over tables into a query."""
    return lambda f: lambda spark, sf_dir: f(*[table(spark, sf_dir, n) for n in names])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": _on("documents")(pii.digest),
    "op2_byte_bpe": _on("documents")(lambda d: bpe.digest(d, pieces(), public_tokenizers.PATTERN)),
    "op3_decontamination": _on("documents", "benchmark")(decontam.digest),
    "op4_hmm": _on("documents")(lm.digest),
    "op5_toxicity": _on("documents", "labels")(toxicity.digest),
    "op6_secrets": _on("documents")(secrets.digest),
    "op7_revisits": _on("pages")(warc.digest),
    "op8_simhash": _on("documents")(simhash.digest),
    "op9_quality": _on("documents", "labels")(quality.judge),
    "op10_language": _on("documents")(langid.digest),
    "op11_trie": _on("conversations")(trie.digest),
    "op12_sharding": _on("documents")(sharding.digest),
    "op13_phrases": _on("documents")(phrases.digest),
}

#: DuckDB has no function for most digests and models; those queries are tested against brute force.
ORACLE_SQL = {
    "op7_revisits": warc.ORACLE,
    "op11_trie": trie.ORACLE,
    "op12_sharding": sharding.ORACLE,
    "op13_phrases": phrases.ORACLE,
    "op3_decontamination": r"""
        WITH docs AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        items AS (
          SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        spread AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS pos FROM items WHERE len(ws) > 0),
        grams AS (SELECT DISTINCT item_id, n, list_slice(ws, pos, pos + n - 1) AS w FROM spread),
        places AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n),
        hits AS (SELECT doc_id, pos, n, item_id FROM (SELECT doc_id, pos, n, list_slice(ws, pos, pos + n - 1) AS w FROM places) JOIN grams USING (n, w)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(ws) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
          sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id""",
}
