"""The dealt operators bound to the driver tables, as ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read
from .bpe import bpe_digests
from .common import shared_path
from .exact_dedup import duplicate_groups
from .fingerprints import compare_with_next
from .html_extract import extract_main_text, fit_regions
from .line_dedup import dedup_lines
from .merkle import digest_of, merkle_manifest, proof_digest
from .ngram_join import ngram_jaccard_components
from .packing import pack
from .suffix_dedup import cut_repeats
from .suffix_trees import cut_repeated_words
from .toxicity import fit_toxicity, toxicity_scores
from .warc import archived_pages, read_warc, write_warc
from .whitening import whiten

SPACES = r"[\x20\x09-\x0D]+"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity_scores(docs, fit_toxicity(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    whole = read_warc(spark, path, payload=True, verify=True).where("record_type = 'response'")
    again = read_warc(spark, path, payload=False).where("record_type = 'revisit'")
    return archived_pages(whole).unionByName(archived_pages(again))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_regions(pages))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(read(spark, sf_dir, "documents", "doc_id", "text"), digest_all=True)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeated_words(read(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    # an audit that finds the text of every fifth document, by checksum, in lower case
    lower = digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"),
                      F.translate("text", _UPPER, _LOWER))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower)
    manifest = merkle_manifest(docs, observed=tampered)
    return manifest.withColumn("proof_sha256", proof_digest(F.col("path"))).drop("path", "group")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it does not fit a long."""
    rows = whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_fingerprints": op6_fingerprints,
    "op8_html_extraction": op8_html_extraction,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen(({value})::VARCHAR), ':', {value}) END"


SQL: dict[str, str] = {
    "op10_exact_dedup": rf"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') AS s FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(s) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY s)""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE
        crc_table AS (
            SELECT list(v ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) r(i))),
        rows AS (
            SELECT doc_id, source,
                   concat({_sql_field('doc_id')}, {_sql_field('source')}, {_sql_field('lang')},
                          {_sql_field('n_chars')}) AS head, text,
                   xor(list_reduce(list_concat([4294967295::BIGINT],
                       list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM documents, crc_table),
        leaves AS (
            SELECT doc_id, source, sha256(concat(head, {_sql_field('text')})) AS leaf,
                   CASE WHEN crc % 5 = 0 THEN sha256(concat(head, {_sql_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}))
                   END AS seen FROM rows),
        placed AS (
            SELECT *, coalesce('=' || source, '') AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n FROM leaves),
        up AS (
            SELECT 0 AS lvl, tree, pos, n, leaf AS h FROM placed
            UNION ALL
            SELECT lvl + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
            FROM up WHERE n > 1 GROUP BY lvl, tree, pos // 16, n),
        subroots AS (
            SELECT tree, h, lvl, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
            FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS lvl, pos, n, h FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
            FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n),
        steps AS (
            SELECT a.lvl, a.tree, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
                   coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
            FROM up a JOIN up b ON a.lvl = b.lvl AND a.tree = b.tree AND a.pos // 16 = b.pos // 16
            WHERE a.n > 1 GROUP BY a.lvl, a.tree, a.pos),
        top_steps AS (
            SELECT a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
                   coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
            FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
            WHERE a.n > 1 GROUP BY a.lvl, a.pos),
        fold AS (
            SELECT 0 AS k, p.doc_id, p.leaf, p.tree, p.pos, s.lvl AS height, s.pos AS top_pos, s.h AS subroot,
                   coalesce(p.seen, p.leaf) AS h, '' AS proof,
                   (SELECT max(lvl) FROM top) AS top_height, (SELECT h FROM top WHERE n = 1) AS root
            FROM placed p JOIN subroots s ON s.tree = p.tree
            UNION ALL
            SELECT f.k + 1, f.doc_id, f.leaf, f.tree, f.pos, f.height, f.top_pos, f.subroot,
                   sha256(concat(coalesce(s.lo, t.lo), f.h, coalesce(s.hi, t.hi))),
                   concat(f.proof, coalesce(s.lo, t.lo), coalesce(s.hi, t.hi)), f.top_height, f.root
            FROM fold f
            LEFT JOIN steps s ON f.k < f.height AND s.lvl = f.k AND s.tree = f.tree AND s.pos = f.pos >> (4 * f.k)
            LEFT JOIN top_steps t ON f.k >= f.height AND t.lvl = f.k - f.height
                                 AND t.pos = f.top_pos >> (4 * (f.k - f.height))
            WHERE f.k < f.height + f.top_height)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
        FROM fold WHERE k = height + top_height""",
}
