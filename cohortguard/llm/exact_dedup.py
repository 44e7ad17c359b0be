"""Exact document deduplication by progressive refinement [native].

Two texts are equal when they are identical after every run of the ASCII
white-space characters (space, tab, LF, VT, FF, CR) becomes one space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BITMAP_BITS, attach_group, bitmap_of, fresh, text_or_empty, with_mark, written

#: Code points of a text that the second refinement hashes.
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """``text`` with each run of ASCII white space as one space."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                     digest_all: bool = False, prefix_chars: int = PREFIX_CHARS,
                     bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """Group equal texts; the row with the smallest id stays.

    1. Texts are counted by normalised length; a length that occurs once is
       settled.
    2. The others are counted by length and hash of their first characters.
    3. Full content is hashed only for texts whose (length, prefix hash)
       occurs at least twice.  The surviving keys reach the second scan as a
       bitmap of fixed size, so the texts themselves are never shuffled; a
       false hit in the bitmap costs one needless hash, nothing else.

    Groups are formed on SHA-256 of the normalised text by partial
    aggregation, and the result is attached without meeting in one task.

    Returns ``id_col, keep_id, group_size, kept, text_sha256``, one row per
    input row.  ``digest_all`` fills ``text_sha256`` for settled texts too
    (null otherwise).  Null texts count as empty; empty texts equal each
    other; a null id sorts after all others; of rows with equal id and text
    one is kept.  Other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("_id"), normalised(text_or_empty(text_col)).alias("_norm"))
    sized = base.select("_id", "_norm", F.octet_length("_norm").alias("_len"),
                        F.xxhash64(F.left("_norm", F.lit(prefix_chars))).alias("_prefix"))
    counts = sized.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_len = counts.groupBy("_len").agg(F.sum("_n").alias("_of_len")).where("_of_len > 1")
    keys = counts.join(by_len, "_len", "left_semi").where("_n > 1")
    sha = F.sha2("_norm", 256)
    marked = (with_mark(sized, bitmap_of(keys, "_len", "_prefix", bits=bitmap_bits), "_open", "_len", "_prefix",
                        bits=bitmap_bits)
              .select("_id", "_open", (sha if digest_all else F.when(F.col("_open"), sha)).alias("_sha"),
                      F.monotonically_increasing_id().alias("_row")))
    table = written(marked, "exact-dedup")
    opened = table.where("_open")
    rank = F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_row").alias("c"))
    facts = opened.groupBy("_sha").agg(F.min(rank).alias("_first"), F.count(F.lit(1)).alias("group_size"))
    grouped = attach_group(opened, facts, "_sha", "group_size")
    out = grouped.select("_id", F.col("_first.b").alias("keep_id"), "group_size",
                         (F.col("_row") == F.col("_first.c")).alias("kept"), "_sha")
    alone = table.where("not _open").select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "_sha")
    return out.unionByName(alone).select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept",
                                         F.col("_sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows with equal id and equal text are repeated rows; one of them stays.
    """
    doc_sha, kept_id, kept_sha, again = map(fresh, ("sha", "kept_id", "kept_sha", "again"))
    groups = duplicate_groups(docs, id_col, text_col, digest_all=True)
    kept = groups.where("kept").select(F.col(id_col).alias(kept_id), F.col("text_sha256").alias(kept_sha))
    rows = (docs.withColumn(doc_sha, F.sha2(normalised(text_or_empty(text_col)), 256))
            .join(kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(doc_sha) == F.col(kept_sha)), "left_semi"))
    first = F.row_number().over(Window.partitionBy(id_col, doc_sha).orderBy(F.lit(1)))
    return rows.withColumn(again, first).where(F.col(again) == 1).select(*docs.columns)
