"""Corpus cleaning pipeline over the training-data operators.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written and read again as the next
one's ``docs``.  All stages but the last return the columns of ``documents``.
Nulls, empty texts, repeated rows, empty tables and extra columns are handled
as each operator's docstring states; extra columns travel along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortguard.llm.common import written
from cohortguard.llm.exact_dedup import drop_exact_copies
from cohortguard.llm.ngram_join import drop_near_copies
from cohortguard.llm.packing import pack
from cohortguard.llm.suffix_dedup import drop_repeats
from cohortguard.llm.toxicity import drop_toxic, fit_toxicity
from cohortguard.sources.tables import read


#: Bytes of an Arrow batch: a task holds so much of the texts at once, and not
#: ten thousand of them however long they are.
BATCH_BYTES = 4 << 20
#: Rows that a scan decodes at once: of texts, few fill megabytes.
SCAN_ROWS = 512
#: What a worker of the last stage remembers and encodes at once: little, since
#: the stages before it leave less room than packing alone has.
PACK_CHUNKS, PACK_CHARS = 50_000, 500_000


def _by_bytes(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from labelled rows
    of ``docs`` that are not held out."""
    _by_bytes(spark)
    return drop_toxic(docs, fit_toxicity(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest doc_id stays."""
    _by_bytes(spark)
    return drop_exact_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.75 or more), the
    one with the smallest doc_id stays."""
    _by_bytes(spark)
    return drop_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of strings of 100 bytes are cut from the texts; ``n_chars``
    follows.  No row goes."""
    _by_bytes(spark)
    return drop_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    _by_bytes(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), chunks=PACK_CHUNKS, group_chars=PACK_CHARS,
                keep=False)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_jaccard", ngram_jaccard),
          ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: None: SQL cannot express the fitted classifier and the tokenizer; the
#: other stages are tested in plain Python on planted cases (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
