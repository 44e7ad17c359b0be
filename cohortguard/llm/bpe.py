"""Byte-level byte-pair encoding and decoding by a rank file.

A text is split by a pattern; every match is encoded by itself, by merging
the adjacent pair of bytes or tokens of lowest rank until none has a rank.

The work is done per distinct word: a task folds the merges over the words it
has not met yet, all at once (:mod:`.merges`), and joins remembered ids for
the rest.  :func:`encode_words_sql` is the same fold in Spark's higher-order
functions over a literal rank map; it gives equal ids and is kept for small
word tables (see README for why it is not the main path).
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_groups, text_or_empty
from .merges import PieceIds, load_byte_ranks

#: Distinct words whose ids a Python worker remembers.
CACHE_WORDS = 600_000
_BLANKS_AFTER_SPACE = re.compile(r" (?=\s|$)")


class ByteCodec:
    """Encoder and decoder for one rank file and split pattern.

    No match of the pattern may begin before and end after a space that a
    non-space follows; texts are cut there, so that the pieces between can be
    remembered.  That holds for patterns in which such a space begins a word.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        merges, ranks, symbols = load_byte_ranks(path)
        self.dtype = np.dtype("<u2") if max(ranks.values()) < 1 << 16 else np.dtype("<u4")
        self.pieces = PieceIds(merges, symbols, symbols, self.dtype.str, CACHE_WORDS)
        size = max(ranks.values()) + 1
        self.token, self.decimal = [b""] * size, [str(i).encode() for i in range(size)]
        for token, r in ranks.items():
            self.token[r] = token
        # a token that is a whole word stands for it, whatever the merges give
        self.whole = {p: np.array([r], self.dtype).tobytes() for t, r in ranks.items()
                      if (p := t.decode("utf-8", "ignore")).encode() == t and p}
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = dict(self.whole)

    def _chunks(self, text: str) -> list[str]:
        """Cut before every space that a non-space follows."""
        parts = text.split(" ")
        chunks = [parts[0]] if parts[0] else []
        if not _BLANKS_AFTER_SPACE.search(text):
            chunks.extend([" " + p for p in parts[1:]])
            return chunks
        for p in parts[1:]:
            if p and not p[0].isspace() or not chunks:
                chunks.append(" " + p)
            else:
                chunks[-1] += " " + p
        return chunks

    def _learn(self, chunks: list[str]) -> None:
        split = [self.split(c) for c in chunks]
        whole = self.whole
        known = self.pieces.learn({p for x in split for p in x if p not in whole})
        for chunk, x in zip(chunks, split):
            self.cache[chunk] = b"".join([whole[p] if p in whole else known[p] for p in x])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        cache = self.cache
        if len(cache) > CACHE_WORDS + len(self.whole):
            cache = self.cache = dict(self.whole)
        split = [self._chunks(t) for t in texts]
        found = [list(map(cache.get, x)) for x in split]
        new = {c for x, ids in zip(split, found) if None in ids for c, i in zip(x, ids) if i is None}
        if new:
            self._learn(list(new))
        return [b"".join([cache[c] if i is None else i for c, i in zip(x, ids)])
                for x, ids in zip(split, found)]

    def ids(self, packed: bytes) -> list[int]:
        return np.frombuffer(packed, self.dtype).tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Concatenate the tokens' bytes."""
        return b"".join(map(self.token.__getitem__, ids))


_CODECS: dict[tuple[str, str], ByteCodec] = {}


def _codec(path: str, pattern: str) -> ByteCodec:
    """The worker's codec, kept from task to task."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteCodec(path, pattern)
    return _CODECS[path, pattern]


def bpe_encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>``: the token ids of every whole text.

    A null text is an empty one, without ids; repeated rows stay; other
    columns are ignored.  Narrow: no shuffle, and a worker's memory of words
    is bounded.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            ids = [codec.ids(p) for p in in_groups(codec.encode_batch, batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, decoded binary``: the bytes of every id list (null: empty)."""
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(ids_col, F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([codec.decode(x) for x in batch["ids"].to_pylist()], pa.binary())],
                names=["id", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids, in one pass: ``id_col, n_tokens,
    ids_sha256`` (of decimal ids joined by commas) and ``decoded_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for packed in in_groups(codec.encode_batch, batch["text"].to_pylist()):
                ids = codec.ids(packed)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(map(codec.decimal.__getitem__, ids))).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))


def encode_words_sql(word: Column, ranks: dict[bytes, int], buckets: int = 8192) -> Column:
    """Ids of one word (a match of the pattern) by higher-order functions only.

    The rank map is a literal: an array of small maps, picked by CRC-32 of the
    token, since looking up a map literal scans it.  Each step of the fold
    replaces the leftmost pair of lowest rank by its concatenation.
    """
    table: list[dict[str, int]] = [{} for _ in range(buckets)]
    for token, r in ranks.items():
        table[zlib.crc32(token) % buckets][token.hex().upper()] = r
    literal = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")

    def rank(token: Column) -> Column:
        return F.element_at(F.element_at(literal, (F.crc32(token) % buckets).cast("int") + 1), F.hex(token))

    none = F.lit(2 ** 31 - 1)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1),
                            lambda j: F.coalesce(rank(F.concat(F.element_at(parts, j), F.element_at(parts, j + 1))), none))

        def merge(found: Column) -> Column:
            at = F.array_position(found, F.array_min(found)).cast("int")
            return F.when(F.array_min(found) == none, parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1),
                F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
                F.slice(parts, at + 2, F.size(parts))))

        return F.when(F.size(parts) < 2, parts).otherwise(F.element_at(F.transform(F.array(pairs), merge), 1))

    raw = word.cast("binary")
    n = F.octet_length(raw)
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(raw, i, F.lit(1)))
    folded = F.aggregate(F.sequence(F.lit(1), n), parts, step)
    return (F.when(n == 0, F.array().cast("array<int>")).when(rank(raw).isNotNull(), F.array(rank(raw)))
            .otherwise(F.transform(folded, rank)))
