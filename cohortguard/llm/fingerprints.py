"""Document fingerprints by winnowing.

Of every window of ``w`` consecutive k-grams the smallest rolling hash is
kept, the rightmost one on ties, with its position.  Two texts that share a
string of ``k + w - 1`` bytes share a kept hash; strings below ``k`` bytes are
never matched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .shingles import span_hashes
from .suffix_dedup import _SEGMENT, anchors

KGRAM = 16
WINDOW = 65
_FIRST = -(1 << 63)  # order key of a null id: after all others in descending order


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Runs of (index, start in text, bytes) of the texts of ``length`` bytes or
    more; long texts come in pieces that overlap by ``length - 1``."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for a in range(0, len(t) - length + 1, _SEGMENT):
            group.append((i, a, t[a:a + _SEGMENT + length - 1]))
            size += len(group[-1][2])
            if size >= _SEGMENT:
                yield group
                group, size = [], 0
    if group:
        yield group


def winnow(texts: list[bytes], k: int = KGRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(32-bit hashes, positions) of each text, by position.

    A text shorter than a window's bytes keeps its smallest k-gram; one
    shorter than ``k`` is hashed whole; an empty one keeps nothing.
    """
    length = k + window - 1
    out: list = [None] * len(texts)
    for group in _pieces(texts, length):
        stops = np.cumsum([len(x[2]) for x in group])
        h, place, lo, _ = anchors(np.frombuffer(b"".join(x[2] for x in group), np.uint8), stops, length, k)
        doc = np.searchsorted(stops, lo, side="right")
        cut = np.searchsorted(doc, np.arange(len(group) + 1))
        begin = np.concatenate([[0], stops[:-1]])
        for n, (i, start, _) in enumerate(group):
            own, at = (h[cut[n]:cut[n + 1]] >> np.uint64(32)).astype(np.uint32), place[cut[n]:cut[n + 1]] - begin[n] + start
            if out[i] is None:
                out[i] = [], []
            elif out[i][1][-1][-1] == at[0]:  # kept in the piece before, too
                own, at = own[1:], at[1:]
            if len(at):
                out[i][0].append(own)
                out[i][1].append(at)
    out = [x and (np.concatenate(x[0]), np.concatenate(x[1])) for x in out]
    for i, t in enumerate(texts):
        if out[i] is None:
            data = np.frombuffer(t, np.uint8)
            at = np.arange(max(1, len(t) - k + 1)) if t else np.empty(0, np.int64)
            h = span_hashes(data, at, np.minimum(at + k, len(t))) if t else np.empty(0, np.uint64)
            best = np.flatnonzero(h == h.min())[-1:] if len(h) else at
            out[i] = ((h[best] >> np.uint64(32)).astype(np.uint32), at[best])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    x, y = np.unique(a), np.unique(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def encode(hashes: np.ndarray) -> str:
    """A fingerprint as text: eight hexadecimal digits per kept hash."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = KGRAM,
                 window: int = WINDOW) -> DataFrame:
    """``id_col, hashes array<long>, positions array<int>`` for every row
    (null text: empty; positions count bytes).  Narrow: no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = winnow([t.encode() for t in batch["text"].to_pylist()], k, window)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([h.tolist() for h, _ in made], pa.list_(pa.int64())),
                 pa.array([p.tolist() for _, p in made], pa.list_(pa.int32()))], names=["id", "hashes", "positions"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, hashes array<long>, positions array<int>")
            .withColumnRenamed("id", id_col))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = KGRAM,
                      window: int = WINDOW, rows_per_bucket: int = 2000) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses.

    The next document is the one of next smaller id; after the smallest comes
    the largest.  Ids are cut into buckets of about equal numbers of rows; the
    first document of a bucket is also sent to the bucket before it, so each
    task sees every successor.  The driver holds two numbers per bucket.  Texts
    are shuffled once.

    Returns ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.  Null texts are empty.  Rows with equal ids
    follow each other by text; null ids come last.  A single row follows
    itself.  ``id_col`` must be an integer column; other columns are ignored.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("key"))
    n = keyed.count()
    buckets = max(1, n // rows_per_bucket)
    cuts = keyed.approxQuantile("key", [i / buckets for i in range(1, buckets)], 0.25 / buckets) if buckets > 1 else []
    bounds = np.unique(np.array(cuts, np.float64))

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return -np.searchsorted(bounds, keys.astype(np.float64), side="right")  # descending order of ids

    def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch["key"].to_numpy())), batch["key"]],
                                             names=["bucket", "key"])

    found = (keyed.select("key").mapInArrow(buckets_of, "bucket long, key long")
             .groupBy("bucket").agg(F.max("key").alias("head")).collect())
    found.sort(key=lambda r: r.bucket)
    # the head of each bucket follows the last row of the one before it
    follows = {r.head: found[i - 1].bucket for i, r in enumerate(found)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_numpy()
            own = pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(keys)), pa.array(np.zeros(len(keys), np.int32)), batch["key"], batch["id"],
                 batch["text"]], names=["bucket", "extra", "key", "id", "text"])
            yield own
            heads = [i for i, key in enumerate(keys.tolist()) if key in follows]
            if heads:
                copy = own.take(pa.array(heads, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([follows[key] for key in copy["key"].to_pylist()], pa.int64()),
                     pa.array(np.ones(len(heads), np.int32)), copy["key"], copy["id"], copy["text"]],
                    names=["bucket", "extra", "key", "id", "text"])

    placed = (keyed.mapInArrow(place, "bucket long, extra int, key long, id long, text string")
              .repartition("bucket").sortWithinPartitions("bucket", "extra", F.col("key").desc(), "text")
              .select("bucket", "extra", "id", "text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(rows: list[tuple]) -> pa.RecordBatch:
            """Of all rows but the last, which only follows."""
            n = len(rows)
            ends = [edited(a[3], b[3]) if a[0] == b[0] else "" for a, b in zip(rows, rows[1:])]
            made = winnow([r[3].encode() for r in rows] + [e.encode() for e in ends], k, window)
            out = []
            for i, end in enumerate(ends):
                bucket, extra, id_, text = rows[i]
                if extra or rows[i + 1][0] != bucket:
                    continue
                own, cut = made[i][0], made[n + i][0]
                out.append((id_, len(text), hashlib.sha256(end.encode()).hexdigest(), encode(own), encode(cut),
                            likeness(own, cut), likeness(own, made[i + 1][0])))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("bucket", "extra", "id", "text"))):
                held.append(row)
                size += len(row[3])
                if size >= 1_000_000 and len(held) > 1:
                    yield results(held)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield results(held)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out = placed.mapInArrow(compare, "id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
