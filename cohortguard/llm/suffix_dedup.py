"""Removal of long repeated byte strings by longest previous factors.

A byte goes when a string of ``length`` bytes around it also starts earlier:
in a document of smaller id, or earlier in the same document.  That is so for
all strings whose longest previous factor is at least ``length``.

The suffixes of a corpus are not sorted as one array.  Every window of
``length`` bytes has an anchor, the smallest hash (rightmost on ties) of its
k-grams; equal windows have equal anchors, so the suffixes that start at
windows with one anchor form a bucket that can be ordered by itself.  Anchors
that occur once are settled by a shuffle of hashes; only the surroundings of
the others are moved.  In a bucket, suffixes are ordered by their first
``length`` bytes (by a hash of them: a longer match removes nothing more, so
only equality counts) and by position; a suffix whose previous smaller
position in that order has the same prefix has a previous factor of at least
``length``, and its bytes go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_group, bitmap_of, discard, fresh, text_or_empty, tidy, with_mark, written
from .shingles import mix, powers, span_hashes

LENGTH = 100
KGRAM = 24
#: Anchors that occur more often are split by window instead of by anchor: a
#: task keeps up to 76 prefixes of 8 bytes for each occurrence of one anchor.
HOT_ANCHOR = 500_000
_SEGMENT = 1_000_000  # bytes of a text looked at at once
#: Bytes of texts that go together, and rows whose windows do: a worker holds
#: some ten numbers of 8 bytes for each byte, or each window, of them.
_GROUP, _ROWS = 250_000, 1000
_LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, stops: np.ndarray, length: int, k: int):
    """Anchors of all windows of texts laid end to end (``stops``: their ends).

    Returns (hash, place, first window, last window) of each run of windows
    with one anchor, in places of ``data``."""
    n, w = len(data), length - k + 1
    if n > 1 << 24:
        raise ValueError(f"places have 24 bits, but {n} bytes were given")
    empty = np.empty(0, np.int64)
    if n < length:
        return empty.astype(np.uint64), empty, empty, empty
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers("up", n), out=sums[1:])
    full = mix((sums[k:] - sums[:-k]) * powers("down", n + 1)[:n - k + 1])
    least = (full & ~_LOW) | (_LOW - np.arange(len(full), dtype=np.uint64))
    span = 1
    while span * 2 <= w:  # least[i]: of the k-grams i .. i + span - 1
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
    place = (_LOW - (least & _LOW)).astype(np.int64)
    start = np.arange(len(place))
    inside = start + length <= np.repeat(stops, np.diff(np.concatenate([[0], stops])))[:len(place)]
    start, place = start[inside], place[inside]
    if not len(start):
        return empty.astype(np.uint64), empty, empty, empty
    cut = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    at = np.flatnonzero(cut)
    last = np.append(at[1:], len(start)) - 1
    return full[place[at]], place[at], start[at], start[last]


def _segments(batches: Iterator[pa.RecordBatch], length: int):
    """Runs of texts, as (ids, start in text, bytes); long texts come in
    segments that overlap by ``length - 1``."""
    group, size, seen = [], 0, {}
    for batch in batches:
        for i, t in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
            raw = t.encode()
            if i is None or len(raw) < length:
                continue
            digest = hashlib.blake2b(raw, digest_size=16).digest()
            if seen.get(digest, i + 1) <= i:  # a later copy: it goes as a whole
                continue
            if len(seen) > 500_000:
                seen.clear()
            seen[digest] = i
            for a in range(0, max(1, len(raw) - length + 1), _SEGMENT):
                group.append((i, a, raw[a:a + _SEGMENT + length - 1]))
                size += len(group[-1][2])
                if size >= _GROUP:
                    yield group
                    group, size = [], 0
    if group:
        yield group


def _members(length: int, k: int):
    """Rows (anchor, id, spot); ``spot`` packs the anchor's place in the text
    and how far before it the first and the last window start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _segments(batches, length):
            stops = np.cumsum([len(x[2]) for x in group])
            h, place, lo, hi = anchors(np.frombuffer(b"".join(x[2] for x in group), np.uint8), stops, length, k)
            doc = np.searchsorted(stops, lo, side="right")
            shift = (np.array([x[1] for x in group]) - np.concatenate([[0], stops[:-1]]))[doc]
            spot = ((place + shift) << 14) | ((place - lo) << 7) | (place - hi)
            ids = np.array([x[0] for x in group], np.int64)[doc]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids), pa.array(spot)],
                                             names=["anchor", "id", "spot"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, id and spot: each once, without the anchors that
    occur once.  Streams."""
    last, waiting = None, None  # the last row; the same as a batch while its anchor may be alone
    for batch in batches:
        keys = [batch[c].to_numpy() for c in ("anchor", "id", "spot")]
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for k, v in enumerate(keys):
            new[1:] |= v[1:] != v[:-1]
            new[0] |= last is None or v[0] != last[k]
        if not new.all():  # a repeated row
            batch = batch.filter(pa.array(new))
            if not len(batch):
                continue
            keys = [batch[c].to_numpy() for c in ("anchor", "id", "spot")]
        t = keys[0]
        same = t[1:] == t[:-1]
        keep = np.concatenate([[last is not None and t[0] == last[0]], same])
        keep[:-1] |= same
        if waiting is not None and t[0] == last[0]:
            yield waiting
        waiting = None if keep[-1] else batch.slice(len(t) - 1, 1)
        last = tuple(v[-1] for v in keys)
        yield batch.filter(pa.array(keep))


def _surroundings(length: int):
    """Per row of (id, text, spots): the bytes that each spot's windows span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for n in range(0, len(whole), 100):
                batch = whole.slice(n, 100)
                marks = batch["marks"]
                counts = marks.value_lengths().to_numpy()
                anchor, spot = (x.to_numpy() for x in marks.flatten().flatten())
                lo, hi = (spot >> 14) - ((spot >> 7) & 127), (spot >> 14) - (spot & 127) + length
                raw = np.repeat(np.arange(len(batch)), counts).tolist()
                texts = [t.encode() for t in batch["text"].to_pylist()]
                around = [texts[i][a:b] for i, a, b in zip(raw, lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(np.repeat(batch["id"].to_numpy(), counts)), pa.array(lo),
                     pa.array(around, pa.binary())], names=["anchor", "id", "start", "bytes"])

    return run


def _windows(t: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window in row, hash of its bytes) of all windows of the rows."""
    blobs = t["bytes"].to_pylist()
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(blobs)), counts)
    j = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = (np.cumsum(sizes) - sizes)[row] + j
    return row, j, span_hashes(np.frombuffer(b"".join(blobs), np.uint8), begin, begin + length)


def _previous_factors(length: int):
    """Rows sorted by anchor, id and start: the spans of windows whose longest
    previous factor reaches ``length``.  Streams: of a bucket that goes on, only
    its distinct prefixes so far are kept."""

    def spans(t: pa.Table, before: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
        """Spans of some rows, given the prefixes that the last bucket's
        earlier rows have; and the prefixes of the last bucket so far."""
        row, j, h = _windows(t, length)
        order = np.argsort(h, kind="stable")  # suffix order; equal prefixes by position
        found = np.zeros(len(h), bool)
        found[order[1:]] = h[order[1:]] == h[order[:-1]]  # the previous smaller position has the prefix
        if len(before):
            i = np.minimum(np.searchsorted(before, h), len(before) - 1)
            found |= before[i] == h
        anchor = t["anchor"].to_numpy()
        open_ = h[anchor[row] == anchor[-1]]
        before = np.union1d(before, open_) if anchor[0] == anchor[-1] else np.unique(open_)
        row, j = row[found], j[found]
        cut = np.concatenate([[True], (row[1:] != row[:-1]) | (j[1:] != j[:-1] + 1)])[:len(row)]
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(row))[:len(first)] - 1
        start = t["start"].to_numpy()[row[first]]
        return pa.RecordBatch.from_arrays([pa.array(t["id"].to_numpy()[row[first]]), pa.array(start + j[first]),
                                           pa.array(start + j[last] + length)], names=["id", "from", "to"]), before

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = np.empty(0, np.uint64), None
        for batch in batches:
            for n in range(0, len(batch), _ROWS):
                t = pa.Table.from_batches([batch.slice(n, _ROWS)])
                if t["anchor"][0].as_py() != last:
                    before = np.empty(0, np.uint64)
                last = t["anchor"][-1].as_py()
                made, before = spans(t, before)
                yield made

    return run


def _each_window(length: int):
    """Every window of every row as a row of its own, for hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                t = pa.Table.from_batches([batch.slice(a, _ROWS)])
                row, j, h = _windows(t, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(t["id"].to_numpy()[row]),
                     pa.array(t["start"].to_numpy()[row] + j)], names=["window", "id", "start"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = KGRAM, hot: int = HOT_ANCHOR,
                   once: bool = True) -> DataFrame:
    """Spans (id, from, to) whose bytes go, of ``docs`` (id, text); spans may
    overlap.  An id has one text; rows may repeat if ``once`` is false.  Later
    exact copies in one task are left to the caller."""
    members = docs.mapInArrow(tidy(_members(length, k)), "anchor long, id long, spot long")
    dups = written(members.repartition("anchor").sortWithinPartitions("anchor", "id", "spot")
                   .mapInArrow(tidy(_repeated), "anchor long, id long, spot long"), "anchors")
    marks = dups.groupBy("id").agg(F.collect_list(F.struct("anchor", "spot")).alias("marks"))
    texts = with_mark(docs, bitmap_of(dups, "id"), "_hit", "id").where("_hit").select("id", "text")
    if not once:
        texts = texts.dropDuplicates(["id"])
    around = written(texts.join(marks, "id").mapInArrow(
        tidy(_surroundings(length)), "anchor long, id long, start long, bytes binary"), "surroundings")
    often = dups.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("anchor")
    often = written(often, "hot-anchors")
    spans = (around.join(often, "anchor", "left_anti").repartition("anchor")
             .sortWithinPartitions("anchor", "id", "start")
             .mapInArrow(tidy(_previous_factors(length)), "id long, from long, to long"))
    if not often.isEmpty():
        rows = written(around.join(often, "anchor", "left_semi")
                       .mapInArrow(tidy(_each_window(length)), "window long, id long, start long"), "windows")
        first = rows.groupBy("window").agg(F.min(F.struct("id", "start")).alias("first"),
                                           F.count(F.lit(1)).alias("n")).where("n > 1")
        later = attach_group(rows, first, "window", "n").where(F.struct("id", "start") > F.col("first"))
        spans = spans.unionByName(later.select("id", F.col("start").alias("from"),
                                               (F.col("start") + length).alias("to")))
    spans = written(spans, "spans")
    discard(dups, around)
    return spans


def _merge(spans: list) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut_rows(docs: DataFrame, id_col: str, text_col: str, length: int, characters: bool = False) -> DataFrame:
    """(id, sha, n_bytes, n_removed, n_spans, kept) for every row; ``sha`` is
    the digest of its text.  With ``characters``, what is left of a character
    of which a byte goes is not kept either."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    full = base.withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn("sha", F.sha2("text", 256))
    long = full.where((F.col("n_bytes") >= length) & F.col("id").isNotNull()).select("id", "sha")
    long = written(long, "text-digests")
    facts = long.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = attach_group(long, facts, "sha", "n").where("id > first").select("id", "sha")
    copies = written(copies.distinct(), "copies")
    ids = written(long.groupBy("id").agg(F.min("sha").alias("own"), F.max("sha").alias("other"),
                                         F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-ids")
    repeated = not ids.isEmpty()
    several = ids.where("own <> other").select("id", "own")
    searched = base
    if repeated:
        searched = full.join(several, "id", "left").where("own is null or sha = own").select("id", "text")
    spans = repeated_spans(searched, length, once=not repeated)
    by_doc = spans.groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    marked = with_mark(with_mark(full, bitmap_of(spans, "id"), "_cut", "id"), bitmap_of(copies, "id"), "_copy", "id")
    touched = (marked.where("_cut or _copy").join(by_doc, "id", "left")
               .join(copies.withColumn("whole", F.lit(True)), ["id", "sha"], "left"))
    if repeated:
        touched = touched.join(several, "id", "left").withColumn("spans", F.when(F.expr("own is null or sha = own"), F.col("spans")))
    touched = touched.select("id", "sha", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(n, 500) for b in batches for n in range(0, len(b), 500)):
            rows = []
            for i, sha, t, spans, whole in zip(*(batch[c].to_pylist() for c in ("id", "sha", "text", "spans", "whole"))):
                raw, at, kept = t.encode(), 0, []
                gone = [(0, len(raw))] if whole else [s for s in _merge(spans or []) if s[1] <= len(raw)]
                for a, b in gone:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                if characters:
                    left = left.decode("utf-8", "ignore").encode()
                rows.append((i, sha, len(raw), sum(b - a for a, b in gone), len(gone), left))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("id", "sha", "n_bytes", "n_removed", "n_spans", "kept"), r)) for r in rows],
                schema=pa.schema([("id", pa.int64()), ("sha", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                                  ("n_spans", pa.int64()), ("kept", pa.binary())]))

    zero = F.lit(0).cast("long")
    whole = marked.where("not (_cut or _copy)").select(
        "id", "sha", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return touched.mapInArrow(tidy(cut), "id long, sha string, n_bytes long, n_removed long, n_spans long, kept binary").unionByName(whole)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept`` (bytes) for every row.

    Null texts are empty.  Texts of fewer than ``length`` bytes stay whole.
    Rows with equal id and text are one document and get equal results.  Of
    rows with equal id and other texts, the text of the smallest SHA-256 is the
    document; the others offer no matches and stay whole, unless they are
    copies of a text under a smaller id.  Rows with a null id are kept whole
    and offer no matches.  ``id_col`` must be an integer column; others are
    ignored.
    """
    out = _cut_rows(docs, id_col, text_col, length)
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
                      "n_bytes", "n_removed", "n_spans", "kept")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut from the text; no row goes.

    A character of which a byte goes is dropped as a whole.  Odd rows are
    treated as :func:`cut_repeats` states; extra columns stay as they are.
    """
    # one Python operator in a task: a second one would double the executors' workers
    cut = _cut_rows(docs, id_col, text_col, length, characters=True).where("n_removed > 0").select(
        "id", "sha", F.col("kept").cast("string").alias("kept"))
    cut = written(cut.dropDuplicates(["id", "sha"]), "cut-texts")
    doc_id, sha, kept, hit = map(fresh, ("id", "sha", "kept", "hit"))
    cut = cut.select(F.col("id").alias(doc_id), F.col("sha").alias(sha), F.col("kept").alias(kept))
    rows = docs.withColumn(doc_id, F.col(id_col).cast("long"))
    marked = with_mark(rows, bitmap_of(cut, doc_id), hit, doc_id)
    changed = (marked.where(hit).withColumn(sha, F.sha2(text_or_empty(text_col), 256)).join(cut, [doc_id, sha], "left")
               .withColumn(text_col, F.coalesce(kept, text_col)).select(*docs.columns))
    return marked.where(~F.col(hit)).select(*docs.columns).unionByName(changed)
