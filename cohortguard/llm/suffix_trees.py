"""Removal of repeated word sequences by prefix-partitioned suffix trees.

A word goes when a window of ``length`` words around it also starts earlier: in
a document of smaller id, or earlier in the same document.

The generalised suffix tree of a corpus is cut into subtrees by prefix.  A
window's suffixes need not all be moved: of the ``prefix``-word grams in a
window the one with the smallest hash (rightmost on ties) names the partition,
so equal windows meet under one prefix, and about one suffix in seven is
sampled.  Prefixes are of variable length.  Those that occur once have no
internal node and end there; a prefix with up to ``group`` occurrences is a
partition that fits in memory; a more frequent one is lengthened to the whole
context of its windows, where equal ones are one leaf each and only the first
goes on, and, where still more than ``group`` contexts differ, to single
windows, whose subtree is one node, settled by a minimum.

A task joins neighbouring partitions up to a fixed size and builds their
subtrees at once: suffixes are put in order by prefix doubling on word ranks,
and runs that agree in ``length`` words are the internal nodes of that depth.
Of the leaves below such a node the first occurrence stays; the others are
covered.  Consecutive covered windows make the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_group, discard, mark_bits, marked_by, text_or_empty, written
from .shingles import _SPACE, span_hashes
from .suffix_dedup import anchors

LENGTH = 20
#: Words of the shortest prefix.
PREFIX = 8
#: Sampled suffixes under one prefix that a task takes into memory at once.
GROUP = 1 << 13
_SEGMENT = 1_000_000  # bytes of a text looked at at once
_ROWS = 2048  # contexts looked at at once, besides those of a partition that goes on
_KEY = "id long, sub long"


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts laid end to end: hash, text, first byte and end byte
    (both counted in the text)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edge = np.diff(np.concatenate([[1], _SPACE[data], [1]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    stops = np.cumsum(sizes)
    text = np.searchsorted(stops, starts, side="right")
    shift = (stops - sizes)[text]
    return span_hashes(data, starts, ends), text, starts - shift, ends - shift


def _two_hashes(h: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128 bits, in two columns, for each run of words, from their hashes."""
    raw = h.view(np.uint8)
    ahead = span_hashes(raw, begins * 8, ends * 8)
    back = span_hashes(raw[::-1], (len(h) - ends) * 8, (len(h) - begins) * 8)
    return pa.array(ahead.view(np.int64)), pa.array(back.view(np.int64))


def _segments(raw: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(first word's number, bytes) of pieces that overlap by ``length - 1``
    words; only long texts have several."""
    at, first, size = 0, 0, _SEGMENT
    while len(raw) - at > size:
        cut = at + size
        while cut < len(raw) and not _SPACE[raw[cut]]:
            cut += 1
        piece = raw[at:cut]
        _, _, begins, _ = _words([piece])
        if len(begins) <= 2 * length:  # very long words: look further
            size *= 2
            continue
        yield first, piece
        first += len(begins) - length + 1
        at += int(begins[-length + 1]) if length > 1 else len(piece)
        size = _SEGMENT
    yield first, raw[at:]


def _sampled(length: int, k: int):
    """Rows (prefix, id, sub, spot): the sampled suffixes of each text.
    ``spot`` packs the prefix's place and how far before it the first and the
    last of its windows start, in words."""

    def rows(group: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        h, text, _, _ = _words([x[3] for x in group])
        stops = np.cumsum(np.bincount(text, minlength=len(group)))
        name, place, lo, hi = anchors(h, stops, length, k)
        which = np.searchsorted(stops, lo, side="right")
        shift = (np.array([x[2] for x in group]) - np.concatenate([[0], stops[:-1]]))[which]
        spot = ((place + shift) << 14) | ((place - lo) << 7) | (place - hi)
        ids, subs = (np.array([x[j] for x in group], np.int64)[which] for j in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(ids), pa.array(subs), pa.array(spot)],
                                          names=["prefix", "id", "sub", "spot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size = [], 0
        for batch in batches:
            for i, sub, t in zip(*(batch[c].to_pylist() for c in ("id", "sub", "text"))):
                for first, piece in _segments(t.encode(), length):
                    group.append((i, sub, first, piece))
                    size += len(piece)
                    if size >= 500_000:
                        yield rows(group)
                        group, size = [], 0
        if group:
            yield rows(group)

    return run


def _contexts(length: int):
    """The words around each spot of (id, sub, text, spots): (prefix, often,
    node, again, id, sub, start, to, words), from the first to the last of its
    windows; ``node`` and ``again`` are a hash of all these words.

    Texts come in the pieces that they were sampled in, so the windows of a
    spot lie in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, int, bytes, np.ndarray]] = []  # id, sub, first word, bytes, its spots

        def rows(prefix: np.ndarray, often: np.ndarray) -> pa.RecordBatch:
            pieces = [x[3] for x in group]
            h, text, begins, ends = _words(pieces)
            base = np.searchsorted(text, np.arange(len(pieces)))
            which = np.repeat(np.arange(len(pieces)), [len(x[4]) for x in group])
            spot = np.concatenate([x[4] for x in group])
            first = np.array([x[2] for x in group])[which]
            lo = (spot >> 14) - ((spot >> 7) & 127)
            hi = (spot >> 14) - (spot & 127) + length - 1
            at = base[which] - first
            node, again = _two_hashes(h, at + lo, at + hi + 1)
            around = [pieces[i][a:b] for i, a, b in
                      zip(which.tolist(), begins[at + lo].tolist(), ends[at + hi].tolist())]
            ids, subs = (np.array([x[j] for x in group], np.int64)[which] for j in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(prefix), pa.array(often), node, again, pa.array(ids), pa.array(subs), pa.array(lo),
                 pa.array(hi + 1), pa.array(around, pa.binary())],
                names=["prefix", "often", "node", "again", "id", "sub", "start", "to", "words"])

        size, names, flags = 0, [], []
        for batch in batches:
            marks = batch["marks"]
            prefix, spot, often = (x.to_numpy(zero_copy_only=False) for x in marks.flatten().flatten())
            stops = np.cumsum(marks.value_lengths().to_numpy()).tolist()
            for i, sub, t, a, b in zip(*(batch[c].to_pylist() for c in ("id", "sub", "text")), [0, *stops], stops):
                own = spot[a:b]
                last = (own >> 14) - (own & 127) + length  # behind the last word
                todo = np.ones(b - a, bool)
                raw = t.encode()
                for first, piece in _segments(raw, length):
                    n_words = len(piece.split()) if len(raw) > _SEGMENT else len(raw)
                    mine = todo & ((own >> 14) - ((own >> 7) & 127) >= first) & (last <= first + n_words)
                    todo &= ~mine
                    if mine.any():
                        group.append((i, sub, first, piece, own[mine]))
                        names.append(prefix[a:b][mine])
                        flags.append(often[a:b][mine])
                        size += len(piece)
                    if size >= 500_000:
                        yield rows(np.concatenate(names), np.concatenate(flags))
                        group.clear()
                        size, names, flags = 0, [], []
        if group:
            yield rows(np.concatenate(names), np.concatenate(flags))

    return run


def suffix_ranks(symbols: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes of ``symbols`` by their first ``length`` symbols
    (one rank for each place where so many follow), by prefix doubling."""
    _, rank = np.unique(symbols, return_inverse=True)
    done = 1
    while done < length:
        step = min(done, length - done)
        left, right = rank[:len(rank) - step], rank[step:]
        _, rank = np.unique(left * np.int64(rank.max(initial=0) + 1) + right, return_inverse=True)
        done += step
    return rank


def _windows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the rows laid end to end; of each window the place, the
    row and the number in the row."""
    h, row, _, _ = _words(batch["words"].to_pylist())
    places = np.flatnonzero(row[:len(row) - length + 1] == row[length - 1:]) if len(row) >= length else np.empty(0, np.int64)
    return h, places, row[places], places - np.searchsorted(row, row[places])


def _covered(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Spans of the windows below a deep node, its first occurrence aside."""
    h, places, row, number = _windows(batch, length)
    node = suffix_ranks(h, length)[places]
    many = np.bincount(node)[node] > 1  # leaves of an internal node
    places, row, number, node = places[many], row[many], number[many], node[many]
    ids, subs = batch["id"].to_numpy()[row], batch["sub"].to_numpy()[row]
    start = batch["start"].to_numpy()[row] + number
    order = np.lexsort((start, subs, ids, node))
    node, ids_, subs_, start_ = node[order], ids[order], subs[order], start[order]
    new = np.concatenate([[True], node[1:] != node[:-1]])[:len(node)]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (ids_ != ids_[first]) | (subs_ != subs_[first]) | (start_ != start_[first])
    kept = np.sort(order[later])
    row, number, ids, subs, start = row[kept], number[kept], ids[kept], subs[kept], start[kept]
    cut = np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)])[:len(row)]
    begin = np.flatnonzero(cut)
    last = np.append(begin[1:], len(row))[:len(begin)] - 1
    return pa.RecordBatch.from_arrays([pa.array(ids[begin]), pa.array(subs[begin]), pa.array(start[begin]),
                                       pa.array(start[last] + length)], names=["id", "sub", "from", "to"])


def _subtrees(length: int, group: int):
    """Rows sorted by prefix: the spans that each subtree covers.  Whole
    partitions are joined until some thousand rows are in memory; no partition
    has more than ``group``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in (b.slice(n, _ROWS) for b in batches for n in range(0, len(b), _ROWS)):
            waiting.append(batch)
            held += len(batch)
            if held < min(group, _ROWS):
                continue
            whole = pa.concat_batches(waiting)
            prefix = whole["prefix"].to_numpy()
            others = np.flatnonzero(prefix != prefix[-1])  # all but the last partition, which may go on
            border = int(others[-1]) + 1 if len(others) else 0
            if border:
                yield _covered(whole.slice(0, border), length)
            waiting, held = [whole.slice(border)], len(whole) - border
        if held:
            yield _covered(pa.concat_batches(waiting), length)

    return run


def _whole_windows(length: int):
    """Every window of each row: (node, again, id, sub, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for n in range(0, len(whole), _ROWS):
                batch = whole.slice(n, _ROWS)
                h, places, row, number = _windows(batch, length)
                yield pa.RecordBatch.from_arrays(
                    [*_two_hashes(h, places, places + length), batch["id"].take(pa.array(row)),
                     batch["sub"].take(pa.array(row)), pa.array(batch["start"].to_numpy()[row] + number)],
                    names=["node", "again", "id", "sub", "start"])

    return run


# Kinds of spans.  Candidates are covered unless the same span is the first
# occurrence of its node, which is only known where a document's spans meet.
COVERED, CONTEXT, FIRST_CONTEXT, WINDOW, FIRST_WINDOW = range(5)


def _spans(rows: DataFrame, to, kind: int) -> DataFrame:
    return rows.select("id", "sub", F.col("start").alias("from"), to.alias("to"), F.lit(kind).alias("kind"))


def covered_spans(spans: list) -> list[tuple[int, int]]:
    """The spans of one document that are covered, in order."""
    first = {(s["from"], s["to"], s["kind"]) for s in spans if s["kind"] in (FIRST_CONTEXT, FIRST_WINDOW)}
    return sorted((s["from"], s["to"]) for s in spans
                  if s["kind"] == COVERED or s["kind"] in (CONTEXT, WINDOW)
                  and (s["from"], s["to"], s["kind"] + 1) not in first)


def repeated_windows(docs: DataFrame, n_docs: int, length: int = LENGTH, prefix: int = PREFIX,
                     group: int = GROUP) -> DataFrame:
    """Spans (id, sub, from, to, kind), in words, of ``docs`` (id, sub, text),
    one text for each (id, sub); they may overlap.  :func:`covered_spans` tells
    which of a document's spans earlier windows cover."""
    rows = written(docs.mapInArrow(_sampled(length, prefix), f"prefix long, {_KEY}, spot long"), "sampled-suffixes")
    counts = written(rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "prefixes")
    inner = attach_group(rows, counts, "prefix", "n").select(
        "id", "sub", F.struct("prefix", "spot", (F.col("n") > group).alias("often")).alias("mark"))
    marks = written(inner.groupBy("id", "sub").agg(F.collect_set("mark").alias("marks")), "inner-prefixes")
    discard(rows)
    texts = marked_by(docs, marks, "_hit", "id", "sub", bits=mark_bits(n_docs)).where("_hit").drop("_hit")
    around = written(texts.join(marks, ["id", "sub"]).mapInArrow(
        _contexts(length), f"prefix long, often boolean, node long, again long, {_KEY}, start long, to long, words binary"),
        "contexts")
    columns = ["prefix", "id", "sub", "start", "words"]
    rest, spans = around.where("not often").select(columns), None
    place = F.struct("id", "sub", "start")
    if not counts.where(F.col("n") > group).isEmpty():
        # a frequent prefix is lengthened to its whole context: of equal ones the
        # first goes on, and the others are covered from end to end
        whole = around.where("often")
        own = whole.groupBy("node", "again").agg(F.min(F.struct("id", "sub", "start", "prefix", "to", "words")).alias("r"))
        own = written(own.select("r.*"), "first-contexts")
        spans = _spans(whole, F.col("to"), CONTEXT).unionByName(_spans(own, F.col("to"), FIRST_CONTEXT))
        own = own.drop("to")
        crowded = written(own.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group), "crowded")
        rest = rest.unionByName(own.join(crowded, "prefix", "left_anti"))
        # prefixes with many different contexts end as windows
        windows = written(own.join(crowded, "prefix", "left_semi").mapInArrow(
            _whole_windows(length), f"node long, again long, {_KEY}, start long"), "windows")
        first = windows.groupBy("node", "again").agg(F.min(place).alias("r")).select("r.*")
        for rows, kind in ((windows, WINDOW), (first, FIRST_WINDOW)):
            spans = spans.unionByName(_spans(rows, F.col("start") + length, kind))
    found = (rest.repartition("prefix").sortWithinPartitions("prefix")
             .mapInArrow(_subtrees(length, group), f"{_KEY}, from long, to long")
             .withColumn("kind", F.lit(COVERED)))
    spans = found if spans is None else found.unionByName(spans)
    spans = written(spans, "spans")
    discard(around, marks, counts)
    return spans


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(n, 500) for b in batches for n in range(0, len(b), 500)):
            totals, removed, kept = [], [], []
            for t, spans, copy in zip(*(batch[c].to_pylist() for c in ("text", "spans", "copy"))):
                words = t.encode().split()  # bytes split at ASCII white space
                if copy and len(words) >= length:
                    spans = [{"from": 0, "to": len(words), "kind": COVERED}]
                stay, at = [], 0
                for a, b in covered_spans(spans or []):
                    stay += words[at:a]
                    at = max(at, b)
                stay += words[at:]
                totals.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])

    return run


def cut_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                       prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for every row: the words that stay,
    joined by one space.

    Words are runs without ASCII white space, compared as they are.  Null
    texts have no words; texts of fewer than ``length`` words stay whole.  Rows
    with equal id and text are one document and get equal results; rows with
    equal id and other texts are documents of their own, ordered by the texts'
    hashes.  Rows with a null id stay whole and offer no matches.  ``id_col``
    must be an integer column; other columns are ignored; without rows there
    is no result.

    A text that occurs under a smaller id has only windows that start earlier:
    it goes as a whole, and only first copies are searched.
    """
    if not 1 < prefix <= length < 128:
        raise ValueError("a prefix has 2 words at least and the window is its limit, below 128")
    kind = docs.schema[id_col].dataType
    full = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    full = full.withColumn("sha", F.unhex(F.sha2("text", 256)))
    # a text's number among those of its id: zero where the id has one text only
    seen = written(full.where("id is not null").select("id", "sha").groupBy("id", "sha").agg(F.count(F.lit(1)).alias("n")),
                   "text-digests")
    n_docs = seen.count()
    shared = written(seen.groupBy("id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("id"), "shared-ids")
    any_shared = not shared.isEmpty()
    number = F.conv(F.hex(F.substring("sha", 1, 7)), 16, 10).cast("long") + 1
    bits = mark_bits(n_docs)

    def keyed(rows: DataFrame) -> DataFrame:
        if not any_shared:
            return rows.withColumn("sub", F.lit(0).cast("long"))
        both = marked_by(rows, shared, "_hit", "id", bits=bits)
        known = both.where("_hit").join(shared.withColumn("_several", F.lit(True)), "id", "left")
        return (both.where("not _hit").withColumn("sub", F.lit(0).cast("long"))
                .unionByName(known.withColumn("sub", F.when(F.col("_several"), number).otherwise(0)).drop("_several"))
                .drop("_hit"))

    place = F.struct("id", "sub")
    owners = written(keyed(seen), "owners")  # one row for each text of an id
    first = owners.groupBy("sha").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
    first = written(first, "first-copies")
    copies = written(attach_group(owners.select("id", "sub", "sha"), first, "sha", "m")
                     .where(place > F.col("first")).select("id", "sub"), "copies")
    # a bitmap of the copies hits some others too; these are named by a second
    # one, whose own false hits are copies searched in vain
    others = written(marked_by(owners.select("id", "sub"), copies, "_copy", "id", "sub", bits=bits).where("_copy")
                     .join(copies, ["id", "sub"], "left_anti").select("id", "sub"), "no-copies")
    rows = keyed(full).select("id", "sub", "text")
    live = marked_by(marked_by(rows.where("id is not null"), copies, "_copy", "id", "sub", bits=bits),
                     others, "_stay", "id", "sub", bits=bits).where("not _copy or _stay").select("id", "sub", "text")
    again = written(owners.where(F.col("n") > 1).select("id", "sub"), "repeated-rows")
    if not again.isEmpty():  # of repeated rows one is searched
        both = marked_by(live, again, "_again", "id", "sub", bits=bits)
        live = (both.where("not _again").drop("_again")
                .unionByName(both.where("_again").drop("_again").dropDuplicates(["id", "sub"])))
    spans = repeated_windows(live, n_docs, length, prefix, group)
    span = F.struct("from", "to", "kind")
    acts = (spans.select("id", "sub", span.alias("span"), F.lit(False).alias("copy"))
            .unionByName(copies.select("id", "sub", F.lit(None).cast("struct<from:bigint,to:bigint,kind:int>").alias("span"),
                                       F.lit(True).alias("copy")))
            .groupBy("id", "sub").agg(F.collect_list("span").alias("spans"), F.max("copy").alias("copy")))
    acts = written(acts, "cuts")
    touched = marked_by(rows, acts, "_cut", "id", "sub", bits=bits)
    plain = touched.where("not _cut").select("id", "text", F.lit(None).cast(acts.schema["spans"].dataType).alias("spans"),
                                             F.lit(False).alias("copy"))
    found = touched.where("_cut").join(acts, ["id", "sub"], "left").select("id", "text", "spans",
                                                                          F.coalesce("copy", F.lit(False)).alias("copy"))
    out = plain.unionByName(found).mapInArrow(_cut(length), "id long, n_words long, n_removed long, kept string")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "kept")
