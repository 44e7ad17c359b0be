"""Mixture-controlled sequence packing.

Documents wait in one queue per source.  Every window of the output takes
tokens from all queues in the target proportions; what a queue is owed or has
overdrawn by rounding (its deficit) is carried to the next window.  The
deficits after any number of windows have a closed form, so a task can start
at any window with the deficits that all earlier ones left: windows need no
pass in order, and deficits cross partitions exactly.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_groups, shared_path, text_or_empty, tidy, written
from .merges import PieceIds, load_word_merges

#: Distinct chunks whose ids a Python worker remembers: so many that came up in
#: several batches, and as many of the last batches that did not yet.  An entry
#: takes some 200 bytes, so that is at most 120 MB a worker.
CHUNKS = 300_000
#: Characters of texts that are encoded together.
GROUP_CHARS = 4_000_000
_OWN_SPACES = re.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizer
# Fixed value: the split pattern of the word-end tokenizer; a line feed parts chunks here.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _has_word_ends(config: dict) -> bool:
    """Whether a tokenizer file is of the kind whose merges are folded here:
    lower-cased, white space dropped, split by ``_PIECES``, word-end symbols."""
    norm = config.get("normalizer") or {}
    pre = config.get("pre_tokenizer") or {}
    kinds = [x.get("type") for x in norm.get("normalizers", [])]
    splits = pre.get("pretokenizers", [{}])
    model = config["model"]
    return (kinds == ["NFC", "Replace", "Lowercase"] and model.get("end_of_word_suffix") == "</w>"
            and not model.get("dropout") and not model.get("ignore_merges")
            and splits[0].get("pattern") == {"Regex": _PIECES}
            and [x.get("type") for x in splits] == ["Split", "ByteLevel"])


class ChunkEncoder:
    """Token ids of texts, as the ``tokenizers`` library gives them.

    A tokenizer that drops white space treats every white-space separated
    chunk by itself, so each distinct chunk is encoded once and remembered:
    for word-end vocabularies by folding the merges over all new pieces at
    once, for others by the library.  ``whole=True`` has the library encode
    whole texts and fits any tokenizer.  ``chunks`` bounds what is remembered.
    """

    def __init__(self, path: str, whole: bool = False, chunks: int = CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer, self.whole, self.most = Tokenizer.from_file(path), whole, chunks
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.hot: dict[str, bytes] = {}
        self.cache: dict[str, bytes] = {}
        self.pieces = None
        if not whole and _has_word_ends(config):
            import regex
            self.pieces = PieceIds(*load_word_merges(path), self.dtype.str, 0)
            self.split = regex.compile(_PIECES + r"|\n").findall
            # chunks the library encodes: those with special tokens, or letters
            # whose lower case depends on the place in a word
            marks = [re.escape(t["content"]) for t in config.get("added_tokens", [])]
            self.odd = re.compile("|".join([*marks, "\u03a3"])).search

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _library(self, chunks: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        self.cache.update(zip(chunks, (self._pack(e.ids) for e in found)))

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of ``chunks`` into the cache; all are normalised and,
        but for the odd ones, in lower case."""
        if self.pieces is None:
            return self._library(chunks)
        if self.odd("\n".join(chunks)):
            self._library([c for c in chunks if self.odd(c)])
            chunks = [c for c in chunks if not self.odd(c)]
        # a chunk of letters is one piece; others are split, and pieces that are
        # chunks of their own elsewhere need no second fold
        plain, mixed = [], []
        for c in chunks:
            (plain if c.isalpha() else mixed).append(c)
        split = self.split("\n".join([*mixed, ""]))
        parts = set(split) - {"\n"}
        known = {p: ids for p in parts if (ids := self.hot.get(p) or self.cache.get(p)) is not None}
        folded = self.pieces.learn(parts.difference(known).union(plain))
        self.cache.update((c, folded[c]) for c in plain)
        known.update((p, folded[p]) for p in parts.difference(known))
        folded.clear()
        known["\n"] = b"\xff" * self.dtype.itemsize  # no id: marks the chunks' ends
        packed = b"".join(map(known.__getitem__, split))
        ends = np.flatnonzero(np.frombuffer(packed, self.dtype) == np.iinfo(self.dtype).max) * self.dtype.itemsize
        starts = np.concatenate([[0], ends[:-1] + self.dtype.itemsize]).tolist() if len(ends) else []
        self.cache.update(zip(mixed, (packed[a:b] for a, b in zip(starts, ends.tolist()))))

    def _chunks(self, text: str) -> list[str] | None:
        """The text's chunks, normalised and then in lower case, as the library
        does; None for texts it must encode as a whole: those with white space
        of Python's own, or special tokens next to marks that would join them."""
        if self.whole or _OWN_SPACES.search(text):
            return None
        if self.pieces is None:  # the library normalises
            return text.split()
        special = "<" in text  # special tokens are matched before normalising
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            if special:
                return None
            text = unicodedata.normalize("NFC", text)
        if special or "\u03a3" in text:
            return [c if self.odd(c) else c.lower() for c in text.split()]
        return text.lower().split()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens, as packed integers."""
        out: list = [None] * len(texts)
        if len(self.hot) > self.most:
            self.hot.clear()
        if len(self.cache) > self.most:
            self.cache.clear()
        hot, cache, open_, once = self.hot, self.cache, [], set()
        for i, text in enumerate(texts):
            chunks = self._chunks(text)
            if chunks is None:
                out[i] = self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
                continue
            found = list(map(hot.get, chunks))
            if None in found:  # filled in when all new chunks are known
                missing = [j for j, ids in enumerate(found) if ids is None]
                rare = [chunks[j] for j in missing]
                once.update(rare)
                open_.append((i, found, missing, rare))
            else:
                out[i] = b"".join(found)
        again = once.intersection(cache)  # of an earlier batch
        new = list(once - again)
        if new:
            self._learn(new)
        for i, found, missing, rare in open_:
            for j, chunk in zip(missing, rare):
                found[j] = cache[chunk]
            out[i] = b"".join(found)
        hot.update((chunk, cache.pop(chunk)) for chunk in again)
        return out


_ENCODERS: dict[tuple[str, bool, int], ChunkEncoder] = {}


def _encoder(path: str, whole: bool, chunks: int) -> ChunkEncoder:
    """The worker's encoder, kept from task to task."""
    if (path, whole, chunks) not in _ENCODERS:
        _ENCODERS[path, whole, chunks] = ChunkEncoder(path, whole, chunks)
    return _ENCODERS[path, whole, chunks]


def _forget(path: str, whole: bool, chunks: int) -> None:
    _ENCODERS.pop((path, whole, chunks), None)


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int | None, id_col: str, text_col: str,
              queue_col: str, whole: bool = False, chunks: int = CHUNKS, group_chars: int = GROUP_CHARS,
              keep: bool = True) -> DataFrame:
    """Write ``docs`` as token ids with each document's place in its queue.

    A task numbers the tokens of every source it meets; ``part`` orders tasks.
    """
    schema = docs.select(F.col(id_col).alias("id")).schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, whole, chunks)
        end = b"" if end_id is None else encoder._pack([end_id])
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            queues = batch["queue"].to_pylist()
            ids, starts, counts = [], [], []
            for packed, queue in zip(in_groups(encoder.encode_batch, batch["text"].to_pylist(), group_chars), queues):
                packed += end
                n = len(packed) // encoder.dtype.itemsize
                at = seen.get(queue, 0)
                seen[queue] = at + n
                ids.append(packed)
                starts.append(at)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["queue"], pa.array([part] * len(ids), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([encoder.dtype.itemsize] * len(ids), pa.int32())],
                names=["id", "queue", "part", "start", "n", "ids", "width"])
        if not keep:
            del encoder
            _forget(tokenizer_path, whole, chunks)

    queue = F.concat(F.when(F.col(queue_col).isNull(), F.lit("null")).otherwise(F.lit("=")),
                     F.coalesce(F.col(queue_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), queue.alias("queue"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(tidy(run), f"id {schema.simpleString()}, queue string, part int, start long, n long, "
                               "ids binary, width int")
    path = shared_path(docs.sparkSession, "tokens")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


@dataclass(frozen=True)
class Share:
    """A queue's part of one phase of the output.

    In the phase's ``length`` tokens, which begin at ``begin`` of the output,
    the queue gives its tokens ``first`` .. ``first + high - low``.  ``low`` and
    ``high`` are the tokens that the queues before it, and these and itself,
    give in the phase.
    """
    begin: int
    length: int
    first: int
    low: int
    high: int

    def taken(self, n: int) -> int:
        """Tokens taken from this queue in the first ``n`` of the phase: what
        it is owed, less a deficit below one token."""
        return n * self.high // self.length - n * self.low // self.length


def plan_shares(totals: dict[str, int], mix: dict[str, float] | None = None) -> dict[str, list[Share]]:
    """Split the output into phases with fixed proportions.

    While all queues of the mix have tokens, windows follow the mix; when one
    runs dry, the others share its part in proportion.  Without a mix the
    proportions are the queues' sizes and there is a single phase.  Queues
    outside the mix follow when those in it are dry.
    """
    shares: dict[str, list[Share]] = {q: [] for q in totals}
    rest, begin = {q: n for q, n in totals.items() if n}, 0
    while rest:
        weights = {q: Fraction(mix[q]) for q in rest if mix and mix.get(q)} or {q: Fraction(n) for q, n in rest.items()}
        time = min(rest[q] / w for q, w in weights.items())
        give = {q: int(w * time) for q, w in sorted(weights.items())}
        length, low = sum(give.values()), 0
        for q, n in give.items():
            shares[q].append(Share(begin, length, totals[q] - rest[q], low, low + n))
            low += n
        begin += length
        rest = {q: n - give.get(q, 0) for q, n in rest.items() if n > give.get(q, 0)}
    return shares


def pieces(shares: list[Share], start: int, n: int, window: int) -> Iterator[tuple[int, int, int, int]]:
    """Cut ``n`` tokens at ``start`` of a queue into (from, length, sequence, offset)."""
    x, end = start, start + n
    for s in shares:
        size = s.high - s.low
        if x >= end:
            return
        if not size or x >= s.first + size:
            continue
        y = x - s.first  # place in this phase
        seq = (s.begin + y * s.length // size) // window
        bound = lambda w: min(max(w * window - s.begin, 0), s.length)  # noqa: E731, B023
        while seq > s.begin // window and s.taken(bound(seq)) > y:
            seq -= 1
        while s.taken(bound(seq + 1)) <= y:
            seq += 1
        a = bound(seq)
        have, low = s.taken(a), a * s.low // s.length
        while x < end and y < size:
            b = bound(seq + 1)
            low_b = b * s.low // s.length
            upto = b * s.high // s.length - low_b
            if upto > y:
                k = min(end - x, upto - y)
                yield x - start, k, seq, s.begin + a - seq * window + low_b - low + y - have
                x, y = x + k, y + k
            if y >= upto:
                seq, a, have, low = seq + 1, b, upto, low_b


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, *, end_id: int | None = 2,
         mix: dict[str | None, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", whole_texts: bool = False, with_ids: bool = False,
         chunks: int = CHUNKS, group_chars: int = GROUP_CHARS,
         keep: bool = True) -> DataFrame:
    """Pack every document into sequences of ``window`` tokens.

    ``mix`` maps sources to target proportions; by default they are the
    sources' shares of all tokens, so that every window is a small copy of the
    corpus.  All windows but the last are full.  Sources below two tokens per
    window wait in one common queue, so at most ``window / 2`` queue totals
    reach the driver and the tasks.

    Documents are tokenised once, into a table in the shared folder; only
    per-task token counts are grouped.  Returns one row per piece:
    ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    with ``with_ids``, ``ids`` (unsigned 32-bit little-endian).

    ``chunks`` and ``group_chars`` bound a worker's memory (see ``CHUNKS`` and
    ``GROUP_CHARS``): smaller ones cost time and change no result.  Without ``keep``
    a worker gives its tokenizer back after each task, as jobs want that do more
    than packing.

    A null text is an empty one and still gives its ``end_id``; a null source
    is a source of its own; repeated rows are packed once each; without rows
    the result is empty.
    """
    tokens = tokenized(docs, tokenizer_path, end_id, id_col, text_col, source_col, whole_texts, chunks, group_chars,
                       keep)
    parts = written(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")), "queue-parts")
    sums = parts.groupBy("queue").agg(F.sum("n").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    key = lambda s: "null" if s is None else f"={s}"
    named = {key(s): p for s, p in (mix or {}).items()}
    if any(p * window < 2 * sum(named.values()) for p in named.values()):
        raise ValueError("a proportion is below two tokens per window")
    large = {r.queue: r.n for r in sums.where(F.col("queue").isin(*named) if named else
                                              F.col("n") * window >= 2 * total).collect()}
    totals, common = dict(large), total - sum(large.values())
    if common and not named and totals and common * window < 2 * total:  # too small for a queue of its own
        common += totals.pop(min(totals, key=lambda q: (totals[q], q)))
    totals[""] = common
    shares = plan_shares(totals, named or None)
    own = [q for q in totals if q]
    line = F.when(F.col("queue").isin(own), F.col("queue")).otherwise("") if own else F.lit("")
    before = (Window.partitionBy("line").orderBy("part", "queue")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = (parts.withColumn("line", line)
               .select("queue", "part", "line", (F.sum("n").over(before) - F.col("n")).alias("base")))
    # a table of known size: broadcast only while Spark finds it small enough
    offsets = written(offsets, "queue-offsets")
    placed = tokens.join(offsets, ["queue", "part"]).select(
        "id", "line", (F.col("base") + F.col("start")).alias("start"), "n", "ids", "width")
    id_type = placed.schema["id"].dataType.simpleString()
    fields = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cols, blobs = [], [], []
            for i, (queue, start, n, ids, width) in enumerate(zip(*(batch[c].to_pylist() for c in
                                                                   ("line", "start", "n", "ids", "width")))):
                wide = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                for at, k, seq, offset in pieces(shares[queue], start, n, window):
                    blob = wide[4 * at:4 * (at + k)]
                    rows.append(i)
                    cols.append((at, k, zlib.crc32(blob), n, seq, offset))
                    if with_ids:
                        blobs.append(blob)
            arrays = [pa.array(c, pa.int64()) for c in (zip(*cols) if cols else [[]] * 6)]
            made = [batch["id"].take(pa.array(rows, pa.int64())), *arrays] + ([pa.array(blobs, pa.binary())] * with_ids)
            yield pa.RecordBatch.from_arrays(made, names=fields + ["ids"] * with_ids)

    schema = f"id {id_type}, " + ", ".join(f"{f} long" for f in fields[1:]) + ", ids binary" * with_ids
    return placed.mapInArrow(tidy(cut), schema).withColumnRenamed("id", id_col)
