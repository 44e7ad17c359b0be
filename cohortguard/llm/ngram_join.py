"""Exact Jaccard self-join of documents on word n-grams.

Two documents link when the Jaccard similarity of their sets of distinct
five-word shingles reaches the threshold.  The result is the graph's
connected components.

1. Equal sets form classes at once, by a digest of the set.
2. Prefix filter: a document posts its lightest shingles, as many as any
   linked document must share one of.  Shingles that many documents hold count
   as heavy and come last in the order, so common passages are not posted
   while a document has enough others.  Any heavy list is correct.
3. In a few rounds every document tries its likeliest partner, first the
   smallest member of most of its posting lists, then the one that is in most
   lists.  Verified links join components, and lists within one component are
   done.  This settles most groups of near copies in linear work.
4. What is left are lists that still meet in different components.  They are
   cut into size-banded tiles: a document can only link within its band of
   sizes and the next.  In a tile, hashed bitmap signatures bound the overlap
   of every pair of different components from above; surviving pairs are
   verified.
5. Verification intersects the sorted shingle arrays exactly.  Compressed texts
   move for it, and tasks make the arrays from them: an array of hashes takes
   more room than its text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach_group, bitmap_of, discard, text_or_empty, tidy, with_mark, written
from .components import connected_components
from .shingles import shingle_sets

#: Shingles that may count as heavy: the most frequent ones, at most this many.
HEAVY_LIMIT = 100_000
#: Documents that a shingle must occur in to count as heavy.
HEAVY_DOCS = 64
#: Lists of at most this many documents give their pairs as they are.
SHORT_LIST = 32
#: Documents compared with each other in one tile.
TILE_DOCS = 1024
#: Long lists, the first by token, that a tile's row names of its node: a pair is
#: given by the first list that both name.
NAMED_LISTS = 8
#: Least bits of a signature; larger sets have at least two bits a shingle.  Bits
#: shared by chance loosen the bound of small sets most, and theirs cost least.
SIGNATURE_BITS = 1024
#: Rounds in which each document tries its likeliest partner; tiles do the rest.
ROUNDS = 1


def _groups(batches: Iterator[pa.RecordBatch], size: int = 400_000):
    """(ids, texts as bytes) in runs of about ``size`` bytes."""
    ids, texts, total = [], [], 0
    for batch in batches:
        for i, t in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
            ids.append(i)
            texts.append(t.encode())
            total += len(t)
            if total >= size:
                yield ids, texts
                ids, texts, total = [], [], 0
    if ids:
        yield ids, texts


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _added(tokens: np.ndarray, counts: np.ndarray, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The counts with those of the tokens that occur more than once in ``held``."""
    token, count = np.unique(np.concatenate(held), return_counts=True)
    known = np.zeros(len(token), bool)
    if len(tokens):
        known = tokens[np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)] == token
    keep = known | (count >= 2)
    both, n = np.concatenate([tokens, token[keep]]), np.concatenate([counts, count[keep]])
    token, place = np.unique(both, return_inverse=True)
    return token, np.bincount(place, n, len(token)).astype(np.int64)


def _survey(k: int, buffer: int = 1_000_000):
    """Per document its set's size and digest; per task the shingles that
    occur in several of its documents, with how many (of ``buffer`` shingles
    at a time, those that occur once are forgotten)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n_held = set(), [], 0
        tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def often() -> pa.RecordBatch:
            token, count = tokens[counts >= 3], counts[counts >= 3]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(token), pa.int64()), pa.array(count), pa.nulls(len(token), pa.binary()),
                 pa.array(token.view(np.int64))], names=["id", "n", "digest", "token"])

        for ids, texts in _groups(batches):
            hashes, at = shingle_sets(texts, k)
            digests = [_digest(hashes[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.diff(at)), pa.array(digests, pa.binary()),
                 pa.nulls(len(ids), pa.int64())], names=["id", "n", "digest", "token"])
            new = np.zeros(len(ids), bool)
            for i, d in enumerate(digests):
                new[i] = d not in seen
                seen.add(d)
            if len(seen) > 500_000:
                seen.clear()
            held.append(hashes[np.repeat(new, np.diff(at))])
            n_held += len(held[-1])
            if n_held >= buffer:
                tokens, counts = _added(tokens, counts, held)
                held, n_held = [], 0
                if len(tokens) >= buffer:
                    yield often()
                    tokens, counts = tokens[:0], counts[:0]
        if held:
            tokens, counts = _added(tokens, counts, held)
        if len(tokens):
            yield often()

    return run


def _postings(k: int, percent: int, heavy: np.ndarray, weight: np.ndarray):
    """The prefix of every set, lightest shingles first; a set that the task
    has posted already is left out (it is of the same class)."""
    low = np.uint64((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)
    maybe[(heavy & low).astype(np.int64)] = True

    def ranks(hashes: np.ndarray) -> np.ndarray:
        """Weight of each shingle, 0 if it is not heavy."""
        rank = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(maybe[(hashes & low).astype(np.int64)])
        if len(at):
            i = np.minimum(np.searchsorted(heavy, hashes[at]), len(heavy) - 1)
            rank[at] = np.where(heavy[i] == hashes[at], weight[i], 0)
        return rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for ids, texts in _groups(batches):
            hashes, at = shingle_sets(texts, k)
            sizes = np.diff(at)
            new = np.zeros(len(ids), bool)
            for i, (a, b) in enumerate(zip(at, at[1:])):
                if b > a and ids[i] is not None:  # other rows post nothing, so they stand for none
                    d = _digest(hashes[a:b])
                    new[i] = d not in seen
                    seen.add(d)
            if len(seen) > 500_000:
                seen.clear()
            rank = ranks(hashes)
            weighty = np.zeros(len(ids), bool)
            weighty[np.unique(np.searchsorted(at, np.flatnonzero(rank), side="right") - 1)] = True
            # any linked set shares at least ceil(threshold * size) shingles
            prefix = sizes - -(-sizes * percent // 100) + 1
            take = [np.empty(0, np.int64)]
            for i in np.flatnonzero(new):
                a, b = at[i], at[i + 1]
                take.append(a + np.argsort(rank[a:b], kind="stable")[:prefix[i]] if weighty[i]
                            else np.arange(a, a + prefix[i]))
            take = np.concatenate(take)
            doc = np.repeat(np.arange(len(ids)), np.where(new, prefix, 0))
            node = np.array([0 if i is None else i for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[take].view(np.int64)), pa.array(sizes[doc].astype(np.int32)),
                 pa.array(node[doc])], names=["token", "size", "node"])

    return run


def _shared_lists(percent: int):
    """Rows sorted by token and size: keep those that some other row of their
    list may link with by size (its neighbours are the likeliest), and name
    the list's first node and its size.

    Streams: what is remembered is the last row."""
    kinds = (np.int64, np.int32, np.int64, np.int64, np.int32)

    def made(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, k)) for x, k in zip(rows, kinds)],
                                          names=["token", "size", "node", "pivot", "pivot_size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, False  # the last row with its list's first node; whether it stays
        for batch in batches:
            t, s, n = (batch[c].to_numpy() for c in ("token", "size", "node"))
            if not len(t):
                continue
            if last is not None:
                t, s, n = (np.append(w, x) for w, x in zip(last, (t, s, n)))
            same = t[1:] == t[:-1]
            start = np.concatenate([[last is None], ~same])
            at, run_ = np.flatnonzero(start), np.cumsum(start)
            pivot = np.append(last[3] if last else 0, n[at])[run_]
            pivot_size = np.append(last[4] if last else 0, s[at])[run_]
            near = same & (s[:-1].astype(np.int64) * 100 >= s[1:].astype(np.int64) * percent)
            keep = np.append(kept, near) | np.append(near, False)
            last, kept = tuple(x[-1] for x in (t, s, n, pivot, pivot_size)), bool(keep[-1])
            keep[-1] = False
            yield made([x[keep] for x in (t, s, n, pivot, pivot_size)])
        if kept:
            yield made([[x] for x in last])

    return run


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, text) of the documents named in ``nodes``, and rarely of others."""
    return with_mark(docs.where("id is not null"), bitmap_of(nodes, "node"), "wanted", "id").where("wanted").select(
        "id", "text")


def _signatures_of(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Signatures of the nodes' documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _groups(batches):
            hashes, at = shingle_sets(texts, k)
            signs = [_signature(hashes[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(signs, pa.binary())],
                                             names=["node", "signature"])

    return _texts_of(docs, nodes).mapInArrow(tidy(run), "node long, signature binary")


def _packed_of(docs: DataFrame, nodes: DataFrame, node: str, name: str) -> DataFrame:
    """The nodes' texts, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for ids, texts in _groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(pack, texts), pa.binary())],
                                             names=[node, name])

    return _texts_of(docs, nodes).mapInArrow(tidy(run), f"{node} long, {name} binary")


def _signature(hashes: np.ndarray) -> bytes:
    """A bitmap of the set; its width, a power of two, follows the set's size."""
    width = max(SIGNATURE_BITS, 1 << (2 * len(hashes) - 1).bit_length()) if len(hashes) else SIGNATURE_BITS
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(sign: bytes, words: int) -> np.ndarray:
    """The bitmap that the set would have with a smaller width."""
    x = np.frombuffer(sign, np.uint64)
    return np.bitwise_or.reduce(x.reshape(-1, words), axis=0)


def _most_shared(signs: list[bytes], sizes: np.ndarray, x: np.ndarray, y: np.ndarray, fold: int = 1) -> np.ndarray:
    """Upper bound of the overlap of pairs (x, y) from their bitmaps.

    Shingles that one set has alone are at least the bits it has alone, at the
    smaller of the two widths.  Bitmaps ``fold`` times narrower are quicker to
    compare and bound less tightly."""
    words = np.fromiter((len(s) // 8 // fold for s in signs), np.int64, len(signs))
    least, most = np.minimum(words[x], words[y]), np.zeros(len(x), np.int64)
    for w in np.unique(least):
        at = np.flatnonzero(least == w)
        for lo in range(0, len(at), max(1, (1 << 20) // int(w))):
            k = at[lo:lo + max(1, (1 << 20) // int(w))]
            have, place = np.unique(np.concatenate([x[k], y[k]]), return_inverse=True)
            bits = np.stack([_folded(signs[i], int(w)) for i in have])
            ones = np.bitwise_count(bits).sum(1, dtype=np.int64)
            i, j = place[:len(k)], place[len(k):]
            common = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64)
            most[k] = np.minimum(sizes[x[k]] - (ones[i] - common), sizes[y[k]] - (ones[j] - common))
    return most


def _may_link(signs: list[bytes], sizes: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures leave the pairs (x, y) possible; narrow ones first."""
    may = np.ones(len(x), bool)
    for fold in (4, 1):
        at = np.flatnonzero(may)
        may[at] = _most_shared(signs, sizes, x[at], y[at], fold) >= _needed(sizes[x[at]], sizes[y[at]], percent)
    return may


def _needed(x, y, percent: int):
    """Shared shingles that sets of sizes ``x`` and ``y`` need: 100·i ≥ p·(x+y−i)."""
    return -(-(percent * (x + y)) // (100 + percent))


def _linked(k: int, percent: int, bytes_at_once: int = 200_000):
    """Rows (a, b, ..., x, y) whose texts' sets link; rows of one ``a`` that
    follow each other share its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            if not len(batch):
                continue
            size = np.cumsum(pc.binary_length(batch["y"]).to_numpy()) // bytes_at_once
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(batch)]
            for lo, hi in zip(cuts, cuts[1:]):
                rows = batch.slice(lo, hi - lo)
                a = rows["a"].to_numpy()
                x = rows["x"]
                new = np.array([i == 0 or a[i] != a[i - 1] or x[i] != x[i - 1] for i in range(len(a))], bool)
                firsts = x.filter(pa.array(new)).to_pylist()
                hashes, at = shingle_sets([unpack(t) for t in firsts + rows["y"].to_pylist()], k)
                sets = [hashes[i:j] for i, j in zip(at, at[1:])]
                keep = []
                for i, left in enumerate(np.cumsum(new) - 1):
                    u, v = sets[left], sets[len(firsts) + i]
                    common = len(np.intersect1d(u, v, assume_unique=True))
                    keep.append(common * 100 >= (len(u) + len(v) - common) * percent)
                names = [c for c in rows.schema.names if c not in ("x", "y")]
                yield rows.select(names).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b, ...) whose sorted arrays intersect in enough shingles."""
    left = _packed_of(docs, pairs.select(F.col("a").alias("node")), "a", "x")
    right = _packed_of(docs, pairs.select(F.col("b").alias("node")), "b", "y")
    both = pairs.join(right, "b").join(left, "a").select(*pairs.columns, "x", "y")
    return both.mapInArrow(tidy(_linked(k, percent)), pairs.schema)


def _labels(links: DataFrame) -> DataFrame:
    """(node, label, n): the smallest node within two links of each.

    Nodes with one label are connected; a star of links gets one label."""
    arcs = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = arcs.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n")).select(
        "b", F.least("m", "b").alias("m"), "n")
    return (attach_group(arcs, near, "b", "n").groupBy(F.col("a").alias("node"))
            .agg(F.min("m").alias("label"), F.count(F.lit(1)).alias("n"))
            .select("node", F.least("label", "node").alias("label"), "n"))


def _one_of_each(lists: DataFrame, copies: DataFrame) -> DataFrame:
    """Lists (token, size, node, comp) with the first node ``a`` of equal sets
    in place of every ``b`` of ``copies``: each task posts a set of its own, and
    pairs of equal sets' nodes would grow with the square of the copies."""
    own = lists.join(copies.select(F.col("b").alias("node"), "a"), "node", "left").withColumn(
        "node", F.coalesce("a", "node")).drop("a")
    # no token is null; said here, both uses of the lists have one exchange
    return (own.where("token is not null").repartition("token").groupBy("token", "node")
            .agg(F.min("size").alias("size"), F.min("comp").alias("comp")))


def _open(lists: DataFrame) -> DataFrame:
    """Lists (token, size, node, comp) that meet in several components.

    Lists of the same nodes offer the same pairs: one of them is kept."""
    kept = (lists.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.min(F.struct("size", "node")).alias("first"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.xxhash64("node", F.lit(1)) % (1 << 31)).alias("y"))
        .where("lo < hi").groupBy("n", "x", "y", "first").agg(F.min("token").alias("token"))
        .select("token", F.col("first.node").alias("pivot"), F.col("n").alias("members")))
    return lists.select("token", "size", "node", "comp").join(kept, "token")


def _likeliest(lists: DataFrame, tried: DataFrame | None, percent: int) -> DataFrame:
    """Each node's likeliest partner in another component: the centre (node of
    most lists) of most of its lists, if their sizes allow a link."""
    degree = lists.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    rows = lists.join(degree, "node")
    centre = rows.groupBy("token").agg(F.max(F.struct("degree", -F.col("node"), "size", "comp")).alias("c"))
    pairs = (rows.join(centre, "token")
             .where((F.col("comp") != F.col("c.comp"))
                    & (F.least("size", "c.size") * 100 >= F.greatest("size", "c.size") * percent))
             .groupBy("node", (-F.col("c.col2")).alias("centre"))
             .agg(F.count(F.lit(1)).alias("n"), F.first("comp").alias("comp"), F.first("c.comp").alias("centre_comp")))
    if tried is not None:
        pairs = pairs.join(tried.select(F.col("a").alias("centre"), F.col("b").alias("node")),
                           ["centre", "node"], "left_anti")
    best = pairs.groupBy("node").agg(F.max(F.struct("n", -F.col("centre"), "comp", "centre_comp")).alias("p"))
    return best.select((-F.col("p.col2")).alias("a"), F.col("node").alias("b"),
                       F.col("p.centre_comp").alias("comp_a"), F.col("p.comp").alias("comp_b"))


def _first_lists(pairs: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, each with the first of its lists."""
    order = np.lexsort((lists, pairs))
    pairs, lists = pairs[order], lists[order]
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    return pairs[new], lists[new]


def _rows_of(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of at most ``width`` longs as rows of a matrix, filled up with the
    largest long."""
    flat = lists.combine_chunks()
    n = pc.list_value_length(flat).to_numpy()
    out = np.full((len(flat), width), np.iinfo(np.int64).max)
    out[np.arange(width) < n[:, None]] = flat.flatten().to_numpy()
    return out


def _meet_before(u: np.ndarray, v: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Whether rows of ``u`` and ``v`` have a common entry less than ``lists``."""
    met = np.zeros(len(lists), bool)
    for c in range(u.shape[1]):
        met |= (u[:, c] < lists) & (u[:, c, None] == v).any(1)
    return met


def _tiles(percent: int, signed: bool, rows_at_once: int = 20_000, bytes_at_once: int = 16_000_000,
           pairs_at_once: int = 200_000):
    """Pairs of nodes in one tile that sizes, components and (if ``signed``)
    signatures leave possible.

    Rows are sorted by tile and side.  A tile that meets itself (``own``) has
    side 0 only and pairs its rows with the later ones; others pair side 0 with
    side 1.  Many small tiles are worked off together, and a pair that several
    of them hold is looked at once.  A signed pair that also meets in an earlier
    one of its ``named`` lists is left to that list."""

    def possible(t: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, size, comp, node, side, own = (t[c].to_numpy() for c in
                                             ("tile", "size", "comp", "node", "side", "own"))
        nodes, first, which = np.unique(node, return_index=True, return_inverse=True)
        size, n = size.astype(np.int64), len(nodes)
        signs, sizes = t["signature"].take(pa.array(first)).to_pylist() if signed else [], size[first]
        at = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        stop = np.repeat(np.append(at[1:], len(t)), np.diff(np.append(at, len(t))))
        ones_side = np.repeat(np.append(at, len(t))[:-1] + np.add.reduceat(side == 0, at),
                              np.diff(np.append(at, len(t))))
        begin = np.where(own == 1, np.arange(len(t)) + 1, ones_side)
        count = np.where(side == 0, stop - begin, 0)
        done, keys, lists = np.cumsum(count), np.empty(0, np.int64), np.empty(0, np.int64)
        token = t["token"].to_numpy() if signed else tile
        named = _rows_of(t["named"].take(pa.array(first)), NAMED_LISTS) if signed else None
        for lo in range(0, int(done[-1]), pairs_at_once):
            k = np.arange(lo, min(lo + pairs_at_once, int(done[-1])))
            i = np.searchsorted(done, k, side="right")
            j = begin[i] + k - (done[i] - count[i])
            need = _needed(size[i], size[j], percent)
            keep = (need <= np.minimum(size[i], size[j])) & (comp[i] != comp[j])
            x, y = which[i[keep]], which[j[keep]]
            keys, lists = _first_lists(np.append(keys, np.minimum(x, y) * n + np.maximum(x, y)),
                                       np.append(lists, token[i[keep]]))
        for lo in range(0, len(keys), pairs_at_once // 4):
            x, y = np.divmod(keys[lo:lo + pairs_at_once // 4], n)
            keep = _may_link(signs, sizes, x, y, percent) if signed else np.ones(len(x), bool)
            if signed:
                at = np.flatnonzero(keep)
                keep[at] = ~_meet_before(named[x[at]], named[y[at]], lists[lo:lo + pairs_at_once // 4][at])
            yield pa.RecordBatch.from_arrays([pa.array(nodes[x[keep]]), pa.array(nodes[y[keep]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in (whole.slice(at, 2000) for whole in batches for at in range(0, len(whole), 2000)):
            tile = batch["tile"].to_numpy()
            if held and (rows >= rows_at_once or size >= bytes_at_once):  # end at a tile's end
                last = held[-1]["tile"][-1].as_py()
                upto = int(np.argmax(tile != last)) if (tile != last).any() else len(tile)
                held.append(batch.slice(0, upto))
                if upto < len(tile):
                    yield from possible(pa.Table.from_batches(held))
                    held, rows, size = [], 0, 0
                batch = batch.slice(upto)
            if len(batch):
                held.append(batch)
                rows, size = rows + len(batch), size + batch.nbytes
        if held:
            yield from possible(pa.Table.from_batches(held))

    return run


def _possible(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their signatures leave possible."""
    both = (pairs.join(signs.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("signature").alias("y")), "b")
            .join(signs.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("signature").alias("x")), "a")
            .select("a", "b", "nx", "ny", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                t = whole.slice(at, 2000)
                n = len(t)
                sizes = np.concatenate([t["nx"].to_numpy(), t["ny"].to_numpy()])
                i = np.arange(n)
                may = _may_link(t["x"].to_pylist() + t["y"].to_pylist(), sizes, i, n + i, percent)
                yield t.select(["a", "b"]).filter(pa.array(may))

    return both.mapInArrow(tidy(run), "a long, b long")


def _remaining_pairs(lists: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in different components that share a list and that
    sizes and signatures leave possible.

    A pair of near copies shares many short lists, so their pairs are made
    distinct before signatures are moved; long lists are cut into tiles."""
    short = lists.where(F.col("members") <= SHORT_LIST).select(
        F.col("token").alias("tile"), F.hash("pivot").alias("place"), F.lit(0).alias("side"), F.lit(1).alias("own"),
        "size", "node", "comp")
    plain = (short.repartition("place").sortWithinPartitions("place", "tile", "size")
             .mapInArrow(tidy(_tiles(percent, signed=False)), "a long, b long").distinct())
    tiled = _tile_pairs(lists.where(F.col("members") > SHORT_LIST), signs, percent)
    return _possible(written(plain, "plain-pairs"), signs, percent).unionByName(tiled).distinct()


def _tile_pairs(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of long lists, from size-banded tiles with signatures."""
    # bands of sizes: linked sets lie in the same band or in neighbouring ones
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent)).cast("int")
    banded = left.withColumn("band", band)
    blocks = (banded.groupBy("token", "band").agg(F.count(F.lit(1)).alias("n"))
              .select("token", "band", F.ceil(F.col("n") / TILE_DOCS).cast("int").alias("blocks")))
    rows = (banded.join(blocks, ["token", "band"])
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    above = blocks.select("token", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("token", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    rows = rows.join(above, ["token", "band"], "left").join(below, ["token", "band"], "left")

    def tile(low_band: Column, low: Column, high_band: Column, high: Column, side: Column) -> Column:
        return F.struct(F.xxhash64("token", low_band, low, high_band, high).alias("tile"),
                        F.hash("pivot", low_band, low, high_band, high).alias("place"), side.alias("side"),
                        ((low_band == high_band) & (low == high)).cast("int").alias("own"))

    b, zero = F.col("band"), F.lit(0)
    every = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda j: tile(
        b, F.least("block", j), b, F.greatest("block", j), (F.col("block") > j).cast("int")))
    upper = F.when(F.col("above").isNotNull(), F.transform(
        F.sequence(zero, F.col("above") - 1), lambda j: tile(b, F.col("block"), b + 1, j, zero)))
    lower = F.when(F.col("below").isNotNull(), F.transform(
        F.sequence(zero, F.col("below") - 1), lambda j: tile(b - 1, j, b, F.col("block"), F.lit(1))))
    none = F.array().cast("array<struct<tile:bigint,place:int,side:int,own:int>>")
    named = left.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("token")), 1, NAMED_LISTS).alias("named"))
    dealt = (rows.select("token", "size", "node", "comp", F.explode(F.concat(
        every, F.coalesce(upper, none), F.coalesce(lower, none))).alias("t")).select("token", "size", "node", "comp", "t.*")
        .join(sets.select("node", "signature").join(named, "node"), "node"))
    pairs = (dealt.repartition("place").sortWithinPartitions("place", "tile", "side", "node")
             .mapInArrow(tidy(_tiles(percent, signed=True)), "a long, b long").distinct())
    return pairs


def _heavy(facts: DataFrame, min_docs: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (at most ``limit``) and how heavy they are."""
    rows = (facts.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_docs).orderBy(F.col("n").desc(), "token").limit(limit).toPandas())
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    weight = np.floor(np.log2(rows["n"].to_numpy(np.float64))).astype(np.int64)
    order = np.argsort(token)
    return token[order], weight[order]


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                             percent: int = 75, heavy_limit: int = HEAVY_LIMIT,
                             heavy_docs: int = HEAVY_DOCS) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row.

    ``percent`` is the similarity threshold in hundredths.  ``component_id``
    is the smallest id that links lead to.  Null, empty and blank texts have
    no shingles and link with nothing; a text of fewer than ``words`` words
    has one shingle.  Rows with the same id are one node; a null id has a null
    component and links with nothing.  ``id_col`` must be an integer column.
    Shingles are told apart by 64-bit hashes.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    facts = written(base.mapInArrow(tidy(_survey(words)), "id long, n long, digest binary, token long"), "sets")
    sets = facts.where("digest is not null").select("id", "n", "digest")
    classes = (sets.where("id is not null and n > 0").groupBy("digest")
               .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")))
    twins = classes.where("rows > 1")
    heavy, weight = _heavy(facts, heavy_docs, heavy_limit)
    posted = base.mapInArrow(tidy(_postings(words, percent, heavy, weight)), "token long, size int, node long")
    lists = written(posted.repartition("token").sortWithinPartitions("token", "size", "node")
                    .mapInArrow(tidy(_shared_lists(percent)), "token long, size int, node long, pivot long, pivot_size int"), "lists")
    # each node's likeliest partner: the first node of most of its lists
    stars = (lists.where((F.col("node") != F.col("pivot"))
                         & (F.col("pivot_size") * 100 >= F.col("size") * percent))
             .groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
             .where(F.col("n") * 20 >= F.col("size"))  # a fifth of its prefix; the rest wait
             .groupBy("node").agg(F.max(F.struct("n", -F.col("pivot"))).alias("best"))
             .select((-F.col("best.col2")).alias("a"), F.col("node").alias("b")))
    stars = written(stars, "stars")
    copies = (attach_group(sets.where("id is not null and n > 0"), twins, "digest", "rows").where("id <> rep")
              .select(F.col("rep").alias("a"), F.col("id").alias("b")))
    known = written(_confirmed(stars, base, words, percent).unionByName(copies), "links")
    labels = written(_labels(known), "labels")
    comps = lists.select("token", "size", "node").join(labels, "node", "left").select(
        "token", "size", "node", F.coalesce("label", "node").alias("comp"))
    left = written(_open(_one_of_each(comps, copies)), "open-lists")
    discard(lists)
    links, spent = [known], [stars]
    tried = stars
    for _ in range(ROUNDS):
        pairs = written(_likeliest(left, tried, percent), "pairs")
        more = written(_confirmed(pairs, base, words, percent), "links")
        tried = tried.unionByName(pairs.select("a", "b"))
        spent.append(pairs)
        links.append(more)
        merged = _labels(more.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
        now = (left.join(merged.select(F.col("node").alias("comp"), "label"), "comp", "left")
               .select("token", "size", "node", F.coalesce("label", "comp").alias("comp")))
        before, left = left, written(_open(now), "open-lists")
        discard(before)
    signs = _signatures_of(base, left.select("node").distinct(), words)
    signs = written(signs.join(left.groupBy("node").agg(F.max("size").cast("long").alias("n")), "node"), "signatures")
    pairs = _remaining_pairs(left, signs, percent).join(tried.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    pairs = written(pairs, "pairs")
    links.append(written(_confirmed(pairs, base, words, percent), "links"))
    every = links[0].select("a", "b")
    for more in links[1:]:
        every = every.unionByName(more.select("a", "b"))
    every = written(every, "all-links")
    discard(*spent, left, signs, pairs)
    # links between the stars that labels name; most have none left
    labels = written(_labels(every), "labels")
    named = attach_group(every.withColumnRenamed("a", "node"), labels.select("node", "label", "n"), "node", "n")
    named = attach_group(named.select(F.col("label").alias("a"), F.col("b").alias("node")), labels, "node", "n")
    across = written(named.where("a <> label").select("a", F.col("label").alias("b")).distinct(), "label-links")
    if across.isEmpty():
        comps = labels.select("node", F.col("label").alias("component"))
    else:
        roots = written(connected_components(across), "components")
        comps = labels.join(roots.select(F.col("node").alias("label"), "component"), "label", "left").select(
            "node", F.coalesce("component", "label").alias("component"))
    named = comps.where("node <> component").select(F.col("node").alias("id"), "component")
    return (sets.join(named, "id", "left")
            .select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component."""
    comps = ngram_jaccard_components(docs, id_col, text_col, **options)
    gone = comps.where(F.col("component_id") < F.col(id_col)).select(id_col).distinct()
    return docs.join(written(gone, "near-copies"), id_col, "left_anti").select(*docs.columns)
