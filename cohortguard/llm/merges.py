"""Ranked merges of byte-pair vocabularies, folded over many words at once."""

from __future__ import annotations

import base64
import heapq
import json

import numpy as np

_NONE = np.int32(2 ** 31 - 1)
#: Words of more symbols are folded one by one with a heap.
LONG_WORD = 2048


class PairTable:
    """Rank of a pair of symbols: an open-addressed table of numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(len(rank) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == -1
            first = np.unique(slot[todo[free]], return_index=True)[1]
            put = todo[free][first]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], rank[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        out = np.full(len(keys), _NONE, np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            seen = self.keys[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit & (seen != -1)]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
        return out


class RankedMerges:
    """Folds the merges of a vocabulary over words given as symbol ids.

    In every word the adjacent pair of lowest rank is merged (leftmost first)
    until no pair has a rank.  All words advance together, one rank each per
    round; finished words leave the arrays.
    """

    def __init__(self, left, right, rank, merged):
        """``merged`` maps a rank to the symbol that its pair becomes."""
        left, right, rank = (np.asarray(x, np.int64) for x in (left, right, rank))
        self.table = PairTable(left, right, rank.astype(np.int32))
        self.merged = np.asarray(merged, np.int32)
        self.pairs = dict(zip(zip(left.tolist(), right.tolist()), rank.tolist()))

    def fold_one(self, symbols: list[int]) -> list[int]:
        """One long word, by a heap over its pairs: n log n steps."""
        n = len(symbols)
        sym, nxt, prev = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        rank = self.pairs.get
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j] = int(self.merged[r]), False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and nxt[k] < n and (q := rank((sym[k], sym[nxt[k]]))) is not None:
                    heapq.heappush(heap, (q, k, sym[k], sym[nxt[k]]))
        return [s for s, live in zip(sym, alive) if live]

    def fold(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fold words laid end to end; returns their ids and new lengths."""
        n_words = len(lengths)
        word = np.repeat(np.arange(n_words, dtype=np.int64), lengths)
        sym = symbols.astype(np.int32)
        done_sym, done_word = [], []
        if len(long := np.flatnonzero(lengths > LONG_WORD)):
            starts = np.cumsum(lengths) - lengths
            for w in long:
                ids = self.fold_one(sym[starts[w]:starts[w] + lengths[w]].tolist())
                done_sym.append(np.array(ids, np.int32))
                done_word.append(np.full(len(ids), w, np.int64))
            keep = ~np.isin(word, long)
            word, sym = word[keep], sym[keep]
        rank = np.full(len(sym), _NONE, np.int32)
        at = np.flatnonzero(word[1:] == word[:-1])
        rank[at] = self.table.rank(sym[at], sym[at + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            if (least == _NONE).any():
                out = np.repeat(least == _NONE, sizes)
                done_sym.append(sym[out])
                done_word.append(word[out])
                sym, word, rank = sym[~out], word[~out], rank[~out]
                sizes, least = sizes[least != _NONE], least[least != _NONE]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, sizes)
            # of overlapping hits, the leftmost and then every second one
            i = np.arange(len(hit))
            last_miss = np.maximum.accumulate(np.where(hit, -1, i))
            hit &= (i - last_miss) % 2 == 1
            at = np.flatnonzero(hit)
            sym[at] = self.merged[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # places after removal: one symbol gone per earlier merge
            sym, word, rank = sym[keep], word[keep], rank[keep]
            near = np.zeros(len(sym) + 1, bool)
            near[at] = True
            near[at - 1] = True  # a hit at 0 marks the spare last place
            redo = np.flatnonzero(near[:len(sym) - 1])
            same = word[redo] == word[redo + 1]
            rank[at] = _NONE
            rank[redo[~same]] = _NONE
            redo = redo[same]
            rank[redo] = self.table.rank(sym[redo], sym[redo + 1])
        if not done_sym:
            return np.empty(0, np.int32), np.zeros(n_words, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n_words)


class PieceIds:
    """Packed ids of text pieces, each folded once and remembered.

    ``inner`` and ``last`` give the symbol of a byte inside and at the end of
    a piece.  The memory is bounded: beyond ``limit`` pieces it starts anew.
    """

    BLOCK = 8000  # pieces folded at once: arrays that stay in the cache

    def __init__(self, merges: RankedMerges, inner: np.ndarray, last: np.ndarray, dtype: str, limit: int):
        self.merges, self.inner, self.last = merges, inner, last
        self.dtype, self.limit = np.dtype(dtype), limit
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of all ``pieces`` (at least)."""
        known = self.known
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            new = list(pieces)
        for i in range(0, len(new), self.BLOCK):
            raw = [p.encode() for p in new[i:i + self.BLOCK]]
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            data = np.frombuffer(b"".join(raw), np.uint8)
            symbols, ends = self.inner[data], np.cumsum(lengths) - 1
            symbols[ends] = self.last[data[ends]]
            ids, counts = self.merges.fold(symbols, lengths)
            packed, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            stops = (np.cumsum(counts) * width).tolist()
            for p, a, b in zip(new[i:i + self.BLOCK], [0, *stops], stops):
                known[p] = packed[a:b]
        return known


def load_byte_ranks(path: str) -> tuple[RankedMerges, dict[bytes, int], np.ndarray]:
    """A rank file (base64 token, rank per line): merges, ranks, symbol per byte."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    symbols = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return RankedMerges(left, right, rank, np.arange(max(ranks.values()) + 1)), ranks, symbols


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level files:
    printable Latin-1 as is, the others from code point 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def load_word_merges(path: str) -> tuple[RankedMerges, np.ndarray, np.ndarray]:
    """A tokenizer file with word-end symbols: merges, symbol per inner byte,
    symbol per last byte."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = RankedMerges([vocab[a] for a, _ in merges], [vocab[b] for _, b in merges], range(len(merges)),
                          [vocab[a + b] for a, b in merges])
    chars = byte_alphabet()
    return (merged, np.array([vocab[c] for c in chars], np.int32),
            np.array([vocab[c + end] for c in chars], np.int32))
