"""Sets of word shingles as sorted arrays of 64-bit hashes, by numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A worker keeps at most so many powers of each kind (10 MB) from task to task.
KEPT_POWERS = 5 << 18
_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base (``up``) or its inverse
    (``down``), modulo 2^64; up to ``KEPT_POWERS`` are kept for the next call."""
    have = _powers[kind]
    if len(have) < n:
        steps = np.full(max(n, 1 << 16), _BASE if kind == "up" else _INVERSE, _U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if len(have) <= KEPT_POWERS:
            _powers[kind] = have
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every byte span: equal spans have equal hashes."""
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers("up", len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers("down", len(data) + 1)[starts] + (ends - starts).astype(_U))


def shingle_sets(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each text, as (hashes, offsets).

    ``hashes[offsets[i]:offsets[i + 1]]`` is sorted.  Words are runs without
    ASCII white space, with A-Z lower-cased; a text of fewer than ``k`` words
    has its whole sequence as one shingle, one without words has none.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    edge = np.diff(np.concatenate([[1], _SPACE[data], [1]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = span_hashes(data, starts, ends)
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(counts) - counts
    # windows of k words, and whole texts of fewer
    full = np.flatnonzero(doc[:len(doc) - k + 1] == doc[k - 1:]) if len(doc) >= k else np.empty(0, np.int64)
    h = np.zeros(len(full), _U)
    for j in range(k):
        h = h * _BASE + words[full + j]
    short = np.flatnonzero((counts > 0) & (counts < k))
    hs = np.zeros(len(short), _U)
    for j in range(k - 1):
        has = counts[short] > j
        hs[has] = hs[has] * _BASE + words[first[short[has]] + j] + _U(j)
    hashes = mix(np.concatenate([h, hs + _INVERSE]))
    doc = np.concatenate([doc[full], short])
    if len(short):  # put the short texts' shingles in place
        order = np.argsort(doc, kind="stable")
        hashes, doc = hashes[order], doc[order]
    stops = np.cumsum(np.bincount(doc, minlength=len(texts)))
    for a, b in zip([0, *stops.tolist()], stops.tolist()):
        hashes[a:b].sort()
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
