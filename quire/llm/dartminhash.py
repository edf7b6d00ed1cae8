"""Weighted signatures of word shingles by DartMinHash, in numpy.

A text's elements are its five-word shingles, weighted by how often they occur.
Above every element lies a strip of the plane (weight x rank); hashed darts
fall on it as a Poisson process, the same for every text.  A text sees the
darts below its own weights; each carries a coordinate, and the signature keeps
the earliest (lowest rank) per coordinate.  Two signatures agree in a
coordinate with probability equal to the weighted Jaccard similarity.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

WORDS = 5
#: Fixed multipliers of the hash (odd 64-bit numbers).
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(5).integers(1, 2**63, 256, np.uint64)
_BYTES[_SPACE] = 0
#: Texts worked on together, by bytes.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1) from the upper 52 bits."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


@dataclass
class Shingles:
    """Distinct shingles of a run of texts, ordered by text, then hash:
    ``bounds[i]:bounds[i + 1]`` are those of text i, ``count`` their weights."""

    hashes: np.ndarray
    count: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    digests: list[bytes]


def shingles(raw: Sequence[bytes], size: int = WORDS) -> Shingles:
    """Words are runs of bytes other than ASCII white space. A text of fewer
    words than ``size`` has one shingle of all of them; without words, none.
    ``digests`` identify the sequence of words."""
    import hashlib

    lengths = np.array([len(r) for r in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(lengths)
    solid = ~_SPACE[flat]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = (ends - lengths)[lengths > 0]
    opens[inner] |= solid[inner]
    at = np.flatnonzero(opens)
    doc = np.searchsorted(ends, at, "right")
    words = np.bincount(doc, minlength=len(raw))
    firsts = np.cumsum(words) - words
    if len(at):
        span = np.diff(np.append(at, len(flat)))
        powers = np.cumprod(np.append(np.uint64(1), np.full(int(span.max()) - 1, M1, np.uint64)))
        place = np.arange(at[0], len(flat)) - np.repeat(at, span)
        value = _BYTES[flat[at[0] :]] * powers[place]
        # a word that runs up to the end of its text meets the next text's first byte as a new word or as space
        hashed = mix(np.add.reduceat(value, at - at[0]))
    else:
        hashed = np.zeros(0, np.uint64)
    digests = [hashlib.blake2b(hashed[f : f + n].tobytes(), digest_size=16).digest() for f, n in zip(firsts.tolist(), words.tolist(), strict=True)]
    n = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    bounds = np.append(0, np.cumsum(n))
    start = np.repeat(firsts, n) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    left = np.repeat(np.minimum(words, size), n)
    out = np.zeros(bounds[-1], np.uint64)
    for k in range(size):
        inside = left > k
        out[inside] = mix(out[inside] * M1 + hashed[start[inside] + k] + np.uint64(k + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[a:b].sort()
    owner = np.repeat(np.arange(len(raw)), n)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    keep = np.flatnonzero(new)
    count = np.diff(np.append(keep, len(out)))
    return Shingles(out[keep], count, np.append(0, np.cumsum(np.bincount(owner[keep], minlength=len(raw)))), words, digests)


def signatures(found: Shingles, k: int, *, weighted: bool = True, seed: int = 1) -> np.ndarray:
    """(text, k) dart numbers; rows of texts without shingles are 0.

    Darts are thrown up to a rank at which k (ln k + 2) of them are expected
    below a text's weights; texts with a coordinate left empty are thrown at
    again up to twice the rank, until none is.
    """
    n = len(found.bounds) - 1
    out = np.zeros((n, k), np.uint64)
    sizes = np.diff(found.bounds)
    weight = found.count.astype(np.float64) if weighted else np.ones(len(found.count))
    todo, darts = np.flatnonzero(sizes), k * (math.log(k) + 2)
    while len(todo):
        picked = np.concatenate([np.arange(found.bounds[i], found.bounds[i + 1]) for i in todo.tolist()])
        rows = np.repeat(np.arange(len(todo)), sizes[todo])
        sig, full = _throw(found.hashes[picked], weight[picked], rows, len(todo), k, darts, seed)
        out[todo[full]] = sig[full]
        todo, darts = todo[~full], darts * 2
    return out


def _throw(elements, weight, row, n, k, darts, seed):
    total = np.bincount(row, weight, minlength=n)
    limit = darts / total
    # weight regions of an element: [0, 1), [1, 2), [2, 4), [4, 8), ... up to its weight
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64) + 1
    pick = np.repeat(np.arange(len(elements)), levels)
    level = np.arange(len(pick)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1.0, low)
    state = mix(elements[pick] + M1 * (level.astype(np.uint64) + np.uint64(seed << 8)))
    top, owner = weight[pick], row[pick]
    rank = np.zeros(len(pick))
    ceiling = limit[owner]
    best = np.full(n * k, np.inf)
    hits = []
    while len(state):
        # the next dart of each strip: an exponential step up the rank axis
        state = mix(state + M1)
        rank = rank - np.log(unit(state)) / width
        go = rank < ceiling
        state, rank, owner, low, width, top, ceiling = (x[go] for x in (state, rank, owner, low, width, top, ceiling))
        dart = mix(state ^ M3)
        hit = low + width * unit(dart) < top
        number = mix(dart[hit] + M2)
        spot = owner[hit] * k + (number % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, spot, rank[hit])
        hits.append((spot, rank[hit], number))
    sig = np.zeros(n * k, np.uint64)
    for spot, at, number in hits:
        first = best[spot] == at
        sig[spot[first]] = number[first]
    return sig.reshape(n, k), np.isfinite(best).reshape(n, k).all(axis=1)


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """(text, k / rows) hashes of runs of ``rows`` coordinates, each with its
    number mixed in; as signed 64-bit numbers."""
    n, k = sig.shape
    part = sig.reshape(n, k // rows, rows)
    out = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64), (n, k // rows)).copy()
    for i in range(rows):
        out = mix(out * M1 + part[:, :, i])
    return out.view(np.int64)


def similarity(a: Shingles, i: int, b: Shingles, j: int) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two texts' shingles."""
    ha, hb = a.hashes[a.bounds[i] : a.bounds[i + 1]], b.hashes[b.bounds[j] : b.bounds[j + 1]]
    if not len(ha) or not len(hb):
        return 0.0, 0.0
    ca, cb = a.count[a.bounds[i] : a.bounds[i + 1]], b.count[b.bounds[j] : b.bounds[j + 1]]
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    shared = int(np.minimum(ca[same], cb[at[same]]).sum())
    both = int(same.sum())
    return shared / (int(ca.sum()) + int(cb.sum()) - shared), both / (len(ha) + len(hb) - both)


def beyond(a: Shingles, i: int, b: Shingles, j: int) -> tuple[float, int, np.ndarray]:
    """Of texts i of ``a`` and j of ``b``: their weighted similarity, the
    number of shingles of i, and hashes of those of them that j lacks. A
    shingle that occurs again is another one, told apart by its number."""
    ha, hb = a.hashes[a.bounds[i] : a.bounds[i + 1]], b.hashes[b.bounds[j] : b.bounds[j + 1]]
    ca, cb = a.count[a.bounds[i] : a.bounds[i + 1]], b.count[b.bounds[j] : b.bounds[j + 1]]
    size = int(ca.sum())
    had = np.zeros(len(ha), np.int64)
    if len(ha) and len(hb):
        at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
        had = np.where(hb[at] == ha, np.minimum(ca, cb[at]), 0)
    shared, extra = int(had.sum()), ca - had
    picked = np.repeat(np.arange(len(ha)), extra)
    number = np.arange(len(picked)) - np.repeat(np.cumsum(extra) - extra, extra) + had[picked]
    return shared / max(1, size + int(cb.sum()) - shared), size, mix(ha[picked] + M1 * number.astype(np.uint64)).view(np.int64)


def pieces(lengths: Sequence[int], most: int = PIECE) -> list[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    out, first, size = [], 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            out.append((first, i))
            first, size = i, 0
        size += n
    if first < len(lengths):
        out.append((first, len(lengths)))
    return out
