"""Weighted MinHash signatures from hashed darts.

Every element owns a strip of the plane: weight upwards, rank to the right. The
strip is cut into regions of fixed size (weight doubling, rank doubling); a hash
of element and region says how many darts land in it, and where, so that two
documents with the same element see the same darts. A document keeps the darts
under its weight and below a rank that its total weight sets, about k ln k + 2k
in all; the earliest for each of k coordinates are its signature. Two signatures
agree at a coordinate with the probability of the weighted Jaccard similarity.
A coordinate left empty doubles the rank for that document.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from .textkernel import U64, mix

#: Rank regions: [0, 1/8), [1/8, 1/4), then doubling.
_FIRST = -3


def _rank_region(c: int) -> tuple[float, float]:
    return (0.0 if c == 0 else 2.0 ** (_FIRST + c - 1), 2.0 ** (_FIRST + c))


def _weight_region(v: int) -> tuple[float, float]:
    return (0.0 if v == 0 else 2.0 ** (v - 1), 2.0**v)


@lru_cache(maxsize=256)
def _counts(mean: float) -> np.ndarray:
    """Cumulative probabilities of a number of darts (Poisson)."""
    most = int(mean + 12 * math.sqrt(mean) + 16)
    logs = [n * math.log(mean) - mean - math.lgamma(n + 1) for n in range(most)]
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U64(11)).astype(np.float64) * 2.0**-53


def signatures(elements: np.ndarray, bounds: np.ndarray, k: int, weights: np.ndarray | None = None, piece: int = 1 << 17) -> np.ndarray:
    """Signatures (documents x k, uint64) of the sets elements[bounds[i]:bounds[i+1]].

    ``weights`` are over 0, one for each element, and equal elements of a document must have equal weights; none
    means 1 each, and then an element may stand more than once. A document without elements gets zeros.
    """
    n = len(bounds) - 1
    out = np.zeros((n, k), U64)
    size = np.diff(bounds)
    darts = k * math.log(max(k, 2)) + 2 * k
    doc = np.repeat(np.arange(n), size)
    total = size.astype(float) if weights is None else np.bincount(doc, weights, minlength=n)
    reach = darts / np.maximum(total, 1e-12)
    todo = np.flatnonzero(size > 0)
    best = np.full(n * k, np.inf)
    done = np.zeros(n)  # the rank up to which a document's darts are thrown
    flat_out = out.reshape(-1)
    while len(todo):
        active = np.zeros(n, bool)
        active[todo] = True
        c = 0
        top = reach[todo].max()
        while _rank_region(c)[0] < top:
            lo, hi = _rank_region(c)
            need = active & (reach > lo) & (done < hi)
            mine = np.flatnonzero(need[doc]) if need.sum() < n or not need.all() else np.arange(len(doc))
            heaviest = 1.0 if weights is None else (weights[mine].max() if len(mine) else 0.0)
            v = 0
            while _weight_region(v)[0] < heaviest:
                low, high = _weight_region(v)
                part = mine if weights is None else mine[weights[mine] > low]
                step = max(1, int(piece / max(1.0, (hi - lo) * (high - low))))
                for i in range(0, len(part), step):
                    _throw(part[i : i + step], elements, weights, doc, reach, done, (lo, hi), (low, high), c, v, k, best, flat_out)
                v += 1
            c += 1
        done[todo] = reach[todo]
        empty = np.isinf(best.reshape(n, k)[todo]).any(axis=1)
        todo = todo[empty]
        reach[todo] *= 2
    return out


def _throw(part, elements, weights, doc, reach, done, rank, weight, c, v, k, best, out) -> None:
    (lo, hi), (low, high) = rank, weight
    seed = mix(elements[part] + U64((0x9E3779B97F4A7C15 * (1 + c + 64 * v)) & 0xFFFFFFFFFFFFFFFF))
    count = np.searchsorted(_counts((hi - lo) * (high - low)), _unit(mix(seed ^ U64(0xA5A5A5A5A5A5A5A5))), "right")
    total = int(count.sum())
    if not total:
        return
    own = np.repeat(np.arange(len(part)), count)
    nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    dart = mix(seed[own] + (nth.astype(U64) + U64(1)) * U64(0xD1B54A32D192ED03))
    at = lo + (hi - lo) * _unit(mix(dart ^ U64(0x5851F42D4C957F2D)))
    of = doc[part[own]]
    keep = (at < reach[of]) & (at >= done[of])
    if weights is not None:
        up = low + (high - low) * _unit(mix(dart ^ U64(0x14057B7EF767814F)))
        keep &= up < weights[part[own]]
    at, dart, of = at[keep], dart[keep], of[keep]
    slot = of * k + ((dart >> U64(32)) % U64(k)).astype(np.int64)
    np.minimum.at(best, slot, at)
    won = best[slot] == at
    out[slot[won]] = dart[won]


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """Hashes of each ``rows`` neighbouring coordinates (documents x k / rows)."""
    n, k = signature.shape
    out = np.zeros((n, k // rows), U64)
    for i in range(rows):
        out = mix(out + signature[:, i::rows][:, : k // rows])
    return out
