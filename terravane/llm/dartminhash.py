"""Weighted minhash signatures from hashed darts.

Each element owns a Poisson process of darts on its (weight, rank) half-plane, one process for each weight row [0, 1),
[1, 2), [2, 4), ...; the arrivals follow from the element's hash alone. A dart counts for a set if it lies below the
element's weight. Every dart falls on one of k coordinates, and a set keeps the earliest dart of each coordinate. For
two weighted sets the chance that a coordinate agrees is their weighted Jaccard similarity. Only darts up to the rank
(k ln k + 2 k) / total weight are thrown at first; sets with a coordinate still empty get twice the rank, and so on.
The kept dart doesn't depend on how far the throwing went.
"""

from __future__ import annotations

import numpy as np

from terravane.llm.textarrays import U64, mix, seeds

#: Bits of a kept dart's mark in a signature.
MARK_BITS = 14
ROWS = seeds(64, 101)
STEP = U64(0xD1342543DE82EF95)


def _throw(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, reach: np.ndarray, k: int) -> np.ndarray:
    """Darts below rank reach as packed (set and coordinate, rank, mark), unsorted. owner: the set of each element."""
    found = []
    top = float(weights.max()) if len(weights) else 0.0
    row, low = 0, 0.0
    while low < top:
        width = 1.0 if row == 0 else low
        some = np.flatnonzero(weights > low) if low else np.arange(len(weights))
        seed = hashes[some] + ROWS[row]
        rank = np.zeros(len(some), np.float64)
        own, most = owner[some], reach[owner[some]]
        limit = weights[some] - low
        while len(seed):
            seed = seed * STEP + U64(1)
            drawn = mix(seed)
            rank = rank - np.log(((drawn >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            live = rank <= most
            seed, rank, own, most, limit, drawn = seed[live], rank[live], own[live], most[live], limit[live], drawn[live]
            second = mix(drawn ^ STEP)
            coordinate = ((second >> U64(40)) * U64(k)) >> U64(24)
            cell = own.astype(U64) * U64(k) + coordinate
            packed = (cell << U64(46)) | (rank.astype(np.float32).view(np.uint32).astype(U64) << U64(14)) | (second & U64((1 << MARK_BITS) - 1))
            if row:
                height = (second & U64((1 << 40) - 1)).astype(np.float64) * 2.0**-40 * width
                packed = packed[height < limit]
            found.append(packed)
        row, low = row + 1, width if row == 0 else low * 2
    return np.concatenate(found) if found else np.zeros(0, U64)


def signatures(hashes: np.ndarray, bounds: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """A (sets, k) matrix of marks, 1 and up; the row of an empty set is all 0.

    bounds: set i has the elements bounds[i]:bounds[i + 1], each once for it; at most 2**18 / k sets a call. weights: above 0;
    all 1 if None. The same elements with the same weights have the same row, whatever their order.
    """
    sets = len(bounds) - 1
    if sets * k > 1 << 18:
        step = max(1, (1 << 18) // k)
        rows = [signatures(hashes[bounds[a] : bounds[min(a + step, sets)]], bounds[a : min(a + step, sets) + 1] - bounds[a], k, None if weights is None else weights[bounds[a] : bounds[min(a + step, sets)]]) for a in range(0, sets, step)]
        return np.concatenate(rows)
    out = np.zeros((sets, k), np.uint16)
    weights = np.ones(len(hashes)) if weights is None else np.asarray(weights, np.float64)
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    total = np.bincount(owner, weights, sets)
    todo = np.flatnonzero(total > 0)
    darts = k * np.log(k) + 2 * k
    reach = np.zeros(sets)
    pick = None
    with np.errstate(over="ignore"):
        while len(todo):
            reach[todo] = darts / total[todo]
            if pick is None:
                got = _throw(hashes, weights, owner, reach, k)
            else:
                mine = pick[owner]
                got = _throw(hashes[mine], weights[mine], owner[mine], reach, k)
            got.sort()
            cell = (got >> U64(46)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
            out.reshape(-1)[cell[first]] = (got[first] & U64((1 << MARK_BITS) - 1)).astype(np.uint16) + np.uint16(1)
            todo = todo[(out[todo] == 0).any(axis=1)]
            pick = np.zeros(sets, bool)
            pick[todo] = True
            darts *= 2
    return out
