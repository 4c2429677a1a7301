"""Suffix arrays by induced sorting and permuted common prefixes, for one shard of texts held in numpy arrays.

The scans over the buckets run a whole bucket at a time: a bucket's entries induce their predecessors together, in
waves for predecessors that fall into the same bucket, so the work is linear in array operations on the shard.
"""

from __future__ import annotations

import numpy as np

# Ends a text in a shard; never a byte of UTF-8.
SEPARATOR = 0xFF


def _smaller(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbour; the end of the string is smaller than all else."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int16)))
    step = np.append(step, -1)
    # Equal neighbours take the type of the next position where the bytes differ.
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def _deal(buckets: list[list[np.ndarray]], positions: np.ndarray, t: np.ndarray) -> None:
    """Append positions to the buckets of their bytes, keeping their order."""
    if not len(positions):
        return
    c = t[positions]
    order = np.argsort(c, kind="stable")
    positions, c = positions[order], c[order]
    cuts = np.flatnonzero(np.diff(c)) + 1
    for first, part in zip(c[np.append(0, cuts)].tolist(), np.split(positions, cuts), strict=True):
        buckets[first].append(part)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    starts: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(starts, lms, t)
    starts = [_joined(x) for x in starts]
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    last = len(t) - 1  # the end of the string comes before all suffixes and induces the last one
    larger[t[last]].append(np.array([last]))
    for c in range(256):
        done = 0
        while done < len(larger[c]):
            wave = _joined(larger[c][done:])
            done = len(larger[c])
            before = wave[wave > 0] - 1
            _deal(larger, before[~smaller[before]], t)
        before = starts[c][starts[c] > 0] - 1
        _deal(larger, before[~smaller[before]], t)
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    for c in range(255, -1, -1):
        done = 0
        while done < len(falling[c]):
            wave = _joined(falling[c][done:])
            done = len(falling[c])
            before = wave[wave > 0] - 1
            _deal(falling, before[smaller[before]], t)
        wave = _joined(larger[c])[::-1]
        before = wave[wave > 0] - 1
        _deal(falling, before[smaller[before]], t)
    return np.concatenate([x for c in range(256) for x in (_joined(larger[c]), _joined(falling[c])[::-1])])


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Suffixes of the reduced string in order: ranks of runs of 1, 2, 4, ... names, only where still tied."""
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        sorted_rank = rank[order]
        new = np.append(True, sorted_rank[1:] != sorted_rank[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = head
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order
        items = order[tied]
        after = np.where(items + width < n, rank[np.minimum(items + width, n - 1)] + 1, 0)
        key = np.lexsort((after, rank[items]))
        items, after = items[key], after[key]
        order[tied] = items
        # Ranks of the tied items split by what follows them.
        base = rank[items]
        split = np.append(True, (base[1:] != base[:-1]) | (after[1:] != after[:-1]))
        rank[items] = tied[np.maximum.accumulate(np.where(split, np.arange(len(tied)), 0))]
        width *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of the bytes `t` in the order of their suffixes."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    smaller = _smaller(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        # Sort the substrings between leftmost-smaller positions by induction, name them, and sort the names' suffixes.
        order = _induce(t, smaller, lms)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        order = order[is_lms[order]]
        names = np.empty(n, dtype=np.int64)
        names[order] = np.cumsum(np.append(False, ~_same_substrings(t, lms, order)))
        lms = lms[_sort_names(names[lms])]
    return _induce(t, smaller, lms)


def _same_substrings(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each leftmost-smaller substring, in `order`, equals the one before it."""
    end = np.empty(len(t), dtype=np.int64)
    end[lms] = np.append(lms[1:], len(t) - 1)
    length = end[order] - order + 1
    same = length[1:] == length[:-1]
    same &= (order[1:] + length[1:] < len(t)) & (order[:-1] + length[:-1] < len(t))  # the last one ends with the string
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        a, b = order[left] + k, order[left + 1] + k
        differs = t[a] != t[b]
        same[left[differs]] = False
        k += 1
        left = left[~differs & (length[left] > k)]
    return same


def common_prefixes(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: the one before it in suffix order (-1: none), and the length of their common prefix.

    Only irreducible values, where the bytes to the left differ, are found by comparison; a reducible one is one less than
    the value at the position to its left."""
    n = len(t)
    phi = np.full(n, -1, dtype=np.int64)
    phi[order[1:]] = order[:-1]
    left = phi - 1
    i = np.arange(n)
    reducible = (phi > 0) & (i > 0) & (t[np.maximum(left, 0)] == t[np.maximum(i - 1, 0)])
    at = np.flatnonzero(~reducible & (phi >= 0))
    padded = np.concatenate([t, np.zeros(16, dtype=np.uint8)]).astype(np.uint64)
    eight = sum(padded[k:k + n + 8] << np.uint64(8 * k) for k in range(8))
    length = np.zeros(n, dtype=np.int64)
    active, a, b = at, at.copy(), phi[at]
    while len(active):
        x = eight[a] ^ eight[b]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
        room = n - np.maximum(a, b)
        length[active] += np.minimum(same, room)
        on = (x == 0) & (room > 8)
        active, a, b = active[on], a[on] + 8, b[on] + 8
    reach = np.zeros(n, dtype=np.int64)
    reach[at] = length[at] + at
    return phi, np.where(phi >= 0, np.maximum.accumulate(reach) - i, 0)


def repeated(texts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indexes of the texts with strings of `span` bytes that start elsewhere in `texts` too, and the first and the last
    start of such a string in each."""
    sizes = np.array([len(x) + 1 for x in texts])
    begins = np.cumsum(sizes) - sizes
    separator = bytes([SEPARATOR])
    t = np.frombuffer(separator.join(texts) + separator, dtype=np.uint8)
    phi, common = common_prefixes(t, suffix_array(t))
    hit = common >= span
    hit[phi[hit]] = True
    found = np.flatnonzero(hit)
    of = np.searchsorted(begins, found, side="right") - 1
    inside = found - begins[of] + span < sizes[of]
    found, of = found[inside], of[inside]
    if not len(found):
        return of, found, found
    which, first = np.unique(of, return_index=True)
    last = np.append(first[1:], len(of)) - 1
    return which, found[first] - begins[which], found[last] - begins[which]
