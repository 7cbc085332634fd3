"""Suffix arrays by induced sorting, for the shards that tasks hold.

A suffix is S-type if it is smaller than the one after it, else L-type; an S-type one whose
predecessor is L-type is leftmost smaller (LMS). LMS substrings are sorted by one round of
inducing and named; if names repeat, the string of names is sorted recursively. The order of
the LMS suffixes then induces all others: L-type ones from the left, S-type ones from the right.

Inducing goes through the array in blocks: all that is filled up to the next gap is taken at
once, as the suffixes it puts lie beyond.
"""

from __future__ import annotations

import numpy as np

#: Suffixes looked at at a time, and how few of them are placed one by one.
BLOCK, FEW = 4096, 16


def _types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is S-type; the last symbol is the unique smallest one."""
    step = np.diff(s.astype(np.int64))
    places = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(places[::-1])[::-1]
    types = np.ones(len(s), bool)
    types[:-1] = np.append(step, 1)[following] > 0
    return types


def _leftmost(types: np.ndarray) -> np.ndarray:
    return np.flatnonzero(types[1:] & ~types[:-1]) + 1


def _sweep(view: np.ndarray, s: np.ndarray, types: np.ndarray, kind: bool, heads: np.ndarray, own: np.ndarray) -> None:
    """Go through ``view`` in order and put the suffix before each one, if it is of ``kind``,
    at its bucket's head. ``own`` marks the places of that kind, which get filled on the way:
    all up to the next unfilled one can be taken at once, as what they put lies beyond."""
    done = 0
    while done < len(view):
        block = view[done : done + BLOCK]
        unfilled = (block < 0) & own[done : done + BLOCK]
        ready = int(unfilled.argmax()) or (0 if unfilled[0] else len(block))
        if not ready:
            raise ValueError("the last symbol isn't the unique smallest one")
        if ready <= FEW:
            for i in block[:ready].tolist():
                if i > 0 and types[i - 1] == kind:
                    letter = s[i - 1]
                    view[heads[letter]] = i - 1
                    heads[letter] += 1
        else:
            before = block[:ready]
            before = before[before > 0] - 1
            before = before[types[before] == kind]
            letters = s[before]
            turn = np.argsort(letters, kind="stable")
            letters = letters[turn]
            firsts = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]])) if len(letters) else turn
            counts = np.diff(np.append(firsts, len(letters)))
            view[heads[letters] + np.arange(len(letters)) - np.repeat(firsts, counts)] = before[turn]
            heads[letters[firsts]] += counts
        done += ready


def _induced(s: np.ndarray, types: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order of all suffixes from that of the LMS ones (``lms``, grouped by bucket)."""
    n, starts = len(s), np.concatenate([[0], ends[:-1]])
    larger = np.arange(n) < np.repeat(ends - np.bincount(s[types], minlength=len(ends)), ends - starts)
    order = np.full(n, -1, np.int64)
    letters = s[lms]
    counts = np.bincount(letters, minlength=len(ends))
    order[(ends - np.cumsum(counts))[letters] + np.arange(len(lms))] = lms
    _sweep(order, s, types, False, starts.copy(), larger)
    order[~larger] = -1
    order[0] = n - 1
    heads = n - ends
    heads[0] += 1
    _sweep(order[::-1], s, types, True, heads, ~larger[::-1])
    return order


def _same(s: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether s[a : a + length] and s[b : b + length] are equal, for each pair."""
    same, active, at = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(active):
        equal = s[a[active] + at] == s[b[active] + at]
        same[active[~equal]] = False
        at += 1
        active = active[equal]
        active = active[lengths[active] > at]
    return same


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """The suffix array of ``s``, symbols below ``size``, the last one 0 and nowhere else."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    types = _types(s)
    lms = _leftmost(types)
    ends = np.cumsum(np.bincount(s, minlength=size))
    # Any order within a bucket sorts the LMS substrings.
    order = _induced(s, types, lms[np.argsort(s[lms], kind="stable")], ends)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    length = np.zeros(len(s), np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    alike = length[a] == length[b]
    alike[alike] = _same(s, a[alike], b[alike], length[a[alike]])
    names = np.zeros(len(s), np.int64)
    names[sorted_lms] = np.concatenate([[0], np.cumsum(~alike)])
    reduced = names[lms]
    if reduced.max() + 1 < len(lms):
        ranked = lms[suffix_array(reduced, int(reduced.max()) + 1)]
    else:
        ranked = np.empty_like(lms)
        ranked[reduced] = lms
    return _induced(s, types, ranked, ends)


def common_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For every place (permuted: in text order) how many symbols its suffix shares with the
    one before it in ``order``, up to ``most``. ``s`` has 8-bit symbols but for the last."""
    before = np.full(len(s), -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([s.astype(np.uint64), np.zeros(most + 8, np.uint64)])
    words = np.zeros(len(s) + most, np.uint64)  # four symbols of 16 bits at every place
    for k in range(4):
        words |= padded[k : k + len(words)] << np.uint64(48 - 16 * k)
    shared = np.zeros(len(s), np.int64)
    active = np.flatnonzero(before >= 0)
    for at in range(0, most, 4):
        differ = words[active + at] ^ words[before[active] + at]
        shared[active] += np.where(differ == 0, 4, (differ < 1 << 48).astype(int) + (differ < 1 << 32) + (differ < 1 << 16))
        active = active[differ == 0]
    return np.minimum(shared, most)
