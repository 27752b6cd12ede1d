"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy.

``suffix_array`` follows induced sorting: classify the suffixes as smaller (S) or larger (L)
than their right neighbour, sort the leftmost-S substrings (by inducing, naming and, where
names repeat, recursion), then induce all other suffixes from them in two linear passes. With
few letters a pass handles one bucket at a time as arrays; the recursion's strings have many
letters and few places, there a plain loop is faster.
"""

from __future__ import annotations

import numpy as np


def _classify(s: np.ndarray) -> np.ndarray:
    """True for S-type places; the last place is the sentinel and S-type."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    # A place equal to its right neighbour takes that neighbour's type.
    unequal = np.append(np.where(step != 0, np.arange(n - 1), n), n - 1)
    following = np.minimum.accumulate(unequal[::-1])[::-1]
    rising = np.append(step > 0, True)
    return rising[np.minimum(following, n - 1)]


class _Buckets:
    def __init__(self, s: np.ndarray, letters: int):
        self.count = np.bincount(s, minlength=letters)
        self.end = np.cumsum(self.count)
        self.start = self.end - self.count


def _induce_by_bucket(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, induced from the leftmost-S suffixes in the order of ``lms``."""
    b = _Buckets(s, letters)
    sa = np.full(len(s), -1, np.int64)

    def ranked(j: np.ndarray):
        """``j`` grouped by first letter, order kept; rank in the group; size of each group."""
        letter = s[j]
        order = np.argsort(letter, kind="stable")
        letter = letter[order]
        size = np.bincount(letter, minlength=letters)
        return j[order], letter, np.arange(len(j)) - (np.cumsum(size) - size)[letter], size

    tail_size = np.bincount(s[lms], minlength=letters)
    tail = b.end - tail_size
    put, letter, rank, _ = ranked(lms)
    sa[tail[letter] + rank] = put

    head = b.start.copy()
    used = np.flatnonzero(b.count)
    for c in used:
        done = b.start[c]
        waves = True
        while waves:
            waves = done < head[c]
            chunk = sa[done : head[c]] if waves else sa[tail[c] : b.end[c]]
            done = head[c]
            j = chunk[chunk > 0] - 1
            j = j[~is_s[j]]
            if len(j):
                put, letter, rank, size = ranked(j)
                sa[head[letter] + rank] = put
                head += size

    tail = b.end.copy()
    for c in used[::-1]:
        if c == 0:
            sa[0] = len(s) - 1
            break
        done = b.end[c]
        waves = True
        while waves:
            waves = done > tail[c]
            chunk = sa[tail[c] : done][::-1] if waves else sa[b.start[c] : head[c]][::-1]
            done = tail[c]
            j = chunk[chunk > 0] - 1
            j = j[is_s[j]]
            if len(j):
                put, letter, rank, size = ranked(j)
                tail -= size
                sa[(tail + size)[letter] - 1 - rank] = put
    return sa


def _induce_by_place(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """The same in one loop over places, for strings of many letters."""
    b = _Buckets(s, letters)
    n = len(s)
    # Of each place: the letter before it if that starts an L- or an S-type suffix, else -1.
    # Place n stands for a slot that is still empty. The loops see what they fill in.
    before = np.append(np.roll(s, 1), -1)
    before_l, before_s = before.copy(), before.copy()
    before_l[1:n][is_s[:-1]] = -1
    before_s[1:n][~is_s[:-1]] = -1
    before_l[0] = before_s[0] = -1
    sa = [n] * n
    tail = b.end.tolist()
    for i, c in zip(lms[::-1].tolist(), s[lms[::-1]].tolist()):
        tail[c] -= 1
        sa[tail[c]] = i
    head, letter = b.start.tolist(), before_l.tolist()
    for i in sa:
        c = letter[i]
        if c >= 0:
            sa[head[c]] = i - 1
            head[c] += 1
    tail, letter = b.end.tolist(), before_s.tolist()
    for i in reversed(sa):
        c = letter[i]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = i - 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def _name(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the leftmost-S substrings, in text order; equal substrings share a name."""
    length = np.append(np.diff(lms) + 1, 1)
    place = np.empty(len(s), np.int64)
    place[lms] = np.arange(len(lms))
    k = place[order]
    same = np.zeros(len(k), bool)
    open_ = np.flatnonzero(length[k[1:]] == length[k[:-1]]) + 1
    step = 0
    while len(open_):
        a, b = order[open_ - 1] + step, order[open_] + step
        open_ = open_[s[a] == s[b]]
        step += 1
        full = step >= length[k[open_]]
        same[open_[full]] = True
        open_ = open_[~full]
    names = np.empty(len(k), np.int64)
    names[k] = np.cumsum(~same) - 1
    return names


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of integers ``s``; the last one must be 0 and the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    letters = int(s.max()) + 1
    is_s = _classify(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    induce = _induce_by_bucket if letters * 50 < n else _induce_by_place
    sa = induce(s, is_s, lms, letters)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names = _name(s, lms, order)
    if names.max() + 1 < len(lms):
        order = lms[suffix_array(names)]
    return induce(s, is_s, order, letters)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place, the length its suffix shares with the one before it in ``sa``.

    Where the letters before both are equal the value is that of the place before, less one;
    only the other (irreducible) values are counted letter by letter, four letters a step.
    """
    n = len(s)
    phi = np.empty(n, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    reducible = np.zeros(n, bool)
    inner = np.flatnonzero((phi > 0) & (np.arange(n) > 0))
    reducible[inner] = s[inner - 1] == s[phi[inner] - 1]
    letters = np.zeros(n + 4, np.uint64)
    letters[:n] = s
    quad = letters[:n] | letters[1 : n + 1] << np.uint64(16) | letters[2 : n + 2] << np.uint64(32) | letters[3 : n + 3] << np.uint64(48)
    value = np.zeros(n, np.int64)
    open_ = np.flatnonzero(~reducible & (phi >= 0))
    shift = 0
    while len(open_):
        differ = quad[open_ + shift] ^ quad[phi[open_] + shift]
        equal = differ == 0
        rest, gap = open_[~equal], differ[~equal]
        more = np.zeros(len(rest), np.int64)
        for bits in (16, 32, 48):
            more += (gap & np.uint64((1 << bits) - 1)) == 0
        value[rest] = shift + more
        open_ = open_[equal]
        shift += 4
    base = np.maximum.accumulate(np.where(reducible, -1, np.arange(n)))
    return value[base] - (np.arange(n) - base)
