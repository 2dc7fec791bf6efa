"""Suffix arrays by induced sorting, and capped common prefixes in text order, in numpy.

The two induction sweeps go symbol by symbol. All suffixes of a symbol that are known when its turn
comes are handled at once: first those whose predecessor has the same symbol, round by round, then
all predecessors in other buckets, placed by a stable sort. The work is linear but for the sorts.
"""

from __future__ import annotations

import numpy as np

SWEEP_SYMBOLS = 2048  # reduced texts with more symbols are sorted by doubling ranks instead


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (values below ``symbols``) in ascending order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    if symbols > SWEEP_SYMBOLS:
        return _doubling(text)
    smaller = _types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    end = np.cumsum(np.bincount(text, minlength=symbols))
    if len(lms) > 1:
        order = _induce(text, symbols, end, lms)
        chosen = np.zeros(n, bool)
        chosen[lms] = True
        order = order[chosen[order]]
        names = _names(text, lms, order)
        top = int(names.max()) + 1
        lms = lms[np.argsort(names) if top == len(lms) else suffix_array(names, top)]
    return _induce(text, symbols, end, lms)


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; runs take the type of their last place."""
    n = len(text)
    last = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # of each run
    kind = np.append(text[last[:-1]] < text[last[:-1] + 1], False)
    return np.repeat(kind, np.diff(last, prepend=-1))


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks, in text order, of the substrings between leftmost-smaller places, given their order."""
    n = len(text)
    length = np.zeros(n, np.int64)
    length[lms] = np.append(np.diff(lms), n - lms[-1])  # the last one runs into the end of the text
    a, b = order[:-1], order[1:]
    same = (length[a] == length[b]) & (a != lms[-1]) & (b != lms[-1])
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        equal = text[a[live] + k] == text[b[live] + k]
        same[live[~equal]] = False
        live = live[equal]
        k += 1
        live = live[length[a[live]] >= k]
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~same)])
    return rank[lms]


def _place(sa: np.ndarray, at: np.ndarray, found: np.ndarray, symbol: np.ndarray, step: int) -> None:
    """Put suffixes into their buckets, in order, forwards from the heads or backwards from the tails."""
    order = np.argsort(symbol, kind="stable")
    s = symbol[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    count = np.diff(np.append(first, len(s)))
    sa[at[s] + step * (np.arange(len(s)) - np.repeat(first, count))] = found[order]
    at[s[first]] += step * count


def _induce(text: np.ndarray, symbols: int, end: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array induced from leftmost-smaller suffixes in the order given."""
    n = len(text)
    start = np.concatenate([[0], end[:-1]])
    sa = np.full(n, -1, np.int64)
    of = text[lms]
    by = np.argsort(of, kind="stable")
    seeds, cut = lms[by], np.searchsorted(of[by], np.arange(symbols + 1))
    head = start.copy()
    sa[head[text[n - 1]]] = n - 1  # the predecessor of the empty suffix
    head[text[n - 1]] += 1
    for c in range(symbols):
        lo = start[c]
        while True:  # rounds of predecessors with the same symbol
            hi = head[c]
            found = sa[lo:hi]
            found = found[found > 0] - 1
            found = found[text[found] == c]
            lo = hi
            if not len(found):
                break
            sa[hi : hi + len(found)] = found
            head[c] = hi + len(found)
        found = np.concatenate([sa[start[c] : head[c]], seeds[cut[c] : cut[c + 1]]])
        found = found[found > 0] - 1
        symbol = text[found]
        up = symbol > c
        if up.any():
            _place(sa, head, found[up], symbol[up], 1)
    tail = end - 1
    larger = head.copy()  # of each bucket, where its larger suffixes end
    for c in range(symbols - 1, -1, -1):
        hi = end[c] - 1
        while True:
            lo = tail[c]
            found = sa[lo + 1 : hi + 1][::-1]
            found = found[found > 0] - 1
            found = found[text[found] == c]
            hi = lo
            if not len(found):
                break
            sa[lo - len(found) + 1 : lo + 1] = found[::-1]
            tail[c] = lo - len(found)
        found = np.concatenate([sa[tail[c] + 1 : end[c]][::-1], sa[start[c] : larger[c]][::-1]])
        found = found[found > 0] - 1
        symbol = text[found]
        down = symbol < c
        if down.any():
            _place(sa, tail, found[down], symbol[down], -1)
    return sa


def _doubling(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text with many symbols: ranks of prefixes of doubling length, of which only
    those not yet alone are sorted again."""
    n, k = len(text), 1
    order = np.argsort(text, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # beyond the end
    first = np.concatenate([[True], text[order[1:]] != text[order[:-1]]])
    while True:
        head = np.flatnonzero(first)
        size = np.diff(np.append(head, n))
        rank[order] = np.repeat(head, size)
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            return order
        some = order[tied]
        key = rank[some] * (n + 1) + rank[np.minimum(some + k, n)] + 1
        by = np.argsort(key)
        order[tied], key = some[by], key[by]
        first[tied[1:]] = key[1:] != key[:-1]
        first[tied[0]] = True
        k *= 2


def permuted_lcp(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each place of a byte text, the common prefix with its predecessor in ``sa``, at most ``cap``.

    ``sa`` may hold some of the suffixes only; the others get 0. Places are compared eight bytes at a time, in text order, until they differ.
    """
    n = len(text)
    padded = np.zeros(n + cap + 16, np.uint8)
    padded[:n] = text
    word = np.ndarray(n + cap + 8, "<u8", padded, strides=(1,))
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    other = before[live]
    for k in range(0, cap, 8):
        x = word[live + k] ^ word[other + k]
        differ = x != 0
        low = x[differ]
        out[live[differ]] = k + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        live, other = live[~differ], other[~differ]
    out[live] = cap
    return np.minimum(np.minimum(out, cap), np.minimum(n - np.arange(n), np.where(before >= 0, n - before, 0)))
