"""Self-join of 128-bit signatures within blocks, on binary tries.

The signatures of a block, sorted, are the leaves of a binary trie: a node is a
range of the sorted array and its children are told apart by one bit.  Pairs of
nodes are taken through the levels together, their differing bits add up, and a
pair whose sum exceeds the budget is dropped with everything below it.  All
blocks of a partition go through a level at once.  A node of up to ``LEAF`` rows
is not divided: pairs of such nodes are compared by all their bits at once.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
CHUNK = 1 << 20


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int32)


def trie_join(block: np.ndarray, s0: np.ndarray, s1: np.ndarray, budget: int, part: np.ndarray | None = None, comp: np.ndarray | None = None, left: np.ndarray | None = None, right: np.ndarray | None = None):
    """Index pairs (i, j) of one block whose signatures differ in at most ``budget`` bits, each once.

    With ``part`` (0 or 1 per row) only pairs of different parts are returned, with
    ``comp`` only pairs of different components, with ``left`` and ``right`` (flags)
    only pairs with one of each.  Node pairs without such a pair are dropped whole.
    Yields pairs of index arrays; rows need not be sorted.
    """
    order = np.argsort(block)
    blk = block[order]
    edge = np.flatnonzero(np.concatenate(([True], blk[1:] != blk[:-1]))) if blk.size else np.empty(0, np.int64)
    lo, hi = edge, np.concatenate((edge[1:], [blk.size])) if edge.size else edge
    # only what is divided need be sorted by its bits
    at = np.flatnonzero(np.repeat(hi - lo > LEAF, hi - lo))
    if at.size:
        own = order[at]
        keys = (s1[own].view(np.uint64), s0[own].view(np.uint64), blk[at])
        order[at] = own[np.lexsort(keys if comp is None else (comp[own], *keys))]
    a, b = s0[order].view(np.uint64), s1[order].view(np.uint64)
    keep = hi - lo > 1
    lo, hi = lo[keep], hi[keep]
    side = None if part is None else part[order]
    own = None if comp is None else comp[order]
    changes = None if comp is None else np.concatenate(([0], np.cumsum(own[1:] != own[:-1]))) if own.size else own
    flags = None if left is None else (left[order].astype(bool), right[order].astype(bool))
    sums = None if flags is None else tuple(np.concatenate(([0], np.cumsum(f))) for f in flags)

    def wanted(l1, h1, l2, h2):
        """Node pairs below which a pair can be that is asked for."""
        ok = np.ones(l1.size, bool)
        if own is not None:
            ok &= ~((changes[h1 - 1] == changes[l1]) & (changes[h2 - 1] == changes[l2]) & (own[l1] == own[l2]))
        if sums is not None:
            a1, b1, a2, b2 = (x[h] > x[l] for h, l in ((h1, l1), (h2, l2)) for x in sums)
            ok &= (a1 & b2) | (b1 & a2)
        return ok

    keep = wanted(lo, hi, lo, hi)
    lo, hi = lo[keep], hi[keep]
    stack = [(0, lo, hi, lo, hi, np.zeros(lo.size, np.int32))]
    ones_at: dict[int, np.ndarray] = {}

    def ones(d: int) -> np.ndarray:
        if d not in ones_at:
            if len(ones_at) > 8:
                ones_at.clear()
            w = a if d < 64 else b
            ones_at[d] = np.concatenate(([0], np.cumsum((w >> np.uint64(63 - d % 64)) & np.uint64(1)))).astype(np.int64)
        return ones_at[d]

    while stack:
        d, l1, h1, l2, h2, diff = stack.pop()
        if l1.size > CHUNK:
            for s in range(0, l1.size, CHUNK // 2):
                e = slice(s, s + CHUNK // 2)
                stack.append((d, l1[e], h1[e], l2[e], h2[e], diff[e]))
            continue
        small = (h1 - l1 <= LEAF) & (h2 - l2 <= LEAF) | (d >= 128)
        if small.any():
            yield from _leaves(l1[small], h1[small], l2[small], h2[small], a, b, budget, side, own, flags, order)
            rest = ~small
            l1, h1, l2, h2, diff = l1[rest], h1[rest], l2[rest], h2[rest], diff[rest]
        if not l1.size:
            continue
        c = ones(d)
        m1, m2 = h1 - (c[h1] - c[l1]), h2 - (c[h2] - c[l2])
        cross = l1 != l2
        parts = [(l1, m1, l2, m2, diff), (m1, h1, m2, h2, diff), (l1, m1, m2, h2, diff + 1), (m1[cross], h1[cross], l2[cross], m2[cross], diff[cross] + 1)]
        n1, e1, n2, e2, df = (np.concatenate(x) for x in zip(*parts))
        live = (e1 > n1) & (e2 > n2) & (df <= budget) & ~((n1 == n2) & (e1 - n1 == 1))
        n1, e1, n2, e2, df = n1[live], e1[live], n2[live], e2[live], df[live]
        if own is not None or sums is not None:
            live = wanted(n1, e1, n2, e2)
            n1, e1, n2, e2, df = n1[live], e1[live], n2[live], e2[live], df[live]
        stack.append((d + 1, n1, e1, n2, e2, df))


def _leaves(l1, h1, l2, h2, a, b, budget, side, comp, flags, order):
    """All pairs below small node pairs, by counting the differing bits at once."""
    for s in range(0, l1.size, CHUNK // 16):
        e = slice(s, s + CHUNK // 16)
        p, q, r, t = l1[e], h1[e], l2[e], h2[e]
        n2 = t - r
        cnt = (q - p) * n2
        own = np.repeat(np.arange(p.size), cnt)
        k = np.arange(own.size) - np.repeat(np.cumsum(cnt) - cnt, cnt)
        i, j = p[own] + k // n2[own], r[own] + k % n2[own]
        ok = (p[own] != r[own]) | (i < j)
        if side is not None:
            ok &= side[i] != side[j]
        if comp is not None:
            ok &= comp[i] != comp[j]
        if flags is not None:
            ok &= (flags[0][i] & flags[1][j]) | (flags[1][i] & flags[0][j])
        i, j = i[ok], j[ok]
        near = _popcount(a[i] ^ a[j]) + _popcount(b[i] ^ b[j]) <= budget
        if near.any():
            yield order[i[near]], order[j[near]]
