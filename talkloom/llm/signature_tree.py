"""A signature tree over token sets: bitmaps and size ranges that rule out whole pairs of nodes.

Sets stand in the leaves in a given order (neighbours alike); a node over ``FAN``
children holds the OR of their bitmaps, the range of their sizes and the most tokens one of
them has beyond its bits. Two sets with Jaccard similarity of num / den or more share at
least num / (num + den) of their joint size, and what two sets under a node pair share
is at most the common bits of the node bitmaps plus that excess. Traversal
goes down only where this maximum reaches the least overlap, sizes allow it, and the
nodes are not already one component.
"""

from __future__ import annotations

import numpy as np

BITS = 2048
FAN = 8
PAIRS_AT_ONCE = 1 << 13


def bitmaps(sets: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """One row of uint64 words per set."""
    out = np.zeros((len(sets), bits // 64), np.uint64)
    if sets:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        place = (np.concatenate(sets) >> np.uint64(20)) % np.uint64(bits)
        np.bitwise_or.at(out, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
    return out


class UnionFind:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        p = self.parent
        while not np.array_equal(p, up := p[p]):
            p = up
        self.parent = p
        return p


class Tree:
    def __init__(self, maps: np.ndarray, sizes: np.ndarray, num: int = 3, den: int = 4):
        self.num, self.den = num, den
        excess = sizes - np.bitwise_count(maps).sum(1, dtype=np.int64)
        self.levels = [(maps, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > FAN:
            maps, low, high, excess = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))

    def possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether a pair of sets under the nodes can reach the similarity."""
        maps, low, high, excess = self.levels[level]
        fit = (self.den * high[i] >= self.num * low[j]) & (self.den * high[j] >= self.num * low[i])
        out = np.zeros(len(i), bool)
        some = np.flatnonzero(fit)
        a, b = i[some], j[some]
        common = np.bitwise_count(maps[a] & maps[b]).sum(1, dtype=np.int64) + np.minimum(excess[a], excess[b])
        most = np.minimum(common, np.minimum(high[a], high[b]))
        out[some] = (self.num + self.den) * most >= self.num * (low[a] + low[b])
        return out

    def uniform(self, roots: np.ndarray) -> list[np.ndarray]:
        """Per level and node: the component all its leaves share, or -1."""
        out = [roots]
        for maps, *_ in self.levels[1:]:
            at = np.arange(0, len(out[-1]), FAN)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, low, -1))
        return out

    def pairs(self, components=None):
        """Batches (i, j) of leaves, i < j, that may be similar and are not yet one component.

        ``components`` gives the roots of the leaves now; without it no pair is skipped for that.
        """
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        i, j = np.triu_indices(n)
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS_AT_ONCE:
                stack.append((level, i[PAIRS_AT_ONCE:], j[PAIRS_AT_ONCE:]))
                i, j = i[:PAIRS_AT_ONCE], j[:PAIRS_AT_ONCE]
            if components is not None:
                one = self.uniform(components())[level]
                apart = (one[i] != one[j]) | (one[i] < 0)
                i, j = i[apart], j[apart]
            may = self.possible(level, i, j)
            i, j = i[may], j[may]
            if not len(i):
                continue
            if level == 0:
                yield i[i < j], j[i < j]
                continue
            below = len(self.levels[level - 1][0])
            ci = (i[:, None, None] * FAN + np.arange(FAN)[None, :, None]).repeat(FAN, 2).ravel()
            cj = (j[:, None, None] * FAN + np.arange(FAN)[None, None, :]).repeat(FAN, 1).ravel()
            keep = (ci <= cj) & (ci < below) & (cj < below)
            stack.append((level - 1, ci[keep], cj[keep]))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    spot = np.searchsorted(b, a)
    spot[spot == len(b)] = 0
    return int((b[spot] == a).sum()) if len(b) else 0


def similar(a: np.ndarray, b: np.ndarray, num: int = 3, den: int = 4) -> bool:
    shared = overlap(a, b)
    return den * shared >= num * (len(a) + len(b) - shared)


def link(sets: list[np.ndarray], num: int = 3, den: int = 4) -> np.ndarray:
    """The component (smallest position) of every set: all links between the sets are honoured."""
    found = UnionFind(len(sets))
    for i in range(len(sets) - 1):  # neighbours first: most of a group becomes one component at once
        if similar(sets[i], sets[i + 1], num, den):
            found.join(i, i + 1)
    sizes = np.array([len(s) for s in sets], np.int64)
    tree = Tree(bitmaps(sets), sizes, num, den)
    for i, j in tree.pairs(found.roots):
        for at in range(0, len(i), 512):
            roots = found.roots()
            a, b = i[at : at + 512], j[at : at + 512]
            apart = roots[a] != roots[b]
            for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                if found.root(x) != found.root(y) and similar(sets[x], sets[y], num, den):
                    found.join(x, y)
    return found.roots()
