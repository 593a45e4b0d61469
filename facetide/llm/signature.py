"""Signature trees: nodes hold OR-combined token bitmaps and size ranges, and are searched against each other.

A set of n tokens has a bitmap of the next power of two bits at least; a token sets bit ``hash mod bits``. For sets a and b
every bit of a that b lacks stands for a token of a that b lacks, so

    |a & b| <= n_a - popcount(bits_a & ~bits_b) = (n_a - popcount(bits_a)) + popcount(bits_a & bits_b).

The right side, with the largest slack of a node and the OR of its bitmaps, bounds all sets below it. Nodes use bitmaps of
about a bit a token; pairs of sets that these leave open are held against bitmaps ``FINE`` times as long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
FINE = 8
#: Two sets are linked when 100 * overlap >= PERCENT * union.
PERCENT = 75


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least overlap with which sets of sizes a and b are linked."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    """Sets that are linked share a token among so many first ones, in any order of all tokens."""
    return n - (-(-PERCENT * n // 100)) + 1


def short_length(n: int) -> int:
    """Of the smaller of two linked sets, the shared token is among so many first ones."""
    return n - (-(-2 * PERCENT * n // (100 + PERCENT))) + 1


def bitmap(tokens: np.ndarray, per_token: int = 1) -> np.ndarray:
    """As 64-bit words, at least ``per_token`` bits a token."""
    bits = 64 * per_token
    while bits < per_token * len(tokens):
        bits *= 2
    at = tokens & np.uint64(bits - 1)
    flags = np.zeros(bits, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap as if made with fewer bits. Works on rows of bitmaps too."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


class Tree:
    """Levels of nodes over sets of one bitmap width; level 0 are the sets."""

    def __init__(self, at: np.ndarray, sizes: np.ndarray, labels: np.ndarray, least: np.ndarray, bits: np.ndarray):
        # Sets of one label lie together, so that nodes of one label need not be compared; within it sets with the same
        # least token, as sets that are alike often have. Labels of single sets say nothing.
        _, of, many = np.unique(labels, return_inverse=True, return_counts=True)
        order = np.lexsort((sizes, least, np.where(many[of] > 1, of, -1)))
        self.at = at[order]
        sizes, labels, bits = sizes[order], labels[order], bits[order]
        self.sizes, self.fine = sizes, bits
        self.fine_slack = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        bits = folded(bits, bits.shape[1] // FINE)
        slack = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, slack, labels, labels)]
        while len(self.levels[-1][1]) > FANOUT:
            bits, low, high, slack, first, last = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                np.maximum.reduceat(slack, cut), np.minimum.reduceat(first, cut), np.maximum.reduceat(last, cut)))

    def children(self, level: int, node: int) -> np.ndarray:
        """Nodes one level down; of the top, all nodes of its level."""
        if level == len(self.levels):
            return np.arange(len(self.levels[-1][1]))
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][1])))


def _open(a: Tree, x: np.ndarray, b: Tree, y: np.ndarray, level_a: int, level_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes that may hold linked sets of different labels."""
    bits_a, low_a, high_a, slack_a, first_a, last_a = (v[x][:, None] for v in a.levels[level_a])
    bits_b, low_b, high_b, slack_b, first_b, last_b = (v[y][None, :] for v in b.levels[level_b])
    both = np.bitwise_count(bits_a & bits_b).sum(axis=2).astype(np.int64)
    most = np.minimum(np.minimum(slack_a, slack_b) + both, np.minimum(high_a, high_b))
    ok = (most >= needed(low_a, low_b)) & (100 * high_a >= PERCENT * low_b) & (100 * high_b >= PERCENT * low_a)
    ok &= ~((first_a == last_a) & (first_b == last_b) & (first_a == first_b))
    i, j = np.nonzero(ok)
    return x[i], y[j]


def pairs(a: Tree, b: Tree, rng: np.random.Generator, done: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the sets whose pairs cannot be ruled out, some at a time in random order; each pair of one tree with itself
    once. With ``done`` pairs of places that both are done are left out where that saves work."""
    same = a is b
    stack = [(len(a.levels), 0, len(b.levels), 0)]
    while stack:
        level_a, node_a, level_b, node_b = stack.pop()
        # From the tops, then the taller side goes down first.
        down_a = level_a == len(a.levels) or level_a >= level_b and level_a > 0
        down_b = level_b == len(b.levels) or level_b >= level_a and level_b > 0
        x = a.children(level_a, node_a) if down_a else np.array([node_a])
        y = b.children(level_b, node_b) if down_b else np.array([node_b])
        la, lb = level_a - down_a, level_b - down_b
        if done is not None and la == lb == 0 and done[a.at[x]].all() and done[b.at[y]].all():
            continue
        i, j = _open(a, x, b, y, la, lb)
        if same:
            half = i <= j
            i, j = i[half], j[half]
        if la == lb == 0 and len(i):
            both = np.bitwise_count(a.fine[i] & b.fine[j]).sum(axis=1).astype(np.int64)
            ok = np.minimum(a.fine_slack[i], b.fine_slack[j]) + both >= needed(a.sizes[i], b.sizes[j])
            if same:
                ok &= i != j
            i, j = i[ok], j[ok]
        order = rng.permutation(len(i))
        i, j = i[order], j[order]
        if la == lb == 0:
            if len(i):
                yield a.at[i], b.at[j]
        else:
            stack.extend((la, p, lb, q) for p, q in zip(i.tolist(), j.tolist()))


def candidates(sizes: np.ndarray, least: np.ndarray, bits: list[np.ndarray], labels: np.ndarray, side: np.ndarray | None = None,
               seed: int = 0, done: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of sets, of different labels, that may be linked, by sizes, least tokens and ``FINE`` bitmaps. With ``side``
    (0 or 1), only pairs of both sides.

    Linked sizes are within a third of each other, so bitmap widths are equal or neighbours.
    """
    rng = np.random.default_rng(seed)
    width = np.array([len(b) for b in bits])
    sides = np.zeros(len(width), int) if side is None else side
    groups = {(w, s): np.flatnonzero((width == w) & (sides == s)) for w in set(width.tolist()) for s in set(sides.tolist())}
    groups = {k: v for k, v in groups.items() if len(v)}

    def tree(at: np.ndarray, w: int) -> Tree:
        return Tree(at, sizes[at], labels[at], least[at], folded(np.stack([bits[i] for i in at]), w))

    trees = {k: tree(v, k[0]) for k, v in groups.items()}
    for (w, s), own in trees.items():
        if side is None:
            yield from pairs(own, own, rng, done)
        elif s == 0 and (w, 1) in trees:
            yield from pairs(own, trees[(w, 1)], rng, done)
        for t in ({0} if side is None else {1 - s}):
            if (2 * w, t) in trees:
                yield from pairs(own, tree(groups[(2 * w, t)], w), rng, done)


def may_link(sizes: np.ndarray, least: np.ndarray, bits: list[np.ndarray], labels: np.ndarray,
             side: np.ndarray | None = None) -> np.ndarray:
    """Which sets may be linked with one of another label at all."""
    found = np.zeros(len(sizes), bool)
    for i, j in candidates(sizes, least, bits, labels, side, 0, found):
        found[i] = True
        found[j] = True
    return found


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are linked, by all their tokens."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(both) - shared)


def links(labels: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None, seed: int = 0,
          every: bool = False) -> Iterator[tuple[int, int]]:
    """Places of linked sets of different labels, verified: all, or only those that join groups that were apart."""
    sizes, least = np.array([len(s) for s in sets]), np.array([s[0] for s in sets])
    some = candidates(sizes, least, [bitmap(s, FINE) for s in sets], labels, side, seed)
    found = ((i, j) for x, y in some for i, j in zip(x.tolist(), y.tolist()))
    if every:
        return ((i, j) for i, j in found if linked(sets[i], sets[j]))
    return forest(found, labels, lambda i, j: linked(sets[i], sets[j]))


def forest(found: Iterator[tuple[int, int]], labels: np.ndarray, holds=lambda i, j: True) -> Iterator[tuple[int, int]]:
    """Of pairs of places for which ``holds`` is true only those that join groups: fewer than there are groups."""
    parent = {label: label for label in labels.tolist()}
    apart = len(parent)
    if apart < 2:
        return

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in found:
        x, y = top(int(labels[i])), top(int(labels[j]))
        if x != y and holds(i, j):
            parent[y] = x
            yield i, j
            apart -= 1
            if apart == 1:
                return
