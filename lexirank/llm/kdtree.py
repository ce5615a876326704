"""kd-trees over vectors of whole numbers, and the filtering form of Lloyd's step on them.

A node has the box, the sums and the count of its vectors. Going down the tree, each node keeps the codebook entries that
may be nearest to something in its box; where one is left, all the node's vectors go to it at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Vectors of a leaf.
LEAF = 24


@dataclass
class Tree:
    """points: in tree order; order: their rows; of node i: box lo[i], hi[i], sums[i], vectors first[i] up to stop[i], children left[i] and left[i] + 1, or left[i] = 0."""

    points: np.ndarray
    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    sums: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    left: np.ndarray

    ARRAYS = ("points", "order", "lo", "hi", "sums", "first", "stop", "left")


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree over rows of integers, cut at the median of the widest side; equal vectors aren't cut."""
    order = np.arange(len(points))
    first, stop, left, lo, hi = [0], [len(points)], [0], [], []
    at = 0
    while at < len(first):
        a, b = first[at], stop[at]
        own = points[order[a:b]]
        lo.append(own.min(axis=0))
        hi.append(own.max(axis=0))
        sides = hi[at] - lo[at]
        axis = int(sides.argmax())
        if b - a > leaf and sides[axis] > 0:
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], half)]
            left[at] = len(first)
            first += [a, a + half]
            stop += [a + half, b]
            left += [0, 0]
        at += 1
    ordered = points[order]
    until = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, axis=0, dtype=np.int64)])
    first, stop = np.array(first), np.array(stop)
    return Tree(ordered, order, np.array(lo), np.array(hi), until[stop] - until[first], first, stop, np.array(left))


def exact_kind(*arrays: np.ndarray) -> type:
    """Floats where they hold all squared distances exactly, which are faster; else integers."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return np.float64 if arrays[0].shape[-1] * (2 * most + 1) ** 2 * 4 < 2**53 else np.int64


@dataclass
class Assigned:
    """Nearest entry of each vector in tree order; sums and counts by entry; vectors that were held against entries one by one, times those entries."""

    nearest: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    compared: int


def assign(tree: Tree, entries: np.ndarray) -> Assigned:
    """Each vector's nearest entry, ties to the lower index.

    Entry z is out for a box if another, c, is nearer to its every point: |x-z|^2 - |x-c|^2 is linear in x and so has
    its minimum over the box in a corner. Where that is 0, z is out if its index is the higher one. All nodes of one
    depth are compared on at once.
    """
    kind = exact_kind(tree.points, entries)
    z = entries.astype(kind)
    norms = (z * z).sum(axis=1)
    nearest = np.zeros(len(tree.points), np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    nodes, alive, compared = np.zeros(1, np.int64), np.ones((1, len(entries)), bool), 0
    index = np.arange(len(entries))
    while len(nodes):
        lo, hi = tree.lo[nodes].astype(kind), tree.hi[nodes].astype(kind)
        middle = lo + hi  # twice the middle
        to_middle = np.where(alive, norms - middle @ z.T, np.iinfo(np.int64).max // 2)
        pivot = to_middle.argmin(axis=1)
        keep = np.zeros_like(alive)
        for row in range(len(nodes)):
            own = np.flatnonzero(alive[row])
            c = pivot[row]
            u = z[own] - z[c]
            corner = np.maximum(u * lo[row], u * hi[row]).sum(axis=1)
            least = norms[own] - norms[c] - 2 * corner
            keep[row, own[(least < 0) | ((least == 0) & (own <= c))]] = True
        single = keep.sum(axis=1) == 1
        only = keep.argmax(axis=1)
        ends = tree.left[nodes] == 0
        for node, entry in zip(nodes[single].tolist(), only[single].tolist()):
            nearest[tree.first[node] : tree.stop[node]] = entry
        np.add.at(sums, only[single], tree.sums[nodes[single]])
        np.add.at(counts, only[single], (tree.stop - tree.first)[nodes[single]])
        for row in np.flatnonzero(ends & ~single).tolist():
            node, own = nodes[row], index[keep[row]]
            a, b = tree.first[node], tree.stop[node]
            x = tree.points[a:b].astype(kind)
            got = own[(norms[own] - 2 * (x @ z[own].T)).argmin(axis=1)]
            compared += len(x) * len(own)
            nearest[a:b] = got
            np.add.at(sums, got, tree.points[a:b])
            counts += np.bincount(got, minlength=len(counts))
        down = np.flatnonzero(~ends & ~single)
        alive = np.repeat(keep[down], 2, axis=0)
        nodes = np.stack([tree.left[nodes[down]], tree.left[nodes[down]] + 1], axis=1).reshape(-1)
    return Assigned(nearest, sums, counts, compared)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    d = points.astype(np.int64) - entries.astype(np.int64)
    return (d * d).sum(axis=1)
