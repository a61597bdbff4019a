"""Burkhard-Keller trees over 64-bit fingerprints, as flat arrays.

Many trees are built and asked together: a child hangs below its parent under their Hamming distance, and a search goes
only along edges whose distance differs from its own by the radius at most. Values of one tree must be distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_FAN = 65  # distances of 64-bit values run from 0 to 64
_STEP = 1 << 22  # visits that a block of searches may need at most, so that its frontier fits in memory


@dataclass
class Forest:
    values: np.ndarray  # uint64, by node
    roots: np.ndarray  # node of each tree's root
    edges: np.ndarray  # sorted parent * 65 + distance
    children: np.ndarray  # node below each edge
    sizes: np.ndarray  # nodes of each tree


def build(values: np.ndarray, tree: np.ndarray) -> Forest:
    """Trees over ``values``; ``tree`` numbers them from 0 without gaps and is sorted."""
    n = len(values)
    roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[roots, n])
    parent = np.repeat(roots, sizes)
    left = np.setdiff1d(np.arange(n), roots, assume_unique=True)
    edges, children = [], []
    while len(left):
        code = parent[left] * _FAN + np.bitwise_count(values[left] ^ values[parent[left]])
        distinct, first, member = np.unique(code, return_index=True, return_inverse=True)
        below = left[first]
        edges.append(distinct)
        children.append(below)
        placed = np.zeros(len(left), bool)
        placed[first] = True
        parent[left] = below[member]
        left = left[~placed]
    edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    order = np.argsort(edge, kind="stable")
    child = np.concatenate(children)[order] if children else np.zeros(0, np.int64)
    return Forest(values, roots, edge[order], child, sizes)


def search(forest: Forest, queries: np.ndarray, tree: np.ndarray, radius: int):
    """Yields (query number, node) arrays of all pairs within the radius, a block of searches at a time."""
    cost = np.cumsum(forest.sizes[tree]) // _STEP if len(queries) else np.zeros(0, np.int64)
    for rows in np.split(np.arange(len(queries)), np.flatnonzero(np.diff(cost)) + 1):
        node, query = forest.roots[tree[rows]], rows
        while len(query):
            apart = np.bitwise_count(queries[query] ^ forest.values[node]).astype(np.int64)
            near = apart <= radius
            if near.any():
                yield query[near], node[near]
            start = np.searchsorted(forest.edges, node * _FAN + np.maximum(apart - radius, 1), "left")
            stop = np.searchsorted(forest.edges, node * _FAN + np.minimum(apart + radius, 64), "right")
            many = stop - start
            query = np.repeat(query, many)
            at = np.repeat(start - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(len(query))
            node = forest.children[at]


class Links:
    """Keeps which of ``n`` things are linked, as a label per thing: the smallest number reachable."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, one: np.ndarray, other: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[one], label[other]
            apart = a != b
            if not apart.any():
                return
            one, other = one[apart], other[apart]
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(label, high, low)
            while not np.array_equal(jumped := label[label], label):
                label[:] = jumped

    def star(self) -> tuple[np.ndarray, np.ndarray]:
        """Every thing that is not its own label, and that label."""
        rest = np.flatnonzero(self.label != np.arange(len(self.label)))
        return rest, self.label[rest]
