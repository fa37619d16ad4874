"""A balanced search tree of bins by remaining capacity.

A treap: ordered by key, heap-ordered by a priority hashed from the bin, so its
expected depth is logarithmic and its shape does not depend on insertion order.
"""

from __future__ import annotations

from zlib import crc32


class _Node:
    __slots__ = ("key", "priority", "left", "right")

    def __init__(self, key):
        self.key, self.priority = key, crc32(str(key).encode())
        self.left = self.right = None


class BinTree:
    """Set of (remaining capacity, bin)."""

    def __init__(self):
        self._root = None

    def add(self, key: tuple[int, int]) -> None:
        below, above = self._split(self._root, key)
        self._root = self._merge(self._merge(below, _Node(key)), above)

    def pop_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest entry with at least ``size`` left."""
        below, above = self._split(self._root, (size, -1))
        if above is None:
            self._root = below
            return None
        first = above
        while first.left is not None:
            first = first.left
        _, rest = self._split(above, (first.key[0], first.key[1] + 1))
        self._root = self._merge(below, rest)
        return first.key

    def _split(self, node, key):
        """Trees of the entries below ``key`` and of the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, above = self._split(node.right, key)
            return node, above
        below, node.left = self._split(node.left, key)
        return below, node

    def _merge(self, a, b):
        """One tree of ``a`` and ``b``, all of ``a`` below ``b``."""
        if a is None or b is None:
            return a or b
        if a.priority >= b.priority:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> dict[int, int]:
    """Bin of each item (item, size): largest first, each into the fullest bin that still holds it.

    An item above the capacity gets a bin of its own.  Ties go by item.
    """
    bins, tree, n_bins = {}, BinTree(), 0
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        entry = tree.pop_tightest(size)
        if entry is None:
            entry, n_bins = (max(capacity, size), n_bins), n_bins + 1
        bins[item] = entry[1]
        tree.add((entry[0] - size, entry[1]))
    return bins
