"""Trees as balanced parentheses: excess blocks with a min tree, findclose, ranks."""

from __future__ import annotations

import numpy as np

# Positions per block of the range min-max tree.
BLOCK = 64

# Opens whose blocks are looked through at once.
_SLICE = 16_384


class Parentheses:
    """A tree in preorder as a sequence of 1 (open) and 0 (close), with the excess of opens behind every position.

    The sequence is cut into blocks; a binary tree over the blocks holds the least excess
    below each of its nodes, so that the close of an open is found in its own block or by one
    climb and one descent.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits = np.asarray(bits, np.int8)
        excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        blocks = max(1, -(-len(bits) // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = excess
        self.excess = padded.reshape(blocks, BLOCK)
        self.least = [self.excess.min(axis=1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = self.least[-1] = np.append(below, np.iinfo(np.int64).max)
            self.least.append(below.reshape(-1, 2).min(axis=1))
        self.opens = np.flatnonzero(bits)
        pair = np.zeros(len(bits), bool)
        pair[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.is_leaf = pair[self.opens]

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The position of the close of each open."""
        return np.concatenate([self._find_close(opens[k : k + _SLICE]) for k in range(0, len(opens), _SLICE)] or [opens])

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        block, inside = opens // BLOCK, opens % BLOCK
        target = self.excess[block, inside] - 1
        hit = (self.excess[block] <= target[:, None]) & (np.arange(BLOCK) > inside[:, None])
        found = np.where(hit.any(axis=1), block * BLOCK + hit.argmax(axis=1), -1)
        at = np.flatnonzero(found < 0)
        if len(at):
            home = self._next_block(block[at], target[at])
            found[at] = home * BLOCK + (self.excess[home] <= target[at][:, None]).argmax(axis=1)
        return found

    def _next_block(self, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block after each whose least excess is at most the target."""
        node, level = node.copy(), np.full(len(node), -1)
        for k, least in enumerate(self.least):
            beside = np.minimum(node + 1, len(least) - 1)
            stop = (level < 0) & (node % 2 == 0) & (beside > node) & (least[beside] <= target)
            node[stop], level[stop] = node[stop] + 1, k
            node[level < 0] //= 2
        for k in range(len(self.least) - 1, 0, -1):
            down = level == k
            left = 2 * node[down]
            node[down] = np.where(self.least[k - 1][left] <= target[down], left, left + 1)
            level[down] = k - 1
        return node

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every node, by preorder number: the first number of its subtree and the one behind its last."""
        close = self.find_close(self.opens)
        first = np.arange(len(self.opens))
        return first, first + (close - self.opens + 1) // 2


def range_sums(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums over ranges from one cumulative array."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[end] - total[first]


def range_least(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least values of non-empty ranges, from the least of all stretches of 1, 2, 4 ... values, one level at a time."""
    out = np.empty(len(first), values.dtype)
    width = np.floor(np.log2(np.maximum(end - first, 1))).astype(np.int64)
    least = values
    for k in range(int(width.max()) + 1 if len(width) else 0):
        at = width == k
        out[at] = np.minimum(least[first[at]], least[end[at] - (1 << k)])
        least = np.minimum(least[: len(least) - (1 << k)], least[1 << k :]) if len(least) > 1 << k else least
    return out
