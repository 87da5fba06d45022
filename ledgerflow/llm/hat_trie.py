"""Counts of short sequences of numbers in a HAT-trie that hands out whole subtrees when it grows too large.

A key is a sequence of numbers below 2^BITS, packed into one. A leaf is a container, a hash table that counts what is left
of its keys. A container that grows beyond its limit bursts into a branch: numbers that share their leading digit share a
container, so containers stay large. Containers of single numbers never burst, so the trie is as shallow as its keys.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np

# Bits of a number, of which three fit in a 64-bit integer, and of a digit, by which branches branch.
BITS = 21
DIGIT = 7
DIGITS = BITS // DIGIT


class Branch(dict):
    """Children by leading digit: branches or containers."""


Tree = Branch | Counter


def packed(numbers: np.ndarray) -> np.ndarray:
    """Rows of an (n, size) array as keys; more than three numbers become Python's integers."""
    wide = numbers.astype(object) if numbers.shape[1] * BITS > 63 else numbers
    key = wide[:, 0]
    for column in range(1, numbers.shape[1]):
        key = (key << BITS) | wide[:, column]
    return key


def unpacked(keys: list[int], size: int) -> np.ndarray:
    """The numbers of every key, an (n, size) array."""
    array = np.array(keys, dtype=object if size * BITS > 63 else np.int64)
    columns = [(array >> (BITS * (size - 1 - i))) & ((1 << BITS) - 1) for i in range(size)]
    return np.stack(columns, axis=1).astype(np.int64) if len(keys) else np.zeros((0, size), np.int64)


def size_of(tree: Tree) -> int:
    return sum(map(size_of, tree.values())) if type(tree) is Branch else len(tree)


class HatTrie:
    """Counts of keys of `size` numbers; `burst` entries fit in a container and `most` in the whole."""

    def __init__(self, size: int, burst: int, most: int) -> None:
        self.digits, self.burst, self.most = size * DIGITS, burst, most
        self.root: Tree = Counter()
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        """Count every key of a sorted array once."""
        if len(keys):
            self.root = self.grown(self.root, keys, self.digits)

    def grown(self, tree: Tree, keys: np.ndarray, left: int) -> Tree:
        """`tree` with these keys, of which `left` digits remain; a container that has burst comes back as a branch."""
        if type(tree) is not Branch:
            before = len(tree)
            tree.update(keys.tolist())
            self.size += len(tree) - before
            return self.split(tree, left) if len(tree) > self.burst and left > DIGITS else tree
        shift = DIGIT * (left - 1)
        heads, rest = keys >> shift, keys & ((1 << shift) - 1)
        begins = np.append(0, np.flatnonzero(heads[1:] != heads[:-1]) + 1)
        for head, low, high in zip(heads[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(keys)], strict=True):
            child = tree.get(head)
            tree[head] = self.grown(Counter() if child is None else child, rest[low:high], left - 1)
        return tree

    def split(self, container: Counter, left: int) -> Branch:
        branch, shift = Branch(), DIGIT * (left - 1)
        mask = (1 << shift) - 1
        for key, count in container.items():
            head = key >> shift
            if head not in branch:
                branch[head] = Counter()
            branch[head][key & mask] = count
        return branch

    def entries(self, tree: Tree, left: int, lead: int = 0) -> tuple[list[int], list[int]]:
        """Keys and counts of a subtree with `left` digits below `lead`."""
        if type(tree) is not Branch:
            above = lead << (DIGIT * left)
            return [above | key for key in tree] if above else list(tree), list(tree.values())
        keys, counts = [], []
        for head, child in tree.items():
            more, ns = self.entries(child, left - 1, (lead << DIGIT) | head)
            keys += more
            counts += ns
        return keys, counts

    def spilled(self) -> Iterator[tuple[list[int], list[int]]]:
        """If there are too many entries: the largest subtrees, one at a time, until half of the room is free."""
        if self.size <= self.most:
            return
        if type(self.root) is not Branch:
            yield from self.drained()
            return
        sizes = sorted(((size_of(child), head) for head, child in self.root.items()), reverse=True)
        for size, head in sizes:
            if 2 * self.size <= self.most:
                break
            self.size -= size
            yield self.entries(self.root.pop(head), self.digits - 1, head)

    def drained(self) -> Iterator[tuple[list[int], list[int]]]:
        """All that is left, one subtree of the root at a time; the trie is empty afterwards."""
        root, self.root, self.size = self.root, Counter(), 0
        if type(root) is Branch:
            for head, child in root.items():
                yield self.entries(child, self.digits - 1, head)
        else:
            yield self.entries(root, self.digits)
