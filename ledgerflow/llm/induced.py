"""Suffix order and common prefixes of one text by external induced sorting.

The suffixes that begin a descent to the left (the seeds) are put in order by recursion on a shorter text of names; from
them the order of all others is induced by two scans, one upward over the descending suffixes, one downward over the
ascending ones. A scan is a priority queue: it takes the smallest suffixes that are known, and each hands its left
neighbour in the text to the queue. As a suffix is only ever followed by larger ones, the queue is a row of buckets in
which tuples (position, common prefix with the tuple before) keep the order of their arrival.

Buckets are taken many at a time: a run of buckets is ready at once if no suffix of it hands over into it, except to its
own symbol, which is done in rounds. So all work is on arrays. Tuples beyond a memory limit wait in files, and so do a
text beyond it and its runs. Positions, names and common prefixes stay in memory, so a text must be bounded by the caller.

Common prefixes travel with the tuples: left neighbours that share their symbol have one more than the least common
prefix between their right neighbours.
"""

from __future__ import annotations

import os
from tempfile import TemporaryDirectory

import numpy as np

from ledgerflow.llm.arrays import mixed

# Bytes of one queue, or of one array, that may stay in memory.
MEMORY_BYTES = 64 << 20
# Suffixes are compared by lanes of four symbols, so many lanes of so many pairs at once.
BLOCK_LANES, PAIRS = 8, 1 << 13


class Scratch:
    """Arrays and files of one task, removed when it ends or fails."""

    def __init__(self, memory: int = MEMORY_BYTES) -> None:
        self.memory = memory
        self.folder: TemporaryDirectory | None = None
        self.files = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        if self.folder is not None:
            self.folder.cleanup()

    def path(self) -> str:
        if self.folder is None:
            self.folder = TemporaryDirectory(prefix="suffixes-")
        self.files += 1
        return os.path.join(self.folder.name, str(self.files))

    def room(self, n: int, dtype: type) -> np.ndarray:
        """An array of n entries, in a file if it is large."""
        if n * np.dtype(dtype).itemsize <= self.memory:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))


def changes(values: np.ndarray) -> np.ndarray:
    """Places whose value differs from the one before."""
    return (values[1:] != values[:-1]).nonzero()[0] + 1


class BucketQueue:
    """Tuples in numbered buckets, first in first out; buckets are emptied in one direction.

    Far buckets are kept in groups, each a list of blocks or, beyond the memory limit, a file; a group is dealt to its
    buckets when the first of them is due.
    """

    def __init__(self, n_buckets: int, scratch: Scratch) -> None:
        self.width = max(1, int(np.sqrt(n_buckets)))
        self.scratch = scratch
        self.far: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, str] = {}
        self.near: dict[int, list[np.ndarray]] = {}
        self.group = -1
        self.held = 0

    def push(self, bucket: np.ndarray, tuples: np.ndarray) -> None:
        """`tuples` has columns; buckets rise or fall along the block."""
        if not len(bucket):
            return
        groups = bucket // self.width
        cuts = changes(groups)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)], strict=True):
            group = int(groups[a])
            block = np.concatenate([bucket[None, a:b], tuples[:, a:b]])
            if group == self.group:
                self._deal(block)
            else:
                self.far.setdefault(group, []).append(block)
                self.held += block.nbytes
        if self.held > self.scratch.memory:
            for group, blocks in self.far.items():
                path = self.files.setdefault(group, self.scratch.path())
                with open(path, "ab") as file:
                    for block in blocks:
                        np.ascontiguousarray(block.T).tofile(file)
            self.far, self.held = {}, 0

    def _deal(self, block: np.ndarray) -> None:
        cuts = changes(block[0])
        if len(cuts):
            block = block[:, block[0].argsort(kind="stable")]
            cuts = changes(block[0])
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), block.shape[1]], strict=True):
            self.near.setdefault(int(block[0, a]), []).append(block[1:, a:b])

    def take(self, bucket: int, columns: int) -> np.ndarray:
        group = bucket // self.width
        if group != self.group:
            self.group, self.near = group, {}
            blocks = self.far.pop(group, [])
            self.held -= sum(b.nbytes for b in blocks)
            if group in self.files:
                path = self.files.pop(group)
                blocks.insert(0, np.fromfile(path, np.int64).reshape(-1, columns + 1).T)
                os.remove(path)
            if blocks:
                self._deal(np.concatenate(blocks, axis=1))
        blocks = self.near.pop(bucket, [])
        return np.concatenate(blocks, axis=1) if blocks else np.zeros((columns, 0), np.int64)


class Minima:
    """Least value between two places of an array, from minima over spans of powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first..last, both included."""
        result = np.empty(len(first), np.int64)
        level = np.floor(np.log2(last - first + 1)).astype(np.int64)
        for i in np.unique(level):
            at = np.flatnonzero(level == i)
            values = self.levels[i]
            result[at] = np.minimum(values[first[at]], values[last[at] - (1 << int(i)) + 1])
        return result


def runs_ready(symbols: np.ndarray, right: np.ndarray, size: int, upward: bool) -> np.ndarray:
    """Batch number of every symbol: buckets of one batch hand nothing to each other.

    `symbols` are the symbols of left neighbours, `right` those of the suffixes that hand them over.
    """
    if not upward:
        symbols, right = size - 1 - symbols, size - 1 - right
    nearest = np.full(size, size, np.int64)
    apart = symbols > right
    np.minimum.at(nearest, right[apart], symbols[apart])
    bound = np.minimum.accumulate(nearest[::-1])[::-1]
    begins, at = [], 0
    while at < size:
        begins.append(at)
        at = max(at + 1, int(bound[at]))
    number = np.zeros(size, np.int64)
    number[begins] = 1
    number = np.cumsum(number) - 1
    return number if upward else number[::-1]


def scan(
    text: np.ndarray,
    wanted: np.ndarray,
    seeds: np.ndarray,
    seed_prefix: np.ndarray | None,
    run: np.ndarray | None,
    size: int,
    upward: bool,
    cap: int,
    scratch: Scratch,
) -> tuple[np.ndarray, np.ndarray | None]:
    """The suffixes marked `wanted` in the order of the scan, with their common prefixes if `run` is given.

    `seeds` are the other suffixes that hand over, in order of the scan: in each bucket they follow the wanted ones.
    `run` is the length of the run of one symbol that begins at each position. Symbols are taken one at a time if
    common prefixes are asked for.
    """
    positions = np.flatnonzero(wanted[:-1])
    left, right = text[positions].astype(np.int64), text[positions + 1].astype(np.int64)
    if run is None:
        batch_of = runs_ready(left, right, size, upward)
    else:
        batch_of = np.arange(size) if upward else np.arange(size)[::-1]
    del positions, left, right
    n_batches = int(batch_of.max()) + 1
    queue = BucketQueue(n_batches, scratch)
    columns = 1 if run is None else 2
    seed_batches = batch_of[text[seeds]]
    seed_cuts = np.searchsorted(seed_batches, np.arange(n_batches + 1))
    met = np.zeros(size, bool)
    out, out_prefix = [], []
    for batch in range(n_batches):
        found = queue.take(batch, columns)
        own = slice(seed_cuts[batch], seed_cuts[batch + 1])
        if not found.shape[1] and own.start == own.stop:
            continue
        # Suffixes whose left neighbour has the same symbol hand over into their own bucket, round by round.
        rounds, prefixes = [found[0]], [found[1]] if run is not None else []
        while len(rounds[-1]):
            last = rounds[-1]
            before = last - 1
            same = ((last > 0) & wanted[before] & (text[before] == text[last])).nonzero()[0]
            if not len(same):
                break
            rounds.append(before[same])
            if run is not None:
                prefix = np.full(len(same), len(rounds) - 1, np.int64)
                if len(same) > 1:
                    prefix[1:] = 1 + Minima(prefixes[-1]).between(same[:-1] + 1, same[1:])
                prefixes.append(np.minimum(prefix, cap))
        n_wanted = sum(map(len, rounds))
        sequence = np.concatenate([*rounds, seeds[own]])
        if run is None:
            # A batch of many buckets: bring them in order, wanted ones first in each.
            key = text[sequence].astype(np.int64)
            order = (key if upward else -key).argsort(kind="stable")
            sequence = sequence[order]
            out.append(sequence[order < n_wanted])
            prefix = None
        else:
            out.append(sequence[:n_wanted])
            out_prefix.append(np.concatenate(prefixes))
            prefix = np.concatenate([*prefixes, seed_prefix[own]])
            if 0 < n_wanted < len(sequence):
                prefix[n_wanted] = min(run[sequence[n_wanted - 1]], run[sequence[n_wanted]], cap)
        before = sequence - 1
        hands = ((sequence > 0) & wanted[before] & (text[before] != text[sequence])).nonzero()[0]
        if not len(hands):
            continue
        targets = before[hands]
        symbol = text[targets].astype(np.int64)
        order = batch_of[symbol].argsort(kind="stable")
        if run is None:
            queue.push(batch_of[symbol[order]], targets[order][None, :])
            continue
        symbol, source, targets = symbol[order], hands[order], targets[order]
        shared = met[symbol].astype(np.int64)
        follows = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        if len(follows):
            shared[follows] = 1 + Minima(prefix).between(source[follows - 1] + 1, source[follows])
        met[symbol] = True
        queue.push(batch_of[symbol], np.stack([targets, np.minimum(shared, cap)]))
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order, (np.concatenate(out_prefix) if out_prefix else np.zeros(0, np.int64)) if run is not None else None


def ascending(text: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(whether each suffix is smaller than its right neighbour, length of the run of its symbol from there)."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    lengths = np.diff(np.append(-1, ends))
    rises = np.append(text[ends[:-1] + 1] > text[ends[:-1]], True)
    up, run = scratch.room(n, bool), scratch.room(n, np.int32)
    up[:] = np.repeat(rises, lengths)
    run[:] = np.repeat(ends, lengths) - np.arange(n) + 1
    return up, run


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix in `order` with the one before, up to `cap`: four symbols first, then blocks of lanes."""
    result = np.zeros(len(order), np.int64)
    padded = np.zeros(len(text) + 4 * BLOCK_LANES, np.uint16)
    padded[: len(text)] = text
    lanes = np.ndarray((len(text) + 1, BLOCK_LANES), "<u8", padded, strides=(2, 8))
    for first in range(1, len(order), PAIRS):
        live = np.arange(first, min(first + PAIRS, len(order)))
        a, b = order[live - 1], order[live]
        done, width = 0, 1
        while len(live) and done < cap:
            x = lanes[np.minimum(a + done, len(text)), :width] ^ lanes[np.minimum(b + done, len(text)), :width]
            unlike = x != 0
            differs = unlike.any(axis=1)
            place = unlike[differs].argmax(axis=1)
            low = x[differs, place]
            low &= ~low + np.uint64(1)
            result[live[differs]] = done + 4 * place + (np.frexp(low.astype(np.float64))[1] - 1) // 16
            live, a, b = live[~differs], a[~differs], b[~differs]
            done, width = done + 4 * width, BLOCK_LANES
        result[live] = cap
    return np.minimum(result, cap)


def seed_order(text: np.ndarray, up: np.ndarray, size: int, scratch: Scratch) -> np.ndarray:
    """The seeds in order: sorted by the pieces up to the next seed, and where pieces are equal, by recursion."""
    seeds = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    if len(seeds) < 2:
        return seeds
    by_symbol = seeds[np.argsort(text[seeds], kind="stable")]
    down, _ = scan(text, ~np.asarray(up), by_symbol, None, None, size, True, 0, scratch)
    rising, _ = scan(text, up, down[::-1], None, None, size, False, 0, scratch)
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds] = True
    # The end mark has no right neighbour and is handed over by none; it is the smallest.
    pieces = np.append(len(text) - 1, rising[::-1][is_seed[rising[::-1]]])
    bounds = np.append(seeds, len(text))
    offset = np.arange(len(text) - seeds[0]) - np.repeat(seeds - seeds[0], np.diff(bounds))
    terms = text[seeds[0] :].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + offset.astype(np.uint64)
    content = np.add.reduceat(mixed(terms), seeds - seeds[0])
    length = np.diff(bounds).astype(np.uint64)
    closing = np.append(text[seeds[1:]].astype(np.uint64), np.uint64(0))
    content = mixed(content + mixed(length * np.uint64(0xD1342543DE82EF95) + closing))
    del terms, offset
    place = np.zeros(len(text), np.int64)
    place[seeds] = np.arange(len(seeds))
    rank = place[pieces]
    fresh = np.append(True, content[rank][1:] != content[rank][:-1])
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 == len(seeds):
        return pieces
    shorter = np.zeros(len(seeds), np.int64)
    shorter[rank] = names
    return seeds[suffix_order(shorter, int(names[-1]) + 1, scratch)]


def suffix_order(text: np.ndarray, size: int, scratch: Scratch) -> np.ndarray:
    """All suffixes of `text` in order; its symbols are 0 to size - 1, and the last is the only 0."""
    if len(text) < 2:
        return np.arange(len(text))
    up, _ = ascending(text, scratch)
    seeds = seed_order(text, up, size, scratch)
    down, _ = scan(text, ~np.asarray(up), seeds, None, None, size, True, 0, scratch)
    rising, _ = scan(text, up, down[::-1], None, None, size, False, 0, scratch)
    merged = np.concatenate([[len(text) - 1], down, rising[::-1]])
    return merged[np.argsort(text[merged], kind="stable")]


def sorted_suffixes(text: np.ndarray, size: int, cap: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before, up to `cap`)."""
    up, run = ascending(text, scratch)
    seeds = seed_order(text, up, size, scratch)
    down, down_prefix = scan(
        text, ~np.asarray(up), seeds, common_prefixes(text, seeds, cap), run, size, True, cap, scratch
    )
    # Downward, the prefix shared with the suffix before is the one its successor had upward.
    backward = np.append(0, down_prefix[:0:-1]) if len(down) else down_prefix
    rising, rising_prefix = scan(text, up, down[::-1], backward, run, size, False, cap, scratch)
    forward = np.append(0, rising_prefix[:0:-1]) if len(rising) else rising_prefix
    merged = np.concatenate([[len(text) - 1], down, rising[::-1]])
    prefix = np.concatenate([[0], down_prefix, forward])
    order = np.argsort(text[merged], kind="stable")
    merged, prefix = merged[order], prefix[order]
    # Where ascending suffixes follow descending ones of the same symbol, they share the shorter run.
    turn = np.flatnonzero(np.asarray(up)[merged[1:]] & ~np.asarray(up)[merged[:-1]]) + 1
    prefix[turn] = np.minimum(run[merged[turn]], run[merged[turn - 1]])
    change = np.flatnonzero(text[merged[1:]] != text[merged[:-1]]) + 1
    prefix[change] = 0
    return merged, np.minimum(prefix, cap)
