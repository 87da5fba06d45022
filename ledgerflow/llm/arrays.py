"""Text columns as numpy arrays: words, word hashes, hashes of runs of words, sliding minima.

Everything here works on one Arrow batch inside a task. Hashes are 64 bits wide and depend on nothing but the bytes, so
they agree between tasks and machines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Word separators, fixed by the word pattern [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SEPARATORS)] = True

TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[ord("A") : ord("Z") + 1] += 32

# Everything but letters; bytes of longer characters count as letters.
IS_NO_LETTER = np.ones(256, dtype=bool)
IS_NO_LETTER[ord("A") : ord("Z") + 1] = IS_NO_LETTER[ord("a") : ord("z") + 1] = IS_NO_LETTER[128:] = False

# Odd multipliers of the mixing steps.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(32)

# Words longer than this are hashed one by one.
LONG_WORD = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output; works in place."""
    x ^= x >> SHIFT
    x *= SECOND
    x ^= x >> SHIFT
    x *= SECOND
    x ^= x >> SHIFT
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring pieces from the hashes of both."""
    return mixed(left * MULTIPLIER + right)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of n + 1 entries); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - first


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word in `data` and, per text, the number of words before it (n + 1 entries).

    `between` tells for each of the 256 bytes whether it separates words.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~between[data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = solid[cuts]
    ends[cuts - 1] = solid[cuts - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, from its bytes in lanes of eight."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    length = ends - starts
    value = lanes[starts] & masks[np.minimum(length, 8)]
    value = mixed(value * MULTIPLIER + length.astype(np.uint64))
    for done in range(8, LONG_WORD, 8):
        rest = np.flatnonzero((length > done) & (length <= LONG_WORD))
        if not len(rest):
            break
        lane = lanes[starts[rest] + done] & masks[np.minimum(length[rest] - done, 8)]
        value[rest] = joined(value[rest], lane)
    for i in np.flatnonzero(length > LONG_WORD):
        value[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return value


def hash_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` neighbours, by doubling; the result is `size - 1` entries shorter."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    result, covered, power, level = None, 0, 1, hashes
    while True:
        if size & power:
            piece = level[covered:]
            result = piece[: len(hashes) - size + 1].copy() if result is None else joined(
                result, piece[: len(hashes) - size + 1]
            )
            covered += power
        power *= 2
        if power > size:
            return mixed(result * MULTIPLIER + np.uint64(size))
        level = joined(level[: -(power // 2)], level[power // 2 :])


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of `size` neighbours, from prefix and suffix minima of blocks."""
    n = len(values)
    if n < size:
        return values[:0]
    if size == 1:
        return values.copy()
    padded = np.full(-(-n // size) * size, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])


def slices(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive ranges of texts with about `most` bytes each, one text at least."""
    result, first = [], 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        result.append((first, last))
        first = last
    return result
