"""Packing along a space-filling curve: neighbouring documents share a sequence.

A document's token ids are hashed into a vector, projected to three dimensions and put on a Hilbert curve. The corpus is
sorted by its place on the curve and cut every 2048 tokens, so only the very last sequence is padded. Where a document
begins follows from sums: tokens per range of the curve, then the running sum inside the range.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import mixed, slices, text_bytes
from ledgerflow.llm.frames import documents_of, lean, shuffle_width, staged

LENGTH = 2048
END = 1
DIMENSIONS = 3
CURVE_BITS = 10
TIE_BITS = 63 - DIMENSIONS * CURVE_BITS
HASHED = 64
# Tokens a range of the curve should hold: 128 MB, sorted by Spark; the driver holds a few numbers per range.
RANGE_TOKENS = 64_000_000
# Words whose ids a task remembers, twice over (about 50 MB each), and words it looks up at a time.
REMEMBERED = 120_000
LONGEST_REMEMBERED = 64
TOGETHER = 500
# Bytes of text that are encoded at once.
SLICE_BYTES = 1 << 21

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Characters beyond these may combine or change their case by context.
UNUSUAL = re.compile("[^\x00-\u02ff]")
# Classes of bytes: those without one may be parts of anything.
LETTER, DIGIT, MARK = 1, 2, 3
CLASSES = np.zeros(256, np.uint8)
CLASSES[0x21:0x7F] = MARK
CLASSES[ord("0") : ord("9") + 1] = DIGIT
CLASSES[ord("a") : ord("z") + 1] = LETTER
# The letters from \u00df to \u00ff have this byte first; their second byte, but for that of the sign \u00f7.
LEAD, SECONDS = 0xC3, np.array([b in range(0x9F, 0xC0) and b != 0xB7 for b in range(256)])
SPACE, LINE_FEED, APOSTROPHE = 0x20, 0x0A, 0x27


def inner_cuts(data: np.ndarray) -> np.ndarray:
    """Whether the vocabulary cuts between each byte and the one before, judged by these two alone.

    It cuts where letters, digits and marks meet, and around every digit; an apostrophe may belong to letters behind it.
    """
    kind = CLASSES[data]
    lead = np.flatnonzero(data[:-1] == LEAD)
    lead = lead[SECONDS[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = LETTER
    left, right = kind[:-1], kind[1:]
    cut = (left != right) & ((data[:-1] != APOSTROPHE) | (right != LETTER))
    cut |= right == DIGIT
    cut &= (left > 0) & (right > 0)
    return np.append(False, cut)


# The vocabulary's model spells bytes as printable characters: those that are none, in order, from 256 on. White space
# between words stays.
SPELLED = np.arange(256, dtype="<u4")
SPELLED[[b for b in range(256) if b < 33 or 126 < b < 161 or b == 173]] = 256 + np.arange(68)
SPELLED[SPACE] = SPACE


class WordTokenizer:
    """Ids of texts, word by word: this vocabulary never joins what a space or line feed separates.

    The vocabulary folds case and cuts letters, digits and marks apart, so texts of usual characters are brought to lower
    case and cut there before words are looked up; then far fewer of them differ. Words are told apart and put back in
    order by Arrow; Python sees the different ones of a slice alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The model alone, for words its earlier steps would leave as they are, and the ids that end a word.
        self.spelled = Tokenizer(self.tokenizer.model)
        self.spelled.pre_tokenizer = WhitespaceSplit()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True
        # Words met lately, and those of the time before.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give the memory of all words back."""
        self.known, self.older = {}, {}

    def cleaned(self, text: str | None) -> tuple[bytes, bool]:
        """(UTF-8, whether all characters are usual): usual texts are in lower case."""
        if not text:
            return b"", False
        usual = (text.isascii() or UNUSUAL.search(text) is None) and not any(s in text for s in self.special)
        return (text.lower() if usual else text).encode(), usual

    def words(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """All words of `texts` in order, and per text the number of words up to its end."""
        parts = [self.cleaned(text) for text in texts]
        if not parts:
            return pa.array([], pa.large_string()), np.zeros(0, np.int64)
        # A line feed behind every text parts it from the next one.
        data = np.frombuffer(b"\n".join([*(part for part, _ in parts), b""]), np.uint8)
        sizes = np.array([len(part) + 1 for part, _ in parts])
        ends = np.cumsum(sizes) - 1
        solid = (data != SPACE) & (data != LINE_FEED)
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        begins |= inner_cuts(data) & np.repeat([usual for _, usual in parts], sizes)
        starts = np.flatnonzero(begins)
        kept = data[solid]
        offsets = np.append(np.cumsum(solid)[starts] - 1, len(kept))
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        return words, np.searchsorted(starts, ends)

    def learn_spelled(self, words: list[str]) -> None:
        """Ids of words of usual small letters, from the model alone."""
        lines = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        lines = [SPELLED[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-32-le") for line in lines]
        found = self.spelled.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(words):
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.update(zip(words, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
            return
        # Not every word ends with an id that ends words only.
        tokenize = self.tokenizer.model.tokenize
        for word, spelling in zip(words, " ".join(lines).split(" "), strict=True):
            self.known[word] = np.array([t.id for t in tokenize(spelling)], "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Look up the ids of new words.

        Words of usual small letters go straight to the tokenizer's model, which is what its earlier steps leave of them.
        The others are encoded many in one text: where an id begins tells its word.
        """
        every = " ".join(words)
        # Almost always all words are usual and small; then one look at all of them together tells.
        usual = UNUSUAL.search(every) is None and every == every.lower()
        plain, others = [], []
        for word in words:
            small = word.isalpha() and (usual or (word == word.lower() and UNUSUAL.search(word) is None))
            (plain if small else others).append(word)
        if plain:
            self.learn_spelled(plain)
        words = others
        for first in range(0, len(words), TOGETHER):
            some = words[first : first + TOGETHER]
            encoding = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *[len(w) + 1 for w in some]])
            starts = np.fromiter((a for a, _ in encoding.offsets), np.int64, len(encoding.ids))
            cuts = np.searchsorted(starts, begins).tolist()
            ids = np.array(encoding.ids, "<u4")
            for word, low, high in zip(some, cuts[:-1], cuts[1:], strict=True):
                self.known[word] = ids[low:high].tobytes()

    def looked_up(self, words: list[str]) -> list[bytes]:
        """The ids of different words."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        result = list(map(known.get, words))
        missing = [i for i, ids in enumerate(result) if ids is None]
        new = [words[i] for i in missing]
        known.update((w, older[w]) for w in new if w in older)
        self.learn([w for w in new if w not in known])
        for i, word in zip(missing, new, strict=True):
            result[i] = known[word]
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del known[word]
        return result

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): per text its ids and the end mark, as little-endian unsigned 32-bit numbers."""
        words, counts = self.words(texts)
        coded = words.dictionary_encode()
        ids = self.looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        table = pa.array([*ids, np.array([END], "<u4").tobytes()], pa.large_binary())
        packed = table.take(pa.array(np.insert(np.asarray(coded.indices), counts, len(ids))))
        _, offsets, raw = packed.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(packed) + 1)
        ends = offsets[counts + np.arange(1, len(texts) + 1)] // 4
        return np.frombuffer(raw, "<u4", int(offsets[-1]) // 4), np.append(0, ends)


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def projection() -> np.ndarray:
    """Fixed directions, from hashes of their indices."""
    bits = mixed(np.arange(HASHED * DIMENSIONS, dtype=np.uint64) + np.uint64(1))
    return (bits.astype(np.float64) / 2.0**63 - 1.0).reshape(HASHED, DIMENSIONS)


def coordinates(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, DIMENSIONS): counts of hashed ids with length 1, projected."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    place = (mixed(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(HASHED)).astype(np.int64)[ids & 0xFFFF]
    counts = np.bincount(owner * HASHED + place, minlength=n * HASHED).reshape(n, HASHED).astype(np.float64)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)
    return counts @ projection()


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid points, an (n, dimensions) array of unsigned numbers of `bits` bits.

    The axes are untangled from the highest bit down (exchange or inversion by the bit's value), then Gray coded; the
    bits of all axes, interleaved, are the place.
    """
    axes = [points[:, d].astype(np.uint64) for d in range(points.shape[1])]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint64((1 << level) - 1)
        for axis in range(len(axes)):
            high = (axes[axis] >> np.uint64(level)) & one == one
            swap = np.where(high, np.uint64(0), (axes[0] ^ axes[axis]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if axis:
                axes[axis] = axes[axis] ^ swap
    for axis in range(1, len(axes)):
        axes[axis] = axes[axis] ^ axes[axis - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> np.uint64(level)) & one == one, turn ^ np.uint64((1 << level) - 1), turn)
    place = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << one) | (((axis ^ turn) >> np.uint64(level)) & one)
    return place


def stored_type(path: str) -> str:
    """Two bytes per id where the vocabulary allows it."""
    return "<u2" if tokenizer_at(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, stored: str) -> DataFrame:
    """(doc_id, ids, n, tie, x0, x1, x2) of every row of (doc_id, text)."""
    fields = ", ".join(f"x{d} double" for d in range(DIMENSIONS))

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(path)
        for whole in batches:
            for first, last in slices(text_bytes(whole.column("text"))[1], SLICE_BYTES):
                batch = whole.slice(first, last - first)
                ids, offsets = tokenizer.encode(batch.column("text").to_pylist())
                points = coordinates(ids.astype(np.int64), offsets)
                raw, cuts = ids.astype(stored).tobytes(), (offsets * np.dtype(stored).itemsize).tolist()
                small = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(small, pa.binary()),
                        pa.array(np.diff(offsets)),
                        pa.array([zlib.crc32(e) for e in small], pa.int64()),
                        *[pa.array(points[:, d]) for d in range(DIMENSIONS)],
                    ],
                    ["doc_id", "ids", "n", "tie", *[f"x{d}" for d in range(DIMENSIONS)]],
                )
        # Workers outlive their tasks.
        tokenizer.forget()

    return docs.mapInArrow(task, f"doc_id bigint, ids binary, n bigint, tie bigint, {fields}")


def pack(documents: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every token id of every row lies in exactly one piece. A null or empty text is the end mark alone. Rows that agree in
    id and text are packed like any others. A null doc_id is packed and stays null. An empty table gives an empty result.
    Other columns are not looked at.
    """
    spark = documents.sparkSession
    path = path or vocabulary()
    stored = stored_type(path)
    rows = staged(tokenized(documents_of(documents), path, stored), "tokens")
    axes = [f"x{d}" for d in range(DIMENSIONS)]
    stats = rows.agg(
        F.sum("n").alias("n"),
        *[F.avg(a).alias(f"mean_{a}") for a in axes],
        *[F.stddev_pop(a).alias(f"spread_{a}") for a in axes],
    ).first()
    if stats["n"] is None:
        return spark.createDataFrame([], PIECES)
    means = np.array([stats[f"mean_{a}"] for a in axes])
    spreads = np.maximum(np.array([stats[f"spread_{a}"] for a in axes]), 1e-12)

    @F.arrow_udf("bigint")
    def place(x: pa.Array, y: pa.Array, z: pa.Array, tie: pa.Array) -> pa.Array:
        # A logistic curve deals the standardised axes evenly over the grid.
        points = (np.stack([x, y, z], axis=1) - means) / spreads
        grid = np.minimum((2**CURVE_BITS / (1 + np.exp(-1.702 * np.clip(points, -30, 30)))).astype(np.int64), 2**CURVE_BITS - 1)
        key = hilbert(grid, CURVE_BITS) << np.uint64(TIE_BITS)
        return pa.array((key | (np.asarray(tie).view(np.uint64) & np.uint64((1 << TIE_BITS) - 1))).view(np.int64))

    # Documents of one cell of the curve follow each other in an order of hashes, so a cell can be split anywhere.
    placed = rows.withColumn("key", place(*axes, F.xxhash64("doc_id", "tie")))
    ranges = max(shuffle_width(spark), math.ceil(stats["n"] / RANGE_TOKENS))
    cuts = placed.approxQuantile("key", [i / ranges for i in range(1, ranges)], 1 / (8 * ranges))
    edges = np.array(sorted(set(cuts)), np.float64)

    @F.arrow_udf("int")
    def range_of(key: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, np.asarray(key).astype(np.float64), "right").astype(np.int32))

    dealt = placed.withColumn("range", range_of("key"))
    sums = dict(dealt.groupBy("range").agg(F.sum("n")).collect())
    begins, at = {}, 0
    for number in sorted(sums):
        begins[number] = at
        at += sums[number]

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, current = 0, None
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            ids, doc_ids = batch.column("ids").to_pylist(), batch.column("doc_id").to_pylist()
            for number, doc_id, packed in zip(batch.column("range").to_pylist(), doc_ids, ids, strict=True):
                if number != current:
                    at, current = begins[number], number
                tokens = np.frombuffer(packed, stored).astype("<u4")
                done = 0
                while done < len(tokens):
                    take = min(len(tokens) - done, length - at % length)
                    crc = zlib.crc32(tokens[done : done + take].tobytes())
                    for column, value in zip(columns, (doc_id, done, take, crc, len(tokens), at // length, at % length), strict=True):
                        column.append(value)
                    done += take
                    at += take
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in PIECES.split(", ")])

    return (
        dealt.select("range", "key", "doc_id", "tie", "ids")
        .repartitionById(len(edges) + 1, "range")
        .sortWithinPartitions("range", "key", "doc_id", "tie")
        .drop("tie", "key")
        .mapInArrow(cut, PIECES)
    )
