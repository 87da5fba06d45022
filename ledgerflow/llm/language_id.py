"""Language identification by cross-parsing: the language whose sample parses a text into the fewest phrases wins.

Per language a suffix automaton is built over a bounded sample of labelled text. A text is cut greedily into the longest
phrases that occur in the sample; few phrases mean a near relative. Phrases grow with the logarithm of the sample, so
counts are weighted by it where samples differ in size. All automata are one table of transitions in which
the start of the next phrase is already folded in, so parsing is one table look-up per byte, taken for thousands of
blocks of text and all languages at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import TO_LOWER, slices, text_bytes
from ledgerflow.llm.frames import documents_of, lean, small_batches

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

# The sample that is learned from: documents per language, bytes taken of each, bytes per language, and bytes in all.
SAMPLE_DOCUMENTS = 48
SAMPLE_PIECE = 1024
SAMPLE_BYTES = 24 * 1024
SAMPLE_TOTAL = 256 * 1024

# Added to the size of a sample in its logarithm, so that a sample of a few bytes wins nothing.
SAMPLE_LEAST = 256

# Texts are parsed in blocks of so many bytes; a phrase ends at the end of its block.
BLOCK = 512
SLICE_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Documents no sample is taken from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes as the automata see them: A-Z lowered, other ASCII that is no letter as one space."""
    lowered = TO_LOWER[data]
    letters = ((lowered >= ord("a")) & (lowered <= ord("z"))) | (lowered >= 128)
    return np.where(letters, lowered, np.uint8(0x20))


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of `text`; state 0 is the empty string."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


@dataclass
class CrossParser:
    """Automata of all languages as one table: entry [state * width + symbol] is 2 * (next state) + (1 if a phrase ended)."""

    languages: list[str]
    symbol: np.ndarray
    width: int
    table: np.ndarray
    roots: np.ndarray
    # Expected phrase length of each sample, as a share of that of the largest.
    weights: np.ndarray

    @staticmethod
    def of(samples: Mapping[str, bytes]) -> CrossParser:
        languages = sorted(samples)
        texts = {name: folded(np.frombuffer(samples[name], np.uint8)).tobytes() for name in languages}
        used = sorted({b for text in texts.values() for b in text})
        symbol = np.zeros(256, np.int64)
        for i, byte in enumerate(used):
            symbol[byte] = i + 1
        width = len(used) + 1
        tables, roots, base = [], [], 0
        for name in languages:
            moves = suffix_automaton(texts[name])
            table = np.full((len(moves), width), -1, np.int32)
            for state, targets in enumerate(moves):
                for byte, target in targets.items():
                    table[state, symbol[byte]] = 2 * (base + target)
            base_of, base = base, base + len(moves)
            del moves
            # Where no longer phrase exists, one ends and the next begins with this symbol.
            restart = np.where(table[0] >= 0, table[0], np.int32(2 * base_of)) + np.int32(1)
            tables.append(np.where(table >= 0, table, restart))
            roots.append(base_of)
        table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        sizes = np.log(np.array([len(texts[name]) + SAMPLE_LEAST for name in languages], np.float64))
        weights = sizes / sizes.max(initial=0) if languages else sizes
        return CrossParser(languages, symbol, width, table, np.array(roots, np.int64), weights)

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, languages): number of phrases of every text."""
        n, k = len(offsets) - 1, len(self.languages)
        result = np.zeros((n, k), np.int64)
        lengths = np.diff(offsets)
        blocks = -(-lengths // BLOCK)
        total = int(blocks.sum())
        if not total or not k:
            return result
        owner = np.repeat(np.arange(n), blocks)
        within = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = offsets[owner] + within * BLOCK
        size = np.minimum(lengths[owner] - within * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        codes = self.symbol[folded(data)].astype(np.int32)
        # Longest blocks first, so the blocks still running are a prefix at every step.
        running = np.searchsorted(-size, -np.arange(int(size[0])), "left")
        states = np.repeat(self.roots.astype(np.int32)[:, None], total, axis=1)
        ended = np.ones((k, total), np.int32)
        for step, live in enumerate(running.tolist()):
            key = states[:, :live] * np.int32(self.width) + codes[begin[:live] + step]
            after = self.table.take(key)
            ended[:, :live] += after & 1
            states[:, :live] = after >> 1
        for j in range(k):
            result[:, j] = np.bincount(owner, ended[j], n).astype(np.int64)
        return result

    def decide(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of every text; the score is the margin of the winner, as a share of the runner-up."""
        data, offsets = text_bytes(column)
        names, scores = [], []
        for low, high in slices(offsets, SLICE_BYTES):
            part = offsets[low : high + 1] - offsets[low]
            here = data[offsets[low] : offsets[high]]
            counts = self.phrases(here, part)
            if not self.languages:
                names += [UNKNOWN] * (high - low)
                scores.append(np.zeros(high - low))
                continue
            counts = counts * self.weights
            best = counts.argmin(axis=1)
            least = counts[np.arange(len(best)), best]
            second = np.sort(counts, axis=1)[:, 1] if counts.shape[1] > 1 else least * 2
            margin = (second - least) / np.maximum(second, 1)
            score = np.clip(0.5 + margin, 0.0, 1.0)
            ascii_letters = ((TO_LOWER[here] >= ord("a")) & (TO_LOWER[here] <= ord("z"))).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(ascii_letters)])
            lettered = before[part[1:]] > before[part[:-1]]
            for i in np.flatnonzero(~lettered):
                lettered[i] = bool(LETTER.search(here[part[i] : part[i + 1]].tobytes().decode("utf-8", "ignore")))
            names += [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            scores.append(np.where(lettered, score, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def samples_of(documents: DataFrame, lang_column: str = "lang") -> dict[str, bytes]:
    """Sample text per language, from labelled documents outside the held-out part.

    Of each language the documents with the smallest hash of their id count. The driver receives `SAMPLE_DOCUMENTS`
    pieces per language and cuts the samples to `SAMPLE_BYTES` each and `SAMPLE_TOTAL` together. A language that does
    not fill its sample is filled with further pieces of the same documents.
    """
    chosen = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"), F.col(f"`{lang_column}`").alias("lang")
    )
    chosen = chosen.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.filter(F.col("text").rlike(r"\p{L}"))
    piece = F.substring("text", 1, SAMPLE_PIECE)
    order = Window.partitionBy("lang").orderBy("h", "piece")

    def first_of(rows: DataFrame, taken: Column) -> dict[str, list[str]]:
        ranked = rows.select("lang", F.xxhash64("doc_id").alias("h"), piece.alias("piece"), taken.alias("taken"))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_DOCUMENTS)
        found: dict[str, list[str]] = {}
        for lang, text in ranked.orderBy("lang", "rank").select("lang", "taken").collect():
            found.setdefault(lang, []).append(text)
        return found

    pieces = first_of(chosen, piece)
    share = min(SAMPLE_BYTES, SAMPLE_TOTAL // max(1, len(pieces)))
    samples = {lang: b" ".join(t.encode() for t in found) for lang, found in pieces.items()}
    short = [lang for lang, sample in samples.items() if len(sample) < share]
    if short:
        longer = first_of(chosen.filter(F.col("lang").isin(short)), F.substring("text", 1, SAMPLE_BYTES))
        for lang, texts in longer.items():
            for at in range(SAMPLE_PIECE, SAMPLE_BYTES, SAMPLE_PIECE):
                more = [t[at : at + SAMPLE_PIECE].encode() for t in texts if len(t) > at]
                samples[lang] = b" ".join([samples[lang], *more])
                if not more or len(samples[lang]) >= share:
                    break
    return {lang: sample[:share] for lang, sample in samples.items()}


def shared_parser(documents: DataFrame, samples: Mapping[str, bytes] | None) -> Broadcast[CrossParser]:
    """The parser, built once on the driver and sent as one table.

    A sample of n bytes makes 2 * n states at most, so the table has up to 2 * `SAMPLE_TOTAL` * (different bytes + 1)
    entries of four bytes, whatever the input.
    """
    samples = samples_of(documents) if samples is None else samples
    return documents.sparkSession.sparkContext.broadcast(CrossParser.of(samples))


def language_digest(documents: DataFrame, samples: Mapping[str, bytes] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `documents`.

    `und` with score 0 for a null text, a text without a letter, or if nothing could be learned. Equal phrase counts go
    to the language first in name order. A null doc_id counts as not held out, and is never learned from. Other columns
    are not looked at.
    """
    shared = shared_parser(documents, samples)

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.decide(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents_of(documents).select("doc_id", "text", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    return rows.mapInArrow(task, "doc_id bigint, held_out boolean, lang_pred string, score double")


def recognised(documents: DataFrame) -> DataFrame:
    """The documents in a language: rows whose prediction is `und` go, the others stay with all their columns."""
    small_batches(documents.sparkSession)
    shared = shared_parser(documents, None)

    @F.arrow_udf("string")
    def language(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.decide(texts)[0], pa.string())

    return documents.filter(language("text") != UNKNOWN)

