"""Collocations: phrases of a few words that occur together more often than their parts suggest.

Phrases are counted one length after the other. Within a task a HAT-trie over word numbers sums the occurrences; when it
grows too large its largest subtrees leave it as sorted runs, which meet by the first two words of their phrases and are
merged there. A phrase is counted only if the phrases of one word less in it occur often enough, which a bit filter of
fixed size tells; what the filter passes by chance is too rare and goes by its exact count.

Everything after the counts is joins and groupings of the frequent phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import IS_SPACE, TO_LOWER, hash_runs, hash_words, joined, slices, text_bytes, words
from ledgerflow.llm.frames import lean, staged
from ledgerflow.llm.hat_trie import HatTrie, packed, unpacked
from ledgerflow.llm.segments import filter_of

MAX_WORDS = 3
LEAST_COUNT = 10
# A phrase goes if one that contains it has so many percent of its occurrences.
PERCENT = 50
FIRST = 2000
UNKNOWN = "und"

# Marks that end a piece, fixed by the pattern [.,;:!?\x0A-\x0D].
BREAKS = b".,;:!?\n\x0b\x0c\r"

# Entries of a container before it bursts, entries and words a task holds before subtrees leave it, entries of a run, bytes
# taken at once and phrases numbered at once. Word numbers stay below `VOCABULARY` + `CHUNK`, which a number has room for.
BURST = 4096
ENTRIES = 600_000
VOCABULARY = 300_000
RUN = 20_000
SLICE_BYTES = 1 << 21
CHUNK = 1 << 19

# A phrase that makes up one in so many words is common: there are at most so many of one length.
COMMON = 1000
# Parts of a language's ranking.
SALTS = 16

IS_BREAK = np.zeros(256, np.uint8)
IS_BREAK[list(BREAKS)] = 1
IS_BETWEEN = (IS_BREAK > 0) | IS_SPACE & np.isin(np.arange(256), (0x20, 0x09))

# While phrases are counted, language and phrase are one text; no phrase has a line feed.
COUNTS = "key string, n bigint"


def language_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    place = hashes & np.uint64(len(table) * 64 - 1)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


class Phrases:
    """Occurrences of phrases of `size` words, summed in a trie; the words' numbers tell languages apart."""

    def __init__(self, size: int, frequent: np.ndarray | None) -> None:
        self.size, self.frequent = size, frequent
        self.trie = HatTrie(size, BURST, ENTRIES)
        self.number: dict[tuple[str, bytes], int] = {}
        # Words by language, phrases or not.
        self.totals: Counter[str] = Counter()

    def numbers(self, spoken: np.ndarray, langs: list[str], lang: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A number per word, the same for the same word and language until the vocabulary starts anew."""
        inverse = np.asarray(pa.array(spoken).dictionary_encode().indices)
        place = np.empty(int(inverse.max()) + 1, np.int64)
        # The last write wins, so the first place of every word stays.
        place[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
        number = self.number
        each = zip(lang[place].tolist(), starts[place].tolist(), ends[place].tolist(), strict=True)
        found = np.fromiter((number.setdefault((langs[k], raw[a:b]), len(number)) for k, a, b in each), np.int64, len(place))
        return found[inverse]

    def take(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], lang_of_text: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count some texts, in lower case; yields what leaves the trie for lack of room."""
        starts, ends, first = words(data, offsets, IS_BETWEEN)
        lengths = np.diff(first)
        lang = np.repeat(lang_of_text, lengths)
        for name, n in zip(langs, np.bincount(lang, minlength=len(langs)).tolist(), strict=True):
            self.totals[name] += n
        size = self.size
        if len(starts) < size:
            return
        codes = hash_words(data, starts, ends)
        salt = np.array([language_hash(x) for x in langs], np.uint64)[lang]
        at = np.arange(len(starts) - size + 1)
        if size > 1:
            # Phrases lie within a piece, and pieces within a text.
            piece = np.cumsum(IS_BREAK[data], dtype=np.int32)[starts]
            text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            whole = (piece[: len(at)] == piece[size - 1 :]) & (text[: len(at)] == text[size - 1 :])
            shorter = hash_runs(codes, size - 1)
            often = passes(self.frequent, joined(salt[: len(shorter)], shorter))
            at = np.flatnonzero(whole & often[:-1] & often[1:])
        raw, steps = data.tobytes(), np.arange(size)
        for first_at in range(0, len(at), CHUNK):
            here = at[first_at : first_at + CHUNK]
            low, high = here[0], here[-1] + size
            spoken = np.zeros(high - low, bool)
            for step in range(size):
                spoken[here - low + step] = True
            used = low + np.flatnonzero(spoken)
            number = np.zeros(high - low, np.int64)
            number[used - low] = self.numbers(joined(salt[used], codes[used]), langs, lang[used], raw, starts[used], ends[used])
            self.trie.add(np.sort(packed(number[(here - low)[:, None] + steps])))
            yield from self.overflow()

    def runs(self, subtrees: Iterator[tuple[list[int], list[int]]]) -> Iterator[pa.RecordBatch]:
        """Subtrees as runs of (key, n), sorted by the numbers of their words."""
        first_of: pa.Array | None = None
        words_of: pa.Array | None = None
        keys, counts = [], []

        def run() -> pa.RecordBatch:
            nonlocal first_of, words_of
            if first_of is None:
                first_of = pa.array([g.encode() + b"\n" + w for g, w in self.number], pa.binary())
                words_of = pa.array([w for _, w in self.number], pa.binary())
            numbers, n = unpacked(keys, self.size), np.array(counts, np.int64)
            order = np.lexsort(numbers.T[::-1])
            columns = [pa.array(numbers[order, i]) for i in range(self.size)]
            phrase = first_of.take(columns[0])
            if self.size > 1:
                phrase = pc.binary_join_element_wise(phrase, *[words_of.take(c) for c in columns[1:]], b" ")
            return pa.RecordBatch.from_arrays([phrase.cast(pa.string()), pa.array(n[order])], ["key", "n"])

        for more, ns in subtrees:
            keys += more
            counts += ns
            if len(keys) > RUN:
                yield run()
                keys, counts = [], []
        if keys:
            yield run()

    def overflow(self) -> Iterator[pa.RecordBatch]:
        if len(self.number) > VOCABULARY:
            yield from self.rest()
        else:
            yield from self.runs(self.trie.spilled())

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self.runs(self.trie.drained())
        self.number.clear()


def counted(size: int, frequent: np.ndarray | None):
    """A task from (lang, text) to counts of its phrases, and with an empty phrase to those of all words (one word only)."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(size, frequent)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            lang = batch.column("lang").dictionary_encode()
            langs, lang_of_text = lang.dictionary.to_pylist(), np.asarray(lang.indices).astype(np.int64)
            for low, high in slices(offsets, SLICE_BYTES):
                here = TO_LOWER[data[offsets[low] : offsets[high]]]
                yield from phrases.take(here, offsets[low : high + 1] - offsets[low], langs, lang_of_text[low:high])
        yield from phrases.rest()
        totals = phrases.totals
        if size == 1 and totals:
            names = pa.array([f"{name}\n" for name in totals], pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(list(totals.values()), pa.int64())], ["key", "n"])

    return task


@lean
def phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash that tasks look for, of every (lang, phrase) of one number of words."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("phrase"))
        starts, ends, first = words(data, offsets, IS_BETWEEN)
        lengths = np.diff(first)
        if not len(lengths):
            continue
        runs = hash_runs(hash_words(data, starts, ends), int(lengths[0]))[first[:-1]]
        salt = np.array([language_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(joined(salt, runs).view(np.int64))], ["fp"])


def merged_counts(runs: DataFrame, size: int) -> DataFrame:
    """(key, n): sums of runs. They meet by language and the first two words, so a prefix of many phrases is split."""
    if size <= 2:
        return runs.repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    prefix = F.substring_index("key", " ", 2)
    return runs.repartition(prefix).groupBy(prefix, "key").agg(F.sum("n").alias("n")).select("key", "n")


def frequent_phrases(documents: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST_COUNT) -> list[DataFrame]:
    """Staged (lang, phrase, n) of the phrases of 1, 2, ... words that occur `least` times; a null phrase is all words."""
    spark = documents.sparkSession
    texts = documents.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").alias("text"))
    levels: list[DataFrame] = []
    for size in range(1, max_words + 1):
        if size == 1:
            task = counted(1, None)
        else:
            shorter = levels[-1].filter("phrase is not null").select("lang", "phrase")
            shared = spark.sparkContext.broadcast(filter_of(shorter.mapInArrow(phrase_hashes, "fp bigint")))

            @lean
            def task(batches, size=size, shared=shared):
                return counted(size, shared.value)(batches)

        merged = merged_counts(texts.mapInArrow(task, COUNTS), size).filter((F.col("n") >= least) | F.endswith("key", F.lit("\n")))
        phrase = F.substring_index("key", "\n", -1)
        lang = F.substring("key", F.lit(1), F.length("key") - F.length(phrase) - 1)
        levels.append(staged(merged.select(lang.alias("lang"), F.nullif(phrase, F.lit("")).alias("phrase"), "n"), f"phrases-{size}"))
    return levels


def part(words_of: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(words_of, first, length), " ")


def scored(candidates: DataFrame, parts: DataFrame, least_common: int) -> DataFrame:
    """(lang, phrase, a, l, r, score): the cut of every candidate that scores lowest, the earliest at a tie.

    `candidates` has (lang, phrase, n), `parts` the same of all phrases that can be parts. Those of `least_common`
    occurrences must be few enough for a broadcast. The score is a whole number
    from exact products: a * a * 1000000 must stay below 10 ^ 38.
    """
    words_of = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), words_of.alias("w"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.col("w"), F.lit(1), F.col("k")).alias("left"), part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    # A common word is the end of many phrases. There are few such words: they are broadcast, and phrases that have found
    # their part go on under a key of their own, which finds nothing.
    common = F.broadcast(parts.filter(F.col("n") >= least_common))
    for side, name in (("left", "l"), ("right", "r")):
        here = common.select("lang", F.col("phrase").alias(side), F.col("n").alias("known"))
        cuts = cuts.join(here, ["lang", side], "left")
        key = F.when(F.col("known").isNull(), F.col(side)).otherwise(F.concat("phrase", F.lit("\n")))
        others = parts.select("lang", F.col("phrase").alias("key"), F.col("n").alias("counted"))
        cuts = cuts.withColumn("key", key).join(others, ["lang", "key"], "left")
        cuts = cuts.withColumn(name, F.coalesce("known", "counted")).drop("known", "counted", "key")
    exact = [F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")]
    cuts = cuts.withColumn("up", exact[0] * exact[0] * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("down", exact[1] * exact[2])
    best = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def outgrown(candidates: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of the candidates inside a longer one that has at least `percent` percent of their occurrences."""
    w = F.col("w")
    longer = candidates.select("lang", F.split("phrase", " ").alias("w"), F.col("n").alias("longer")).filter(F.size("w") > 2)
    inside = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    most = inside.select("lang", part(w, F.col("at"), F.col("size")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(most, ["lang", "phrase"]).filter(100 * F.col("longer") >= percent * F.col("n")).select("lang", "phrase")


def collocations(
    documents: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST_COUNT, percent: int = PERCENT, first: int = FIRST
) -> DataFrame:
    """The `first` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A null text has no words; a null lang is `und`, together with rows whose lang is that. Repeated rows and repeated ids
    count like any others. Equal scores go by more occurrences, then by the phrase's bytes. A language without a
    candidate has no row, and an empty table gives an empty result. Other columns are not looked at.
    """
    levels = frequent_phrases(documents, max_words, least)
    counts = [f.filter("phrase is not null") for f in levels]
    candidates, parts = counts[1], counts[0]
    for longer, shorter in zip(counts[2:], counts[1:], strict=False):
        candidates, parts = candidates.unionByName(longer), parts.unionByName(shorter)
    total = levels[0].filter("phrase is null").agg(F.sum("n")).first()[0] or 0
    kept = scored(candidates, parts, max(least, total // COMMON)).join(outgrown(candidates, percent), ["lang", "phrase"], "left_anti")
    kept = staged(kept, "collocations")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is ranked in parts first, so no task meets more than the leaders of each.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    leaders = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    leaders = leaders.filter(F.col("rank") <= first)
    ranked = leaders.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= first)
    n = levels[0].filter("phrase is null").select("lang", "n")
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
