from __future__ import annotations

import random
import re
from collections import Counter

import corpus
import numpy as np
import pytest

from ledgerflow.llm import collocations as module
from ledgerflow.llm.hat_trie import HatTrie, packed, unpacked

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(data: list[tuple], max_words: int = 3, least: int = 10, percent: int = 50, first: int = 2000) -> Counter:
    f: Counter = Counter()
    n: Counter = Counter()
    for _, text, lang, *_ in data:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    chosen = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, w), a in chosen.items():
        for m in range(2, len(w)):
            gone.update((lang, w[i : i + m]) for i in range(len(w) - m + 1) if 100 * a >= percent * f[lang, w[i : i + m]])
    rows: dict = {}
    for (lang, w), a in chosen.items():
        if (lang, w) not in gone:
            cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, b" ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    return Counter(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1)
    )


def spoken(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    stock = ["of the", "in spite of", "New York", "new york city", "por favor", "ünter öl", "a", "b", "c d", "x\x0by", "tab\tbed"]
    texts: list[str | None] = [None, "", " . , ;", "one", "New York " * 4000, "a " * 30_000]
    texts += [rng.choice(" ,.;\n").join(rng.choices(stock, k=rng.randint(1, 60))) for _ in range(120)]
    langs = ["en", "de x\ny", None, "und", "ünï"]
    return [(i, t, langs[i % 5], "s", 1) for i, t in enumerate(texts)] + [(None, "of the new york", "en", None, None)] * 12


@pytest.fixture
def small(monkeypatch):
    """Limits so low that containers burst, subtrees leave the trie and the vocabulary starts anew."""
    for name, value in {"BURST": 3, "ENTRIES": 12, "VOCABULARY": 15, "SLICE_BYTES": 512, "RUN": 4, "CHUNK": 50}.items():
        monkeypatch.setattr(module, name, value)


def test_counts_by_brute_force(spark):
    rows = spoken()
    assert corpus.found(module.collocations(corpus.frame(spark, rows).repartition(3)), *COLUMNS) == expected(rows)


def test_longer_phrases_and_other_limits(spark):
    rows = spoken(8)
    found = module.collocations(corpus.frame(spark, rows).repartition(3), 5, 3, 80, 7)
    assert corpus.found(found, *COLUMNS) == expected(rows, 5, 3, 80, 7)


def test_runs_that_leave_a_full_trie_add_up(small):
    rows = spoken(4)
    import pyarrow as pa

    batch = pa.record_batch({"lang": [r[2] or "und" for r in rows], "text": [r[1] for r in rows]})
    all_bits = np.full(1 << 10, 2**64 - 1, np.uint64)
    for size in (1, 2, 3):
        total: Counter = Counter()
        batches = list(module.counted(size, all_bits)(iter([batch])))
        for b in batches:
            for key, n in zip(b.column("key").to_pylist(), b.column("n").to_pylist(), strict=True):
                total[tuple(key.rsplit("\n", 1))] += n
        plain: Counter = Counter()
        for _, text, lang, *_ in rows:
            for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER)):
                w = re.findall(rb"[^\x20\x09]+", piece)
                plain.update((lang or "und", b" ".join(w[i : i + size]).decode()) for i in range(len(w) - size + 1))
        assert len(batches) > 3 and Counter({k: v for k, v in total.items() if k[1]}) == plain


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_trie_keeps_every_count(size):
    rng = np.random.default_rng(size)
    trie, total, spilled = HatTrie(size, 4, 60), Counter(), Counter()

    def take(subtrees):
        for keys, counts in subtrees:
            for key, n in zip(unpacked(keys, size).tolist(), counts, strict=True):
                spilled[tuple(key)] += n

    for _ in range(200):
        numbers = rng.integers(0, 4, (10, size)) + (1 << 20)
        total.update(map(tuple, numbers.tolist()))
        trie.add(np.sort(packed(numbers)))
        take(trie.spilled())
        assert trie.size <= 60
    take(trie.drained())
    assert spilled == total and trie.size == 0


def test_scores_are_exact_for_large_counts(spark):
    a, left, right = 3 * 10**14 + 7, 9 * 10**14 + 11, 5 * 10**14 + 13
    candidates = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, n bigint")
    parts = spark.createDataFrame([("en", "x", left), ("en", "y", right)], "lang string, phrase string, n bigint")
    for common in (1, 10**15):
        assert module.scored(candidates, parts, common).first()["score"] == 10**6 * a * a // (left * right)


def test_no_rows(spark, nothing):
    assert module.collocations(nothing).count() == 0
