from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import corpus
import numpy as np
import pytest

from ledgerflow.llm import periodic
from ledgerflow.llm.arrays import mixed

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def runs_of(words: list) -> list[tuple]:
    """Every run (start, length, period) by trying all periods; the smallest period of a stretch counts."""
    found: dict[tuple, int] = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def tail(doc_id: int | None, words: list) -> list:
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id: int | None, text: str | None) -> tuple:
    words = tail(doc_id, corpus.words(text))
    runs = sorted(runs_of(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def document(rng: random.Random) -> list[int]:
    letters, words = rng.choice([1, 2, 3, 60]), []
    while len(words) < rng.randint(0, 220):
        piece = [rng.randrange(letters) for _ in range(rng.randint(1, 24))]
        words += (piece * 14)[: rng.randint(1, 14 * len(piece))] if rng.random() < 0.3 else piece
    return words


def stitched(docs: list[list[int]]) -> list[list[tuple]]:
    codes = mixed(np.array([w for d in docs for w in d], np.uint64) + np.uint64(7))
    parts: dict[tuple, list] = {}
    for doc, q, low, high in zip(*(c.tolist() for c in periodic.fragments(codes, np.cumsum([0, *map(len, docs)]))), strict=True):
        parts.setdefault((doc, q), []).append((low, high))
    found: list[list[tuple]] = [[] for _ in docs]
    for (doc, q), pieces in parts.items():
        whole: list[list[int]] = []
        for low, high in sorted(pieces):
            if whole and low <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], high)
            else:
                whole.append([low, high])
        found[doc] += [(a, b - a + q, q) for a, b in whole if b - a + q >= max(6, 4 * q)]
    return [sorted(f) for f in found]


@pytest.mark.parametrize("tiles", [1, 3, 1024])
def test_fragments_of_tiles_make_up_all_runs(monkeypatch, tiles):
    monkeypatch.setattr(periodic, "TILES", tiles)
    monkeypatch.setattr(periodic, "COMPARED", 64)
    rng = random.Random(tiles)
    for _ in range(60):
        docs = [document(rng) for _ in range(rng.randint(1, 10))]
        assert stitched(docs) == [runs_of(d) for d in docs]


def test_a_word_that_fills_a_long_document_makes_few_fragments():
    fragments = periodic.fragments(mixed(np.ones(50_000, np.uint64)), np.array([0, 50_000]))
    assert set(fragments[1].tolist()) == {1} and len(fragments[1]) < 100


def planted(data: list[tuple]) -> list[tuple]:
    rng = random.Random(11)
    more = [" ".join(f"w{x}" for x in document(rng)) for _ in range(60)]
    more += ["ha " * 5000, "a b\tc\n" * 4, "x x x x x", "x x x x x x", " ".join(["p q r s"] * 4)]
    return [r for r in data if len(r[1] or "") < 50_000] + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(more)]


def test_digest_equals_brute_force(spark, data):
    rows = planted(data)
    found = corpus.found(periodic.periodic_digest(corpus.frame(spark, rows).repartition(3)), *COLUMNS)
    assert found == Counter(digest(doc_id, text) for doc_id, text, *_ in rows)
    assert sum(n for row, n in found.items() if row[1]) > 30


def test_tails_are_repeated_for_some_ids():
    chosen = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    text = " ".join(f"w{i}" for i in range(100)).encode()
    assert len(chosen) > 15
    for i in range(300):
        new = periodic.repeated_tail(i, text)
        assert (new or text).split() == tail(i, text.split()) and (new is None) == (i not in chosen)


def test_no_rows(spark, nothing):
    assert periodic.periodic_digest(nothing).count() == 0
    assert periodic.collapsed(nothing).count() == 0


def test_collapsed_texts_keep_their_columns(spark, data):
    rows = planted(data)
    frame = corpus.frame(spark, rows)
    shorter = periodic.collapsed(frame)
    assert shorter.columns == frame.columns and shorter.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in shorter.filter("doc_id >= 1000").collect()}
    assert texts[1060].split() == ["ha"] and texts[1061].split() == ["a", "b", "c"] and texts[1062] == "x x x x x"
    for doc_id, text, *_ in rows:
        if doc_id is not None and doc_id >= 1000:
            words = corpus.words(text)
            gone = {i for s, length, q in runs_of(words) for i in range(s + q, s + length)}
            assert corpus.words(texts[doc_id]) == [w for i, w in enumerate(words) if i not in gone]
