from __future__ import annotations

import hashlib
import random
from collections import Counter

import corpus
import numpy as np
import pytest

from ledgerflow.llm import edit_embedding as module

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def plain_walk(text: str) -> str:
    """The walk one output place at a time, and the fingerprint from its whole output."""
    chars = module.characters(text)
    bits = module.mixed(np.arange(module.CLASSES * module.PERIOD, dtype=np.uint64) + np.uint64(0x5EED))
    bits = bits.reshape(module.CLASSES, module.PERIOD) & np.uint64(1)
    classes, out, at = module.classes_of(chars), [], 0
    while at < len(chars):
        out.append(at)
        at += int(bits[classes[at], (len(out) - 1) % module.PERIOD])
    octaves = 1
    while module.KEPT << (octaves - 1) < len(out):
        octaves += 1
    result = []
    for place in module.places()[: octaves * module.KEPT].tolist():
        if place >= len(out):
            result.append("-")
        else:
            three = [int(chars[i]) if i < len(chars) else 0 for i in range(out[place], out[place] + 3)]
            result.append(sign(three, place))
    return "".join(result)


def sign(three: list[int], place: int) -> str:
    def join(a, b):
        return module.joined(np.array([a], np.uint64), np.array([b], np.uint64))[0]

    value = int(join(join(join(three[0], three[1]), three[2]), place)) >> 20
    return module.SIGNS[1 + value % (len(module.SIGNS) - 1)]


def alike(a: str, b: str) -> float:
    n = max(len(a), len(b))
    a, b = a.ljust(n, "-"), b.ljust(n, "-")
    w = [1 if i < 2 * module.KEPT else 2 ** (i // module.KEPT - 1) for i in range(n)]
    there = sum(w[i] for i in range(n) if a[i] != "-" or b[i] != "-")
    return sum(w[i] for i in range(n) if a[i] == b[i] != "-") / there if there else 1.0


def expected(data: list[tuple]) -> Counter:
    rows = sorted(((r[0], r[1] or "") for r in data), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    result: Counter = Counter()
    for (doc_id, text), (_, after) in zip(rows, [*rows[1:], *rows[:1]], strict=True):
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        own, changed, following = (plain_walk(t) for t in (text, edited, after))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        result[(doc_id, len(text), sha, own, changed, alike(own, changed), alike(own, following))] += 1
    return result


def short(data: list[tuple]) -> list[tuple]:
    return [(r[0], r[1][:3000] if r[1] else r[1], *r[2:]) for r in data]


@pytest.mark.parametrize("partitions", [1, 4])
def test_digest_equals_one_step_at_a_time(spark, data, partitions):
    rows = short(data)
    frame = corpus.frame(spark, rows).repartition(partitions)
    assert corpus.found(module.fingerprint_digest(frame), *COLUMNS) == expected(rows)


def test_whole_long_texts_count(spark, data):
    rows = corpus.found(module.fingerprint_digest(corpus.frame(spark, data)), "doc_id", "n_chars")
    assert rows == Counter((r[0], len(r[1] or "")) for r in data)
    rng = random.Random(2)
    text = corpus.sentence(rng, 30_000)
    other = text[:-9000] + corpus.sentence(rng, 3000)[:9000]
    assert module.fingerprint_of(text).tolist() != module.fingerprint_of(other).tolist()


def test_edited_texts_are_nearer_than_others():
    rng = random.Random(9)
    texts = [corpus.sentence(rng, rng.randint(30, 900)) for _ in range(60)]
    for a, b in zip(texts, texts[1:], strict=False):
        own = module.Walked(1, a).beside(module.Walked(0, b))
        assert own[5] > 0.5 and own[6] < 0.2 and own[7] > 0 and own[8] < 3
        words = a.split()
        words[len(words) // 2] = "zzz"
        assert module.likeness(module.fingerprint_of(a), module.fingerprint_of(" ".join(words))) > 0.4


@pytest.mark.parametrize("rows", [[], [(5, "one text alone", "en", "s", 1)], [(5, None, None, None, None)] * 3])
def test_few_rows(spark, rows):
    assert corpus.found(module.fingerprint_digest(corpus.frame(spark, rows)), *COLUMNS) == expected(rows)


def test_near_texts_are_found_in_buckets_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE", 7)
    rng = random.Random(4)
    base = corpus.sentence(rng, 400)
    # Copies with another end, one group larger than a tile, and texts of their own.
    texts = [f"{base} end {i}" for i in range(40)] + [corpus.sentence(rng, rng.randint(0, 300)) for _ in range(30)] + ["", None]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(3, "same id", "en", "s", 1), (None, base, None, None, None)]
    found = module.near_texts(corpus.frame(spark, rows).repartition(3)).collect()
    component = {r["doc_id"]: r["component_id"] for r in found}
    assert len(found) == len(rows) and all(component[i] == 0 for i in range(40))
    prints = [module.fingerprint_of(t) for _, t, *_ in rows[:-1]]
    links = [(rows[i][0], rows[j][0]) for i in range(len(prints)) for j in range(i) if module.likeness(prints[i], prints[j]) >= 0.8]
    assert component == corpus.least_reachable({r[0] for r in rows[:-1]}, links) | {None: None}
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)
    assert module.near_texts(corpus.frame(spark, [])).count() == 0
