from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest

from ledgerflow.llm.mixing import Target, exponent, mixed_documents, mixing_digest, mixture, tempered
from ledgerflow.llm.packing import CURVE_BITS, LENGTH, WordTokenizer, hilbert, pack, vocabulary


def reference_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_every_id_lies_in_exactly_one_piece(documents, data):
    extra = ["'S don't it's\ttab nbsp line", "a<|endoftext|>b <|startoftext|>", "é ΣΣ İ", "\x1c\x85x\r\n y", "1234 5,6"]
    data = data + [(7000 + i, t, None, None, None) for i, t in enumerate(extra)]
    docs = corpus.frame(documents.sparkSession, data)
    pieces = pack(docs.repartition(4)).collect()
    per_doc = defaultdict(list)
    for p in pieces:
        per_doc[p["doc_id"]].append(p)
    wanted = defaultdict(list)
    for (doc_id, *_), ids in zip(data, reference_ids([r[1] for r in data]), strict=True):
        wanted[doc_id].append(ids)
    assert set(per_doc) == set(wanted)
    for doc_id, versions in wanted.items():
        have = Counter((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in per_doc[doc_id])
        # Where a document is cut depends on its place; the pieces must cover each version once.
        for ids in sorted(versions, key=len):
            at = 0
            while at < len(ids):
                fits = [
                    h
                    for h in have
                    if h[0] == at and h[3] == len(ids) and h[2] == zlib.crc32(np.array(ids[at : at + h[1]], "<u4").tobytes())
                ]
                assert fits, (doc_id, at)
                have[fits[0]] -= 1
                have += Counter()
                at += fits[0][1]
            assert at == len(ids)
        assert not have
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == LENGTH or number == len(sequences) - 1


def test_words_that_differ_in_digits_and_marks_are_looked_up_once():
    texts = ["", None, *[f"Über{i}!!! straße???{i}, it's 'll{i} x÷y \u00a0{i}\n'tis ''s.{i}" for i in range(300)], "ÿ.,\n", "a<|endoftext|>,b", "Ω1, é"]
    tokenizer = WordTokenizer(vocabulary())
    learned = []
    learn = tokenizer.learn
    tokenizer.learn = lambda words: (learned.extend(words), learn(words))[1]
    ids, offsets = tokenizer.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == reference_ids(texts)
    assert len(learned) == len(set(learned)) < 60
    again, _ = tokenizer.encode(texts)
    assert again.tolist() == ids.tolist() and len(learned) < 60
    assert [x.tolist() for x in tokenizer.encode([])] == [[], [0]]


def test_curve_visits_every_cell_by_steps_of_one():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = hilbert(grid, bits).astype(int)
    assert sorted(place) == list(range(8**bits))
    path = grid[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert CURVE_BITS > bits


def test_neighbours_on_the_curve_share_words(spark):
    import random

    rng = random.Random(1)
    stems = ["ab cde fg hij", "klm no pqr", "stu vw xyz"]
    rows = [(i, corpus.sentence(rng, 300, stems[i % 3]), None, None, None) for i in range(90)]
    pieces = pack(corpus.frame(spark, rows)).collect()
    order = [p["doc_id"] % 3 for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))]
    assert sum(a != b for a, b in zip(order[:-1], order[1:], strict=True)) < len(order) / 3


def test_empty_table(nothing):
    assert pack(nothing).count() == 0
    assert mixing_digest(nothing).count() == 0
    assert mixed_documents(nothing).count() == 0


SHARES = {"a": 1000.0, "b": 100.0, "c": 100.0, "d": 10.0, "e": 0.0}


def test_exponent_meets_the_repetition_limit():
    alpha = exponent(SHARES, Target(repeats=2.0))
    weights = tempered(SHARES, alpha)
    budget = max(SHARES[s] / w for s, w in weights.items())
    assert max(w * budget / SHARES[s] for s, w in weights.items()) == pytest.approx(2.0)
    assert min(w * budget / SHARES[s] for s, w in weights.items()) == pytest.approx(1.0)
    assert exponent(SHARES, Target(repeats=1e9)) == 0.0
    assert exponent({}, Target()) == 1.0 and exponent({"x": 0.0}, Target()) == 1.0


def test_exponent_meets_the_entropy():
    weights = tempered(SHARES, exponent(SHARES, Target(entropy=1.0)))
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(1.0)


def test_every_document_stays_and_budgets_are_met(spark):
    import random

    rng = random.Random(6)
    rows = []
    for i in range(900):
        source = "big" if i % 3 else rng.choice(["x", "y", None])
        rows.append((i, corpus.sentence(rng, rng.randint(1, 40)), None, source, None))
    rows += [(2000, None, None, "big", 0), (2001, "", None, "x", 0), (2002, " ", None, "empty", 0)]
    docs = corpus.frame(spark, rows).repartition(4)
    target = Target(repeats=1.5)
    used, names = mixture(docs, target)
    result = used.collect()
    tokens: Counter = Counter()
    for _, text, _, source, _ in rows:
        tokens[source] += len(corpus.words(text))
    spent: Counter = Counter()
    for r in result:
        spent[r["source"]] += r[names["tokens"]]
    uses = Counter(r["doc_id"] for r in result)
    assert set(uses) == {r[0] for r in rows} and set(uses.values()) <= {1, 2}
    assert uses[2000] == uses[2001] == uses[2002] == 1
    alpha = exponent({s or "": float(n) for s, n in tokens.items()}, target)
    weights = tempered({s or "": float(n) for s, n in tokens.items()}, alpha)
    budget = max(tokens[s or None] / w for s, w in weights.items())
    for source, n in tokens.items():
        if n:
            # A budget is met but for less than one document.
            assert 0 <= weights[source or ""] * budget - spent[source] < 41
    epochs = defaultdict(set)
    for r in result:
        assert r[names["epoch"]] not in epochs[r["doc_id"]]
        epochs[r["doc_id"]].add(r[names["epoch"]])
    again = mixture(docs.repartition(2), target)[0].collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, result))


def test_a_small_budget_takes_part_of_a_source(spark):
    rows = [(i, "one two three four", None, "s", None) for i in range(400)]
    chosen = mixed_documents(corpus.frame(spark, rows), Target(budget=401.0))
    assert chosen.count() == 100 and chosen.distinct().count() == 100


def test_awkward_rows_do_not_crash(documents, data):
    kept = mixed_documents(documents)
    assert kept.columns == documents.columns and kept.count() >= len(data)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in data}
