from __future__ import annotations

import random
import zlib

import corpus
import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm.language_id import BLOCK, SAMPLE_BYTES, CrossParser, folded, language_digest, recognised, samples_of
from ledgerflow.llm.quality import monotone, quality_digest, statistics_of
from ledgerflow.llm.toxicity import toxicity_digest, train

STEMS = {
    "aa": "the ing on er th and re ly or ea",
    "bb": "el os ado cion que ar do co ta ñi",
    "cc": "sch ung ein ver ge ch ich ät den über",
}


def test_phrases_match_a_plain_parse():
    rng = random.Random(2)
    samples = {name: corpus.sentence(rng, 60, stems).encode() for name, stems in STEMS.items()}
    parser = CrossParser.of(samples)
    texts = [corpus.sentence(rng, n, stems).encode() for stems in STEMS.values() for n in (1, 7, 300)] + [b"", b"zzz 9"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    known = {name: folded(np.frombuffer(s, np.uint8)).tobytes() for name, s in samples.items()}

    def plain(text: bytes, sample: bytes) -> int:
        count = 0
        for first in range(0, len(text), BLOCK):
            block, at = text[first : first + BLOCK], 0
            while at < len(block):
                n = 1
                while at + n < len(block) and block[at : at + n + 1] in sample:
                    n += 1
                # A symbol that the sample lacks counts as a phrase, and ends the one before.
                at += n
                count += 1
        return count

    counts = parser.phrases(data, offsets)
    for i, text in enumerate(texts):
        text = folded(np.frombuffer(text, np.uint8)).tobytes()
        for j, name in enumerate(parser.languages):
            # A strange symbol closes its phrase and opens the next, which the parser counts once more.
            strange = sum(1 for b in text if bytes([b]) not in known[name])
            assert abs(int(counts[i, j]) - plain(text, known[name])) <= 2 * strange


def test_languages_are_told_apart(spark):
    rng = random.Random(4)
    rows, truth = [], {}
    for i in range(240):
        name = list(STEMS)[i % 3]
        truth[i] = name
        rows.append((i, corpus.sentence(rng, rng.randint(12, 90), STEMS[name]), name if i % 7 else None, "s", 1))
    awkward = [(900, None), (901, ""), (902, " \n"), (903, "123 !!"), (904, "é"), (905, "a" * 50_000), (None, "the ing")]
    rows += [(i, t, "aa", None, None) for i, t in awkward]
    docs = corpus.frame(spark, rows)
    result = language_digest(docs).collect()
    assert len(result) == len(rows)
    by_id = {r["doc_id"]: r for r in result}
    assert sum(by_id[i]["lang_pred"] == name for i, name in truth.items()) >= 235
    assert all(0 <= r["score"] <= 1 for r in result)
    assert [by_id[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und"] * 4
    assert by_id[904]["lang_pred"] != "und" and by_id[905]["lang_pred"] != "und"
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in result)
    kept = recognised(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4


def test_a_small_sample_is_at_no_disadvantage():
    stems = {"aa": "the ing on er th and re ly or ea", "bb": "the ing on er th ado cion que ar do"}
    rng = random.Random(9)
    parser = CrossParser.of({"aa": corpus.sentence(rng, 30, stems["aa"]).encode(), "bb": corpus.sentence(rng, 4000, stems["bb"]).encode()})
    texts = [(name, corpus.sentence(rng, 40, stems[name])) for name in stems for _ in range(60)]
    assert parser.decide(pa.array([t for _, t in texts]))[0] == [name for name, _ in texts]


def test_few_long_documents_fill_a_sample(spark):
    rng = random.Random(10)
    rows = [(i, corpus.sentence(rng, 9000), "aa", None, None) for i in range(6)]
    rows += [(100 + i, corpus.sentence(rng, 400), "bb", None, None) for i in range(100)] + [(300, "one short text", "cc", None, None)]
    rows += [(301 + i, "one short text", "cc", None, None) for i in range(2)]
    sizes = {lang: len(sample) for lang, sample in samples_of(corpus.frame(spark, rows)).items()}
    assert sizes["aa"] == sizes["bb"] == SAMPLE_BYTES
    assert 0 < sizes["cc"] < 50


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string, label string")


@pytest.fixture(scope="module")
def judged(spark):
    """Toxic texts hold words of their own; poor texts repeat or shout."""
    rng = random.Random(8)
    documents, labels = [], []
    for i in range(900):
        text, toxic, good = corpus.sentence(rng, rng.randint(20, 120)), int(i % 6 == 0), int(i % 4 != 0)
        if toxic:
            at = text.split()
            for _ in range(3):
                at.insert(rng.randrange(len(at)), rng.choice(["scumbag", "vilething", "lowlife"]))
            text = " ".join(at)
        if not good:
            text = rng.choice([text.upper() + "!!", " ".join([text.split()[0]] * 60), " ".join(w + "###" for w in text.split())])
        documents.append((i, text, None, None, None))
        if i % 7:
            labels.append((i, good, toxic if i % 11 else None, "x", "y"))
    documents += [(5000, None, None, None, None), (5001, "", None, None, None), (None, "ab", None, None, None), documents[7]]
    documents += [(5002, "q" * 100_000, None, None, None)]
    labels += [(None, 1, 1, None, None), (7, None, None, None, None)]
    return corpus.frame(spark, documents), labelled(spark, labels), documents


@pytest.mark.parametrize(("digest", "threshold", "truth"), [(toxicity_digest, 0.3, lambda i: i % 6 == 0), (quality_digest, 0.7, lambda i: i % 4 != 0)])
def test_classifiers_hold_on_unseen_documents(judged, digest, threshold, truth):
    docs, labels, rows = judged
    result = digest(docs, labels).collect()
    assert len(result) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold) for r in result)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in result)
    unseen = [r for r in result if r["held_out"] and r["doc_id"] < 900]
    assert len(unseen) > 150
    assert sum(r["predicted"] == int(truth(r["doc_id"])) for r in unseen) >= 0.95 * len(unseen)


@pytest.mark.parametrize("digest", [toxicity_digest, quality_digest])
def test_nothing_to_learn_from(spark, judged, nothing, digest):
    none = labelled(spark, [])
    assert digest(nothing, none).count() == 0
    result = digest(judged[0], none).collect()
    assert len(result) == len(judged[2]) and all(0 <= r["score"] <= 1 for r in result)


def test_risk_on_clean_text_is_kept_from_falling_below_zero():
    rng = np.random.default_rng(0)
    toxic = [np.array([1, 2, *rng.integers(10, 500, 5)]) for _ in range(200)]
    rest = [np.array([1, 2, *rng.integers(10, 500, 5)]) if i % 5 == 0 else rng.integers(10, 500, 7) for i in range(1000)]
    model = train(toxic, rest, 0.2)
    assert model.weights[1] > 0 and not model.weights[10:500].any()


def test_monotone_pools_neighbours_that_fall():
    assert monotone(np.array([1.0, 3.0, 2.0, 4.0]), np.array([1.0, 1.0, 3.0, 1.0])).tolist() == [1.0, 2.25, 2.25, 4.0]
    assert monotone(np.zeros(0), np.zeros(0)).tolist() == []


def test_statistics_do_not_depend_on_the_other_texts():
    texts = [b"", b"One two two.\nOne two two.", b"\n\n", "ÄÖ! wide".encode(), b"A" * 3000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = statistics_of(data, np.cumsum([0, *map(len, texts)]))
    for text, row in zip(texts, together, strict=True):
        alone = statistics_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert np.allclose(alone, row)
    assert not together[0].any()
