from __future__ import annotations

import random
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import suffix_dedup
from ledgerflow.llm.components import components
from ledgerflow.llm import near_dup, segments
from ledgerflow.llm.near_dup import Rule, near_dedup, near_duplicates, tile_task
from ledgerflow.llm.substring_dedup import substring_dedup, substring_dedup_digest
from ledgerflow.llm.suffix_dedup import suffix_dedup_digest


def test_passages_match_brute_force(documents, data):
    digest = substring_dedup_digest(documents)
    assert corpus.found(digest, "doc_id", "n_words", "n_removed", "kept_sha256") == corpus.without_passages(data)


def test_cut_documents_keep_their_columns_and_the_words_that_stay(documents, data):
    result = substring_dedup(documents)
    assert result.columns == documents.columns
    kept = Counter()
    import hashlib

    for row in result.select("doc_id", "text").collect():
        kept[(row[0], hashlib.sha256(b" ".join(corpus.words(row[1]))).hexdigest())] += 1
    wanted = Counter()
    for (doc_id, n, gone, sha), times in corpus.without_passages(data).items():
        if n == 0 or gone < n:
            wanted[(doc_id, sha)] += times
    assert kept == wanted


def test_untouched_documents_keep_their_spacing(spark):
    text = "a  b\n\nc " + " ".join(f"w{i}" for i in range(60)) + "\t end "
    rows = [(1, text, None, None, None), (2, f"head \n {text}", None, None, None)]
    result = {r[0]: r[1] for r in substring_dedup(corpus.frame(spark, rows)).select("doc_id", "text").collect()}
    assert result == {1: text, 2: "head \n  "} | {2: result[2]} and result[2].split() == ["head"]


def test_repeated_bytes_match_brute_force(documents, data):
    digest = suffix_dedup_digest(documents)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert corpus.found(digest, *columns) == corpus.without_repeats(data)


def test_texts_there_twice_are_shuffled_once(spark):
    from pyspark.sql import functions as F

    texts = ["a" * 500, "b" * 500, "a" * 500, "c" * 10, "c" * 10, None, "a" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("tid", F.xxhash64("text"))
    marked, first = suffix_dedup.text_classes(docs, 400)
    # What four later steps read holds no shuffle and no sort.
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert [(r["doc_id"], r["text"]) for r in first.collect()] == [(0, "a" * 500)]
    assert {r["doc_id"]: r["copies"] for r in marked.collect()} == {0: 3, 1: None, 2: 3, 3: None, 4: None, 5: None, 6: 3}


def test_a_line_of_many_documents_fills_no_shard(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    lines = [corpus.sentence(rng, 60)[:n] for n in (150, 300, 390)]
    texts = [f"{corpus.sentence(rng, 120)}{lines[i % 3]}{corpus.sentence(rng, 120)}" for i in range(450)]
    # Some share the line and its surroundings, and one repeats itself.
    texts += [f"{corpus.sentence(rng, 30)}{t[400:-300]}{corpus.sentence(rng, 30)}" for t in texts[:12]]
    texts += [texts[20], texts[21] + texts[21], "z" * 3000 + lines[1]]
    data = [(i, t, None, None, None) for i, t in enumerate(texts)]
    task_of, limit = suffix_dedup.shard_task, 40_000

    def watched(length):
        task = task_of(length)

        def measured(batches):
            held = [b for b in batches if b.num_rows]
            size = sum(len(s) for b in held for s in b.column("bytes").to_pylist())
            with open(f"{tmp_path}/{random.random()}", "w") as file:
                file.write(str(size))
            yield from task(iter(held))

        return measured

    monkeypatch.setattr(suffix_dedup, "shard_task", watched)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", limit)
    monkeypatch.setattr(suffix_dedup, "KEY_BYTES", limit // 8, raising=False)
    digest = suffix_dedup_digest(corpus.frame(spark, data).repartition(3))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert corpus.found(digest, *columns) == corpus.without_repeats(data)
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sizes and max(sizes) <= limit


def test_only_windows_in_doubt_are_sorted(monkeypatch):
    rng = random.Random(16)
    # Documents share a line of 300 bytes and nothing around it, but for two that share 700 bytes and one that repeats itself.
    line = corpus.sentence(rng, 80)[:300]
    texts = [corpus.sentence(rng, 200) + line + corpus.sentence(rng, 200) for _ in range(40)]
    texts += [corpus.sentence(rng, 90) + texts[0][-900:-200] + corpus.sentence(rng, 90), "twice " * 300]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    runs = suffix_dedup.byte_kernel(400, 128)(np.frombuffer(b"".join(raw), np.uint8), ends)
    segments = [raw[d][a : a + n + 399] for d, a, n in zip(runs.doc.tolist(), runs.start.tolist(), runs.count.tolist(), strict=True)]
    seen = Counter(s[i : i + 400] for s in segments for i in range(len(s) - 399))
    wanted = {(i, a) for i, s in enumerate(segments) for a in range(len(s) - 399) if seen[s[a : a + 400]] > 1}
    at = np.arange(len(segments))
    columns = {"fp": runs.fp.view(np.int64), "seg": at, "single": at >= 0, "count": runs.count, "bytes": segments}
    rows = pa.RecordBatch.from_pydict(columns | {"piece": np.full(len(at), 128, np.int32)})
    sort, sorted_bytes = suffix_dedup.repeats_in_shard, []

    def watched(segments, counts, length):
        sorted_bytes.append(sum(map(len, segments)))
        return sort(segments, counts, length)

    monkeypatch.setattr(suffix_dedup, "repeats_in_shard", watched)
    (result,) = suffix_dedup.shard_task(400)(iter([rows]))
    found = {(r["seg"], p["start"] + k) for r in result.to_pylist() for p in r["found"] for k in range(p["count"])}
    assert found == wanted and wanted
    # What is sorted beside the repeated windows are the ends of runs, not the surroundings of the line.
    assert len(wanted) < sorted_bytes[0] < sum(map(len, segments)) / 5


def test_a_passage_of_many_documents_is_no_row_for_each_of_its_windows(spark, monkeypatch):
    rng = random.Random(17)
    passage, pair = corpus.sentence(rng, 90)[:560], "over again "
    texts = [f"{corpus.sentence(rng, 60)}{passage}{corpus.sentence(rng, 60)}" for _ in range(60)]
    texts += [f"{corpus.sentence(rng, 20)}{pair * (60 + i % 7)}{corpus.sentence(rng, 20)}" for i in range(60)]
    data = [(i, t, None, None, None) for i, t in enumerate(texts)]
    staged, steps = segments.staged, []

    def watched(df, label):
        result = staged(df, label)
        steps.append((label, result.count()))
        return result

    monkeypatch.setattr(segments, "staged", watched)
    monkeypatch.setattr(suffix_dedup, "staged", watched)
    monkeypatch.setattr(suffix_dedup, "KEY_BYTES", 1000)
    digest = suffix_dedup_digest(corpus.frame(spark, data).repartition(3))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert corpus.found(digest, *columns) == corpus.without_repeats(data)
    # Down to whole windows; what each step joins is no more than some segments of each document.
    assert "byte-windows" in dict(steps)
    assert max(n for label, n in steps if label == "byte-segments") <= 25 * len(texts)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_copies_match_brute_force(documents, data, size, percent):
    # Two texts of one id are one node of the graph; brute force compares them the same way.
    digest = near_duplicates(documents, Rule(size, percent))
    assert corpus.found(digest, "doc_id", "n_shingles", "component_id", "kept") == corpus.near_copies(data, size, percent)


def test_chain_and_crowd_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    data = []
    # A crowd of edited copies, a chain whose ends are far apart, and texts just below the threshold.
    for i in range(90):
        edited = list(words)
        for _ in range(2):
            edited[rng.randrange(300)] = f"e{i}"
        data.append((i, " ".join(edited), None, None, None))
    chain = [f"c{i}" for i in range(200)]
    for i in range(30):
        data.append((1000 + i, " ".join(chain[i * 5 :] + [f"n{j}" for j in range(i * 5)]), None, None, None))
    for i in range(40):
        edited = list(words[:150])
        for _ in range(14):
            edited[rng.randrange(150)] = f"f{i}x{rng.random()}"
        data.append((2000 + i, " ".join(edited), None, None, None))
    digest = near_duplicates(corpus.frame(spark, data), Rule(3, 85))
    assert corpus.found(digest, "doc_id", "n_shingles", "component_id", "kept") == corpus.near_copies(data, 3, 85)


def test_many_rows_of_one_id_and_ids_with_several_texts(spark, monkeypatch):
    rng = random.Random(12)
    base = corpus.sentence(rng, 120)
    crowd = [(100 + i, f"{base} end{i}", "en", "s", 1) for i in range(60)]
    other = corpus.sentence(rng, 120)
    rows = [(1, base, "en", "s", 1)] * 2500 + [(2, f"{base} more", "en", "s", 1)] * 2500 + crowd
    # The second text of id 150 ties the crowd to two others.
    rows += [(150, other, "en", "s", 1), (300, f"{other} x", "en", "s", 1), (301, f"{other} y z", "en", "s", 1)]
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 8)
    monkeypatch.setattr(near_dup, "TILE", 16)
    found = corpus.found(near_duplicates(corpus.frame(spark, rows).repartition(3), Rule(3, 85)), "doc_id", "n_shingles", "component_id", "kept")
    assert found == corpus.near_copies(rows, 3, 85)
    assert {row[2] for row in found} == {1}


def test_very_large_sets_are_compared_in_whole_numbers():
    # 100 * both is below 85 * union by less than a float32 can tell.
    n_left, n_right, both = 730380, 730404, 671171
    for shared, linked in ((both, False), (both + 1, True)):
        left, right = np.arange(n_left, dtype=np.uint64), np.arange(n_left - shared, n_left - shared + n_right, dtype=np.uint64)
        assert (100 * shared >= 85 * (n_left + n_right - shared)) == linked
        columns = {"key": [1, 1], "low": [0, 0], "high": [0, 0], "node": [1, 2], "component": [1, 2], "tile": [0, 0]}
        rows = pa.RecordBatch.from_pydict(columns | {"shingles": pa.array([left.tobytes(), right.tobytes()], pa.binary())})
        found = list(tile_task(Rule(3, 85))(iter([rows])))
        assert [b.to_pydict() for b in found] == ([{"u": [2], "v": [1]}] if linked else [])


def test_near_dedup_keeps_one_of_each_group(documents, data):
    kept = near_dedup(documents, Rule(5, 80))
    assert kept.columns == documents.columns
    wanted = {d for (d, _, _, k) in corpus.near_copies(data, 5, 80) if k}
    assert {r[0] for r in kept.select("doc_id").collect()} == wanted


def test_empty_tables(nothing):
    assert substring_dedup_digest(nothing).count() == 0
    assert substring_dedup(nothing).count() == 0
    assert suffix_dedup_digest(nothing).count() == 0
    assert near_duplicates(nothing, Rule()).count() == 0
    assert near_dedup(nothing).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(60, 100)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 60 for i in range(60, 101)} | {200: 200, 201: 200}
