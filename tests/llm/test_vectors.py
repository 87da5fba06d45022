from __future__ import annotations

import numpy as np
import pytest
from corpus import least_reachable

from ledgerflow.llm.block_search import nearest
from ledgerflow.llm.vector_dedup import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, size string, tile string, q_ids string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "a", "b", "c", "d") for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    data = []
    for c in range(12):
        centre = rng.standard_normal(16)
        data += [centre + rng.standard_normal(16) * s for s in (0.02, 0.1, 0.2, 0.3)]
    data += [data[0]] * 30 + [data[0] * 3.0, -data[0]]
    # A crowd larger than a tile, and a chain.
    crowd = rng.standard_normal(16)
    data += [crowd + rng.standard_normal(16) * 0.05 for _ in range(600)]
    turn = np.linspace(0, 2, 16)
    data += [np.cos(t) * np.eye(16)[0] + np.sin(t) * np.eye(16)[1] for t in turn]
    data += [None, np.zeros(16), [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, []]
    # Other lengths: near copies of each other, of length 2 and 40.
    data += [[1.0, 2.0], [1.0, 2.1], [2.0, 4.0], [2.0, -1.0], *(np.full(40, 1.0) + rng.standard_normal(40) * 0.1 for _ in range(5))]
    result = [(i * 2, v if v is None else np.array([np.nan if x is None else x for x in v], np.float32) if None not in list(v) else v) for i, v in enumerate(data)]
    # A repeated row, a row without an id, and an id with two vectors that ties two groups.
    return [*result, (4, result[2][1]), (None, result[3][1]), (8, result[40][1])]


def sound(rows):
    return [
        (i, np.array(v, np.float64))
        for i, v in rows
        if i is not None and v is not None and len(v) and None not in list(v) and np.isfinite(np.array(v, float)).all() and np.any(v)
    ]


def test_links_and_components_match_brute_force(spark, rows):
    good = sound(rows)
    ids = [i for i, _ in good]
    linked = np.zeros((len(good), len(good)), bool)
    for length in {len(v) for _, v in good}:
        at = np.array([k for k, (_, v) in enumerate(good) if len(v) == length])
        x = np.array([good[k][1] for k in at])
        cosine = (x @ x.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((x * x).sum(1))
        linked[np.ix_(at, at)] = cosine >= 0.95
    np.fill_diagonal(linked, False)
    name: dict = {}
    for i, v in good:
        name[v.tobytes()] = min(name.get(v.tobytes(), i), i)
    names = [name[v.tobytes()] for _, v in good]
    own = list(zip(ids, names, strict=True))
    least = least_reachable({*names, *ids}, [(names[a], names[b]) for a, b in zip(*np.nonzero(linked), strict=True)] + own)
    wanted = sorted((i, int(linked[k].sum()), least[names[k]], i == least[names[k]]) for k, i in enumerate(ids))
    result = near_vectors(table(spark, rows).repartition(3)).select("vec_id", "n_links", "component_id", "kept").collect()
    taken = {i for i, _ in good}
    assert sorted(tuple(r) for r in result if r[0] in taken) == wanted
    others = sorted(((r[0] is None, r[0]), r[1], r[2], r[3]) for r in result if r[0] not in taken)
    missing = [i for i, _ in rows if i not in taken]
    assert [o[0][1] for o in others] == sorted(missing, key=lambda i: (i is None, i))
    assert all(o[1] == 0 and o[2] == o[0][1] and o[3] for o in others)


@pytest.mark.parametrize(("k", "every"), [(20, 20), (3, 6), (2000, 400)])
def test_search_matches_brute_force(spark, rows, k, every):
    good = sound(rows)
    wanted = []
    for q, v in good:
        if q % every == 0:
            scores = sorted((-float(np.add.accumulate(c * v)[-1]), i) for i, c in good if i != q and len(c) == len(v))[:k]
            wanted += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    result = nearest(table(spark, rows).repartition(3), k, every).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in result) == sorted(wanted)


def test_every_vector_of_an_id_has_its_links(spark):
    rows = [(5, [1, 0, 0]), (5, [0, 1, 0]), (7, [1, 0.05, 0]), (8, [0.05, 1, 0]), (1, [1, 1]), (60, [1, 1])]
    found = near_vectors(table(spark, rows)).select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1, 1), (5, 1, 5), (5, 1, 5), (7, 1, 5), (8, 1, 5), (60, 1, 1)]
    assert [r["vec_id"] for r in nearest(table(spark, rows)).filter("query_id = 60").collect()] == [1]


def test_empty_tables(spark):
    empty = table(spark, [])
    assert nearest(empty).count() == 0
    assert near_vectors(empty).count() == 0
    assert near_vectors(table(spark, [(1, None), (2, [])])).count() == 2
