"""A small corpus with every awkward row, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(rb"[^\x20\x09-\x0D]+")

# Columns whose names the operators use inside.
CLASHING = ["fp", "seg", "start", "count", "parts", "node", "u", "v", "key", "tid", "maybe", "_copy_id", "_dedup_parts", "component", "ids", "n"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)


def sentence(rng: random.Random, n: int, stems: str = "ab cde fg hij klm no pqr stu vw xyz") -> str:
    parts = stems.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(60, 260)) for _ in range(14)]
    passage = sentence(rng, 75)
    texts: list[str | None] = [None, "", " \n\t ", "one", "One two", "one two", "!!! 123", "ünï cödé " * 3]
    texts += base
    texts += [f"{b} tail{i}" for i, b in enumerate(base[:4])]
    texts += [b.replace(" ", "\n", 3) for b in base[:2]] + [base[0], base[0].upper()]
    texts += [f"{sentence(rng, 40)} {passage} {sentence(rng, 30)}" for _ in range(9)]
    texts += ["same " * 700, "same " * 60, "y" * 900, "x" + "y" * 1200, "ab" * 500 + " " + "ab" * 500]
    texts += ["w" * 200_000, sentence(rng, 20_000)]
    result = [(i * 3, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    result += [result[10], result[10], (result[11][0], base[3] + " other", "de", "s1", 1), (None, base[5], None, None, None), (None, None, None, None, None)]
    return result


def frame(spark: SparkSession, data: list[tuple]) -> DataFrame:
    extra = tuple("clash" for _ in CLASHING)
    return spark.createDataFrame([r + extra for r in data], SCHEMA)


def found(df: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def without_passages(data: list[tuple], size: int = 50) -> Counter:
    owner: dict[tuple, int] = {}
    for doc_id, text, *_ in data:
        w = words(text)
        for i in range(len(w) - size + 1) if doc_id is not None else ():
            k = tuple(w[i : i + size])
            owner[k] = min(owner.get(k, doc_id), doc_id)
    result: Counter = Counter()
    for doc_id, text, *_ in data:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1) if doc_id is not None else ():
            if owner[tuple(w[i : i + size])] < doc_id:
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        result[(doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return result


def without_repeats(data: list[tuple], size: int = 400) -> Counter:
    seen: Counter = Counter()
    raw = [(text or "").encode() for _, text, *_ in data]
    for r in raw:
        seen.update(r[i : i + size] for i in range(len(r) - size + 1))
    result: Counter = Counter()
    for (doc_id, *_), r in zip(data, raw, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(r, gone, strict=True) if not g)
        result[(doc_id, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return result


def shingles(text: str | None, size: int) -> frozenset:
    w = [x.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def least_reachable(nodes: set, links: list[tuple]) -> dict:
    around = defaultdict(set)
    for a, b in links:
        around[a].add(b)
        around[b].add(a)
    least: dict = {}
    for node in sorted(nodes):
        if node not in least:
            stack = [node]
            while stack:
                at = stack.pop()
                if at not in least:
                    least[at] = node
                    stack.extend(around[at])
    return least


def near_copies(data: list[tuple], size: int, percent: int) -> Counter:
    """Equal sets go by their smallest doc_id, and so do sets whose smallest doc_id is the same."""
    sets = [(doc_id, shingles(text, size)) for doc_id, text, *_ in data]
    name: dict = {}
    for doc_id, s in sets:
        if doc_id is not None and s:
            name[s] = min(name.get(s, doc_id), doc_id)
    distinct = list(name)
    links = [
        (name[x], name[y])
        for i, x in enumerate(distinct)
        for y in distinct[:i]
        if 100 * len(x & y) >= percent * len(x | y)
    ]
    least = least_reachable(set(name.values()), links)
    result: Counter = Counter()
    for doc_id, s in sets:
        component = None if doc_id is None else least[name[s]] if s else doc_id
        result[(doc_id, len(s), component, doc_id is None or component == doc_id)] += 1
    return result
