from __future__ import annotations

import numpy as np
import pytest

from ledgerflow.llm.induced import Scratch, sorted_suffixes
from ledgerflow.llm.suffix_dedup import repeats_in_shard


def naive(text: list[int], cap: int) -> tuple[list[int], list[int]]:
    order = sorted(range(len(text)), key=lambda i: text[i:])
    prefix = [0]
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = 0
        while n < cap and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        prefix.append(n)
    return order, prefix


@pytest.mark.parametrize("seed", range(60))
def test_order_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    symbols = int(rng.choice([1, 2, 3, 6, 40]))
    text = rng.integers(1, symbols + 1, int(rng.integers(1, 160)))
    if seed % 3 == 0:
        text = np.tile(text[: 1 + len(text) // 6], 7)
    text = np.append(text, 0).astype(np.uint16)
    # A tiny memory limit sends every tuple through files.
    with Scratch(memory=150 if seed % 2 else 1 << 20) as scratch:
        order, prefix = sorted_suffixes(text, symbols + 1, 15, scratch)
    assert (order.tolist(), prefix.tolist()) == naive(text.tolist(), 15)


def test_scratch_files_are_removed(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    monkeypatch.setattr("tempfile.tempdir", None)
    text = np.append(np.tile(np.arange(1, 9), 40), 0).astype(np.uint16)
    with Scratch(memory=64) as scratch:
        sorted_suffixes(text, 9, 50, scratch)
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())


def test_windows_of_a_shard():
    a, b = bytes(range(60)) * 2, b"x" + bytes(range(60))
    found = repeats_in_shard([a, b, b"y" * 70], np.array([len(a) - 49, len(b) - 49, 21]), 50)
    assert found[0].tolist() == [*range(0, 11), *range(60, 71)]
    assert found[1].tolist() == list(range(1, 12))
    assert found[2].tolist() == list(range(21))
