from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from agoralake.llm.packing import best_boundaries, pack


def test_boundaries_have_the_least_padding():
    rng = np.random.default_rng(0)
    for _ in range(60):
        counts = rng.integers(0, 6, int(rng.integers(1, 14)))
        used = [k for k, n in enumerate(counts) if n]
        buckets = int(rng.integers(1, 5))
        got = best_boundaries(counts, buckets)
        if not used:
            assert got == []
            continue

        def padding(ends):
            return sum(n * (min(e for e in ends if e >= k) - k) for k, n in enumerate(counts) if n)

        best = min(
            padding((*some, used[-1])) for r in range(buckets) for some in combinations(used[:-1], min(r, len(used) - 1))
        )
        assert got[-1] == used[-1] and len(got) <= buckets and padding(got) == best


def test_batches_hold_every_word_once(documents, prose):
    out = pack(documents(prose), max_len=50, buckets=4, budget=200).collect()
    words = Counter()
    for r in out:
        words[r.doc_id] += r.n_tokens
        assert r.start == 50 * r.piece and r.n_tokens + r.padding == r.bucket_len
    assert words == {i: len((t or "").encode().split()) for i, t in prose}
    batches = Counter((r.bucket_len, r.batch) for r in out)
    for (length, batch), n in batches.items():
        assert n * length <= 200
        last = max(b for l, b in batches if l == length)
        assert batch == last or n == 200 // max(length, 1)
    assert len({(r.bucket_len, r.batch, r.row) for r in out}) == len(out)


def test_odd_input(documents):
    docs = documents([(None, None), (1, ""), (1, ""), (2, "a " * 120), (3, None)], "doc_id bigint, text string, piece string")
    out = pack(docs, max_len=50, buckets=2, budget=100)
    assert out.columns == ["doc_id", "piece", "start", "n_tokens", "bucket_len", "batch", "row", "padding"]
    assert sorted((str(r.doc_id), r.piece, r.n_tokens) for r in out.collect()) == [
        ("1", 0, 0), ("1", 0, 0), ("2", 0, 50), ("2", 1, 50), ("2", 2, 20), ("3", 0, 0), ("None", 0, 0)
    ]
    assert pack(documents([])).count() == 0
    with pytest.raises(ValueError):
        pack(docs, max_len=10, budget=5)
