from __future__ import annotations

import random

import numpy as np
import pytest

import brute
from agoralake.llm.ngram_join import MAX_MATCH, needed, ngram_components, one_of_each, ordered


def _got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_equals_brute_force(documents, prose, words, percent):
    got = _got(ngram_components(documents(prose), words=words, percent=percent))
    assert got == brute.jaccard(prose, words, percent)


def test_chains_of_near_copies(documents):
    rng = random.Random(4)
    text = [f"w{rng.randrange(300)}" for _ in range(80)]
    docs = []
    for k in range(30):  # each a little further from the first
        text = [*text]
        text[rng.randrange(80)] = f"n{k}"
        docs.append((100 - k, " ".join(text)))
    assert _got(ngram_components(documents(docs), words=4, percent=85)) == brute.jaccard(docs, 4, 85)


def test_prefixes_of_sets_at_the_threshold_share_enough():
    rng = np.random.default_rng(1)
    for _ in range(400):
        size, percent = int(rng.integers(1, 60)), int(rng.choice([50, 80, 85]))
        x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        swap = len(x) - needed(len(x), percent)
        keep = rng.permutation(x)[swap:]
        y = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, swap).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both):
            continue
        count = {int(g): int(g) % 7 for g in np.union1d(x, y)}
        for match in range(1, min(MAX_MATCH, needed(len(x), percent), needed(len(y), percent)) + 1):
            prefixes = []
            for s in (x, y):
                low, own, places = ordered(s, percent)
                order = sorted(own[:low], key=lambda g: (count[int(g)], g)) + list(own[low:])
                assert list(places[low:]) == list(range(low + 1, len(own) + 1))
                prefixes.append(order[: len(s) - needed(len(s), percent) + match])
            assert len(np.intersect1d(*prefixes)) >= match


def test_nulls_repeats_and_nothing(documents):
    text = "a b c d e f g h"
    docs = documents([(3, text), (3, text), (7, text.upper()), (None, text), (1, None), (2, " "), (9, "x"), (8, "X")])
    rows = sorted(map(str, ngram_components(docs, words=4, percent=85).collect()))
    assert [r.count("component_id=3") for r in rows].count(1) == 4
    assert sum("component_id=8" in r for r in rows) == 2
    kept = sorted(str(r["doc_id"]) for r in one_of_each(docs).collect())
    assert kept == ["1", "2", "3", "3", "8", "None"]
    assert ngram_components(documents([])).count() == 0
    assert one_of_each(documents([])).count() == 0


def test_several_texts_of_one_id(documents):
    words = [f"w{k}" for k in range(60)]
    near = " ".join([*words[:30], "x", *words[31:]])
    docs = documents([(5, "other text " * 20), (5, " ".join(words)), (9, near), (7, "z " * 9)])
    got = sorted((r.doc_id, r.component_id) for r in ngram_components(docs, words=4, percent=80).collect())
    assert got == [(5, 5), (5, 5), (7, 7), (9, 5)]
