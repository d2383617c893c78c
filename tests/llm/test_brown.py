"""The class model against plain sums: gains, base scores, and probabilities that add up to one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from agoralake.llm import brown
from agoralake.llm.brown import END, FIRST, RARE, gains, score_texts, train_classes

SMALL = {"n_classes": 6, "core": 60, "local": 120, "rounds": 4}


def tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [""]


def likelihood(pairs, classes):
    """Of the classes' bigrams, up to what moving words between classes does not change."""
    both, left, right = Counter(), Counter(), Counter()
    for (a, b), n in pairs.items():
        both[classes[a], classes[b]] += n
        left[classes[a]] += n
        right[classes[b]] += n
    f = lambda sums: sum(n * math.log(n) for n in sums.values() if n)
    return f(both) - f(left) - f(right)


def test_gain_is_the_difference_of_likelihoods():
    rng = random.Random(3)
    n_words, n_classes = 30, FIRST + 4
    pairs = Counter((rng.randrange(n_words), rng.randrange(n_words) // 2) for _ in range(900))
    classes = [END, RARE] + [rng.randrange(FIRST, n_classes) for _ in range(n_words - 2)]
    now = np.zeros((n_classes, n_classes), int)
    for (a, b), n in pairs.items():
        now[classes[a], classes[b]] += n
    for word in range(2, 12):
        before, after = np.zeros(n_classes), np.zeros(n_classes)
        for (a, b), n in pairs.items():
            if a == word != b:
                after[classes[b]] += n
            if b == word != a:
                before[classes[a]] += n
        gain = gains(now, classes[word], before, after, pairs[word, word])
        want = []
        for k in range(FIRST, n_classes):
            moved = classes.copy()
            moved[word] = k
            want.append(likelihood(pairs, moved))
        assert np.allclose(gain - gain[0], np.array(want) - want[0])


@pytest.fixture
def corpus(documents, prose):
    return documents([(i, t) for i, t in prose] + [(900, "unheard-of words HERE"), (900, "ONE two"), (None, "one")])


def test_scores(spark, corpus):
    train = corpus.where("doc_id % 3 > 0")
    model = train_classes(train, **SMALL)
    got = score_texts(corpus, model).collect()
    assert len(got) == corpus.count()
    count = Counter(t for r in train.collect() for t in tokens(r.text))
    total, distinct = count.total(), len(count)
    # every word has a class, on one side or the other
    rest = {bytes(r.word): (r.c, r["class"]) for r in model.rest.collect()}
    known = {w: (int(c), int(k)) for w, c, k in zip(model.words.to_pylist(), model.counts, model.classes)}
    every = {**rest, **known}
    assert {w.decode(): c for w, (c, _) in every.items()} == dict(count)
    assert len(known) > model.core and len(rest) > len(known) - model.core
    in_class = Counter()
    for c, k in every.values():
        in_class[k] += c
    assert {k: int(n) for k, n in enumerate(model.bigrams.sum(0)) if n} == dict(in_class)
    steps, history = 10 ** model.transitions(), {w: k for w, (_, k) in list(known.items())[: model.core]}
    assert np.allclose(steps.sum(1), 1)

    def score(text):
        out, before = 0.0, b""
        for t in (t.encode() for t in tokens(text)):
            if t in every:
                c, k = every[t]
                out += math.log10((1 - model.unseen) * steps[history.get(before, RARE), k] * c / in_class[k])
            else:
                out += math.log10(model.unseen)
            before = t
        return out

    want = Counter()
    for r in corpus.collect():
        words = tokens(r.text)
        base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in words)
        want[r.doc_id, len(words), sum(t in count for t in words), total, round(base, 6), round(score(r.text), 6)] += 1
    assert Counter((*tuple(r)[:4], round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_classes_tell_held_out_texts_better(spark, documents):
    rng = random.Random(5)
    kinds = [[f"{c}{k}" for k in range(80)] for c in "abc"]
    rows = []
    for i in range(300):
        words = [rng.choice(kinds[(k + i) % 3])for k in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words)))
    docs = documents(rows)
    model = train_classes(docs.where("doc_id % 4 > 0"), n_classes=3, core=200, local=300, rounds=20)
    held = score_texts(docs.where("doc_id % 4 = 0"), model).agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > 0.87 * held["sum(base_score)"]
    groups = Counter((w[:1], int(k)) for w, k in zip(model.words.to_pylist()[1:], model.classes[1 : model.core]))
    assert sum(sorted(groups.values())[-3:]) > 0.9 * (model.core - 1)


def test_nothing_to_learn_from(spark, documents):
    model = train_classes(documents([]).limit(0), **SMALL)
    (row,) = score_texts(documents([(1, "a b")]), model).collect()
    assert tuple(row)[:4] == (1, 3, 0, 0) and row.base_score == 0 and math.isfinite(row.score) and row.score < 0
    assert score_texts(documents([]).limit(0), model).collect() == []


def test_words_that_tasks_hold_do_not_change_the_model(spark, corpus, monkeypatch):
    want = train_classes(corpus, **SMALL)
    monkeypatch.setattr(brown, "WORDS_HELD", 7)
    got = train_classes(corpus, **SMALL)
    assert got.words.to_pylist() == want.words.to_pylist() and got.counts.tolist() == want.counts.tolist()
    assert (got.bigrams == want.bigrams).all() and (got.tokens, got.once) == (want.tokens, want.once)
    rest = [sorted((bytes(r.word), r.c, r["class"]) for r in m.rest.collect()) for m in (got, want)]
    assert rest[0] == rest[1]
