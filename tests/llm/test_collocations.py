"""Collocations against a count over plain lists, and the graph's paths against a walk."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from agoralake.llm.collocations import collocations, unary_paths


def brute(rows, min_count, percent, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in f.items() if a >= min_count}
    inside = defaultdict(int)
    for (lang, g), a in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                inside[lang, g[i : i + k]] = max(inside[lang, g[i : i + k]], a)
    out = defaultdict(list)
    for (lang, g), a in often.items():
        if len(g) < 2 or 100 * inside[lang, g] >= percent * a and inside[lang, g]:
            continue
        score, cut = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
        phrase = " ".join(g)
        out[lang].append((-score, -a, phrase.encode(), phrase, f[lang, g[:cut]], f[lang, g[cut:]]))
    return sorted(
        (lang, rank, phrase, -a, left, right, total[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def table(spark, rows):
    return spark.createDataFrame([(k, t, g) for k, (g, t) in enumerate(rows)], "n bigint, text string, lang string")


def test_against_plain_counts(spark, prose):
    langs = ["en", "fr", None, "und", ""]
    rows = [(langs[i % 5], text) for i, text in prose]
    rows += [("en", "a a a a a a a a"), ("en", "x y z x y z x y z x y z, X Y Z\tx y"), ("fr", "Über ÉTÉ über été. Über été")] * 4
    rows += [("en", "  ,;\n . "), ("en", None), (None, "")]
    for min_count, percent, top in ((3, 80, 50), (5, 100, 2000), (30, 80, 2000)):
        got = collocations(table(spark, rows), min_count=min_count, percent=percent, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, min_count, percent, top)


def test_empty(spark):
    assert collocations(table(spark, []).limit(0)).collect() == []
    assert collocations(table(spark, [(None, None), ("en", "one two")])).collect() == []


def test_paths(spark, tmp_path):
    # a long path, a branch into it, a circle, a loop on itself, and a circle that a path enters
    line = [f"p{k}" for k in range(2100)]
    circle = [f"c{k}" for k in range(7)] * 2
    entered = ["e0", "e1", "e2"] + ["k0", "k1", "k2", "k3", "k4"] * 2
    edges = set()
    for words in (line, ["q", *line[500:503], "z"], circle[:10], ["o"] * 4, entered):
        edges |= {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
    rows = [("en", " ".join(e), 30 + i) for i, e in enumerate(sorted(edges))]
    weight = {r[1]: r[2] for r in rows}
    paths = unary_paths(spark.createDataFrame(rows, "lang string, gram string, n bigint"), str(tmp_path)).collect()
    seen = []
    for p in paths:
        words = p.gram.split(" ")
        grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
        assert [weight[g] for g in grams] == list(p.weights)
        seen += grams
    assert sorted(seen) == sorted(weight)
    length = Counter()
    for p in paths:
        length[p.head] += len(p.weights)
    # the line is cut at the branch's node (entered and left twice), the circle is one path
    assert sorted(length.values()) == sorted([500, 1597, 1, 1, 7, 1, 3, 5])
