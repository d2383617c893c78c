"""Source divergence against plain counts, whatever the slices and blocks."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from agoralake.llm import divergence
from agoralake.llm.divergence import source_divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"


def brute(rows, min_docs, top):
    docs = []
    for _, text, lang, source in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        docs.append((lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)))
    df, counts = Counter(), defaultdict(Counter)
    for lang, _, terms in docs:
        df.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= min_docs:
            kept[lang].append(t)
    for lang, source, terms in docs:
        counts[lang, source].update(t for t in terms if df[lang, t] >= min_docs)
        counts[lang, None].update(t for t in terms if df[lang, t] >= min_docs)

    def p(key, term):
        return 1 + 10**9 * (counts[key][term] + 5) // (counts[key].total() + 5 * len(kept[key[0]]))

    out = []
    for lang, source in [key for key in counts if key[1] is not None]:
        others = [s for g, s in counts if g == lang and s not in (None, source)]
        apart = [(sum(abs(p((lang, source), t) - p((lang, s), t)) for t in kept[lang]), s) for s in others]
        more = [(p((lang, source), t) - p((lang, None), t), t) for t in kept[lang] if counts[lang, source][t]]
        more = [x for x in more if x[0] > 0]
        for part, found, most in (("pair", apart, len(apart)), ("term", more, top)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.fixture
def rows(prose):
    sources = ["a", "b", "c", "", None, "d/ü", "e"]
    out = [(i, t, ["en", "fr", None, "xx"][i % 4] if i % 9 else "", sources[i * i % 7]) for i, t in prose]
    out += [(1000 + k, "Été über ÉTÉ 日本語 mixed-UP foo1bar", "fr", f"s{k % 11}") for k in range(40)]
    return out + [(2000, "lonely words", "zz", "one"), (2001, None, "yy", "one"), (2002, "", "yy", "two")]


@pytest.mark.parametrize("sizes", [{}, {"slice_terms": 97, "block_terms": 13, "block_sources": 2}])
def test_against_plain_counts(spark, rows, sizes):
    got = source_divergence(spark.createDataFrame(rows, SCHEMA), min_docs=5, top=7, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 7)


@pytest.mark.parametrize("held", [1 << 17, 3])
def test_frequent_terms_are_looked_up_a_few_times(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = [(k, "often " * 500 + "Twice twice" + " rare" * (k < 3), "en", "ab"[k % 2]) for k in range(8)]
    docs = divergence._rows(spark.createDataFrame(rows, SCHEMA).coalesce(1), "text", "lang", "source")
    found, looked_up = Counter(), 0
    for source, weight, terms in divergence._occurrences(docs).collect():
        assert len(set(terms)) == len(terms)
        found.update({(source, t): weight for t in terms})
        looked_up += len(terms)
    want = {"often en": (2000, 2000), "twice en": (8, 8), "rare en": (2, 1)}
    assert found == {(s, t): n[i] for t, n in want.items() for i, s in enumerate("ab")}
    assert looked_up <= 20
    documents = Counter()
    for term, n in divergence._documents_of(docs).collect():
        documents[term] += n
    assert documents == {"often en": 8, "twice en": 8, "rare en": 3}


def test_empty(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, "a b", "en", "x"), (1, "a b", "en", "y")], SCHEMA)
    assert sorted(map(tuple, source_divergence(only).collect())) == [
        ("en", "x", "pair", "y", 0, 1),
        ("en", "y", "pair", "x", 0, 1),
    ]
