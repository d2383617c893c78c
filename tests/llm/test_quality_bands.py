from __future__ import annotations

import base64
import random
from collections import Counter

import pytest
import zstandard

from agoralake.llm.quality_bands import ADDED, BANDS, CHUNKS, chunks, kept_documents, quality_bands


def _brute(text):
    body = text or ""
    w = body.encode().split()
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in body.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in body), dup, len(covered), failed)


def test_base_equals_brute_force(documents, prose):
    docs = [*prose, (900, "ab cd\n" * 3 + "#*é ñ 漢字 |"), (901, "x" * 3000)]
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_bands(documents(docs)).collect()
    }
    assert got == {i: _brute(t) for i, t in docs}


def test_bands_reject_what_repeats_or_does_not_compress(documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    clean = " ".join(word() for _ in range(3000))
    noise = " ".join("".join(chr(rng.randrange(0x100, 0x8000)) for _ in range(9)) for _ in range(400))
    # No five words repeat, but every chunk does nearly.
    near = " ".join(f"{'common part of every line ' * 1}{k} and so on" for k in range(900))
    lists = " ".join(str(k) for k in range(20000, 26000))
    rows = quality_bands(documents([(1, clean), (2, noise), (3, near), (4, lists)])).collect()
    assert {r.doc_id: r.kept for r in rows} == {1: True, 2: False, 3: False, 4: False}
    assert not next(r for r in rows if r.doc_id == 4).base_failed
    assert [r.doc_id for r in kept_documents(documents([(1, clean), (2, noise)])).collect()] == [1]


def _words(rng, size):
    out = []
    while sum(map(len, out)) + len(out) < size:
        out.append("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))))
    return " ".join(out)[:size].strip()


@pytest.mark.parametrize("size", [1500, 2047, 4000, 8100, 12000, 20000])
def test_an_incompressible_half_is_seen_at_any_length(documents, size):
    rng = random.Random(size)
    prose, noise = _words(rng, size), base64.b64encode(rng.randbytes(size)).decode()[: size // 2]
    tail = prose[: size - len(noise) - 1] + " " + noise
    front = noise + " " + prose[: size - len(noise) - 1]
    rows = quality_bands(documents([(1, prose), (2, tail), (3, front)])).collect()
    assert {r.doc_id: r.kept for r in rows} == {1: True, 2: False, 3: False}


def _verdict(text):
    """The bands' verdict from their definition, byte by byte."""
    body, press = (text or "").encode(), zstandard.ZstdCompressor(level=3)
    ratio = lambda x: len(press.compress(x)) / len(x)
    limits = [(low, high) for least, low, high in BANDS if least <= len(body)]
    if limits and not limits[-1][0] <= ratio(body) <= limits[-1][1]:
        return False
    rules = [rule for rule in CHUNKS if rule[0] <= len(body)]
    if not rules:
        return True
    _, size, low, high = rules[-1]
    at, bad, n = 0, 0, 0
    while at < len(body):
        begin = min(at, len(body) - size)
        bad += not low <= ratio(body[begin : begin + size]) <= high
        at, n = at + size, n + 1
    return 4 * bad <= n


def test_verdict_equals_the_definition(documents, prose):
    rng = random.Random(5)
    docs = list(prose)
    for k in range(120):
        parts = [_words(rng, rng.randint(50, 6000)), base64.b64encode(rng.randbytes(rng.randint(1, 3000))).decode()]
        docs.append((1000 + k, " ".join(rng.sample(parts, 2)) if k % 3 else parts[0]))
    got = {r.doc_id: r.kept for r in quality_bands(documents(docs)).collect()}
    assert got == {i: not _brute(t)[5] and _verdict(t) for i, t in docs}
    assert 40 < sum(got[1000 + k] for k in range(120)) < 120


def test_chunks_cover_the_text():
    for n in (0, 1, 1023, 1024, 1025, 2048, 4095, 4096, 8100, 8192, 50001):
        body = bytes(k * 7 % 251 for k in range(n))
        parts, _, _ = chunks(body)
        assert not parts if n < 1024 else len({len(x) for x in parts}) == 1
        if parts:
            assert len(parts) == -(-n // len(parts[0])) and parts[0] == body[: len(parts[0])]
            assert parts[-1] == body[-len(parts[0]) :]


def test_clashing_names_and_no_rows(documents):
    out = quality_bands(documents([(1, None, "x")], "doc_id bigint, text string, kept string"))
    assert out.columns == ["doc_id", "text", "kept", *list(ADDED)[:-1], "kept_"]
    row = out.first()
    assert (row.kept, row.kept_, row.ratio, row.n_words) == ("x", False, None, 0)
    assert quality_bands(documents([])).count() == 0
