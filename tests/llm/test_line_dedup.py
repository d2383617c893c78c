from __future__ import annotations

import brute
from agoralake.llm.line_dedup import line_dedup


def _rows(df):
    return sorted(map(str, ((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect())))


def _want(docs):
    return sorted(
        str((i, n, d, t if t or src is not None else None))
        for (i, n, d, t), (_, src) in zip(brute.lines(docs), docs)
    )


def test_equals_brute_force(documents, prose):
    assert _rows(line_dedup(documents(prose))) == _want(prose)


def test_a_full_filter_changes_nothing(documents, prose):
    # 2 ** 9 bits are full at once: every line is suspected, the exact count decides.
    assert _rows(line_dedup(documents(prose), filter_bits=1 << 19)) == _want(prose)


def test_keys_ties_nulls_and_spaces(documents):
    line = "éèàç" * 5
    docs = [(k, f"\t{line} \r\nkeep {k}") for k in range(5)]
    docs += [(9, line + "\n" + line), (None, line), (10, line[:19]), (11, line[:19]), (12, line[:19]), (13, None), (14, "")]
    docs += [(9, line + "\n" + line)]
    assert _rows(line_dedup(documents(docs))) == _want(docs)


def test_clashing_names_and_no_rows(documents):
    clash = documents([(1, "a\nb", "x")], "doc_id bigint, text string, n_lines string")
    out = line_dedup(clash)
    assert out.columns == ["doc_id", "text", "n_lines", "n_lines_", "n_dropped"]
    assert tuple(out.first()) == (1, "a\nb", "x", 2, 0)
    assert line_dedup(documents([])).count() == 0
