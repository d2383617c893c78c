"""Columns named like those that operators make for themselves come back as they were."""

from __future__ import annotations

import pytest

from agoralake.llm.html_text import Field, extract_text
from agoralake.llm.line_dedup import line_dedup
from agoralake.llm.mixing import mix_sources, mixed
from agoralake.llm.ngram_join import one_of_each
from agoralake.llm.quality_bands import kept_documents, quality_bands
from agoralake.llm.substring_dedup import substring_dedup

NAMES = """__id __p __n __source __gone __turn __rank __slot __cycle __block __key __keeper __suspects __ref __starts
    __copy __words __raw __all __by __cut c0 c1 c2 id text_ body ref node component n_words n_lines""".split()

OPERATORS = {
    "op1": substring_dedup,
    "op2": mix_sources,
    "op2_mixed": mixed,
    "op5": quality_bands,
    "op5_kept": kept_documents,
    "op6": line_dedup,
    "op7_one": one_of_each,
    "op9": lambda docs: extract_text(docs.withColumnRenamed("text", "html"), Field()),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_clashing_columns_are_kept(spark, name):
    prose = " ".join(f"w{k}" for k in range(40)) + "\n" + "a line that is in all of these documents"
    rows = [
        (k, prose if k < 4 else f"{prose} {k} {' '.join(f'v{k}x{j}' for j in range(60))}", "ab"[k % 2], *[f"{n}-{k}" for n in NAMES])
        for k in range(8)
    ]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in NAMES)
    docs = spark.createDataFrame(rows, schema)
    out = OPERATORS[name](docs)
    kept = [c for c in docs.columns if c != "text"]
    assert [c for c in out.columns if c in kept] == kept
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) >= 4
    for k, row in got.items():
        assert row["source"] == "ab"[k % 2] and all(row[n] == f"{n}-{k}" for n in NAMES)


@pytest.mark.parametrize("name", ["text", "c0", "__body"])
def test_any_name_of_the_text(spark, name):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], f"c1 bigint, {name} string")
    assert substring_dedup(docs, text=name).columns == ["c1", name, "n_words", "n_removed"]
    assert sorted(r[0] for r in substring_dedup(docs, text=name).collect()) == [1, 2]
    assert sorted(r[0] for r in line_dedup(docs, ident="c1", text=name).collect()) == [1, 2]
