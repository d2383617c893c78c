from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) rows; other columns may be null."""

    def make(rows, schema=DOCS):
        width = len(schema.split(","))
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)

    return make


@pytest.fixture
def prose():
    """Texts of invented words, with copies, near copies, shared passages and odd ones."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 20

    def text(n):
        out = []
        for k in range(n):
            out.append(rng.choice(vocabulary))
            out.append("\n" if k % 13 == 12 else " ")
        return "".join(out).rstrip(" ")

    rows = [text(rng.randint(1, 160)) for _ in range(60)]
    passage, line = text(45).replace("\n", " "), "A Line That Many Documents Share, as they do"
    for k in range(0, 24, 3):
        rows[k] = rows[k] + "\n" + passage + "\n" + text(5)
    for k in range(0, 40, 2):
        rows[k] = f"{line.upper() if k % 4 else line}  \n" + rows[k]
    base = text(150)
    for k in range(25):  # a group of near copies
        near = base.split(" ")
        near[rng.randrange(len(near))] = f"x{k}"
        rows.append(" ".join(near))
    rows += [rows[5]] * 6 + ["a " * 90, "a " * 140, "a b " * 60, "", None, " \n\t ", "one", "one two three", "ONE two three"]
    rows.append(text(3000))
    rng.shuffle(rows)
    return list(enumerate(rows))
