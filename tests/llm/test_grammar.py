from __future__ import annotations

import random
import zlib

from agoralake.llm.grammar import Grammar, INSULT, score_toxicity, train_grammar, without_toxic

LABELS = "doc_id bigint, quality int, toxic int"


def _corpus(n=900, seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(2, 7))) for _ in range(600)]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 80))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                bad = rng.choice(["grotbag", "numpty", "zwack" + rng.choice(["en", "er", "ig", "los", "o"])])
                words.insert(rng.randrange(len(words)), bad)
        docs.append((k, " ".join(words) + "."))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = _corpus()
    grammar = train_grammar(documents(docs), spark.createDataFrame(labels, LABELS))
    assert {"grotbag", "numpty"} <= set(grammar.words) and "zwac" in "".join(grammar.stems)
    got = {r.doc_id: r.score for r in score_toxicity(documents(docs), grammar).collect()}
    held = [k for k, _ in docs if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum((got[k] >= 0.7) == (k % 8 == 0) for k in held) / len(held) > 0.97
    kept = {r.doc_id for r in without_toxic(documents(docs), grammar).collect()}
    assert len(kept ^ {k for k, _ in docs if k % 8}) < 20


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    docs, labels = _corpus(400)
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, q, t in labels]
    a, b = (train_grammar(documents(docs), spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a == b


def test_clauses_weigh_what_stands_around():
    g = Grammar(words={"numpty": 3.0}, stems={"zwack": 3.0})
    assert g.read("numpty") == (INSULT, 3.0) and g.read("zwacken") == (INSULT, 3.0)
    assert g.read("zwack")[0] != INSULT and g.read("table") == (0, 0.0)
    one = lambda t: max(g.clauses(t), default=0.0)
    assert one("You numpty!") > one("numpty") > one("not a numpty") > one("he said numpty") > one("nothing")
    assert g.clauses("numpty. fine; zwacker\nnumpty") == [3.0, 3.0, 3.0]
    assert 0 < one("I will kill them") and one("kill time") < one("kill you now or you kill")
    assert g.score("") == g.score(None) == g.score("nothing here") < g.score("you numpty")


def test_odd_input(spark, documents):
    clash = documents([(1, None, "x"), (1, None, "x"), (None, "", "y")], "doc_id bigint, text string, score string")
    out = score_toxicity(clash, Grammar())
    assert out.columns == ["doc_id", "text", "score", "score_"]
    assert len({r.score_ for r in out.collect()}) == 1 and out.count() == 3
    assert score_toxicity(documents([]), Grammar()).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 0, 0)], LABELS)
    assert train_grammar(documents([(1, "a")]), odd) == Grammar()
    assert train_grammar(documents([]), spark.createDataFrame([], LABELS)) == Grammar()
