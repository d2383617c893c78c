"""Toxicity: a weighted finite-state grammar, composed of small transducers, that scores clauses.

The word transducer reads letters and writes a class: insult, threat, person, negation, report or
other. Its insult arcs (whole words, and stems that end in any letters) are learned from labelled
documents; the closed classes are short word lists. The clause transducer reads classes, moves
between a few states and weighs an insult or a threat by what stands before it: a person aimed at
raises it, a negation or a report of somebody else's words lowers it. A clause's score is the
weight of its path, a repeated word counts once, where it weighs most; a document's score is a logistic function of its clauses' scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.llm.common import plain

#: Bounds of the labelled sample the grammar is learned from, toxic and other rows.
MAX_TOXIC, MAX_OTHER = 4000, 8000
#: Fewest distinct contexts in toxic rows for an arc, shortest stem, and letters tried beyond it.
MIN_CONTEXTS, STEM, STEM_MORE = 5, 4, 2
#: Least logarithm of the odds of an arc, the weight at which arcs are cut off, and how sure an arc has
#: to be: the log-likelihood ratio that chance reaches for one of a million arcs.
MIN_ODDS, MAX_WEIGHT, SURE = 2.0, 6.0, 24.0
#: Relative error of context counts; what an arc holds in memory grows with its inverse square.
CONTEXT_ERROR = 0.08
THRESHOLD = 0.7

# Words of the closed classes, in the languages of the tables.
PERSON = """you your yours yourself ya u he she they them their him her these those people
du dich dir dein deine ihr euch euer sie er tu te toi ton ta tes vous votre vos il elle ils
tú usted ustedes vosotros tus su sus él ella ellos""".split()
NEGATION = """not no never nobody isn't aren't don't doesn't wasn't without
nicht kein keine nie niemals ohne ne pas jamais aucun sans nunca jamás ningún sin""".split()
REPORT = """said says say told called calls quoted quote wrote writes reported claims claimed
sagte sagt nannte schrieb zitierte dit disait appelé écrit cité dijo dice llamó escribió citó""".split()
THREAT = """kill hurt beat stab shoot burn destroy strangle punch die murder smash
töten umbringen schlagen sterben tuer frapper mourir brûler matar golpear morir quemar""".split()

OTHER, INSULT, THREATEN, AIMED, NOT, SAID = range(6)
_CLASSES = {w: c for c, ws in ((THREATEN, THREAT), (AIMED, PERSON), (NOT, NEGATION), (SAID, REPORT)) for w in ws}
_LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")

# States of the clause transducer.
START, TARGETED, NEGATED, REPORTED = range(4)
#: (state, class): next state. Where none is given, the state stays.
MOVES = {
    (START, AIMED): TARGETED,
    (START, NOT): NEGATED,
    (TARGETED, NOT): NEGATED,
    (START, SAID): REPORTED,
    (TARGETED, SAID): REPORTED,
}
#: What an insult or threat weighs in a state; a threat alone is weak, one at a person is strong.
FACTOR = {
    (START, INSULT): 1.0,
    (TARGETED, INSULT): 1.25,
    (NEGATED, INSULT): 0.6,
    (REPORTED, INSULT): 0.5,
    (START, THREATEN): 0.1,
    (TARGETED, THREATEN): 0.4,
    (NEGATED, THREATEN): 0.0,
    (REPORTED, THREATEN): 0.1,
}
THREAT_WEIGHT = 2.0


@dataclass
class Grammar:
    """Learned arcs and the logistic function over clause scores."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-3.0, 0.5, 0.5)

    def read(self, word: str) -> tuple[int, float]:
        """The class and weight that the word transducer writes for a word."""
        weight = self.words.get(word)
        if weight is None:
            for k in range(STEM + STEM_MORE, STEM - 1, -1):
                if len(word) > k and (weight := self.stems.get(word[:k])) is not None:
                    break
        if weight is not None:
            return INSULT, weight
        kind = _CLASSES.get(word, OTHER)
        return kind, THREAT_WEIGHT if kind == THREATEN else 0.0

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses in which the composed transducers match, in their order."""
        known: dict[str, tuple[int, float]] = {}
        found = []
        for clause in _CLAUSE.split(text.lower()):
            state, best, counted = START, 0.0, {}
            for word in _LETTERS.findall(clause):
                got = known.get(word)
                if got is None:
                    got = known[word] = self.read(word)
                kind, weight = got
                if kind:
                    value = weight * FACTOR.get((state, kind), 0.0)
                    if value > counted.get(word, 0.0):
                        best += value - counted.get(word, 0.0)
                        counted[word] = value
                    state = MOVES.get((state, kind), state)
            if best > 0:
                found.append(best)
        return found

    @staticmethod
    def features(found: list[float]) -> tuple[float, float]:
        return max(found, default=0.0), math.log1p(sum(found))

    def score(self, text: str | None) -> float:
        bias, best, total = self.weights
        x, y = self.features(self.clauses(text or ""))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + best * x + total * y))))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, train: Column, *, ident: str, text: str, label: str
) -> DataFrame:
    """(__id, text, label) of at most MAX_TOXIC and MAX_OTHER labelled rows, the first by digest.

    Only the ids of labelled rows are ranked; their number is bounded before a text is read.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(ident).isNotNull())
    rows = rows.select(F.col(ident).alias("__id"), F.col(label).cast("int").alias("__toxic"))
    rows = rows.withColumn("__order", F.md5(F.col("__id").cast("string")))
    rows = rows.where(train)
    sets = [
        rows.where(F.col("__toxic") == 1).orderBy("__order", "__id").limit(MAX_TOXIC),
        rows.where(F.col("__toxic") == 0).orderBy("__order", "__id").limit(MAX_OTHER),
    ]
    chosen = sets[0].union(sets[1]).select("__id", "__toxic")
    texts = docs.select(F.col(ident).alias("__id"), F.col(text).alias("__text"))
    return F.broadcast(chosen).join(texts, "__id").where("__text IS NOT NULL")


def _arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(arc, toxic, context) of every word and stem; a context is the words beside it."""
    # A slice holds few texts, so that not all of their arcs are held at once.
    for batch in (b.slice(k, 100) for b in batches for k in range(0, b.num_rows, 100)):
        arcs, flags, contexts = [], [], []
        for toxic, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = ["", *_LETTERS.findall(body.lower()), ""]
            seen = set()
            for before, word, after in zip(words, words[1:], words[2:], strict=False):
                for arc in (word + "$", *(word[:k] for k in range(STEM, STEM + STEM_MORE + 1) if len(word) > k)):
                    if arc not in seen:
                        seen.add(arc)
                        arcs.append(arc)
                        flags.append(toxic)
                        near = xxhash.xxh3_64_intdigest(f"{before} {word} {after}")
                        contexts.append(near - (1 << 63))
        yield pa.RecordBatch.from_arrays(
            [pa.array(arcs, pa.string()), pa.array(flags, pa.int32()), pa.array(contexts, pa.int64())],
            ["arc", "toxic", "context"],
        )


def learn(sample: DataFrame) -> Grammar:
    """Arcs by their odds over distinct contexts, then the logistic function over clause scores.

    Copies of one document share their contexts, so that they count once. The sample is bounded, and
    so is what it has in arcs and feature rows.
    """
    rows = sample.select("__toxic", "__text")
    sizes = {r[0]: r[1] for r in rows.groupBy("__toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Grammar()
    counted = (
        rows.mapInArrow(_arcs, "arc string, toxic int, context bigint")
        .groupBy("arc")
        .agg(
            F.approx_count_distinct(F.when(F.col("toxic") == 1, F.col("context")), CONTEXT_ERROR).alias("bad"),
            F.sum(1 - F.col("toxic")).alias("good"),
        )
        .where(F.col("bad") >= MIN_CONTEXTS)
    )
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log(
        (F.col("good") + 0.5) / (sizes[0] + 1)
    )
    share = sizes[1] / (sizes[0] + sizes[1])
    ratio = F.expr(
        f"2 * (bad * ln(bad / ((bad + good) * {share}D)) + "
        f"IF(good > 0, good * ln(good / ((bad + good) * (1D - {share}D))), 0D))"
    )
    sure = counted.withColumn("odds", odds).where((F.col("odds") >= MIN_ODDS) & (ratio >= SURE))
    kept = sure.collect()
    grammar = Grammar()
    weight = {r["arc"]: min(MAX_WEIGHT, r["odds"]) for r in kept}
    bad = {r["arc"]: r["bad"] for r in kept}
    for arc in sorted(weight, key=len):
        if not arc.endswith("$"):
            # The shortest stem that is as sure as any: longer ones are read by it.
            if not any(arc[:k] in grammar.stems for k in range(STEM, len(arc))):
                grammar.stems[arc] = weight[arc]
    for arc, w in weight.items():
        word = arc[:-1]
        if arc.endswith("$"):
            grammar.words[word] = w
            for k in range(STEM, STEM + STEM_MORE + 1):
                # A stem that only this word has is the word.
                if len(word) > k and word[:k] in grammar.stems and bad[arc] >= 0.95 * bad[word[:k]]:
                    del grammar.stems[word[:k]]

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Grammar.features(grammar.clauses(t.as_py())) for t in batch.column(1)]
            columns = [pa.array(batch.column(0).to_pylist(), pa.int32())]
            columns += [pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "best", "total"])

    data = rows.mapInArrow(featured, "toxic int, best double, total double").collect()
    table = np.array([(1.0, r["best"], r["total"], r["toxic"]) for r in data])
    grammar.weights = _logistic(table[:, :3], table[:, 3])
    return grammar


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> tuple[float, ...]:
    """Newton's method with a ridge on all but the bias."""
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def train_grammar(
    docs: DataFrame,
    labels: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Grammar:
    """Learn from labelled rows but for those held out (crc32 of the id as text, mod 3, is 1)."""
    train = F.expr("crc32(CAST(CAST(__id AS STRING) AS BINARY)) % 3 <> 1")
    return learn(labelled_sample(docs, labels, train, ident=ident, text=text, label=label))


def score_toxicity(docs: DataFrame, grammar: Grammar, *, text: str = "text") -> DataFrame:
    """All input rows and columns and `score` (an underscore is added if there is such a column).

    A null or empty text matches nothing and gets the lowest score. Equal texts get equal scores, no
    other column has a part in them. An empty table gives an empty table.
    """
    name = plain("score", docs.columns)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [grammar.score(t.as_py()) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def without_toxic(
    docs: DataFrame,
    grammar: Grammar,
    *,
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    name = plain("score", docs.columns)
    return score_toxicity(docs, grammar, text=text).where(F.col(name) < threshold).select(*docs.columns)
