"""Source divergence: which terms a source overuses, and how far the sources of a language lie apart.

Terms carry their language behind a space, which no term holds, so that one `CountVectorizer` holds the
terms that every language keeps: those of at least `min_docs` of its documents, counted inside tasks and
then by Spark. It is fitted to them with the greatest `vocabSize` there is and builds exact sparse count
vectors of what tasks add up per source, a vector for each power of two. Its model lies on the driver and in
every task; it is therefore fitted for slices of the terms, by hash, of about `SLICE` terms each: one
slice on tables of some hundred GB of text, and always all terms. Vectors are summed per group inside
tasks as index and count, as a Summarizer does with dense ones, and then over tasks.

Pairs are compared sparsely, over blocks of about TERMS terms and SOURCES x SOURCES sources. With d the
distance of two sources on a term that neither has, two sources differ by d on all terms, plus what
one's own terms change against the other's value for absent ones (from sorted prefix sums), plus a
correction for the terms that both have. No dense row of a source is ever built.

Probabilities are whole billionths and all sums are whole numbers. Null text, language and source are
''; a group without any kept term has count 0 for all. Only the three named columns are read; repeated
rows count as often as they occur, and an empty table gives no rows. Sources of one language need not
be few: the pair part is as long as the pairs that are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agoralake.llm.common import stored, work_folder
from agoralake.llm.words import Words, summed

# Fixed value: what stands between terms, which is all of ASCII but its letters.
BETWEEN = bytes(c for c in range(128) if not chr(c).isalpha())
#: Fixed values of the measure: whole parts of one, what every count is raised by, documents of a term.
PARTS, RAISE, MIN_DOCS, TOP = 1_000_000_000, 5, 30, 50
#: Terms of one fitted vocabulary, terms and sources of a block of pairs.
SLICE, TERMS, SOURCES = 1 << 20, 1024, 256
#: Distinct keys that a task holds before it hands their counts on.
HELD = 1 << 17


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = F.lit("")
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source).cast("string"), empty).alias("source"),
        F.col(text).cast("binary").alias("text"),
    )


def _named(batch: pa.RecordBatch, words: Words, part: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Rows and numbers of a batch's terms, and their names: the term, a space and its language.

    With part (k, n), the k-th of n parts of all terms, by hash.
    """
    langs = batch.column("lang").dictionary_encode()
    row, code = words.row, words.code
    if part[1] > 1:
        mine = words.hashes() % np.uint64(part[1]) == part[0]
        kept = mine[code]
        row, code = row[kept], code[kept]
    spoken = np.asarray(langs.indices, np.int64)[row]
    pair, at = np.unique(spoken * len(words.values) + code, return_inverse=True)
    lang, code = np.divmod(pair, max(len(words.values), 1))
    names = pc.binary_join_element_wise(
        words.values.take(pa.array(code)), langs.dictionary.cast(pa.binary()).take(pa.array(lang)), b" "
    )
    return row, at, names.cast(pa.string())


def _documents_of(docs: DataFrame, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """(term, n): documents with a term, added up within tasks; a term may come in several rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for batch in batches:
                row, at, names = _named(batch, Words.of(batch.column("text"), BETWEEN), part)
                once = np.unique(row * max(len(names), 1) + at) % max(len(names), 1)
                yield pa.table({"term": names, "n": np.bincount(once, minlength=len(names))})

        yield from summed(tables(), ["term"], HELD, [])

    return docs.mapInArrow(count, "term string, n bigint")


def _occurrences(docs: DataFrame, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """(source, weight, terms): occurrences of terms, added up within tasks and written in binary.

    A row holds the terms whose sum has that power of two, each once: a term that occurs a thousand times
    is read and looked up six times, and not a thousand.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for batch in batches:
                row, at, names = _named(batch, Words.of(batch.column("text"), BETWEEN), part)
                sources = batch.column("source").dictionary_encode()
                told = np.asarray(sources.indices, np.int64)[row]
                pair, n = np.unique(told * max(len(names), 1) + at, return_counts=True)
                source, term = np.divmod(pair, max(len(names), 1))
                source = sources.dictionary.take(pa.array(source))
                yield pa.table({"source": source, "term": names.take(pa.array(term)), "n": n})

        for batch in summed(tables(), ["source", "term"], HELD, ["source"]):
            sources, n = batch.column("source").dictionary_encode(), np.asarray(batch.column("n"))
            for power in range(int(n.max()).bit_length()):
                at = np.flatnonzero(n >> power & 1)
                # rows are sorted by source, so the numbers of sources never fall
                ends = np.searchsorted(np.asarray(sources.indices)[at], np.arange(len(sources.dictionary) + 1))
                terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("term").take(pa.array(at)))
                weight = pa.array([1 << power] * len(terms), pa.int64())
                yield pa.RecordBatch.from_arrays([sources.dictionary, weight, terms], ["source", "weight", "terms"])

    return docs.mapInArrow(count, "source string, weight bigint, terms array<string>")


def _slices(docs: DataFrame, min_docs: int, size: int) -> int:
    """A number of slices of about `size` kept terms or fewer.

    A term of `min_docs` documents is in a `min_docs`-th of them, drawn at random, with a chance of 0.63 or
    more, so the terms of such a draw outnumber 0.63 of those kept. Only the number is told from it.
    """
    drawn = _documents_of(docs.sample(1 / min_docs, 7))
    return 1 + int(drawn.agg(F.approx_count_distinct("term")).first()[0] / 0.6 // size)


def _group_sums(vectors: DataFrame) -> DataFrame:
    """(source, at, n): weights of a source added up at the indices of its vectors, which hold a term once."""
    entries = vectors.select("source", "weight", F.explode(F.unwrap_udt("vector")["indices"]).alias("at"))
    return entries.groupBy("source", "at").agg(F.sum("weight").alias("n"))


def term_counts(docs: DataFrame, min_docs: int, folder: str, slice_terms: int = SLICE) -> DataFrame:
    """(lang, source, term, n): occurrences of the terms that their language keeps, in every group."""
    spark = docs.sparkSession
    slices, out = _slices(docs, min_docs, slice_terms), None
    # a term that is none, so that an empty vocabulary is no error
    none = spark.range(1).select(F.array(F.lit(" ")).alias("terms"))
    for k in range(slices):
        kept = _documents_of(docs, (k, slices)).groupBy("term").agg(F.sum("n").alias("n"))
        kept = stored(kept.where(F.col("n") >= min_docs).select(F.array("term").alias("terms")), folder, f"kept-{k}")
        vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=1.0, vocabSize=(1 << 31) - 1)
        model = vectorizer.fit(kept.unionByName(none))
        names = pa.table({"at": pa.array(range(len(model.vocabulary)), pa.int32()), "name": model.vocabulary})
        named = spark.createDataFrame(names).where("name <> ' '").select(
            "at",
            F.expr("substring(name, locate(' ', name) + 1)").alias("lang"),
            F.substring_index("name", " ", 1).alias("term"),
        )
        vectors = model.transform(_occurrences(docs, (k, slices)))
        sums = _group_sums(vectors).join(named, "at").select("lang", "source", "term", "n")
        sums = stored(sums, folder, f"terms-{k}")
        out = sums if out is None else out.unionByName(sums)
    return out


def _p(count: Column, total: str, kept: str) -> Column:
    """1 + floor(PARTS (count + RAISE) / (total + RAISE kept)); null if nothing is kept."""
    shares = (count.cast("decimal(19,0)") + RAISE) * F.lit(PARTS).cast("decimal(10,0)")
    whole = F.col(total).cast("decimal(19,0)") + RAISE * F.col(kept).cast("decimal(19,0)")
    return 1 + F.call_function("div", shares, F.nullif(whole, F.lit(0)))


def _compared(table: pa.Table) -> pa.Table:
    """What the terms of one block add to the distance of each pair of its sources.

    Rows with a null term name the sources (number, absent); those of the lower source block have
    `left`. The first block of terms adds what all terms would if neither source had any.
    """
    col = {k: table.column(k) for k in table.column_names}
    named = np.asarray(col["term"].is_null())
    number, absent, p = (col[k].to_numpy() for k in ("number", "absent", "p"))
    left = np.asarray(col["left"])[named]
    order = np.argsort(number[named], kind="stable")
    numbers, base, left = number[named][order], absent[named][order], left[order]
    row = np.searchsorted(numbers, number[~named])
    value = p[~named].astype(np.int64)
    term = np.asarray(col["term"].filter(pa.array(~named)).combine_chunks().dictionary_encode().indices)
    n = len(numbers)
    away = np.abs(base[:, None] - base[None, :])
    own = np.zeros((n, n), np.int64)  # own[i, j]: i's terms against j's value for absent ones
    order = np.lexsort((value, row))
    for i, x in zip(*_runs(row[order], value[order]), strict=True):
        sums = np.concatenate([[0], np.cumsum(x)])
        below = np.searchsorted(x, base)
        own[i] = base * below - sums[below] + sums[-1] - sums[below] - base * (len(x) - below) - len(x) * away[i]
    out = own + own.T
    if col["first"][0].as_py():
        out += away * col["kept"][0].as_py()
    order = np.argsort(term, kind="stable")
    pair = np.stack([row, value], axis=1)[order]
    for _, both in zip(*_runs(term[order], pair), strict=True):
        r, x = both[:, 0], both[:, 1]
        if len(r) > 1:
            alone = np.abs(x[:, None] - base[r][None, :])
            at = np.ix_(r, r)
            out[at] += np.abs(x[:, None] - x[None, :]) - alone - alone.T + away[at]
    if col["same"][0].as_py():
        one, two = np.triu_indices(n, 1)
    else:
        one, two = (k.ravel() for k in np.meshgrid(np.flatnonzero(left), np.flatnonzero(~left), indexing="ij"))
    result = {"one": numbers[one], "two": numbers[two], "value": out[one, two]}
    lang = pa.array([col["lang"][0].as_py()] * len(one), pa.string())
    return pa.table({"lang": lang, **{k: pa.array(v, pa.int64()) for k, v in result.items()}})


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys of sorted ones, and the values of each."""
    if not len(keys):
        return keys, []
    cut = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate([[0], cut])], np.split(values, cut)


def _pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, one, two, value): the distance of two sources, by number, one < two."""
    one = ["lang", "kept", "number", "absent", "source_block", "source_blocks", "term_blocks"]
    term_block = F.expr("pmod(xxhash64(term), term_blocks)").cast("int")
    terms = counts.join(groups, ["lang", "source"]).select(
        *one, "term", _p(F.col("n"), "total", "kept").alias("p"), term_block.alias("block")
    )
    names = groups.select(*one, F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("p"))
    names = names.select("*", F.explode(F.expr("sequence(0, term_blocks - 1)")).alias("block"))
    rows = names.withColumn("block", F.col("block").cast("int")).unionByName(terms)
    rows = rows.select("*", F.explode(F.expr("sequence(0L, source_blocks - 1)")).alias("other"))
    rows = rows.select(
        "lang",
        "kept",
        "number",
        "absent",
        "term",
        "p",
        "block",
        F.least("source_block", "other").alias("low"),
        F.greatest("source_block", "other").alias("high"),
        (F.col("source_block") <= F.col("other")).alias("left"),
        (F.col("block") == 0).alias("first"),
        (F.col("source_block") == F.col("other")).alias("same"),
    )
    kind = "lang string, one bigint, two bigint, value bigint"
    parts = rows.groupBy("lang", "block", "low", "high").applyInArrow(_compared, kind)
    return parts.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    folder: str | None = None,
    slice_terms: int = SLICE,
    block_terms: int = TERMS,
    block_sources: int = SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group.

    Part `pair`: distance to each other source of the language. Part `term`: the `top` terms that
    the group uses more than its language does, by how much more.
    """
    folder = folder or work_folder(docs.sparkSession)
    docs = _rows(docs, text, lang, source)
    counts = term_counts(docs, min_docs, folder, slice_terms)
    in_lang = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang")), folder, "langs")
    langs = in_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = (
        docs.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "kept", "total_lang"])
        .withColumn("number", F.expr("row_number() OVER (PARTITION BY lang ORDER BY source) - 1").cast("bigint"))
        .withColumn("sources", F.expr("count(*) OVER (PARTITION BY lang)"))
    )
    groups = groups.select(
        "*",
        F.coalesce(_p(zero, "total", "kept"), zero).alias("absent"),
        F.expr(f"number DIV {block_sources}").alias("source_block"),
        F.expr(f"1 + (sources - 1) DIV {block_sources}").alias("source_blocks"),
        F.expr(f"CAST(1 + greatest(kept - 1, 0) DIV {block_terms} AS INT)").alias("term_blocks"),
    )
    groups = stored(groups, folder, "groups")

    pairs = _pairs(groups, counts)
    named = groups.select("lang", "number", "source")
    pairs = pairs.join(named.withColumnsRenamed({"number": "one", "source": "a"}), ["lang", "one"])
    pairs = pairs.join(named.withColumnsRenamed({"number": "two", "source": "b"}), ["lang", "two"])
    both = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    pairs = pairs.select("lang", "value", F.explode(both).alias("e")).select("lang", "e.source", "e.item", "value")

    more = counts.join(groups, ["lang", "source"]).join(in_lang, ["lang", "term"])
    own, whole = _p(F.col("n"), "total", "kept"), _p(F.col("n_lang"), "total_lang", "kept")
    more = more.select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value")).where("value > 0")
    rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)")
    more = more.withColumn("rank", rank).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    pairs = pairs.withColumns({"rank": rank, "part": F.lit("pair")}).select(*columns)
    return pairs.unionByName(more.withColumn("part", F.lit("term")).select(*columns))
