"""The numbered queries over the given tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agoralake.llm.brown import score_texts, train_classes
from agoralake.llm.collocations import collocations
from agoralake.llm.common import small_batches
from agoralake.llm.divergence import source_divergence
from agoralake.llm.grammar import THRESHOLD, score_toxicity, train_grammar
from agoralake.llm.html_text import extract_text, train_field
from agoralake.llm.line_dedup import line_dedup
from agoralake.llm.mixing import BLOCK, mix_sources
from agoralake.llm.ngram_join import ngram_components
from agoralake.llm.packing import BUCKETS, BUDGET, MAX_LEN, pack
from agoralake.llm.quality_bands import quality_bands
from agoralake.llm.substring_dedup import substring_dedup
from agoralake.llm.url_lists import filter_urls
from agoralake.llm.vector_links import near_vectors


def _table(spark: SparkSession, folder: str, name: str, rows: int = 1000) -> DataFrame:
    """A whole table, whose texts go to Python `rows` at a time."""
    small_batches(spark, rows)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sha256(column: str) -> F.Column:
    return F.sha2(F.coalesce(F.col(column), F.lit("")).cast("binary"), 256)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", _sha256("text").alias("kept_sha256")
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source")
    return mix_sources(docs)


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with the time of their fetch, spread over a year by a digest of their id."""
    digest = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 6), 16, 10).cast("int")
    hours = F.expr("make_dt_interval(0, hours)")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return pages.select("page_id", "url", (digest % 8784).alias("hours")).select(
        "page_id", "url", (start + hours).alias("fetched_at")
    )


def _entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, parent domains and first folders that occur in the pages."""
    host = F.regexp_extract("url", "://([^/?#:]+)", 1)
    keys = pages.select(
        F.explode(
            F.array(
                host,
                F.regexp_replace(host, r"^[^.]+\.", ""),
                F.concat(host, F.regexp_extract("url", "://[^/?#]+(/[^/?#]+/)", 1)),
            )
        ).alias("key")
    ).distinct()
    rows = keys.select("key", F.explode(F.array(*map(F.lit, range(6)))).alias("turn"))
    digest = F.md5(F.concat_ws("#", "key", "turn"))
    rows = rows.withColumn("h", F.conv(F.substring(digest, 1, 6), 16, 10).cast("int"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return rows.where("h % 3 = 0").select(
        "key",
        F.expr("element_at(array('block', 'allow', 'remove'), CAST(h DIV 3 % 3 + 1 AS INT))").alias("verdict"),
        (start + F.expr("make_dt_interval(CAST(h DIV 9 % 360 AS INT))")).alias("listed_at"),
    )


def op4_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(_captures(pages), _entries(pages), ident="page_id")


def op5_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality_bands(docs).drop("text")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(_table(spark, folder, "documents"), words=4, percent=85)


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return extract_text(pages.select("page_id", "url", "html"), train_field(pages))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    grammar = train_grammar(docs, _table(spark, folder, "labels"))
    held = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1")
    return score_toxicity(docs, grammar).select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op3_vector_links(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents", rows=400))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(_table(spark, folder, "documents", rows=200))


def op13_brown_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held = F.expr("crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)) % 7 = 2")
    scored = score_texts(docs, train_classes(docs.where(~held)))
    return scored.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_vector_links": op3_vector_links,
    "op4_url_lists": op4_url_lists,
    "op5_compression_bands": op5_compression_bands,
    "op6_line_dedup": op6_line_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_pack": op8_pack,
    "op9_html_text": op9_html_text,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_divergence": op12_divergence,
    "op13_brown_score": op13_brown_score,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM again),
words AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP2 = f"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s, md5(CAST(doc_id AS VARCHAR)) AS d
  FROM documents),
placed AS (
  SELECT doc_id, source, s, (row_number() OVER (PARTITION BY s ORDER BY d) - 1) // {BLOCK} AS block
  FROM docs),
shares AS (
  SELECT s, CAST(round(sqrt(count(*))) AS BIGINT) AS p FROM docs GROUP BY s),
one AS (
  SELECT list(s ORDER BY s) AS names, list(p ORDER BY s) AS ps, CAST(sum(p) AS BIGINT) AS q
  FROM shares),
turns AS (
  SELECT 0::BIGINT AS t, [0::BIGINT for x in ps] AS done, 0::BIGINT AS pick, 0::BIGINT AS turn
  FROM one
  UNION ALL
  SELECT t + 1, [CASE WHEN i = k THEN done[i] + 1 ELSE done[i] END for i in range(1, len(done) + 1)],
         k, done[k]
  FROM (
    SELECT t, done, list_min([
      CASE WHEN done[i] * q // ps[i] <= t
           THEN {{'due': ((done[i] + 1) * q + ps[i] - 1) // ps[i], 'i': i}} END
      for i in range(1, len(ps) + 1)]).i AS k, q
    FROM turns, one)
  WHERE t < q),
plan AS (
  SELECT names[pick] AS s, turn, t - 1 AS slot, q, ps[pick] AS p FROM turns, one WHERE t > 0)
SELECT doc_id, source, block, (block // p) * q + slot AS slot
FROM placed JOIN plan ON placed.s = plan.s AND block % p = turn
"""

OP3 = """
WITH RECURSIVE
good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM good x JOIN good y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, links.b FROM reach r JOIN links ON links.a = r.y)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""

OP4 = r"""
WITH hosts AS (
  SELECT page_id, url, regexp_extract(url, '://([^/?#:]+)', 1) AS host,
         regexp_extract(url, '://[^/?#]+(/[^/?#]+/)', 1) AS folder,
         TIMESTAMP '2024-01-01' + to_hours(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6)
           AS BIGINT) % 8784) AS fetched_at
  FROM pages),
keys AS (
  SELECT host AS key FROM hosts
  UNION SELECT regexp_replace(host, '^[^.]+\.', '') FROM hosts
  UNION SELECT host || folder FROM hosts),
turns AS (
  SELECT key, CAST('0x' || substr(md5(key || '#' || turn), 1, 6) AS BIGINT) AS h
  FROM keys, range(6) AS r(turn)),
entries AS (
  SELECT key, ['block', 'allow', 'remove'][h // 3 % 3 + 1] AS verdict,
         TIMESTAMP '2024-01-01' + to_days(CAST(h // 9 % 360 AS INTEGER)) AS listed_at
  FROM turns WHERE h % 3 = 0),
once AS (
  SELECT key, listed_at,
         max_by(verdict, list_position(['allow', 'block', 'remove'], verdict)) AS verdict
  FROM entries GROUP BY key, listed_at),
held AS (
  SELECT *, coalesce(lead(listed_at) OVER (PARTITION BY key ORDER BY listed_at),
                     TIMESTAMP '9999-12-01') AS until
  FROM once),
asked AS (
  SELECT page_id, url, fetched_at, host, string_split(host, '.') AS labels,
         list_filter(string_split(regexp_extract(url, '://[^/?#]*(/[^?#]*/)', 1), '/'), lambda x: x <> '')
           AS folders
  FROM hosts),
domains AS (
  SELECT *, array_to_string(labels[k:], '.') AS name
  FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS k FROM asked)),
under AS (
  SELECT page_id, url, fetched_at, name AS key FROM domains
  UNION
  SELECT page_id, url, fetched_at, name || '/' || array_to_string(folders[:n], '/') || '/'
  FROM (SELECT *, unnest(range(1, len(folders) + 1)) AS n FROM domains)),
best AS (
  SELECT page_id, max_by({'k': u.key, 'v': verdict, 'f': listed_at}, {'l': length(u.key), 'k': u.key}) AS b
  FROM under u JOIN held h ON u.key = h.key AND fetched_at >= listed_at AND fetched_at < until
  WHERE verdict <> 'remove' GROUP BY page_id)
SELECT a.page_id, a.url, a.fetched_at, b.v AS verdict, b.k AS list_key, b.f AS listed_since
FROM asked a LEFT JOIN best USING (page_id)
"""

OP6 = f"""
WITH lines AS (
  SELECT doc_id, n, parts[n] AS line,
         translate(trim(parts[n], {_SPACES}), {_LOWER}) AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
hot AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, n, line, coalesce(doc_id <> keeper, false) AS gone
  FROM lines LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7 = rf"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s
  FROM docs),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
counted AS (SELECT g, list(doc_id) AS ids FROM grams GROUP BY g HAVING count(*) > 1),
pairs AS (
  SELECT a, b, count(*) AS k
  FROM (SELECT a, unnest(ids) AS b FROM (SELECT ids, unnest(ids) AS a FROM counted))
  WHERE a < b GROUP BY a, b),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, e.b FROM reach r JOIN either e ON e.a = r.y)
SELECT doc_id, n AS n_shingles, component_id
FROM sizes JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""


def _pack_sql(buckets: int = BUCKETS) -> str:
    steps = []
    for k in range(2, buckets + 1):
        steps.append(f"""
b{k} AS (
  SELECT e, least(any_value(old), min(cost)) AS pad,
         CASE WHEN min(cost) < any_value(old) THEN min(i) FILTER (cost = low) END AS prev
  FROM (
    SELECT x.e, x.pad AS old, y.e AS i,
           y.pad + x.e * (x.many - y.many) - (x.mass - y.mass) AS cost,
           min(y.pad + x.e * (x.many - y.many) - (x.mass - y.mass)) OVER (PARTITION BY x.e) AS low
    FROM (SELECT * FROM b{k - 1} JOIN h USING (e)) x
    LEFT JOIN (SELECT * FROM b{k - 1} JOIN h USING (e)) y ON y.e < x.e)
  GROUP BY e)""")
    tops = [f"t{buckets} AS (SELECT max(e) AS e FROM h)"]
    for k in range(buckets, 1, -1):
        # Where a level has no split, the boundary passes on unchanged to the level below.
        tops.append(
            f"t{k - 1} AS (SELECT coalesce(prev, e) AS e FROM t{k} JOIN b{k} USING (e))"
        )
    ends = " UNION ".join(f"SELECT e FROM t{k}" for k in range(1, buckets + 1))
    return f"""
WITH docs AS (
  SELECT doc_id, CAST(len({_WORDS}) AS BIGINT) AS words FROM documents),
pieces AS (
  SELECT doc_id, piece, least(words - piece * {MAX_LEN}, {MAX_LEN}) AS n
  FROM (SELECT doc_id, words,
               unnest(range(CAST(greatest(words - 1, 0) // {MAX_LEN} + 1 AS BIGINT))) AS piece FROM docs)),
h AS (
  SELECT n AS e, CAST(sum(count(*)) OVER (ORDER BY n) AS BIGINT) AS many,
         CAST(sum(n * count(*)) OVER (ORDER BY n) AS BIGINT) AS mass
  FROM pieces GROUP BY n),
b1 AS (SELECT e, e * many - mass AS pad, CAST(NULL AS BIGINT) AS prev FROM h),
{",".join(steps).strip()},
{", ".join(tops)},
ends AS ({ends}),
rows AS (
  SELECT doc_id, piece, n, (SELECT min(e) FROM ends WHERE e >= n) AS b,
         md5(CAST(doc_id AS VARCHAR) || '/' || CAST(piece AS VARCHAR)) AS d
  FROM pieces),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY b ORDER BY d) - 1 AS r, {BUDGET} // greatest(b, 1) AS per
  FROM rows)
SELECT doc_id, piece, piece * {MAX_LEN} AS start, n AS n_tokens, b AS bucket_len, r // per AS batch,
       r % per AS "row", b - n AS padding
FROM placed
"""

OP11 = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, g AS phrase, k, count(*) AS a
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM starts, range(1, 5) AS s(k) WHERE i + k - 1 <= len(w))
  GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS p FROM grams WHERE a >= 30),
inside AS (
  SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS best
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM often WHERE k > 2))
  GROUP BY ALL),
kept AS (
  SELECT o.* FROM often o LEFT JOIN inside s ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE k > 1 AND (best IS NULL OR 100 * best::HUGEINT < 80 * a::HUGEINT)),
cuts AS (
  SELECT c.*, x.a AS l, y.a AS r, 2000000 * c.a::HUGEINT // (x.a + y.a) AS score
  FROM (SELECT *, array_to_string(p[1:cut], ' ') AS x, array_to_string(p[cut + 1:], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)) c
  JOIN often x ON x.lang = c.lang AND x.phrase = c.x
  JOIN often y ON y.lang = c.lang AND y.phrase = c.y),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
terms AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 30),
sizes AS (
  SELECT l.lang, count(term) AS v FROM (SELECT DISTINCT lang FROM docs) l
  LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
counts AS (
  SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n, any_value(v) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN sizes USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
         1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (n + 5 * v) AS p
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 5) // (n + 5 * v) AS q
  FROM counts JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM groups GROUP BY lang) USING (lang)
  GROUP BY lang, term, n, v),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
more AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


ORACLES: dict[str, str] = {
    "op3_vector_links": OP3,
    "op1_substring_dedup": OP1,
    "op2_mix_sources": OP2,
    "op4_url_lists": OP4,
    "op6_line_dedup": OP6,
    "op7_ngram_join": OP7,
    "op8_pack": _pack_sql(),
    "op11_collocations": OP11,
    "op12_divergence": OP12,
}
