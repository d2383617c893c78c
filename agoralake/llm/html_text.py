"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into blocks of text, each with the tags and class words above it. The field labels the
whole sequence of a page's blocks as article or not: weights of what stands above and in a block, and
of a label following another. It is trained on labelled pages by maximum likelihood and decoded by
Viterbi's algorithm, page by page, so pages never shuffle.

Labelled pages come from a bounded sample of the table's own. Where a page marks its article, by the
element, by `main` or by a class word for content, its blocks are labelled by that; each is then
rendered anew in several layouts, with and without such marks, with menus, sidebars, notices, adverts,
forms and comments around and between its paragraphs, so that the field learns from class words and
the shape of texts and not from one template. Where no page of the table marks its article, only such
renderings are learned from, with the pages' own prose as paragraphs.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agoralake.llm.common import plain

#: Bounds of training: pages, layouts of each, blocks of a page that are used, and steps.
MAX_PAGES, LAYOUTS, MAX_BLOCKS, STEPS = 150, 4, 120, 250
RIDGE, RATE = 0.02, 0.3

# Elements that break blocks, that hold code, that hold text which a page does not show
# or which belongs to a form, that may hold either, and that have no end.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu
    nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
CODE_TAGS = frozenset("script style".split())
SILENT_TAGS = frozenset("title textarea template iframe select button audio video canvas".split())
OPEN_TAGS = frozenset("noscript object".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that a start of the same element ends.
SELF_CLOSING = frozenset("p li dt dd tr td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: The next start or end of the same element.
_SAME = {
    t: re.compile(rf"<(/?){t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in CODE_TAGS | SILENT_TAGS | OPEN_TAGS
}


def _end(page: str, tag: str, at: int) -> re.Match | None:
    """Where the element ends; none if another one begins first or the page ends."""
    found = _SAME[tag].search(page, at)
    while found and tag in CODE_TAGS and not found[1]:
        found = _SAME[tag].search(page, found.end())
    return found if found and found[1] else None


@dataclass
class Block:
    text: str
    linked: int
    above: tuple[str, ...]


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    if not attributes or "=" not in attributes:
        return (tag,)
    found = {tag}
    for value in _NAMES.findall(attributes):
        found.update("." + w for w in _WORDS.findall(_CAMEL.sub(" ", value).lower()))
    return tuple(sorted(found))


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order, with the marks of all elements around them.

    Code is skipped to its end tag or else to the end of the page. What a page does not show and the
    text of form controls is skipped to its end tag; an element without one loses nothing but its tag.
    `noscript` and `object` are blocks of their own if they hold text. `head` is no block: its
    elements are of these kinds, whether it ends or not.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, at = 0, False, 0

    def close() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                marks = tuple(m for _, ms in stack for m in ms)
                out.append(Block(text, min(linked, len(text)), marks))
            parts.clear()
        linked, in_link = 0, False

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    while True:
        found = _TAG.search(page, at)
        add(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag, ending = found[2].lower(), bool(found[1])
        if tag in CODE_TAGS or tag in SILENT_TAGS:
            if not ending and not found[3].endswith("/"):
                last = _end(page, tag, at)
                at = last.end() if last else len(page) if tag in CODE_TAGS else at
                parts.append(" ")
        elif tag in OPEN_TAGS:
            last = None if ending else _end(page, tag, at)
            if last and not _TAG.sub("", page[at : last.start()]).strip():
                at = last.end()
            elif ending or last:
                close()
                if not ending:
                    stack.append((tag, _marks(tag, found[3])))
                elif any(t == tag for t, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
        elif tag == "a":
            in_link = not ending
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS:
            close()
            if ending:
                names = [t for t, _ in stack]
                if tag in names:
                    del stack[len(names) - 1 - names[::-1].index(tag) :]
            elif tag not in VOID_TAGS:
                # A paragraph ends where any block begins, a cell or item where the next one does.
                if stack and stack[-1][0] == "p":
                    stack.pop()
                if stack and tag in SELF_CLOSING and stack[-1][0] == tag:
                    stack.pop()
                stack.append((tag, _marks(tag, found[3])))
    close()
    return out


def features(block: Block) -> list[str]:
    """What the field sees of a block: marks above it, its own element, and the shape of its text."""
    text = block.text
    n, words = len(text), text.count(" ") + 1
    marks = set(block.above)
    out = ["^" + m for m in marks]
    own = next((m for m in reversed(block.above) if not m.startswith(".")), "")
    out.append("own=" + own)
    share = block.linked / n
    out.append("links=" + ("none" if not share else "some" if share < 0.5 else "most"))
    size = sum(words > k for k in (1, 3, 6, 10, 20, 40, 80))
    out.append(f"words={size}")
    last = text[-1]
    out.append("end=" + ("stop" if last in ".!?…\"”»)" else "colon" if last == ":" else "open"))
    out.append(f"stops={min(3, text.count('. ') + text.count(', '))}")
    if "©" in text or "|" in text or "»" in text:
        out.append("sign")
    out.append(f"own={own},words={size}")
    if not share and size >= 4 and own in ("p", "blockquote", "pre", "li", "td", "div", "section"):
        out.append("prose")
    return out


@dataclass
class Field:
    """Weights of features for the article label, and of the label and the one before it."""

    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    step: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def decode(self, page: list[Block]) -> list[bool]:
        """The best labels of a page's blocks."""
        if not page:
            return []
        get = self.weights.get
        seen: dict[tuple, float] = {}
        back: list[tuple[int, int]] = []
        no, yes = self.start
        for k, block in enumerate(page):
            # The marks above are the same for many blocks: their sum is kept.
            above = seen.get(block.above)
            if above is None:
                above = seen[block.above] = sum(get("^" + m, 0.0) for m in set(block.above))
            own = above + sum(get(f, 0.0) for f in features(block) if f[0] != "^")
            if k:
                (nn, ny), (yn, yy) = self.step
                into = (int(yes + yn > no + nn), int(yes + yy > no + ny))
                back.append(into)
                no, yes = max(no + nn, yes + yn), max(no + ny, yes + yy)
            yes += own
        label = int(yes > no)
        labels = [label]
        for into in reversed(back):
            label = into[label]
            labels.append(label)
        return [bool(x) for x in reversed(labels)]

    def text(self, page: str | None) -> str:
        found = blocks(page or "")
        kept = [b.text for b, x in zip(found, self.decode(found), strict=True) if x]
        return "\n\n".join(kept)


# Marks that say what a container is for. They name layouts that pages are rendered in for training;
# what they mean for a page is learned.
_MAIN = (
    "<article>|</article>", "<main>|</main>", '<div class="content">|</div>',
    '<div id="main-content" class="post-body">|</div>', '<div class="entry-content">|</div>',
    '<section class="story">|</section>', '<div class="article-text">|</div>', "<div>|</div>",
    '<main><article class="post">|</article></main>', '<div class="page"><article>|</article></div>',
)
_AROUND = (
    "<nav>|</nav>", '<div class="menu">|</div>', '<ul id="navigation">|</ul>', "<header>|</header>",
    '<div class="site-header">|</div>', "<footer>|</footer>", '<div id="footer">|</div>',
    "<aside>|</aside>", '<div class="sidebar">|</div>', '<div class="widget related-posts">|</div>',
    '<div class="ad">|</div>', '<div class="advert banner">|</div>', '<div id="sponsored" class="promo">|</div>',
    '<div class="cookie-notice">|</div>', '<div class="notice" role="alert">|</div>',
    "<form>|</form>", '<form class="newsletter subscribe">|</form>', '<div class="share social">|</div>',
    '<div class="comments">|</div>', '<section id="comments">|</section>', '<ol class="comment-list">|</ol>',
    '<div class="breadcrumb">|</div>', '<div class="login search">|</div>', '<div class="popup modal">|</div>',
)
# Class words that say nothing; they stand around articles and other blocks alike.
_NEUTRAL = "wrapper container row col inner page site body grid box layout block root app wide left".split()
_WITHIN = ("<aside>|</aside>", '<div class="ad">|</div>', '<div class="related">|</div>',
           '<section class="comments">|</section>', '<div class="comment">|</div>',
           '<form>|</form>', '<div class="notice">|</div>', '<div class="newsletter">|</div>')


def _wrapped(rule: str, inside: str) -> str:
    begin, end = rule.split("|")
    return begin + inside + end


def rendered(article: list[str], around: list[str], rng: random.Random) -> list[tuple[Block, int]]:
    """One labelled page: the article's paragraphs in a random layout with other blocks about them.

    Comments and notices are prose of other pages' kind: they reuse paragraphs, cut short or whole.
    """
    mark = "\u0001"

    def neutral(inside: str, share: float) -> str:
        while rng.random() < share:
            name = rng.choice(("", f' class="{rng.choice(_NEUTRAL)}"', f' id="{rng.choice(_NEUTRAL)}"'))
            inside, share = f"<div{name}>{inside}</div>", share / 2
        return inside

    spare = around + [p[: rng.randint(20, 200)] for p in article]

    def other(within: bool = False) -> str:
        rule = rng.choice(_WITHIN if within else _AROUND)
        items = []
        for _ in range(rng.randint(1, 4)):
            text = html.escape(rng.choice(spare))
            if "comment" in rule and rng.random() < 0.7:
                text = html.escape(rng.choice(article))
            link = "nav" in rule or "menu" in rule or rng.random() < 0.3
            text = f'<a href="/">{text[:40]}</a>' if link else text
            tag = "li" if "<ul" in rule or "<ol" in rule or link else rng.choice(("p", "div", "span"))
            items.append(f"<{tag}>{text}</{tag}>")
        return neutral(_wrapped(rule, "".join(items)), 0.4)

    body = []
    for k, paragraph in enumerate(article):
        if rng.random() < 0.2:
            paragraph = paragraph[: rng.randint(8, 60)].strip() + rng.choice((".", "", "!")) or "-"
        tag = "h1" if not k and len(paragraph) < 120 else rng.choice(("p", "p", "p", "p", "p", "blockquote", "li", "h2" if len(paragraph) < 60 else "p"))
        inside = html.escape(paragraph)
        inside = f"<ul><li>{mark}{inside}</li></ul>" if tag == "li" else f"<{tag}>{mark}{inside}</{tag}>"
        body.append(inside)
        if rng.random() < 0.12:
            body.append(other(within=True))
    main = "".join(body)
    main = _wrapped(rng.choice(_MAIN), main) if rng.random() < 0.6 else neutral(main, 1.0)
    main = neutral(main, 0.6)
    page = "".join(other() for _ in range(rng.randint(1, 4))) + main
    page = neutral(page + "".join(other() for _ in range(rng.randint(1, 4))), 0.5)
    page = f"<html><body>{page}</body></html>"
    out = []
    for block in blocks(page):
        label = int(block.text.startswith(mark))
        out.append((Block(block.text.lstrip(mark) or "-", block.linked, block.above), label))
    return out


#: Elements whose blocks are none of the article's, where a page marks its article.
_NOT_WITHIN = frozenset("nav aside footer form .comments .comment .ad .advert .notice .sidebar".split())


#: What marks an article, the surest first, and the text that shows it.
_MARKS = ({"article"}, {"main"}, {".main"}, {".entry", ".content"}, {".post", ".content"}, {".post", ".body"}, {".article"})
_MARKED = r"""(?i)<main[\s>]|(class|id|role)\s*=\s*["']?[^"'>]*(main|entry.?content|post.?content|post.?body|article)"""


def labelled(page: str) -> list[tuple[Block, int]] | None:
    """A page's blocks with labels, if it marks its article; the first of _MARKS that it has counts."""
    found = blocks(page)[:MAX_BLOCKS]
    above = [set(b.above) for b in found]
    for marks in _MARKS:
        labels = [int(marks <= a and not _NOT_WITHIN & a) for a in above]
        if any(labels):
            return list(zip(found, labels, strict=True))
    return None


def assumed(page: str) -> list[tuple[Block, int]] | None:
    """Blocks of an unmarked page: those that read like prose serve as paragraphs to render."""
    found = blocks(page)[:MAX_BLOCKS]
    labels = [int(not b.linked and b.text.count(" ") >= 10) for b in found]
    return list(zip(found, labels, strict=True)) if any(labels) else None


def _sequences(
    pages: Iterator[str], seed: int, marked: bool = True
) -> list[list[tuple[list[str], int]]]:
    """Feature lists and labels of the pages as they are, if they mark articles, and in LAYOUTS other ways."""
    rng, out = random.Random(seed), []
    for page in pages:
        rows = (labelled if marked else assumed)(page or "")
        if not rows:
            continue
        versions = [rows] if marked else []
        article = [b.text for b, y in rows if y]
        around = [b.text for b, y in rows if not y] or ["-"]
        versions += [rendered(article[: MAX_BLOCKS // 2], around, rng) for _ in range(LAYOUTS)]
        out += [[(features(b), y) for b, y in v] for v in versions]
    return out


def fit(sequences: list[list[tuple[list[str], int]]]) -> Field:
    """Maximum likelihood with a ridge, by gradient steps of adapted length."""
    sequences = [s for s in sequences if s]
    if not sequences:
        return Field({"prose": 2.0}, (1.0, 0.0))
    names = sorted({f for s in sequences for fs, _ in s for f in fs})
    number = {f: k for k, f in enumerate(names)}
    m, longest = len(sequences), max(map(len, sequences))
    cell, column = [], []
    gold = np.full((m, longest), -1)
    for i, s in enumerate(sequences):
        for j, (fs, y) in enumerate(s):
            gold[i, j] = y
            cell += [i * longest + j] * len(fs)
            column += [number[f] for f in fs]
    cell, column = np.array(cell), np.array(column)
    there, total = gold >= 0, sum(map(len, sequences))
    nf = len(names)
    w, speed = np.zeros(nf + 6), np.zeros(nf + 6)
    for _ in range(STEPS):
        start, step = w[nf : nf + 2], w[nf + 2 :].reshape(2, 2)
        emit = np.zeros((m, longest, 2))
        emit[..., 1] = np.bincount(cell, w[column], m * longest).reshape(m, longest)
        # Forward and backward sums in logarithms; positions behind a page's end change nothing.
        fore, back = np.zeros((m, longest, 2)), np.zeros((m, longest, 2))
        fore[:, 0] = start + emit[:, 0]
        for j in range(1, longest):
            got = np.logaddexp(fore[:, j - 1, :1] + step[0], fore[:, j - 1, 1:] + step[1]) + emit[:, j]
            fore[:, j] = np.where(there[:, j, None], got, fore[:, j - 1])
        norm = np.logaddexp(fore[:, -1, 0], fore[:, -1, 1])
        for j in range(longest - 2, -1, -1):
            tail = emit[:, j + 1] + back[:, j + 1]
            got = np.logaddexp(step[:, 0] + tail[:, :1], step[:, 1] + tail[:, 1:])
            back[:, j] = np.where(there[:, j + 1, None], got, 0.0)
        odds = np.exp(fore + back - norm[:, None, None]) * there[..., None]
        grad = np.zeros_like(w)
        miss = ((gold == 1) - odds[..., 1]) * there
        grad[:nf] = np.bincount(column, miss.ravel()[cell], nf)
        for y in (0, 1):
            grad[nf + y] = (gold[:, 0] == y).sum() - odds[:, 0, y].sum()
            for z in (0, 1):
                pair = fore[:, :-1, y] + step[y, z] + emit[:, 1:, z] + back[:, 1:, z] - norm[:, None]
                seen = (gold[:, :-1] == y) & (gold[:, 1:] == z)
                grad[nf + 2 + 2 * y + z] = seen.sum() - (np.exp(pair) * there[:, 1:]).sum()
        grad = grad / total - RIDGE * w / total
        speed += grad * grad
        w += RATE * grad / (np.sqrt(speed) + 1e-8)
    start, step = w[nf : nf + 2], w[nf + 2 :].reshape(2, 2)
    return Field(
        dict(zip(names, map(float, w[:nf]), strict=True)),
        tuple(map(float, start)),
        tuple(tuple(map(float, row)) for row in step),
    )


def train_field(pages: DataFrame, *, ident: str = "page_id", page: str = "html", seed: int = 7) -> Field:
    """A field from at most MAX_PAGES pages, the first by a digest of the id.

    Pages that mark their article by the element come before those that mark it otherwise; pages
    without any mark are used only if no page has one.
    """
    order = F.md5(F.coalesce(F.col(ident).cast("string"), F.lit("")))
    kind = F.when(F.col(page).rlike("(?i)<article"), 0).when(F.col(page).rlike(_MARKED), 1)
    choice = pages.where(kind.isNotNull())
    has_marks = not choice.isEmpty()
    choice = (choice if has_marks else pages).orderBy(kind, order).select(ident)
    chosen = choice.limit(MAX_PAGES).withColumnRenamed(ident, "__id").distinct()
    rows = pages.join(F.broadcast(chosen), F.col(ident) == F.col("__id")).select(
        F.col(ident).cast("string").alias("id"), F.col(page).alias("page")
    )

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for s in _sequences(iter([text]), seed + hash_of(key), has_marks):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key], pa.string()),
                            pa.array([[f for f, _ in s]], pa.list_(pa.list_(pa.string()))),
                            pa.array([[y for _, y in s]], pa.list_(pa.int32())),
                        ],
                        ["id", "features", "labels"],
                    )

    seen = rows.mapInArrow(see, "id string, features array<array<string>>, labels array<int>")
    table = seen.orderBy("id", F.xxhash64("features")).collect()
    return fit([list(zip(r["features"], r["labels"], strict=True)) for r in table])


def hash_of(key: str | None) -> int:
    return sum((k + 1) * ord(c) for k, c in enumerate(key or ""))


def extract_text(pages: DataFrame, model: Field, *, page: str = "html") -> DataFrame:
    """All input columns but the page's own, and `text` and `n_chars` (its code points).

    A null or empty page, and one without an article, has an empty text. Character references are
    decoded, white space within a block becomes one space, blocks are joined by an empty line. Equal
    pages get equal texts; an empty table gives an empty table. A page is one value of one task.
    Taken names get underscores.
    """
    rest = [c for c in pages.columns if c != page]
    text, size = (plain(n, rest) for n in ("text", "n_chars"))
    fields = [f for f in pages.schema.fields if f.name != page]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.text(x.as_py()) for x in batch.column(page)]
            columns = [batch.column(c) for c in rest]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, text, size])

    added = [T.StructField(text, T.StringType()), T.StructField(size, T.LongType())]
    return pages.mapInArrow(extract, T.StructType([*fields, *added]))
