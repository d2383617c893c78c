from __future__ import annotations

import pytest

from agoralake.llm.html_text import Block, Field, blocks, extract_text, fit, labelled, train_field

PAGES = "/root/testdata/sf0.001/pages.parquet"


def _texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><title>no</title><style>p{}</style><body class='a b'><p>One &amp; <b>two
      <i>three</i>&nbsp;four<p>five<br>six<!-- no --><ul><li>x<li>y</ul><script>"<p>no</p>"</script>
      a < b <div data-x="1>2">&#233;t&eacute;</DIV><p></p>tail<!-- open"""
    assert _texts(page) == ["One & two three four", "five six", "x", "y", "a < b", "été", "tail"]
    assert _texts("") == [] and _texts("plain  text") == ["plain text"]
    assert _texts("<script>never ends") == [] and _texts('<p title="it>s') == ["s"]


@pytest.mark.parametrize("head", ["<head><title>no</title>", "<head><title>no</title></head>", "<HEAD>"])
def test_nothing_is_lost_behind_unclosed_elements(head):
    body = "<header>Site menu</header><p>First paragraph.</p><p>Second one.</p>"
    assert _texts(f"<html>{head}<body>{body}") == ["Site menu", "First paragraph.", "Second one."]
    for tag in ("button", "select", "textarea", "title", "video", "object", "noscript", "iframe"):
        assert _texts(f"<p>One.</p><{tag}><p>Two.</p><p>Three.</p>") == ["One.", "Two.", "Three."]
        assert _texts(f"<{tag}><p>Two.</p><{tag}></{tag}><p>Three.</p>") == ["Two.", "Three."]


def test_text_of_inline_and_open_elements():
    assert _texts("<p>Let <math><mi>x</mi></math> be <svg><title>no</title><path/></svg>one.") == ["Let x be one."]
    assert _texts("<p>a <noscript><img src=x></noscript>b<p>c <button>Copy</button>d") == ["a b", "c d"]
    found = blocks("<p>a</p><noscript><p>Shown without code.</p></noscript><object>else</object>b")
    assert [b.text for b in found] == ["a", "Shown without code.", "else", "b"]
    assert [("noscript" in b.above, "object" in b.above) for b in found] == [
        (False, False), (True, False), (False, True), (False, False)
    ]
    code = "<script>document.write('<script>x</scripts>')</script>"
    assert _texts(f"<p>a</p>{code}<p>b</p><style>p") == ["a", "b"]


def test_marks_and_links():
    (block,) = blocks('<div class="PostBody x2" id=main><nav><a href="/">Home</a> now</nav></div>')
    assert {"div", ".post", ".body", ".x", ".main", "nav"} == set(block.above)
    assert block.linked == 4


def test_viterbi_is_the_best_of_all_labelings():
    model = Field({"^p": 0.7, "^nav": -1.2, "end=stop": 0.3}, (0.2, -0.1), ((0.5, -0.6), (-0.4, 0.3)))
    page = blocks("<p>a.</p><nav>b</nav><p>c</p><nav>d.</nav><nav>e</nav><p>f g h.</p>")
    from itertools import product

    from agoralake.llm.html_text import features

    def value(labels):
        total = model.start[labels[0]] + sum(model.step[a][b] for a, b in zip(labels, labels[1:]))
        return total + sum(
            model.weights.get(f, 0.0) for b, y in zip(page, labels) if y for f in features(b)
        )

    best = max(product((0, 1), repeat=len(page)), key=value)
    assert model.decode(page) == [bool(y) for y in best]


@pytest.fixture(scope="module")
def model(spark):
    return train_field(spark.read.parquet(PAGES))


def test_held_out_pages(spark, model):
    rows = spark.read.parquet(PAGES).collect()
    right = 0
    for row in rows:
        want = "\n\n".join(b.text for b, y in labelled(row.html) or [] if y)
        right += len(blocks(row.html)) > 120 or model.text(row.html) == want
    assert right / len(rows) > 0.95


def test_another_layout(model):
    prose = "This paragraph of the story has a good many words in it, and it ends well."
    page = f"""<header><div class=logo>Site</div><nav><a href=1>Home</a></nav></header>
    <div id="cookie-banner">We use cookies on this site.</div><div class=wrapper><div class=post>
    <h1>A title</h1><p>{prose}</p><p>{prose} Again.</p><div class=ad>Buy now, great offer.</div>
    <p>{prose} At last.</p></div><div class=sidebar><h3>More</h3><a href=q>Other</a></div></div>
    <div id=comments><div class=comment><p>{prose} I think so too.</p></div></div>
    <form><p>Please enter your address to join us.</p></form><footer>&copy; 2020 Site</footer>"""
    assert model.text(page) == "\n\n".join(["A title", prose, prose + " Again.", prose + " At last."])


STORY = [
    "The harbour was quiet when the first boats came back, and nobody on the quay spoke.",
    "A storm had passed in the night, taking two roofs and the old mast of the school.",
    "By noon the road was open again, so that the doctor could drive out to the farms.",
    "It rained once more in the evening, but by then the children were all at home.",
]


@pytest.mark.parametrize("rule", ["<MAIN>|</MAIN>", "<div role=main>|</div>", '<div class="entry-content">|</div>', "<div>|</div>"])
def test_learns_without_article_elements(spark, rule):
    begin, end = rule.split("|")

    def page(k):
        story = [f"{x[:-1]}, as number {k} says." for x in STORY]
        inside = "".join(f"<p>{x}</p>" for x in story)
        return story, f"""<body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>{begin}
          <h1>Report {k}</h1>{inside}{end}<div class=comments><p>I was there as well and saw
          it, number {k} is quite right about the roofs.</p></div><footer>All rights kept</footer>"""

    made = [page(k) for k in range(40)]
    pages = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(made)], "page_id long, html string")
    model = train_field(pages)
    right = sum(model.text(x) == "\n\n".join([f"Report {k}", *s]) for k, (s, x) in enumerate(made))
    prose = sum("\n\n".join(s) in model.text(x) and "quite right" not in model.text(x) for s, x in made)
    assert prose >= 38
    assert "<div>|" in rule or right >= 38


def test_odd_pages(spark, model):
    rows = [(1, None, "u", "x"), (2, "", "u", "x"), (2, "", "u", "x"), (None, "<nav><a>m</a></nav>", None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, url string, text string")
    out = extract_text(pages, model)
    assert out.columns == ["page_id", "url", "text", "text_", "n_chars"]
    assert [(r.text_, r.n_chars) for r in out.collect()] == [("", 0)] * 4
    none = spark.createDataFrame([], pages.schema)
    assert extract_text(none, model).count() == 0 and isinstance(train_field(none), Field)
    assert fit([]).decode([Block("a", 0, ())]) in ([True], [False])
