import html
import re

import pytest

from tenantmart.llm import html_text as H


@pytest.fixture(scope="module")
def model():
    return H.trained()


def test_held_out_layouts(model):
    """Share of held-out text that is labelled right."""
    right = total = 0
    for page, truth in H.training_pages(200, seed=1234):
        dom = H.Dom(page)
        for (node, _, text, _), m in ((p, model.marginals(dom)) for p in dom.pieces):
            if text.strip():
                total += len(text)
                right += len(text) * ((m[node] >= 0.5) == truth(text.strip()))
    assert right / total > 0.98


def test_marginals_equal_enumeration(model):
    import itertools
    import math
    dom = H.Dom("<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>Some text here.</p></article></body>")
    own, n = H.evidence(dom), len(dom.tags)
    total, ones = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        score = sum(labels[i] * sum(model.weight.get(f, 0.0) for f in own[i]) for i in range(n))
        score += sum(model.edge[labels[dom.parents[i]]][labels[i]] for i in range(1, n))
        total += math.exp(score)
        for i in range(n):
            ones[i] += labels[i] * math.exp(score)
    assert model.marginals(dom) == pytest.approx([o / total for o in ones], abs=1e-9)


def test_blocks_and_references(model):
    page = ("<html><head><title>no</title><style>p{}</style></head><body><header class='masthead'><a href=/>Site name</a></header>"
            "<div class='cookie-banner'>We use cookies. Accept?</div><article><h1> A &amp; B&nbsp;&#169; </h1><p>One\n two <b>three<br><p>fo<i>ur</i> &lt;x&gt;.<script>var a='<p>';</script></p>"
            "<ul><li>first item here<li>second item here</ul><aside>Related: <a href=1>other</a></aside><p>Last one.</article>"
            "<section id=comments><h3>Comments</h3><p>I liked it a lot, thanks.</p></section><form><input name=q><p>Sign up now</p></form><footer>&copy; 2020</footer></body>")
    assert H.main_text(page, model) == "A & B ©\nOne two three\nfour <x>.\nfirst item here\nsecond item here\nLast one."


def test_rows(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<article><h1>T</h1><p>" + "word " * 100_000 + "</p></article>"), (None, "u", "<div>" * 5000),
            (5, "u", "<article><h1>T</h1><p>Plain text of the page.</p></article>"), (5, "u", "<article><h1>T</h1><p>Plain text of the page.</p></article>"),
            (6, "u", "<!-- <p>x</p> <script>")]
    df = spark.createDataFrame([(h, 1, i, u) for i, u, h in rows], "html string, text int, page_id long, url string")
    got = {(r.page_id, r.url): r for r in H.extract(df, model).collect()}
    assert H.extract(df, model).count() == len(rows) and H.extract(df.limit(0), model).count() == 0
    assert got[1, "u"].text == "" and got[2, None].n_chars == 0 and got[6, "u"].text == ""
    assert got[5, "u"].text == "T\nPlain text of the page." and got[4, "u"].n_chars == 2 + 5 * 100_000 - 1


def test_pages_table(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages, model).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
