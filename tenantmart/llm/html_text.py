"""Main text of web pages by a graphical model on the DOM tree.

Every block element, and every inline element with a class, id or role, is a
node with a hidden label: content or not.  A node's own evidence is its tag,
the words of its class, id and role, its share of link text, how much text it
holds and whether it holds sentences or form fields; parent-child potentials
tie a node's label to its parent's.  Messages are passed up the tree and down
again (sum-product), which gives each node's exact marginal; text counts when
its node's marginal is at least one half.

The potentials are fitted on labelled pages by the likelihood of their labels,
whose gradient needs just these marginals.  No table carries labels for pages, so the training pages are built here, from seeded
layouts in many markups whose content is known by construction
(``TRAINING_PAGES`` of them, a fixed bound).

Text of scripts, styles, heads, buttons and the like is never content.
Character references are decoded, white space inside a block becomes one
space, and blocks are joined in page order by a line feed; a ``<br>`` is white
space.  Broken markup is read as browsers do: a new block closes an open
paragraph, stray end tags are ignored, and what is open at the end is closed.
Null and empty pages have empty text.  Rows are independent, so repeated rows
need no rule, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, take

# Fixed values of HTML: elements by how their text is laid out.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("audio button canvas datalist head iframe math noembed noframes noscript object option script select style svg template textarea title video".split())
AROUND_P = BLOCKS - {"p"}
#: A start tag of the key closes an open element of the value, up to the nearest of its scope.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
          "option": ({"option"}, {"select"})}

SPACES = re.compile(r"\s+")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
UNCLOSED = re.compile(r"<[/!?a-zA-Z]")
SENTENCE = re.compile(r"[.!?。！？](\s|$)")
TRAINING_PAGES = 800
PASSES = 6
SEED = 6


class Dom(HTMLParser):
    """Nodes (parents first) and the text pieces of one page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.words: list[tuple] = [()]
        self.pieces: list[tuple[int, int, str, bool]] = []    # node, block number, text, in a link
        self.fields: Counter = Counter()
        self.open: list[tuple[str, int]] = [("#page", 0)]     # tag, node that its text belongs to
        self.opened: Counter = Counter()                      # how many of each tag are open
        self.block = 0
        self.hidden = self.links = 0
        self.feed(html)
        if not self.cdata_elem and UNCLOSED.match(self.rawdata):
            self.rawdata = ""    # markup that never ends holds no text
        self.close()

    def _pop(self) -> None:
        tag, _ = self.open.pop()
        self.opened[tag] -= 1
        if tag in BLOCKS:
            self.block += 1
        self.hidden -= tag in HIDDEN
        self.links -= tag == "a"

    def _close(self, wanted, scope=()) -> None:
        """Close the innermost open element of ``wanted`` that no element of ``scope`` hides."""
        if not any(self.opened[t] for t in wanted):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in wanted:
                while len(self.open) > i:
                    self._pop()
                return
            if tag in scope:
                return

    def handle_starttag(self, tag, attrs):
        node = self.open[-1][1]
        if tag == "br" or tag == "hr":
            if tag == "hr":
                self._close({"p"}, AROUND_P)
                self.block += 1
            elif not self.hidden:
                self.pieces.append((node, self.block, " ", self.links > 0))
        if tag in ("input", "select", "textarea", "button"):
            self.fields[node] += 1
        if tag in VOID:
            return
        if tag in BLOCKS and tag not in ("html", "body"):
            self._close({"p"}, AROUND_P)
        if tag in ("html", "body") and self.opened[tag]:
            return
        if tag == "body" or tag in BLOCKS - {"html"}:
            self._close({"head"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "a":
            self._close({"a"}, BLOCKS)
        marks = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop"))
        if tag in BLOCKS or marks:
            self.tags.append(tag)
            self.parents.append(node)
            self.words.append(tuple(t.lower() for t in TOKEN.findall(marks)))
            node = len(self.tags) - 1
        if tag in BLOCKS:
            self.block += 1
        self.open.append((tag, node))
        self.opened[tag] += 1
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)    # a slash at the end of a start tag has no meaning in HTML

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag not in ("html", "body"):
            self._close({tag}, () if tag in BLOCKS or tag in HIDDEN else BLOCKS)

    def handle_data(self, data):
        if not self.hidden and data:
            self.pieces.append((self.open[-1][1], self.block, data, self.links > 0))

    def unknown_decl(self, data):
        pass


def evidence(dom: Dom) -> list[list[str]]:
    """Each node's own observations."""
    n = len(dom.tags)
    chars, linked, sentences, fields = [0] * n, [0] * n, [0] * n, [dom.fields[i] for i in range(n)]
    for node, _, text, link in dom.pieces:
        size = len(text) - text.count(" ")
        chars[node] += size
        linked[node] += size * link
        sentences[node] += bool(SENTENCE.search(text))
    for i in range(n - 1, 0, -1):
        p = dom.parents[i]
        for a in (chars, linked, sentences, fields):
            a[p] += a[i]
    out = []
    for i in range(n):
        share = linked[i] / chars[i] if chars[i] else 0
        parent = dom.tags[dom.parents[i]] if i else ""
        links = math.ceil(share * 4)
        own = ["any", f"tag {dom.tags[i]}", f"under {parent} {dom.tags[i]}", f"links {links}", f"links {dom.tags[i]} {links}", f"size {min(6, len(str(chars[i] // 5)) if chars[i] else 0)}",
               f"sentences {min(sentences[i], 3)}", f"fields {min(fields[i], 2)}"]
        own += [f"word {w}" for w in set(dom.words[i]) if not w.isdigit()]
        out.append(own)
    return out


class TreeModel:
    """Node weights (log odds of content by observation) and parent-child potentials."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        self.edge = [[0.0, 0.0], [0.0, 0.0]]    # log potential of (parent's label, label)

    def infer(self, parents, observed) -> tuple[list[float], list]:
        """P(content) of each node, and P(parent's label, label) of each but the root: one pass up, one down."""
        n, weight = len(parents), self.weight
        step = [[math.exp(v) for v in row] for row in self.edge]
        up = []
        for own in observed:
            w = max(-30.0, min(30.0, sum([weight.get(f, 0.0) for f in own])))
            one = 1 / (1 + math.exp(-w))
            up.append((1 - one, one))
        message = [None] * n
        for i in range(n - 1, 0, -1):
            own, p = up[i], parents[i]
            m = message[i] = (step[0][0] * own[0] + step[0][1] * own[1], step[1][0] * own[0] + step[1][1] * own[1])
            a, b = up[p][0] * m[0], up[p][1] * m[1]
            up[p] = (a / (a + b), b / (a + b))
        belief, pairs = [up[0]] + [None] * (n - 1), [None] * n
        for i in range(1, n):
            above, m, own = belief[parents[i]], message[i], up[i]
            r0, r1 = above[0] / m[0], above[1] / m[1]
            joint = (r0 * step[0][0] * own[0], r0 * step[0][1] * own[1], r1 * step[1][0] * own[0], r1 * step[1][1] * own[1])
            total = sum(joint)
            joint = pairs[i] = [j / total for j in joint]
            belief[i] = (joint[0] + joint[2], joint[1] + joint[3])
        return [b[1] for b in belief], pairs

    @classmethod
    def fit(cls, pages, passes: int = PASSES, rate: float = 0.3, decay: float = 1e-4) -> TreeModel:
        """Gradient ascent on the likelihood of the labels: observed less expected counts, page by page."""
        model, pages = cls(), [(d, evidence(d), node_labels(d, truth)) for d, truth in ((Dom(h), t) for h, t in pages)]
        size, edge_size = Counter(), [[1.0, 1.0], [1.0, 1.0]]
        for _ in range(passes):
            for dom, observed, labels in pages:
                belief, pairs = model.infer(dom.parents, observed)
                slope: dict[str, float] = {}
                edges = [[0.0, 0.0], [0.0, 0.0]]
                for i, own in enumerate(observed):
                    miss = labels[i] - belief[i]
                    for f in own:
                        slope[f] = slope.get(f, 0.0) + miss
                    if i:
                        edges[labels[dom.parents[i]]][labels[i]] += 1
                        for k, v in enumerate(pairs[i]):
                            edges[k // 2][k % 2] -= v
                for f, g in slope.items():
                    g -= decay * model.weight.get(f, 0.0)
                    size[f] += g * g
                    model.weight[f] = model.weight.get(f, 0.0) + rate * g / math.sqrt(size[f] + 1e-6)
                for j in (0, 1):
                    for k in (0, 1):
                        edge_size[j][k] += edges[j][k] ** 2
                        model.edge[j][k] += rate * edges[j][k] / math.sqrt(edge_size[j][k])
        return model

    def marginals(self, dom: Dom) -> list[float]:
        return self.infer(dom.parents, evidence(dom))[0]


def node_labels(dom: Dom, is_content) -> list[int]:
    """A node is content if it holds any; without text it is what its parent is."""
    n = len(dom.tags)
    good, chars = [0] * n, [0] * n
    for node, _, text, _ in dom.pieces:
        if text := text.strip():
            chars[node] += len(text)
            good[node] += len(text) * is_content(text)
    for i in range(n - 1, 0, -1):
        chars[dom.parents[i]] += chars[i]
        good[dom.parents[i]] += good[i]
    out = []
    for i in range(n):
        out.append(int(good[i] > 0) if chars[i] else out[dom.parents[i]] if i else 0)
    return out


def main_text(html: str | None, model: TreeModel) -> str:
    if not html:
        return ""
    dom = Dom(html)
    content = [m >= 0.5 for m in model.marginals(dom)]
    blocks: dict[int, list[str]] = {}
    for node, block, text, _ in dom.pieces:
        if content[node]:
            blocks.setdefault(block, []).append(text)
    lines = (SPACES.sub(" ", "".join(b)).strip() for b in blocks.values())
    return "\n".join(x for x in lines if x)


# Layouts of the training pages.  Words of content begin with C, all others with B.

ROLES = {
    "menu": (["nav", "ul", "div", "div"], "menu nav navbar navigation topnav breadcrumb breadcrumbs pagination pager tabs toc links share social tags"),
    "head": (["header", "div"], "header masthead topbar branding banner hero logo site"),
    "foot": (["footer", "div"], "footer copyright colophon legal bottom foot site"),
    "side": (["aside", "div", "section"], "sidebar side widget related recommended trending popular more rail aside"),
    "note": (["div", "section", "dialog", "p"], "cookie cookies consent notice gdpr alert banner popup modal privacy message warning disclaimer"),
    "ad": (["div", "section", "aside", "p", "ins"], "ad ads advert advertisement sponsor sponsored promo promotion adsense commercial"),
    "form": (["form", "div"], "form newsletter subscribe signup search login contact register comment"),
    "comments": (["section", "div", "ol", "ul"], "comments comment replies reply respond discussion disqus responses reviews thread"),
}
CONTENT_WORDS = "content article post entry story main body text page single hentry articlebody copy"
PLAIN_WORDS = "container wrapper wrap row col inner grid layout outer block box section module left right center clearfix"


class Layouts:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self, kind: str) -> str:
        return kind + "".join(self.rng.choice("aeinorst") for _ in range(self.rng.randint(1, 9)))

    def text(self, kind: str, words: int) -> str:
        out = [self.word(kind) for _ in range(words)]
        return " ".join(w + ("." if self.rng.random() < 0.12 else "") for w in out) + self.rng.choice(["", ".", ".", "."])

    def link(self, kind: str, words: int = 0) -> str:
        return f'<a href="/{self.rng.randint(1, 99)}">{self.text(kind, words or self.rng.randint(1, 3))}</a>'

    def mark(self, words: str, chance: float = 0.75) -> str:
        rng = self.rng
        if rng.random() > chance:
            return ""
        own = rng.sample(words.split(), rng.choice([1, 1, 2]))
        if rng.random() < 0.2:
            own.append(rng.choice(PLAIN_WORDS.split()))
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice([" ", "-", "_"]).join(own)}"'

    def listing(self, kind: str, n: int, linked: float) -> str:
        items = [self.link(kind) if self.rng.random() < linked else self.text(kind, self.rng.randint(1, 14)) for _ in range(n)]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"

    def aside(self, role: str) -> str:
        rng = self.rng
        tags, words = ROLES[role]
        tag = rng.choice(tags)

        def title(n: int) -> str:
            h = rng.choice(["h2", "h2", "h3", "h3", "h4", "h5", "strong", "p"])
            return f"<{h}>{self.text('B', n)}</{h}>"

        semantic = tag in ("nav", "header", "footer", "aside", "form", "ins")
        mark = self.mark(words, 0.5 if semantic else 1.0 if role != "menu" else 0.8)
        n = rng.randint(1, 7)
        if role == "menu":
            inner = self.listing("B", n + 1, 1.0) if rng.random() < 0.7 else " | ".join(self.link("B") for _ in range(n + 1))
            if tag == "ul":
                inner = inner.removeprefix("<ul>").removesuffix("</ul>") if inner.startswith("<ul>") else f"<li>{inner}</li>"
        elif role == "head":
            inner = rng.choice([f"<h1>{self.link('B')}</h1>", title(2), f"<div>{self.text('B', 3)}</div>", f"<p>{self.text('B', 6)}</p>", ""]) + (self.aside("menu") if rng.random() < 0.5 else self.text("B", 2))
        elif role == "foot":
            inner = rng.choice(["&copy; ", ""]) + self.text("B", rng.randint(2, 14)) + rng.choice(["", self.listing("B", n, 1.0), f"<p>{self.text('B', 9)}</p>"])
        elif role == "form":
            inner = f"<label>{self.text('B', 2)}</label><input name=q><button>{self.text('B', 1)}</button>" + rng.choice(["", f"<p>{self.text('B', 8)}</p>"])
            tag = "form" if not mark else tag
        elif role == "comments":
            inner = title(2) + "".join(
                rng.choice([f"<div{self.mark('comment reply author body')}><p>{self.text('B', rng.randint(2, 40))}</p></div>", f"<li><p>{self.text('B', rng.randint(2, 30))}</p></li>",
                            f"<p>{self.text('B', rng.randint(3, 30))}</p>", f"<article{self.mark('comment comment', 1.0)}><p>{self.text('B', 12)}</p></article>"]) for _ in range(n))
        elif role == "side":
            inner = title(2) + rng.choice([self.listing("B", n, 0.9), f"<p>{self.text('B', rng.randint(5, 40))}</p>", self.listing("B", n, 0.9) + f"<div>{self.text('B', 12)}</div>"])
        else:
            inner = rng.choice([self.text("B", rng.randint(2, 25)), f"<p>{self.text('B', rng.randint(3, 25))}</p>", f"<div><span>{self.text('B', 6)}</span> {self.link('B')}</div>"])
        if tag == "p":    # a paragraph holds no blocks
            inner = self.text("B", rng.randint(2, 25))
        return f"<{tag}{mark}>{inner}</{tag}>"

    def paragraph(self) -> str:
        rng = self.rng
        kind = rng.random()
        body = self.text("C", rng.choice([1, 2, 5, 20, 60, 120]))
        if kind < 0.15:
            body += f" <b>{self.text('C', 3)}</b> " + self.text("C", 8)
        elif kind < 0.3:
            body += f" {self.link('C')} " + self.text("C", 10)
        if kind > 0.9:
            return rng.choice([self.listing("C", rng.randint(2, 5), 0.15), f"<blockquote><p>{body}</p></blockquote>", f"<pre>{body}</pre>", f"<h2>{self.text('C', 3)}</h2>",
                               f"<figure><img src=x><figcaption>{self.text('C', 6)}</figcaption></figure>", f"<table><tr><td>{self.text('C', 2)}</td><td>{self.text('C', 3)}</td></tr></table>",
                               f"<section><h2>{self.text('C', 3)}</h2><p>{body}</p></section>", f"<div>{body}</div>"])
        return rng.choice([f"<p>{body}</p>", f"<p>{body}</p>", f"<p>{body}<br>{self.text('C', 9)}</p>", f"<p><b>{body}<br><p>{self.text('C', 9)}</p>"])

    def article(self) -> str:
        rng = self.rng
        title = f"<h1>{self.text('C', rng.randint(2, 9))}</h1>"
        if rng.random() < 0.15:
            title = f"<header>{title}</header>"
        parts = [self.paragraph() for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.3:
            parts.insert(rng.randint(0, len(parts)), self.aside(rng.choice(["ad", "side", "menu", "form", "note"])))
        inner = (title if rng.random() < 0.9 else "") + "".join(parts)
        if rng.random() < 0.12:
            inner += self.aside("comments")
        if rng.random() < 0.1:
            return inner
        tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
        out = f"<{tag}{self.mark(CONTENT_WORDS, 0.9 if tag in ('div', 'section') else 0.3)}>{inner}</{tag}>"
        if rng.random() < 0.3:
            outer = rng.choice(["main", "div", "section"])
            out = f"<{outer}{self.mark(CONTENT_WORDS + ' ' + PLAIN_WORDS, 0.6)}>{out}</{outer}>"
        return out

    def page(self) -> str:
        rng = self.rng
        before = [self.aside(r) for r in ("note", "head", "menu", "ad", "side", "form") if rng.random() < 0.4]
        after = [self.aside(r) for r in ("ad", "side", "comments", "form", "menu", "note") if rng.random() < 0.35]
        if rng.random() < 0.8:
            after.append(self.aside("foot"))
        rng.shuffle(before)
        body = "".join(before) + self.article() + "".join(after)
        if rng.random() < 0.3:
            body = f"<div{self.mark(PLAIN_WORDS, 0.8)}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.text('B', 3)}</title><script>var a='</p>';</script></head><body>{body}</body></html>"


def training_pages(n: int = TRAINING_PAGES, seed: int = SEED):
    layouts = Layouts(seed)
    for _ in range(n):
        yield layouts.page(), lambda text: text.startswith("C")


_models: dict = {}


def trained(n: int = TRAINING_PAGES, seed: int = SEED) -> TreeModel:
    if (n, seed) not in _models:
        _models[n, seed] = TreeModel.fit(training_pages(n, seed))
    return _models[n, seed]


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = take(pages, "page_id", "url", "html")
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())    # some hundred potentials
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string"

    def run(batches):
        import pyarrow as pa

        own = shared.value
        for batch in batches:
            texts = [main_text(h.as_py(), own) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return map_arrow(rows, run, schema).withColumn("n_chars", F.length("text").cast("long"))
