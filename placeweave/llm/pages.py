"""Main text of web pages: boosted trees over DOM nodes, decoded so that no node contradicts its ancestors.

A page is read into block nodes and runs of text. Each node gets features of its subtree (density of text, links and
marks), of its attribute tokens, of its depth and of its siblings. Gradient-boosted trees, fitted with Spark on pages laid
out at random by ``layouts``, say how likely a node holds main text. Decoding picks the likeliest labelling of the whole
tree in which a node is kept only below kept nodes and a kept node has something kept below it.

A null or empty page has empty text; a page cut off anywhere is read as far as it goes. Text is never dropped by length, and
pages that repeat give the same text each time. An empty table gives an empty result. Other columns are carried along; a
column named ``text`` is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.llm.store import Shared

# Kinds of elements of the public HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template title head svg math iframe object select option textarea button canvas audio video".split())
BLOCK = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption nav header footer aside form fieldset address details summary hr dialog menu center".split()
)
ENDS = {
    "p": BLOCK,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "head": {"body"},
}
#: Elements that an implied end does not reach across.
FENCE = set("table ul ol dl div article section main body blockquote td th".split())
TAGS = "body main article section div p heading ul li dl table row cell blockquote pre figure nav header footer aside form text".split()
ALIAS = {
    **{f"h{i}": "heading" for i in range(1, 7)},
    **dict.fromkeys(("ol", "menu"), "ul"),
    **dict.fromkeys(("dt", "dd"), "li"),
    **dict.fromkeys(("tr", "thead", "tbody", "tfoot"), "row"),
    **dict.fromkeys(("td", "th", "caption"), "cell"),
    **dict.fromkeys(("figcaption",), "figure"),
    **dict.fromkeys(("fieldset",), "form"),
    **dict.fromkeys(("details", "summary", "address", "center", "dialog"), "div"),
}
# Attribute tokens by what they usually name.
TOKENS = {
    "body": "article content main post entry story text body prose page".split(),
    "menu": "nav navbar menu breadcrumb breadcrumbs pagination pager tabs toc skip sitemap".split(),
    "frame": "header footer masthead banner copyright colophon topbar bottom legal".split(),
    "side": "sidebar aside side widget related recommended trending popular more rail tags share social author".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion dfp outbrain taboola".split(),
    "notice": "cookie cookies consent notice alert gdpr modal popup overlay subscribe newsletter paywall toast".split(),
    "comment": "comment comments reply replies disqus discussion respond commentlist reader feedback".split(),
    "form": "form search login signup register contact input".split(),
}
TOKEN = re.compile(r"[A-Z]?[a-z]+")
MARK = re.compile(r"[.,;:!?]")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple = ()
    text: str = ""
    links: int = 0
    kids: list = field(default_factory=list)


class Tree(HTMLParser):
    """Block nodes in document order; node 0 is the page. Inline elements only tell how much text is linked."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open, self.hidden, self.linked = [Node("body", -1, 0)], [("", 0)], [], 0
        # How many tags of a name are open: blocks in all, inline ones since the latest open block. Tags that end without
        # a start are told apart without walking what is open.
        self.blocks, self.inline = Counter(), [Counter()]
        self.parts: list[str] = []
        self.link_chars = 0

    def _flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            at = self.open[-1][1]
            self._add(Node("text", at, self.nodes[at].depth + 1, (), text, min(self.link_chars, len(text))))
        self.parts, self.link_chars = [], 0

    def _add(self, node: Node) -> int:
        self.nodes.append(node)
        self.nodes[node.parent].kids.append(len(self.nodes) - 1)
        return len(self.nodes) - 1

    def _close(self, count: int):
        for _ in range(count):
            tag = self.open.pop()[0]
            if tag in BLOCK:
                self.blocks[tag] -= 1
                self.inline.pop()
                continue
            self.inline[-1][tag] -= 1
            if tag == "a":
                self.linked = max(0, self.linked - 1)

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            if tag not in VOID and tag == self.hidden[-1]:
                self.hidden.append(tag)
            return
        if tag in ("br", "hr") or tag in VOID:
            self.parts.append(" ")
            return
        if tag in HIDDEN and tag not in ("head", "title"):
            self.hidden.append(tag)
            return
        if tag == "title":
            self.hidden.append(tag)
            return
        if tag in ("html", "head", "body"):
            return
        if tag in BLOCK:
            self._flush()
            for back in range(1, len(self.open)):
                name = self.open[-back][0]
                if tag in ENDS.get(name, ()):
                    self._close(back)
                    break
                if name in FENCE:
                    break
            at = self.open[-1][1]
            words = [w.lower() for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label") for w in TOKEN.findall(v or "")]
            self.open.append((tag, self._add(Node(ALIAS.get(tag, tag), at, self.nodes[at].depth + 1, tuple(words)))))
            self.blocks[tag] += 1
            self.inline.append(Counter())
            return
        if tag == "a":
            self.linked += 1
        self.open.append((tag, self.open[-1][1]))
        self.inline[-1][tag] += 1

    def handle_endtag(self, tag):
        if self.hidden:
            if tag == self.hidden[-1]:
                self.hidden.pop()
            return
        if tag in ("html", "head", "body") or tag in VOID:
            return
        if not (self.blocks[tag] if tag in BLOCK else self.inline[-1][tag]):
            return
        back = 1
        while self.open[-back][0] != tag:
            back += 1
        if tag in BLOCK:
            self._flush()
        self._close(back)

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.linked:
                self.link_chars += len(data)


def parse(html: str | None) -> list[Node]:
    tree, html = Tree(), html or ""
    # A page cut off inside a tag ends before that tag.
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and html[last + 1 : last + 2] and (html[last + 1].isalpha() or html[last + 1] in "/!"):
        html = html[:last]
    tree.feed(html)
    tree.close()
    tree._flush()
    return tree.nodes


KINDS = list(TOKENS)
NAMES = [
    *(f"tag_{t}" for t in TAGS),
    *(f"own_{k}" for k in KINDS),
    *(f"above_{k}" for k in KINDS),
    *(f"in_{t}" for t in ("main", "article", "nav", "header", "footer", "aside", "form", "li", "table")),
    *"depth kids place same text_log share link_density mark_density word_length text_per_node sentence share_of_parent best_share rank_share headings paragraphs".split(),
]


def features(nodes: list[Node]):
    """One row of features for each node."""
    import numpy as np

    n = len(nodes)
    text, links, marks, count, words, heads, paras = (np.zeros(n) for _ in range(7))
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        text[i] += len(node.text)
        links[i] += node.links
        marks[i] += len(MARK.findall(node.text))
        words[i] += node.text.count(" ") + bool(node.text)
        count[i] += 1
        heads[i] += node.tag == "heading"
        paras[i] += node.tag == "p"
        if node.parent >= 0:
            for total in (text, links, marks, count, words, heads, paras):
                total[node.parent] += total[i]
    out = np.zeros((n, len(NAMES)), np.float32)
    kinds = {t: k for k, names in enumerate(TOKENS.values()) for t in names}
    own = np.zeros((n, len(KINDS)), bool)
    above, inside = np.zeros((n, len(KINDS)), bool), np.zeros((n, 9), bool)
    spots = {t: k for k, t in enumerate(("main", "article", "nav", "header", "footer", "aside", "form", "li", "table"))}
    place, same, best = np.zeros(n), np.zeros(n), np.ones(n)
    for i, node in enumerate(nodes):
        out[i, TAGS.index(node.tag) if node.tag in TAGS else TAGS.index("div")] = 1
        for token in node.tokens:
            if token in kinds:
                own[i, kinds[token]] = True
        if i:
            above[i] = above[node.parent] | own[i]
            inside[i] = inside[node.parent]
        else:
            above[i] = own[i]
        if node.tag in spots:
            inside[i, spots[node.tag]] = True
        if node.kids:
            tags = Counter(nodes[k].tag for k in node.kids)
            most = max(text[k] for k in node.kids)
            for at, k in enumerate(node.kids):
                place[k] = at / max(1, len(node.kids) - 1)
                same[k] = tags[nodes[k].tag] / len(node.kids)
                best[k] = text[k] / max(1.0, most)
    parent = np.array([max(0, x.parent) for x in nodes])
    safe = np.maximum(text, 1)
    rank = text / max(1.0, max((text[i] for i, x in enumerate(nodes) if x.tag in ("article", "main", "section", "div", "cell", "text")), default=1.0))
    tail = np.stack(
        [
            np.minimum([x.depth for x in nodes], 30),
            np.log1p([len(x.kids) for x in nodes]),
            place,
            same,
            np.log1p(text),
            text / max(1.0, text[0]),
            links / safe,
            50 * marks / safe,
            text / np.maximum(words, 1),
            np.log1p(text / count),
            marks / np.maximum(words, 1),
            text / np.maximum(text[parent], 1),
            best,
            rank,
            np.log1p(heads),
            np.log1p(paras),
        ],
        axis=1,
    )
    out[:, len(TAGS) :] = np.hstack([own, above, inside, tail])
    return out


@dataclass(frozen=True)
class Forest:
    """Boosted regression trees as flat arrays: feature, threshold, left, right, value; a leaf has feature -1."""

    trees: tuple

    def chances(self, rows):
        import numpy as np

        total = np.zeros(len(rows))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                down = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(down, left[at], right[at]), at)
            total += weight * value[at]
        return 1 / (1 + np.exp(-2 * total))


def decode(nodes: list[Node], chances) -> list[bool]:
    """The likeliest labels where a kept node has a kept parent and, unless it is text, a kept child."""
    import numpy as np

    p = np.clip(chances, 1e-6, 1 - 1e-6)
    gain, drop = np.log(p), np.log(1 - p)
    n = len(nodes)
    none, kept, forced = drop.copy(), np.zeros(n), [-1] * n
    for i in range(n - 1, -1, -1):
        kids = nodes[i].kids
        none[i] += sum(none[k] for k in kids)
        if nodes[i].tag == "text":
            kept[i] = gain[i]
        elif not kids:
            kept[i] = -np.inf
        else:
            kept[i] = gain[i] + sum(max(none[k], kept[k]) for k in kids)
            if all(none[k] >= kept[k] for k in kids):
                forced[i] = max(kids, key=lambda k: kept[k] - none[k])
                kept[i] += kept[forced[i]] - none[forced[i]]
    keep = [False] * n
    keep[0] = bool(kept[0] > none[0])
    for i in range(n):
        if keep[i]:
            for k in nodes[i].kids:
                keep[k] = k == forced[i] or bool(kept[k] > none[k])
    return keep


def main_text(html: str | None, forest: Forest) -> str:
    nodes = parse(html)
    keep = decode(nodes, forest.chances(features(nodes)))
    return "\n".join(node.text for node, kept in zip(nodes, keep, strict=True) if kept and node.text)


def extractor(df: DataFrame, forest: Forest):
    """``html -> text`` for a column."""
    shared = Shared(df.sparkSession, forest)

    @F.arrow_udf("string")
    def extract(column):
        import numpy as np
        import pyarrow as pa

        forest, out = shared.value, []
        for at in range(0, len(column), 64):
            trees = [parse(page) for page in column[at : at + 64].to_pylist()]
            chances = forest.chances(np.concatenate([features(nodes) for nodes in trees]))
            start = 0
            for nodes in trees:
                keep = decode(nodes, chances[start : start + len(nodes)])
                start += len(nodes)
                out.append("\n".join(x.text for x, kept in zip(nodes, keep, strict=True) if kept and x.text))
        return pa.array(out, pa.string())

    return extract


def extract_pages(pages: DataFrame, forest: Forest, html: str = "html", text: str = "text") -> DataFrame:
    return pages.withColumn(text, extractor(pages, forest)(pages[html]))


@dataclass(frozen=True)
class Settings:
    """Pages laid out for the fit, and the boosted trees."""

    pages: int = 480
    rounds: int = 20
    depth: int = 4
    step: float = 0.3
    seed: int = 11


def fit(spark: SparkSession, settings: Settings = Settings()) -> Forest:
    """Boost with Spark on the nodes of ``settings.pages`` laid-out pages; the result is a few hundred numbers."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    from placeweave.llm.layouts import page

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for number in batch.column("id").to_pylist():
                html, wanted = page(settings.seed * 1_000_003 + number)
                nodes = parse(html)
                labels = [0.0] * len(nodes)
                for i in range(len(nodes) - 1, -1, -1):
                    if nodes[i].text and nodes[i].text in wanted:
                        labels[i] = 1.0
                    if labels[i] and nodes[i].parent >= 0:
                        labels[nodes[i].parent] = 1.0
                x = pa.ListArray.from_arrays(
                    pa.array(range(0, (len(nodes) + 1) * len(NAMES), len(NAMES)), pa.int32()), pa.array(features(nodes).ravel().astype(float))
                )
                yield pa.RecordBatch.from_arrays([pa.array(labels), x], names=["label", "x"])

    nodes = spark.range(0, settings.pages, 1, 4).mapInArrow(rows, "label double, x array<double>")
    nodes = nodes.select("label", array_to_vector("x").alias("features")).persist()
    boost = GBTClassifier(maxIter=settings.rounds, maxDepth=settings.depth, stepSize=settings.step, seed=settings.seed, maxBins=32)
    model = boost.fit(nodes)
    nodes.unpersist()
    return Forest(tuple(_flat(tree.toDebugString, weight) for tree, weight in zip(model.trees, model.treeWeights, strict=True)))


_RULE = re.compile(r"^( *)(?:If \(feature (\d+) <= ([-+.\dEe]+)\)|(Else) |Predict: ([-+.\dEe]+))")


def _flat(text: str, weight: float) -> tuple:
    """A tree's printed rules as arrays."""
    import numpy as np

    lines = [m for m in map(_RULE.match, text.split("\n")) if m]
    feature, threshold, left, right, value = [], [], [], [], []

    def read(at: int) -> tuple[int, int]:
        """The node that starts at line ``at``, and the line after it."""
        me, line = len(feature), lines[at]
        for column, start in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
            column.append(start)
        if line[5] is not None:
            value[me] = float(line[5])
            return me, at + 1
        feature[me], threshold[me] = int(line[2]), float(line[3])
        left[me], after = read(at + 1)
        right[me], after = read(after + 1)
        return me, after

    read(0)
    return weight, *(np.array(c) for c in (feature, threshold, left, right, value))
