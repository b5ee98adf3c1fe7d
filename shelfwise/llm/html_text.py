"""Main text of web pages by a graphical model on the page's tree.

Every element and every block of text is a node with two states, content or
not. A node's own evidence (tag, words in its class, length, share of links) is
a logistic potential; each edge to the parent has a table of potentials for the
four pairs of states, one table for each kind of child. Messages pass from the
leaves to the root and back (sum-product, exact on a tree); a block is kept if
its marginal for content is above one half.

Potentials are trained from labelled pages: pages whose markup itself says what
the article is. Each is used as it is, with those tags made plain, so that the
model also learns to do without them, and with its own paragraphs put into lists,
tables and quotations of the article and into comments, forms, notices and
sidebars, so that a paragraph alone does not make an article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.frames import chunks, extended, plus

#: Pages that the model is trained on, those with the least hash of their text.
SAMPLE_PAGES = 1500

#: Elements without content; elements whose content is no markup;
#: elements that begin and end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Which open elements a start tag ends.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
#: Tags and words of classes and ids that mark what is not the article, and what is.
ASIDE_TAGS = frozenset("nav footer header aside form button menu dialog fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "footer form header login menu nav navbar navigation newsletter notice popup promo related reply replies share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())

#: Words that stand beside such words in names of parts of a page, and say nothing alone.
FURNITURE = MAIN_WORDS | frozenset(
    "area bar block body bottom box button buttons col column container frame group head holder icon icons inner item items "
    "left line link links list message messages module outer page panel posts primary right row secondary section site slot "
    "strip text title top unit wrap wrapper".split()
)
#: Of the marks, those that a paragraph or heading of an article may have itself; and such tags.
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement promo sponsor sponsored".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figure figcaption table ul ol dl".split())

# Attribute values end at their quote or, without one, at a blank or the end of the tag.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^\s/>=]++)*+)>|<[!?/][^>]*+>""", re.S
)
_NAMES = re.compile(r"""(?:^|[\s/"'])(?:class|id|role)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>|</{name}\Z", re.I) for name in RAW}

FEATURES = (
    "bias", "leaf", "aside", "main", "p", "heading", "list", "table", "inline", "short", "medium", "long", "some links", "mostly links", "sentences", "empty"
)
_at = {name: i for i, name in enumerate(FEATURES)}
#: Kinds of edges, by the child: it has a mark of its own, it has none, it is a block of text.
MARKED, PLAIN, LEAF = range(3)


@dataclass
class Tree:
    """Nodes in page order, so parents come first. A leaf's text is its block."""

    parent: list[int]
    tag: list[str]  # "" for a block of text
    words: list[tuple]  # of classes, ids and roles: the words of each
    text: list[str]
    links: list[int]  # code points of a block that are inside links


def _split(names: str) -> tuple[frozenset, ...]:
    """The words of each name, as in `site-header` and `siteHeader`."""
    return tuple(frozenset(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())) for name in names.split())


def parse(page: str) -> Tree:
    """The tree of a page; forgiving about ends that are missing or have no start."""
    tree = Tree([-1], ["#"], [()], [""], [0])
    stack, open_tags = [0], Counter()
    run: list[str] = []
    in_links, linked = 0, 0

    def end_block() -> None:
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                at = next((s for s in reversed(stack) if tree.tag[s] in BLOCK), 0)
                for part, value in zip((tree.parent, tree.tag, tree.words, tree.text, tree.links), (at, "", (), text, linked), strict=True):
                    part.append(value)
            run, linked = [], 0

    def add_text(text: str) -> None:
        nonlocal linked
        text = html.unescape(text)
        run.append(text)
        if in_links:
            linked += len(text)

    def close(names: set[str] | frozenset[str]) -> None:
        """Ends open elements up to and with the innermost of these names."""
        nonlocal in_links
        if not any(open_tags[n] for n in names):
            return
        while True:
            tag = tree.tag[stack[-1]]
            if tag in BLOCK:
                end_block()
            stack.pop()
            open_tags[tag] -= 1
            in_links -= tag == "a"
            if tag in names:
                return

    at = 0
    while match := _TAG.search(page, at):
        if match.start() > at:
            add_text(page[at : match.start()])
        at = match.end()
        if not match[2]:
            continue
        name = match[2].lower()
        if match[1]:
            if name in BLOCK:
                end_block()
            close({name})
            continue
        if name == "br":
            run.append(" ")
        if name in VOID:
            if name in BLOCK:
                end_block()
            continue
        if name in BLOCK:
            end_block()
            if name not in ("html", "head", "body"):
                close({"p"})
        if name in ENDS:
            close(ENDS[name])
        if name in RAW:
            ended = _RAW_END[name].search(page, at)
            at = ended.end() if ended else len(page)
            continue
        found = " ".join(filter(None, (a or b or c for a, b, c in _NAMES.findall(match[3])))) if match[3] else ""
        for part, value in zip(
            (tree.parent, tree.tag, tree.words, tree.text, tree.links),
            (stack[-1], name, _split(found), "", 0),
            strict=True,
        ):
            part.append(value)
        stack.append(len(tree.tag) - 1)
        open_tags[name] += 1
        in_links += name == "a"
    if at < len(page):
        add_text(page[at:])
    end_block()
    return tree


def _marks(tree: Tree, masked: bool) -> tuple[list[bool], list[bool]]:
    """Which nodes are marked as something beside the article, and which as the
    article.

    A name is a mark as a whole, `related` or `related-links` but not `related-work`.
    An article and what contains it is never marked as beside it, whatever its names
    (`has-comments`); prose inside one only by names of adverts.
    """
    n = len(tree.tag)
    inside, holds = [t in MAIN_TAGS for t in tree.tag], [t in MAIN_TAGS or t in ("html", "body") for t in tree.tag]
    for i in range(1, n):
        inside[i] = inside[i] or inside[tree.parent[i]]
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[tree.parent[i]] = True

    def beside(i: int) -> bool:
        if holds[i]:
            return False
        if tree.tag[i] in ASIDE_TAGS:
            return True
        marks = ADVERT_WORDS if inside[i] and tree.tag[i] in PROSE else ASIDE_WORDS
        return any(words & marks and words <= ASIDE_WORDS | FURNITURE for words in tree.words[i])

    aside = [bool(t) and beside(i) for i, t in enumerate(tree.tag)]
    main = [
        not a and not masked and (t in MAIN_TAGS or any(words & MAIN_WORDS for words in w))
        for t, w, a in zip(tree.tag, tree.words, aside, strict=True)
    ]
    return aside, main


def evidence(tree: Tree, masked: bool = False) -> tuple[list[tuple[int, ...]], list[int]]:
    """The features of each node that hold, and its kind of edge."""
    n = len(tree.tag)
    size, linked, stops = [len(t) for t in tree.text], list(tree.links), [t.count(". ") + t.endswith(".") for t in tree.text]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        size[p] += size[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    aside, main = _marks(tree, masked)
    found, kinds = [], []
    for i, tag in enumerate(tree.tag):
        own = [_at["bias"]]
        if not tag:
            own.append(_at["leaf"])
        if aside[i]:
            own.append(_at["aside"])
        if main[i]:
            own.append(_at["main"])
        if tag == "p":
            own.append(_at["p"])
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            own.append(_at["heading"])
        elif tag in ("ul", "ol", "li", "dl", "dt", "dd"):
            own.append(_at["list"])
        elif tag in ("table", "tr", "td", "th", "tbody"):
            own.append(_at["table"])
        elif tag and tag not in BLOCK:
            own.append(_at["inline"])
        length = size[i]
        own.append(_at["empty"] if not length else _at["short"] if length < 40 else _at["medium"] if length < 200 else _at["long"])
        if length and linked[i] * 2 > length:
            own.append(_at["mostly links"])
        elif linked[i] * 10 > length:
            own.append(_at["some links"])
        if stops[i] > 1:
            own.append(_at["sentences"])
        found.append(tuple(own))
        kinds.append(LEAF if not tag else MARKED if aside[i] or main[i] else PLAIN)
    return found, kinds


_ADDED = frozenset(("xbeside",))


def labels(tree: Tree) -> list[int] | None:
    """States that the elements give, whatever they are named: a block is content
    inside an article and not inside an element for something else there, nor inside
    what `enriched` has added as such; an element is if most of its text is. None if
    the page has no article."""
    inside = [False] * len(tree.tag)
    content, total = [0] * len(tree.tag), [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        p, tag = tree.parent[i], tree.tag[i]
        inside[i] = tag in MAIN_TAGS or (inside[p] and tag not in ASIDE_TAGS and _ADDED not in tree.words[i])
        content[i], total[i] = len(tree.text[i]) * inside[i], len(tree.text[i])
    if not any(t in MAIN_TAGS for t in tree.tag):
        return None
    for i in range(len(tree.tag) - 1, 0, -1):
        content[tree.parent[i]] += content[i]
        total[tree.parent[i]] += total[i]
    return [int(2 * c > t) if t else int(inside[i]) for i, (c, t) in enumerate(zip(content, total, strict=True))]


@dataclass
class Model:
    weights: list[float]  # of FEATURES
    edges: list[list[list[float]]]  # for each kind: potential [state of parent][state of child]


#: What a model is if there is no labelled page: marks decide, text is content.
UNTRAINED = Model(
    [0.5 if f in ("leaf", "long", "sentences", "p") else 3.0 if f == "main" else -3.0 if f in ("aside", "mostly links") else 0.0 for f in FEATURES],
    [[[1.0, 1.0], [1.0, 1.0]], [[3.0, 1.0], [1.0, 3.0]], [[3.0, 1.0], [1.0, 3.0]]],
)


def marginals(tree: Tree, model: Model, masked: bool = False) -> list[float]:
    """Probability of content for each node."""
    found, kinds = evidence(tree, masked)
    n = len(found)
    # odds of content against not: own, then with all that is below
    own = []
    for features in found:
        score = 0.0
        for f in features:
            score += model.weights[f]
        own.append(max(-12.0, min(12.0, score)))
    below = own.copy()
    message = [0.0] * n
    for i in range(n - 1, 0, -1):
        table = model.edges[kinds[i]]
        odds = math.exp(max(-30.0, min(30.0, below[i])))
        message[i] = math.log((table[1][0] + table[1][1] * odds) / (table[0][0] + table[0][1] * odds))
        below[tree.parent[i]] += message[i]
    total = below.copy()
    for i in range(1, n):
        p = tree.parent[i]
        table = model.edges[kinds[i]]
        odds = math.exp(max(-30.0, min(30.0, total[p] - message[i])))
        total[i] = below[i] + math.log((table[0][1] + table[1][1] * odds) / (table[0][0] + table[1][0] * odds))
    return [1 / (1 + math.exp(max(-30.0, min(30.0, -t)))) for t in total]


def extract(page: str, model: Model) -> str:
    """The blocks that are content, in page order, two line ends between them."""
    tree = parse(page)
    chances = marginals(tree, model)
    return "\n\n".join(t for t, tag, p in zip(tree.text, tree.tag, chances, strict=True) if not tag and t and p > 0.5)


#: What a labelled page is given more of, inside and after its article.
# `xbeside` tells the labels which of the added parts are not of the article.
_INSIDE = (
    "<h2>{0}</h2><ul><li>{1}</li><li>{2}</li></ul><blockquote>{3}</blockquote><table><tr><td>{1}</td><td>{2}</td></tr></table>"
    "<figure><img src='x'><figcaption>{0}</figcaption></figure><p>{1} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>"
    "<div><p>{2}</p></div><aside><p>{1}</p></aside><div class='share xbeside'><ul><li><a href='#'>{0}</a></li></ul></div>"
    "<section class='comments xbeside'><p>{3}</p><p>{1}</p></section><div class='notice xbeside'><p>{2}</p></div>"
)
_AFTER = (
    "<section class='comments'><h3>{0}</h3><p>{1}</p><p>{3}</p></section><div class='sidebar'><p>{2}</p></div>"
    "<form><p>{3}</p></form><div id='cookie-notice'><p>{1}</p></div><header><h1>{0}</h1><p>{2}</p></header>"
)
_ARTICLE_END = re.compile(r"</(?:article|main)\s*>", re.I)


def enriched(page: str) -> str:
    """A labelled page with its own blocks of text set in further surroundings."""
    blocks = [t for t in parse(page).text if t]
    end = _ARTICLE_END.search(page)
    if not blocks or not end:
        return page
    longest = sorted(blocks, key=len)[-3:]
    own = [html.escape(t) for t in (blocks[len(blocks) // 2][:60], *longest, *blocks, *blocks, *blocks)][:4]
    return page[: end.start()] + _INSIDE.format(*own) + end[0] + _AFTER.format(*own) + page[end.end() :]


def observed(page: str) -> tuple[Counter, Counter]:
    """Counts of (features, state) and of (kind, state of parent, state of child)
    of a labelled page in its variants."""
    nodes, edges = Counter(), Counter()
    richer = enriched(page)
    for variant, masked in ((page, False), (page, True), (richer, False), (richer, True)):
        tree = parse(variant)
        states = labels(tree)
        if states is None:
            break
        found, kinds = evidence(tree, masked)
        nodes.update(zip(found[1:], states[1:], strict=True))
        edges.update((kinds[i], states[tree.parent[i]], states[i]) for i in range(1, len(states)))
    return nodes, edges


def fit(nodes: Counter, edges: Counter) -> Model:
    """Logistic weights by Newton steps; edge potentials are how much more often
    two states meet than their frequencies say."""
    if not nodes:
        return UNTRAINED
    x = np.zeros((len(nodes), len(FEATURES)))
    y, n = np.zeros(len(nodes)), np.zeros(len(nodes))
    for i, ((features, state), count) in enumerate(sorted(nodes.items())):
        x[i, list(features)] = 1
        y[i], n[i] = state, count
    n = n / n.sum() * 100_000
    beta = np.zeros(len(FEATURES))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(beta)), x.T @ (n * (y - p)) - 0.5 * beta)
        beta += np.clip(step, -2, 2)
    tables = []
    for kind in range(3):
        met = np.array([[edges[kind, a, b] for b in (0, 1)] for a in (0, 1)], float)
        met += 0.001 * met.sum() + 1
        tables.append((met * met.sum() / np.outer(met.sum(1), met.sum(0))).tolist())
    return Model(beta.tolist(), tables)


def train(pages: DataFrame, column: str = "html", rows: int = SAMPLE_PAGES) -> Model:
    """A model from the labelled pages among a sample of at most `rows`. What
    reaches the driver are counts of feature sets, a few thousand at most. Copies
    of a page are one in the sample's size but all count."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, edges = Counter(), Counter()
        for batch in batches:
            for page in batch.column("page").to_pylist():
                more = observed(page)
                nodes.update(more[0])
                edges.update(more[1])
        rows = [(list(f), s, -1, c) for (f, s), c in nodes.items()] + [([k], b, a, c) for (k, a, b), c in edges.items()]
        if rows:
            types = [pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["features", "state", "above", "n"])

    source = pages.select(F.col(f"`{column}`").alias("page")).where("page is not null").withColumn("rank", F.xxhash64("page"))
    # the greatest rank in the sample is found from ranks alone, so whole pages stay where they are
    last = source.select("rank").distinct().orderBy("rank").limit(rows).agg(F.max("rank")).first()[0]
    sample = source.where(F.col("rank") <= (F.lit(None) if last is None else F.lit(last))).select("page")
    seen = sample.mapInArrow(count, "features array<int>, state int, above int, n long")
    seen = seen.groupBy("features", "state", "above").agg(F.sum("n").alias("n")).collect()
    nodes = Counter({(tuple(r.features), r.state): r.n for r in seen if r.above < 0})
    edges = Counter({(r.features[0], r.above, r.state): r.n for r in seen if r.above >= 0})
    return fit(nodes, edges)


TEXT = T.StructType([T.StructField("text", T.StringType())])


def extract_text(pages: DataFrame, model: Model, column: str = "html") -> DataFrame:
    """The pages with their main `text`, in place of any column of that name.

    Null and empty pages, and pages without content, have an empty text. Pages
    are used whole. Repeated rows are extracted each; an empty table stays empty.
    """
    kept, schema = extended(pages, TEXT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, column):
            found = [extract(page, model) if page else "" for page in batch.column(column).to_pylist()]
            yield plus(batch, {"text": pa.array(found, pa.string())})

    return kept.mapInArrow(run, schema)
