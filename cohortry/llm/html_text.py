"""Main text of web pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks: whatever lies between two block-level tags, with
character references decoded and white space collapsed. A block's features are its words
and link density, those of the blocks before and after it, the long text before it in the
same container, whether it is a heading, a sentence of a paragraph or reads like a notice,
the element around it (article, boilerplate, neither), and what class, id and role names
around it hint at. A hint is weak or strong and never ends the search: long text without
links under a weak one can be main text, and so can an article inside. A decision tree,
fitted by Spark ML on a small labelled table (the blocks of the pages below, marked by
hand, and a grid of feature values marked by rule, which covers the cases between), keeps
or drops each block.

Defined results: null html and pages without main text give an empty text; every block is
kept or dropped whole; unclosed and stray tags are tolerated; repeated rows give repeated
rows; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from cohortry.llm.common import map_batches, type_of

# Fixed values of HTML: elements by how they shape text.
RAW = "script style noscript template title textarea iframe noembed noframes xmp"
BLOCK = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
SKIPPED = "head select option button svg canvas object video audio map datalist".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
# An opening tag on the left closes an open one on the right, if that lies inside the scope.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
          "option": ({"option"}, {"select"})}

# Words in class, id and role names that tell what a container is for.
ARTICLE_HINTS = set("article articlebody content main post entry story maincontent".split())
# These also tell it as the last word of a longer name ("post-comments", "main-menu").
STRONG_HINTS = set(
    "nav navbar navigation menu submenu sidebar aside complementary breadcrumb breadcrumbs ad ads adv advert adverts "
    "advertisement advertising adsense banner cookie cookies consent gdpr newsletter sharebar pagination pager footer "
    "contentinfo copyright masthead comment comments commentlist respond replies disqus discussion toc"
    .split()
)
SIDE_HINTS = STRONG_HINTS | set(
    "sponsor sponsored promo promotion notice notices notification alert popup modal overlay subscribe subscription signup "
    "login social share sharing related recommended recommendations widget widgets toolbar search reply form skip hidden"
    .split()
)
HEADER_HINTS = {"header", "topbar"}
# Words that say nothing about a purpose, and words that turn a name into one of the page's layout.
NEUTRAL_HINTS = set("a the my site page area block box container wrapper wrap inner outer section list item items left right top bottom group bar region posts articles stories links".split())
LAYOUT_HINTS = set("has no with without hide show is".split())
NOTICE = re.compile(
    r"©|\bcookies?\b|all rights reserved|\bcopyright\b|\bnewsletter\b|\bsubscribe\b|\badvertisement\b|\bsponsored\b|"
    r"privacy policy|terms of (?:use|service)|\b(?:sign|log) ?(?:in|up)\b",
    re.I,
)
NOTICE_WORDS = 40
# What is a notice inside an article too.
APPEAL = re.compile(
    r"\b(?:we|site|website|page|pages) uses? cookies\b|\baccept (?:all )?cookies\b|\bcookie (?:policy|settings|preferences)\b|"
    r"\bsubscribe (?:now|today|here)?\s*(?:to|for) (?:our|the|my)\b.*\b(?:newsletter|updates|channel|mailing list)\b|"
    r"\bsign up (?:for|to) (?:our|the)\b.*\bnewsletter\b|^(?:advertisement|sponsored(?: content)?)\W*$",
    re.I | re.S,
)
APPEAL_WORDS = 25
SENTENCE = re.compile(r"[.!?…][\"'”’»)\]]*$")
LONG_WORDS = 14

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW.replace(' ', '|')})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>",
    re.S | re.I,
)
_HINT = re.compile(r"(?<![\w:.-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CONTAINERS = set("address article aside body center details dialog div fieldset figure footer form header main nav section table td th".split())
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

ARTICLE, NEITHER, SIDE, SKIP, HEAD = 1, 0, -1, -2, -3
NO_HINT, WEAK, STRONG = 0, 1, 2
FEATURES = (
    "place", "hint", "words", "links", "long_before", "words_before", "links_before", "words_after", "links_after", "heading", "sentence", "notice",
)
TREE_DEPTH = 16

_LONG = "It was a long way from the old harbour to the house on the hill, and nobody who had walked it in winter cared to walk it again before spring. "
# Pages whose blocks are marked by hand: + is main text, - is not.
LABELLED_PAGES = (
    f"""<body class="no-sidebar"><header><h1>- The Daily Page</h1><p>- All the news of the hill</p></header><nav><ul><li><a>- Home</a><li><a>- News</a></ul></nav>
    <article><header><h1>+ A winter walk</h1><span>- by Someone</span></header><p>+ {_LONG}<p>+ Yes.<p>+ {_LONG * 2}<ul><li>+ boots<li>+ a warm hat</ul>
    <p><a>+ The whole of this paragraph is a link to another walk.</a><ul><li><a>- Another walk</a><li><a>- A third walk</a></ul>
    <p>- We use cookies to make this page better for you.<p>- Subscribe to our newsletter today<p>+ Take care.</article><footer>- Copyright 2020 The Daily Page</footer>""",
    f"""<div class="site-header">- Hill and harbour</div><div class="main-menu"><a>- Home</a> <a>- Walks</a></div><div id="wrap"><h1>+ The house on the hill</h1>
    <p>+ {_LONG}<p>+ No.<p>+ Yes, always.<h2>+ Later</h2><p>+ {_LONG * 3}<p>+ That was all.</div><div>- Home of good walks</div><p>- All rights reserved.""",
    f"""<main class="has-sidebar"><h1>+ Tides</h1><p>+ {_LONG}<p>+ They turn.<p>+ {_LONG}</main><div class="sidebar"><p>- {_LONG}</div>""",
    f"""<article class="post search-result"><h2>+ Found</h2><p>+ {_LONG}<p>+ It ends here.</article><div class="related-posts"><p>- {_LONG}<a>- More</a></div>""",
    f"""<div class="content-social"><p>+ {_LONG * 2}<a>- Share</a><p>- Tell friends</div><div class="social"><p>- {_LONG}</div>""",
    f"""<div data-id="comment"><p>+ {_LONG}<p>+ {_LONG}<p>+ The end.</div><div class="post-comments"><article><p>- {_LONG}<p>- Great!</article></div>""",
    f"""<div class="promo-grid"><article><p>+ {_LONG}<p>+ And on.</article><p>- Buy now</div><aside><p>- {_LONG * 2}</aside><div class="ad">- {_LONG}</div>""",
    f"""<div id="cookie-notice"><p>- {_LONG}</div><div role="main"><p>+ Short start.<p>+ {_LONG}<blockquote>+ Said nobody.</blockquote></div><div role="navigation">- Up Down</div>""",
    f"""<table><tr><td><a>- One</a> <a>- Two</a><td><p>+ {_LONG}<p>+ {_LONG}<td><a>- {_LONG}</a></table><p>- 12 readers<p>- Next""",
)


def _by_rule(place, hint, words, links, long_before, words_before, links_before, words_after, links_after, heading, sentence, notice) -> int:
    """The mark of a grid point. It gives labels only; pages are judged by the tree."""
    if place == SIDE or hint == STRONG or notice == 2:
        return 0
    if place == ARTICLE and hint == NO_HINT:
        return int(links < 0.5 or (sentence and words >= 6))
    if links >= 0.5 or notice:
        return 0
    if words >= LONG_WORDS:
        return 1
    before, after = words_before >= LONG_WORDS and links_before < 0.5, words_after >= LONG_WORDS and links_after < 0.5
    return int(hint == NO_HINT and (long_before >= LONG_WORDS or (after and (heading or before))))


def _grid() -> list[tuple[float, ...]]:
    around = [(0, 0.0), (13, 0.1), (14, 0.1), (60, 0.9)]
    kinds = [(0, 0, 0), (0, 1, 0), (1, 0, 0), (0, 0, 1), (0, 1, 1), (0, 0, 2), (0, 1, 2)]
    few = [(0, *around[0], *around[3]), (0, *around[1], *around[2]), (60, *around[2], *around[2]), (0, *around[2], *around[2])]
    every = [(long, *before, *after) for long in (0, 14) for before in around for after in around]
    points = []
    for place, hint in ((SIDE, 0), (SIDE, 1), (SIDE, 2), (NEITHER, 2), (ARTICLE, 2), (ARTICLE, 0), (ARTICLE, 1), (NEITHER, 1), (NEITHER, 0)):
        for words in (1, 5, 6, 13, 14, 25, 400):
            for links in (0.0, 0.45, 0.55, 1.0):
                for kind in kinds:
                    if not (kind[2] and words > NOTICE_WORDS) and not (kind[2] == 2 and words > APPEAL_WORDS):
                        near = every if (place, hint) == (NEITHER, 0) and words in (1, 6, 13) and links == 0.45 else few
                        points += [(place, hint, words, links, *n, *kind) for n in near]
    return [(*point, _by_rule(*point)) for point in points]


def labelled_table() -> list[tuple[float, ...]]:
    """Features of the labelled blocks, then 1 for main text."""
    out = []
    for page in LABELLED_PAGES:
        blocks = blocks_of(page)
        out += [(*row, int(b.text.startswith("+"))) for b, row in zip(blocks, features(blocks)) if b.text[0] in "+-"]
    return out + _grid()


@dataclass
class Block:
    text: str
    place: int
    words: int
    links: float
    heading: int
    hint: int = NO_HINT
    container: int = 0
    paragraph: bool = False

    @property
    def notice(self) -> int:
        if self.words <= APPEAL_WORDS and APPEAL.search(self.text):
            return 2
        return int(self.words <= NOTICE_WORDS and NOTICE.search(self.text) is not None)

    @property
    def sentence(self) -> int:
        return int(self.paragraph and SENTENCE.search(self.text) is not None)


def _hint_of(name: str) -> tuple[int, bool, bool]:
    """What one class, id or role name hints at: boilerplate (none, weak, strong), an article, a header."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in LAYOUT_HINTS:
        return NO_HINT, False, False
    words = [w for w in words if w not in NEUTRAL_HINTS]
    if not words:
        return NO_HINT, False, False
    if all(w in SIDE_HINTS for w in words) or words[-1] in STRONG_HINTS:
        return STRONG, False, False
    if words[-1] in HEADER_HINTS:
        return NO_HINT, False, True
    weak = any(w in SIDE_HINTS for w in words)
    return (WEAK if weak else NO_HINT), all(w in ARTICLE_HINTS for w in words), False


def _place_of(tag: str, rest: str, parent: int, around: int) -> tuple[int, bool, int]:
    """What a container is for, whether nothing inside can be main text again, and the hint in force."""
    if tag in SKIPPED or (rest and _HIDDEN.search(rest)):
        return SKIP, True, around
    if tag in ("nav", "aside", "footer", "search", "dialog", "menu"):
        return SIDE, True, around
    hint, article, header = NO_HINT, False, tag == "header"
    if rest and tag not in ("html", "body"):
        for found in _HINT.finditer(rest):
            for name in (found[1] or found[2] or found[3] or "").split():
                kind, names_article, names_header = _hint_of(name)
                hint, article, header = max(hint, kind), article or names_article, header or names_header
    if hint == STRONG and tag != "main":
        return parent, False, STRONG
    if header:
        return (SIDE if parent != ARTICLE else HEAD), False, max(hint, around)  # an article's own header keeps its headings
    if tag == "form":
        return SIDE, False, max(hint, around)
    if tag in ("article", "main") or article:
        # An article leaves weak hints behind, the page's main element any.
        return ARTICLE, False, around if around == STRONG and tag != "main" else NO_HINT
    return parent, False, max(hint, around)


def blocks_of(source: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    # Open elements: tag, place, whether the place is final, hint in force, number of the container.
    stack: list[tuple[str, int, bool, int, int]] = [("", NEITHER, False, NO_HINT, 0)]
    containers = 0
    pieces: list[tuple[str, bool]] = []

    def flush() -> None:
        if not pieces:
            return
        tag, place, _, hint, container = stack[-1]
        heading = int(any(tag in HEADINGS for tag, *_ in stack[-3:]))
        if place == HEAD:
            place = ARTICLE if heading else SIDE
        text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if text and place != SKIP:
            words = len(text.split(" "))
            linked = sum(len(html.unescape(p).split()) for p, inside in pieces if inside)
            out.append(Block(text, place, words, min(1.0, linked / words), heading, hint, container, tag == "p"))
        pieces.clear()

    def close(names: set[str], scope: set[str] | None = None) -> None:
        """Leave the innermost open element of these names, unless the scope ends before."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if scope is not None and stack[i][0] in scope:
                return

    links, at = 0, 0
    for token in _TOKEN.finditer(source):
        if token.start() > at:
            pieces.append((source[at : token.start()], links > 0))
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        end, rest = token["end"] or token["end2"], token["rest"] or ""
        if tag == "br":
            pieces.append((" ", False))
        elif tag == "a":
            links = 0 if end else 1
        elif end:
            if tag in BLOCK:
                flush()
                if tag == "p":
                    close({"p"}, set(BLOCK) - {"p"})
                else:
                    close({tag})
            else:
                hinted = stack[-1][0] == tag
                if hinted:
                    if stack[-1][1] in (SKIP, SIDE) or stack[-1][3]:
                        flush()
                    close({tag})
        else:
            block = tag in BLOCK
            if block:
                flush()
                close({"p"}, set(BLOCK) - {"p"})
                if tag == "body":
                    close({"head"})
                if tag in CLOSES:
                    close(*CLOSES[tag])
            if tag in VOID or rest.endswith("/") and tag not in BLOCK:
                continue
            _, parent, final, around, container = stack[-1]
            place, ends, hint = (parent, final, around) if final else _place_of(tag, rest, parent, around)
            if block or tag in SKIPPED or (place, hint) != (parent, around):
                if not block and (place, hint) != (parent, around):
                    flush()
                if tag in CONTAINERS:
                    containers += 1
                    container = containers
                stack.append((tag, place, ends, hint, container))
    if at < len(source):
        pieces.append((source[at:], links > 0))
    flush()
    return out


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    rows = []
    long_before: dict[int, int] = {}
    for i, b in enumerate(blocks):
        before = blocks[i - 1] if i else None
        after = blocks[i + 1] if i + 1 < len(blocks) else None
        rows.append((
            b.place, b.hint, b.words, b.links, long_before.get(b.container, 0),
            before.words if before else 0, before.links if before else 0.0,
            after.words if after else 0, after.links if after else 0.0,
            b.heading, b.sentence, b.notice,
        ))
        if b.words >= LONG_WORDS and b.links < 0.5 and not b.notice:
            long_before[b.container] = long_before.get(b.container, 0) + b.words
    return rows


Tree = tuple  # (feature, threshold, left, right) or (label,)


def fit_tree(spark: SparkSession, labelled: list[tuple[float, ...]] | None = None) -> Tree:
    """Fit the decision tree on the labelled table and take its nodes."""
    rows = [(Vectors.dense(*row[:-1]), float(row[-1])) for row in (labelled if labelled is not None else labelled_table())]
    data = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=TREE_DEPTH, maxBins=256, seed=1).fit(data)

    def nodes(node) -> Tree:
        if node.subtreeDepth() == 0:
            return (int(node.prediction()),)
        split = node.split()
        return split.featureIndex(), split.threshold(), nodes(node.leftChild()), nodes(node.rightChild())

    return nodes(model._java_obj.rootNode())


def decide(tree: Tree, row: tuple[float, ...]) -> int:
    while len(tree) > 1:
        feature, threshold, left, right = tree
        tree = left if row[feature] <= threshold else right
    return tree[0]


def main_text(source: str | None, tree: Tree) -> str:
    blocks = blocks_of(source or "")
    return "\n\n".join(b.text for b, row in zip(blocks, features(blocks)) if decide(tree, row))


def extract_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    tree = tree or fit_tree(pages.sparkSession)

    def extract(batch: pa.RecordBatch) -> dict[str, object]:
        texts = [main_text(source, tree) for source in batch.column("html").to_pylist()]
        return {
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64()),
        }

    return map_batches(
        pages.select("page_id", "url", "html"), extract, f"page_id {type_of(pages, 'page_id')}, url string, text string, n_chars bigint"
    )
