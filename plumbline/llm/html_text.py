"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a flat list of text blocks.  A block knows its number of
words, its link density (share of words inside links), those of its two
neighbours, and what its open elements say (navigation and the like, or the
article).  A decision tree, grown from the small labelled table below, tells
main text from the rest.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXT_SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"

#: elements that begin and end a block
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section select summary table tbody td tfoot th thead tr ul".split()
)
#: elements without content
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no markup; none of it is text of the page
RAW_TAGS = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes select button".split())
#: elements that hold no article text
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: words of class, id and role attributes around the article, and of the article itself
ASIDE_WORDS = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|widget\w*|related|recommend\w*"
    r"|share|sharing|social|cookies?|consent|gdpr|notice|newsletter|subscribe|signup|login|popup|modal|overlay|footer\w*|header\w*"
    r"|masthead|topbar|toolbar|comments?|commentlist|disqus|respond|reply|replies|pagination|pager|search|copyright|legal"
    r"|contentinfo|complementary|navigation|alert|dialog)"
)
MAIN_WORDS = re.compile(r"article\w*|post|entry|story|main|content|body|text")
#: of these, those that name a part of a page whatever word stands before them
PART_WORDS = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|widget\w*|cookies?|consent|newsletter"
    r"|popup|modal|overlay|footer\w*|header\w*|masthead|topbar|toolbar|comments?|commentlist|pagination|pager)"
)
#: words that name no part of a page, before or behind those that do
PLACE_WORDS = frozenset("site page top bottom left right global primary secondary".split())
BOX_WORDS = frozenset(
    "area bar block box buttons column container form inner items links list panel posts region section slot unit wrap wrapper zone".split()
)
#: words that begin what is said about an element, and not what it is
MODIFIERS = frozenset("has have no not with without is show hide tag category cat topic author format type status layout template theme".split())

FEATURES = (
    "words", "links", "before_words", "before_links", "after_words", "after_links", "aside", "article", "heading",
)
#: the labelled table: the features of a block and 1 for main text
LABELLED = (
    # inside an article: paragraphs of any length, headings, list items
    (60, 0.0, 8, 0.0, 45, 0.0, 0, 1, 0, 1),
    (45, 0.0, 60, 0.0, 1, 0.0, 0, 1, 0, 1),
    (1, 0.0, 45, 0.0, 3, 0.0, 0, 1, 0, 1),
    (3, 0.0, 1, 0.0, 80, 0.05, 0, 1, 0, 1),
    (80, 0.05, 3, 0.0, 9, 0.0, 0, 1, 0, 1),
    (9, 0.0, 80, 0.05, 5, 0.0, 0, 1, 1, 1),
    (8, 0.0, 7, 0.0, 60, 0.0, 0, 1, 1, 1),
    (5, 0.0, 9, 0.0, 120, 0.0, 0, 1, 0, 1),
    (120, 0.1, 5, 0.0, 12, 0.0, 0, 1, 0, 1),
    (12, 0.4, 120, 0.1, 30, 0.0, 0, 1, 0, 1),
    (4, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (2, 0.0, 5, 1.0, 7, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1),
    (2, 0.0, 1, 0.0, 2, 1.0, 0, 1, 0, 1),
    (1, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (3, 0.0, 1, 1.0, 1, 0.0, 0, 1, 1, 1),
    (1, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0, 1),
    (2, 0.0, 60, 0.0, 2, 1.0, 0, 1, 0, 1),
    (4, 0.0, 3, 0.0, 4, 0.0, 0, 1, 0, 1),
    (7, 0.0, 2, 1.0, 1, 0.0, 0, 1, 1, 1),
    (5, 0.0, 7, 0.0, 5, 0.0, 0, 1, 0, 1),
    (30, 0.0, 12, 0.4, 6, 0.0, 0, 1, 0, 1),
    (15, 0.2, 30, 0.0, 40, 0.0, 0, 1, 0, 1),
    (200, 0.0, 15, 0.2, 6, 1.0, 0, 1, 0, 1),
    (6, 0.5, 40, 0.0, 50, 0.0, 0, 1, 0, 1),
    (4, 1.0, 200, 0.0, 5, 1.0, 0, 1, 0, 1),
    (5, 1.0, 4, 1.0, 4, 1.0, 0, 1, 0, 1),
    (3, 1.0, 5, 1.0, 7, 0.0, 0, 1, 0, 1),
    # navigation, adverts, footers, forms, notices, comments: of any length, with links or without
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0),
    (1, 1.0, 1, 1.0, 7, 0.0, 1, 0, 0, 0),
    (7, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (25, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0, 0),
    (60, 0.0, 25, 0.0, 90, 0.0, 1, 0, 0, 0),
    (90, 0.1, 60, 0.0, 9, 0.3, 1, 0, 0, 0),
    (9, 0.3, 90, 0.1, 0, 0.0, 1, 0, 0, 0),
    (150, 0.0, 9, 0.3, 40, 0.0, 1, 0, 0, 0),
    (40, 0.0, 150, 0.0, 6, 0.0, 1, 0, 1, 0),
    (6, 0.0, 40, 0.0, 30, 0.0, 1, 1, 1, 0),
    (30, 0.0, 6, 0.0, 45, 0.0, 1, 1, 0, 0),
    (45, 0.0, 30, 0.0, 0, 0.0, 1, 1, 0, 0),
    (3, 0.0, 45, 0.0, 2, 1.0, 1, 1, 0, 0),
    (12, 1.0, 80, 0.0, 12, 1.0, 1, 1, 0, 0),
    # pages without such hints: long blocks with few links, and short ones between them
    (70, 0.0, 4, 0.0, 50, 0.0, 0, 0, 0, 1),
    (50, 0.05, 70, 0.0, 33, 0.0, 0, 0, 0, 1),
    (33, 0.0, 50, 0.05, 2, 1.0, 0, 0, 0, 1),
    (90, 0.0, 1, 1.0, 18, 0.0, 0, 0, 0, 1),
    (18, 0.0, 90, 0.0, 40, 0.0, 0, 0, 0, 1),
    (25, 0.1, 18, 0.0, 60, 0.0, 0, 0, 0, 1),
    (22, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (6, 0.0, 70, 0.0, 55, 0.0, 0, 0, 0, 1),
    (9, 0.0, 60, 0.0, 64, 0.0, 0, 0, 0, 1),
    (3, 0.0, 41, 0.0, 38, 0.0, 0, 0, 0, 1),
    (2, 0.0, 40, 0.0, 50, 0.0, 0, 0, 0, 1),
    (1, 0.0, 60, 0.0, 30, 0.0, 0, 0, 0, 1),
    (2, 0.0, 24, 0.0, 37, 0.0, 0, 0, 0, 1),
    (14, 0.0, 22, 0.0, 2, 0.0, 0, 0, 0, 1),
    (35, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1),
    (2, 0.0, 1, 1.0, 40, 0.0, 0, 0, 1, 1),
    (1, 0.0, 2, 1.0, 31, 0.0, 0, 0, 1, 1),
    (6, 0.0, 1, 1.0, 70, 0.0, 0, 0, 1, 1),
    (8, 0.0, 3, 0.5, 45, 0.0, 0, 0, 1, 1),
    (5, 0.0, 40, 0.0, 66, 0.0, 0, 0, 1, 1),
    # ... and menus, link lists, single lines at the edge
    (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (1, 1.0, 2, 1.0, 50, 0.0, 0, 0, 0, 0),
    (12, 0.9, 33, 0.0, 14, 0.8, 0, 0, 0, 0),
    (40, 0.8, 14, 0.8, 8, 0.0, 0, 0, 0, 0),
    (30, 0.6, 2, 1.0, 20, 0.7, 0, 0, 0, 0),
    (2, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0),
    (2, 0.0, 35, 0.0, 1, 1.0, 0, 0, 0, 0),
    (7, 0.0, 46, 0.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 29, 0.0, 0, 0.0, 0, 0, 0, 0),
    (6, 0.0, 3, 1.0, 2, 0.0, 0, 0, 0, 0),
    (4, 0.0, 33, 0.0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.2, 4, 0.0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 6, 0.0, 4, 0.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 1, 0),
)
MAX_DEPTH = 6
#: link density from which a block on a page of short ones is no text
LINKS = 0.5


@cache
def grown_tree(rows: tuple = LABELLED, depth: int = MAX_DEPTH):
    """A decision tree: ``(feature, bound, below, above)`` or a label; splits by least Gini impurity."""
    counts = Counter(r[-1] for r in rows)
    if depth == 0 or len(counts) == 1:
        return counts.most_common(1)[0][0]

    def impurity(part) -> float:
        ones = sum(r[-1] for r in part)
        return 2 * ones * (len(part) - ones) / len(part)

    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            bound = (low + high) / 2
            below, above = [r for r in rows if r[f] <= bound], [r for r in rows if r[f] > bound]
            cost = impurity(below) + impurity(above)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, bound, tuple(below), tuple(above)
    if best is None:
        return counts.most_common(1)[0][0]
    _, f, bound, below, above = best
    return f, bound, grown_tree(below, depth - 1), grown_tree(above, depth - 1)


def classified(tree, block: tuple) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if block[tree[0]] <= tree[1] else tree[3]
    return tree


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[\W\d_]+|(?<=[a-z])(?=[A-Z])")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TAGS}


@lru_cache(4096)
def token_kind(token: str) -> str:
    """What one class, id or role says: aside (one word), part (a compound such as post-comments), main, header or nothing.

    Words are told apart by signs, numbers and capitals inside.  What follows a
    modifier (has-sidebar, category-social) says nothing of what the element is.  The
    last word that is not only a box or a place decides: it stands aside if it names a
    part of a page by itself (reader-comments), or if it is one of the other words and
    those before it are known too.  The content of such a part (footer-content) goes with it.
    """
    words = [w.lower() for w in _WORDS.split(token) if w]
    cut = next((k for k, w in enumerate(words) if w in MODIFIERS), len(words))
    words = words[:cut]
    if not words:
        return ""
    if len(words) == 1 or ASIDE_WORDS.fullmatch(token.lower()):
        alone = words[0] if len(words) == 1 else token.lower()
        if ASIDE_WORDS.fullmatch(alone):
            return "header" if alone.startswith("header") else "aside"
        return "main" if MAIN_WORDS.fullmatch(alone) else ""
    main = any(map(MAIN_WORDS.fullmatch, words))
    named = list(words)
    while len(named) > 1 and named[-1] in BOX_WORDS:
        named.pop()
    of_page = all(ASIDE_WORDS.fullmatch(w) or MAIN_WORDS.fullmatch(w) or w in PLACE_WORDS for w in named)
    last = named[-1]
    # content-sidebar-wrap holds both
    if (PART_WORDS.fullmatch(last) or of_page and ASIDE_WORDS.fullmatch(last)) and (len(named) == len(words) or not main):
        return ("main" if main else "header") if last.startswith("header") else "part"
    first = next((w for w in named if w not in PLACE_WORDS), last)
    if PART_WORDS.fullmatch(first) and first is not last and MAIN_WORDS.fullmatch(last) and len(named) == len(words):
        return "header" if first.startswith("header") else "part"
    return "main" if main else ""


@lru_cache(4096)
def said(attributes: str) -> tuple[bool, frozenset[str]]:
    """Whether an element is hidden, and the kinds of its class, id, role and itemprop tokens."""
    hidden, kinds = False, set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop"):
            kinds.update(map(token_kind, value.split()))
        elif name == "hidden" or name == "style" and _UNSEEN.search(value) or name == "aria-hidden" and value.strip().lower() == "true":
            hidden = True
    return hidden, frozenset(kinds)


class Blocks:
    """Collects the blocks of one page: (text, words, link density, aside, article, heading)."""

    def __init__(self):
        self.out: list[tuple] = []
        self.open: list[tuple[str, int, int]] = []  # tag, aside and article as they were before it
        self.names: Counter = Counter()  # of what is open
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.aside = self.article = self.heading = self.in_link = 0

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked.append(raw)

    def end_block(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", entities.unescape("".join(self.parts))).strip()
            if text:
                words = text.count(" ") + 1
                linked = len(entities.unescape(" ".join(self.linked)).split())
                self.out.append((text, words, min(1.0, linked / words), int(self.aside > 0), int(self.article > 0), self.heading))
            self.parts, self.linked = [], []

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text("\n")
            return
        if tag in BLOCK_TAGS:
            self.end_block()
        if tag == "p":
            self.close("p", within=("p",))
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.close(tag, within=(tag,))
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            return
        self.open.append((tag, self.aside, self.article))
        self.names[tag] += 1
        if tag == "a":
            self.in_link += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.heading = 1
        if tag in ("article", "main"):
            self.article += 1
        elif tag in ASIDE_TAGS or tag == "header" and not self.article:
            self.aside += 1
        if attributes and tag not in ("main", "body", "html"):
            hidden, kinds = said(attributes)
            main = "main" in kinds
            own = "header" in kinds and (self.article or main)
            # an article, or what is named as one, stands aside by a whole word only
            part = "part" in kinds and tag != "article" and not main
            if hidden or "aside" in kinds or part or "header" in kinds and not own:
                self.aside += 1
            elif main and tag in ("div", "section", "td"):
                self.article += 1

    def close(self, tag: str, within: tuple = ()) -> None:
        """Closes the innermost open ``tag``; with ``within`` only if no container stands between."""
        if not self.names[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                for closed, _, _ in self.open[k:]:
                    self.in_link -= closed == "a"
                    self.names[closed] -= 1
                _, self.aside, self.article = self.open[k]
                del self.open[k:]
                break
            if within and name in BLOCK_TAGS:
                break

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.heading = 0
        self.close(tag)


def blocks(page: str) -> list[tuple]:
    """The text blocks of a page in its order; markup that is cut off or not closed is tolerated."""
    state, at = Blocks(), 0
    while (m := _TOKEN.search(page, at)) is not None:
        state.text(page[at : m.start()])
        at = m.end()
        if (tag := m[2]) is None:
            continue
        tag = tag.lower()
        if m[1]:
            state.end(tag)
        elif tag in RAW_TAGS:
            if not m[3].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.start() if end else len(page)
        else:
            state.start(tag, m[3])
    state.text(page[at:])
    state.end_block()
    return state.out


def main_text(page: str, tree=None) -> tuple[str, int, int]:
    """(text, number of blocks, number kept) of one page."""
    tree = tree or grown_tree()
    found = blocks(page)
    edge = ("", 0, 0.0)
    kept = [
        b[0]
        for before, b, after in zip([edge, *found], found, [*found[1:], edge], strict=False)
        if classified(tree, (b[1], b[2], before[1], before[2], after[1], after[2], b[3], b[4], b[5]))
    ]
    if not kept and not any(b[4] for b in found):
        # a page of short blocks, none of which is told by itself: all that neither stand aside nor are links
        kept = [b[0] for b in found if not b[3] and b[2] < LINKS]
    return "\n\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every row: ``TEXT_SCHEMA``.

    Null or empty html, and pages without main text, give an empty text.  Rows
    are read each by itself, so repeated rows repeat and an empty table stays
    empty; null ids and urls pass through; other columns are not read.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = grown_tree()
        for batch in batches:
            found = [main_text(h or "", tree) for h in batch["html"].to_pylist()]
            yield pa.record_batch(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([len(f[0]) for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(texts, TEXT_SCHEMA)
