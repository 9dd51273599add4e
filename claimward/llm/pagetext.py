"""Main text of web pages by composite text density.

A page becomes a tree without scripts, controls and hidden parts. Every node gets its composite
text density: characters per tag, weighted by how much of it is link text. The density sum
of a node adds the densities of its children, and the subtree with the largest sum is the
article. The smallest density on its path to the body is the threshold for what else is
content: a branch off that path joins if its density reaches the threshold and its largest
sum a quarter of the article's. Densities are those of the whole tree; no element name,
not ``article`` either, overrides the choice.

Names are evidence, not the method: a part whose element, role, class or id names navigation,
a form, an advert, notice, sidebar or comment list is neither chosen nor printed inside the
chosen part, unless it holds the page's content: all its article and main elements, all
its top headings, or most of its text outside links.

Null or empty html and pages without text give an empty text. Unclosed, stray and cut-off
tags are tolerated; work grows with the length of a page, however deep its tree is. Repeated
rows give repeated results; extra columns are left out.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.llm.common import table
from claimward.llm.texts import chunks

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*))>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p "
    "pre section summary table tbody tfoot thead tr ul".split()
)
#: Tags whose start ends an open element of the named kinds.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
#: Where the search for an element that an end tag or a new item closes stops.
SCOPE = frozenset("article aside body dl footer header html main nav ol section table ul".split())

CUT_TAGS = frozenset(
    "script style noscript template head title button select option textarea input "
    "label iframe object embed svg canvas audio video map noframes noembed xmp".split()
)
#: Elements that are cut unless they hold the content.
DOUBTED_TAGS = frozenset("nav aside footer form dialog menu".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())
#: Last words of a class or id that mark a part as no article text.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "sidebar rail menu nav navbar navigation breadcrumb breadcrumbs masthead topbar toolbar footer cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist disqus reply replies respond discussion widget pagination pager copyright disclaimer search".split()
)
#: Class words that count outside an article only, where they are the site's.
CUT_OUTSIDE = frozenset("header".split())
#: Parts of a name that say nothing of what is inside, and those that turn its meaning.
FILLERS = frozenset(
    "container wrapper wrap inner outer box block area section list items item links link buttons button bar left right "
    "top bottom primary secondary main posts widgets unit slot x".split()
)
MODIFIERS = frozenset("with without no not non has have is hide hides show shows".split())
KEEP_TAGS = frozenset("html body main".split())
CONTENT_TAGS = frozenset(("article", "main"))
_WORDS = re.compile(r"[a-z]+")
#: What articles have outside a part in them, or outside a form, as a share of the part, for the
#: part to be no content; for other parts any text in an article elsewhere is enough.
OUTSIDE_SHARE = 0.25
#: Least part of the largest density sum that a branch off the body path needs to join.
BRANCH_SHARE = 0.25


def _named(value: str, in_article: bool) -> bool:
    """Whether a class or id names a part that is no article text by its last word."""
    for name in value.split():
        words = _WORDS.findall(name)
        if MODIFIERS.intersection(words):
            continue
        while len(words) > 1 and words[-1] in FILLERS:
            words.pop()
        if words and (words[-1] in CUT_WORDS or (not in_article and words[-1] in CUT_OUTSIDE)):
            return True
    return False


def _cut(tag: str, attributes: str, in_article: bool) -> str:
    """"always" if a part is cut with all it holds, "doubted" if only where it holds no content."""
    if tag in CUT_TAGS:
        return "always"
    doubted = tag in DOUBTED_TAGS or (tag == "header" and not in_article)
    if tag in KEEP_TAGS or not attributes or not attributes.strip():
        return "doubted" if doubted else ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "always"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "always"
        if name == "role" and value in CUT_ROLES:
            doubted = True
        if name in ("class", "id") and not doubted:
            doubted = _named(value, in_article)
    return "doubted" if doubted else ""


class OpenElements:
    """The open elements of a page; finding the one that a tag closes takes constant time."""

    def __init__(self):
        self.nodes, self.tags = [0], ["html"]
        self.at: dict[str, list[int]] = {}  # places of the open elements by tag
        self.scopes: list[int] = []  # places of elements that stop a search
        self.blocks: list[int] = []

    def __len__(self) -> int:
        return len(self.nodes)

    def push(self, node: int, tag: str) -> None:
        place = len(self.nodes)
        self.nodes.append(node)
        self.tags.append(tag)
        self.at.setdefault(tag, []).append(place)
        if tag in SCOPE:
            self.scopes.append(place)
        if tag in BLOCK or tag in ("td", "th"):
            self.blocks.append(place)

    def cut_back(self, place: int) -> None:
        """End the element at ``place`` and all in it."""
        while len(self.nodes) > place:
            self.nodes.pop()
            self.at[self.tags.pop()].pop()
        for places in (self.scopes, self.blocks):
            while places and places[-1] >= place:
                places.pop()

    def nearest(self, *tags: str) -> int:
        """Place of the innermost open element of these tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def behind_scope(self, place: int) -> bool:
        return bool(self.scopes) and self.scopes[-1] > place

    def close(self, tag: str) -> None:
        """What an end tag does; one without an open element does nothing."""
        place = self.nearest(tag)
        if place and (tag in SCOPE or not self.behind_scope(place)):
            self.cut_back(place)

    def imply(self, tag: str) -> None:
        """End elements that the start of ``tag`` closes."""
        if tag in BLOCK and self.blocks and self.tags[self.blocks[-1]] == "p":
            self.cut_back(self.blocks[-1])
        place = self.nearest(*ENDS.get(tag, ()))
        if place and not self.behind_scope(place):
            self.cut_back(place)


class Page:
    """The tree of a page; nodes are numbers in page order, children may be texts.

    Without ``names`` no element is doubted because of its name.
    """

    def __init__(self, source: str, names: bool = True):
        self.tag, self.parent, self.children, self.article = ["html"], [-1], [[]], [False]
        self.names = names
        self.doubted: set[int] = set()
        self._parse(source)
        self.rejected = self._rejected() if self.doubted else [False] * len(self.tag)

    def _open(self, tag: str, parent: int) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.children.append([])
        self.article.append(self.article[parent] or tag in ("article", "main"))
        self.children[parent].append(node)
        return node

    def _parse(self, source: str) -> None:
        stack, at, size = OpenElements(), 0, len(source)
        cut: OpenElements | None = None  # open elements inside a part that is cut
        while at < size:
            found = _TAG.search(source, at)
            text = source[at : found.start()] if found else source[at:]
            if text and not cut:
                self.children[stack.nodes[-1]].append(text)
            if not found:
                break
            at = found.end()
            closing, tag, attributes = (
                found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            )
            if not tag:
                continue
            tag = tag.lower()
            if not closing and tag in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if cut:
                first = cut.tags[1]
                if self._ends_cut(cut, closing, tag, attributes):
                    cut = None
                    if closing and tag in SCOPE and tag != first:
                        stack.close(tag)
                continue
            if closing:
                stack.close(tag)
            elif tag in VOID:
                if tag in ("br", "wbr", "hr"):
                    self._open(tag, stack.nodes[-1])
            else:
                stack.imply(tag)
                verdict = _cut(tag, attributes, self.article[stack.nodes[-1]])
                if verdict == "always":
                    self._open("cut", stack.nodes[-1])
                    if not attributes.endswith("/"):
                        cut = OpenElements()
                        cut.push(0, tag)
                elif tag not in ("html", "body") or len(stack) == 1:
                    if tag != "html":
                        stack.push(self._open(tag, stack.nodes[-1]), tag)
                        if verdict and self.names:
                            self.doubted.add(stack.nodes[-1])

    def _ends_cut(self, cut: OpenElements, closing: str, tag: str, attributes: str) -> bool:
        """Follow the elements inside a part that is cut; whether it ends here."""
        if closing:
            if cut.nearest(tag):
                cut.cut_back(cut.nearest(tag))
            elif tag in ("body", "html", "article", "main"):
                return True  # the part was never closed
        elif tag not in VOID and not attributes.endswith("/"):
            if tag == cut.tags[-1] and tag in ("p", "li", "option", "dt", "dd", "tr", "td", "th"):
                cut.cut_back(len(cut) - 1)
                if len(cut) == 1:
                    return True
            cut.push(0, tag)
        return len(cut) == 1

    def _rejected(self) -> list[bool]:
        """Nodes in doubted parts that do not hold the content, judged from the outermost in."""
        count = len(self.tag)
        plain, in_content, contents, heads = ([0] * count for _ in range(4))
        linked = [False] * count
        for node in range(1, count):
            linked[node] = linked[self.parent[node]] or self.tag[node] == "a"
        for node in range(count - 1, -1, -1):
            if not linked[node]:
                own = sum(len("".join(c.split())) for c in self.children[node] if isinstance(c, str))
                plain[node] += own
                in_content[node] += own * self.article[node]
            contents[node] += self.tag[node] in CONTENT_TAGS
            heads[node] += self.tag[node] == "h1"
            if node:
                for of in (plain, in_content, contents, heads):
                    of[self.parent[node]] += of[node]
        gone = [False] * count
        for node in range(1, count):
            gone[node] = gone[self.parent[node]]
            if node in self.doubted and not gone[node]:
                outside = in_content[0] - in_content[node]
                within = self.article[self.parent[node]] or self.tag[node] == "form"
                little = OUTSIDE_SHARE * plain[node] if within else 1
                gone[node] = not (
                    contents[node] == contents[0] > 0
                    or heads[node] == heads[0] > 0
                    or (2 * plain[node] > plain[0] and outside < little)
                )
        return gone

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite text density of every node, and the sum over its children.

        Densities are those of the whole tree; rejected children add nothing to a sum.
        """
        count = len(self.tag)
        chars, tags, link_chars, link_tags = ([0] * count for _ in range(4))
        for node in range(count - 1, -1, -1):
            own = sum(len("".join(c.split())) for c in self.children[node] if isinstance(c, str))
            chars[node] += own
            if self.tag[node] == "a":
                link_chars[node], link_tags[node] = chars[node], max(link_tags[node], 0) + 1
            if node:
                up = self.parent[node]
                chars[up] += chars[node]
                link_chars[up] += link_chars[node]
                tags[up] += tags[node] + (self.tag[node] not in ("cut", "br", "wbr"))
                link_tags[up] += link_tags[node]
        ratio = link_chars[0] / max(chars[0], 1)
        self.linked = [2 * lc > c for lc, c in zip(link_chars, chars)]
        density, sums = [0.0] * count, [0.0] * count
        for node in range(count - 1, -1, -1):
            c, t, lc, lt = chars[node], max(tags[node], 1), link_chars[node], max(link_tags[node], 1)
            if c:
                base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
                density[node] = c / t * max(math.log(max(c / max(lc, 1) * t / lt, 1.0)), 0.0) / base
            if node and not self.rejected[node]:
                sums[self.parent[node]] += density[node]
        return density, sums

    def content(self) -> list[int]:
        """Roots of the content, in page order."""
        density, sums = self.densities()
        self.density = density
        open_ = [n for n in range(len(sums)) if not self.rejected[n]]
        best = max(open_, key=lambda n: (sums[n], density[n], -n))
        self.threshold = 0.0
        if sums[best] <= 0:  # a few characters at most
            return [0]
        path = [best]
        while path[-1]:
            path.append(self.parent[path[-1]])
        self.threshold = threshold = min(density[n] for n in path)
        on_path = set(path)
        # largest sum at or below each node, found bottom-up
        top = list(range(len(sums)))
        for node in reversed(open_[1:]):
            up = self.parent[node]
            if (sums[top[node]], -top[node]) > (sums[top[up]], -top[up]):
                top[up] = top[node]
        roots = {best}
        for node in path[1:]:
            for child in self.children[node]:
                if isinstance(child, str) or self.rejected[child] or child in on_path:
                    continue
                dense = density[child] >= threshold and density[child] > 0
                if dense and sums[top[child]] >= BRANCH_SHARE * sums[best]:
                    roots.add(top[child])
        return sorted(roots | self._heading(roots))

    def _heading(self, roots: set[int]) -> set[int]:
        """The page's only top heading, if it stands outside the content."""
        heads = [n for n in range(len(self.tag)) if self.tag[n] == "h1" and not self.rejected[n]]
        if len(heads) != 1:
            return set()
        node = heads[0]
        while node and node not in roots:
            node = self.parent[node]
        return set() if node in roots else {heads[0]}

    def blocks(self, root: int) -> list[str]:
        """Texts of the blocks below ``root``, white space made single spaces.

        Rejected parts are left out. Where no narrower part than the body was chosen, so are
        menus: blocks directly in it of mostly link text below the threshold.
        """
        done, parts = [], []
        wide = self.tag[root] in ("html", "body")

        def flush():
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                done.append(text)
            parts.clear()

        todo: list = [root]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item is None:
                flush()
            elif self.rejected[item]:
                flush()
            else:
                tag = self.tag[item]
                menu = tag in BLOCK and self.linked[item] and self.density[item] < self.threshold
                if wide and menu and self.tag[self.parent[item]] in ("html", "body"):
                    continue
                if tag in ("br", "td", "th", "cut"):
                    parts.append(" ")
                if tag in BLOCK:
                    flush()
                    todo.append(None)
                todo.extend(reversed(self.children[item]))
        flush()
        return done


def main_text(source: str, names: bool = True) -> str:
    """The article of a page, blocks joined by an empty line."""
    if not source:
        return ""
    page = Page(source, names)
    return "\n\n".join(b for root in page.content() for b in page.blocks(root))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for batch in batches:
            urls, low = batch.column("url").to_pylist(), 0
            for keys, sources in chunks(batch.column("page_id"), batch.column("html")):
                texts = [main_text(s.decode("utf-8")) for s in sources]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(urls[low : low + len(keys)], pa.string()),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )
                low += len(keys)

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
