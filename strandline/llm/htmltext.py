"""Main text of web pages by composite text density.

A page is parsed into a tree. Elements that are never main text by their tag, role or a
whole word of their class or id (menus, footers, adverts, comments ...) are left out. Weaker
evidence only raises a doubt, which the text decides: an element with a boilerplate word
as a part of a name, and a form, are left out unless they hold most of the page's plain text (the
characters outside of links); within an article or main element, and for ids of sections, they are left
out if half of their characters are links. Words after "no", "has", "with" and the like, and ids of
headings, which are slugs, tell nothing. The fields of a form go in any case.

Every remaining node gets its composite text density, a link-adjusted number of characters
per tag; a node's density sum is the sum of its children's densities. The node of the
largest sum gives the threshold: the least density on its path to the body. Walking down
from the body through nodes that reach the threshold, the largest-sum subtree of each is main
text. A subtree that lies in an article or main element is widened to the outermost such element.

Cases: null or empty html gives an empty text; broken and cut markup is read as far as
it goes; very long pages are read whole; repeated rows are kept, each by itself; character
references are decoded in each run of text by itself, so none arises across tags.
"""

from __future__ import annotations

import html as html_module
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import blocks, strings, texts

# Element names of HTML, and names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li tbody td tfoot th thead tr".split())
DROPPED = frozenset(
    "head script style noscript template title nav footer header aside button select option textarea input label legend iframe object "
    "embed svg canvas audio video dialog menu map noembed noframes".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments reply replies disqus discussion respond share sharing social related "
    "recommended recommendations pagination pager toolbar widget".split()
)
#: Boilerplate that may well be longer than the article.
COMMENTS = frozenset("comment comments reply replies disqus discussion respond".split())
NEGATIONS = frozenset("no not non has have with without hide hidden show is".split())
KEPT = frozenset("html body article main".split())
LANDMARKS = frozenset(["article", "main"])
SAME_CLOSES = {  # a start tag of the key closes an open element of the value, not beyond the containers that follow
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
# End of fixed values.

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^'\">])*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in RAW}


KEEP, DROP, BY_LINKS, BY_SHARE = range(4)


def _named(value: str) -> tuple[bool, bool, bool]:
    """Whether a class or id has a boilerplate word, one that is a whole name, and one for comments."""
    found = whole = comments = False
    for name in value.split():
        parts = [x.lower() for x in NAME_PARTS.findall(name)]
        for k, part in enumerate(parts):
            if part in BOILERPLATE and not (k and parts[k - 1] in NEGATIONS):
                found = True
                whole |= len(parts) == 1 and len(name) == len(part)
                comments |= part in COMMENTS
    return found, whole, comments


def _verdict(tag: str, attributes: str, names: list[str]) -> int:
    """Whether an element below the open ones of ``names`` is kept or dropped, or which share decides."""
    if tag in DROPPED:
        return DROP
    landmark = not LANDMARKS.isdisjoint(names)
    verdict, seen = KEEP, set()
    if tag == "form":
        verdict = BY_SHARE
    if not attributes:
        return verdict
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in seen:
            continue  # the first of a name counts
        seen.add(name)
        if name in ("class", "id"):
            if tag in KEPT:
                continue
            found, whole, comments = _named(value)
            if not found or name == "id" and tag in HEADINGS:
                continue
            if name == "id" and tag == "section":
                verdict = max(verdict, BY_LINKS)
            elif whole or comments:
                return DROP
            else:
                verdict = max(verdict, BY_LINKS if landmark else BY_SHARE)
            continue
        value = value.lower()
        if name == "role":
            if tag not in KEPT and value in DROPPED_ROLES:
                return DROP
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return DROP
    return verdict


class Tree:
    """Nodes in page order; parents stand before their children. Dropped subtrees are not in it."""

    def __init__(self, page: str):
        self.tags, self.parents, self.content = ["#root"], [-1], [[]]
        self.doubted: list[tuple[int, int]] = []
        self.gone: set[int] = set()
        self._read(page)
        if self.doubted:
            self._settle()

    def _read(self, page: str) -> None:
        stack = [0]  # open nodes; -1 - depth marks those inside a dropped subtree
        names = ["#root"]
        dropped = 0  # how many open elements belong to a dropped subtree
        at, find = 0, TOKEN.search
        while True:
            m = find(page, at)
            stop = m.start() if m else len(page)
            if stop > at and not dropped:
                self.content[stack[-1]].append(html_module.unescape(page[at:stop]))
            if not m:
                return
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                dropped = self._close(tag, stack, names, dropped)
                continue
            if tag in CLOSES_P and "p" in names:
                dropped = self._close("p", stack, names, dropped, BUTTON_SCOPE)
            if tag in SAME_CLOSES:
                own, limits = SAME_CLOSES[tag]
                for k in range(len(names) - 1, 0, -1):
                    if names[k] in limits:
                        break
                    if names[k] in own:
                        dropped = self._cut(k, stack, names, dropped)
                        if tag != "tr":
                            break
            attributes = m[3] or ""
            verdict = DROP if dropped else _verdict(tag, attributes, names)
            drop = verdict == DROP
            if tag in VOID:
                if not drop and tag in ("br", "hr", "wbr", "img"):
                    self.content[stack[-1]].append(tag)
                    self.content[stack[-1]][-1] = VOID_MARK[tag]
                continue
            if tag in RAW:
                end = RAW_END[tag].search(page, at)
                body_end = end.start() if end else len(page)
                if not drop:
                    node = self._add(tag, stack[-1])
                    self.content[node].append(page[at:body_end])
                close = page.find(">", body_end)
                at = len(page) if close < 0 else close + 1
                continue
            if attributes.endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "span", "em", "strong"):
                continue
            names.append(tag)
            if drop:
                dropped += 1
                stack.append(stack[-1])
            else:
                stack.append(self._add(tag, stack[-1]))
                if verdict != KEEP:
                    self.doubted.append((stack[-1], verdict))

    def _settle(self) -> None:
        """Takes out the doubted subtrees that their share of links, or of the page's plain text, speaks against."""
        n = len(self.tags)
        chars, links = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            chars[i] += sum(len("".join(x.split())) for x in self.content[i] if isinstance(x, str))
            if self.tags[i] == "a":
                links[i] = chars[i]
            chars[self.parents[i]] += chars[i]
            links[self.parents[i]] += links[i]
        chars[0] += sum(len("".join(x.split())) for x in self.content[0] if isinstance(x, str))
        most = (chars[0] - links[0]) / 2
        out = {i for i, why in self.doubted if (2 * links[i] >= chars[i] if why == BY_LINKS else chars[i] - links[i] <= most)}
        for i in range(1, n):
            if i in out or self.parents[i] in self.gone:
                self.gone.add(i)
        for i in self.gone:
            self.content[i] = []
        for i in out:
            self.content[self.parents[i]] = [x for x in self.content[self.parents[i]] if isinstance(x, str) or x != i]

    def _add(self, tag: str, parent: int) -> int:
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.content.append([])
        self.content[parent].append(node)
        return node

    @staticmethod
    def _cut(k: int, stack: list, names: list, dropped: int) -> int:
        gone = len(names) - k
        del stack[k:], names[k:]
        return max(0, dropped - gone)

    def _close(self, tag: str, stack: list, names: list, dropped: int, limits: frozenset = frozenset()) -> int:
        for k in range(len(names) - 1, 0, -1):
            if names[k] == tag:
                return self._cut(k, stack, names, dropped)
            if names[k] in limits:
                break
        return dropped


class _Mark(str):
    """Stands for a void element among the texts of a node."""


RULE = _Mark("")
VOID_MARK = {"br": _Mark(" "), "hr": RULE, "wbr": _Mark(""), "img": _Mark("")}
BUTTON_SCOPE = frozenset("button table td th caption html body article".split())


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite density and density sum of each node. On a page without links it is the number of characters per tag."""
    n = len(tree.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        own = sum(len("".join(x.split())) for x in tree.content[i] if isinstance(x, str))
        chars[i] += own
        if tree.tags[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        p = tree.parents[i]
        if p >= 0 and i not in tree.gone:
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
    all_chars, all_links = max(1, chars[0]), link_chars[0]
    density = [0.0] * n
    for i in range(n):
        c, t = chars[i], tags[i] or 1
        if not c:
            continue
        if not all_links:
            density[i] = c / t
            continue
        lc, lt = link_chars[i] or 1, link_tags[i] or 1
        base = math.log(c / max(1, c - link_chars[i]) * lc + all_links / all_chars * c + math.e)  # more than ln(1 + e)
        density[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base)
    total = [0.0] * n
    for i in range(1, n):
        total[tree.parents[i]] += density[i]
    for i in range(n):
        if not any(not isinstance(x, str) for x in tree.content[i]):
            total[i] = density[i]  # a leaf stands for itself
    return density, total


def chosen(tree: Tree) -> list[int]:
    """Roots of the subtrees that hold the main text."""
    density, total = densities(tree)
    n = len(tree.tags)
    body = next((i for i in range(n) if tree.tags[i] == "body"), 0)
    inside = [False] * n
    best_below = list(range(n))
    for i in range(body, n):
        inside[i] = i == body or inside[tree.parents[i]]
    nodes = [i for i in range(n) if inside[i]]
    if not nodes or not any(density[i] for i in nodes):
        return []
    for i in reversed(nodes):
        p = tree.parents[i]
        if i != body and total[best_below[i]] >= total[best_below[p]]:
            best_below[p] = best_below[i]
    best = best_below[body]
    threshold, i = density[best], best
    while True:
        threshold = min(threshold, density[i])
        if i == body:
            break
        i = tree.parents[i]
    landmark = [-1] * n  # the outermost article or main element that a node is or lies in
    for i in nodes:
        above = landmark[tree.parents[i]] if i != body else -1
        landmark[i] = above if above >= 0 else i if tree.tags[i] in LANDMARKS else -1
    marked, todo = set(), [body]
    while todo:
        i = todo.pop()
        if density[i] < threshold or not density[i]:
            continue
        marked.add(landmark[best_below[i]] if landmark[best_below[i]] >= 0 else best_below[i])
        todo += [x for x in tree.content[i] if not isinstance(x, str)]
    return sorted(marked)


def render(tree: Tree, roots: list[int]) -> str:
    """The texts of the blocks below the roots, in page order, joined by an empty line."""
    out: list[str] = []
    parts: list[str] = []

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    end = -1
    for root in roots:
        if root <= end:
            continue  # inside the subtree before
        todo: list = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                if x is RULE:
                    flush()
                else:
                    parts.append(x)
                continue
            if x == FLUSH:
                flush()
                continue
            end = max(end, x)
            block = tree.tags[x] in BLOCK
            if block:
                flush()
                todo.append(FLUSH)
            todo += reversed(tree.content[x])
        flush()
    return "\n\n".join(out)


FLUSH = -1


def main_text(page: str) -> str:
    tree = Tree(page)
    return render(tree, chosen(tree))


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page."""

    def run(batches):
        for block in blocks(batches):
            out = [main_text(page) for page in strings(block)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), block.column("url").cast(pa.string()), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return texts(df, id_col, html_col, url=url_col).mapInArrow(run, "page_id long, url string, text string, n_chars long")
