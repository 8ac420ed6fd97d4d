"""Main text of web pages by composite text density.

A page becomes a light tree of its elements.  Elements that are never article
text (menus, forms, scripts, adverts, notices, reader comments) are left out by
their tag, role or class.  For every other element the density is its number of
characters per tag, adjusted for characters and tags of links; the sum of its
children's densities tells how much content it holds.  The element with the
highest density gives the threshold: the least density on its path to the body.
Among the elements that reach it, the one with the greatest sum is the content,
widened to the article around it.
"""

from __future__ import annotations

import html as html_entities
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, per_text
from cartwheel.session import ship_package

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
# Elements whose content is raw text, and elements that hold no article text.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp")
SKIP = frozenset(
    "head script style noscript template title nav footer aside form button select option input textarea label "
    "fieldset iframe object embed svg canvas audio video dialog menu menuitem map noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words in classes and ids that mark what is not part of the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social sidebar sidebars rail widget widgets related recommended recommendations teaser "
    "breadcrumb breadcrumbs menu menus nav navbar navigation pagination pager footer masthead topbar toolbar skip "
    "comment comments commentlist respond reply replies disqus discussion feedback copyright disclaimer hidden".split())
# Of these, words for adverts and page furniture, and for reader comments.
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo cookie cookies consent gdpr popup "
    "modal newsletter subscribe signup share sharing social sidebar sidebars breadcrumb breadcrumbs nav navbar "
    "pagination pager masthead topbar".split())
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
PARTS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("form input select textarea button".split())
# Elements that group others, and whose class may therefore speak for their content.
GROUPS = frozenset("div section ul ol span a center font".split())
# Skipped elements that can hold a whole page, and those that can hold its article.
WRAPS = frozenset("form fieldset label".split())
SIDES = frozenset("aside nav footer dialog menu".split())
# A start tag that ends an open element of the same row.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
# Where the search for an element to end stops.
SCOPE = frozenset("table ul ol dl article main section div body html".split())

_START = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)|[!?/])")
_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.S)
# Up to a tag's end, quoted values whole; possessive, so one scan decides.
_TAG_END = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_RAW_END = {tag: re.compile(f"</{tag}[^>]*>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# What an element's attributes say.
SURE, BY_CLASS, BY_ID, STRONG_WORD, COMMENT_WORD, SECTION = 1, 2, 4, 8, 16, 32


class _Tree:
    """Elements in page order (a parent comes before its children)."""

    def __init__(self) -> None:
        self.tag, self.parent, self.hint = ["html"], [-1], [0]
        # Page order of texts (element, text) and block borders (None).
        self.items: list = []
        # Elements with an input control right inside.
        self.inputs: list[int] = []

    def open(self, tag: str, parent: int, hint: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.hint.append(hint)
        return len(self.tag) - 1


def _hints(tag: str, attributes: str) -> int:
    """What an element's attributes say about its content (0: nothing)."""
    if tag in ("body", "html", *PARTS) or not attributes:
        return 0
    said = SECTION if tag == "section" else 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            said |= SURE
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            said |= SURE
        elif name == "role" and value.lower() in ROLES:
            said |= SURE
        elif name in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in _PART.findall(word)]
                if not parts:
                    continue
                if name == "class" and parts == ["section"]:
                    said |= SECTION
                meant = [p for p in {parts[0], parts[-1]} if p in HINTS]
                if parts[0] in HINTS or (meant and parts[0] not in ("has", "no", "with", "is")):
                    said |= BY_CLASS if name == "class" else BY_ID
                    said |= STRONG_WORD if any(p in STRONG for p in meant) else 0
                    said |= COMMENT_WORD if any(p in COMMENTS for p in meant) else 0
    return said


def _parse(page: str) -> _Tree:
    """One pass over the page; every step back over open elements closes them.

    ``lines`` counts the open inline elements above each open block, ``scopes`` the
    open blocks above each open scope, so a search that would find nothing is not
    made.  A tag whose quotes never close ends at its first ``>``, and from there on
    quotes do not count.
    """
    tree = _Tree()
    stack, at, items = [0], 0, tree.items
    lines: list[dict] = [{}]
    scopes: list[dict] = [{}]
    everywhere: dict = {}
    last, quotes = page.rfind(">"), True

    def text(upto: int) -> None:
        if upto > at:
            items.append((stack[-1], html_entities.unescape(page[at:upto])))

    def push(tag: str, hint: int) -> None:
        stack.append(tree.open(tag, stack[-1], hint))
        everywhere[tag] = everywhere.get(tag, 0) + 1
        if tag in INLINE:
            lines[-1][tag] = lines[-1].get(tag, 0) + 1
        else:
            scopes[-1][tag] = scopes[-1].get(tag, 0) + 1
            lines.append({})
            if tag in SCOPE:
                scopes.append({})

    def shut(depth: int) -> None:
        """End the open elements from ``depth`` on."""
        while len(stack) > depth:
            tag = tree.tag[stack.pop()]
            everywhere[tag] -= 1
            if tag in INLINE:
                lines[-1][tag] -= 1
            else:
                items.append(None)
                lines.pop()
                if tag in SCOPE:
                    scopes.pop()
                scopes[-1][tag] -= 1

    def close(names) -> None:
        """End the last open element of these names."""
        depth = len(stack) - 1
        while depth > 0 and tree.tag[stack[depth]] not in names:
            depth -= 1
        if depth:
            shut(depth)

    match = _START.search(page)
    while match:
        start, after = match.start(), match.end()
        name = match["tag"]
        if name and after > last:
            match = _START.search(page, after)  # no tag ends behind this place: it is text
            continue
        text(start)
        if match["comment"]:
            at = _COMMENT.match(page, start).end()
        elif not name:
            at = page.find(">", after) + 1 or len(page)
        else:
            end = _TAG_END.match(page, after) if quotes else None
            quotes = end is not None
            at = end.end() if end else page.find(">", after) + 1
            tag, attributes = name.lower(), page[after:at - 1]
            if match["end"]:
                # An inline end tag does not reach out of its block.
                if (lines[-1] if tag in INLINE else everywhere).get(tag):
                    close({tag})
            elif tag in RAW:
                # Raw text runs to its own end tag; none of it is article text.
                over = _RAW_END[tag].search(page, at)
                at = over.end() if over else len(page)
                if tag != "title":
                    items.append((stack[-1], " "))
            elif tag == "br":
                items.append((stack[-1], " "))
            else:
                if tag not in INLINE:
                    if scopes[-1].get("p"):
                        close({"p"})
                    for _ in range(3):
                        if any(scopes[-1].get(x) for x in CLOSES.get(tag, ())):
                            close(CLOSES[tag])
                    items.append(None)
                if tag == "input":
                    tree.inputs.append(stack[-1])
                if tag not in VOID and tag != "html" and (not attributes.endswith("/") or tag in ("div", "p")):
                    push(tag, _hints(tag, attributes))
        match = _START.search(page, at)
    text(len(page))
    return tree


def _sizes(tree: _Tree) -> tuple[list[int], list[int]]:
    """Characters and link characters of each element, white space aside."""
    n = len(tree.tag)
    chars, links, linked = [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parent[i]] or tree.tag[i] == "a"
    for item in tree.items:
        if item:
            size = len("".join(item[1].split()))
            chars[item[0]] += size
            links[item[0]] += size if linked[item[0]] else 0
    for i in range(n - 1, 0, -1):
        chars[tree.parent[i]] += chars[i]
        links[tree.parent[i]] += links[i]
    return chars, links


def _kept(tree: _Tree) -> list[bool]:
    """Elements outside everything marked.

    What an attribute says about an element counts where its content agrees: it
    consists mostly of links, holds form controls, or holds or stands among further
    elements marked as comments.  Without that, classes and ids (which are often made
    from headings) count for nothing on headings, on paragraphs of an article and, as
    far as ids go, on sections; inside an article only words for adverts, page
    furniture and comments count, on elements that group others.

    A mark around an article does not count, nor does a form (fieldset, label)
    that holds most of the page's text; a label without form or control is text.
    A side element (aside, nav, footer, dialog, menu) around an article keeps its
    mark where the page has another article outside and the side holds less than
    the rest.  Input controls are always left out.
    """
    n = len(tree.tag)
    chars, links = _sizes(tree)
    holds, inside, controls, remarks, in_form = [False] * n, [False] * n, [0] * n, [0] * n, [False] * n
    near = [0] * n  # children marked as comments
    for i in tree.inputs:
        controls[i] += 1
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        if tree.tag[i] in PARTS or holds[i]:
            holds[up] = True
        controls[up] += controls[i] + (tree.tag[i] in CONTROLS)
        own = tree.hint[i] & COMMENT_WORD > 0 and tree.tag[i] not in HEADINGS and tree.tag[i] != "p"
        remarks[up] += remarks[i] + own
        near[up] += own
    marked, unsure = [False] * n, []
    for i in range(1, n):
        up, tag, hint = tree.parent[i], tree.tag[i], tree.hint[i]
        inside[i] = inside[up] or tag in PARTS
        in_form[i] = in_form[up] or tag == "form"
        if tag == "label" and not in_form[i] and not controls[i] and not hint & SURE:
            continue
        if tag in WRAPS:
            marked[i] = not holds[i]
            if marked[i] and not hint & ~SECTION:
                unsure.append(i)
        elif tag in SKIP:
            marked[i] = True
            if tag in SIDES and holds[i]:
                unsure.append(i)
        elif holds[i]:
            continue
        elif hint & SURE or (tag == "header" and not inside[up]):
            marked[i] = True
        elif hint & (BY_CLASS | BY_ID) and tag not in HEADINGS:
            agrees = links[i] * 2 > chars[i] or controls[i] > 0 or (
                hint & COMMENT_WORD > 0 and (remarks[i] > 0 or near[up] > 1))
            plain = hint & BY_ID and not hint & BY_CLASS and (hint & SECTION or tag == "p")
            if inside[i]:
                plain = plain or tag not in GROUPS or not hint & (STRONG_WORD | COMMENT_WORD) or (
                    hint & SECTION and not hint & BY_CLASS)
            marked[i] = bool(agrees or not plain)
    if unsure:
        _unmark(tree, marked, unsure, inside)
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[tree.parent[i]] and not marked[i]
    return kept


def _unmark(tree: _Tree, marked: list[bool], unsure: list[int], inside: list[bool]) -> None:
    """Clear the marks of the ``unsure`` elements that hold the page's text."""
    n = len(tree.tag)
    sure, seen, outside, size = list(marked), [True] * n, [True] * n, [0] * n
    for i in unsure:
        sure[i] = False
    for i in range(1, n):
        seen[i] = seen[tree.parent[i]] and not sure[i]
        outside[i] = outside[tree.parent[i]] and not marked[i]
    for item in tree.items:
        if item and seen[item[0]]:
            size[item[0]] += len("".join(item[1].split()))
    for i in range(n - 1, 0, -1):
        size[tree.parent[i]] += size[i]
    article = any(outside[i] and size[i] and tree.tag[i] in PARTS for i in range(n))
    for i in unsure:
        most = size[i] * 2 > size[0]
        if tree.tag[i] in SIDES:
            marked[i] = article and not most
        else:
            marked[i] = not (most and (inside[i] or not article))


def _content(tree: _Tree, kept: list[bool]) -> int:
    """The element that holds the article."""
    body, best, chars = _densest(tree, kept)
    return _widened(tree, kept, chars, body, best)


def _densities(tree: _Tree, kept: list[bool]) -> tuple[list[float], list[float], list[int], int]:
    """Density, sum of the children's densities and characters of each element, and
    the body."""
    n, tag, parent = len(tree.tag), tree.tag, tree.parent
    chars, links, tags, link_tags, linked = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = linked[parent[i]] or tag[i] == "a"
    for item in tree.items:
        if item and kept[item[0]]:
            size = len("".join(item[1].split()))
            chars[item[0]] += size
            links[item[0]] += size if linked[item[0]] else 0
    for i in range(n - 1, 0, -1):
        if kept[i]:
            up = parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (tag[i] == "a")
    body = next((i for i in range(n) if tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    share = links[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        if kept[i] and chars[i]:
            plain = max(chars[i] - links[i], 1)
            base = math.log(chars[i] / plain * links[i] + share * chars[i] + math.e)
            ratio = chars[i] / max(links[i], 1) * max(tags[i], 1) / max(link_tags[i], 1)
            density[i] = chars[i] / max(tags[i], 1) * max(math.log(ratio) / base, 0.0)
    for i in range(1, n):
        total[parent[i]] += density[i]
    for i in range(n):
        if not total[i] and tag[i] not in INLINE:
            total[i] = density[i]  # text without elements of its own
    return density, total, chars, body


def _densest(tree: _Tree, kept: list[bool]) -> tuple[int, int, list[int]]:
    """The body, the element with the greatest density sum among those that reach the
    threshold, and each element's characters."""
    n, parent = len(tree.tag), tree.parent
    density, total, chars, body = _densities(tree, kept)
    peak = max(range(n), key=density.__getitem__)
    threshold, i = density[peak], peak
    while i >= 0:
        if density[i]:
            threshold = min(threshold, density[i])
        i = parent[i] if i != body else -1
    best = max((i for i in range(n) if kept[i] and density[i] >= threshold), key=total.__getitem__, default=body)
    return body, best, chars


def _widened(tree: _Tree, kept: list[bool], chars: list[int], body: int, best: int) -> int:
    tag, parent = tree.tag, tree.parent
    i = best
    while i > 0 and i != body:
        if tag[i] in PARTS:
            return i
        i = parent[i]
    # No article around it: an article within it that holds most of its text.
    under = [False] * len(tag)
    under[best] = True
    for i in range(best + 1, len(tag)):
        under[i] = under[parent[i]]
        if under[i] and kept[i] and tag[i] in PARTS and chars[i] * 2 >= chars[best]:
            return i
    # Else the widest element below the body to which it adds much of its text.
    # (a form around the page counts as the body).
    while best != body and parent[best] not in (body, 0) and parent[best] > 0 and tag[parent[best]] not in WRAPS:
        up = parent[best]
        if chars[up] - chars[best] < chars[best] // 5 and tag[best] not in INLINE and tag[best] != "p":
            break
        best = up
    return body if tag[best] in INLINE or tag[best] == "p" or re.fullmatch("h[1-6]", tag[best]) else best


def main_text(page: str) -> str:
    """Blocks of a page's article in page order, joined by an empty line.

    Character references are decoded and white space within a block becomes one
    space.  A page without text gives the empty string.
    """
    tree = _parse(page)
    kept = _kept(tree)
    root = _content(tree, kept)
    inside = [False] * len(tree.tag)
    inside[root] = True
    for i in range(root + 1, len(tree.tag)):
        inside[i] = inside[tree.parent[i]] and kept[i]
    blocks, parts = [], []
    for item in [*tree.items, None]:
        if item is None:
            words = "".join(parts).split()
            if words:
                blocks.append(" ".join(words))
            parts = []
        elif inside[item[0]]:
            parts.append(item[1])
    return "\n\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """Rows ``(page_id, url, text)``, one for each row of ``pages``.

    A null html counts as empty and gives the empty text; null ids and urls and
    repeated rows pass through; other columns are ignored; an empty table gives no
    rows.  Pages of any length are read whole, in time linear in their length.  Work
    is per row, so there is no shuffle.
    """
    ship_package(pages.sparkSession)
    return per_text(pages, [F.col("page_id"), F.col("url"), null_to_empty(F.col("html")).alias("html")],
                    lambda page_id, url, page: (page_id, url, main_text(page)),
                    "page_id bigint, url string, text string")
