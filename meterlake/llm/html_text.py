"""Main text of HTML pages by tree scoring.

A small parser builds the element tree (comments, declarations and the content
of scripts and the like left out; ``p``, ``li``, cells and options closed where
HTML closes them). Each run of text between block borders is a paragraph. Its
points, for length and commas, go in full to the element that holds it and by
half as much to each further ancestor; an element's score is its points times
its share of text outside links. The element with the best score is the
container, or the nearest article (else main) element around it, or, without
one, the outermost parent with no junk beside; all of it but its junk is kept.
Text right beside it and siblings with enough points of their own, or with plain text under
few links, are kept with it, and so are a heading right before it, a header that
is named as the article's, and the h1 outside of articles that says what the
page's title (or its first part) says; of a page header only that h1 stays.
Menus, page headers and footers, sidebars,
notices, adverts, forms and reader comments — told by element, role, class or
id, or as lists made of links (in an article: before its first paragraph; later
ones are references) — count nowhere and are left out. A class or id
alone leaves nothing out that holds most of the article or, on pages without
an article or main element, most of the text.

Kept blocks: character references decoded, white space inside as one space,
trimmed, joined by an empty line in page order.

Defined results: null or empty html, or a page without text, gives ''. Broken
markup never fails: unclosed elements end with the page, stray end tags are
ignored, an unclosed comment or tag hides the rest, as in browsers. Repeated
rows and null ids each give a row; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template iframe object svg math canvas audio video map datalist".split())
JUNK = set("head nav footer aside button select textarea input menu dialog label fieldset title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var".split()
)
LIST_LIKE = set("ul ol dl div section p table tbody tr".split())
JUNK_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# parts of class and id names
JUNK_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar"
    " sidenav menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar"
    " comment comments disqus reply replies respond social share sharing related recommended recommendations widget"
    " skip".split()
)
CONTROLS = set("select textarea input button".split())
# class parts that, with header, name the article's own header
ARTICLE_PARTS = set("post entry article story content".split())
COMMENTS = set("comment comments disqus reply replies respond".split())
# class parts after these name what the element has or lacks, not what it is
NOT_ITSELF = set("no has have with without hide show not non".split())
# an end is implied for the first where one of the second starts
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
}
SCOPES = set("ul ol dl table select html body article section div td th".split())
LONG = 80  # characters that make a paragraph count fully
SIBLING_SHARE = 0.2
MENU_LINKS = 3
TEASER_LINKS = 0.2  # share of linked text from which a further article is a teaser
HEADER, OWN_HEADER = 3, 4
MOST = 0.5  # share of a page's text that no class name alone takes away

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_TITLE_PARTS = re.compile(r"\s+[-–—:·•|»]\s+|\s*[|»]\s*")
_NAME = re.compile(r"[^a-z0-9]+")
_END_OF = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in HIDDEN | {"title", "textarea"}}


class Node:
    __slots__ = ("tag", "parent", "kids", "junk", "named", "points", "chars", "linked", "links")

    def __init__(self, tag: str, parent: Node | None, junk: bool = False):
        self.tag, self.parent, self.junk = tag, parent, junk
        self.named = 0
        self.kids: list = []
        self.points = 0.0
        self.chars = self.linked = self.links = 0


def _junk_kind(tag: str, attributes: str, inside_article: bool) -> tuple[bool, int]:
    """Whether it is junk by element, role or ``hidden``; and by a part of its
    class or id alone (1, 2 for reader comments, 3 for a header, 0 if not; 4 for
    the article's own header, which is none). A part after no, has, with and the like tells
    of something else and does not count."""
    if tag in JUNK or tag in HIDDEN or (tag == "header" and not inside_article):
        return True, 0
    # a form goes like a named element, unless it holds most of the text; its controls always go
    named, seen = int(tag == "form"), set()
    if not attributes:
        return False, named
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in seen:
            continue  # of repeated attributes the first counts, as in browsers
        seen.add(name)
        value = next((v for v in values if v), "").lower()
        if name == "hidden":
            return True, 0
        if name == "role":
            if value in JUNK_ROLES:
                return True, 0
        elif name in ("class", "id") and tag not in ("html", "body", "main"):
            for word in value.split():
                parts = [x for x in _NAME.split(word) if x]
                names = set(parts[: next((i for i, x in enumerate(parts) if x in NOT_ITSELF), len(parts))])
                if tag == "article" and not names & COMMENTS:
                    continue  # only reader comments make an article junk
                if names & JUNK_NAMES:
                    kind = 2 if names & COMMENTS else 1
                elif "header" in names and not inside_article:
                    kind = OWN_HEADER if names & ARTICLE_PARTS else HEADER
                else:
                    continue
                if named in (0, HEADER, OWN_HEADER) or kind == 2:
                    named = kind
    return False, named


def parse(page: str) -> Node:
    """The element tree; texts are strings among the children."""
    root = at = Node("#page", None)
    articles = 0
    i, n = 0, len(page)
    while i < n:
        j = page.find("<", i)
        if j < 0:
            j = n
        if j > i:
            at.kids.append(page[i:j])
        if j >= n:
            break
        if page.startswith("<!--", j):
            k = page.find("-->", j + 4)
            i = n if k < 0 else k + 3
            continue
        m = _TAG.match(page, j) or _LOOSE_TAG.match(page, j)
        if not m:
            if page[j + 1 : j + 2] in ("!", "?", "/"):
                k = page.find(">", j)
                i = n if k < 0 else k + 1
            elif page[j + 1 : j + 2].isalpha():
                break  # a tag that never ends
            else:
                at.kids.append("<")
                i = j + 1
            continue
        i = m.end()
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if closing:
            found, node = None, at
            while node.parent is not None:
                if node.tag == tag:
                    found = node
                    break
                if tag in INLINE and node.tag not in INLINE:
                    break  # an inline end tag closes no block
                node = node.parent
            if found is not None:
                articles -= _count_articles(at, found)
                at = found.parent
            continue
        if tag not in INLINE and tag not in VOID | {"br"} or tag == "hr":
            at, closed = _close_implied(at, tag)
            articles -= closed
        junk, named = _junk_kind(tag, attributes, articles > 0)
        node = Node(tag, at, junk)
        node.named = named
        at.kids.append(node)
        if tag in VOID or attributes.endswith("/") and tag in HIDDEN:
            continue
        if tag in _END_OF:
            end = _END_OF[tag].search(page, i)
            if tag == "title":
                node.kids.append(page[i : n if end is None else end.start()])
            i = n if end is None else end.start()  # its end tag comes next
            if end is not None:
                k = page.find(">", i)
                i = n if k < 0 else k + 1
            continue
        at = node
        articles += tag in ("article", "main")
    return root


def _count_articles(at: Node, upto: Node) -> int:
    count, node = 0, at
    while True:
        count += node.tag in ("article", "main")
        if node is upto:
            return count
        node = node.parent


def _close_implied(at: Node, tag: str) -> tuple[Node, int]:
    """Where a block element starts: open paragraphs end, and with them what
    is open inside; list items, cells and the like end at their next sibling."""
    node, target = at, None
    while node.parent is not None:
        if node.tag == "p" or tag in ENDED_BY.get(node.tag, ()):
            target = node
            if node.tag != "p":
                break
        elif node.tag in SCOPES:
            break
        node = node.parent
    if target is None:
        return at, 0
    return target.parent, _count_articles(at, target)


def _blocks(root: Node) -> list[tuple[Node, str, int]]:
    """Paragraphs in page order: the block element that holds them, raw text,
    characters under links. Junk is left out."""
    out: list[tuple[Node, str, int]] = []
    text: list[str] = []
    linked = 0
    holder = root

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                out.append((holder, whole, min(linked, len(whole))))
            text.clear()
        linked = 0

    # (node, next child, links open, holder outside)
    stack: list = [(root, iter(root.kids), 0, root)]
    while stack:
        node, kids, links, outside = stack[-1]
        for kid in kids:
            if isinstance(kid, str):
                text.append(kid)
                if links:
                    linked += len(" ".join(kid.split()))
                continue
            if kid.junk:
                if kid.tag not in INLINE:
                    flush()
                continue
            if kid.tag in ("br", "wbr"):
                text.append(" " if kid.tag == "br" else "")
                continue
            if kid.tag not in INLINE:
                flush()
                stack.append((kid, iter(kid.kids), links, holder))
                holder = kid
            else:
                stack.append((kid, iter(kid.kids), links + (kid.tag == "a"), holder))
            break
        else:
            stack.pop()
            if node.tag not in INLINE:
                flush()
                holder = outside
            continue
    flush()
    return out


def _text(node: Node) -> str:
    """Its text without junk, white space as one space."""
    out, stack = [], [node]
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            out.append(at)
        elif at is node or not at.junk:
            out.append(" " if at.tag not in INLINE else "")
            stack.extend(reversed(at.kids))
    return " ".join(entities.unescape("".join(out)).split())


def _find_title(root: Node) -> tuple[Node | None, Node | None]:
    """The h1 that the page's title names, with the page header that held it,
    of which all else goes; nulls where none stands outside of articles.
    Labels in articles are text, unless they are of a form or a control."""
    title, inside, free, headed = None, [], [], []
    stack: list = [(root, False, False, None)]
    while stack:
        node, article, form, header = stack.pop()
        if node.tag == "title" and title is None:
            title = _text(node).casefold()
        if node.tag == "label" and article and not form:
            node.junk = any(k.tag in CONTROLS for k in node.kids if not isinstance(k, str))
        if node.tag == "header" and node.junk or node.named == HEADER:
            header = header or node
        elif node.junk and node.tag != "head" or node.named not in (0, OWN_HEADER) and node.tag != "form":
            continue
        if node.tag == "h1":
            (inside if article else headed if header else free).append((node, header))
        article, form = article or node.tag in ("article", "main"), form or node.tag in ("form", "fieldset")
        stack.extend((k, article, form, header) for k in reversed(node.kids) if not isinstance(k, str))
    if not title:
        return None, None
    names = {title, _TITLE_PARTS.split(title)[0]}
    for found in (inside, free, headed):
        for node, header in found:
            if _text(node).casefold() in names:
                if found is inside:
                    return None, None
                at = node
                while header is not None and at is not header:
                    at.parent.kids, at = [at], at.parent
                if header is not None:
                    header.junk, header.named = False, 0
                return node, header
    return None, None


def _only_headings(node: Node) -> bool:
    """Whether it has text, all of it in headings, little of it linked."""
    stack, seen = [node], False
    while stack:
        at = stack.pop()
        if at.tag in ("h1", "h2"):
            seen = seen or at.chars > 0
            continue
        if any(k.strip() for k in at.kids if isinstance(k, str)):
            return False
        stack.extend(k for k in at.kids if not isinstance(k, str) and not k.junk)
    return seen and node.linked < 0.3 * node.chars


def _mark_named(root: Node) -> None:
    """Junk by class or id alone, unless it holds more than ``MOST`` of the
    text in article and main elements (of all text, on a page without them),
    links and other junk aside. Reader comments may be most of a page; they
    stay only where hardly any other text is left."""
    order, stack = [], [(root, False, False)]
    while stack:
        node, linked, inside = stack.pop()
        linked, inside = linked or node.tag == "a", inside or node.tag in ("article", "main")
        order.append((node, linked, inside))
        stack.extend((k, linked, inside) for k in node.kids if not isinstance(k, str) and not k.junk)
    if not any(node.named not in (0, OWN_HEADER) for node, _, _ in order):
        return
    sizes: dict[Node, tuple[int, int]] = {}  # in article and main elements, in all
    for node, linked, inside in reversed(order):
        own = 0 if linked else sum(len(" ".join(k.split())) for k in node.kids if isinstance(k, str))
        below = [sizes[k] for k in node.kids if not isinstance(k, str) and not k.junk]
        sizes[node] = own * inside + sum(x for x, _ in below), own + sum(x for _, x in below)
    of = 0 if sizes[root][0] else 1
    total = sizes[root][of]
    for node, _, _ in order:
        if node.named not in (0, OWN_HEADER):
            held = sizes[node][of]
            node.junk = held <= MOST * total or node.named == 2 and total - held >= LONG


def _mark_link_lists(root: Node) -> None:
    """Lists made of links are menus; in an article those that stand before
    its first paragraph."""
    order, stack = [], [(root, None)]
    while stack:
        node, article = stack.pop()
        article = node if node.tag == "article" else article
        order.append((node, article))
        stack.extend((k, article) for k in reversed(node.kids) if not isinstance(k, str))
    for node, _ in reversed(order):
        for kid in node.kids:
            if isinstance(kid, str):
                size = len(" ".join(kid.split()))
                node.chars += size
            elif not kid.junk:
                node.chars += kid.chars
                node.links += kid.links
                node.linked += kid.linked
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
    begun: set[Node] = set()
    for node, article in order:
        if node.tag == "p" and not node.junk and node.linked < 0.8 * node.chars:
            begun.add(article)
        items = node.tag in ("ul", "ol", "dl") and node.links >= MENU_LINKS
        if items and node.linked >= 0.8 * node.chars and (article is None or article not in begun):
            node.junk = True


def _container(best: Node, root: Node, header: Node | None = None) -> Node:
    """The nearest article or main element around the best one, with all that
    it holds; without one, or around it, the parents that hold no junk."""
    node = best
    while node is not None and node.tag != "article":
        node = node.parent
    if node is None:
        node = best
        while node is not None and node.tag != "main":
            node = node.parent
    at = node or best
    if at.tag in ("article", "main"):
        return at
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in node.kids if not isinstance(k, str))
    unclean: set[Node] = set()  # with menus and the like inside, marked or mere links
    for node in reversed(order):
        marked = node.junk and node.tag not in HIDDEN and node.tag not in ("head", "title", "input", "button")
        links = node.tag not in INLINE and node.links >= MENU_LINKS and node.linked >= 0.5 * node.chars
        if marked or links or node is header or any(k in unclean for k in node.kids if not isinstance(k, str)) and not node.junk:
            unclean.add(node)
    # what is inside the best element counts neither for nor against its parents
    while at.parent is not None and not any(k in unclean for k in at.parent.kids if not isinstance(k, str) and k is not at):
        at = at.parent
    return at


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = parse(page)
    title, header = _find_title(root)
    _mark_named(root)
    _mark_link_lists(root)
    blocks = _blocks(root)
    if not blocks:
        return ""
    totals: dict[Node, list] = {}
    for holder, text, linked in blocks:
        points = min(len(text) / LONG, 1) + len(text) / 400 + text.count(",") / 4
        # a paragraph element passes its points to what holds it
        node = holder.parent if holder.parent is not None and holder.tag in ("p", "pre", "blockquote", "li", "td") else holder
        share = 1.0
        while node is not None and share > 1e-9:
            entry = totals.setdefault(node, [0.0, 0, 0])
            entry[0] += points * share
            entry[1] += len(text)
            entry[2] += linked
            node, share = node.parent, share / 2
    order = {node: i for i, node in enumerate(totals)}

    def score(node: Node) -> float:
        points, chars, linked = totals[node]
        return points * (1 - linked / max(chars, 1))

    best = max(totals, key=lambda x: (score(x), -order[x]))
    best = _container(best, root, header)
    kept = {best, title} - {None}
    if best.parent is not None:
        siblings = [k for k in best.parent.kids if not isinstance(k, str)]
        at = siblings.index(best)
        if at and not siblings[at - 1].junk and _only_headings(siblings[at - 1]):
            kept.add(siblings[at - 1])
        for sibling in siblings:
            if sibling.junk or sibling not in totals and sibling.tag != "p":
                continue
            if sibling.named == OWN_HEADER or sibling in totals and score(sibling) >= SIBLING_SHARE * score(best):
                kept.add(sibling)
            elif sibling.tag == best.tag == "article" and sibling.linked < TEASER_LINKS * max(sibling.chars, 1):
                kept.add(sibling)  # a further article, not a teaser that links to one
            elif sibling.tag in ("p", "h1", "h2", "h3", "pre", "blockquote") and sibling.linked < 0.3 * max(sibling.chars, 1):
                kept.add(sibling)
    inside: dict[Node, bool] = {}

    def held(node: Node) -> bool:
        path = []
        while node is not None and node not in inside and node not in kept:
            path.append(node)
            node = node.parent
        answer = node is not None and (node in kept or inside[node])
        for x in path:
            inside[x] = answer
        return answer

    def beside(holder: Node, text: str, linked: int) -> bool:
        return holder is best.parent and linked < 0.3 * len(text)

    return "\n\n".join(text for holder, text, linked in blocks if held(holder) or beside(holder, text, linked))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([main_text(p) for p in pages_], dtype=object)

    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), extract(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
