"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, weakened where much of its text is
in links; only what a browser does not show as text is left out before. A node's density sum is
the sum over its children and over its own loose text. The node of the largest sum holds the
article, and the least density on the path from it to the body is the threshold at which other
parts of the page count as content as well.

From the best node the article's border is sought upwards: a parent belongs to it as long as it
is not much thinner than the child (``CLIMB``), and so does an article or main element around it.
Headings, short blocks and loose text in there are content without a threshold, what is mostly
links only as a heading, and so are headings of an outer main before it. Elsewhere a part needs
the threshold's density, and ``SHARE`` of the best sum, which short dense notices lack.
Menus, side bars, notices, adverts, forms and reader comments that stand inside the article are
as dense as its text, so they are known by tag, role or class; such a part is weighed like any
other, but neither is it the best one nor is it given out.

Null or empty html, pages without text and pages whose every density is 0 give an empty string.
Unclosed and misplaced tags are closed as browsers do it roughly; marked sections that are not
HTML count as comments. Of equal sums the first in page order counts. Repeated rows are extracted
alike; other columns stay as they are; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import free_name

# Element names of HTML and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody tfoot thead "
    "tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
UNSEEN = frozenset(
    "button canvas datalist head iframe input math noscript object script select style svg template "
    "textarea title".split())
ASIDE = frozenset("aside dialog footer form header menu nav".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"},
         "th": {"tr"}, "option": {"select"}}
FURNITURE = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright disqus footer form gdpr header login masthead menu menubar "
    "modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted "
    "recommended related share sharing sidebar sidebars signup social sponsor sponsored subscribe "
    "toolbar widget widgets".split())
KEPT_NAMES = frozenset("article content entry main post story text".split())
CLIMB = 0.6        # a parent of at least this share of its child's density belongs to the article
SHARE = 0.1        # of the best density sum, at which another part of the page can be content
ROLES = frozenset("banner navigation contentinfo complementary search form dialog alert "
                  "menu menubar toolbar".split())


def _is_furniture(tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """``inside``: within an article, whose own header belongs to it."""
    if tag in ASIDE:
        return not (tag == "header" and inside)
    if tag in ("html", "body", "main", "article"):
        return False
    given = dict(attributes)
    if "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if (given.get("role") or "").lower() in ROLES:
        return True
    names = set(re.findall(r"[a-z]+", re.sub(
        r"([a-z])([A-Z])", r"\1 \2",
        f"{given.get('class') or ''} {given.get('id') or ''}").lower()))
    if names & {"comment", "comments"}:
        return True
    return bool(names & FURNITURE) and not names & KEPT_NAMES


class _Tree(HTMLParser):
    """Nodes in page order as parallel lists, and the page as a list of events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.dead = ["#"], [-1], [False]
        self.link, self.inside, self.furniture = [False], [False], [False]
        self.places: dict[str, list[int]] = {}      # of each open tag in the open ones
        self.chars, self.link_chars = [0], [0]
        self.open = [0]
        self.events: list[tuple[int, str | None]] = []      # node with its text, or its end

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.events.append((self.open[-1], " "))
            return
        if tag in VOID:
            if tag == "hr":
                self._close_if_open("p", ())
            return
        if tag in BLOCK:
            self._close_if_open("p", ("table", "button"))
        for other in CLOSED_BY.get(tag, ()):
            self._close_if_open(other, HOLDS[tag])
        if tag in ("html", "body") and self.places.get(tag):
            return
        up, k = self.open[-1], len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.dead.append(self.dead[up] or tag in UNSEEN)
        self.furniture.append(self.furniture[up] or _is_furniture(tag, attrs, self.inside[up]))
        self.link.append(self.link[up] or tag == "a")
        self.inside.append(self.inside[up] or tag in ("article", "main"))
        self.chars.append(0)
        self.link_chars.append(0)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(k)
        self.events.append((k, ""))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in ("html", "body"):
            self._close_if_open(tag, ())

    def _close_if_open(self, tag, limits) -> None:
        at = self.places.get(tag)
        if not at or any(self.places[x][-1] > at[-1] for x in limits if self.places.get(x)):
            return
        for _ in range(len(self.open) - at[-1]):
            k = self.open.pop()
            self.places[self.tag[k]].pop()
            self.events.append((k, None))

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)         # a browser takes it for a comment
        return -1 if end < 0 else end + 1

    def unknown_decl(self, data):
        pass

    def handle_data(self, data):
        k = self.open[-1]
        if self.dead[k]:
            return
        self.events.append((k, data))
        n = len("".join(data.split()))
        self.chars[k] += n
        if self.link[k]:
            self.link_chars[k] += n


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int,
                      body_ratio: float) -> float:
    """Characters per tag, damped by the share of linked text beside that of the body."""
    if not chars:
        return 0.0
    tags, plain = max(tags, 1), max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + body_ratio * chars + math.e)
    value = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    if value <= 1.0:        # all links, or one letter: a trace, so that any text has some
        return 1e-6 * chars / tags
    return chars / tags * math.log(value) / max(math.log(base), 1e-9) if base > 1.0 + 1e-9 \
        else chars / tags * math.log(value)


def main_text(html: str | None) -> str:
    """The article's blocks, each with single blanks, joined by line feeds."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    n = len(tree.tag)
    alive = [not d for d in tree.dead]
    loose = [*tree.chars]                   # a node's own text
    tags, link_tags = [0] * n, [0] * n
    for k in range(n - 1, 0, -1):           # children stand after their parents
        up = tree.parent[k]
        if alive[k]:
            tags[up] += tags[k] + 1
            link_tags[up] += link_tags[k] + (tree.tag[k] == "a")
            tree.chars[up] += tree.chars[k]
            tree.link_chars[up] += tree.link_chars[k]
    body = next((k for k in range(n) if tree.tag[k] == "body"), 0)
    if not tree.chars[body]:
        body = 0
    ratio = tree.link_chars[body] / max(tree.chars[body], 1)
    density = [composite_density(tree.chars[k], tags[k], tree.link_chars[k], link_tags[k], ratio)
               if alive[k] else 0.0 for k in range(n)]
    sums = [composite_density(loose[k], 0, loose[k] if tree.link[k] else 0, 0, ratio)
            if alive[k] else 0.0 for k in range(n)]
    below = [k == body for k in range(n)]
    for k in range(1, n):
        below[k] = below[k] or below[tree.parent[k]]
        if alive[k]:
            sums[tree.parent[k]] += density[k]
    best = max((k for k in range(n) if below[k] and alive[k] and not tree.furniture[k]),
               key=lambda k: (sums[k], -k), default=-1)
    if best < 0 or sums[best] <= 0.0:
        return ""
    path = [best]
    while path[-1] != body:
        path.append(tree.parent[path[-1]])
    threshold = min(density[k] for k in path)
    home = best
    for k in path[1:]:
        if density[k] < CLIMB * density[home]:
            break
        home = k
    # an article or main element around the best node says that it is no smaller
    named = next((k for name in ("article", "main") for k in path if tree.tag[k] == name), home)
    home = path[max(path.index(home), path.index(named))]
    on_path = set(path)
    at_home = [False] * n
    share = [_OUT] * n
    for k in range(n):
        up = tree.parent[k]
        at_home[k] = k == home or (up >= 0 and at_home[up])
        linked = tree.link_chars[k] * 2 >= tree.chars[k]
        if not alive[k] or tree.furniture[k]:
            continue
        if k == best or (up >= 0 and share[up] == _ALL):
            share[k] = _ALL
        elif at_home[k]:
            whole = k not in on_path and (tree.tag[k] in HEADING
                                          or tree.tag[k] in BLOCK and not linked)
            share[k] = _ALL if whole else _LOOSE
        elif k in on_path or up < 0:
            continue
        elif tree.tag[k] in HEADING and tree.inside[k] and k < best and (
                up in on_path or tree.tag[up] == "header" and tree.parent[up] in on_path):
            share[k] = _ALL
        elif up in on_path and tree.tag[k] in BLOCK and not linked and density[k] >= threshold \
                and sums[k] >= SHARE * sums[best]:
            share[k] = _ALL
    return "\n".join(_blocks(tree, share))


_OUT, _LOOSE, _ALL = range(3)       # of a node's own text: none, lines not mostly links, all


def _blocks(tree: _Tree, share: list[int]) -> list[str]:
    """The texts between borders of blocks, with single blanks."""
    out: list[str] = []
    line: list[str] = []
    sure, chars, linked = False, 0, 0

    def end() -> None:
        nonlocal sure, chars, linked
        text = " ".join("".join(line).split())
        if text and (sure or linked * 2 < chars):
            out.append(text)
        line.clear()
        sure, chars, linked = False, 0, 0

    for k, text in tree.events:
        if not share[k]:
            if tree.tag[k] in BLOCK and line:
                end()
            continue
        if not text and tree.tag[k] in BLOCK:
            end()
        elif text:
            line.append(text)
            size = len("".join(text.split()))
            sure |= share[k] == _ALL and size > 0
            chars += size
            linked += size * tree.link[k]
        elif tree.tag[k] in ("td", "th"):
            line.append(" ")
    end()
    return out


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add the main text; a column named ``out`` is replaced."""
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(h) for h in column.to_pylist()], pa.string())

    name = free_name(pages, "main_text")
    got = pages.withColumn(name, run(F.col(html)))
    return got.drop(out).withColumnRenamed(name, out)
