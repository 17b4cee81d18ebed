"""Main text of web pages by composite text density.

For every element: characters per tag, adjusted for links. A node's density sum
adds up its children's densities; the node with the largest sum holds the article,
and elements elsewhere count too where they and all their ancestors reach the
least density on the path from the body to that node.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.registry import register

#: Comments, declarations and tags; of a tag whose attributes hold < or > in quotes
#: only the name. ``_tag_end`` reads on there.
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^<>\"']++|\"[^<>\"]*+\"|'[^<>']*+')*+)(?:>|\Z))?",
    re.S,
)
_PLAIN = re.compile(r"[^>\"']*+")
#: Name and value of each attribute; of a name that comes twice, the first counts.
_ATTRS = re.compile(r"([^\s\"'>/=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_TOLD = re.compile(r"class|id|role|hidden|style", re.I)
_NONE = re.compile(r"display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp")}
#: Elements that never hold article text.
_DROPPED = frozenset(
    "head script style noscript template iframe object svg math canvas audio video button select option textarea input title xmp".split()
)
#: Elements that surround an article, unless a page has its article in them.
_SURROUNDS = frozenset("nav header footer aside form label fieldset menu dialog".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Words of class, id and role values that mark what surrounds an article.
_AROUND = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies disqus discussion cookie "
    "cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login form search share "
    "sharing social related recommended recommendations widget toolbar pagination pager copyright legal disclaimer "
    "complementary contentinfo outbrain taboola skip respond feedback".split()
)
#: Of these, words that tell the same inside an article, as a class of nothing else.
_APART = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead comment comments replies disqus newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations toolbar pagination pager outbrain taboola".split()
)
#: Of these, words that a part of an article may be called by: it stays inside one if
#: it's so many characters of text without a link at least.
_MAY_TELL = frozenset("promotion social share sharing related recommended recommendations".split())
_PROSE = 100
#: Words that add nothing to such a name.
_FILLERS = frozenset("area bar block bottom box buttons container content inner left links list main outer right row section top wrap wrapper".split())
_ROLES = frozenset("navigation banner complementary contentinfo search menu menubar toolbar".split())
#: A name that begins so tells of something else's surroundings.
_ABOUT = frozenset("no has have with without not".split())
#: Blocks of running text, and what stands in them.
_TEXT_BLOCKS = _INLINE | frozenset("p h1 h2 h3 h4 h5 h6 hgroup pre blockquote figure figcaption address details hr".split())
#: A block is a part of the text if it's so many times less dense than another at most.
_PEERS = 4
#: Blocks that may be lists of links.
_LINK_LISTS = frozenset("ul ol dl div section table".split())
_LISTS = frozenset("ul ol dl table".split())
#: An element of these is never dropped by such a word.
_CORE = frozenset("html body main article".split())
#: Opening one of these closes an open paragraph.
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl dd dt fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: Opening the key closes an open element of the values, up to the stops.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_P = (frozenset(["p"]), frozenset("td th button object table".split()) | {"body"})
#: An end tag without a start doesn't close anything beyond these.
_SCOPES = frozenset("table td th article section aside nav header footer main body html".split())


#: What speaks for an element being around the article: one word of a name, a name as
#: a whole, a form, a class that counts inside an article too but for prose, and a sign
#: that always counts there.
ONE_WORD, WHOLE_NAME, FORM, NAMED, SURE = 1, 2, 3, 4, 5


class Node:
    __slots__ = (
        "tag", "above", "kids", "dropped", "sign", "closed", "bare", "plain",
        "blocky", "chars", "tags", "link_chars", "link_tags", "bare_tags", "density", "total",
    )

    def __init__(self, tag: str, dropped: bool, above: Node | None = None, sign: int = 0):
        self.tag, self.dropped, self.above, self.kids = tag, dropped, above, []
        self.sign, self.closed, self.bare = sign, False, False

    def elements(self) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node) and not k.dropped]


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, quoted, single, bare in _ATTRS.findall(text):
        found.setdefault(name.lower(), quoted or single or bare)
    return found


def _hidden(attrs: dict[str, str]) -> bool:
    return (
        attrs.get("hidden", "until-found").strip().lower() != "until-found"
        or attrs.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NONE.search(attrs.get("style", "")))
    )


def _sign(tag: str, attrs: dict[str, str]) -> int:
    """The strongest sign that an element surrounds the article; 0 for none."""
    if tag in _SURROUNDS:
        return FORM if tag == "form" else SURE
    best = 0
    for key in ("class", "id", "role"):
        for name in attrs.get(key, "").split():
            if key == "role" and name.lower() in _ROLES:
                return SURE
            words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
            if _AROUND.isdisjoint(words) or words[0] in _ABOUT:
                continue
            whole = all(w in _AROUND or w in _FILLERS for w in words)
            apart = _APART.intersection(words)
            if whole and key == "class" and apart - _MAY_TELL:
                return SURE
            if whole and key == "class" and apart:
                best = NAMED
                continue
            best = max(best, WHOLE_NAME if whole else ONE_WORD)
    return best


def _judge(tag: str, text: str) -> tuple[bool, int, bool]:
    """Whether an element goes whatever it holds, its sign, and whether it's a link
    that neither leads anywhere nor can be led to."""
    if tag in _DROPPED:
        return True, 0, False
    if tag in _CORE:
        return False, 0, False
    attrs = _attributes(text) if tag == "a" or _TOLD.search(text) else {}
    return _hidden(attrs), _sign(tag, attrs), tag == "a" and attrs.keys().isdisjoint(("href", "name", "id"))


def _tag_end(html: str, at: int, lost: set[int]) -> int:
    """Where the attributes from ``at`` end: at the first > outside quotes or at the
    page's end; at the first > of all if a quote doesn't close. ``lost`` keeps the
    quotes from which none is found, so a page is read once for all its tags."""
    seen, here = [], at
    while True:
        here = _PLAIN.match(html, here).end()
        if here == len(html) or html[here] == ">":
            return here
        seen.append(here)
        after = -1 if here in lost else html.find(html[here], here + 1)
        if after < 0:
            lost.update(seen)
            first = html.find(">", at)
            return len(html) if first < 0 else first
        here = after + 1


def parse(html: str) -> Node:
    """Element tree of a page, with the closing rules of everyday mark-up. Attributes
    may be of any number and length."""
    root = Node("html", False)
    stack, at, end = [root], 0, len(html)
    lost: set[int] = set()

    def close(tags, stops) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                stack[i].closed = True
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    while at < end:
        m = _MARKUP.search(html, at)
        upto = m.start() if m else end
        if upto > at:
            stack[-1].kids.append(html[at:upto])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, told = m[2].lower(), m[3]
        if told is None:
            stop = _tag_end(html, at, lost)
            at, told = min(stop + 1, end), html[at:stop]
        if m[1]:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                continue
            close((tag,), () if tag in _SCOPES else _SCOPES - {tag})
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close(("head",), ())
            continue
        if tag in _CLOSES_P:
            close(*_P)
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        dropped, sign, bare = _judge(tag, told)
        node = Node(tag, dropped, stack[-1], sign)
        node.bare = bare
        stack[-1].kids.append(node)
        if tag in _RAW:
            stop = _RAW[tag].search(html, at)
            at = stop.end() if stop else end
        elif tag not in _VOID:
            stack.append(node)
    _drop_surroundings(root)
    return root


def _drop_surroundings(root: Node) -> None:
    """Drop what surrounds the article by its signs, but never what holds it.

    Spared are elements around the article or main element of the most unlinked
    text, and those of over half of the page's unlinked text, unless an article stands
    outside and a whole name or sure sign of a closed element speaks against it.
    A closed footer, nav, header or aside isn't spared for its length while there is
    text without any sign. Inside an article only forms, sure signs and classes that
    speak against anything but prose count, and its header stays. Blocks of links
    beside the article in a spared element go.
    """
    order, named_inside, todo = [], [], [(root, False, False, False)]
    while todo:
        node, linked, inside, within = todo.pop()
        if inside and (node.sign < FORM or node.tag == "header"):
            node.sign = 0
        order.append((node, linked, within))
        if inside and node.sign == NAMED:
            named_inside.append(node)
        inner = inside or node.tag == "article"
        todo.extend((k, linked or k.tag == "a", inner, within or node.sign > 0) for k in node.elements())
    if not any(node.sign for node, _, _ in order):
        return
    for node, linked, _ in reversed(order):
        node.plain = node.chars = 0
        for kid in node.kids:
            if isinstance(kid, str):
                n = len("".join(kid.split()))
                node.chars += n
                node.plain += 0 if linked else n
            elif not kid.dropped:
                node.chars += kid.chars
                node.plain += kid.plain
    for node in named_inside:
        if node.plain == node.chars >= _PROSE:
            node.sign = 0
    cores = [(node, within) for node, _, within in order if node.tag in ("article", "main") and node.plain]
    free = [node for node, within in cores if not within]
    core = max(free or [node for node, _ in cores], key=lambda n: n.plain, default=None)
    marked = sum(node.plain for node, _, within in order if node.sign and not within)
    unmarked = root.plain > marked
    holds, node = set(), core
    while node is not None:
        holds.add(id(node))
        node = node.above
    for node, _, _ in order:
        if not node.sign:
            continue
        most = 2 * node.plain > root.plain and (not free or not node.closed or node.sign in (ONE_WORD, FORM))
        # A closed footer, nav, header or aside isn't the article while other text is unmarked.
        most = most and not (node.closed and node.tag in _SURROUNDS and node.sign == SURE and unmarked)
        if id(node) not in holds and not most:
            node.dropped = True
            continue
        for kid in node.elements() if id(node) in holds or node.sign >= NAMED else ():
            if id(kid) not in holds and kid.chars and 2 * kid.plain <= kid.chars:
                kid.dropped = True


def _measure(root: Node) -> list[Node]:
    """Count characters, tags and links of every kept node, then its density and the
    sum of its children's; returns the kept nodes, each after the one above it.

    An inline element without blocks in it is a part of its block's text: its tag
    counts there, but it adds no density of its own, so bold text or a line break
    doesn't make a paragraph the densest node of a page."""
    order, todo = [], [(root, False)]
    while todo:  # no recursion: pages may nest very deeply
        node, linked = todo.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        todo.extend((k, linked) for k in node.elements())
    for node, linked in reversed(order):
        chars = tags = link_chars = link_tags = bare_tags = 0
        node.blocky = node.tag not in _INLINE and node.tag not in _VOID
        for kid in node.kids:
            if isinstance(kid, str):
                chars += len("".join(kid.split()))
            elif not kid.dropped:
                node.blocky = node.blocky or kid.blocky
                chars += kid.chars
                tags += kid.tags + 1
                link_chars += kid.link_chars
                link_tags += kid.link_tags + (kid.tag == "a")
                bare_tags += kid.bare_tags + kid.bare
        node.chars, node.tags, node.link_tags, node.bare_tags = chars, tags, link_tags, bare_tags
        node.link_chars = chars if linked else link_chars
    share = root.link_chars / max(root.chars, 1)
    for node, _ in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        # Characters per tag, times a logarithm that falls as links take over.
        base = log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + e)
        weight = log(c / lc * t / lt) if c * t > lc * lt else 0.0
        node.density = c / t * (weight / log(base) if base > e else weight)
    for node, _ in order:
        node.total = sum(k.density for k in node.elements() if k.blocky)
    return [node for node, _ in order]


def _menu(node: Node) -> bool:
    """A list of nothing but links that lead nowhere and aren't led to: controls."""
    return node.tag in ("ul", "ol") and node.link_tags == node.bare_tags > 1 and node.link_chars == node.chars


def _link_list(node: Node) -> bool:
    """A block of several links and next to nothing else."""
    return node.tag in _LINK_LISTS and node.link_tags > 1 and node.link_chars * 5 >= node.chars * 4


def _texts(node: Node | str) -> Iterator[str]:
    """A node's text in page order; block borders and line breaks become blanks.
    Of a whole page, link lists less dense than the page go, but none in an article."""
    todo: list = [(node, isinstance(node, Node) and node.above is None)]
    while todo:
        x, wide = todo.pop()
        if isinstance(x, str):
            yield unescape(x) if "&" in x else x
            continue
        if x.dropped or x is not node and (_menu(x) or wide and x.density < node.density and _link_list(x)):
            continue
        wide = wide and x.tag != "article"
        border = x.tag not in _INLINE
        todo.extend((k, wide) for k in [" "] * border + x.kids[::-1] + [" "] * border)


def _joined(nodes: list[Node | str]) -> str:
    return " ".join("".join(t for n in nodes for t in _texts(n)).split())


def extract(html: str | None) -> str:
    """Main text of a page; empty for an empty or null page.

    The node of the largest density sum counts whole, whatever its tag. So does every
    other topmost element whose density reaches the least on the path from the body to
    that node, provided it holds running text (most of it outside links).

    The tags article and main only lower that threshold: if the chosen node is an
    article, others need a quarter of its density. Of the elements on the path that are
    or lie in a main or article around the chosen node (the chosen one too if it's the
    main itself), text, paragraphs, headings and lists of running text count as they
    are, and other blocks need a quarter of the density of the densest beside them.
    """
    root = parse(html or "")
    best = max(_measure(root), key=lambda n: n.total)
    path = [best]
    while path[-1].above is not None:
        path.append(path[-1].above)
    floor = min(n.density for n in path)
    spine = path[best.tag != "main" :]
    on_spine, in_main = set(map(id, spine)), False
    wide = set()  # nodes of the spine that are a main or an article, or lie in one
    for node in reversed(spine):
        in_main = in_main or node.tag in ("main", "article")
        if in_main:
            wide.add(id(node))
    marked: list[Node | str] = []
    # What to look at next, the density it needs, and whether it lies in such a node.
    todo: list[tuple[Node | str, float, bool]] = [(root, floor, False)]
    while todo:
        node, need, free = todo.pop()
        if isinstance(node, str):
            marked.append(node)
            continue
        if id(node) in wide:
            low = min(floor, max((k.density for k in node.elements()), default=0.0) / _PEERS)
            todo.extend((k, low, True) for k in reversed(node.kids) if isinstance(k, str) or not k.dropped)
            continue
        if id(node) not in on_spine:
            if node.tag == "article" and best.tag == "article":
                need = min(need, best.density / _PEERS)
            running = 2 * node.link_chars < node.chars
            as_is = free and (node.tag in _TEXT_BLOCKS or node.tag == "header" or node.tag in _LISTS and running)
            if node is best or as_is or node.density >= need and running:
                marked.append(node)
                continue
        todo.extend((k, floor, False) for k in reversed(node.elements()))
    return _joined(marked)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the mark-up, and ``main_text``.

    A null or empty page has empty text; a column of the name main_text gives way;
    an empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def main_text(html: pd.Series) -> pd.Series:
        return html.map(extract)

    return pages.withColumn("main_text", main_text(F.col(html_col).cast("string"))).drop(html_col)


@register("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
