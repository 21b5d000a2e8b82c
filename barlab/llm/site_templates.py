"""HTML extraction by site template removal.

Pages are parsed into element trees. In Spark, the hashes of their subtrees are
counted per host, once per distinct page; a subtree found on many pages of a host
(at least ``MIN_PAGES`` and ``MIN_SHARE`` of them) is template and is deleted, along
with elements that say themselves that they aren't the text: navigation, headers,
footers, sidebars, forms, scripts, and containers with a class or id token that
names nothing but adverts, notices, comments and the like (``ad-box``,
``comment-5``; not ``related-work``). Headings, paragraphs and inline elements are
never dropped by class or id, where slugs of their text are usual. What is left of
the main element (article, else main, else body) is joined block by block.

Rows of a host are one page if the texts of their main elements are equal: copies
under other URLs, print views and repeated rows don't vote their text into a
template. Near copies, with other words in the main element, are pages of their own.

Text that many pages share inside a main element is still text (a common line of
an article): there, only container subtrees (``CONTAINERS``) count as template.

A host has at most pages-per-host * subtrees-per-page / threshold templates,
that is, some hundred, so they travel as one list per host; a host's pages are
counted by partial aggregates (first by host, subtree and page, so copies end
where they are read), and the lists are joined to pages by a stage table, broadcast
when small and skew-split when not.

Edge cases: null html is empty; null or hostless URLs share the host ``""``;
unclosed, stray and cut-off tags are tolerated, an unclosed element ends with its
parent; repeated rows count as one page; an empty table gives no rows; only
page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh64_intdigest

from barlab.llm import vectors as V
from barlab.llm.url_lm import host_path
from barlab.llm.workspace import Workspace

MIN_PAGES = 4
MIN_SHARE = 0.2

RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = RAW | frozenset("head nav header footer aside form button select option dialog menu object video audio canvas".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td
tfoot th thead title tr ul""".split())
CONTAINERS = frozenset("aside details div footer form header nav ol section table ul".split())
#: An open element of these ends when one of its set begins.
CLOSED_BY = {"p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class and id tokens that name what isn't main text.
LABELS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices notification alert popup modal overlay
comment comments respond replies disqus sidebar aside widget widgets related recommended share sharing social
nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer
newsletter subscribe subscription signup login search""".split())
#: Words that may stand beside them in a token.
LAYOUT = frozenset("area bar block box button buttons container inner item left link links list outer right slot wrap wrapper".split())

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[^\W\d_]+")

#: A row without subtree stands for the page itself.
HOST_SUBTREES = V.struct("host string, page long, subtree long")
TEXTS = V.struct("page_id long, url string, text string, n_chars long")


class Element:
    __slots__ = ("tag", "dropped", "children", "subtree")

    def __init__(self, tag: str, dropped: bool):
        self.tag, self.dropped, self.children, self.subtree = tag, dropped, [], 0


def _names_other(token: str) -> bool:
    """Whether the whole token names something else than main text."""
    words = _WORDS.findall(token)
    return not LABELS.isdisjoint(words) and all(w in LABELS or w in LAYOUT for w in words)


def _labelled(tag: str, attrs: str) -> bool:
    if tag in DROPPED:
        return True
    if not attrs.strip() or tag in ("html", "body", "article", "main"):
        return False
    of: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        of.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or "").lower())  # the first of a name holds
    if "hidden" in of or of.get("aria-hidden") == "true" or of.get("role") in ROLES:
        return True
    return tag in CONTAINERS and any(_names_other(token) for name in ("class", "id") for token in of.get(name, "").split())


def parse(source: str) -> Element:
    """Element tree; text nodes are strings with references decoded."""
    root = Element("#root", False)
    stack, at, n = [root], 0, len(source)

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(entities.unescape(s) if "&" in s else s)

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        text(source[at:lt])
        m = _TOKEN.match(source, lt)
        if not m:
            text("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # inline end tags don't close blocks around them
                if stack[k].tag in BLOCKS and tag not in BLOCKS:
                    break
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        while len(stack) > 1:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCKS), 0)
            if k and tag in CLOSED_BY.get(stack[k].tag, ()):
                del stack[k:]
            else:
                break
        e = Element(tag, _labelled(tag, attrs))
        stack[-1].children.append(e)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(e)
    return root


def _walk(e: Element):
    """Elements in post order, without recursion."""
    todo = [(e, False)]
    while todo:
        x, done = todo.pop()
        if done:
            yield x
        else:
            todo.append((x, True))
            todo.extend((c, False) for c in reversed(x.children) if isinstance(c, Element))


def _hash(e: Element) -> None:
    """Set the ``subtree`` of every element of ``e`` from tags, texts and children."""
    for x in _walk(e):
        x.subtree = xxh64_intdigest("\0".join(
            [x.tag, *[f"\1{c.subtree}" if isinstance(c, Element) else c.strip() for c in x.children]])) - (1 << 63)


def _mains(root: Element) -> list[Element]:
    """Outermost articles, else the main element, else all."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            e = todo.pop()
            if e.tag == wanted:
                found.append(e)
            elif not e.dropped:
                todo.extend(c for c in reversed(e.children) if isinstance(c, Element))
        if found:
            return found
    return [root]


def _candidates(root: Element) -> list[Element]:
    """Elements that may be template, hashed: those outside the main elements, and containers inside."""
    mains = _mains(root)
    if mains[0] is root:
        _hash(root)
        return [e for e in _walk(root) if e.children and e is not root and e.tag not in ("html", "body")]
    own, out, todo = {id(m) for m in mains}, [], [(root, False)]
    while todo:
        e, inside = todo.pop()
        here = inside or id(e) in own
        for c in e.children:
            if isinstance(c, Element):
                if (not here and id(c) not in own) or (here and c.tag in CONTAINERS):
                    if c.children and c.tag not in ("html", "body"):
                        out.append(c)
                todo.append((c, here))
    for e in out:
        if not e.subtree:
            _hash(e)
    return out


def subtrees(root: Element) -> set[int]:
    """Hashes of the subtrees that may be template."""
    return {e.subtree for e in _candidates(root)}


def main_text(root: Element, templates: frozenset[int]) -> str:
    """Blocks of the main element outside dropped and template subtrees."""
    template = {id(e) for e in _candidates(root) if e.subtree in templates} if templates else ()
    mains = _mains(root)
    blocks, line = [], []

    def close() -> None:
        s = " ".join("".join(line).split())
        line.clear()
        if s:
            blocks.append(s)

    for m in mains:
        todo: list = [m]
        while todo:
            e = todo.pop()
            if e is None:
                close()
            elif isinstance(e, str):
                line.append(e)
            else:
                if e is not m and (e.dropped or id(e) in template):
                    close()
                    continue
                if e.tag in BLOCKS:
                    close()
                    todo.append(None)
                todo.extend(reversed(e.children))
        close()
    return "\n".join(blocks)


def page_subtrees(batches):
    schema = to_arrow_schema(HOST_SUBTREES)
    for b in batches:
        hosts, pages, hashes = [], [], []
        for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            root = parse(source)
            found = [None, *subtrees(root)]
            hosts += [host] * len(found)
            pages += [xxh64_intdigest(main_text(root, frozenset())) - (1 << 63)] * len(found)
            hashes += found
        yield V.record_batch(schema, host=hosts, page=pages, subtree=hashes)


def page_texts(batches):
    schema = to_arrow_schema(TEXTS)
    for b in batches:
        for k in range(0, b.num_rows, 500):
            part = b.slice(k, 500)
            texts = [main_text(parse(s), frozenset(t or ())) if s else ""
                     for s, t in zip(part.column("html").to_pylist(), part.column("templates").to_pylist())]
            yield V.record_batch(schema, page_id=part.column("page_id"), url=part.column("url"), text=texts, n_chars=[len(t) for t in texts])


def extract(ws: Workspace, pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    host, _ = host_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    found = rows.select("host", "html").mapInArrow(page_subtrees, HOST_SUBTREES).groupBy("host", "subtree").agg(F.count_distinct("page").alias("n"))
    found = ws.stage(found.filter(F.col("subtree").isNull() | (F.col("n") >= min_pages)), "subtrees")
    of_host = found.filter(F.col("subtree").isNull()).select("host", F.col("n").alias("pages"))
    common = found.filter(F.col("subtree").isNotNull()).join(of_host, "host").filter(F.col("n") >= min_share * F.col("pages"))
    lists = ws.stage(common.groupBy("host").agg(F.collect_list("subtree").alias("templates")), "templates")
    return rows.join(lists, "host", "left").select("page_id", "url", "html", "templates").mapInArrow(page_texts, TEXTS)
