"""Main text of web pages: site templates, found as element subtrees that recur on a host's pages, go with all that is no
article by its element or name."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, some_rows, written
from .url_filters import host_of

#: A subtree is a template on a host where so many different pages, and such a share of them, have it.
MIN_PAGES, MIN_SHARE = 10, 0.2
#: Elements whose content is no text, elements that are no article, words of class, id or role that say so.
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "xmp", "noembed", "noframes"})
APART = frozenset({"nav", "footer", "aside", "form", "menu", "dialog", "select", "button", "head", "object", "audio", "video", "canvas", "fieldset", "datalist"})
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments disqus replies respond cookie cookies consent gdpr "
    "notice notices alert popup modal overlay footer foot masthead nav navbar navigation menu sidebar side rail widget promo promotion sponsor sponsored "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager toolbar skip "
    "complementary contentinfo dialog alertdialog toc".split()
)
HEADER_WORDS = frozenset("header head topbar site-header page-header".split())
CONTAINERS = frozenset(
    "html body div section article main header nav footer aside form ul ol dl table tbody thead tfoot tr td th figure figcaption details summary menu dialog "
    "fieldset select button center blockquote object audio video canvas head datalist".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SPLIT_NAME = re.compile(r"[^a-z0-9]+")


@dataclass
class Element:
    tag: str
    parent: Element | None
    apart: bool  # it, or one that it is in, is no article
    article: bool  # in an article or main element
    first: int  # of the parts of text, those that are its own
    attributes: str = ""
    last: int = -1


@dataclass
class Page:
    parts: list[str] = field(default_factory=list)  # text, and " " where a block ends
    owner: list[Element] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _apart(tag: str, attributes: str, inside: Element | None) -> bool:
    if tag in APART or tag == "header" and not (inside and inside.article):
        return True
    if not attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = set(SPLIT_NAME.split(name))
            if words & APART_WORDS and not words & {"article", "content", "main", "body", "post", "entry", "story"} or name in HEADER_WORDS and not (inside and inside.article):
                return True
    return False


def parse(text: str) -> Page:
    """Containers and text of a page. A close tag without its open tag is left out; one that skips open containers
    closes them too; what stays open ends with the page. Never fails, whatever the markup."""
    page, at, here = Page(), 0, Element("", None, False, False, 0)
    page.elements.append(here)

    def add(part: str) -> None:
        page.parts.append(part)
        page.owner.append(here)

    while True:
        m = TOKEN.search(text, at)
        if m is None:
            add(text[at:])
            break
        if m.start() > at:
            add(text[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closes, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if not closes and tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            add(" ")
        elif tag not in INLINE:
            add(" ")
            if tag not in CONTAINERS:
                continue
            if not closes:
                if attributes.endswith("/"):
                    continue
                here = Element(tag, here, here.apart or _apart(tag, attributes, here), here.article or tag in ("article", "main"), len(page.parts), attributes)
                page.elements.append(here)
            else:
                up = here
                while up is not None and up.tag != tag:
                    up = up.parent
                if up is not None and up.parent is not None:
                    while here is not up.parent:
                        here.last = len(page.parts)
                        here = here.parent
    while here is not None:
        here.last = len(page.parts)
        here = here.parent
    return page


def _clean(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def subtree_hashes(page: Page) -> list[int | None]:
    """A hash of each container's subtree: its tag, class, id and role, and in order its own text (references decoded, white
    space runs one space) and its containers' hashes; None where there is no text in it. Each part is looked at once,
    however deep it stands."""
    import xxhash

    found: list[int | None] = [None] * len(page.elements)
    number = {id(e): i for i, e in enumerate(page.elements)}
    inner: list[list[tuple[int, str]]] = [[] for _ in page.elements]  # (part, hash) of containers with text
    own: list[list[tuple[int, str]]] = [[] for _ in page.elements]
    for i, (part, e) in enumerate(zip(page.parts, page.owner, strict=True)):
        own[number[id(e)]].append((i, part))
    for i in range(len(page.elements) - 1, -1, -1):  # a container's own containers come after it
        e, pieces, run = page.elements[i], [], []
        at = sorted([*own[i], *((p, None, h) for p, h in inner[i])], key=lambda x: x[0])
        for x in at:
            if len(x) == 2:
                run.append(x[1])
                continue
            pieces += [_clean(run), x[2]]
            run = []
        pieces.append(_clean(run))
        if any(pieces):
            names = " ".join(sorted((m[1] or m[2] or m[3] or "").lower() for m in NAMES.finditer(e.attributes)))
            found[i] = xxhash.xxh3_64_intdigest("\x1f".join([e.tag, names, *pieces])) - (1 << 63)
            if e.parent is not None:
                inner[number[id(e.parent)]].append((e.first, f"\x1e{found[i]}"))
    return found


def subtrees(page: Page) -> list[int]:
    """Hashes of the containers that can be templates, each once: those with text, in an article or out of it, but for the
    page itself, articles and what holds one."""
    holds = set()
    for e in page.elements:
        if e.tag in ("article", "main"):
            while e is not None and id(e) not in holds:
                holds.add(id(e))
                e = e.parent
    return sorted({h for e, h in zip(page.elements, subtree_hashes(page), strict=True) if h is not None and id(e) not in holds and e.parent is not None and e.tag not in ("html", "body")})


def main_text(page: Page, templates: frozenset[int] = frozenset()) -> str:
    """The page's text but for templates and what is apart; of the article or main elements alone, where there are any
    with text. White space, no-break space included, is one space."""
    cut, end = set(), 0
    for e, h in zip(page.elements, subtree_hashes(page), strict=True) if templates else ():
        if e.first >= end and h in templates and e.tag not in ("html", "body", "article", "main"):
            cut.update(range(e.first, e.last))
            end = e.last
    keep = [i for i, e in enumerate(page.owner) if not e.apart and i not in cut]
    inside = _clean([page.parts[i] if page.owner[i].article else " " for i in keep])
    return inside or _clean([page.parts[i] for i in keep])


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, templates): each host's recurring subtrees. pages: host, h. Pages that are the same but for nothing count
    once, so copies of a page make no templates. A host has no more of them than its pages' subtrees / min_share."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in some_rows(batches, 1):
            texts = batch.column(1).to_pylist()
            own = pa.array([xxhash.xxh3_64_intdigest(t or "") - (1 << 63) for t in texts], pa.int64())
            trees = pa.array([subtrees(parse(t or "")) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), own, trees], ["host", "page", "trees"])

    found = written(pages.select("host", "h").mapInArrow(find, "host string, page bigint, trees array<bigint>").distinct(), "subtrees")
    of = found.groupBy("host").agg(F.count_distinct("page").alias("n"))
    trees = found.select("host", "page", F.explode("trees").alias("tree")).distinct().groupBy("host", "tree").agg(F.count(F.lit(1)).alias("k"))
    trees = trees.filter(F.col("k") >= min_pages).join(of, "host").filter(F.col("k") >= min_share * F.col("n"))
    return written(trees.groupBy("host").agg(F.collect_list("tree").alias("templates")), "templates")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per row of pages: id, url, text, n_chars (code points).

    Null html is empty text; null or odd urls are pages of the host with the empty name, which has no templates. Hosts
    are joined to their few templates, by broadcast where these are measured small. Other columns are left out.
    """
    d = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_u"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("h"))
    d = d.withColumn("host", host_of(F.col("_u")))
    templates = site_templates(d.filter("host <> ''"), min_pages, min_share).withColumnRenamed("host", "_host")
    j = d.join(maybe_broadcast(templates), F.col("host") == F.col("_host"), "left").select(F.struct("_id", "_u").alias("k"), "h", "templates")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            text = [main_text(parse(h), frozenset(t or ())) for h, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["k", "text", "n_chars"])

    out = j.mapInArrow(read, f"k {j.schema['k'].dataType.simpleString()}, text string, n_chars bigint")
    return out.select(F.col("k._id").alias(id_col), F.col("k._u").alias(url_col), "text", "n_chars")
