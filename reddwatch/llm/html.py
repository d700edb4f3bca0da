"""Main texts of web pages, by removal of what a site repeats.

Each element's subtree has two hash values: one of its tag, attributes, text and children, and one of its shape alone
(tag, class and the shapes of its children, runs of equal ones as one). For each host, Spark counts over how many
different pages each subtree recurs, and each shape of a subtree whose text is mostly links, such as a menu that has other
entries on every page. What recurs on enough pages is part of the site's template and goes, however large the host is.
Three rules keep content: pages with the same body count once, so a page that was copied is no template; blocks of
prose inside an article or main element stay, since articles may quote the same passage; and shapes go only outside
articles and main elements, from parts that have sentences besides. What HTML itself names as something else than main text (nav,
footer, script and the like) goes too, and what a class, id or role names so, if that does not hold most of the sentences.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import picked, written
from reddwatch.operators.joins import BROADCAST_BYTES, split_join

# A subtree is a template's if it is on at least so many different pages of the host.
LEAST = 5
# What a template's subtree takes in a broadcast, besides the host's name.
SUBTREE_BYTES = 16

# Elements by what HTML says about them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template".split())
NOT_TEXT = set(
    "head script style noscript template iframe object svg canvas audio video map nav header footer aside form "
    "button select input textarea dialog menu".split()
)
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th caption figcaption".split())
# What a start tag ends before it begins.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "tbody": {"table"}, "body": {"html"}}
ENDS_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
# Words in a class, id or role that mark something else than main text.
ASIDE = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "complementary contentinfo disqus footer header masthead menu modal nav navbar navigation newsletter notice paywall "
    "pagination popup promo promoted related reply replies search share sharing sidebar skip social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
# Those of them that also name containers of main text; one that holds most of a page's sentences is such a container.
LAYOUT = set("banner header modal toolbar widget".split())
# What a name begins with that tells what an element has or lacks, not what it is.
ABOUT = set("has is no not with without".split())
# Words that begin a class, id or role of an article that is a comment or the like, and of one that stands for
# another page. The former go, the latter are only not taken for the main part.
REMARK = set("ad ads advert advertisement comment comments promo promoted related replies reply sponsor sponsored".split())
CARD = REMARK | {"card", "teaser"}
SENTENCES = set("p h1 h2 h3 h4 h5 h6 blockquote pre".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(eq=False)
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # elements and texts
    number: int | None = None  # hash value of the subtree
    shape: int = 0  # hash value of its shape
    letters: int = 0  # characters of its text without white space
    linked: int = 0  # those in links
    links: int = 0  # its links


def tree(page: str) -> Element:
    """The page's elements; end tags that are missing or too many are borne."""
    root = Element("html")
    stack = [root]
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        closing, opening, rest = m.group(1), m.group(2), m.group(3)
        if closing:
            tag = closing.lower()
            if tag == "br":
                stack[-1].children.append(Element("br"))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                # A formatting end tag doesn't reach over the block it is in.
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
        elif opening:
            tag = opening.lower()
            found = {
                k.lower(): entities.unescape(next((v for v in (a, b, c) if v), ""))
                for k, a, b, c in _ATTRIBUTE.findall(rest or "")
            }
            if tag in ("html", "body") and any(e.tag == tag for e in stack):
                stack[0].attributes.update(found)
                if tag == "html":
                    continue
            ends, scope = ENDS.get(tag, set()), SCOPE.get(tag, set())
            if tag in ENDS_P:
                ends, scope = ends | {"p"}, scope | (BLOCK - PROSE - ends)
            if tag[0] == "h" and tag[1:] in "123456" and len(tag) == 2:
                ends = ends | {f"h{n}" for n in range(1, 7)}
            if ends:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in scope:
                        break
                    if stack[i].tag in ends:
                        del stack[i:]
                        if tag not in ("tr", "tbody"):
                            break
            element = Element(tag, found)
            stack[-1].children.append(element)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                element.children.append(page[at : end.start() if end else size])
                at = end.end() if end else size
            elif tag not in VOID:
                stack.append(element)
        elif m.group()[0] != "<" or m.group() == "<":
            stack[-1].children.append(entities.unescape(m.group()))
    return root


def _hashed(parts: list[str]) -> int:
    data = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(data, "little", signed=True)


def numbered(element: Element) -> int:
    """Hash values of the subtrees, of all elements under this one too; white space does not count."""
    stack = [(element, False)]
    while stack:
        e, ready = stack.pop()
        if e.number is not None:
            continue
        if not ready:
            stack.append((e, True))
            stack += [(c, False) for c in e.children if isinstance(c, Element)]
            continue
        parts = [e.tag, *(f"{k}={v}" for k, v in sorted(e.attributes.items()))]
        shapes = ["shape", e.tag, " ".join(sorted(e.attributes.get("class", "").split()))]
        for c in e.children:
            if isinstance(c, Element):
                parts.append(f"<{c.number}>")
                if shapes[-1] != (shape := f"<{c.shape}>"):
                    shapes.append(shape)
                e.letters, e.linked, e.links = e.letters + c.letters, e.linked + c.linked, e.links + c.links
            elif words := " ".join(c.split()):
                parts.append(words)
                e.letters += len(words) - words.count(" ")
        if e.tag == "a":
            e.linked, e.links = e.letters, 1
        e.number, e.shape = _hashed(parts), _hashed(shapes)
    return element.number


def is_menu(element: Element) -> bool:
    """Whether a subtree is mostly links: at least two, with three quarters of its text."""
    return element.links > 1 and 4 * element.linked >= 3 * element.letters > 0


def unseen(element: Element) -> bool:
    """Whether HTML itself says that it is something else than main text, or not shown."""
    if not element.attributes:
        return element.tag in NOT_TEXT
    if element.tag in NOT_TEXT or "hidden" in element.attributes or element.attributes.get("aria-hidden") == "true":
        return True
    style = element.attributes.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style


def named_aside(element: Element) -> bool:
    """Whether its tag, class, id or role says that it is something else than main text."""
    if unseen(element):
        return True
    if not element.attributes or element.tag in ("body", "html", "main"):
        return False
    if element.tag == "article":
        return begins_with(element, REMARK)
    return not ASIDE.isdisjoint(aside_words(element))


def aside_words(element: Element) -> set[str]:
    """The words of its class, id and role. Those of a sentence or heading count only where they are the whole name."""
    names = " ".join(element.attributes.get(k, "") for k in ("class", "id", "role")).split()
    words: set[str] = set()
    for name in names:
        own = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
        if own and own[0] not in ABOUT and (len(own) == 1 or element.tag not in SENTENCES):
            words.update(own)
    return words


def begins_with(element: Element, words: set[str]) -> bool:
    """Whether a name in its class, id or role begins with one of the words."""
    names = " ".join(element.attributes.get(k, "") for k in ("class", "id", "role")).lower().split()
    return any(re.match(r"[a-z]*", name).group() in words for name in names)


def is_main(element: Element) -> bool:
    return element.tag == "main" or element.attributes.get("role") == "main"


def is_article(element: Element) -> bool:
    return element.tag == "article" or element.attributes.get("role") == "article"


def outermost(root: Element, match) -> list[Element]:
    """Elements under this one that match and are in no other that does, nor in something else than main text."""
    found, stack = [], [root]
    while stack:
        e = stack.pop()
        if e is not root and match(e):
            found.append(e)
        elif not named_aside(e) or e is root:
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]
    return found


def prose(root: Element, without: list[Element]) -> int:
    """Characters of the sentences and headings under an element, but for those in some others."""
    skipped, size, stack = {id(e) for e in without}, 0, [(root, False)]
    while stack:
        x, inside = stack.pop()
        if isinstance(x, str):
            size += sum(map(len, x.split())) if inside else 0
        elif x is root or not (id(x) in skipped or named_aside(x)):
            stack += [(c, inside or x.tag in SENTENCES) for c in x.children]
    return size


def content(root: Element) -> list[Element]:
    """The main parts of a page: its main elements, or the articles in them if they have no prose besides, and
    articles elsewhere; without a main element the articles, if they have at least half of the prose; else
    the body; else all. Comments are no such articles, cards only where there is nothing else."""

    def articles(scope: Element) -> list[Element]:
        own = outermost(scope, lambda e: is_article(e) and not begins_with(e, CARD))
        return own or (outermost(scope, is_article) if not prose(scope, outermost(scope, is_article)) else [])

    if outermost(root, is_main):
        parts = []
        for e in outermost(root, lambda e: is_main(e) or is_article(e) and not begins_with(e, CARD)):
            inner = articles(e) if is_main(e) else []
            every = outermost(e, is_article)
            parts += inner if inner and not prose(e, every) else [e]
        return parts
    found = articles(root)
    if found and 2 * prose(root, found) <= prose(root, []):
        return found
    return outermost(root, lambda e: e.tag == "body") or [root]


def candidates(root: Element) -> Iterator[tuple[Element, bool]]:
    """Elements that may belong to a template, with whether they are in an article or main element: those with a
    subtree, but no prose inside an article or main."""
    stack = [(root, False)]
    while stack:
        e, inside = stack.pop()
        for c in e.children:
            if isinstance(c, Element):
                within = inside or c.tag in ("article", "main")
                if c.tag not in VOID and c.tag in BLOCK and c.tag not in ("body", "article", "main") and not (
                    inside and c.tag in PROSE
                ):
                    yield c, inside
                stack.append((c, within))


def recurrences(root: Element) -> Iterator[tuple[int, Element, bool]]:
    """The hash values that are counted for a page, with their elements and whether they are those of a shape."""
    for e, inside in candidates(root):
        yield numbered(e), e, False
        if not inside and is_menu(e):
            yield e.shape, e, True


def body_number(root: Element) -> int:
    """What stands for a page when pages are counted: equal main parts are equal pages."""
    parts = [numbered(e) for e in content(root)]
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little", signed=True)


def read(page: str) -> Element:
    """The page's elements. A container that only a word of layout names as something else, but that holds most
    sentences of the main or article element it is in, or of a page without any, loses its names."""
    root = tree(page)
    for scope in outermost(root, lambda e: is_main(e) or is_article(e) and not begins_with(e, CARD)) or [root]:
        found = outermost(scope, lambda e: e.tag != "article" and not unseen(e) and named_aside(e) and (
            aside_words(e) & ASIDE <= LAYOUT
        ))
        sizes = [prose(e, []) for e in found]
        whole = prose(scope, []) + sum(sizes) if found else 0
        for e, size in zip(found, sizes):
            if 2 * size > whole:
                e.attributes = {k: v for k, v in e.attributes.items() if k not in ("class", "id", "role")}
    return root


def text_of(root: Element, template: set[int]) -> str:
    """Blocks of the page's main parts, one a line, without subtrees of the template."""
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        if words := " ".join("".join(line).split()):
            blocks.append(words)
        line.clear()

    parts = content(root)
    prunable = set()
    if template:
        found = [(e, shape) for number, e, shape in recurrences(root) if number in template]
        prunable = {id(e) for e, shape in found if not shape}
        menus = [e for e, shape in found if shape]
        if menus and any(prose(part, menus) for part in parts):
            prunable |= {id(e) for e in menus}
    for part in parts:
        stack: list = [part]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                line.append(x)
            elif x.tag == "br":
                line.append(" ")
            elif x is part or not (named_aside(x) or id(x) in prunable):
                if x.tag in BLOCK or x is part:
                    end()
                    stack.append(None)
                stack += reversed(x.children)
        end()
    return "\n".join(blocks)


def host_of(url: str | None) -> str:
    """The host of a URL in lower case, without port and www; empty without one."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", url or "")
    return m.group(1).lower().removeprefix("www.") if m else ""


def _numbers(with_body: bool):
    """A step over batches of key, url and html: the hash values of each page's subtrees."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hosts, numbers = [], [], []
            for key, url, page in zip(batch["key"].to_pylist(), batch["url"].to_pylist(), batch["html"].to_pylist()):
                root = read(page or "")
                found = {number for number, _, _ in recurrences(root)}
                keys += [body_number(root) if with_body and found else key] * len(found)
                hosts += [host_of(url)] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64() if with_body else pa.binary()), pa.array(hosts, pa.string()),
                    pa.array(numbers, pa.int64()),
                ],
                names=["body" if with_body else "key", "host", "number"],
            )

    return step


def extracted(
    pages: DataFrame, least: int = LEAST, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row page_id, url, text and n_chars (code points of the text).

    A null html is empty and has an empty text. A null url, or one without a host, belongs to the host with the
    empty name. Null ids stay null, repeated rows are rows of their own but one page when pages are
    counted, an empty table gives no rows, further columns are ignored.

    Templates go to the pages in a broadcast if their counted rows are at most `broadcast_bytes`. Beyond it each page
    looks up its own subtrees, and pages are joined with what they found by a hash of their content, so no task
    has a host's pages or templates. Both ways give the same texts.
    """
    rows = picked(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))
    # Distinct before counting: the second step's rows are one for each host, subtree and body of a task.
    seen = rows.select(F.lit(None).cast("binary").alias("key"), "url", "html").mapInArrow(
        _numbers(True), "body long, host string, number long"
    ).distinct()
    counted = seen.groupBy("host", "number").count().filter(F.col("count") >= least).select("host", "number")
    counted = written(counted, "html-subtrees")
    bytes_ = counted.select(F.sum(F.octet_length("host") + SUBTREE_BYTES)).first()[0] or 0
    if bytes_ <= broadcast_bytes:
        templates = counted.groupBy("host").agg(F.collect_list("number").alias("template"))
        host = F.lower(F.regexp_extract(
            F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1
        ))
        host = F.regexp_replace(host, r"^www\.", "")
        known = rows.withColumn("host", host).join(F.broadcast(templates), "host", "left")
    else:
        keyed = rows.withColumn("key", F.unhex(F.sha2(F.concat_ws(
            "\u0000", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
        ), 256)))
        own = written(
            keyed.select("key", "url", "html").mapInArrow(_numbers(False), "key binary, host string, number long"),
            "html-pages",
        )
        found = split_join(own, counted, [("host", "host"), ("number", "number")], "left_semi")
        found = found.groupBy("key").agg(F.collect_set("number").alias("template"))
        known = split_join(keyed, found, [("key", "key")], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, template in zip(batch["html"].to_pylist(), batch["template"].to_pylist()):
                texts.append(text_of(read(page or ""), set(template or ())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return known.select("page_id", "url", "html", "template").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long"
    )
