"""Main text of web pages by site template removal.

Every page is parsed into elements and each subtree (tag, class, id, text and
children) is hashed; Spark counts in how many pages of a host each hash occurs,
and subtrees recurring across many pages of their host are deleted as template.
Inside the main element these are boxes (``BOXES``) that hold no more than half
of its letters, and only occurrences whose parents differ count: copied articles
recur with the same parts around them.  Lone paragraphs, headings, items and
cells inside the main element stay, since stories share those as well.  Menus, forms, scripts and the like go by their
element or class; every block that is left is text, in the main element or not.
Main are the outermost ``article`` and ``main`` elements: they and what holds
them are never deleted, and a ``header`` inside them stays.

A host's template list is bounded by its threshold: with a share ``MIN_SHARE``
of a host's pages needed, it holds at most (subtrees per page / MIN_SHARE)
hashes, whatever the host's size.

Defined cases: null and empty html give an empty text; a page whose url has no
host shares the empty host; repeated pages each count and each get a row;
unclosed, mis-nested and cut-off markup is closed at its parent's end; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, materialize, read_table

MIN_PAGES = 8
MIN_SHARE = 0.01
BROADCAST_HASHES = 200_000
INSIDE = 0x5BF0_3635_DCF5_9A17

#: Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark meter output "
                   "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INLINE_OR_P = INLINE | {"p"}
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table "
                     "ul".split())
SCOPES = frozenset("html table td th caption button object template".split())
DROPPED = frozenset("script style template head title nav footer aside form button select option datalist textarea "
                    "input iframe object embed svg canvas audio video menu dialog noscript noembed noframes "
                    "xmp applet map search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                  "toolbar".split())
BOILER = frozenset("ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored "
                   "promo promotion banner sidebar menu nav navbar navigation topnav breadcrumb breadcrumbs footer "
                   "cookie cookies consent gdpr notice notices notification alert comment comments commentlist "
                   "respond reply replies disqus share sharing social related recommended newsletter subscribe "
                   "subscription signup login popup modal overlay widget widgets toolbar pagination pager "
                   "masthead skip".split())
BOXES = frozenset("address center details div dl fieldset figure hgroup ol section table ul".split())
NEGATED = frozenset("has no with without is not".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
            "thead": ("tbody", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select", "datalist"), "tbody": ("table",), "thead": ("table",),
         "tfoot": ("table",)}

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
                   r"|<[!?/][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)()[^<>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "names", "role", "parts", "drop", "main", "holds", "hash")

    def __init__(self, tag: str, names: str = "", role: str = ""):
        self.tag, self.names, self.role = tag, names, role
        self.parts: list = []
        self.drop = self.main = self.holds = False
        self.hash = 0


def _boiler(names: str) -> bool:
    """Whether a class or id names a part of the page that is not the article."""
    for name in names.lower().split():
        words = _NAME.findall(name)
        if words and words[0] not in NEGATED and any(w in BOILER for w in words):
            return True
    return False


def parse(page: str) -> Element:
    """The element tree; text stays undecoded in ``parts`` between child elements."""
    root = Element("#root")
    stack, at, seek = Open([root]), 0, 0
    last, final = page.rfind(">"), page.rfind("<")
    while (seek := page.find("<", seek)) >= 0:
        if seek > last and seek != final and not page.startswith(("<!", "<?", "</"), seek):
            # nothing closes a tag any more; only these and the final one end with the page
            seek += 1
            continue
        m = _PART.match(page, seek)
        if m is None:
            seek += 1
            continue
        if seek > at:
            stack[-1].parts.append(page[at:seek])
        at = seek = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            _end(stack, tag)
            continue
        found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m[3] or "")} if m[3] else {}
        new = Element(tag, f"{found.get('class', '')} {found.get('id', '')}".strip(), found.get("role", "").lower())
        if tag in CLOSES_P:
            _close_open(stack, ("p",), SCOPES)
        if tag in SIBLINGS:
            _close_open(stack, SIBLINGS[tag], frozenset(HOLDS[tag]))
        stack[-1].parts.append(new)
        if tag in VOID or (m[3] or "").rstrip().endswith("/") and tag not in INLINE | CLOSES_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            new.parts.append(page[at:end.start() if end else len(page)])
            at = seek = end.end() if end else len(page)
            continue
        stack.push(new)
    if at < len(page):
        stack[-1].parts.append(page[at:])
    return root


class Open(list):
    """The open elements, outermost first, with a count of each tag."""

    def __init__(self, elements=()):
        super().__init__(elements)
        self.counts = Counter(e.tag for e in self)

    def push(self, e: Element) -> None:
        self.append(e)
        self.counts[e.tag] += 1

    def cut(self, k: int) -> None:
        self.counts.subtract(e.tag for e in self[k:])
        del self[k:]


def _close_open(stack: Open, tags, stop) -> None:
    """Close the outermost open element of ``tags`` above the nearest of ``stop``."""
    found, left = 0, sum(stack.counts[t] for t in tags)
    for k in range(len(stack) - 1, 0, -1):
        if not left:
            break
        if stack[k].tag in tags:
            found, left = k, left - 1
        elif stack[k].tag in stop:
            break
    if found:
        stack.cut(found)


def _end(stack: Open, tag: str) -> None:
    if not stack.counts[tag]:
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            stack.cut(k)
            return
        if tag in INLINE_OR_P and stack[k].tag not in INLINE_OR_P:
            return


def _all(root: Element, into_main: bool = True):
    """Elements with their parents, parents first, without recursion."""
    todo = [(root, None)]
    while todo:
        e, up = todo.pop()
        yield e, up
        if into_main or not e.main:
            todo.extend((x, e) for x in reversed(e.parts) if type(x) is Element)


def study(page: str) -> tuple[Element, bool]:
    """The tree with main and dropped elements marked, and whether it has a main element."""
    root = parse(page)
    order = list(_all(root))
    return root, _mark(order)


def hash_subtrees(root: Element) -> list[tuple[int, int | None]]:
    """(hash, hash of the parent) of the boxes inside the main elements, and (hash, None) of
    all subtrees that hold text outside them and what holds them.  Both kinds differ in hash."""
    order = list(_all(root))
    own: dict[int, list] = {id(e): [] for e, _ in order}
    whole, size, bare = {}, {id(e): 0 for e, _ in order}, set()
    for e, up in reversed(order):
        text = " ".join(" ".join(x for x in e.parts if type(x) is str).split())
        seen = (e.tag, e.names, text, tuple(reversed(own.pop(id(e)))))
        whole[id(e)] = int.from_bytes(hashlib.blake2b(repr(seen).encode("utf-8", "surrogatepass"), digest_size=8)
                                      .digest(), "big", signed=True)
        if not (text or seen[3]):
            bare.add(id(e))
        size[id(e)] += 0 if e.drop else len(text)
        if up is not None:
            own[id(up)].append(whole[id(e)])
            size[id(up)] += 0 if e.drop else size[id(e)]
    found = set()
    main: dict[int, Element | None] = {}
    for e, up in order:
        within = main[id(e)] = e if e.main else main[id(up)] if up is not None else None
        e.hash = whole[id(e)]
        if e.main or within and (e.tag not in BOXES or e.drop):
            e.hash = 0
        elif within:
            e.hash ^= INSIDE
            if id(e) not in bare and 2 * size[id(e)] <= size[id(within)]:
                found.add((e.hash, whole[id(up)]))
        elif not e.holds and e.tag not in ("#root", "html", "body", "head") and id(e) not in bare:
            found.add((e.hash, None))
    return sorted(found, key=lambda x: (x[0], x[1] or 0))


def hash_outside(root: Element) -> list[int]:
    """Hashes of the subtrees that hold text, outside the main element and what holds it."""
    return [h for h, up in hash_subtrees(root) if up is None]


def _mark(order) -> bool:
    """Set ``main``, ``holds`` (it holds a main element) and ``drop``."""
    mains = [e for e, _ in order if e.tag == "main" or e.role == "main" or e.tag == "article" and not _boiler(e.names)]
    parent = {id(e): up for e, up in order}
    for e in mains:
        e.main = True
    for e in mains:
        up = parent[id(e)]
        while up is not None and not up.main:
            up.holds = True
            up = parent[id(up)]
        if up is not None:
            e.main = False
    within: dict[int, bool] = {}
    for e, up in order:
        within[id(e)] = inside = e.main or (up is not None and within[id(up)])
        if e.main or e.holds or e.tag in ("#root", "html", "body"):
            continue
        e.drop = e.tag in DROPPED or e.role in ROLES or bool(e.names and _boiler(e.names)) \
            or (e.tag == "header" and not inside)
    return bool(mains)


def blocks(root: Element, mains: bool, template: frozenset[int]) -> str:
    """The blocks of the page without dropped and template subtrees, joined by an empty line."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            out.append(text)
    # a todo entry is a text, an element to open, or None to end a block
    todo: list = [root]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif type(x) is str:
            line.append(x)
        elif x.drop or (x.hash and not x.holds and x.hash in template):
            if x.tag not in INLINE:
                flush()
        elif x.tag == "br":
            line.append(" ")
        else:
            if x.tag not in INLINE:
                flush()
                todo.append(None)
            todo.extend(reversed(x.parts))
    flush()
    return "\n\n".join(out)


SUBTREES = pa.schema([("host", pa.string()), ("hash", pa.int64()), ("parent", pa.int64())])
TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _subtrees():
    def work(batch: pa.RecordBatch) -> dict:
        hosts, hashes, parents = [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for h, parent in hash_subtrees(study(page)[0]) if page else ():
                hosts.append(host)
                hashes.append(h)
                parents.append(parent)
        return {"host": hosts, "hash": hashes, "parent": parents}
    return work


def _texts():
    def work(batch: pa.RecordBatch) -> dict:
        texts = []
        for page, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            root, mains = study(page or "")
            if known:
                hash_subtrees(root)
            texts.append(blocks(root, mains, frozenset(known or ())))
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": list(map(len, texts))}
    return work


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per host the subtree hashes that recur in enough of its pages, those inside main
    elements in as many different parents."""
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages"))
    each = pages.select("host", "html").mapInArrow(arrow_rows(_subtrees, SUBTREES, 512),
                                                   "host string, hash long, parent long")
    found = each.groupBy("host", "hash", "parent").agg(F.count("*").alias("n")) \
        .groupBy("host", "hash").agg(F.sum(F.when(F.col("parent").isNull(), F.col("n")).otherwise(1)).alias("n")) \
        .where(F.col("n") >= min_pages)
    many = found.join(sizes, "host").where(F.col("n") >= min_share * F.col("pages"))
    return materialize(many.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("hashes")), "templates")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html",
            min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per page: page_id, url, main text and its length."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(page).cast("string").alias("html")).withColumn("host", host)
    known = templates(slim, min_pages, min_share)
    held = known.agg(F.sum(F.size("hashes"))).first()[0] or 0
    side = F.broadcast(known) if held <= BROADCAST_HASHES else known
    joined = slim.join(side, "host", "left").select("page_id", "url", "html", "hashes")
    return joined.mapInArrow(arrow_rows(_texts, TEXTS, 512), "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(read_table(spark, sf_dir, "pages"))
