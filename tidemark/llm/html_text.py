"""Main text of web pages: site templates are the element subtrees that recur on a host.

Pass 1 parses each page and gives the subtrees of its block elements two hashes: an exact one (names and words), and
one of its shape (place in the page, element and class names with digits masked, whether it is mostly links; no
words), as menus, adverts and footers recur with other words on each page. Spark counts on how many different pages of
a host each hash occurs and how many the host has; a subtree on a large share of them is template. Pass 2 parses again
and deletes the page's subtrees that are. Shapes count outside the main element or article; on pages that have
neither, only for lists of links that hold at most half of the page's words, as there stories recur in shape too.
Exact hashes count outside the main element, and inside it for what isn't prose or bears a telling name. Paragraphs,
headings and other prose inside the main element are not deleted for recurring: a passage that many pages quote is
text, not template; outside it, long prose goes only if nearly all pages of the host have it.

What counts can't show (hosts of few pages, a part that few pages have) falls to names: elements of the frame
(navigation, footer, form), and classes whose last telling word is one of MARKS (`site-footer`, `google-ads`). Where
such a word only qualifies another (`share-price`, `notice-period`) the element stays if it holds a sentence.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import settle, small_batches

#: Fixed values of HTML: elements without content, with raw content, that begin a block, that are never main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
SKIP = set("head nav header footer aside form menu script style noscript template iframe object svg canvas button select textarea input dialog xmp title".split())
#: Words of class, id or role that mark what isn't main text, and words that turn such a mark into another's (fixed values).
MARKS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside related recommended widget share sharing social cookie cookies consent notice notices alert popup modal newsletter subscribe subscription signup login search pagination pager comment comments respond reply replies discussion disqus toolbar contentinfo complementary".split())
#: Words of names that say nothing of the contents (fixed values).
PLAIN = set("site page post posts article articles entry story blog news main top bottom left right list section area box block wrapper wrap container inner outer item items link links bar button buttons icon icons group row col column content body text title heading slot zone unit panel module thread form global mobile desktop js".split())
#: Elements that are never text, whatever counts or names say (fixed values).
UNSEEN = set("head script style noscript template iframe object svg canvas xmp title".split())
NOT_MARKS = {"has", "with", "no", "without", "not", "non", "layout"}
ENDS_P = BLOCKS - {"caption", "legend", "option", "optgroup", "html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}
#: An opening tag closes open ones of these, up to the nearest barrier.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
#: Elements of running text: prose however short, if most of it isn't links.
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)([^'\">]*(?:(?:\"[^\"]*\"|'[^']*')[^'\">]*)*|[^>]*)>|[!?][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
RAW_ENDS = {tag: re.compile(rf"</{tag}", re.I) for tag in RAW}
#: A template is on this share of its host's different pages and on so many at least; long prose outside the main element on
#: nearly all of them. Prose inside it has so many words outside links; long prose so many.
MIN_PAGES, SHARE, PROSE_SHARE = 5, 0.3, 0.8
PROSE_WORDS, LONG_WORDS = 12, 50
#: A sentence has so many words outside links and one of these at the end of a run of text.
SENTENCE_WORDS, STOPS = 4, frozenset(".!?\u2026\u3002\uff01\uff1f")
#: Pages with more copies than this, and than this share of all, get their list by broadcast: 10,000 lists at most.
COPIES, COPIES_SHARE = 256, 1e-4


class Node:
    __slots__ = ("tag", "marks", "children")

    def __init__(self, tag: str, marks: tuple = ()):
        self.tag, self.marks, self.children = tag, marks, []


def marks_of(attributes: str) -> tuple:
    """Names in class, id and role, lower-cased; `hidden` for what isn't shown."""
    if not attributes or attributes.isspace():
        return ()
    found = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        found += ["hidden"] if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value == "true") else value.split()
    return tuple(found)


def parse(page: str) -> Node:
    """A forgiving tree: unclosed elements end with their parent, stray end tags are dropped. One pass
    forward: behind the last > no tag is looked for, and a tag that isn't open isn't searched."""
    root = Node("#root")
    stack, at, n, last = [root], 0, len(page), page.rfind(">")
    opened: Counter[str] = Counter()

    def close(k: int) -> None:
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    while at < n:
        m = TAG.search(page, at) if at <= last or page.find("<!", at) >= 0 or page.find("<?", at) >= 0 else None
        if m is None:
            cut = next((x.start() for x in re.finditer(r"<[A-Za-z/!?]", page[at:])), -1)
            # markup that the page's end cuts off isn't text
            rest = page[at:] if cut < 0 else page[at : at + cut]
            if rest:
                stack[-1].children.append(entities.unescape(rest))
            break
        if m.start() > at:
            stack[-1].children.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag in ENDS_P and opened["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in CLOSES and any(opened[x] for x in CLOSES[tag][0]):
            ended, barrier = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in barrier:
                    break
                if stack[k].tag in ended:
                    close(k)
                    break
        node = Node(tag, marks_of(m[4]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = RAW_ENDS[tag].search(page, at)
            stop = page.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else n
        elif tag not in VOID and not m[4].rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root


@lru_cache(maxsize=10_000)
def mark(name: str) -> int:
    """2 if a class, id or role names what isn't main text (`ad`, `site-footer`, `comments_list`), 1 if it only has such a
    word beside a later one (`share-price`), 0 otherwise and for what speaks of the page around it (`has-sidebar`)."""
    parts = re.split(r"[^a-z0-9]+", name)
    if MARKS.isdisjoint(parts) or not NOT_MARKS.isdisjoint(parts):
        return 0
    telling = [x for x in parts if x and x not in PLAIN and not any(c.isdigit() for c in x)]
    return 2 if telling and telling[-1] in MARKS else 1


@lru_cache(maxsize=10_000)
def kind(tag: str, marks: tuple) -> bytes:
    """Element and class names, with digits masked."""
    return re.sub(r"\d+", "0", f"{tag} {' '.join(sorted(set(marks)))}").encode("utf-8", "surrogatepass")


@lru_cache(maxsize=10_000)
def below(place: bytes, tag: str, marks: tuple) -> bytes:
    """Hash of the names from the page's top down to an element."""
    return xxhash.xxh64(place + kind(tag, marks)).digest()


class Page:
    """A parsed page: nodes in order, and for each the words of its text, of those in links, whether it is in the main
    element, and the hashes by which it may be template. Each step is one pass over the nodes, up or down, as broken
    pages can nest thousands deep."""

    def __init__(self, page: str):
        self.root = parse(page)
        self.nodes, self.parent, stack = [], [], [(self.root, -1)]
        while stack:
            x, up = stack.pop()
            k = len(self.nodes)
            self.nodes.append(x), self.parent.append(up)
            stack.extend((c, k) for c in reversed(x.children) if isinstance(c, Node))
        n = len(self.nodes)
        self.kids: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            self.kids[self.parent[k]].append(k)
        self.words, self.linked, self.shown, self.stops = [0] * n, [0] * n, [0] * n, [False] * n
        for k in range(n - 1, -1, -1):
            x, own = self.nodes[k], 0
            for c in x.children:
                if isinstance(c, str) and (found := c.split()):
                    own += len(found)
                    self.stops[k] = self.stops[k] or found[-1][-1] in STOPS
            self.words[k] += own
            self.linked[k] = self.words[k] if x.tag == "a" else self.linked[k]
            self.shown[k] = 0 if k and x.tag not in ("form", "header", "aside") and self.unwanted(k) else self.shown[k] + own
            if k:
                up = self.parent[k]
                self.words[up] += self.words[k]
                self.linked[up] += self.linked[k]
                self.shown[up] += self.shown[k]
                self.stops[up] = self.stops[up] or self.stops[k]
        self.anchors = self._anchors()
        self.around, self.inside = [k in self.anchors for k in range(n)], [k in self.anchors for k in range(n)]
        for k in range(n - 1, 0, -1):  # what holds the main element is never unwanted
            self.around[self.parent[k]] |= self.around[k]
        for k in range(1, n):
            self.inside[k] |= self.inside[self.parent[k]]
        self.exact, self.shape = self._hashes()

    def unwanted(self, k: int) -> bool:
        """Whether names tell that this isn't main text."""
        x = self.nodes[k]
        if x.tag in SKIP or "hidden" in x.marks:
            return True
        if not x.marks or x.tag in ("html", "body", "article", "main"):
            return False
        most = max(map(mark, x.marks))
        return most == 2 or most == 1 and not self.sentence(k)

    def sentence(self, k: int) -> bool:
        """Running text by its words, whatever the element."""
        free = self.words[k] - self.linked[k]
        return free >= self.linked[k] and (free >= PROSE_WORDS or free >= SENTENCE_WORDS and self.stops[k])

    def prose(self, k: int) -> bool:
        """Running text rather than a part of the site's frame."""
        if self.linked[k] * 2 > self.words[k]:
            return False
        return self.nodes[k].tag in PROSE or self.words[k] - self.linked[k] >= PROSE_WORDS

    def _outermost(self, tag: str) -> list[int]:
        """Elements of this name that show words and aren't in another of that name, nor in an unwanted part, forms and headers aside."""
        barred = [False] * len(self.nodes)
        out = []
        for k, x in enumerate(self.nodes):
            up = self.parent[k]
            barred[k] = k > 0 and (barred[up] or self.nodes[up].tag == tag or x.tag in SKIP - {"form", "header", "aside"} or "hidden" in x.marks)
            if x.tag == tag and not barred[k] and self.shown[k]:
                out.append(k)
        return out

    def _anchors(self) -> set[int]:
        """The main elements, else the article of most words and those that are no mere teasers beside it; none if there is
        neither. An article in a marked part (related, comments) is only taken if no other is there."""
        if found := self._outermost("main"):
            return set(found)
        if not (found := self._outermost("article")):
            return set()
        beside = [False] * len(self.nodes)  # in a marked part of less than half of the page's words
        for k in range(1, len(self.nodes)):
            up = self.parent[k]
            beside[k] = beside[up] or self.words[up] * 2 < self.words[0] and any(map(mark, self.nodes[up].marks))
        clear = [k for k in found if not beside[k]] or found
        most = max(self.shown[k] for k in clear)
        return {k for k in clear if self.shown[k] * 4 >= most or not beside[k]}

    def _hashes(self) -> tuple[dict[int, int], dict[int, int]]:
        """Exact hash and shape of each block that may be template by it. Only what lies in such a block is hashed."""
        exact, shape, n = set(), set(), len(self.nodes)
        needed = [False] * n
        for k in range(1, n):
            x = self.nodes[k]
            if x.tag in BLOCKS and x.tag not in ("html", "head", "body") and not self.around[k] and self.words[k]:
                if not self.inside[k]:
                    if not self.anchors or self.around[self.parent[k]]:  # within such a part shapes tell enough
                        exact.add(k)
                    if self.anchors or self.linked[k] * 2 > self.words[k] and self.words[k] * 2 <= self.words[0]:
                        shape.add(k)
                elif not self.prose(k) or any(map(mark, x.marks)):
                    exact.add(k)
            needed[k] = needed[self.parent[k]] or k in exact or k in shape
        place = [b""] * n
        for k in range(1, n):
            if not self.inside[k]:
                place[k] = below(place[self.parent[k]], self.nodes[k].tag, self.nodes[k].marks)
        whole, masked = [b""] * n, [b""] * n
        for k in range(n - 1, 0, -1):
            if not needed[k]:
                continue
            x, inner = self.nodes[k], iter(self.kids[k])
            h = xxhash.xxh64(f"{x.tag} {' '.join(x.marks)}".encode("utf-8", "surrogatepass"))
            for c in x.children:
                h.update(" ".join(c.split()).encode("utf-8", "surrogatepass") if isinstance(c, str) else whole[next(inner)])
            whole[k] = h.digest()
            parts = {masked[i]: None for i in self.kids[k]}  # each shape once: menus differ in length
            parts.pop(b"", None)
            if x.tag in BLOCKS or x.tag == "a" or parts:
                named = kind(x.tag, x.marks) if x.tag in BLOCKS or x.tag == "a" else b""
                masked[k] = xxhash.xxh64(named + (b"\1" if self.linked[k] * 2 > self.words[k] else b"\0") + b"".join(parts)).digest()
        return {k: xxhash.xxh64_intdigest(whole[k]) for k in exact}, {k: xxhash.xxh64_intdigest(b"shape" + place[k] + masked[k]) for k in shape}

    def candidates(self) -> dict[int, bool]:
        """Exact hash and shape of each subtree that may be template -> whether it is long prose."""
        out: dict[int, bool] = {}
        for found in (self.exact, self.shape):
            for k, h in found.items():
                out[h] = out.get(h, False) or self.words[k] - self.linked[k] >= LONG_WORDS
        return out

    def blocks(self, template: set[int], names: bool = True) -> list[str]:
        """Text of the main elements (of all, if there is none) in page order without template and unwanted
        parts, one string for each block. Without `names` counts alone decide on the whole page: neither the main element
        bounds the text nor do the names of the frame remove any; scripts and the like are no text either way."""
        out: list[str] = []
        part: list[str] = []

        def close() -> None:
            if text := " ".join("".join(part).split()):
                out.append(text)
            part.clear()

        def gone(k: int) -> bool:
            return (self.unwanted(k) if names else self.nodes[k].tag in UNSEEN) or self.exact.get(k) in template or self.shape.get(k) in template

        for root in (sorted(self.anchors) if names else None) or [0]:
            stack: list = [root]
            while stack:
                k = stack.pop()
                if k is None:
                    close()
                elif isinstance(k, str):
                    part.append(k)
                elif k == root or self.around[k] or not gone(k):
                    x, inner = self.nodes[k], iter(self.kids[k])
                    if x.tag == "br":
                        part.append(" ")
                    elif x.tag in BLOCKS:
                        close()
                        stack.append(None)
                    stack.extend(reversed([c if isinstance(c, str) else next(inner) for c in x.children]))
            close()
        return out


def host(url: str | None) -> str:
    """Lower-case host without user, port and a leading www.; '' if there is none."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return (m[1].lower().removeprefix("www.")) if m else ""


def host_column(url: str) -> Column:
    """`host` as a column."""
    return F.regexp_replace(F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))), r"^www\.", "")


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host and content (hashes of both, signed)."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.withColumns({"host": F.xxhash64(host_column("url")), "content": F.xxhash64("html")})


def subtrees(rows: DataFrame) -> DataFrame:
    """host, content, subtree, long of each different page's candidates, and one row with subtree null for the page itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, contents, found, long = [], [], [], []
            for h, c, page in zip(*[x.to_pylist() for x in b.columns]):
                for x, y in {None: False, **Page(page).candidates()}.items():
                    hosts.append(h), contents.append(c), found.append(x if x is None else x - (1 << 64) if x >> 63 else x), long.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((hosts, contents, found, long), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], ["host", "content", "subtree", "long"])

    return rows.where("html <> ''").select("host", "content", "html").mapInArrow(run, "host long, content long, subtree long, long boolean").distinct()


def templates(seen: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, subtree: what is on a large share of its host's different pages. Pages with the same html count once, or a
    page listed often would be its own template."""
    counts = seen.groupBy("host", "subtree").agg(F.count("*").alias("n"), F.max("long").alias("long")).where(F.col("n") >= min_pages)
    every = counts.where("subtree is null").select("host", F.col("n").alias("every"))
    share = F.when(F.col("long"), PROSE_SHARE).otherwise(SHARE)
    return counts.where("subtree is not null").join(every, "host").where(F.col("n") >= share * F.col("every")).select("host", "subtree")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text. Null or empty html gives an empty text; a null url counts as a host of its
    own; repeated rows come back as often; other columns aren't read; an empty table gives no rows.

    Each different page's own templates come to it as a list, joined by host and content, for which html is moved once at
    every size: lists grow with the pages. Contents with many copies are few, and their lists are broadcast, so that no
    task gathers the copies of a page."""
    small_batches(pages.sparkSession)
    rows = keyed(pages)
    seen, _ = settle(subtrees(rows), "subtrees")
    lists, _ = settle(seen.join(templates(seen, min_pages), ["host", "subtree"], "left_semi").groupBy("host", "content").agg(F.collect_list("subtree").alias("drops")), "drops")
    key = ["host", "content"]
    copies = rows.groupBy(*key).count()
    many = F.broadcast(settle(copies.where(F.col("count") > F.greatest(F.lit(COPIES), F.lit(rows.count() * COPIES_SHARE))).select(*key), "copies")[0])
    light = rows.join(many, key, "left_anti").join(lists.hint("merge"), key, "left")
    heavy = rows.join(F.broadcast(many.join(lists, key, "left")), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = ["\n\n".join(Page(page).blocks({x % (1 << 64) for x in drops or ()})) if page else "" for page, drops in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.string())], ["page_id", "url", "text"])

    columns = ["page_id", "url", "html", "drops"]
    return light.select(*columns).unionByName(heavy.select(*columns)).mapInArrow(run, "page_id long, url string, text string")
