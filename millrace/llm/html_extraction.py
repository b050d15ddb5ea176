"""Main text of web pages by deducing each host's template.

Tokens of a page are its tags and blocks of words, each with the path of open
block elements it stands in. Over the pages of one host, tokens with equal
occurrence vectors (how often each page has them) form an equivalence class; a
vector is summed up by adding a hash of (page, count) over the pages, so classes
come out of one grouped sum and no host is ever gathered. Equal pages of a host
count as one page.

The classes that occur in nearly every page are candidates of the template. A
class is valid in so far as its tokens keep their order and lie in one gap of the
widest class around them: on every page the class's sequence is compared with that
of a page which all its tokens share, tokens outside the longest common order or
in another gap than usual get a mark, and tokens marked on more than 5 % of their
pages leave the class. What valid classes do not cover is a slot; slots hold the
page's own text.

Hosts with few pages cannot tell a template by themselves. Their pages are pooled
over hosts by shape (the set of paths with text), with equal pages counted once.
Pools and hosts of fewer than ``LEAST_PAGES`` different pages have no template: their
repeated words may be the article's own, so nothing is cut there.

A slot belongs to the article when its path runs through the article region and
through no element that tags, roles, classes and ids show to be furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments). The article region
is the element named as such (article, main); on pages without one it is the element
of the template that holds the most slot text. Inside the region a name never decides
on a heading, and on a paragraph, item or cell only if the element recurs on the
host's pages.

Markup is read as browsers do: scripts and the like end at their own end tag only,
a quote opens a value only behind ``=``, attributes are read one after the other.
Character references are decoded, white space in a block becomes one space,
blocks are joined by one space in page order. Cut-off markup is read as far as it
goes.

A page is parsed once, into a file of packed blocks; html is in no exchange.

Cases: null and empty html give ""; null urls are one host; repeated pages stay;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

LEAST_PAGES = 8
COMMON = 0.9
TEMPLATE_WORDS = 0.95

# Names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript iframe noembed noframes xmp textarea title".split())  # text up to their end tag
SKIPPED = set("template svg object math canvas".split())
TEXTUAL = set("p blockquote pre li dt dd tr td th caption figure figcaption summary address".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE_TAGS = set("nav footer aside form button select option dialog menu head".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_FURNITURE = re.compile(
    r"(?:^|[-_ ])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|overlay|"
    r"newsletter|subscribe|share|sharing|social|related|recommend\w*|comments?|respond|replies|disqus|login|signup|search|form|widget|pagination|pager|toolbar|skip|copyright|legal)(?:$|[-_ ])")
_MAIN = re.compile(r"(?:^|[-_ ])(?:article|main|content|post|entry|story|article-?body|post-?content|entry-?content|main-?content)(?:$|[-_ ])")
_OWN = re.compile(r"(?:^|[-_ ])(?:article|main|post|entry|story)(?:$|[-_ ])")
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_SLASH_IN_VALUE = re.compile(r"=\s*[^\s\"'>][^\s>]*/$")
_SPACE = re.compile(r"\s+")
_CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}


def _hash(text: str, seed: int = 1) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed % 2**64) - (1 << 63)


@dataclass
class Page:
    """The text blocks of a page in order, and the tree of their paths."""

    parents: list[int] = field(default_factory=lambda: [-1])   # by path; a parent comes before its children
    paths: list[int] = field(default_factory=lambda: [_hash("")])
    depths: list[int] = field(default_factory=lambda: [0])
    at: list[int] = field(default_factory=list)                # by block: its path,
    main: list[int] = field(default_factory=list)              # how sure it is that it stands in the article (-1: furniture),
    doubt: list[int] = field(default_factory=list)             # the path that is furniture if it recurs (-1: none),
    texts: list[str] = field(default_factory=list)             # and its words

    def __post_init__(self):
        self.known: dict[tuple[int, str], int] = {}

    def path(self, parent: int, label: str) -> int:
        found = self.known.get((parent, label))
        if found is None:
            found = self.known[parent, label] = len(self.parents)
            self.parents.append(parent)
            self.paths.append(_hash(label, self.paths[parent]))
            self.depths.append(self.depths[parent] + 1)
        return found


class Element:
    __slots__ = ("name", "path", "furniture", "main", "doubt", "skipped", "block")

    def __init__(self, name: str, attributes: dict[str, str], top: "Element | None", page: Page):
        self.name = name
        if top is None:
            self.path, self.furniture, self.main, self.doubt, self.skipped, self.block = 0, False, 0, -1, False, self
            return
        self.skipped = top.skipped or name in SKIPPED
        if name in INLINE or self.skipped:
            self.path, self.furniture, self.main, self.doubt, self.block = top.path, top.furniture, top.main, top.doubt, top.block
            return
        self.block = self
        marks = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().strip()
        role = attributes.get("role", "").lower()
        self.path = page.path(top.path, name + ("." + ".".join(marks.split()[:2]) if marks else ""))
        if name in ("article", "main") or role in ("main", "article") or attributes.get("itemprop") == "articleBody":
            own_main = 2
        else:
            own_main = 1 if marks and _MAIN.search(marks) else 0
        odd = name in FURNITURE_TAGS or role in FURNITURE_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
        odd |= name == "header" and top.main < 2
        # An article may be a reader's comment or an advert, unless it is named as the page's own.
        own = bool(_OWN.search(marks)) if name in ("article", "main") else own_main > 0
        named = bool(marks) and name not in ("html", "body") and not own and bool(_FURNITURE.search(marks))
        self.doubt = top.doubt
        if named and top.main:
            if name in TEXTUAL:
                named, self.doubt = False, self.doubt if self.doubt >= 0 else self.path
            elif name in HEADINGS:
                named = False
        self.furniture = top.furniture or odd or named
        self.main = max(top.main, 0 if self.furniture else own_main)


def _attributes(tag: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _end_of(name: str, source: str, start: int) -> int:
    """Where the end tag of a raw element begins; without one the rest of the page is inside."""
    found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, start)
    return found.start() if found else len(source)


def parsed(source: str | None) -> Page:
    page = Page()
    root = Element("", {}, None, page)
    open_, names, text, where = [root], Counter(), [], root
    source, start = source or "", 0

    def flush() -> None:
        if text:
            words = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if words:
                page.at.append(where.path)
                page.main.append(-1 if where.furniture else where.main)
                page.doubt.append(where.doubt)
                page.texts.append(words)
            text.clear()

    def close(at: int) -> None:
        for e in open_[at:]:
            names[e.name] -= 1
        del open_[at:]

    while start < len(source):
        mark = _MARKUP.search(source, start)
        end = mark.start() if mark else len(source)
        if end > start and not open_[-1].skipped:
            if not text:
                where = open_[-1].block
            text.append(source[start:end])
        if mark is None:
            break
        start = mark.end()
        if mark[2] is None:
            continue  # comments, doctypes
        name, tail = mark[2].lower(), mark[3]
        if name not in INLINE and name not in RAW and name not in SKIPPED and not open_[-1].skipped:
            flush()
        if mark[1]:
            if names[name]:
                close(next(i for i in range(len(open_) - 1, 0, -1) if open_[i].name == name))
            continue
        if name in VOID:
            continue
        alone = tail.endswith("/") and not _SLASH_IN_VALUE.search(tail)
        if name in RAW:
            if not alone:
                start = _end_of(name, source, start)
            continue
        if name in _CLOSES_P or name in _CLOSES:
            closed = {"p"} if name in _CLOSES_P else _CLOSES[name]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].name in closed:
                    close(i)
                    break
                if open_[i].name not in INLINE:
                    break
        if not alone:
            open_.append(Element(name, _attributes(tail), open_[-1], page))
            names[name] += 1
    flush()
    return page


def words_hash(path: int, text: str) -> int:
    return _hash(text, path + 2**63 + 1)


def tokens(page: Page) -> dict[int, list]:
    """By token (hash of a path, or of words in their path): occurrences, first place, characters of
    slot candidates, whether it is a path, the path above, whether the path is in doubt."""
    found: dict[int, list] = {}
    for place, (at, main, doubt, text) in enumerate(zip(page.at, page.main, page.doubt, page.texts, strict=True)):
        for token, path, size in ((page.paths[at], at, len(text) if main >= 0 else 0), (words_hash(page.paths[at], text), -1, 0)):
            x = found.setdefault(token, [0, place, 0, path >= 0, page.paths[page.parents[at]] if path > 0 else 0, False])
            x[0] += 1
            x[2] += size
        if doubt >= 0:
            found.setdefault(page.paths[doubt], [1, place, 0, True, page.paths[page.parents[doubt]], True])[5] = True
    return found


def _host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_TOKENS = "array<struct<token: long, n: long, place: long, chars: long, tag: boolean, up: long, doubt: boolean>>"
_PACKED = ("page_id long, url string, host long, page long, shape long, parents array<int>, paths array<long>, depths array<int>, at array<int>, main array<int>,"
           f" doubt array<int>, texts array<string>, tokens {_TOKENS}")
_TOKEN_FIELDS = ("token", "n", "place", "chars", "tag", "up", "doubt")


def packed(pages: DataFrame) -> DataFrame:
    """Every page, parsed."""
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.xxhash64(F.lit("host"), _host()).alias("host"), F.xxhash64("html").alias("page"), F.col("html").cast("string").alias("html"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            read = [parsed(h) for h in rows["html"]]
            out = rows[["page_id", "url", "host", "page"]].copy()
            out["shape"] = [_hash(",".join(map(str, sorted({p.paths[i] for i in p.at})))) for p in read]
            for name in ("parents", "paths", "depths", "at", "main", "doubt", "texts"):
                out[name] = [getattr(p, name) for p in read]
            out["tokens"] = [[dict(zip(_TOKEN_FIELDS, (t, *x), strict=True)) for t, x in tokens(p).items()] for p in read]
            yield out

    return source.mapInPandas(each, _PACKED)


def _different(read: DataFrame) -> DataFrame:
    """group, page, tokens: the different pages of every host, and of every shape over all hosts."""
    groups = read.select(F.explode(F.array("host", "shape")).alias("group"), "page", "tokens")
    return groups.groupBy("group", "page").agg(F.first("tokens").alias("tokens"))


def candidates(different: DataFrame) -> DataFrame:
    """group and tokens that may be its template, as structs (token, class, place on the class's common page, support), the
    paths in doubt that recur, and the path above the one with the most text."""
    sizes = written(different.groupBy("group").agg(F.count(F.lit(1)).alias("all_pages")).filter(F.col("all_pages") >= LEAST_PAGES), "hosts")
    sums = different.select("group", "page", F.explode("tokens").alias("t")).groupBy("group", "t.token").agg(
        F.expr("pmod(sum(shiftright(xxhash64(page, t.n), 12)), 9007199254740992)").alias("vector"), F.count(F.lit(1)).alias("pages"),
        F.min(F.struct("page", "t.place")).alias("common"), F.sum("t.chars").alias("chars"), F.max("t.tag").alias("tag"), F.max("t.up").alias("up"), F.max("t.doubt").alias("doubt"))
    shared = sums.filter("pages > 1").join(sizes, "group").filter(F.col("pages") >= F.col("all_pages") * F.lit(1 - COMMON))
    skeleton = ~F.col("tag") & (F.col("pages") >= F.col("all_pages") * F.lit(TEMPLATE_WORDS))
    return shared.groupBy("group").agg(
        F.collect_list(F.when(skeleton, F.struct("token", "vector", F.col("common.place").alias("place"), F.col("pages").alias("support")))).alias("words"),
        F.collect_list(F.when(F.col("doubt"), F.col("token"))).alias("recurring"),
        F.max(F.when(F.col("tag"), F.struct("chars", "up")))["up"].alias("up"))


def out_of_order(sequence: list[int]) -> set[int]:
    """Places of a sequence of different numbers that its longest increasing part leaves out."""
    tails, at, before = [], [], []
    for i, x in enumerate(sequence):
        k = bisect_left(tails, x)
        before.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(x)
            at.append(i)
        else:
            tails[k], at[k] = x, i
    left, i = set(range(len(sequence))), at[-1] if at else -1
    while i >= 0:
        left.discard(i)
        i = before[i]
    return left


def marks(places: dict[int, int], words: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(token, gap, out of order) of one page: ``places`` by token, ``words`` as in ``candidates``.

    The gap is the token of the widest class that stands before it.
    """
    widest = max(((s, c) for _, c, _, s in words), default=None)
    by_class: dict[tuple[int, int], list] = {}
    for token, vector, place, support in words:
        if token in places:
            by_class.setdefault((support, vector), []).append((places[token], place, token))
    for own in by_class.values():
        own.sort()
    around = sorted(by_class.get(widest, []))
    loose = {key: out_of_order([place for _, place, _ in own]) for key, own in by_class.items()}
    around = [x for i, x in enumerate(around) if i not in loose[widest]]
    for key, own in by_class.items():
        for i, (at, _, token) in enumerate(own):
            gap = 0
            if key != widest:
                k = bisect_right(around, (at,)) - 1
                gap = around[k][2] if k >= 0 else 0
            yield token, gap, i in loose[key]


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        total: dict[tuple[int, int, int], list] = {}
        for group, places, words in zip(rows["group"], rows["places"], rows["words"], strict=True):
            found = {p["token"]: p["place"] for p in places}
            for token, gap, loose in marks(found, [(w["token"], w["vector"], w["place"], w["support"]) for w in words]):
                x = total.setdefault((group, token, gap), [0, 0])
                x[0] += 1
                x[1] += loose
        yield pd.DataFrame([(*k, *x) for k, x in total.items()], columns=["group", "token", "gap", "n", "loose"])


def templates(read: DataFrame) -> DataFrame:
    """group, the tokens of its valid classes with the recurring paths in doubt (``cut``), and the path that holds most text (``up``)."""
    different = written(_different(read), "different", "zstd")
    found = written(candidates(different), "candidates")
    words_of = found.select("group", "words").filter(F.size("words") > 0)
    places = F.transform(F.filter("tokens", lambda t: ~t["tag"]), lambda t: F.struct(t["token"].alias("token"), t["place"].alias("place")))
    marked = different.select("group", places.alias("places")).join(words_of, "group").mapInPandas(_marked, "group long, token long, gap long, n long, loose long")
    gaps = marked.groupBy("group", "token", "gap").agg(F.sum("n").alias("n"), F.sum("loose").alias("loose"))
    valid = gaps.groupBy("group", "token").agg(F.max("n").alias("usual"), F.sum("n").alias("n"), F.sum("loose").alias("loose")).filter(
        (F.col("usual") >= F.col("n") * F.lit(TEMPLATE_WORDS)) & (F.col("loose") <= F.col("n") * F.lit(1 - TEMPLATE_WORDS)))
    kept = valid.groupBy("group").agg(F.collect_list("token").alias("kept"))
    return found.join(kept, "group", "left").select(
        "group", F.concat(F.coalesce("kept", F.array().cast("array<long>")), "recurring").alias("cut"), "up")


def article(page: Page, cut: set[int], up: int | None) -> str:
    """The slots of the article region, joined."""
    slots = [
        (at, main, text) for at, main, doubt, text in zip(page.at, page.main, page.doubt, page.texts, strict=True)
        if main >= 0 and words_hash(page.paths[at], text) not in cut and (doubt < 0 or page.paths[doubt] not in cut)]
    sure = max((main for _, main, _ in slots), default=0)
    if not sure and slots:
        inside = _region(page, slots, up)
        slots = [s for s in slots if inside[s[0]]]
    return " ".join(text for _, main, text in slots if main == sure)


def _region(page: Page, slots: list[tuple[int, int, str]], up: int | None) -> list[bool]:
    """By path, whether it lies in the innermost one that holds most of the text, found from the template or on the page itself."""
    size = [0] * len(page.parents)
    for at, _, text in slots:
        size[max(page.parents[at], 0)] += len(text)
    for i in range(len(size) - 1, 0, -1):
        size[page.parents[i]] += size[i]
    whole = sum(len(t) for *_, t in slots)
    best = max((i for i, n in enumerate(size) if n >= 0.6 * whole), key=lambda i: page.depths[i], default=0)
    if up is not None:
        outer = next((i for i, h in enumerate(page.paths) if h == up), -1)
        if outer >= 0 and size[outer] >= 0.5 * whole and page.depths[outer] < page.depths[best]:
            best = outer
    inside = [False] * len(size)
    for i, parent in enumerate(page.parents):
        inside[i] = i == best or parent >= 0 and inside[parent]
    return inside


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        texts = []
        for row in rows.itertuples(index=False):
            page = Page(*(x.tolist() for x in (row.parents, row.paths, row.depths, row.at, row.main, row.doubt, row.texts)))
            texts.append(article(page, set(row.cut.tolist()) if row.cut is not None else set(), None if pd.isna(row.up) else int(row.up)))
        yield pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": texts})


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    read = written(packed(pages), "pages", "zstd")
    found = written(templates(read), "templates")
    own = found.select(F.col("group").alias("host"), F.struct("cut", "up").alias("own"))
    pooled = found.select(F.col("group").alias("shape"), F.struct("cut", "up").alias("pooled"))
    joined = read.drop("tokens", "page").join(own, "host", "left").join(pooled, "shape", "left").withColumn("best", F.coalesce("own", "pooled"))
    return joined.select("page_id", "url", "parents", "paths", "depths", "at", "main", "doubt", "texts", "best.cut", "best.up").mapInPandas(_extracted, "page_id long, url string, text string")
