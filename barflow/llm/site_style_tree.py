"""Main text of web pages by site style trees."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from barflow.llm.common import lookup, salts, slices
from barflow.session import staged

#: Weight of what lies below a node against its own layout, for each node below.
GAMMA = 0.9
#: Pages of a site that must have a node before its importance counts; others are taken as important.
LEAST_PAGES = 2
#: A branch goes if its importance is below this, and below half of that of the page's longest block,
LOW, AGAINST = 0.3, 0.5
#: and if it has no more than this share of the text.
SMALL = 0.3
#: Nodes of all sites that may be sent to every task; beyond it pages meet their nodes in a join.
SENT_NODES = 200_000
#: Distinct observations that a task sums before it passes them on.
HELD = 300_000

# Fixed values of HTML: elements without content, with raw text, and those that break lines.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg xmp noembed noframes".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary
    table tbody td tfoot th thead tr ul""".split())
#: A start tag ends these open elements, up to an element that holds them.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "body": {"head"}}
HOLDS = set("ul ol dl table div section article main body select td th aside nav form blockquote".split())
# Roles of branches that are not the article: by element, by role, by a word of class or id.
NEVER_TAGS = set("head button select input object canvas audio video datalist".split()) | RAW
APART_TAGS = set("nav footer aside form dialog menu".split())
APART_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
APART_WORDS = set("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie
    cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination
    popup promo promoted related replies reply respond rss share sharing sidebar signup skip social sponsor sponsored
    subscribe toolbar widget widgets""".split())
#: Words that change nothing about a role beside them, and words that deny it.
NEUTRAL_WORDS = set("""area bar block bottom box button buttons column container footer form global group header holder inner item
    items left links list main outer panel post primary right secondary section site top wrap wrapper""".split())
DENYING_WORDS = set("has is no non not with without".split())
#: A branch with a sign of such a role goes if the text without any sign is this part of the branch's own text.
SURE, UNSURE = 0.1, 1.0

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)",
    re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: The end of an element without content; the slash of an unquoted value is part of the value.
_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*\Z""")


class Page:
    """The elements of a page in page order: tag, attributes, parent, and children (numbers, or text)."""

    def __init__(self, html: str):
        self.tag, self.attributes, self.parent, self.kids = ["#page"], [{}], [-1], [[]]
        self._read(html)

    def _add(self, parent: int, tag: str, rest: str) -> int:
        at = len(self.tag)
        known = {}
        if "=" in rest or "hidden" in rest:
            for name, value in _ATTRIBUTE.findall(rest):
                known[name.lower()] = value.strip("\"'")
        self.tag.append(tag), self.attributes.append(known), self.parent.append(parent), self.kids.append([])
        self.kids[parent].append(at)
        return at

    def _read(self, html: str) -> None:
        stack, at, lower = [0], 0, None
        tag, kids = self.tag, self.kids
        while True:
            m = _TAG.search(html, at)
            text = html[at: m.start() if m else len(html)]
            if text:
                kids[stack[-1]].append(entities.unescape(text) if "&" in text else text)
            if m is None:
                return
            at = m.end()
            closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if closing:
                for depth in range(len(stack) - 1, 0, -1):
                    if tag[stack[depth]] == name:
                        del stack[depth:]
                        break
                continue
            self._end_implied(stack, name)
            node = self._add(stack[-1], name, rest)
            if name in RAW:
                lower = lower or html.lower()
                end = lower.find(f"</{name}", at) if len(lower) == len(html) else html.find(f"</{name}", at)
                at = len(html) if end < 0 else end
                stack.append(node)
            elif name not in VOID and not _CLOSED.search(rest):
                stack.append(node)

    def _end_implied(self, stack: list[int], name: str) -> None:
        """A new block ends an open paragraph; items, rows and cells end the one before them."""
        ends = ENDS.get(name, set())
        for depth in range(len(stack) - 1, 0, -1):
            open_ = self.tag[stack[depth]]
            if open_ in ends or (open_ == "p" and name in BLOCK):
                del stack[depth:]
                if open_ == "p":
                    return self._end_implied(stack, name)
            elif open_ in HOLDS:
                return


def site_of(url: str | None) -> str:
    """The host of an address in lower case; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _look(page: Page, i: int) -> str:
    """How an element presents itself: its tag, class, id and role, without numbers."""
    a = page.attributes[i]
    return page.tag[i] if not a else re.sub(r"\d+", "", f"{page.tag[i]}.{a.get('class', '')}#{a.get('id', '')}@{a.get('role', '')}")


def place(page: Page, site: str) -> tuple[list[int], list[int], list[int | None]]:
    """Where a page's elements lie in the tree of its site: node, style below it and content, as 64-bit numbers.

    A node is a place in the sequence of looks below its parent; equal neighbours are one place, so pages with
    more or fewer paragraphs share a style. Content is the direct text and the targets of links and images.
    """
    n = len(page.tag)
    nodes, styles, contents = [0] * n, [0] * n, [None] * n
    nodes[0] = xxhash.xxh64_intdigest(site) >> 1
    for i in range(n):
        looks, of = [], []
        text = []
        for kid in page.kids[i]:
            if isinstance(kid, str):
                text.append(kid)
                continue
            look = _look(page, kid)
            if not looks or looks[-1] != look:
                looks.append(look)
            of.append((kid, len(looks)))
        styles[i] = xxhash.xxh64_intdigest("\n".join(looks), nodes[i]) >> 1
        for kid, number in of:
            nodes[kid] = xxhash.xxh64_intdigest(f"{number} {looks[number - 1]}", styles[i]) >> 1
        own = " ".join("".join(text).split())
        a = page.attributes[i]
        target = a.get("href") or a.get("src") or ""
        if own or target:
            contents[i] = xxhash.xxh64_intdigest(f"{own}\n{target}") >> 1
    return nodes, styles, contents


NODE, STYLE, CONTENT = 0, 1, 2
_SEEN = "node bigint, kind int, value bigint, pages bigint, total bigint, logs double"


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pages of a task show of the trees, summed."""
    held: dict[tuple[int, int, int], list] = {}

    def out():
        keys = list(held)
        rows = [[k[i] for k in keys] for i in range(3)] + [[held[k][i] for k in keys] for i in range(3)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)],
                                          names=["node", "kind", "value", "pages", "total", "logs"])

    for batch in slices(batches):
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            nodes, styles, contents = place(Page(html or ""), site_of(url))
            seen = Counter((n, CONTENT, c) for n, c in zip(nodes, contents) if c is not None)
            once = {(n, NODE, 0) for n in nodes} | {(n, STYLE, s) for n, s in zip(nodes, styles)}
            for key, c in [*seen.items(), *((k, 1) for k in once)]:
                known = held.setdefault(key, [0, 0, 0.0])
                known[0] += 1
                known[1] += c
                known[2] += c * math.log(c)
        if len(held) > HELD:
            yield out()
            held = {}
    if held:
        yield out()


def importances(pages: DataFrame) -> DataFrame:
    """``node, layout, content``: importances of the tree nodes that enough pages of a site share.

    With m pages that have a node, ``layout`` is the entropy to base m of the styles below it, and ``content`` is
    1 less the mean entropy to base m of each of its contents over the pages: 0 for what all pages repeat, 1
    for what only one has. Sites may hold any share of the pages: all sums are by node and value first.
    """
    seen = pages.select("url", "html").mapInArrow(_observed, _SEEN).groupBy("node", "kind", "value").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum("logs").alias("logs"))
    of = lambda kind, c: F.sum(F.when(F.col("kind") == kind, c))
    sums = seen.groupBy("node").agg(
        of(NODE, F.col("pages")).alias("m"), of(STYLE, F.col("pages")).alias("n"),
        of(STYLE, F.col("pages") * F.log("pages")).alias("nlogn"),
        of(CONTENT, F.log("total") - F.col("logs") / F.col("total")).alias("spread"), of(CONTENT, F.lit(1)).alias("values"))
    base = F.log(F.col("m").cast("double"))
    return sums.filter(F.col("m") >= LEAST_PAGES).select(
        "node", F.greatest(F.lit(0.0), (F.log("n") - F.col("nlogn") / F.col("n")) / base).alias("layout"),
        F.when(F.col("values") > 0, 1 - F.col("spread") / F.col("values") / base).alias("content"))


def _never(page: Page, i: int) -> bool:
    """Whether an element holds nothing that a reader sees as text."""
    tag, a = page.tag[i], page.attributes[i]
    return tag in NEVER_TAGS or bool(a) and (
        "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""))


def _sign(page: Page, i: int, in_article: bool) -> float | None:
    """How sure an element's tag, role, class or id is that its branch lies apart from the article; None: no sign.

    A name that is made of role words (and neutral ones) is a sure sign, a role word among others an unsure one, and
    a name that denies the role (``no-comments``, ``with-sidebar``) is none.
    """
    tag, a = page.tag[i], page.attributes[i]
    if tag in APART_TAGS or (tag == "header" and not in_article) or a.get("role", "").lower() in APART_ROLES:
        return SURE
    if not a or tag in ("html", "body", "main"):
        return None
    sign = None
    for name in [*a.get("class", "").split(), a.get("id", "")]:
        words = [w.lower() for w in _NAME.findall(name)]
        roles = set(words) & APART_WORDS or ({"header"} & set(words) if not in_article else set())
        if roles and words[0] not in DENYING_WORDS:
            if set(words) <= roles | APART_WORDS | NEUTRAL_WORDS:
                return SURE
            sign = UNSURE
    return sign


def branches_apart(page: Page) -> list[bool]:
    """Of each element, whether it lies in a branch apart from the article.

    Signs are weighed with text: the branches with a sign are judged from the one with most text down. A
    branch goes if enough text is left without any sign; otherwise it holds what the page has to say, its sign is
    void, and its text counts as text without a sign, but for branches in it that have signs of their own.
    """
    n = len(page.tag)
    inside, out, sign = [False] * n, [False] * n, [None] * n
    marked = [-1] * n  # the nearest element above, or the element itself, that has a sign
    for i in range(1, n):
        p = page.parent[i]
        inside[i] = inside[p] or page.tag[p] in ("article", "main")
        out[i] = out[p] or _never(page, i)
        sign[i] = None if out[i] else _sign(page, i, inside[i])
        marked[i] = marked[p] if sign[i] is None else i
    length = _lengths(page, out)
    clean = [0] * (n + 1)  # text by the nearest sign above it; the last place holds text without one
    for i in range(n):
        if not out[i]:
            clean[marked[i]] += sum(len(k.strip()) for k in page.kids[i] if isinstance(k, str))
    left = clean[-1]
    gone = [False] * n
    for i in sorted((i for i in range(n) if sign[i] is not None), key=lambda i: (-length[i], i)):
        if left >= sign[i] * length[i]:
            gone[i] = True
        else:
            left += clean[i]
    for i in range(1, n):
        out[i] = out[i] or gone[i] or out[page.parent[i]]
    return out


def _lengths(page: Page, out: list[bool]) -> list[int]:
    """Characters of text in each element's branch, without what is out."""
    length = [0] * len(page.tag)
    for i in range(len(page.tag) - 1, -1, -1):
        if not out[i]:
            length[i] += sum(len(k.strip()) for k in page.kids[i] if isinstance(k, str))
            if i:
                length[page.parent[i]] += length[i]
    return length


def main_text(html: str | None, url: str | None, known: Callable[[int], tuple[float, float] | None]) -> tuple[str, int]:
    """The article's text, and how many branches the site's tree removed.

    ``known`` gives layout and content importance of a node, or None for nodes of too few pages.
    """
    if not html:
        return "", 0
    page = Page(html)
    n = len(page.tag)
    out = branches_apart(page)
    length = _lengths(page, out)
    roots = _roots(page, out, length)
    keep = [False] * n
    for i in range(n):
        keep[i] = not out[i] and (i in roots or (i > 0 and keep[page.parent[i]]))
    removed = _remove_low(page, keep, roots, length, place(page, site_of(url))[0], known)
    return _assemble(page, keep, roots), removed


def _roots(page: Page, out: list[bool], length: list[int]) -> set[int]:
    """The outermost articles with text, else main, else the page."""
    for wanted in ("article", "main"):
        found = []
        nested = [False] * len(page.tag)
        for i in range(1, len(page.tag)):
            p = page.parent[i]
            nested[i] = nested[p] or page.tag[p] == wanted
            if page.tag[i] == wanted and not nested[i] and not out[i] and length[i]:
                found.append(i)
        if found:
            return set(found)
    return {0}


def _remove_low(page, keep, roots, length, nodes, known) -> int:
    """Take branches of low importance out of ``keep``.

    A node's importance is its layout's, with weight 1 - GAMMA ** l for l parts below it, and the mean of the
    parts', with the rest; a text is a part with the content's importance.
    """
    n = len(page.tag)
    worth, parts, total = [1.0] * n, [0] * n, [0.0] * n
    own = [0] * n
    for i in range(n - 1, 0, -1):
        if not keep[i]:
            continue
        layout, content = known(nodes[i]) or (1.0, 1.0)
        own[i] = sum(len(k.strip()) for k in page.kids[i] if isinstance(k, str))
        if own[i] or page.tag[i] in ("a", "img"):
            parts[i] += 1
            total[i] += 1.0 if content is None else content
        if parts[i]:
            share = GAMMA ** parts[i] if parts[i] > 1 or not own[i] else 1.0
            worth[i] = (1 - share) * layout + share * total[i] / parts[i]
            p = page.parent[i]
            parts[p] += 1
            total[p] += worth[i]
    kept = [i for i in range(1, n) if keep[i]]
    if not kept:
        return 0
    against = worth[max(kept, key=lambda i: (own[i], -i))]
    whole = sum(length[i] for i in roots)
    removed = 0
    for i in kept:
        p = page.parent[i]
        if i not in roots and not keep[p]:
            keep[i] = False
        elif (i not in roots and page.tag[i] in BLOCK and worth[i] < LOW and worth[i] < AGAINST * against
              and length[i] <= SMALL * whole):
            keep[i] = False
            removed += 1
    return removed


def _assemble(page: Page, keep: list[bool], roots: set[int]) -> str:
    """Blocks in page order, one line each, white space inside a block as one space."""
    blocks, held = [], []

    def flush():
        line = " ".join("".join(held).split())
        if line:
            blocks.append(line)
        held.clear()

    stack: list = sorted(roots, reverse=True)
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            held.append(at)
        elif at < 0:
            flush()
        elif page.tag[at] == "br":
            held.append(" ")
        elif keep[at] or at in roots:
            if page.tag[at] in BLOCK or at in roots:
                flush()
                stack.append(-1)
            stack.extend(k for k in reversed(page.kids[at]) if isinstance(k, str) or keep[k])
    flush()
    return "\n".join(blocks)


_EXTRA = [StructField("text", StringType()), StructField("n_chars", LongType()), StructField("n_removed", LongType())]


def _with_text(batch: pa.RecordBatch, names: list[str], found: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in names), pa.array([t for t, _ in found], pa.string()),
         pa.array([len(t) for t, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())],
        names=[*names, *(f.name for f in _EXTRA)])


def extract(pages: DataFrame, sent_nodes: int = SENT_NODES) -> DataFrame:
    """``page_id, url, text, n_chars, n_removed``: the main text of every page, read whole.

    Null and empty pages have an empty text. A null or malformed address is a site of its own, shared by all
    such pages. Repeated pages are extracted each; extra columns are ignored; an empty table gives no rows.
    Branches whose tag, role, class or id tells that they lie apart (menus, footers, adverts, forms, comments and so
    on) go if enough text is left without them; of the rest, those that the site's style tree shows to be
    repeated, unless the page's main block is repeated as well (copied pages) or they are large.

    The trees' nodes go to every task while they are at most ``sent_nodes``; beyond that each page meets its
    own nodes in a join, in which a node that a third of all pages have is dealt to many tasks.
    """
    spark, base = pages.sparkSession, pages.select("page_id", "url", "html")
    nodes = staged(importances(base), "style-trees")
    n_nodes = nodes.count()
    names = ["page_id", "url"]
    schema = StructType([f for f in base.schema.fields if f.name in names] + _EXTRA)
    if n_nodes <= sent_nodes:
        known = spark.sparkContext.broadcast({r[0]: (r[1], r[2]) for r in nodes.collect()})

        def run(batches):
            for batch in slices(batches):
                yield _with_text(batch, names, [main_text(h, u, known.value.get) for u, h in zip(
                    batch.column("url").to_pylist(), batch.column("html").to_pylist())])

        return base.mapInArrow(run, schema)

    def places(batches):
        for batch in slices(batches):
            rows = [(r, x) for r, u, h in zip(*(batch.column(c).to_pylist() for c in ("row", "url", "html")))
                    for x in set(place(Page(h or ""), site_of(u))[0])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["row", "node"])

    def run_joined(batches):
        for batch in slices(batches):
            found = []
            for u, h, mine in zip(*(batch.column(c).to_pylist() for c in ("url", "html", "nodes"))):
                known = {x["node"]: (x["layout"], x["content"]) for x in mine or ()}
                found.append(main_text(h, u, known.get))
            yield _with_text(batch, names, found)

    keyed = base.withColumn("row", F.xxhash64("page_id", "url", "html"))
    met = keyed.select("row", "url", "html").mapInArrow(places, "row bigint, node bigint").distinct()
    own = lookup(met, nodes, ["node"], F.col("row"), salts(met.count())).groupBy("row").agg(
        F.collect_list(F.struct("node", "layout", "content")).alias("nodes"))
    return keyed.join(own, "row", "left").drop("row").mapInArrow(run_joined, schema)
