"""Main text of web pages by differencing a page with its nearest neighbour.

Pages of a host are sorted by URL path; a page's neighbour is the one beside it
with the longer common path prefix, which in this order is the nearest of all by
that measure.  The text lines of both are aligned by longest common subsequence, and lines that both share
are template text and deleted.  Markup says more where it can: lines inside
menus, headers, adverts and the like go even when no neighbour has them, and
lines inside an article element stay where a neighbour only quotes them: they go
if they are also on at least half of the host's pages.

The sort is by range partitions, so a hot host is cut into many; the rows at
partition edges get their neighbours from a table of one row per partition.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .url_filter import host as url_host
from .url_filter import path as url_path

# Element names of HTML by role
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
CHROME = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
MAIN = frozenset("article main".split())
# Words of class, id and role values that mark page furniture, and those that mark the article
CHROME_WORDS = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer form gdpr header hidden login masthead menu modal nav navbar navigation "
    "newsletter notice notification pager pagination popup promo related replies reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split())
MAIN_WORDS = frozenset("article main".split())
EXEMPT = frozenset("html body article main".split())

COPY_SHARE = 0.9      # a neighbour with this share of a page's own text is a copy of it, not its template
COMMON_SHARE = 0.5    # lines on this share of a host's distinct pages are its furniture, not quotes ...
COMMON_PAGES = 3      # ... if so many pages have them, and the hosts with them do so on average

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_OPEN_END = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_MARK = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_WORDS = re.compile(r"[a-z]+")
CHROME_LINE, PLAIN_LINE, MAIN_LINE = 0, 1, 2


def _marks(attributes: str) -> set[str]:
    found: set[str] = set()
    for m in _MARK.finditer(attributes):
        found.update(_WORDS.findall((m[1] or m[2] or m[3] or "").lower()))
    return found


def lines(html: str | None) -> list[tuple[str, int]]:
    """Text lines of a page in order, each a block with white space folded,
    and the kind markup gives it.  Scripts, styles and other raw elements hold
    no lines.  An element left open ends with the page; a cut-off tag is dropped."""
    if not html:
        return []
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []     # name, chrome and main depth outside it
    chrome = main = at = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, CHROME_LINE if chrome else MAIN_LINE if main else PLAIN_LINE))

    end = len(html)
    cut = html.rfind("<")
    if cut >= 0 and _OPEN_END.match(html, cut):
        end = cut
    search = _TAG.search
    while True:
        m = search(html, at, end)
        if m is None:
            parts.append(html[at:end])
            break
        if m.start() > at:
            parts.append(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, attributes = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            if name in BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    _, chrome, main = stack[i]
                    del stack[i:]
                    break
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th", "option"):
            parts.append(" ")
        if name in RAW:
            closing = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at, end)
            at = closing.end() if closing else end
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        marks = _marks(attributes) if "=" in attributes else ()
        is_main = name in MAIN or (bool(marks) and not MAIN_WORDS.isdisjoint(marks))
        is_chrome = name in CHROME or name not in EXEMPT and (
            bool(marks) and not CHROME_WORDS.isdisjoint(marks) or bool(attributes and _HIDDEN.search(attributes)))
        if is_main or is_chrome or name in BLOCKS:
            stack.append((name, chrome, main))
            chrome += is_chrome
            main += is_main
    flush()
    return out


def aligned(a: list, b: list) -> set[int]:
    """Places of ``a`` in one longest common subsequence with ``b``.  Bit-parallel
    rows; large tables are halved first, so memory stays bounded."""
    found: set[int] = set()
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.add(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.add(a1)
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) <= 1 << 26 or a1 - a0 == 1:
            found.update(_rows(a, a0, a1, b, b0, b1))
            continue
        mid = (a0 + a1) // 2
        front = _lengths(a[a0:mid], b[b0:b1])
        back = _lengths(a[mid:a1][::-1], b[b0:b1][::-1])
        n = b1 - b0
        split = b0 + max(range(n + 1), key=lambda j: front[j] + back[n - j])
        work += [(a0, mid, b0, split), (mid, a1, split, b1)]
    return found


def _places(b: list) -> dict:
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    return places


def _step(row: int, match: int, full: int) -> int:
    both = row & match
    return ((row + both) | (row - both)) & full


def _rows(a: list, a0: int, a1: int, b: list, b0: int, b1: int) -> list[int]:
    places, full = _places(b[b0:b1]), (1 << (b1 - b0)) - 1
    rows = [full]
    for i in range(a0, a1):
        rows.append(_step(rows[-1], places.get(a[i], 0), full))
    out, i, j = [], a1 - a0, b1 - b0
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(a0 + i)
    return out


def _lengths(a: list, b: list) -> list[int]:
    """Length of the common subsequence of ``a`` with each prefix of ``b``."""
    places, full = _places(b), (1 << len(b)) - 1
    row = full
    for x in a:
        row = _step(row, places.get(x, 0), full)
    out, n = [0], 0
    for bit in bin(row | 1 << len(b))[3:][::-1]:
        n += bit == "0"
        out.append(n)
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def shared_lines(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, digest, shared)`` for each distinct html of a host: for every line
    1 if the nearest neighbour of another html has it aligned, 2 if it is also common on the host, else 0.
    Equal html of one host is one class, placed at its smallest path, so that copies never delete each other."""
    keyed = pages.select(url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
                         F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))

    def parse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [[_hash(t) for t, _ in lines(h)] for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(rows, pa.list_(pa.int64()))],
                names=["host", "path", "digest", "lines"])

    parsed = keyed.select("host", "path", "html", "digest").mapInArrow(
        parse, "host string, path string, digest string, lines array<bigint>")
    classes = parsed.groupBy("host", "digest").agg(F.min("path").alias("path"), F.any_value("lines").alias("lines"))
    place = ["host", "path", "digest"]
    blocks = stored(classes.repartitionByRange(*place).withColumn("block", F.spark_partition_id()), "page-lines")
    # lines common on a host, at most twice as many as its pages have on average, and not rare on the other hosts with them
    counts = blocks.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("held"))
    sizes = blocks.groupBy("host").agg(F.count("*").alias("n"))
    counts = stored(counts.join(sizes, "host"), "line-counts")
    often = F.col("held") >= COMMON_SHARE * F.col("n")
    spread = counts.groupBy("line").agg(F.sum("held").alias("held"), F.sum("n").alias("n")).where(often).select("line")
    common = counts.where((F.col("held") >= COMMON_PAGES) & often).join(spread, "line").groupBy("host").agg(
        F.collect_list("line").alias("common"))
    # each block borrows the last row of the block before and the first of the one after
    row = F.struct(*place, "lines")
    ends = blocks.groupBy("block").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    beside = Window.orderBy("block")      # one row a block
    ends = ends.select("block", F.lag("last").over(beside).alias("before"), F.lead("first").over(beside).alias("after"))
    ghosts = ends.select("block", F.explode(F.array("before", "after")).alias("g")).where("g is not null").select(
        "g.*", "block", F.lit(True).alias("ghost"))
    inside = Window.partitionBy("block").orderBy(*place)
    around = blocks.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    other = F.struct("host", "path", "lines")
    around = around.withColumns({"p": F.lag(other).over(inside), "n": F.lead(other).over(inside)}).where("not ghost")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        host, common = None, frozenset()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["host"] != host:
                    host, common = r["host"], frozenset(r["common"] or ())
                near = [x for x in (r["p"], r["n"]) if x and x["host"] == r["host"]]
                mine, hit = r["lines"], set()
                if near:
                    best = max(near, key=lambda x: _common_prefix(x["path"], r["path"]))
                    hit = aligned(mine, best["lines"])
                out.append([(1 + (x in common)) * (i in hit) for i, x in enumerate(mine)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int8()))], names=["host", "digest", "shared"])

    return around.join(common, "host", "left").select("host", "digest", "path", "lines", "p", "n", "common").mapInArrow(
        compare, "host string, digest string, shared array<tinyint>")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(key, url, text, n_chars, n_shared, n_differenced)`` per row of ``pages``: the main text,
    its blocks joined by a blank line, the number of lines that the neighbour shares, and of
    those that were deleted for that alone, which markup had kept.

    Kept are the lines inside an article where the page marks one, without those that the neighbour
    shares and that are common on the host (an article of nearly nothing else is a copied one and stays whole).
    Elsewhere the lines are kept that are neither furniture nor shared; where the neighbour holds nearly all
    of a page's own text it is a copy and deletes only what is common on the host.  Null or empty html gives an empty text, a null URL belongs to the empty
    host.  Repeated rows and null keys are kept.
    """
    kind = pages.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(key, url, url_host(F.col(url)).alias("host"), F.sha1(body).alias("digest"), body.alias("html"))

    def parse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        line = pa.struct([("text", pa.string()), ("kind", pa.int8())])
        for batch in batches:
            parsed = [[{"text": t if k else "", "kind": k} for t, k in lines(h)] for h in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(parsed, pa.list_(line))],
                names=[key, url, "host", "digest", "lines"])

    parsed = rows.mapInArrow(parse, f"`{key}` {kind}, `{url}` string, host string, digest string, "
                                    "lines array<struct<text:string, kind:tinyint>>")
    joined = parsed.join(shared_lines(pages, url, html), ["host", "digest"])
    marked = F.zip_with("lines", "shared", lambda x, s: F.struct(
        x["text"].alias("text"), x["kind"].alias("kind"), s.alias("shared")))

    def length_of(which) -> Column:
        return F.aggregate(F.filter("marked", which), F.lit(0), lambda n, x: n + F.length(x["text"]))

    own = length_of(lambda x: x["kind"] > CHROME_LINE)
    same = length_of(lambda x: (x["kind"] > CHROME_LINE) & (x["shared"] > 0))
    article = length_of(lambda x: x["kind"] == MAIN_LINE)
    furniture = length_of(lambda x: (x["kind"] == MAIN_LINE) & (x["shared"] == 2))
    has_main = F.exists("marked", lambda x: x["kind"] == MAIN_LINE)
    is_copy = F.col("same") >= COPY_SHARE * F.col("own")
    is_copied = F.col("furniture") >= COPY_SHARE * F.col("article")
    kept = F.filter("marked", lambda x: (x["kind"] == MAIN_LINE) & ((x["shared"] < 2) | F.col("is_copied")) | (
        (x["kind"] == PLAIN_LINE) & ~F.col("has_main") & ((x["shared"] == 0) | (x["shared"] == 1) & F.col("is_copy"))))
    by_markup = lambda x: (x["kind"] == MAIN_LINE) | (x["kind"] == PLAIN_LINE) & ~F.col("has_main")
    text = F.array_join(F.transform(kept, lambda x: x["text"]), "\n\n")
    return (joined.select(key, url, marked.alias("marked"))
            .withColumns({"own": own, "same": same, "article": article, "furniture": furniture, "has_main": has_main})
            .withColumns({"is_copy": is_copy, "is_copied": is_copied})
            .select(key, url, text.alias("text"),
                    F.size(F.filter("marked", lambda x: x["shared"] > 0)).cast("bigint").alias("n_shared"),
                    (F.size(F.filter("marked", by_markup)) - F.size(kept)).cast("bigint").alias("n_differenced"))
            .select(key, url, "text", F.length("text").cast("bigint").alias("n_chars"), "n_shared", "n_differenced"))
