"""Main text of web pages by nearest-URL page differencing.

Pages of one host are put in order of their URL path, and each is compared with
the next. A page is cut into lines (the texts of its blocks); the lines of the
two pages are aligned by their longest common subsequence, and lines in the
alignment are shared: menus, notices and footers recur on neighbouring pages,
articles don't. Shared lines are deleted.

Markup says more than a neighbour where it is explicit. Elements for menus,
headers, footers, sidebars, forms, scripts and the like, and elements whose class,
id or role names such a part, adverts or comments, are left out whether shared or
not. Each class and id is read by itself: one like ``no-sidebar`` names nothing, an
element that one names as content stays whatever the others say, and ids of
headings and sections, which are often made from their titles, name nothing. Words
that articles use too (``discussion``, ``related``, ``notice``) prove nothing alone; the
lines under them go only if they are shared. If a page marks its article (``article``,
``main``, or a container named as content), only that is kept, and a line in it counts
as shared boilerplate only if it consists of links or lies under such a word: two
articles may quote the same passage, and a page that repeats its neighbour's article
would else lose all of it. For the same reason a neighbour that shares nearly all
unmarked text proves nothing. What is deleted are the aligned lines themselves, not
others of the same text.

Defined results: null html is an empty page, text "". Pages with a null url form
the host "". Rows are compared by url and html, so rows that repeat both are one
page with one neighbour and each get its text. Character references are decoded,
white space (no-break spaces too) is turned into one space within a block, blocks
are joined by one space in page order.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import successors
from .scratch import free_name, written

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|math)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

# fixed values: elements that are inline, empty, or never part of an article
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUT = frozenset("head nav header footer aside form button select option dialog menu object audio video canvas map".split())
_BLOCK_ENDS = frozenset("p li dt dd td th tr option".split())
_CHROME = frozenset(
    "ad ads adv advert adverts advertisement advertisements sponsor sponsored promo banner sidebar sidebars widget widgets menu menus nav navbar navigation "
    "breadcrumb breadcrumbs masthead topbar footer bottombar cookie cookies consent gdpr popup modal overlay newsletter subscribe signup "
    "signin login comment comments commentlist reply replies respond disqus pagination pager complementary contentinfo dialog".split()
)
#: Words that name such a part too, but also a part of an article; two words of either set in one class or id are clear.
_UNCLEAR = frozenset(
    "header notice notices notification alert discussion share sharing social related recommended recommendations toc skip search form "
    "advertising promotion promoted subscription".split()
)
_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alertdialog alert menu menubar toolbar".split())
_MODIFIERS = frozenset("no not non without with has have hide hidden is".split())
_TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
_CONTENT = frozenset("content article post entry story main maincontent articlebody postbody bodytext".split())
_ARTICLE, _MAIN, _NAMED = 4, 2, 1


@lru_cache(maxsize=4096)
def _named(name: str, attrs: str) -> tuple[bool, bool, bool, bool, bool]:
    """What class, id and role say of an element: left out, perhaps left out, content, main part, hidden."""
    out = perhaps = content = pure = main = hidden = False
    for m in _ATTR.finditer(attrs):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key in ("hidden", "aria-hidden"):
            hidden |= key == "hidden" or value == "true"
            continue
        for token in value.lower().split():
            words = [w for w in _SPLIT.split(token) if w]
            if not words or words[0] in _MODIFIERS:
                continue
            main |= "main" in words and "role" in attrs
            if key == "role":
                out |= token in _ROLES
                content |= token in _CONTENT
                continue
            clear, unclear = sum(w in _CHROME for w in words), sum(w in _UNCLEAR for w in words)
            if clear or unclear:
                if key == "id" and name in _TITLED:
                    continue
                out |= clear > 0 or unclear > 1
                perhaps |= unclear == 1
            elif any(w in _CONTENT for w in words):
                content = True
                pure |= all(w in _CONTENT for w in words)
    if pure or name in ("html", "body") or name in ("article", "main") and content:
        out = perhaps = False
    return out, perhaps, content, main, hidden


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, container, in doubt) of the blocks of a page that markup doesn't rule out.

    In doubt is a block of links only, and one in an element that may be no part of an article.
    """
    lines: list[tuple[str, int, bool]] = []
    buffer: list[str] = []
    linked = plain = 0  # characters in and outside of links
    skip, depth = "", 0  # the element that is left out, and how many of its name are open
    doubt, doubts = "", 0  # the outermost element in doubt, and how many of its name are open
    containers: list[list] = []  # [name, kind, open elements of that name]
    kind = links = 0

    def flush() -> None:
        nonlocal linked, plain
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                lines.append((text, kind, plain == 0 or doubt != ""))
            buffer.clear()
        linked = plain = 0

    for m in _TOKEN.finditer(page):
        text = m.group("text")
        if text is not None:
            if not skip:
                buffer.append(text)
                if text.strip():
                    if links:
                        linked += 1
                    else:
                        plain += 1
            continue
        name = m.group("name") or m.group("name2")
        if name is None:
            continue
        name = name.lower()
        closing = bool(m.group("close") or m.group("close2"))
        if skip:
            if name == skip:
                depth += -1 if closing else 1
                if skip in _BLOCK_ENDS and not closing:
                    depth = 1  # such an element ends where the next begins
                    skip = ""
                elif depth == 0:
                    skip = ""
                    continue
            elif skip in _BLOCK_ENDS and (name not in _INLINE and name not in _VOID):
                skip = ""
            if skip:
                continue
        if name == "a":
            links = 0 if closing else 1
        if name not in _INLINE:
            flush()
        if doubt and name == doubt:
            doubts = doubts - 1 if closing else 1 if name in _BLOCK_ENDS else doubts + 1
            if doubts == 0 or not closing and name in _BLOCK_ENDS:
                doubt = ""
        if closing:
            for k in range(len(containers) - 1, -1, -1):
                if containers[k][0] == name:
                    containers[k][2] -= 1
                    if containers[k][2] == 0:
                        del containers[k:]
                        kind = containers[-1][1] if containers else 0
                    break
            continue
        if name in _VOID:
            continue
        attrs = m.group("attrs") or ""
        out, perhaps, content, role_main, hidden = _named(name, attrs) if attrs else (False, False, False, False, False)
        if name in _OUT or hidden or out:
            flush()
            skip, depth = name, 1
            continue
        if perhaps and not doubt and name not in _INLINE:
            doubt, doubts = name, 1
        if containers and containers[-1][0] == name:
            containers[-1][2] += 1
        found = _ARTICLE if name == "article" else _MAIN if name == "main" or role_main else _NAMED if content and name not in ("html", "body") and name not in _INLINE else 0
        if found:
            if containers and containers[-1][0] == name:
                containers[-1][2] -= 1
            kind |= found
            containers.append([name, kind, 1])
    flush()
    return lines


def chosen(lines: list[tuple[str, int, bool]]) -> tuple[list[int], bool]:
    """Numbers of the lines in the page's article, and whether the markup names one."""
    for flag in (_ARTICLE, _MAIN, _NAMED):
        inside = [k for k, line in enumerate(lines) if line[1] & flag]
        if inside:
            return inside, True
    return list(range(len(lines))), False


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists, as pairs of positions.

    Bit-parallel: one number holds a row of the table, a bit for each place in b.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    out = [(k, k) for k in range(low)] + [(len(a) - 1 - k, len(b) - 1 - k) for k in range(high)]
    where: dict[int, int] = {}
    for k, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << k
    kept = [k for k, v in enumerate(x) if v in where]
    full = (1 << len(y)) - 1
    row, rows = full, []
    for k in kept:
        u = row & where[x[k]]
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    i, j = len(kept) - 1, len(y) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append((low + kept[i], low + j))
            i, j = i - 1, j - 1
    return sorted(out)


#: A neighbour that shares this much of the unmarked text is a copy and proves nothing.
COPY_SHARE = 0.7


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, sizes, links, named = [], [], [], []
        for page in batch.column("html"):
            lines = page_lines(page.as_py() or "")
            inside, marked = chosen(lines)
            hashes.append([xxhash.xxh64_intdigest(lines[k][0]) - (1 << 63) for k in inside])
            sizes.append([len(lines[k][0]) for k in inside])
            links.append([lines[k][2] for k in inside])
            named.append(marked)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(links, pa.list_(pa.bool_())), pa.array(named, pa.bool_())],
            names=["key", "lines", "sizes", "links", "named"],
        )


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, gone = [], []
        for r in batch.to_pylist():
            a, b = r["lines"], r["next_lines"]
            pairs = common_lines(a, b)
            for side, key in ((0, "key"), (1, "next_key")):
                prefix = "next_" if side else ""
                sizes, links, named = r[f"{prefix}sizes"], r[f"{prefix}links"], r[f"{prefix}named"]
                shared = [p[side] for p in pairs]
                if named:
                    shared = [k for k in shared if links[k]]
                elif sum(sizes[k] for k in shared) > COPY_SHARE * max(sum(sizes), 1):
                    shared = []
                if shared:
                    keys.append(r[key])
                    gone.append(shared)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(gone, pa.list_(pa.int64()))], names=["key", "gone"])


def _texts(names: list[str], schema: T.StructType, gone_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, gone in zip(batch.column("html"), batch.column(gone_name), strict=True):
                lines = page_lines(page.as_py() or "")
                inside, _ = chosen(lines)
                gone = set(gone.as_py() or ())  # places among the lines inside
                out.append(" ".join(lines[k][0] for place, k in enumerate(inside) if place not in gone))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=schema.names)

    return run


def main_texts(pages: DataFrame) -> DataFrame:
    """The columns of ``pages`` (url, html) other than html, with text and n_chars."""
    key = F.xxhash64("url", "html")
    rows = pages.select(key.alias("key"), "url", F.coalesce("html", F.lit("")).alias("html"))
    lined = written(rows.select("key", "html").mapInArrow(_fingerprinted, "key long, lines array<long>, sizes array<int>, links array<boolean>, named boolean").dropDuplicates(["key"]), "lines")
    rest = F.when(F.locate("://", F.col("url")) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    urls = rows.select("key", F.coalesce(rest, F.lit("")).alias("rest")).select(
        "key", F.lower(F.regexp_extract("rest", r"^([^/?#]*)", 1)).alias("host"), F.regexp_extract("rest", r"^[^/?#]*(.*)$", 1).alias("path")
    )
    order = [F.col("host").asc(), F.col("path").asc(), F.col("key").asc()]
    near = successors(urls.distinct(), order, ["key", "host"]).where(F.col("host") == F.col("next_host")).select("key", "next_key")
    columns = ["lines", "sizes", "links", "named"]
    pairs = near.join(lined, "key").join(lined.select(F.col("key").alias("next_key"), *[F.col(c).alias(f"next_{c}") for c in columns]), "next_key")
    # a line that either neighbour shares goes
    found = pairs.mapInArrow(_differenced, "key long, gone array<long>")
    gone_name = free_name(pages.columns, "gone")
    shared = written(found.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias(gone_name)), "shared-lines")

    names = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    schema = T.StructType([*[pages.schema[c] for c in names], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    key_name = free_name([*pages.columns, gone_name], "key")
    joined = pages.withColumn(key_name, key).join(shared.withColumnRenamed("key", key_name), key_name, "left").select(*names, "html", gone_name)
    return joined.mapInArrow(_texts(names, schema, gone_name), schema)
