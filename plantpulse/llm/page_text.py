"""Main text of web pages: page structure, and differences to the page with the nearest URL.

A page is read into blocks of text, each in one of three zones: inside an article, inside an
element whose tag or class names a part that is no article (menu, footer, advert, form,
comments, ...), or neither. Pages of a host are put in the order of their URL paths; each
page is paired with the neighbour whose path shares the longest beginning. The text lines
of both are aligned by their longest common subsequence.

Lines that the pair shares are candidates for template. Where a page marks no article at all,
they are deleted from zone "neither" and what remains is its text; two pages that share all
such lines are copies and decide nothing. Where a page marks an article, that is its text
without the shared lines that are template of the host: articles quote and repeat each other, and
copies of one article on a host share most lines, so the pair alone would delete true text. A
shared line inside an article goes if the pair shares fewer than half of the article's lines
(else it is a copy or another state of one article) and if the line stands in the articles of more
than half of the host's pages, which must be HOST_PAGES or more. Lines of articles are compared by
64-bit hashes.

Names of a state, such as `no-sidebar`, `with-header` or `comments-open`, mark nothing: they stand
on elements around or on the article.

White space and references are resolved as in a browser's text. Neighbours are found in a
range-sorted table of paths; the ends of its partitions are matched in a second, small
step, so one host with most pages is spread over many tasks. Only pages that need them
receive the lines of their pair.

Defined results: null or empty html gives an empty text. A null URL or a host with one page
has no pair, so nothing is deleted by difference. Repeated rows are one page when pairs are made.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.tables import for_python
from plantpulse.session import stage_table

# Elements without an end tag, elements that break a line, elements whose content is no text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
             "nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead title "
             "tr ul".split())
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "object", "canvas", "audio", "video")
ASIDE = set("nav footer aside form button select dialog menu head header search fieldset label".split())
# Names in class, id or role that mark a part as no article.
MARKS = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
            "navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar side aside complementary "
            "contentinfo widget cookie cookies consent gdpr notice notices notification alert popup modal overlay "
            "newsletter subscribe subscription signup login search form share sharing social comment comments reply "
            "replies respond disqus discussion related recommended pagination pager skip toolbar tracking hidden".split())

# Parts of a name that tell how a page is laid out, not what an element is (no-sidebar, comments-open).
STATES = set("no not without with has is hide hidden show open closed enabled disabled on off".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")

NEITHER, ARTICLE, OUTSIDE = 0, 1, 2
#: Pages with an article that a host must have before a line of theirs can be its template.
HOST_PAGES = 4


def is_mark(name: str) -> bool:
    """Whether a class name, id or role names a part that is no article."""
    parts = _PART.split(name)
    return not MARKS.isdisjoint(parts) and (name in MARKS or STATES.isdisjoint(parts))


def zone_of(tag: str, attrs: str, outer: int) -> int:
    """The zone that an element opens within `outer`."""
    if outer == OUTSIDE:
        return OUTSIDE
    if tag in ASIDE and not (tag == "header" and outer == ARTICLE):
        return OUTSIDE
    if attrs and "=" in attrs:
        for m in _NAMES.finditer(attrs):
            if tag not in ("html", "body") and any(map(is_mark, (m[1] or m[2] or m[3] or "").lower().split())):
                return OUTSIDE
    return ARTICLE if tag in ("article", "main") else outer


def blocks(page: str) -> list[tuple[int, str]]:
    """Zone and text of each block, in page order."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    zone, text, at = NEITHER, [], 0

    def flush() -> None:
        line = " ".join(entities.unescape("".join(text)).split())
        if line:
            out.append((zone, line))
        text.clear()

    def leave(tag: str, *limits: str) -> None:
        """Close the innermost open `tag` and all within it, unless one of `limits` is nearer."""
        nonlocal zone
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                if zone != (outer := stack[k][1]):
                    flush()
                zone = outer
                del stack[k:]
                return
            if stack[k][0] in limits:
                return

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in BREAKS:
            flush()
        if m["close"]:
            leave(tag)
            continue
        if tag in BREAKS and tag != "br":
            # A paragraph or list item that was not closed ends here.
            leave("p", "div", "section", "article", "main", "td", "li", "body")
            if tag in ("li", "td", "th", "tr", "dt", "dd"):
                leave(tag, "ul", "ol", "dl", "table")
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        stack.append((tag, zone))
        inner = zone_of(tag, m["attrs"], zone)
        if inner != zone:
            flush()
            zone = inner
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def common_lines(a: list, b: list) -> set[int]:
    """Places in `a` of a longest common subsequence with `b`, by matching pairs in order."""
    where: dict[object, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []
    ends: list[tuple] = []
    for i, line in enumerate(a):
        for j in where.get(line, ()):
            k = bisect_left(tails, j)
            node = (i, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(node)
            else:
                tails[k], ends[k] = j, node
    out, node = set(), ends[-1] if ends else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path without query, fragment, index page and closing slash."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    host = F.lower(F.substring_index(rest, "/", 1))
    path = F.regexp_replace(F.regexp_replace(rest, "^[^/]*", ""), r"(/|/index\.[a-z]+)$", "")
    return host, path


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += len(x) + 1
    return n


def neighbours(keys: DataFrame) -> DataFrame:
    """row and mate: for each row of (host, path, row) the row of the nearest path on its host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous: list[tuple] = []
        edges: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                              ["row", "mate", "host", "path", "score"])

        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("host", "path", "row")), strict=True))
            pairs = []
            for row in rows:
                if previous and previous[-1][0] == row[0]:
                    last = previous[-1]
                    score = _shared(last[1], row[1])
                    pairs += [(row[2], last[2], None, None, score), (last[2], row[2], None, None, score)]
                if not edges:
                    edges.append(row)
                previous[:] = [row]
            yield out(pairs)
        if edges:
            # First and last row, for the neighbours across partitions.
            yield out([(r, None, h, p, None) for h, p, r in dict.fromkeys([edges[0], previous[0]])])

    ordered = for_python(keys).repartitionByRange("host", "path", "row").sortWithinPartitions("host", "path", "row")
    found = stage_table(ordered.mapInArrow(run, "row long, mate long, host string, path string, score int"))
    inside = found.where("mate is not null").select("row", "mate", "score")
    order = Window.partitionBy("host").orderBy("path", "row")
    ends = found.where("mate is null").select("row", "host", "path")
    nxt = ends.select("row", "path", F.lead("row").over(order).alias("mate"), F.lead("path").over(order).alias("other"))
    nxt = nxt.where("mate is not null").withColumn("score", _shared_column(F.col("path"), F.col("other")))
    across = nxt.select("row", "mate", "score").union(nxt.select(F.col("mate").alias("row"), F.col("row").alias("mate"), "score"))
    return inside.union(across).groupBy("row").agg(
        F.max_by("mate", F.struct("score", -F.col("mate"))).alias("mate"))


def _shared_column(a: Column, b: Column) -> Column:
    x, y = F.split(a, "/"), F.split(b, "/")
    same = F.zip_with(x, y, lambda p, q: F.when(p == q, F.length(p) + 1).otherwise(-1))
    stop = F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda s, v: F.struct(
        (s["n"] + F.when(s["go"] & (v >= 0), v).otherwise(0)).alias("n"), (s["go"] & (v >= 0)).alias("go")))
    return stop["n"]


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path; `article`, the lines of marked articles (null if there are none); `lines`, the others."""
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).withColumns({"host": host, "path": path})
    kept = ["page_id", "url", "host", "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            articles, lines = [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page or "")
                inside = [line for zone, line in found if zone == ARTICLE]
                articles.append(inside or None)
                lines.append([line for zone, line in found if zone == NEITHER])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(articles, pa.list_(pa.string())), pa.array(lines, pa.list_(pa.string()))],
                [*kept, "article", "lines"])

    return for_python(rows).select(*kept, "html").mapInArrow(
        run, "page_id long, url string, host string, path string, article array<string>, lines array<string>")


def own_lines(lines: pd.Series, other: pd.Series) -> pd.Series:
    """The lines of a page without those it shares, in order, with its pair."""
    out = []
    for mine, its in zip(lines, other, strict=True):
        mine = list(mine)
        shared = common_lines(mine, list(its)) if its is not None else ()
        out.append([x for k, x in enumerate(mine) if k not in shared] if len(shared) < len(mine) else mine)
    return pd.Series(out)


def shared_places(mine: pd.Series, other: pd.Series) -> pd.Series:
    """Places of the lines that an article shares, in order, with its pair; none if those are half of it or more."""
    out = []
    for a, b in zip(mine, other, strict=True):
        shared = common_lines(list(a), list(b))
        out.append(sorted(shared) if 2 * len(shared) < len(a) else [])
    return pd.Series(out)


def template_lines(articles: DataFrame, mates: DataFrame) -> DataFrame:
    """row and `template`: place and mark of the article lines that are template; only rows that have some.

    `articles` has row, host and `marks`, the hashes of the article's lines.
    """
    articles = articles.where("host is not null and host <> ''")
    other = articles.join(mates.select(F.col("mate").alias("row")).distinct(), "row", "left_semi").groupBy(
        F.col("row").alias("mate")).agg(F.first("marks").alias("other"))
    places = F.pandas_udf(shared_places, "array<int>")
    shared = articles.join(mates, "row").join(other, "mate").select("row", "host", "marks", places("marks", "other").alias("places"))
    candidates = shared.select("row", "host", F.explode("places").alias("place"), "marks").select(
        "row", "host", "place", F.get("marks", F.col("place")).alias("mark"))
    pages = articles.select("host", "row", F.array_distinct("marks").alias("marks")).distinct()
    sizes = pages.groupBy("host").agg(F.count_distinct("row").alias("n_pages")).where(F.col("n_pages") >= HOST_PAGES)
    common = (pages.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n"))
              .join(sizes, "host").where(2 * F.col("n") > F.col("n_pages")).select("host", "mark"))
    return candidates.join(common, ["host", "mark"]).groupBy("row").agg(F.collect_set(F.struct("place", "mark")).alias("template"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = stage_table(parsed(pages).withColumns({
        "row": F.xxhash64("page_id", "url"), "marks": F.transform("article", lambda line: F.xxhash64(line))}))
    keys = rows.where("host is not null and host <> ''").select("host", "path", "row").distinct()
    mates = stage_table(neighbours(keys))
    # Few pages have such lines: stored, they are of known size, and the texts need not travel to meet them.
    template = stage_table(template_lines(rows.where("article is not null").select("row", "host", "marks"), mates))
    # A row is meant by its hash, a line by its place and hash.
    kept = F.filter("article", lambda line, k: ~F.exists(
        F.coalesce("template", F.array().cast("array<struct<place:int,mark:long>>")), lambda t: (t["place"] == k) & (t["mark"] == F.xxhash64(line))))
    marked = rows.where("article is not null").join(template, "row", "left").select(
        "page_id", "url", F.concat_ws(" ", kept).alias("text"))
    unmarked = rows.where("article is null").select("row", "page_id", "url", "lines")
    paired = unmarked.join(mates, "row", "left")
    other = (rows.join(paired.select(F.col("mate").alias("row")).distinct(), "row", "left_semi")
             .groupBy(F.col("row").alias("mate")).agg(F.first("lines").alias("other")))
    own = F.pandas_udf(own_lines, "array<string>")
    rest = paired.join(other, "mate", "left").select("page_id", "url", F.concat_ws(" ", own("lines", "other")).alias("text"))
    return marked.union(rest).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
