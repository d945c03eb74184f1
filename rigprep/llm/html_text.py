"""Main text of pages by nearest-URL differencing.

Each page becomes text lines, one for each block, and each line knows what its markup says of it:
inside an article, inside a menu, footer, advert and the like, or neither. Within each host pages
are paired with their nearest neighbour by URL path. The lines of a pair are aligned by their
longest common subsequence, and shared lines are deleted: a host's frame is what its pages share.

Four limits keep the article whole. Lines inside an ``article`` or ``main`` element are never
taken for frame, as two pages can carry the same article. Pages whose other lines are all equal are
copies, which say nothing of a frame, and keep these lines. Lines that the markup already marks as
frame go even when no neighbour shares them, as a host may have one page only. A long line goes only if three
pages of the host have it: two pages of a host may share a paragraph.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigprep.functions.shared import materialize
from rigprep.llm.text import map_texts

#: Element names of HTML, by what they mean here.
SKIP = frozenset(["script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video", "head", "title", "select", "textarea", "button"])
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe"])
FRAME = frozenset(["nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"])
MAIN = frozenset(["article", "main"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
BLOCK = frozenset(
    ["address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"]
)
#: Words that name a page's frame, and reader comments, in a class or id; and words that say nothing beside them. A class or id
#: marks frame if it has one of the first and nothing but these: `site-footer` does, `share price` does not.
FRAME_WORDS = frozenset(
    ["ad", "ads", "advert", "adverts", "advertisement", "banner", "promo", "sponsor", "sponsored", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "respond", "replies", "pagination", "pager", "toolbar", "widget", "search", "skip"]
)
PLAIN_WORDS = frozenset(
    ["site", "page", "global", "top", "bottom", "left", "right", "main", "primary", "secondary", "wrapper", "wrap", "container", "inner", "outer", "box", "bar", "block", "section", "area", "list", "item", "items", "link", "links", "fixed", "sticky", "default", "slot", "unit", "row", "col", "column", "icon", "icons", "button", "buttons", "btn", "form", "field", "posts", "articles", "stories", "content", "panel", "group", "module", "region", "zone", "overlay", "dropdown", "toggle", "mobile", "desktop", "horizontal", "vertical", "small", "large", "clearfix", "to", "the", "and"]
)
ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"])

#: Shared lines of so many code points go only if so many pages of their host have them.
LONG_LINE, AGREED = 80, 3

#: Inside an article, only these as a whole class or id.
MAIN_FRAME_WORDS = frozenset(["ad", "ads", "advert", "adverts", "advertisement", "comment", "comments", "disqus", "replies", "respond"])

_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)(?:>|\Z)", re.S)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?i)(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_CLOSES_P = BLOCK - {"br"}


def _all_frame(value: str) -> bool:
    words = set(re.split(r"[\s_-]+", value.lower())) - {""}
    return bool(words & FRAME_WORDS) and all(w in FRAME_WORDS or w in PLAIN_WORDS or w.isdigit() for w in words)


def _marks_frame(name: str, attributes: str, in_main: bool) -> bool:
    if name in FRAME and not (name == "header" and in_main):
        return True
    if not attributes or attributes.isspace():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"(?i)display\s*:\s*none", value):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in ("body", "html", "article", "main"):
            if MAIN_FRAME_WORDS & set(value.lower().split()) if in_main else _all_frame(value):
                return True
    return False


def lines(page: str) -> Iterator[tuple[str, str]]:
    """(kind, text) of each block with text, in page order; kind: main, frame or open.

    A small scanner in place of a parser, linear in the page's length: unclosed elements end with their
    parent, cut markup ends with the page, an end tag without a start is passed over, and after a tag
    with a quote that never closes tags end at the next >.
    """
    stack: list[tuple[str, bool, bool, bool]] = []  # name, main, frame, skipped
    opened: Counter[str] = Counter()  # names in the stack
    parts: list[str] = []
    at = 0
    state = (False, False, False)
    out: list[tuple[str, str]] = []
    tag = _TAG

    def flush():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text and not state[2]:
                out.append(("frame" if state[1] else "main" if state[0] else "open", text))

    def close(k: int) -> tuple[bool, bool, bool]:
        for name, *_ in stack[k:]:
            opened[name] -= 1
        del stack[k:]
        return stack[-1][1:] if stack else (False, False, False)

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            parts.append(page[at:])
            break
        parts.append(page[at:start])
        after = page[start + 1 : start + 3]
        if not after or after == "/":  # cut markup
            break
        if after[0] in "!?":
            at = _OTHER.match(page, start).end()
            continue
        if not (after[1:2] if after[0] == "/" else after[0]).isascii() or not (after[1:2] if after[0] == "/" else after[0]).isalpha():
            parts.append("<")
            at = start + 1
            continue
        m = tag.match(page, start)
        if not m:
            tag = _LOOSE_TAG
            m = tag.match(page, start)
        at = m.end()
        name = m[2].lower()
        if name in BLOCK or name in SKIP:
            flush()
        if m[1]:  # an end tag
            if opened[name]:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                before = stack[k - 1][1:] if k else (False, False, False)
                if before != state:
                    flush()
                state = close(k)
            continue
        if name in VOID:
            continue
        if name in _CLOSES_P and opened["p"]:  # an open paragraph ends where a block begins
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    state = close(k)
                    break
                if stack[k][0] in _CLOSES_P:
                    break
        main = state[0] or name in MAIN
        now = (main, state[1] or _marks_frame(name, m[3], state[0]), state[2] or name in SKIP)
        if now != state:
            flush()
        if not m[3].endswith("/"):
            stack.append((name, *now))
            opened[name] += 1
            state = now
        if name in RAW:
            end = re.compile(rf"(?i)</{name}\s*>").search(page, at)
            at = end.start() if end else len(page)
    flush()
    return iter(out)


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits.

    A row has a bit for each line of ``b``, which is 0 where the length grows, and follows from the row before by
    one addition of long numbers. Equal ends are cut off first. Every so many rows are kept, and those
    between are made again on the way back, so memory is in proportion to the page.
    """
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    found = {*range(first), *range(len(a) - last, len(a))}
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full, every = (1 << len(b)) - 1, max(1, math.isqrt(len(a)))

    def rows(row: int, low: int, high: int) -> list[int]:
        out = [row]
        for x in a[low:high]:
            same = row & where.get(x, 0)
            row = (row + same | row - same) & full
            out.append(row)
        return out

    kept = [full]
    for low in range(0, len(a), every):
        kept.append(rows(kept[-1], low, min(low + every, len(a)))[-1])
    i, j, low, part = len(a), len(b), len(a) + 1, []
    while i and j:
        if i - 1 < low:
            low = (i - 1) // every * every
            part = rows(kept[low // every], low, min(low + every, len(a)))
        if part[i - low] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if part[i - low] >> (j - 1) & 1 or not i:
                j -= 1
                found.add(first + i)
    return found


def page_lines(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, kinds and texts: the lines of each page. A null page is empty."""

    def start():
        def work(cols, texts):
            kinds, found = [], []
            for text in texts:
                got = list(lines(text.decode("utf-8", "replace")))
                kinds.append([k for k, _ in got])
                found.append([t for _, t in got])
            return {"page_id": cols["page_id"], "url": cols["url"], "kinds": pa.array(kinds, pa.list_(pa.string())), "texts": pa.array(found, pa.list_(pa.string()))}

        return work

    return map_texts(pages, {"page_id": id_col, "url": url_col}, html_col, start, f"page_id {dict(pages.dtypes)[id_col]}, url string, kinds array<string>, texts array<string>")


def host_of(url_col: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def _line_hash(line: str) -> int:
    """Spark's xxhash64 of a line."""
    h = xxhash.xxh64_intdigest(line.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def nearest(pages: DataFrame, rows_per_part: int = 20_000) -> DataFrame:
    """(row, mate): each page's nearest page of the same host by URL path; none for a lone page.

    Pages of a host are sorted by path, where the nearest one stands next; of the two neighbours it
    is the one with more leading characters in common. A large host is cut into ranges of paths,
    so that no task sorts it whole; the first and last page of each range (two small rows a range)
    are written and then find their neighbours in the ranges beside theirs.
    """
    path = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    keyed = pages.select("row", host_of("url").alias("host"), path.alias("path"))
    parts = max(1, -(-keyed.count() // rows_per_part))
    # range partitions by (host, path) are contiguous, so that neighbours share a partition
    dealt = keyed.repartitionByRange(parts, "host", "path", "row").withColumn("part", F.spark_partition_id())
    order = Window.partitionBy("part").orderBy("host", "path", "row")
    page = F.struct("row", "host", "path")
    near = dealt.withColumn("before", F.lag(page).over(order)).withColumn("after", F.lead(page).over(order))

    def own(other: str):
        return F.when(F.col(f"{other}.host") == F.col("host"), F.col(other))

    def common(other: str):
        """Leading characters in common, by halving: 32 steps for a path of any length."""
        most = F.least(F.length("path"), F.length(F.col(f"{other}.path")))

        def halve(s, _):
            k = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
            same = F.substring("path", F.lit(1), k) == F.substring(F.col(f"{other}.path"), F.lit(1), k)
            return F.when(s["low"] >= s["high"], s).otherwise(F.struct(F.when(same, k).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(k - 1).alias("high")))

        start = F.struct(F.lit(0).alias("low"), most.alias("high"))
        return F.when(F.col(other).isNull(), -1).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, halve, lambda s: s["low"]))

    def mated(rows: DataFrame) -> DataFrame:
        mate = F.when(common("after") > common("before"), F.col("after.row")).otherwise(F.coalesce("before.row", "after.row"))
        return rows.withColumns({"before": own("before"), "after": own("after")}).withColumn("mate", mate)

    edge = F.when(F.col("before").isNull() | F.col("after").isNull(), F.struct("host", "path", "before", "after")).alias("edge")
    # written once, as ranges that are dealt again can differ
    near = materialize(mated(near.select("*", edge)).select("row", "mate", "edge"), "near")
    edges = near.where("edge is not null").select("row", "edge.*")
    over = Window.orderBy("host", "path", "row")
    beside = edges.withColumns({c: F.coalesce(c, f(page).over(over)) for c, f in (("before", F.lag), ("after", F.lead))})
    return near.where("edge is null").select("row", "mate").unionByName(mated(beside).select("row", "mate"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, n_shared, n_frame.

    text joins the kept lines by \\n; it is empty if none is left, and for null, empty or frame-only
    pages. n_shared counts lines deleted because the nearest page shares them, n_frame those that
    the markup marks. Null and odd URLs form a host of their own; repeated rows are judged each. An
    empty table gives an empty table. Other columns are not looked at.
    """
    # Every table here has rows for pages and grows with the input; their files are much smaller than their rows, so none is broadcast.
    parsed = page_lines(pages, id_col, url_col, html_col)
    # A line inside an article is never frame, so only the other lines are written and sent to mates.
    other = F.filter(F.arrays_zip("kinds", "texts"), lambda x: x["kinds"] != "main")
    long = F.filter(F.arrays_zip("kinds", "texts"), lambda x: (x["kinds"] == "open") & (F.char_length(x["texts"]) >= LONG_LINE))
    hashes = F.array_distinct(F.transform(long, lambda x: F.xxhash64(x["texts"])))
    frames = materialize(parsed.select("page_id", "url", F.transform(other, lambda x: x["texts"]).alias("others"), hashes.alias("long")).withColumn("row", F.monotonically_increasing_id()), "frames")
    found = frames.select("row", host_of("url").alias("host"), F.explode("long").alias("line"))
    agreed = found.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= AGREED)
    agreed = materialize(found.join(agreed.hint("merge"), ["host", "line"]).groupBy("row").agg(F.collect_list("line").alias("agreed")), "agreed")  # a page's lines
    pairs = nearest(frames).where("mate is not null")
    # rows that repeat an id and a URL share the mate of the first of them
    chosen = pairs.join(frames.select("row", "page_id", "url").hint("merge"), "row").groupBy("page_id", "url").agg(F.min_by("mate", "row").alias("mate"), F.min("row").alias("row")).join(agreed.hint("merge"), "row", "left")
    mates = chosen.join(frames.select(F.col("row").alias("mate"), F.col("others").alias("mate_texts")).hint("merge"), "mate")
    mates = materialize(mates.select(F.col("page_id").alias("own_id"), F.col("url").alias("own_url"), "mate_texts", "agreed"), "mates")
    both = parsed.join(mates.hint("merge"), parsed.page_id.eqNullSafe(mates.own_id) & parsed.url.eqNullSafe(mates.own_url), "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for kinds, texts, mate, often in zip(x["kinds"], x["texts"], x["mate_texts"], x["agreed"], strict=True):
                kinds, texts = list(kinds), list(texts)
                outside = [i for i, k in enumerate(kinds) if k != "main"]
                own, mate = [texts[i] for i in outside], list(mate) if mate is not None else []
                shared = {outside[i] for i in common_lines(own, mate)} if own != mate else set()
                often = set(often) if often is not None else set()
                shared = {i for i in shared if kinds[i] == "frame" or len(texts[i]) < LONG_LINE or _line_hash(texts[i]) in often}
                frame = {i for i in outside if kinds[i] == "frame"}
                rows.append(("\n".join(t for i, t in enumerate(texts) if i not in shared and i not in frame), len(shared), len(frame)))
            yield pd.DataFrame({"page_id": x["page_id"], "url": x["url"], "text": [r[0] for r in rows], "n_shared": [r[1] for r in rows], "n_frame": [r[2] for r in rows]})

    return both.select("page_id", "url", "kinds", "texts", "mate_texts", "agreed").mapInPandas(cut, f"page_id {dict(parsed.dtypes)['page_id']}, url string, text string, n_shared long, n_frame long")
