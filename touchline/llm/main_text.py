"""Main text of web pages by nearest-URL page differencing.

A page is cut into blocks at its block-level tags. The pages of a host are
ordered by URL path, each page is paired with its nearest neighbour on either
side, the pair's blocks are aligned by longest common subsequence, and the
shared ones, the site's template, are deleted. What elements and names tell
is checked after it: blocks in menus, headers, footers, sidebars, adverts,
forms, comment sections, scripts and styles never count, and on a page with
text inside ``article`` or ``main`` only that text does.

Copies are no neighbours, since they share the article too. Pages of a host
with equal text blocks are one page, at the first of their paths, and its
result holds for all. A neighbour with more than half of the blocks of the
page's article is a copy with changes; the next one on that side takes its
place, up to ``REACH`` pages away.

What stands inside ``article`` or ``main`` is the article's own until proven a
template: two articles may well share a short paragraph or a licence line. A
block there goes only if it is on the common subsequence with ``VOTES`` or more
of the unlike pages within ``REACH``, and with more than half of them.

Only block fingerprints are compared.

Defined results: a null page has an empty text; null or odd URLs form a host
of their own; a page without neighbour keeps its blocks. Other columns are
kept out of the result.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.arrays import batches
from touchline.llm.common import stored

SKIP = frozenset("nav footer aside form menu dialog button select iframe svg head title template noscript object canvas video audio map".split())
RAW = re.compile(r"<(script|style|noscript|template|textarea|xmp|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
ATTRS = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# whole class tokens, ids, roles and labels that mark what is not the article;
# doubtful ones (notice, alert, banner, form, menu, search) are left to differencing
MARKS = frozenset("ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer modal nav navbar navigation newsletter popup promo promotion related share sharing sidebar social sponsor sponsored subscribe toolbar widget contentinfo complementary login signup".split())
COMMENTS = frozenset("comment comments disqus".split())
RUN, REACH = 1024, 8  # pages worked on at once, and looked at on either side
VOTES = 2  # unlike pages that share a block of an article, at least, for it to go
TABLE = 1 << 22  # cells of an alignment that are kept at once
SENT = 1 << 20  # numbers, some eight bytes each, that are broadcast at most
FREE, OWN, OTHER = 0, 1, 2  # where a block is: elsewhere, in article or main, in boilerplate


def names(attrs: str) -> set[str]:
    """The element's class and role tokens, its id and its label."""
    found: set[str] = set()
    for m in ATTRS.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        found.update([value.strip()] if m[1].lower() == "aria-label" else value.split())
    return found


def boilerplate(name: str, attrs: str, inside: bool) -> bool:
    if name in SKIP or name == "header" and not inside:
        return True
    if "=" in attrs and name not in ("body", "html", "article", "main"):
        return bool(re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", ATTRS.sub("", attrs))) or not MARKS.isdisjoint(names(attrs))
    return False


def _walk(page: str, kept: set[int]) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(text, place) of the page's blocks, and the boilerplate elements, by
    their position, that hold a main element or an article, with the length
    of its text (without limit for main). Elements in ``kept`` are none."""
    out: list[tuple[str, int]] = []
    buffer: list[str] = []
    skip, start, depth, inside, at = "", 0, 0, 0, 0
    within: list[str] = []  # open article and main elements of a skipped element
    length, holds, closed = 0, {}, False

    def close():
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((text, OTHER if skip else OWN if inside else FREE))

    for m in TAG.finditer(page):
        end, name = m[1], m[2].lower()
        if m.start() > at:
            buffer.append(page[at : m.start()])
            if skip and within:
                length += len(page[at : m.start()].strip())
        at = m.end()
        if name in BLOCK or name in SKIP:
            close()
        elif name == "br":
            buffer.append(" ")
        if skip:
            if name in ("article", "main") and not end:
                if not within:
                    length = 0
                within.append(name)
            elif name in ("article", "main") and name in within:
                while within.pop() != name:
                    pass
                if not within and not closed:
                    holds[start] = max(holds.get(start, 0), length)
            elif name == skip:
                depth += -1 if end else 1
                if not depth:
                    close()
                    skip = ""
            elif end and name in ("body", "article", "main"):  # never closed: its parent's end closes it
                close()
                skip, depth = "", 0
                inside = max(0, inside - (name != "body"))
            if name == "main" and not end and not closed:
                holds[start] = 1 << 62
            if within and not skip:
                if not closed:
                    holds[start] = max(holds.get(start, 0), length)
                within.clear()
            continue
        if not end and name not in VOID and not m[0].endswith("/>") and m.start() not in kept and boilerplate(name, m[3], bool(inside)):
            close()
            skip, start, depth, length = name, m.start(), 1, 0
            closed = not COMMENTS.isdisjoint(names(m[3])) or name in ("head", "template", "dialog")
        elif name in ("article", "main"):
            inside = max(0, inside + (-1 if end else 1))
    buffer.append(page[at:])
    close()
    if skip and within and not closed:
        holds[start] = max(holds.get(start, 0), length)
    return out, holds


def placed(page: str) -> list[tuple[str, int]]:
    """The page's blocks and where they are. A boilerplate element, comments
    apart, that holds the main element, or an article longer than all text
    outside boilerplate, is a wrapper round the page's article and is none."""
    page = RAW.sub(" ", page)
    kept: set[int] = set()
    while True:
        found, holds = _walk(page, kept)
        least = sum(len(x) for x, place in found if place != OTHER)
        wrapper = {k for k, n in holds.items() if n > least}
        if not wrapper:
            return found
        kept.add(max(wrapper, key=lambda k: (holds[k], -k)))


def blocks(page: str) -> tuple[list[str], bool]:
    """The page's blocks outside boilerplate, and whether they come from an
    article or main element (then only those inside one are given)."""
    found = placed(page)
    own = [x for x, place in found if place == OWN]
    return (own, True) if own else ([x for x, place in found if place == FREE], False)


def mark(block: str) -> int:
    return int.from_bytes(hashlib.blake2b(block.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places of ``a`` on a longest common subsequence with ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    found = {*range(start), *range(len(a) - stop, len(a))}
    common = set(a[start : len(a) - stop]) & set(b[start : len(b) - stop])
    p = [i for i in range(start, len(a) - stop) if a[i] in common]
    q = [x for x in b[start : len(b) - stop] if x in common]
    found.update(p[i] for i in _aligned(np.array([a[i] for i in p], np.int64), np.array(q, np.int64)))
    return found


def _lengths(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of p and each start of q."""
    row = np.zeros(len(q) + 1, np.int32)
    for x in p:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(q == x, row[:-1] + 1, 0)))
    return row


def _aligned(p: np.ndarray, q: np.ndarray) -> list[int]:
    """Places of ``p`` on a longest common subsequence with ``q``. Long lists
    are halved where the best split is, so memory grows with their lengths."""
    if not len(p) or not len(q):
        return []
    if len(p) > 1 and len(p) * len(q) > TABLE:
        half = len(p) // 2
        cut = int(np.argmax(_lengths(p[:half], q) + _lengths(p[half:][::-1], q[::-1])[::-1]))
        return _aligned(p[:half], q[:cut]) + [half + i for i in _aligned(p[half:], q[cut:])]
    length = np.zeros((len(p) + 1, len(q) + 1), np.int32)
    for i in range(len(p) - 1, -1, -1):
        row = np.maximum(length[i + 1, :-1], np.where(q == p[i], length[i + 1, 1:] + 1, 0))
        length[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    found, i, j = [], 0, 0
    while i < len(p) and j < len(q):
        if p[i] == q[j]:
            found.append(i)
            i, j = i + 1, j + 1
        elif length[i + 1, j] >= length[i, j + 1]:
            i += 1
        else:
            j += 1
    return found


def normal(url):
    """A URL without scheme, query and fragment."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "^[a-zA-Z]+://|[?#].*$", "")


def template(page: dict, sides) -> set[int]:
    """Places of the page's blocks that are the site's. ``sides`` are the marks
    of the pages before and after it, the nearest first. Elsewhere, what the
    nearest page on either side shares that is no copy; in an article, what
    most unlike pages share. A page that holds more than half of the blocks of
    the page's article is a copy of it."""
    own = set(page["places"]) if page["sure"] else set()
    mine = {page["marks"][i] for i in own}
    gone: set[int] = set()
    votes: dict[int, int] = {}
    unlike = 0
    for side in sides:
        nearest = True
        for other in side:
            if not nearest and mine.isdisjoint(other):
                unlike += 1  # no block of the article there, and none but the nearest matters elsewhere
                continue
            both = shared(page["marks"], other)
            if 2 * len(own & both) > len(own):
                continue
            unlike += 1
            for i in own & both:
                votes[i] = votes.get(i, 0) + 1
            if nearest:
                gone |= both - own
                nearest = False
            if not own:
                break
    return gone | {i for i, n in votes.items() if n >= VOTES and 2 * n > unlike}


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), normal(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    own = own.withColumn("host", F.lower(F.substring_index("path", "/", 1)))
    kind = dict(own.dtypes)["id"]

    def cut(page):
        """(texts, their places among all blocks, all blocks' fingerprints,
        whether from an article, digest of the texts)."""
        found = placed(page or "")
        sure = any(place == OWN for _, place in found)
        places = [i for i, (_, place) in enumerate(found) if place == (OWN if sure else FREE)]
        marks = [mark(x) for x, _ in found]
        key = hashlib.blake2b(np.array([sure, *(marks[i] for i in places)], np.int64).tobytes(), digest_size=16).digest()
        return [found[i][0] for i in places], places, marks, sure, key

    def lists(it):
        for b in batches(it):
            _, places, marks, sure, key = zip(*(cut(h) for h in b.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("path"), pa.array(key, pa.binary()), pa.array(marks, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(sure)], names=["host", "path", "key", "marks", "places", "sure"])

    def texts(it):
        for b in batches(it):
            parts, _, _, _, key = zip(*(cut(h) for h in b.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), b.column("host"), pa.array(key, pa.binary()), pa.array(parts, pa.list_(pa.string()))], names=["id", "url", "host", "key", "blocks"])

    listed = own.select("host", "path", "html").mapInArrow(lists, "host string, path string, key binary, marks array<bigint>, places array<int>, sure boolean")
    gone = stored(_differenced(listed), "gone")
    size = gone.agg(F.sum(F.size("gone") + 16)).first()[0] or 0
    # texts are cut again and not stored; they travel only if the places to
    # delete are too many to be sent to them
    if size <= SENT:
        gone = F.broadcast(gone)
    whole = own.select("id", "url", "host", "html").mapInArrow(texts, f"id {kind}, url string, host string, key binary, blocks array<string>")
    out = whole.join(gone, ["host", "key"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("blocks") - 1), "gone")
    kept = F.transform(left, lambda i: F.get("blocks", i))
    text = F.array_join(F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(kept), "\n")
    out = out.select("id", "url", text.alias("text"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("bigint").alias("n_chars"))


def _differenced(listed: DataFrame) -> DataFrame:
    """(host, key, gone) of the pages that lose blocks; ``gone`` counts among
    the page's own blocks. Equal pages of a host are one page at their first
    path. Pages are numbered by host and path over all tasks, and the numbers
    are dealt out in runs of ``RUN`` with the ``REACH`` pages on either side,
    so neither a large host nor a large section meets in one task."""
    one = listed.where("size(places) > 0").groupBy("host", "key").agg(F.min(F.struct("path", "marks", "places", "sure")).alias("x")).select("host", "key", "x.*")
    parts = stored(stored(one, "lists").repartitionByRange("host", "path", "key").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["part"], r["count"]) for r in parts.groupBy("part").count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    base = parts.sparkSession.createDataFrame([(p, n) for (p, _), n in zip(sizes, before)], "part int, base long")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("host", "path", "key"))
    placed_ = parts.withColumn("r", rank).join(F.broadcast(base), "part").withColumn("n", F.col("base") + F.col("r") - 1)
    run = lambda n: F.greatest(F.lit(0), F.floor(n / RUN)).cast("bigint")
    dealt = placed_.select("host", "key", "marks", "places", "sure", "n", F.explode(F.sequence(run(F.col("n") - REACH), run(F.col("n") + REACH))).alias("run"))

    def pairs(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["n"])
        out = []
        for at, page in enumerate(rows):
            if page["n"] // RUN != key[0].as_py():
                continue
            left, right = rows[max(0, at - REACH) : at][::-1], rows[at + 1 : at + 1 + REACH]
            both = template(page, [[x["marks"] for x in side if x["host"] == page["host"]] for side in (left, right)])
            lost = [i for i, place in enumerate(page["places"]) if place in both]
            if lost:
                out.append({"host": page["host"], "key": page["key"], "gone": lost})
        return pa.Table.from_pylist(out, pa.schema({"host": pa.string(), "key": pa.binary(), "gone": pa.list_(pa.int32())}))

    return dealt.groupBy("run").applyInArrow(pairs, "host string, key binary, gone array<int>")
