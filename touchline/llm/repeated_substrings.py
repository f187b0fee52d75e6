"""Suffix-array dedup of repeated byte strings, over sampled suffixes.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller id, or same document and earlier start) is removed; strings are
judged on the input and never cross documents.

Suffixes are sampled so that no string is missed: a string's anchor is the
place of its smallest ``GRAM``-byte fingerprint, leftmost on ties, which
depends on the string alone. Strings of one document with one anchor follow
each other and form a run; a run's span is what they cover.

1. Runs go to buckets by the gram at their anchor. Equal spans are one class;
   all runs of a class but the earliest are removed whole (a task does so for
   its own rows before it sends them). Grams with one class are done.
2. The earliest runs of grams with several classes are unsettled: their spans
   are cut from the texts as suffixes at the anchor, with what stands left of
   it. Sampled splitters range-partition them by their leading bytes and their
   place, a partition sorts them by multikey quicksort, and neighbours' common
   prefixes with the left parts tell which strings are equal.
3. The first and the last gram of a partition may go on in the next one: their
   strings are compared across boundaries by fingerprint.

Defined results: null and empty texts have no bytes; rows without id come
last; rows that repeat an id come in the order of their text's hash, and
wholly equal rows count as one document. Other columns are not read.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import _BYTE, _power_tables, U64, batches, chunks, mix
from touchline.llm.common import stored

LENGTH = 100
GRAM = 32
WIDTH = LENGTH - GRAM + 1  # places of a string's anchor
CHUNK = 1 << 19  # bytes of text worked on at once
FLUSH = 1 << 18  # runs that a task gathers at least before it sends them
WINDOW = 1 << 20  # bytes of a long text worked on at once
LONG = 4 << 20  # bytes from which a text is long
_PLACE = U64((1 << 28) - 1)
NONE = (1 << 63) - 1  # the id that stands for null

RUN = np.dtype([("gram", "<u8"), ("span", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("count", "u1"), ("left", "u1")])

GONE = np.dtype([("doc", "<u4"), ("start", "<u4"), ("count", "<u4"), ("left", "u1")])


def runs(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The runs of a chunk of texts; ``start`` counts from its text's start,
    ``left`` are the bytes between the run's start and its anchor."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, RUN)
    up, down = _power_tables(len(raw) + 1)
    acc = np.zeros(len(raw) + 1, U64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=acc[1:])
    gram = mix((acc[GRAM:] - acc[:-GRAM]) * down[: len(raw) - GRAM + 1])
    value = gram & ~_PLACE | np.arange(len(gram), dtype=U64)
    # smallest of every WIDTH values: prefix and suffix minima of blocks
    padded = np.full(-(-len(value) // WIDTH) * WIDTH, ~U64(0))
    padded[: len(value)] = value
    grid = padded.reshape(-1, WIDTH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:n], ahead[WIDTH - 1 : WIDTH - 1 + n]) & _PLACE).astype(np.int64)
    size = np.diff(offsets) - 1
    inside = np.zeros(len(raw) + 1, np.int64)
    long = size >= LENGTH
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[:-1][long] + size[long] - LENGTH + 1, -1)
    valid = np.cumsum(inside[:n]) > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    end = valid.copy()
    end[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    last = np.flatnonzero(end)
    out = np.zeros(len(first), RUN)
    out["gram"] = gram[anchor[first]]
    out["count"] = last - first + 1
    out["left"] = anchor[first] - first
    span = (acc[last + LENGTH] - acc[first]) * down[first]
    out["span"] = mix(span ^ (out["left"].astype(U64) << U64(8) | out["count"].astype(U64)))
    doc = np.searchsorted(offsets, first, "right") - 1
    out["doc"], out["start"] = doc, first - offsets[doc]
    return out


def long_runs(data: bytes) -> np.ndarray:
    """The runs of one long text (which a newline follows), window by window. A
    run that a window cuts becomes two; then it may not equal another's, and
    the sort settles its strings."""
    size = len(data) - 1
    parts = []
    for at in range(0, max(1, size - LENGTH + 1), WINDOW):
        piece = data[at : min(size, at + WINDOW + LENGTH - 1)] + b"\n"
        r = runs(piece, np.array([0, len(piece)]))
        r["start"] += at
        parts.append(r)
    return np.concatenate(parts)


def _earliest(r: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which runs are the first of their class; ``rank`` orders the runs."""
    order = np.lexsort((rank, r["span"], r["gram"]))
    o = r[order]
    first = np.ones(len(o), bool)
    first[1:] = (o["gram"][1:] != o["gram"][:-1]) | (o["span"][1:] != o["span"][:-1])
    out = np.zeros(len(o), bool)
    out[order[first]] = True
    return out


def _ranked(ids: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Order of runs by (id, version, start); ``ids`` are the documents' pairs."""
    names = np.lexsort((ids[:, 1], ids[:, 0]))
    rank = np.empty(len(ids), np.int64)
    same = np.concatenate([[False], (ids[names[1:]] == ids[names[:-1]]).all(axis=1)]) if len(ids) else np.zeros(0, bool)
    rank[names] = np.cumsum(~same)
    return rank[r["doc"]] << 32 | r["start"].astype(np.int64)


def _joined(r: np.ndarray) -> np.ndarray:
    """Settled runs of a document that overlap or touch as one."""
    r = r[np.lexsort((r["start"], r["doc"]))]
    doc = r["doc"].astype(np.int64) << 34
    start = doc + r["start"]
    end = np.maximum.accumulate(start + r["count"] - 1 + LENGTH)
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    out = np.zeros(len(first), GONE)
    out["doc"], out["start"] = r["doc"][first], r["start"][first]
    out["count"] = end[np.append(first[1:], len(r)) - 1] - start[first] - LENGTH + 1
    return out


def _packed(docs: DataFrame, bits: int) -> DataFrame:
    """Runs dealt to 2**bits buckets by their gram; runs that an earlier equal
    one in the same task settles travel as removals (bucket below 0)."""

    def send(parts, ids):
        r, ids = np.concatenate(parts), np.array(ids, np.int64).reshape(-1, 2)
        first = _earliest(r, _ranked(ids, r))
        gone, r = r[~first], r[first]
        r["gram"] = mix(r["gram"])  # an anchor's gram is a minimum: mixed, the buckets are even
        r = r[np.argsort(r["gram"], kind="stable")]
        bucket = (r["gram"] >> U64(64 - bits)).astype(np.int64)
        edge = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        rows = [(k, r[edge[k] : edge[k + 1]]) for k in np.flatnonzero(np.diff(edge)).tolist()]
        # settled runs may go anywhere: to a bucket by their first document
        rows += [(-1 - int(mix(ids[gone["doc"][:1]].sum(axis=1).astype(U64))[0] >> U64(64 - bits)), _joined(gone))] if len(gone) else []
        for k, part in rows:
            used, place = np.unique(part["doc"], return_inverse=True)
            part = part.copy()
            part["doc"] = place
            fields = [np.ascontiguousarray(part[f]).tobytes() for f in ("doc", "start", "count", "left")]
            if k < 0:
                yield k, ids[used].tobytes(), b"", b"", *fields
                continue
            gram = (part["gram"] >> U64(24 - min(bits, 24))).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            span = np.ascontiguousarray(part["span"]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            yield k, ids[used].tobytes(), gram, span, *fields

    def run(it):
        parts, ids, total = [], [], 0
        flush = min(max(FLUSH, 4 << bits), 4 * FLUSH)  # the more buckets, the more to each

        def batch(rows):
            for at in range(0, len(rows), 64):
                part = rows[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.int32(), *[pa.binary()] * 7))], names=["bucket", "ids", "gram", "span", "doc", "start", "count", "left"])

        for b in batches(it):
            keys = list(zip(b.column("id").to_pylist(), b.column("version").to_pylist()))
            for first, last, data, offsets in chunks(b.column("text").to_pylist(), CHUNK):
                r = runs(data, offsets) if len(data) <= LONG else long_runs(data)
                r["doc"] += len(ids)
                ids += keys[first:last]
                parts.append(r)
                total += len(r)
                if total >= flush:
                    yield from batch(list(send(parts, ids)))
                    parts, ids, total = [], [], 0
        if total:
            yield from batch(list(send(parts, ids)))

    return docs.mapInArrow(run, "bucket int, ids binary, gram binary, span binary, doc binary, start binary, count binary, left binary")


_ROWS = "id long, version long, start int, count int, left int, settled boolean"


def _settled(packed: DataFrame) -> DataFrame:
    """Runs that are removed (settled) and runs of grams with several classes."""

    def run(key, pdf):
        parts, ids, base = [], [], 0
        for row in pdf.itertuples(index=False):
            own = np.frombuffer(row.ids, np.int64).reshape(-1, 2)
            r = np.zeros(len(row.doc) // 4, RUN if key[0] >= 0 else GONE)
            for f in ("doc", "start", "count", "left"):
                r[f] = np.frombuffer(getattr(row, f), r.dtype[f])
            r["doc"] += base
            for f, width in (("gram", 5), ("span", 6)):
                if len(getattr(row, f)):
                    wide = np.zeros((len(r), 8), np.uint8)
                    wide[:, :width] = np.frombuffer(getattr(row, f), np.uint8).reshape(-1, width)
                    r[f] = wide.view("<u8").ravel()
            parts.append(r)
            ids.append(own)
            base += len(own)
        r, ids = np.concatenate(parts), np.concatenate(ids)
        if key[0] < 0:
            settled = np.ones(len(r), bool)
        else:
            first = _earliest(r, _ranked(ids, r))
            order = np.lexsort((r["span"], r["gram"]))
            g, f = r["gram"][order], first[order]
            start = np.ones(len(g), bool)
            start[1:] = g[1:] != g[:-1]
            classes = np.add.reduceat(f.astype(np.int64), np.flatnonzero(start))
            several = np.zeros(len(r), bool)
            several[order] = np.repeat(classes > 1, np.diff(np.append(np.flatnonzero(start), len(g))))
            keep = ~first | several
            r, settled = r[keep], ~first[keep]
        who = ids[r["doc"]]
        return pd.DataFrame({"id": who[:, 0], "version": who[:, 1], "start": r["start"].astype(np.int32), "count": r["count"].astype(np.int32), "left": r["left"].astype(np.int32), "settled": settled})

    return packed.groupBy("bucket").applyInPandas(run, _ROWS)


def _suffixes(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """(suffix, before, id, version, start, count): the unsettled spans, cut at the anchor."""
    wanted = open_.groupBy("id", "version").agg(F.collect_list(F.struct("start", "count", "left")).alias("runs"))
    rows = docs.join(wanted, ["id", "version"])

    def run(it):
        for b in batches(it):
            out = []
            for i, v, text, want in zip(*(b.column(c).to_pylist() for c in ("id", "version", "text", "runs"))):
                raw = text.encode("utf-8", "surrogatepass")
                for x in want:
                    s, p, e = x["start"], x["start"] + x["left"], x["start"] + x["count"] - 1 + LENGTH
                    out.append((raw[p:e], raw[s:p], i, v, s, x["count"]))
                    if len(out) == 20000:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    return rows.select("id", "version", "text", "runs").mapInArrow(run, "suffix binary, before binary, id long, version long, start int, count int").dropDuplicates(["id", "version", "start", "suffix"])


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["suffix", "before", "id", "version", "start", "count"])


SMALL = 48  # rows that are sorted at once


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of rows of big-endian words by multikey quicksort: a range of rows
    that agree so far is parted by one word into smaller, equal and larger
    ones, and the equal ones go on with the next word."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        first, last, w = todo.pop()
        if last - first < 2 or w == words.shape[1]:
            continue
        rows = order[first:last]
        if last - first <= SMALL:
            order[first:last] = rows[np.lexsort(words[rows, w:].T[::-1])]
            continue
        value = words[rows, w]
        pivot = np.sort(value[[0, len(value) // 4, len(value) // 2, 3 * len(value) // 4, -1]])[2]
        less, more = value < pivot, value > pivot
        parts = rows[less], rows[~(less | more)], rows[more]
        order[first:last] = np.concatenate(parts)
        a, b = first + len(parts[0]), last - len(parts[2])
        todo += [(first, a, w), (a, b, w + 1), (b, last, w)]
    return order


def settle(suffix: list, before: list, rank: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which strings of the given spans have an earlier equal one among them:
    a row per span, a column per number of bytes left of the anchor. Also the
    strings' fingerprints, and for each span whether its gram is the first or
    last of the sorted spans."""
    n = len(suffix)
    wide = WIDTH - 1 + LENGTH
    text = np.zeros((n, WIDTH - 1 + wide + -wide % 8), np.uint8)
    left = np.fromiter(map(len, before), np.int64, n)
    ends = np.fromiter(map(len, suffix), np.int64, n)
    for i, (a, b) in enumerate(zip(before, suffix)):
        text[i, WIDTH - 1 - len(a) : WIDTH - 1] = np.frombuffer(a, np.uint8)
        text[i, WIDTH - 1 : WIDTH - 1 + len(b)] = np.frombuffer(b, np.uint8)
    right = np.ascontiguousarray(text[:, WIDTH - 1 :])
    order = multikey_order(right.view(">u8"))
    # common prefix in bytes with the span before
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = right[order[:-1]], right[order[1:]]
        common[1:] = np.where((a != b).any(axis=1), (a != b).argmax(axis=1), right.shape[1])
        common[1:] = np.minimum(common[1:], np.minimum(ends[order[:-1]], ends[order[1:]]))
    up, down = _power_tables(text.shape[1] + 1)
    acc = np.zeros((n, text.shape[1] + 1), U64)
    np.cumsum(_BYTE[text] * up[: text.shape[1]], axis=1, out=acc[:, 1:])
    gone, prints = np.zeros((n, WIDTH), bool), np.zeros((n, WIDTH), U64)
    for d in range(WIDTH):
        a = WIDTH - 1 - d
        prints[:, d] = mix((acc[:, a + LENGTH] - acc[:, a]) * down[a])
        has = (left >= d) & (left - count < d)
        rows = order[has[order]]
        if not len(rows):
            continue
        part = np.cumsum(common < LENGTH - d)[has[order]]
        before_print = mix((acc[rows, WIDTH - 1] - acc[rows, a]) * down[a])
        by = np.lexsort((rank[rows], before_print, part))
        p, q = part[by], before_print[by]
        again = np.zeros(len(rows), bool)
        again[1:] = (p[1:] == p[:-1]) & (q[1:] == q[:-1])
        gone[rows[by], d] = again
    edge = np.zeros(n, bool)
    gram = np.cumsum(common < GRAM)
    edge[order[(gram == gram[0]) | (gram == gram[-1])]] = True
    return gone, prints, edge


def _compared(suffixes: DataFrame, parts: int) -> DataFrame:
    """Removed pieces (print null) and the boundary grams' strings that no
    earlier one of the same partition equals (with print)."""
    schema = "id long, version long, start int, end int, print long"

    def run(it):
        got = [b for b in batches(it)]
        if not got:
            return
        t = pa.Table.from_batches(got)
        suffix, before = t.column("suffix").to_pylist(), t.column("before").to_pylist()
        ids, version, start, count = (t.column(c).to_numpy().astype(np.int64) for c in ("id", "version", "start", "count"))
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((start, version, ids))] = np.arange(len(ids))
        gone, prints, edge = settle(suffix, before, rank, count)
        left = np.fromiter(map(len, before), np.int64, len(before))
        flat = np.flatnonzero(gone)
        row, d = flat // WIDTH, flat % WIDTH
        at = start[row] + left[row] - d
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(version[row]), pa.array(at.astype(np.int32)), pa.array((at + LENGTH).astype(np.int32)), pa.nulls(len(row), pa.int64())], names=["id", "version", "start", "end", "print"])
        has = (left[:, None] >= np.arange(WIDTH)) & ((left - count)[:, None] < np.arange(WIDTH)) & ~gone & edge[:, None]
        row, d = np.nonzero(has)
        at = start[row] + left[row] - d
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(version[row]), pa.array(at.astype(np.int32)), pa.array((at + LENGTH).astype(np.int32)), pa.array(prints[row, d].view(np.int64))], names=["id", "version", "start", "end", "print"])

    return suffixes.repartitionByRange(parts, "suffix", "id", "version", "start").mapInArrow(run, schema)


def removals(docs: DataFrame) -> DataFrame:
    """(id, version, start, end) of byte ranges to remove; ranges overlap."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(24, max(3, int(total >> 23).bit_length()))
    found = stored(_settled(_packed(docs, bits)), "runs")
    suffixes = stored(_suffixes(docs, found.where("not settled").select("id", "version", "start", "count", "left")), "suffixes")
    size = suffixes.agg(F.sum(F.octet_length("suffix") + F.octet_length("before"))).first()[0] or 0
    pieces = stored(_compared(suffixes, int(size // (8 << 20)) + 2), "pieces")
    edges = pieces.where("print is not null")
    first = edges.groupBy("print").agg(F.min(F.struct("id", "version", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    late = edges.join(first, "print").where(F.struct("id", "version", "start") != F.col("first"))
    whole = found.where("settled").select("id", "version", "start", (F.col("start") + F.col("count") - 1 + LENGTH).alias("end"))
    return whole.union(pieces.where("print is null").select("id", "version", "start", "end")).union(late.select("id", "version", "start", "end"))


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NONE)).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the maximal removed byte ranges
    and the bytes that are left."""
    own = _prepared(docs, id_col, text_col)
    gone = removals(own).groupBy("id", "version").agg(F.collect_set(F.struct("start", "end")).alias("gone"))
    joined = own.join(gone, ["id", "version"], "left").select("id", "text", "gone")

    def run(it):
        for b in batches(it):
            rows = []
            for i, text, want in zip(*(b.column(c).to_pylist() for c in ("id", "text", "gone"))):
                raw, spans, kept, at = text.encode("utf-8", "surrogatepass"), [], [], 0
                for x in sorted((x["start"], x["end"]) for x in want or ()):
                    if spans and x[0] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], x[1])
                    else:
                        spans.append({"start": x[0], "end": x[1]})
                for x in spans:
                    kept.append(raw[at : x["start"]])
                    at = x["end"]
                rows.append((None if i == NONE else i, len(raw), spans, b"".join([*kept, raw[at:]])))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["id", "n_bytes", "spans", "kept"])

    out = joined.mapInArrow(run, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
