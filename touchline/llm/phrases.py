"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are parsed into phrases level by level. On each level,
runs of one symbol are folded first; then deterministic coin tossing gives
every symbol a small label from its lowest bit that differs from the left
neighbour's, three times over, and a symbol whose label is a local minimum
starts a phrase. A phrase's name is a fingerprint of its symbols, the next
level's symbol. Cuts depend on a few neighbours only, so equal substrings get
equal phrases but at their ends, wherever they stand.

The features of a text are its phrase names of the levels in ``LEVELS`` (some
twelve and forty bytes long) and of any shorter top; the fingerprint is the
``KEEP`` smallest of them in hex, and the likeness of two fingerprints is the
usual estimate of the sets' Jaccard similarity from such sketches.

``pairs_with_next`` compares each document with its edited text and with the
next document. Documents are dealt to ranges of (id, hash of the text) by
sampled splitters; the first document of every range also goes to the range
before, as the last one's successor. A task reads its ranges in order and holds
some ``BATCH`` bytes of them, however long a range is; wholly equal rows travel
as one with their number.

Defined results: a null text counts as empty; the fingerprint of an empty text
is empty and like an empty one only; rows without id come first; rows that
repeat an id follow each other in the order of a hash of their texts; a single
row is its own successor. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import U64, mix

LEVELS = (2, 3)
TOP = 3
KEEP = 64
SLICE = 1 << 19  # bytes parsed at once
BATCH = 4 << 20  # bytes of texts that a task holds before it compares them
RANGES = 1 << 14  # most ranges, so most splitters on the driver; larger tables have longer ranges
SAMPLED = 16  # sampled keys for a splitter
_WEIGHT = mix(np.arange(1, 4097, dtype=U64)) | U64(1)


def _labels(sym: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Coin tossing: labels below 8 that differ from the left neighbour's.
    ``fresh`` marks the first symbol of each text."""
    for _ in range(3):
        left = np.concatenate([sym[:1], sym[:-1]])
        diff = sym ^ left
        low = np.bitwise_count((diff & (~diff + diff.dtype.type(1))) - diff.dtype.type(1))
        bit = (sym >> low.astype(sym.dtype)) & sym.dtype.type(1)
        label = (2 * low + bit).astype(np.uint8)
        label[fresh] = sym[fresh].astype(np.uint8) & 7 if sym.dtype == np.uint8 else (sym[fresh] & sym.dtype.type(7)).astype(np.uint8)
        sym = label
    return sym


def _folded(sym: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple:
    """Runs of one symbol as one symbol, named by symbol and length."""
    first = np.ones(len(sym), bool)
    first[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(sym))).astype(U64)
    return mix(sym[at].astype(U64) + length * U64(0x9E3779B97F4A7C15)), doc[at], start[at]


def _level(sym: np.ndarray, doc: np.ndarray, raw: np.ndarray | None) -> tuple:
    """Phrase names of one level: (names, documents). ``raw`` are the folded
    bytes on the ground level, whose labels are cheaper to find."""
    fresh = np.ones(len(sym), bool)
    fresh[1:] = doc[1:] != doc[:-1]
    label = _labels(sym if raw is None else raw, fresh)
    cut = fresh.copy()
    low = np.ones(len(sym), bool)
    low[1:] &= label[1:] < label[:-1]
    low[:-1] &= label[:-1] <= label[1:]
    last = np.append(fresh[1:], True)
    cut |= low & ~last
    cut[1:] &= ~cut[:-1] | fresh[1:]  # no phrase of one symbol but at an end
    at = np.flatnonzero(cut)
    place = np.arange(len(sym)) - np.repeat(at, np.diff(np.append(at, len(sym))))
    names = mix(np.add.reduceat(mix(sym) * _WEIGHT[place % len(_WEIGHT)] + (place // len(_WEIGHT)).astype(U64), at))
    return names, doc[at]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, name) of the phrases of all texts."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    docs, names = [], []
    sym = raw
    for level in range(1, TOP + 1):
        if not len(sym):
            break
        folded, d, s = _folded(sym, doc, sym)
        sym, doc = _level(folded, d, None if level > 1 else s)
        count = np.bincount(doc, minlength=len(texts))
        take = np.ones(len(sym), bool) if level in LEVELS else count[doc] == 1
        docs.append(doc[take])
        names.append(mix(sym[take] + U64(level)))
    if not docs:
        return np.zeros(0, np.int32), np.zeros(0, U64)
    return np.concatenate(docs), np.concatenate(names)


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """The ``KEEP`` smallest distinct features of each text, in order."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE):
            size += len(texts[end])
            end += 1
        doc, name = features(texts[at:end])
        order = np.lexsort((name, doc))
        doc, name = doc[order], name[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
        doc, name = doc[new], name[new]
        edge = np.searchsorted(doc, np.arange(end - at + 1))
        out += [name[a : min(b, a + KEEP)] for a, b in zip(edge[:-1], edge[1:])]
        at = end
    return out


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard estimate: of the smallest names of both, the share in each."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:KEEP]
    return float(np.isin(both, np.intersect1d(a, b)).mean())


def compared(texts: list[str], after: list[str]) -> pd.DataFrame:
    """Fingerprints and likenesses of texts, their edited texts and the next ones."""
    edited = []
    for t, nxt in zip(texts, after):
        half = len(t) // 2
        edited.append((t[: len(t) - half] + nxt[:half]).encode("utf-8", "surrogatepass"))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    own, new, nxt = sketches(raw), sketches(edited), sketches([t.encode("utf-8", "surrogatepass") for t in after[-1:]])
    following = own[1:] + nxt
    return pd.DataFrame({
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(x).hexdigest() for x in edited],
        "fingerprint": [as_text(x) for x in own],
        "edited_fingerprint": [as_text(x) for x in new],
        "near_edited": [likeness(a, b) for a, b in zip(own, new)],
        "near_next": [likeness(a, b) for a, b in zip(own, following)],
    })


def _stream(it):
    """Rows in the order of their ranges -> results. A row's successor is the
    next row of its range, the last one of a range being the next range's."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(ids, texts, times, after):
        out = compared(texts, texts[1:] + [after])
        whose = list(range(len(ids)))
        for i, n in enumerate(times):
            if n > 1:  # all but the last of equal rows follow themselves
                out = pd.concat([out, *[compared(texts[i : i + 1], texts[i : i + 1])] * (n - 1)])
                whose += [i] * (n - 1)
        keys = pa.array([ids[i] for i in whose], pa.int64())
        return pa.RecordBatch.from_arrays([keys, *[pa.array(out[c].tolist()) for c in names[1:]]], names=names)

    now, ids, texts, times, size = None, [], [], [], 0
    for batch in it:
        for part, tail, key, text, n in zip(*(batch.column(c).to_pylist() for c in ("range", "tail", "id", "text", "n"))):
            if part == now and ids and (tail or size >= BATCH):
                yield results(ids, texts, times, text)
                ids, texts, times, size = [], [], [], 0
            now = part
            if not tail:
                ids.append(key)
                texts.append(text)
                times.append(n)
                size += len(text)


def _range_number(splits: list) -> F.Column:
    """How many splitters are at or below (k, version), by binary search."""
    if not splits:
        return F.lit(0)
    every = F.from_json(F.lit(json.dumps([{"k": k, "version": v} for k, v in splits])), "array<struct<k:bigint,version:bigint>>")
    steps = F.array(*[F.lit(1 << i) for i in range(len(splits).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(splits)) & (F.get(every, at + step - 1) <= F.struct("k", "version")), at + step).otherwise(at))


def pairs_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = 8 << 20) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row."""
    text = F.coalesce(text_col, F.lit(""))
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("k"), F.xxhash64(text).alias("version"), text.alias("text"))
    n_bytes, rows = own.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    ranges = int(max(1, min((n_bytes or 0) // range_bytes, rows, RANGES)))
    keys = own.select("k", "version")
    splits: list = []
    if ranges > 1:
        found = sorted({tuple(r) for r in keys.sample(min(1.0, SAMPLED * ranges / rows), 11).collect()})
        splits = sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []
    number = _range_number(splits).alias("range")
    if keys.groupBy("k", "version").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        own = own.withColumn("n", F.lit(1).cast("bigint"))
    else:  # equal rows are one with their number
        own = own.groupBy("id", "k", "version").agg(F.min("text").alias("text"), F.count("*").alias("n"))
    # the first key of every range, at most RANGES of them, goes to the range before as well
    heads = sorted(tuple(r) for r in keys.select(number, F.struct("k", "version").alias("x")).groupBy("range").agg(F.min("x").alias("x")).select("range", "x.*").collect())
    back = [(heads[i - 1][0], k, v) for i, (_, k, v) in enumerate(heads)]
    first = own.sparkSession.createDataFrame(back or [(0, 0, 0)], "range int, k long, version long")
    tails = own.select("k", "version", "text").join(F.broadcast(first), ["k", "version"]).groupBy("range", "k", "version").agg(F.min("text").alias("text"))
    mine = own.select(number, F.lit(0).alias("tail"), "id", "k", "version", "text", "n")
    dealt = mine.unionByName(tails.select("range", F.lit(1).alias("tail"), "k", "version", "text"), allowMissingColumns=True)
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    out = dealt.repartition("range").sortWithinPartitions("range", "tail", "k", "version").select("range", "tail", "id", "text", "n").mapInArrow(_stream, schema)
    return out.withColumnRenamed("id", id_col)
