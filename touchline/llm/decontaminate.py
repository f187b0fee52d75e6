"""Benchmark decontamination with an FM-index per training shard.

Words are the runs of characters that match ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z. A test phrase is each window of ``window`` consecutive
words of a benchmark item; an item with fewer words, but not none, is one
phrase. A shard is about ``shard_bytes`` of consecutive whole documents of a
partition. Words that no phrase has can never lie inside an occurrence, so the
shard's sequence keeps only the runs of phrase words that are as long as the
shortest phrase; it is indexed, all phrases are searched backward through
wavelet-tree ranks, occurrences are located from sampled suffix positions, and
overlapping or touching ones are merged into spans. There is no shuffle.

Words are compared by 64-bit fingerprints.

The distinct phrases, with the items of each, are a table that Spark makes. It
is dealt by hash to blocks of about ``block_bytes`` of phrases; one pass over
the documents follows for each block and is stored before the next, so what
the driver and a worker hold has that bound whatever the benchmark's size, and
however often its rows repeat.

Defined results: a null or empty text has no words and no hits; so has a null
benchmark text; phrases of an item without id count as hits and are listed
under no item. Repeated documents and items are treated one by one. Other
columns of ``docs`` are kept; the operator's own columns are ``n_words``,
``items`` and ``spans`` (byte offsets in the UTF-8 text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import WORD_ALNUM, batches, chunks, fingerprints, lowered, words
from touchline.llm.common import stored
from touchline.llm.fmindex import FMIndex


def phrase_table(benchmark: DataFrame, window: int) -> DataFrame:
    """``phrase`` (the fingerprints of its words, eight bytes each) and the
    sorted ``items`` that have it, of (item, text)."""
    item = benchmark.schema["item"].dataType.simpleString()

    def run(it):
        for b in batches(it):
            for first, last, data, offsets in chunks(b.column("text").to_pylist(), 1 << 22):
                low = lowered(data)
                s, e = words(low, WORD_ALNUM)
                h = fingerprints(low, s, e)
                edge = np.searchsorted(s, offsets)
                for i in range(last - first):
                    own = h[edge[i] : edge[i + 1]]
                    if not len(own):
                        continue
                    rows = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                    for at in range(0, len(rows), 8192):
                        part = [x.tobytes() for x in rows[at : at + 8192]]
                        who = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(part), np.int32)), b.column("item").slice(first + i, 1)).dictionary_decode()
                        yield pa.RecordBatch.from_arrays([who, pa.array(part, pa.binary())], names=["item", "phrase"])

    found = benchmark.select("item", "text").mapInArrow(run, f"item {item}, phrase binary")
    return found.groupBy("phrase").agg(F.array_sort(F.collect_set("item")).alias("items"))


def block_of(rows: list) -> dict:
    """Phrases of a block for the search: the sorted fingerprints of their
    words (symbol 1, 2, ...), a row of symbols for each, and their items."""
    if not rows:
        return {"vocab": np.zeros(0, np.uint64), "table": np.zeros((0, 1), np.int64), "lengths": np.zeros(0, np.int64), "items": []}
    flat = np.frombuffer(b"".join(bytes(r["phrase"]) for r in rows), np.uint64)
    lengths = np.array([len(r["phrase"]) // 8 for r in rows], np.int64)
    vocab = np.unique(flat)
    table = np.zeros((len(rows), int(lengths.max())), np.int64)
    table[np.arange(table.shape[1]) < lengths[:, None]] = np.searchsorted(vocab, flat) + 1
    return {"vocab": vocab, "table": table, "lengths": lengths, "items": [list(r["items"]) for r in rows]}


class Searcher:
    """Finds one block's phrases in shards."""

    def __init__(self, block: dict):
        self.vocab, self.table, self.lengths, self.items = (block[k] for k in ("vocab", "table", "lengths", "items"))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocab >> np.uint64(48)).astype(np.int64)] = True

    def symbols(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(48)).astype(np.int64)])
        place = np.searchsorted(self.vocab, h[at])
        same = self.vocab[np.minimum(place, len(self.vocab) - 1)] == h[at]
        out[at[same]] = place[same] + 1
        return out

    def search(self, data: bytes, offsets: np.ndarray) -> tuple:
        """Of each document: number of words, items, merged spans (bytes from
        the document's start) and hit words."""
        low = lowered(data)
        s, e = words(low, WORD_ALNUM)
        edge = np.searchsorted(s, offsets)
        n_words = np.diff(edge)
        symbol = self.symbols(fingerprints(low, s, e))
        doc = np.repeat(np.arange(len(n_words)), n_words)
        known = symbol > 0
        start = known.copy()
        start[1:] &= ~known[:-1] | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(start)
        stop = known.copy()
        stop[:-1] &= ~known[1:] | (doc[1:] != doc[:-1])
        lens = np.flatnonzero(stop) + 1 - begin
        long = lens >= (self.lengths.min() if len(self.lengths) else 1)
        begin, lens = begin[long], lens[long]
        none = np.zeros(0, np.int64)
        if not len(begin):
            return n_words, none, none, [[] for _ in n_words], s, e, edge
        run_starts = np.cumsum(lens) - lens
        where = np.arange(lens.sum()) + np.repeat(begin - run_starts, lens)
        index = FMIndex(symbol[where], run_starts, len(self.vocab) + 1)
        who, at = index.locate(self.table, self.lengths)
        at = where[at]
        cover = np.zeros(len(s) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.lengths[who], -1)
        hit = np.cumsum(cover[:-1]) > 0
        first = hit.copy()
        first[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
        final = hit.copy()
        final[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
        items: list = [[] for _ in n_words]
        pair = np.unique(doc[at] * len(self.table) + who) if len(at) else none
        for d, p in zip((pair // len(self.table)).tolist(), (pair % len(self.table)).tolist()):
            items[d] += self.items[p]
        return n_words, np.flatnonzero(first), np.flatnonzero(final), items, s, e, edge


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, shard_bytes: int = 4 << 20, block_bytes: int = 16 << 20, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` with n_words, items (sorted ids found) and spans (first byte,
    end byte, first word, end word of each merged hit)."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).alias("item"), F.col("text").alias("text"))
    found = stored(phrase_table(bench, window), "phrases")
    size = found.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    item_type = dict(bench.dtypes)["item"]
    out = docs.withColumns({
        "n_words": F.lit(None).cast("bigint"),
        "items": F.array().cast(f"array<{item_type}>"),
        "spans": F.array().cast("array<struct<start:bigint,end:bigint,first_word:bigint,end_word:bigint>>"),
    })
    for k in range(blocks):
        block = block_of(list(found.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k).toLocalIterator()))
        out = _pass(out, spark.sparkContext.broadcast(block), shard_bytes, text_col)
        if k + 1 < blocks:
            out = stored(out, "searched")
    return out


def _pass(docs: DataFrame, shared, shard_bytes: int, text_col: str) -> DataFrame:
    def run(it):
        searcher = Searcher(shared.value)
        for b in batches(it):
            texts = b.column(text_col).to_pylist()
            old_items = b.column("items").to_pylist()
            old_spans = b.column("spans").to_pylist()
            n_words: list = []
            for first, last, data, offsets in chunks(texts, shard_bytes):
                n, begin, end, items, s, e, edge = searcher.search(data, offsets)
                n_words += n.tolist()
                for d in np.flatnonzero([bool(x) for x in items]).tolist():
                    old_items[first + d] = sorted(set(old_items[first + d]) | set(items[d]))
                owner = np.searchsorted(edge, begin, "right") - 1
                for d, f, l in zip(owner.tolist(), begin.tolist(), end.tolist()):
                    old_spans[first + d].append({"start": int(s[f] - offsets[d]), "end": int(e[l] - offsets[d]), "first_word": int(f - edge[d]), "end_word": int(l + 1 - edge[d])})
            out = {"n_words": pa.array(n_words, pa.int64()), "items": old_items, "spans": [_merged(x) for x in old_spans]}
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if f.name in out else b.column(f.name) for f in b.schema], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def _merged(spans: list) -> list:
    """Spans of several blocks, joined where their words overlap or touch."""
    out: list = []
    for x in sorted(spans, key=lambda x: x["start"]):
        if out and x["first_word"] <= out[-1]["end_word"]:
            if x["end_word"] > out[-1]["end_word"]:
                out[-1] |= {"end": x["end"], "end_word": x["end_word"]}
        else:
            out.append(dict(x))
    return out


def n_hit() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end_word"] - x["first_word"])


def removed(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents of ``find`` with the hit spans cut out of their texts,
    without the operator's own columns. Texts without a hit stay as they are."""
    kept = [f for f in found.columns if f not in ("n_words", "items", "spans")]
    raw = F.encode(text_col, "UTF-8")
    n = F.size("spans")
    gaps = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.decode(
            F.substring(
                raw,
                (F.when(i == 0, F.lit(0)).otherwise(F.get("spans", i - 1)["end"]) + 1).cast("int"),
                (F.when(i == n, F.octet_length(text_col)).otherwise(F.get("spans", i)["start"]) - F.when(i == 0, F.lit(0)).otherwise(F.get("spans", i - 1)["end"])).cast("int"),
            ),
            "UTF-8",
        ),
    )
    cut = F.when(n > 0, F.array_join(gaps, "")).otherwise(F.col(text_col))
    return found.select(*[cut.alias(c) if c == text_col else F.col(c) for c in kept])
