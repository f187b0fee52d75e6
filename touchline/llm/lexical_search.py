"""Ranked lexical search over an inverted index in segments.

``build`` turns documents into index segments: a task cuts its part of the
input into runs of some ``SEGMENT_BYTES`` of text and writes, for each run, one
row a term (the ordinals of the documents that hold it and how often) and one
row without term that lists the documents and their lengths. No text is
shuffled, and a segment is of bounded size however rows are dealt.

``search`` answers queries in blocks of bounded size, each against every
segment. Posting lists meet the queries that use their term in a join and are
gathered by segment; there a query runs in two parts:

* term at a time: its short lists are summed into accumulators;
* document at a time: the accumulators, now one iterator whose largest value is
  known, and the long lists are passed together over windows of documents. A
  window whose bounds cannot reach the k-th best score so far is skipped; in
  the others, the lists that cannot lift a document there on their own are only
  probed at the documents that are still in question.

Scores are integers (see ``search``), so the order of summing does not matter.
The best ``k`` of each segment are merged in two steps, first within groups of
segments, then a query.

Defined results: a null or empty text has no terms; a document without terms is
never found; each query row is a query of its own, also where ids repeat or are
null; repeated document rows are documents of their own; equal scores go by
ascending document id, null last; extra columns are ignored; an empty table of
either kind gives an empty result. Texts are read in pieces, so a long one
takes the memory of its distinct terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import stored

SEGMENT_BYTES = 8 << 20
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: Documents of a window, in which a list has one upper bound.
WINDOW = 512
#: Pairs of query and term in one block of queries.
BLOCK_PAIRS = 1 << 17
#: Pairs up to which the queries' side of the join is broadcast (some 40 bytes
#: each); beyond it, the join shuffles by term and salt.
BROADCAST_PAIRS = 1 << 19
SALTS = 64

# letters and digits of ASCII and all bytes above stay, upper case is lowered;
# every other byte separates terms
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(text: bytes) -> Counter:
    """Terms of a text in UTF-8, and how often each occurs."""
    if len(text) <= PIECE:
        return Counter(text.translate(_TABLE).split())
    found, rest = Counter(), b""
    for at in range(0, len(text), PIECE):
        piece = rest + text[at:at + PIECE].translate(_TABLE)
        cut = piece.rfind(b" ") + 1
        found.update(piece[:cut].split())
        rest = piece[cut:]
    found.update(rest.split())
    return found


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    return batch.column(at).cast(pa.large_binary()).to_pylist()


def _segment_schema(id_type: T.DataType) -> T.StructType:
    ints = T.ArrayType(T.IntegerType(), False)
    return T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("term", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("ords", ints), T.StructField("tfs", ints),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.LongType(), False))])


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index rows of all documents: ``segment, term, n`` (documents that hold
    the term), ``ords, tfs``; the row of the documents has a null term, their
    ``ids`` and their ``lengths`` in terms."""
    schema = _segment_schema(docs.schema[id_col].dataType)

    def lists(parts: list, kind: pa.DataType) -> pa.Array:
        ends = np.zeros(len(parts) + 1, np.int32)
        np.cumsum([len(x) for x in parts], out=ends[1:])
        flat = np.fromiter(chain.from_iterable(parts), np.int32, int(ends[-1]))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, lengths, ords, tfs, size = [], [], {}, {}, 0
        arrow = None

        def segment() -> Iterator[pa.RecordBatch]:
            number = (task << 32) + made
            empty = pa.array([None], pa.list_(pa.int32()))
            documents = [pa.array([number], pa.int64()), pa.array([None], pa.string()), pa.array([len(ids)], pa.int64()), empty, empty,
                         pa.array([ids], pa.list_(arrow)), pa.array([lengths], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(documents, names=schema.names)
            terms = sorted(ords)
            for at in range(0, len(terms), 8192):
                some = terms[at:at + 8192]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), number), pa.int64()), pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array([len(ords[t]) for t in some], pa.int64()),
                    lists([ords[t] for t in some], pa.int32()), lists([tfs[t] for t in some], pa.int32()),
                    pa.nulls(len(some), pa.list_(arrow)), pa.nulls(len(some), pa.list_(pa.int64()))], names=schema.names)

        for batch in batches:
            arrow = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), _texts(batch, 1)):
                counts = count_terms(text) if text else {}
                here = len(ids)
                ids.append(key)
                lengths.append(sum(counts.values()))
                for term, tf in counts.items():
                    if term in ords:
                        ords[term].append(here)
                        tfs[term].append(tf)
                    else:
                        ords[term], tfs[term] = [here], [tf]
                size += len(text or b"") + 64
                if size >= segment_bytes:
                    yield from segment()
                    made, size = made + 1, 0
                    ids, lengths, ords, tfs = [], [], {}, {}
        if ids:
            yield from segment()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(index, schema)


def query_terms(queries: DataFrame) -> DataFrame:
    """``item, term, repeats`` of the queries' ``item, text``."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _texts(batch, 1)):
                counts = count_terms(text) if text else {}
                if counts:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([item] * len(counts), pa.int64()), pa.array(list(counts), pa.binary()).cast(pa.string()),
                        pa.array(list(counts.values()), pa.int64())], names=["item", "term", "repeats"])

    return queries.select("item", "text").mapInArrow(terms, "item long, term string, repeats long")


class PostingList:
    """A term's documents in one segment with the part of the score that its
    count gives, and upper bounds of it by window."""

    __slots__ = ("ords", "parts", "most", "bounds", "first")

    def __init__(self, ords: np.ndarray, tfs: np.ndarray, m: np.ndarray):
        tf = tfs.astype(np.int64)
        self.ords = ords
        self.parts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[ords])
        self.most = int(self.parts.max())
        windows = -(-len(m) // WINDOW)
        self.first = np.searchsorted(ords, np.arange(windows + 1) * WINDOW)
        full = np.flatnonzero(np.diff(self.first))
        self.bounds = np.zeros(windows, np.int64)
        self.bounds[full] = np.maximum.reduceat(self.parts, self.first[full])


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """25 + (75 * length * n_docs) div n_terms, in 64 bits where those hold it."""
    if len(lengths) and int(lengths.max()) * 75 * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 25 + 75 * lengths * n_docs // n_terms


def best(lists: list[tuple[int, PostingList]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ordinals and scores of all documents of a segment whose score is among
    the ``k`` highest, ties included; ``lists`` with their weights."""
    lists = sorted((x for x in lists if x[0] > 0), key=lambda x: len(x[1].ords))
    # term at a time: short lists, together at most an eighth of the documents
    acc, spent, short = np.zeros(n_docs, np.int64), 0, 0
    for weight, postings in lists:
        spent += len(postings.ords)
        if spent * 8 > n_docs:
            break
        acc[postings.ords] += weight * postings.parts
        short += 1
    summed = acc[acc > 0]
    least = max(1, int(np.partition(summed, -k)[-k])) if len(summed) >= k else 1
    rest = sorted(lists[short:], key=lambda x: -x[0] * x[1].most)
    if not rest:
        docs = np.flatnonzero(acc >= least)
        return docs, acc[docs]
    # document at a time: bounds[j] is what lists j, j + 1, ... can add in a window
    bounds = np.cumsum(np.array([w * p.bounds for w, p in rest])[::-1], axis=0)[::-1]
    tops = np.maximum.reduceat(acc, np.arange(0, n_docs, WINDOW))
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for window in range(len(tops)):
        if tops[window] + bounds[0, window] < least:
            continue
        base = window * WINDOW
        score = acc[base:base + WINDOW].copy()
        asked = (score > 0) & (score + bounds[0, window] >= least)
        j = 0
        while j < len(rest) and bounds[j, window] >= least:  # lists that alone may lift a document
            weight, p = rest[j]
            part = slice(p.first[window], p.first[window + 1])
            here = p.ords[part] - base
            score[here] += weight * p.parts[part]
            asked[here] = True
            j += 1
        left = bounds[j, window] if j < len(rest) else 0
        alive = np.flatnonzero(asked & (score + left >= least))
        while j < len(rest) and len(alive):  # the others are probed
            weight, p = rest[j]
            begin, end = p.first[window], p.first[window + 1]
            if begin < end:
                at = begin + np.searchsorted(p.ords[begin:end], alive + base)
                hit = p.ords[np.minimum(at, end - 1)] == alive + base
                score[alive[hit]] += weight * p.parts[at[hit]]
            j += 1
            left = bounds[j, window] if j < len(rest) else 0
            alive = alive[score[alive] + left >= least]
        if len(alive):
            docs, scores = np.concatenate([docs, alive + base]), np.concatenate([scores, score[alive]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
                stay = scores >= least
                docs, scores = docs[stay], scores[stay]
    return docs, scores


def _places(ids: list) -> np.ndarray:
    """Ranks of the documents by id, null last."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    places = np.empty(len(ids), np.int64)
    places[order] = np.arange(len(ids))
    return places


def _ranked(segment: pa.Table, n_docs: int, n_terms: int, k: int) -> pa.Table:
    segment = segment.combine_chunks()
    header = segment.filter(pc.is_null(segment["term"]))
    rows = segment.filter(pc.is_valid(segment["term"]))
    ids_column = header["ids"].combine_chunks().flatten()
    ids = ids_column.to_pylist()
    m = length_norms(np.array(header["lengths"][0].as_py(), np.int64), n_docs, n_terms)
    asked: dict[int, list] = {}
    if len(rows):
        flat = {}
        for name in ("ords", "tfs", "users"):
            column = rows[name].combine_chunks()
            flat[name] = (column.offsets.to_numpy(), column.values)
        (ends, ords), tfs = flat["ords"], flat["tfs"][1].to_numpy()
        ords = ords.to_numpy()
        users, pairs = flat["users"]
        items, weights = pairs.field("item").to_numpy(), pairs.field("weight").to_numpy()
        for i in range(len(rows)):
            postings = PostingList(ords[ends[i]:ends[i + 1]], tfs[ends[i]:ends[i + 1]], m)
            for j in range(users[i], users[i + 1]):
                asked.setdefault(int(items[j]), []).append((int(weights[j]), postings))
    places = _places(ids)
    out_items, out_docs, out_scores = [], [], []
    for item, lists in asked.items():
        docs, scores = best(lists, len(ids), k)
        first = np.lexsort((places[docs], -scores))[:k]
        out_items.append(np.full(len(first), item))
        out_docs.append(docs[first])
        out_scores.append(scores[first])
    none = [np.zeros(0, np.int64)]
    return pa.table({
        "item": pa.array(np.concatenate(out_items or none), pa.int64()),
        "segment": pa.array(np.full(sum(map(len, out_docs)), header["segment"][0].as_py()), pa.int64()),
        "doc_id": ids_column.take(pa.array(np.concatenate(out_docs or none))),
        "score": pa.array(np.concatenate(out_scores or none), pa.int64())})


def search(index: DataFrame, queries: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every
    row of ``queries`` (``item_id, text``). ``index`` comes from ``build`` and
    is read three times, so store it.

    A term that df of N documents hold weighs floor(1000 ln((2N+2)/(2df+1)));
    a document of n terms, of L in all, has m = 25 + (75 n N) div L; a term with
    tf occurrences adds its weight times (10^9 tf) div (1000 tf + 8 m), once for
    each time the query repeats it."""
    spark = index.sparkSession
    lengths = index.where("term is null").select(F.explode("lengths").alias("n"))
    seen = lengths.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_segments = index.where("term is null").count()
    id_type = index.schema["ids"].dataType.elementType
    numbered = stored(queries.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "queries")
    terms = stored(query_terms(numbered), "query-terms")
    pairs = terms.count()
    empty = T.StructType([numbered.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    if not seen["docs"] or not pairs:
        return spark.createDataFrame([], empty)
    few = pairs <= broadcast_pairs
    n_docs, n_terms, blocks = seen["docs"], seen["terms"], -(-pairs // block_pairs)

    held = index.where("term is not null").select("term", "n")
    wanted = terms.select("term").distinct()
    df = held.join(F.broadcast(wanted) if few else wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * F.lit(float(n_docs)) + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    users = (terms.join(df, "term").withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
             .groupBy("term", "block").agg(F.collect_list(F.struct("item", (weight * F.col("repeats")).alias("weight"))).alias("users")))

    postings = index.where("term is not null").select("segment", "term", "ords", "tfs")
    if few:
        met = postings.join(F.broadcast(users), "term")
    else:
        spread = users.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = postings.withColumn("salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS)).cast("int")).join(spread, ["term", "salt"]).drop("salt")
    documents = index.where("term is null").select("segment", "term", "ids", "lengths").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    gathered = met.unionByName(documents, allowMissingColumns=True)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("segment", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    found = gathered.groupBy("segment", "block").applyInArrow(lambda t: _ranked(t, n_docs, n_terms, k), schema)

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = F.pmod(F.xxhash64("segment"), F.lit(max(1, round(n_segments ** 0.5))))
    near = found.withColumn("some", some).withColumn("r", F.row_number().over(Window.partitionBy("item", "some").orderBy(*order))).where(F.col("r") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    top = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
