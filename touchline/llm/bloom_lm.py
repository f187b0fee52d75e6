"""Language-model scoring from a log-frequency Bloom filter.

Tokens are runs without white space of the text with A-Z lower-cased, and one
end mark per text. The texts are stored once in groups of some ``GROUP`` bytes.
A group sends each of its distinct words and bigrams once, with its count in
the group's training texts, to the bucket of its fingerprint, so what travels
does not grow with the number of buckets that a document's words lie in. A
bucket adds the counts up and writes those n-grams that were learned into its
own segments of one Bloom filter: an n-gram of count c is entered with each
level 1 .. 1 + floor(log2 c), so its quantised count is the last level found
by probing level after level. A segment has ``entry_bits`` bits for every entry
of its bucket, so the filter grows with the distinct n-grams, none is left out,
and an n-gram that was never seen passes for one with a chance of about 2.4
percent (at ``ENTRY_BITS``).

The bucket answers every group with the exact counts of its words and with the
levels that its segments have of its words and bigrams, held out ones too, in
the order in which they came. A group meets its answers, and its texts are
scored from them. A filter of up to ``broadcast_bytes`` is broadcast instead of
having its levels travel, and is probed for the group's n-grams where they are
scored. Both ways probe the same filter and give the same scores.

Scoring: P(w | v) = x * c(v, w) / c(v) + (1 - x) * P(w) with
P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)); counts come from the filter (those
of the frequent words below are exact), N tokens and V distinct ones are
exact. The weight x is the one of ``WEIGHTS`` under which all training texts
are likeliest when each token's own occurrence is taken off the counts; each
text is scored under every weight in one pass.

``base_score`` uses exact counts instead. Words that many documents of a
sample share (at most ``HOT``) are not entered into the filter: their exact
counts are sent to all and stand in for levels too.

Defined results: null and empty texts are one end mark; rows without id are
neither held out nor learned from; rows that repeat an id and text each get
their own result; with no training text every count is 0 and scores are those
of equal chances. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import U64, WORD_NOT_SPACE, batches, chunks, fingerprints, give_back, lowered, mix, words
from touchline.llm.common import stored

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WEIGHTS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5, 0.7)
HOT = 4096
PROBES = 4
ENTRY_BITS = 8
BROADCAST_BYTES = 192 << 20
CHUNK = 1 << 20
STEP = 1 << 17  # tokens that are scored at a time
GROUP = 1 << 22  # bytes of text whose n-grams are sent together
BUCKET = 25  # a bucket has the words of some 2**25 bytes of text
FINER = 3  # and their bigrams in 2**3 segments
END = U64(0x5851F42D4C957F2D)
BEGIN = U64(0x14057B7EF767814F)
_LEVEL = mix(np.arange(1, 65, dtype=U64) * U64(0xA0761D6478BD642F))
_PAIR = U64(0xE7037ED1A0B428DB) | U64(1)


def tokens(texts: list):
    """Per chunk: (first, last, word fingerprints, edges of the documents)."""
    for first, last, data, offsets in chunks(texts, CHUNK):
        low = lowered(data)
        s, e = words(low, WORD_NOT_SPACE)
        yield first, last, fingerprints(low, s, e), np.searchsorted(s, offsets)


def bigrams(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word, fingerprint of both) of every token of a chunk, the
    end marks included, documents one after another."""
    docs = len(edge) - 1
    size = len(h) + docs
    own = np.empty(size, U64)
    end = edge[1:] + np.arange(docs)
    own[end] = END
    word = np.ones(size, bool)
    word[end] = False
    own[word] = h
    before = np.empty(size, U64)
    before[1:] = own[:-1]
    before[edge[:-1] + np.arange(docs)] = BEGIN
    return before, own, mix(before * _PAIR + own)


class Segments:
    """Parts of the filter, chosen by the top ``bits`` bits of a fingerprint:
    the first bit and the number of bits of each within ``data``."""

    def __init__(self, data: np.ndarray, bits: int, first: np.ndarray, size: np.ndarray):
        self.data, self.bits, self.first, self.size = data, bits, first.astype(U64), size.astype(U64)

    def places(self, h: np.ndarray, level: int) -> np.ndarray:
        """Bit numbers of fingerprints on a level: a row per probe."""
        part = (h >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        spare = U64(16 - min(self.bits, 16))  # the lowest bits that buckets do not get to see
        a = mix((h >> spare << spare) ^ _LEVEL[level])
        b = (a >> U64(32)) | U64(1)
        first, size = self.first[part], self.size[part]
        return np.stack([first + ((((a + b * U64(i)) & U64(0xFFFFFFFF)) * size) >> U64(32)) for i in range(PROBES)])

    def enter(self, h: np.ndarray, n: np.ndarray) -> None:
        level = levels(n)
        for j in range(int(level.max()) if len(level) else 0):
            p = self.places(h[level > j], j).ravel()
            np.bitwise_or.at(self.data, (p >> U64(3)).astype(np.int64), (U64(1) << (p & U64(7))).astype(np.uint8))

    def found(self, h: np.ndarray) -> np.ndarray:
        """The last level that is found, 0 if none is."""
        level = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        for k in range(40):
            there = np.ones(len(live), bool)
            for row in self.places(h[live], k):
                there &= (self.data[(row >> U64(3)).astype(np.int64)] >> (row & U64(7)).astype(np.uint8)) & 1 == 1
            live = live[there]
            if not len(live):
                break
            level[live] += 1
        return level

    def counts(self, h: np.ndarray) -> np.ndarray:
        return quantised(self.found(h))


def quantised(level: np.ndarray) -> np.ndarray:
    """Counts by level: 0, or the middle of the counts of that level."""
    return np.where(level == 0, 0.0, np.where(level == 1, 1.0, 1.5 * 2.0 ** (level - 1.0)))


def levels(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(n)).astype(np.int64) + 1 if len(n) else n.astype(np.int64)


def segment(h: np.ndarray, n: np.ndarray, bits: int, bucket: int, entry_bits: int = ENTRY_BITS) -> Segments:
    """A new segment that holds the n-grams of one bucket."""
    size = max(64, -(-int(levels(n).sum()) * entry_bits // 8) * 8)
    if size >= 1 << 32:
        raise ValueError("a bucket has too many n-grams for one segment")
    parts = (bucket + 1 if bits else 1)
    first, sizes = np.zeros(parts, np.int64), np.full(parts, size)
    out = Segments(np.zeros(size // 8, np.uint8), bits, first, sizes)
    out.enter(h, n)
    return out


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``stored``; what was shuffled for it goes as soon as it is written, not
    when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(CLEANUP, before)


def _prepared(docs: DataFrame, id_col: str, text_col: str, folds: int) -> DataFrame:
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("version"), text.alias("text"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.coalesce(fold != 0, F.lit(False)).alias("train"))


def _sampled(docs: DataFrame, n: int, size: int) -> DataFrame:
    """About ``size`` of n rows, by hash."""
    return docs.where(F.pmod(F.xxhash64("id", "version"), F.lit(max(1, n // size))) == 0)


def _hot_words(docs: DataFrame, sample_docs: int) -> np.ndarray:
    """Sorted fingerprints of the words that at least one in 64 documents of a
    sample holds, at most ``HOT``."""
    n = docs.count()
    sample = _sampled(docs, n, sample_docs)

    def run(it):
        for b in batches(it):
            got = [np.unique(h[a:z]) for _, _, h, edge in tokens(b.column("text").to_pylist()) for a, z in zip(edge[:-1], edge[1:])]
            h, c = np.unique(np.concatenate(got), return_counts=True)
            often = c > len(got) // 256  # bounds what is sent; rarer ones are no candidates
            yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(c[often]), pa.array(np.full(often.sum(), len(got)))], names=["h", "c", "n"])

    counted = sample.mapInArrow(run, "h long, c long, n long").groupBy("h").agg(F.sum("c").alias("c"))
    top = counted.where(F.col("c") * 64 >= min(n, sample_docs)).orderBy(F.desc("c"), "h").limit(HOT)
    return np.sort(top.toPandas()["h"].to_numpy(np.int64).view(U64))


def _is_hot(hot: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(h), bool)
    return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h


def _cut(h: np.ndarray, bits: int) -> np.ndarray:
    """Edges of the buckets in sorted fingerprints."""
    part = (h >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    return np.searchsorted(part, np.arange((1 << bits) + 1))


def _six(h: np.ndarray, bits: int) -> bytes:
    """The 48 bits below the bucket's: what a bucket needs to know."""
    return (h >> U64(16 - min(bits, 16)) & U64((1 << 48) - 1)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _whole(six: np.ndarray, bits: int, bucket: int) -> np.ndarray:
    return (U64(bucket) << U64(64 - bits) if bits else U64(0)) | six << U64(16 - min(bits, 16))


def _narrow(n: np.ndarray) -> bytes:
    """Whole numbers, the lowest byte of all, then the next, up to the last
    that one of them needs."""
    n = np.ascontiguousarray(n, "<u8")
    width = max(1, -(-int(n.max()).bit_length() // 8)) if len(n) else 0
    return n.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _wide(parts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The numbers of ``_narrow``, of parts of so many each."""
    out, at = np.zeros((int(sizes.sum()), 8), np.uint8), 0
    for part, size in zip(parts, sizes.tolist()):
        if size:
            planes = np.frombuffer(part, np.uint8).reshape(-1, size)
            out[at : at + size, : len(planes)] = planes.T
        at += size
    return out.view("<i8").ravel()


_GROUPED = "ids array<long>, held_out array<boolean>, train array<boolean>, offsets binary, body binary"


def _grouped(docs: DataFrame, size: int) -> DataFrame:
    """The documents in rows of some ``size`` bytes of text, lower-cased and
    packed; a longer text is a row of its own."""

    def row(docs):
        data = b"\n".join(d[3] for d in docs) + b"\n"
        offsets = np.cumsum([0, *(len(d[3]) + 1 for d in docs)])
        body = pa.Codec("zstd", compression_level=3).compress(lowered(data).tobytes(), asbytes=True)
        lists = [pa.array([[d[c] for d in docs]], pa.list_(t)) for c, t in enumerate((pa.int64(), pa.bool_(), pa.bool_()))]
        return pa.RecordBatch.from_arrays([*lists, pa.array([offsets.tobytes()], pa.binary()), pa.array([body], pa.binary())], names=[x.split()[0] for x in _GROUPED.split(", ")])

    def run(it):
        docs, total = [], 0
        for b in batches(it):
            for *keys, text in zip(*(b.column(c).to_pylist() for c in ("id", "held_out", "train", "text"))):
                text = text.encode("utf-8", "surrogatepass")
                if docs and total + len(text) >= size:
                    yield row(docs)
                    docs, total = [], 0
                docs.append((*keys, text))
                total += len(text) + 1
        if docs:
            yield row(docs)

    return docs.select("id", "held_out", "train", "text").mapInArrow(run, _GROUPED).withColumn("gid", F.monotonically_increasing_id())


def _opened(offsets: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word fingerprints of a group and the edges of its documents."""
    offsets = np.frombuffer(offsets, np.int64)
    low = np.frombuffer(pa.decompress(body, int(offsets[-1]), codec="zstd"), np.uint8)
    h, edge, first = [], [np.zeros(1, np.int64)], 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        part = low[offsets[first] : offsets[last]]
        s, e = words(part, WORD_NOT_SPACE)
        edge.append(edge[-1][-1] + np.searchsorted(s, offsets[first + 1 : last + 1] - offsets[first]))
        h.append(fingerprints(part, s, e))
        first = last
    return np.concatenate(h), np.concatenate(edge)


def _tallied(h: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct fingerprints in order, and how often training has them."""
    seen, n = np.unique(h[train], return_counts=True)
    rest = np.unique(h[~train])
    rest = rest[~_is_hot(seen, rest)]
    at = np.searchsorted(seen, rest)
    return np.insert(seen, at, rest), np.insert(n, at, 0)


_PACKED = "bucket int, gid long, word binary, times binary, pair binary, pair_times binary, cuts binary, hot binary, hot_times binary"


def _packed(groups: DataFrame, hot, bits: int, pair_bits: int) -> DataFrame:
    """Of every group a row for each bucket: its distinct words but the hot
    ones, its bigrams and where those of each segment begin, and the hot words
    of training texts by number, all with their counts in training texts."""

    def run(it):
        top, fine = hot.value, 1 << (pair_bits - bits)
        for b in it:
            for k in range(b.num_rows):
                gid, train, offsets, body = (b.column(c)[k].as_py() for c in ("gid", "train", "offsets", "body"))
                h, edge = _opened(offsets, body)
                train, size = np.array(train, bool), np.diff(edge)
                mine, is_hot = np.repeat(train, size), _is_hot(top, h)
                often, often_n = np.unique(np.searchsorted(top, h[is_hot & mine]), return_counts=True)
                word, n = _tallied(h[~is_hot], mine[~is_hot])
                pair, pair_n = _tallied(bigrams(h, edge)[2], np.repeat(train, size + 1))
                w, t, p = _cut(word, bits), _cut(top[often], bits), _cut(pair, pair_bits)
                rows = []
                for j in range(1 << bits):
                    cuts = p[j * fine : (j + 1) * fine + 1]
                    (a, z), (c, d), (e, f) = w[j : j + 2], (cuts[0], cuts[-1]), t[j : j + 2]
                    if a < z or c < d or e < f:
                        rows.append((j, gid, _six(word[a:z], bits), _narrow(n[a:z]), _six(pair[c:d], pair_bits), _narrow(pair_n[c:d]), (cuts - c).astype(np.uint32).tobytes(), often[e:f].astype(np.uint16).tobytes(), _narrow(often_n[e:f])))
                for at in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 512]), (pa.int32(), pa.int64(), *[pa.binary()] * 7))], names=[x.split()[0] for x in _PACKED.split(", ")])
        give_back()

    return groups.select("gid", "train", "offsets", "body").mapInArrow(run, _PACKED)


def _six_of(parts: list[bytes]) -> np.ndarray:
    """What ``_six`` made, a row of six bytes each."""
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 6)


def _learned(six: np.ndarray, times: np.ndarray, bits: int, bucket: int, entry_bits: int) -> tuple[np.ndarray, np.ndarray, Segments, int]:
    """Of the n-grams that groups sent to one segment: how often each was
    learned, its level, the segment, and how many distinct ones were learned."""
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    key = wide.view("<u8").ravel()
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    n = np.add.reduceat(times[order], at) if len(at) else np.zeros(0, np.int64)
    h = _whole(key[at], bits, bucket)
    made = segment(h[n > 0], n[n > 0], bits, bucket, entry_bits)
    count, level, each = np.empty(len(key), np.int64), np.empty(len(key), np.uint8), np.diff(np.append(at, len(key)))
    count[order], level[order] = np.repeat(n, each), np.repeat(made.found(h).astype(np.uint8), each)
    return count, level, made, int((n > 0).sum())


_COUNTED = "kind int, bucket int, gid long, field binary, size long, vocab long, tokens long, hot array<long>, hot_n array<long>, count binary, level binary, pair_level binary"


def _counted(packed: DataFrame, hot, bits: int, pair_bits: int, entry_bits: int) -> DataFrame:
    """Of every bucket its filter segments: one of words (kind 0), with the
    number of distinct ones and of their tokens and the hot ones with counts,
    and those of bigrams (kind 1). Then its answer to each group (kind 2)."""

    def run(key, table):
        k, fine, top = key[0].as_py(), 1 << (pair_bits - bits), hot.value
        cols = {c: table.column(c).to_pylist() for c in table.column_names}
        del table
        none = dict.fromkeys(("field", "hot", "hot_n", "count", "level", "pair_level")) | {"size": 0, "vocab": 0, "tokens": 0, "gid": -1, "bucket": k}
        # words
        sizes = np.array([len(x) // 6 for x in cols["word"]])
        times = _wide(cols.pop("times"), sizes)
        count, level, made, vocab = _learned(_six_of(cols.pop("word")), times, bits, k, entry_bits)
        often = np.frombuffer(b"".join(cols["hot"]), np.uint16)
        often_n = np.zeros(len(top), np.int64)
        np.add.at(often_n, often, _wide(cols.pop("hot_times"), np.array([len(x) // 2 for x in cols.pop("hot")])))
        used = np.flatnonzero(often_n)
        rows = [none | {"kind": 0, "field": made.data.tobytes(), "size": len(made.data), "vocab": vocab, "tokens": int(times.sum()), "hot": top[used].view(np.int64).tolist(), "hot_n": often_n[used].tolist()}]
        # bigrams, segment by segment
        cuts = np.frombuffer(b"".join(cols.pop("cuts")), np.uint32).reshape(-1, fine + 1).astype(np.int64)
        times, six = _wide(cols.pop("pair_times"), cuts[:, -1]), _six_of(cols.pop("pair"))
        begin = np.cumsum(cuts[:, -1]) - cuts[:, -1]
        pair_level = np.empty(len(six), np.uint8)
        for j in range(fine):
            each = cuts[:, j + 1] - cuts[:, j]
            take = np.repeat(begin + cuts[:, j] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            _, pair_level[take], made, _ = _learned(six[take], times[take], pair_bits, k * fine + j, entry_bits)
            rows.append(none | {"kind": 1, "bucket": k * fine + j, "field": made.data.tobytes(), "size": len(made.data)})
        at, pair_at = np.cumsum([0, *sizes]), np.append(begin, len(six))
        for i, gid in enumerate(cols["gid"]):
            a, z = at[i], at[i + 1]
            rows.append(none | {"kind": 2, "gid": gid, "count": _narrow(count[a:z]), "level": level[a:z].tobytes(), "pair_level": pair_level[pair_at[i] : pair_at[i + 1]].tobytes()})
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
        out = pa.table({c: pa.array([r[c] for r in rows], kinds[t]) for c, t in (x.split() for x in _COUNTED.split(", "))})
        give_back()
        return out

    return packed.groupBy("bucket").applyInArrow(run, _COUNTED)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, sample_docs: int = 8192, entry_bits: int = ENTRY_BITS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    own = _prepared(docs, id_col, text_col, folds)
    total, learned = own.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    learned = learned or 0
    bits = max(3, int((total or 0) >> BUCKET).bit_length())
    pair_bits = bits + FINER
    hot = _hot_words(own, sample_docs)
    shared_hot = spark.sparkContext.broadcast(hot)
    groups = stored(_grouped(own, min(max(GROUP, 512 << bits), 4 * GROUP)), "texts")
    counted = _kept(_counted(_packed(groups, shared_hot, bits, pair_bits), shared_hot, bits, pair_bits, entry_bits), "ngrams")
    hot_rows = counted.where(F.size("hot") > 0).select(F.explode(F.arrays_zip("hot", "hot_n")).alias("x")).select("x.*").toPandas()
    hot_n = np.zeros(len(hot), np.int64)
    if len(hot_rows):
        hot_n[np.searchsorted(hot, hot_rows["hot"].to_numpy(np.int64).view(U64))] = hot_rows["hot_n"].to_numpy()
    vocab, n_train, held = counted.agg(F.sum("vocab"), F.sum("tokens"), F.sum("size")).first()
    vocab = (vocab or 0) + int((hot_n > 0).sum()) + (learned > 0)
    n_train = (n_train or 0) + int(hot_n.sum()) + learned
    model = {"hot": hot, "hot_n": hot_n, "ends": learned, "scale": n_train + 0.1 * (vocab + 1)}
    answers = ["gid", "bucket", "count"]
    if (held or 0) <= broadcast_bytes:
        for kind, name, n in ((0, "words", bits), (1, "pairs", pair_bits)):
            model[name] = _gathered(counted.where(F.col("kind") == kind), n)
    else:
        answers += ["level", "pair_level"]
    sums = _kept(_scored(groups, counted.where("kind = 2").select(*answers), spark.sparkContext.broadcast(model), bits), "scores")
    # the likeliest weight for the training texts without themselves
    fit = [sums.agg(*[F.sum(F.element_at("fit", k + 1)).alias(f"f{k}") for k in range(len(WEIGHTS))]).first()][0]
    fit = [x if x is not None else 0.0 for x in fit]
    best = fit.index(max(fit))
    base = F.col("share") - F.col("n_tokens") * float(np.log10(model["scale"]))
    return sums.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("bigint").alias("train_tokens"), base.alias("base_score"), F.element_at("scores", best + 1).alias("score"))


def _gathered(rows: DataFrame, bits: int) -> Segments:
    """The segments one after another; the caller has checked their size."""
    first, size = np.zeros(1 << bits, np.int64), np.full(1 << bits, 64)
    parts, at = [np.zeros(8, np.uint8)], 8  # buckets without n-grams share an empty one
    for row in rows.select("bucket", "field").toLocalIterator():
        part = np.frombuffer(row["field"], np.uint8)
        first[row["bucket"]], size[row["bucket"]] = at * 8, len(part) * 8
        parts.append(part)
        at += len(part)
    return Segments(np.concatenate(parts), bits, first, size)


def _exact(m: dict, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts that need no probe (hot words, marks), and which those are."""
    c, exact = np.zeros(len(h)), _is_hot(m["hot"], h)
    if exact.any():
        c[exact] = m["hot_n"][np.searchsorted(m["hot"], h[exact])]
    marks = (h == END) | (h == BEGIN)
    c[marks] = m["ends"]
    return c, exact | marks


def _sums(prior, single, pair, scale: float) -> np.ndarray:
    """log10 P of tokens: a row for every weight."""
    pair = np.minimum(pair, np.minimum(prior, single))
    bound, free = pair / np.maximum(prior, 1.0), (single + 0.1) / scale
    return np.stack([np.log10(x * bound + (1 - x) * free) for x in WEIGHTS])


_SCORED = "id long, held_out boolean, n_tokens long, n_known long, share double, scores array<double>, fit array<double>"


def _doc_sums(prior, single, pair, start, train, scale) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the tokens of each document, and those of a training document
    with its token's own occurrence taken off the counts."""
    scores = np.add.reduceat(_sums(prior, single, pair, scale), start, axis=1)
    less = [np.maximum(x - 1, 0) for x in (prior, single, pair)]
    fit = np.add.reduceat(_sums(*less, scale), start, axis=1) * train
    return scores.T, fit.T


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))


def _scored(groups: DataFrame, answers: DataFrame, shared, bits: int) -> DataFrame:
    """Every document's sums, from its group's answers and, where the filter is
    broadcast, from its probes."""

    def run(key, left, right):
        m = shared.value
        ids, held, train, offsets, body = (left.column(c)[0].as_py() for c in ("ids", "held_out", "train", "offsets", "body"))
        h, edge = _opened(offsets, body)
        before, own, both = bigrams(h, edge)
        ends = np.append(edge[:-1] + np.arange(len(ids)), len(own))
        start, train = ends[:-1], np.array(train, bool)
        single, exact = _exact(m, own)
        word, back = np.unique(own[~exact], return_inverse=True)
        pair, pair_back = np.unique(both, return_inverse=True)
        # the answers, in the order of the buckets, are in that of the n-grams
        right = right.sort_by("bucket")
        got = {c: right.column(c).to_pylist() for c in right.column_names}
        sizes = np.diff(_cut(word, bits))[got["bucket"]]
        if sizes.sum() != len(word):
            raise ValueError("a group has words without an answer")
        count = single.copy()
        count[~exact] = _wide(got["count"], sizes)[back]
        if "words" in m:
            level, pair_level = m["words"].found(word), m["pairs"].found(pair)
        else:
            level, pair_level = (np.frombuffer(b"".join(got[c]), np.uint8) for c in ("level", "pair_level"))
        single[~exact] = quantised(level)[back]
        prior = np.empty(len(own))
        prior[1:] = single[:-1]
        prior[start] = m["ends"]
        times = np.where((single > 0) & (prior > 0), quantised(pair_level)[pair_back], 0.0)
        scores, fit, first = [], [], 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + STEP, "right")) - 1)
            part = slice(ends[first], ends[last])
            sums = _doc_sums(prior[part], single[part], times[part], start[first:last] - ends[first], train[first:last], m["scale"])
            scores.append(sums[0])
            fit.append(sums[1])
            first = last
        known, share = (np.add.reduceat(x, start) for x in ((count > 0).astype(np.int64), np.log10(count + 0.1)))
        out = pa.table([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(np.diff(ends)), pa.array(known), pa.array(share), _lists(np.concatenate(scores)), _lists(np.concatenate(fit))], names=[x.split()[0] for x in _SCORED.split(", ")])
        give_back()
        return out

    return groups.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(run, _SCORED)
