"""N-gram Jaccard join by universe partitioning and the pigeonhole principle.

A document's set holds its distinct shingles of ``words`` words (lower-cased
A-Z, words are runs without white space); a text with fewer words is one
shingle. Two documents link when 100 * intersection >= 75 * union.

Sizes are cut into bands [L, U] with U = floor(L / 0.75), so partners lie in
the same or the next band; instance k compares sets of bands k-1 and k. Two
linked sets of sizes a, b differ in at most (a + b) / 7 shingles. Instance k
hashes shingles into m segments. A set that differs from any partner in at
most H places shares, of any H + 1 segments, one that is equal. Segments are
ordered by a cost that depends on the segment's content alone (more shingles:
fewer chance matches, cheaper; empty: dearest), and a set indexes its H + 1
cheapest: of a linked pair's two choices the stricter one holds an equal
segment that the other chose too. Segments made of frequent shingles only (a
passage that many documents share) are the dearest filled ones; which shingles
count as frequent is read from a sample of at most ``sample_docs`` documents
and bears on the cost alone, never on the result. Where H is 1, the whole set is one segment
and is indexed with its one-deletion neighbourhood. A set with too few filled
segments indexes its empty ones as well.

Rows with equal sets are one class, and only one text of each class goes on.
Signatures travel as packed arrays to buckets. In a bucket the classes of an
equal signature form a group, whose first class is the hub. Round one
checks each (hub, member) pair, first by size and by parity bitmaps (two sets
differ at least where their bitmaps do, so no link is lost), then exactly on
the shingle sets; components of the links follow. Round two takes the groups
that have members in different components, compares those members' bitmaps
in blocks inside the task, and verifies what is left exactly. A pair that
several groups hold is left to one of them: every member carries the smallest
names of its groups, and a group that sees a smaller name common to both keeps
silent. So no link between different components is lost, and no group's pairs
become rows.

Defined results: null, empty and blank texts have no shingles and link with
nothing; equal sets always link; rows without id get a null component; rows
that repeat an id are one document, and one with unlike texts links with the
partners of each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import U64, WORD_NOT_SPACE, batches, chunks, fingerprints, give_back, lowered, mix, rolling, words
from touchline.llm.common import stored
from touchline.llm.components import components

NUM, DEN = 3, 4  # the similarity, 0.75
CHUNK = 1 << 20  # bytes of text worked on at once
FLUSH = 1 << 19  # signatures that a task gathers at least before it sends them
BUCKET = 26  # a bucket has the signatures of some 2**26 bytes of text
MEMBERS = 4096  # members of a group in one row
NAMES = 8  # smallest group names that a member carries


@lru_cache(maxsize=None)
def bands(top: int) -> list[tuple[int, int]]:
    """Bands of sizes up to at least ``top``."""
    out = [(1, 1)]
    while out[-1][1] < top:
        low = out[-1][1] + 1
        out.append((low, low * DEN // NUM))
    return out


def band_of(n: int) -> int:
    return next(k for k, (lo, hi) in enumerate(bands(max(64, 1 << int(n).bit_length()))) if lo <= n <= hi)


@lru_cache(maxsize=None)
def segments(k: int) -> int:
    """Number of segments of instance k: the fewest with which nearly all its
    sets (four standard deviations) fill as many as they must index."""
    lo, hi = bands(1 << 40)[k]
    small = bands(1 << 40)[k - 1][0] if k else lo
    m = max(1, 2 * hi // 7 + 1)
    if 2 * hi // 7 <= 1:
        return 1
    while True:
        short = False  # a third of the filled segments is to spare, for the dear ones
        for n, need in ((hi, 2 * hi // 7 + 1), (lo, (lo + hi) // 7 + 1), (small, (small + small * DEN // NUM) // 7 + 1)):
            empty = m * (1 - 1 / m) ** n
            var = m * (m - 1) * max(0.0, 1 - 2 / m) ** n + empty - empty**2
            short |= m - empty - 4 * max(0.0, var) ** 0.5 < need * 4 / 3
        if not short or m >= 4 * hi:
            return m
        m += max(1, m // 64)


def signatures(h: np.ndarray, hot: np.ndarray) -> list[np.ndarray]:
    """Signatures of a set of shingles, for the instance of its own band and
    of the next; ``hot`` marks frequent shingles."""
    n, k, out = len(h), band_of(len(h)), []
    low, high = bands(1 << 40)[k]
    for inst, most in ((k, min(high, n * DEN // NUM)), (k + 1, n * DEN // NUM)):
        if inst == k + 1 and most <= high:
            continue  # no partner in the next band
        differ = (n + most) // 7
        salt = U64(inst * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        own = mix(h ^ salt)
        m = segments(inst)
        if m == 1:
            whole = own.sum(dtype=U64)
            out.append(mix(np.concatenate([[whole], whole - own]) ^ salt))
            continue
        seg = ((h >> U64(32)) ^ (salt >> U64(40))) * U64(0x9E3779B1) & U64(0xFFFFFFFF)
        seg = (seg * U64(m) >> U64(32)).astype(np.int64)
        count = np.bincount(seg, minlength=m)
        total = np.zeros(m, U64)
        np.add.at(total, seg, own)
        filled = np.flatnonzero(count)
        need = differ + 1
        if len(filled) < need:
            use = np.arange(m)
        elif len(filled) == need:
            use = filled
        else:
            rare = np.bincount(seg[~hot], minlength=m)[filled] > 0
            cost = -(count[filled] + rare * n) * (m + 1) + filled
            use = filled[np.argpartition(cost, need - 1)[:need]]
        out.append(mix(mix(total[use] + salt) + use.astype(U64)))
    return out


def shingle_sets(texts: list, size: int):
    """The sorted distinct shingles of every text."""
    for first, last, data, offsets in chunks(texts, CHUNK):
        low = lowered(data)
        s, e = words(low, WORD_NOT_SPACE)
        h = fingerprints(low, s, e)
        edge = np.searchsorted(s, offsets)
        roll = rolling(h, size)
        for i in range(last - first):
            a, b = edge[i], edge[i + 1]
            if b - a >= size:
                yield np.unique(roll[a : b - size + 1])
            elif b > a:
                yield rolling(h[a:b], b - a) ^ U64(b - a)
            else:
                yield np.zeros(0, U64)


def parity(h: np.ndarray) -> bytes:
    """Bitmap of about two bits a shingle, a bit set where an odd number fell."""
    bits = 1 << max(8, (2 * len(h) - 1).bit_length())
    odd = np.bincount((h & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap brought to ``size`` bytes: parts laid over each other."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, U64).reshape(-1, size // 8), axis=0)


def apart(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles that differ in at least so many places
    cannot link."""
    return (100 * np.minimum(n, m) < 75 * np.maximum(n, m)) | (7 * differ > n + m)


def _sizes(docs: DataFrame, size: int) -> DataFrame:
    def run(it):
        for b in batches(it):
            sets = [(len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None, parity(x)) for x in shingle_sets(b.column("text").to_pylist(), size)]
            n, key, bits = zip(*sets)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("hash"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bits, pa.binary())], names=["id", "hash", "n", "same", "bits"])

    return docs.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(run, "id long, hash long, n long, same binary, bits binary")


def _frequent(docs: DataFrame, size: int, sample_docs: int, keep: int = 1 << 17) -> np.ndarray:
    """Sorted shingles that three documents or more of a sample share."""
    n = docs.count()
    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // sample_docs))) == 0)

    def run(it):
        for b in batches(it):
            h, c = np.unique(np.concatenate([*shingle_sets(b.column("text").to_pylist(), size)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    top = sample.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 2").orderBy(F.desc("c"), "h").limit(keep)
    return np.sort(top.select("h").toPandas()["h"].to_numpy(np.int64).view(U64))


def _packed(docs: DataFrame, size: int, bits: int, frequent) -> DataFrame:
    """Signatures, dealt to 2**bits buckets: 40 bits of each and the place of
    its document in ``ids``."""
    schema = "bucket int, lo binary, hi binary, place binary, ids binary"

    def send(sigs, ids, counts):
        sig = np.concatenate(sigs)
        place = np.repeat(np.arange(len(ids), dtype=np.uint32), counts)
        order = np.argsort(sig)
        sig, place = sig[order], place[order]
        bucket = (sig >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sig), np.int64)
        edge = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        rest = sig >> U64(24 - bits) & U64((1 << 40) - 1)
        ids = np.array(ids, np.int64)
        rows = []
        for k in np.flatnonzero(np.diff(edge)).tolist():
            r, p = rest[edge[k] : edge[k + 1]], place[edge[k] : edge[k + 1]]
            used, p = np.unique(p, return_inverse=True)
            rows.append((k, r.astype(np.uint32).tobytes(), (r >> U64(32)).astype(np.uint8).tobytes(), p.astype(np.uint32).tobytes(), ids[used].tobytes()))
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 64]), (pa.int32(), *[pa.binary()] * 4))], names=["bucket", "lo", "hi", "place", "ids"])

    def run(it):
        sigs, ids, counts, total = [], [], [], 0
        flush = min(max(FLUSH, 4 << bits), 4 * FLUSH)  # the more buckets, the more to each
        hot = frequent.value
        maybe = np.zeros(1 << 20, bool)
        maybe[(hot >> U64(44)).astype(np.int64)] = True
        for b in batches(it):
            for i, x in zip(b.column("id").to_pylist(), shingle_sets(b.column("text").to_pylist(), size)):
                mark = maybe[(x >> U64(44)).astype(np.int64)]
                mark[mark] = hot[np.minimum(np.searchsorted(hot, x[mark]), len(hot) - 1)] == x[mark]
                got = np.concatenate(signatures(x, mark))
                sigs.append(got)
                ids.append(i)
                counts.append(len(got))
                total += len(got)
                if total >= flush:
                    yield from send(sigs, ids, counts)
                    sigs, ids, counts, total = [], [], [], 0
        if sigs:
            yield from send(sigs, ids, counts)

    return docs.mapInArrow(run, schema)


def _groups(packed: DataFrame) -> DataFrame:
    """(gid, hub, members): the documents of each signature that several
    have, the smallest apart; equal groups of a bucket once."""

    def run(key, pdf):
        sig = np.concatenate([np.frombuffer(a, np.uint32).astype(U64) | np.frombuffer(b, np.uint8).astype(U64) << U64(32) for a, b in zip(pdf.lo, pdf.hi)])
        ids = np.concatenate([np.frombuffer(i, np.int64)[np.frombuffer(p, np.uint32)] for i, p in zip(pdf.ids, pdf.place)])
        order = np.argsort(sig)
        sig = sig[order]
        more = np.zeros(len(sig) + 1, bool)
        more[1:-1] = sig[1:] == sig[:-1]
        keep = more[1:] | more[:-1]
        sig, ids = sig[keep], ids[order[keep]]
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else []
        seen, rows = set(), []
        for a, b in zip(starts, np.append(starts[1:], len(sig)).astype(int) if len(sig) else []):
            own = ids[a:b]
            own = own[np.append(True, own[1:] != own[:-1])]
            if len(own) < 2 or (mark := hash(own.tobytes())) in seen:
                continue
            seen.add(mark)
            gid = int(sig[a]) << 22 | int(key[0])
            rows += [(gid, own[0], own[i : i + MEMBERS]) for i in range(1, len(own), MEMBERS)]
        out = pd.DataFrame(rows, columns=["gid", "hub", "members"])
        del pdf, sig, ids, order, more, keep, rows, seen
        give_back()
        return out

    return packed.groupBy("bucket").applyInPandas(run, "gid long, hub long, members array<long>")


def _plausible(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""

    def run(it):
        for b in batches(it):
            na, nb = (b.column(c).to_numpy() for c in ("na", "nb"))
            differ = np.zeros(len(na), np.int64)
            for i, (x, y) in enumerate(zip(b.column("xa").to_pylist(), b.column("xb").to_pylist())):
                size = min(len(x), len(y))
                differ[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(~apart(na, nb, differ)))

    of = lambda k: sizes.select(F.col("id").alias(k), F.col("n").alias("n" + k), F.col("bits").alias("x" + k))
    both = pairs.join(of("b"), "b").join(of("a"), "a").where("100 * least(na, nb) >= 75 * greatest(na, nb)")
    return both.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(a, b) of the pairs that link, by the sets themselves."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    rows = docs.join(need.hint("shuffle_hash"), "id", "left_semi")

    def sets(it):
        for b in batches(it):
            got = [x.tobytes() for x in shingle_sets(b.column("text").to_pylist(), size)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(got, pa.binary())], names=["id", "s"])

    s = stored(rows.mapInArrow(sets, "id long, s binary").dropDuplicates(["id"]), "sets")

    def check(it):
        for b in batches(it):
            link = []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist()):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                link.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(link, pa.bool_()))

    joined = pairs.join(s.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").join(s.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    return stored(joined.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long"), "verified")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, sample_docs: int = 8192) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, int(total >> BUCKET).bit_length())
    sizes = stored(_sizes(docs, size), "sizes")
    # rows with equal sets are one class with a number of its own and the text
    # of one of its rows; an id and a hash of the text tell rows apart
    filled = sizes.where("same is not null and id is not null")
    first = filled.groupBy("same").agg(F.min(F.struct("id", "hash", "n", "bits")).alias("r")).select("same", "r.*")
    classes = stored(first.withColumn("node", F.monotonically_increasing_id()), "classes")
    texts = docs.withColumn("hash", F.xxhash64("text")).join(classes.select("id", "hash", "node"), ["id", "hash"])
    texts = stored(texts.select(F.col("node").alias("id"), "text"), "class-texts")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(texts, size, sample_docs))
    groups = stored(_groups(_packed(texts, size, bits, frequent)), "groups")

    star = groups.select(F.col("hub").alias("a"), F.explode("members").alias("b")).distinct()
    reps = classes.select(F.col("node").alias("id"), "n", "bits")
    links = _verified(stored(_plausible(star, reps), "pairs"), texts, size)
    # an id with unlike texts is one document: its classes are linked
    rows = filled.select("id", "same").distinct()
    several = rows.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id")
    own = rows.join(several, "id", "left_semi").join(classes.select("same", "node"), "same").select("id", "node")
    links = links.union(own.join(own.groupBy("id").agg(F.min("node").alias("b")), "id").where("node <> b").select(F.col("node").alias("a"), "b"))
    found = components(links, "a", "b")
    for nearest in (True, False):  # first each member's likeliest partner, then all that is still open
        second = stored(_second(groups, reps, found, nearest, 4 << bits), "second")
        if second.isEmpty():
            break
        links = links.union(_verified(second, texts, size))
        found = components(links, "a", "b")
    named = classes.select("same", "node", "id").join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of = named.join(least, "component").select("same", "component_id")
    out = sizes.select("id", "n", "same").join(of, "same", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _second(groups: DataFrame, reps: DataFrame, found: DataFrame, nearest: bool, batches_: int) -> DataFrame:
    """Plausible pairs of a group's members that lie in different components,
    of groups with three or more members; the hub's own pairs are done. With
    ``nearest`` only each member's pair that differs least."""
    several = groups.groupBy("gid", "hub").agg(F.sum(F.size("members")).alias("k")).where("k > 1").select("gid", "hub")
    rows = groups.join(several, ["gid", "hub"], "left_semi")
    members = rows.select("gid", "hub", F.explode("members").alias("x"))
    members = members.join(found.withColumnsRenamed({"id": "x", "component": "c"}), "x", "left").withColumn("c", F.coalesce("c", "x"))
    other = F.xxhash64("x", F.lit(1)).cast("decimal(38,0)")
    equal = {"k": F.count("x"), "xor": F.bit_xor(F.xxhash64("x")), "sum": F.sum(other)}
    mixed = members.groupBy("gid").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), *[v.alias(k) for k, v in equal.items()]).where("c0 <> c1")
    once = mixed.groupBy(*equal).agg(F.min("gid").alias("gid")).select("gid")  # equal groups of several buckets
    open_ = stored(members.join(once, "gid", "left_semi").select("gid", "x", "c"), "open")
    names = open_.groupBy("x").agg(F.slice(F.array_sort(F.collect_set("gid")), 1, NAMES).alias("names"))
    work = open_.join(reps.withColumnRenamed("id", "x").join(names, "x"), "x")

    def run(pdf):
        pdf = pdf.sort_values(["gid", "n"], kind="stable")
        edge = np.flatnonzero(np.append(True, np.diff(pdf["gid"].to_numpy()) != 0)).tolist()
        parts = [pairs_of(pdf.iloc[a:b]) for a, b in zip(edge, [*edge[1:], len(pdf)]) if b - a > 1]
        both = np.concatenate([np.zeros((0, 2), np.int64), *parts])
        del pdf, parts
        give_back()
        return pd.DataFrame({"a": both.min(axis=1), "b": both.max(axis=1)}).drop_duplicates()

    def pairs_of(pdf):
        x, c, n = pdf.x.to_numpy(), pdf.c.to_numpy(), pdf.n.to_numpy()
        bits = pdf.bits.tolist()
        gid = int(pdf.gid.iloc[0])
        names = np.full((len(pdf), NAMES), np.iinfo(np.int64).max)
        for i, own in enumerate(pdf.names):
            names[i, : len(own)] = own
        # half a set's bitmap still tells unlike sets apart, at half the work
        width = np.maximum(32, np.fromiter(map(len, bits), np.int64, len(bits)) // 2)
        reach = np.searchsorted(n, n * DEN // NUM, "right")  # larger sets cannot link
        out, far = [], 1 << 30
        best, partner = np.full(len(x), far), np.zeros(len(x), np.int64)

        def left(p, q):
            """Pairs for this group: those without a smaller name in common."""
            same = (names[p][:, :, None] == names[q][:, None, :]).any(axis=2) & (names[p] < gid)
            return ~same.any(axis=1)

        def closer(rows, value, other):
            less = value < best[rows]
            best[rows[less]], partner[rows[less]] = value[less], other[less]

        for size in np.unique(width).tolist():
            first, last = np.searchsorted(width, [size, size + 1])
            top = reach[last - 1]
            maps = np.stack([folded(v, size) for v in bits[first:top]])
            for i in range(first, last, 64):
                z = min(i + 64, last)
                for j in range(i, reach[z - 1], 4096):
                    e = min(j + 4096, reach[z - 1])
                    if (c[i:z] == c[i]).all() and (c[j:e] == c[i]).all():
                        continue
                    differ = np.zeros((z - i, e - j), np.uint16)
                    for w in range(maps.shape[1]):
                        differ += np.bitwise_count(maps[i - first : z - first, None, w] ^ maps[None, j - first : e - first, w])
                    near = differ <= (n[i:z, None] + n[None, j:e]) // 7
                    if not near.any():
                        continue
                    p, q = np.nonzero(near)
                    d, p, q = differ[p, q].astype(np.int64), p + i, q + j
                    keep = (c[p] != c[q]) & ~apart(n[p], n[q], d)
                    d, p, q = d[keep], p[keep], q[keep]
                    keep = left(p, q)
                    d, p, q = d[keep], p[keep], q[keep]
                    if nearest:
                        for one, two in ((p, q), (q, p)):
                            order = np.lexsort((d, one))
                            at = order[np.append(True, one[order][1:] != one[order][:-1])] if len(order) else order
                            closer(one[at], d[at], two[at])
                    else:
                        out.append(np.stack([x[p], x[q]], axis=1))
        if nearest:
            has = best < far
            return np.stack([x[has], x[partner[has]]], axis=1)
        return np.concatenate([np.zeros((0, 2), np.int64), *out])

    # many small groups share a task's call
    work = work.withColumn("batch", F.pmod(F.xxhash64("gid"), F.lit(batches_)))
    return work.groupBy("batch").applyInPandas(run, "a long, b long").distinct()
