"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be covered by a merge, so the place between them is a certain cut. A text is
cut at the pre-tokeniser's borders and at these certain cuts; each fragment
is encoded on its own by rank-ordered merges, and the ids are concatenated.
Fragments repeat a lot, so a bounded table per worker keeps their codes.

Defined results: a null text counts as empty (no ids, empty decoded text);
repeated rows give repeated results; an empty table gives an empty table;
other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: the split pattern of the published vocabulary
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_FRAGMENTS = 500_000  # parts that a worker's table holds before it is emptied
SLICE_CHARS = 1 << 20  # characters whose new parts are encoded together


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file:
    printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_model(path: str) -> dict:
    """Vocabulary, merges and added tokens of a byte-level BPE file, read on
    the driver. A vocabulary has some 10**5 tokens at most; the size is checked."""
    spec = json.load(open(path, encoding="utf-8"))
    model, letters = spec["model"], byte_letters()
    if model["type"] != "BPE" or spec.get("normalizer") is not None:
        raise ValueError("a byte-level BPE file without a normaliser is needed")
    if len(model["vocab"]) > 1_000_000:
        raise ValueError("vocabulary too large to broadcast")
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    vocab = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merges = [tuple(bytes(letters[c] for c in x) for x in p) for p in pairs]
    return {"vocab": vocab, "merges": merges, "added": added}


class Codec:
    """Encoder and decoder of one worker. ``table`` maps a part of a text (the
    word after a space; a part that no space starts as a 1-tuple; an added
    token as its id) to its place in ``starts``; the ids of place i are
    ``ids[starts[i]:starts[i + 1]]``."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        self.added = model["added"]
        self.token = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.byte_id = np.array([vocab.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.ranks = PairRanks([(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]])
        self.inside = np.zeros((256, 256), bool)
        for t in vocab:
            for p in zip(t, t[1:]):
                self.inside[p] = True
        self.split = regex.compile(SPLIT)
        self.kind = char_kinds()
        longest = sorted(self.added, key=len, reverse=True)
        self.added_split = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.decimal = [b"%d" % i for i in range(max(self.token) + 1)]
        self.raw = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self.forget()

    def forget(self) -> None:
        self.table: dict = {}
        self.ids, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def parts(self, text: str) -> list:
        """Table keys of the parts of a text, which is cut before every space
        that a non-space follows: the pre-tokeniser always starts a piece there."""
        if self.added_split is not None and self.added_split.search(text):
            out, at = [], 0
            for m in self.added_split.finditer(text):
                out += [*self.plain(text[at : m.start()]), self.added[m.group()]]
                at = m.end()
            return out + self.plain(text[at:])
        return self.plain(text)

    def plain(self, text: str) -> list:
        if not text:
            return []
        if _SPACES.search(text):
            return [p[1:] if p[0] == " " else (p,) for p in _BEFORE_WORD.split(text) if p]
        out = text.split(" ")
        if out[0]:
            out[0] = (out[0],)
        else:
            del out[0]
        return out

    def learn(self, keys: set) -> None:
        """Encode the parts that the table lacks, all at once."""
        if len(self.table) > MAX_FRAGMENTS:
            self.forget()
        new = keys.difference(self.table)
        if not new:
            return
        easy = [k for k in new if isinstance(k, str)]
        joined = " " + "\n ".join(easy) + "\n"
        if joined.count(" ") != len(easy) or joined.count("\n") != len(easy) or _ODD.search(joined):
            easy = [k for k in easy if not _ODD_PART.search(k)]
            joined = " " + "\n ".join(easy) + "\n"
        seen = set(easy)
        hard = [k for k in new if k not in seen]
        # simple parts: the pre-tokeniser's pieces are runs of one kind of character
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kind[points]
        ends = kind == LINE
        cut = np.zeros(len(points), bool)
        cut[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE) | ends[:-1]
        cut[0] = True
        width = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
        byte_at = np.cumsum(width) - width
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        cuts = np.zeros(len(raw) + 1, bool)
        cuts[byte_at[cut]] = True
        cuts, raw_end = cuts[:-1], byte_at[ends]
        keep = np.ones(len(raw), bool)
        keep[raw_end] = False
        raw, cuts = raw[keep], cuts[keep]
        edges = raw_end - np.arange(len(raw_end)) if easy else np.zeros(0, np.int64)
        if not easy:
            raw, cuts = raw[:0], cuts[:0]
        # the others by the pattern itself
        if hard:
            pre = [[k] if isinstance(k, int) else self.split.findall(" " + k if isinstance(k, str) else k[0]) for k in hard]
            pre = [[self.token[p] if isinstance(p, int) else p.encode("utf-8", "surrogatepass") for p in x] for x in pre]
            size = np.fromiter((len(p) for x in pre for p in x), np.int64)
            more = np.frombuffer(b"".join([p for x in pre for p in x]), np.uint8)
            at = np.zeros(len(more), bool)
            at[np.cumsum(size) - size] = True
            n_pre = np.cumsum(np.fromiter(map(len, pre), np.int64, len(pre)))
            edges = np.concatenate([edges, len(raw) + np.cumsum(size)[n_pre - 1]])
            raw, cuts = np.concatenate([raw, more]), np.concatenate([cuts, at])
        cuts[1:] |= ~self.inside[raw[:-1], raw[1:]]  # forced boundaries
        starts = np.flatnonzero(cuts)
        ids, frag = merge_all(self.byte_id[raw], starts, self.ranks)
        last = np.searchsorted(starts[frag], edges)
        base, n = len(self.ids), len(self.table)
        self.table.update(zip(easy + hard, range(n, n + len(easy) + len(hard))))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, base + last])
        for k in hard:
            if isinstance(k, int):
                at = self.starts[self.table[k]]
                self.ids = np.concatenate([self.ids[:at], [k], self.ids[self.starts[self.table[k] + 1] :]])
                self.starts[self.table[k] + 1 :] += 1 - (self.starts[self.table[k] + 1] - at)

    def slices(self, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, edges) of consecutive texts, in slices of bounded size: the
        ids of a slice's text i are ``ids[edges[i]:edges[i + 1]]``."""
        at = 0
        while at < len(texts):
            size, parts = 0, []
            while at < len(texts) and size < SLICE_CHARS:
                t = texts[at] or ""
                parts.append(self.parts(t))
                size += len(t)
                at += 1
            self.learn(set().union(*parts))
            starts, ids, find = self.starts, self.ids, self.table.__getitem__
            place = np.array([find(k) for p in parts for k in p], np.int64)
            lens = starts[place + 1] - starts[place]
            ends = np.concatenate([[0], np.cumsum(lens)])
            got = ids[np.arange(ends[-1]) + np.repeat(starts[place] - ends[:-1], lens)]
            yield got, ends[np.cumsum([0, *map(len, parts)])]

    def encode(self, texts: list) -> Iterator[list[int]]:
        """The ids of each text."""
        for ids, edges in self.slices(texts):
            got, edges = ids.tolist(), edges.tolist()
            for a, b in zip(edges, edges[1:]):
                yield got[a:b]

    def decode(self, ids) -> bytes:
        raw = b"".join(map(self.raw.__getitem__, ids))
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError:
            raw = raw.decode("utf-8", "replace").encode()
        return raw

    def digests(self, texts: list) -> Iterator[tuple[int, str, str]]:
        """(number of ids, digest of the ids, digest of the decoded text) of each."""
        decimal = self.decimal.__getitem__
        for ids in self.encode(texts):
            joined = b",".join(map(decimal, ids))
            yield len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


# kinds of characters; LINE ends a part
OTHER, SPACE, LETTER, NUMBER, LINE = range(5)


def char_kinds() -> np.ndarray:
    """Kind of every code point, from the classes that the pattern names."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, range(0xD800))), "".join(map(chr, range(0xE000, 0x110000)))
    for text, base in zip(points, (0, 0xE000)):
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, text):
                out[base + m.start() : base + m.end()] = kind
    out[32], out[10] = SPACE, LINE
    return out


# what the runs of kinds do not settle: contractions and white space
_ODD = re.compile(r"'|[^\S \n]|  |(?: \n)")
_ODD_PART = re.compile(r"^$|['\s]")
_SPACES = re.compile(r" \s")
_BEFORE_WORD = re.compile(r"(?= \S)")
NO_RANK = 1 << 40


class PairRanks:
    """Rank of a pair of ids, looked up for whole arrays in small hash tables:
    pairs that find their slot taken go to the next table."""

    BITS = 17

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.new = np.array([m[2] for m in merges] or [0], np.int64)
        first = {}
        for rank, (a, b, _) in enumerate(merges):
            first.setdefault(a << 24 | b, rank)
        keys = np.array(list(first), np.int64)
        rank = np.array(list(first.values()), np.int64)
        self.levels, mult = [], 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(self.BITS, int(len(keys)).bit_length() + 1)
            slot = self._slot(keys, mult, bits)
            _, won = np.unique(slot, return_index=True)
            k, r = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_RANK, np.int64)
            k[slot[won]], r[slot[won]] = keys[won], rank[won]
            self.levels.append((mult, bits, k, r))
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, rank, mult = keys[rest], rank[rest], (mult * 0x2545F4914F6CDD1D | 1) & (1 << 64) - 1

    @staticmethod
    def _slot(keys, mult, bits):
        return ((keys.astype(np.uint64) * np.uint64(mult)) >> np.uint64(64 - bits)).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 24 | b
        out = np.full(len(key), NO_RANK, np.int64)
        for mult, bits, k, r in self.levels:
            slot = self._slot(key, mult, bits)
            same = k[slot] == key
            out[same] = r[slot[same]]
        return out


def merge_all(ids: np.ndarray, starts: np.ndarray, ranks: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """BPE of many fragments side by side: each round merges, in every
    fragment, all places of its lowest-ranked pair. Fragments with nothing
    left to merge leave. Returns the ids in order and each id's fragment."""
    n = len(ids)
    lens = np.diff(np.append(starts, n))
    name = np.arange(len(starts))
    rank = np.full(n, NO_RANK, np.int64)
    rank[:-1] = ranks.of(ids[:-1], ids[1:])
    rank[starts[1:] - 1] = NO_RANK
    out_ids, out_frag = [], []
    while len(ids):
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        low = np.minimum.reduceat(rank, starts)
        live = low < NO_RANK
        if not live.all():
            stay = np.repeat(live, lens)
            out_ids.append(ids[~stay])
            out_frag.append(np.repeat(name[~live], lens[~live]))
            ids, rank, lens, low, name = ids[stay], rank[stay], lens[live], low[live], name[live]
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else lens
            if not len(ids):
                break
        hit = rank == np.repeat(low, lens)
        if (hit[1:] & hit[:-1]).any():  # aaa: of a run of places, every second from the left
            run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            at = np.flatnonzero(hit)
            hit[at[(at - run[np.searchsorted(run, at, "right") - 1]) % 2 == 1]] = False
        at = np.flatnonzero(hit)
        ids[at] = ranks.new[rank[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        gone = np.searchsorted(at, starts), np.searchsorted(at, starts + lens)
        rank[at] = rank[at + 1]  # the right member's place: NO_RANK if it was the last
        lens = lens - (gone[1] - gone[0])
        ids, rank = ids[keep], rank[keep]
        at = at - np.arange(len(at))
        ends = np.cumsum(lens) - 1
        last = np.zeros(len(ids), bool)
        last[ends] = True
        stale = np.zeros(len(ids), bool)
        stale[at] = True
        stale[at[at > 0] - 1] = True
        again = np.flatnonzero(stale & ~last)
        rank[again] = ranks.of(ids[again], ids[again + 1])
        rank[ends] = NO_RANK
    frag = np.concatenate(out_frag) if out_frag else np.zeros(0, np.int64)
    order = np.argsort(frag, kind="stable")
    return np.concatenate(out_ids)[order] if out_ids else ids, frag[order]


_codecs: dict[int, Codec] = {}


def _codec(model) -> Codec:
    """One codec per worker process and broadcast."""
    if model.id not in _codecs:
        _codecs[model.id] = Codec(model.value)
    return _codecs[model.id]


def _task(codec: Codec, it) -> Iterator[pa.RecordBatch]:
    """A task's batches. The table goes with the last one: it holds a task's
    own parts for the most part, and an idle worker need not keep it."""
    yield from it
    codec.forget()
    pa.default_memory_pool().release_unused()


class _Shared:
    """A broadcast with its number, which names the worker's codec."""

    def __init__(self, spark, path: str):
        self.cast = spark.sparkContext.broadcast(load_model(path))
        self.id = hash(path)

    @property
    def value(self):
        return self.cast.value


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every text."""
    shared, kind = _Shared(df.sparkSession, path), dict(df.dtypes)[id_col]

    def run(it):
        codec = _codec(shared)
        for b in _task(codec, it):
            ids = list(codec.encode(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return out.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text of every list of ids; a null list gives an empty text."""
    shared, kind = _Shared(df.sparkSession, path), dict(df.dtypes)[id_col]

    def run(it):
        codec = _codec(shared)
        for b in _task(codec, it):
            texts = [codec.decode(x or []).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    out = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return out.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded and
    decoded again in one pass, of which only digests leave the task."""
    shared, kind = _Shared(df.sparkSession, path), dict(df.dtypes)[id_col]

    def run(it):
        codec = _codec(shared)
        for b in _task(codec, it):
            rows = list(codec.digests(b.column(1).to_pylist()))
            n, ids, dec = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return out.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def tokenized(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with token_ids and decodes_back (whether decoding the ids gives
    the text again); columns of these names are replaced."""
    shared = _Shared(df.sparkSession, path)
    out = df.withColumns({"token_ids": F.array().cast("array<int>"), "decodes_back": F.lit(None).cast("boolean")})

    def run(it):
        codec = _codec(shared)
        for b in _task(codec, it):
            at = 0
            for ids, edges in codec.slices(texts := b.column(text_col).to_pylist()):
                own = texts[at : at + len(edges) - 1]
                back = [codec.decode(ids[x:y].tolist()) == (t or "").encode("utf-8", "surrogatepass") for x, y, t in zip(edges, edges[1:], own)]
                new = {"token_ids": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32())), "decodes_back": pa.array(back)}
                part = b.slice(at, len(own))
                yield pa.RecordBatch.from_arrays([new[f.name].cast(f.type) if f.name in new else part.column(f.name) for f in b.schema], schema=b.schema)
                at += len(own)

    return out.mapInArrow(run, out.schema)
