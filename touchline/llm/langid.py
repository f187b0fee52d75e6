"""Language identification with string kernels.

A text is the set of character n-grams (1 to 3 letters, lower-cased, with word
borders) that it holds anywhere: the blended spectrum, by presence. The kernel
of two texts is the size of the sets' intersection over the root of the
product of their sizes. Nyström: each text is described by its kernel values
with a few landmark texts, one-versus-rest kernel ridge regression is solved
on them, and scoring is two matrix products per batch of texts. n-grams are
hashed to ``DIM`` columns.

Scores tell languages apart, but add up to about 1 in any text, so they cannot
tell that a text is in none of them. For that a text's typicality is used: the
share of a language's fitted texts that hold one of its n-grams, averaged over
its n-grams, at the likeliest language; texts longer than ``PIECE`` characters
are averaged over their pieces. The least typicality of a known text is
measured with the fit: each half of the fitted texts is described by the other
half, once with all languages and once without its own.

The classifier is fitted on a bounded sample of labelled rows
(``sample_rows``, drawn evenly from the languages by the smallest hashes of
the ids); predictions use only the whole text.

Defined results: a text that is null or has no letter gets ``und`` with score
0, and so does every text if no labelled row exists; rows without id or
language are not learned from; repeated rows get equal results; other columns
are kept, and ``lang_pred`` and ``score`` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.arrays import batches

DIM = 8192
UNKNOWN = "und"
PIECE = 8192  # characters; longer texts hold ever more rare n-grams
MEASURED = 16  # fitted texts that a language needs for the least typicality
_ROWS = 128  # texts of one matrix product
_CHARS = 1 << 20  # characters of a text looked at in one step
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def mark_presence(text: str, row: np.ndarray) -> bool:
    """Set the columns of the text's n-grams; whether it has a letter."""
    is_letter, any_letter = letters(), False
    text = " " + text.lower() + " "
    for at in range(0, max(1, len(text) - 2), _CHARS):  # two characters overlap: no n-gram is lost
        c = np.frombuffer(text[at : at + _CHARS + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        a = np.where(is_letter[c], c, np.uint32(0))
        inner = a[1:-1]
        one = inner[inner > 0]
        if not len(one):
            continue
        any_letter = True
        h = a * np.uint32(0x9E3779B1)
        two = (h[:-1] ^ (a[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0x27D4EB2F)
        three = (two[:-1] ^ (a[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x165667B1)
        row[(one * np.uint32(0x165667B1)) >> np.uint32(19)] = 1
        row[two[(a[1:] > 0) | (a[:-1] > 0)] >> np.uint32(19)] = 1
        row[three[inner > 0] >> np.uint32(19)] = 1
    return any_letter


def presence(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(0/1 matrix, which texts have letters) of each block of texts."""
    for at in range(0, len(texts), _ROWS):
        part = texts[at : at + _ROWS]
        x = np.zeros((len(part), DIM), np.float32)
        yield x, np.array([mark_presence(t or "", x[i]) for i, t in enumerate(part)], bool)


def kernel(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    both = np.outer(x.sum(axis=1), marks.sum(axis=1))
    return (x @ marks.T) / np.sqrt(np.maximum(both, 1))


def typical(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Typicality of texts (rows of ``x``) in languages (rows of ``held``, the
    share of fitted texts that hold each n-gram)."""
    return x @ held.T / np.maximum(x.sum(axis=1, keepdims=True), 1)


def shares(x: np.ndarray, y: np.ndarray, langs: list) -> np.ndarray:
    return np.stack([x[y == g].mean(axis=0) if (y == g).any() else np.zeros(x.shape[1], x.dtype) for g in langs])


def least_typical(x: np.ndarray, y: np.ndarray, langs: list) -> float:
    """The typicality below which a text is in no known language: half way
    from the languages left out (upper quartile) to known texts (all but a few),
    or that of the least known text where these two meet."""
    use = np.isin(y, langs)
    x, y = x[use], y[use]
    if not len(y):
        return 0.0
    known, unknown = [], []
    turn = np.zeros(len(y), int)
    for g in langs:
        turn[y == g] = np.arange((y == g).sum()) % 2
    for half in (0, 1):
        t = typical(x[turn == half], shares(x[turn != half], y[turn != half], langs))
        own = np.array(langs)[None, :] == y[turn == half][:, None]
        known.append(t.max(axis=1))
        unknown.append(np.where(own, 0, t).max(axis=1))
    known, unknown = np.concatenate(known), np.concatenate(unknown)
    low, high = np.quantile(known, 0.005), np.quantile(unknown, 0.75)
    return float((low + high) / 2 if high < low else known.min())


def pieces(text: str) -> list[str]:
    n = -(-len(text) // PIECE)
    return [text[len(text) * k // n : len(text) * (k + 1) // n] for k in range(n)]


def likely(texts: list, x: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Typicality of texts at their likeliest language; ``x`` is their presence."""
    out = typical(x, held).max(axis=1)
    for i, text in enumerate(texts):
        if len(text or "") > PIECE:
            got = [typical(p[ok], held).max(axis=1) for p, ok in presence(pieces(text))]
            out[i] = np.concatenate([*got, np.zeros(0)]).mean() if any(map(len, got)) else 0
    return out


def solve(x: np.ndarray, y: np.ndarray, per_lang: int, ridge: float = 1e-2) -> dict:
    """Landmarks (the first rows of every language) and the weights that take
    kernel values with them to one score per language, 1 for the language and
    0 for the rest."""
    langs = sorted(set(y))
    marks = np.concatenate([x[y == g][:per_lang] for g in langs])
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    use = value > 1e-6 * value.max()
    root = vector[:, use] / np.sqrt(value[use])
    z = np.concatenate([kernel(x, marks) @ root, np.ones((len(x), 1))], axis=1)
    target = np.stack([y == g for g in langs], axis=1).astype(np.float64)
    weight = 1.0 / (target @ target.sum(axis=0))[:, None]
    w = np.linalg.solve(z.T @ (z * weight) + ridge / len(x) * np.eye(z.shape[1]), z.T @ (target * weight))
    return {"langs": langs, "marks": np.packbits(marks.astype(np.uint8), axis=1), "weights": (root @ w[:-1]).astype(np.float32), "bias": w[-1]}


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 1536, landmarks: int = 192) -> dict | None:
    """The classifier from at most ``sample_rows`` rows of ``labelled``."""
    known = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("id is not null and lang is not null")
    counts = known.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids"))
    n = counts.count()
    if n == 0:
        return None
    per = max(1, sample_rows // n)
    if n * per > 4 * sample_rows:
        raise ValueError(f"{n} languages: raise sample_rows")
    # the ``per`` ids of smallest hash of each language lie, as good as surely,
    # in the share of all hashes that holds some four times as many of its ids
    h = F.xxhash64("id")
    low = h / F.lit(2.0**64) + 0.5 <= F.lit(4.0 * per + 64) / F.col("ids")
    keys = known.join(F.broadcast(counts), "lang").where(low).select("id", "lang", h.alias("h")).distinct()
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = keys.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per)
    rows = known.join(F.broadcast(chosen.select("id", "lang", "r")), ["id", "lang"]).groupBy("lang", "r").agg(F.min("text").alias("text"))

    def features(it):
        for b in batches(it):
            got = [(np.packbits(x.astype(np.uint8), axis=1), ok) for x, ok in presence(b.column("text").to_pylist())]
            bits = [r.tobytes() for p, _ in got for r in p]
            ok = np.concatenate([k for _, k in got])
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("r"), pa.array(bits, pa.binary()), pa.array(ok)], names=["lang", "r", "bits", "ok"])

    got = rows.mapInArrow(features, "lang string, r int, bits binary, ok boolean").where("ok").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["r", "lang"])
    x = np.unpackbits(np.stack([np.frombuffer(b, np.uint8) for b in got.bits]), axis=1).astype(np.float32)
    y = got.lang.to_numpy()
    model = solve(x, y, max(1, landmarks // n))
    measured = [g for g in model["langs"] if (y == g).sum() >= MEASURED]
    return model | {"held": shares(x, y, model["langs"]).astype(np.float32), "least": least_typical(x, y, measured), "measured": measured}


def predict(docs: DataFrame, model: dict | None, text_col: str = "text", *, known: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), and on demand ``known``:
    whether the text has letters and is typical of a known language, or is
    found to be in one with too few fitted texts to tell."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")} | ({"known": F.lit(None).cast("boolean")} if known else {}))

    def run(it):
        model = shared.value
        if model:
            marks = np.unpackbits(model["marks"], axis=1).astype(np.float32)
            langs = np.array([*model["langs"], UNKNOWN], object)
        for b in batches(it):
            names, scores, sure = [], [], []
            texts = b.column(text_col).to_pylist()
            for x, ok in presence(texts):
                if not model:
                    sure += [False] * len(ok)
                    names += [UNKNOWN] * len(ok)
                    scores += [0.0] * len(ok)
                    continue
                f = kernel(x, marks) @ model["weights"] + model["bias"]
                best = f.argmax(axis=1)
                if known:
                    part = texts[len(sure) : len(sure) + len(ok)]
                    few = ~np.isin(langs[best].astype(str), model["measured"])
                    sure += (ok & (few | (likely(part, x, model["held"]) >= model["least"]))).tolist()
                names += langs[np.where(ok, best, len(langs) - 1)].tolist()
                scores += np.where(ok, np.clip(f[np.arange(len(f)), best], 0, 1), 0.0).tolist()
            new = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())} | ({"known": pa.array(sure, pa.bool_())} if known else {})
            yield pa.RecordBatch.from_arrays([new.get(f.name, b.column(f.name)).cast(f.type) for f in b.schema], schema=b.schema)

    return out.mapInArrow(run, out.schema)


def fold(id_col: str, n: int) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n
