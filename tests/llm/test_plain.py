"""Operators that SQL cannot express, against plain versions written from
their descriptions."""

import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import langid, line_templates, phrases

DIR = "/root/testdata/sf0.001"
M = (1 << 64) - 1


# --- language ID ---------------------------------------------------------


def plain_grams(text):
    """n-grams of 1 to 3 characters with a letter in them, by presence; what is
    no letter is a border."""
    a = [ord(c) if c.isalpha() else 0 for c in " " + text.lower() + " "]
    one = {(x,) for x in a if x}
    two = {(x, y) for x, y in zip(a, a[1:]) if x or y}
    three = {(x, y, z) for x, y, z in zip(a, a[1:], a[2:]) if y}
    return one | two | three


def column(gram):
    m = 0xFFFFFFFF
    if len(gram) == 1:
        return (gram[0] * 0x165667B1 & m) >> 19
    two = ((gram[0] * 0x9E3779B1 & m) ^ (gram[1] * 0x85EBCA6B & m)) * 0x27D4EB2F & m
    if len(gram) == 2:
        return two >> 19
    return ((two ^ (gram[2] * 0xC2B2AE35 & m)) * 0x165667B1 & m) >> 19


def test_presence_is_that_of_the_text_s_ngrams():
    texts = ["Grün ist die Straße", "a", "ab1c", "12 !!", "", "É d'été\n\nx"]
    x, ok = next(langid.presence(texts))
    for i, t in enumerate(texts):
        assert set(np.flatnonzero(x[i])) == ({column(g) for g in plain_grams(t)} if any(c.isalpha() for c in t) else set())
        assert ok[i] == any(c.isalpha() for c in t)


def test_nystroem_with_all_landmarks_is_kernel_ridge():
    """With every row a landmark, the scores are those of weighted kernel ridge
    regression in its dual form, solved directly."""
    rng = np.random.default_rng(5)
    base = rng.random((3, 60)) < 0.3
    y = np.array(["a", "b", "c"])[np.arange(36) % 3]
    x = np.zeros((36, langid.DIM), np.float32)
    x[:, :60] = np.where(rng.random((36, 60)) < 0.15, 1 - base[np.arange(36) % 3], base[np.arange(36) % 3])
    model = langid.solve(x, y, 36)
    marks = np.unpackbits(model["marks"], axis=1).astype(np.float32)
    got = langid.kernel(x, marks) @ model["weights"] + model["bias"]
    size = x.sum(axis=1)
    gram = (x @ x.T) / np.sqrt(np.outer(size, size)) + 1  # the bias is a constant feature
    target = np.stack([y == g for g in "abc"], axis=1).astype(float)
    weight = 1 / target.sum(axis=0)[np.array(["abc".index(g) for g in y])]
    dual = np.linalg.solve(gram + np.diag(1e-2 / len(x) / weight), target)
    assert np.abs(got - gram @ dual).max() < 2e-2
    assert (np.array(model["langs"])[got.argmax(axis=1)] == y).all()


# --- fingerprints by locally consistent parsing ---------------------------


def mix(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & M
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & M
    return x ^ x >> 32


def coin(symbols):
    """Three rounds of coin tossing from the left neighbour."""
    for _ in range(3):
        out = []
        for i, s in enumerate(symbols):
            if not i:
                out.append(s & 7)
                continue
            differ = s ^ symbols[i - 1]
            low = (differ & -differ).bit_length() - 1
            out.append(2 * low + (s >> low & 1))
        symbols = out
    return symbols


def folded(symbols):
    out = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1][1] += 1
        else:
            out.append([s, 1])
    return [mix((s + n * 0x9E3779B97F4A7C15) & M) for s, n in out], [s for s, _ in out]


def plain_sketch(text):
    weight = [int(x) for x in phrases._WEIGHT]
    names, features = list(text), set()
    for level in (1, 2, 3):
        if not names:
            break
        symbols, ground = folded(names)
        label = coin(ground if level == 1 else symbols)
        cuts = [0]
        for i in range(1, len(symbols) - 1):
            if label[i] < label[i - 1] and label[i] <= label[i + 1] and not (i == 1):
                cuts.append(i)
        names = []
        for a, b in zip(cuts, [*cuts[1:], len(symbols)]):
            names.append(mix(sum(mix(s) * weight[k % 4096] + k // 4096 for k, s in enumerate(symbols[a:b])) & M))
        if level in (2, 3) or len(names) == 1:
            features |= {mix((x + level) & M) for x in names}
    return sorted(features)[:64]


def test_fingerprints_by_plain_parsing():
    rng = np.random.default_rng(8)
    texts = [b"", b"a", b"aaaa", b"ab", "Grün ist die Straße".encode(), bytes(rng.integers(97, 101, 400).astype(np.uint8)), bytes(rng.integers(0, 256, 3000).astype(np.uint8)), b"xy" * 500]
    for text, sketch in zip(texts, phrases.sketches(texts)):
        assert [int(x) for x in sketch] == plain_sketch(text), text[:20]


# --- the pipeline, stage by stage -----------------------------------------


def plain_links(texts):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in texts.items()}
    name = {i: i for i in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x
    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                name[b] = a
    return {i: find(i) for i in sets}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_cut(text, items):
    """The text without the words that lie in a window of a benchmark item."""
    words = list(WORD.finditer(text.translate(LOWER)))
    plain = [m[0] for m in words]
    hit = [False] * len(words)
    for w in items:
        n = min(10, len(w))
        for p in {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else ():
            for k in range(len(plain) - n + 1):
                if tuple(plain[k : k + n]) == p:
                    hit[k : k + n] = [True] * n
    out, at, k = [], 0, 0
    while k < len(words):
        if hit[k]:
            end = k
            while end + 1 < len(words) and hit[end + 1]:
                end += 1
            out.append(text[at : words[k].start()])
            at, k = words[end].end(), end
        k += 1
    return "".join([*out, text[at:]])


def table_of(df):
    return sorted((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect())


def test_stages_against_plain_versions(spark, prose):
    stages = dict(corpus_pipeline.STAGES)
    docs = prose.select(corpus_pipeline.COLUMNS)
    rows = docs.collect()
    kept = stages["language_id"](spark, docs, DIR)
    # all documents of the table are in the languages that it is fitted on
    assert table_of(kept) == sorted(tuple(r) for r in rows if any(c.isalpha() for c in r["text"] or ""))

    lines = stages["line_dedup"](spark, kept, DIR)
    documents = pd.DataFrame([r.asDict() for r in kept.collect()])  # noqa: F841 - read by the query
    want = duckdb.sql(f"WITH {line_templates.sql()} SELECT doc_id, new_text, n_dropped FROM kept").fetchall()
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in lines.collect()) == sorted((i, t, len(t)) for i, t, n in want if not n or t.strip(" "))

    texts = {r["doc_id"]: r["text"] for r in lines.collect()}
    component = plain_links({i: re.findall("[^\x20\x09-\x0d]+", t.translate(LOWER)) for i, t in texts.items()})
    single = stages["near_duplicates"](spark, lines, DIR)
    assert table_of(single) == [r for r in table_of(lines) if component[r[0]] == r[0]]

    items = [WORD.findall((r["text"] or "").translate(LOWER)) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, single, DIR)
    cut = {r[0]: plain_cut(r[1], items) for r in table_of(single)}
    assert table_of(clean) == [(i, cut[i], g, s, len(cut[i])) for i, _, g, s, _ in table_of(single)]
    assert any(cut[i] != t for i, t, *_ in table_of(single))

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode.no_truncation()
    encode.no_padding()
    last = {r["doc_id"]: r for r in stages["tokenization"](spark, clean, DIR).collect()}
    assert {i: list(r["token_ids"]) for i, r in last.items()} == {i: encode.encode(t, add_special_tokens=False).ids for i, t in cut.items()}
    assert all(r["decodes_back"] for r in last.values())


def test_hash_fold_is_that_of_the_decimal(prose):
    got = {r["doc_id"]: r["f"] for r in prose.select("doc_id", langid.fold("doc_id", 4).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 for i in got}
