"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import pytest

from touchline.llm import lexical_search as ls
from touchline.llm.common import stored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [] if text is None else TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text))


def plain(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [x for x in held if x[1]]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = 0
            for t in terms(text):
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return Counter(out)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    often = [1 / (i + 1) for i in range(200)]
    docs = [(i, " ".join(rng.choices(words, often, k=rng.randint(1, 60)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(words, often, k=rng.randint(1, 15)))) for i in range(20)]
    return docs, items


def run(spark, docs, items, tmp="lexical", segment_bytes=2000, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    out = ls.search(stored(ls.build(d, segment_bytes=segment_bytes), tmp), q, **kw)
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in out.collect())


@pytest.mark.parametrize("kw", [{}, {"block_pairs": 40}, {"broadcast_pairs": 0}, {"segment_bytes": 1 << 20}])
def test_same_as_scoring_every_document(spark, monkeypatch, kw):
    docs, items = corpus(700)
    assert run(spark, docs, items, **kw) == plain(docs, items)


def test_windows_are_skipped_without_loss():
    rng = random.Random(3)
    m = ls.length_norms(ls.np.array([rng.randint(1, 50) for _ in range(5000)]), 5000, 120_000)
    for trial in range(30):
        lists, want = [], Counter()
        for _ in range(rng.randint(1, 8)):
            ords = ls.np.array(sorted(rng.sample(range(5000), rng.choice([1, 5, 60, 700, 3000]))), ls.np.int32)
            p = ls.PostingList(ords, ls.np.array([rng.randint(1, 9) for _ in ords], ls.np.int32), m)
            lists.append((rng.choice([0, 1, 50, 4000]), p))
            for o, x in zip(p.ords.tolist(), p.parts.tolist()):
                want[o] += lists[-1][0] * x
        docs, scores = ls.best(lists, 5000, 10)
        ranked = sorted((x for x in want.values() if x), reverse=True)
        least = ranked[9] if len(ranked) > 9 else 1
        assert dict(zip(docs.tolist(), scores.tolist())) == {o: x for o, x in want.items() if x >= least and x}


def test_copies_ties_nulls_and_long_texts(spark):
    docs = [(i, "alpha beta gamma") for i in range(40)] + [(None, "alpha beta gamma"), (7, "alpha beta gamma"), (50, None), (51, ""), (52, "?! --"),
            (53, "alpha " * 400_000), (54, "GRÜN Alpha-beta_2"), (55, "x" * 3_000_000)]
    items = [(1, "ALPHA beta"), (1, "ALPHA beta"), (None, "grün"), (2, None), (3, ""), (4, "unknown"), (5, "alpha alpha alpha 2"), (6, "x" * 3_000_000)]
    got = run(spark, docs, items)
    assert got == plain(docs, items)
    assert got[(1, 1, 0, next(s for i, r, d, s in got if (i, r, d) == (1, 1, 0)))] == 2


def test_empty_tables_and_extra_columns(spark, odd, none):
    queries = odd.selectExpr("doc_id as item_id", "text", "version as item", "lang as term")
    index = stored(ls.build(odd), "lexical")
    got = Counter(tuple(r) for r in ls.search(index, queries).collect())
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got == plain(rows, rows)
    assert ls.search(index, queries.limit(0)).count() == 0
    nothing = ls.search(stored(ls.build(none), "lexical"), queries)
    assert nothing.count() == 0 and nothing.columns == ["item_id", "rank", "doc_id", "score"]


def test_large_collections_do_not_overflow():
    lengths = ls.np.array([10**7, 1], ls.np.int64)
    assert ls.length_norms(lengths, 10**12, 10**14).tolist() == [25 + 75 * 10**7 * 10**12 // 10**14, 25]
