"""The pipeline's stages on odd rows."""

import random

import corpus_pipeline


def test_stages_keep_the_columns(odd, none, spark):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "tokenization":
            assert out.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 6 not in ids and 7 in ids and None in ids
    assert all(r["decodes_back"] for r in docs.collect())


def test_language_id_drops_unknown_languages(prose, spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    latin, greek = "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνοπρστυφχψω"
    strange = [(10**6 + k, text(latin if k % 2 else greek, 50 + 100 * k), None, "s", 0) for k in range(8)]
    clean = prose.select(corpus_pipeline.COLUMNS)
    one = clean.where("lang = 'en'").agg({"text": "max"}).first()[0]
    long = [(2 * 10**6, " ".join(r["text"] for r in clean.where("lang = 'en'").collect()), None, "s", 0), (2 * 10**6 + 1, one * 50, None, "s", 0)]
    docs = clean.union(spark.createDataFrame(strange + long, clean.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()}
    want = {r["doc_id"] for r in clean.where(r"text rlike '\\p{L}'").collect()} | {i for i, *_ in long}
    assert kept == want


def test_near_duplicates_keeps_unlike_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "en", "s", 1), (1, a, "de", "s", 1), (1, b, "en", "s", 1), (2, b + " end", "en", "s", 1), (3, c, "en", "s", 1), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r["doc_id"], r["text"] or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted([(1, a), (1, b), (3, c), (3, "")])
