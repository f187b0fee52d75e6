"""Each operator on odd rows and empty tables, and against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from touchline.llm import arrays, bloom_lm, bpe, components, decontaminate, fmindex, langid, line_templates, main_text, phrases, repeated_substrings, similarity_join, warc
from touchline.llm.common import shared_path

FILE = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- line templates ------------------------------------------------------


def test_templates_drop_all_but_the_first(spark):
    line = "Visited {} times since the year {} by all readers"
    docs = spark.createDataFrame([(i, f"own words {i}x here\n" + line.format(i, 2000 + i) + "\nshort") for i in range(1, 6)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(line_templates.drop_recurring_lines(docs))}
    assert [got[i]["n_dropped"] for i in range(1, 6)] == [0, 2, 2, 2, 2]  # `own words <*> here` recurs as well
    assert got[1]["text"].count("\n") == 2 and got[5]["text"] == "short"


@pytest.mark.parametrize("strangers", [0, 500])
def test_several_templates_of_one_length_and_beginning(spark, strangers):
    rng = np.random.default_rng(2)
    name = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 9)).title()
    lines = [f"Read more about {name()} on our great site" for _ in range(300)]
    lines += [f"Read more about the {name()} museum opening hours" for _ in range(300)]
    lines += ["Read more about " + " ".join(name() for _ in range(5)) for _ in range(strangers)]
    docs = spark.createDataFrame([(i, f"{name()} {name()}\n{x}") for i, x in enumerate(lines)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["n_dropped"] for r in rows(line_templates.drop_recurring_lines(docs))}
    assert [i for i in range(600) if not got[i]] == [0, 300]
    assert not any(got[i] for i in range(600, len(lines)))


def test_many_lines_of_one_document(spark):
    text = "\n".join(f"line number {i} of the long list here" if i % 2 else f"own {i}" for i in range(40_000))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(line_templates.drop_recurring_lines(docs))}
    assert [got[i]["n_dropped"] for i in range(3)] == [0, 20_000, 20_000] and got[2]["text"].count("\n") == 19_999


def test_templates_odd_rows(odd, none):
    got = rows(line_templates.drop_recurring_lines(odd))
    assert len(got) == odd.count() and all(r["text"] is None for r in got if r["doc_id"] == 3)
    assert {r["version"] for r in got} == {r["version"] for r in rows(odd)}
    assert rows(line_templates.drop_recurring_lines(none)) == []


# --- WARC ----------------------------------------------------------------


def test_warc_round_trip(spark):
    page = "<p>" + "wide words ü " * 40
    pages = spark.createDataFrame([(1, "http://a/\r\nb", page), (2, None, page), (3, "u", "same"), (4, "u", "same"), (5, "u", None), (None, "u", page), (6, "u", "z" * 200_000), (7, "v", page + "\r\n\r\n")], "page_id long, url string, html string")
    path = shared_path(spark, "warc-test")
    warc.write(pages, path)
    got = {r["page_id"]: r for r in rows(warc.read(spark, path, payloads=True))}
    assert len(got) == 8
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", 1) and got[None]["record_type"] == "response"
    assert got[4]["record_type"] == "response" and got[5]["payload_bytes"] == 0
    for r in rows(pages):
        raw, x = (r["html"] or "").encode(), got[r["page_id"]]
        assert (x["payload_bytes"], x["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert x["record_type"] == "revisit" or bytes(x["payload"]) == raw


def test_warc_finds_damage():
    r = warc.record(1, "u", "text " * 50, hashlib.sha256(b"text " * 50).hexdigest(), 250, None)
    data = b"".join(warc.archive([r] * 40))
    assert len(list(warc.frames(data))) == 40 and warc.parsed(r)[0] == 1
    with pytest.raises(ValueError):
        list(warc.frames(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.frames(data[4:]))
    for bad in (r.replace(b"text text", b"next text", 1), r[:-1], r.replace(b"WARC/1.1", b"WARC/9.9"), r.replace(b"WARC-Date: ", b"X-Date: ")):
        with pytest.raises(ValueError):
            warc.parsed(bad)


def test_warc_empty(spark):
    path = shared_path(spark, "warc-test")
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    warc.write(pages.limit(0), path)
    assert rows(warc.read(spark, path)) == []


# --- decontamination -----------------------------------------------------


def test_fm_index_locates():
    rng = np.random.default_rng(1)
    runs = [rng.integers(1, 5, n) for n in (50, 3, 40, 1)]
    index = fmindex.FMIndex(np.concatenate(runs), np.cumsum([0, 50, 3, 40]), 5)
    table = np.array([list(p) for p in np.ndindex(4, 4, 4)]) + 1
    who, at = index.locate(table, np.full(64, 3))
    want = sorted((int(np.flatnonzero((table == r[i : i + 3]).all(axis=1))[0]), s + i) for r, s in zip(runs, (0, 50, 53, 93)) for i in range(len(r) - 2))
    assert sorted(zip(who.tolist(), at.tolist())) == want


def test_repeated_and_many_benchmark_rows(spark):
    base = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + base + " y"), (2, "nothing here"), (3, "short item")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, base)] * 20 + [(8, base), (None, base), (9, "short item")] + [(100 + i, " ".join(f"n{i}_{k}" for k in range(40))) for i in range(60)], "item_id long, text string")
    plans = []
    for block in (1 << 24, 2000):
        out = decontaminate.find(docs, bench, block_bytes=block)
        plans.append(out._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        got = {r["doc_id"]: (r["n_words"], r["items"], [tuple(x) for x in r["spans"]]) for r in out.collect()}
        assert got[1][:2] == (32, [7, 8]) and [x[2:] for x in got[1][2]] == [(1, 31)]
        assert got[2] == (2, [], []) and got[3][1] == [9]
    assert plans[0] == plans[1]  # passes are stored, not chained


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_decontaminate(spark, odd, none, block):
    item = " ".join(f"q{i}" for i in range(14))
    bench = spark.createDataFrame([(1, item), (2, "tiny item"), (3, None), (4, "..."), (None, "nameless thing here"), (5, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " + item.upper() + ", b"), (2, "a tiny\nITEM!"), (3, item[:-4]), (4, "q1 q2"), (5, None), (6, "nameless thing here"), (7, "tiny item tiny item")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(decontaminate.find(docs, bench, block_bytes=block).withColumn("hit", decontaminate.n_hit()))}
    assert [got[i]["hit"] for i in range(1, 8)] == [14, 2, 13, 0, 0, 3, 4]
    assert [got[i]["items"] for i in range(1, 8)] == [[1, 5], [2], [1, 5], [], [], [], [2]]
    cut = {r["doc_id"]: r["text"] for r in rows(decontaminate.removed(decontaminate.find(docs, bench, block_bytes=block)))}
    assert cut[1] == "a , b" and cut[4] == "q1 q2" and cut[5] is None and cut[7] == ""
    assert len(rows(decontaminate.find(odd, bench))) == odd.count()
    assert rows(decontaminate.find(none, bench)) == [] and rows(decontaminate.find(docs, bench.limit(0)))[0]["spans"] == []


# --- language ID ---------------------------------------------------------


def test_language_id(prose, odd, none):
    held = langid.fold("doc_id", 4)
    model = langid.fit(prose.where(held != 2))
    got = langid.predict(prose.where(held == 2), model).select("lang", "lang_pred").collect()
    assert sum(r[0] == r[1] for r in got) >= 0.97 * len(got)
    by = {r["doc_id"]: r for r in rows(langid.predict(odd, model))}
    assert [by[i]["lang_pred"] for i in (3, 4, 5, 6)] == ["und"] * 4 and by[6]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in by.values())
    assert rows(langid.predict(none, model)) == [] and langid.fit(none) is None
    assert rows(langid.predict(odd, None))[0]["lang_pred"] == "und"


# --- main text -----------------------------------------------------------


def test_blocks():
    page = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li>menu</ul></nav>
    <div class="ad">buy</div><!-- <p>hidden</p> --><article><h1>Head&nbsp;line</h1><p>One &amp; <b>two<br>three<p>four
      five<aside>by the way</aside><div id="comments"><p>first!</p></div><form><p>mail</form></article><footer>foot</footer>"""
    assert main_text.blocks(page) == (["Head line", "One & two three", "four five"], True)
    assert main_text.blocks("") == ([], False)
    assert main_text.blocks("<p>a<nav>never closed</body>") == (["a"], False)


def test_blocks_of_loosely_named_elements():
    text = lambda page: main_text.blocks(page)[0]
    assert text("<div id='page' class='has-sidebar no-sidebar'><article><p>A</p><p class='notice'>B <span class='hljs-comment'># c</span></p><section class='related-work'><p>R</p></section></article></div><p>after</p>") == ["A", "B # c", "R"]
    assert text("<form class='widget'><main><p>A</p></main></form><p>after, and longer than the article</p>") == ["A"]
    assert text("<div class='sidebar'><article><p>The article, long enough</p></article></div><p>after</p>") == ["The article, long enough"]
    assert text("<article><p>A</p><div class='comments'><article><p>c1</p></article><article><p>c2</p></article></div><p>B</p></article>") == ["A", "B"]
    assert text("<p>A</p><div id='comments'><article><p>a long comment</p></article><article><p>c2</p></article></div><p>B</p>") == ["A", "B"]
    assert text("<article><p>A</p><div class='ad'>never closed</article><p>after</p>") == ["A"]
    assert text("<section aria-label='Comments on the social budget'><p>A</p></section><section aria-label='Comments'><p>c</p></section>") == ["A"]


def test_shared_lines():
    assert main_text.shared([1, 2, 3, 4, 5], [1, 9, 3, 5]) == {0, 2, 4}
    assert main_text.shared([], [1]) == set() and main_text.shared([7, 8], [8, 7]) in ({0}, {1})


def test_main_text_by_neighbours(spark):
    page = lambda t: f"<div>Site name</div><div>{t}</div><div>Imprint</div>"
    pages = spark.createDataFrame([(i, f"http://h.example/s/{i}?x=1", page(f"Story {i}")) for i in range(4)] + [(4, "http://other.example/s/1", page("Lone")), (5, None, None), (6, "bad", "<article><p>A</article>"), (7, "http://h.example/s/3", page("Story 3"))], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in rows(main_text.extract(pages))}
    assert [got[i]["text"] for i in range(3)] == ["Story 0", "Story 1", "Story 2"]
    assert got[4]["text"] == "Site name\nLone\nImprint" and got[5]["text"] == "" and got[6]["text"] == "A"
    assert got[0]["n_chars"] == 7 and rows(main_text.extract(pages.limit(0))) == []


def test_main_text_copies_and_articles(spark, monkeypatch):
    page = lambda t: f"<div>Site name</div><div>{t}</div><div>Imprint</div>"
    body = lambda i: "".join(f"<p>Text {i} {k}</p>" for k in range(4))
    art = lambda i, more="": f"<p>Top {i}</p><article>{body(i)}{more}<p>Share this page</p></article>"
    data = [(i, f"http://flat.example/{i:02}", page(f"Story {i}")) for i in range(10)]  # every page a section of its own
    data += [(100 + i, f"http://run.example/s/1?again={i}", page("Copied")) for i in range(5)] + [(110, "http://run.example/s/2", page("Other"))]
    data += [(200 + i, f"http://art.example/{i}", art(i)) for i in range(3)]
    data += [(210, "http://art.example/1b", art(1, "<p>Edited</p>")), (211, "http://art.example/1c", art(1).replace("Top 1", "Top one"))]
    want = {i: f"Story {i}" for i in range(10)} | {100 + i: "Copied" for i in range(5)} | {110: "Other"}
    text = lambda i: "\n".join(f"Text {i} {k}" for k in range(4))
    want |= {200 + i: text(i) for i in range(3)} | {210: text(1) + "\nEdited", 211: text(1)}
    monkeypatch.setattr(main_text, "RUN", 3)  # cuts inside hosts
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in rows(main_text.extract(pages))} == want
    monkeypatch.setattr(main_text, "SENT", 0)  # the texts travel to the places
    assert {r["page_id"]: r["text"] for r in rows(main_text.extract(pages))} == want


def test_blocks_of_an_article_need_more_than_one_neighbour(spark):
    """A short paragraph or licence line that a few articles share stays, a
    line that most pages of the host have goes."""
    art = lambda i: "<nav>Menu</nav><article>" + f"<p>Yes.</p><p>Licence</p>" * (i % 4 == 0) + "".join(f"<p>Text {i} {k}</p>" for k in range(5)) + "<p>Read our paper</p></article>"
    pages = spark.createDataFrame([(i, f"http://host.example/{i:03}", art(i)) for i in range(40)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in rows(main_text.extract(pages))}
    for i in range(40):
        assert got[i] == ["Yes.", "Licence"] * (i % 4 == 0) + [f"Text {i} {k}" for k in range(5)]
    two = spark.createDataFrame([(i, f"http://host.example/{i}", art(4 * i)) for i in range(2)], "page_id long, url string, html string")
    assert all(r["text"].startswith("Yes.\nLicence\n") for r in rows(main_text.extract(two)))


def test_long_alignments():
    rng = np.random.default_rng(4)
    small = [(rng.integers(0, 30, 200).tolist(), rng.integers(0, 30, 180).tolist()) for _ in range(5)]
    plain = [main_text.shared(a, b) for a, b in small]
    table = main_text.TABLE
    try:
        main_text.TABLE = 64
        for (a, b), want in zip(small, plain):
            got = main_text.shared(a, b)
            assert len(got) == len(want)
            picked, at = [a[i] for i in sorted(got)], 0
            for x in picked:  # a subsequence of b
                at = b.index(x, at) + 1
    finally:
        main_text.TABLE = table
    n = 50_000
    a, b = rng.permutation(n).tolist(), rng.permutation(n)[:2000].tolist()
    assert 60 < len(main_text.shared(a, b)) < 2000
    assert len(main_text.shared(a, a[:20_000] + a[30_000:])) == 40_000


# --- Jaccard join --------------------------------------------------------


def plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    name = {i: i for i in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, k in common.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                name[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_join_finds_every_class(spark):
    rng = np.random.default_rng(3)
    texts, passage = {}, " ".join(f"p{k}" for k in range(40))
    for i in range(90):
        base = [f"w{x}" for x in np.random.default_rng(i // 6).integers(0, 400, 12 * (i // 6) + 5)]
        for _ in range(int(rng.integers(0, 4))):
            base[int(rng.integers(0, len(base)))] = f"n{rng.integers(0, 99)}"
        texts[i] = " ".join(base) + (" " + passage if i % 3 else "")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(similarity_join.near_duplicates(docs))}
    assert got == plain_components(texts)


def test_round_two_has_the_pairs_of_every_group(spark):
    """Groups of one hub with other members, and groups that share pairs."""
    ids = [1, 2, 3, 5, 6, 7]
    groups = spark.createDataFrame([(10, 1, [2, 3]), (20, 1, [5, 6]), (30, 1, [2, 3, 7]), (40, 2, [3, 7, 5]), (50, 1, [5, 6])], "gid long, hub long, members array<long>")
    bits = bytes(64)
    reps = spark.createDataFrame([(i, 20, bits) for i in ids], "id long, n long, bits binary")
    found = spark.createDataFrame([], "id long, component long")
    made = sorted(tuple(r) for r in similarity_join._second(groups, reps, found, False, 8).collect())
    held = [[2, 3], [5, 6], [2, 3, 7], [3, 7, 5]]  # the hubs' pairs are checked before
    assert made == sorted({(x, y) for g in held for x in g for y in g if x < y})


def cluster(n, seed):
    """Near copies of one text, each with a few words of its own."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 400, 300)]
    out = []
    for i in range(n):
        own = list(base)
        for k in rng.integers(0, 300, 9):
            own[int(k)] = f"n{rng.integers(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_pairs_of_a_cluster_grow_with_its_members(spark, monkeypatch):
    made, second = [], similarity_join._second

    def counted(*args):
        out = second(*args).persist()
        made[-1] += out.count()
        return out
    monkeypatch.setattr(similarity_join, "_second", counted)
    for n in (60, 120):
        made.append(0)
        texts = dict(enumerate(cluster(n, 8)))
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(similarity_join.near_duplicates(docs))}
        assert got == plain_components(texts)
    assert made[1] <= 2.5 * made[0] + 20, made


def test_unlike_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    docs = spark.createDataFrame([(5, a), (5, b), (2, a + " end"), (3, b + " end"), (4, c), (7, c), (7, None)], "doc_id long, text string")
    for _ in range(2):
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(similarity_join.near_duplicates(docs.repartition(4))))
        assert got == Counter({(5, 76, 2): 2, (2, 77, 2): 1, (3, 77, 2): 1, (4, 76, 4): 1, (7, 76, 4): 1, (7, 0, 7): 1}), got  # no words: linked with nothing


def test_signatures_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    for n in [*range(1, 40), 100, 300, 1000]:
        for _ in range(6):
            a = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
            drop, add = 0, 0
            while True:  # as different as a link allows
                more = (drop + 1, add) if rng.random() < 0.5 else (drop, add + 1)
                if 100 * (len(a) - more[0]) < 75 * (len(a) + more[1]) or more[0] >= len(a):
                    break
                drop, add = more
            b = np.unique(np.concatenate([a[drop:], rng.integers(1, 2**63, add).astype(np.uint64)]))
            sig = [set(np.concatenate(similarity_join.signatures(x, np.zeros(len(x), bool))).tolist()) for x in (a, b)]
            assert sig[0] & sig[1], (n, drop, add)


def test_join_odd_rows(odd, none):
    got = rows(similarity_join.near_duplicates(odd))
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert len(got) == 12 and by[2] == 1 and by[10] == 9 and by[4] == 4 and by[None] is None
    assert rows(similarity_join.near_duplicates(none)) == []


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (10, 9), (2, 20), (None, 1)], "a long, b long")
    got = {r["id"]: r["component"] for r in rows(components.components(links, "a", "b"))}
    assert got == {5: 2, 4: 2, 3: 2, 20: 2, 9: 8, 10: 8}


# --- BPE -----------------------------------------------------------------


def test_bpe_is_the_librarys(spark, odd, none, prose):
    lib = Tokenizer.from_file(FILE)
    texts = ["a  b   \n c\t\t d", " lead", "x<|endoftext|>y <|endoftext|>", "don't I'll 've  's", "日本語　x   y", "👩‍👩‍👧", "aaaa" * 300, "foo   \nbar \n  baz   ", *[r["text"] for r in prose.limit(40).collect()]]
    codec = bpe.Codec(bpe.load_model(FILE))
    for t, ids in zip(texts, codec.encode(texts)):
        assert ids == lib.encode(t, add_special_tokens=False).ids and codec.decode(ids).decode() == lib.decode(ids, skip_special_tokens=False)
    for r, want in zip(rows(bpe.round_trip(odd, FILE)), rows(odd)):
        ids = lib.encode(want["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((want["text"] or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(odd, FILE), FILE)
    assert [r["text"] for r in rows(back)] == [r["text"] or "" for r in rows(odd)] and rows(bpe.round_trip(none, FILE)) == []


# --- phrase fingerprints -------------------------------------------------


def test_phrases_are_local():
    rng = np.random.default_rng(2)
    body = bytes(rng.integers(97, 123, 4000).astype(np.uint8))
    a, b, c = phrases.sketches([body, b"some other start " + body, bytes(rng.integers(97, 123, 4000).astype(np.uint8))])
    assert phrases.likeness(a, b) > 0.9 and phrases.likeness(a, c) < 0.05 and phrases.likeness(a, a) == 1.0


def test_phrases_of_equal_ids_and_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    text = lambda: "".join(rng.choice(list("abcdefgh "), 300))
    data = [(1, "first " + text())] + [(5, "same " * 50)] * 40 + [(5, text()) for _ in range(20)] + [(None, text()) for _ in range(20)] + [(9, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    out = rows(phrases.pairs_with_next(docs, range_bytes=2000))
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in data)
    twins = [r for r in out if r["n_chars"] == 250 and r["doc_id"] == 5]
    assert len(twins) == 40 and sum(r["near_next"] == 1.0 for r in twins) == 39 and len({r["fingerprint"] for r in twins}) == 1
    for r in out:  # a row's edited text has the first characters of one other row, the last row's of the first
        half = r["n_chars"] // 2
        mine = [t for i, t in data if i == r["doc_id"] and len(t) == r["n_chars"]]
        assert any(hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest() == r["edited_sha256"] for t in mine for _, n in data)


def test_phrases_next_and_edited(odd, none, prose):
    docs = prose.select("doc_id", "text")
    got = {r["doc_id"]: r for r in rows(phrases.pairs_with_next(docs, range_bytes=50_000))}
    order = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    for (i, t), (_, nxt) in zip(order, [*order[1:], order[0]]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.25 > 0.05 > np.mean([r["near_next"] for r in got.values()])
    for small in (1, 7_000):  # more ranges than rows, and few rows held at once
        again = {r["doc_id"]: r for r in rows(phrases.pairs_with_next(docs.repartition(3), range_bytes=small))}
        assert again == got
    odd_rows = rows(phrases.pairs_with_next(odd))
    assert len(odd_rows) == 12 and len({r["fingerprint"] for r in odd_rows if r["doc_id"] in (9, 10)}) == 1
    assert rows(phrases.pairs_with_next(none)) == []


# --- language model ------------------------------------------------------


def test_lm_base_is_exact_and_model_helps(prose):
    got = {r["doc_id"]: r for r in rows(bloom_lm.score(prose))}
    texts = {r["doc_id"]: [*words(r["text"]), None] for r in prose.collect()}
    count = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in texts.items():
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert math.isclose(got[i]["base_score"], base, rel_tol=1e-9) and got[i]["train_tokens"] == n
        assert got[i]["n_tokens"] == len(t) and got[i]["n_known"] == sum(count[w] > 0 for w in t)
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())


def test_lm_odd_rows(odd, none):
    got = rows(bloom_lm.score(odd))
    assert len(got) == 12 and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    twins = [r for r in got if r["doc_id"] == 1]
    assert twins[0] == twins[1] and not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert rows(bloom_lm.score(none)) == []


def test_lm_broadcast_and_travelling_probes_agree(spark, prose, odd):
    for docs in (prose.select("doc_id", "text"), odd.select("doc_id", "text")):
        a, b = (sorted(map(tuple, bloom_lm.score(docs, broadcast_bytes=n).collect()), key=str) for n in (1 << 30, -1))
        assert len(a) == len(b) == docs.count()
        for x, y in zip(a, b):
            assert x[:5] == y[:5] and math.isclose(x[5], y[5], rel_tol=1e-9) and math.isclose(x[6], y[6], rel_tol=1e-9)


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, -1])
def test_lm_disk_does_not_grow_with_the_buckets(spark, tmp_path, monkeypatch, broadcast_bytes):
    """As many buckets as words of a document, as on some 6 GB: what is
    shuffled and stored stays a few times the text."""
    rng = np.random.default_rng(9)
    vocabulary = np.array(["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9))) for _ in range(20_000)])
    texts = [" ".join(vocabulary[(20_000 * rng.random(300) ** 3).astype(int)]) for _ in range(600)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs, disk = spark.read.parquet(str(tmp_path / "docs")), {}
    few = {r["doc_id"]: r for r in rows(bloom_lm.score(docs, broadcast_bytes=broadcast_bytes))}

    def stored(df, name):
        spark.conf.set(bloom_lm.CLEANUP, "false")  # shuffle files stay, to be measured
        df.write.parquet(str(tmp_path / name))
        disk.update(shuffled())
        disk.update({f: f.stat().st_size for f in (tmp_path / name).rglob("*.parquet")})
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    def shuffled():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f: f.stat().st_size for d in local for f in Path(d.getPath()).rglob("shuffle_*.data")}

    monkeypatch.setattr(bloom_lm, "stored", stored)
    monkeypatch.setattr(bloom_lm, "BUCKET", 13)
    before = shuffled()
    many = {r["doc_id"]: r for r in rows(bloom_lm.score(docs, broadcast_bytes=broadcast_bytes))}
    assert sum(size for f, size in disk.items() if f not in before) < 3.5 * sum(map(len, texts))
    for i, r in many.items():  # exact counts do not depend on the buckets, false positives do
        assert r["n_known"] == few[i]["n_known"] and math.isclose(r["base_score"], few[i]["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], few[i]["score"], rel_tol=0.05)
    assert len(many) == 600


def test_lm_leaves_no_shuffle_files_and_the_setting_as_it_was(spark, monkeypatch):
    seen, plain = [], bloom_lm.stored

    def stored(df, name):
        seen.append((name, spark.conf.get(bloom_lm.CLEANUP)))
        if name == "scores":
            raise OSError("no room")
        return plain(df, name)

    before = spark.conf.get(bloom_lm.CLEANUP)
    monkeypatch.setattr(bloom_lm, "stored", stored)
    with pytest.raises(OSError):
        bloom_lm.score(spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id long, text string"))
    assert seen[1:] == [("ngrams", "true"), ("scores", "true")] and spark.conf.get(bloom_lm.CLEANUP) == before


def test_whole_numbers_in_as_many_bytes_as_they_need():
    parts = [np.array(x, np.int64) for x in ([], [0], [1, 255], [256, 0, 3], [1 << 40, 7])]
    packed = [bloom_lm._narrow(x) for x in parts]
    assert [len(x) for x in packed] == [0, 1, 2, 6, 12]
    assert bloom_lm._wide(packed, np.array([len(x) for x in parts])).tolist() == np.concatenate(parts).tolist()


def quantised(c):
    return 0.0 if c == 0 else 1.0 if c == 1 else 1.5 * 2 ** (int(math.log2(c)))


@pytest.mark.parametrize("size", [130, 200])
def test_lm_score_by_a_dictionary_of_quantised_counts(prose, size):
    """With a filter of few false positives the scores are those of exact
    dictionaries; with the usual one, a few n-grams in a hundred differ."""
    docs = prose.select("doc_id", "text").where(f"doc_id < {size}").coalesce(1)
    texts = {r["doc_id"]: [*words(r["text"]), None] for r in docs.collect()}
    train = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10}
    single, pair = Counter(), Counter()
    for t in train.values():
        single.update(t)
        pair.update(zip(["", *t], t))
    holders = Counter(w for t in texts.values() for w in set(t))
    n, v = sum(map(len, train.values())), len(single)
    single[""] = len(train)
    # frequent words are counted exactly, the others by levels
    count = {w: c if w in ("", None) or holders[w] * 64 >= len(texts) else quantised(c) for w, c in single.items()}

    def log_sum(t, x, less=0):
        total = 0.0
        for a, b in zip(["", *t], t):
            k, p, q = (max(0, c - less) for c in (quantised(pair[a, b]), count.get(a, 0), count.get(b, 0)))
            k = min(k, p, q) if count.get(a) and count.get(b) else 0
            total += math.log10(x * k / max(p, 1) + (1 - x) * (q + 0.1) / (n + 0.1 * (v + 1)))
        return total
    best = max(bloom_lm.WEIGHTS, key=lambda x: sum(log_sum(t, x, 1) for t in train.values()))
    fine, usual = ({r["doc_id"]: r["score"] for r in rows(bloom_lm.score(docs, entry_bits=e))} for e in (96, bloom_lm.ENTRY_BITS))
    exact = sum(math.isclose(fine[i], log_sum(t, best), rel_tol=1e-9) for i, t in texts.items())
    assert exact >= 0.98 * len(texts), (exact, best)
    tokens, off = sum(map(len, texts.values())), sum(abs(usual[i] - fine[i]) for i in texts)
    assert off < 0.15 * tokens


def test_filter_has_every_ngram_and_few_others():
    rng = np.random.default_rng(3)
    for size in (50, 20_000):
        h = np.unique(rng.integers(1, 2**63, size).astype(np.uint64) * np.uint64(2))
        n = rng.integers(1, 100, len(h))
        made = bloom_lm.segment(h, n, 0, 0)
        assert len(made.data) * 8 <= max(64, bloom_lm.levels(n).sum() * bloom_lm.ENTRY_BITS + 8)
        want = np.array([quantised(c) for c in n])
        got = made.counts(h)
        assert (got >= want).all() and (got > want).mean() < 0.06
        strange = rng.integers(1, 2**63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1) << np.uint64(17)
        assert (made.counts(strange) > 0).mean() < 0.05


# --- repeated substrings -------------------------------------------------


def plain_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        out[i] = (bytes(b for b, g in zip(raw, gone) if not g), len(re.findall(b"\1+", bytes(gone))))
    return out


def test_multikey_quicksort():
    rng = np.random.default_rng(9)
    for n, kinds in ((0, 2), (1, 2), (40, 2), (3000, 2), (3000, 5), (2000, 2**60)):
        words_ = rng.integers(0, kinds, (n, 6)).astype(">u8")
        got = words_[repeated_substrings.multikey_order(words_)]
        assert got.tolist() == sorted(words_.tolist())


def test_fingerprints_piece_by_piece(monkeypatch):
    data = (" ".join("w%d" % (i % 977) for i in range(5000)) + " " + "z" * 3000 + " end").encode() + b"\n"
    low = arrays.lowered(data)
    s, e = arrays.words(low, arrays.WORD_NOT_SPACE)
    whole = arrays.fingerprints(low, s, e)
    monkeypatch.setattr(arrays, "PIECE", 256)
    assert (arrays.fingerprints(low, s, e) == whole).all()


def test_repeats_in_long_texts(spark, monkeypatch):
    """One text in windows: its runs are cut, the bytes removed are the same."""
    rng = np.random.default_rng(12)
    block = "".join(rng.choice(list("abcdefgh "), 5000))
    long = "".join(rng.choice(list("abcdefgh "), 3000)) + block + "".join(rng.choice(list("abcdefgh "), 2500)) + block[1000:4000] + "tail"
    data = long.encode() + b"\n"
    monkeypatch.setattr(repeated_substrings, "WINDOW", 700)
    cut = repeated_substrings.long_runs(data)
    whole = repeated_substrings.runs(data, np.array([0, len(data)]))
    places_of = lambda r: sorted((int(x["start"]) + k, int(x["start"]) + int(x["left"])) for x in r for k in range(x["count"]))
    assert places_of(cut) == places_of(whole)
    texts = {1: long, 2: "x" * 4_500_000 + block, 3: block[:600]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(repeated_substrings.dedup(docs))}
    want = plain_repeats({k: v for k, v in texts.items() if k != 2} | {2: "x" * 300 + block})
    assert bytes(got[1]["kept"]) == want[1][0] and bytes(got[3]["kept"]) == want[3][0] == b""
    assert bytes(got[2]["kept"]) == want[2][0]


@pytest.mark.parametrize("parts", [None, 7])
def test_repeats(spark, monkeypatch, parts):
    if parts:  # many boundaries between sorted partitions
        plain = repeated_substrings._compared
        monkeypatch.setattr(repeated_substrings, "_compared", lambda s, n: plain(s, parts))
    rng = np.random.default_rng(7)
    letters = lambda n: "".join(rng.choice(list("abcdefgü "), n))
    passage, texts = letters(400), {}
    for i in range(60):
        a, b = sorted(rng.integers(0, 400, 2))
        texts[i] = letters(int(rng.integers(0, 200))) + passage[a:b] + letters(int(rng.integers(0, 50))) + (passage if i % 7 == 0 else "") + ("ab" * 150 if i % 11 == 0 else "")
    got = {r["doc_id"]: (bytes(r["kept"]), len(r["spans"])) for r in rows(repeated_substrings.dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)))}
    assert got == plain_repeats(texts)


def test_repeats_odd_rows(odd, none):
    got = rows(repeated_substrings.dedup(odd))
    assert len(got) == 12
    assert {r["n_bytes"] for r in got if r["doc_id"] in (3, 4)} == {0}
    assert sum(len(r["spans"]) for r in got if r["doc_id"] is None) == 1
    assert rows(repeated_substrings.dedup(none)) == []
