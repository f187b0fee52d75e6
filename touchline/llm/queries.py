"""Registered queries of the corpus operators, and their SQL where SQL can
say the same. A query only names the tables, fixes production parameters and
derives the columns asked for; the work is the operator's."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bloom_lm, bpe, decontaminate, langid, lexical_search, line_templates, main_text, phrases, repeated_substrings, sharding, similarity_join, turn_trie, warc
from touchline.llm.common import shared_path, stored, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def hex_digest(col) -> F.Column:
    return F.sha2(col, 256)


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", hex_digest(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), hex_digest(ids).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(langid.fold("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(langid.fold("doc_id", 4) != 2))
    return langid.predict(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BPE_FILE)


def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.pairs_with_next(table(spark, sf_dir, "documents"))


def op9_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"))


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_substrings.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), hex_digest("kept").alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(lexical_search.build(table(spark, sf_dir, "documents")), "lexical-index")
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = stored(turn_trie.turns(table(spark, sf_dir, "conversations")), "conversations")
    return turn_trie.trie(turn_trie.rebuilt(convs))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.by_bytes(table(spark, sf_dir, "documents"), shards=40)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_line_templates": op1_line_templates,
    "op2_warc": op2_warc,
    "op3_decontaminate": op3_decontaminate,
    "op4_language_id": op4_language_id,
    "op5_main_text": op5_main_text,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_bpe": op7_bpe,
    "op8_phrase_fingerprints": op8_phrase_fingerprints,
    "op9_bloom_lm": op9_bloom_lm,
    "op10_repeated_substrings": op10_repeated_substrings,
    "op11_lexical_search": op11_lexical_search,
    "op12_turn_trie": op12_turn_trie,
    "op13_sharding": op13_sharding,
}

_TERMS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = {
    "op1_line_templates": f"""WITH {line_templates.sql()}
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(coalesce(new_text, '')) AS kept_sha256 FROM kept""",
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h HAVING count(*) > 1)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h""",
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS phrase, least(10, len(w)) AS n
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT g.r, g.k, g.n, p.item_id FROM g JOIN p ON g.phrase = p.phrase AND g.n = p.n),
hw AS (SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS i FROM (SELECT DISTINCT r, k, n FROM hits)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
       FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.r = hw.r LEFT JOIN it ON d.r = it.r
""",
    "op11_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS q, item_id, {_TERMS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
s AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
t AS (SELECT term, count(*) AS df FROM p GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight FROM t, s),
m AS (SELECT r, doc_id, 25 + ((75 * len(w) * big_n) // big_l) AS m FROM d, s WHERE len(w) > 0),
q AS (SELECT q, item_id, term, count(*) AS n FROM (SELECT q, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
x AS (SELECT q, item_id, r, doc_id, CAST(sum(n * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN wt USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM x WHERE score > 0) WHERE rank <= 10
""",
    "op12_turn_trie": """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, sha256(k)) AS place, {'k': k, 'n': n} AS x
           FROM (SELECT conv_id, turn, length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS k, length(coalesce(text, '')) AS n
                 FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, list(x ORDER BY place) AS own FROM t GROUP BY conv_id),
bits AS (SELECT conv_id, list((ascii(substr(conv_id::VARCHAR, i::INT, 1)) >> j::INT) & 1 ORDER BY i, j) AS b
         FROM c, unnest(range(1, length(conv_id::VARCHAR) + 1)) AS u(i), unnest(range(0, 8)) AS v(j) GROUP BY conv_id),
h AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]), lambda a, z: xor(a >> 1, 3988292384 * (xor(a, z) & 1))), 4294967295) % 6 AS h FROM bits),
s AS (SELECT c.conv_id, list_concat(coalesce(base.own[1:h], []), c.own[h + 1:]) AS s
      FROM c JOIN h USING (conv_id) LEFT JOIN c AS base ON base.conv_id = c.conv_id - c.conv_id % 100),
n AS (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CASE WHEN len(s) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
      FROM s, unnest(range(0, len(s) + 1)) AS u(d) GROUP BY ALL),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(p[d].n, 0) AS saved FROM n LEFT JOIN kids USING (p)),
sub AS (SELECT p[1:k] AS p, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM own, unnest(range(0, d + 1)) AS u(k) GROUP BY ALL)
SELECT own.conv_id, CAST(d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(own.n_convs AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM own JOIN sub USING (p) LEFT JOIN (SELECT p, conv_id FROM n) AS up ON d > 0 AND up.p = own.p[1:d - 1]
""",
}
