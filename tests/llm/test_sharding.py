"""Sharding against brute force over every contiguous partition."""

import zlib
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from touchline.llm import sharding
from touchline.llm.queries import op13_sharding


def plain_capacity(sizes, shards):
    @lru_cache(None)
    def best(i, k):
        if i == len(sizes):
            return 0
        if k == 0:
            return float("inf")
        total, found = 0, float("inf")
        for j in range(i, len(sizes)):
            total += sizes[j]
            found = min(found, max(total, best(j + 1, k - 1)))
        return found
    return best(0, shards)


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def loads(out):
    total = Counter()
    for r in out:
        total[r["shard"]] += r["size"]
    return total


@pytest.mark.parametrize("shards,cells", [(1, 4), (3, 4), (7, 16), (40, 1 << 16), (200, 8)])
def test_fullest_shard_is_as_small_as_can_be(spark, monkeypatch, shards, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    texts = [f"{i} " * ((i * 37) % 50 + 1) for i in range(60)] + ["same text"] * 9 + ["z" * 900]
    df = docs(spark, texts)
    out = sharding.by_bytes(df, shards).collect()
    hashes = {r["id"]: r["h"] for r in sharding.narrow(df).collect()}
    size = Counter()
    for i, t in enumerate(texts):
        size[hashes[i]] += len(t) + 16
    in_order = tuple(size[h] for h in sorted(size))
    assert max(loads(out).values()) == plain_capacity(in_order, shards)
    assert {r["id"] for r in out} == set(range(len(texts))) and len(out) == len(texts)
    assert len({r["shard"] for r in out if r["id"] in range(60, 69)}) == 1
    for s in {r["shard"] for r in out}:
        assert 0 <= s < shards
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    by_hash = sorted((hashes[r["id"]], r["shard"]) for r in out)
    assert [s for _, s in by_hash] == sorted(s for _, s in by_hash)


def test_every_shard_gets_its_share(spark):
    texts = [f"text {i} " * (1 + i % 7) for i in range(4000)]
    load = loads(sharding.by_bytes(docs(spark, texts), 40).collect())
    mean = sum(load.values()) / 40
    assert len(load) == 40 and max(load.values()) < 1.02 * mean and min(load.values()) > 0.95 * mean


def test_group_larger_than_its_share_leaves_the_rest_even(spark):
    texts = ["hot " * 20] * 2000 + [f"text {i} " * (1 + i % 7) for i in range(4000)]
    out = sharding.by_bytes(docs(spark, texts), 10).collect()
    load = loads(out)
    hot = next(r["shard"] for r in out if r["id"] == 0)
    rest = [n for s, n in load.items() if s != hot]
    assert len(load) == 10 and max(rest) < 1.4 * min(rest)  # the runs beside the hot group need not divide evenly


def test_odd_rows(odd, none):
    out = sharding.by_bytes(odd, 40).collect()
    assert len(out) == odd.count() and Counter(r["id"] for r in out)[1] == 2
    want = {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect()}
    for r in out:
        data = (want[r["id"]] or "").encode()
        assert r["size"] == len(data) + 16 and r["crc"] == zlib.crc32(data)
    shard = {r["id"]: r["shard"] for r in out}
    assert shard[3] == shard[4] and shard[9] == shard[10] and shard[None] == shard[1]
    assert sharding.by_bytes(none, 40).count() == 0


def test_query(spark):
    out = op13_sharding(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert out.groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("ok"), (F.min("slot") == 0).alias("zero")).where("not ok or not zero").count() == 0
