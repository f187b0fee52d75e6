"""The skew-safe window helpers equal the plain windows they replace."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import windows
from touchline.operators.windows import ranged_lag, ranged_running_sum, rank_by_histogram


def _data(spark, n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = rnd.choice(["a", "a", "a", "b", "c"])  # one hot group
        v = None if rnd.random() < 0.05 else float(rnd.randint(0, 30))
        rows.append((g, float(rnd.randint(0, 20000)), i, v, rnd.randint(0, 100)))
    return spark.createDataFrame(rows, "g string, ts double, id long, v double, n long")


def test_rank_by_histogram(spark):
    df = _data(spark)
    for asc in (True, False):
        o = F.col("v").asc_nulls_last() if asc else F.col("v").desc_nulls_last()
        want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(o)).cast("bigint"))
        got = rank_by_histogram(df, ["g"], "v", asc, "r")
        assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.select(*want.columns).collect()))


def _hard(spark):
    """One group with a third of the rows at one time, null times and values,
    rows that are equal in every column, and a null key."""
    rnd = random.Random(4)
    rows = [("hot", 5.0, 1, 3.0, 2)] * 300 + [("hot", 5.0, None, float(rnd.randint(0, 3)), 1) for _ in range(200)]
    rows += [("hot", None, i, float(i % 7), 1) for i in range(250)] + [(None, 1.0, i, None if i % 3 else 2.0, 4) for i in range(90)]
    rows += [(rnd.choice("abc"), float(rnd.randint(0, 90)), i, float(i % 5), i) for i in range(300)]
    return spark.createDataFrame(rows, "g string, ts double, id long, v double, n long").repartition(5)


def _same(a, b, cols):
    assert Counter(map(tuple, a.select(cols).collect())) == Counter(map(tuple, b.select(cols).collect()))


@pytest.mark.parametrize("range_rows", [7, 60, 10_000])
def test_ranged_lag(spark, range_rows):
    for df in (_data(spark), _hard(spark)):
        want = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("ts", "id", "v")))
        _same(ranged_lag(df, ["g"], "ts", "id", "v", "p", range_rows), want, want.columns)


@pytest.mark.parametrize("range_rows", [7, 60, 10_000])
def test_ranged_running_sum(spark, range_rows):
    for df in (_data(spark), _hard(spark)):
        w = Window.partitionBy("g").orderBy("ts", "id", "n").rowsBetween(Window.unboundedPreceding, 0)
        want = df.withColumn("s", F.sum("n").over(w))
        _same(ranged_running_sum(df, ["g"], "ts", "id", "n", "s", range_rows), want, want.columns)


def test_without_tiebreak_and_empty(spark):
    df = _hard(spark)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("ts", "v"))).select("g", "ts", "v", "p")
    _same(ranged_lag(df.select("g", "ts", "v"), ["g"], "ts", None, "v", "p", 20), want, want.columns)
    assert ranged_lag(df.limit(0), ["g"], "ts", "id", "v", "p").count() == 0


def test_hot_hour_and_null_times_are_spread(spark):
    n = 200_000
    hot = spark.range(n).selectExpr("'m' as g", "cast(id % 3600 as double) as ts", "id", "cast(id % 10 as double) as v", "1L as n")
    null = spark.range(n).selectExpr("'z' as g", "cast(null as double) as ts", "cast(null as long) as id", "1.0D as v", "1L as n")
    narrow, rows = windows._numbered(hot.union(null), ["g"], "ts", "id", "v")
    splits = windows._splitters(narrow, rows, 5000)
    per = [r["count"] for r in narrow.groupBy("g", windows._range_of(splits).alias("r")).count().collect()]
    assert rows == 2 * n == sum(per) and len(per) >= 60 and max(per) < 4 * 5000
    out = ranged_running_sum(hot.union(null), ["g"], "ts", "id", "n", "s", 5000)
    assert {tuple(r) for r in out.groupBy("g").agg(F.max("s"), F.sum("s")).collect()} == {(g, n, n * (n + 1) // 2) for g in "mz"}
