"""Window-style operators that stay safe when one group is huge.

A plain ``Window.partitionBy(g)`` sends every row of group ``g`` to one task.
With one match (or one player) holding a large share of all rows that task
becomes the job. The helpers below only ever window over *bounded* inputs:

* ``rank_by_histogram`` — rank = 1 + number of rows with a smaller value.
  Rows are first counted per (group, value) with a partial aggregate; the
  window then runs over distinct values only (at most 1,001 for a
  one-decimal stamina in [0, 100]) and the rank is joined back.
* ``ranged_lag`` / ``ranged_running_sum`` — a prefix scan. The rows are written
  once as a narrow table; splitters sampled from it cut the order (group, time,
  tiebreak, value, row number) into ranges of about ``RANGE_ROWS`` rows, whatever
  the share of one group, hour or time is, null times included. Each group is
  windowed range by range; only groups that a splitter divides need a carry
  into their later ranges, one row a range from a small aggregate, which enters
  as a sentinel sorted first. The large side is shuffled once, and the result
  equals the undivided window.

The rank join back is an ordinary equi-join; the rank side has one row per
(group, value), so AQE either broadcasts it after measuring it at run time
or splits skewed partitions of the large side.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import shared_dir

#: Rows of a range of the prefix scan.
RANGE_ROWS = 100_000
#: Most splitters the driver holds and ships as a literal (some 100 bytes each);
#: tables beyond RANGE_ROWS times that get proportionally larger ranges.
MAX_SPLITS = 1 << 16
#: Sampled rows for each splitter, collected by the driver.
SAMPLED = 8


def _eq_null_safe(left: DataFrame, right: DataFrame, cols: list[str], prefix: str) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[prefix + c])
        cond = e if cond is None else cond & e
    return cond


def rank_by_histogram(df: DataFrame, group: list[str], value: str,
                      ascending: bool = True, out: str = "rank") -> DataFrame:
    """SQL ``rank() OVER (PARTITION BY group ORDER BY value [ASC|DESC] NULLS LAST)``."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    p = "_r_"
    ranks = counts.select(
        *[F.col(c).alias(p + c) for c in group + [value]],
        (F.lit(1) + F.coalesce(F.sum("_n").over(before), F.lit(0))).cast("bigint").alias(out),
    )
    joined = df.join(ranks, _eq_null_safe(df, ranks, group + [value], p), "inner")
    return joined.drop(*[p + c for c in group + [value]])


def _numbered(df: DataFrame, keys: list[str], ts: str, tiebreak: str | None, value: str) -> tuple[DataFrame, int]:
    """The scan's columns written once, and their number of rows. ``_h`` and
    ``_o`` are a row's place in the order; the row number in it is fixed by the
    files, so rows that are equal otherwise can be told apart and divided."""
    spark = df.sparkSession
    order = F.struct(F.col(ts).alias("t"), (F.col(tiebreak) if tiebreak else F.lit(None)).cast("bigint").alias("b"),
                     F.col(value).cast("double").alias("v"), F.monotonically_increasing_id().alias("n"))
    narrow = df.withColumn("_h", F.xxhash64(*keys)).withColumn("_o", order)
    path = shared_dir(spark, "scan")
    narrow.write.parquet(path)
    back = spark.read.schema(narrow.schema).parquet(path)
    return back, back.count()  # from the files' footers


_PLACE = T.StructType([T.StructField("h", T.LongType()), T.StructField("t", T.DoubleType()), T.StructField("b", T.LongType()),
                       T.StructField("v", T.DoubleType()), T.StructField("n", T.LongType())])


def _splitters(narrow: DataFrame, rows: int, range_rows: int) -> list:
    """Places, in order, that cut the rows into ranges of about equal size."""
    wanted = min(rows // range_rows, MAX_SPLITS)
    if not wanted:
        return []
    place = F.struct(F.col("_h").alias("h"), "_o.*").alias("p")
    share = min(1.0, SAMPLED * wanted / rows)
    found = narrow.select(place).sample(share, 7).select(F.sort_array(F.collect_list("p")).alias("p")).first()["p"]
    step = len(found) / (wanted + 1)
    return sorted_unique([found[int(step * (i + 1))] for i in range(wanted) if int(step * (i + 1)) < len(found)])


def sorted_unique(rows: list) -> list:
    return [r for i, r in enumerate(rows) if not i or r != rows[i - 1]]


def _range_of(splits: list) -> Column:
    """Number of splitters at or below a row's place: a binary search in the
    literal array, so the cost is the logarithm of the splitters."""
    if not splits:
        return F.lit(0)
    text = json.dumps([r.asDict() for r in splits])
    every = F.from_json(F.lit(text), T.ArrayType(_PLACE))
    n = len(splits)
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    place = F.struct(F.col("_h").alias("h"), F.col("_o.t").alias("t"), F.col("_o.b").alias("b"), F.col("_o.v").alias("v"), F.col("_o.n").alias("n"))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(every, at + step - 1) <= place), at + step).otherwise(at))


def _scanned(df: DataFrame, keys: list[str], ts: str, tiebreak: str | None, value: str, out: str,
             carried: Column, combine, window_value, range_rows: int) -> DataFrame:
    """``window_value(window)`` over each group and range, with a sentinel row
    that carries ``combine`` of the ``carried`` aggregates of the ranges before."""
    narrow, rows = _numbered(df, keys, ts, tiebreak, value)
    splits = _splitters(narrow, rows, range_rows)
    # a group is divided only where a splitter has its hash
    divided = sorted({r["h"] for r in splits})
    cut = F.col("_h").isin(divided) if divided else F.lit(False)
    base = narrow.withColumn("_range", F.when(cut, _range_of(splits)).otherwise(0))
    if divided:
        parts = (base.filter(cut).groupBy(*keys, "_range").agg(carried.alias("_c"))
                 .withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_range"))))
        before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        sentinels = parts.withColumn(value, combine("_c", before)).filter(F.col("_n") > 1).drop("_n", "_c")
        base = base.withColumn("_real", F.lit(1)).unionByName(sentinels.withColumn("_real", F.lit(0)), allowMissingColumns=True)
    else:
        base = base.withColumn("_real", F.lit(1))
    # a sentinel has nulls for its place, which sort before every row's
    w = Window.partitionBy(*keys, "_range").orderBy("_o.t", "_o.b", "_o.v", "_o.n")
    done = base.withColumn(out, window_value(w)).filter(F.col("_real") == 1)
    return done.drop("_h", "_o", "_range", "_real")


def ranged_lag(df: DataFrame, keys: list[str], ts: str, tiebreak: str | None,
               value: str, out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY ts, tiebreak, value)``."""
    last = F.max_by(F.col(value), F.col("_o"))
    return _scanned(df, keys, ts, tiebreak, value, out, last,
                    lambda c, before: F.last(c).over(before), lambda w: F.lag(value).over(w), range_rows)


def ranged_running_sum(df: DataFrame, keys: list[str], ts: str, tiebreak: str | None,
                       value: str, out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY ts, tiebreak, value ROWS
    BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)``."""
    def running(w):
        return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _scanned(df, keys, ts, tiebreak, value, out, F.sum(value),
                    lambda c, before: F.sum(c).over(before), running, range_rows)
