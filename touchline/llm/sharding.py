"""Shards of near-equal bytes: a minimax contiguous partition of text groups.

Rows with equal texts are one atomic group, which no cut may divide. Groups
stand in the order of a 64-bit hash of their text, so a row's place among the
cuts follows from its own text, without a join. The capacity of the fullest
shard is the smallest that a contiguous partition into ``shards`` runs allows:
a binary search over the capacity, each candidate checked greedily.

The groups stay in Spark. The driver sees a *sketch*: cells of consecutive
hashes with their bytes and number of groups, at most ``CELLS`` from one look.
On a sketch a capacity is checked twice: with cells of several groups
taken as indivisible (feasible there: feasible) and as divisible anywhere
(infeasible there: infeasible). Between the two answers only the cells that a
cut may fall into are looked at again, in finer cells, until both agree; then
the capacity and the cuts are exact. So rounds grow with the logarithm of the
groups, and neither the driver nor a task holds more than its bounded part.

Everything is built-in functions. Defined results: a text of null counts no
bytes and is one group with empty texts; rows without id, repeated rows and
extra columns are rows like any other; an empty table gives an empty result; a
group larger than its share fills a shard of its own size; with fewer groups
than shards the last shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import stored

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Cells that one look at the groups gives the driver: 2^16 rows of four numbers.
CELLS = 1 << 16
_FULL = 64


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the sharding needs of each row; ``h`` orders the groups, ``row``
    numbers the rows of one partition of the input."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("row"))


def groups(rows: DataFrame) -> DataFrame:
    """Bytes of each group; partial sums leave one row a group and task."""
    return rows.groupBy("h").agg(F.sum("size").alias("bytes"))


@dataclass
class Sketch:
    """Cells in hash order: the lowest hash that each may hold, the width of
    that range in bits, its bytes and groups."""

    low: list[int]
    bits: list[int]
    size: list[int]
    count: list[int]

    def __post_init__(self) -> None:
        self.edge = [0]
        for x in self.size:
            self.edge.append(self.edge[-1] + x)

    def whole(self, i: int) -> bool:
        return self.count[i] <= 1 or self.bits[i] == 0

    def reach(self, start: int, capacity: int, divisible: bool) -> int:
        """The furthest end of a shard that begins at byte ``start``."""
        to = start + capacity
        if to >= self.edge[-1]:
            return self.edge[-1]
        i = bisect_right(self.edge, to) - 1  # the cell in which byte ``to`` lies
        if divisible and not self.whole(i):
            return to
        return max(self.edge[i], start)

    def ends(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Greedy ends of the shards, at most ``shards`` of them."""
        out, at = [], 0
        while at < self.edge[-1] and len(out) < shards:
            to = self.reach(at, capacity, divisible)
            if to == at:
                break
            out.append(at := to)
        return out

    def feasible(self, capacity: int, shards: int, divisible: bool) -> bool:
        return (self.ends(capacity, shards, divisible) or [0])[-1] == self.edge[-1]

    def smallest(self, shards: int, divisible: bool, least: int) -> int:
        low, high = least, max(least, self.edge[-1])
        while low < high:
            mid = (low + high) // 2
            if self.feasible(mid, shards, divisible):
                high = mid
            else:
                low = mid + 1
        return low


def _first(found: DataFrame) -> tuple[Sketch, int]:
    """The sketch of all groups by the upper bits of their hashes, and the
    bytes of the largest group."""
    bits = _FULL - (CELLS.bit_length() - 1)
    rows = found.groupBy(F.shiftright("h", bits).alias("n")).agg(
        F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("count"), F.max("bytes").alias("most")).collect()
    rows.sort()
    sketch = Sketch([r["n"] << bits for r in rows], [bits] * len(rows), [r["size"] for r in rows], [r["count"] for r in rows])
    return sketch, max((r["most"] for r in rows), default=0)


def _finer(found: DataFrame, sketch: Sketch, split: list[int]) -> Sketch:
    """The sketch with the cells ``split``, all of one width, divided."""
    wide = sketch.bits[split[0]]
    bits = max(0, wide - max(1, (CELLS // len(split)).bit_length() - 1))
    chosen = found.where(F.shiftright("h", wide).isin([sketch.low[i] >> wide for i in split]))
    rows = chosen.groupBy(F.shiftright("h", bits).alias("n")).agg(
        F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("count")).collect()
    gone = set(split)
    cells = {sketch.low[i]: (sketch.bits[i], sketch.size[i], sketch.count[i]) for i in range(len(sketch.low)) if i not in gone}
    cells.update({r["n"] << bits: (bits, r["size"], r["count"]) for r in rows})
    low = sorted(cells)
    return Sketch(low, *([cells[x][k] for x in low] for k in range(3)))


def capacity(found: DataFrame, shards: int) -> tuple[int, Sketch]:
    """The smallest feasible capacity, exactly, and a sketch that is fine
    enough to cut by it."""
    sketch, largest = _first(found)
    while True:
        low = sketch.smallest(shards, True, largest)
        high = sketch.smallest(shards, False, low)
        if low == high:
            return low, sketch
        # a cut lies between the greedy ends of indivisible cells at the lower
        # bound and those of divisible cells at the upper one; were all cells
        # between them single groups, both checks would agree
        first, last = sketch.ends(low, shards, False), sketch.ends(high, shards, True)
        first, last = first or [0], last or [0]
        split: set[int] = set()
        for k in range(shards):
            begin, end = first[min(k, len(first) - 1)], last[k] if k < len(last) else sketch.edge[-1]
            cells = range(bisect_right(sketch.edge, begin) - 1, bisect_left(sketch.edge, end))
            split.update(x for x in cells if not sketch.whole(x))
        wide = max(sketch.bits[i] for i in split)
        sketch = _finer(found, sketch, sorted(i for i in split if sketch.bits[i] == wide))


def cuts(sketch: Sketch, most: int, shards: int) -> list[int]:
    """The lowest hash of every shard after the first. No shard exceeds
    ``most``. Where a few large groups alone call for that capacity, the other
    shards are cut to the smallest one that leaves those a shard each; within
    it, each ends where it comes nearest to an equal share of what is left."""
    edge, end = sketch.edge, sketch.edge[-1]

    def onward(at: int, size: int) -> int:
        return max(sketch.reach(at, size, False), edge[min(bisect_right(edge, at), len(edge) - 1)])

    def fits(size: int) -> bool:
        at, n = 0, 0
        while at < end and n < shards:
            at, n = onward(at, size), n + 1
        return at == end

    low, high = 0, most
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    usual = high
    # from back[k] on, shards k, k + 1, ... hold the rest
    back = [end] * (shards + 1)
    for k in range(shards - 1, -1, -1):
        i = bisect_left(edge, max(0, back[k + 1] - usual))
        back[k] = edge[i] if edge[i] < back[k + 1] else edge[max(bisect_left(edge, back[k + 1]) - 1, 0)]
    large = [i for i, x in enumerate(sketch.size) if x > usual]
    out, at = [], 0
    for k in range(shards - 1):
        to = end
        if at < end:
            ahead = [sketch.size[i] for i in large if edge[i] >= at]
            share = at + (end - at - sum(ahead)) / max(1, shards - k - len(ahead))
            i = bisect_left(edge, share)
            near = min(edge[max(i - 1, 0):i + 1], key=lambda x: abs(x - share))
            to = min(max(near, back[k + 1], edge[bisect_right(edge, at)]), onward(at, usual))
        at = to
        i = bisect_left(edge, at)
        out.append(sketch.low[i] if i < len(sketch.low) else 1 << (_FULL - 1))
    return out


def by_bytes(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, crc, shard, slot`` of every row. Slots number the rows of a
    shard without gaps in the order of the input's files."""
    rows = stored(narrow(df, id_col, text_col), "shard-rows")
    found = stored(groups(rows), "shard-groups")
    most, sketch = capacity(found, shards)
    top = (1 << (_FULL - 1)) - 1
    shard = F.lit(0)
    for cut in cuts(sketch, most, shards):
        if cut <= top:
            shard = shard + (F.col("h") >= F.lit(cut)).cast("int")
    placed = rows.select("id", "size", "crc", shard.alias("shard"), F.shiftright("row", 33).alias("part"), "row")
    # a cell is what one input partition gives to one shard: never larger than
    # the partition, whatever share of all rows the shard has
    cell = ["shard", "part"]
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("row")) - 1
    return placed.withColumn("place", place).join(offset, cell).select("id", "size", "crc", "shard", (F.col("offset") + F.col("place")).cast("bigint").alias("slot"))
