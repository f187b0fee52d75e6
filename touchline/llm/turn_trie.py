"""Prefix trie of conversations, built from adaptive radix trees.

A turn's id is the first 16 bytes of a SHA-256 over its role and text, so a
conversation is a byte string of ids of one width, and a trie node a prefix of
whole ids. Conversations with equal turns are one key with its members counted
before anything else. Keys are dealt to tasks by ranges of their bytes: a first
turn that a third of all conversations share is spread over many ranges, and
each task builds the radix tree (``Tree``) of its own keys.

A node whose keys all lie in one range is finished there. Only the prefixes of
a range's first and last key can go on in its neighbours; these *edge* nodes
leave the task as partial sums, are merged by node, and their subtree sums come
from pointer doubling over the edge nodes alone (rounds: the logarithm of their
depth). Children of edge nodes get their parent's name by a join on range and
parent, so that a parent of many children is spread too.

Defined results: a null role or text is empty; rows without conversation id are
left out; turns go by number, null first, and turns of one number by the bytes
of their ids; repeated rows are repeated turns; extra columns are ignored; an
empty table has no nodes, not even a root. Memory: one conversation's turns (a
few dozen bytes each, never the texts) and one range of keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import stored

#: Bytes of a turn's id in a key.
WIDTH = 16
#: Bytes of keys of one range.
RANGE_BYTES = 4 << 20
#: Member ids that are joined to one text before the digest reads them.
CHUNK = 1024
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Node:
    """A tree node: the bytes from its parent to it, its children by next byte
    in one of four layouts, and the value of the key that ends here."""

    __slots__ = ("path", "keys", "children", "value", "lengths")

    def __init__(self, path: bytes, lengths):
        self.path, self.value, self.lengths = path, None, lengths
        self.keys: bytearray | None = bytearray()  # up to 16 children: sorted bytes; up to 48: places by byte
        self.children: list = []

    def child(self, byte: int) -> Node | None:
        n = len(self.children)
        if n <= 16:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.keys is not None:
            at = self.keys[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add or replace a child; a full layout grows into the next one."""
        n = len(self.children)
        if n <= 16:
            at = self.keys.find(byte)
            if at >= 0:
                self.children[at] = child
            elif n < 16:
                at = sum(k < byte for k in self.keys)
                self.keys.insert(at, byte)
                self.children.insert(at, child)
            else:
                places = bytearray(256)
                for at, k in enumerate(self.keys):
                    places[k] = at + 1
                self.children.append(child)
                places[byte] = n + 1
                self.keys = places
        elif self.keys is not None:
            at = self.keys[byte]
            if at:
                self.children[at - 1] = child
            elif n < 48:
                self.children.append(child)
                self.keys[byte] = n + 1
            else:
                every: list = [None] * 256
                for k, at in enumerate(self.keys):
                    if at:
                        every[k] = self.children[at - 1]
                every[byte] = child
                self.keys, self.children = None, every
        else:
            self.children[byte] = child

    def ordered(self) -> list[Node]:
        """Children by next byte."""
        if len(self.children) <= 16:
            return self.children
        if self.keys is not None:
            return [self.children[at - 1] for at in self.keys if at]
        return [c for c in self.children if c is not None]


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


class Tree:
    def __init__(self):
        self.root = Node(b"", None)

    def insert(self, key: bytes, value, lengths) -> None:
        """``lengths`` are those of the key's turns; a node keeps the lengths
        of one of the keys below it."""
        node, at = self.root, 0
        if node.lengths is None:
            node.lengths = lengths
        while at < len(key):
            below = node.child(key[at])
            if below is None:
                leaf = Node(key[at:], lengths)
                leaf.value = value
                node.put(key[at], leaf)
                return
            same = _shared(below.path, key[at:at + len(below.path)])
            if same < len(below.path):  # the key leaves inside the compressed path
                middle = Node(below.path[:same], lengths)
                below.path = below.path[same:]
                middle.put(below.path[0], below)
                node.put(key[at], middle)
                below = middle
            node, at = below, at + same
        node.value = value


def _depths(start: int, node: Node) -> range:
    """Depths, in turns, of the trie nodes on the way into a tree node."""
    if not start and not node.path:
        return range(1)  # the root
    return range(start // WIDTH + 1, (start + len(node.path)) // WIDTH + 1)


def _sums(root: Node) -> dict[int, list]:
    """Of each tree node, by its identity: smallest member, members, the trie
    nodes first met going down, childless trie nodes and saved tokens below and
    on its path."""
    sums, todo = {}, [(root, 0, False)]
    while todo:
        node, start, back = todo.pop()
        end = start + len(node.path)
        if not back:
            todo.append((node, start, True))
            todo.extend((c, end, False) for c in node.ordered())
            continue
        first, members, tops, leaves, saved = None, 0, 0, 0, 0
        if node.value is not None:
            first, members = node.value[0], node.value[1]
        for c in node.ordered():
            f, m, t, l, s = sums[id(c)][:5]
            first = f if first is None else min(first, f)
            members, tops, leaves, saved = members + m, tops + t, leaves + l, saved + s
        depths = _depths(start, node)
        below = (tops, leaves, saved)
        if len(depths):
            leaves = leaves or 1
            saved += (members - 1) * sum(node.lengths[d - 1] for d in depths if d)
            tops = 1
        sums[id(node)] = [first, members, tops, leaves, saved, below]
    return sums


NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_EMITTED = ", ".join(["range int", "edge boolean", "node binary", "parent binary", "length long", *(f"{c} long" for c in NODE_COLUMNS[:-1]), "ends_sha256 string"])
_TYPES = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), *[pa.int64()] * 7, pa.string()]
_NAMES = [x.split()[0] for x in _EMITTED.split(", ")]


def _below_edges(node: Node, end: int, left: bool, right: bool, sums: dict) -> tuple[int, int, int]:
    """What finished nodes under an edge node add up to, edge nodes and what is
    under them left out: topmost nodes, childless nodes, saved tokens."""
    tops = leaves = saved = 0
    todo = [(node, end, left, right)]
    while todo:
        node, end, left, right = todo.pop()
        children = node.ordered()
        for i, c in enumerate(children):
            on_left, on_right = left and not i and node.value is None, right and i == len(children) - 1
            if not (on_left or on_right):
                _, _, t, l, s, _ = sums[id(c)]
                tops, leaves, saved = tops + t, leaves + l, saved + s
            elif not len(_depths(end, c)):  # no node on the way yet
                todo.append((c, end + len(c.path), on_left, on_right))
    return tops, leaves, saved


def emitted(tree: Tree, number: int) -> Iterator[tuple]:
    """Rows of a range's trie nodes. ``node`` and ``parent`` name edge nodes by
    a chain of hashes over their turns; finished nodes have a ``parent`` only if
    that is an edge node, and else know its smallest member themselves."""
    sums = _sums(tree.root)
    todo = [(tree.root, 0, True, True, b"", (None, None))]
    while todo:
        node, start, left, right, around, (parent_name, parent_first) = todo.pop()
        end = start + len(node.path)
        first, members, _, leaves, saved, (tops, leaves_below, saved_below) = sums[id(node)]
        depths, edge = _depths(start, node), left or right
        whole, begin, spent = around + node.path, start - len(around), 0
        for d in depths:
            last = d == depths[-1]
            length = node.lengths[d - 1] if d else 0
            ends = node.value[2] if last and d * WIDTH == end and node.value is not None else None
            if edge:
                turn = whole[(d - 1) * WIDTH - begin:d * WIDTH - begin] if d else b"root"
                name = hashlib.blake2b((parent_name or b"") + turn, digest_size=20).digest()
                sub = _below_edges(node, end, left, right, sums) if last else (0, 0, 0)
                yield number, True, name, parent_name, length, first, d, None, members, *sub, ends
                parent_name, parent_first = name, None
            else:
                kids = tops if last else 1
                yield number, False, None, parent_name, length, first, d, parent_first, members, kids, leaves, saved - spent, ends or NO_ENDS
                parent_name, parent_first = None, first
                spent += (members - 1) * length
        tail = whole[-(end % WIDTH):] if end % WIDTH else b""
        children = node.ordered()
        for i, c in enumerate(children):
            todo.append((c, end, left and not i and node.value is None, right and i == len(children) - 1, tail, (parent_name, parent_first)))


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree, number, some = Tree(), TaskContext.get().partitionId(), False
    for batch in batches:
        lengths = batch.column("lengths")
        for i, (key, first, members, ends) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "first", "members", "ends")))):
            tree.insert(key, (first, members, ends), lengths[i].values.to_numpy())
            some = True
    if not some:
        return
    rows: list[tuple] = []
    for row in emitted(tree, number):
        rows.append(row)
        if len(rows) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)], names=_NAMES)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def turn_id(role: Column, text: Column) -> Column:
    """Role and text cannot run into each other: the role's length goes first."""
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), F.concat(role, text)), 256)), 1, WIDTH)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, ids, lengths`` of every conversation in the order of turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), turn_id(role, text).alias("id"), F.char_length(text).alias("length"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), one.alias("t"))
    each = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return each.select("conv_id", F.col("t.id").alias("ids"), F.col("t.length").alias("lengths"))


def rebuilt(convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations with their first turns, crc32(id) mod ``most`` of them,
    taken from the conversation at the start of their block of ``every`` ids."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    base = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, most - 1).alias("base_ids"), F.slice("lengths", 1, most - 1).alias("base_lengths"))
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h)

    def joined(c: str) -> Column:
        head = F.when(F.col("base_" + c).isNull(), F.slice(c, 1, 0)).otherwise(F.slice("base_" + c, F.lit(1), F.col("h")))
        return F.concat(head, F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))).alias(c)

    return own.join(base, "base", "left").select("conv_id", joined("ids"), joined("lengths"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from chunks that arrive in order; holds one state."""
    key, state, out = None, None, []
    for batch in batches:
        for name, part in zip(batch.column("name").to_pylist(), batch.column("part").to_pylist()):
            if name == key:
                state.update(b"," + part.encode())
                continue
            if key is not None:
                out.append((key, state.hexdigest()))
            key, state = name, hashlib.sha256(part.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["name", "ends"])
            out = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["name", "ends"])


def keys(convs: DataFrame) -> DataFrame:
    """``key, lengths, first, members, ends`` of each distinct sequence of
    turns: its smallest conversation, their number, and the digest of their
    ids. Ids are joined in chunks first, so no list of all members arises."""
    key = F.unhex(F.array_join(F.transform("ids", lambda x: F.hex(x)), ""))
    rows = stored(convs.select("conv_id", key.alias("key"), "lengths").withColumn("name", F.sha2("key", 256)), "trie-rows")
    distinct = rows.groupBy("name").agg(F.first("key").alias("key"), F.first("lengths").alias("lengths"), F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("members"))
    chunk = F.floor(F.col("conv_id") / F.lit(CHUNK))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    parts = rows.groupBy("name", chunk.alias("chunk")).agg(ids.alias("part"))
    ends = parts.repartition("name").sortWithinPartitions("name", "chunk").select("name", "part").mapInArrow(_digests, "name string, ends string")
    return distinct.join(ends, "name").drop("name")


def trie(convs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The trie of ``conv_id, ids, lengths``: one row a node, ``NODE_COLUMNS``."""
    spark = convs.sparkSession
    found = stored(keys(convs), "trie-keys")
    size = found.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes))
    nodes = stored(found.repartitionByRange(ranges, "key").sortWithinPartitions("key").mapInArrow(_grow, _EMITTED), "trie-nodes")
    edges = stored(_merged(nodes.where("edge")), "trie-edges")

    named = nodes.where("edge").select("range", "node").join(edges.select("node", F.col("conv_id").alias("up")), "node").withColumnRenamed("node", "parent")
    below = nodes.where("not edge and parent is not null").join(named, ["range", "parent"]).withColumn("parent_conv_id", F.col("up"))
    inner = nodes.where("not edge and parent is null")
    return inner.select(NODE_COLUMNS).unionByName(below.select(NODE_COLUMNS)).unionByName(edges.select(NODE_COLUMNS))


def _merged(parts: DataFrame) -> DataFrame:
    """Edge nodes from their partial sums, with the sums of their subtrees."""
    one = parts.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("length").alias("length"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("finished"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("ends_sha256").alias("ends"))
    one = stored(one, "trie-edge-nodes")
    kids = one.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("edge_children"))
    top = one.join(kids, "node", "left").withColumn("n_children", F.col("finished") + F.coalesce("edge_children", F.lit(0)))
    sums = top.select("node", F.col("parent").alias("jump"),
                      (F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
                      (F.col("saved") + (F.col("n_convs") - 1) * F.col("length")).alias("saved_tokens"))
    # after round r a node has the sums of its descendants nearer than 2^r, and
    # its jump is the ancestor 2^r above
    depth = one.agg(F.max("depth")).first()[0] or 0
    for _ in range(depth.bit_length()):
        sums = stored(sums, "trie-sums")
        more = sums.where("jump is not null").groupBy(F.col("jump").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        further = sums.select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        sums = (sums.join(more, "node", "left").join(further, "jump", "left")
                .select("node", F.col("next").alias("jump"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                        (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")))
    up = one.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (top.select("node", "parent", "depth", "conv_id", "n_convs", "n_children", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
            .join(sums.drop("jump"), "node").join(up, "parent", "left"))
