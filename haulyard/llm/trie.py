"""The prefix trie of conversations, with members, leaves and the bytes that shared prefixes save.

A conversation is its turns in order; each turn becomes one number: 16 bytes of a SHA-256 over role and text, then
the text's bytes as 8 more. Conversations are dealt over range shards by that key, so a shard holds a run of the
trie's leaves. In each shard the numbers are replaced by their place in the shard's own sorted dictionary, and the
distinct conversations are put into a ternary search tree, the median first, then the medians of both halves, which
keeps the tree balanced. Nodes are made before their children, so one walk back over them adds up members, leaves and savings.

Only prefixes of a shard's first or last conversation can go on in another shard. Those boundary nodes are merged by a
chained hash of their prefix; subtree sums over them are taken by doubling the distance to the ancestor, so the
number of rounds is the logarithm of the depth. All other nodes are final where they were made.

Equal conversations lie in one shard, as their member list has one hash; they are hashed as a stream in the order
of their ids and never held together.

Defined cases: a null role or text is empty. Turns of equal number follow the order of their numbers (so repeated rows
stand side by side); a null turn comes first. Rows without a conversation id belong to none. Without conversations there are no nodes.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulyard.llm.frames import COLLECTED_ROWS, col
from haulyard.session import materialise

TURN = 24  # bytes of a turn in the key: 16 of its hash, 8 of its text's size
SHARD_BYTES = 16 << 20  # keys per range shard
NOTHING = hashlib.sha256(b"").hexdigest()
NODES = (
    "id binary, up binary, boundary boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, bytes long, ends_sha256 string, turn binary"
)


def turn_code(role: Column, text: Column) -> Column:
    """A turn's number as hexadecimal digits."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    return F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def sequences(rows: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns' numbers of every conversation, in order."""
    coded = rows.where(col(key).isNotNull()).select(col(key).cast("long").alias("conv_id"), F.struct(col(order).alias("at"), turn_code(col(role), col(text)).alias("code")).alias("turn"))
    gathered = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return gathered.select("conv_id", F.col("turns.code").alias("turns"))


def rebuilt(own: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family of ``family`` ids.

    How many, 0 to ``most``, follows from the crc32 of its id. A conversation that is not there gives none.
    """
    n = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1)).cast("int")
    mine = own.select("conv_id", "turns", n.alias("n"), (F.col("conv_id") - F.pmod("conv_id", F.lit(family))).alias("head"))
    heads = own.where(F.pmod("conv_id", F.lit(family)) == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, most).alias("first"))
    first = F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), F.col("n"))
    rest = F.slice("turns", F.col("n") + 1, F.greatest(F.size("turns") - F.col("n"), F.lit(0)))
    return mine.join(heads, "head", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def members(batches) -> Iterator[tuple[bytes, int, int, str]]:
    """(key, members, least id, hash of the ids) per run of equal keys in rows sorted by key and id."""
    now, n, least, digest = None, 0, 0, None
    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != now or now is None:
                if now is not None:
                    yield now, n, least, digest.hexdigest()
                now, n, least, digest = key, 1, conv, hashlib.sha256(str(conv).encode())
            else:
                n += 1
                digest.update(b",%d" % conv)
    if now is not None:
        yield now, n, least, digest.hexdigest()


class TernaryTree:
    """A trie of number sequences; the children of a node form a binary tree (``low``, ``high``), reached by ``equal``.

    Node 0 is the textless root. ``up`` is the node of the prefix one shorter.
    """

    def __init__(self) -> None:
        self.code, self.low, self.equal, self.high, self.up = [-1], [0], [0], [0], [0]

    def child(self, node: int, code: int) -> int:
        """The child of ``node`` with this number, made if it is not there."""
        at, place, links = self.equal[node], node, self.equal
        while at:
            if code == self.code[at]:
                return at
            links = self.low if code < self.code[at] else self.high
            at, place = links[at], at
        new = len(self.code)
        links[place] = new
        for values, value in ((self.code, code), (self.low, 0), (self.equal, 0), (self.high, 0), (self.up, node)):
            values.append(value)
        return new

    def insert(self, codes: list[int]) -> int:
        node = 0
        for code in codes:
            node = self.child(node, code)
        return node

    def path(self, node: int) -> list[int]:
        """The nodes from below the root down to ``node``."""
        out = []
        while node:
            out.append(node)
            node = self.up[node]
        return out[::-1]


def median_order(n: int) -> Iterator[int]:
    """0 … n-1, the middle first, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            ranges += [(m + 1, b), (a, m)]


def shard_nodes(batches) -> Iterator[tuple]:
    """The nodes of one range shard's trie, in the order of ``NODES``."""
    runs = list(members(batches))
    if not runs:
        return
    parts = [[key[i : i + TURN] for i in range(0, len(key), TURN)] for key, *_ in runs]
    names = sorted({turn for turns in parts for turn in turns})
    number = {turn: i for i, turn in enumerate(names)}
    tree = TernaryTree()
    end = [0] * len(runs)
    for i in median_order(len(runs)):
        end[i] = tree.insert([number[turn] for turn in parts[i]])
    size = len(tree.code)
    count, least, ends = [0] * size, [None] * size, [None] * size
    for node, (_, n, first, digest) in zip(end, runs):
        count[node], least[node], ends[node] = n, first, digest
    boundary = {0: b""}  # node: hash of its prefix
    for leaf in (end[0], end[-1]):
        for node in tree.path(leaf):
            boundary[node] = hashlib.sha256(boundary[tree.up[node]] + names[tree.code[node]]).digest()
    depth = [0] * size
    for node in range(1, size):
        depth[node] = depth[tree.up[node]] + 1
    children, leaves, saved, weight = [0] * size, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, 0, -1):  # children come after their parents
        up = tree.up[node]
        weight[node] = int.from_bytes(names[tree.code[node]][16:], "big")
        count[up] += count[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
        if node not in boundary:  # a boundary node's own part is added when its shards are merged
            leaves[node] += not children[node]
            saved[node] += (count[node] - 1) * weight[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in range(size):
        up = tree.up[node]
        inner = node not in boundary
        above = boundary.get(up) if node else None
        parent = least[up] if inner and up not in boundary else None
        turn = names[tree.code[node]] if node else None
        yield (boundary.get(node), above, not inner, least[node], depth[node], parent, count[node], children[node], leaves[node], saved[node], weight[node], ends[node], turn)


def shards(turns: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The nodes of every range shard of (conv_id, turns), stored."""
    keys = materialise(turns.select(F.unhex(F.array_join("turns", "")).alias("key"), "conv_id"))
    total = keys.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    n = int(total // shard_bytes) + 1
    dealt = keys.repartitionByRange(n, "key").sortWithinPartitions("key", "conv_id")
    kinds = {"binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
    fields = [(part.split()[0], kinds[part.split()[1]]) for part in NODES.split(", ")]

    def grow(batches):
        held = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, (_, k) in zip(zip(*held), fields)], [n for n, _ in fields])

        for node in shard_nodes(batches):
            held.append(node)
            if len(held) == 10_000:
                yield batch()
                held.clear()
        if held:
            yield batch()

    return materialise(dealt.mapInArrow(grow, NODES))


def merged(nodes: DataFrame) -> DataFrame:
    """The boundary nodes of all shards, merged, with final numbers."""
    edge = nodes.where("boundary").groupBy("id").agg(
        F.min("up").alias("up"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("bytes").alias("bytes"), F.max("ends_sha256").alias("ends_sha256"), F.min("turn").alias("turn"),
    )
    edge = materialise(edge)
    below = edge.groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("more"))
    edge = edge.join(below, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    edge = edge.withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes"),
    })
    edge = materialise(edge)
    sums = edge.select("id", F.col("up").alias("far"), "n_leaves", "saved_tokens")
    deepest, reach = edge.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:
        # so far each node has its descendants nearer than ``reach``, and ``far`` is the ancestor at that distance
        more = sums.where(F.col("far").isNotNull()).groupBy(F.col("far").alias("id")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        hop = sums.select(F.col("id").alias("far"), F.col("far").alias("farther"))
        sums = sums.join(more, "id", "left").join(hop, "far", "left").select(
            "id", F.col("farther").alias("far"), (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens")
        )
        sums, reach = materialise(sums), 2 * reach
    return materialise(edge.drop("n_leaves", "saved_tokens").join(sums.drop("far"), "id"))


def trie(turns: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The trie of (conv_id, turns): one row per node.

    (conv_id, the smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves; saved_tokens; ends_sha256; turn, the number of the last turn)
    """
    nodes = shards(turns, shard_bytes)
    edge = merged(nodes)
    inner = nodes.where("NOT boundary").select(*edge.columns, "parent_conv_id")
    every = inner.unionByName(edge.withColumn("parent_conv_id", F.lit(None).cast("long")))
    parents = edge.select(F.col("id").alias("up"), F.col("conv_id").alias("_parent"))
    # many nodes hang on one boundary node: broadcast them while they are few, else the skewed side is split
    parents = F.broadcast(parents) if edge.count() <= COLLECTED_ROWS else parents
    out = every.join(parents, "up", "left")
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"), "turn",
    )


def dictionary(rows: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(turn, role, text): what a node's ``turn`` stands for."""
    named = rows.select(F.unhex(turn_code(col(role), col(text))).alias("turn"), F.coalesce(col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text"))
    return named.groupBy("turn").agg(F.min("role").alias("role"), F.min("text").alias("text"))
