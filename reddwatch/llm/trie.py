"""The prefix tree of conversations, by adaptive radix trees over fixed-width turn ids.

A turn's id has WIDTH bytes: the length of its text in UTF-8, big-endian, and half a SHA-256 of its role and
text. A conversation's key is its turns' ids one after another, so keys with common first turns have common first
bytes and lie side by side when sorted. Keys are sorted over the cluster by range, with conversation ids behind
them, so that copies of one conversation, however many, are dealt over tasks too. Equal keys are reduced to one row
each; then every block of sorted keys is put into a radix tree, whose bytes at full turns are the nodes wanted.

Only nodes on the way to a block's first and last key can have members in other blocks. For these the block gives
partial sums, at most twice the depth of them, which one pass over the blocks' borders in key order adds up with a
stack as deep as the keys. All other nodes are whole within their block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import partitions, picked, written
from reddwatch.llm.radix import Node, Tree

# Bytes of a turn id, and those of the text's length in it.
WIDTH, SIZE = 20, 4
# Bytes of keys that a task sorts, and keys of a block.
TASK, BLOCK = 16 << 20, 20_000
# Ids of conversations with equal keys that travel in one row.
TOGETHER = 50_000
# Border nodes up to this number are sent to all tasks.
SENT = 200_000

NONE = hashlib.sha256(b"").hexdigest()
MEMBERS = "key binary, first long, n long, ids binary"
NODES = (
    "node binary, parent binary, block long, seq long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, n_bytes long"
)
NAMES = [c.split()[0] for c in NODES.split(", ")]
TYPES = [{"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in NODES.split(", ")]


def sequences(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """conv_id and `turns`, its turns' ids in hexadecimal in their order.

    Turns are ordered by number, null first, equal numbers by role and then by id. Null roles and texts count
    as empty. Rows without a conversation id belong to none and are left out; repeated rows are repeated turns.
    """
    rows = picked(turns, conv_id=(id_col, "long"), turn=(turn_col, "long"), role=(role_col, "string"), text=(text_col, "string"))
    rows = rows.filter("conv_id IS NOT NULL").fillna("", ["role", "text"])
    size = F.octet_length("text")
    # The role's length in front tells where it ends and the text begins.
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(" "), F.col("role"), F.col("text")), 256)
    turn_id = F.concat(F.lpad(F.hex(size), 2 * SIZE, "0"), F.upper(F.substring(digest, 1, 2 * (WIDTH - SIZE))))
    rows = rows.select("conv_id", F.struct("turn", "role", turn_id.alias("id")).alias("turn"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.col("turns.id").alias("turns"))


def regrown(conversations: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations c (as of `sequences`) whose first h turns are those of c - c % every (none if that is
    absent), with h the CRC-32 of c in decimal modulo `most`; then come c's own turns after its first h."""
    starts = conversations.select(
        F.col("conv_id").alias("start_id"), F.slice("turns", 1, most - 1).alias("start")
    ).filter(F.col("start_id") % every == 0)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = conversations.join(starts, F.col("conv_id") - F.col("conv_id") % every == F.col("start_id"), "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    start = F.coalesce(F.slice("start", 1, h), F.array().cast("array<string>"))
    return joined.select("conv_id", F.concat(start, own).alias("turns"))


@dataclass
class End:
    """The conversations that end with a key."""

    n: int
    least: int
    digest: str


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows key, conv_id in their order as rows of a key, the first id, how many, and all ids in decimal."""
    key, ids = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()),
             pa.array([",".join(map(str, ids)).encode()], pa.binary())],
            names=["key", "first", "n", "ids"],
        )

    for batch in batches:
        for next_key, conv_id in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if ids and (next_key != key or len(ids) == TOGETHER):
                yield out()
                ids = []
            key = next_key
            ids.append(conv_id)
    if ids:
        yield out()


def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, End]]:
    """Each distinct key with its conversations, from rows of `members` in the order of key and first id."""
    key, end, digest = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] == key:
                digest.update(b",")
                end.n += row["n"]
            else:
                if end is not None:
                    end.digest = digest.hexdigest()
                    yield key, end
                key, end, digest = row["key"], End(row["n"], row["first"], ""), hashlib.sha256()
            digest.update(row["ids"])
    if end is not None:
        end.digest = digest.hexdigest()
        yield key, end


@dataclass
class Sums:
    """What nodes of the prefix tree in and below a node of the radix tree come to."""

    n: int = 0
    least: int | None = None
    tops: int = 0  # nodes without another one above them here
    leaves: int = 0
    saved: int = 0
    key: bytes = b""  # one of the keys

    def take(self, other: Sums) -> None:
        self.n += other.n
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.tops += other.tops
        self.leaves += other.leaves
        self.saved += other.saved
        self.key = self.key or other.key


def text_bytes(key: bytes, depth: int) -> int:
    """Bytes of the last text of the key's first `depth` turns."""
    at = (depth - 1) * WIDTH
    return int.from_bytes(key[at : at + SIZE], "big") if depth else 0


def node_id(prefix: bytes) -> bytes:
    return hashlib.sha256(prefix).digest()[:16]


class Block:
    """The radix tree of sorted distinct keys, and the rows it gives."""

    def __init__(self, keys: list[tuple[bytes, End]], number: int):
        self.number, self.first, self.last = number, keys[0][0], keys[-1][0]
        self.tree = Tree()
        for key, end in keys:
            self.tree.put(key, (key, end))

    def sum_up(self) -> None:
        """Gives every node of the radix tree the sums of what is on its path and below."""
        order: list[tuple[Node, int]] = []
        waiting = [(self.tree.root, 0)]
        while waiting:
            node, start = waiting.pop()
            order.append((node, start))
            waiting.extend((child, start + len(node.path) + 1) for _, child in node)
        for node, start in reversed(order):
            sums = Sums()
            for _, child in node:
                sums.take(child.sums)
            if node.value:
                key, end = node.value
                sums.take(Sums(end.n, end.least, leaves=0 if node.children else 1, key=key))
            depths = self.depths(node, start, start + len(node.path))
            sums.saved += sum((sums.n - 1) * text_bytes(sums.key, d) for d in depths)
            sums.tops = 1 if depths else sums.tops
            node.sums = sums

    def depths(self, node: Node, start: int, end: int) -> range:
        """Depths in turns of the prefix tree's nodes on this node's path and the branch byte before it; only
        full turns are nodes."""
        if node is self.tree.root:
            return range(0, 1)
        return range((start - 1) // WIDTH + 1, end // WIDTH + 1)

    def rows(self) -> Iterator[tuple]:
        """Rows of whole nodes, then those of the border in their order."""
        self.sum_up()
        left, right = self.spine(self.first), self.spine(self.last)
        # node, start, conv_id of the node above, its identifier if it is a border node
        waiting: list[tuple[Node, int, int | None, bytes | None]] = [(self.tree.root, 0, None, None)]
        open_rows: dict[bytes, list] = {}
        while waiting:
            node, start, above, above_id = waiting.pop()
            end = start + len(node.path)
            sums, depths = node.sums, self.depths(node, start, end)
            on_border = id(node) in left or id(node) in right
            if not on_border:
                saved = sums.saved
                for d in depths:
                    last = d == depths[-1]
                    children = sum(c.sums.tops for _, c in node) if last else 1
                    ended = node.value[1].digest if last and node.value else NONE
                    yield (
                        None, above_id, self.number, None, sums.least, d, above, sums.n, children, sums.leaves,
                        saved, ended, None,
                    )
                    saved -= (sums.n - 1) * text_bytes(sums.key, d)
                    above, above_id = sums.least, None
            else:
                for d in depths:
                    name = node_id(sums.key[: d * WIDTH])
                    open_rows[name] = [name, above_id, d, text_bytes(sums.key, d), Sums(), None]
                    above, above_id = None, name
                if node.value:
                    end_ = node.value[1]
                    open_rows[above_id][4].take(Sums(end_.n, end_.least))
                    open_rows[above_id][5] = end_.digest
                for _, child in node:
                    if id(child) not in left and id(child) not in right:
                        open_rows[above_id][4].take(child.sums)
            waiting.extend((child, end + 1, above, above_id) for _, child in node)
        yield from self.border_rows(open_rows)

    def spine(self, key: bytes) -> set[int]:
        """The nodes on the way to a key."""
        node, at, found = self.tree.root, 0, set()
        while True:
            found.add(id(node))
            at += len(node.path)
            if at == len(key):
                return found
            node, at = node.children.find(key[at]), at + 1

    def border_rows(self, found: dict[bytes, list]) -> Iterator[tuple]:
        """The nodes on the way to the first key, then the others on the way to the last, from above."""
        order = [node_id(self.first[: d * WIDTH]) for d in range(len(self.first) // WIDTH + 1)]
        order += [
            name for d in range(len(self.last) // WIDTH + 1)
            if self.first[: d * WIDTH] != self.last[: d * WIDTH] and (name := node_id(self.last[: d * WIDTH]))
        ]
        for seq, name in enumerate(order):
            _, above, depth, size, sums, ended = found[name]
            yield (
                name, above, self.number, seq, sums.least, depth, None, sums.n, sums.tops, sums.leaves, sums.saved,
                ended, size,
            )


def grown(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Sorted members as nodes: whole ones, and partial ones of the blocks' borders (those with `seq`)."""
    number = TaskContext.get().partitionId() << 33
    keys: list[tuple[bytes, End]] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in Block(keys, number).rows():
            held.append(row)
            if len(held) == 10_000:
                yield rows_of(held)
                held = []
        if held:
            yield rows_of(held)

    for key, end in ends(batches):
        if keys and (len(keys) == block or size + len(key) > TASK):
            yield from out()
            keys, size, number = [], 0, number + 1
        keys.append((key, end))
        size += len(key)
    if keys:
        yield from out()


def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Border rows in the order of their blocks as whole nodes. The stack has the way to the last key seen."""
    stack: list[dict] = []
    done: list[tuple] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            sums: Sums = node["sums"]
            children, leaves = sums.tops, sums.leaves if sums.tops else 1
            saved = sums.saved + (sums.n - 1) * node["n_bytes"]
            done.append((
                node["node"], node["parent"], None, None, sums.least, node["depth"], None, sums.n, children, leaves,
                saved, node["ends"] or NONE, None,
            ))
            if stack:
                stack[-1]["sums"].take(Sums(sums.n, sums.least, 1, leaves, saved))

    for batch in batches:
        for row in batch.to_pylist():
            depth = row["depth"]
            sums = Sums(row["n_convs"], row["conv_id"], row["n_children"], row["n_leaves"], row["saved_tokens"])
            if len(stack) <= depth or stack[depth]["node"] != row["node"]:
                close(depth)
                stack.append({
                    "node": row["node"], "parent": row["parent"], "depth": depth, "n_bytes": row["n_bytes"],
                    "sums": Sums(), "ends": None,
                })
            node = stack[depth]
            if sums.n:
                node["sums"].take(sums)
            node["ends"] = node["ends"] or row["ends_sha256"]
        if len(done) > 10_000:
            yield rows_of(done)
            done.clear()
    close(0)
    if done:
        yield rows_of(done)


def nodes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per node of the prefix tree of conversations (as of `sequences`): conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The members of a node are the conversations that start with its turns; the root, which has none, has all
    of them, also those without turns. An empty table has no nodes. Conversations that repeat an id are members
    each. A conversation's key takes 20 bytes a turn in one row, so it may have 100 million turns.
    """
    spark = conversations.sparkSession
    keys = written(conversations.select(F.unhex(F.array_join("turns", "")).alias("key"), "conv_id"), "trie-keys")
    size = keys.agg(F.coalesce(F.sum(F.octet_length("key") + 16), F.lit(0))).first()[0]
    tasks = max(partitions(spark), -(-size // TASK))
    sorted_keys = keys.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    groups = written(sorted_keys.mapInArrow(members, MEMBERS), "trie-members")
    in_order = groups.repartitionByRange(tasks, "key").sortWithinPartitions("key", "first")
    found = written(in_order.mapInArrow(lambda batches: grown(batches, block), NODES), "trie-nodes")
    borders = found.filter("seq IS NOT NULL").repartition(1).sortWithinPartitions("block", "seq")
    upper = written(borders.mapInArrow(closed, NODES), "trie-upper")
    names = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("known"))
    if upper.count() <= SENT:
        names = F.broadcast(names)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = found.filter("seq IS NULL").union(upper)
    below = whole.filter("parent IS NOT NULL").join(names, "parent", "left").withColumn("parent_conv_id", F.col("known"))
    return whole.filter("parent IS NULL").select(columns).union(below.select(columns))
