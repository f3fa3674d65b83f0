"""The trie of all conversations' beginnings, as ternary search trees over range shards.

Turns are dictionary-encoded: every distinct turn has a number, so a conversation is an array
of numbers and no text is moved or compared again. The arrays are sorted by range
partitioning, equal ones by id, so that a group of copies is split like anything else. Every
partition is a row of shards, stretches of at most ``SHARD`` numbers. A shard's sequences enter
a ternary search tree, the median first, then the medians of either half, which keeps it
balanced. One walk over its nodes, without recursion, accumulates members, children, leaves
and savings.

A beginning that conversations of two shards share lies on the path of the last sequence of
the one and of the first of the other. These boundary nodes, two paths per shard, carry a
digest of their beginning; they are merged by it, and their sums are passed up in rounds
that double their reach, in the logarithm of the depth. All other nodes are final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import written

#: Conversations ``c`` to ``c + FAMILY - 1`` share beginnings; of how many turns the checksum says.
FAMILY, TURNS = 5, 9
#: Numbers of a shard's sequences, apart from its last sequence.
SHARD = 1 << 17
NONE = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------- sequences

def encoded_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, id, n_bytes``: every distinct (role, text) has one ``id``.

    Equal turns are combined before they are shuffled; the dictionary is met by a digest.
    """
    said = turns.select(
        F.col("conv_id").cast("long"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    mark = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    marked = said.withColumn("mark", mark)
    numbers = written(
        marked.groupBy("mark").agg(F.first(F.octet_length("text")).cast("long").alias("n_bytes"))
        .withColumn("id", F.monotonically_increasing_id()), "trie-turns",
    )
    return marked.join(numbers, "mark").drop("mark")


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, sizes``: the turns of each conversation in order, a null turn first.

    Turns of the same number are ordered by role and text.
    """
    one = F.struct("turn", "role", F.sha2("text", 256).alias("text"), "id", "n_bytes")
    own = encoded_turns(turns).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("own"))
    return own.select("conv_id", F.col("own.id").alias("ids"), F.col("own.n_bytes").alias("sizes"))


def shared(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % TURNS).cast("int")


def rebuilt(own: DataFrame) -> DataFrame:
    """``conv_id, ids, sizes`` with the beginnings taken from the first conversation of each family."""
    own = written(own, "trie-own")
    first = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("ids", 1, TURNS).alias("first_ids"),
        F.slice("sizes", 1, TURNS).alias("first_sizes"),
    )
    n = shared(F.col("conv_id"))

    def spliced(head: str, tail: str) -> Column:
        none = F.array().cast("array<long>")
        start = F.coalesce(F.slice(F.col(head), F.lit(1), F.col("n")), none)
        rest = F.slice(F.col(tail), F.col("n") + 1, F.greatest(F.size(tail), F.lit(1)))
        return F.concat(start, rest)

    met = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("n", n)
    return met.join(first, "first", "left").select(
        "conv_id", spliced("first_ids", "ids").alias("ids"), spliced("first_sizes", "sizes").alias("sizes")
    )


# ------------------------------------------------------------------------ shards

class TernaryTree:
    """A ternary search tree over sequences of numbers; a node is a beginning, node 0 the empty one.

    A node holds its last number, the nodes of smaller and of larger numbers in the same
    place (``low``, ``high``), and the first of the next place (``below``).
    """

    def __init__(self) -> None:
        self.number, self.parent, self.depth = [0], [-1], [0]
        self.low, self.high, self.below = [-1], [-1], [-1]
        self.size, self.ends = [0], [[]]

    def _node(self, number: int, size: int, parent: int) -> int:
        self.number.append(number)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.size.append(size)
        self.ends.append([])
        for branch in (self.low, self.high, self.below):
            branch.append(-1)
        return len(self.number) - 1

    def insert(self, ids: list[int], sizes: list[int], members: list[int]) -> None:
        at = 0
        for number, size in zip(ids, sizes):
            parent, branch, place = at, self.below, at
            while (at := branch[place]) >= 0 and self.number[at] != number:
                branch, place = (self.low if number < self.number[at] else self.high), at
            if at < 0:
                at = branch[place] = self._node(number, size, parent)
        self.ends[at] = members

    def insert_all(self, sequences: list[tuple[list[int], list[int], list[int]]]) -> None:
        """Distinct sequences in ascending order: the median, then those of the halves."""
        parts = [(0, len(sequences))]
        while parts:
            start, stop = parts.pop()
            if start < stop:
                middle = (start + stop) // 2
                self.insert(*sequences[middle])
                parts += [(middle + 1, stop), (start, middle)]

    def walk(self) -> list[int]:
        """All nodes, every one after its parent, by a stack of its own."""
        found, waiting = [], [0]
        while waiting:
            at = waiting.pop()
            found.append(at)
            waiting += [n for n in (self.high[at], self.below[at], self.low[at]) if n >= 0]
        return found

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of all beginnings of an inserted sequence."""
        at, nodes = 0, [0]
        for number in ids:
            at = self.below[at]
            while self.number[at] != number:
                at = self.low[at] if number < self.number[at] else self.high[at]
            nodes.append(at)
        return nodes


_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, key binary, parent_key binary, n_bytes long, ends string, "
    "first_end long"
)
_NAMES = [c.split()[0] for c in _NODES.split(", ")]
_KINDS = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64()]


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def shard_nodes(sequences: list[tuple[list[int], list[int], list[int]]]) -> list[tuple]:
    """Rows of ``_NODES`` of one shard, from its distinct sequences, ascending, with their members.

    A boundary node has a ``key``, and counts what hangs on it without other boundary nodes.
    A node below a boundary node has its ``parent_key`` and no ``parent_conv_id``.
    """
    tree = TernaryTree()
    tree.insert_all(sequences)
    keys: dict[int, bytes] = {}
    for ids in (sequences[0][0], sequences[-1][0]):
        key = b""
        for at in tree.path(ids):
            key = xxhash.xxh3_128_digest(key + tree.number[at].to_bytes(8, "little"))
            keys[at] = key
    order, n = tree.walk(), len(tree.number)
    convs = [len(ends) for ends in tree.ends]
    least = [min(ends, default=None) for ends in tree.ends]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for at in reversed(order):
        if at not in keys:
            leaves[at] += children[at] == 0
            saved[at] += (convs[at] - 1) * tree.size[at]
        up = tree.parent[at]
        if up < 0:
            continue
        convs[up] += convs[at]
        least[up] = least[at] if least[up] is None else min(least[up], least[at])
        if at not in keys:
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    rows = []
    for at in order:
        up, ends = tree.parent[at], tree.ends[at]
        own, above = keys.get(at), keys.get(up)
        if own is None:
            digest = hashlib.sha256(_joined(ends).encode()).hexdigest() if ends else NONE
            said, first = None, None
        else:
            digest, said, first = None, _joined(ends) if ends else None, ends[0] if ends else None
        rows.append((
            least[at], tree.depth[at], None if above else least[up] if up >= 0 else None, convs[at],
            children[at], leaves[at], saved[at], digest, own, above, tree.size[at], said, first,
        ))
    return rows


def _shards(shard: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nodes of a partition's sequences (``conv_id, ids, sizes``), which come in order."""
        held: list[tuple[list[int], list[int], list[int]]] = []
        size = 0
        for batch in batches:
            convs, ids, sizes = (batch.column(c) for c in ("conv_id", "ids", "sizes"))
            for conv, row, n_bytes in zip(convs.to_pylist(), ids, sizes):
                row = row.as_py()
                if size >= shard:
                    yield from _batches(shard_nodes(held))
                    held, size = [], 0
                if held and held[-1][0] == row:
                    held[-1][2].append(conv)
                    size += 1
                else:
                    held.append((row, n_bytes.as_py(), [conv]))
                    size += len(row) + 1
        if held:
            yield from _batches(shard_nodes(held))
    return nodes


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for base in range(0, len(rows), 10_000):
        columns = zip(*rows[base:base + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES
        )


# ---------------------------------------------------------------- boundary nodes

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends_sha256`` from pieces of lists of ids in the order of key and first id.

    One digest is one stream, so the pieces of a node pass through one task, one at a time.
    """
    key, digest = None, None
    for batch in batches:
        keys, found = [], []
        for own, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if own == key:
                digest.update(b"," + piece.encode())
                continue
            if key is not None:
                keys.append(key)
                found.append(digest.hexdigest())
            key, digest = own, hashlib.sha256(piece.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"]
        )
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"]
        )


def _summed_up(own: DataFrame) -> DataFrame:
    """``key, n_leaves, saved_tokens`` of whole subtrees, from ``key, above`` and each node's own.

    After round ``k`` a node has the sums of all less than ``2**k`` below it, and ``above`` is
    the node so many above.
    """
    sums = written(own.select("key", "above", "n_leaves", "saved_tokens"), "trie-sums")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        more = sums.where("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        further = sums.select(F.col("key").alias("above"), F.col("above").alias("further"))
        sums = written(
            sums.join(more, "key", "left").join(further, "above", "left").select(
                "key", F.col("further").alias("above"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ), "trie-sums",
        )
    return sums.drop("above")


def _merged(parts: DataFrame) -> DataFrame:
    """The boundary nodes of all shards as final nodes, with ``key`` and ``above``."""
    nodes = written(
        parts.groupBy("key").agg(
            F.first("parent_key").alias("above"), F.first("depth").alias("depth"),
            F.first("n_bytes").alias("n_bytes"), F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ), "trie-boundary",
    )
    below = nodes.where("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(
        F.count("*").alias("more")
    )
    nodes = written(
        nodes.join(below, "key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
        .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_bytes")),
        "trie-boundary",
    )
    ends = (
        parts.where("ends IS NOT NULL").select("key", "first_end", "ends").repartition("key")
        .sortWithinPartitions("key", "first_end").mapInArrow(_digests, "key binary, ends_sha256 string")
    )
    return (
        nodes.drop("n_leaves", "saved_tokens").join(_summed_up(nodes), "key").join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE)))
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per distinct beginning of the sequences ``conv_id, ids, sizes`` (``COLUMNS``).

    ``sizes`` are the bytes of each turn's text. Ids are distinct. One conversation's numbers
    are held at once, and ``shard`` of them beside it; its texts are not.
    """
    parts = written(
        conversations.select("conv_id", "ids", "sizes").repartitionByRange("ids", "conv_id")
        .sortWithinPartitions("ids", "conv_id").mapInArrow(_shards(shard), _NODES), "trie-nodes",
    )
    nodes = written(_merged(parts.where("key IS NOT NULL")), "trie-merged")
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_conv_id"))
    boundary = nodes.withColumnRenamed("above", "parent_key").join(above, "parent_key", "left").select(
        *[F.col("above_conv_id").alias(c) if c == "parent_conv_id" else c for c in COLUMNS]
    )
    inner = parts.where("key IS NULL").join(above, "parent_key", "left").select(
        *[F.coalesce("above_conv_id", c).alias(c) if c == "parent_conv_id" else c for c in COLUMNS]
    )
    return boundary.union(inner)


def trie_report(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: one row per distinct sequence of first turns.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Null roles and
    texts are empty; turns are ordered by number (null first), then role and text's checksum. Rows
    without ``conv_id`` belong to no conversation and are left out. An empty table gives no
    rows, not even a root, as nobody is its member; other columns are not read.
    """
    return prefix_trie(rebuilt(sequences(turns)))
