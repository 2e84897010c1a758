"""The trie of conversations: a node for each distinct sequence of first turns.

**Sequences.** A turn is a 64-bit hash of role and text. A conversation is its turn ids in order, cut
into blocks: the first has up to ``FIRST`` turns, the following ones up to four times as many as the
block before, ``MOST`` at most. A block knows its class, a 128-bit hash of all turns before
it. Block k of all conversations makes level k of the trie. So a few long conversations do not widen the
matrix of all others, and a padded matrix holds at most about four cells for each turn.

**Levels.** The blocks of a level are range-partitioned by class, turn ids and conversation; a
shard is one task. No sequence is too common for that: equal ones are told apart by conversation.

1. A shard is a matrix of turn ids, one row for each block, padded, its rows in order by
   ``lexsort``. A cell differs from the row above or not; accumulating this by OR along the row marks
   where a new node starts at each depth. ``reduceat`` over the starts gives each node's members,
   children and bytes, from the deepest column to the first, so that a node adds up its subtree.
2. Only nodes that hold a shard's first or last row can reach into other shards. They leave the
   task as parts, with the sums over what lies whole inside the shard. Parts are joined by node;
   what a joined node counts itself is then added to the nodes above it, which it lists.
3. Levels are done from the deepest to the first. The totals of a class go to the blocks that it
   continues; the members' least conversation goes the other way.

Numbers of conversations that end at a node are hashed in ascending order: those of a shard become one
text, and the texts of a node are hashed as a stream, so no list of them is ever held.

Rows with a null conv_id belong to no conversation and are left out. Null roles and texts count as empty.
Turns are ordered by turn (null first), ties by role, then text; repeated rows are turns of
their own. Other columns are left out. An empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.frames import only
from pulsegrid.llm.words import mix
from pulsegrid.sources.settle import settle

FIRST, MOST = 64, 4096
#: Cells of a shard's matrix, on average; and blocks of a shard at most.
CELLS, SHARD_BLOCKS = 1 << 20, 20_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

BLOCKS = "level int, k1 long, k2 long, ids array<long>, sizes array<long>, conv_id long, next1 long, next2 long"
#: kind: node (whole), part (of a node that may reach into other shards), class (the top of a later level).
FOUND = (
    "kind string, depth int, b1 long, b2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, size long, below_children long, below_leaves long, below_saved long, "
    "first_end long, ends string, next1 long, next2 long, path array<struct<b1: long, b2: long>>"
)
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def width(level: int, first: int = FIRST, most: int = MOST) -> int:
    return min(first * 4**level, max(first, most))


def start(level: int, first: int = FIRST, most: int = MOST) -> int:
    """The turns before a level."""
    return sum(width(k, first, most) for k in range(level))


def chained(key: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
    """The keys (two unsigned numbers) of the sequences that go on from ``key`` by one id after another."""
    for one in ids.view(np.uint64):
        key = mix(key * _STEP + (one ^ _LANES))
        yield key


ROOT = mix(_LANES)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part (0), at (the turn's place, from 0), id and size (bytes) of every turn."""
    rows = only(conversations, ("conv_id", "turn", "role", "text"), "conversations").where("conv_id is not null")
    rows = rows.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", F.octet_length("text").cast("long").alias("size")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    at = (F.row_number().over(order) - 1).alias("at")
    return rows.select("conv_id", F.lit(0).alias("part"), at, F.xxhash64("role", "text").alias("id"), "size")


def rebuilt(given: DataFrame, family: int, borrowed: Column, most: int) -> DataFrame:
    """``turns`` of conversations that start with turns of another.

    Conversation c takes the first ``borrowed`` turns (an expression of conv_id, ``most`` at most) of
    conversation c - c % family, then its own turns after as many. Those left without turns have one row
    whose id is null.
    """
    convs = settle(given.select("conv_id").distinct())
    own = given.where(F.col("at") >= borrowed).withColumn("part", F.lit(1))
    first = given.where((F.col("conv_id") % family == 0) & (F.col("at") < most))
    relatives = F.sequence(F.when(F.col("conv_id") > 0, 0).otherwise(1 - family), F.when(F.col("conv_id") < 0, 0).otherwise(family - 1))
    first = first.withColumn("relative", F.explode(relatives)).withColumn("conv_id", F.col("conv_id") + F.col("relative")).drop("relative")
    first = first.where(F.col("at") < borrowed).join(convs, "conv_id", "left_semi")
    none = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("size"))
    return own.unionByName(first).unionByName(none)


def blocks(sequence: DataFrame, first: int = FIRST, most: int = MOST) -> DataFrame:
    """``BLOCKS`` of every conversation, from ``turns``. A task holds one block of turns at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, level, key = None, 0, ROOT
        ids: list[int] = []
        sizes: list[int] = []
        out: list[tuple] = []

        def cut(more: bool) -> None:
            nonlocal level, key
            own = key.view(np.int64).tolist()
            after = [None, None]
            if more:
                *_, key = chained(key, np.array(ids, np.int64))
                after = key.view(np.int64).tolist()
            out.append((level, *own, ids.copy(), sizes.copy(), current, *after))
            ids.clear()
            sizes.clear()
            level += 1

        for batch in batches:
            for conv, turn, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "id", "size")), strict=True):
                if conv != current:
                    if current is not None:
                        cut(False)
                    current, level, key = conv, 0, ROOT
                if turn is None:
                    continue
                if len(ids) == width(level, first, most):
                    cut(True)
                ids.append(turn)
                sizes.append(size)
            yield _table(out, BLOCKS)
            out.clear()
        if current is not None:
            cut(False)
        yield _table(out, BLOCKS)

    dealt = sequence.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return dealt.select("conv_id", "id", "size").mapInArrow(run, BLOCKS)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds, names = [], []
    for field in schema.split(", ", schema.split("array<struct")[0].count(", ") if "array<struct" in schema else -1):
        name, kind = field.split(" ", 1)
        pairs = pa.list_(pa.struct([("b1", pa.int64()), ("b2", pa.int64())]))
        kinds.append(_ARROW.get(kind) or (pairs if "struct" in kind else pa.list_(pa.int64())))
        names.append(name)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _padded(column: pa.Array, columns: int, pad: int, dense: bool) -> np.ndarray:
    """A list column as rows; dense: the values' ranks instead of the values."""
    values, lengths = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    if dense:
        values = np.unique(values, return_inverse=True)[1]
    out = np.full((len(column), columns), pad, np.int64)
    out[np.arange(columns) < lengths[:, None]] = values
    return out


class Shard:
    """The nodes of some blocks that follow each other in the order of their level."""

    def __init__(self, table: pa.Table, before: int, full: int, top: bool):
        """before: the turns before the level; full: the level's width; top: whether it is the first one."""
        table = table.combine_chunks()
        one = {c: table.column(c).chunk(0) for c in table.column_names}
        lengths = np.diff(one["ids"].offsets.to_numpy())
        columns = int(lengths.max())
        ranks = _padded(one["ids"], columns, -1, dense=True)
        keys = np.stack([one["k1"].to_numpy(), one["k2"].to_numpy()], 1)
        conv = one["conv_id"].to_numpy()
        goes_on = one["next1"].is_valid().to_numpy(zero_copy_only=False)  # after those that end at the same node
        order = np.lexsort((conv, goes_on, *ranks.T[::-1], keys[:, 1], keys[:, 0]))
        self.before, self.full, self.top, self.columns = before, full, top, columns
        self.ranks, self.keys, self.conv, self.lengths = ranks[order], keys[order], conv[order], lengths[order]
        self.sizes = _padded(one["sizes"], columns, 0, dense=False)[order]
        whole = lambda c: np.nan_to_num(one[c].to_numpy(zero_copy_only=False), nan=0).astype(np.int64)[order]
        self.below = {c: whole(c) for c in ("below_children", "below_leaves", "below_saved")}
        self.next = [one[c].take(pa.array(order)) for c in ("next1", "next2")]
        ids = one["ids"].take(pa.array(order[[0, -1]]))
        self.edge_ids = [np.array(ids[k].as_py(), np.int64) for k in (0, 1)]
        same = (self.keys[1:] == self.keys[:-1]).all(1)
        fresh = np.concatenate([[True], ~same])
        changed = np.concatenate([np.ones((1, columns), bool), self.ranks[1:] != self.ranks[:-1]])
        #: starts[r, d]: a new node of depth d (within the level) starts at row r; or the padding after a node.
        self.starts = np.logical_or.accumulate(np.concatenate([fresh[:, None], changed], 1), axis=1)

    def _edge_keys(self, k: int) -> list[np.ndarray]:
        key = self.keys[(0, -1)[k]].astype(np.int64).view(np.uint64)
        return [key, *chained(key, self.edge_ids[k])]

    def rows(self) -> Iterator[tuple]:
        """``FOUND`` of all nodes, the deepest first."""
        n = len(self.conv)
        edge_keys = [[tuple(k.view(np.int64).tolist()) for k in self._edge_keys(e)] for e in (0, 1)]
        leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)  # at their first rows: what nodes below count
        child_starts = np.zeros(n, np.int64)  # nodes of the next depth that lie whole in the shard
        firsts: list[np.ndarray] = []
        for d in range(self.columns, -1, -1):
            at = np.flatnonzero(self.starts[:, d])
            real = self.ranks[at, d - 1] >= 0 if d else np.ones(len(at), bool)
            add = lambda x: np.add.reduceat(x, at)[real]  # noqa: B023, E731
            most = lambda x: np.maximum.reduceat(x, at)[real]  # noqa: B023, E731
            ends = np.append(at[1:], n)[real]
            members = (ends - at[real]).astype(np.int64)
            least = np.minimum.reduceat(self.conv, at)[real]
            ending = add((self.lengths == d).astype(np.int64)) - add(self._continuing(d))
            children, down_leaves, down_saved = add(child_starts), add(leaves), add(saved)
            below = {c: most(x) if d == self.full else np.zeros(len(members), np.int64) for c, x in self.below.items()}
            at = at[real]
            edge = (at == 0) | (ends == n)
            size = self.sizes[at, d - 1] if d else np.zeros(len(at), np.int64)
            total = children + below["below_children"]
            own_leaves = (total == 0).astype(np.int64) + below["below_leaves"]
            own_saved = (members - 1) * size + below["below_saved"]
            parent, parent_edge = self._parents(d, at)
            whole = np.flatnonzero(~edge)
            for j in range(len(at)):
                a, b, is_edge = int(at[j]), int(ends[j]), bool(edge[j])
                ids = self.conv[a : a + int(ending[j])].tolist()
                after = [x[b - 1].as_py() for x in self.next] if d == self.full else (None, None)
                text = ",".join(map(str, ids))
                if is_edge:
                    mine = edge_keys[0] if a == 0 else edge_keys[1]
                    path = [{"b1": k[0], "b2": k[1]} for k in mine[:d]]
                    up = mine[d - 1] if d else (None, None)
                    yield (
                        "part", self.before + d, *mine[d], *up, int(least[j]), None, int(members[j]), int(children[j]), int(down_leaves[j]),
                        int(down_saved[j]), int(size[j]), *(int(below[c][j]) for c in ("below_children", "below_leaves", "below_saved")),
                        ids[0] if ids else None, text if ids else None, *after, path,
                    )
                elif d or self.top:
                    sha = hashlib.sha256(text.encode()).hexdigest()
                    up = self._parent_key(d, a, parent_edge[j], edge_keys)
                    yield (
                        "node", self.before + d, None, None, *up, int(least[j]), None if up[0] is not None else int(parent[j]), int(members[j]),
                        int(total[j]), int(down_leaves[j] + own_leaves[j]), int(down_saved[j] + own_saved[j]), 0, 0, 0, 0, None, sha, *after, None,
                    )
                else:
                    yield (
                        "class", self.before, *self.keys[a].tolist(), None, None, None, None, 0, int(total[j]), int(down_leaves[j]),
                        int(down_saved[j]), 0, 0, 0, 0, None, None, None, None, None,
                    )
            np.add.at(leaves, at[whole], own_leaves[whole])
            np.add.at(saved, at[whole], own_saved[whole])
            child_starts = np.zeros(n, np.int64)
            child_starts[at[whole]] = 1

    def _continuing(self, d: int) -> np.ndarray:
        """Rows whose block ends at depth d, but not their conversation."""
        if d != self.full:
            return np.zeros(len(self.conv), np.int64)
        return ((self.lengths == d) & self.next[0].is_valid().to_numpy(zero_copy_only=False)).astype(np.int64)

    def _parents(self, d: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the nodes at depth d their parents' least conversation, and whether the parent is at an edge."""
        if not d:
            return np.zeros(len(at), np.int64), np.ones(len(at), bool)
        above = np.flatnonzero(self.starts[:, d - 1])
        ends = np.append(above[1:], len(self.conv))
        which = np.searchsorted(above, at, side="right") - 1
        return np.minimum.reduceat(self.conv, above)[which], ((above == 0) | (ends == len(self.conv)))[which]

    def _parent_key(self, d: int, a: int, parent_edge: bool, edge_keys: list) -> tuple:
        """The key that the parent is looked up by: for the tops of later levels, and for parents at an edge."""
        if d == 1:
            return tuple(self.keys[a].tolist())
        if not parent_edge:
            return None, None
        first = bool((self.ranks[a, : d - 1] == self.ranks[0, : d - 1]).all() and (self.keys[a] == self.keys[0]).all())
        return edge_keys[0 if first else 1][d - 1]


def nodes_of_level(rows: DataFrame, level: int, first: int = FIRST, most: int = MOST) -> DataFrame:
    """``FOUND`` of the level's blocks, which have the totals below_children, below_leaves and below_saved."""
    wide, before = width(level, first, most), start(level, first, most)
    n = rows.count()
    shards = max(1, -(-n // max(1, min(SHARD_BLOCKS, CELLS // wide))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        out: list[tuple] = []
        for row in Shard(pa.Table.from_batches(parts), before, wide, not level).rows():
            out.append(row)
            if len(out) == 4096:
                yield _table(out, FOUND)
                out = []
        yield _table(out, FOUND)

    return rows.repartitionByRange(shards, "k1", "k2", "ids", "conv_id").mapInArrow(run, FOUND)


def _hashed_ends(parts: DataFrame) -> DataFrame:
    """b1, b2 and ends_sha256 of the nodes that conversations end at, from texts in ascending order."""
    schema = "b1 long, b2 long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for b1, b2, ends in zip(*(batch.column(c).to_pylist() for c in ("b1", "b2", "ends")), strict=True):
                if (b1, b2) != current:
                    if current is not None:
                        out.append((*current, state.hexdigest()))
                    current, state = (b1, b2), hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield _table(out, schema)
        yield _table([(*current, state.hexdigest())] if current is not None else [], schema)

    texts = parts.where("ends is not null").select("b1", "b2", "first_end", "ends")
    return texts.repartition("b1", "b2").sortWithinPartitions("b1", "b2", "first_end").select("b1", "b2", "ends").mapInArrow(run, schema)


def joined_parts(parts: DataFrame) -> DataFrame:
    """A row for each node that is given in parts, with the columns of whole nodes, its key and its parent's key."""
    key = ("b1", "b2")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    tops = [F.max(c).alias(c) for c in ("depth", "size", "below_children", "below_leaves", "below_saved", "p1", "p2", "next1", "next2")]
    nodes = parts.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), *sums, *tops)
    nodes = settle(nodes)
    children = nodes.where("p1 is not null").groupBy(F.col("p1").alias("b1"), F.col("p2").alias("b2")).agg(F.count("*").alias("more"))
    nodes = nodes.join(children, list(key), "left").fillna(0, ["more"])
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.col("more") + F.col("below_children"))
    nodes = nodes.withColumns(
        {
            "own_leaves": (F.col("n_children") == 0).cast("long") + F.col("below_leaves"),
            "own_saved": (F.col("n_convs") - 1) * F.col("size") + F.col("below_saved"),
        }
    )
    nodes = settle(nodes.join(_hashed_ends(parts), list(key), "left"))
    up = nodes.select(F.explode("path").alias("up"), "own_leaves", "own_saved")
    up = up.groupBy(F.col("up.b1").alias("b1"), F.col("up.b2").alias("b2")).agg(F.sum("own_leaves").alias("more_l"), F.sum("own_saved").alias("more_s"))
    nodes = nodes.join(up, list(key), "left").fillna(0, ["more_l", "more_s"])
    return nodes.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.col("own_leaves") + F.col("more_l"),
            "saved": F.col("saved") + F.col("own_saved") + F.col("more_s"),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)),
        }
    )


def trie(sequence: DataFrame, first: int = FIRST, most: int = MOST) -> DataFrame:
    """``NODES`` of the conversations given as ``turns``."""
    spark = sequence.sparkSession
    given = settle(blocks(sequence, first, most))
    deepest = given.agg(F.max("level")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    totals, levels = None, {}
    below = ("below_children", "below_leaves", "below_saved")
    for level in range(deepest, -1, -1):
        rows = given.where(F.col("level") == level).drop("level")
        if totals is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in below})
        else:
            on = totals.select(F.col("b1").alias("next1"), F.col("b2").alias("next2"), *[F.col(c).alias(b) for c, b in zip(("n_children", "n_leaves", "saved"), below, strict=True)])
            rows = rows.join(on, ["next1", "next2"], "left")
        found = settle(nodes_of_level(rows, level, first, most))
        parts = settle(joined_parts(found.where("kind = 'part'")))
        levels[level] = (found.where("kind = 'node'").withColumn("ends_sha256", F.col("ends")), parts)
        if level:
            top, names = start(level, first, most), ("b1", "b2", "n_children", "n_leaves", "saved")
            own = parts.where(F.col("depth") == top)
            totals = settle(found.where("kind = 'class'").select(*names).unionByName(own.select(*names)))
    return _assembled(levels, first, most)


def _assembled(levels: dict[int, tuple[DataFrame, DataFrame]], first: int, most: int) -> DataFrame:
    """The nodes of all levels with their parents' least conversation."""
    common = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256", "p1", "p2", "next1", "next2")
    root = levels[0][1].where("depth = 0").first()
    out, links = None, None
    for level in sorted(levels):
        whole, parts = levels[level]
        top = start(level, first, most)
        keyed = parts.withColumn("parent_conv_id", F.lit(None).cast("long"))
        nodes = whole.select(*common).unionByName(keyed.where(F.col("depth") > top if level else F.lit(True)).select(*common))
        above = parts.select(F.col("b1").alias("p1"), F.col("b2").alias("p2"), F.col("conv_id").alias("up"), (F.col("depth") + 1).alias("depth"))
        if level:  # parents of the first column are nodes of the level above
            above = above.where(F.col("depth") > top + 1).unionByName(
                links.select(F.col("next1").alias("p1"), F.col("next2").alias("p2"), F.col("conv_id").alias("up"), F.lit(top + 1).alias("depth"))
            )
            near, rest = None, nodes
        else:  # all share one parent
            near, rest = nodes.where("depth <= 1"), nodes.where("depth > 1")
            near = near.withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id)).cast("long"))
        known = rest.where("p1 is null")
        looked_up = rest.where("p1 is not null").join(above, ["p1", "p2", "depth"], "left").withColumn("parent_conv_id", F.col("up"))
        done = known.select(*common).unionByName(looked_up.select(*common))
        done = done if near is None else done.unionByName(near.select(*common))
        links = nodes.where("next1 is not null").select("next1", "next2", "conv_id")
        out = done if out is None else out.unionByName(done)
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
    )
