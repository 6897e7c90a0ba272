"""Links between 64-bit fingerprints within a Hamming radius, by BK-trees over block shards.

Fingerprints are cut into `blocks` blocks; two that differ in at most `blocks - equal` bits
agree in at least `equal` of them, so every choice of `equal` blocks is a key and each link
meets under some key. The fingerprints of a key form a shard with a BK-tree: children are
keyed by their integer distance to the parent, and a search follows only the edges within
the radius. A broadcast of all trees would have no size bound (they hold every
fingerprint), so each tree is built in the task that owns its shard, and the queries are sent
there. A key with more than `shard` members is split into several trees, and its members
query each of them, so no task holds more than a shard.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.llm.components import forest
from panelflow.session import materialised


class ShardLinks:
    """Hits inside one shard, reduced to one link from each fingerprint to its local root."""

    def __init__(self, fps: np.ndarray, members: int, radius: int, leaf: int = 0) -> None:
        self.fps, self.members, self.radius, self.leaf = fps, members, radius, leaf
        self.root = np.arange(len(fps))

    def _roots(self, at: np.ndarray) -> np.ndarray:
        r = self.root[at]
        while True:
            up = self.root[r]
            if np.array_equal(up, r):
                return r
            r = up

    def _compare(self, nodes: np.ndarray, queries: np.ndarray) -> None:
        q, n = np.nonzero(np.bitwise_count(self.fps[queries][:, None] ^ self.fps[nodes][None]) <= self.radius)
        a, b = queries[q], nodes[n]
        while len(a):
            a, b = self._roots(a), self._roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def search(self) -> np.ndarray:
        """Walk the tree with all queries at once; root[i] is i's local root afterwards."""
        fps, radius = self.fps, self.radius
        stack = [(np.arange(self.members), np.arange(len(fps)))]
        while stack:
            nodes, queries = stack.pop()
            if len(nodes) <= self.leaf and len(queries) <= self.leaf:
                self._compare(nodes, queries)
                continue
            top, rest = nodes[0], nodes[1:]
            away = np.bitwise_count(fps[queries] ^ fps[top]).astype(np.int16)
            hit = queries[away <= radius]
            if len(hit) > 1 or (len(hit) == 1 and hit[0] != top):
                tops = np.unique(self._roots(np.append(hit, top)))
                self.root[tops] = tops[0]
            if len(rest) == 0:
                continue
            edge = np.bitwise_count(fps[rest] ^ fps[top]).astype(np.int16)
            for d in np.unique(edge):
                near = queries[np.abs(away - d) <= radius]
                if len(near):
                    stack.append((rest[edge == d], near))
        return self._roots(np.arange(len(fps)))


def _shard_links(radius: int, flush: int, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (role, fp, node) arrays of the shard being read
        held_key = None

        def links():
            role = np.concatenate([x[0] for x in held])
            fps = np.concatenate([x[1] for x in held])
            nodes = pa.chunked_array([x[2] for x in held]).combine_chunks()
            members = int((role == 0).sum())
            if len(fps) < 2 or members == 0:
                return None
            root = ShardLinks(fps, members, radius, leaf).search()
            moved = np.nonzero(root != np.arange(len(fps)))[0]
            if len(moved) == 0:
                return None
            return pa.RecordBatch.from_arrays([nodes.take(pa.array(moved)), nodes.take(pa.array(root[moved]))], names=["src", "dst"])

        for b in batches:
            if b.num_rows == 0:
                continue
            key = b.column("key").to_numpy(zero_copy_only=False)
            tree = b.column("tree").to_numpy(zero_copy_only=False)
            role = b.column("role").to_numpy(zero_copy_only=False)
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = np.nonzero((key[1:] != key[:-1]) | (tree[1:] != tree[:-1]))[0] + 1
            starts, ends = np.append(0, cut), np.append(cut, len(key))
            sizes, inside = ends - starts, (starts > 0) & (ends < len(key))
            # a tree of two is its root and one child: all of them are searched at once
            two = starts[inside & (sizes == 2)]
            two = two[(role[two] == 0) & (np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius)]
            if len(two):
                nodes = b.column("node")
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(two + 1)), nodes.take(pa.array(two))], names=["src", "dst"])
            for i in np.nonzero(~inside | (sizes > 2))[0]:
                s, e = int(starts[i]), int(ends[i])
                now = (key[s], tree[s])
                if now != held_key:
                    if held and (out := links()) is not None:
                        yield out
                    held, held_key = [], now
                held.append((role[s:e], fps[s:e], b.column("node").slice(s, e - s)))
                if sum(len(x[0]) for x in held) > flush:
                    # the members come first: answer these queries and keep the members
                    if (out := links()) is not None:
                        yield out
                    held = [(r[r == 0], f[r == 0], n.filter(pa.array(r == 0))) for r, f, n in held if (r == 0).any()]
        if held and (out := links()) is not None:
            yield out

    return run


def block_keys(fp: Column, blocks: int, equal: int) -> Column:
    """An array with the key of every choice of `equal` blocks."""
    at = [64 * i // blocks for i in range(blocks + 1)]
    part = [
        F.shiftrightunsigned(fp, at[i]).bitwiseAND(F.lit((1 << (at[i + 1] - at[i])) - 1).cast("long"))
        for i in range(blocks)
    ]
    keys = []
    for t, chosen in enumerate(itertools.combinations(range(blocks), equal)):
        key = F.lit(t).cast("long")
        for i in chosen:
            key = F.shiftleft(key, at[i + 1] - at[i]).bitwiseOR(part[i])
        keys.append(key)
    return F.array(*keys)


def hamming_links(
    prints: DataFrame, radius: int, blocks: int, equal: int, shard: int = 20_000, leaf: int = 0
) -> DataFrame:
    """Links (src, dst) that join all fingerprints of `prints` (node, fp) within `radius` bits.

    The links have the components of the full link graph; those of a task are a forest. Nodes may have any type; fingerprints should be distinct.
    Every pair within `blocks - equal` bits is found; with a larger `radius`, also the pairs up
    to it that agree in `equal` blocks. Parts of a tree of at most `leaf` prints are compared directly.
    """
    keyed = prints.select("node", "fp", F.explode(block_keys(F.col("fp"), blocks, equal)).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard)
    trees = materialised(counts.select("key", F.ceil(F.col("n") / shard).cast("int").alias("trees")), "hot-keys")
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    hot = keyed.join(trees, "key").select("node", "fp", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"))
    hot = hot.select("key", "tree", F.when(F.col("tree") == F.col("own"), 0).otherwise(1).alias("role"), "fp", "node")
    cold = keyed.join(trees.select("key"), "key", "left_anti")
    cold = cold.select("key", F.lit(0).alias("tree"), F.lit(0).alias("role"), "fp", "node")
    rows = cold if trees.isEmpty() else cold.union(hot)
    if trees.isEmpty():
        rows = keyed.select("key", F.lit(0).alias("tree"), F.lit(0).alias("role"), "fp", "node")
    node = prints.schema["node"].dataType.simpleString()
    return (
        rows.repartition("key", "tree")
        .sortWithinPartitions("key", "tree", "role")
        .mapInArrow(forest(_shard_links(radius, 4 * shard, leaf)), f"src {node}, dst {node}")
    )
