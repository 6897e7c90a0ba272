"""Connected components of an edge table, by Spark joins only.

Edges are first reduced to a spanning forest inside each partition, then large-star and
small-star steps alternate until nothing changes. No node's neighbours are ever gathered: a
star step is a minimum per node (combined before the shuffle) and a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.session import materialised


#: Links that leave a worker at a time.
ROWS = 10_000


class UnionFind:
    """Disjoint sets; the smallest member is a set's root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x] = root
            x = p
        return root

    def union(self, a, b) -> bool:
        """False if they were in one set already."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


def forest(links: Callable = iter) -> Callable:
    """A function for mapInArrow: a spanning forest of each task's links.

    `links` is one that makes them, (src, dst); it runs in the same Python worker, so a task needs no second one.
    Links with a null end are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, kind = UnionFind(), None
        for b in links(batches):
            kind = b.schema.field("src").type
            for x, y in zip(b.column("src").to_pylist(), b.column("dst").to_pylist(), strict=True):
                if x is not None and y is not None:
                    sets.union(x, y)
        nodes = list(sets.up)
        for at in range(0, len(nodes), ROWS):
            some = nodes[at : at + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some, kind), pa.array([sets.find(x) for x in some], kind)], names=["src", "dst"])

    return run


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, forests: bool = False) -> DataFrame:
    """(node, component) for every node of `edges` (src, dst); component is the smallest node reachable.

    Ids may be of any ordered type. Rows with a null end and loops are ignored; repeated
    and reversed edges count once; an empty table gives an empty result. `forests`: the edges of
    each task are a forest already.
    """
    proper = edges.select("src", "dst").filter("src is not null and dst is not null and src != dst")
    e = proper if forests else proper.mapInArrow(forest(), proper.schema)
    e = materialised(e.distinct(), "edges")
    before = _state(e)
    while before[0]:
        both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
        large = both.join(low, "src").filter("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.filter("src != dst").distinct()
        least = large.groupBy("src").agg(F.min("dst").alias("low"))
        rest = large.join(least, "src").filter("dst != low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        small = rest.union(least.select("src", F.col("low").alias("dst"))).distinct()
        e = materialised(small, "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
