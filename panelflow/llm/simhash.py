"""SimHash near-duplicates: fingerprints of word shingles, linked by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import batch, small_batches
from panelflow.llm.components import connected_components
from panelflow.llm.hamming import hamming_links
from panelflow.session import materialised

SEED = 42
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size) + np.arange(len(words))
    starts = ends - size
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    hash64, n, ones = xxhash.xxh64_intdigest, len(starts), np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        pairs = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        h = np.array([hash64(joined[s:e], SEED) for s, e in pairs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield batch(["id", "fp"], [b.column(0), got.view(np.int64)], [None, pa.int64()])

    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) of every row; fp is the unsigned fingerprint's bits as a bigint."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _prints(shingle), f"id {kind}, fp bigint"
    )


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int = 6,
    shard: int = 20_000,
) -> DataFrame:
    """(id, fp, component) of every row of `docs`; component is the smallest id reachable.

    Fingerprints within `radius` bits are linked. Equal fingerprints are first folded into
    one, so a group of copies of any size costs one row per task. Null and wordless texts have
    fingerprint 0 and are linked like others. Rows without an id get a fingerprint and the
    component of their fingerprint (null if no row with an id has it or is linked to it); they
    link nothing. Repeated rows each give a row. Other columns are not touched.
    """
    each = materialised(fingerprints(docs, id_col, text_col, shingle), "prints")
    first = each.filter("id is not null").groupBy("fp").agg(F.min("id").alias("node"))
    prints = materialised(first.select("node", "fp"), "distinct-prints")
    links = hamming_links(prints, radius, blocks, blocks - radius, shard)
    groups = connected_components(links, forests=True)
    of_print = prints.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    return each.join(of_print, "fp", "left").select("id", "fp", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that are the first of their group; of rows with one id, one stays.

    Rows without an id are kept only if no row with an id is in their group.
    """
    near = near_duplicates(docs, id_col, text_col, **settings)
    first = near.filter("id = component").groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    first = materialised(first, "first-of-group")
    kept = docs.join(first.select(F.col("id").alias(id_col)), id_col, "left_semi")
    if first.filter("copies > 1").head(1):
        kept = kept.dropDuplicates([id_col])
    alone = near.filter("component is null").select("fp").distinct()
    if not alone.isEmpty():
        lost = docs.filter(F.col(id_col).isNull())
        kept = kept.unionByName(lost.dropDuplicates([text_col]))
    return kept.select(docs.columns)
