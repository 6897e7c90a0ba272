"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import batch, small_batches

#: Byte table: A-Z lower-cased; ASCII other than letters and digits is white space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items, found = [], []
            for item, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words(t.as_py())
                k = min(size, len(w))
                if item is None or k == 0:
                    continue
                for s in {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}:
                    items.append(item)
                    found.append(s)
            yield batch(["item", "window"], [items, found], [pa.string(), pa.binary()])

    return run


def item_windows(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct (item, window); an item shorter than `size` is one window."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_windows(size), "item string, window binary").distinct()


@dataclass
class WindowIndex:
    """Windows by their rarest shingle.

    A document window contains an item window only if it has all its shingles, so one
    shingle is a sufficient prefix; the rarest one gives the fewest candidates. A shingle is two
    neighbouring words, or the word of a window of one. `near[c]` has (offset of the
    shingle in the window, length of the window, its word ids, its items).
    """

    ids: dict[bytes, int] = field(default_factory=dict)
    windows: list[tuple[np.ndarray, list[str]]] = field(default_factory=list)
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    near: dict[int, list[tuple[int, int, np.ndarray, list[str]]]] = field(default_factory=dict)
    single: list[int] = field(default_factory=list)  # codes of windows of one word

    @classmethod
    def of(cls, rows: list[tuple[str, bytes]]) -> WindowIndex:
        owners: dict[bytes, list[str]] = defaultdict(list)
        for item, window in sorted(rows):
            owners[window].append(item)
        index = cls()
        for window, items in owners.items():
            w = [index.ids.setdefault(x, len(index.ids) + 1) for x in window.split(b" ")]
            index.windows.append((np.array(w, np.int64), items))
        every = [index.shingles(w) for w, _ in index.windows]
        index.codes = np.unique(np.concatenate(every)) if every else index.codes
        return index

    def shingles(self, w: np.ndarray) -> np.ndarray:
        """Codes of the shingles at each position; 0 where a word is in no window."""
        base = len(self.ids) + 1
        if len(w) < 2:
            return w.copy()
        return np.where((w[:-1] > 0) & (w[1:] > 0), w[:-1] * base + w[1:], 0)

    def parse(self, text: str | None) -> np.ndarray:
        w = words(text)
        get = self.ids.get
        return np.fromiter((get(x, 0) for x in w), np.int64, len(w))

    def count(self, w: np.ndarray, into: Counter) -> None:
        codes = self.shingles(w)
        codes = codes[codes > 0]
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        hit = codes[self.codes[at] == codes] if len(self.codes) else codes[:0]
        for c, n in zip(*np.unique(hit, return_counts=True), strict=True):
            into[int(c)] += int(n)

    def choose(self, seen: dict[int, int]) -> None:
        """Order each window's shingles by rarity in the documents and index the first."""
        for w, items in self.windows:
            codes = self.shingles(w).tolist()
            at = min(range(len(codes)), key=lambda i: (seen.get(codes[i], 0), i))
            self.near.setdefault(codes[at], []).append((at, len(w), w, items))
        self.codes = np.array(sorted(self.near), np.int64)
        self.single = sorted(int(w[0]) for w, _ in self.windows if len(w) == 1)

    def find(self, w: np.ndarray) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an item window, and the items whose windows occur."""
        hit, items = np.zeros(len(w), bool), set()
        if len(w) == 0 or len(self.codes) == 0:
            return hit, items
        pairs = self.shingles(w) if len(w) > 1 else w[:0]
        alone = np.where(np.isin(w, self.single), w, 0) if self.single else w[:0]
        for codes, one in ((pairs, False), (alone, True)):
            at = np.searchsorted(self.codes, codes)
            at[at == len(self.codes)] = 0
            for p in np.nonzero((self.codes[at] == codes) & (codes > 0))[0].tolist():
                for offset, size, window, owners in self.near[int(codes[p])]:
                    start = p - offset
                    if (size == 1) == one and 0 <= start <= len(w) - size and np.array_equal(w[start : start + size], window):
                        hit[start : start + size] = True
                        items.update(owners)
        return hit, items


def _counts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen = sent.value, Counter()
        for b in batches:
            for t in b.column(0):
                index.count(index.parse(t.as_py()), seen)
        yield batch(["code", "n"], [list(seen), list(seen.values())], [pa.int64(), pa.int64()])

    return run


def _hits(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for b in batches:
            n, starts, ends, items = [], [], [], []
            for t in b.column(1):
                w = index.parse(t.as_py())
                hit, found = index.find(w)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                n.append(len(w))
                starts.append(edge[::2].tolist())
                ends.append(edge[1::2].tolist())
                items.append(sorted(found))
            many = pa.list_(pa.int64())
            yield batch(
                ["id", "n_words", "starts", "ends", "items", "text_hash"],
                [b.column(0), n, starts, ends, items, b.column(2)],
                [None, pa.int64(), many, many, pa.list_(pa.string()), None],
            )

    return run


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    block: int = 200_000,
) -> DataFrame:
    """(id, n_words, n_hit, starts, ends, items, text_hash) of every row of `docs`.

    A window is `size` consecutive words of an item (all of them if it has fewer); words of a
    document inside any occurrence of a window are hit. `starts` and `ends` are the hit spans in
    words, end exclusive; `items` the sorted ids, as strings, of the items whose windows occur.

    The windows are an indexed query set: at most `block` (item, window) rows are sent to the tasks
    at a time; a larger benchmark is taken in several blocks, each over all documents, whose
    hits are united. Null and wordless texts have no words and no hits; items that are null,
    wordless or without an id have no windows; an item that repeats counts once; repeated
    documents each give a row. Other columns are not touched.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out_schema = f"id {kind}, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>, text_hash bigint"
    windows = item_windows(items, item_col, item_text_col, size)
    blocks = max(1, -(-windows.count() // block))
    found = None
    for k in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        index = WindowIndex.of([(r.item, bytes(r.window)) for r in own.toLocalIterator()])
        plain = spark.sparkContext.broadcast(index)
        seen = rows.select("text").mapInArrow(_counts(plain), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
        # no more rows than the block has shingles
        index.choose({r.code: r.n for r in seen.toLocalIterator()})
        part = rows.mapInArrow(_hits(spark.sparkContext.broadcast(index)), out_schema)
        found = part if found is None else found.unionAll(part)
    if blocks > 1:
        found = _united(found, blocks)
    sizes = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("id", "n_words", sizes.alias("n_hit"), "starts", "ends", "items", "text_hash")


def _united(found: DataFrame, blocks: int) -> DataFrame:
    """One row per document again; rows that repeat are alike in each block."""
    same = found.groupBy("id", "text_hash", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count(F.lit(1)).alias("n"),
    )

    def step(done, s):
        last = F.element_at(done, -1)
        joined = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], s["ends"]).alias("ends"))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        return F.when((F.size(done) > 0) & (s["starts"] <= F.try_element_at(done, F.lit(-1))["ends"]), grown).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<starts:bigint,ends:bigint>>")
    spans = F.aggregate("spans", empty, step)
    copies = F.explode(F.sequence(F.lit(1), (F.col("n") / blocks).cast("int")))
    return same.withColumn("spans", spans).withColumn("copy", copies).select(
        "id", "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items", "text_hash"
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` without a hit."""
    hits = benchmark_hits(docs, items, id_col, text_col, **settings).filter("n_hit > 0").select("id", "text_hash").distinct()
    same = docs[id_col].eqNullSafe(hits["id"]) & (F.xxhash64(docs[text_col].cast("string")) == hits["text_hash"])
    return docs.join(hits, same, "left_anti")
