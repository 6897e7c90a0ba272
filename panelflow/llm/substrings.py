"""Substring deduplication by difference-cover anchors.

A window of `size` words holds `size - anchor + 1 = period` anchor windows. Anchors are hashed only
at positions whose remainder by the period is in a difference cover: for any two places of a
repeated window there is a shift that puts both on the cover, so they share an anchor. Windows
that hold a repeated anchor are the extensions: they alone are hashed whole and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelflow.llm.base import batch, small_batches

#: Difference covers: every remainder by the period is a difference of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it holds `size`."""

    size = 400_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.size:
            self.clear()
        if len(word) < 200:
            self[word] = h
        return h


_HASHES = WordHashes()


def split(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of every `size` consecutive elements."""
    n = len(h) - size + 1
    out = h[:n].copy()
    for k in range(1, size):
        out *= BASE
        out += h[k : n + k]
    return out


class Plan:
    """The window, its period, cover and anchor length."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.period = max(p for p in COVERS if p < size)
        self.cover = COVERS[self.period]
        self.anchor = size - self.period + 1
        self.half = size // 2

    def anchors(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions and the hashes of the anchors there."""
        n = len(h) - self.anchor + 1
        at = np.arange(n)
        at = at[np.isin(at % self.period, self.cover)]
        return at, rolling(h, self.anchor)[at]

    def windows(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each window: the hashes of its two (perhaps overlapping) halves."""
        part = self.size - self.half
        r = rolling(h, part)
        n = len(h) - self.size + 1
        return r[:n], r[self.half : self.half + n]

    def extensions(self, n: int, at: np.ndarray) -> np.ndarray:
        """Which of the n windows hold an anchor at one of these positions."""
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, np.maximum(at - self.period + 1, 0), 1)
        np.add.at(change, np.minimum(at + 1, n), -1)
        return np.cumsum(change[:n]) > 0


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a ^ (a >> np.uint64(29))) * BASE + b


def _anchors(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, rows, places = [], [], []
            for k, (i, t) in enumerate(zip(b.column(0), b.column(1), strict=True)):
                words = split(t.as_py()) if i.is_valid else []
                if len(words) < plan.size:
                    continue
                at, h = plan.anchors(hashes(words))
                h, first = np.unique(h, return_index=True)
                hs.append(h)
                places.append(at[first])
                rows.append(np.full(len(h), k))
            if hs:
                yield batch(
                    ["h", "id", "at"],
                    [np.concatenate(hs).view(np.int64), b.column(0).take(pa.array(np.concatenate(rows))), np.concatenate(places).astype(np.int32)],
                    [pa.int64(), None, pa.int32()],
                )

    return run


def _windows(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right, rows, places = [], [], [], []
            for k, (i, t, flagged) in enumerate(zip(b.column(0), b.column(1), b.column(2), strict=True)):
                words = split(t.as_py()) if i.is_valid else []
                if len(words) < plan.size:
                    continue
                h = hashes(words)
                at, anchors = plan.anchors(h)
                own, times = np.unique(anchors, return_counts=True)
                known = own[times > 1]
                if flagged.is_valid:
                    known = np.union1d(known, anchors[np.searchsorted(at, flagged.values.to_numpy())])
                if len(known) == 0:
                    continue
                a, c = plan.windows(h)
                start = np.nonzero(plan.extensions(len(a), at[np.isin(anchors, known)]))[0]
                _, first = np.unique(_mixed(a[start], c[start]), return_index=True)
                start = start[first]
                left.append(a[start])
                right.append(c[start])
                places.append(start.astype(np.int32))
                rows.append(np.full(len(start), k))
            if left:
                yield batch(
                    ["a", "c", "id", "start"],
                    [
                        np.concatenate(left).view(np.int64),
                        np.concatenate(right).view(np.int64),
                        b.column(0).take(pa.array(np.concatenate(rows))),
                        np.concatenate(places),
                    ],
                    [pa.int64(), pa.int64(), None, pa.int32()],
                )

    return run


def _cleaned(plan: Plan, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, digests, kept_texts, starts, ends = [], [], [], [], [], []
            for t, copy, listed in zip(b.column(1), b.column(2), b.column(3), strict=True):
                words = split(t.as_py())
                gone = np.zeros(len(words), bool)
                if len(words) >= plan.size:
                    if copy.as_py():
                        gone[:] = True
                    else:
                        a, c = plan.windows(hashes(words))
                        _, first = np.unique(_mixed(a, c), return_index=True)
                        later = np.ones(len(a), bool)
                        later[first] = False
                        if listed.is_valid:
                            later[listed.values.to_numpy()] = True
                        at = np.nonzero(later)[0]
                        change = np.zeros(len(words) + 1, np.int64)
                        change[at] += 1
                        change[at + plan.size] -= 1
                        gone = np.cumsum(change[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                starts.append(edge[::2].tolist())
                ends.append(edge[1::2].tolist())
                kept_texts.append(kept.decode("utf-8", "replace") if with_text else None)
            many = pa.list_(pa.int64())
            yield batch(
                ["id", "n_words", "n_removed", "kept_sha256", "starts", "ends", "kept"],
                [b.column(0), n_words, n_removed, digests, starts, ends, kept_texts],
                [None, pa.int64(), pa.int64(), pa.string(), many, many, pa.string()],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 20, with_text: bool = True
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, starts, ends, kept) of every row of `docs`.

    A word goes if a window of `size` words that covers it also starts earlier: in a row with a
    smaller id, or earlier in the same row. `starts` and `ends` are the removed spans in words;
    `kept` is the rest joined by one space (null unless `with_text`).

    A null text has no words; shorter texts keep all. Rows without an id lose what
    repeats inside them and are no earlier place for others. Equal rows give equal results. Rows
    with one id but different texts are versions of one document: a start is kept if some
    version's window there is the first.

    Exact copies of a text are settled by a digest, so a group of copies brings its anchors once.
    An anchor or window brings at most one row per document; what repeats inside a document is
    found there. Texts cross the shuffle once, keyed by id: the three passes share that exchange.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plan = Plan(size)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    digest = rows.select("id", F.sha2("text", 256).alias("digest")).filter("id is not null and digest is not null")
    firsts = digest.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    copies = digest.join(firsts, "digest").filter("id > first").groupBy("id").agg(F.lit(True).alias("copy"))
    # the left sides of the joins by id stay exactly alike (no filter of their own), so that they share one exchange
    marked = rows.join(copies, "id", "left")

    anchors = marked.filter("copy is null").select("id", "text").mapInArrow(_anchors(plan), f"h bigint, id {kind}, at int")
    shared = anchors.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("n > 1")
    flagged = shared.groupBy("id").agg(F.array_distinct(F.collect_list("at")).alias("flagged"))
    judged = marked.join(flagged, "id", "left").filter("copy is null").select("id", "text", "flagged")
    windows = judged.mapInArrow(_windows(plan), f"a bigint, c bigint, id {kind}, start int")
    later = windows.withColumn("place", F.rank().over(Window.partitionBy("a", "c").orderBy("id"))).filter("place > 1")
    listed = later.groupBy("id").agg(F.collect_list("start").alias("listed"))
    ready = marked.join(listed, "id", "left").select("id", "text", "copy", "listed")
    return ready.mapInArrow(
        _cleaned(plan, with_text),
        f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, starts array<bigint>, ends array<bigint>, kept string",
    )
