"""Byte-level BPE by a rank queue on a hierarchical bitmap."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import batch, small_batches

def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one pre-token: always the lowest rank, the leftmost place first.

    The queue holds a bucket of list positions per rank and a bitmap of full buckets in two
    levels: a bit of `low[r >> 8]` says that bucket r is not empty, a bit of `top` that a word of
    `low` is not. Find-first-set in `top`, then in the word that it names, gives the lowest
    rank. (Words are Python integers, so `top` fits any vocabulary. The queue's steps are
    written out in place, since calls would double the time of short pre-tokens.)

    Parts form a linked list: `end[i]` is where the part that starts at i ends, 0 if it is gone.
    An entry is stale if its part is gone or its pair has another rank by now. If a merge
    makes a pair of a lower rank than the current one, the rest of the bucket waits.
    """
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    n = len(piece)
    end, prev = list(range(1, n + 1)), list(range(-1, n))
    get = ranks.get
    top, low, buckets = 0, {}, {}
    pending = [(r, i) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    while True:
        for r, i in pending:
            if r in buckets:
                buckets[r].append(i)
                continue
            buckets[r] = [i]
            if (hi := r >> 8) in low:
                low[hi] |= 1 << (r & 255)
            else:
                low[hi] = 1 << (r & 255)
                top |= 1 << hi
        if not top:
            break
        hi = (top & -top).bit_length() - 1
        word = low[hi]
        bit = word & -word
        rank = hi << 8 | (bit.bit_length() - 1)
        if word == bit:
            del low[hi]
            top &= top - 1
        else:
            low[hi] = word ^ bit
        places = buckets.pop(rank)
        if len(places) > 1:
            places.sort()
        pending = []
        for k, i in enumerate(places):
            mid = end[i]
            if not mid or mid >= n:
                continue
            stop = end[mid]
            if get(piece[i:stop]) != rank:
                continue
            end[i], end[mid] = stop, 0
            lower = False
            if stop < n:
                prev[stop] = i
                if (r := get(piece[i : end[stop]])) is not None:
                    pending.append((r, i))
                    lower = r < rank
            if i:
                before = prev[i]
                if (r := get(piece[before:stop])) is not None:
                    pending.append((r, before))
                    lower = lower or r < rank
            if lower:
                pending += [(rank, j) for j in places[k + 1 :]]
                break
    out, i = [], 0
    while i < n:
        stop = end[i]
        out.append(ranks[piece[i:stop]])
        i = stop
    return tuple(out)


class Memo(dict):
    """Ids of recent pre-tokens; two generations of at most `size` entries each."""

    def __init__(self, ranks: dict[bytes, int], size: int, longest: int = 200) -> None:
        super().__init__()
        self.ranks, self.size, self.longest, self.old = ranks, size, longest, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = merge_piece(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Coder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int) -> None:
        self.find = regex.compile(pattern).finditer
        self.memo = Memo(ranks, memo)
        self.names = {i: str(i) for i in ranks.values()}
        self.bytes = {i: b for b, i in ranks.items()}

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, (m.group() for m in self.find(text)))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


#: One coder per worker process and vocabulary: the memo outlives a task.
_CODERS: dict[tuple, Coder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def coder(vocabulary: str, ranks: dict[bytes, int], pattern: str, memo: int) -> Coder:
    at = (vocabulary, pattern, memo)
    if at not in _CODERS:
        _CODERS[at] = Coder(ranks, pattern, memo)
    return _CODERS[at]


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    memo: int = 500_000,
    with_ids: bool = True,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, the ids of every row.

    A null text counts as empty: no tokens, digests of nothing. Each row stands alone, so ties,
    repeated rows and other columns don't matter. The vocabulary file is read once on the driver
    (its size is bounded by the vocabulary) and sent to the tasks. `memo` bounds the pre-tokens
    a worker remembers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(read_ranks(vocabulary))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary, sent.value, pattern, memo)
        sha = hashlib.sha256
        for b in batches:
            n, digest, back, lists = [], [], [], []
            for t in b.column(1):
                ids = c.encode(t.as_py() or "")
                n.append(len(ids))
                digest.append(sha(",".join(map(c.names.__getitem__, ids)).encode()).hexdigest())
                back.append(sha(c.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(pa.array(ids, pa.int32()))
            columns, types = [b.column(0), n, digest, back], [None, pa.int64(), pa.string(), pa.string()]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = pa.array([0, *accumulate(n)], pa.int32())
                values = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
                columns, types, names = [*columns, pa.ListArray.from_arrays(offsets, values)], [*types, None], [*names, "ids"]
            yield batch(names, columns, types)

    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, schema + ", ids array<int>" * with_ids
    )
