"""Language-model scores: smoothed n-grams as a weighted automaton with failure arcs.

The model has an arc for every n-gram of the training texts, so it grows with the corpus and is neither broadcast nor
collected. Texts are cut into chunks of bounded size, whose tokens are written once as codes. Each chunk asks
for the counts of its own n-grams: sorted 64-bit keys with the chunk's counts, cut by key range into buckets, one row per
bucket. A bucket adds up all chunks' counts and answers a chunk only where the corpus count is not its own,
which few rare n-grams need. With the answers a chunk's automaton is whole: every arc and failure arc its texts can take is there.

States are the contexts that the training texts hold, from the empty one up to `order` - 1 tokens. An arc has the smoothed
log-probability of its token after the state's context; the failure arc leads to the state without the oldest token and has the weight
of backing off. Smoothing is Bayesian with a Dirichlet prior: p(w | c) = (n(cw) + strength p(w | c')) / (n(c) + strength), where c' is c without
its oldest token; it sums to one, and its failure weight strength / (n(c) + strength) needs no sum over a state's arcs. The empty
context has the add-one estimate, with one class for all unknown words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.llm.base import small_batches
from panelflow.session import materialised

#: Bytes of text, and texts, of a chunk; a longer text is a chunk by itself.
CHUNK_BYTES, CHUNK_TEXTS = 8 << 20, 50_000
#: n-grams that a bucket adds up, about.
BUCKET_KEYS = 2_000_000
#: Words hold no blank, so these hash like no word.
BEGIN, END = xxhash.xxh3_64_intdigest(b" begin"), xxhash.xxh3_64_intdigest(b" end")
BEGIN_CODE, END_CODE = 0, 1


def packed(a: np.ndarray) -> bytes:
    """Bytes of the numbers, those of one place together, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 3)


def unpacked(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), np.uint8) if b else np.zeros(0, np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has. A null text has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(flat, "")  # white space at an end gives an empty word
    if not pc.all(real).as_py():
        text = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(text[real.to_numpy(zero_copy_only=False)], minlength=len(sizes))
        flat = flat.filter(real)
    return flat, sizes


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: ids, training flags, numbers of tokens, hashes of the words, and the tokens' codes."""
    held, size, texts, nth = [], 0, 0, 0

    def out():
        ids = pa.concat_arrays([b.column(0) for b in held])
        train = pa.concat_arrays([b.column(1) for b in held])
        flat, sizes = words_of(pa.concat_arrays([b.column(2) for b in held]))
        coded = flat.dictionary_encode()
        own = [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in coded.dictionary.to_pylist()]
        hashes = np.array([BEGIN, END, *own], np.uint64)
        tokens = np.empty(len(flat) + 2 * len(sizes), np.int32)
        ends = np.cumsum(sizes + 2)
        tokens[ends - 1], tokens[ends - sizes - 2] = END_CODE, BEGIN_CODE
        inside = np.ones(len(tokens), bool)
        inside[ends - 1] = inside[ends - sizes - 2] = False
        tokens[inside] = coded.indices.to_numpy(zero_copy_only=False) + 2
        learnt = train.to_numpy(zero_copy_only=False).astype(bool)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"{TaskContext.get().partitionId()}-{nth}"]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([packed(learnt)], pa.binary()),
                pa.array([packed(sizes + 1)], pa.binary()),
                pa.array([packed(hashes)], pa.binary()),
                pa.array([packed(tokens)], pa.binary()),
                pa.array([len(tokens) - len(sizes)], pa.int64()),
                pa.array([int((sizes + 1)[learnt].sum())], pa.int64()),
            ],
            names=["chunk", "ids", "train", "sizes", "words", "codes", "tokens", "train_tokens"],
        )

    for b in batches:
        lengths = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = lengths[at - 1] if at else 0
            end = int(np.searchsorted(lengths, before + CHUNK_BYTES - size, side="right"))
            end = min(max(end, at + (not held)), b.num_rows, at + CHUNK_TEXTS - texts)
            if end > at:
                held.append(b.slice(at, end - at))
                size += int(lengths[end - 1] - before)
                texts += end - at
            if end < b.num_rows:
                yield out()
                held, size, texts, nth = [], 0, 0, nth + 1
            at = end
    if held:
        yield out()


class Grams:
    """The n-grams of a chunk: per length the sorted keys, training counts, and each token's row (-1: none)."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, train: np.ndarray, sizes: np.ndarray, order: int) -> None:
        self.sizes, n = sizes, len(tokens)
        starts = np.cumsum(sizes + 1) - sizes - 1
        self.place = (np.arange(n) - np.repeat(starts, sizes + 1)).astype(np.int32)  # in its text, from 0 for the begin mark
        weight = np.repeat(train, sizes + 1)
        self.keys, self.counts, self.at, self.first = [], [], [], []
        keys, back = np.unique(hashes, return_inverse=True)
        rows = back[tokens]
        first = np.zeros(len(keys), np.int64)
        first[rows[::-1]] = np.arange(n)[::-1]
        self._add(keys, rows, first, weight)
        each = hashes[tokens]
        for m in range(2, order + 1):
            each[1:] = mixed(each[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[tokens[1:]] + np.uint64(m))
            inside = np.nonzero(self.place >= m - 1)[0].astype(np.int32)
            keys, first, back = np.unique(each[inside], return_index=True, return_inverse=True)
            rows = np.full(n, -1, np.int32)
            rows[inside] = back
            first = inside[first]
            del inside, back
            self._add(keys, rows, first, weight)

    def _add(self, keys, rows, first, weight) -> None:
        counts = np.bincount(rows[weight & (rows >= 0)], minlength=len(keys))
        self.keys.append(keys)
        self.counts.append(counts)
        self.at.append(rows.astype(np.int32, copy=False))
        self.first.append(first)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grams(words: bytes, codes: bytes, train: bytes, sizes: bytes, order: int) -> Grams:
    return Grams(unpacked(words, np.uint64), unpacked(codes, np.int32), unpacked(train, np.bool_), unpacked(sizes, np.int64), order)


def _borders(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's keys begin, and the end of the last."""
    if not bits:
        return np.array([0, len(keys)])
    inner = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]])


def _requests(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                g = _grams(row["words"], row["codes"], row["train"], row["sizes"], order)
                for m in range(order):
                    borders = _borders(g.keys[m], bits)
                    filled = np.nonzero(np.diff(borders))[0]
                    cut = [(int(borders[i]), int(borders[i + 1])) for i in filled]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(cut), m + 1, np.int32)),
                            pa.array(filled.astype(np.int64)),
                            pa.array([row["chunk"]] * len(cut), pa.string()),
                            pa.array([packed(g.keys[m][s:e]) for s, e in cut], pa.binary()),
                            pa.array([packed(g.counts[m][s:e]) for s, e in cut], pa.binary()),
                        ],
                        names=["length", "bucket", "chunk", "keys", "counts"],
                    )

    return run


def totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every key the sum of its counts; the distinct keys; their sums."""
    distinct, back = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, back, counts)
    return sums[back], distinct, sums


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: for each chunk where and what the corpus counts are, if not its own; and the number of known words."""
    held, at = [], None

    def out():
        keys = [unpacked(r["keys"], np.uint64) for r in held]
        own = [unpacked(r["counts"], np.int64) for r in held]
        each, distinct, sums = totals(np.concatenate(keys), np.concatenate(own))
        chunks, where, what, end = [], [], [], 0
        for r, k, c in zip(held, keys, own, strict=True):
            mine, end = each[end : end + len(k)], end + len(k)
            other = np.nonzero(mine != c)[0]
            if len(other):
                chunks.append(r["chunk"])
                where.append(packed(np.diff(other, prepend=0).astype(np.int32)))
                what.append(packed(mine[other]))
        known = int(((sums > 0) & (distinct != np.uint64(BEGIN))).sum()) if at[0] == 1 else 0
        n = len(chunks)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*chunks, None], pa.string()),
                pa.array(np.full(n + 1, at[0], np.int32)),
                pa.array(np.full(n + 1, at[1], np.int64)),
                pa.array([*where, None], pa.binary()),
                pa.array([*what, None], pa.binary()),
                pa.array([*[0] * n, known], pa.int64()),
            ],
            names=["chunk", "length", "bucket", "places", "counts", "known"],
        )

    for b in batches:
        for r in b.to_pylist():
            now = (r["length"], r["bucket"])
            if now != at and held:
                yield out()
                held = []
            at = now
            held.append(r)
    if held:
        yield out()


class Automaton:
    """Arc and failure weights of a chunk's n-grams with the counts of the whole corpus.

    arcs[m][row]: log10 probability of the last token of that n-gram of m + 1 tokens after the others, NaN where
    the training texts lack it. fails[m][row]: weight of leaving the state of that context; 0 where there is no such state.
    """

    def __init__(self, grams: Grams, train_tokens: int, known: int, strength: float) -> None:
        self.grams = grams
        size = train_tokens + known + 1
        p = (grams.counts[0] + 1) / size
        self.arcs, self.fails = [np.log10(p)], []
        for m in range(1, len(grams.keys)):
            count, first = grams.counts[m], grams.first[m]
            context = grams.counts[m - 1][grams.at[m - 1][first - 1]]
            p = (count + strength * p[grams.at[m - 1][first]]) / (context + strength)
            with np.errstate(divide="ignore"):
                self.arcs.append(np.where(count > 0, np.log10(p), np.nan))
            self.fails.append(np.where(grams.counts[m - 1] > 0, np.log10(strength / (grams.counts[m - 1] + strength)), 0.0))

    def walk(self) -> np.ndarray:
        """The weight of every token, begin marks left out.

        The state after a token is the longest stored context that ends there, whatever way led to it, so it is carried as the row of
        the context and all tokens take their next arc, or the failure arc to the next shorter state, at the same time.
        """
        g = self.grams
        weight = np.zeros(len(g.place))
        left = np.nonzero(g.place > 0)[0]
        for m in range(len(self.arcs) - 1, 0, -1):
            deep = left[g.place[left] >= m]
            arc = self.arcs[m][g.at[m][deep]]
            fails = np.isnan(arc)
            weight[deep] += np.where(fails, self.fails[m - 1][g.at[m - 1][deep - 1]], arc)
            done = np.zeros(len(weight), bool)
            done[deep[~fails]] = True
            left = left[~done[left]]
        weight[left] += self.arcs[0][g.at[0][left]]
        return weight[g.place > 0]


def _scores(order: int, bits: int, train_tokens: int, known: int, strength: float, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, grams, borders = None, None, []

        def out():
            g, sizes = grams, grams.sizes
            starts = np.cumsum(sizes) - sizes
            scored = g.place > 0
            count = g.counts[0][g.at[0][scored]]
            base = np.log10((count + 1) / (train_tokens + known + 1))
            each = Automaton(g, train_tokens, known, strength).walk()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], id_type),
                    pa.array(unpacked(row["train"], np.bool_)),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(each, starts)),
                ],
                names=["id", "train", "n_tokens", "n_known", "base_score", "score"],
            )

        for b in batches:
            for r in b.to_pylist():
                if r["codes"] is not None:
                    if row is not None:
                        yield out()
                    row = r
                    grams = _grams(r["words"], r["codes"], r["train"], r["sizes"], order)
                    borders = [_borders(k, bits) for k in grams.keys]
                    continue
                if row is None or r["chunk"] != row["chunk"]:
                    raise ValueError(f"answers without a chunk: {r['chunk']}")
                m = r["length"] - 1
                places = np.cumsum(unpacked(r["places"], np.int32)) + borders[m][r["bucket"]]
                grams.counts[m][places] = unpacked(r["counts"], np.int64)
        if row is not None:
            yield out()

    return run


def score(docs: DataFrame, id_col: str, text_col: str, train: Column, order: int = 2, strength: float = 4.0) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    The model learns from the rows where `train` is true; null counts as false. Tokens are the words (separated by ASCII white
    space, A-Z lower-cased), then one end token; an empty or null text has the end token alone. n_known counts tokens that
    occur in training, base_score is the add-one unigram score and score the automaton's. Repeated rows and
    rows with a null id each count and each give a row; an empty table gives none. Without a training row every token has
    probability 1 / (0 + 0 + 1). Other columns are not touched.

    Two different n-grams whose 64-bit hashes are equal share a count; words and longer n-grams are kept apart.
    """
    if order < 1 or strength <= 0:
        raise ValueError("order must be at least 1 and strength positive")
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    shape = f"chunk string, ids array<{kind}>, train binary, sizes binary, words binary, codes binary, tokens bigint, train_tokens bigint"
    chunks = materialised(rows.mapInArrow(_chunks, shape), "lm-chunks")
    total = chunks.agg(F.sum("tokens").alias("n"), F.sum("train_tokens").alias("train")).first()
    n, train_tokens = total.n or 0, total.train or 0
    bits = max(0, int(np.ceil(np.log2(max(1, n / BUCKET_KEYS)))))

    small_batches(spark, 1)  # a row may be a chunk
    asked = chunks.select("chunk", "train", "sizes", "words", "codes").mapInArrow(
        _requests(order, bits), "length int, bucket bigint, chunk string, keys binary, counts binary"
    )
    small = "chunk string, length int, bucket bigint, places binary, counts binary, known bigint"
    answers = asked.repartition("length", "bucket").sortWithinPartitions("length", "bucket").mapInArrow(_answers, small)
    answers = materialised(answers, "lm-answers")
    known = answers.filter("chunk is null").agg(F.sum("known")).first()[0] or 0

    none = lambda t: F.lit(None).cast(t)
    whole = chunks.select(
        "chunk", "ids", "train", "sizes", "words", "codes", none("int").alias("length"), none("bigint").alias("bucket"), none("binary").alias("places"), none("binary").alias("counts")
    )
    parts = answers.filter("chunk is not null").select(
        "chunk", none(f"array<{kind}>").alias("ids"), *(none("binary").alias(c) for c in ("train", "sizes", "words", "codes")), "length", "bucket", "places", "counts"
    )
    from pyspark.sql.pandas.types import to_arrow_type

    run = _scores(order, bits, train_tokens, known, strength, to_arrow_type(docs.schema[id_col].dataType))
    out = f"id {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    ordered = whole.unionByName(parts).repartition("chunk").sortWithinPartitions("chunk", F.col("length").asc_nulls_first())
    scored = materialised(ordered.mapInArrow(run, out), "lm-scores")
    small_batches(spark)
    return scored.select("id", "train", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
