"""Whitening, conversation repair and language-model scores against direct computations."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelflow.llm import lm, repair, whitening
from panelflow.llm.queries import QUERIES

# --- whitening


def eigen_reference(a):
    values, vectors = np.linalg.eigh(a)
    return values[::-1], vectors[:, ::-1]


def direct_whitening(vectors):
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, basis = eigen_reference(y.T @ y / n)
    return n, ((n * x - s) ** 2).sum(axis=1), y @ basis, values


def check_whitening(got, rows, flat=()):
    """`got` rows by id; columns equal up to sign."""
    n, deviation, projected, values = direct_whitening([v for _, v in rows])
    k = min(32, len(values))
    assert len(got) == len(rows) * k
    table = {(r.vec_id, r.component): r for r in got}
    for c in range(1, k + 1):
        here = np.array([table[i, c].whitened for i, _ in rows])
        if c in flat:
            assert not here.any()
            continue
        want = projected[:, c - 1] / math.sqrt(values[c - 1])
        here *= np.sign(here @ want)
        assert np.allclose(here, want, atol=1e-9), c
    for (i, _), d in zip(rows, deviation, strict=True):
        for c in range(1, k + 1):
            r = table[i, c]
            assert (r.n, r.deviation) == (n, d)
            assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9, abs_tol=1e-12)
            assert r.identity_error < 1e-9


def test_whitening_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op11_whitening"](spark, sf).collect(), rows)


def frame(spark, rows, kind="float"):
    data = [(i, v, "x", 1) for i, v in rows]
    return spark.createDataFrame(data, f"vec_id bigint, embedding array<{kind}>, id string, vector int").repartition(3)


def test_whitening_edge_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=5) * [4, 2, 1, 1, 0.5]]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [math.nan] * 5), (104, [math.inf] + [0.0] * 4), (105, [1.0, 2.0]), (106, [3e38] * 5)]
    got = whitening.whiten(frame(spark, good + bad)).withColumnRenamed("id", "vec_id").collect()
    check_whitening(got, good)
    again = whitening.whiten(frame(spark, good[:1] * 3 + [(None, good[1][1])] + good)).collect()
    assert len(again) == 44 * 5 and sum(r.id is None for r in again) == 5 and {r.n for r in again} == {44}
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, bad[:2])).collect() == []
    one = whitening.whiten(frame(spark, good[:1])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, 0.0, 0.0, 0.0)] * 5


def test_whitening_dependent_entries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v[0]), float(v[1]), float(v[0]), float(v[1] - v[0])]) for i, v in enumerate(rng.integers(-9, 9, (30, 2)))]
    got = whitening.whiten(frame(spark, rows, "double")).withColumnRenamed("id", "vec_id").collect()
    check_whitening(got, rows, flat=(3, 4))
    assert len(whitening.whiten(frame(spark, [(1, [2, 3]), (2, [5, 3])], "int")).collect()) == 4


def test_deviation_beyond_a_long():
    far = whitening.Fit(2**40, [0], -(2**40), 2**40, np.ones(1), np.eye(1), 1.0)
    assert whitening.deviations(np.array([[2**40], [1]]), far) == [None, None]
    near = far._replace(n=2**20, low=-(2**12), high=2**12)
    assert whitening.deviations(np.array([[3]]), near) == [9 * 2**40]


@pytest.mark.parametrize("values", [np.linspace(1, 9, 24), np.repeat([5.0, 1.0], 12), np.r_[[3.0] * 4, 3 + 1e-9 * np.arange(8), np.ones(12) * 1e-6], np.zeros(24)])
def test_refined_eigenpairs(values):
    q = np.linalg.qr(np.random.default_rng(7).normal(size=(24, 24)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined_eigenpairs(a)
    assert np.allclose(got, np.sort(values)[::-1], rtol=0, atol=1e-14 * max(1, values.max()))
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-15 * 24
    assert np.abs(a @ x - x * got).max() < 1e-14 * max(1, values.max())
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    if values.any():
        assert np.abs(start.T @ start - np.eye(24)).max() > 1e-8  # what the refinement had to repair


def test_integers_of_a_batch():
    x, good = whitening.integers(pa.array([[0.5, -0.01], [None, 1.0], [math.nan, 1.0]], pa.list_(pa.float32())), 2)
    assert x.tolist() == [[32, -1]] and good.tolist() == [True, False, False]


# --- conversation repair

SPACE = " \t\n\v\f\r"


def faults(rows):
    """(role, text, fault) of turns in order."""
    seen, out = set(), []
    for role, text in rows:
        kept = text.strip(SPACE)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def every_repair(rows):
    """Least (cost, audit, result) over all edits with up to two inserts in a gap, by trying them all."""
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        if sum(map(len, inserts)) > 3:
            continue
        added = [[("I", r, "", 5) for r in g] for g in inserts]
        ways = []
        for role, text, fault in rows:
            extra = 5 if fault == "truncated" else 0
            ways.append([("D", None, None, 2)])
            if fault not in ("blank", "duplicate"):
                ways[-1] += [("K", role, text, extra), ("R", "user", text, 1 + extra), ("R", "assistant", text, 1 + extra)]
        for own in itertools.product(*ways):
            edits = added[0] + [e for w, g in zip(own, added[1:], strict=True) for e in (w, *g)]
            left = [e for e in edits if e[0] != "D"]
            if all(e[1] for e in left) and re.fullmatch("(s?(ua)+)?", "".join(e[1][0] for e in left)):
                found = (sum(e[3] for e in edits), "".join(e[0] for e in edits), [(e[1], e[2]) for e in left])
                best = found if best is None else min(best, found)
    return best


def table_repair(rows):
    """The same by a table with whole audits, for longer conversations."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def insert(best):
        for _ in range(3):
            for (state, c), new in after.items():
                if state in best and c != "s":
                    cost, audit, out = best[state]
                    way = (cost + 5, audit + "I", [*out, ({"u": "user", "a": "assistant"}[c], "")])
                    best[new] = min(best.get(new, way), way)
        return best

    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, out) in insert(dict(best)).items():
            ways = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                cost += 5 if fault == "truncated" else 0
                for (s, c), new in after.items():
                    if s == state:
                        if role[:1] == c:
                            ways.append((new, (cost, audit + "K", [*out, (role, text)])))
                        if c != "s":
                            ways.append((new, (cost + 1, audit + "R", [*out, ({"u": "user", "a": "assistant"}[c], text)])))
            for new, way in ways:
                found[new] = min(found.get(new, way), way)
        best = found
    ends = insert(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def search_repair(rows):
    search, edits = repair.Search(), []
    for role, text, fault in rows:
        edits += search.step(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        search.most_nodes = max(search.most_nodes, search.held())
    edits += search.finish()
    out = [(r, t) for e, r, t in edits if e != "D"]
    return (search.cost, "".join(e[0] for e in edits), out), search


def random_rows(rng, n):
    text = lambda: rng.choice(["a.", "b", "", "c!", "d.", "e.", "f?", f"{rng.random()}."])
    return faults([(rng.choice(["user", "assistant", "system", "tool", "user", "assistant", ""]), text()) for _ in range(n)])


def test_search_tries_everything():
    rng = random.Random(1)
    for i in range(150):
        rows = random_rows(rng, i % 4)
        want = every_repair(rows)
        assert table_repair(rows) == want, rows
        assert search_repair(rows)[0] == want, rows


def test_search_equals_table():
    rng = random.Random(2)
    for i in range(1500):
        rows = random_rows(rng, 4 + i % 40)
        assert search_repair(rows)[0] == table_repair(rows), rows


def test_search_memory_is_bounded():
    rng = random.Random(3)
    clean = [(("user", "assistant")[i % 2], f"{i}.", None) for i in range(5000)]
    noisy = [(rng.choice(["user", "assistant"]), f"{i}.", rng.choice([None, None, "blank", "truncated"])) for i in range(5000)]
    for rows in (clean, noisy, [("user", "", "blank")] * 5000):
        got, search = search_repair(rows)
        assert got == table_repair(rows)
        assert search.most_nodes < 300


def damage(rows):
    out = []
    blank = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        role, text = blank(role), blank(text)
        hit = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marked = faults([r[1:] for r in rows])
    cost, audit, out = table_repair(marked)
    numbers = {r[0] for r in rows if r[0] is not None}
    count = collections.Counter(f for *_, f in marked)
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(marked)]
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count["blank"], count["duplicate"], count["truncated"],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


def check_repair(got, rows):
    turns = collections.defaultdict(list)
    for r in rows:
        turns[r[0]] += [x[1:] for x in damage([r])]
    want = {c: report(v) for c, v in turns.items()}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r[0]], r


def test_repair_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_repair(QUERIES["op12_repair"](spark, sf).collect(), rows)


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, id string, copies int").repartition(5)


def test_repair_edge_rows(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(12), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice([None, "", "x.", "y", " \n", f"{rng.random()}!"])) for _ in range(300)]
    rows += [(None, 1, "user", "x."), (None, None, "assistant", "é😀."), (77, 3, "user", "long. " * 30_000)] + [(78, i, "user", "ok.") for i in range(50)]
    rows += [(79, 1, "user", "same.")] * 40
    got = repair.repair_reports(repair.damaged(turns_frame(spark, rows)), "id", copies=F.col("copies"))
    check_repair(got.collect(), rows)
    assert repair.repair_reports(repair.damaged(turns_frame(spark, [])), "id", copies=F.col("copies")).collect() == []


def test_repaired_edits(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (2, 0, "tool", "")]
    got = repair.repaired_edits(turns_frame(spark, rows)).orderBy("id", "place").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "D", "user", "a."), (1, 1, "K", "user", "b."), (1, 2, "K", "assistant", "c."), (2, 0, "D", "tool", ""),
    ]
    assert repair.repair_reports(turns_frame(spark, rows)).orderBy("id").first().audit == "DKK"


# --- language model


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def direct_scores(rows, order, strength):
    """rows of (text, train): tokens, known tokens, N, base score, score."""
    count = collections.Counter()
    for text, train in rows:
        t = ["<s>", *tokens(text)]
        if train:
            for m in range(1, order + 1):
                count.update(tuple(t[i : i + m]) for i in range(len(t) - m + 1))
    words = {g: c for g, c in count.items() if len(g) == 1 and g != ("<s>",)}
    n, v = sum(words.values()), len(words)

    @functools.cache
    def p(gram):
        if len(gram) == 1:
            return (words.get(gram, 0) + 1) / (n + v + 1)
        context = count[gram[:-1]]
        lower = p(gram[1:])
        return (count[gram] + strength * lower) / (context + strength) if context else lower

    out = []
    for text, _ in rows:
        t = ["<s>", *tokens(text)]
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1) : i + 1]))) for i in range(1, len(t)))
        base = sum(math.log10(p((w,))) for w in t[1:])
        out.append((len(t) - 1, sum((w,) in words for w in t[1:]), n, base, score))
    return out


def check_scores(got, want):
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-9, atol=1e-9), (a, b)


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_lm_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = direct_scores([(r.text, not held_out(r.doc_id)) for r in docs], 2, 4.0)
    got = QUERIES["op13_lm"](spark, sf).collect()
    check_scores(got, want)
    assert all(r.held_out == held_out(r.doc_id) for r in got) and any(r.held_out for r in got)
    mean = lambda c: sum(getattr(r, c) for r in got if r.held_out)
    assert mean("score") > mean("base_score")


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_small_chunks(spark, monkeypatch, order):
    rng = random.Random(order)
    words = ["a", "B", "b", "É", "it's", "x" * 50, "\x1c", " ", "1"]
    rows = [(i % 70, rng.choice([" ", "\n ", "\t", "\v\f\r"]).join(rng.choices(words, k=rng.randrange(30)))) for i in range(90)]
    rows += [(None, "a b"), (200, None), (201, ""), (202, " \n"), (203, " a b  unseen "), (204, "a b " * 20_000)]
    df = spark.createDataFrame([(i, t, i is None or i % 3 > 0, "x", 1) for i, t in rows], "doc_id bigint, text string, learn boolean, id string, chunk int")
    monkeypatch.setattr(lm, "BUCKET_KEYS", 50)
    got = lm.score(df.repartition(6), "doc_id", "text", F.col("learn") & F.col("doc_id").isNotNull(), order, 1.5).collect()
    check_scores(got, direct_scores([(t, i is not None and i % 3 > 0) for i, t in rows], order, 1.5))
    assert sorted((r.id is None, r.id) for r in got if r.id) == sorted((False, i) for i, _ in rows if i)


def test_lm_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score(df, "doc_id", "text", F.lit(True)).collect() == []
    none = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    r = lm.score(none, "doc_id", "text", F.lit(None).cast("boolean")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_lm_chunks_are_cut(monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 10)
    monkeypatch.setattr(lm, "CHUNK_TEXTS", 3)
    monkeypatch.setattr(lm, "TaskContext", type("Fixed", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 7})())}))
    texts = ["", "a", None, "b c", "one very long text", "d", "e", "f", "g", "h i j k l"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array([True] * 10), pa.array(texts)], names=["id", "train", "text"])
    out = [r for b in lm._chunks(iter([batch.slice(0, 4), batch.slice(4)])) for r in b.to_pylist()]
    assert [i for r in out for i in r["ids"]] == list(range(10))
    assert all(len(r["ids"]) <= 3 for r in out) and len({r["chunk"] for r in out}) == len(out)
    assert [lm.unpacked(r["sizes"], np.int64).tolist() for r in out if r["ids"] == [4]] == [[5]]


def test_lm_probabilities_sum_to_one():
    """Over all words and the class of unknown ones, after any context."""
    rng = np.random.default_rng(8)
    hashes = np.array([lm.BEGIN, lm.END, *range(11, 17)], np.uint64)
    known = 6
    train = [np.r_[0, rng.integers(2, 7, 12), 1] for _ in range(5)]
    probe = [np.r_[0, 2, w, 1] for w in range(2, 8)] + [np.r_[0, 2, 1]]
    chunk = [*train, *probe]
    sizes = np.array([len(t) - 1 for t in chunk])
    grams = lm.Grams(hashes, np.concatenate(chunk).astype(np.int32), np.array([True] * 5 + [False] * 7), sizes, 3)
    total = sum(len(t) - 1 for t in train)
    assert (grams.counts[0][grams.keys[0] != lm.BEGIN] > 0).sum() == known
    walk = lm.Automaton(grams, total, known, 2.0).walk()
    ends = np.cumsum(sizes)[4:]
    second = [walk[s + 1] for s in ends[:-1]]  # the token after the first word
    assert math.isclose(sum(10**w for w in second), 1.0, rel_tol=1e-12)
