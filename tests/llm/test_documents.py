"""Queries on whole documents against brute force; the edge rows of each operator."""

import public_tokenizers
import pytest
import tiktoken

from panelflow.llm import bpe, components, decontam, simhash
from panelflow.llm.components import connected_components
from panelflow.llm.hamming import hamming_links
from panelflow.llm.queries import QUERIES, VOCABULARY
from tests.llm import reference as ref

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "a b c"), (7, "A b  c\n"), (8, "ß😀 日本 x" * 40),
    (9, "word " * 30_000), (None, "one"), (4, "one"), (10, "it's  the\n\nEnd. 12345 -- ...   "),
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 0, "kept") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, id string, component int, key string")


def library():
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return ranks, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query(spark, sf, docs):
    _, lib = library()
    rows = QUERIES["op2_bpe"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), ref.sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == ref.sha((docs[r.doc_id] or "").encode())


def test_bpe_edges(spark, odd):
    ranks, lib = library()
    rows = bpe.encode(odd, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, memo=3).collect()
    assert sorted(map(str, (r.id for r in rows))) == sorted(str(i) for i, _ in ODD)
    by_text = {tuple(r.ids) for r in rows}
    assert by_text == {tuple(lib.encode_ordinary(t or "")) for _, t in ODD}
    assert bpe.encode(odd.limit(0), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).count() == 0
    for piece in ("a" * 50_001, "ab" * 20_000, "0af3" * 999, "x" * 199 + "yz" * 40):
        assert list(bpe.merge_piece(piece.encode(), ranks)) == lib.encode_ordinary(piece)


def test_simhash_query(spark, sf, docs):
    rows = QUERIES["op7_simhash_near_dedup"](spark, sf).collect()
    prints = {i: ref.simhash(t) for i, t in docs.items()}
    want = ref.components(sorted(docs), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", want[i]) for i in docs
    }


def test_simhash_edges(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = {(r.id, r.component) for r in rows}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (None, 4)} <= got
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component for r in rows})
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_links_of_a_split_shard(spark):
    """A hot key with many trees gives the same components as one tree."""
    import random

    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {(rng.choice(seeds) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6)))) % 2**64 for _ in range(600)}
    rows = [(i, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(sorted(prints))]
    df = spark.createDataFrame(rows, "node bigint, fp bigint").repartition(3)
    bits = {i: p % 2**64 for i, p in rows}
    want = ref.components(sorted(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 4)
    for shard in (5, 1000):
        got = {r.node: r.component for r in connected_components(hamming_links(df, 4, 6, 2, shard)).collect()}
        assert {i: got.get(i, i) for i in bits} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, x) for x in range(1001, 1200)] + [(5, 5), (None, 3), (2, 1)]
    df = spark.createDataFrame(chain, "src bigint, dst bigint").repartition(7)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}
    assert connected_components(df.limit(0)).count() == 0


def test_decontamination_query(spark, sf, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r in QUERIES["op9_decontamination"](spark, sf).collect():
        n, hit, found = ref.decontaminate(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(found), ref.sha(",".join(found)), hit > 0,
        )


def test_decontamination_edges(spark, odd):
    items = [(1, None), (2, ""), (3, "One"), (4, "a, B"), (5, "word " * 12), (6, "a b c"), (6, "a b c"), (None, "one"), (7, "absent here")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, id int")
    own = [(i, t) for i, t in items if i is not None]
    for block in (3, 100):
        rows = decontam.benchmark_hits(odd, bench, block=block).collect()
        got = sorted((str(r.id), r.n_words, r.n_hit, r["items"]) for r in rows)
        assert got == sorted((str(i), *ref.decontaminate(t, own)) for i, t in ODD)
        assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_hit for r in rows)
    assert decontam.benchmark_hits(odd.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontam.benchmark_hits(odd, bench.limit(0)).collect()} == {0}


def test_links_need_one_python_worker(spark, odd, monkeypatch):
    """The stage that makes links hands them to no second worker."""
    plans = []
    keep = components.materialised

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(components, "materialised", seen)
    simhash.near_duplicates(odd).count()
    assert plans and not any("MapInPandas" in p for p in plans) and plans[0].count("MapInArrow") == 1
