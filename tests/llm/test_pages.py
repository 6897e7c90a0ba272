"""URL filters, language ID, archives and the pipeline."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from panelflow.llm import langid, urls, warc
from panelflow.llm.queries import QUERIES, URL_RULES
from panelflow.session import scratch_path
from tests.llm import reference as ref
from tests.llm.test_documents import ODD, docs, odd  # noqa: F401


def test_url_query(spark, sf):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op5_urls"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.host, r.path) == ref.host_path(pages[r.page_id])
        fits = [x for x in URL_RULES if (r.host == x.host or r.host.endswith("." + x.host)) and r.path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert r.rule == (best.name if best else None) and r.verdict in ("allow", "block")
        assert best is None or r.verdict == best.verdict


def test_url_edges(spark):
    odd_urls = [None, "", "a.com/x", "http://", "HTTP://A.Com", "x://Ä.COM/en/?q://z", "://com/", "http://u@b.com:80/p#f", "a://b?c/d", "a\nb://c\nd/e\nf", "http://example.com/en/" + "x" * 50_000]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(odd_urls)], "page_id int, url string, host string, rule string")
    rows = urls.judge(df, URL_RULES).collect()
    assert {r.id: (r.host, r.path) for r in rows} == {i: ref.host_path(u) for i, u in enumerate(odd_urls)}
    assert {r.verdict for r in urls.judge(df, []).collect()} == {"allow"}
    assert urls.judge(df.limit(0), URL_RULES).count() == 0


def test_url_model_learns(spark):
    rng = random.Random(3)
    bad, good = ["casino", "pills", "winbig"], ["garden", "museum", "school"]
    url = lambda names: f"http://{rng.choice(names)}{rng.randrange(100)}.{rng.choice(['org', 'info'])}/{rng.choice(names)}/{rng.randrange(10**6)}"
    rows = [(i, url(bad if i % 2 else good), i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id int, url string, label int")
    labelled, held = df.filter("page_id < 300").select("url", "label"), df.filter("page_id >= 300")
    got = urls.judge(held, [], labelled).collect()
    assert sum((r.verdict == "block") == bool(r.id % 2) for r in got) >= 295
    again = urls.judge(held, [], labelled.repartition(5)).collect()
    assert {r.id: r.p_block for r in got} == {r.id: r.p_block for r in again}


def test_language_query(spark, sf, docs):  # noqa: F811
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_language"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_phrases_match_brute_force():
    rng = random.Random(8)

    def parse(text, sample):
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
        return n

    for _ in range(200):
        sample = "".join(rng.choice("abc ") for _ in range(rng.randrange(60)))
        auto = langid.SuffixAutomaton(sample)
        text = "".join(rng.choice("abcd ") for _ in range(30))
        assert auto.phrases(text) == parse(text, sample)
        assert len(auto.next) <= max(2, 2 * len(sample))


def test_language_edges(spark, odd):  # noqa: F811
    train = spark.createDataFrame([("the cat and the dog", "en", 1), ("le chat et le chien", "fr", 2), (None, "de", 3), ("x", None, 4)], "text string, lang string, doc_id int")
    samples = langid.learn(train, "text", "lang", "doc_id")
    assert set(samples) == {"en", "fr"}
    rows = langid.predict(odd, samples).collect()
    assert len(rows) == len(ODD)
    assert {r.id: r.lang_pred for r in rows if r.id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}
    assert langid.learn(train.limit(0), "text", "lang", "doc_id") == {}
    long = langid.learn(train.withColumn("text", F.repeat("text", F.lit(9000))), "text", "lang", "doc_id", chars=5000)
    assert {len(t) for t in long.values()} == {5001}


def test_warc_query(spark, sf):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    rows = QUERIES["op8_warc"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id]
        again = len(body) >= 100 and first[body] != r.page_id
        want = (len(body), ref.sha(body), "revisit" if again else "response", first[body] if again else None)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want


@pytest.fixture(scope="module")
def archive(spark):
    html = ["<p>é</p>" * 40, "tiny", None, "", "<p>é</p>" * 40, "tiny", "x" * 3_000_000, "\r\n\r\nWARC/1.1\r\n\r\n" * 30]
    rows = [(i, f"http://a/{i}" if i else None, h, "k") for i, h in enumerate(html)]
    rows += [(None, "u\r\nv%0A", html[0], "k"), (4, "http://a/4", html[4], "k")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, digest string").repartition(3)
    path = scratch_path(spark, "warc")
    warc.register(spark)
    writer = warc.page_records(df).write.format("warc").mode("append").option("filebytes", 2000).option("splitbytes", 500)
    writer.save(path)
    return rows, path


def test_warc_round_trip(spark, archive):
    rows, path = archive
    got = spark.read.format("warc").option("partitionbytes", 600).load(path).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.record_id, []).append(r)
    for i, url, html, _ in rows[:8]:
        for r in by_id[f"<urn:page:{i}>"]:
            assert r.payload_bytes == len((html or "").encode()) and r.target_uri == url
            again = i == 4
            assert r.record_type == ("revisit" if again else "response") and r.refers_to == ("<urn:page:0>" if again else None)
            assert r.payload is None if again else bytes(r.payload) == (html or "").encode()
    lost = by_id["<urn:page:>"][0]
    assert (lost.record_type, lost.refers_to, lost.target_uri) == ("revisit", "<urn:page:0>", "u\r\nv%0A")
    assert len(by_id["<urn:page:4>"]) == 2


def test_warc_pushdown(spark, archive):
    """Predicates reach the reader, and what they reject is not decoded."""
    from pyspark.sql.datasource import EqualTo, In, IsNull

    rows, path = archive
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("record_id",), ("<urn:page:4>",)), IsNull(("date",))]))
    assert left == [IsNull(("date",))]
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in got] == ["<urn:page:4>"] * 2
    df = spark.read.format("warc").option("payload", "false").load(path).filter("record_type = 'response' and payload_bytes > 100")
    assert df.count() == 3 and df.filter("payload is not null").isEmpty()


def test_warc_other_archives(spark, tmp_path):
    """Plain archives, and gzip members without sizes, as other tools write them."""
    import gzip

    row = {"record_type": "response", "record_id": "<urn:x:1>", "date": None, "target_uri": "http://b/", "payload_digest": None, "refers_to": None, "payload": b"body" * 50_000, "payload_bytes": None}
    one, two = warc.record_bytes(row), warc.record_bytes(row | {"record_id": "<urn:x:2>", "payload": b"small"})
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(one) + gzip.compress(two))
    warc.register(spark)
    df = spark.read.format("warc").load(str(tmp_path))
    assert sorted((r.record_type, r.record_id or "", r.payload_bytes or 0) for r in df.collect()) == sorted(
        [("warcinfo", "", 3), ("response", "<urn:x:1>", 200_000), ("response", "<urn:x:2>", 5)] * 2
    )
    assert df.filter("record_id = '<urn:x:2>'").select("payload").distinct().collect()[0][0] == b"small"
    empty = scratch_path(spark, "warc")
    warc.page_records(spark.createDataFrame([], "page_id int, url string, html string")).write.format("warc").mode("append").save(empty)
    assert spark.read.format("warc").load(empty).count() == 0


def test_language_samples_are_full(spark):
    """A language of one or few long texts, or of texts that are mostly blanks, is learned wherever its hashes fall."""
    rows = [(f"word{i} " * 20_000, f"l{i}", i) for i in range(12)]
    rows += [("a b " * 40_000, "few", 100 + i) for i in range(3)]
    rows += [("x" + " " * 900 if i else "y" * 90_000, "blank", 200 + i) for i in range(300)]
    train = spark.createDataFrame(rows, "text string, lang string, doc_id int")
    samples = langid.learn(train, "text", "lang", "doc_id", chars=5000)
    assert set(samples) == {f"l{i}" for i in range(12)} | {"few", "blank"}
    assert all(5000 <= len(t) <= 5001 for lang, t in samples.items())
