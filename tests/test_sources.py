"""Sources, sinks and catalog, including running them twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelflow import session
from panelflow.functions import scalars
from panelflow.sources import artifacts, catalog, readers, storage, ticks, writers


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_csv(spark, tmp_path):
    p = write(tmp_path / "a.csv", "k,v\na,1.5\nb,NaN\nc,\n")
    got = readers.read_csv(spark, p, "k string, v double").collect()
    assert [r["v"] for r in got] == [1.5, None, None]
    with pytest.raises(FileNotFoundError):
        readers.read_csv(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("sep,encoding", [(",", "utf-8"), (";", "utf-8"), (";", "utf-8-sig"), (",", "utf-8-sig")])
def test_csv_sniffed(spark, tmp_path, sep, encoding):
    p = write(tmp_path / "a.csv", f"k{sep}v\na{sep}2\n", encoding)
    df = readers.read_csv_sniffed(spark, p)
    assert df.columns == ["k", "v"] and df.first()["v"] == 2


def test_documents(spark, tmp_path):
    p = write(tmp_path / "d.json", '{"_id": 1, "a": 5}\n{"_id": "x", "b": {"c": 1}}\n{"_id": 3, "a": 9}\n')
    df = readers.read_documents(spark, p, where="a > 4", limit=1)
    assert df.count() == 1 and dict(df.dtypes)["_id"] == "string"
    out = writers.export_documents(spark, p, str(tmp_path / "out"))
    got = spark.read.option("header", True).csv(out)
    assert got.columns == ["_id", "a", "b"] and got.where("_id = 'x'").first()["b"] == '{"c":1}'


LINES = [
    "2025-12-16 03:34:14|US.100+|24862.340000|24864.190000", "2025-12-16 03:34:15|X|2|1", "2025-12-16 03:34:15|X|0|1",
    "2025-12-16 03:34:15|X|abc|1", "2025-12-16 03:34:15|X|1", "no time|X|1|2", "2025-12-16 03:34:15|X|nan|nan",
    "  2025-12-16 03:34:16|X|1|1  ", "2025-12-16 03:34:15|X|1|2|3",
]


def test_tick_lines(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = {r["instrument"]: r for r in ticks.ticks_from_lines(lines).collect()}
    assert set(got) == {"US.100+", "X"}
    assert got["US.100+"]["mid"] == pytest.approx(24863.265) and got["US.100+"]["spread"] == pytest.approx(1.85)
    assert got["X"]["ts"] == dt.datetime(2025, 12, 16, 3, 34, 16)
    bad = {r["value"]: r["reason"] for r in ticks.rejects(lines).collect()}
    assert len(bad) == len(LINES) - 2
    assert bad[LINES[1]] == "ask below bid" and bad[LINES[5]] == "bad time" and bad[LINES[8]] == "field count"
    assert bad[LINES[6]] == "price not numeric" and bad[LINES[2]] == "bid not positive"
    assert dict(ticks.stored_prices(ticks.ticks_from_lines(lines)).dtypes)["mid"] == "float"


def test_bar_directory(spark, tmp_path):
    write(tmp_path / "bars" / "EURUSD.csv", "2024.01.02,10:00,1,3,0.5,2,10\nbad,10:00,1,3,0.5,2,10\n")
    write(tmp_path / "bars" / "US100.csv", "2024.01.02,10:01,10,30,5,20,10\n")
    got = {r["instrument"]: r for r in ticks.read_bar_csv(spark, str(tmp_path / "bars")).collect()}
    assert set(got) == {"EURUSD", "US100"}
    assert got["EURUSD"]["bid"] == got["EURUSD"]["mid"] == 2 and got["EURUSD"]["spread"] == 2.5
    assert got["US100"]["ts"] == dt.datetime(2024, 1, 2, 10, 1) and got["US100"]["source"] == "historical"
    one = ticks.read_bar_csv(spark, str(tmp_path / "bars" / "US100.csv"), "NDX").first()
    assert one["instrument"] == "NDX"
    raw = readers.read_directory(spark, str(tmp_path / "bars/*.csv"), ticks.BAR_SCHEMA)
    assert {r[0] for r in raw.select("instrument").distinct().collect()} == {"EURUSD", "US100"}


@pytest.mark.parametrize("keep,price", [("first", 1.0), ("last", 9.0)])
def test_append_merge(spark, tmp_path, keep, price):
    path = str(tmp_path / "ticks")

    def batch(seq, rows):
        d = spark.createDataFrame(rows, "ts timestamp, instrument string, bid double, ask double")
        return d.withColumns({"mid": (F.col("bid") + F.col("ask")) / 2, "seq": F.lit(seq)})

    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    ticks.append_merge(spark, batch(1, [(t0, "A", 1.0, 2.0), (t1, "A", 5.0, 6.0), (t0, "B", 7.0, 8.0)]), path, keep)
    second = batch(2, [(t0, "A", 9.0, 10.0), (t0, "C", 3.0, 4.0)])
    for _ in range(2):  # the same batch twice changes nothing
        ticks.append_merge(spark, second, path, keep)
        got = {(r["instrument"], r["ts"]): r["bid"] for r in spark.read.parquet(path).collect()}
        assert got == {("A", t0): price, ("A", t1): 5.0, ("B", t0): 7.0, ("C", t0): 3.0}


def _files_read(df):
    """Files that the scans of a frame opened."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution()
        plan.toRdd().count()
        leaves = plan.executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return sum(s.metrics().apply("numFiles").value() for s in scans if s.metrics().contains("numFiles"))
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("named", [5000, 2])
def test_append_merge_reads_touched_partitions_only(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(ticks, "NAMED_PARTITIONS", named)
    path, day = str(tmp_path / "ticks"), dt.timedelta(days=1)
    row = lambda i, name, seq, bid: (dt.datetime(2024, 1, 1) + i * day, name, bid, bid + 1, bid, 1.0, seq)
    shape = "ts timestamp, instrument string, bid double, ask double, mid double, spread double, seq int"
    old = [row(i, name, 1, 1.0) for i in range(30) for name in ("007", "A/B", "plain")]
    ticks.append_merge(spark, spark.createDataFrame(old, shape), path)
    everything = spark.read.parquet(path)
    assert _files_read(everything) == 90
    new = [row(4, "007", 2, 5.0), row(4, "A/B", 2, 6.0), row(5, "007", 2, 7.0), row(40, "new", 2, 8.0)]
    batch = spark.createDataFrame(new, shape).withColumn("date", F.to_date("ts"))
    stored = ticks.stored_partitions(spark, path, batch)
    assert sorted((r.instrument, r.date.day) for r in stored.collect()) == [("007", 5), ("007", 6), ("A/B", 5)]
    assert _files_read(stored) == (3 if named == 5000 else 78)  # all of the 26 days from the first touched one
    ticks.append_merge(spark, spark.createDataFrame(new, shape), path, keep="last")
    got = {(r.instrument, r.ts): r.bid for r in spark.read.parquet(path).collect()}
    assert len(got) == 91
    first = {(r[1], r[0]): r[2] for r in old} | {(r[1], r[0]): r[2] for r in new}
    assert got == first


def test_versioned_saves(spark, tmp_path):
    d = spark.range(3)
    folder = str(tmp_path)
    names = [writers.save_csv(d, folder, n).rsplit("/", 1)[1] for n in ("x", "x.csv", "x")]
    assert names == ["x.csv", "x_1.csv", "x_2.csv"]
    with pytest.raises(ValueError, match="name"):
        writers.save_csv(d, folder, "")
    assert [writers.save_table(d, "saved_rows") for _ in range(2)] == ["saved_rows", "saved_rows_1"]
    with pytest.raises(ValueError, match="empty"):
        writers.save_table(d.limit(0), "saved_rows")


def test_run_registry(spark, tmp_path):
    p = str(tmp_path / "runs")
    d = spark.createDataFrame([("r2", 0.5)], "metric string, value double")
    assert [writers.save_run(d, p, {"trees": "200"}) for _ in range(3)] == [1, 2, 3]
    import shutil

    shutil.move(f"{p}/results/run_id=2", str(tmp_path / "gone"))
    assert writers.next_run_id(spark, f"{p}/results") == 4
    assert writers.first_free_run_id(spark, f"{p}/results") == 2
    assert spark.read.parquet(f"{p}/parameters").where("run_id = 1").first()["value"] == "200"


def test_idempotent_load(spark, tmp_path):
    files = {
        write(tmp_path / "one.csv", "a,b\n1,2\n3,4\n"): "load_one",
        write(tmp_path / "none.csv", "a,b\n"): "load_none",
        write(tmp_path / "keep.csv", "a,b\n1,2\n"): "guarded",
    }
    first = catalog.sync_csv_files(spark, files, "load_manifest", ["guarded"])
    assert sorted(first.values()) == ["empty", "loaded", "protected"]
    again = catalog.sync_csv_files(spark, files, "load_manifest", ["guarded"])
    assert sorted(again.values()) == ["empty", "present", "protected"]
    catalog.record_load(spark, "load_manifest", "one.csv", "load_one")
    m = catalog.read_manifest(spark, "load_manifest").collect()
    assert [(r["file"], r["table"], r["rows"], r["columns"]) for r in m] == [("one.csv", "load_one", 2, 2)]
    assert "load_one" in catalog.catalog_tables(spark)


def test_refresh_and_search(spark, tmp_path):
    target = str(tmp_path / "copy")
    a = spark.createDataFrame([("Poland", 1990, 2.0), ("Poland", 1991, 4.0), ("Chad", 1990, 1.0)], "country string, year int, v double")
    assert catalog.refresh_copy({"a": a}, target) == {"a": True}
    assert catalog.refresh_copy({"a": a.limit(0)}, target) == {"a": False}
    assert spark.read.parquet(f"{target}/a").count() == 3
    hits = catalog.tables_with_entity({"a": a, "b": a.where("year > 1995"), "c": a.drop("country")}, "country", "Poland")
    assert [tuple(r) for r in hits.collect()] == [("a", 2)]
    assert [r["year"] for r in catalog.entity_rows(a, "country", "Poland", "year").collect()] == [1990, 1991]
    assert tuple(catalog.entity_stats(a, "country", "Poland", "v").first()) == (2.0, 4.0, 3.0)


def test_artifacts(spark, tmp_path):
    root, cat = str(tmp_path / "results"), str(tmp_path / "catalog")
    write(tmp_path / "results" / "run_001" / "report.txt", "héllo")
    (tmp_path / "results" / "run_001" / "plot.PNG").write_bytes(b"\x89PNG")
    write(tmp_path / "results" / "model.pkl", "no")
    assert artifacts.sync_artifacts(spark, root, cat) == 2
    assert artifacts.sync_artifacts(spark, root, cat) == 0
    write(tmp_path / "results" / "more.csv", "a")
    assert artifacts.sync_artifacts(spark, root, cat) == 1
    got = {r["file_path"]: r for r in spark.read.parquet(cat).collect()}
    assert set(got) == {"run_001/report.txt", "run_001/plot.PNG", "more.csv"}
    assert got["run_001/report.txt"]["content"] == "héllo" and got["run_001/report.txt"]["size_bytes"] == 6
    assert bytes(got["run_001/plot.PNG"]["binary"]) == b"\x89PNG" and got["run_001/plot.PNG"]["file_type"] == "image"


def test_scalars(spark):
    d = spark.createDataFrame([("file:/a/b/Some File.TXT", "United States", 2001, "1.5", "x", float("nan"))],
                              "p string, n string, y int, ok string, bad string, nan double")
    r = d.select(
        scalars.base_name("p").alias("base"), scalars.extension("p").alias("ext"), scalars.stem("p").alias("stem"),
        scalars.relative_path("p", "/a").alias("rel"), scalars.slug("n").alias("slug"), scalars.safe_name("n").alias("safe"),
        scalars.entity_code("n").alias("code"), scalars.year_start("y").alias("day"), scalars.safe_double("ok").alias("ok"),
        scalars.safe_double("bad").alias("bad"), scalars.clean_double("nan").alias("nan"),
        scalars.percent(F.lit(1), F.lit(3)).alias("pct"), scalars.ratio(F.lit(1), F.lit(0)).alias("none"),
    ).first()
    assert tuple(r) == (
        "Some File.TXT", "txt", "Some File", "b/Some File.TXT", "united_states", "United_States", "UNI",
        dt.date(2001, 1, 1), 1.5, None, None, 33.3, None,
    )


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.children(spark, session.scratch_path(spark, "nothing")) == []


def test_save_texts(spark, tmp_path):
    """One flat file for each value, so that neither the writer nor a listing pays for a folder a file; the first sync scans the root."""
    from unittest import mock

    d = spark.createDataFrame([(i // 3, f"line {i} é") for i in range(100)] + [(None, "x"), (None, "y"), (1, None)], "part long, value string")
    folder, store = str(tmp_path / "texts"), str(tmp_path / "catalog")
    assert writers.save_texts(d, folder, "part") == 35
    files = {p.name: p.read_text("utf-8") for p in (tmp_path / "texts").iterdir()}
    assert len(files) == 35 and sorted(files["part-1.txt"].split("\n")) == ["", "", "line 3 é", "line 4 é", "line 5 é"]
    assert sorted(files["part-null.txt"].split()) == ["x", "y"]
    with mock.patch.object(artifacts, "with_contents", wraps=artifacts.with_contents) as seen:
        assert artifacts.sync_artifacts(spark, folder, store) == 35 and seen.call_args.kwargs["whole"]
        (tmp_path / "texts/more.txt").write_text("z")
        assert artifacts.sync_artifacts(spark, folder, store) == 1 and not seen.call_args.kwargs["whole"]
    assert artifacts.sync_artifacts(spark, folder, store) == 0
    assert spark.read.parquet(store).count() == 36
