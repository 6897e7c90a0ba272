"""Profiles of datasets with broken files."""

import pytest
from pyspark.sql import functions as F

from panelflow.operators import profile
from panelflow.sources import directory
from panelflow.sources.storage import files_below


def write_parts(spark, folder, parts, rows=10):
    for i in range(parts):
        spark.range(i * rows, (i + 1) * rows).selectExpr("id", "cast(id % 3 as string) s").coalesce(1).write.mode("append").parquet(folder)


def add_broken(folder, *names):
    folder.mkdir(exist_ok=True)
    for n in names:
        (folder / n).write_bytes(b"PAR1 and no more")
    return set(names)


def test_bad_files_become_rows(spark, tmp_path):
    good, mixed, gone = (str(tmp_path / n) for n in ("good", "mixed", "gone"))
    write_parts(spark, good, 2)
    write_parts(spark, mixed, 9)
    broken = add_broken(tmp_path / "mixed", "a.parquet", "part-5.parquet", "z.parquet")
    add_broken(tmp_path / "gone", "1.parquet", "2.parquet")
    assert len(files_below(spark, mixed)) == 12
    rows = directory.profile_directory(spark, {"good": good, "mixed": mixed, "gone": gone, "absent": str(tmp_path / "absent")}).collect()
    errors = {(r.dataset, r.column): r.value for r in rows if r.metric == "error"}
    assert {c for d, c in errors if d == "mixed"} == broken and len([1 for d, _ in errors if d == "gone"]) == 2
    assert errors[("absent", "absent")] == "no files" and not any(d == "good" for d, _ in errors)
    assert all(v == "CANNOT_READ_FILE_FOOTER" for (d, _), v in errors.items() if d != "absent")
    counts = {r.dataset: r.value for r in rows if r.metric == "rows"}
    assert counts == {"good": "20", "mixed": "90"}


def test_sound_datasets_are_read_once(spark, tmp_path, monkeypatch):
    write_parts(spark, str(tmp_path / "a"), 3)
    monkeypatch.setattr(directory, "probe", lambda *a: pytest.fail("a sound dataset was probed"))
    assert directory.profile_directory(spark, {"a": str(tmp_path / "a")}).count() > 10


def test_malformed_text_fails_its_file(spark, tmp_path):
    folder = str(tmp_path / "csv")
    for lines in (["1,a", "2,b"], ["3,c", "x,d,e,f"], ["5,e"]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
    read = directory.reader(spark, "csv", "n int, s string")
    found, bad = directory.read_sound(spark, folder, read)
    assert sorted(r.n for r in found.collect()) == [1, 2, 5] and len(bad) == 1 and "MALFORMED" in bad[0][1]


def test_a_failure_without_a_bad_file_is_raised(spark, tmp_path):
    write_parts(spark, str(tmp_path / "a"), 1)
    sound = directory.reader(spark)
    read = lambda paths: sound(paths) if paths[0].endswith(".parquet") else sound(paths).select(F.raise_error("broken plan").alias("x"))
    with pytest.raises(Exception, match="broken plan"):
        directory.profile_directory(spark, {"a": str(tmp_path / "a")}, read)


def test_table_profile(spark):
    rows = [(3, None, [1.0, 2.0], "x" * 100), (1, 2.5, [1.0, 2.0], "x" * 100), (1, 2.5, [1.0, 2.0], "x" * 100), (2, 4.0, None, "x" * 99 + "y")]
    d = profile.table_profile(spark.createDataFrame(rows, "k int, v double, a array<double>, t string"), "d")
    got = {(r.column, r.metric): r.value for r in d.collect()}
    assert got[("", "rows")] == "4" and got[("", "duplicates")] == "1" and got[("", "columns")] == "4"
    assert got[("a", "type")] == "array<double>" and got[("t", "distinct")] == "2" and got[("a", "distinct")] == "2" and got[("v", "missing")] == "1"
    assert [got[("k", f"first_{i}")] for i in range(1, 5)] == ["1", "1", "2", "3"] and got[("a", "first_3")] is None
    assert got[("v", "first_1")] == "2.5000" and got[("t", "first_1")] == "x" * 60
    assert got[("v", "q50")] == "2.5000" and got[("", "linear_verdict")] == "yes" and got[("", "reasons")] == "few_rows"


def test_profile_of_an_empty_table(spark):
    got = {(r.column, r.metric): r.value for r in profile.table_profile(spark.createDataFrame([], "k int, s string"), "e").collect()}
    assert got[("", "rows")] == "0" and got[("", "duplicates")] == "0" and ("k", "first_1") not in got


@pytest.mark.parametrize("n", [1, 7, 9_999, 10_001, 25_000])
def test_quantiles_on_both_sides_of_the_sketch(spark, n):
    d = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"))
    points = [0.0, 0.0003, 0.25, 0.5, 0.9997, 1.0]
    got = profile.exact_quantiles(d, ["v"], points).first().q
    assert all(abs(g - (n - 1) * p) < 1e-6 for g, p in zip(got, points, strict=True))
