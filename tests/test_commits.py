"""The commit catalog: several writers, writers that die, readers during changes."""

import threading

import pytest
from pyspark.sql import functions as F

from panelflow.sources import writers
from panelflow.sources.commits import CommitCatalog, Conflict
from panelflow.sources.storage import children, publish, read_text


@pytest.fixture
def catalog(spark, tmp_path):
    return CommitCatalog(spark, str(tmp_path / "catalog"))


def at_once(*jobs):
    """Results of jobs that run at the same time."""
    out, gate = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(i):
        gate.wait()
        try:
            out[i] = jobs[i]()
        except Exception as e:  # noqa: BLE001
            out[i] = e

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(jobs))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return out


def test_a_name_is_published_once(spark, tmp_path):
    path = f"{tmp_path}/deep/name"
    got = at_once(*[lambda i=i: publish(spark, path, f"writer {i} " * 1000) for i in range(8)])
    assert sorted(got) == [False] * 7 + [True]
    assert read_text(spark, path) == f"writer {got.index(True)} " * 1000
    assert children(spark, f"{tmp_path}/deep") == ["name"]


def test_writers_get_ids_of_their_own(spark, catalog):
    other = CommitCatalog(spark, catalog.root)
    ids = at_once(*[lambda c=c, i=i: c.save_run(spark.range(i + 1), {"writer": i}) for i, c in enumerate([catalog, other, catalog, other])])
    assert sorted(ids) == [1, 2, 3, 4] == catalog.runs()
    for i, run in enumerate(ids):
        rows, parameters = catalog.run(run)
        assert rows.count() == i + 1 and parameters == {"writer": str(i)}
    names = at_once(*[lambda: other.save(spark.range(3), "t") for _ in range(3)])
    assert sorted(names) == ["t", "t_1", "t_2"] == list(catalog.tables())


def test_loads_race_for_one_table(spark, catalog):
    got = at_once(*[lambda i=i: catalog.load_if_absent(spark.range(i + 1), "t", f"f{i}") for i in range(4)])
    assert sorted(got) == ["loaded", "present", "present", "present"]
    [note] = catalog.manifest().collect()
    assert note.rows == catalog.read("t").count() == got.index("loaded") + 1 and note.file == f"f{got.index('loaded')}"


def test_a_writer_that_dies_leaves_nothing_visible(spark, catalog, monkeypatch):
    catalog.refresh({"a": spark.range(2), "b": spark.range(3)})

    def dies(self, state):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(CommitCatalog, "_publish", dies)
        for change in (
            lambda: catalog.refresh({"a": spark.range(9), "b": spark.range(9)}), lambda: catalog.save_run(spark.range(1)),
            lambda: catalog.load_if_absent(spark.range(1), "c", "f"), lambda: catalog.save(spark.range(1), "a"), lambda: catalog.drop("a"),
        ):
            with pytest.raises(KeyboardInterrupt):
                change()
    assert {n: d.count() for n, d in catalog.tables().items()} == {"a": 2, "b": 3}
    assert catalog.runs() == [] and catalog.manifest().isEmpty() and catalog.versions() == [1]
    assert catalog.save_run(spark.range(1)) == 1
    assert len(catalog.vacuum(older_than=0.0)) == 5  # what the dead writers staged: 2 + 1 + 1 + 1
    assert {n: d.count() for n, d in catalog.tables().items()} == {"a": 2, "b": 3} and catalog.run(1)[0].count() == 1


def test_readers_keep_their_version(spark, catalog):
    catalog.refresh({"a": spark.range(2), "b": spark.range(3)})
    before = catalog.tables()
    assert catalog.refresh({"a": spark.range(20), "b": spark.range(0)}) == {"a": True, "b": False}
    assert {n: d.count() for n, d in before.items()} == {"a": 2, "b": 3}
    assert {n: d.count() for n, d in catalog.tables().items()} == {"a": 20, "b": 3}
    assert catalog.read("a", version=1).count() == 2
    assert catalog.append(spark.range(5), "a") == 25 == catalog.read("a").count()
    assert catalog.vacuum(keep_versions=1, older_than=3600.0) == []
    catalog.vacuum(keep_versions=1, older_than=0.0)
    assert catalog.read("a").count() == 25
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        catalog.read("a", version=1).count()


def test_appends_are_all_kept(spark, catalog):
    at_once(*[lambda i=i: catalog.append(spark.range(i, i + 1), "t") for i in range(5)])
    assert sorted(r.id for r in catalog.read("t").collect()) == [0, 1, 2, 3, 4]


def test_rules_of_names_and_ids(spark, catalog):
    for bad in (lambda: catalog.save(spark.range(1), ""), lambda: catalog.save(spark.range(0), "t")):
        with pytest.raises(ValueError):
            bad()
    assert catalog.load_if_absent(spark.range(0), "t") == "empty" and catalog.load_if_absent(spark.range(1), "t", protected=["t"]) == "protected"
    with pytest.raises(KeyError):
        catalog.read("t")
    assert [catalog.save_run(spark.range(1)) for _ in range(3)] == [1, 2, 3]
    assert catalog.remove_run(2) and not catalog.remove_run(2) and catalog.remove_run(3)
    assert catalog.save_run(spark.range(1)) == 4  # removed ids stay unused
    assert catalog.save_run(spark.range(1), first_gap=True) == 2
    assert catalog.versions() == list(range(1, len(catalog.versions()) + 1))


def test_too_many_conflicts(spark, catalog, monkeypatch):
    monkeypatch.setattr(CommitCatalog, "_publish", lambda self, state: (_ for _ in ()).throw(Conflict()))
    catalog.attempts = 3
    with pytest.raises(Conflict):
        catalog.drop("a") or catalog.save_run(spark.range(1))


def test_csv_saves_claim_their_names(spark, tmp_path):
    folder = f"{tmp_path}/csv"
    paths = at_once(*[lambda i=i: writers.save_csv(spark.range(i + 1), folder, "t.csv") for i in range(4)])
    assert sorted(p.rsplit("/", 1)[-1] for p in paths) == ["t.csv", "t_1.csv", "t_2.csv", "t_3.csv"]
    for i, p in enumerate(paths):
        assert spark.read.option("header", True).csv(p).agg(F.count("*")).first()[0] == i + 1
