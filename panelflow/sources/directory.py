"""Datasets whose files may be broken: a bad file becomes a row with its reason, the others are read.

A dataset is read as a whole first. Only if that fails are its files looked for, by halves: a half that can be read is done
with, the other is halved again. So b bad ones of n files cost about 2 b log2(n) partial reads, and a sound dataset none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.operators.profile import table_profile
from panelflow.session import materialised
from panelflow.sources.storage import files_below

FAILURES = (PySparkException, Py4JJavaError)
Reader = Callable[[Sequence[str]], DataFrame]
#: Spark's name of an error, as its messages begin.
CONDITION = re.compile(r"\[([A-Z][A-Z0-9_]+(?:\.[A-Z0-9_]+)*)\]")
PROFILE = "dataset string, column string, metric string, value string"


def reason(error: Exception) -> str:
    """Spark's name for what went wrong, the innermost one without its class; else the kind of error."""
    named = CONDITION.findall(str(error))
    return named[-1].rsplit(".", 1)[-1] if named else type(error).__name__


def reader(spark: SparkSession, fmt: str = "parquet", schema=None, **options) -> Reader:
    """A function that reads a list of files; malformed records of text formats fail their file."""
    r = spark.read.format(fmt).options(**({"mode": "FAILFAST"} if fmt in ("csv", "json") else {}), **options)
    r = r.schema(schema) if schema is not None else r
    return lambda paths: r.load(list(paths))


def probe(read: Reader, files: Sequence[str]) -> str | None:
    """Read every value of the files; the reason if that fails."""
    try:
        df = read(files)
        # Values are counted after a look at their bytes, so that none is left undecoded.
        df.agg(*[F.bit_xor(F.xxhash64(c)) for c in df.columns], F.count(F.lit(1))).collect()
    except FAILURES as e:
        return reason(e)
    return None


def bad_files(read: Reader, files: Sequence[str]) -> list[tuple[str, str]]:
    """(file, reason) of the files that cannot be read, each found by itself."""
    why = probe(read, files)
    if why is None:
        return []
    if len(files) == 1:
        return [(files[0], why)]
    half = len(files) // 2
    return bad_files(read, files[:half]) + bad_files(read, files[half:])


def read_sound(spark: SparkSession, path: str, read: Reader) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """The readable files of a dataset as a frame (None if there are none), and (file, reason) of the others."""
    files = files_below(spark, path)
    bad = bad_files(read, files) if files else [(path, "no files")]
    broken = {f for f, _ in bad}
    good = [f for f in files if f not in broken]
    return (read(good) if good else None), bad


def _profile(spark: SparkSession, name: str, path: str, read: Reader) -> list[DataFrame]:
    errors: list[tuple[str, str]] = []
    try:
        out = [materialised(table_profile(read([path]), name), "profile")]
    except FAILURES as e:
        sound, errors = read_sound(spark, path, read)
        if not errors:
            raise e
        out = [] if sound is None else [materialised(table_profile(sound, name), "profile")]
    if errors:
        rows = [(name, f.rsplit("/", 1)[-1], "error", why) for f, why in errors]
        out.append(spark.createDataFrame(rows, PROFILE))
    return out


def profile_directory(spark: SparkSession, datasets: Mapping[str, str], read: Reader | None = None, at_once: int = 4) -> DataFrame:
    """(dataset, column, metric, value) of every dataset, and of every broken file a row (dataset, file, ``error``, reason).

    One job for each sound dataset, `at_once` side by side: its profile, which is as long as its schema, is written to the
    shared folder, and reading all its values is what shows that it is sound. A failure that no file explains is raised.
    """
    read = read or reader(spark)
    out = spark.createDataFrame([], PROFILE)
    with ThreadPoolExecutor(at_once) as pool:
        for parts in pool.map(lambda item: _profile(spark, *item, read), datasets.items()):
            for p in parts:
                out = out.unionByName(p)
    return out
