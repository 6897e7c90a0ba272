"""Compare a registered query with its SQL twin; also a command: python tests/oracle.py [sf] [names]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def connect(root: str):
    con = duckdb.connect()
    for f in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(f).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{f}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]) or pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("float64")
        elif not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT else str(v)[:10] if hasattr(v, "year") else v)
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = normal(spark_df), normal(sql_df)
    try:
        pd.testing.assert_frame_equal(a, b, check_dtype=False, check_exact=True)
    except AssertionError as e:
        bad = ~((a == b) | (a.isna() & b.isna())).all(axis=1)
        return f"{bad.sum()} rows differ: {str(e)[-300:]}\n{a[bad].head(3)}\n{b[bad].head(3)}"
    return None


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    root = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for n in names:
        start = time.time()
        try:
            got = entry.queries()[n](spark, root).toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(n)
            if sql is None:
                print(f"rows  {n} {len(got)} {took:.2f}s", flush=True)
                continue
            msg = difference(got, con.execute(sql).df())
        except Exception as e:  # noqa: BLE001
            took, msg = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
        bad += msg is not None
        print(f"{'ok   ' if msg is None else 'FAIL '} {n} {took:.2f}s {msg or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
