"""Saves, loads, catalogs and exports: each query writes what it derives from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.operators import clean, ml
from panelflow.session import scratch_path
from panelflow.sources import artifacts, catalog, readers, writers
from panelflow.sources.commits import CommitCatalog
from panelflow.suite.registry import case, rounded


@case("s07_directory", "select o_orderkey, o_custkey, o_orderpriority, true as has_name from orders")
def s07(t):
    path = scratch_path(t.spark, "directory")
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    d.write.csv(path)
    back = readers.read_directory(t.spark, f"{path}/*.csv", d.schema, name="file")
    return back.withColumn("has_name", F.length("file") > 0).drop("file")


@case(
    "s08_versioned_save",
    """select name, count(*) as "rows", cast(sum(o_custkey) as bigint) as custkeys
    from orders, (values ('orders'), ('orders.csv'), ('orders_1'), ('orders_1.csv')) v(name) group by 1""",
)
def s08(t):
    """Two saves as tables of a commit catalog and two as CSV datasets, each under a name of its own."""
    folder = scratch_path(t.spark, "versions")
    store, d = CommitCatalog(t.spark, f"{folder}/catalog"), t.orders.select("o_orderkey", "o_custkey")
    saved = {}
    for _ in range(2):
        name = store.save(d, "orders")
        saved[name] = store.read(name)
        path = writers.save_csv(d, folder, "orders")
        saved[path.rsplit("/", 1)[-1]] = readers.read_csv(t.spark, path, d.schema)
    out = None
    for name, one in saved.items():
        one = one.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_custkey").alias("custkeys")).select(F.lit(name).alias("name"), "rows", "custkeys")
        out = one if out is None else out.unionByName(one)
    return out


@case(
    "s09_idempotent_load",
    """select 'lineitem.csv' as file, 'lineitem' as "table", count(*) as "rows", 3 as columns, 'loaded' as first, 'present' as again from lineitem
    union all select 'orders.csv', 'orders', count(*), 2, 'loaded', 'present' from orders""",
)
def s09(t):
    """Every file is loaded once, the table and the note of its file in one commit."""
    folder = scratch_path(t.spark, "loads")
    sources = {"orders": t.orders.select("o_orderkey", "o_totalprice"), "lineitem": t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")}
    files = {}
    for name, d in sources.items():
        d.write.option("header", True).csv(f"{folder}/{name}.csv")
        files[f"{name}.csv"] = (name, readers.read_csv(t.spark, f"{folder}/{name}.csv", d.schema))
    store = CommitCatalog(t.spark, f"{folder}/catalog")
    done = [store.sync(files) for _ in range(2)]
    told = [F.create_map(*[F.lit(x) for pair in d.items() for x in pair])[F.col("file")] for d in done]
    return store.manifest().drop("loaded_at").select("file", "table", "rows", "columns", told[0].alias("first"), told[1].alias("again"))


@case(
    "s10_refresh_copy",
    """select 'orders' as "table", count(*) as "rows", 2 as versions from orders where o_custkey % 3 = 0
    union all select 'lineitem', count(*), 2 from lineitem
    union all select 'orders before', count(*), 2 from orders""",
)
def s10(t):
    """Two refreshes, each one commit; an empty source keeps its table, and a reader its version."""
    store = CommitCatalog(t.spark, scratch_path(t.spark, "copies"))
    orders, lines = t.orders.select("o_orderkey", "o_custkey"), t.lineitem.select("l_orderkey", "l_linenumber")
    store.refresh({"orders": orders, "lineitem": lines})
    before = store.read("orders")
    store.refresh({"orders": orders.where("o_custkey % 3 = 0"), "lineitem": lines.where("false")})
    counts = catalog.table_counts({**store.tables(), "orders before": before})
    return counts.withColumn("versions", F.lit(len(store.versions())))


@case(
    "s11_artifacts",
    """select 'text' as file_type, count(distinct doc_id // 50) as files, count(*) as "lines", 0 as added_again from documents""",
)
def s11(t):
    """One text file for fifty documents, a line each."""
    path, store = scratch_path(t.spark, "artifacts"), scratch_path(t.spark, "artifact-catalog")
    d = t.documents.select(F.concat_ws(" ", "doc_id", "lang", "source").alias("value"), F.floor(F.col("doc_id") / 50).alias("part"))
    writers.save_texts(d, path, "part")
    artifacts.sync_artifacts(t.spark, path, store)
    again = artifacts.sync_artifacts(t.spark, path, store)
    lines = F.sum(F.size(F.split("content", "\n")) - 1).alias("lines")
    d = t.spark.read.parquet(store).groupBy("file_type").agg(F.count(F.lit(1)).alias("files"), lines)
    return d.withColumn("added_again", F.lit(again))


@case(
    "s12_union_export",
    """select o_orderkey::varchar as "_id", case when o_orderkey % 2 = 0 then o_orderpriority end as a,
       case when o_orderkey % 2 = 1 then o_custkey::varchar end as b from orders""",
)
def s12(t):
    source, target = scratch_path(t.spark, "documents"), scratch_path(t.spark, "export")
    even = F.to_json(F.struct(F.col("o_orderkey").alias("_id"), F.col("o_orderpriority").alias("a")))
    odd = F.to_json(F.struct(F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("b")))
    t.orders.select(F.when(F.col("o_orderkey") % 2 == 0, even).otherwise(odd)).write.text(source)
    path = writers.export_documents(t.spark, source, target)
    return readers.read_csv(t.spark, path, '_id string, a string, b string')


@case(
    "s14_run_registry",
    """select 1 as run_id, count(distinct o_custkey) as "rows", 'orders by customer' as source from orders
    union all select 2, count(distinct l_partkey), 'lineitem by part' from lineitem""",
)
def s14(t):
    store = CommitCatalog(t.spark, scratch_path(t.spark, "runs"))
    store.save_run(t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v")), {"source": "orders by customer"})
    store.save_run(t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("v")), {"source": "lineitem by part"})
    out = None
    for run in store.runs():
        rows, parameters = store.run(run)
        one = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(run).alias("run_id"), "rows", F.lit(parameters["source"]).alias("source"))
        out = one if out is None else out.unionByName(one)
    return out


@case("k05_limit", "select least(10, count(*)) as n from orders where o_custkey % 2 = 0")
def k05(t):
    path = scratch_path(t.spark, "orders-json")
    t.orders.select("o_orderkey", "o_custkey").write.json(path)
    d = readers.read_documents(t.spark, path, "o_orderkey long, o_custkey long", where="o_custkey % 2 = 0", limit=10)
    return d.agg(F.count(F.lit(1)).alias("n"))


@case(
    "p10_feature_target",
    """select 's_suppkey' as feature, 's_acctbal' as target, round(corr(s_suppkey, s_acctbal), 6) as r from supplier
    union all select 's_nationkey', 's_acctbal', round(corr(s_nationkey, s_acctbal), 6) from supplier""",
)
def p10(t):
    features, target = clean.features_and_target(t.supplier)
    wide = t.supplier.agg(*[F.corr(F.col(f).cast("double"), F.col(target)).alias(f) for f in features])
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(target).alias("target"), F.col(f).alias("r")) for f in features])
    return rounded(wide.select(F.inline(each)))


@case(
    "m11_estimator",
    """with fit as (
      select l_returnflag, regr_slope(l_extendedprice, l_quantity) a, regr_intercept(l_extendedprice, l_quantity) b
      from lineitem group by 1)
    select l_returnflag, count(*) n, round(avg(a * l_quantity + b), 3) mean_predicted,
           round(sqrt(avg((l_extendedprice - a * l_quantity - b) * (l_extendedprice - a * l_quantity - b))), 3) rmse
    from lineitem join fit using (l_returnflag) group by 1""",
)
def m11(t):
    path = scratch_path(t.spark, "estimator")
    ml.EntityRegression(keyCols=["l_returnflag"], featureCols=["l_quantity"], labelCol="l_extendedprice").fit(t.lineitem).write().save(path)
    d = ml.EntityRegressionModel.load(path).transform(t.lineitem)
    error = F.col("l_extendedprice") - F.col("prediction")
    d = d.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean_predicted"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
    return rounded(d, 3)
