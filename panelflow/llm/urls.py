"""URL filters: allow and block rules, and a logistic regression on hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise("")


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """A struct of the longest fitting rule's name and verdict; null if none fits."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<name:string,verdict:string>")


def grams(host: Column, path: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of host and path, marked with their part; digits count as one sign."""

    def of(part: Column, mark: str) -> Column:
        text = F.concat(F.lit("^"), F.regexp_replace(part, "[0-9]", "0"), F.lit("$"))
        each = [
            F.when(
                F.length(text) >= n,
                F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i, n=n: F.concat(F.lit(mark), F.substring(text, i, F.lit(n)))),
            ).otherwise(F.array().cast("array<string>"))
            for n in sizes
        ]
        return F.concat(*each)

    return F.concat(of(host, "h"), of(path, "p"))


@dataclass
class UrlModel:
    model: LogisticRegressionModel | None  # None: there was no pair of classes to learn from
    features: int
    sizes: tuple[int, ...]

    def blocked(self, pages: DataFrame) -> DataFrame:
        """Adds `p_block` to rows with host and path; null without a model."""
        if self.model is None:
            return pages.withColumn("p_block", F.lit(None).cast("double"))
        hashed = hashing(self.features).transform(pages.withColumn("grams_", grams(F.col("host"), F.col("path"), self.sizes)))
        out = self.model.transform(hashed)
        return out.select(*pages.columns, vector_to_array("probability_")[1].alias("p_block"))


def hashing(features: int) -> HashingTF:
    return HashingTF(numFeatures=features, inputCol="grams_", outputCol="vector_", binary=True)


def train(
    labelled: DataFrame, features: int = 1 << 15, sizes: tuple[int, ...] = (3, 4, 5), most: int = 20_000, penalty: float = 1e-3
) -> UrlModel:
    """Fit on `labelled` (host, path, label 0/1), a small table: at most about `most` rows of it.

    Beyond `most` distinct rows a sample by hash is taken. The sample is one sorted partition, so the
    sums of the fit have one order and a model can be made again exactly.
    """
    distinct = labelled.filter("label is not null").groupBy("host", "path").agg(F.max("label").cast("double").alias("label_"))
    n = distinct.count()
    if n > most:
        distinct = distinct.filter(F.pmod(F.xxhash64("host", "path"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    rows = distinct.repartition(1).sortWithinPartitions("host", "path")
    rows = hashing(features).transform(rows.withColumn("grams_", grams(F.col("host"), F.col("path"), sizes))).select("vector_", "label_").cache()
    try:
        sizes_of = {r["label_"]: r["count"] for r in rows.groupBy("label_").count().collect()}
        if len(sizes_of) < 2:
            return UrlModel(None, features, sizes)
        # both classes weigh the same, however many pages of each are labelled
        half = sum(sizes_of.values()) / 2
        weighted = rows.withColumn("weight_", F.when(F.col("label_") == 1, half / sizes_of[1.0]).otherwise(half / sizes_of[0.0]))
        lr = LogisticRegression(
            featuresCol="vector_", labelCol="label_", weightCol="weight_", probabilityCol="probability_", rawPredictionCol="raw_", predictionCol="predicted_",
            regParam=penalty, maxIter=60, standardization=False,
        )
        return UrlModel(lr.fit(weighted), features, sizes)
    finally:
        rows.unpersist()


def judge(
    pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", **settings
) -> DataFrame:
    """(id, host, path, rule, verdict, p_block) of every row of `pages`.

    The longest rule that fits decides; other pages go by the model, blocked from 0.5 on.
    `labelled` (url, label; 1 is block) is the small table to learn from; without it the pages that
    a rule decides are the labels. If it lacks one of both classes, pages without a rule are allowed.
    A null url, or one without `://`, has an empty host and path. Repeated rows each give a row;
    other columns are not touched.
    """
    url = F.col("url_")
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url_"))
    parts = parts.select("id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    parts = parts.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = parts.filter("hit is not null").select("host", "path", (F.col("hit.verdict") == "block").cast("int").alias("label"))
    else:
        u = F.col("url").cast("string")
        known = labelled.select(F.coalesce(host_of(u), F.lit("")).alias("host"), F.coalesce(path_of(u), F.lit("")).alias("path"), "label")
    scored = train(known, **settings).blocked(parts)
    by_model = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "id", "host", "path", F.col("hit.name").alias("rule"), F.coalesce(F.col("hit.verdict"), by_model).alias("verdict"), "p_block"
    )
