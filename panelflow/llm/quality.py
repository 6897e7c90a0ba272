"""Quality rules on word statistics, and robust multivariate outliers, with SQL functions only.

The minimum-covariance-determinant estimate of a group is reached by concentration steps:
distances of all rows, the `share` of rows with the smallest ones, their mean and covariance, again
until no determinant shrinks. All groups and both starts take each step in one pass of
aggregates over the compact statistics; the subset's limit comes from a histogram of
the distances, so no group is ever gathered or sorted.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelflow.session import materialised

SPACES = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

#: The vector: its parts and the least standard deviation that each is taken to have.
PARTS = {"x_words": 0.3, "x_length": 0.08, "x_symbols": 0.3, "x_lines": 0.15, "x_repeats": 0.12}

Q = list(PARTS)
P = len(Q)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE + "+", -1)).otherwise(F.array().cast("array<string>"))


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; `w` is an array column.

    Windows are compared by 64-bit hashes. They are sorted only where some hash repeats.
    """
    at = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda s: F.filter(
                s,
                lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)),
            ),
        )
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(w) >= 4, count).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Counts of every row, the base verdict and the transformed vector."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(lang_col)), F.lit("-")).alias("lang_key"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("-")).alias("source_key"),
    )
    parts = rows.select(
        "id",
        "lang_key",
        "source_key",
        F.xxhash64("text").alias("text_hash"),
        word_array(text).alias("w"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    counts = parts.select(
        "id",
        "lang_key",
        "source_key",
        "text_hash",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    )
    n, failed = F.col("n_words"), (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    share = F.least(F.lit(1.0), F.col("n_repeat_words") / F.greatest(n, F.lit(1)))
    return counts.select(
        "*",
        failed.alias("base_failed"),
        F.log1p(n).alias("x_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(n, F.lit(1))).alias("x_length"),
        F.log1p(100 * F.col("n_symbols") / F.greatest(n, F.lit(1))).alias("x_symbols"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("x_lines"),
        F.asin(F.sqrt(share)).alias("x_repeats"),
    )


def _gamma_p(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 500.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_p(df / 2, mid / 2) < p else (lo, mid)
    return lo


def consistency(share: float) -> float:
    """What makes the covariance of the central `share` unbiased for normal rows."""
    return share / _gamma_p(P / 2 + 1, chi2_quantile(share, P) / 2)


def distance(scale: float = 1.0) -> Column:
    """The squared Mahalanobis distance, by forward substitution in the Cholesky factor."""
    z: list[Column] = []
    for i, x in enumerate(Q):
        known = reduce(lambda a, j: a + F.col(f"l_{i}_{j}") * z[j], range(i), F.lit(0.0))
        z.append((F.col(x) - F.col(f"m_{i}") - known) / F.col(f"l_{i}_{i}"))
    return reduce(lambda a, b: a + b * b, z, F.lit(0.0)) / scale


def _factor(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factors of the covariances c_i_j, with the least variances on the diagonal."""
    out = moments
    for i in range(P):
        for j in range(i + 1):
            got = F.col(f"c_{i}_{j}") + (PARTS[Q[i]] ** 2 if i == j else 0.0)
            got = reduce(lambda a, k: a - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}"), range(j), got)
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(got, F.lit(1e-12))) if i == j else got / F.col(f"l_{j}_{j}"))
    half = reduce(lambda a, i: a + F.log(F.col(f"l_{i}_{i}")), range(P), F.lit(0.0))
    kept = [f"m_{i}" for i in range(P)] + [f"l_{i}_{j}" for i in range(P) for j in range(i + 1)]
    return out.select(*keys, "n", *kept, (2 * half).alias("log_det"))


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(x).alias(f"m_{i}") for i, x in enumerate(Q)),
        *(F.covar_pop(Q[i], Q[j]).alias(f"c_{i}_{j}") for i in range(P) for j in range(i + 1)),
    )


def histogram_limits(rows: DataFrame, keys: list[str], bin_col: Column, shares: list[float]) -> DataFrame:
    """For each key and share, the first bin up to which at least this share of the rows lies.

    Bins are integers of a bounded range, so a key has a bounded number of them.
    """
    counts = rows.groupBy(*keys, bin_col.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    return run.groupBy(*keys).agg(
        *(F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * s), F.col("bin"))).alias(f"q_{k}") for k, s in enumerate(shares))
    )


def _distance_bin(d2: Column) -> Column:
    return F.floor(16 * F.log2(F.least(F.greatest(d2, F.lit(1e-9)), F.lit(1e30))))


def mcd(rows: DataFrame, share: float = 0.75, least_gain: float = 1e-3, steps: int = 40) -> DataFrame:
    """Centre and Cholesky factor per `grp` of `rows` (grp and the vector).

    Two starts are concentrated: the classical moments, and the rows nearest to the medians in
    units of the quartile range. A group's step is taken if it lowers the logarithm of its
    determinant by more than `least_gain`; else the group is done and costs nothing more. The start
    with the smaller determinant is returned, with `converged` telling whether it was done in time.
    """
    keys = ["grp", "start"]
    each = rows.select("grp", F.posexplode(F.array(*Q)).alias("of", "x"))
    q = histogram_limits(each, ["grp", "of"], F.floor(F.col("x") * 64), [0.25, 0.5, 0.75])
    mid, iqr = F.col("q_1") / 64, (F.col("q_2") - F.col("q_0")) / 64
    q = q.groupBy("grp").agg(*(F.max(F.when(F.col("of") == k, x)).alias(f"{n}_{k}") for k in range(P) for n, x in (("mid", mid), ("iqr", iqr))))
    rough = rows.join(materialised(q, "quartiles"), "grp")
    far = reduce(
        lambda a, k: a + F.pow((F.col(Q[k]) - F.col(f"mid_{k}")) / F.greatest(F.col(f"iqr_{k}"), F.lit(PARTS[Q[k]])), F.lit(2)),
        range(P),
        F.lit(0.0),
    )
    rough = rough.select("grp", *Q, F.lit(1).alias("start"), _distance_bin(far).alias("bin"))
    limits = histogram_limits(rough, keys, F.col("bin"), [share]).withColumnRenamed("q_0", "limit")
    near = rough.join(limits, keys).filter("bin <= limit")
    both = _moments(near, keys).unionByName(_moments(rows.withColumn("start", F.lit(0)), keys))
    fit = materialised(_factor(both, keys).withColumn("done", F.lit(False)), "mcd")
    for _ in range(steps):
        if fit.filter(~F.col("done")).isEmpty():
            break
        active = fit.filter(~F.col("done"))
        at = rows.join(active, "grp").select(*keys, *Q, _distance_bin(distance()).alias("bin"))
        limits = histogram_limits(at, keys, F.col("bin"), [share]).withColumnRenamed("q_0", "limit")
        new = _factor(_moments(at.join(limits, keys).filter("bin <= limit"), keys), keys)
        new = new.select(*keys, F.struct([c for c in new.columns if c not in keys]).alias("new"))
        old = fit.select(*keys, F.struct([c for c in fit.columns if c not in (*keys, "done")]).alias("old"))
        better = F.coalesce(F.col("old.log_det") - F.col("new.log_det") > least_gain, F.lit(False))
        taken = old.join(new, keys, "left").select(*keys, F.when(better, F.col("new")).otherwise(F.col("old")).alias("est"), (~better).alias("done"))
        fit = materialised(taken.select(*keys, "est.*", "done"), "mcd")
    best = fit.groupBy("grp").agg(F.min(F.struct("log_det", "start")).alias("best"))
    chosen = best.select("grp", F.col("best.start").alias("start"))
    return fit.join(chosen, keys).drop("start").withColumnRenamed("done", "converged")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    share: float = 0.75,
    least_rows: int = 100,
    tail: float = 1e-9,
) -> DataFrame:
    """Counts, base_failed, d2 and kept of every row of `docs`.

    Base rule: fewer than 50 words, or more than half of the words in repeated 3-word windows.
    The other rows are compared with the robust estimate of their language and source: a row is
    rejected if its squared distance exceeds the 1 - `tail` quantile of chi-squared. A language
    and source with fewer than `least_rows` such rows takes the estimate of its language, a
    language with fewer the estimate of all rows; if all are fewer, nothing more is rejected.

    A null text counts as empty (no words, so it fails). A null language or source is a value of
    its own. Repeated rows each give a row; other columns are not touched.
    """
    stats = materialised(statistics(docs, id_col, text_col, lang_col, source_col), "quality")
    good = stats.filter(~F.col("base_failed"))
    by_source = good.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n_source"))
    by_lang = by_source.groupBy("lang_key").agg(F.sum("n_source").alias("n_lang"))
    own = F.concat_ws("\x01", "lang_key", "source_key")
    grp = F.when(F.col("n_source") >= least_rows, own).when(F.col("n_lang") >= least_rows, F.col("lang_key")).otherwise("*")
    groups = materialised(by_source.join(by_lang, "lang_key").select("lang_key", "source_key", grp.alias("grp")), "groups")
    needed = groups.select("grp").distinct()
    levels = F.explode(F.array(own, F.col("lang_key"), F.lit("*")))
    rows = good.select(*Q, levels.alias("grp")).join(needed, "grp", "left_semi")
    rows = materialised(rows, "vectors")
    fit = mcd(rows, share).filter(F.col("n") >= share * least_rows * 0.9)
    wide = stats.join(groups, ["lang_key", "source_key"], "left").join(fit.drop("n", "log_det"), "grp", "left")
    d2 = distance(consistency(share))
    limit = chi2_quantile(1 - tail, P)
    kept = ~F.col("base_failed") & F.coalesce(d2 <= limit, F.lit(True))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return wide.select("id", "text_hash", *counts, "base_failed", d2.alias("d2"), kept.alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that are kept."""
    verdict = judge(docs, id_col, text_col, **settings).filter("kept").select("id", "text_hash").distinct()
    same = docs[id_col].eqNullSafe(verdict["id"]) & (F.xxhash64(docs[text_col].cast("string")) == verdict["text_hash"])
    return docs.join(verdict, same, "left_semi")
