"""Model-facing operators on Spark ML."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.operators.profile import regression_metrics
from panelflow.operators.regression import ols, predicted
from panelflow.plans.series import POS, Series, positions
from panelflow.session import materialised

# The default forest settings, and those of the baseline forest.
FOREST = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 5, "featureSubsetStrategy": "sqrt", "seed": 42}
BASELINE_FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1, "featureSubsetStrategy": "all", "seed": 42}
#: Up to so many rows a forest is fitted on the rows themselves; of more, about so many weighted points are made.
FOREST_POINTS = 200_000
#: Bins of a feature, as of Spark's forests.
BINS = 32
#: Steps of the quantiles that bins are made from.
QUANTILES = 2000


def zscores(df: DataFrame, columns: Sequence[str], train: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``z_{v}`` with mean and population std of the training rows, globally or per key."""
    base = df if train is None else df.where(train)
    stats = base.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    )
    if keys:
        d = df.join(stats, list(keys), "left")
    else:
        d = df.select("*", *[stats.select(c).scalar().alias(c) for c in stats.columns])
    d = d.withColumns({f"z_{c}": F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in columns})
    return d.drop(*[f"_{k}_{c}" for k in "ms" for c in columns])


def _assembler(features: Sequence[str], scaled: bool) -> list:
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip")]
    if scaled:
        stages.append(StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True))
    return stages


def forest(features: Sequence[str], label: str, scaled: bool = True, **settings) -> Pipeline:
    col = "_features" if scaled else "_raw"
    model = RandomForestRegressor(featuresCol=col, labelCol=label, **(FOREST | settings))
    return Pipeline(stages=[*_assembler(features, scaled), model])


def bin_borders(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Per feature the borders of at most `bins` bins of about equally many rows; a frequent value leaves its neighbours the other bins.

    The counts of values are read off quantiles of all rows, so few values have a bin each.
    """
    out = []
    for found in df.approxQuantile(list(features), [i / QUANTILES for i in range(QUANTILES + 1)], 0.2 / QUANTILES):
        counts = sorted(Counter(found).items())
        values = [v for v, _ in counts]
        middles = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
        if len(values) > bins:
            share, target, below, borders = len(found) / bins, len(found) / bins, 0, []
            for (_, n), (_, after), middle in zip(counts, counts[1:], middles, strict=False):
                below += n
                if abs(below - target) < abs(below + after - target):
                    borders.append(middle)
                    target += share
            middles = borders
        out.append(middles or values)
    return out


def weighted_points(df: DataFrame, cell: Sequence[str], ids: Sequence[str], label: str, rows: int, most: int) -> DataFrame:
    """(cell, label, weight): every `rows / most` rows of a cell, dealt out by a hash of `ids`, as their mean label and their number.

    At most `most` points more than there are cells.
    """
    share = rows / most
    large = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share)  # at most `most` rows
    block = F.pmod(F.xxhash64(*ids), F.ceil(F.col("_n") / F.lit(share)))
    dealt = df.join(F.broadcast(large), list(cell), "left").withColumn("_block", F.coalesce(block, F.lit(0)))
    return dealt.groupBy(*cell, "_block").agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("weight"))


def fit_forest(
    train: DataFrame, features: Sequence[str], label: str, scaled: bool = True, points: int = FOREST_POINTS, **settings
) -> PipelineModel:
    """A fitted forest; the number of rows decides the plan.

    A forest visits every row once for each tree and level. It sees a row's bins and label only, and the gain of a split, the
    mean of a leaf and the importances depend on the labels' sums and numbers alone. So of more than `points` rows
    the rows of a bin in every feature (a cell) are folded into weighted points: all rows count, at their weight, and the
    forest's work is bounded by the points and the cells. The bags draw points, of about equal weight; a leaf's least number
    of rows is kept as a weight. Bins are made from all rows. Many features may leave few rows a cell, and so more points.
    """
    n = train.dropna(subset=list(features)).count()
    if n <= points:
        return forest(features, label, scaled, **settings).fit(train)
    least = (FOREST | settings)["minInstancesPerNode"]
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in (*features, label)])
    missing = F.col(label).isNull() | F.isnan(label)
    rows = rows.withColumn(label, F.when(missing, F.raise_error(F.lit("a label is missing"))).otherwise(F.col(label)))
    cell = [f"_bin_{f}" for f in features]
    borders = [[float("-inf"), *b, float("inf")] for b in bin_borders(rows, features)]
    bucketizer = Bucketizer(inputCols=list(features), outputCols=cell, splitsArray=borders, handleInvalid="skip")
    assembler = VectorAssembler(inputCols=cell, outputCol="_raw", handleInvalid="skip")
    d = weighted_points(bucketizer.transform(rows), cell, [*features, label], label, n, points)
    tasks = train.sparkSession.sparkContext.defaultParallelism
    d = materialised(d.repartition(tasks, *cell, "_block").sortWithinPartitions(*cell, "_block"), "forest-points")
    model = RandomForestRegressor(
        featuresCol="_raw", labelCol=label, weightCol="weight", **(FOREST | settings | {"minInstancesPerNode": 1, "minWeightFractionPerNode": least / n})
    )
    return PipelineModel([bucketizer, assembler, model.fit(assembler.transform(d))])


def linear(features: Sequence[str], label: str) -> Pipeline:
    model = LinearRegression(featuresCol="_features", labelCol=label)
    return Pipeline(stages=[*_assembler(features, True), model])


def predictions(fitted, rows: DataFrame) -> DataFrame:
    """Rows with their `prediction`; a forest on bins predicts each cell once."""
    bins = fitted.stages[0]
    if not isinstance(bins, Bucketizer):
        return fitted.transform(rows)
    cell, d = bins.getOutputCols(), bins.transform(rows)
    cells = d.select(*cell).distinct().repartition(rows.sparkSession.sparkContext.defaultParallelism)
    once = PipelineModel(fitted.stages[1:]).transform(cells).select(*cell, "prediction")
    return d.join(once, cell).drop(*cell)


def score(fitted, rows: DataFrame, label: str) -> DataFrame:
    return predictions(fitted, rows).agg(*regression_metrics(label, "prediction"))


def train_and_score(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, **settings):
    """Fitted forest and its metrics on the test rows."""
    train = train.dropna(subset=[*features, label])
    fitted = fit_forest(train, features, label, **settings)
    return fitted, score(fitted, test.dropna(subset=[*features, label]), label)


def baselines(split: DataFrame, features: Sequence[str], label: str, **settings) -> DataFrame:
    """Scaled linear regression and a forest on the same seeded split, both scored."""
    rows = split.dropna(subset=[*features, label])
    train, test = rows.where("is_train"), rows.where(~F.col("is_train"))
    out = None
    for name, fitted in (
        ("linear", linear(features, label).fit(train)),
        ("forest", fit_forest(train, features, label, scaled=False, **(BASELINE_FOREST | settings))),
    ):
        m = score(fitted, test, label).select(F.lit(name).alias("model"), "*")
        out = m if out is None else out.unionByName(m)
    return out


def importance(spark, fitted, features: Sequence[str]) -> DataFrame:
    """(feature, importance, rank) of a fitted forest pipeline; one row per feature."""
    v = fitted.stages[-1].featureImportances.toArray()
    total = float(v.sum()) or 1.0
    d = spark.createDataFrame([(f, float(x) / total) for f, x in zip(features, v, strict=True)], "feature string, importance double")
    return _ranked(d, "importance")


def _ranked(d: DataFrame, by: str) -> DataFrame:
    # One row per feature: the window has no key because it ranks that short list.
    return d.withColumn("rank", F.rank().over(W.orderBy(F.desc(by))))


def compare_variants(train: DataFrame, test: DataFrame, variants: dict[str, Sequence[str]], label: str, **settings) -> DataFrame:
    """One metrics row per feature set, for example with and without a covariate."""
    out = None
    for name, features in variants.items():
        _, m = train_and_score(train, test, features, label, **settings)
        m = m.select(F.lit(name).alias("variant"), F.lit(len(features)).alias("features"), "*")
        out = m if out is None else out.unionByName(m)
    return out


def linear_attribution(df: DataFrame, coefs: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |coef * (x - mean)| per feature, exact for linear models, ranked.

    ``coefs`` is one row with a column per feature.
    """
    means = df.agg(*[F.avg(f).alias(f) for f in features])
    terms = [
        F.avg(F.abs(coefs.select(f).scalar() * (F.col(f) - means.select(f).scalar()))).alias(f) for f in features
    ]
    wide = df.agg(*terms)
    long = wide.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features]))
    )
    return _ranked(long, "importance")


def permute_column(df: DataFrame, ids: Sequence[str], column: str, seed: int) -> DataFrame:
    """Replace a column by its values in another row order, as a one-to-one join on ranks.

    Ranks come from two hash orders through the block plan, so no global sort runs in one
    task.
    """
    cell = 2.0**64 / 4096
    s = Series(("_all",), ("_h", *ids), plan="blocks", bucket=cell)

    def ranked(d, salt):
        d = d.withColumns({"_all": F.lit(1), "_h": F.xxhash64(*ids, F.lit(salt))})
        return positions(d, s).drop("_all", "_h", "_bkt")

    values = ranked(df.select(*ids, column), seed + 1).select(POS, F.col(column).alias("_new"))
    return ranked(df, seed).join(values, POS).drop(POS, column).withColumnRenamed("_new", column)


def permutation_importance(fitted, df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Rise of the mean squared error when one feature is permuted, per feature, ranked."""
    base = score(fitted, df, label).select("mse")
    out = None
    for i, f in enumerate(features):
        mse = score(fitted, permute_column(df, ids, f, seed + 2 * i), label)
        row = mse.select(F.lit(f).alias("feature"), (F.col("mse") - base.scalar()).alias("importance"))
        out = row if out is None else out.unionByName(row)
    return _ranked(out, "importance")


class _EntityRegressionParams(HasLabelCol, HasPredictionCol):
    keyCols = Param(Params._dummy(), "keyCols", "columns naming the group", TypeConverters.toListString)
    featureCols = Param(Params._dummy(), "featureCols", "regressor columns", TypeConverters.toListString)
    ridge = Param(Params._dummy(), "ridge", "ridge on the correlation scale", TypeConverters.toFloat)

    def _keys(self):
        return self.getOrDefault(self.keyCols)

    def _features(self):
        return self.getOrDefault(self.featureCols)


class EntityRegression(Estimator, _EntityRegressionParams, DefaultParamsReadable, DefaultParamsWritable):
    """One linear model per key, fitted in one aggregate; usable in an ML pipeline."""

    @keyword_only
    def __init__(self, *, keyCols=None, featureCols=None, labelCol="label", predictionCol="prediction", ridge=0.0):
        super().__init__()
        self._setDefault(ridge=0.0, labelCol="label", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> EntityRegressionModel:
        table = ols(
            dataset, self._keys(), self.getLabelCol(), self._features(), self.getOrDefault(self.ridge)
        )
        return self._copyValues(EntityRegressionModel(table))


class EntityRegressionModel(Model, _EntityRegressionParams, MLWritable, MLReadable):
    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(ridge=0.0, labelCol="label", predictionCol="prediction")
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fit = self.table.select(*self._keys(), F.col("coef").alias("_coef"), F.col("intercept").alias("_b0"))
        d = dataset.join(fit, self._keys(), "left")
        return d.withColumn(self.getPredictionCol(), predicted(self._features(), "_coef", "_b0")).drop("_coef", "_b0")

    def evaluate(self, dataset: DataFrame) -> DataFrame:
        return self.transform(dataset).agg(*regression_metrics(self.getLabelCol(), self.getPredictionCol()))

    def write(self) -> MLWriter:
        return _EntityRegressionWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EntityRegressionReader()


class _EntityRegressionWriter(MLWriter):
    def __init__(self, model: EntityRegressionModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/table")


class _EntityRegressionReader(MLReader):
    def load(self, path: str) -> EntityRegressionModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = EntityRegressionModel(self.sparkSession.read.parquet(f"{path}/table"))
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
