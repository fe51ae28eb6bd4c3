"""Conversion models on Spark MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    PCA,
    Imputer,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LABEL = "label"
FEATURES = "features"


def index_names(cols: Sequence[str]) -> list[str]:
    return [f"{c}_index" for c in cols]


def one_hot_names(cols: Sequence[str]) -> list[str]:
    return [f"{c}_one_hot" for c in cols]


def encoder(cols: Sequence[str]) -> Pipeline:
    """Category index and one-hot vector of every column: one counting pass for all.

    The labels of a column reach the driver; ``prepare`` refuses columns with too many.
    """
    return Pipeline(stages=[
        StringIndexer(inputCols=list(cols), outputCols=index_names(cols), handleInvalid="keep"),
        OneHotEncoder(inputCols=index_names(cols), outputCols=one_hot_names(cols)),
    ])


def imputer(cols: Sequence[str]) -> Imputer:
    return Imputer(inputCols=list(cols), outputCols=[f"{c}_imputed" for c in cols])


def usable_numbers(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with at least one value; a mean of nothing cannot be fitted."""
    found = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    return [c for c in cols if found[c]]


def feature_pipeline(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> Pipeline:
    """Imputed numbers and one-hot categories assembled into one vector."""
    numbers = usable_numbers(df, numbers)
    stages = [*encoder(categories).getStages(), imputer(numbers)]
    inputs = [f"{c}_imputed" for c in numbers] + one_hot_names(categories)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES)])


def as_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def prepare(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str], label: str,
    most_categories: int = 10_000,
) -> tuple[DataFrame, PipelineModel]:
    """Frame with ``features`` and ``label``, and the fitted preparation.

    A category column with more than about ``most_categories`` values is an error: its one-hot
    vector and its labels would not fit a driver.
    """
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in categories]).first()
    wide = [c for c in categories if sizes[c] > most_categories]
    if wide:
        raise ValueError(f"more than {most_categories} values in {wide}")
    typed = as_doubles(df, [*numbers, label]).fillna("missing", subset=list(categories))
    fitted = feature_pipeline(typed, categories, numbers).fit(typed)
    return fitted.transform(typed).withColumn(LABEL, F.col(label)), fitted


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def index_vector(df: DataFrame, max_categories: int = 6) -> Model:
    """Features with few values become categories."""
    return VectorIndexer(
        inputCol=FEATURES, outputCol="indexed", maxCategories=max_categories, handleInvalid="keep"
    ).fit(df)


def explained_variance(df: DataFrame, k: int = 10) -> DataFrame:
    """Variance share of the first ``k`` components, and its running sum."""
    shares = PCA(k=k, inputCol=FEATURES, outputCol="pca").fit(df).explainedVariance.toArray()
    rows, total = [], 0.0
    for i, share in enumerate(shares):
        total += float(share)
        rows.append((i + 1, float(share), total))
    return df.sparkSession.createDataFrame(rows, "component int, variance double, cumulative double")


def fit_rf(train: DataFrame, trees: int = 20, seed: int = 42, **options) -> Model:
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol=FEATURES, numTrees=trees, seed=seed, **options
    ).fit(train)


def _search(estimator, grid, evaluator, folds: int, seed: int, parallelism: int, train: DataFrame):
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
        numFolds=folds, seed=seed, parallelism=parallelism,
    ).fit(train)


def fit_gbt_cls(
    train: DataFrame, depths: Sequence[int] = (2, 5), rounds: Sequence[int] = (10, 100),
    folds: int = 3, seed: int = 42, parallelism: int = 4, metric: str = "f1", bins: int = 32,
) -> CrossValidatorModel:
    """Boosted trees over a grid, one model per class against the rest.

    The metric is named: scores printed elsewhere as accuracy were F1.
    """
    base = GBTClassifier(labelCol=LABEL, featuresCol=FEATURES, seed=seed, maxBins=bins)
    estimator = OneVsRest(
        labelCol=LABEL, featuresCol=FEATURES, classifier=base, parallelism=parallelism
    )
    # By the classifier's own parameters: a copy of OneVsRest keeps its classifier and hands
    # them on, while a classifier in the grid would be overwritten by the first one.
    grid = (
        ParamGridBuilder()
        .addGrid(base.maxDepth, list(depths))
        .addGrid(base.maxIter, list(rounds))
        .build()
    )
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName=metric)
    return _search(estimator, grid, evaluator, folds, seed, parallelism, train)


def fit_gbt_reg(
    train: DataFrame, depths: Sequence[int] = (2, 5), rounds: Sequence[int] = (10, 100),
    folds: int = 3, seed: int = 42, parallelism: int = 4, bins: int = 32,
) -> CrossValidatorModel:
    """Boosted regression trees over a grid, chosen by RMSE."""
    model = GBTRegressor(labelCol=LABEL, featuresCol=FEATURES, seed=seed, maxBins=bins)
    grid = (
        ParamGridBuilder()
        .addGrid(model.maxDepth, list(depths))
        .addGrid(model.maxIter, list(rounds))
        .build()
    )
    evaluator = RegressionEvaluator(labelCol=LABEL, metricName="rmse")
    return _search(model, grid, evaluator, folds, seed, parallelism, train)


def search_scores(search: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Mean score of each grid point."""
    rows = [(i, float(score)) for i, score in enumerate(search.avgMetrics)]
    return df.sparkSession.createDataFrame(rows, "point int, score double")


def feature_names(df: DataFrame) -> list[str]:
    """Name of every vector slot, from the column's metadata."""
    attrs = df.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]


def importances(model: Model, df: DataFrame) -> DataFrame:
    """Importance of each feature by name."""
    values = model.featureImportances.toArray()
    names = feature_names(df) or [str(i) for i in range(len(values))]
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "name string, importance double")


def score(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy(LABEL, "prediction").agg(F.count("*").alias("rows"))


METRICS = ("accuracy", "f1", "weightedPrecision", "weightedRecall")


def evaluate(scored: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Named metrics of a scored frame, out of its confusion counts.

    The counts are tiny, so each metric is read from them instead of another
    pass over the scores.
    """
    counts = confusion(scored).withColumn("weight", F.col("rows").cast("double"))
    small = counts.sparkSession.createDataFrame(counts.collect(), counts.schema)
    rows = [
        (m, float(MulticlassClassificationEvaluator(
            labelCol=LABEL, metricName=m, weightCol="weight").evaluate(small)))
        for m in metrics
    ]
    return scored.sparkSession.createDataFrame(rows, "metric string, value double")


def accuracy(scored: DataFrame) -> DataFrame:
    hit = F.count_if(F.col(LABEL) == F.col("prediction"))
    return scored.agg((hit / F.count("*")).alias("accuracy"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def labelled_rows(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows with a label, the first in hash order of their key.

    The bound is for models whose fitting time grows with rows times rounds.
    """
    return df.where(F.col(LABEL).isNotNull()).orderBy(F.xxhash64(key), key).limit(most)


def category_weights(df: DataFrame, column: str) -> DataFrame:
    """``value`` and its range ``[low, high)`` among all rows, for values of any number.

    Values are ordered within 256 hashed buckets and the buckets after each other, so no
    task has to hold or sort all values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count("*").alias("n")
    ).withColumn("bucket", F.substring(F.md5("value"), 1, 2))
    inside = Window.partitionBy("bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows
    starts = counts.groupBy("bucket").agg(F.sum("n").alias("all")).select(
        "bucket", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("start")
    )
    high = F.col("start") + F.col("upto")
    return counts.withColumn("upto", F.sum("n").over(inside)).join(starts, "bucket").select(
        "value", (high - F.col("n")).alias("low"), high.alias("high")
    )


def _draw(key, seed: int, name: str):
    """60-bit number decided by seed, column and row id."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def draw_category(ids: DataFrame, name: str, weights: DataFrame, seed: int, key="id") -> DataFrame:
    """``ids`` with a column of values in the proportions of ``category_weights``.

    The range is cut into as many equal cells as there are values; a row meets the few
    values of its cell, by an equi-join.
    """
    size = weights.agg(F.max("high").alias("total"), F.count("*").alias("n")).first()
    if not size["total"]:
        return ids.withColumn(name, F.lit(None).cast("string"))
    width = max(size["total"] // size["n"], 1)

    def cell(point):
        return F.floor(point / width).cast("long")

    cells = weights.select("low", "high", F.col("value").alias(name), F.explode(
        F.sequence(cell(F.col("low")), cell(F.col("high") - 1))).alias("__cell"))
    point = _draw(F.col(key), seed, name) % size["total"]
    drawn = ids.withColumn("__point", point).withColumn("__cell", cell(F.col("__point")))
    inside = (F.col("__point") >= F.col("low")) & (F.col("__point") < F.col("high"))
    return drawn.join(cells, "__cell").where(inside).drop("__cell", "__point", "low", "high")


def weighted(name: str, weights: Mapping[str, int], seed: int, key="id", null_percent: int = 0):
    """Column of a few given values in integer proportions, the same for the same id."""
    ident = F.col(key)
    total = sum(weights.values())
    point = _draw(ident, seed, name) % total
    out, high = None, 0
    for value, weight in weights.items():
        high += weight
        out = F.when(point < high, F.lit(value)) if out is None else out.when(point < high, F.lit(value))
    if null_percent:
        out = F.when(_draw(ident, seed, f"{name} null") % 100 >= null_percent, out)
    return out.alias(name)


def ranged(name: str, low: int, high: int, seed: int, key="id", null_percent: int = 0):
    """Whole numbers evenly in ``[low, high]``."""
    ident = F.col(key)
    out = _draw(ident, seed, name) % (high - low + 1) + low
    if null_percent:
        out = F.when(_draw(ident, seed, f"{name} null") % 100 >= null_percent, out)
    return out.alias(name)


def synthesize(ids: DataFrame, columns: Sequence) -> DataFrame:
    """Rows drawn column by column for the ids given: spread out and repeatable.

    Further columns of ``ids``, as ``draw_category`` adds them, stay.
    """
    return ids.select("*", *columns)
