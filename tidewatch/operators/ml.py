"""Classifier training, scoring and evaluation on ``pyspark.ml``.

Training and serving share one persisted ``PipelineModel`` (indexers, the
``inf`` cap, assembler and forest), so a record gets the same features in
batch and in a stream -- indexers are fitted once, never per micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import to_double
from ..schema import LABEL_COLUMN, TRAFFIC_FIELDS
from .categories import CategoryIndexer, ClassStatistics, category_index

LABEL_INDEXED = "label_indexed"
CATEGORY_BINS = 150000
CACHE_ROWS = 500  # rows of a batch of the cached training rows


def fit_label_indexer(df: DataFrame, col: str = LABEL_COLUMN, out: str = LABEL_INDEXED) -> StringIndexerModel:
    """Frequency-ordered label index (ties alphabetical); unseen/NULL rows skipped."""
    return StringIndexer(inputCol=col, outputCol=out, handleInvalid="skip").fit(df)


def index_to_string(df: DataFrame, model: StringIndexerModel, col: str, out: str) -> DataFrame:
    return IndexToString(inputCol=col, outputCol=out, labels=model.labels).transform(df)


def hash_split(id_col: str | Column, train_pct: int = 80) -> Column:
    """Reproducible train/test flag from an integer id (independent of
    partitioning, so an oracle can reproduce it)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.pmod(c, F.lit(1000003)) * 7919) % 100 < train_pct


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    a, b = df.randomSplit([train, 1.0 - train], seed=seed)
    return a, b


@dataclass
class ForestParams:
    num_trees: int = 10
    max_depth: int = 5
    # 32 bins suit continuous features; with ``rate_as_category`` the Rate
    # index is categorical and needs as many bins as values
    max_bins: int = 32
    seed: int = 42
    rate_as_category: bool = False
    # with more values than this the Rate becomes the class statistics of its value
    category_bins: int = CATEGORY_BINS
    # about this many rows are used for the fit (a hash sample); None uses all
    max_fit_rows: int | None = None


@contextmanager
def small_cache_batches(spark: SparkSession, rows: int | None = None) -> Iterator[None]:
    """What is cached inside (at its first action) is cut into batches of at most ``rows`` rows.

    Cached rows are written through a Java object stream, which holds the last hundred batches beside the memory that Spark
    counts. Of 10,000 assembled rows, the session's default, a batch takes about 3 MB, so each task would hold 300 MB.
    """
    key = "spark.sql.inMemoryColumnarStorage.batchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows or CACHE_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def numeric_feature_names() -> list[str]:
    return [n for n, k in TRAFFIC_FIELDS if k != "string"]


def rate_bounds(df: DataFrame, col: str = "rate_value") -> tuple[float, float]:
    """Smallest and largest finite rate in the training data (one aggregation)."""
    finite = F.when(~F.isnan(col) & (F.abs(F.col(col)) != float("inf")), F.col(col))
    low, high = df.agg(F.min(finite), F.max(finite)).first()
    return (0.0, 0.0) if low is None else (float(low), float(high))


def with_rate_value(df: DataFrame) -> DataFrame:
    """``df`` with ``rate_value``, the rate as a double, if it is not there yet."""
    if "rate_value" in df.columns or "Rate" not in df.columns:
        return df
    return df.withColumn("rate_value", to_double(F.col("Rate").cast("string")))


def rate_stage(params: ForestParams, train: DataFrame, classes: int):
    """The fitted stage of the Rate, its training rows, its output column and the bins that it needs."""
    if params.rate_as_category:
        # whether the values fit is known from at most one more than fit
        fits = train.where(F.col("Rate").isNotNull()).select("Rate").distinct().limit(params.category_bins + 1).count() <= params.category_bins
        if fits:
            model = CategoryIndexer(inputCol="Rate", outputCol="Rate_indexed").fit(train)
            return model, model.transform(train), "Rate_indexed", max(params.max_bins, model.extra["size"])
        model = ClassStatistics(inputCol="Rate", outputCol="Rate_classes", labelCol=LABEL_INDEXED, classes=classes).fit(train)
        return model, model.out_of_fold(train), "Rate_classes", params.max_bins
    low, high = rate_bounds(train)
    inf = "CAST('Infinity' AS DOUBLE)"
    stage = SQLTransformer(
        statement=f"SELECT *, CASE WHEN rate_value = {inf} THEN {high!r}D WHEN rate_value = -{inf} THEN {low!r}D "
        "ELSE rate_value END AS rate_capped FROM __THIS__"
    )
    return stage, stage.transform(train), "rate_capped", params.max_bins


def fit_classifier(params: ForestParams, train: DataFrame, classes: int) -> PipelineModel:
    """Feature stages -> forest: (Rate index | class statistics | finite rate) -> assembler -> forest.

    The label indexer is fitted separately (``train``): serving rows carry no
    known label, and a skipping label stage would drop them.
    """
    stage, rows, column, bins = rate_stage(params, train, classes)
    feats = numeric_feature_names()
    feats = feats[:3] + [column] + feats[3:]
    # Rows reach the assembler complete (``parse_lines(complete=True)`` or
    # ``complete_rows``): a skipping assembler would add a NULL/NaN filter on
    # every feature that Catalyst pushes below the parse projection, re-
    # evaluating the line split once per feature (measured 5x slower).
    assembler = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=LABEL_INDEXED,
        numTrees=params.num_trees,
        maxDepth=params.max_depth,
        maxBins=bins,
        seed=params.seed,
    )
    # the fit reads its rows three times (classes, split candidates, bagging): assembled once
    points = assembler.transform(rows).select("features", LABEL_INDEXED).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        return PipelineModel([stage, assembler, forest.fit(points)])
    finally:
        points.unpersist()


@dataclass
class Trained:
    """A fitted label indexer, the serving model (features + forest) and its parameters."""

    labels: StringIndexerModel
    model: PipelineModel
    params: ForestParams = field(default_factory=ForestParams)

    def save(self, path: str) -> None:
        """Sibling folders, overwritten: ``model``, ``label_indexer`` and ``params``."""
        self.model.write().overwrite().save(f"{path}/model")
        self.labels.write().overwrite().save(f"{path}/label_indexer")
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(asdict(self.params)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/params")

    @staticmethod
    def load(path: str) -> "Trained":
        params = ForestParams(**json.loads(SparkSession.active().read.text(f"{path}/params").first()[0]))
        return Trained(StringIndexerModel.load(f"{path}/label_indexer"), PipelineModel.load(f"{path}/model"), params)


def train(df: DataFrame, params: ForestParams | None = None, persist: bool = True) -> Trained:
    """Fit the label index, the finite rate bounds, the feature stages and the forest.

    The training rows are persisted once (memory, spilling to disk) and
    shared by the label-index fit, the cap aggregation and the forest's
    passes, instead of being re-derived by each (``persist=False`` when the
    caller already caches them). Incomplete rows are dropped above the cache.
    """
    with small_cache_batches(df.sparkSession):
        return _train(df, params or ForestParams(), persist)


def _train(df: DataFrame, params: ForestParams, persist: bool) -> Trained:
    from .parse import complete_rows

    df = with_rate_value(df)
    rows = df.persist(StorageLevel.MEMORY_AND_DISK_DESER) if persist else df
    try:
        # filtered above the cached rows, so nothing is pushed into the parse
        rows = complete_rows(rows, model_features(params))
        labels = fit_label_indexer(rows)
        if params.max_fit_rows is not None:
            share = min(1.0, params.max_fit_rows / max(1, rows.count()))
            place = F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]), F.lit(1 << 30)) / float(1 << 30)
            rows = rows.filter(place < share)
        indexed = labels.transform(rows)
        model = fit_classifier(params, indexed, len(labels.labels))
    finally:
        if persist:
            df.unpersist()
    return Trained(labels, model, params)


def model_features(params: ForestParams | None = None) -> list[str]:
    """Input columns the serving model reads (the rate as text or number)."""
    params = params or ForestParams()
    feats = numeric_feature_names()
    return feats + (["Rate"] if params.rate_as_category else ["rate_value"])


def predict(
    trained: Trained | PipelineModel, df: DataFrame, decode: bool = True, assume_complete: bool = False
) -> DataFrame:
    """Score rows; with ``decode`` add ``predicted_label`` (the class name).

    Rows with a NULL/NaN feature are dropped first, unless the caller already
    did (``parse_lines(complete=True)``): then ``assume_complete`` avoids a
    second, per-feature filter.
    """
    from .parse import complete_rows

    model, params = (trained.model, trained.params) if isinstance(trained, Trained) else (trained, ForestParams())
    df = with_rate_value(df)
    if not assume_complete:
        feats = [c for c in model_features(params) if c in df.columns]
        df = complete_rows(df, feats)
    out = model.transform(df)
    if decode and isinstance(trained, Trained):
        out = IndexToString(
            inputCol="prediction", outputCol="predicted_label", labels=trained.labels.labels
        ).transform(out)
    return out


def confusion(pred: DataFrame, label: str = LABEL_INDEXED, prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, count)``; partial aggregation map-side."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def per_class(conf: DataFrame) -> DataFrame:
    """Per true class: support, true positives and predicted count, from the
    confusion matrix (one row per class)."""
    as_true = conf.select(
        F.col("label").alias("class"),
        F.col("count").alias("n"),
        F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).alias("tp"),
        F.lit(0).cast("bigint").alias("np"),
    )
    as_pred = conf.select(
        F.col("prediction").alias("class"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("tp"),
        F.col("count").alias("np"),
    )
    return (
        as_true.unionByName(as_pred)
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.sum("tp").alias("tp"), F.sum("np").alias("np"))
        .filter(F.col("n") > 0)
    )


def metrics(pred: DataFrame, label: str = LABEL_INDEXED, prediction: str = "prediction") -> DataFrame:
    """Accuracy, weighted precision, weighted recall and weighted F1 in one
    pass over the predictions (then over the per-class rows only).

    Per class c (true classes): p = tp/predicted (0 if none), r = tp/n,
    f = 2pr/(p+r) (0 if none); weights n/N. Terms are summed in class order
    so the result does not depend on partitioning.
    """
    pc = per_class(confusion(pred, label, prediction))
    # per-class rows only (bounded by the number of classes)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    p = F.when(F.col("np") > 0, F.col("tp") / F.col("np")).otherwise(F.lit(0.0))
    r = F.col("tp") / F.col("n")
    pr = F.col("p") + F.col("r")
    f = F.when(pr > 0, F.lit(2.0) * F.col("p") * F.col("r") / pr).otherwise(F.lit(0.0))
    w = F.col("n") / F.col("n_total")
    terms = (
        pc.withColumn("n_total", total)
        .withColumn("p", p)
        .withColumn("r", r)
        .withColumn("f", f)
        .withColumns({"wp": w * F.col("p"), "wr": w * F.col("r"), "wf": w * F.col("f")})
    )

    def fold(col: str) -> Column:
        arr = F.transform(F.array_sort(F.collect_list(F.struct("class", col))), lambda x: x[col])
        return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)

    return terms.agg(
        (F.sum("tp") / F.sum("n")).alias("accuracy"),
        fold("wp").alias("weighted_precision"),
        fold("wr").alias("weighted_recall"),
        fold("wf").alias("f1"),
    )


def metrics_summary(pred: DataFrame, labels: list[str] | StringIndexerModel, label: str = LABEL_INDEXED, prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, f1_score, label_mapping, precision, recall (key order).
    ``labels`` are the fitted indexer's (the indexer itself will do)."""
    labels = labels.labels if isinstance(labels, StringIndexerModel) else labels
    m = metrics(pred, label, prediction)
    mapping = F.create_map(*[x for i, name in enumerate(labels) for x in (F.lit(i).cast("bigint"), F.lit(name))])
    return m.select(
        "accuracy",
        F.col("f1").alias("f1_score"),
        mapping.alias("label_mapping"),
        F.col("weighted_precision").alias("precision"),
        F.col("weighted_recall").alias("recall"),
    )
