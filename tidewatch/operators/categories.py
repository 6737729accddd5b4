"""Category features of any cardinality: an index, or class statistics, kept as a Parquet table.

Both are ``pyspark.ml`` estimators whose models hold a table that is joined at scoring; no list of values reaches the
driver, and a model is saved with its ``PipelineModel``: its parameters as metadata, its table as Parquet beside them.

* ``CategoryIndexer``: the frequency-ordered index (ties alphabetical). The output column says how many values there
  are, so a tree takes it for a category, as long as it has as many bins.
* ``ClassStatistics``: for categories beyond the bins, the smoothed share of each class among the training rows of the
  value, as a vector. Training rows get the shares that the other folds give (``out_of_fold``), so that a
  rare value does not tell its own label; scoring rows get the shares of all training rows.

Rows with a NULL or unseen value are skipped, or with ``handleInvalid='keep'`` get the index after the last one, or the classes' shares
of all rows. Joins are left to the planner: a table below the broadcast threshold is broadcast, any other is shuffled,
and a value that holds a large part of the rows is split by the skew join.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def category_index(df: DataFrame, col: str, suffix: str = "_indexed") -> DataFrame:
    """``(col, col_indexed)``: the frequency-ordered index of a column with any number of
    values, none of which reaches the driver (ties alphabetical, NULL skipped). Values are counted,
    range partitioned by rank, and numbered from their partition's offset."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    # the partition numbers must not change between the two uses
    dealt, _ = _staged(counts.repartitionByRange(F.desc("_n"), F.asc(col)).withColumn("_part", F.spark_partition_id()), "category-index")
    # one row a partition
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    base = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("_n"), F.asc(col))) - 1
    numbered = dealt.withColumn("_inside", inside).join(base, "_part")
    return numbered.select(col, (F.col("_base") + F.col("_inside")).cast("double").alias(f"{col}{suffix}"))


class _TableWriter(MLWriter):
    def __init__(self, model: "_TableModel") -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active(), extraMetadata={"extra": self.model.extra})
        self.model.table().write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        model = self.cls(f"{path}/table", metadata["extra"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _TableModel(Model, HasInputCol, HasOutputCol, HasHandleInvalid, MLReadable, MLWritable):
    """A model that is a table with the column ``value``; ``extra`` are the small facts about it."""

    def __init__(self, path: str = "", extra: dict | None = None) -> None:
        super().__init__()
        self.path, self.extra = path, extra or {}
        self._setDefault(handleInvalid="skip")

    def table(self) -> DataFrame:
        return SparkSession.active().read.parquet(self.path)

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def _joined(self, df: DataFrame) -> DataFrame:
        table = self.table().select(F.col("value").alias("_value"), *[F.col(c).alias(f"_{c}") for c in self.table().columns if c != "value"])
        how = "inner" if self.getOrDefault("handleInvalid") == "skip" else "left"
        return df.join(table, F.col(f"`{self.getInputCol()}`").cast("string") == F.col("_value"), how)


class CategoryIndexModel(_TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        keep = self.getOrDefault("handleInvalid") != "skip"
        size = self.extra["size"]
        index = F.coalesce("_index", F.lit(float(size))) if keep else F.col("_index")
        meta = {"ml_attr": {"name": self.getOutputCol(), "type": "nominal", "num_vals": max(1, size + keep)}}
        return self._joined(df).select(*[F.col(f"`{c}`") for c in df.columns], index.alias(self.getOutputCol(), metadata=meta))


class CategoryIndexer(Estimator, HasInputCol, HasOutputCol, HasHandleInvalid):
    @keyword_only
    def __init__(self, *, inputCol: str, outputCol: str, handleInvalid: str = "skip") -> None:
        super().__init__()
        self._setDefault(handleInvalid="skip")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CategoryIndexModel:
        col = self.getInputCol()
        index = category_index(df.select(F.col(f"`{col}`").cast("string").alias("value")), "value", "_x").withColumnRenamed("value_x", "index")
        table, path = _staged(index, "category-table")
        model = CategoryIndexModel(path, {"size": table.count()})
        return self._copyValues(model)


class ClassStatisticsModel(_TableModel):
    """``extra``: the classes' counts over all training rows, the smoothing and the folds."""

    def _shares(self, counts: Column) -> Column:
        """Smoothed share of each class; a value without rows has the shares of all rows."""
        total = float(sum(self.extra["prior"])) or 1.0
        prior = F.array(*[F.lit(n / total) for n in self.extra["prior"]])
        weight = self.extra["smoothing"]
        bound = F.transform(F.array(F.struct(counts.alias("c"), F.aggregate(counts, F.lit(0.0), lambda a, x: a + x).alias("n"))), lambda b: F.zip_with(b["c"], prior, lambda x, p: (x + weight * p) / (b["n"] + weight)))
        return F.get(bound, 0)

    def _vector(self, counts: Column) -> Column:
        meta = {"ml_attr": {"num_attrs": len(self.extra["prior"])}}  # the assembler asks for the width
        return array_to_vector(self._shares(counts)).alias(self.getOutputCol(), metadata=meta)

    def _zero(self) -> Column:
        return F.array(*[F.lit(0.0)] * len(self.extra["prior"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        counts = F.coalesce("_counts", self._zero())
        return self._joined(df).select(*[F.col(f"`{c}`") for c in df.columns], self._vector(counts))

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        """The training rows with the shares that the rows of the other folds give their value."""
        kept = [F.col(f"`{c}`") for c in df.columns]
        rows = self._joined(df.withColumn("_fold", row_fold(df, self.extra["folds"])))
        own = F.aggregate(
            F.filter("_per_fold", lambda x: x["fold"] == F.col("_fold")), self._zero(), lambda _, x: x["counts"]
        )
        counts = F.zip_with(F.col("_counts"), own, lambda a, b: a - b)
        return rows.select(*kept, self._vector(counts))


def row_fold(df: DataFrame, folds: int) -> Column:
    """The fold of a row, from all its columns of plain types, so that it does not depend on the partitioning."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("vectorudt", "map", "variant", "udt")]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(folds)).cast("int")


class ClassStatistics(Estimator, HasInputCol, HasOutputCol, HasLabelCol, HasHandleInvalid):
    """``labelCol`` is an index of ``classes`` classes."""

    smoothing = Param(Params._dummy(), "smoothing", "rows that the shares of all rows count for", TypeConverters.toFloat)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str, outputCol: str, labelCol: str, classes: int, smoothing: float = 1.0, folds: int = 5, handleInvalid: str = "skip") -> None:
        super().__init__()
        self._setDefault(smoothing=1.0, folds=5, handleInvalid="skip")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ClassStatisticsModel:
        n_classes, folds = self.getOrDefault("classes"), self.getOrDefault("folds")
        value, label = F.col(f"`{self.getInputCol()}`").cast("string"), F.col(f"`{self.getLabelCol()}`").cast("int")
        rows = df.select(value.alias("value"), label.alias("label"), row_fold(df, folds).alias("fold")).where("value is not null and label is not null")
        counts = rows.groupBy("value", "fold", "label").agg(F.count(F.lit(1)).alias("n"))
        # at most folds * classes rows a value from here on
        per_class = [F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)).cast("double") for k in range(n_classes)]
        per_fold = counts.groupBy("value", "fold").agg(F.array(*per_class).alias("counts"))
        zero = F.array(*[F.lit(0.0)] * n_classes)
        whole = F.aggregate("per_fold", zero, lambda a, x: F.zip_with(a, x["counts"], lambda p, q: p + q))
        table = per_fold.groupBy("value").agg(F.array_sort(F.collect_list(F.struct("fold", "counts"))).alias("per_fold")).withColumn("counts", whole)
        table, path = _staged(table, "class-statistics")
        prior = table.agg(*[F.coalesce(F.sum(F.get("counts", k)), F.lit(0.0)) for k in range(n_classes)]).first()
        model = ClassStatisticsModel(path, {"prior": list(prior), "smoothing": self.getOrDefault("smoothing"), "folds": folds})
        return self._copyValues(model)
