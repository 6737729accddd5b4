"""Category index and class statistics: against StringIndexer and by hand, saved with the pipeline, beyond the bins."""

import collections

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.operators.categories import CategoryIndexer, ClassStatistics, row_fold
from tidewatch.session import work_path
from tidewatch.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def rates(spark):
    rows = [(i, str(i * i % 13) if i % 11 else None, i % 3) for i in range(200)] + [(900, "only", 1)]
    return spark.createDataFrame(rows, "id int, Rate string, y int")


def test_index_equals_string_indexer_and_is_saved(spark):
    df = rates(spark)
    model = CategoryIndexer(inputCol="Rate", outputCol="at").fit(df)
    want = StringIndexer(inputCol="Rate", outputCol="at", handleInvalid="skip").fit(df).transform(df)
    assert sorted(map(tuple, model.transform(df).collect())) == sorted(map(tuple, want.collect()))
    path = work_path(spark, "t-index")
    PipelineModel([model]).write().overwrite().save(path)
    back = PipelineModel.load(path).transform(df)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))
    assert back.schema["at"].metadata["ml_attr"]["num_vals"] == 8
    fresh = spark.createDataFrame([(1, "new", 0), (2, None, 0), (3, "0", 0)], df.schema)
    assert [r.id for r in model.transform(fresh).collect()] == [3]
    kept = model.copy({model.handleInvalid: "keep"}).transform(fresh)
    assert {r.id: r.at for r in kept.collect()}[1] == {r.id: r.at for r in kept.collect()}[2] == 8.0


def test_class_statistics_by_hand(spark):
    df = rates(spark)
    model = ClassStatistics(inputCol="Rate", outputCol="shares", labelCol="y", classes=3, smoothing=2.0, folds=4).fit(df)
    rows = [r for r in df.withColumn("fold", row_fold(df, 4)).collect() if r.Rate is not None]
    prior = [sum(r.y == k for r in rows) / len(rows) for k in range(3)]

    def shares(counts):
        return [(counts[k] + 2 * prior[k]) / (sum(counts.values()) + 2) for k in range(3)]

    for got, others in ((model.transform(df), False), (model.out_of_fold(df), True)):
        got = {r.id: list(r.shares) for r in got.collect()}
        assert set(got) == {r.id for r in rows}
        for r in rows:
            counts = collections.Counter(o.y for o in rows if o.Rate == r.Rate and not (others and o.fold == r.fold))
            assert got[r.id] == pytest.approx(shares(counts))
    fresh = spark.createDataFrame([(1, "new", 0)], df.schema)
    assert model.transform(fresh).count() == 0
    assert list(model.copy({model.handleInvalid: "keep"}).transform(fresh).first().shares) == pytest.approx(prior)


def held_out(spark, params, rows):
    is_train = M.hash_split("line_id")
    trained = M.train(rows.filter(is_train), params)
    path = work_path(spark, "t-cat-model")
    trained.save(path)
    trained = M.Trained.load(path)
    scored = M.predict(trained, trained.labels.transform(rows.filter(~is_train)))
    return trained, M.metrics(scored).first()


def test_statistics_match_the_index_and_train_beyond_the_bins(spark):
    rows = P.parse_lines(FX.traffic_lines(spark, SF), keep=("line_id",))
    index, by_index = held_out(spark, M.ForestParams(rate_as_category=True, num_trees=5), rows)
    stats, by_stats = held_out(spark, M.ForestParams(rate_as_category=True, num_trees=5, category_bins=10), rows)
    assert type(index.model.stages[0]).__name__ == "CategoryIndexModel" and type(stats.model.stages[0]).__name__ == "ClassStatisticsModel"
    assert all(abs(a - b) <= 0.01 for a, b in zip(by_index, by_stats, strict=True)), (by_index, by_stats)


def test_more_rates_than_bins_train(spark):
    """200,000 different rates, each on two rows."""
    base = P.parse_lines(FX.traffic_lines(spark, SF), keep=("line_id",), complete=True).limit(1).drop("line_id", "Rate", "Label", "rate_value")
    ids = spark.range(400_000).select((F.col("id") % 200_000).cast("string").alias("Rate"), F.when(F.col("id") % 200_000 % 3 == 0, "A").otherwise("B").alias("Label"), F.col("id").alias("line_id"))
    rows = ids.crossJoin(F.broadcast(base))
    trained = M.train(rows, M.ForestParams(rate_as_category=True, num_trees=10, max_depth=3))
    assert type(trained.model.stages[0]).__name__ == "ClassStatisticsModel"
    # every other feature is constant, and a tree looks at a few features only
    shares = M.predict(trained, rows.where("line_id < 300")).select("Label", vector_to_array("probability")[trained.labels.labels.index("A")].alias("p"))
    by_label = {r.Label: r.p for r in shares.groupBy("Label").agg(F.avg("p").alias("p")).collect()}
    assert shares.count() == 300 and by_label["A"] > by_label["B"] + 0.15, by_label
