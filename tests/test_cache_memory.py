"""What training caches is counted in full: deserialized blocks of small batches."""

from pyspark.sql.classic.dataframe import DataFrame

from tests.test_fit_cost import lines
from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.plans import catalog

KEY = "spark.sql.inMemoryColumnarStorage.batchSize"


def watched(monkeypatch):
    """Level and batch size of everything that is cached, when its first action runs at the latest."""
    seen, persist = [], DataFrame.persist

    def spy(self, *level):
        seen.append(level[0])
        return persist(self, *level)

    monkeypatch.setattr(DataFrame, "persist", spy)
    return seen


def test_training_caches_deserialized_rows_in_small_batches(spark, monkeypatch):
    before, seen, sizes = spark.conf.get(KEY), watched(monkeypatch), []
    fit = M.fit_label_indexer
    monkeypatch.setattr(M, "fit_label_indexer", lambda rows: sizes.append(int(spark.conf.get(KEY))) or fit(rows))
    df = P.parse_lines(lines(spark), keep=("line_id",)).where("line_id >= 120")
    trained = M.train(df, M.ForestParams(num_trees=2, max_depth=2))
    assert len(trained.labels.labels) == 2 and len(seen) == 2
    assert all(level.deserialized and level.useMemory and level.useDisk for level in seen)
    assert sizes == [M.CACHE_ROWS] and spark.conf.get(KEY) == before


def test_queries_cache_their_parsed_rows_deserialized(spark, monkeypatch):
    seen = watched(monkeypatch)
    assert catalog.QUERIES["model_metrics"](spark, "/root/testdata/sf0.001").count() == 1
    assert len(seen) == 2 and all(level.deserialized for level in seen)
