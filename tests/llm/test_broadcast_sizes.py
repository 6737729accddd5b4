"""Tables whose rows the planner underrates are not broadcast in near-dedup."""

import random

from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from tidewatch.llm import common, neardup
from tidewatch.plans.strategy import plan_text


def test_an_exploded_table_is_not_broadcast(spark, tmp_path):
    """However small its file, the table of all keys times all keys is joined by a shuffle."""
    keys = F.transform(F.sequence(F.lit(1), F.lit(24)), lambda x: x + F.col("id") % 3)
    spark.range(200).select(F.col("id").alias("doc_id"), F.lit(9).cast("long").alias("n"), keys.alias("first"), keys.alias("second")).write.parquet(f"{tmp_path}/live")
    got = neardup.buckets(spark.read.parquet(f"{tmp_path}/live"))
    assert "Broadcast" not in plan_text(got)
    assert got.select("doc_id").distinct().count() == 200


def test_counted_rows_are_left_to_the_planner(spark):
    few, many = spark.range(50), spark.range(5000)
    for made, hinted in ((common.planned(few, 50), False), (common.planned(many, 50), True)):
        assert ("SortMergeJoin" in plan_text(spark.range(100).join(made, "id"))) == hinted


def test_more_than_few_rows_give_the_same_groups(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        base = sentence(rng, 60)
        rows += [(4 * i, base), (4 * i + 1, base), (4 * i + 2, base + " end"), (4 * i + 3, sentence(rng, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, neardup.near_duplicates(spark, docs, shingle=2).collect()))
    monkeypatch.setattr(neardup, "_FEW", 8)
    monkeypatch.setattr(neardup, "_FEW_ITEMS", 8)
    monkeypatch.setattr(common, "BROADCAST_IDS", 8)
    kept, keep = [], common.Scratch.keep
    monkeypatch.setattr(neardup.Scratch, "keep", lambda self, df, name: kept.append((name, plan_text(df))) or keep(self, df, name))
    got = neardup.near_duplicates(spark, docs, shingle=2)
    assert sorted(map(tuple, got.collect())) == want and len({r[2] for r in want}) < 200
    plans = dict(kept)
    assert all("BroadcastHashJoin" not in plans[name] for name in ("buckets", "links-0", "sets-0")) and "BroadcastHashJoin" not in plan_text(got)
