"""What training and scoring read and evaluate once."""

from pyspark.ml.classification import RandomForestClassifier

from tidewatch.operators import ml as M
from tidewatch.operators import parse as P
from tidewatch.schema import TRAFFIC_FIELDS


def lines(spark, n=60):
    odd = {3: "", 5: "x", 7: "nan", 9: "inf", 11: "99999999999", 13: "-inf"}
    rows = []
    for i in range(n):
        for at in (0, 1, 3, 36):
            values = [("BENIGN" if i % 2 else "XSS") if k == "string" and name != "Rate" else str(i % 7) + ".5" for name, k in TRAFFIC_FIELDS]
            values[at] = odd.get(i, values[at])
            rows.append((4 * i + at, ",".join(values) + (",more" if i == 17 else "")))
    return spark.createDataFrame([*rows, (9999, None)], "line_id long, csv_line string")


def test_the_completeness_filter_reads_parsed_fields(spark):
    df = lines(spark)
    for numeric in (True, False):
        feats = M.numeric_feature_names() + ["rate_value" if numeric else "Rate"]
        got = P.parse_lines(df, keep=("line_id",), complete=True, rate_numeric=numeric)
        want = P.complete_rows(P.parse_lines(df, keep=("line_id",)), feats)
        assert got.columns == want.columns and got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and 200 < got.count() < 240
        assert "forall" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert "rate_value" not in P.parse_lines(df, complete=True, rate_value=False).columns


def test_the_forest_reads_rows_that_are_assembled_once(spark, monkeypatch):
    seen, fit = [], RandomForestClassifier.fit

    def watched(self, df, *a):
        seen.append((df, df.storageLevel.useMemory and df.storageLevel.useDisk))
        return fit(self, df, *a)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    M.train(P.parse_lines(lines(spark), keep=("line_id",)).where("line_id >= 120"), M.ForestParams(num_trees=2, max_depth=2))
    assert [kept for _, kept in seen] == [True] and not seen[0][0].storageLevel.useMemory
