"""The report is read off one scan and says what its parts say."""

from __future__ import annotations

import datetime as dt

from obsframe.binding import Binding
from obsframe.operators import aggregates as A

B = Binding(("k",), "t", ("x", "y"))
SCHEMA = "t timestamp_ntz, k string, x double, y double"


def rows(spark, n):
    at = dt.datetime(2024, 1, 1)
    data = [(at + dt.timedelta(hours=i), [None, "a", "b"][i % 3], None if i % 7 == 0 else float(i), 2.0 * i + i % 2) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def test_one_scan_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 200).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            reads.add(len(pdf))
            yield pdf

    seen = spark.read.schema(SCHEMA).parquet(path).mapInPandas(count, SCHEMA)
    assert A.summary_report(seen, B, ["t", "k", "x", "y"]).count() > 0
    assert reads.value == 200


def test_sections_are_those_of_their_operators(spark):
    df = rows(spark, 100)
    got = {(r.section, r.metric): r.value for r in A.summary_report(df, B, ["t", "k", "x", "y"]).collect()}
    summary, ranks = A.dataset_summary(df, B).first(), A.key_rankings(df, B).first()
    assert got["dataset", "total_records"] == "100" and got["dataset", "keys"] == str(summary["keys"]) == "2"
    assert got["dataset", "overall_std"] == f"{summary.overall_std:.8f}"
    assert got["rankings", "highest_mean"] == f"{ranks.highest_mean:.8f}" and got["rankings", "highest_key"] == ranks.highest_key
    assert got["missing_values", "x"] == "15" and got["missing_values", "k"] == "34" and ("correlations", "x~y") in got


def test_report_of_an_empty_table(spark):
    got = {(r.section, r.metric): r.value for r in A.summary_report(rows(spark, 1).where("false"), B, ["k", "x"]).collect()}
    assert got["dataset", "total_records"] == "0" and got["dataset", "keys"] == "0"
    assert got["missing_values", "x"] == "0" and got["data_quality", "completeness_pct"] == "null"
