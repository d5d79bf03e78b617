"""Order statistics against numpy, with ties, heavy tails, nulls, small sketches, and without any sort of the rows."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.operators import order_statistics as O
from obsframe.operators import ordering


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({"k": np.where(np.arange(n) < 2600, "hot", np.where(np.arange(n) < 3990, "b", None))})
    pdf["x"] = rng.normal(size=n).round(1)  # ties
    pdf["y"] = np.exp(rng.normal(scale=40, size=n))  # dozens of orders of magnitude
    pdf["z"] = np.where(rng.random(n) < 0.6, 7.0, rng.random(n))  # one value is most of them
    pdf.loc[rng.random(n) < 0.2, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df.repartition(5).cache()


@pytest.mark.parametrize("cells,pick", [(1024, 50_000), (16, 40)])
def test_as_numpy(spark, monkeypatch, values, cells, pick):
    pdf, df = values
    monkeypatch.setattr(O, "CELLS", cells)
    monkeypatch.setattr(O, "PICK_ROWS", pick)
    asked = {f"{c}{q}": (c, q) for c in "xyz" for q in (0.0, 0.25, 0.5, 0.9, 1.0)}
    got = O.order_statistics(df, ["k"], {name: (c, O.at_share(q)) for name, (c, q) in asked.items()}).collect()
    assert len(got) == 3
    for row in got:
        part = pdf[pdf.k.isna()] if row.k is None else pdf[pdf.k == row.k]
        for name, (c, q) in asked.items():
            assert row[name] == pytest.approx(np.nanquantile(part[c], q), rel=1e-12)


def test_without_key_and_without_values(spark, values):
    pdf, df = values
    got = O.order_statistics(df, [], {"m": ("y", O.at_share(0.5))}).collect()
    assert [r.m for r in got] == [pytest.approx(np.median(pdf.y), rel=1e-12)]
    none = df.select("k", F.lit(None).cast("double").alias("v"))
    assert {r.m for r in O.order_statistics(none, ["k"], {"m": ("v", O.at_share(0.5))}).collect()} == {None}
    assert O.order_statistics(none.limit(0), ["k"], {"m": ("v", O.at_share(0.5))}).collect() == []


def test_large_keys_do_not_move(spark, monkeypatch, values, tmp_path):
    """The split form neither sorts nor shuffles rows, and gives what the aggregate gives."""
    values[1].write.parquet(f"{tmp_path}/values")
    df = spark.read.parquet(f"{tmp_path}/values")
    wanted = {"q1": ("x", 0.25), "q3": ("x", 0.75), "m": ("y", 0.5)}
    whole = {r.k: r for r in ordering.quantiles(df, ["k"], [F.count("x").alias("n")], wanted).collect()}
    monkeypatch.setattr(ordering, "positions", lambda *a, **k: pytest.fail("rows were sorted"))
    monkeypatch.setattr(O, "PICK_ROWS", 100)
    moved = []
    link = O.link

    def watched(rows, other, on, how="left"):
        out = link(rows, other, on, how)
        if "y" in rows.columns:  # the rows themselves, not what was made of them
            moved.append(out)
        return out

    monkeypatch.setattr(O, "link", watched)
    spark.conf.set("spark.obsframe.maxGroupRows", "500")
    try:
        split = {r.k: r for r in ordering.quantiles(df, ["k"], [F.count("x").alias("n")], wanted).collect()}
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    assert split.keys() == whole.keys()
    for k, row in whole.items():
        assert split[k].n == row.n and [split[k][c] for c in wanted] == pytest.approx([row[c] for c in wanted], rel=1e-12)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in moved]
    rows_read = [p for p in plans if "FileScan" in p]
    lines = [line.strip() for p in rows_read for line in p.splitlines()]
    assert rows_read and not [line for line in lines if re.match(r"[:+\- ]*(Sort \[|Exchange (hash|range))", line)]


@pytest.mark.parametrize("entries", [4096, 16])
def test_summaries_as_numpy(spark, monkeypatch, values, entries):
    """Values from summaries, however rough these are; whole ones take a scan."""
    pdf, df = values
    for name, size in (("SUMMARY", entries), ("MERGED", entries), ("FOLD_ROWS", 4 * entries)):
        monkeypatch.setattr(O, name, size)
    scans = []
    summaries = O.summaries
    monkeypatch.setattr(O, "summaries", lambda *a: scans.append(1) or summaries(*a))
    asked = {f"{c}{q}": (c, q) for c in "xyz" for q in (0.0, 0.25, 0.5, 0.9, 1.0)}
    wanted = {name: (c, O.at_share(q)) for name, (c, q) in asked.items()}
    got = O.summarised_statistics(df, ["k"], df.select("k").distinct(), wanted).collect()
    assert len(got) == 3 and (len(scans) == 1 if entries == 4096 else 1 < len(scans) < 12)
    for row in got:
        part = pdf[pdf.k.isna()] if row.k is None else pdf[pdf.k == row.k]
        for name, (c, q) in asked.items():
            assert row[name] == pytest.approx(np.nanquantile(part[c], q), rel=1e-12)


def test_summaries_order_as_spark(spark):
    rows = [("a", v) for v in (float("nan"), float("inf"), -1.5, -0.0, 0.0, 2.0, None, float("-inf"), 3.0)] + [("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {f"r{i}": ("v", lambda n, i=i: n - n + i) for i in range(8)}
    got = {r.k: r for r in O.summarised_statistics(df, ["k"], df.select("k").distinct(), wanted).collect()}
    want = [r.v for r in df.where("k = 'a' and v is not null").orderBy("v").collect()]
    np.testing.assert_array_equal([got["a"][f"r{i}"] for i in range(8)], want)
    assert got["b"].r0 is None
    none = O.summarised_statistics(df.limit(0), ["k"], df.select("k").distinct(), wanted)
    assert none.columns == ["k", *wanted] and none.collect() == []


def test_one_heavy_value_hides_no_others(spark, monkeypatch):
    for name, size in (("SUMMARY", 32), ("MERGED", 32), ("FOLD_ROWS", 200)):
        monkeypatch.setattr(O, name, size)
    v = np.concatenate([np.full(9_000, 5.0), np.arange(1_000) / 1_000, 6 + np.arange(1_000) / 1_000])
    df = spark.createDataFrame(pd.DataFrame({"v": np.random.default_rng(2).permutation(v)})).repartition(3)
    qs = (0.001, 0.05, 0.0909, 0.5, 0.93, 0.999)
    got = O.summarised_statistics(df, [], df, {str(q): ("v", O.at_share(q)) for q in qs}).first()
    assert [got[str(q)] for q in qs] == pytest.approx([np.quantile(v, q) for q in qs], rel=1e-12)
