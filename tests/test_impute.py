import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators.impute import (
    DateOffset,
    FromColumn,
    KeyMean,
    Literal,
    WindowMean,
    _batches,
    impute,
)

NAN = float("nan")


def test_window_fills_nulls_and_rounds(spark, rows):
    data = [(0, "a", 0, 1.0), (1, "a", 60, 2.0), (2, "a", 120, 2.0), (3, "a", 180, None)]
    data += [(4, "a", 200_000, None), (5, "b", 10, None), (6, None, 0, 5.0), (7, None, 1, None)]
    df = spark.createDataFrame(data, "id int, key string, s long, x double")
    df = df.withColumn("timestamp", F.timestamp_seconds("s"))
    got = dict(rows(impute(df, [WindowMean("x", 2, "key")]), "id", "x"))
    assert got == {0: 1.0, 1: 2.0, 2: 2.0, 3: 1.667, 4: None, 5: None, 6: 5.0, 7: 5.0}


def test_window_on_nan(spark, rows):
    df = spark.createDataFrame(
        [(0, "a", 0, 1.0), (1, "a", 1800, NAN), (2, "a", 3600, 3.0), (3, "a", 5400, None)],
        "id int, key string, s long, x double",
    ).withColumn("timestamp", F.timestamp_seconds("s"))
    got = dict(rows(impute(df, [WindowMean("x", 2, "key", nan=True)]), "id", "x"))
    assert got == {0: 1.0, 1: 1.0, 2: 3.0, 3: 2.0}


def test_window_fields_do_not_disturb_each_other(spark, rows):
    df = spark.createDataFrame(
        [(0, "a", 0, 1.0, 10.0), (1, "a", 60, None, 20.0), (2, "a", 120, 3.0, None)],
        "id int, key string, s long, x double, y double",
    ).withColumn("timestamp", F.timestamp_seconds("s"))
    got = impute(df, [WindowMean("x", 1, "key"), WindowMean("y", 1, "key")])
    assert got.columns == df.columns
    assert rows(got, "id", "x", "y") == [(0, 1.0, 10.0), (1, 1.0, 20.0), (2, 3.0, 15.0)]


def test_mean_by_key(spark, rows):
    data = [(None, 5.0), (None, None), ("A", 1.0), ("A", None), ("", 7.0), ("", None), ("B", None)]
    df = spark.createDataFrame(
        [(i, *d) for i, d in enumerate(data)], "id int, product_id string, x double"
    )
    got = dict(rows(impute(df, [KeyMean("x", "product_id")]), "id", "x"))
    assert got == {0: 5.0, 1: None, 2: 1.0, 3: 1.0, 4: 7.0, 5: 7.0, 6: None}


def test_mean_of_whole_numbers_is_not_cut(spark, rows):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("A", None)], "k string, x int")
    assert rows(impute(df, [KeyMean("x", "k")]), "x") == [(1.0,), (1.5,), (2.0,)]


def test_mean_by_a_hot_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.lit(2.0)).alias("x"),
    )
    got = impute(df, [KeyMean("x", "k")])
    assert got.count() == 20_000
    assert got.filter("k = 'hot' and (x is null or x <> 2)").isEmpty()


def test_date_offset(spark, rows):
    d = dt.date(2025, 1, 1)
    df = spark.createDataFrame([(d, None), (d, d), (None, None)], "made date, ends date")
    got = impute(df, [DateOffset("ends", "made", 40)])
    assert rows(got, "ends") == [(None,), (d,), (dt.date(2025, 2, 10),)]


def test_literal(spark, rows):
    df = spark.createDataFrame([("USD",), (None,)], "currency string")
    assert rows(impute(df, [Literal("currency", "EUR")])) == [("EUR",), ("USD",)]


def test_from_column_only_for_the_given_status(spark, rows):
    d = dt.date(2025, 1, 1)
    df = spark.createDataFrame(
        [(0, "RECEIVED", d, None), (1, "SENT", d, None), (2, None, d, None)],
        "id int, status string, planned date, actual date",
    )
    got = impute(df, [FromColumn("actual", "planned", "status", "RECEIVED")])
    assert rows(got, "id", "actual") == [(0, d), (1, None), (2, None)]


def test_unknown_rule(spark):
    with pytest.raises(ValueError, match="unknown imputation rule"):
        impute(spark.range(1), ["median"])


def test_rules_share_a_pass_only_where_the_order_cannot_matter():
    x, y = WindowMean("x", 3, "k"), WindowMean("y", 3, "k")
    assert _batches([x, Literal("z", 0), y], "timestamp") == [[x, y], [Literal("z", 0)]]
    # A rule that fills the key of another must stay where it is.
    rules = [KeyMean("x", "k"), Literal("k", "none"), KeyMean("y", "k")]
    assert _batches(rules, "timestamp") == [[r] for r in rules]


def test_rows_without_a_gap_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([("A", 1.0), ("A", None)], "k string, x double").write.parquet(
        f"{tmp_path}/t"
    )
    df = impute(spark.read.parquet(f"{tmp_path}/t"), [KeyMean("x", "k")])
    plan = df._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    passing, filled = str(plan.children().apply(0)), str(plan.children().apply(1))
    assert "Join" not in passing and "Aggregate" not in passing
    assert "Join" in filled and "isnull(x" in filled
