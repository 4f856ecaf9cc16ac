import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.operators.moving import moving_average


def readings(spark, data):
    """Rows of (id, key, second, value)."""
    df = spark.createDataFrame(data, "id int, key string, s double, value double")
    return df.withColumn("timestamp", F.timestamp_seconds("s"))


def plain_window(df, hours):
    """The textbook form, for comparison on small data."""
    w = (
        Window.partitionBy("key")
        .orderBy(F.col("timestamp").cast("long"))
        .rangeBetween(-hours * 3600, 0)
    )
    return df.withColumn(f"mean_last_{hours}h", F.avg("value").over(w))


def test_both_ends_and_own_row_are_in_the_frame(spark):
    df = readings(spark, [(i, "a", i * 3600.0, float(i)) for i in range(5)])
    got = moving_average(df, "value", 3, "key").orderBy("id")
    assert [r.mean_last_3h for r in got.collect()] == [0.0, 0.5, 1.0, 1.5, 2.5]


@pytest.mark.parametrize("seed", range(3))
def test_same_as_a_plain_range_window(spark, rows, seed):
    r = random.Random(seed)
    # A hot key, a null key, a hot second and null times among rows of all densities.
    data = []
    for i in range(1500):
        key = r.choice(["hot"] * 4 + ["b", None])
        second = r.choice([None, 50_000.0, r.uniform(0, 30_000), r.randint(-20, 20) * 3600.0])
        value = r.choice([None, r.randint(0, 1000) / 4])
        data.append((i, key, second, value))
    df = readings(spark, data)
    for hours in (1, 3):
        column = f"mean_last_{hours}h"
        got = dict(rows(moving_average(df, "value", hours, "key"), "id", column))
        expected = dict(rows(plain_window(df, hours), "id", column))
        assert got.keys() == expected.keys()
        for i, mean in expected.items():
            if mean is None:
                assert got[i] is None
            else:
                assert math.isclose(got[i], mean, rel_tol=1e-12)


def test_a_large_value_does_not_spoil_later_means(spark):
    df = readings(spark, [(0, "a", 0.0, 1e300), (1, "a", 4000.0, 0.1), (2, "a", 4001.0, 0.3)])
    got = moving_average(df, "value", 1, "key").orderBy("id").collect()
    assert [r.mean_last_1h for r in got] == [1e300, 0.1, 0.2]


def test_decimal_sums_do_not_depend_on_the_order_of_rows(spark):
    data = [(i, "a", 0.0, v) for i, v in enumerate([0.1, 0.2, 0.3, 1e9, 0.7, -1e9])]
    for order in (data, data[::-1]):
        got = moving_average(readings(spark, order), "value", 1, "key", sum_type="decimal(18,2)")
        assert {r.mean_last_1h for r in got.collect()} == {1.3 / 6}


def test_one_window_group_holds_at_most_two_blocks_of_seconds(spark):
    """However many rows a key has, they are summed per second before the window."""
    df = readings(spark, [(i, "hot", float(i % 3), 1.0) for i in range(2000)])
    means = moving_average(df, "value", 1, "key")
    plan = means._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "HashAggregate" in window and "partial_sum" in window
    assert "__block" in plan
    assert means.agg(F.sum("mean_last_1h")).first()[0] == 2000.0
