"""Business aggregates.

`sum_type` names a decimal type to sum prices and readings in; the totals then do not
depend on the order in which rows arrive. Results are doubles either way.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(column: str, sum_type: str | None) -> Column:
    return F.sum(F.col(column).cast(sum_type) if sum_type else F.col(column))


def _total(column: str, sum_type: str | None) -> Column:
    return _sum(column, sum_type).cast("double")


def _mean(column: str, sum_type: str | None) -> Column:
    n = F.count(column)
    return _total(column, sum_type) / F.when(n > 0, n)


def sales_volume(sales: DataFrame, sum_type: str | None = None) -> DataFrame:
    """Orders, sales and mean order value per category and day.

    All transaction states and currencies count alike.
    """
    return sales.groupBy("category", F.to_date("timestamp").alias("order_date")).agg(
        F.count("*").alias("orders_count"),
        _total("sales_price", sum_type).alias("total_sales"),
        _mean("sales_price", sum_type).alias("avg_order_value"),
    )


def sales_parts(sales: DataFrame, sum_type: str | None = None) -> DataFrame:
    """What `sales_volume` adds up, per category and day; parts of several runs can be merged."""
    return sales.groupBy("category", F.to_date("timestamp").alias("order_date")).agg(
        F.count("*").alias("orders"),
        _sum("sales_price", sum_type).alias("total"),
        F.count("sales_price").alias("priced"),
    )


def sales_volume_of(parts: DataFrame) -> DataFrame:
    """`sales_volume` from the parts of all runs."""
    n, total = F.sum("priced"), F.sum("total").cast("double")
    return parts.groupBy("category", "order_date").agg(
        F.sum("orders").alias("orders_count"),
        total.alias("total_sales"),
        (total / F.when(n > 0, n)).alias("avg_order_value"),
    )


def with_delivery_delay(df: DataFrame) -> DataFrame:
    """Days between scheduled and actual delivery, and whether it was on time.

    An order that is not delivered has no delay and is not on time.
    """
    delay = F.datediff("actual_delivery_date", "scheduled_delivery_date")
    return df.withColumns(
        {
            "delivery_delay_days": delay,
            "on_time_delivery": F.when(delay <= 0, True).otherwise(False),
        }
    )


def order_fulfillment_performance(sales: DataFrame, logistics: DataFrame) -> DataFrame:
    """Deliveries per category and city, over all pairs of sale and delivery of an order.

    `total_orders` counts these pairs. An undelivered order is not on time but does not
    enter the mean delay. Deliveries are counted per order first, so they are one row per
    order when they meet the sales: sales never multiply, and are moved once. The adaptive
    join splits an order that has very many.
    """
    delivered = with_delivery_delay(logistics).filter(F.col("order_id").isNotNull())
    per_order = delivered.groupBy("order_id").agg(
        F.count("*").alias("__n"),
        F.sum(F.col("on_time_delivery").cast("int")).alias("__on_time"),
        F.sum("delivery_delay_days").alias("__delay"),
        F.count("delivery_delay_days").alias("__delivered"),
    )
    delay, n = F.sum("__delay").cast("double"), F.sum("__delivered")
    return (
        sales.select("order_id", "category", "city")
        .join(per_order, "order_id")
        .groupBy("category", "city")
        .agg(
            F.sum("__n").alias("total_orders"),
            F.sum("__on_time").alias("on_time_deliveries"),
            (delay / F.when(n > 0, n)).alias("avg_delay_days"),
        )
        .withColumn("on_time_rate", F.col("on_time_deliveries") / F.col("total_orders"))
    )


def climate_impact(
    sales: DataFrame,
    climate: DataFrame,
    sum_type: str | None = None,
    per_reading: bool = False,
) -> DataFrame:
    """Sales and mean weather of every day that has both.

    Each side is aggregated to days before they meet, one row to one row. Pairing every
    sale with every reading of its day, as the original jobs do, repeats the total once
    per reading and leaves the means alike; `per_reading=True` gives that total.
    """
    sold = sales.groupBy(F.to_date("timestamp").alias("date")).agg(
        _sum("sales_price", sum_type).alias("__sales")
    )
    weather = climate.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("__readings"),
        _mean("temperature_C", sum_type).alias("avg_temp_C"),
        _mean("humidity_percent", sum_type).alias("avg_humidity"),
    )
    total = F.col("__sales")
    if per_reading:
        total = total * F.col("__readings")
    return sold.join(weather, "date").select(
        "date", total.cast("double").alias("total_sales"), "avg_temp_C", "avg_humidity"
    )


def daily_sales_parts(sales: DataFrame, sum_type: str | None = None) -> DataFrame:
    day = F.to_date("timestamp").alias("date")
    return sales.groupBy(day).agg(_sum("sales_price", sum_type).alias("total"))


def weather_parts(climate: DataFrame, sum_type: str | None = None) -> DataFrame:
    """Sums and numbers of the readings of each day."""
    parts = [(f"{n}_{c}", f(c, sum_type)) for c in WEATHER for n, f in (("sum", _sum), ("n", _count))]
    return climate.groupBy(F.to_date("timestamp").alias("date")).agg(*[v.alias(n) for n, v in parts])


WEATHER = {"temperature_C": "avg_temp_C", "humidity_percent": "avg_humidity"}


def _count(column: str, _: str | None) -> Column:
    return F.count(column)


def climate_impact_of(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """`climate_impact` from the parts of all runs, each side merged before they meet."""
    sold = sales.groupBy("date").agg(F.sum("total").cast("double").alias("total_sales"))
    means = []
    for c, name in WEATHER.items():
        n = F.sum(f"n_{c}")
        means.append((F.sum(f"sum_{c}").cast("double") / F.when(n > 0, n)).alias(name))
    return sold.join(weather.groupBy("date").agg(*means), "date").select(
        "date", "total_sales", *WEATHER.values()
    )
